"""A corpus pipeline: language, near duplicates, benchmark leaks, personal data, then token ids.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept, and returns a DataFrame that is
written and read again as the next one's input. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.llm.decontaminate import drop_contaminated
from marlstone.llm.jaccard import keep_first
from marlstone.llm.language import drop_unknown, train
from marlstone.llm.lattice import coded, id_bytes
from marlstone.llm.pii import redact
from marlstone.llm.store import materialize, read


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Fits the languages on the labelled documents and drops those without a language."""
    return drop_unknown(docs, train(docs, "doc_id", "text", "lang"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of least number of each group that n-gram similarity links."""
    return keep_first(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold an item of the benchmark."""
    return drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Puts the kind in the place of each span of personal data; n_chars is that of the new text."""
    clean = redact(docs)
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of each document, whether they decode to its text, and its sampled segmentations; ids are binary cells."""
    found = coded(docs, as_bytes=True)
    return found.select(F.col("id").alias("doc_id"), (F.octet_length("ids") / id_bytes()).cast("int").alias("n_ids"), "ids", "exact", "samples")


STAGES = [
    ("language ID", language),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("PII", personal_data),
    ("SentencePiece encoding and decoding", token_ids),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
