"""Landed files as typed tables: registries, submissions, company facts, indexes, headers, documents, ledgers."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as X

REGISTRY = "company_id string, display_name string, primary_cik string, ticker string, sic int, sic_description string, industry_profile string, fiscal_year_end string, target_period_policy string, entity_continuity_status string, related_ciks string, roles string"
LEDGER = "timestamp_utc string, method string, source_url string, status_code int, purpose string, repo_relative_path string, headers_repo_relative_path string, content_length bigint, content_sha256 string, accession string, document_name string, user_agent string, retry_attempt int, error string"
FACTS = "cik bigint, entityName string, facts map<string, map<string, struct<units: map<string, array<struct<start: date, end: date, val: decimal(38,6), accn: string, fy: int, fp: string, form: string, filed: date, frame: string>>>>>>"
SUBMISSION_COLUMNS = ("accessionNumber", "filingDate", "reportDate", "acceptanceDateTime", "act", "form", "fileNumber", "filmNumber", "items", "size", "isXBRL", "isInlineXBRL", "primaryDocument", "primaryDocDescription")


def csv_table(spark: SparkSession, path: str, schema: str, exact: bool = True) -> DataFrame:
    """A CSV file of known shape; blank cells are null. With ``exact`` a row too short, too long, of a wrong type,
    or a header that differs is an error when read; else what does not fit is null."""
    mode = "FAILFAST" if exact else "PERMISSIVE"
    return spark.read.csv(path, schema=schema, header=True, enforceSchema=False, mode=mode, emptyValue="", nullValue="", quote='"', escape='"', multiLine=True)


def roles(registry: DataFrame) -> DataFrame:
    """(company_id, entity_role, cik): the roles cell ``role:cik;role:cik`` as rows."""
    rows = registry.select("company_id", F.explode(F.split("roles", ";")).alias("r")).select("company_id", F.split("r", ":").alias("p"))
    return rows.select("company_id", F.trim(F.col("p")[0]).alias("entity_role"), X.cik10(F.col("p")[1]).alias("cik"))


def profiles(registry: DataFrame, rules: DataFrame, overrides: dict[str, str] | None = None) -> DataFrame:
    """``registry`` with ``profile``: an override, else the rule whose SIC range holds, else the default."""
    from ..operators.relational import banded

    out = banded(registry, rules, "sic", "sic_start", "sic_end", F.lit("default_non_fi"), "profile")
    if overrides:
        table = F.create_map(*[F.lit(x) for kv in overrides.items() for x in kv])
        out = out.withColumn("profile", F.coalesce(table[F.col("company_id")], "profile"))
    return out


def _parallel(prefix: str) -> Column:
    """Arrays of equal length as an array of rows."""
    return F.arrays_zip(*[F.col(f"{prefix}{c}").alias(c) for c in SUBMISSION_COLUMNS])


def submissions_schema(base: bool) -> T.StructType:
    kinds = {"size": T.LongType(), "isXBRL": T.IntegerType(), "isInlineXBRL": T.IntegerType()}
    arrays = T.StructType([T.StructField(c, T.ArrayType(kinds.get(c, T.StringType()))) for c in SUBMISSION_COLUMNS])
    if not base:
        return arrays
    names = T.ArrayType(T.StructType([T.StructField("name", T.StringType())]))
    return T.StructType([T.StructField("cik", T.StringType()), T.StructField("filings", T.StructType([T.StructField("recent", arrays), T.StructField("files", names)]))])


def submissions(spark: SparkSession, base: str, supplements: str | None = None) -> DataFrame:
    """Filings of a base file and its supplements, one row each, with the file they came from."""
    b = spark.read.json(base, schema=submissions_schema(True), multiLine=True).select("*", F.col("_metadata.file_name").alias("source_file"))
    rows = b.select(F.col("cik"), "source_file", F.explode(_parallel("filings.recent.")).alias("f"))
    if supplements:
        s = spark.read.json(supplements, schema=submissions_schema(False), multiLine=True).select("*", F.col("_metadata.file_name").alias("source_file"))
        cik = F.regexp_extract("source_file", r"^CIK0*([0-9]+)-", 1)
        rows = rows.unionByName(s.select(cik.alias("cik"), "source_file", F.explode(_parallel("")).alias("f")))
    out = rows.select(X.cik10(F.col("cik")).alias("cik"), "source_file", "f.*")
    return out.withColumns({c: F.to_date(F.nullif(F.col(c), F.lit(""))) for c in ("filingDate", "reportDate")})


def supplement_names(submission: str | None, cik: int | str) -> list[str]:
    """The supplement files that a base file names; any other name, as of another CIK or path, is an error."""
    import re

    from ..functions.urls import cik10

    if submission is None:
        raise TypeError("no submission")
    names = [f["name"] for f in json.loads(submission)["filings"].get("files", [])]
    for name in names:
        if not re.fullmatch(rf"CIK{cik10(cik)}-submissions-[0-9]{{3}}\.json", name):
            raise ValueError(f"not a supplement of {cik}: {name!r}")
    return names


def companyfacts(spark: SparkSession, path: str) -> DataFrame:
    """All observations of company facts files: (cik, taxonomy, concept, unit, start, end, val, accn, ...)."""
    raw = spark.read.json(path, schema=FACTS, multiLine=True)
    x = raw.select(X.cik10(F.col("cik")).alias("cik"), F.explode("facts").alias("taxonomy", "c"))
    x = x.select("cik", "taxonomy", F.explode("c").alias("concept", "u"))
    x = x.select("cik", "taxonomy", "concept", F.explode("u.units").alias("unit", "o"))
    return x.select("cik", "taxonomy", "concept", "unit", F.explode("o").alias("o")).select("cik", "taxonomy", "concept", "unit", "o.*")


def index_documents(spark: SparkSession, path: str) -> DataFrame:
    """(path, name, type) of the documents that accession indexes list."""
    raw = spark.read.json(path, schema="directory struct<item: array<struct<name: string, type: string>>>", multiLine=True)
    return raw.select(F.col("_metadata.file_path").alias("path"), F.explode("directory.item").alias("i")).select("path", "i.*")


def bytes_table(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """Files as (path, length, content, sha256)."""
    raw = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    return raw.select("path", "length", "content", F.sha2("content", 256).alias("sha256"))


def headers(files: DataFrame) -> DataFrame:
    """SGML headers as (path, cik, accession, form, filing_date, period, items): repeated item tags in order, once each."""
    text = F.decode("content", "UTF-8")
    tag = lambda name: F.trim(F.regexp_extract(text, rf"(?m)^<{name}>([^\r\n]*)", 1))
    day = lambda name: F.to_date(F.nullif(tag(name), F.lit("")), "yyyyMMdd")
    items = F.array_distinct(F.regexp_extract_all(text, F.lit(r"(?m)^<ITEMS>([0-9]+\.[0-9]+)")))
    return files.select("path", F.lpad(tag("CIK"), 10, "0").alias("cik"), tag("ACCESSION-NUMBER").alias("accession"), tag("TYPE").alias("form"), day("FILING-DATE").alias("filing_date"), day("PERIOD").alias("period"), items.alias("items"))


def primary_items(html: Column) -> Column:
    """Item numbers that a primary document's headings name, in order, once each."""
    return F.array_distinct(F.regexp_extract_all(X.plain_text(html), F.lit(r"(?i)\bItem\s+([0-9]\.[0-9]{2})\b")))


def ledger(spark: SparkSession, path: str) -> DataFrame:
    """A request ledger of exact width."""
    return csv_table(spark, path, LEDGER)


def export_csv(df: DataFrame, columns: list[str], path: str) -> None:
    """One CSV file of the given columns, null as a blank cell. For artifacts of report size."""
    df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in columns]).coalesce(1).write.csv(path, header=True, mode="overwrite", emptyValue="")


def unique_object(pairs: list[tuple]) -> dict:
    """For json.loads: an object whose keys repeat is an error, where Spark would keep one silently."""
    out = dict(pairs)
    if len(out) != len(pairs):
        raise ValueError("a key repeats")
    return out
