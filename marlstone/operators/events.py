"""Events of current reports: items of filings, fiscal windows, counts with evidence, zeros with evidence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import config as C
from .relational import in_window, small


def items_of(header_items: Column, primary_items: Column, name: Column) -> Column:
    """A filing's items: the header's, else those of the primary document's headings; none at all is an error."""
    first = F.when(F.size(header_items) > 0, header_items).when(F.size(primary_items) > 0, primary_items)
    return F.coalesce(first, F.raise_error(F.concat(F.lit("no items in "), name)))


def event_rows(filings: DataFrame) -> DataFrame:
    """One row for each filing and item, of filings (…, accession, header_items, primary_items)."""
    none = F.array().cast("array<string>")
    h, p = F.coalesce("header_items", none), F.coalesce("primary_items", none)
    source = F.when(F.size(h) > 0, "hdr_sgml").otherwise("primary_document")
    rows = filings.withColumn("item_source", source).withColumn("item_code", F.explode(items_of(h, p, F.col("accession"))))
    return rows.drop("header_items", "primary_items")


def fiscal_window(filings: DataFrame, windows: DataFrame) -> DataFrame:
    """Current reports filed after the prior and up to the target report date, for each company and CIK role."""
    return in_window(filings.where(F.col("form").startswith("8-K")), windows, ["company", "cik"], "filing_date", "prior_report_date", "target_report_date")


def period_start(prior: Column, end: Column) -> Column:
    """The day after the prior year's end; without a prior year the first of January of the end's year."""
    return F.coalesce(F.date_add(prior, 1), F.trunc(end, "year").cast("date"))


def c04_period_start(prior: Column, prior_cik: Column, cik: Column, end: Column) -> Column:
    """period_start() of the auditor's metric: a prior year under another CIK does not count."""
    same = prior_cik.cast("long").eqNullSafe(cik.cast("long")) & cik.isNotNull()
    return period_start(F.when(same, prior), end)


def event_metrics(events: DataFrame, companies: DataFrame, mapping: dict[str, tuple[str, ...]] = C.EVENT_ITEMS) -> DataFrame:
    """(company, metric_id, value, status, unit, source_class, confidence, context, accessions): how many events of
    a metric's items each company has, over all its CIK roles; 0 with the evidence of the scan where none."""
    items = events.sparkSession.sql("select * from values " + ", ".join(f"('{m}', '{i}')" for m, xs in mapping.items() for i in xs) + " as t(metric_id, item_code)")
    hits = events.join(small(items), "item_code").groupBy("company", "metric_id").agg(F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_set("accession")), ";").alias("accessions"))
    grid = companies.select("company").distinct().crossJoin(small(items.select("metric_id").distinct()))
    out = grid.join(hits, ["company", "metric_id"], "left")
    some = F.col("n").isNotNull()
    pick = lambda yes, no: F.when(some, yes).otherwise(no)
    return out.select("company", "metric_id", F.coalesce("n", F.lit(0)).alias("value"), pick("8K_ITEM_OK", "NOT_AVAILABLE_SEC").alias("status"), F.lit("count").alias("unit"), F.lit("8K_ITEM").alias("source_class"), F.lit("text/event extraction").alias("formula"), pick(0.90, 0.80).alias("confidence"), pick("FY window", "FY-window 8-K accessions scanned").alias("context_or_dimension"), F.coalesce("accessions", F.lit("")).alias("accessions"))


def event_evidence(events: DataFrame, companies: DataFrame, mapping: dict[str, tuple[str, ...]] = C.EVENT_ITEMS) -> DataFrame:
    """One row for each counted event with the metric's total, and one for each zero that names the scan. A
    counted event carries its filing's CIK, a zero the company's own."""
    metrics = event_metrics(events, companies, mapping).select("company", "metric_id", F.col("value").alias("value_normalized"))
    items = events.sparkSession.sql("select * from values " + ", ".join(f"('{m}', '{i}')" for m, xs in mapping.items() for i in xs) + " as t(metric_id, item_code)")
    own = events.join(small(items), "item_code").join(metrics, ["company", "metric_id"])
    own = own.select("company", "cik", "metric_id", "accession", "item_code", F.lit(1).cast("long").alias("value_raw"), "value_normalized", F.lit("eightk_item").alias("extraction_method"))
    zero = metrics.where("value_normalized = 0").join(companies.select("company", "cik"), "company")
    zero = zero.select("company", "cik", "metric_id", F.lit(None).cast("string").alias("accession"), F.lit(None).cast("string").alias("item_code"), F.lit(0).cast("long").alias("value_raw"), "value_normalized", F.lit("eightk_zero_item_scan").alias("extraction_method"))
    return own.unionByName(zero)
