"""The whole batch: landed tables to the matrix of cells, its evidence and its coverage, as one lazy plan."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import config as C
from ..operators import events as E
from ..operators import facts as A
from ..operators import passages as P
from ..operators.relational import coverage, small

MATRIX = ["company", "cik", "metric_id", "value", "unit", "status", "source_class", "formula", "period_start", "period_end", "accession", "concept_or_section", "context_or_dimension", "confidence", "notes"]


@dataclass
class Landed:
    """Inputs. companies: (company, cik, profile, entity_continuity_status, fye, prior_fye). facts: of companyfacts.
    instance: facts with company, cik, accession. events: (company, cik, accession, item_code) of fiscal_window().
    passages: (company, cik, accession, text) of annual reports. auditors: those of auditor_candidates()."""

    companies: DataFrame
    facts: DataFrame
    instance: DataFrame
    events: DataFrame
    passages: DataFrame
    auditors: DataFrame


def _cells(df: DataFrame, **more) -> DataFrame:
    """The columns of a cell, null where a source has none."""
    kinds = {"value": "decimal(38,18)", "confidence": "decimal(3,2)", "period_start": "date", "period_end": "date"}
    out = []
    for c in MATRIX:
        if c == "cik":
            continue
        x = more[c] if c in more else F.col(c) if c in df.columns else F.lit(None)
        out.append((F.lit(x) if isinstance(x, str) else x).cast(kinds.get(c, "string")).alias(c))
    return df.select(*out)


def found_metrics(landed: Landed) -> DataFrame:
    """All that some extractor found, over the families."""
    spark = landed.companies.sparkSession
    ends = landed.companies.select("company", F.col("fye"))
    now = landed.instance.join(small(ends), "company").withColumn("period_end", F.col("period_end"))
    own = now.where(F.col("period_end") == F.col("fye"))
    parts = A.components(landed.facts, landed.companies, C.chains(spark))
    last = parts.where("period_kind = 'current'").groupBy("company").agg(F.max("end").alias("period_end"), F.max("accn").alias("accession"))
    standard = _cells(A.standard_metrics(parts).join(last, "company", "left"), confidence=F.lit(0.95))
    basel = _cells(A.basel_ratios(own, F.col("fye")), unit="pure", status="DIM_XBRL_OK", source_class="DIM_XBRL", formula="fact", concept_or_section=F.col("concept"), context_or_dimension=F.col("context"), confidence=F.lit(0.9))
    backlog = _cells(A.rpo(own, F.col("fye")).withColumn("metric_id", F.lit("B12")), unit="USD", source_class="DIM_XBRL", concept_or_section=C.RPO, notes="RPO is not recurring revenue", confidence=F.lit(0.9))
    pay = _cells(A.compensation(own, F.col("fye")).withColumn("metric_id", F.lit("C03")), unit="USD", source_class="DEF14A", formula="fact", concept_or_section="PeoTotalCompAmt", confidence=F.lit(0.9))
    change = _cells(A.auditor_change(landed.auditors, A.auditors(landed.instance)), unit="flag", source_class="DIM_XBRL", formula="names differ", concept_or_section="AuditorName")
    counted = _cells(E.event_metrics(landed.events, landed.companies), accession=F.col("accessions"))
    risk = _cells(P.risk_passages(landed.passages).groupBy("company", "metric_id").agg(F.max_by(F.struct("status", "quote", "accession"), F.struct("status", "accession")).alias("x")).select("company", "metric_id", "x.*"), unit="", source_class="TEXT", formula="text evidence", notes=F.col("quote"), confidence=F.lit(0.6))
    rooms = P.lodging(landed.passages).where("revpar is not null")
    rooms = rooms.groupBy("company").agg(F.min_by(F.struct("revpar", "occupancy", "quote", "accession"), F.struct("identity_error", "accession")).alias("x")).select("company", "x.*")
    rooms = _cells(rooms.select("company", "quote", "accession", F.expr("stack(2, 'B10', occupancy, 'percent', 'B11', revpar, 'USD') as (metric_id, value, unit)")), status="MDA_OK", source_class="MDA", formula="table, identity checked", notes=F.col("quote"), confidence=F.lit(0.8))
    out = standard
    for part in (basel, backlog, pay, change, counted, risk, rooms):
        out = out.unionByName(part)
    return out


def matrix(landed: Landed) -> DataFrame:
    """One row for each company and each metric of its profile."""
    spark = landed.companies.sparkSession
    cells = A.applied(found_metrics(landed).withColumn("cik", F.lit(None).cast("string")), landed.companies, C.applicability(spark))
    captive = A.captive_debt(landed.instance).select("company").distinct().withColumn("captive", F.lit(True))
    cells = A.continuity(cells, landed.companies).join(captive, "company", "left")
    review = F.coalesce("captive", F.lit(False)) & (F.col("metric_id") == "B06") & (F.col("profile") == "manufacturing")
    cells = cells.withColumn("value", F.when(~review, F.col("value"))).withColumn("status", F.when(review, "NEEDS_REVIEW").otherwise(F.col("status")))
    return cells.withColumn("source_class", F.coalesce("source_class", F.lit("NOT_AVAILABLE"))).select(*MATRIX)


def evidence(landed: Landed) -> DataFrame:
    """What cells rest on: components of standard metrics, facts of ratios, counted events and scans."""
    spark = landed.companies.sparkSession
    parts = A.components(landed.facts, landed.companies, C.chains(spark)).where("period_kind = 'current'")
    uses = {"B01": ["revenue"], "B02": ["revenue"], "B03": ["operating_income", "revenue"], "B04": ["net_income"], "B05": ["operating_cash_flow", "capex"], "B06": ["equity"], "B07": ["operating_income", "interest_expense"], "B08": ["current_assets", "current_liabilities"], "B09": ["cash"]}
    pairs = spark.sql("select * from values " + ", ".join(f"('{m}', '{c}')" for m, cs in uses.items() for c in cs) + " as t(metric_id, component)")
    std = parts.join(small(pairs), "component").select("company", "cik", "metric_id", F.col("accn").alias("accession"), F.col("concept").alias("concept_or_section"), F.col("value").cast("string").alias("value_raw"), F.lit("companyfacts").alias("extraction_method"))
    ev = E.event_evidence(landed.events, landed.companies).select("company", "cik", "metric_id", "accession", F.col("item_code").alias("concept_or_section"), F.col("value_raw").cast("string").alias("value_raw"), "extraction_method")
    return std.unionByName(ev)


def coverage_matrix(cells: DataFrame, rows: DataFrame) -> DataFrame:
    """The matrix's keys with flags that come from a real join."""
    out = coverage(cells.select("company", "metric_id", "status", "value"), rows, ["company", "metric_id"])
    return out.select("company", "metric_id", "status", F.col("value").isNotNull().alias("has_numeric_value"), "has_evidence", (F.col("status") == "NOT_EXTRACTED").alias("needs_text_extraction"), (F.col("status") == "NEEDS_REVIEW").alias("needs_review"))
