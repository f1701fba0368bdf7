"""Synthetic filings, facts and events out of the driver's tables, as DataFrames and as the same rows in DuckDB SQL.

Companies are the nations; every order is a fact of one of them, a filing and an event; every line of an order is a
fact of an instance with dimensions. All rows of the tables are used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import table

CONCEPTS = (
    "Revenues", "SalesRevenueNet", "NetIncomeLoss", "ProfitLoss", "OperatingIncomeLoss", "DepreciationAndAmortization",
    "NetCashProvidedByUsedInOperatingActivities", "PaymentsToAcquirePropertyPlantAndEquipment", "InterestExpense", "AssetsCurrent",
    "LiabilitiesCurrent", "CashAndCashEquivalentsAtCarryingValue", "StockholdersEquity", "LongTermDebt", "LongTermDebtCurrent", "ShortTermBorrowings",
)
DURATIONS = 9
FORMS = ("10-K", "10-K", "10-K/A", "10-Q")
FILED_FORMS = ("10-K", "10-K/A", "8-K", "8-K/A", "10-Q")
ITEMS = ("5.02", "1.01", "2.01", "1.03", "4.02", "8.01")
RATIOS = (
    "CommonEquityTierOneCapitalToRiskWeightedAssets", "TierOneRiskBasedCapitalToRiskWeightedAssets",
    "TierOneRiskBasedCapitalRequiredToBeWellCapitalizedToRiskWeightedAssets", "CommonEquityTierOneRiskBasedCapitalRatioWellCapitalized", "Assets",
    "CapitalToRiskWeightedAssets",
)
NAMES = ("Alpha LLP", "Alpha, L.L.P.", " -- ", "Beta & Co")
DEI, CUSTOM = "http://xbrl.sec.gov/dei/2025", "https://example.com/custom"
FYE, PRIOR = "2000-12-31", "1999-12-31"


def _one(names: tuple[str, ...], index: str) -> str:
    """An expression for the index-th name, from 0, that both engines read."""
    return f"CASE {index} " + " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(names)) + " END"


def _key(n: str, width: int) -> str:
    return f"lpad(CAST({n} AS {{text}}), {width}, '0')"


_COMPANIES = f"""SELECT n_name AS company, {_key('n_nationkey + 1', 10)} AS cik, CAST('{FYE}' AS DATE) AS fye,
  CASE WHEN n_nationkey % 10 <> 9 THEN CAST('{PRIOR}' AS DATE) END AS prior_fye,
  {_one(('financial_institution', 'lodging', 'retail', 'retail'), 'n_nationkey % 4')} AS profile,
  CASE WHEN n_nationkey % 6 = 0 THEN 'predecessor_break' ELSE 'continuous' END AS entity_continuity_status FROM {{nation}}"""

_FACTS = f"""SELECT {_key('k + 1', 10)} AS cik, CASE WHEN (k * 3 + i) % 5 = 0 THEN 'Other' ELSE {_one(CONCEPTS, 'i')} END AS concept, 'USD' AS unit,
  CASE WHEN i < {DURATIONS} THEN {{minus}} END AS "start", "end", CASE WHEN (k + i) % 7 = 0 THEN -cents ELSE cents END AS val,
  {_one(FORMS, '{third} % 4')} AS form, {{plus}} AS filed, {_key('o_orderkey', 18)} AS accn FROM (
  SELECT *, o_custkey % 25 AS k, (o_orderkey * 7 + o_custkey) % 16 AS i, CAST(round(o_totalprice * 100) AS BIGINT) AS cents,
    CASE WHEN {{sixteenth}} % 2 = 0 THEN CAST('{FYE}' AS DATE) ELSE CAST('{PRIOR}' AS DATE) END AS "end" FROM {{orders}}) t"""

_FILINGS = f"""SELECT n_name AS company, {_key('n_nationkey + 1', 10)} AS cik, {_key('o_orderkey', 18)} AS accession, {_one(FILED_FORMS, 'o_orderkey % 5')} AS form,
  CAST({{year}} AS DATE) AS "reportDate", CAST(o_orderdate AS DATE) AS "filingDate", {_key('o_custkey + 1', 10)} AS filer, CASE WHEN n_nationkey % 5 = 0 THEN '8.01' ELSE {_one(ITEMS, '(o_orderkey + o_custkey) % 6')} END AS item_code
  FROM {{orders}} JOIN {{nation}} AS n ON o_custkey % 25 = n_nationkey"""

_LINES = f"""SELECT n_name AS company, {_key('n_nationkey + 1', 10)} AS cik, {_key('l_orderkey', 18)} AS accession, l_linenumber % 4 AS d, n_nationkey AS k,
  l_partkey AS p, l_suppkey AS s, concat_ws('-', CAST(l_orderkey AS {{text}}), CAST(l_linenumber AS {{text}}), CAST(l_partkey AS {{text}}), CAST(l_suppkey AS {{text}})) AS context,
  CASE WHEN l_partkey % 2 = 0 THEN CAST('{FYE}' AS DATE) ELSE CAST('{PRIOR}' AS DATE) END AS period_end, CAST(round(l_extendedprice * 100) AS BIGINT) AS cents,
  CAST(l_quantity AS BIGINT) AS quantity FROM {{lineitem}} JOIN {{nation}} AS n ON l_orderkey % 25 = n_nationkey"""

_SPARK = {"text": "STRING", "minus": "date_sub(`end`, CAST(250 + (i * 13 + k * 17) % 160 + o_orderkey % 10 AS INT))", "plus": "date_add(`end`, CAST(30 + o_orderkey % 60 AS INT))", "third": "(o_orderkey div 3)", "sixteenth": "(o_orderkey div 16)", "year": "concat(year(o_orderdate) - 1, '-12-31')", "nation": "{nation}", "orders": "{orders}", "lineitem": "{lineitem}"}
_DUCK = {"text": "VARCHAR", "minus": '"end" - CAST(250 + (i * 13 + k * 17) % 160 + o_orderkey % 10 AS INTEGER)', "plus": '"end" + CAST(30 + o_orderkey % 60 AS INTEGER)', "third": "(o_orderkey // 3)", "sixteenth": "(o_orderkey // 16)", "year": "concat(year(o_orderdate) - 1, '-12-31')", "nation": "nation", "orders": "orders", "lineitem": "lineitem"}


def _read(spark: SparkSession, d: str, sql: str, *names: str) -> DataFrame:
    return spark.sql(sql.format(**_SPARK).replace('"', "`"), **{n: table(spark, d, n) for n in names})


def companies(spark: SparkSession, d: str) -> DataFrame:
    return _read(spark, d, _COMPANIES, "nation")


def facts(spark: SparkSession, d: str) -> DataFrame:
    return _read(spark, d, _FACTS, "orders")


def filings(spark: SparkSession, d: str) -> DataFrame:
    return _read(spark, d, _FILINGS, "orders", "nation")


def lines(spark: SparkSession, d: str) -> DataFrame:
    return _read(spark, d, _LINES, "lineitem", "nation")


def sql(*names: str) -> str:
    """The tables as common table expressions for DuckDB, to be followed by further ones or a SELECT."""
    known = {"companies": _COMPANIES, "facts": _FACTS, "filings": _FILINGS, "lines": _LINES}
    return "WITH " + ", ".join(f"{n} AS ({known[n].format(**_DUCK)})" for n in names)


def dimensioned(rows: DataFrame) -> DataFrame:
    """Lines as capital ratios: an approach on three of four, a legal entity on two."""
    axis, approach = F.lit("us-gaap:RiskWeightedAssetsCalculationMethodologyAxis"), lambda m: F.lit(f"us-gaap:{m}ApproachMember")
    legal = F.lit("dei:LegalEntityAxis")
    dims = F.when(F.col("d") == 0, F.create_map(axis, approach("Standardized"))).when(F.col("d") == 1, F.create_map(axis, approach("Advanced")))
    dims = dims.when(F.col("d") == 2, F.create_map(axis, approach("Standardized"), legal, F.lit("srt:ParentCompanyMember"))).otherwise(F.create_map(legal, F.lit("x:BankMember")))
    return rows.withColumns({"dimensions": dims, "concept": F.expr(_one(RATIOS, "p % 6")), "unit": F.when(F.col("s") % 3 == 0, "USD").otherwise("pure"), "value": F.col("quantity")})


#: The same in SQL: concept, unit, whether the methodology axis is there.
RATIO_ROWS = f"ratios AS (SELECT *, {_one(RATIOS, 'p % 6')} AS concept, CASE WHEN s % 3 = 0 THEN 'USD' ELSE 'pure' END AS unit, d <> 3 AS axis FROM lines)"
