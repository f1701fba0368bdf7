"""Named queries that call the operators of the filing engine on synthetic filings, each with the SQL that checks it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import events as E
from ..operators import facts as A
from ..operators.relational import small
from ..session import table
from . import filing_tables as T
from . import gates as G

QUERIES: dict = {}
ORACLE_SQL: dict = {}
CHAINS = (("revenue", ("RevenueFromContractWithCustomerExcludingAssessedTax", "Revenues", "SalesRevenueNet"), False), ("net_income", ("NetIncomeLoss", "ProfitLoss"), False), ("operating_income", ("OperatingIncomeLoss",), False), ("depreciation_amortization", ("DepreciationAndAmortization",), False), ("operating_cash_flow", ("NetCashProvidedByUsedInOperatingActivities",), False), ("capex", ("PaymentsToAcquirePropertyPlantAndEquipment",), False), ("interest_expense", ("InterestExpense",), False), ("current_assets", ("AssetsCurrent",), True), ("current_liabilities", ("LiabilitiesCurrent",), True), ("cash", ("CashAndCashEquivalentsAtCarryingValue",), True), ("equity", ("StockholdersEquity",), True), ("long_term_debt", ("LongTermDebt",), True), ("long_term_debt_current", ("LongTermDebtCurrent",), True), ("short_term_borrowings", ("ShortTermBorrowings",), True))
CHAIN_VALUES = ", ".join(f"('{c}', '{x}', {i}, {str(now).lower()})" for c, xs, now in CHAINS for i, x in enumerate(xs))


def _end():
    return F.lit(T.FYE).cast("date")


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], ORACLE_SQL[f.__name__] = f, sql
        return f

    return add


# Facts of filings.

@query(T.sql("facts") + f"""SELECT accn, concept, val, CAST("end" - "start" AS BIGINT) AS days FROM facts
WHERE form LIKE '10-K%' AND "end" = DATE '{T.FYE}' AND "start" IS NOT NULL AND "end" - "start" BETWEEN 300 AND 400""")
def annual_facts(spark: SparkSession, d: str) -> DataFrame:
    return T.facts(spark, d).where(A.annual(_end())).select("accn", "concept", "val", F.datediff("end", "start").cast("long").alias("days"))


@query(T.sql("facts", "companies") + """SELECT company, accn, concept, val FROM facts JOIN companies USING (cik)
WHERE form LIKE '10-K%' AND "end" = prior_fye AND "start" IS NOT NULL AND "end" - "start" BETWEEN 300 AND 400""")
def prior_year_facts(spark: SparkSession, d: str) -> DataFrame:
    return T.facts(spark, d).join(small(T.companies(spark, d)), "cik").where(A.annual(F.col("prior_fye"))).select("company", "accn", "concept", "val")


@query(T.sql("facts") + f"""SELECT accn, concept, val FROM facts WHERE form LIKE '10-K%' AND "end" = DATE '{T.FYE}' AND "start" IS NULL""")
def instant_facts(spark: SparkSession, d: str) -> DataFrame:
    return T.facts(spark, d).where(A.instant(_end())).select("accn", "concept", "val")


@query(T.sql("facts") + f"""SELECT accn, concept, 'NOT_MEANINGFUL' AS status FROM facts WHERE form LIKE '10-K%' AND "end" = DATE '{T.FYE}' AND "end" - "start" < 300""")
def stub_facts(spark: SparkSession, d: str) -> DataFrame:
    return T.facts(spark, d).where(A.stub(_end())).select("accn", "concept", F.lit("NOT_MEANINGFUL").alias("status"))


FOUND = f""", chains(component, concept, chain_rank, instant) AS (VALUES {CHAIN_VALUES}),
days AS (SELECT company, cik, 'current' AS kind, fye AS day FROM companies UNION ALL SELECT company, cik, 'prior', prior_fye FROM companies WHERE prior_fye IS NOT NULL),
kinds AS (SELECT company, cik, component, chain_rank, concept, val, accn, filed, CASE WHEN instant THEN CASE WHEN "start" IS NULL THEN kind END
  WHEN "end" - "start" BETWEEN 300 AND 400 THEN kind WHEN "end" - "start" < 300 THEN 'stub_' || kind END AS period_kind
  FROM facts JOIN chains USING (concept) JOIN days USING (cik) WHERE form LIKE '10-K%' AND "end" = day),
found AS (SELECT company, cik, component, period_kind, val AS value, concept, accn FROM kinds WHERE period_kind IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY company, cik, component, period_kind ORDER BY chain_rank, filed DESC, accn DESC) = 1)"""


def _found(spark: SparkSession, d: str) -> DataFrame:
    chains = spark.sql(f"select * from values {CHAIN_VALUES} as t(component, concept, chain_rank, instant)")
    return A.components(T.facts(spark, d), T.companies(spark, d), chains)


@query(T.sql("facts", "companies") + FOUND + " SELECT company, cik, component, period_kind, value, concept, accn FROM found")
def concept_chains(spark: SparkSession, d: str) -> DataFrame:
    return _found(spark, d).select("company", "cik", "component", "period_kind", "value", "concept", "accn")


def _v(c: str, k: str = "current") -> str:
    return f"max(value) FILTER (component = '{c}' AND period_kind = '{k}')"


_PARTS = {"rev": "revenue", "ni": "net_income", "oi": "operating_income", "da": "depreciation_amortization", "ocf": "operating_cash_flow", "capex": "capex", "ie": "interest_expense", "ca": "current_assets", "cl": "current_liabilities", "cash": "cash", "eq": "equity", "ltd": "long_term_debt", "ltdc": "long_term_debt_current", "stb": "short_term_borrowings"}
_WIDE = ", ".join(f"{_v(c)} AS {a}" for a, c in _PARTS.items()) + ", " + ", ".join(f"{_v(_PARTS[a], 'stub_current')} AS stub_{a}" for a in ("rev", "ni", "ocf", "cash")) + f", {_v('revenue', 'prior')} AS rev0"
_METRICS = (
    ("B01", "rev", "rev", "false"), ("B02", "CAST(rev - rev0 AS DOUBLE) / nullif(rev0, 0)", "rev", "false"), ("B03", "CAST(oi + da AS DOUBLE) / nullif(rev, 0)", "rev", "false"),
    ("B04", "ni", "ni", "false"), ("B05", "ocf - capex", "ocf", "false"), ("B06", "CAST(coalesce(ltd, ltdc) + coalesce(stb, 0) AS DOUBLE) / nullif(eq, 0)", "cash", "coalesce(eq < 0, false)"),
    ("B07", "CAST(oi AS DOUBLE) / nullif(ie, 0)", "rev", "coalesce(oi <= 0, false)"), ("B08", "CAST(ca AS DOUBLE) / nullif(cl, 0)", "cash", "false"), ("B09", "cash", "cash", "false"),
    ("A08", "CAST(NULL AS DOUBLE)", "none", "false"), ("A10", "CAST(NULL AS DOUBLE)", "cash", "false"),
)
_STUBBED = {a: f"({a} IS NULL AND stub_{a} IS NOT NULL)" for a in ("rev", "ni", "ocf", "cash")} | {"none": "false"}
CELLS = ", wide AS (SELECT company, cik, " + _WIDE + " FROM found GROUP BY company, cik), cells AS (" + " UNION ALL ".join(
    f"SELECT company, cik, '{m}' AS metric_id, CAST({v} AS DOUBLE) AS v, CASE WHEN {_STUBBED[s]} OR {bad} THEN 'NOT_MEANINGFUL' WHEN ({v}) IS NULL THEN 'NOT_AVAILABLE_SEC' ELSE 'OK' END AS status FROM wide" for m, v, s, bad in _METRICS
) + "), metrics AS (SELECT company, cik, metric_id, round(CASE WHEN status = 'OK' THEN v END, 6) AS value, status FROM cells)"


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumn("value", F.round(F.col("value").cast("double"), 6))


@query(T.sql("facts", "companies") + FOUND + CELLS + " SELECT company, cik, metric_id, value, status FROM metrics")
def standard_cells(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(A.standard_metrics(_found(spark, d)).select("company", "cik", "metric_id", "value", "status"))


_ASKED = "('financial_institution', 'B08'), ('financial_institution', 'A10'), ('financial_institution', 'A03'), ('lodging', 'B01'), ('lodging', 'B10'), ('retail', 'B01'), ('retail', 'B02'), ('retail', 'B08')"


@query(T.sql("facts", "companies") + FOUND + CELLS + f""", asked(profile, metric_id) AS (VALUES {_ASKED}),
grid AS (SELECT company, profile, entity_continuity_status <> 'continuous' AS broken, metric_id FROM companies JOIN asked USING (profile))
SELECT company, metric_id, CASE WHEN (profile = 'financial_institution' AND metric_id = 'B08') OR (broken AND metric_id = 'B02') THEN NULL ELSE value END AS value,
  CASE WHEN broken AND metric_id = 'B02' THEN 'NOT_MEANINGFUL' WHEN profile = 'financial_institution' AND metric_id = 'B08' THEN 'N_A_STRUCTURAL' ELSE coalesce(status, 'NOT_EXTRACTED') END AS status
FROM grid LEFT JOIN metrics USING (company, metric_id)""")
def profile_cells(spark: SparkSession, d: str) -> DataFrame:
    asked, companies = spark.sql(f"select * from values {_ASKED} as t(profile, metric_id)"), T.companies(spark, d)
    cells = A.continuity(A.applied(A.standard_metrics(_found(spark, d)), companies, asked), companies)
    return _rounded(cells.select("company", "metric_id", "value", "status"))


@query(T.sql("facts") + """SELECT accn, 'companyfacts:USD:' || CASE WHEN form = '10-Q' THEN '' ELSE 'CY' || year("end") || CASE WHEN "start" IS NULL THEN 'Q4I' ELSE '' END END AS context FROM facts""")
def companyfacts_contexts(spark: SparkSession, d: str) -> DataFrame:
    frame = F.when(F.col("form") != "10-Q", F.concat(F.lit("CY"), F.year("end").cast("string"), F.when(F.col("start").isNull(), "Q4I").otherwise("")))
    return T.facts(spark, d).select("accn", X.companyfacts_label(F.col("unit"), frame).alias("context"))


# Filings.

@query(T.sql("filings") + """SELECT company, cik, accession, form, "reportDate" AS report_date FROM filings WHERE form IN ('10-K', '10-K/A')
QUALIFY row_number() OVER (PARTITION BY company, cik ORDER BY "reportDate" DESC, "filingDate" DESC, accession DESC) = 1""")
def latest_annual_report(spark: SparkSession, d: str) -> DataFrame:
    return A.latest_10k(T.filings(spark, d), ["company", "cik"]).select("company", "cik", "accession", "form", F.col("reportDate").alias("report_date"))


@query(T.sql("filings", "lines") + """, n AS (SELECT accession, count(*) AS n, count(*) FILTER (d IN (0, 1)) > 0 AND count(*) FILTER (d = 2) > 0 AS whole FROM lines GROUP BY 1),
t AS (SELECT f.*, (CASE WHEN form = '10-K/A' THEN 'target_is_amendment;' ELSE '' END) || (CASE WHEN coalesce(n, 0) < 4 THEN 'target_instance_fact_count_lt_4;' ELSE '' END)
    || (CASE WHEN NOT coalesce(whole, false) THEN 'target_instance_key_group_missing;' ELSE '' END) AS reasons
  FROM filings f LEFT JOIN n USING (accession) WHERE form IN ('10-K', '10-K/A'))
SELECT t.company, t.accession, o.accession AS original_accession, rtrim(reasons, ';') AS reasons FROM t JOIN filings o ON o.form = '10-K' AND o.filer = t.filer AND o."reportDate" = t."reportDate"
  AND o.accession <> t.accession WHERE reasons <> ''""")
def original_instances(spark: SparkSession, d: str) -> DataFrame:
    filings = T.filings(spark, d).drop("cik").withColumnRenamed("filer", "cik")
    groups = spark.sql("select * from values ('income', 'Revenues'), ('income', 'NetIncomeLoss'), ('position', 'Assets') as t(group_name, concept)")
    told = F.when(F.col("d") == 0, "Revenues").when(F.col("d") == 1, "NetIncomeLoss").when(F.col("d") == 2, "Assets").otherwise("Other")
    facts = T.lines(spark, d).select("accession", told.alias("concept"))
    hit = A.original_fallback(filings.where("form in ('10-K', '10-K/A')"), facts, filings, 4, groups)
    return hit.select("company", "accession", "original_accession", F.array_join("reasons", ";").alias("reasons"))


@query(T.sql("facts", "lines") + """, i AS (SELECT accession, period_end, concept, min_by(amount, context) AS amount FROM (
    SELECT accession, period_end, CASE d WHEN 0 THEN 'Revenues' WHEN 1 THEN 'NetIncomeLoss' ELSE 'Assets' END AS concept, cents AS amount, context FROM lines) GROUP BY 1, 2, 3),
m AS (SELECT accn AS accession, "end" AS period_end, CASE WHEN concept IN ('Revenues', 'SalesRevenueNet') THEN 'Revenues' ELSE 'NetIncomeLoss' END AS concept, abs(val) AS val FROM facts)
SELECT accession, concept, CASE WHEN amount IS NULL THEN 'NOT_FOUND' WHEN amount = val THEN 'MATCH' ELSE 'MISMATCH' END AS match_status FROM m LEFT JOIN i USING (accession, period_end, concept)""")
def instance_crosscheck(spark: SparkSession, d: str) -> DataFrame:
    one = F.when(F.col("concept").isin("Revenues", "SalesRevenueNet"), "Revenues").otherwise("NetIncomeLoss")
    metrics = T.facts(spark, d).select(F.col("accn").alias("accession"), F.col("end").alias("period_end"), one.alias("concept"), F.abs("val").alias("value"))
    told = F.when(F.col("d") == 0, "Revenues").when(F.col("d") == 1, "NetIncomeLoss").otherwise("Assets")
    instance = T.lines(spark, d).select("accession", "period_end", told.alias("concept"), F.col("cents").alias("value"), "context", F.create_map().cast("map<string,string>").alias("dimensions"))
    return A.crosscheck(metrics, instance).select("accession", "concept", "match_status")


# Facts with dimensions.

_NAME = "replace(regexp_replace(lower(concept), '[^a-z0-9]', '', 'g'), 'tierone', 'tier1')"
BASEL = f""", {T.RATIO_ROWS}, named AS (SELECT *, {_NAME} AS n FROM ratios WHERE unit = 'pure' AND axis AND period_end = DATE '{T.FYE}'),
eligible AS (SELECT *, CASE WHEN contains(n, 'riskweightedassets') OR contains(n, 'riskbasedcapitalratio') THEN CASE WHEN contains(n, 'commonequitytier1') THEN 'A02' WHEN contains(n, 'tier1') THEN 'A01' END END AS metric_id,
  CASE WHEN contains(n, 'wellcapitalized') THEN 'regulatory_threshold' ELSE 'primary' END AS candidate_role FROM named)"""


@query(T.sql("lines") + BASEL + " SELECT company, context, concept, metric_id, candidate_role FROM eligible WHERE metric_id IS NOT NULL")
def basel_roles(spark: SparkSession, d: str) -> DataFrame:
    return A.basel_candidates(T.dimensioned(T.lines(spark, d)), _end()).select("company", "context", "concept", "metric_id", "candidate_role")


@query(T.sql("lines") + BASEL + """ SELECT company, metric_id, context, CAST(quantity AS BIGINT) AS value FROM eligible WHERE metric_id IS NOT NULL AND candidate_role = 'primary'
QUALIFY row_number() OVER (PARTITION BY company, metric_id ORDER BY (d = 2) DESC, (d IN (0, 2)) DESC, (d = 2), context, quantity) = 1""")
def basel_choice(spark: SparkSession, d: str) -> DataFrame:
    return A.basel_ratios(T.dimensioned(T.lines(spark, d)), _end()).select("company", "metric_id", "context", "value")


def _captive(spark: SparkSession, d: str) -> DataFrame:
    member = F.when(F.col("d") == 0, "x:FinancialServicesMember").when(F.col("d") == 1, "x:CreditFacilityMember").when(F.col("d") == 2, "x:AutomotiveMember").otherwise("x:CaptiveFinanceMember")
    axis = F.when(F.col("s") % 2 == 0, "us-gaap:StatementBusinessSegmentsAxis").otherwise("srt:ProductOrServiceAxis")
    concept = F.when(F.col("p") % 3 == 0, "LongTermDebt").when(F.col("p") % 3 == 1, "DebtSecuritiesAvailableForSale").otherwise("Revenues")
    return T.lines(spark, d).withColumns({"dimensions": F.create_map(axis, member), "concept": concept})


@query(T.sql("lines") + """SELECT company, context, 'LongTermDebt' AS concept, 'captive_finance_debt' AS candidate_role, 'NEEDS_REVIEW' AS status FROM lines WHERE d IN (0, 3) AND s % 2 = 0 AND p % 3 = 0""")
def captive_candidates(spark: SparkSession, d: str) -> DataFrame:
    return A.captive_debt(_captive(spark, d)).select("company", "context", "concept", "candidate_role", "status")


@query(T.sql("lines") + f""", own AS (SELECT company, context, cents * 1000 AS value, CASE WHEN k % 3 = 0 AND d = 0 THEN 'none' WHEN k % 5 = 0 AND d = 1 THEN 'none' WHEN d = 0 THEN 'total' WHEN d = 1 THEN 'current' WHEN d = 2 THEN 'noncurrent' ELSE 'none' END AS part
  FROM lines WHERE period_end = DATE '{T.FYE}'), parts AS (SELECT company, max(value) FILTER (part = 'total') AS t, max(value) FILTER (part = 'current') AS c, max(value) FILTER (part = 'noncurrent') AS n FROM own GROUP BY 1)
SELECT company, coalesce(t, c + n) AS value, CASE WHEN t IS NOT NULL THEN 'total' ELSE 'current + noncurrent' END AS formula, 'DIM_XBRL_OK' AS status FROM parts WHERE coalesce(t, c + n) >= 1000000000""")
def backlog_choice(spark: SparkSession, d: str) -> DataFrame:
    kind = F.when((F.col("k") % 3 == 0) & (F.col("d") == 0), "Other").when((F.col("k") % 5 == 0) & (F.col("d") == 1), "Other").when(F.col("d") == 0, "RevenueRemainingPerformanceObligation")
    kind = kind.when(F.col("d") == 1, "RevenueRemainingPerformanceObligationCurrent").when(F.col("d") == 2, "x_RevenueRemainingPerformanceObligationNoncurrent").otherwise("RevenueRemainingPerformanceObligationPercentage")
    facts = T.lines(spark, d).withColumns({"concept": kind, "unit": F.lit("USD"), "value": F.col("cents") * 1000, "dimensions": F.create_map().cast("map<string,string>")})
    return A.rpo(facts, _end()).select("company", "value", "formula", "status")


@query(T.sql("lines") + f""", pay AS (SELECT company, count(DISTINCT v) AS n_facts, max(v) AS v FROM (SELECT company, CASE WHEN k % 2 = 0 THEN k * 1000 ELSE cents END AS v FROM lines WHERE d = 0 AND period_end = DATE '{T.FYE}') GROUP BY 1)
SELECT company, CAST(CASE WHEN n_facts = 1 THEN v END AS BIGINT) AS value, CASE WHEN n_facts = 1 THEN 'DEF14A_OK' ELSE 'NEEDS_REVIEW' END AS status, n_facts FROM pay""")
def officer_pay(spark: SparkSession, d: str) -> DataFrame:
    facts = T.lines(spark, d).withColumns({"concept": F.when(F.col("d") == 0, "PeoTotalCompAmt").otherwise("Other"), "unit": F.lit("USD"), "value": F.when(F.col("k") % 2 == 0, F.col("k").cast("long") * 1000).otherwise(F.col("cents"))})
    return A.compensation(facts, _end())


def _names(spark: SparkSession, d: str) -> DataFrame:
    name = F.expr(T._one(T.NAMES, "(k + CASE WHEN p % 11 = 0 THEN 1 ELSE 0 END) % 4"))
    return T.lines(spark, d).withColumns({"concept": F.lit("AuditorName"), "namespace": F.when(F.col("s") % 7 == 0, T.CUSTOM).otherwise(T.DEI), "text": name})


NAMED = f""", told AS (SELECT company, cik, accession, {T._one(T.NAMES, "(k + CASE WHEN p % 11 = 0 THEN 1 ELSE 0 END) % 4")} AS name FROM lines WHERE s % 7 <> 0),
names AS (SELECT company, cik, accession, count(DISTINCT regexp_replace(upper(name), '[^A-Z0-9]', '', 'g')) AS n, min(name) AS auditor, min(regexp_replace(upper(name), '[^A-Z0-9]', '', 'g')) AS canonical
  FROM told WHERE name <> ' -- ' GROUP BY 1, 2, 3)"""


@query(T.sql("lines") + NAMED + """ SELECT company, cik, accession, CASE WHEN n = 1 THEN auditor END AS auditor, CASE WHEN n = 1 THEN canonical END AS canonical, CASE WHEN n > 1 THEN 'conflicting_values' END AS finding FROM names""")
def auditor_names(spark: SparkSession, d: str) -> DataFrame:
    return A.auditors(_names(spark, d))


#: The candidates of a company's last two report dates, and the first that names an auditor.
YEARS = """, annual AS (SELECT company, cik, accession, form, "reportDate" AS r, "filingDate" AS f, dense_rank() OVER (PARTITION BY company, cik ORDER BY "reportDate" DESC) AS back FROM filings WHERE form IN ('10-K', '10-K/A'))"""


@query(T.sql("filings") + YEARS + """ SELECT company, cik, coalesce(string_agg(accession, ';' ORDER BY (form = '10-K'), f DESC, accession) FILTER (back = 1), '') AS candidates,
coalesce(string_agg(accession, ';' ORDER BY (form = '10-K'), f DESC, accession) FILTER (back = 2), '') AS prior_candidates FROM annual GROUP BY 1, 2""")
def auditor_candidates(spark: SparkSession, d: str) -> DataFrame:
    found = A.auditor_candidates(T.filings(spark, d))
    return found.select("company", "cik", *[F.array_join(c, ";").alias(c) for c in ("candidates", "prior_candidates")])


CHANGED = """, best AS (SELECT company, cik, back, canonical FROM annual JOIN names USING (company, cik, accession) WHERE n = 1
  QUALIFY row_number() OVER (PARTITION BY company, cik, back ORDER BY (form = '10-K'), f DESC, accession) = 1),
flags AS (SELECT t.company, t.cik, CAST(CASE WHEN a.canonical = b.canonical THEN 0 WHEN a.canonical <> b.canonical THEN 1 END AS INTEGER) AS value
  FROM (SELECT DISTINCT company, cik FROM annual) t LEFT JOIN best a ON a.cik = t.cik AND a.back = 1 LEFT JOIN best b ON b.cik = t.cik AND b.back = 2)"""


@query(T.sql("filings", "lines") + NAMED + YEARS + CHANGED + """ SELECT company, cik, value, CASE WHEN value = 0 THEN 'DIM_XBRL_OK' ELSE 'NEEDS_REVIEW' END AS status,
round(CASE WHEN value IS NULL THEN 0.45 ELSE 0.8 END, 2)::DOUBLE AS confidence FROM flags""")
def auditor_flags(spark: SparkSession, d: str) -> DataFrame:
    cells = A.auditor_change(A.auditor_candidates(T.filings(spark, d)), A.auditors(_names(spark, d)))
    return cells.select("company", "cik", "value", "status", F.col("confidence").cast("double").alias("confidence"))


@query(T.sql("filings", "lines") + NAMED + YEARS + CHANGED + """, claimed AS (SELECT company, 0 AS value, 'DIM_XBRL_OK' AS status FROM flags WHERE company <> 'NATION_7')
SELECT CASE WHEN c.company IS NULL THEN 'no cell' WHEN c.value IS DISTINCT FROM f.value THEN 'value differs' ELSE 'status differs' END AS finding,
  f.company || '|' || coalesce(CAST(c.value AS VARCHAR), '') || '|' || coalesce(CAST(f.value AS VARCHAR), '') AS subject
FROM flags f LEFT JOIN claimed c USING (company) WHERE c.company IS NULL OR c.value IS DISTINCT FROM f.value OR c.status <> CASE WHEN f.value = 0 THEN 'DIM_XBRL_OK' ELSE 'NEEDS_REVIEW' END""")
def gate_auditor_cells(spark: SparkSession, d: str) -> DataFrame:
    claimed = T.companies(spark, d).where("company <> 'NATION_7'").select("company", F.lit("C04").alias("metric_id"), F.lit(0).alias("value"), F.lit("DIM_XBRL_OK").alias("status"))
    return G.auditor_cells(claimed, T.filings(spark, d), _names(spark, d))


# Events.

WINDOWS = "('NATION_0', '0000000001', DATE '1994-12-31', DATE '1996-12-31'), ('NATION_1', '0000000002', DATE '1994-12-31', DATE '1996-12-31'), ('NATION_2', '0000000003', DATE '1993-06-30', DATE '1999-06-30'), ('NATION_3', '0000000009', DATE '1993-06-30', DATE '1999-06-30')"


@query(T.sql("filings") + f""", windows(company, cik, a, z) AS (VALUES {WINDOWS})
SELECT company, cik, accession, "filingDate" AS filing_date FROM filings JOIN windows USING (company, cik) WHERE form LIKE '8-K%' AND "filingDate" > a AND "filingDate" <= z""")
def fiscal_window_reports(spark: SparkSession, d: str) -> DataFrame:
    windows = spark.sql(f"select * from values {WINDOWS} as t(company, cik, prior_report_date, target_report_date)")
    return E.fiscal_window(T.filings(spark, d).withColumnRenamed("filingDate", "filing_date"), windows).select("company", "cik", "accession", "filing_date")


_ITEMS = ", ".join(f"('{m}', '{i}')" for m, xs in E.C.EVENT_ITEMS.items() for i in xs)
COUNTED = f""", items(metric_id, item_code) AS (VALUES {_ITEMS}), hits AS (SELECT company, metric_id, count(*) AS n, string_agg(DISTINCT accession, ';' ORDER BY accession) AS accessions FROM filings JOIN items USING (item_code) GROUP BY 1, 2),
counted AS (SELECT company, metric_id, coalesce(n, 0) AS n, coalesce(accessions, '') AS accessions FROM companies CROSS JOIN (SELECT DISTINCT metric_id FROM items) LEFT JOIN hits USING (company, metric_id))"""


@query(T.sql("filings", "companies") + COUNTED + """ SELECT company, metric_id, CAST(n AS BIGINT) AS value, CASE WHEN n > 0 THEN '8K_ITEM_OK' ELSE 'NOT_AVAILABLE_SEC' END AS status,
CASE WHEN n > 0 THEN 0.9 ELSE 0.8 END::DOUBLE AS confidence, accessions FROM counted""")
def event_counts(spark: SparkSession, d: str) -> DataFrame:
    cells = E.event_metrics(T.filings(spark, d), T.companies(spark, d))
    return cells.select("company", "metric_id", "value", "status", F.col("confidence").cast("double").alias("confidence"), "accessions")


@query(T.sql("filings", "companies") + COUNTED + """ SELECT company, cik, metric_id, accession, item_code, CAST(1 AS BIGINT) AS value_raw, CAST(n AS BIGINT) AS value_normalized, 'eightk_item' AS extraction_method
FROM filings JOIN items USING (item_code) JOIN counted USING (company, metric_id)
UNION ALL SELECT company, cik, metric_id, NULL, NULL, 0, 0, 'eightk_zero_item_scan' FROM counted JOIN companies USING (company) WHERE n = 0""")
def event_evidence(spark: SparkSession, d: str) -> DataFrame:
    return E.event_evidence(T.filings(spark, d), T.companies(spark, d))


@query(T.sql("filings") + """SELECT accession, item_code, CASE WHEN form = '8-K' THEN 'hdr_sgml' ELSE 'primary_document' END AS item_source FROM filings
UNION ALL SELECT accession, '9.01', 'hdr_sgml' FROM filings WHERE form = '8-K'""")
def event_item_rows(spark: SparkSession, d: str) -> DataFrame:
    filings = T.filings(spark, d).withColumns({"header_items": F.when(F.col("form") == "8-K", F.array("item_code", F.lit("9.01"))), "primary_items": F.array("item_code")})
    return E.event_rows(filings.drop("item_code")).select("accession", "item_code", "item_source")


@query(T.sql("filings") + """SELECT accession, CAST(coalesce(p + 1, date_trunc('year', "reportDate")) AS DATE) AS event_start,
CAST(coalesce(CASE WHEN form = '10-K' THEN p + 1 END, date_trunc('year', "reportDate")) AS DATE) AS c04_start
FROM (SELECT *, CASE WHEN item_code <> '5.02' THEN "filingDate" - 700 END AS p FROM filings)""")
def period_starts(spark: SparkSession, d: str) -> DataFrame:
    prior = F.when(F.col("item_code") != "5.02", F.date_sub("filingDate", 700))
    other = F.when(F.col("form") == "10-K", F.col("cik")).otherwise("1234567890")
    return T.filings(spark, d).select("accession", E.period_start(prior, F.col("reportDate")).alias("event_start"), E.c04_period_start(prior, other, F.col("cik"), F.col("reportDate")).alias("c04_start"))


# Gates: each finds what is wrong in a table that is wrong by its data. All return (finding, subject).

def _cells(spark: SparkSession, d: str) -> DataFrame:
    """A cell for each customer, some of them with words, sources or units that are not of the lists."""
    c = table(spark, d, "customer")
    return c.select(
        F.col("c_name").alias("company"), F.element_at(F.array(*[F.lit(m) for m in ("B01", "B02", "D01")]), (F.col("c_custkey") % 3 + 1).cast("int")).alias("metric_id"), "c_custkey", "c_acctbal",
        F.when(F.col("c_mktsegment") == "BUILDING", "FINE").when(F.col("c_mktsegment") == "MACHINERY", "NOT_EXTRACTED").otherwise("OK").alias("status"),
        F.when(F.col("c_acctbal") < 0, "GUESS").otherwise("STD_XBRL").alias("source_class"), F.when(F.col("c_nationkey") == 3, "EUR").otherwise("USD").alias("unit"),
        F.round(F.col("c_acctbal") * 100).cast("long").alias("value"), F.when(F.col("c_nationkey") == 5, "ToDo: check").when(F.col("c_nationkey") == 6, "stub period").alias("notes"),
        F.lit(T.PRIOR).cast("date").alias("period_start"), _end().alias("period_end"), F.lpad(F.col("c_custkey").cast("string"), 18, "0").alias("accession"),
    )


CELL_ROWS = f"""WITH cells AS (SELECT c_name AS company, CASE c_custkey % 3 WHEN 0 THEN 'B01' WHEN 1 THEN 'B02' ELSE 'D01' END AS metric_id, c_custkey, c_acctbal, c_nationkey,
  CASE c_mktsegment WHEN 'BUILDING' THEN 'FINE' WHEN 'MACHINERY' THEN 'NOT_EXTRACTED' ELSE 'OK' END AS status, CASE WHEN c_acctbal < 0 THEN 'GUESS' ELSE 'STD_XBRL' END AS source_class,
  CASE WHEN c_nationkey = 3 THEN 'EUR' ELSE 'USD' END AS unit, CAST(round(c_acctbal * 100) AS BIGINT) AS value, lpad(CAST(c_custkey AS VARCHAR), 18, '0') AS accession FROM customer)"""


@query(CELL_ROWS + """ SELECT 'missing' AS finding, company || '|' || metric_id AS subject FROM cells WHERE c_acctbal < 0
UNION ALL SELECT 'duplicate', company || '|' || metric_id FROM cells WHERE c_acctbal > 9000 UNION ALL SELECT 'unexpected', s_name || '|B01' FROM supplier""")
def gate_matrix_keys(spark: SparkSession, d: str) -> DataFrame:
    cells, keys = _cells(spark, d), ["company", "metric_id"]
    extra = table(spark, d, "supplier").select(F.col("s_name").alias("company"), F.lit("B01").alias("metric_id"))
    actual = cells.where("c_acctbal >= 0").select(*keys).unionByName(cells.where("c_acctbal > 9000").select(*keys)).unionByName(extra)
    return G.matrix_keys(actual, cells)


@query(CELL_ROWS + """ SELECT 'unknown status' AS finding, company || '|' || metric_id AS subject FROM cells WHERE status = 'FINE'
UNION ALL SELECT 'unknown source class', company || '|' || metric_id FROM cells WHERE c_acctbal < 0 UNION ALL SELECT 'unknown unit', company || '|' || metric_id FROM cells WHERE unit = 'EUR'""")
def gate_vocabulary(spark: SparkSession, d: str) -> DataFrame:
    return G.vocabulary(_cells(spark, d))


@query(CELL_ROWS + """, real AS (SELECT *, c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F') AS have FROM cells)
SELECT 'wrong has_evidence' AS finding, company || '|' || metric_id AS subject FROM real WHERE have <> (c_acctbal > 0)""")
def gate_coverage_flags(spark: SparkSession, d: str) -> DataFrame:
    cells = _cells(spark, d)
    rows = cells.join(table(spark, d, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey")), "c_custkey")
    return G.coverage_flags(cells.withColumn("has_evidence", F.col("c_acctbal") > 0), cells, rows.select("company", "metric_id"))


@query(CELL_ROWS + """ SELECT 'no matching evidence' AS finding, company || '|' || metric_id AS subject FROM cells WHERE status = 'OK' AND (source_class = 'GUESS' OR unit = 'EUR' OR value % 7 = 0)""")
def gate_numeric_evidence(spark: SparkSession, d: str) -> DataFrame:
    cells = _cells(spark, d)
    rows = cells.select("company", "metric_id", "unit", "period_start", "period_end", "accession", (F.col("value") + F.when(F.col("unit") == "EUR", 1).otherwise(0)).alias("value_normalized"), F.when(F.col("source_class") != "GUESS", "https://www.sec.gov/x").alias("source_url"), F.lit("Cash").alias("concept_or_section"), F.when(F.col("value") % 7 != 0, "fact").otherwise("").alias("extraction_method"))
    return G.numeric_evidence(cells, rows)


@query(T.sql("filings", "companies") + COUNTED + """ SELECT 'count or status differs' AS finding, company || '|' || metric_id || '|' || (n + 1) || '|' || n AS subject FROM counted WHERE company LIKE '%3' AND metric_id = 'E02'""")
def gate_event_counts(spark: SparkSession, d: str) -> DataFrame:
    return G.event_outputs(_miscounted(spark, d), T.filings(spark, d), E.C.EVENT_ITEMS)


def _miscounted(spark: SparkSession, d: str) -> DataFrame:
    cells = E.event_metrics(T.filings(spark, d), T.companies(spark, d)).withColumnRenamed("accessions", "accession")
    return cells.withColumn("value", F.col("value") + F.when(F.col("company").endswith("3") & (F.col("metric_id") == "E02"), 1).otherwise(0))


@query(T.sql("filings", "companies") + COUNTED + """, wrong AS (SELECT company, metric_id, n, CASE WHEN n > 0 THEN '8K_ITEM_OK' ELSE 'NOT_AVAILABLE_SEC' END AS status FROM counted WHERE company LIKE '%3' AND metric_id = 'E02')
SELECT 'row not as recomputed' AS finding, company || '|' || metric_id || '|' || (n + 1) || '|' || status AS subject FROM wrong
UNION ALL SELECT 'recomputed row missing', company || '|' || metric_id || '|' || n || '|' || status FROM wrong""")
def gate_event_rows(spark: SparkSession, d: str) -> DataFrame:
    return G.event_rows_recomputed(_miscounted(spark, d), T.companies(spark, d), T.filings(spark, d), E.C.EVENT_ITEMS)


def _golden(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Cells as a fixture, and what a run kept of them: some far off, some near, some lost."""
    cells = _cells(spark, d).withColumn("assertion_id", F.concat_ws("-", "company", "metric_id"))
    fixture = cells.select("assertion_id", "company", "metric_id", F.col("value").cast("string").alias("expected"), F.when(F.col("unit") == "EUR", "exact").otherwise("5").alias("tolerance"), "value", "status")
    kept = fixture.where("status <> 'NOT_EXTRACTED'").withColumn("actual", F.col("value") + F.col("value") % 9)
    return fixture, kept


GOLDEN = CELL_ROWS + """, g AS (SELECT company || '-' || metric_id AS a, value AS v, value + value % 9 AS w, CASE WHEN unit = 'EUR' THEN value % 9 = 0 ELSE abs(value % 9) <= 5 END AS near, status FROM cells)"""


@query(GOLDEN + """ SELECT 'missing' AS finding, a AS subject FROM g WHERE status = 'NOT_EXTRACTED'
UNION ALL SELECT 'value differs', a || '|' || v || '|' || w FROM g WHERE status <> 'NOT_EXTRACTED' AND NOT near""")
def gate_golden(spark: SparkSession, d: str) -> DataFrame:
    fixture, kept = _golden(spark, d)
    return G.golden(kept.select("assertion_id", "actual"), fixture.select("assertion_id", "expected", "tolerance"))


@query(GOLDEN + """ SELECT 'missing' AS finding, a AS subject FROM g WHERE status = 'NOT_EXTRACTED'
UNION ALL SELECT 'matrix drift', a FROM g WHERE status <> 'NOT_EXTRACTED' AND w <> v UNION ALL SELECT 'status differs', a FROM g WHERE status <> 'NOT_EXTRACTED' AND NOT near
UNION ALL SELECT 'fixture mismatch', a FROM g WHERE status = 'FINE'""")
def gate_golden_snapshot(spark: SparkSession, d: str) -> DataFrame:
    fixture, kept = _golden(spark, d)
    changed = fixture.withColumn("tolerance", F.when(F.col("status") == "FINE", "7").otherwise(F.col("tolerance")))
    stored = kept.select("assertion_id", "expected", "tolerance", F.col("actual").cast("string").alias("actual"), F.lit("PASS").alias("status"))
    return G.golden_snapshot(stored, changed.drop("status"), fixture)


@query(CELL_ROWS + """ SELECT 'lost' AS finding, company || '|' || metric_id AS subject FROM cells WHERE status <> 'OK' AND c_acctbal > 0""")
def gate_ratchet(spark: SparkSession, d: str) -> DataFrame:
    cells = _cells(spark, d)
    return G.ratchet(cells, cells.where("c_acctbal > 0").select("company", "metric_id"))


@query("SELECT 'placeholder' AS finding, c_name || '|' || CASE c_custkey % 3 WHEN 0 THEN 'B01' WHEN 1 THEN 'B02' ELSE 'D01' END AS subject FROM customer WHERE c_nationkey = 5")
def gate_placeholder_notes(spark: SparkSession, d: str) -> DataFrame:
    return G.placeholder_notes(_cells(spark, d))


@query(CELL_ROWS + """, want AS (SELECT company, metric_id FROM cells QUALIFY row_number() OVER (PARTITION BY source_class ORDER BY sha256(company || '|' || metric_id), company, metric_id) <= CASE source_class WHEN 'GUESS' THEN 5 ELSE 20 END),
have AS (SELECT company, metric_id FROM cells WHERE c_acctbal > 9500)
SELECT 'missing' AS finding, company || '|' || metric_id AS subject FROM (SELECT * FROM want EXCEPT SELECT * FROM have) UNION ALL SELECT 'unexpected', company || '|' || metric_id FROM (SELECT * FROM have EXCEPT SELECT * FROM want)""")
def gate_audit_sample(spark: SparkSession, d: str) -> DataFrame:
    cells = _cells(spark, d)
    return G.audit_sample(cells.where("c_acctbal > 9500"), cells, {"GUESS": 5, "STD_XBRL": 20})


@query(T.sql("lines") + BASEL + """ SELECT 'threshold chosen' AS finding, company || '|' || metric_id || '|' || concept AS subject FROM eligible WHERE metric_id IS NOT NULL AND candidate_role <> 'primary'""")
def gate_thresholds(spark: SparkSession, d: str) -> DataFrame:
    return G.thresholds_never_primary(A.basel_candidates(T.dimensioned(T.lines(spark, d)), _end()))


@query(T.sql("lines") + BASEL + """, firsts AS (SELECT company, metric_id, concept, context, candidate_role FROM eligible WHERE metric_id IS NOT NULL AND metric_id <> 'A02' QUALIFY row_number() OVER (PARTITION BY company, metric_id ORDER BY context, quantity) = 1)
SELECT 'actual ratio not chosen' AS finding, company || '|' || metric_id AS subject FROM (SELECT DISTINCT company, metric_id FROM eligible WHERE candidate_role = 'primary' AND metric_id IS NOT NULL) WHERE (company, metric_id) NOT IN (SELECT (company, metric_id) FROM firsts)
UNION ALL SELECT 'chosen is no actual ratio', company || '|' || metric_id || '|' || concept FROM firsts WHERE candidate_role <> 'primary'""")
def gate_actual_beside_threshold(spark: SparkSession, d: str) -> DataFrame:
    candidates = A.basel_candidates(T.dimensioned(T.lines(spark, d)), _end())
    blind = A.first_hit(candidates.where("metric_id <> 'A02'"), ["company", "metric_id"], [F.col("context"), F.col("value")])
    return G.actual_beside_threshold(blind, candidates)


@query(T.sql("lines") + """SELECT 'captive debt not in review' AS finding, company AS subject FROM (SELECT DISTINCT company FROM lines WHERE d IN (0, 3) AND s % 2 = 0 AND p % 3 = 0) WHERE company LIKE '%4'""")
def gate_captive_reviewed(spark: SparkSession, d: str) -> DataFrame:
    cells = T.companies(spark, d).where("company not like '%4'").select("company", F.lit("B06").alias("metric_id"), F.lit("NEEDS_REVIEW").alias("status"), F.lit(None).cast("long").alias("value"))
    return G.captive_reviewed(cells, _captive(spark, d))


@query(T.sql("lines") + """SELECT 'ordinary term chosen' AS finding, company || '|' || CASE p % 3 WHEN 0 THEN 'LongTermDebt' WHEN 1 THEN 'DebtSecuritiesAvailableForSale' ELSE 'Revenues' END || '|' || context AS subject FROM lines WHERE d = 1 OR p % 3 = 1""")
def gate_captive_exclusions(spark: SparkSession, d: str) -> DataFrame:
    return G.captive_exclusions(_captive(spark, d))


@query(T.sql("lines") + BASEL + """, best AS (SELECT * FROM eligible WHERE metric_id IS NOT NULL AND candidate_role = 'primary' QUALIFY row_number() OVER (PARTITION BY company, metric_id ORDER BY (d = 2) DESC, (d IN (0, 2)) DESC, (d = 2), context, quantity) = 1),
blind AS (SELECT * FROM eligible WHERE metric_id IS NOT NULL AND candidate_role = 'primary' QUALIFY row_number() OVER (PARTITION BY company, metric_id ORDER BY context, quantity) = 1),
x AS (SELECT b.company, b.metric_id, concat_ws(',', CASE WHEN b.concept <> c.concept THEN 'concept' END, CASE WHEN b.context <> c.context THEN 'context' END, CASE WHEN b.d <> c.d THEN 'dimensions' END, CASE WHEN b.quantity <> c.quantity THEN 'value' END) AS other
  FROM best b JOIN blind c USING (company, metric_id))
SELECT 'differs in ' || other AS finding, company || '|' || metric_id AS subject FROM x WHERE other <> ''""")
def gate_selected_identity(spark: SparkSession, d: str) -> DataFrame:
    facts = T.dimensioned(T.lines(spark, d))
    blind = A.first_hit(A.basel_candidates(facts, _end()).where("candidate_role = 'primary'"), ["company", "metric_id"], [F.col("context"), F.col("value")])
    return G.selected_identity(blind, A.basel_ratios(facts, _end()))


@query(T.sql("facts", "companies") + """, have AS (SELECT company, concept, "end" AS period_end, max(abs(val)) AS top FROM facts JOIN companies USING (cik) GROUP BY 1, 2, 3),
want AS (SELECT company, 'Revenues' AS concept, fye AS period_end FROM companies)
SELECT CASE WHEN top IS NULL THEN 'missing' ELSE 'scale or value differs' END AS finding, company || '|Revenues|' || period_end AS subject FROM want LEFT JOIN have USING (company, concept, period_end) WHERE top IS NULL OR company LIKE '%2'""")
def gate_scaled_amounts(spark: SparkSession, d: str) -> DataFrame:
    companies = T.companies(spark, d)
    facts = T.facts(spark, d).join(small(companies), "cik").select("company", "concept", F.col("end").alias("period_end"), F.abs("val").alias("value"), F.create_map().cast("map<string,string>").alias("dimensions"))
    top = facts.where("concept = 'Revenues'").groupBy("company", "concept", "period_end").agg(F.max("value").alias("top"))
    want = companies.select("company", F.lit("Revenues").alias("concept"), F.col("fye").alias("period_end")).join(top, ["company", "concept", "period_end"], "left")
    off = F.when(F.col("company").endswith("2"), F.lit(1000)).otherwise(F.lit(1))
    return G.scaled_amounts(facts, want.select("company", "concept", "period_end", (F.coalesce("top", F.lit(0)) * off).alias("value")))


@query("SELECT 'missing' AS finding, i AS subject FROM (VALUES ('I1'), ('I2'), ('I3'), ('I4'), ('I5'), ('I6'), ('I7'), ('I8')) t(i) WHERE i NOT IN (SELECT 'I' || (n_nationkey % 7 + 2) FROM nation) UNION ALL SELECT DISTINCT 'unexpected', 'I' || (n_regionkey + 9) FROM nation")
def gate_implementation_map(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "nation")
    ids = n.select((F.col("n_nationkey") % 7 + 2).alias("i"), F.lit("plans/gates").alias("implemented_in")).unionByName(n.select((F.col("n_regionkey") + 9).alias("i"), F.lit("plans/gates").alias("implemented_in"))).unionByName(n.select(F.lit(1).alias("i"), F.lit(" ").alias("implemented_in")))
    return G.implementation_map(ids.select(F.concat(F.lit("I"), F.col("i").cast("string")).alias("instruction_id"), "implemented_in"))


@query(T.sql("lines") + """, r AS (SELECT DISTINCT company FROM lines WHERE d = 0), t AS (SELECT company FROM companies_ WHERE company LIKE '%1')
SELECT 'text used beside a fact' AS finding, company AS subject FROM r JOIN t USING (company) UNION ALL SELECT 'no such fact', company FROM companies_ WHERE company NOT IN (SELECT company FROM r)""".replace("companies_", "(SELECT n_name AS company FROM nation)"))
def gate_backlog(spark: SparkSession, d: str) -> DataFrame:
    names = T.companies(spark, d).select("company", F.lit("B12").alias("metric_id"), F.lit(1).alias("value"), F.lit("DIM_XBRL").alias("source_class"), F.lit("text_table").alias("extraction_method"))
    facts = T.lines(spark, d).select("company", F.when(F.col("d") == 0, "RevenueRemainingPerformanceObligation").otherwise("Other").alias("concept"))
    return G.backlog_from_instance(names, names.where("company like '%1'"), facts)


_BASE_URL = "https://www.sec.gov/Archives/edgar/data/"


def _requests(spark: SparkSession, d: str) -> DataFrame:
    """Every order as a request: host, digest and kept body go wrong by its data."""
    o = table(spark, d, "orders")
    host = F.when(F.col("o_orderpriority") == "5-LOW", "http://www.sec.gov/Archives/edgar/data/").otherwise(_BASE_URL)
    sha = F.sha2(F.concat_ws("-", F.col("o_custkey").cast("string"), F.when(F.col("o_orderstatus") == "P", F.col("o_orderkey").cast("string"))), 256)
    return o.select("o_orderkey", "o_orderstatus", F.concat(host, F.col("o_custkey").cast("string")).alias("source_url"), F.when(F.col("o_orderpriority") == "1-URGENT", 404).otherwise(200).alias("status_code"), F.when(F.col("o_orderpriority") == "2-HIGH", F.upper(sha)).otherwise(sha).alias("content_sha256"), F.concat(F.lit("raw/"), F.col("o_orderkey").cast("string")).alias("repo_relative_path"))


@query(f"""WITH r AS (SELECT *, CASE WHEN o_orderpriority = '5-LOW' THEN 'http://www.sec.gov/Archives/edgar/data/' ELSE '{_BASE_URL}' END || o_custkey AS u, o_orderpriority <> '1-URGENT' AS ok,
  sha256(o_custkey || CASE WHEN o_orderstatus = 'P' THEN '-' || o_orderkey ELSE '' END) AS h FROM orders), ok AS (SELECT *, CASE WHEN o_orderpriority = '2-HIGH' THEN upper(h) ELSE h END AS sha FROM r WHERE ok)
SELECT 'not official' AS finding, u AS subject FROM r WHERE o_orderpriority = '5-LOW' UNION ALL SELECT 'no digest', u FROM ok WHERE NOT regexp_full_match(sha, '[0-9a-f]{{64}}')
UNION ALL SELECT 'body missing', 'raw/' || o_orderkey FROM ok WHERE o_orderstatus = 'O' UNION ALL SELECT 'conflicting successful bodies', u FROM ok GROUP BY u HAVING count(DISTINCT sha) > 1""")
def gate_ledger_rows(spark: SparkSession, d: str) -> DataFrame:
    r = _requests(spark, d)
    return G.ledger_rows(r, r.where("o_orderstatus <> 'O'").select(F.col("repo_relative_path").alias("path"), F.col("content_sha256").alias("sha256")))


@query("""SELECT CASE WHEN o_orderstatus = 'P' THEN 'removed' ELSE 'changed' END AS finding, CAST(o_orderkey AS VARCHAR) AS subject FROM orders WHERE o_orderstatus = 'P' OR o_orderpriority = '1-URGENT'""")
def gate_ledger_prefix(spark: SparkSession, d: str) -> DataFrame:
    base = _requests(spark, d).withColumnRenamed("o_orderkey", "seq")
    head = base.where("o_orderstatus <> 'P'").withColumn("content_sha256", F.when(F.col("status_code") == 404, "gone").otherwise(F.col("content_sha256")))
    return G.ledger_prefix(base, head, ["source_url", "content_sha256"])


@query(f"""WITH x AS (SELECT c_name AS company, c_custkey + 1 AS cik, c_nationkey AS k, lpad(CAST(c_custkey AS VARCHAR), 18, '0') AS a FROM customer),
y AS (SELECT *, CASE WHEN k = 1 THEN 'https://example.com/data/' WHEN k = 2 THEN 'https://www.sec.gov/other/' ELSE '{_BASE_URL}' END || CASE WHEN k = 3 THEN cik + 1 ELSE cik END || '/' || CASE WHEN k = 2 THEN 'x' ELSE a END || '/a.htm' AS u FROM x),
z AS (SELECT company, u, unnest(list_filter([CASE WHEN k = 1 THEN 'non_sec' END, CASE WHEN k = 2 THEN 'unsupported_source_type' END, CASE WHEN k = 3 THEN 'cik_mismatch' END, CASE WHEN k = 4 THEN 'accession_mismatch' END, CASE WHEN k = 5 THEN 'document_mismatch' END], lambda v: v IS NOT NULL)) AS finding FROM y WHERE k <> 6)
SELECT finding, company || '|B01|' || u AS subject FROM z UNION ALL SELECT 'component_count_mismatch', company || '|B01' FROM y WHERE k = 6""")
def gate_locators(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").select(F.col("c_name").alias("company"), F.lit("B01").alias("metric_id"), (F.col("c_custkey") + 1).cast("string").alias("cik"), F.col("c_nationkey").alias("k"), F.lpad(F.col("c_custkey").cast("string"), 18, "0").alias("a"))
    base = F.when(F.col("k") == 1, "https://example.com/data/").when(F.col("k") == 2, "https://www.sec.gov/other/").otherwise(_BASE_URL)
    shown = F.when(F.col("k") == 3, (F.col("cik").cast("long") + 1).cast("string")).otherwise(F.col("cik"))
    url = F.concat(base, shown, F.lit("/"), F.when(F.col("k") == 2, "x").otherwise(F.col("a")), F.lit("/a.htm"))
    wrong = F.lpad((F.col("a").cast("long") + 1).cast("string"), 18, "0")
    return G.locator_errors(c.select("company", "metric_id", "cik", url.alias("source_url"), F.when(F.col("k") == 4, wrong).when(F.col("k") == 6, F.concat_ws(";", "a", "a")).otherwise(F.col("a")).alias("accession"), F.when(F.col("k") == 5, "b.htm").otherwise("a.htm").alias("document_name")))
