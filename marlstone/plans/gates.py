"""Verification gates. Each gives a table of violations; check() folds one into a row of the validation table.

Gates recompute what they check from their inputs and share no builder with what made the outputs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import config as C
from ..functions import text as X
from ..operators.relational import conflicts, coverage, exact_set_diff, multiset_diff, ordered_prefix, without_evidence

CHECK = "check_id string, severity string, status string, details string"
FINDING = "finding string, subject string"


def _findings(df: DataFrame, finding, *subject: str) -> DataFrame:
    return df.select(finding.alias("finding"), F.concat_ws("|", *[F.coalesce(F.col(s).cast("string"), F.lit("")) for s in subject]).alias("subject"))


def check(spark: SparkSession, check_id: str, violations: DataFrame | None, evidence: DataFrame | None = None, severity: str = "critical", shown: int = 5) -> DataFrame:
    """One row (check_id, severity, status, details). No violations table, or evidence with no rows, is never a
    pass. Details hold the number of violations and the first few in order."""
    if violations is None or (evidence is not None and evidence.isEmpty()):
        return spark.createDataFrame([(check_id, severity, "NOT_EVALUATED_MISSING_EVIDENCE", "no evidence")], CHECK)
    first = violations.orderBy("finding", "subject").limit(shown)
    n = violations.count()
    sample = "; ".join(f"{r.finding}: {r.subject}" for r in first.collect())
    return spark.createDataFrame([(check_id, severity, "FAIL" if n else "PASS", f"{n} violations: {sample}" if n else "none")], CHECK)


def matrix_keys(metrics: DataFrame, expected: DataFrame) -> DataFrame:
    """The matrix has exactly the cells that profiles ask for, once each."""
    return _findings(exact_set_diff(expected, metrics, ["company", "metric_id"]), F.col("finding"), "company", "metric_id")


def vocabulary(metrics: DataFrame) -> DataFrame:
    """Statuses, classes and units are of the closed lists."""
    bad = F.array_compact(F.array(F.when(~F.col("status").isin(*C.STATUSES), "unknown status"), F.when(~F.col("source_class").isin(*C.SOURCE_CLASSES), "unknown source class"), F.when(~F.coalesce("unit", F.lit("")).isin(*C.UNITS), "unknown unit")))
    return _findings(metrics.select("company", "metric_id", F.explode(bad).alias("finding")), F.col("finding"), "company", "metric_id")


def coverage_flags(table: DataFrame, metrics: DataFrame, evidence: DataFrame) -> DataFrame:
    """The coverage table has the matrix's keys and tells the truth about evidence."""
    keys = ["company", "metric_id"]
    real = coverage(metrics.select(*keys), evidence, keys).withColumnRenamed("has_evidence", "real")
    wrong = table.join(real, keys).where(~F.col("has_evidence").eqNullSafe(F.col("real")))
    return matrix_keys(table, metrics).unionByName(_findings(wrong, F.lit("wrong has_evidence"), *keys))


def numeric_evidence(metrics: DataFrame, evidence: DataFrame) -> DataFrame:
    """Every number that counts as found has evidence of equal value, unit, period and filing that is complete."""
    ok = ("OK", "OK_APPROX", "DIM_XBRL_OK", "MDA_OK", "DEF14A_OK", "8K_ITEM_OK")
    keys = ["company", "metric_id", "value", "unit", "period_start", "period_end", "accession"]
    whole = " and ".join(f"coalesce({c}, '') <> ''" for c in ("source_url", "concept_or_section", "extraction_method"))
    e = evidence.where(whole).withColumnRenamed("value_normalized", "value")
    need = metrics.where(F.col("value").isNotNull() & F.col("status").isin(*ok)).select(*keys)
    return _findings(without_evidence(need, e.select(*keys), keys), F.lit("no matching evidence"), "company", "metric_id")


def events_multiset(actual: DataFrame, expected: DataFrame, columns: list[str]) -> DataFrame:
    """The events are those recomputed from the raw filings, row for row and as often."""
    return _findings(multiset_diff(expected, actual, columns), F.when(F.col("surplus") > 0, "too many").otherwise("too few"), *columns, "surplus")


def event_outputs(metrics: DataFrame, events: DataFrame, mapping: dict[str, tuple[str, ...]]) -> DataFrame:
    """Counts in the matrix are those of the events, counted here by conditional sums."""
    sums = [F.sum(F.when(F.col("item_code").isin(*items), 1).otherwise(0)).alias(m) for m, items in mapping.items()]
    counted = events.groupBy("company").agg(*sums)
    long = counted.select("company", F.expr(f"stack({len(mapping)}, " + ", ".join(f"'{m}', {m}" for m in mapping) + ") as (metric_id, real)"))
    x = metrics.where(F.col("metric_id").isin(*mapping)).join(long, ["company", "metric_id"], "left").withColumn("real", F.coalesce("real", F.lit(0)))
    status = F.when(F.col("real") > 0, "8K_ITEM_OK").otherwise("NOT_AVAILABLE_SEC")
    return _findings(x.where((F.col("value").cast("long") != F.col("real")) | F.col("value").isNull() | (F.col("status") != status)), F.lit("count or status differs"), "company", "metric_id", "value", "real")


def golden(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """Golden assertions: the ids are the expected ones, once each, and each value is within its tolerance."""
    from ..operators.relational import within_tolerance

    ids = _findings(exact_set_diff(expected, actual, ["assertion_id"]), F.col("finding"), "assertion_id")
    x = expected.select("assertion_id", "expected", "tolerance").join(actual.select("assertion_id", F.col("actual").cast("string").alias("actual")), "assertion_id")
    return ids.unionByName(_findings(x.where(~within_tolerance("expected", "actual", "tolerance")), F.lit("value differs"), "assertion_id", "expected", "actual"))


def ratchet(metrics: DataFrame, previous: DataFrame) -> DataFrame:
    """No cell that had a good status before has lost it."""
    good = metrics.where(F.col("status").isin("OK", "OK_APPROX", "DIM_XBRL_OK", "MDA_OK", "DEF14A_OK", "8K_ITEM_OK", "TEXT_QUAL"))
    return _findings(previous.join(good.select("company", "metric_id"), ["company", "metric_id"], "left_anti"), F.lit("lost"), "company", "metric_id")


def thresholds_never_primary(chosen: DataFrame) -> DataFrame:
    """No chosen capital ratio is a regulatory requirement."""
    name = X.normalized_concept(F.col("concept"))
    bad = F.exists(F.array(*[F.lit(w) for w in C.THRESHOLD_WORDS]), lambda w: F.contains(name, w))
    return _findings(chosen.where(bad), F.lit("threshold chosen"), "company", "metric_id", "concept")


def backlog_from_instance(metrics: DataFrame, evidence: DataFrame, facts: DataFrame) -> DataFrame:
    """A backlog with a structured fact is not read from text, and one that claims a fact has one."""
    have = facts.where(F.col("concept").endswith(C.RPO)).select("company").distinct()
    rows = metrics.where("metric_id = 'B12' and value is not null")
    text = evidence.where("metric_id = 'B12' and extraction_method like 'text%'").select("company").distinct()
    a = _findings(rows.join(have, "company").join(text, "company"), F.lit("text used beside a fact"), "company")
    return a.unionByName(_findings(rows.where("source_class = 'DIM_XBRL'").join(have, "company", "left_anti"), F.lit("no such fact"), "company"))


def placeholder_notes(metrics: DataFrame) -> DataFrame:
    return _findings(metrics.where(F.lower("notes").rlike("todo|tbd|placeholder|fixme")), F.lit("placeholder"), "company", "metric_id")


def ledger_prefix(base: DataFrame, head: DataFrame, columns: list[str]) -> DataFrame:
    """The ledger only grew: each earlier row is where it was, as it was."""
    return _findings(ordered_prefix(base, head, "seq", columns), F.col("finding"), "seq")


def ledger_rows(ledger: DataFrame, files: DataFrame) -> DataFrame:
    """Requests went to official hosts, digests are digests, kept bodies exist with the digest they claim, and a
    document that may not change had one successful body."""
    from ..functions.urls import official_column

    url = _findings(ledger.where(~official_column(F.col("source_url"))), F.lit("not official"), "source_url")
    ok = ledger.where("status_code = 200")
    sha = _findings(ok.where(~F.coalesce(F.col("content_sha256").rlike("^[0-9a-f]{64}$"), F.lit(False))), F.lit("no digest"), "source_url")
    kept = ok.where("repo_relative_path is not null")
    lost = kept.join(files.select(F.col("path").alias("repo_relative_path"), F.col("sha256").alias("content_sha256")), ["repo_relative_path", "content_sha256"], "left_anti")
    fixed = ok.where("source_url like '%/Archives/%'")
    two = conflicts(fixed, ["source_url"], F.col("content_sha256"))
    return url.unionByName(sha).unionByName(_findings(lost, F.lit("body missing"), "repo_relative_path")).unionByName(_findings(two, F.lit("conflicting successful bodies"), "source_url"))


def locator_errors(rows: DataFrame) -> DataFrame:
    """Locators of metrics: lists of one length; each address official, with the row's CIK and the accession of
    its place in the list, and of a kind of source that counts."""
    from ..functions.urls import official_column

    s = lambda c: F.split(F.coalesce(c, F.lit("")), ";")
    x = rows.withColumns({"u": s("source_url"), "a": s("accession"), "d": s("document_name")})
    even = (F.size("u") == F.size("a")) & (F.size("u") == F.size("d"))
    parts = x.where(even).select("company", "metric_id", "cik", F.explode(F.arrays_zip("u", "a", "d")).alias("p")).select("company", "metric_id", "cik", "p.*")
    in_url = F.regexp_extract("u", r"/data/0*([0-9]+)/", 1)
    plain = F.regexp_extract("u", r"/data/[0-9]+/([0-9]{18})", 1)
    facts = F.col("u").rlike(r"/(companyfacts|companyconcept|submissions)/")
    bad = F.array_compact(F.array(
        F.when(~official_column(F.col("u")), "non_sec"),
        F.when((in_url != "") & (in_url.cast("long") != F.col("cik").cast("long")), "cik_mismatch"),
        F.when((plain != "") & (plain != X.accession_no_dash(F.col("a"))), "accession_mismatch"),
        F.when((plain != "") & (F.col("d") != "") & ~F.col("u").endswith(F.concat(F.lit("/"), F.col("d"))), "document_mismatch"),
        F.when((plain == "") & ~facts & official_column(F.col("u")), "unsupported_source_type"),
    ))
    wrong = _findings(parts.select("company", "metric_id", "u", F.explode(bad).alias("finding")), F.col("finding"), "company", "metric_id", "u")
    return wrong.unionByName(_findings(x.where(~even), F.lit("component_count_mismatch"), "company", "metric_id"))


def audit_sample(rows: DataFrame, metrics: DataFrame, caps: dict[str, int]) -> DataFrame:
    """The audit sample is the deterministic one: of each source class the first rows by digest, up to its cap."""
    from pyspark.sql import Window

    table = F.create_map(*[F.lit(x) for kv in caps.items() for x in kv])
    order = Window.partitionBy("source_class").orderBy(F.sha2(F.concat_ws("|", "company", "metric_id"), 256), "company", "metric_id")
    want = metrics.where("value is not null").withColumn("r", F.row_number().over(order)).where(F.col("r") <= F.coalesce(table[F.col("source_class")], F.lit(0)))
    return _findings(exact_set_diff(want, rows, ["company", "metric_id"]), F.col("finding"), "company", "metric_id")


def auditor_cells(metrics: DataFrame, inventory: DataFrame, facts: DataFrame) -> DataFrame:
    """C04 recomputed from raw facts and the inventory, by a way of its own: for each year of a company the names
    of the best filing that has just one. Inventory rows that lack a field are findings, and so is a company
    whose cell has another value or status, or no cell, or more than one."""
    from ..sources.xbrl import is_dei

    needed = ("company", "cik", "accession", "form", "reportDate")
    lacks = F.array_compact(F.array(*[F.when(F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")) == "", c) for c in needed]))
    bad = inventory.withColumn("fields", F.array_join(lacks, ",")).where("fields <> ''")
    annual = inventory.where(F.col("form").isin("10-K", "10-K/A")).dropna(subset=list(needed)).select(*needed, "filingDate").distinct()
    years = annual.groupBy("company", "cik").agg(F.sort_array(F.collect_set("reportDate"), asc=False).alias("ends"))
    years = years.select("company", "cik", F.posexplode(F.slice("ends", 1, 2)).alias("back", "reportDate"))
    named = facts.where((F.col("concept") == "AuditorName") & is_dei(F.col("namespace"))).withColumn("name", F.upper(F.regexp_replace("text", "[^A-Za-z0-9]", "")))
    named = named.where("name <> ''").groupBy("cik", "accession").agg(F.min("name").alias("low"), F.max("name").alias("high")).where("low = high")
    best = years.join(annual, ["company", "cik", "reportDate"]).join(named, ["cik", "accession"])
    best = best.groupBy("company", "cik", "back").agg(F.min_by("low", F.struct(F.col("form") == "10-K", -F.unix_date("filingDate"), "accession")).alias("name"))
    real = years.where("back = 0").join(best.groupBy("company", "cik").pivot("back", [0, 1]).agg(F.first("name")), ["company", "cik"], "left")
    real = real.select("company", F.when(F.col("0") == F.col("1"), 0).when(F.col("0") != F.col("1"), 1).alias("real"))
    cells = metrics.where("metric_id = 'C04'").groupBy("company").agg(F.count("*").alias("n"), F.first(F.col("value").cast("int")).alias("value"), F.first("status").alias("status"))
    x = real.join(cells, "company", "left")
    wanted = F.when(F.col("real") == 0, "DIM_XBRL_OK").otherwise("NEEDS_REVIEW")
    finding = F.when(F.col("n").isNull(), "no cell").when(F.col("n") > 1, "two cells").when(~F.col("value").eqNullSafe(F.col("real")), "value differs").when(~F.col("status").eqNullSafe(wanted), "status differs")
    wrong = x.withColumn("finding", finding).where("finding is not null")
    return _findings(bad, F.concat(F.lit("inventory row lacks "), F.col("fields")), *needed).unionByName(_findings(wrong, F.col("finding"), "company", "value", "real"))


def actual_beside_threshold(chosen: DataFrame, candidates: DataFrame) -> DataFrame:
    """Where a company has an actual capital ratio beside regulatory thresholds, the chosen one is an actual ratio
    of the candidates."""
    keys = ["company", "metric_id"]
    actual = candidates.where("candidate_role = 'primary'")
    none = _findings(actual.select(*keys).distinct().join(chosen, keys, "left_anti"), F.lit("actual ratio not chosen"), *keys)
    other = chosen.join(actual.select(*keys, "concept", "context").distinct(), [*keys, "concept", "context"], "left_anti")
    return none.unionByName(_findings(other, F.lit("chosen is no actual ratio"), *keys, "concept"))


def captive_reviewed(metrics: DataFrame, facts: DataFrame) -> DataFrame:
    """Recall: each company with debt of a captive finance member has its leverage cell blank and in review."""
    from ..operators.facts import captive_debt

    have = captive_debt(facts).select("company").distinct()
    cells = metrics.where("metric_id = 'B06' and status = 'NEEDS_REVIEW' and value is null").select("company")
    return _findings(have.join(cells, "company", "left_anti"), F.lit("captive debt not in review"), "company")


def captive_exclusions(chosen: DataFrame) -> DataFrame:
    """Precision: no chosen fact rests on ordinary credit or lease terms, or on debt securities held."""
    members = X.normalized_concept(F.array_join(F.map_values("dimensions"), " "))
    plain = F.exists(F.array(*[F.lit(w) for w in C.CAPTIVE_EXCEPTIONS]), lambda w: F.contains(members, w))
    telling = F.exists(F.map_values("dimensions"), lambda m: _captive(X.normalized_concept(m)))
    securities = F.startswith(X.normalized_concept(F.col("concept")), F.lit("debtsecurities"))
    return _findings(chosen.where((plain & ~telling) | securities), F.lit("ordinary term chosen"), "company", "concept", "context")


def _captive(name):
    some = lambda words: F.exists(F.array(*[F.lit(w) for w in words]), lambda w: F.contains(name, w))
    return some(C.CAPTIVE_WORDS) & ~some(C.CAPTIVE_EXCEPTIONS)


def selected_identity(chosen: DataFrame, expected: DataFrame) -> DataFrame:
    """A further company's choices are the expected ones by concept, context, dimensions and value, not by value alone."""
    keys = ["company", "metric_id"]
    flat = lambda df, to: df.select(*keys, *[(F.array_join(F.transform(F.array_sort(F.map_entries(c)), lambda e: F.concat_ws("=", e["key"], e["value"])), ";") if c == "dimensions" else F.col(c).cast("string")).alias(f"{to}_{c}") for c in ("concept", "context", "dimensions", "value")])
    x = flat(expected, "e").join(flat(chosen, "c"), keys, "left")
    differs = F.array_compact(F.array(*[F.when(~F.col(f"e_{c}").eqNullSafe(F.col(f"c_{c}")), c) for c in ("concept", "context", "dimensions", "value")]))
    x = x.withColumn("finding", F.when(F.col("c_concept").isNull() & F.col("c_value").isNull(), "not chosen").otherwise(F.concat(F.lit("differs in "), F.array_join(differs, ","))))
    return _findings(x.where((F.size(differs) > 0) | (F.col("finding") == "not chosen")), F.col("finding"), *keys)


def scaled_amounts(facts: DataFrame, expected: DataFrame) -> DataFrame:
    """Amounts that are known in full (company, concept, period_end, value) are in the instance at that scale. A
    missing fact is a finding, never a pass."""
    keys = ["company", "concept", "period_end"]
    have = facts.join(expected.select(*keys).distinct(), keys, "left_semi").where("size(dimensions) = 0")
    have = have.groupBy(*keys).agg(F.collect_set(F.col("value").cast("decimal(38,6)")).alias("have"))
    x = expected.join(have, keys, "left")
    finding = F.when(F.col("have").isNull(), "missing").when(~F.array_contains("have", F.col("value").cast("decimal(38,6)")), "scale or value differs")
    return _findings(x.withColumn("finding", finding).where("finding is not null"), F.col("finding"), *keys)


def golden_snapshot(stored: DataFrame, fixture: DataFrame, metrics: DataFrame) -> DataFrame:
    """A kept golden result is what it would be now: its expected values are the fixture's, its actual values the
    matrix's, and its status follows from the two."""
    from ..operators.relational import within_tolerance

    keys = ["assertion_id"]
    ids = _findings(exact_set_diff(fixture, stored, keys), F.col("finding"), *keys)
    f = fixture.select(*keys, "company", "metric_id", F.col("expected").alias("f_expected"), F.col("tolerance").alias("f_tolerance"))
    x = stored.join(f, keys).join(metrics.select("company", "metric_id", F.col("value").cast("string").alias("now")), ["company", "metric_id"], "left")
    status = F.when(within_tolerance("expected", "actual", "tolerance"), "PASS").otherwise("FAIL")
    other = F.array_compact(F.array(
        F.when(~(F.col("expected").eqNullSafe(F.col("f_expected")) & F.col("tolerance").eqNullSafe(F.col("f_tolerance"))), "fixture mismatch"),
        F.when(~F.col("actual").eqNullSafe(F.col("now")), "matrix drift"),
        F.when(~F.col("status").eqNullSafe(status), "status differs"),
    ))
    return ids.unionByName(_findings(x.select(*keys, F.explode(other).alias("finding")), F.col("finding"), *keys))


#: The instructions that a map of the implementation must cover.
INSTRUCTIONS = tuple(f"I{i}" for i in range(1, 9))


def implementation_map(rows: DataFrame, ids: tuple[str, ...] = INSTRUCTIONS) -> DataFrame:
    """Each instruction has at least one row that names where it is done; rows of no known instruction are findings."""
    spark = rows.sparkSession
    wanted = spark.sql("select * from values " + ", ".join(f"('{i}')" for i in ids) + " as t(instruction_id)")
    done = rows.where("coalesce(trim(implemented_in), '') <> ''").select("instruction_id").distinct()
    return _findings(exact_set_diff(wanted, done, ["instruction_id"]), F.col("finding"), "instruction_id")


def event_rows_recomputed(metrics: DataFrame, companies: DataFrame, events: DataFrame, mapping: dict[str, tuple[str, ...]]) -> DataFrame:
    """Whole rows of event metrics, (company, metric_id, value, status, unit, source_class, confidence, accession), are
    those worked out here, one conditional pass over the events for all metrics."""
    parts = [F.when(F.col("item_code").isin(*items), F.col("accession")) for items in mapping.values()]
    aggs = [x for m, p in zip(mapping, parts, strict=True) for x in (F.count(p).alias(f"n_{m}"), F.array_join(F.sort_array(F.collect_set(p)), ";").alias(f"a_{m}"))]
    wide = companies.select("company").distinct().join(events.groupBy("company").agg(*aggs), "company", "left")
    long = wide.select("company", F.inline(F.array(*[F.struct(F.lit(m).alias("metric_id"), F.coalesce(f"n_{m}", F.lit(0)).alias("value"), F.coalesce(f"a_{m}", F.lit("")).alias("accession")) for m in mapping])))
    some = F.col("value") > 0
    pick = lambda yes, no: F.when(some, yes).otherwise(no)
    fixed = {"status": pick("8K_ITEM_OK", "NOT_AVAILABLE_SEC"), "unit": F.lit("count"), "source_class": F.lit("8K_ITEM"), "confidence": pick("0.90", "0.80")}
    columns = ["company", "metric_id", "value", "status", "unit", "source_class", "confidence", "accession"]
    real = long.withColumns(fixed).select(*columns)
    own = metrics.where(F.col("metric_id").isin(*mapping)).withColumns({"value": F.col("value").cast("long"), "confidence": F.col("confidence").cast("decimal(3,2)").cast("string"), "accession": F.coalesce("accession", F.lit(""))}).select(*columns)
    return _findings(multiset_diff(real, own, columns), F.when(F.col("surplus") > 0, "row not as recomputed").otherwise("recomputed row missing"), "company", "metric_id", "value", "status")
