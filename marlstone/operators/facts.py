"""Selection of facts and the standard metrics: what a filing's numbers are, and what follows from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import config as C
from ..functions import text as X
from .relational import first_hit, growth, ratio, small

ANNUAL_DAYS = (300, 400)


def annual(end: Column) -> Column:
    """Duration facts of a 10-K that end on the given day and span a year."""
    days = F.datediff(F.col("end"), F.col("start"))
    return F.col("form").startswith("10-K") & (F.col("end") == end) & F.col("start").isNotNull() & days.between(*ANNUAL_DAYS)


def instant(end: Column) -> Column:
    """Facts of a 10-K at the given day, with no start."""
    return F.col("form").startswith("10-K") & (F.col("end") == end) & F.col("start").isNull()


def stub(end: Column) -> Column:
    """Facts of a 10-K that end on the given day and span less than a year."""
    return F.col("form").startswith("10-K") & (F.col("end") == end) & (F.datediff(F.col("end"), F.col("start")) < ANNUAL_DAYS[0])


def latest_10k(filings: DataFrame, keys: list[str]) -> DataFrame:
    """The latest 10-K or 10-K/A of each key: by report date, then filing date, then accession."""
    order = [F.col(c).desc() for c in ("reportDate", "filingDate", "accession")]
    return first_hit(filings.where(F.col("form").isin("10-K", "10-K/A")), keys, order)


def components(facts: DataFrame, targets: DataFrame, chains: DataFrame) -> DataFrame:
    """(company, cik, component, period_kind, value, concept, unit, start, end, accn, form, filed): for each target
    (company, cik, fye, prior_fye) the first concept of each chain that has a fact of the fiscal year, latest
    filed; the same for the prior year, and for stub years. Targets and chains are configuration."""
    t = targets.select("company", "cik", F.explode(F.array(F.struct(F.lit("current").alias("period_kind"), F.col("fye").alias("day")), F.struct(F.lit("prior").alias("period_kind"), F.col("prior_fye").alias("day")))).alias("x")).select("company", "cik", "x.*")
    f = facts.join(small(chains), "concept").join(small(t.where("day is not null")), "cik")
    kind = F.when(F.col("instant") & instant(F.col("day")), F.col("period_kind")).when(~F.col("instant") & annual(F.col("day")), F.col("period_kind")).when(~F.col("instant") & stub(F.col("day")), F.concat(F.lit("stub_"), "period_kind"))
    f = f.withColumn("period_kind", kind).where("period_kind is not null and unit = 'USD'")
    hit = first_hit(f, ["company", "cik", "component", "period_kind"], [F.col("chain_rank"), F.col("filed").desc(), F.col("accn").desc(), F.col("start"), F.col("val").desc()])
    return hit.select("company", "cik", "component", "period_kind", F.col("val").alias("value"), "concept", "unit", "start", "end", "accn", "form", "filed")


def _wide(found: DataFrame) -> DataFrame:
    cell = F.concat_ws(":", "period_kind", "component")
    names = [f"{k}:{c}" for k in ("current", "prior", "stub_current") for c in C.CHAINS]
    return found.withColumn("cell", cell).groupBy("company", "cik").pivot("cell", names).agg(F.first(F.struct("value", "concept", "accn", "start", "end")))


def standard_metrics(found: DataFrame) -> DataFrame:
    """(company, cik, metric_id, value, unit, status, source_class, formula, concept_or_section, notes) of the
    standard metrics, from components(). Missing parts give NOT_AVAILABLE_SEC with a blank value, never 0; a
    stub year gives NOT_MEANINGFUL. Total debt is the total, or current and noncurrent parts, never both."""
    v = lambda c, k="current": F.col(f"`{k}:{c}`.value")
    n = lambda c, k="current": F.col(f"`{k}:{c}`.concept")
    zero = lambda c: F.coalesce(v(c), F.lit(0))
    parts = F.when(v("depreciation").isNotNull() | v("amortization").isNotNull(), zero("depreciation") + zero("amortization"))
    da = F.coalesce(v("depreciation_amortization"), parts)
    rebuilt = v("operating_income").isNull() & v("pretax_income").isNotNull() & v("interest_expense").isNotNull()
    income = F.coalesce(v("operating_income"), v("pretax_income") + v("interest_expense"))  # provisional bridge
    long_term = F.coalesce(v("long_term_debt"), F.when(v("long_term_debt_current").isNotNull() | v("long_term_debt_noncurrent").isNotNull(), zero("long_term_debt_current") + zero("long_term_debt_noncurrent")))
    debt = long_term + zero("short_term_borrowings") + zero("commercial_paper") + zero("finance_lease")
    stubbed = lambda c: v(c).isNull() & v(c, "stub_current").isNotNull()
    none = F.lit(None).cast("string")

    def metric(i: str, value: Column, unit: str, formula: str, concept: Column, meaningless: Column | None = None, approx: Column | None = None, derived: bool = True, stub_of: str = "revenue") -> Column:
        bad = F.coalesce(meaningless, F.lit(False)) if meaningless is not None else F.lit(False)
        status = F.when(stubbed(stub_of), "NOT_MEANINGFUL").when(bad, "NOT_MEANINGFUL").when(value.isNull(), "NOT_AVAILABLE_SEC")
        status = status.when(approx, "OK_APPROX").otherwise("OK") if approx is not None else status.otherwise("OK")
        shown = F.when(status.isin("OK", "OK_APPROX"), value.cast("decimal(38,18)"))
        return F.struct(F.lit(i).alias("metric_id"), shown.alias("value"), F.lit(unit).alias("unit"), status.alias("status"), F.lit("DERIVED" if derived else "STD_XBRL").alias("source_class"), F.lit(formula).alias("formula"), concept.alias("concept_or_section"), F.when(stubbed(stub_of), "stub period").otherwise(none).alias("notes"))

    both = lambda *c: F.concat_ws("+", *[n(x) for x in c])
    rows = [
        metric("B01", v("revenue"), "USD", "first hit", n("revenue"), derived=False),
        metric("B02", growth(v("revenue"), v("revenue", "prior")), "ratio", "(now - before) / before", n("revenue")),
        metric("B03", ratio(income + da, v("revenue")), "ratio", "(operating income + D&A) / revenue", both("operating_income", "depreciation_amortization", "revenue"), approx=rebuilt),
        metric("B04", v("net_income"), "USD", "first hit", n("net_income"), derived=False, stub_of="net_income"),
        metric("B05", v("operating_cash_flow") - v("capex"), "USD", "operating cash flow - capex", both("operating_cash_flow", "capex"), stub_of="operating_cash_flow"),
        metric("B06", ratio(debt, v("equity")), "ratio", "total debt / equity", both("long_term_debt", "equity"), meaningless=v("equity") < 0, stub_of="cash"),
        metric("B07", ratio(income, v("interest_expense")), "ratio", "operating income / interest expense", both("operating_income", "interest_expense"), meaningless=income <= 0, approx=rebuilt),
        metric("B08", ratio(v("current_assets"), v("current_liabilities")), "ratio", "current assets / current liabilities", both("current_assets", "current_liabilities"), stub_of="cash"),
        metric("B09", v("cash"), "USD", "first hit", n("cash"), derived=False, stub_of="cash"),
        metric("A08", ratio(v("noninterest_income"), v("net_interest_income")), "ratio", "noninterest income / net interest income", both("noninterest_income", "net_interest_income"), stub_of="net_interest_income"),
        metric("A10", ratio(v("allowance"), v("loans")), "ratio", "allowance / loans before allowance", both("allowance", "loans"), stub_of="cash"),
    ]
    return _wide(found).select("company", "cik", F.explode(F.array(*rows)).alias("m")).select("company", "cik", "m.*")


def applied(metrics: DataFrame, companies: DataFrame, applicability: DataFrame) -> DataFrame:
    """The cells that each company's profile asks for, with its metrics where there are any: current ratio of a
    bank is N_A_STRUCTURAL, what no extractor gave is NOT_EXTRACTED."""
    grid = companies.select("company", "cik", "profile").join(small(applicability), "profile")
    out = grid.join(metrics.drop("cik"), ["company", "metric_id"], "left")
    structural = (F.col("profile") == "financial_institution") & (F.col("metric_id") == "B08")
    return out.withColumn("value", F.when(~structural, F.col("value"))).withColumn("status", F.when(structural, "N_A_STRUCTURAL").otherwise(F.coalesce("status", F.lit("NOT_EXTRACTED"))))


def continuity(metrics: DataFrame, companies: DataFrame) -> DataFrame:
    """Growth over a change of entity is not meaningful; point-in-time metrics stay."""
    broken = companies.where("entity_continuity_status <> 'continuous'").select("company", F.lit(True).alias("broken"))
    out = metrics.join(small(broken), "company", "left")
    hit = F.coalesce("broken", F.lit(False)) & (F.col("metric_id") == "B02")
    return out.withColumn("value", F.when(~hit, F.col("value"))).withColumn("status", F.when(hit, "NOT_MEANINGFUL").otherwise(F.col("status"))).drop("broken")


def _has(text: Column, words: tuple[str, ...]) -> Column:
    return F.exists(F.array(*[F.lit(w) for w in words]), lambda w: F.contains(text, w))


def basel_candidates(facts: DataFrame, period_end: Column) -> DataFrame:
    """Capital ratio facts with their metric and role: ``primary`` or ``regulatory_threshold``. Eligible are pure
    facts of the period with the standard axis; thresholds are told by their words and never primary."""
    name = X.normalized_concept(F.col("concept"))
    axes = F.map_keys("dimensions")
    axis = F.exists(axes, lambda a: F.element_at(F.split(a, ":"), -1) == C.BASEL_AXIS)
    ratio_like = F.contains(name, F.lit("riskweightedassets")) | F.contains(name, F.lit("riskbasedcapitalratio"))
    cet1 = F.contains(name, F.lit("commonequitytier1")) | F.contains(name, F.lit("cet1"))
    metric = F.when(ratio_like & cet1, "A02").when(ratio_like & F.contains(name, F.lit("tier1")) & ~cet1, "A01")
    role = F.when(_has(name, C.THRESHOLD_WORDS), "regulatory_threshold").otherwise("primary")
    return facts.where((F.col("unit") == "pure") & (F.col("period_end") == period_end) & axis).withColumns({"metric_id": metric, "candidate_role": role}).where("metric_id is not null")


def basel_ratios(facts: DataFrame, period_end: Column) -> DataFrame:
    """One primary fact of each company and metric: parent or consolidated first, standardized first, without a
    legal entity first, then by context."""
    members = X.normalized_concept(F.array_join(F.map_values("dimensions"), " "))
    entity = F.exists(F.map_keys("dimensions"), lambda a: F.element_at(F.split(a, ":"), -1) == "LegalEntityAxis")
    order = [(F.contains(members, F.lit("parentcompany")) | F.contains(members, F.lit("consolidated"))).desc(), F.contains(members, F.lit("standardized")).desc(), entity.asc(), F.col("context"), F.col("value")]
    return first_hit(basel_candidates(facts, period_end).where("candidate_role = 'primary'"), ["company", "metric_id"], order)


def captive_debt(facts: DataFrame) -> DataFrame:
    """Debt facts of a captive finance member: candidates for review. The main cell stays blank."""
    axis = lambda a: F.element_at(F.split(a, ":"), -1).isin("StatementBusinessSegmentsAxis", "LegalEntityAxis")
    members = F.map_values(F.map_filter("dimensions", lambda a, m: axis(a)))
    captive = F.exists(members, lambda m: _has(X.normalized_concept(m), C.CAPTIVE_WORDS) & ~_has(X.normalized_concept(m), C.CAPTIVE_EXCEPTIONS))
    name = X.normalized_concept(F.col("concept"))
    return facts.where(captive & F.contains(name, F.lit("debt")) & ~F.startswith(name, F.lit("debtsecurities"))).withColumns({"candidate_role": F.lit("captive_finance_debt"), "status": F.lit("NEEDS_REVIEW")})


def rpo(facts: DataFrame, period_end: Column) -> DataFrame:
    """(company, value, status, formula): the total contract backlog, else the sum of its current and noncurrent
    parts. Concepts may carry a company's prefix; those of a timing axis are out, and so is less than the least."""
    concept = F.col("concept")
    timing = F.exists(F.map_keys("dimensions"), lambda a: F.contains(X.normalized_concept(a), F.lit("timing"))) | F.contains(X.normalized_concept(concept), F.lit("timing")) | F.contains(X.normalized_concept(concept), F.lit("percentage"))
    usd = F.col("unit").isin("USD", "iso4217:USD")
    part = F.when(concept.endswith(C.RPO), "total").when(concept.rlike(f"{C.RPO}(Noncurrent|NonCurrent)$"), "noncurrent").when(concept.rlike(f"{C.RPO}Current$"), "current")
    x = facts.where(usd & (F.col("period_end") == period_end) & ~F.coalesce(timing, F.lit(False))).withColumn("part", part).where("part is not null")
    x = first_hit(x, ["company", "part"], [F.size("dimensions"), F.col("value").desc(), F.col("context")]).groupBy("company").pivot("part", ["total", "current", "noncurrent"]).agg(F.first("value"))
    value = F.coalesce("total", F.col("current") + F.col("noncurrent"))
    formula = F.when(F.col("total").isNotNull(), "total").otherwise("current + noncurrent")
    return x.select("company", value.alias("value"), F.lit("DIM_XBRL_OK").alias("status"), formula.alias("formula")).where(F.col("value") >= C.RPO_LEAST_USD)


def compensation(facts: DataFrame, period_end: Column) -> DataFrame:
    """(company, value, status, n_facts): one officer's total pay of the year; several are never summed."""
    x = facts.where((F.col("concept") == "PeoTotalCompAmt") & F.col("unit").isin("USD", "iso4217:USD") & (F.col("period_end") == period_end))
    x = x.groupBy("company").agg(F.count_distinct("value").alias("n_facts"), F.max("value").alias("v"))
    return x.select("company", F.when(F.col("n_facts") == 1, F.col("v")).alias("value"), F.when(F.col("n_facts") == 1, "DEF14A_OK").otherwise("NEEDS_REVIEW").alias("status"), "n_facts")


def auditors(facts: DataFrame) -> DataFrame:
    """(company, cik, accession, auditor, canonical, finding): the one auditor that a filing names, by names that
    are not blank; names that differ in more than signs are a conflict."""
    from ..sources.xbrl import is_dei

    x = facts.where((F.col("concept") == "AuditorName") & is_dei(F.col("namespace")) & ~X.blank_name(F.col("text"))).withColumn("canonical", X.canonical_name(F.col("text")))
    x = x.groupBy("company", "cik", "accession").agg(F.count_distinct("canonical").alias("n"), F.min("text").alias("auditor"), F.min("canonical").alias("canonical"))
    ok = F.col("n") == 1
    return x.select("company", "cik", "accession", F.when(ok, F.col("auditor")).alias("auditor"), F.when(ok, F.col("canonical")).alias("canonical"), F.when(~ok, "conflicting_values").alias("finding"))


def auditor_candidates(inventory: DataFrame) -> DataFrame:
    """(company, cik, candidates, prior_candidates) for auditor_change(), of an inventory (company, cik, source_role,
    accession, form, reportDate, filingDate). The target is the latest annual report under its CIK. Candidates of a
    year are its annual reports, amendments first, then by filing date; the prior year is the latest one before the
    target's under the same CIK. One company's annual reports are few."""
    annual_reports = inventory.where(F.col("form").isin("10-K", "10-K/A") & F.col("reportDate").isNotNull() & F.col("accession").isNotNull())
    rows = annual_reports.select("company", "cik", "reportDate", "accession", F.col("form").eqNullSafe("10-K").alias("original"), F.date_diff(F.lit("9999-12-31").cast("date"), F.col("filingDate")).alias("age")).distinct()
    years = rows.groupBy("company", "cik", "reportDate").agg(F.array_sort(F.collect_set(F.struct("original", "age", "accession"))).alias("c"))
    years = years.select("company", "cik", "reportDate", F.transform("c", lambda x: x["accession"]).alias("c"))
    last = years.groupBy("company", "cik").agg(F.reverse(F.array_sort(F.collect_list(F.struct("reportDate", "c")))).alias("y"))
    none = F.array().cast("array<string>")
    return last.select("company", "cik", F.col("y")[0]["c"].alias("candidates"), F.coalesce(F.get("y", F.lit(1))["c"], none).alias("prior_candidates"))


def auditor_change(targets: DataFrame, names: DataFrame) -> DataFrame:
    """C04 of each target (company, cik, candidates, prior_candidates: accessions in order of preference): the
    first candidate that names an auditor, against the same of the prior year under the same CIK."""
    def pick(column: str, name: str) -> DataFrame:
        c = targets.select("company", "cik", F.posexplode(column).alias("pos", "accession")).join(names.where("canonical is not null"), ["company", "cik", "accession"])
        return first_hit(c, ["company", "cik"], [F.col("pos")]).select("company", "cik", F.col("canonical").alias(name))

    x = targets.select("company", "cik").join(pick("candidates", "now"), ["company", "cik"], "left").join(pick("prior_candidates", "before"), ["company", "cik"], "left")
    missing = F.col("now").isNull() | F.col("before").isNull()
    same = F.col("now") == F.col("before")
    return x.select("company", "cik", F.lit("C04").alias("metric_id"), F.when(missing, None).when(same, 0).otherwise(1).alias("value"), F.when(missing, "NEEDS_REVIEW").when(same, "DIM_XBRL_OK").otherwise("NEEDS_REVIEW").alias("status"), F.when(missing, 0.45).otherwise(0.80).alias("confidence"))


def original_fallback(targets: DataFrame, facts: DataFrame, filings: DataFrame, least: int = 500, groups: DataFrame | None = None) -> DataFrame:
    """Targets whose instance is an amendment, has fewer than ``least`` facts, or has no fact of one of the ``groups``
    (group_name, concept) that a report must have, with the original 10-K of the same CIK and report date and the
    reasons."""
    n = facts.groupBy("accession").agg(F.count("*").alias("n_facts"))
    x = targets.join(n, "accession", "left").withColumn("n_facts", F.coalesce("n_facts", F.lit(0)))
    lacking = F.lit(False)
    if groups is not None:
        have = facts.join(small(groups), "concept").groupBy("accession").agg(F.count_distinct("group_name").alias("n_groups"))
        x = x.join(have, "accession", "left")
        lacking = F.coalesce("n_groups", F.lit(0)) < groups.agg(F.count_distinct("group_name")).scalar()
    reasons = F.array_compact(F.array(F.when(F.col("form") == "10-K/A", "target_is_amendment"), F.when(F.col("n_facts") < least, f"target_instance_fact_count_lt_{least}"), F.when(lacking, "target_instance_key_group_missing")))
    x = x.withColumn("reasons", reasons).where(F.size("reasons") > 0)
    o = filings.where("form = '10-K'").select("cik", "reportDate", F.col("accession").alias("original_accession"))
    return x.join(o, ["cik", "reportDate"]).where("original_accession <> accession").select("company", "cik", "accession", "original_accession", "reasons", F.lit("target_original_full_instance").alias("source_role"))


def crosscheck(metrics: DataFrame, instance: DataFrame) -> DataFrame:
    """Standard values against instance facts of the same concept, period and filing: MATCH, MISMATCH, NOT_FOUND."""
    keys = ["concept", "period_end", "accession"]
    i = first_hit(instance.where("size(dimensions) = 0"), keys, [F.col("context")]).select(*keys, F.col("value").alias("instance_value"))
    x = metrics.join(i, keys, "left")
    status = F.when(F.col("instance_value").isNull(), "NOT_FOUND").when(F.col("instance_value") == F.col("value"), "MATCH").otherwise("MISMATCH")
    return x.withColumn("match_status", status)
