import json
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from marlstone.functions import config as C
from marlstone.functions import text as X
from marlstone.functions import urls as U
from marlstone.operators import events as E
from marlstone.operators import facts as A
from marlstone.operators import passages as P
from marlstone.operators import relational as R
from marlstone.sources import filings as S
from marlstone.sources.legacy import portable
from marlstone.sources.xbrl import instance_facts, is_dei


def fact(end, val, filed="2026-02-01", start=None, form="10-K", accn="0000000001-26-000001"):
    return {"end": end, "val": val, "accn": accn, "fy": 2025, "fp": "FY", "form": form, "filed": filed} | ({"start": start} if start else {})


@pytest.fixture(scope="module")
def facts(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("facts")
    year, before = ("2025-01-01", "2025-12-31"), ("2024-01-01", "2024-12-31")
    concepts = {
        "Revenues": [fact(year[1], 1000, start=year[0]), fact(year[1], 990, filed="2026-01-01", start=year[0]), fact(year[1], 300, start="2025-10-01"), fact(before[1], 800, start=before[0])],
        "SalesRevenueNet": [fact(year[1], 5, start=year[0])],
        "ProfitLoss": [fact(year[1], 70, start=year[0])],
        "OperatingIncomeLoss": [fact(year[1], 160, start=year[0])],
        "Depreciation": [fact(year[1], 30, start=year[0])],
        "AmortizationOfIntangibleAssets": [fact(year[1], 10, start=year[0])],
        "NetCashProvidedByUsedInOperatingActivities": [fact(year[1], 120, start=year[0])],
        "PaymentsToAcquireProductiveAssets": [fact(year[1], 45, start=year[0])],
        "InterestExpense": [fact(year[1], 40, start=year[0])],
        "AssetsCurrent": [fact(year[1], 2606860)],
        "LiabilitiesCurrent": [fact(year[1], 1262150)],
        "CashAndCashEquivalentsAtCarryingValue": [fact(year[1], 77), fact(year[1], 99, form="10-Q")],
        "StockholdersEquity": [fact(year[1], 200)],
        "LongTermDebtCurrent": [fact(year[1], 20)],
        "LongTermDebtNoncurrent": [fact(year[1], 80)],
        "CommercialPaper": [fact(year[1], 5)],
    }
    usd = lambda cs: {"us-gaap": {c: {"units": {"USD": obs}} for c, obs in cs.items()}}
    stub = {"Revenues": [fact(year[1], 50, start="2025-08-08")], "StockholdersEquity": [fact(year[1], -5)], "LongTermDebt": [fact(year[1], 10)], "OperatingIncomeLoss": [fact(year[1], -4, start=year[0])], "InterestExpense": [fact(year[1], 2, start=year[0])]}
    (folder / "a.json").write_text(json.dumps({"cik": 11, "entityName": "a", "facts": usd(concepts)}))
    (folder / "b.json").write_text(json.dumps({"cik": 22, "entityName": "b", "facts": usd(stub)}))
    return S.companyfacts(spark, str(folder))


def test_company_facts_to_standard_metrics(spark, facts):
    targets = spark.createDataFrame([("a", "0000000011", date(2025, 12, 31), date(2024, 12, 31)), ("b", "0000000022", date(2025, 12, 31), None)], "company string, cik string, fye date, prior_fye date")
    found = A.components(facts, targets, C.chains(spark))
    chosen = {(r.company, r.component, r.period_kind): (r.concept, int(r.value)) for r in found.collect()}
    assert chosen["a", "revenue", "current"] == ("Revenues", 1000) and chosen["a", "revenue", "prior"] == ("Revenues", 800)
    assert chosen["a", "net_income", "current"] == ("ProfitLoss", 70) and chosen["a", "cash", "current"][1] == 77
    got = {(r.company, r.metric_id): r for r in A.standard_metrics(found).collect()}
    value = lambda c, m: None if got[c, m].value is None else float(got[c, m].value)
    assert value("a", "B01") == 1000 and value("a", "B02") == 0.25 and value("a", "B03") == 0.2 and value("a", "B05") == 75
    assert value("a", "B06") == 0.525 and value("a", "B07") == 4.0 and str(got["a", "B08"].value) == "2.065412193479380422"
    assert got["a", "A10"].status == "NOT_AVAILABLE_SEC" and got["a", "A10"].value is None
    assert got["b", "B01"].status == "NOT_MEANINGFUL" and got["b", "B01"].value is None and got["b", "B01"].notes == "stub period"
    assert got["b", "B06"].status == "NOT_MEANINGFUL" and got["b", "B07"].status == "NOT_MEANINGFUL"
    companies = spark.createDataFrame([("a", "0000000011", "financial_institution", "continuous"), ("b", "0000000022", "media", "successor")], "company string, cik string, profile string, entity_continuity_status string")
    cells = A.applied(A.standard_metrics(found), companies, C.applicability(spark))
    status = {(r.company, r.metric_id): r.status for r in A.continuity(cells, companies).collect()}
    assert len(status) == 27 + 22 and status["a", "B08"] == "N_A_STRUCTURAL" and status["a", "A03"] == "NOT_EXTRACTED" and status["b", "B02"] == "NOT_MEANINGFUL"


def test_submissions_supplements_and_latest_10k(spark, tmp_path):
    row = lambda a, form, filed, report: {c: [""] for c in S.SUBMISSION_COLUMNS} | {"accessionNumber": [a], "form": [form], "filingDate": [filed], "reportDate": [report], "size": [1], "isXBRL": [1], "isInlineXBRL": [1]}
    both = {c: row("x-1", "10-K", "2026-02-01", "2025-12-31")[c] + row("x-2", "10-K/A", "2026-03-01", "2025-12-31")[c] for c in S.SUBMISSION_COLUMNS}
    base = {"cik": "11", "filings": {"recent": both, "files": [{"name": "CIK0000000011-submissions-001.json"}]}}
    (tmp_path / "base").mkdir(), (tmp_path / "more").mkdir()
    (tmp_path / "base" / "CIK0000000011.json").write_text(json.dumps(base))
    (tmp_path / "more" / "CIK0000000011-submissions-001.json").write_text(json.dumps(row("x-0", "10-K", "2025-02-01", "2024-12-31")))
    got = S.submissions(spark, str(tmp_path / "base"), str(tmp_path / "more")).withColumnRenamed("accessionNumber", "accession")
    assert sorted((r.cik, r.accession) for r in got.collect()) == [("0000000011", f"x-{i}") for i in range(3)]
    assert A.latest_10k(got, ["cik"]).first().accession == "x-2"
    assert S.supplement_names(json.dumps(base), 11) == ["CIK0000000011-submissions-001.json"]
    with pytest.raises(TypeError):
        S.supplement_names(None, 11)
    for bad in ("../x.json", "CIK0000000012-submissions-001.json", "CIK0000000011-submissions-001.json "):
        with pytest.raises(ValueError):
            S.supplement_names(json.dumps({"filings": {"files": [{"name": bad}]}}), 11)
    counts = spark.createDataFrame([("x-2",)] * 3, "accession string")
    targets = got.where("accession = 'x-2'").withColumn("company", F.lit("a"))
    hit = A.original_fallback(targets, counts, got).first()
    assert hit.original_accession == "x-1" and hit.reasons == ["target_is_amendment", "target_instance_fact_count_lt_500"]


HEADER = "<SEC-HEADER>\n<ACCESSION-NUMBER>0000000011-25-00000{n}\n<TYPE>8-K\n<PERIOD>20250204\n{items}<FILING-DATE>{day}\n<FILER>\n<CIK>0000000011\n"


def test_events_from_headers_with_fallback_windows_and_zeros(spark, tmp_path):
    texts = [("1", ["5.02", "9.01", "5.02"], "20250101"), ("2", ["1.01", "5.02"], "20251231"), ("3", ["1.03"], "20241231"), ("4", [], "20250601")]
    for n, items, day in texts:
        (tmp_path / f"{n}.hdr.sgml").write_text(HEADER.format(n=n, items="".join(f"<ITEMS>{i}\n" for i in items), day=day))
    head = S.headers(S.bytes_table(spark, str(tmp_path), "*.hdr.sgml")).withColumn("company", F.lit("a"))
    assert head.where("accession like '%1'").first()["items"] == ["5.02", "9.01"]
    windows = spark.createDataFrame([("a", "0000000011", date(2024, 12, 31), date(2025, 12, 31))], "company string, cik string, prior_report_date date, target_report_date date")
    inside = E.fiscal_window(head, windows)
    assert sorted(r.accession[-1] for r in inside.collect()) == ["1", "2", "4"]
    html = F.lit("<p>Item&nbsp;2.02 Results</p><script>Item 9.99</script> ITEM 9.01")
    rows = E.event_rows(inside.withColumnRenamed("items", "header_items").withColumn("primary_items", F.when(F.col("accession").endswith("4"), S.primary_items(html))))
    assert sorted((r.accession[-1], r.item_code, r.item_source) for r in rows.collect()) == [("1", "5.02", "hdr_sgml"), ("1", "9.01", "hdr_sgml"), ("2", "1.01", "hdr_sgml"), ("2", "5.02", "hdr_sgml"), ("4", "2.02", "primary_document"), ("4", "9.01", "primary_document")]
    companies = spark.createDataFrame([("a", "0000000011"), ("b", "0000000022")], "company string, cik string")
    m = {(r.company, r.metric_id): r for r in E.event_metrics(rows, companies).collect()}
    assert m["a", "C01"].value == 2 and m["a", "C01"].status == "8K_ITEM_OK" and m["a", "C01"].confidence == 0.9 and m["a", "E05"].value == 1
    assert m["a", "E02"].value == 0 and m["a", "E02"].status == "NOT_AVAILABLE_SEC" and m["b", "C01"].value == 0
    ev = E.event_evidence(rows, companies)
    assert ev.where("company = 'a' and metric_id = 'C01'").count() == 2 and ev.where("company = 'b'").count() == 6
    with pytest.raises(Exception, match="no items"):
        E.event_rows(inside.withColumnRenamed("items", "header_items").withColumn("primary_items", F.lit(None).cast("array<string>"))).collect()
    starts = spark.range(1).select(E.period_start(F.lit(date(2024, 9, 30)), F.lit(date(2025, 9, 30))).alias("x"), E.period_start(F.lit(None).cast("date"), F.lit(date(2025, 9, 30))).alias("y")).first()
    assert (starts.x, starts.y) == (date(2024, 10, 1), date(2025, 1, 1))


XML = """<html xmlns:ix="http://www.xbrl.org/2013/inlineXBRL" xmlns:x="http://www.xbrl.org/2003/instance" xmlns:di="http://xbrl.org/2006/xbrldi" xmlns:dei="{dei}" xmlns:own="http://own">
<x:context id="c"><x:entity><x:segment><di:explicitMember dimension="us:A">own:M</di:explicitMember></x:segment></x:entity><x:period><x:instant>2025-12-31</x:instant></x:period></x:context>
<x:unit id="u"><x:measure>iso4217:USD</x:measure></x:unit>
<ix:nonFraction name="own:Capital" contextRef="c" unitRef="u" scale="6">294,804</ix:nonFraction>
<ix:nonFraction name="own:Loss" contextRef="c" unitRef="u" scale="3" sign="-">1.5</ix:nonFraction>
<ix:nonNumeric name="dei:AuditorName" contextRef="c">Fixture, L.L.P.</ix:nonNumeric>{more}</html>"""


def test_inline_documents_scale_exactly_and_report_errors(spark):
    docs = [("a", XML.format(dei="http://xbrl.sec.gov/dei/2025", more="")), ("b", XML.format(dei="http://x", more='<p xmlns:own="http://other"/>')), ("c", "<broken"), ("d", '<x:xbrl xmlns:x="http://www.xbrl.org/2003/instance" xmlns:g="http://fasb.org/us-gaap/2025"><x:context id="d"><x:period><x:startDate>2025-01-01</x:startDate><x:endDate>2025-12-31</x:endDate></x:period></x:context><g:Revenues contextRef="d">(5)</g:Revenues><g:Assets contextRef="d">12.5</g:Assets></x:xbrl>')]
    got = instance_facts(spark.createDataFrame([(p, bytearray(t.encode())) for p, t in docs], "path string, content binary"))
    rows = {(r.path, r.concept): r for r in got.collect()}
    assert rows["a", "Capital"].value == Decimal("294804000000") and rows["a", "Capital"].dimensions == {"us:A": "own:M"} and rows["a", "Capital"].unit == "iso4217:USD"
    assert rows["a", "Loss"].value == Decimal("-1500") and rows["a", "Capital"].period_end == date(2025, 12, 31)
    assert "declared for two" in rows["b", None].error and rows["c", None].error and rows["d", "Assets"].value == Decimal("12.5")
    assert [r.c for r in got.where(is_dei(F.col("namespace"))).select(F.col("concept").alias("c")).collect()] == ["AuditorName"]
    scaled = spark.createDataFrame([("(1,234)", 3, None), ("5", -2, "-"), ("n/a", 0, None)], "t string, s int, g string").select(X.scaled_inline_value(F.col("t"), F.col("s"), F.col("g")).alias("v")).collect()
    assert [r.v for r in scaled] == [Decimal("-1234000"), Decimal("-0.05"), None]


def dim(*pairs):
    return dict(pairs)


def test_capital_ratios_debt_and_backlog(spark):
    axis, entity = ("us-gaap:RiskWeightedAssetsCalculationMethodologyAxis", "x:BaselIIIStandardizedMember"), ("dei:LegalEntityAxis", "x:BankMember")
    day, old = date(2025, 12, 31), date(2024, 12, 31)
    t1, cet1 = "TierOneRiskBasedCapitalToRiskWeightedAssets", "CommonEquityTierOneCapitalToRiskWeightedAssets"
    rows = [(t1, "pure", day, dim(axis), "0.123", "c1"), (cet1, "pure", day, dim(axis), "0.115", "c2"), ("CommonEquityTierOneRiskBasedCapitalRatioCapitalAdequacyMinimum", "pure", day, dim(axis), "0.070", "c3"), (t1, "pure", old, dim(axis), "0.999", "c4"), (cet1, "pure", day, dim(("us:SegmentAxis", "x:M")), "0.888", "c5"), (cet1, "pure", day, dim(axis, entity), "0.777", "c0")]
    rows += [("LongTermDebt", "USD", day, dim(("us-gaap:StatementBusinessSegmentsAxis", "x:CaptiveFinanceMember")), "9", "d1"), ("LongTermDebt", "USD", day, dim(("us-gaap:StatementBusinessSegmentsAxis", "x:FinanceLeaseMember")), "8", "d2"), ("DebtSecuritiesHeld", "USD", day, dim(("us-gaap:StatementBusinessSegmentsAxis", "x:CaptiveFinanceMember")), "7", "d3")]
    rows += [("xRevenueRemainingPerformanceObligation", "USD", day, {}, "5000000000", "r1"), ("RevenueRemainingPerformanceObligationPercentage", "USD", day, {}, "9000000000", "r2")]
    facts = spark.createDataFrame([("a", c, u, d, m, Decimal(v), x) for c, u, d, m, v, x in rows], "company string, concept string, unit string, period_end date, dimensions map<string,string>, value decimal(38,6), context string")
    got = {r.metric_id: (r.context, float(r.value)) for r in A.basel_ratios(facts, F.lit(day)).collect()}
    assert got == {"A01": ("c1", 0.123), "A02": ("c2", 0.115)}
    assert [r.context for r in A.basel_candidates(facts, F.lit(day)).where("candidate_role <> 'primary'").collect()] == ["c3"]
    assert [r.context for r in A.captive_debt(facts).collect()] == ["d1"]
    assert float(A.rpo(facts, F.lit(day)).first().value) == 5e9
    parts = spark.createDataFrame([("a", C.RPO + "Current", "USD", day, {}, Decimal(2_000_000_000), "x"), ("a", C.RPO + "Noncurrent", "USD", day, {}, Decimal(3_000_000_000), "y")], facts.schema)
    assert A.rpo(parts, F.lit(day)).first().formula == "current + noncurrent"
    pay = spark.createDataFrame([("a", "PeoTotalCompAmt", "USD", day, {}, Decimal(4), "x"), ("b", "PeoTotalCompAmt", "USD", day, {}, Decimal(4), "x"), ("b", "PeoTotalCompAmt", "USD", day, {}, Decimal(6), "y")], facts.schema)
    assert {r.company: (r.status, r.value) for r in A.compensation(pay, F.lit(day)).collect()} == {"a": ("DEF14A_OK", Decimal(4)), "b": ("NEEDS_REVIEW", None)}


def test_auditor_change(spark):
    dei = "http://xbrl.sec.gov/dei/2025"
    names = [("a", "1", "n", dei, "Fixture LLP"), ("a", "1", "p", dei, "Fixture, L.L.P."), ("b", "2", "n", dei, "New LLP"), ("b", "2", "p", dei, "Old LLP"), ("c", "3", "n", dei, "..."), ("c", "3", "p", dei, "Old LLP"), ("d", "4", "n", dei, "X"), ("d", "4", "n", dei, "Y"), ("d", "4", "p", "http://other", "X")]
    facts = spark.createDataFrame([(c, k, a, "AuditorName", ns, t) for c, k, a, ns, t in names], "company string, cik string, accession string, concept string, namespace string, text string")
    found = A.auditors(facts)
    assert found.where("finding is not null").first().company == "d"
    targets = spark.createDataFrame([(c, str(i + 1), ["amend", "n"], ["p"]) for i, c in enumerate("abcd")], "company string, cik string, candidates array<string>, prior_candidates array<string>")
    got = {r.company: (r.value, r.status, float(r.confidence)) for r in A.auditor_change(targets, found).collect()}
    assert got == {"a": (0, "DIM_XBRL_OK", 0.8), "b": (1, "NEEDS_REVIEW", 0.8), "c": (None, "NEEDS_REVIEW", 0.45), "d": (None, "NEEDS_REVIEW", 0.45)}


def test_text_extractors(spark):
    good = "Lodging Statistics Occupancy RevPAR Average Daily Rate 2025 vs. 2024 2025 vs. 2024 Comparable Systemwide Properties Worldwide 70.0 % 1.0 % pts. $ 140.00 2.0 % $ 200.00 1.0 %"
    first = "Statistics RevPAR Occupancy Average Daily Rate Comparable Systemwide Worldwide (2) $ 131.50 2.2 % 70.1 % 0.5 % pts. $ 187.59 1.4 %"
    docs = spark.createDataFrame([(1, good), (2, first), (3, "RevPAR increased 2.0% while occupancy fell"), (4, good.replace("140.00", "150.00"))], "id int, text string")
    got = {r.id: r for r in P.lodging(docs).collect()}
    assert (got[1].revpar, got[1].occupancy, got[1].adr) == (140.0, 70.0, 200.0) and got[1].scope.startswith("comparable")
    assert (got[2].revpar, got[2].occupancy, got[2].adr) == (131.5, 70.1, 187.59)
    assert got[3].revpar is None and got[4].revpar is None
    risk = P.risk_passages(spark.createDataFrame([(1, "<b>Risk Factors</b> are many. Legal proceedings: none.")], "id int, text string"))
    assert {r.metric_id: r.status for r in risk.collect()} == {"D01": "TEXT_QUAL", "D02": "TEXT_QUAL", "D03": "NOT_EXTRACTED", "D04": "NOT_EXTRACTED"}
    cap = P.capacity(spark.createDataFrame([("Our capacity utilization was about 87.5 % in 2025.",), ("no such thing",)], "text string")).collect()
    assert [r.utilization for r in cap] == [87.5, None]
    row = P.table_row(spark.createDataFrame([("Liquidity coverage (in millions) LCR average 113 and more",)], "text string"), "Liquidity coverage", "LCR average").first()
    assert row.value == 113 and row.raw_header == "Liquidity coverage"


def test_names_numbers_and_addresses(spark):
    row = spark.range(1).select(X.normalized_concept(F.lit("Tier-One Ratio")).alias("a"), X.canonical_name(F.lit("Fixture, L.L.P.")).alias("b"), X.blank_name(F.lit(" .- ")).alias("c"), X.accession_dashed(F.lit("000000001126000001")).alias("d"), X.cik10(F.lit(11)).alias("e"), X.dimensions(F.lit("a=b;c=d")).alias("f"), U.official_column(F.lit("https://www.sec.gov.evil.com/x")).alias("g"), U.official_column(F.lit("https://data.sec.gov/x")).alias("h"), U.document_column(F.lit(11), F.lit("0000000011-26-000001"), F.lit("a.htm")).alias("i")).first()
    assert tuple(row)[:8] == ("tier1ratio", "FIXTURELLP", True, "0000000011-26-000001", "0000000011", {"a": "b", "c": "d"}, False, True)
    assert row.i == U.document(11, "0000000011-26-000001", "a.htm") == "https://www.sec.gov/Archives/edgar/data/11/000000001126000001/a.htm"
    assert U.hdr_sgml(11, "000000001126000001").endswith("/0000000011-26-000001.hdr.sgml")
    for bad in ("http://www.sec.gov/x", "https://u@www.sec.gov/x", "https://www.sec.gov:443/x", "https://example.com"):
        with pytest.raises(ValueError):
            U.official(bad)
    for bad in (0, -1, "x", 10**10):
        with pytest.raises(ValueError):
            U.cik10(bad)


def test_registry_profiles_roles_and_legacy_rows(spark, tmp_path):
    (tmp_path / "r.csv").write_text('company_id,display_name,primary_cik,ticker,sic,sic_description,industry_profile,fiscal_year_end,target_period_policy,entity_continuity_status,related_ciks,roles\na,"A, Inc",11,A,7011,"x, y",lodging,0131,latest_10k,continuous,,primary:11;predecessor:22\nb,B,33,B,9999,,,1231,latest_10k,continuous,,primary:33\n')
    reg = S.csv_table(spark, str(tmp_path / "r.csv"), S.REGISTRY)
    assert reg.first().fiscal_year_end == "0131" and reg.where("company_id = 'b'").first().sic_description is None
    assert sorted(tuple(r) for r in S.roles(reg).collect()) == [("a", "predecessor", "0000000022"), ("a", "primary", "0000000011"), ("b", "primary", "0000000033")]
    rules = spark.createDataFrame([(7010, 7019, "lodging")], "sic_start int, sic_end int, profile string")
    assert {r.company_id: r.profile for r in S.profiles(reg, rules).collect()} == {"a": "lodging", "b": "default_non_fi"}
    assert S.profiles(reg, rules, {"b": "media"}).where("company_id = 'b'").first().profile == "media"
    (tmp_path / "bad.csv").write_text("company_id,display_name\na,b,c\n")
    with pytest.raises(Exception):
        S.csv_table(spark, str(tmp_path / "bad.csv"), "company_id string, display_name string").collect()
    old = spark.createDataFrame([("https://www.sec.gov/Archives/edgar/data/1/000000001126000001/a.htm", "/x/clone/evidence/a", "/x/clone/evidence/a.h", "AB", "")], "url string, local_path string, headers_path string, sha256 string, accession string")
    got = portable(old, ["/x/clone", "/y"]).first()
    assert (got.repo_relative_path, got.headers_repo_relative_path, got.content_sha256, got.accession) == ("evidence/a", "evidence/a.h", "ab", "0000000011-26-000001")


def test_relational_edges(spark):
    a = spark.createDataFrame([(1, "x"), (None, "y"), (2, None)], "k int, v string")
    b = spark.createDataFrame([(None, "y"), (2, None), (2, None), (3, "z")], "k int, v string")
    assert sorted(((r.k, r.finding) for r in R.exact_set_diff(a, b, ["k", "v"]).collect()), key=str) == sorted([(1, "missing"), (3, "unexpected"), (2, "duplicate")], key=str)
    assert [r.k for r in R.without_evidence(a, b, ["k", "v"]).collect()] == [1]
    t = spark.createDataFrame([("1.0", "1.05", "0.1"), ("a", "a", "exact"), ("1", None, "1"), ("x", "1", "1")], "e string, a string, t string")
    assert [r.ok for r in t.select(R.within_tolerance("e", "a", "t").alias("ok")).collect()] == [True, True, False, False]
    p = spark.createDataFrame([(["a", "b"], ["a"], ["b"]), (["a", "b"], ["a"], ["a", "b"]), (["a", "b"], ["a"], [])], "w array<string>, a array<string>, b array<string>")
    assert [r.ok for r in p.select(R.exact_partition("w", "a", "b").alias("ok")).collect()] == [True, False, False]
