import json
from datetime import date
from decimal import Decimal

import pytest

from marlstone.functions import config as C
from marlstone.plans import build as B
from marlstone.plans import gates as G
from marlstone.plans import provenance as N
from marlstone.plans import verdict as V

DAY = date(2025, 12, 31)


@pytest.fixture(scope="module")
def landed(spark):
    companies = spark.createDataFrame([("bank", "0000000001", "financial_institution", "continuous", DAY, date(2024, 12, 31)), ("hotel", "0000000002", "lodging", "continuous", DAY, date(2024, 12, 31)), ("maker", "0000000003", "manufacturing", "continuous", DAY, date(2024, 12, 31))], "company string, cik string, profile string, entity_continuity_status string, fye date, prior_fye date")
    f = lambda cik, concept, val, start=date(2025, 1, 1), end=DAY: (cik, "us-gaap", concept, "USD", start, end, Decimal(val), "acc-1", 2025, "FY", "10-K", date(2026, 2, 1), None)
    facts = spark.createDataFrame([f("0000000002", "Revenues", 100), f("0000000002", "Revenues", 80, date(2024, 1, 1), date(2024, 12, 31)), f("0000000003", "StockholdersEquity", 50, None), f("0000000003", "LongTermDebt", 25, None)], "cik string, taxonomy string, concept string, unit string, start date, end date, val decimal(38,6), accn string, fy int, fp string, form string, filed date, frame string")
    axis = {"us-gaap:RiskWeightedAssetsCalculationMethodologyAxis": "x:StandardizedMember"}
    dei = "http://xbrl.sec.gov/dei/2025"
    g = lambda company, cik, concept, unit, dims, value, text=None: (company, cik, "acc-1", concept, dei, unit, DAY, dims, "c", None if value is None else Decimal(value), text)
    instance = spark.createDataFrame([g("bank", "0000000001", "TierOneRiskBasedCapitalToRiskWeightedAssets", "pure", axis, "0.12"), g("maker", "0000000003", "LongTermDebt", "USD", {"us-gaap:StatementBusinessSegmentsAxis": "x:CaptiveFinanceMember"}, "9"), g("hotel", "0000000002", "AuditorName", None, {}, None, "Fixture LLP")], "company string, cik string, accession string, concept string, namespace string, unit string, period_end date, dimensions map<string,string>, context string, value decimal(38,6), text string")
    events = spark.createDataFrame([("bank", "0000000001", "e1", "5.02"), ("bank", "0000000001", "e2", "5.02")], "company string, cik string, accession string, item_code string")
    text = "Risk Factors follow. Lodging Occupancy RevPAR Average Daily Rate Comparable Systemwide Properties Worldwide 70.0 % 1.0 % pts. $ 140.00 2.0 % $ 200.00 1.0 %"
    passages = spark.createDataFrame([("hotel", "0000000002", "acc-1", text)], "company string, cik string, accession string, text string")
    auditors = spark.createDataFrame([("hotel", "0000000002", ["acc-1"], ["acc-0"])], "company string, cik string, candidates array<string>, prior_candidates array<string>")
    return B.Landed(companies, facts, instance, events, passages, auditors)


def test_matrix_has_every_cell_once_and_passes_its_gates(spark, landed):
    cells = B.matrix(landed).cache()
    got = {(r.company, r.metric_id): r for r in cells.collect()}
    assert len(got) == cells.count() == 27 + 24 + 23
    assert float(got["hotel", "B01"].value) == 100 and float(got["hotel", "B02"].value) == 0.25 and float(got["hotel", "B11"].value) == 140 and got["hotel", "B10"].status == "MDA_OK"
    assert float(got["bank", "A01"].value) == 0.12 and got["bank", "B08"].status == "N_A_STRUCTURAL" and got["bank", "A02"].status == "NOT_EXTRACTED"
    assert int(got["bank", "C01"].value) == 2 and got["bank", "E02"].status == "NOT_AVAILABLE_SEC" and int(got["bank", "E02"].value) == 0
    assert got["maker", "B06"].status == "NEEDS_REVIEW" and got["maker", "B06"].value is None
    assert got["hotel", "C04"].status == "NEEDS_REVIEW" and got["hotel", "D01"].status == "TEXT_QUAL" and got["hotel", "D04"].status == "NOT_EXTRACTED"
    want = landed.companies.join(C.applicability(spark), "profile")
    rows = B.evidence(landed)
    checks = [G.check(spark, "keys", G.matrix_keys(cells, want), cells), G.check(spark, "words", G.vocabulary(cells), cells), G.check(spark, "events", G.event_outputs(cells, landed.events, C.EVENT_ITEMS), landed.events), G.check(spark, "coverage", G.coverage_flags(B.coverage_matrix(cells, rows), cells, rows), rows)]
    found = [r for c in checks for r in V.collected(c)]
    assert [r["status"] for r in found] == ["PASS"] * 4
    found.append(V.aggregate(found, "FULL_VALIDATION"))
    assert V.verdict(found, "FULL_VALIDATION") == ("GO", "PASSED")


def test_provenance(tmp_path):
    (tmp_path / "a").write_text("1"), (tmp_path / "out").write_text("2")
    assert N.package_mode(tmp_path, ["a", "out"], "m")[0] == "FULL_VALIDATION" and N.package_mode(tmp_path, ["zz"], "a") == ("LIGHT_REVIEW_MODE", ["zz"]) and N.package_mode(tmp_path, ["zz"], "m")[0] == "WORKSPACE_INCOMPLETE"
    called = []
    rows = N.run_gates({"x": (["a"], lambda: called.append(1) or {"check_id": "x", "status": "PASS"}), "y": (["b"], lambda: called.append(2))}, {"a"})
    assert called == [1] and rows[1]["status"] == "NOT_EVALUATED_MISSING_EVIDENCE"
    m = V.manifest("FULL_VALIDATION", "2026-01-01T00:00:00+00:00", ["out"], [], ["out"], "c") | {"result": "PASSED", "completed_at_utc": "2026-01-01T01:00:00+00:00"}
    N.publish(tmp_path, "snap.json", m, ["a"])
    assert N.verify(tmp_path, "snap.json", "c+dirty") == [] and N.verify(tmp_path, "snap.json", "d") == ["another commit"]
    (tmp_path / "a").write_text("3")
    assert N.verify(tmp_path, "snap.json") == ["changed: a"]
    N.fail(tmp_path, "snap.json", "broke")
    assert any("broke" in x for x in N.verify(tmp_path, "snap.json"))
    (tmp_path / "code.py").write_text("x = 'Ac' + 'me Corp'\ny = f'{1}00'\n")
    assert N.identity_literals(tmp_path, ["code.py"], ["acme", "other"]) == [("code.py", "acme")]
    assert N.policy(json.dumps({"tracked": ["a"], "excluded": ["b"]}))["tracked"] == ["a"]
    for bad in ('{"tracked": ["a"], "excluded": ["a"]}', '{"tracked": ["b", "a"], "excluded": []}', '{"tracked": []}', '{"tracked": [], "tracked": [], "excluded": []}'):
        with pytest.raises(ValueError):
            N.policy(bad)
