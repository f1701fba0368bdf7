import hashlib
import json
import threading

import pytest

from marlstone.functions import config as C
from marlstone.plans import gates as G
from marlstone.plans import verdict as V
from marlstone.sources import fetch as H
from marlstone.streaming import ingest

KEYS = "company string, metric_id string"


def status(df):
    return df.first().status


def test_matrix_and_coverage_gates(spark):
    want = spark.createDataFrame([("a", "B01"), ("a", "B02")], KEYS)
    ok = lambda rows: status(G.check(spark, "m", G.matrix_keys(spark.createDataFrame(rows, KEYS), want), want))
    assert ok([("a", "B01"), ("a", "B02")]) == "PASS"
    assert ok([("a", "B01")]) == ok([("a", "B01"), ("a", "B01")]) == ok([("a", "B01"), ("a", "B02"), ("a", "B03")]) == "FAIL"
    assert status(G.check(spark, "m", None)) == status(G.check(spark, "m", G.matrix_keys(want.limit(0), want.limit(0)), want.limit(0))) == "NOT_EVALUATED_MISSING_EVIDENCE"
    ev = spark.createDataFrame([("a", "B01")], KEYS)
    cover = lambda f: G.coverage_flags(spark.createDataFrame([("a", "B01", f), ("a", "B02", False)], KEYS + ", has_evidence boolean"), want, ev).count()
    assert cover(True) == 0 and cover(False) == 1


def test_numbers_need_matching_evidence(spark):
    m = "company string, metric_id string, value string, unit string, period_start string, period_end string, accession string, status string"
    e = "company string, metric_id string, value_normalized string, unit string, period_start string, period_end string, accession string, source_url string, concept_or_section string, extraction_method string"
    metric = spark.createDataFrame([("a", "B01", "5", "USD", None, "2025", "x", "OK"), ("a", "B02", None, "", None, None, None, "NOT_EXTRACTED")], m)
    good = ("a", "B01", "5", "USD", None, "2025", "x", "u", "c", "m")
    n = lambda row: G.numeric_evidence(metric, spark.createDataFrame([row], e)).count()
    assert n(good) == 0
    for i, v in ((2, "6"), (3, "pure"), (5, "2024"), (6, "y"), (7, ""), (8, None), (9, "")):
        assert n(good[:i] + (v,) + good[i + 1 :]) == 1


def test_event_ledger_locator_and_golden_gates(spark):
    ev = spark.createDataFrame([("a", "5.02"), ("a", "5.02"), ("a", "1.01")], "company string, item_code string")
    assert G.events_multiset(ev, ev, ev.columns).count() == 0 and G.events_multiset(ev.distinct(), ev, ev.columns).count() == 1
    rows = [("a", m, sum(i in items for i in ("5.02", "5.02", "1.01")), "8K_ITEM_OK" if set(items) & {"5.02", "1.01"} else "NOT_AVAILABLE_SEC") for m, items in C.EVENT_ITEMS.items()]
    out = lambda r: G.event_outputs(spark.createDataFrame(r, KEYS + ", value int, status string"), ev, C.EVENT_ITEMS).count()
    assert out(rows) == 0 and out([("a", "C01", 9, "8K_ITEM_OK"), *rows[1:]]) == 1
    sha = "a" * 64
    ledger = "source_url string, status_code int, content_sha256 string, repo_relative_path string"
    url = "https://www.sec.gov/Archives/edgar/data/1/x.htm"
    files = spark.createDataFrame([("p", sha)], "path string, sha256 string")
    bad = lambda *r: sorted(x.finding for x in G.ledger_rows(spark.createDataFrame(list(r), ledger), files).collect())
    assert bad((url, 200, sha, "p")) == []
    assert bad((url, 200, sha, "p"), (url, 200, "b" * 64, None), ("https://evil.com", 503, None, None)) == ["conflicting successful bodies", "not official"]
    assert bad((url, 200, "short", "q")) == ["body missing", "no digest"]
    b = spark.createDataFrame([(0, "x"), (1, "y")], "seq int, v string")
    grow = lambda r: G.ledger_prefix(b, spark.createDataFrame(r, "seq int, v string"), ["v"]).count()
    assert grow([(0, "x"), (1, "y"), (2, "z")]) == 0 and grow([(0, "x")]) == 1 and grow([(0, "y"), (1, "x")]) == 2
    loc = "company string, metric_id string, cik string, source_url string, accession string, document_name string"
    u = "https://www.sec.gov/Archives/edgar/data/11/000000001126000001/a.htm"
    where = lambda *r: sorted(x.finding for x in G.locator_errors(spark.createDataFrame([("a", "B01", *r)], loc)).collect())
    assert where("11", u, "0000000011-26-000001", "a.htm") == []
    assert where("12", u, "0000000011-26-000002", "b.htm") == ["accession_mismatch", "cik_mismatch", "document_mismatch"]
    assert where("11", f"{u};{u}", "0000000011-26-000001", "a.htm") == ["component_count_mismatch"] and where("11", "https://x.com", "", "") == ["non_sec"]
    want = spark.createDataFrame([("g1", "2.0", "0.1"), ("g2", "OK", "exact")], "assertion_id string, expected string, tolerance string")
    gold = lambda *r: G.golden(spark.createDataFrame(list(r), "assertion_id string, actual string"), want).count()
    assert gold(("g1", "2.05"), ("g2", "OK")) == 0 and gold(("g1", "2.2"), ("g2", "OK")) == 1 and gold(("g1", "2.0"), ("g1", "2.0")) == 2


def test_other_gates(spark):
    prev = spark.createDataFrame([("a", "B01"), ("a", "B02")], KEYS)
    now = spark.createDataFrame([("a", "B01", "OK", "STD_XBRL", "USD", "fine", "Revenues"), ("a", "B02", "BAD", "STD_XBRL", "USD", "TODO", "CapitalAdequacyMinimum")], KEYS + ", status string, source_class string, unit string, notes string, concept string")
    assert G.ratchet(now, prev).count() == G.vocabulary(now).count() == G.placeholder_notes(now).count() == G.thresholds_never_primary(now).count() == 1
    m = spark.createDataFrame([("a", "B12", "5", "DIM_XBRL")], KEYS + ", value string, source_class string")
    e = spark.createDataFrame([("a", "B12", "text_regex")], KEYS + ", extraction_method string")
    assert G.backlog_from_instance(m, e, spark.createDataFrame([("a", C.RPO)], "company string, concept string")).count() == 1
    assert G.backlog_from_instance(m, e, spark.createDataFrame([], "company string, concept string")).count() == 1
    rows = spark.createDataFrame([("a", f"B{i:02d}", "1", "STD_XBRL") for i in range(9)], KEYS + ", value string, source_class string")
    first = sorted(((hashlib.sha256(f"a|B{i:02d}".encode()).hexdigest(), "a", f"B{i:02d}") for i in range(9)))[:4]
    assert G.audit_sample(spark.createDataFrame([x[1:] for x in first], KEYS), rows, {"STD_XBRL": 4}).count() == 0
    assert G.audit_sample(spark.createDataFrame([x[1:] for x in first[1:]], KEYS), rows, {"STD_XBRL": 4}).count() == 1


def row(status, severity="critical", check_id="c"):
    return {"check_id": check_id, "severity": severity, "status": status, "details": ""}


def test_verdict_fails_closed():
    agg = row("PASS", check_id=V.AGGREGATE)
    full, light = "FULL_VALIDATION", "LIGHT_REVIEW_MODE"
    assert V.verdict([row("PASS"), agg], full) == ("GO", "PASSED")
    assert V.verdict([row("PASS"), agg], light) == ("GO WITH CAVEATS", "PASSED_WITH_CAVEATS")
    assert V.verdict([row("NOT_EVALUATED_MISSING_EVIDENCE"), agg], light)[0] == "GO WITH CAVEATS"
    for rows, mode, fresh in (([row("NOT_EVALUATED_MISSING_EVIDENCE"), agg], full, True), ([row("FAIL"), agg], light, True), ([row("PASS")], full, True), ([row("ODD"), agg], full, True), ([row("PASS"), agg], full, False), ([agg], "other", True)):
        assert V.verdict(rows, mode, fresh) == ("NO-GO", "FAILED")
    assert V.aggregate([row("PASS"), row("FAIL")], full)["status"] == "FAIL"
    m = V.manifest(full, "2026-01-01T00:00:00+00:00", ["a"], ["b"], ["a", "b"], "abc+dirty")
    assert V.manifest_errors(m) == [] and V.commit_base("abc+dirty") == "abc"
    assert V.manifest_errors(m | {"refreshed": ["a", "b"]}) and V.manifest_errors(m | {"started_at_utc": "2026-01-01T00:00:00+02:00"}) and V.manifest_errors(m | {"result": "PASSED"})
    text = V.injected("# Title\n", "n", "one")
    assert V.injected(text, "n", "one") == text and "two" in V.injected(text, "n", "two") and "one" not in V.injected(text, "n", "two")
    assert "NO-GO" in V.report("r", [row("FAIL"), agg], full)


CONFIG = {"user_agent": "test", "rate_limit_per_sec": 5, "max_retries": 4, "initial_backoff_sec": 1.0, "timeout_sec": 60}
URL = "https://data.sec.gov/submissions/CIK0000000011.json"


def test_client_retries_paces_and_records(tmp_path):
    answers = [(503, b"", {}), (429, b"", {}), (200, b"body", {"x": "y"})]
    slept, now = [], [0.0]
    client = H.Client(tmp_path, CONFIG, lambda *a: answers.pop(0), slept.append, lambda: now[0])
    got = client.fetch(URL, "test", "evidence/a.json")
    assert got.status == 200 and (tmp_path / "evidence/a.json").read_bytes() == b"body"
    assert [s for s in slept if s >= 1] == [1.0, 2.0] and [round(s, 3) for s in slept if s < 1] == [0.2, 0.2]
    assert len(list((tmp_path / "ledger").glob("part-*.csv"))) == 3
    assert (tmp_path / got.path).read_bytes() == b"body"
    for bad in ("http://data.sec.gov/x", "https://example.com/"):
        with pytest.raises(ValueError):
            client.fetch(bad, "test", "x")
    with pytest.raises(ValueError):
        client.fetch(URL, "test", "../x")

    def broken(*a):
        raise OSError("no route")

    assert H.Client(tmp_path, CONFIG, broken, slept.append, lambda: 0.0).fetch(URL, "test", "b").status == 0
    assert H.Client(tmp_path / "q", CONFIG, lambda *a: (404, b"none", {}), slept.append, lambda: 0.0).fetch(URL, "test", "c").status == 404


def test_ledger_only_grows(tmp_path):
    ledger = H.Ledger(tmp_path / "l")
    one = dict.fromkeys(H.FIELDS, "x")
    threads = [threading.Thread(target=ledger.append, args=([one],)) for _ in range(8)]
    [t.start() for t in threads], [t.join() for t in threads]
    assert len(ledger._parts()) == 8 and ledger.verify()
    for bad in ({"a": 1}, one | {"error": "a\nb"}):
        with pytest.raises(ValueError):
            ledger.append([bad])
    part = ledger._parts()[3]
    part.write_bytes(part.read_bytes().replace(b"x", b"y", 1))
    with pytest.raises(ValueError):
        ledger.append([one])
    assert H.write_immutable(tmp_path, "n", b"1") == H.write_immutable(tmp_path, "n", b"1")
    (tmp_path / "cfg.json").write_text(json.dumps(CONFIG))
    assert H.load_config(tmp_path / "cfg.json") == CONFIG
    (tmp_path / "cfg.json").write_text('{"user_agent": 1, "user_agent": 2}')
    with pytest.raises(ValueError):
        H.load_config(tmp_path / "cfg.json")


def test_stream_keeps_latest_and_drops_repeats(spark, tmp_path):
    (tmp_path / "in").mkdir()
    rows = [("2026-01-01T00:00:00", "u", 200, "a", 1), ("2026-01-01T00:10:00", "u", 503, None, 0), ("2026-01-01T00:20:00", "u", 200, "a", 1), ("2026-01-01T01:30:00", "u", 200, "b", 2), ("2026-01-01T00:05:00", "v", 200, "c", 3)]
    for i, part in enumerate((rows[:3], rows[3:])):
        (tmp_path / "in" / f"{i}.json").write_text("\n".join(json.dumps(dict(zip(("observed_at", "source_url", "status_code", "content_sha256", "content_length"), r, strict=True))) for r in part))
    stream = lambda: ingest.observations(spark, str(tmp_path / "in"), 1)
    q = ingest.keep_latest(stream(), str(tmp_path / "t"), str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    last = sorted((tmp_path / "t").glob("v=*"), key=lambda p: int(p.name[2:]))[-1]
    assert sorted((r.source_url, r.content_sha256) for r in spark.read.parquet(str(last)).collect()) == [("u", "b"), ("v", "c")]
    q = ingest.fresh(stream()).writeStream.format("memory").queryName("fresh").option("checkpointLocation", str(tmp_path / "c2")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert spark.table("fresh").count() == 4
    q = ingest.hourly(stream()).writeStream.format("memory").queryName("hourly").outputMode("complete").option("checkpointLocation", str(tmp_path / "c3")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert {(r.start.hour, r.status_code): r.n for r in spark.table("hourly").collect()} == {(0, 200): 3, (0, 503): 1, (1, 200): 1}
