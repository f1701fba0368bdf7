"""Documents of either kind, candidates of filings, ledgers started from older rows."""

import datetime
from decimal import Decimal

import pytest

from marlstone.operators import facts as A
from marlstone.plans import gates as G
from marlstone.sources import fetch, legacy, xbrl
from pyspark.sql import functions as F

HEAD = b'<html xmlns:ix="http://www.xbrl.org/2013/inlineXBRL" xmlns:dei="http://xbrl.sec.gov/dei/2025" xmlns:xbrli="http://www.xbrl.org/2003/instance" xmlns:xbrldi="http://xbrl.org/2006/xbrldi">'
CONTEXT = b'''<xbrli:context id="c1"><xbrli:entity><xbrli:segment><xbrldi:explicitMember dimension="a:B">a:C</xbrldi:explicitMember><xbrldi:typedMember dimension="a:T"><a:t xmlns:a="urn:a">7</a:t></xbrldi:typedMember></xbrli:segment></xbrli:entity>
<xbrli:period><xbrli:startDate>2025-01-01</xbrli:startDate><xbrli:endDate>2025-12-31</xbrli:endDate></xbrli:period></xbrli:context><xbrli:unit id="u"><xbrli:measure>iso4217:USD</xbrli:measure></xbrli:unit>'''
FACTS = b'<ix:nonFraction name="dei:Cash" contextRef="c1" unitRef="u" scale="6" format="ixt:numcommadecimal">294.804,5</ix:nonFraction><ix:nonNumeric name="dei:AuditorName" contextRef="c1">Fix%sture LLP</ix:nonNumeric>'
GOOD, LOOSE = HEAD + CONTEXT + FACTS % b"" + b"</html>", HEAD + b"<br>x & y" + CONTEXT + b"<p>" + FACTS % b"<b>" + b"<p></html>"


def test_loose_documents_give_the_facts_of_good_ones():
    assert xbrl.routed(LOOSE) == xbrl.routed(GOOD)
    cash, name = xbrl.routed(LOOSE)
    assert (cash["text"], cash["scale"], cash["unit"], dict(cash["dimensions"])) == ("294804.5", 6, "iso4217:USD", {"a:B": "a:C", "a:T": "7"})
    assert (name["concept"], name["namespace"], name["text"], name["period_end"]) == ("AuditorName", "http://xbrl.sec.gov/dei/2025", "Fixture LLP", "2025-12-31")


def test_what_is_neither_is_an_error(spark):
    with pytest.raises(ValueError, match="two namespaces"):
        xbrl.routed(LOOSE.replace(b"<br>", b'<br><i xmlns:dei="https://example.com/custom">'))
    files = spark.createDataFrame([("a", bytearray(LOOSE)), ("b", bytearray(b"<xbrl><open></xbrl>")), ("c", bytearray(b""))], "path string, content binary")
    rows = xbrl.instance_facts(files).collect()
    assert [r.value for r in rows if r.concept == "Cash"] == [Decimal("294804500000.000000")]
    assert sorted(r.path for r in rows if r.error) == ["b", "c"]


def test_text_goes_on_in_continuations():
    body = HEAD + CONTEXT + b'<ix:nonNumeric name="dei:Note" contextRef="c1" continuedAt="n1">one </ix:nonNumeric><ix:continuation id="n2">three</ix:continuation><ix:continuation id="n1" continuedAt="n2">two </ix:continuation></html>'
    assert [f["text"] for f in xbrl.routed(body)] == ["one two three"]


def test_candidates_take_amendments_first_and_stay_under_one_cik(spark):
    day = datetime.date
    rows = [("X", "1", "10-K", "o25", day(2025, 12, 31), day(2026, 2, 1)), ("X", "1", "10-K/A", "a25", day(2025, 12, 31), day(2026, 4, 1)), ("X", "1", "10-K", "o24", day(2024, 12, 31), day(2025, 2, 1)), ("X", "1", "8-K", "e", day(2025, 12, 31), day(2026, 2, 1)), ("X", "2", "10-K", "p", day(2023, 12, 31), day(2024, 2, 1)), ("X", "1", "10-K", "o25", day(2025, 12, 31), day(2026, 2, 1)), ("X", "1", "10-K", None, None, None)]
    inventory = spark.createDataFrame(rows, "company string, cik string, form string, accession string, reportDate date, filingDate date")
    found = {r.cik: (r.candidates, r.prior_candidates) for r in A.auditor_candidates(inventory).collect()}
    assert found == {"1": (["a25", "o25"], ["o24"]), "2": (["p"], [])}
    facts = spark.createDataFrame([("1", a, "AuditorName", xbrl_ns, t) for a, xbrl_ns, t in [("a25", "http://xbrl.sec.gov/dei/2025", "--"), ("o25", "http://xbrl.sec.gov/dei/2025", "Fixture LLP"), ("o24", "http://xbrl.sec.gov/dei/2024", "Fixture, L.L.P."), ("o24", "https://example.com/custom", "Other")]], "cik string, accession string, concept string, namespace string, text string")
    cells = spark.createDataFrame([("X", "C04", 0, "DIM_XBRL_OK")], "company string, metric_id string, value int, status string")
    own = inventory.where("cik = 1")
    names = A.auditors(facts.withColumn("company", F.lit("X")))
    assert A.auditor_change(A.auditor_candidates(own), names).first().value == 0
    assert [r.finding for r in G.auditor_cells(cells, own, facts).collect()] == ["inventory row lacks accession,reportDate"]
    whole = own.where("accession is not null")
    assert G.auditor_cells(cells, whole, facts).count() == 0
    assert [r.finding for r in G.auditor_cells(cells.limit(0), whole, facts).collect()] == ["no cell"]


def test_a_ledger_starts_from_older_rows_only_when_told(tmp_path):
    row = dict.fromkeys(fetch.FIELDS, "")
    old = list(legacy.OLD_FIELDS)
    ledger = fetch.Ledger(tmp_path / "l")
    with pytest.raises(PermissionError):
        legacy.bootstrap(ledger, old, [row])
    with pytest.raises(ValueError):
        legacy.bootstrap(ledger, ["a"], [row], authorized=True)
    with pytest.raises(FileNotFoundError):
        legacy.bootstrap(ledger, fetch.FIELDS, [row], authorized=True)
    first = legacy.bootstrap(ledger, old, [row], authorized=True)
    assert legacy.bootstrap(ledger, old, [row], authorized=True) == first and len(list(ledger.folder.glob("part-*.csv"))) == 1
    next(ledger.folder.glob("part-*.json")).unlink()
    with pytest.raises(FileNotFoundError):
        legacy.bootstrap(ledger, old, [row], authorized=True)
