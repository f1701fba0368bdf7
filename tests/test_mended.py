"""Cases that earlier versions got wrong."""

import http.client
from decimal import Decimal

from marlstone.operators import relational as R
from marlstone.sources import fetch, xbrl
from pyspark.sql import functions as F


def test_ratio_keeps_fractions_and_large_numbers(spark):
    rows = [("0.5", "0.25"), ("1", "3"), ("1", "0"), (None, "2"), ("123456789012345678", "2"), ("-7.5", "2.5")]
    df = spark.createDataFrame(rows, "a string, b string").select(R.ratio(F.col("a").cast("decimal(38,6)"), F.col("b").cast("decimal(38,6)")).alias("q"))
    assert [r.q for r in df.collect()] == [Decimal(2), Decimal("0.333333333333333333"), None, None, Decimal("61728394506172839"), Decimal(-3)]


def test_bands_take_the_lowest_and_shuffle_nothing(spark):
    rows = spark.createDataFrame([(1, 5.0), (2, 15.0), (3, 99.0), (4, None), (1, 5.0)], "id int, v double")
    bands = spark.createDataFrame([(0.0, 10.0, "b"), (0.0, 20.0, "a"), (12.0, 20.0, "c"), (None, 1.0, "x")], "lo double, hi double, name string")
    got = R.banded(rows, bands, "v", "lo", "hi", F.lit("none"), "name")
    assert sorted((r.id, r["name"]) for r in got.collect()) == [(1, "a"), (1, "a"), (2, "a"), (3, "none"), (4, "none")]
    assert {r["name"] for r in R.banded(rows, bands.limit(0), "v", "lo", "hi", F.lit("none"), "name").collect()} == {"none"}


def test_documents_with_named_characters_and_inner_namespaces():
    body = b'''<html xmlns="http://www.w3.org/1999/xhtml" xmlns:ix="http://www.xbrl.org/2013/inlineXBRL" xmlns:g="urn:g" xmlns:xbrli="http://www.xbrl.org/2003/instance">
      <p>a&nbsp;b &amp; c</p><svg xmlns="http://www.w3.org/2000/svg"/><xbrli:context id="c"><xbrli:period><xbrli:instant>2020-12-31</xbrli:instant></xbrli:period></xbrli:context>
      <ix:nonFraction name="g:Cash" contextRef="c" scale="3">1,234</ix:nonFraction>%s</html>'''
    facts = list(xbrl.parse(body % b""))
    assert [(f["concept"], f["namespace"], f["text"], f["period_end"]) for f in facts] == [("Cash", "urn:g", "1,234", "2020-12-31")]
    try:
        list(xbrl.parse(body % b'<i xmlns:g="urn:other"><ix:nonFraction name="g:Cash" contextRef="c">1</ix:nonFraction></i>'))
        raise AssertionError("a name of two meanings must not pass")
    except ValueError as e:
        assert "two namespaces" in str(e)


def test_a_broken_answer_is_recorded(tmp_path):
    def broken(url, agent, timeout):
        raise http.client.IncompleteRead(b"ab")

    config = {"rate_limit_per_sec": 1000, "max_retries": 0, "initial_backoff_sec": 0, "timeout_sec": 1, "user_agent": "a b@c.de"}
    client = fetch.Client(tmp_path, config, send=broken, sleep=lambda s: None)
    assert client.fetch("https://www.sec.gov/Archives/x.txt", "test", "x.txt").status == 0
