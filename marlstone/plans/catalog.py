"""Named queries over the driver's tables, each with the SQL that checks it.

Every query applies an operator of the engine to an analogous shape of the synthetic tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import relational as R
from ..session import table

QUERIES: dict = {}
ORACLE_SQL: dict = {}


def query(sql: str | None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


@query("""
SELECT o_custkey, o_orderkey, o_orderpriority, CAST(o_orderdate AS DATE) AS o_orderdate FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority, o_orderdate DESC, o_orderkey) AS r FROM orders) WHERE r = 1
""")
def candidate_chain_select(spark: SparkSession, d: str) -> DataFrame:
    hit = R.first_hit(table(spark, d, "orders"), ["o_custkey"], [F.col("o_orderpriority"), F.col("o_orderdate").desc(), F.col("o_orderkey")])
    return hit.select("o_custkey", "o_orderkey", "o_orderpriority", F.to_date("o_orderdate").alias("o_orderdate"))


@query("""
SELECT o_custkey, max_by(o_orderkey, (o_orderdate, o_orderkey)) AS latest_order, CAST(max(o_orderdate) AS DATE) AS latest_date FROM orders GROUP BY o_custkey
""")
def latest_filed(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    return o.groupBy("o_custkey").agg(F.max_by("o_orderkey", F.struct("o_orderdate", "o_orderkey")).alias("latest_order"), F.to_date(F.max("o_orderdate")).alias("latest_date"))


@query("""
SELECT l_orderkey, l_linenumber, date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS days
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
WHERE date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) BETWEEN 30 AND 400
""")
def duration_window_filter(spark: SparkSession, d: str) -> DataFrame:
    l, o = table(spark, d, "lineitem"), table(spark, d, "orders")
    days = F.datediff(F.to_date("l_shipdate"), F.to_date("o_orderdate"))
    return l.join(o, F.col("l_orderkey") == F.col("o_orderkey")).select("l_orderkey", "l_linenumber", days.cast("long").alias("days")).where("days between 30 and 400")


@query("""
SELECT l_orderkey, l_linenumber,
  CASE WHEN date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) < 0 THEN 'NOT_EXTRACTED'
       WHEN date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) < 300 THEN 'NOT_MEANINGFUL' ELSE 'OK' END AS status
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
""")
def stub_period_status(spark: SparkSession, d: str) -> DataFrame:
    l, o = table(spark, d, "lineitem"), table(spark, d, "orders")
    days = F.datediff(F.to_date("l_shipdate"), F.to_date("o_orderdate"))
    status = F.when(days < 0, "NOT_EXTRACTED").when(days < 300, "NOT_MEANINGFUL").otherwise("OK")
    return l.join(o, F.col("l_orderkey") == F.col("o_orderkey")).select("l_orderkey", "l_linenumber", status.alias("status"))


@query("""
WITH c AS (SELECT c_nationkey AS k, CAST(sum(CAST(round(c_acctbal * 100) AS BIGINT)) AS BIGINT) AS num FROM customer GROUP BY 1),
     s AS (SELECT s_nationkey AS k, CAST(sum(CAST(round(s_acctbal * 100) AS BIGINT)) AS BIGINT) AS den FROM supplier GROUP BY 1)
SELECT n_nationkey, n_name, round(CASE WHEN den > 0 THEN CAST(num AS DOUBLE) / CAST(den AS DOUBLE) END, 6) AS value,
  CASE WHEN den IS NULL OR num IS NULL THEN 'NOT_AVAILABLE_SEC' WHEN den <= 0 THEN 'NOT_MEANINGFUL' ELSE 'OK' END AS status
FROM nation LEFT JOIN c ON c.k = n_nationkey LEFT JOIN s ON s.k = n_nationkey
""")
def derived_ratio_status(spark: SparkSession, d: str) -> DataFrame:
    cents = lambda c: F.sum(F.round(F.col(c) * 100).cast("long"))
    c = table(spark, d, "customer").groupBy(F.col("c_nationkey").alias("k")).agg(cents("c_acctbal").alias("num"))
    s = table(spark, d, "supplier").groupBy(F.col("s_nationkey").alias("k")).agg(cents("s_acctbal").alias("den"))
    n = table(spark, d, "nation").select("n_nationkey", "n_name", F.col("n_nationkey").alias("k"))
    status = F.when(F.col("den").isNull() | F.col("num").isNull(), "NOT_AVAILABLE_SEC").when(F.col("den") <= 0, "NOT_MEANINGFUL").otherwise("OK")
    value = F.when(F.col("den") > 0, R.ratio(F.col("num"), F.col("den")))
    return n.join(c, "k", "left").join(s, "k", "left").select("n_nationkey", "n_name", F.round(value.cast("double"), 6).alias("value"), status.alias("status"))


@query("""
WITH y AS (SELECT year(o_orderdate) AS y, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents FROM orders GROUP BY 1)
SELECT CAST(a.y AS INTEGER) AS fiscal_year, a.cents AS revenue_cents, round(CAST(a.cents - b.cents AS DOUBLE) / b.cents, 6) AS yoy FROM y a LEFT JOIN y b ON b.y = a.y - 1
""")
def yoy_growth(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").groupBy(F.year("o_orderdate").alias("fiscal_year")).agg(F.sum(F.round(F.col("o_totalprice") * 100).cast("long")).alias("revenue_cents"))
    before = o.select((F.col("fiscal_year") + 1).alias("fiscal_year"), F.col("revenue_cents").alias("p"))
    return o.join(before, "fiscal_year", "left").select("fiscal_year", "revenue_cents", F.round(R.growth(F.col("revenue_cents"), F.col("p")).cast("double"), 6).alias("yoy"))


@query("""
WITH bands(lo, hi, profile) AS (VALUES (-1000.0, 0.0, 'negative'), (0.01, 2500.0, 'low'), (2500.01, 7500.0, 'mid')),
     metrics(profile, metric_id) AS (VALUES ('negative', 'B01'), ('low', 'B01'), ('low', 'B02'), ('mid', 'B01'), ('mid', 'B02'), ('mid', 'B03'), ('default', 'B01'))
SELECT c_custkey, coalesce(b.profile, 'default') AS profile, m.metric_id FROM customer
LEFT JOIN bands b ON c_acctbal BETWEEN lo AND hi JOIN metrics m ON m.profile = coalesce(b.profile, 'default')
""")
def applicability_cross(spark: SparkSession, d: str) -> DataFrame:
    bands = spark.sql("select * from values (-1000.0D, 0.0D, 'negative'), (0.01D, 2500.0D, 'low'), (2500.01D, 7500.0D, 'mid') as t(lo, hi, profile)")
    metrics = spark.sql("select * from values ('negative', 'B01'), ('low', 'B01'), ('low', 'B02'), ('mid', 'B01'), ('mid', 'B02'), ('mid', 'B03'), ('default', 'B01') as t(profile, metric_id)")
    rows = R.banded(table(spark, d, "customer").select("c_custkey", "c_acctbal"), bands, "c_acctbal", "lo", "hi", F.lit("default"), "profile")
    return rows.join(R.small(metrics), "profile").select("c_custkey", "profile", "metric_id")


@query("""
WITH e AS (SELECT DISTINCT c_nationkey AS k FROM customer), a AS (SELECT s_nationkey AS k FROM supplier), c AS (SELECT k, count(*) AS n FROM a GROUP BY k)
SELECT CAST(e.k AS INTEGER) AS nationkey, 'missing' AS finding, CAST(0 AS BIGINT) AS n FROM e WHERE e.k NOT IN (SELECT k FROM a)
UNION ALL SELECT k, 'unexpected', n FROM c WHERE k NOT IN (SELECT k FROM e)
UNION ALL SELECT k, 'duplicate', n FROM c WHERE n > 1
""")
def exact_set_diff(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "customer").select(F.col("c_nationkey").alias("nationkey")).distinct()
    return R.exact_set_diff(e, table(spark, d, "supplier").select(F.col("s_nationkey").alias("nationkey")), ["nationkey"])


@query("""
SELECT k AS item, CAST(sum(d) AS BIGINT) AS surplus FROM (
  SELECT l_returnflag || l_linestatus AS k, -1 AS d FROM lineitem WHERE l_linenumber = 1
  UNION ALL SELECT l_returnflag || l_linestatus, 1 FROM lineitem WHERE l_linenumber = 2) GROUP BY k HAVING sum(d) <> 0
""")
def multiset_diff(spark: SparkSession, d: str) -> DataFrame:
    l = table(spark, d, "lineitem").select("l_linenumber", F.concat("l_returnflag", "l_linestatus").alias("item"))
    return R.multiset_diff(l.where("l_linenumber = 1"), l.where("l_linenumber = 2"), ["item"])


@query("""
SELECT u.user_id, t.event_type, count(e.event_id) AS n FROM (SELECT DISTINCT user_id FROM events) u
CROSS JOIN (SELECT unnest(['view', 'click', 'signup', 'purchase', 'error']) AS event_type) t
LEFT JOIN events e ON e.user_id = u.user_id AND e.event_type = t.event_type GROUP BY 1, 2
""")
def evidenced_zero_counts(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select("user_id", "event_type")
    kinds = F.explode(F.array(*[F.lit(x) for x in ("view", "click", "signup", "purchase", "error")])).alias("event_type")
    return R.zero_filled_counts(e.select("user_id").distinct().select("user_id", kinds), e, ["user_id", "event_type"])


@query("""
WITH w AS (SELECT user_id, min(ts) AS prior_at, max(ts) AS target_at FROM events WHERE event_type = 'signup' GROUP BY 1)
SELECT e.user_id, e.event_type, count(*) AS n FROM events e JOIN w USING (user_id) WHERE e.ts > prior_at AND e.ts <= target_at GROUP BY 1, 2
""")
def fiscal_window_events(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select("user_id", "event_type", "ts")
    w = e.where("event_type = 'signup'").groupBy("user_id").agg(F.min("ts").alias("prior_at"), F.max("ts").alias("target_at"))
    return R.in_window(e, w, ["user_id"], "ts", "prior_at", "target_at").groupBy("user_id", "event_type").agg(F.count("*").alias("n"))


@query("SELECT o_custkey, string_agg(CAST(o_orderkey AS VARCHAR), ';' ORDER BY o_orderdate, o_orderkey) AS joined FROM orders GROUP BY o_custkey")
def ordered_concat(spark: SparkSession, d: str) -> DataFrame:
    return R.ordered_concat(table(spark, d, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"], "o_orderkey")


@query("""
SELECT k AS l_returnflag, string_agg(s, ';' ORDER BY s, m) AS l_linestatus_list, string_agg(CAST(m AS VARCHAR), ';' ORDER BY s, m) AS l_linenumber_list
FROM (SELECT DISTINCT l_returnflag AS k, l_linestatus AS s, l_linenumber AS m FROM lineitem) GROUP BY k
""")
def distinct_locator_pairs(spark: SparkSession, d: str) -> DataFrame:
    return R.distinct_pairs(table(spark, d, "lineitem"), ["l_returnflag"], "l_linestatus", "l_linenumber")


@query("SELECT doc_id, doc_id IN (SELECT doc_id FROM labels) AS has_evidence FROM documents")
def coverage_join(spark: SparkSession, d: str) -> DataFrame:
    return R.coverage(table(spark, d, "documents").select("doc_id"), table(spark, d, "labels"), ["doc_id"])


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')")
def evidence_anti(spark: SparkSession, d: str) -> DataFrame:
    l = table(spark, d, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return R.without_evidence(table(spark, d, "orders").select("o_orderkey", "o_orderstatus"), l, ["o_orderkey"])


@query("SELECT p_partkey FROM part WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_quantity >= 49)")
def observed_identity_semi(spark: SparkSession, d: str) -> DataFrame:
    l = table(spark, d, "lineitem").where("l_quantity >= 49").select(F.col("l_partkey").alias("p_partkey"))
    return table(spark, d, "part").select("p_partkey").join(l, "p_partkey", "left_semi")


@query("""
SELECT user_id, event_id, event_type FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events WHERE event_type <> 'error') WHERE r = 1
""")
def latest_success(spark: SparkSession, d: str) -> DataFrame:
    ok = table(spark, d, "events").where("event_type <> 'error'")
    hit = ok.groupBy("user_id").agg(F.max_by(F.struct("event_id", "event_type"), F.struct("ts", "event_id")).alias("x"))
    return hit.select("user_id", "x.event_id", "x.event_type")


@query("""
SELECT user_id, event_id, event_type FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY CASE WHEN value > 50 THEN 1 ELSE 0 END DESC, ts DESC, event_id DESC) AS r FROM events) WHERE r = 1
""")
def material_upsert(spark: SparkSession, d: str) -> DataFrame:
    order = [F.when(F.col("value") > 50, 1).otherwise(0).desc(), F.col("ts").desc(), F.col("event_id").desc()]
    return R.first_hit(table(spark, d, "events"), ["user_id", "event_type"], order).select("user_id", "event_id", "event_type")


@query("""
SELECT k AS prefix, count(DISTINCT sha256(text)) AS n_values FROM (SELECT lower(substr(text, 1, 12)) AS k, text FROM documents WHERE text IS NOT NULL) GROUP BY k HAVING count(DISTINCT sha256(text)) > 1
""")
def conflict_detect(spark: SparkSession, d: str) -> DataFrame:
    x = table(spark, d, "documents").where("text is not null").select(F.lower(F.substring("text", 1, 12)).alias("prefix"), "text")
    return R.conflicts(x, ["prefix"], F.sha2("text", 256))


@query("""
SELECT c_mktsegment, c_custkey, CAST(r AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY c_mktsegment ORDER BY sha256(CAST(c_custkey AS VARCHAR)), c_custkey) AS r FROM customer) WHERE r <= 4
""")
def stratified_sample(spark: SparkSession, d: str) -> DataFrame:
    order = [F.sha2(F.col("c_custkey").cast("string"), 256), F.col("c_custkey")]
    return R.top_n(table(spark, d, "customer").select("c_mktsegment", "c_custkey"), ["c_mktsegment"], order, 4)


@query("""
WITH b AS (SELECT l_orderkey AS k, l_linenumber AS p, l_partkey AS x FROM lineitem WHERE l_linenumber <= 4),
     h AS (SELECT l_orderkey AS k, l_linenumber AS p, CASE WHEN l_partkey % 97 = 0 THEN -1 ELSE l_partkey END AS x FROM lineitem WHERE l_partkey % 89 <> 0)
SELECT b.k * 10 + b.p AS position, CASE WHEN h.k IS NULL THEN 'removed' ELSE 'changed' END AS finding FROM (SELECT k, p, max(x) AS x FROM b GROUP BY 1, 2) b
LEFT JOIN (SELECT k, p, max(x) AS x FROM h GROUP BY 1, 2) h ON h.k = b.k AND h.p = b.p WHERE h.k IS NULL OR h.x <> b.x
""")
def prefix_check(spark: SparkSession, d: str) -> DataFrame:
    l = table(spark, d, "lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("position"), "l_linenumber", "l_partkey")
    b = l.where("l_linenumber <= 4").groupBy("position").agg(F.max("l_partkey").alias("x"))
    h = l.where("l_partkey % 89 <> 0").groupBy("position").agg(F.max(F.expr("case when l_partkey % 97 = 0 then -1 else l_partkey end")).alias("x"))
    return R.ordered_prefix(b, h, "position", ["x"])


@query("""
SELECT source, sha256(string_agg(line, '' ORDER BY line)) AS digest, count(*) AS n FROM (
  SELECT source, CAST(doc_id AS VARCHAR) || chr(0) || CAST(n_chars AS VARCHAR) || chr(0) || sha256(text) || chr(10) AS line FROM documents) GROUP BY source
""")
def tree_digest(spark: SparkSession, d: str) -> DataFrame:
    return R.tree_digest(table(spark, d, "documents").withColumn("sha", F.sha2("text", 256)), ["source"], ["doc_id", "n_chars", "sha"])


@query(r"""
SELECT doc_id, item, CAST(pos AS INTEGER) AS pos FROM (
  SELECT doc_id, unnest(items) AS item, unnest(range(len(items))) AS pos FROM (
    SELECT doc_id, regexp_extract_all(text, '[0-9]\.[0-9]{1,2}') AS items FROM documents) WHERE len(items) > 0)
""")
def item_extract(spark: SparkSession, d: str) -> DataFrame:
    x = table(spark, d, "documents").select("doc_id", F.regexp_extract_all("text", F.lit(r"([0-9]\.[0-9]{1,2})")).alias("items"))
    return x.select("doc_id", F.posexplode("items").alias("pos", "item")).select("doc_id", "item", "pos")


@query(r"""
SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title, CAST(len(regexp_extract_all(html, '<a [^>]*href=')) AS INTEGER) AS n_links FROM pages
""")
def html_tag_extract(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select("page_id", F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"), F.size(F.regexp_extract_all("html", F.lit("(<a [^>]*href=)"))).alias("n_links"))


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def json_scalar(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select("event_id", F.from_json("props", "k bigint")["k"].alias("k"))


@query("SELECT vec_id, CAST(i - 1 AS INTEGER) AS pos, CAST(embedding[i] AS DOUBLE) AS x FROM embeddings, unnest(range(1, len(embedding) + 1)) AS t(i)")
def array_explode(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "embeddings").select("vec_id", F.posexplode("embedding").alias("pos", "x")).select("vec_id", "pos", F.col("x").cast("double").alias("x"))


@query("SELECT p_partkey, regexp_replace(lower(p_name), '[^a-z0-9]', '', 'g') AS normalized, upper(regexp_replace(p_brand, '[^A-Za-z0-9]', '', 'g')) AS canonical FROM part")
def normalize_name(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select("p_partkey", T.normalized_concept(F.col("p_name"), ordinals=False).alias("normalized"), T.canonical_name(F.col("p_brand")).alias("canonical"))


@query("""
WITH p(a, b, c) AS (VALUES (1, 2, 3), (1, 3, 2), (2, 1, 3), (2, 3, 1), (3, 1, 2), (3, 2, 1)),
x AS (SELECT p_partkey, a, b, c, [CAST(p_size AS DOUBLE), p_retailprice, round(p_size * p_retailprice / 100, 2)] AS v FROM part, p),
e AS (SELECT p_partkey, a, b, c, CASE WHEN v[c] > 0 THEN abs(v[c] - v[b] * v[a] / 100) / v[c] END AS err FROM x)
SELECT p_partkey, CAST(a AS INTEGER) AS a, CAST(b AS INTEGER) AS b, CAST(c AS INTEGER) AS c, round(err, 6) AS err FROM (SELECT *, row_number() OVER (PARTITION BY p_partkey ORDER BY err NULLS LAST, a, b, c) AS r FROM e) WHERE r = 1
""")
def identity_argmin(spark: SparkSession, d: str) -> DataFrame:
    v = F.array(F.col("p_size").cast("double"), F.col("p_retailprice"), F.round(F.col("p_size") * F.col("p_retailprice") / 100, 2))
    best = T.best_identity("v")
    return table(spark, d, "part").select("p_partkey", v.alias("v")).select("p_partkey", best.alias("x")).select("p_partkey", (F.col("x.a") + 1).alias("a"), (F.col("x.b") + 1).alias("b"), (F.col("x.c") + 1).alias("c"), F.round("x.err", 6).alias("err"))


@query("""
WITH a AS (SELECT l_orderkey AS k, CAST(sum(CAST(round(l_extendedprice * (1 - l_discount) * (1 + l_tax)) AS BIGINT)) AS BIGINT) AS actual FROM lineitem GROUP BY 1)
SELECT o_orderkey, abs(CAST(round(o_totalprice) AS BIGINT) - actual) <= 5000 AS within FROM orders JOIN a ON k = o_orderkey
""")
def tolerance_compare(spark: SparkSession, d: str) -> DataFrame:
    price = F.round(F.expr("l_extendedprice * (1 - l_discount) * (1 + l_tax)")).cast("long")
    a = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sum(price).cast("string").alias("actual"))
    o = table(spark, d, "orders").select("o_orderkey", F.round("o_totalprice").cast("long").cast("string").alias("expected"), F.lit("5000").alias("tolerance"))
    return o.join(a, "o_orderkey").select("o_orderkey", R.within_tolerance("expected", "actual", "tolerance").alias("within"))


@query("SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY ROLLUP (o_orderstatus, o_orderpriority)")
def status_mix_rollup(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").rollup("o_orderstatus", "o_orderpriority").agg(F.count("*").alias("n"))


@query("""
SELECT 'A' AS family, CAST(c_custkey AS BIGINT) AS id, c_name AS name FROM customer UNION ALL SELECT 'B', s_suppkey, s_name FROM supplier UNION ALL SELECT 'C', p_partkey, p_name FROM part
""")
def union_families(spark: SparkSession, d: str) -> DataFrame:
    part = lambda t, f, k, n: table(spark, d, t).select(F.lit(f).alias("family"), F.col(k).alias("id"), F.col(n).alias("name"))
    return part("customer", "A", "c_custkey", "c_name").unionByName(part("supplier", "B", "s_suppkey", "s_name")).unionByName(part("part", "C", "p_partkey", "p_name"))


@query("""
SELECT o_orderpriority, CASE max(CASE o_orderstatus WHEN 'F' THEN 2 WHEN 'P' THEN 1 ELSE 0 END) WHEN 2 THEN 'FAIL' WHEN 1 THEN 'NOT_EVALUATED_MISSING_EVIDENCE' ELSE 'PASS' END AS verdict,
  bool_or(o_orderstatus = 'F') AS any_fail, count(*) AS n FROM orders GROUP BY 1
""")
def verdict_fold(spark: SparkSession, d: str) -> DataFrame:
    rank = F.expr("case o_orderstatus when 'F' then 2 when 'P' then 1 else 0 end")
    worst = F.max(rank)
    verdict = F.when(worst == 2, "FAIL").when(worst == 1, "NOT_EVALUATED_MISSING_EVIDENCE").otherwise("PASS")
    return table(spark, d, "orders").groupBy("o_orderpriority").agg(verdict.alias("verdict"), F.bool_or(F.col("o_orderstatus") == "F").alias("any_fail"), F.count("*").alias("n"))


@query("""
SELECT l_partkey, CAST(sum(CASE WHEN l_linenumber <= 2 THEN l_quantity END) AS BIGINT) AS current_part, CAST(sum(CASE WHEN l_linenumber > 2 THEN l_quantity END) AS BIGINT) AS noncurrent_part,
  CAST(coalesce(sum(CASE WHEN l_linenumber = 7 THEN l_quantity END), sum(CASE WHEN l_linenumber <= 2 THEN l_quantity END) + coalesce(sum(CASE WHEN l_linenumber > 2 THEN l_quantity END), 0)) AS BIGINT) AS total
FROM lineitem GROUP BY 1
""")
def component_sums(spark: SparkSession, d: str) -> DataFrame:
    part = lambda c: F.sum(F.when(F.expr(c), F.col("l_quantity")))
    l = table(spark, d, "lineitem").groupBy("l_partkey").agg(part("l_linenumber <= 2").alias("c"), part("l_linenumber > 2").alias("m"), part("l_linenumber = 7").alias("t"))
    total = F.coalesce("t", F.col("c") + F.coalesce("m", F.lit(0)))
    return l.select("l_partkey", F.col("c").cast("long").alias("current_part"), F.col("m").cast("long").alias("noncurrent_part"), total.cast("long").alias("total"))


@query("""
SELECT DISTINCT c_nationkey, c_mktsegment FROM customer
""")
def content_dedup(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").select("c_nationkey", "c_mktsegment").dropDuplicates()


@query("""
WITH s AS (SELECT c_nationkey AS k, list_sort(list(DISTINCT c_mktsegment)) AS w FROM customer GROUP BY 1)
SELECT k AS nationkey, list_filter(w, lambda x: x < 'F') || list_filter(w, lambda x: x >= 'F') = w AS is_partition, len(w) AS n FROM s
""")
def exact_partition(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "customer").groupBy(F.col("c_nationkey").alias("nationkey")).agg(F.array_sort(F.collect_set("c_mktsegment")).alias("w"))
    s = s.withColumns({"a": F.filter("w", lambda x: x < "F"), "b": F.filter("w", lambda x: x >= "F")})
    return s.select("nationkey", R.exact_partition("w", "a", "b").alias("is_partition"), F.size("w").cast("long").alias("n"))


@query("""
SELECT a.n_nationkey, a.n_regionkey, b.n_nationkey AS partner FROM nation a JOIN nation b ON b.n_regionkey = a.n_regionkey AND b.n_nationkey = (SELECT min(n_nationkey) FROM nation c WHERE c.n_regionkey = a.n_regionkey)
""")
def original_of_amendment(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "nation").select("n_nationkey", "n_regionkey")
    return n.join(n.groupBy("n_regionkey").agg(F.min("n_nationkey").alias("partner")), "n_regionkey").select("n_nationkey", "n_regionkey", "partner")


@query("""
SELECT l_returnflag, l_linestatus, CAST(sum(l_quantity) AS BIGINT) AS sum_qty, CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS sum_cents, count(*) AS n
FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY 1, 2
""")
def source_mix_counts(spark: SparkSession, d: str) -> DataFrame:
    l = table(spark, d, "lineitem").where("l_shipdate <= timestamp_ntz '1998-09-02'")
    return l.groupBy("l_returnflag", "l_linestatus").agg(F.sum("l_quantity").cast("long").alias("sum_qty"), F.sum(F.round(F.col("l_extendedprice") * 100).cast("long")).alias("sum_cents"), F.count("*").alias("n"))


@query("""
SELECT 'doc' || (o_orderkey % 50) AS path, 'Price' AS concept, 'iso4217:USD' AS unit, CAST(o_orderdate AS DATE) AS period_end, 'Order=' || o_orderkey AS member, CAST(round(o_totalprice) AS BIGINT) * 1000 AS value FROM orders
""")
def parse_xbrl(spark: SparkSession, d: str) -> DataFrame:
    """Inline documents made of the orders, 50 of them, parsed to facts again."""
    from ..sources.xbrl import instance_facts

    o = table(spark, d, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("day"), F.round("o_totalprice").cast("long").alias("v"), F.concat(F.lit("doc"), F.col("o_orderkey") % 50).alias("path"))
    context = F.format_string('<x:context id="c%d"><x:entity><x:segment><d:explicitMember dimension="Order">%d</d:explicitMember></x:segment></x:entity><x:period><x:instant>%s</x:instant></x:period></x:context><ix:nonFraction name="own:Price" contextRef="c%d" unitRef="u" scale="3">%d</ix:nonFraction>', "o_orderkey", "o_orderkey", F.col("day").cast("string"), "o_orderkey", "v")
    head = '<html xmlns:ix="http://www.xbrl.org/2013/inlineXBRL" xmlns:x="http://www.xbrl.org/2003/instance" xmlns:d="http://xbrl.org/2006/xbrldi" xmlns:own="http://own"><x:unit id="u"><x:measure>iso4217:USD</x:measure></x:unit>'
    docs = o.groupBy("path").agg(F.array_join(F.collect_list(context), "").alias("t")).select("path", F.concat(F.lit(head), "t", F.lit("</html>")).cast("binary").alias("content"))
    return instance_facts(docs).select("path", "concept", "unit", "period_end", F.concat(F.lit("Order="), F.col("dimensions")["Order"]).alias("member"), F.col("value").cast("long").alias("value"))
