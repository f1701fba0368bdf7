"""Metrics read from text: lodging tables, risk and legal passages, capacity and bank table rows."""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import config as C
from ..functions import text as X

HEADERS = {"revpar": r"revpar", "occupancy": r"occupancy", "adr": r"average daily rate|\badr\b"}
LEAST_ERROR = 0.05


def lodging(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with revpar, occupancy, adr, identity_error, scope and quote of the lodging table in the text, null
    where there is none. Column order comes from the headers' places, with the other orders behind it; values
    alternate with changes; RevPAR = ADR * occupancy / 100 within 5 % and the bands of size decide."""
    low = F.lower(X.plain_text(F.col(text)))
    df = docs.withColumn("_low", low).withColumns({f"_at_{k}": F.regexp_instr("_low", F.lit(p)) for k, p in HEADERS.items()})
    order = F.array_sort(F.array(*[F.struct(F.col(f"_at_{k}").alias("at"), F.lit(k).alias("k")) for k in HEADERS]))
    df = df.withColumn("_order", F.transform(order, lambda x: x["k"]))
    rows = F.array(*[F.struct(F.lit(i).alias("rank"), F.lit(s).alias("scope"), F.regexp_extract("_low", s.replace(" ", r"[^a-z0-9]+(?:properties[^a-z0-9]+)?") + r"(?:[^a-z0-9]+properties)?(?:[^a-z0-9]+(?:worldwide))?(?:\s*\([0-9]+\))?((?:[^a-z]|pts?|usd){10,200})", 1).alias("row")) for i, s in enumerate(C.LODGING_SCOPES)])
    df = df.withColumn("_rows", F.filter(rows, lambda r: r["row"] != ""))
    values = lambda r: F.slice(X.every_other(X.numbers_in(r["row"])), 1, 3)

    def reading(r: Column, p: tuple[str, ...], rank: Column) -> Column:
        v = values(r)
        get = {k: F.get(v, F.lit(i)) for i, k in enumerate(p)}
        err = F.abs(get["revpar"] - get["adr"] * get["occupancy"] / 100) / get["revpar"]
        ok = (err <= LEAST_ERROR) & get["revpar"].between(*C.REVPAR_USD) & get["occupancy"].between(*C.OCCUPANCY_PERCENT)
        return F.when(F.coalesce(ok, F.lit(False)), F.struct(r["rank"].alias("scope_rank"), rank.alias("order_rank"), err.alias("identity_error"), get["revpar"].alias("revpar"), get["occupancy"].alias("occupancy"), get["adr"].alias("adr"), r["scope"].alias("scope"), r["row"].alias("quote")))

    orders = list(permutations(HEADERS))
    readings = F.flatten(F.transform("_rows", lambda r: F.array(*[reading(r, p, F.when(F.col("_order") == F.array(*[F.lit(x) for x in p]), 0).otherwise(1)) for p in orders])))
    best = F.array_min(F.transform(F.array_compact(readings), lambda x: F.struct(x["scope_rank"].alias("s"), x["identity_error"].alias("e"), x["order_rank"].alias("o"), x.alias("x"))))
    df = df.withColumn("_best", F.when(F.col("_at_revpar") > 0, best["x"]))
    return df.select(*docs.columns, *[F.col(f"_best.{c}").alias(c) for c in ("revpar", "occupancy", "adr", "identity_error", "scope", "quote")])


def risk_passages(docs: DataFrame, text: str = "text", words: dict[str, str] = C.RISK_WORDS) -> DataFrame:
    """(…, metric_id, status, quote): for each document and topic TEXT_QUAL with a quote, or NOT_EXTRACTED."""
    x = docs.withColumn("_plain", X.plain_text(F.col(text)))
    topics = F.array(*[F.struct(F.lit(m).alias("metric_id"), X.quote_around(F.col("_plain"), p).alias("quote")) for m, p in words.items()])
    x = x.select(*[c for c in docs.columns if c != text], F.explode(topics).alias("t"))
    return x.select(*[c for c in x.columns if c != "t"], "t.metric_id", F.when(F.col("t.quote").isNotNull(), "TEXT_QUAL").otherwise("NOT_EXTRACTED").alias("status"), "t.quote")


def capacity(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with utilization in percent and its quote, of a sentence that speaks of capacity utilization."""
    plain = X.plain_text(F.col(text))
    pattern = r"(?i)capacity utilization[^.]{0,80}?([0-9]{1,3}(?:\.[0-9]+)?)\s?%"
    value = F.regexp_extract(plain, pattern, 1)
    return docs.withColumn("utilization", F.when(value != "", value.cast("double"))).withColumn("utilization", F.when(F.col("utilization").between(0, 100), F.col("utilization"))).withColumn("quote", X.quote_around(plain, "capacity utilization"))


def table_row(docs: DataFrame, header: str, label: str, text: str = "text") -> DataFrame:
    """``docs`` with raw_header, raw_row and value: the first number of the row with the label, behind the header."""
    plain = X.plain_text(F.col(text))
    head = F.regexp_extract(plain, f"(?i)({header})", 1)
    rest = F.when(head != "", F.substring(plain, F.instr(plain, head), F.lit(5000)))
    row = F.regexp_extract(rest, f"(?i)({label}[^0-9(]{{0,40}}[(]?[0-9][0-9,.]*[)]?)", 1)
    value = X.number(F.regexp_extract(row, r"([(]?[0-9][0-9,]*(?:\.[0-9]+)?[)]?)$", 1))
    return docs.withColumns({"raw_header": F.nullif(head, F.lit("")), "raw_row": F.nullif(row, F.lit("")), "value": value})
