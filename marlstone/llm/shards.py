"""Sharding by a Feistel permutation of global row numbers, in built-in functions only.

Rows are numbered from 0; a keyed permutation of the numbers gives each row its place, and the place its shard
and slot, both computable without a look at other rows once the row number and the row count are known.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .store import materialize, read

SHARDS = 8
SEED = 20_240_229
ROUNDS = 4
BUCKETS = 4096  # runs of row numbers; their sizes are all that is gathered in one place
PRIME = 2**31 - 1
SPREAD = 1_103_515_245  # times an id, modulo PRIME, gives its bucket
WALK = 40


def keys(seed: int, rounds: int = ROUNDS) -> list[tuple[int, int, int]]:
    """Three numbers below PRIME for each round, by a linear congruence from the seed."""
    out, x = [], seed % PRIME
    for _ in range(rounds):
        row = []
        for _ in range(3):
            x = (x * 48271 + 11) % PRIME
            row.append(x + 1)
        out.append(tuple(row))
    return out


def _step(x: str, side: str, seed: int) -> str:
    """The network with each round's pair bound once, so the expression stays linear in the rounds."""
    pair = f"array({x} div {side}, {x} % {side})"
    for a, b, c in keys(seed):
        r = "p[1]"
        mixed = f"((({r} + {a}L) % {PRIME}L) * (({r} + {b}L) % {PRIME}L) % {PRIME}L * {c}L % {PRIME}L)"
        pair = f"transform(array({pair}), p -> array(p[1], (p[0] + {mixed}) % {side}))[0]"
    return f"transform(array({pair}), p -> p[0] * {side} + p[1])[0]"


def permuted(x: str, n: str, seed: int = SEED) -> str:
    """The place of number x among 0 .. n-1: the network over the least square of at least n numbers, applied
    until the result is below n (cycle walking). The square exceeds n by at most 2 * sqrt(n) + 1 numbers, so
    WALK steps always end for n up to 380 and fail to with a chance below 1e-38 beyond; then it is an error."""
    side = f"cast(ceil(sqrt(cast({n} as double))) as bigint)"
    walk = f"aggregate(sequence(1, {WALK}), {_step(x, side, seed)}, (a, i) -> case when a < {n} then a else {_step('a', side, seed)} end)"
    return f"transform(array({walk}), w -> case when w < {n} then w else raise_error('the walk did not end') end)[0]"


def bucket_of(number: str) -> str:
    """One of BUCKETS numbers for any 64-bit number or null, spread so that strided ids do not meet in few of them."""
    return f"(pmod(coalesce({number}, 0), {PRIME}L) * {SPREAD}L % {PRIME}L) % {BUCKETS}"


def numbered(df: DataFrame) -> DataFrame:
    """df(id, size, text_crc32) with ``row_number`` from 0 and ``row_count``. The order is by a bucket of the id, then
    by all three columns; rows that agree in them are interchangeable. A task gets the rows of some buckets, a
    BUCKETS-th of all each, unless one id has more."""
    df = df.withColumn("bucket", F.expr(bucket_of("id")))
    sizes = df.groupBy("bucket").agg(F.count("*").alias("c"))
    whole = Window.partitionBy(F.lit(0))  # over BUCKETS rows at most
    before = sizes.select("bucket", F.sum("c").over(whole.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)).alias("before"), F.sum("c").over(whole.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("row_count"))
    order = [F.col(c).asc_nulls_first() for c in ("id", "size", "text_crc32")]
    own = df.withColumn("own", F.row_number().over(Window.partitionBy("bucket").orderBy(*order)) - 1)
    out = own.join(F.broadcast(before), "bucket")
    return out.withColumn("row_number", F.col("own") + F.coalesce("before", F.lit(0))).drop("bucket", "own", "before")


def _facts(docs: DataFrame, id_col: str, text_col: str) -> list:
    text = docs[f"`{text_col}`"].cast("string")
    return [docs[f"`{id_col}`"].cast("long").alias("id"), (F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1).alias("size"), F.crc32(text.cast("binary")).alias("text_crc32")]


def _placed(df: DataFrame, shards: int, seed: int) -> DataFrame:
    df = numbered(df).withColumn("place", F.expr(permuted("row_number", "row_count", seed)))
    return df.withColumn("shard", (F.col("place") % shards).cast("int")).withColumn("slot", F.floor(F.col("place") / shards).cast("long"))


def sharded(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """(id, size, text_crc32, law, shard, slot, grown_shard) for each row of ``docs``.

    The law is ``rows``: shard sizes differ by one row at most, and slots of a shard run from 0 without gaps.
    The place of a row is the Feistel permutation of its row number; its shard is the place modulo ``shards``,
    its slot the quotient. Rows are numbered by id, size and checksum of the text; repeated rows get places of
    their own. size is the UTF-8 bytes of the text plus 1, a null text has size 1 and a null checksum; a null
    id sorts first. grown_shard is null under this law. Other columns are not looked at. The texts are read once
    and never shuffled. Equal texts need not meet in a shard: a group of copies may be larger than one.
    """
    df = _placed(materialize(docs.select(*_facts(docs, id_col, text_col))), shards, seed)
    return df.select("id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def write_shards(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS, seed: int = SEED) -> None:
    """Writes ``docs`` as Parquet, a folder shard=N for each shard, in order of the column slot. Columns of ``docs``
    that are named shard or slot are written as own_shard and own_slot; all others keep their names."""
    names = [{"shard": "own_shard", "slot": "own_slot"}.get(c, c) for c in docs.columns]
    row = F.struct(*[docs[f"`{c}`"].alias(f"c{i}") for i, c in enumerate(docs.columns)]).alias("row")
    placed = _placed(docs.select(*_facts(docs, id_col, text_col), row), shards, seed)
    placed = placed.select("shard", "slot", *[F.col(f"row.c{i}").alias(c) for i, c in enumerate(names)])
    placed.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def op7_feistel_shards(spark, sf_dir: str) -> DataFrame:
    found = sharded(read(spark, sf_dir, "documents"))
    return found.withColumnRenamed("id", "doc_id")
