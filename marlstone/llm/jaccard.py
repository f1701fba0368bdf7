"""N-gram Jaccard join by grouped prefixes.

1. Every text becomes the set of its distinct word shingles; texts with one set share a key.
2. Packed hashes meet in ranges of hash values, where those found in a single set fall away (they can be in no
   intersection). The rest get ids that ascend with their frequency: a global order for the prefix filter.
   A set with less than the threshold of its shingles in other sets links with nothing and goes.
3. Sets with equal size and equal prefix make one group. An inverted index over group prefixes gives group
   pairs, filtered by size and position; groups are expanded to their sets and verified exactly.
4. Only connectivity is asked for, so each list of the index is first tied to one leader by a linear number
   of verified pairs; the lists are then searched for pairs over different components only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .blocks import U, chunks, cuts, lean, mix, pack, pack_sorted, part_of, runs, shingle_sets, unpack, unpack_sorted
from .components import components
from .store import in_arrow, materialize, partitions, row_is

BLOCK = 500_000  # entries that a task packs together
SEEDS = 8  # leaders that a group is compared with in a round before the lists are searched
ROUNDS = 2  # of that; the search misses nothing either way


def set_keys(d: np.ndarray, sh: np.ndarray, n_docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Size and 64-bit key of each text's set; order does not matter."""
    n = np.bincount(d, minlength=n_docs)
    c = np.zeros(len(sh) + 1, dtype=np.uint64)
    np.cumsum(mix(sh + U(0x51ED270B)), out=c[1:])
    at = np.concatenate([[0], np.cumsum(n)])
    return n, mix(c[at[1:]] - c[at[:-1]] + n.astype(np.uint64)).view(np.int64)


def _keyed(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [n for n in batch.schema.names if n != "text"]
            for i, j, data, offs in chunks(batch.column("text")):
                d, sh = shingle_sets(data, offs, k)
                n, key = set_keys(d, sh, j - i)
                yield pa.record_batch([*(batch.column(x).slice(i, j - i) for x in own), pa.array(n), pa.array(key, mask=n == 0)], names=[*own, "n", "key"])

    return run


BITS = ["b0", "b1", "b2", "b3"]
ENTRY = [("part", pa.int32()), ("block", pa.int64()), ("at", pa.binary()), ("values", pa.binary()), ("keys", pa.binary()), ("sizes", pa.binary())]
ENTRY_SQL = "part int, block long, at binary, values binary, keys binary, sizes binary"


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, t) for c, (_, t) in zip(zip(*rows, strict=True), ENTRY, strict=True)], names=[n for n, _ in ENTRY])


def _packed(k: int, parts: int):
    """Blocks of sets: one row of their keys and sizes, and for each range of hashes the entries in it."""

    def flush(key: list, n: list, at: list, sh: list, block: int) -> pa.RecordBatch:
        keys, sizes, own, h = np.concatenate(key), np.concatenate(n), np.concatenate(at), np.concatenate(sh)
        keys, first, same = np.unique(keys, return_index=True, return_inverse=True)  # equal sets of the block count once
        keep = first[same[own]] == own
        own, h = same[own[keep]], h[keep]
        order = np.argsort(h, kind="stable")
        own, h = own[order], h[order]
        edges = np.searchsorted(part_of(h, parts), np.arange(parts + 1))
        rows = [(block % parts, block, None, None, pack(keys, "i8"), pack(sizes[first], "u4"))]
        rows += [(p, block, pack(own[a:b], "u4"), pack_sorted(h[a:b] >> U(8)), None, None) for p, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)) if a < b]
        return _rows(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32  # the same in a retry
        key, n, at, sh, docs, size = [], [], [], [], 0, 0
        for batch in batches:
            for i, j, data, offs in chunks(batch.column(0)):
                d, s = shingle_sets(data, offs, k)
                m, own = set_keys(d, s, j - i)
                key.append(own), n.append(m), at.append(d + docs), sh.append(s)
                docs, size = docs + (j - i), size + len(s)
                if size >= BLOCK:
                    yield flush(key, n, at, sh, block)
                    key, n, at, sh, docs, size, block = [], [], [], [], 0, 0, block + 1
        if size:
            yield flush(key, n, at, sh, block)

    return run


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of one range of hashes: to each block its entries of shingles in two sets or more, as numbers that
    ascend with frequency. Keys and sizes pass."""
    for part, rows in runs(batches, "part"):
        out = [(-1, r["block"], None, None, r["keys"], r["sizes"]) for r in rows if r["keys"] is not None]
        rows = [r for r in rows if r["keys"] is None]
        if rows:
            h = [unpack_sorted(r["values"]) for r in rows]
            _, entry, df = np.unique(np.concatenate(h), return_inverse=True, return_counts=True)
            rank = np.empty(len(df), np.int64)
            rank[np.argsort(df, kind="stable")] = np.arange(len(df))
            i = 0
            for r, x in zip(rows, h, strict=True):
                e = entry[i : i + len(x)]
                i += len(x)
                many = df[e] > 1
                own, ranks = unpack(r["at"], "u4")[many], rank[e[many]]
                if len(own):
                    order = np.lexsort((ranks, own))
                    out.append((part, r["block"], pack_sorted(own[order].astype(np.uint64)), pack(ranks[order], "u4"), None, None))
        if out:
            yield _rows(out)


def parities(ids: np.ndarray, c: np.ndarray) -> np.ndarray:
    """256 bits of each list: the parity of how many ids fall on each. Lists whose bits differ in d places
    differ in d ids at least."""
    where = (mix(ids.astype(np.uint64)) >> U(56)).astype(np.int64)
    odd = np.bincount(np.repeat(np.arange(len(c) - 1), np.diff(c)) * 256 + where, minlength=256 * (len(c) - 1)).reshape(-1, 256) & 1
    return np.packbits(odd.astype(np.uint8), axis=1).view(np.int64)


def _sets(percent: int):
    """Of one block: the sets that may link, their shared shingles in global order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in lean(runs(batches, "block")):
            key, size = unpack(rows[0]["keys"], "i8"), unpack(rows[0]["sizes"], "u4").astype(np.int64)
            if len(rows) == 1:
                continue
            own = np.concatenate([unpack_sorted(r["at"]) for r in rows[1:]]).astype(np.int64)
            ids = np.concatenate([unpack(r["values"], "u4").astype(np.int64) << 24 | r["part"] for r in rows[1:]])
            order = np.lexsort((ids, own))
            own, ids = own[order], ids[order]
            c = cuts(own)
            n, shared = size[own[c[:-1]]], np.diff(c)
            q = shared - (percent * n + 99) // 100 + 1
            ok = q > 0
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(shared[ok])]).astype(np.int32)), pa.array(ids[np.repeat(ok, shared)]))
            bits = parities(ids, c)[ok]
            yield pa.record_batch([pa.array(key[own[c[:-1]]][ok]), pa.array(n[ok]), pa.array(q[ok]), lists, *[pa.array(b) for b in bits.T]], names=["key", "n", "q", "ids", *BITS])

    return run


def linked_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80) -> DataFrame:
    """One row for each row of ``docs``: (id, n_shingles, component_id, n_links).

    Two texts link when 100 * |A & B| >= percent * |A | B| over their sets of distinct k-word shingles;
    component_id is the smallest id reachable by links, the row's own included. n_links counts the verified
    links of the row's set with other sets, as far as connectivity needed them. A null, empty or wordless
    text has an empty set, links with nothing and is its own component; a text of fewer than k words has its
    whole sequence as one shingle. Repeated rows and ids are kept, one row each. Shingles are compared by
    hash, at least 56 bits. Other columns of ``docs`` play no part, whatever their names.
    """
    known = _labelled(docs, id_col, text_col, k, percent)
    least = materialize(known.where("key is not null").groupBy("comp").agg(F.min("id").alias("component_id")))
    return known.join(least, "comp", "left").select("id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "id").alias("component_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"))


def _labelled(docs: DataFrame, id_col: str, text_col: str, k: int, percent: int, with_same: bool = False) -> DataFrame:
    """One row for each row of ``docs``: (id, n, key, comp, n_links), comp the least key of the component, null
    as key for an empty set; ``with_same`` adds a hash of the text."""
    spark = docs.sparkSession
    n_parts = partitions(spark)
    parts = 4 * n_parts
    same = [F.xxhash64(F.col(text_col).cast("string")).alias("same")] if with_same else []
    base = docs.select(F.col(id_col).cast("long").alias("id"), *same, F.col(text_col).cast("string").alias("text"))
    keyed = in_arrow(base, _keyed(k), f"id long, {'same long, ' if with_same else ''}n long, key long")
    packed = in_arrow(base.select("text"), _packed(k, parts), ENTRY_SQL)
    shared = in_arrow(packed.repartition(n_parts, "part").sortWithinPartitions("part"), _shared, ENTRY_SQL)
    sets = in_arrow(shared.repartition(n_parts, "block").sortWithinPartitions("block", "part"), _sets(percent), "key long, n long, q long, ids array<long>, b0 long, b1 long, b2 long, b3 long")
    sets = materialize(sets.dropDuplicates(["key"]))  # equal sets of several blocks

    # Sets of one size and one prefix make a group; its number is a hash of both.
    sketch = F.expr(f"array({', '.join(BITS)}, n - size(ids))").alias("sketch")
    member = sets.select("key", "n", "q", sketch, F.xxhash64("n", F.slice("ids", 1, F.col("q").cast("int"))).alias("gid"))
    group = sets.groupBy(F.xxhash64("n", F.slice("ids", 1, F.col("q").cast("int"))).alias("gid"), "n").agg(F.min(F.struct("key", F.slice("ids", 1, F.col("q").cast("int")).alias("prefix"), F.expr(f"array({', '.join(BITS)}, n - size(ids))").alias("sketch"))).alias("x"))
    index = materialize(group.select("gid", "n", F.col("x.key").alias("lead"), F.col("x.sketch").alias("sketch"), F.size("x.prefix").alias("q"), F.posexplode("x.prefix").alias("pos", "id")))
    member = materialize(member.join(group.select("gid", F.col("x.key").alias("lead")), "gid"))

    # Seeds: each list has a leader, drawn by a hash; a group is tied to up to SEEDS leaders of other components,
    # those that it meets most often, and each set of a group to leaders of the group. The number of pairs is linear
    # in that of sets. Every round joins most of what the last one left apart.
    tried = known = None
    for number in range(ROUNDS):
        lists = index if known is None else index.join(known.where("key = lead").select("gid", "comp"), "gid")
        if known is None:
            lists = lists.withColumn("comp", F.col("lead"))
        head = F.min(F.struct(F.xxhash64("id", "lead", F.lit(number)).alias("r"), "n", "lead", "comp", "sketch")).alias("h")
        heads = lists.groupBy("id").agg(head, F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("id", F.col("h.n").alias("hn"), F.col("h.lead").alias("a"), F.col("h.comp").alias("other"), F.col("h.sketch").alias("hs"))
        met = lists.join(heads, "id").where(f"comp <> other and 100 * least(n, hn) >= {percent} * greatest(n, hn) and {_alike('n', 'sketch', 'hn', 'hs', percent)}").groupBy(F.col("lead").alias("b"), "a").agg(F.count("*").alias("c"))
        most = F.row_number().over(Window.partitionBy("b").orderBy(F.col("c").desc(), "a"))
        seeds = met.withColumn("r", most).where(F.col("r") <= SEEDS).select("a", "b")
        # The sets of a group have SEEDS leaders of their own.
        own = member.withColumn("comp", F.col("key")) if known is None else known
        many = own.groupBy("gid").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("gid")
        own = own.join(many, "gid").withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(SEEDS - 1))))
        heads = own.groupBy("gid", "j").agg(F.min(F.struct(F.xxhash64("key", "j", F.lit(number)).alias("r"), "n", "key", "comp", "sketch")).alias("h"))
        heads = heads.select("gid", "j", F.col("h.key").alias("a"), F.col("h.comp").alias("other"), F.col("h.sketch").alias("hs"))
        seeds = seeds.unionByName(own.join(heads, ["gid", "j"]).where(f"comp <> other and {_alike('n', 'sketch', 'n', 'hs', percent)}").select("a", F.col("key").alias("b"))).distinct()
        new = materialize(_verified(sets, seeds, percent))
        tried = new if tried is None else tried.unionByName(new)
        known = materialize(_relabelled(member.withColumn("comp", F.col("key")) if known is None else known, new))
    first = tried

    # The rest: lists that hold more than one component.
    spread = known.groupBy("gid").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("c"))
    wide = index.join(spread, "gid")
    mixed = wide.groupBy("id").agg(F.min("lo").alias("x"), F.max("hi").alias("y")).where("x <> y").select("id")
    live = materialize(wide.join(mixed, "id"))
    l, r = live.alias("l"), live.alias("r")
    # At the first shingle that two sets share, positions i and j, no more than s - i and s - j of them follow;
    # s, the number of shared shingles of a set, is q - 1 + ceil(percent * n / 100).
    left = lambda t: f"{t}.q - 1 - {t}.pos + ({percent} * {t}.n + 99) div 100"
    # Within a group sets differ, so its leader's bits speak for groups of one set alone.
    near = f"""l.id = r.id and (l.n < r.n or (l.n = r.n and l.gid < r.gid)) and 100 * l.n >= {percent} * r.n
        and not (l.lo = l.hi and r.lo = r.hi and l.lo = r.lo)
        and {100 + percent} * least({left("l")}, {left("r")}) >= {percent} * (l.n + r.n)
        and (l.c > 1 or r.c > 1 or {_alike("l.n", "l.sketch", "r.n", "r.sketch", percent)})"""
    by_list = l.join(r, F.expr(near)).select(F.col("l.gid").alias("g"), F.col("r.gid").alias("h")).distinct()
    alike = _alike("x.n", "x.sketch", "y.n", "y.sketch", percent)
    x, y = known.alias("x"), known.alias("y")
    across = by_list.join(x, F.expr("g = x.gid")).join(y, F.expr(f"h = y.gid and x.comp <> y.comp and {alike}")).select(F.col("x.key").alias("a"), F.col("y.key").alias("b"))
    some = known.join(spread.where("lo <> hi").select("gid"), "gid", "left_semi")
    inside = some.alias("x").join(some.alias("y"), F.expr(f"x.gid = y.gid and x.key < y.key and x.comp <> y.comp and {alike}")).select(F.col("x.key").alias("a"), F.col("y.key").alias("b"))
    second = _verified(sets, across.unionByName(inside).distinct().join(first, ["a", "b"], "left_anti"), percent)
    second = materialize(second)
    links = first.unionByName(second)
    degree = links.select("a").unionByName(links.select(F.col("b").alias("a"))).groupBy(F.col("a").alias("key")).agg(F.count("*").alias("n_links"))
    labels = materialize(_relabelled(known, second).select("key", "comp").join(degree, "key", "left"))
    return materialize(keyed.join(labels, "key", "left").withColumn("comp", F.coalesce("comp", "key")))


def _relabelled(known: DataFrame, pairs: DataFrame) -> DataFrame:
    """``known`` (key, comp and more) with the components that the pairs join made one."""
    top = known.select("key", "comp")
    bridges = pairs.join(top.toDF("a", "x"), "a").join(top.toDF("b", "y"), "b").select(F.col("x").alias("a"), F.col("y").alias("b"))
    merged = components(bridges).toDF("comp", "root")
    return known.join(merged, "comp", "left").withColumn("comp", F.coalesce("root", "comp")).drop("root")


def _alike(n: str, sketch: str, m: str, other: str, percent: int) -> str:
    """A condition that all pairs which link meet: shingles of one set alone and bits that differ are no more
    than |A | B| - |A & B| may be."""
    bits = " + ".join(f"bit_count({sketch}[{i}] ^ {other}[{i}])" for i in range(len(BITS)))
    return f"({100 + percent} * ({sketch}[{len(BITS)}] + {other}[{len(BITS)}] + {bits}) <= {100 - percent} * ({n} + {m}))"


def _verified(sets: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs whose sets reach the threshold. Shingles of a single set are in no intersection, so the
    shared ones and the sizes give it exactly."""
    a = sets.select(F.col("key").alias("a"), F.col("n").alias("na"), F.col("ids").alias("ia"))
    b = sets.select(F.col("key").alias("b"), F.col("n").alias("nb"), F.col("ids").alias("ib"))
    near = F.expr(f"100 * least(na, nb) >= {percent} * greatest(na, nb)")
    both = pairs.join(a, "a").join(b, "b").where(near).withColumn("c", F.size(F.array_intersect("ia", "ib")))
    return both.where(f"(100 + {percent}) * c >= {percent} * (na + nb)").select("a", "b")


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80) -> DataFrame:
    """One row of ``docs`` for each component, and all rows whose set is empty. Of a component it is one of least id,
    null ids last, then of least hash of the text; of rows that repeat both, one by the other columns."""
    known = _labelled(docs, id_col, text_col, k, percent, with_same=True)
    texts = materialize(known.where("key is not null").groupBy("comp", "id", "same").agg(F.count("*").alias("rows")))
    first = texts.groupBy("comp").agg(F.min(F.struct(F.col("id").isNull().alias("x"), "id", "same")).alias("h"))
    judged = texts.join(first, "comp").select("id", "same", "rows", F.expr("id <=> h.id and same = h.same").alias("kept"))
    # Written first: Spark then knows how few they are, and shuffles the texts only if they are many.
    marked = materialize(judged.where("not kept or rows > 1"))
    out = docs.join(marked, row_is(docs, id_col, text_col, marked), "left_anti")
    twice = marked.where("kept")
    if twice.isEmpty():
        return out
    # A hash of all columns: the same row again in a retry.
    order = F.xxhash64(*[docs[c] for c, t in docs.dtypes if "map<" not in t])
    one = docs.join(twice, row_is(docs, id_col, text_col, twice), "left_semi")
    one = one.groupBy(F.col(id_col).cast("long").alias("i"), F.xxhash64(F.col(text_col).cast("string")).alias("s")).agg(F.min_by(F.struct(*docs.columns), order).alias("row"))
    return out.unionByName(one.select("row.*"))


def op5_ngram_jaccard_join(spark, sf_dir: str) -> DataFrame:
    from .store import read

    found = linked_components(read(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id")

