"""Approximate nearest neighbours by a hash-prefix forest.

Each tree hashes every vector to a long bit string, the signs of its products with random directions, and
keeps the strings in a sorted array. A query finds the place of its own string in each tree, at its longest
matching prefix, and then all trees give up one bit of prefix at a time, together, until enough candidates
share the prefixes left. Candidates are scored exactly.

Bits tell angles. So that a small angle means a large inner product, a row of length r gets one more coordinate,
the root of R*R - r*r for the greatest length R, and a query gets 0 there: all rows then have length R.

How many candidates are enough depends on the vectors: clustered ones need few, others many. It is measured on a
bounded sample of rows and queries, as the least share of rows at which the forest finds TARGET of the true
neighbours.

Rows are dealt to cells of bounded size by a hash of their number; every cell is a forest of its own, and blocks
of queries visit all cells. So no array outgrows a task, and what a cell returns is k rows for each query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .store import in_arrow, partitions, read

TREES = 160
BITS = 32
CELL = 16_384  # vectors of a forest, about
SHARES = (0.005, 0.01, 0.02, 0.05, 0.1, 0.15, 0.2, 0.25, 0.3, 0.35, 0.4, 0.5, 0.6, 0.8, 1.0)  # of a cell's vectors, tried in order
TARGET = 0.95  # of the true neighbours of the sample that the share has to find
SAMPLE, PROBES = 4096, 64  # rows and queries of the sample, about
QUERIES = 256  # of a block
SEED = 7


def directions(dim: int, trees: int, bits: int, seed: int = SEED) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(seed)).standard_normal((dim, trees * bits))


def strings(x: np.ndarray, planes: np.ndarray, trees: int, bits: int) -> np.ndarray:
    """For each tree the bit string of each vector, as a number; the first direction gives the highest bit."""
    out = np.empty((trees, len(x)), dtype=np.uint32 if bits <= 32 else np.uint64)
    wide = -(-bits // 8)
    for t in range(trees):
        octets = np.packbits(x @ planes[:, t * bits : (t + 1) * bits] >= 0, axis=1)
        number = np.zeros(len(x), np.uint64)
        for j in range(wide):
            number = number << np.uint64(8) | octets[:, j]
        out[t] = number >> np.uint64(8 * wide - bits)
    return out


class Forest:
    def __init__(self, ids: np.ndarray, x: np.ndarray, trees: int, bits: int):
        self.ids, self.x, self.trees, self.bits = ids, x, trees, bits
        self.planes = directions(x.shape[1] + 1, trees, bits)
        size = np.sqrt((x * x).sum(axis=1))
        top = size.max(initial=1.0)
        s = strings(np.column_stack([x / top, np.sqrt(np.maximum(0.0, 1 - (size / top) ** 2))]), self.planes, trees, bits)
        order = np.argsort(s, axis=1)
        self.sorted = np.take_along_axis(s, order, axis=1)
        self.order = order.astype(np.int32)
        self.rough = (x / top).astype(np.float32)

    def candidates(self, q: np.ndarray, least: int) -> Iterator[np.ndarray]:
        """Of each query the rows that share a long enough prefix with it in some tree: the depth goes down for
        all trees at once until ``least`` rows are found; all rows of the prefixes at that depth are taken."""
        s = strings(q, self.planes[:-1], self.trees, self.bits).astype(np.uint64)
        # The sum over trees bounds the union from above: depths with too small a sum need no look.
        runs, deepest = [], np.zeros(len(q), np.int64)
        for depth in range(self.bits + 1):
            drop = np.uint64(self.bits - depth)
            first = (s >> drop) << drop
            last = first + (np.uint64(1) << drop) - np.uint64(1)
            first, last = first.astype(self.sorted.dtype), last.astype(self.sorted.dtype)
            lo, hi = np.empty(s.shape, np.int64), np.empty(s.shape, np.int64)
            for t in range(self.trees):
                lo[t] = np.searchsorted(self.sorted[t], first[t])
                hi[t] = np.searchsorted(self.sorted[t], last[t], side="right")
            runs.append((lo.T.tolist(), hi.T.tolist()))
            enough = (hi - lo).sum(axis=0) >= least
            deepest[enough] = depth
            if not enough.any():
                break
        for i in range(len(q)):
            found = np.zeros(len(self.ids), bool)
            for depth in range(int(deepest[i]), -1, -1):
                found[np.concatenate([o[a:b] for o, a, b in zip(self.order, runs[depth][0][i], runs[depth][1][i], strict=True)])] = True
                if depth == 0 or np.count_nonzero(found) >= least:
                    yield np.flatnonzero(found)
                    break

    def nearest(self, qid: np.ndarray, q: np.ndarray, k: int, least: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(query, ids, scores), nearest first, equal scores by smaller id; a query is no neighbour of its own number."""
        unit = q / np.abs(q).max(axis=1, keepdims=True)
        unit = (unit / np.sqrt((unit * unit).sum(axis=1, keepdims=True))).astype(np.float32)
        # Scores of vectors of length 1 at most, in single precision, are off by less than half of this.
        slack = 4 * (q.shape[1] + 8) * float(np.finfo(np.float32).eps)
        for i, rows in enumerate(self.candidates(q, least)):
            rows = rows[self.ids[rows] != qid[i]]
            if len(rows) > k:  # the exact scores are taken of those that may be among the k
                about = self.rough[rows] @ unit[i]
                rows = rows[about >= np.partition(about, len(rows) - k)[len(rows) - k] - slack]
            score = (self.x[rows] * q[i]).sum(axis=1)
            if len(rows) > k:
                cut = np.partition(score, len(score) - k)[len(score) - k]
                rows, score = rows[score >= cut], score[score >= cut]
            order = np.lexsort((self.ids[rows], -score))[:k]
            yield int(qid[i]), self.ids[rows][order], score[order]


def share_for(ids: np.ndarray, x: np.ndarray, qid: np.ndarray, q: np.ndarray, k: int, trees: int, bits: int, target: float = TARGET) -> float:
    """The least of SHARES at which the forest of these rows finds ``target`` of the k true neighbours of the queries."""
    forest = Forest(ids, x, trees, bits)
    truth = []
    for i in range(len(q)):
        rows = np.flatnonzero(ids != qid[i])
        score = (x[rows] * q[i]).sum(axis=1)
        truth.append(set(ids[rows[np.lexsort((ids[rows], -score))[:k]]].tolist()))
    want = sum(map(len, truth))
    low, high = 0, len(SHARES) - 1
    while low < high:  # recall does not fall as the share grows
        mid = (low + high) // 2
        found = sum(len(t & set(got.tolist())) for t, (_, got, _) in zip(truth, forest.nearest(qid, q, k, max(k + 1, int(np.ceil(SHARES[mid] * len(ids))))), strict=True))
        low, high = (low, mid) if found >= target * want else (mid + 1, high)
    return SHARES[low]


def _probe(df: DataFrame, n: int, about: int) -> tuple[np.ndarray, np.ndarray]:
    """About ``about`` of the n rows of df(id, v), chosen by a hash, never more than twice that."""
    part = df if n <= about else df.where(F.pmod(F.xxhash64(F.lit(SEED), "id"), F.lit(1 << 31)) < int(about / n * (1 << 31)))
    rows = part.limit(2 * about).collect()
    return np.array([r.id for r in rows], np.int64), np.array([r.v for r in rows], np.float64)


def _search(dim: int, k: int, trees: int, bits: int, least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest, cell, ids, vectors = None, None, [], []
        for batch in batches:
            values, numbers = batch.column("values"), batch.column("ids")
            for at, (own, kind) in enumerate(zip(batch.column("cell").to_pylist(), batch.column("kind").to_pylist(), strict=True)):
                if own != cell:
                    forest, cell, ids, vectors = None, own, [], []
                x = values[at].values.to_numpy().reshape(-1, dim)
                number = numbers[at].values.to_numpy()
                if kind == 0:
                    ids.append(number)
                    vectors.append(x)
                    continue
                if not ids:
                    continue
                if forest is None:
                    forest = Forest(np.concatenate(ids), np.concatenate(vectors), trees, bits)
                want = max(k + 1, int(np.ceil(least * len(forest.ids))))
                got = list(forest.nearest(number, x, k, want))
                n = [len(a) for _, a, _ in got]
                yield pa.record_batch([pa.array(np.repeat([q for q, _, _ in got], n), pa.int64()), pa.array(np.concatenate([a for _, a, _ in got]), pa.int64()), pa.array(np.concatenate([s for _, _, s in got]), pa.float64())], names=["query_id", "vec_id", "score"])

    return run


def neighbours(rows: DataFrame, queries: DataFrame, dim: int, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding", trees: int = TREES, bits: int = BITS, cell: int = CELL, least: float | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` rows of largest inner product found for each query, in double
    precision, nearest first, ties to the smaller number; all, if fewer. The query's own number is left out.

    Vectors that are null, of another length than ``dim``, all zero, or hold a null or a value that is not
    finite take no part, as rows or as queries. Repeated rows are neighbours each; a number repeated among the
    queries is answered once, by its least vector; a null number takes no part. Every row is in the index; the number
    of candidates is a lower bound, never an upper one: ``least`` of a cell's rows, or the share that a sample of
    about SAMPLE rows and PROBES queries asks for. Other columns are not looked at.
    """
    spark = rows.sparkSession

    def sound(df: DataFrame) -> DataFrame:
        v = F.col(vec_col).cast("array<double>")
        df = df.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).where(F.col("id").isNotNull() & (F.size("v") == dim))
        return df.where("forall(v, x -> x is not null and not isnan(x) and abs(x) < double('infinity')) and exists(v, x -> x <> 0)")

    x, q = sound(rows), sound(queries).groupBy("id").agg(F.min("v").alias("v"))
    n_rows, n_queries = x.count(), q.count()
    cells = max(1, -(-n_rows // cell))
    if least is None:
        (ids, v), (qid, qv) = _probe(x, n_rows, SAMPLE), _probe(q, n_queries, PROBES)
        least = share_for(ids, v, qid, qv, k, trees, bits) if len(ids) and len(qid) else 1.0
    n_parts = partitions(spark)
    own = x.select(F.pmod(F.xxhash64("id"), F.lit(cells)).alias("cell"), F.lit(0).alias("kind"), F.array("id").alias("ids"), F.col("v").alias("values"))
    n_blocks = max(1, -(-n_queries // QUERIES))
    ask = q.groupBy(F.pmod(F.xxhash64("id"), F.lit(n_blocks)).alias("b")).agg(F.collect_list(F.struct("id", "v")).alias("g"))
    ask = ask.select(F.expr(f"explode(sequence(0L, {cells - 1}L)) as cell"), F.lit(1).alias("kind"), F.col("g.id").alias("ids"), F.flatten("g.v").alias("values"))
    met = own.unionByName(ask).repartition(n_parts, "cell").sortWithinPartitions("cell", "kind")
    found = in_arrow(met, _search(dim, k, trees, bits, least), "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op4_prefix_forest(spark, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "embeddings")
    first = rows.where("embedding is not null").select(F.size("embedding").alias("d")).groupBy("d").count().orderBy(F.desc("count"), "d").first()
    return neighbours(rows, rows.where("vec_id % 20 = 0"), first.d if first else 1)

