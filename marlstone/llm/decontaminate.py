"""Benchmark decontamination by spaced-seed hashing.

Fixed masks select some token positions of a window and ignore the others, so a substituted word at an ignored
position does not hide a match. The masks are such that every stretch that agrees well enough shows one: with up
to s substitutions, positions are dealt into s + 2 classes, and some mask ignores any s of these. Masked hashes of
the test items meet those of all documents; around each hit the item is laid along the document on the hit's
diagonal and compared token by token.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import NOT_ALNUM, U, chunks, mix, word_hashes
from .store import in_arrow, materialize, read, row_is

SEGMENT = 13  # tokens of the stretch that has to agree, or the whole item if it is shorter
PERCENT = 80  # of the stretch's tokens that agree at least


def masks_of(n: int) -> tuple[str, ...]:
    """Seeds, 1 for a position that counts, of which n tokens show one whenever enough of them agree."""
    other = n * (100 - PERCENT) // 100
    free = combinations(range(other + 2), other)
    return tuple("".join("0" if other and i % (other + 2) in f else "1" for i in range(n)) for f in free)


#: The seeds of a whole item of 1 to 12 tokens, and of a stretch of a longer one.
SEEDS = {n: masks_of(n) for n in range(1, SEGMENT + 1)}
MASKS = tuple(m for masks in SEEDS.values() for m in masks)
INDEX_TOKENS = 1_000_000  # tokens of test items that are broadcast together; more are taken in further passes
BITS = 22


def masked_hashes(h: np.ndarray, mask: str) -> np.ndarray:
    """A hash of the selected positions of each window of the mask's length."""
    m = len(h) - len(mask) + 1
    if m <= 0:
        return np.empty(0, np.uint64)
    out = np.full(m, np.uint64(int(mask, 2) * 2654435761 % 2**64))
    for k, bit in enumerate(mask):
        if bit == "1":
            out = (out + h[k : k + m]) * U(0xD6E8FEB86659FD93)
    return mix(out)


class Index:
    """Masked hashes of test items, sorted; items are runs of ``tokens``."""

    def __init__(self, items: list[tuple[int, np.ndarray]]):
        self.ids = np.array([i for i, _ in items], dtype=np.int64)
        size = np.array([len(h) for _, h in items], dtype=np.int64)
        self.start = np.cumsum(size) - size
        self.size = size
        self.tokens = np.concatenate([h for _, h in items]) if items else np.empty(0, np.uint64)
        self.masks, self.hashes, self.item, self.pos, self.bitmap = [], [], [], [], []
        for n in sorted({min(int(n), SEGMENT) for n in size} or {SEGMENT}):
            # A short item is sought as a whole, by masks of its own length.
            items_of = [(k, h) for k, (_, h) in enumerate(items) if min(len(h), SEGMENT) == n]
            for mask in SEEDS[n]:
                own = [(masked_hashes(h, mask), k) for k, h in items_of]
                x = np.concatenate([a for a, _ in own] or [np.empty(0, np.uint64)])
                item = np.repeat(np.array([k for _, k in own], dtype=np.int32), [len(a) for a, _ in own])
                pos = np.concatenate([np.arange(len(a), dtype=np.int32) for a, _ in own] or [np.empty(0, np.int32)])
                order = np.argsort(x, kind="stable")
                bits = min(BITS, 8 + len(x).bit_length())
                bitmap = np.zeros(1 << bits, dtype=bool)
                bitmap[(x >> U(64 - bits)).astype(np.int64)] = True
                self.masks.append(mask), self.hashes.append(x[order]), self.item.append(item[order]), self.pos.append(pos[order]), self.bitmap.append(bitmap)

    def hits(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(item, diagonal) of all hits, without repeats; a diagonal is the token where the item would start."""
        items, diagonals = [], []
        for mask, own, item, pos, bitmap in zip(self.masks, self.hashes, self.item, self.pos, self.bitmap, strict=True):
            x = masked_hashes(h, mask)
            at = np.flatnonzero(bitmap[(x >> U(65 - len(bitmap).bit_length())).astype(np.int64)]) if len(own) else np.empty(0, np.int64)
            lo, hi = np.searchsorted(own, x[at], side="left"), np.searchsorted(own, x[at], side="right")
            n = hi - lo
            k = np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            items.append(item[k].astype(np.int64)), diagonals.append(np.repeat(at, n) - pos[k])
        both = np.unique(np.stack([np.concatenate(items), np.concatenate(diagonals)], axis=1), axis=0)
        return both[:, 0], both[:, 1]

    def verified(self, h: np.ndarray, doc: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, item, tokens that agree) of the diagonals on which some stretch agrees well enough."""
        item, diagonal = self.hits(h)
        docs, items, agree = [], [], []
        for k, d in zip(item, diagonal, strict=True):
            n, s = self.size[k], self.start[k]
            # A hit lies in one or, over a border, several texts; the item is laid along each of them.
            for t in np.unique(doc[max(d, 0) : d + n]):
                a, b = max(d, at[t]), min(d + n, at[t + 1])
                same = h[a:b] == self.tokens[s + a - d : s + b - d]
                need = min(SEGMENT, int(n))
                if len(same) >= need:
                    c = np.concatenate([[0], np.cumsum(same)])
                    if 100 * (c[need:] - c[:-need]).max() >= PERCENT * need:
                        docs.append(t), items.append(k), agree.append(int(c[-1]))
        return np.array(docs, np.int64), np.array(items, np.int64), np.array(agree, np.int64)


def _search(index):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x: Index = index.value
        for batch in batches:
            for i, j, data, offs in chunks(batch.column(2)):
                h, doc = word_hashes(data, offs, NOT_ALNUM)
                at = np.searchsorted(doc, np.arange(j - i + 1))
                d, k, agree = x.verified(h, doc, at)
                order = np.lexsort((x.ids[k], -agree, d))
                d, k, agree = d[order], k[order], agree[order]
                n = np.zeros(j - i, np.int64)
                for t in np.unique(d):
                    n[t] = len(np.unique(k[d == t]))
                first = np.searchsorted(d, np.arange(j - i))
                first[n == 0] = -1
                none = n == 0
                pick = lambda a: pa.array(np.append(a, 0)[first], mask=none)  # noqa: E731,B023
                yield pa.record_batch([batch.column(0).slice(i, j - i), batch.column(1).slice(i, j - i), pa.array(n), pick(x.ids[k]), pick(agree), pick(x.size[k])], names=["id", "same", "n_items", "item_id", "agreeing", "item_tokens"])

    return run


def _indexes(bench: DataFrame, item_col: str, text_col: str, limit: int) -> Iterator[Index]:
    """Indexes over runs of items of ``limit`` tokens at most (or one item); the rows come a partition at a time."""
    held, size = [], 0
    for row in bench.select(F.col(item_col).cast("long"), F.col(text_col).cast("string")).toLocalIterator():
        if row[0] is None or not row[1]:
            continue
        raw = np.frombuffer(row[1].encode(), np.uint8)
        h, _ = word_hashes(raw, np.array([0, len(raw)]), NOT_ALNUM)
        if not len(h):
            continue
        if held and size + len(h) > limit:
            yield Index(held)
            held, size = [], 0
        held.append((row[0], h))
        size += len(h)
    yield Index(held)


SCHEMA = "id long, same long, n_items long, item_id long, agreeing long, item_tokens long"


def contamination(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", index_tokens: int = INDEX_TOKENS) -> DataFrame:
    """(id, same, n_items, item_id, agreeing, item_tokens) for each row of ``docs``: how many test items it
    holds, and of the one with most agreeing tokens (ties: smaller item_id) its number, those tokens and its
    length; without any, n_items is 0 and the rest null. ``same`` tells texts of one id apart.

    Tokens are runs of letters, digits and non-ASCII characters, A-Z lower-cased. A document holds an item if
    on some diagonal 13 tokens in a row, or the whole of a shorter item, agree in 80 % or more; the masks miss
    none of these. Null, empty and wordless texts
    and items hold nothing and are held by nothing; an empty benchmark is held by nothing. Repeated rows and
    items count as they are. Other columns are not looked at.

    The items are indexed and broadcast in runs of ``index_tokens`` tokens; each run is a pass over ``docs``.
    """
    spark = docs.sparkSession
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(F.col(text_col).cast("string")).alias("same"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    passes = []
    for index in _indexes(bench, item_col, item_text_col, index_tokens):
        passes.append(in_arrow(base, _search(spark.sparkContext.broadcast(index)), SCHEMA))
        if len(passes) > 1:
            passes[-2] = materialize(passes[-2])
    if len(passes) == 1:
        return passes[0]
    found = passes[0].where("n_items > 0")
    for p in passes[1:]:
        found = found.unionByName(p.where("n_items > 0"))
    best = F.struct(F.col("agreeing").alias("x"), (-F.col("item_id")).alias("y"), "item_tokens")
    # Repeated rows of one id and text find the same: count a pass once.
    found = found.distinct().groupBy("id", "same").agg(F.sum("n_items").alias("n_items"), F.max(best).alias("b"))
    found = found.select("id", "same", "n_items", (-F.col("b.y")).alias("item_id"), F.col("b.x").alias("agreeing"), F.col("b.item_tokens").alias("item_tokens"))
    left = base.select("id", "same")
    same = left["id"].eqNullSafe(found["id"]) & (left["same"] == found["same"])
    return left.join(found, same, "left").select(left["id"], left["same"], F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"), "item_id", "agreeing", "item_tokens")


def drop_contaminated(docs: DataFrame, bench: DataFrame, **columns) -> DataFrame:
    """The rows of ``docs`` that hold no test item. Each row is judged by its own text; ids may be null or repeated."""
    id_col, text_col = columns.get("id_col", "doc_id"), columns.get("text_col", "text")
    # Written first: Spark then knows how few they are, and shuffles the texts only if they are many.
    bad = materialize(contamination(docs, bench, **columns).where("n_items > 0").select("id", "same").distinct())
    return docs.join(bad, row_is(docs, id_col, text_col, bad), "left_anti")


def op2_decontaminate(spark, sf_dir: str) -> DataFrame:
    found = contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), (F.col("n_items") > 0).alias("contaminated"), "n_items", "item_id", "agreeing", "item_tokens")
