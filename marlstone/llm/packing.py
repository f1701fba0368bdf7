"""Token ids in packs of one length, by best-fit decreasing.

Texts become ids with an end mark; those longer than a pack are split into pieces of a pack's length and a rest,
without loss. Within a block, pieces go in order of size, the largest first, each to the pack with the least
room that is enough; a segment tree over room finds it. A pack knows its texts and where each begins.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import chunks
from .pieces import CHUNK, DEFAULT_MODEL, load
from .store import in_arrow, read

LENGTH = 2048
BLOCK = 2_000_000  # tokens that are packed together


class Room:
    """How many packs have each amount of room, in a segment tree; the least amount that is enough is found
    from the leaf upwards."""

    def __init__(self, most: int):
        self.leaves = 1 << most.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.packs: list[list[int]] = [[] for _ in range(most + 1)]

    def _add(self, room: int, by: int) -> None:
        i = self.leaves + room
        while i:
            self.count[i] += by
            i >>= 1

    def put(self, pack: int, room: int) -> None:
        self.packs[room].append(pack)
        self._add(room, 1)

    def take(self, need: int) -> tuple[int, int] | None:
        """A pack with the least room of at least ``need``, taken out, and its room."""
        i = self.leaves + need
        if not self.count[i]:
            while i > 1 and (i & 1 or not self.count[i + 1]):
                i >>= 1
            if i == 1:
                return None
            i += 1
            while i < self.leaves:
                i = 2 * i if self.count[2 * i] else 2 * i + 1
        room = i - self.leaves
        self._add(room, -1)
        return self.packs[room].pop(), room


def best_fit_decreasing(sizes: np.ndarray, length: int) -> list[list[int]]:
    """Items of each pack, in the order put; no item may be longer than ``length``. Equal sizes keep their order."""
    room, packs = Room(length), []
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        got = room.take(size)
        if got is None:
            packs.append([])
            got = len(packs) - 1, length
        packs[got[0]].append(i)
        room.put(got[0], got[1] - size)
    return packs


NAMES = ["pack_id", "n_tokens", "ids", "cu_seqlens", "resets", "doc_ids", "doc_offsets"]
SCHEMA = "pack_id long, n_tokens int, ids binary, cu_seqlens array<int>, resets array<int>, doc_ids array<long>, doc_offsets array<int>"


def _packed(path: str, length: int, block: int, end_id: int | None, pad_id: int):
    def flush(docs: list, ids: list, per: list, number: int) -> pa.RecordBatch:
        names = pa.chunked_array(docs).to_pylist()
        flat, n = np.concatenate(ids), np.concatenate(per)
        kind = "<u2" if len(load(path).names) <= 1 << 16 else "<u4"
        at = np.cumsum(n) - n
        pieces = -(-n // length)
        doc = np.repeat(np.arange(len(n)), pieces)
        offset = (np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * length
        size = np.minimum(n[doc] - offset, length)
        rows = []
        for k, items in enumerate(best_fit_decreasing(size, length)):
            row = np.full(length, pad_id, dtype=kind)
            cu = np.concatenate([[0], np.cumsum(size[items])])
            for i, a in zip(items, cu, strict=False):
                s = at[doc[i]] + offset[i]
                row[a : a + size[i]] = flat[s : s + size[i]]
            rows.append((number << 20 | k, int(cu[-1]), row.tobytes(), cu.tolist(), cu[:-1].tolist(), [names[doc[i]] for i in items], offset[items].tolist()))
        kinds = [pa.int64(), pa.int32(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int32())]
        cols = zip(*rows, strict=True) if rows else [[]] * len(kinds)
        return pa.record_batch([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = load(path)
        number = TaskContext.get().partitionId() << 20
        docs, ids, per, size = [], [], [], 0
        for batch in batches:
            for i, j, data, offs in chunks(batch.column(1), CHUNK):
                x, n = p.encode(data, offs)
                if end_id is not None:
                    x, n = np.insert(x, np.cumsum(n), end_id), n + 1
                docs.append(batch.column(0).slice(i, j - i)), ids.append(x), per.append(n)
                size += len(x)
                if size >= block:
                    yield flush(docs, ids, per, number)
                    docs, ids, per, size, number = [], [], [], 0, number + 1
        if docs:
            yield flush(docs, ids, per, number)

    return run


def packed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str = DEFAULT_MODEL, length: int = LENGTH, end_id: int | None = 2, pad_id: int = 0, block: int = BLOCK) -> DataFrame:
    """One row for each pack: (pack_id, n_tokens, ids, cu_seqlens, resets, doc_ids, doc_offsets).

    ``ids`` are ``length`` little-endian numbers of 16 bits (32 for vocabularies over 65,536), filled up with
    ``pad_id`` behind the first n_tokens. Segment s holds tokens cu_seqlens[s] to cu_seqlens[s+1] of the pack:
    those of doc_ids[s] from its token doc_offsets[s] on; positions start again at 0 at each of ``resets``.
    A text is its ids and ``end_id``; a null or empty one is the mark alone (with no mark: in no pack). Texts
    are never cut short; one longer than ``length`` is in several segments. Packs are filled within ``block``
    tokens of a task, with no shuffle; pack_id is unique in one run. Repeated rows are packed each; null ids
    stay null. Other columns are not looked at.
    """
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return in_arrow(base, _packed(model, length, block, end_id, pad_id), SCHEMA)


def write_packs(docs: DataFrame, path: str, **options) -> None:
    """Writes packs as Parquet, the ids as a binary column that reads as a matrix of packs by positions."""
    packed(docs, **options).write.parquet(path)


def op6_packed_ids(spark, sf_dir: str) -> DataFrame:
    return packed(read(spark, sf_dir, "documents"))


def packed_documents(spark, sf_dir: str) -> DataFrame:
    """What the packs hold, for the check by SQL: each document, its segments that begin it, and whether segments are
    whole: their sizes and the room of a pack add up."""
    found = packed(read(spark, sf_dir, "documents"))
    whole = F.expr(f"n_tokens = element_at(cu_seqlens, -1) and n_tokens <= {LENGTH} and size(cu_seqlens) = size(doc_ids) + 1 and resets = slice(cu_seqlens, 1, size(doc_ids))")
    parts = found.select(whole.alias("whole"), F.explode(F.arrays_zip("doc_ids", "doc_offsets")).alias("x"))
    return parts.groupBy(F.col("x.doc_ids").alias("doc_id")).agg(F.sum((F.col("x.doc_offsets") == 0).cast("long")).alias("begins"), F.min("whole").alias("whole"))
