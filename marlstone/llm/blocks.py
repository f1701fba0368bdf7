"""Vectorised text blocks: word and n-gram hashes straight from Arrow string buffers, and packed arrays
that travel through a shuffle as one row for many entries.

A word hash is a random polynomial of the word's bytes modulo 2**64, finished by a bijective mixer; it
depends on nothing but the bytes, so every executor and every retry gets the same value.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
CHUNK = 1_000_000  # bytes of text held as vectors at a time; a longer text makes a chunk of its own
WINDOW = 1 << 21  # bytes that one table of powers covers
MULT = 0x9E3779B97F4A7C15
RANDOM = np.random.Generator(np.random.PCG64(20240229)).integers(1, 2**63, 256, dtype=np.uint64)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, dtype=bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
#: All ASCII but letters and digits: words then carry no punctuation.
NOT_ALNUM = np.ones(256, dtype=bool)
NOT_ALNUM[48:58] = NOT_ALNUM[65:91] = NOT_ALNUM[97:123] = NOT_ALNUM[128:] = False


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> U(33))
    x = x * U(0xFF51AFD7ED558CCD)
    x = x ^ (x >> U(33))
    x = x * U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U(33))


_powers: dict[int, np.ndarray] = {}


def powers(n: int, base: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept between calls."""
    out = _powers.get(base)
    if out is None or len(out) < n:
        size = 1 << max(16, (n - 1).bit_length())
        out = np.empty(size, dtype=np.uint64)
        out[0], k = 1, 1
        while k < size:
            t = min(k, size - k)
            out[k : k + t] = out[:t] * U(pow(base, k, 2**64))
            k += t
        _powers[base] = out
    return out[:n]


INVERSE = pow(MULT, -1, 2**64)


def buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes and the offsets of a string column; null counts as empty."""
    if col.null_count:
        col = col.fill_null("")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    kind = np.int64 if wide else np.int32
    _, offsets, data = col.buffers()
    offs = np.frombuffer(offsets, dtype=kind, count=len(col) + 1, offset=col.offset * np.dtype(kind).itemsize) if offsets is not None and len(col) else np.zeros(len(col) + 1, kind)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw, offs.astype(np.int64)


def chunks(col: pa.Array, limit: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets from 0) of runs of rows of at most ``limit`` bytes, or one row."""
    raw, offs = buffers(col)
    i = 0
    while i < len(col):
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + limit, side="right")) - 1)
        yield i, j, raw[offs[i] : offs[j]], offs[i : j + 1] - offs[i]
        i = j


def words(data: np.ndarray, offs: np.ndarray, sep: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of each maximal run of bytes that are no separators."""
    if not len(data):
        none = np.empty(0, np.int64)
        return none, none, none
    s = sep[data]
    first = np.zeros(len(data) + 1, dtype=bool)
    first[offs] = True
    before, after = np.ones(len(data), bool), np.ones(len(data), bool)
    before[1:], after[:-1] = s[:-1], s[1:]
    start = np.flatnonzero(~s & (before | first[:-1]))
    end = np.flatnonzero(~s & (after | first[1:])) + 1
    return start, end, np.searchsorted(offs, start, side="right") - 1


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, fold: np.ndarray | None = LOWER) -> np.ndarray:
    """A 64-bit hash of each span of the bytes, with A-Z lower-cased unless ``fold`` says otherwise."""
    out = np.empty(len(start), dtype=np.uint64)
    i = 0
    while i < len(start):
        j = len(start) if len(data) <= WINDOW else max(i + 1, int(np.searchsorted(end, start[i] + WINDOW, side="right")))
        lo, hi = int(start[i]), int(end[j - 1])
        c = np.zeros(hi - lo + 1, dtype=np.uint64)
        np.cumsum(RANDOM[data[lo:hi] if fold is None else fold[data[lo:hi]]] * powers(hi - lo, MULT), out=c[1:])
        a, b = start[i:j] - lo, end[i:j] - lo
        out[i:j] = (c[b] - c[a]) * powers(hi - lo, INVERSE)[a] + (b - a).astype(np.uint64)
        i = j
    return mix(out)


def word_hashes(data: np.ndarray, offs: np.ndarray, sep: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """The hash and the text number of each word."""
    start, end, doc = words(data, offs, sep)
    return span_hashes(data, start, end), doc


def ngram_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """A hash of each run of n word hashes, over text borders too; the caller masks those."""
    if len(h) < n:
        return np.empty(0, np.uint64)
    out = h[: len(h) - n + 1] * U(3)
    for k in range(1, n):
        out = (out + h[k : len(h) - n + 1 + k]) * U(0xD6E8FEB86659FD93)
    return mix(out + U(n))


def shingle_sets(data: np.ndarray, offs: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(text number, hash) of the distinct k-word shingles of each text, sorted by both. A text of fewer
    than k words has its whole sequence as one; a text without words has none."""
    h, doc = word_hashes(data, offs)
    sh = ngram_hashes(h, k)
    keep = doc[k - 1 :] == doc[: len(doc) - k + 1] if len(h) >= k else np.empty(0, bool)
    d, sh = doc[: len(sh)][keep], sh[keep]
    n = np.bincount(doc, minlength=len(offs) - 1)
    short = np.flatnonzero((n > 0) & (n < k))
    if len(short):
        at = np.searchsorted(doc, short)
        extra = np.array([ngram_hashes(h[a : a + n[t]], int(n[t]))[0] for a, t in zip(at, short, strict=True)], dtype=np.uint64)
        d, sh = np.concatenate([d, short]), np.concatenate([sh, extra])
    order = np.lexsort((sh, d))
    d, sh = d[order], sh[order]
    new = np.ones(len(d), dtype=bool)
    new[1:] = (d[1:] != d[:-1]) | (sh[1:] != sh[:-1])
    return d[new], sh[new]


def _squeeze(x: np.ndarray) -> bytes:
    """One plane for each byte of the numbers, compressed; empty for none."""
    if not len(x):
        return b""
    planes = np.ascontiguousarray(x.view(np.uint8).reshape(len(x), -1).T)
    return len(x).to_bytes(8, "little") + pa.Codec("zstd", 1).compress(planes, asbytes=True)


def _spread(b: bytes, kind: str) -> np.ndarray:
    if not b:
        return np.empty(0, dtype=kind)
    n, width = int.from_bytes(b[:8], "little"), np.dtype(kind).itemsize
    planes = np.frombuffer(pa.Codec("zstd").decompress(b[8:], n * width), dtype=np.uint8).reshape(width, n)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def pack_sorted(x: np.ndarray) -> bytes:
    """Ascending unsigned numbers as differences."""
    d = np.array(x, dtype=np.uint64)
    d[1:] -= x[:-1]
    return _squeeze(d)


def unpack_sorted(b: bytes) -> np.ndarray:
    return np.cumsum(_spread(b, "u8"), dtype=np.uint64)


def pack(x: np.ndarray, kind: str) -> bytes:
    """Numbers of a fixed width."""
    return _squeeze(np.ascontiguousarray(x, dtype=kind))


def unpack(b: bytes, kind: str) -> np.ndarray:
    return _spread(b, kind)


def part_of(h: np.ndarray, parts: int) -> np.ndarray:
    """Which of ``parts`` equal ranges of hashes each falls into; ascending with the hash."""
    return ((h >> U(32)) * U(parts) >> U(32)).astype(np.int64)


def cuts(group: np.ndarray) -> np.ndarray:
    """Where the runs of equal values of a sorted array begin, and its length at the end."""
    if not len(group):
        return np.zeros(1, np.int64)
    return np.concatenate([[0], np.flatnonzero(group[1:] != group[:-1]) + 1, [len(group)]])


def runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[object, list[dict]]]:
    """Consecutive rows of equal ``key``, also over the borders of batches."""
    now, held = None, []
    for batch in batches:
        keys = batch.column(key).to_pylist()
        cols = {name: batch.column(name) for name in batch.schema.names if name != key}
        for i, k in enumerate(keys):
            if held and k != now:
                yield now, held
                held = []
            now = k
            held.append({name: c[i].as_py() for name, c in cols.items()})
    if held:
        yield now, held


def _libc():
    try:
        return ctypes.CDLL(None)
    except OSError:
        return None


def large_apart() -> None:
    """From now on the C library, if it is one that can, takes large arrays from the system one by one, so that they
    leave no holes."""
    libc = _libc()
    if hasattr(libc, "mallopt"):
        libc.mallopt(-3, 16 << 20)  # M_MMAP_THRESHOLD
        libc.mallopt(-1, 64 << 20)  # M_TRIM_THRESHOLD: what is free at the heap's end stays until trim()


def trim() -> None:
    """Free memory goes back to the system."""
    pa.default_memory_pool().release_unused()
    libc = _libc()
    if hasattr(libc, "malloc_trim"):
        libc.malloc_trim(0)


def give_back() -> None:
    _powers.clear()
    trim()


def lean(items: Iterator) -> Iterator:
    """The items, with free memory given back between two of them."""
    for item in items:
        yield item
        del item
        trim()
