"""SentencePiece encoding and decoding of whole columns.

No piece of the model has a blank after another character, so a text is encoded unit by unit, a unit being a
run of blanks with what follows up to the next blank. Only the distinct units of a chunk are given to the
library; the rest is gathering of arrays.
"""

from __future__ import annotations

import os
from itertools import chain

import numpy as np
import sentencepiece

from .blocks import mix, span_hashes

BLANK = "▁"
CHUNK = 1_000_000  # bytes of text at a time
DEFAULT_MODEL = os.path.join("/opt/tokenizers", "piece_bpe_32k.model")


def units(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of each unit, without its first blank: the model puts one before every text,
    so the unit at a text's start and one after a blank have the same form."""
    n = len(offs) - 1
    full = np.flatnonzero(np.diff(offs) > 0)
    blank = data == 32
    # A unit begins at a blank after another character, and at each text's start.
    begin = np.zeros(len(data) + 1, dtype=bool)
    begin[1:-1] = blank[1:] & ~blank[:-1] if len(data) else False
    at_start = np.zeros(len(data) + 1, dtype=bool)
    at_start[offs[:-1][full]] = True
    start = np.flatnonzero(begin | at_start)
    end = np.append(start[1:], len(data)) if len(start) else start
    doc = np.searchsorted(offs, start, side="right") - 1
    return start + ~at_start[start], end, np.minimum(doc, n - 1)


def gathered(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Indexes of all elements of runs that begin at ``start`` and have ``size`` elements, one run after the other."""
    total = int(size.sum())
    kind = np.int32 if max(total, int(start.max(initial=0)) + total) < 1 << 31 else np.int64
    out = np.arange(total, dtype=kind)
    out += np.repeat((start - (np.cumsum(size) - size)).astype(kind), size)
    return out


class Units:
    """The units of texts, and the distinct ones among them: ``of`` is each unit's number among these."""

    def __init__(self, data: np.ndarray, offs: np.ndarray):
        self.start, self.end, self.doc = units(data, offs)
        h = mix(span_hashes(data, self.start, self.end, None))
        order = np.argsort(h)
        h = h[order]
        new = np.ones(len(h), dtype=bool)
        new[1:] = h[1:] != h[:-1]
        first, self.of = order[new], np.empty(len(h), dtype=np.int32)
        self.of[order] = np.cumsum(new, dtype=np.int32) - 1
        self.raw = data.tobytes()
        self.empty = np.flatnonzero(self.end[first] == self.start[first])
        self.texts = [self.raw[a:b].decode() for a, b in zip(self.start[first].tolist(), self.end[first].tolist(), strict=True)]


class Pieces:
    """A model's vocabulary as arrays, and the coder."""

    def __init__(self, path: str = DEFAULT_MODEL):
        self.sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.sp.get_piece_size()
        self.names = [self.sp.id_to_piece(i) for i in range(n)]
        self.is_byte = np.array([self.sp.is_byte(i) for i in range(n)])
        self.special = np.array([self.sp.is_control(i) or self.sp.is_unknown(i) for i in range(n)])
        surface = [bytes([int(p[3:5], 16)]) if b else b"" if s else p.replace(BLANK, " ").encode() for p, b, s in zip(self.names, self.is_byte, self.special, strict=True)]
        self.size = np.array([len(s) for s in surface], dtype=np.int64)
        self.offset = np.cumsum(self.size) - self.size
        self.bytes = np.frombuffer(b"".join(surface), dtype=np.uint8)
        self.byte_ids = np.full(256, self.sp.unk_id(), dtype=np.int64)
        for i in np.flatnonzero(self.is_byte):
            self.byte_ids[int(self.names[i][3:5], 16)] = i
        self.blank = self.sp.piece_to_id(BLANK)
        if any(BLANK in p.lstrip(BLANK) for p in self.names):
            raise ValueError("this model has pieces with a blank after other characters")

    def encode(self, data: np.ndarray, offs: np.ndarray, u: Units | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, and how many each has; as the library gives them."""
        n = len(offs) - 1
        u = u or Units(data, offs)
        doc, of, raw = u.doc, u.of, u.raw
        if not len(doc):
            return np.empty(0, np.int32), np.zeros(n, np.int64)
        coded = self.sp.encode(u.texts, num_threads=1)
        for i in u.empty:
            coded[i] = [self.blank]
        size = np.fromiter(map(len, coded), np.int64, len(coded))
        flat = np.fromiter(chain.from_iterable(coded), np.int32, int(size.sum()))
        at = np.cumsum(size) - size
        count = size[of]
        ids = flat[gathered(at[of], count)]
        per = np.bincount(doc, weights=count, minlength=n).astype(np.int64)
        # The library takes a blank's own sign for a blank; a unit border must not fall beside one.
        if BLANK.encode() in raw:
            keep = np.concatenate([[0], np.cumsum(per)])
            parts = [ids[a:b] for a, b in zip(keep[:-1], keep[1:], strict=True)]
            for t in range(n):
                text = raw[offs[t] : offs[t + 1]]
                if BLANK.encode() in text:
                    parts[t] = np.array(self.sp.encode(text.decode()), np.int32)
            per = np.fromiter(map(len, parts), np.int64, n)
            ids = np.concatenate(parts)
        return ids, per

    def decode(self, ids: np.ndarray, per: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all texts and their offsets; the blank before each text is taken off."""
        size = self.size[ids]
        total = int(size.sum())
        out = self.bytes[gathered(self.offset[ids], size)]
        ends = np.cumsum(size)
        last = np.cumsum(per)
        offs = np.concatenate([[0], np.where(last > 0, np.append(ends, 0)[last - 1], 0)]).astype(np.int64)
        full = per > 0
        keep = np.ones(total, dtype=bool)
        head = offs[:-1][full]
        keep[head[out[head] == 32]] = False
        c = np.zeros(total + 1, dtype=np.int32 if total < 1 << 31 else np.int64)
        np.cumsum(keep, out=c[1:])
        return out[keep], c[offs].astype(np.int64)


_loaded: dict[str, Pieces] = {}


def load(path: str) -> Pieces:
    """The model of a path, once in a process."""
    if path not in _loaded:
        _loaded[path] = Pieces(path)
    return _loaded[path]
