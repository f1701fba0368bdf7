"""Sampled segmentations without replacement, by a perturbed A* search over the lattice of pieces.

A text's lattice is that of its units one after the other. The backward sums of piece probabilities give each
node a distribution over its next pieces, and the text a distribution over segmentations. Top-down sampling of
Gumbel values finds the k segmentations of the largest perturbed log probabilities, which is a sample without
replacement: following a path keeps its value; at each step the other pieces together get a Gumbel value
truncated at the path's, and the search goes on at the largest value on its frontier. The next value of the
frontier is the threshold from which each sample's inclusion probability follows.

The model's own scores are merge ranks, so a piece of rank r (1 for the first) has weight 1 / (r + 10); a
character that is no piece is the sequence of its bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import MULT, U, chunks, mix, powers
from .pieces import BLANK, DEFAULT_MODEL, Pieces, Units, gathered, load
from .store import in_arrow, read

SAMPLES = 2
CHUNK = 500_000  # bytes of text that share a lattice
DRAWN = 250_000  # bytes of text whose paths are drawn at a time
INVERSE = pow(MULT, -1, 2**64)


class Lexicon:
    """Pieces by a hash of their characters, and their log probabilities."""

    def __init__(self, p: Pieces):
        own = [i for i in range(len(p.names)) if not p.is_byte[i] and not p.special[i]]
        weight = 1.0 / (np.arange(1, len(own) + 1) + 10.0)
        by_rank = sorted(own, key=lambda i: (-p.sp.get_score(i), i))
        total = weight.sum() + 256 * weight[-1]
        logs = np.zeros(len(p.names))
        logs[by_rank] = np.log(weight / total)
        self.byte_log = float(np.log(weight[-1] / total))
        keys = self.hashes([p.names[i] for i in own])
        order = np.argsort(keys)
        self.keys, self.ids = keys[order], np.array(own, dtype=np.int32)[order]
        self.logs = logs[self.ids]
        self.longest = max(len(p.names[i]) for i in own)
        # By the first bits of a hash: some piece with them, and whether a piece begins so at all.
        self.slot = np.full(1 << 22, -1, dtype=np.int32)
        self.slot[(self.keys >> U(42)).astype(np.int64)] = np.arange(len(self.keys), dtype=np.int32)
        heads = {p.names[i][:w] for i in own for w in range(1, len(p.names[i]) + 1)}
        self.begins = np.zeros(1 << 22, dtype=bool)
        self.begins[(self.hashes(list(heads)) >> U(42)).astype(np.int64)] = True

    def find(self, h: np.ndarray) -> np.ndarray:
        """The place of each hash among the keys, -1 where it is no piece."""
        at = self.slot[(h >> U(42)).astype(np.int64)]
        other = np.flatnonzero((at >= 0) & (self.keys[at] != h))
        if len(other):  # another piece with the same first bits may be meant
            near = np.minimum(np.searchsorted(self.keys, h[other]), len(self.keys) - 1)
            at[other] = np.where(self.keys[near] == h[other], near, -1)
        return at

    @staticmethod
    def hashes(strings: list[str]) -> np.ndarray:
        """The hash of each string, none of them empty, as a lattice computes it for its runs of characters."""
        size = np.fromiter(map(len, strings), np.int64, len(strings))
        cp = np.frombuffer("".join(strings).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
        at = np.cumsum(size) - size
        place = np.arange(len(cp)) - np.repeat(at, size)
        return mix(np.add.reduceat(mix(cp + U(77)) * powers(int(size.max(initial=1)), MULT)[place], at))


_lexicons: dict[str, Lexicon] = {}


def lexicon(path: str) -> Lexicon:
    """The lexicon of a model's path, once in a process."""
    if path not in _lexicons:
        _lexicons[path] = Lexicon(load(path))
    return _lexicons[path]


class Lattice:
    """Nodes and edges of distinct strings. A string of n characters has nodes 0 .. n; edges are sorted by node, long
    ones first."""

    def __init__(self, lex: Lexicon, strings: list[str]):
        size = np.fromiter(map(len, strings), np.int64, len(strings))
        text = "".join(strings).encode("utf-32-le", "surrogatepass")
        cp = np.frombuffer(text, dtype=np.uint32) if text else np.empty(0, np.uint32)
        n = len(cp)
        c = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(mix(cp.astype(np.uint64) + U(77)) * powers(n, MULT), out=c[1:])
        left = (np.repeat(np.cumsum(size), size) - np.arange(n)).astype(np.int32)  # characters from here to the string's end
        found, degree = [], np.zeros(n + 1, dtype=np.int32)
        single = np.zeros(n, dtype=bool)
        live = np.arange(n, dtype=np.int32)
        for w in range(1, lex.longest + 1):
            live = live[left[live] >= w]
            h = mix((c[live + w] - c[live]) * powers(n, INVERSE)[live])
            first = lex.begins[(h >> U(42)).astype(np.int32)]
            live, h = live[first], h[first]  # others begin no piece of this length or more
            if not len(live):
                break
            at = lex.find(h)
            ok = at >= 0
            i, at = live[ok], at[ok]
            if w == 1:
                single[i] = True
            found.append((i, w, lex.ids[at], lex.logs[at]))
            degree[i] += 1
        lone = np.flatnonzero(~single).astype(np.int32)
        octets = 1 + (cp[lone] > 0x7F) + (cp[lone] > 0x7FF) + (cp[lone] > 0xFFFF)
        found.insert(0, (lone, 1, -1 - cp[lone].astype(np.int32), octets * lex.byte_log))
        degree[lone] += 1
        # Long pieces first: they are the likely ones, and a draw looks at a node's edges in order.
        self.first_edge = np.concatenate([[0], np.cumsum(degree, dtype=np.int32)])[: n + 1]
        m = int(degree.sum())
        src, width, piece, logs = np.empty(m, np.int32), np.empty(m, np.int32), np.empty(m, np.int32), np.empty(m)
        free = self.first_edge.copy()
        for i, w, ids, own in found[::-1]:
            to = free[i]
            free[i] += 1
            src[to], width[to], piece[to], logs[to] = i, w, ids, own
        # Backward sums, by distance from the end; a string's last node has 0.
        far = left[src]
        order = np.argsort(far.astype(np.uint16) if n == 0 or left.max() < 1 << 16 else far, kind="stable")
        self.src, self.width, self.piece = src, width, piece
        self.last = width == far  # the edge ends the string
        target = np.where(self.last, n, src + width)  # beta[n] stays 0
        s, to, l = src[order], target[order], logs[order]
        beta = np.zeros(n + 1)
        head = np.flatnonzero(np.append(True, s[1:] != s[:-1])) if len(s) else np.empty(0, np.int64)  # a node's first edge
        fan, node = np.diff(np.append(head, len(s))), s[head]
        level = np.flatnonzero(np.append(True, left[node][1:] != left[node][:-1])) if len(s) else np.empty(0, np.int64)
        for i, j in zip(level.tolist(), [*level.tolist(), len(head)][1:], strict=True):
            a, b = head[i], head[j] if j < len(head) else len(s)
            v, first = l[a:b] + beta[to[a:b]], head[i:j] - a
            top = np.maximum.reduceat(v, first)
            v -= np.repeat(top, fan[i:j])
            beta[node[i:j]] = top + np.log(np.add.reduceat(np.exp(v, out=v), first))
        self.logp = logs + beta[target] - beta[src]
        self.p = np.exp(self.logp)
        self.start = np.cumsum(size) - size


def _uniform(key: np.ndarray, path: int, index: np.ndarray, step: int, kind: int) -> np.ndarray:
    """Numbers in (0, 1) that depend on the row's key, the path, the place and the purpose alone."""
    salt = np.uint64((path * 0x9E3779B97F4A7C15 + step * 0xC2B2AE3D27D4EB4F + kind * 0x165667B19E3779F9) % 2**64)
    return ((mix(key + index.astype(np.uint64) * U(0xD6E8FEB86659FD93) + salt) >> U(12)).astype(np.float64) + 0.5) / 2**52


def _pick(lat: Lattice, node: np.ndarray, u: np.ndarray, without: list[np.ndarray]) -> np.ndarray:
    """An edge of each node by its probability, with the edges of ``without`` (-1: none) left out."""
    e = lat.first_edge[node]
    stop = lat.first_edge[node + 1]
    if not without:
        out = e.astype(np.int64)
        rest = u - lat.p[out]
        live = np.flatnonzero((rest >= 0) & (out + 1 < stop))
        rest, at, stop = rest[live], out[live], stop[live]
        while len(live):
            at += 1
            out[live] = at
            rest -= lat.p[at]
            go = (rest >= 0) & (at + 1 < stop)
            live, rest, at, stop = live[go], rest[go], at[go], stop[go]
        return out
    free = np.ones(len(node))
    for x in without:
        free -= np.where(x >= 0, lat.p[x], 0.0)
    u = u * np.maximum(free, 0)
    out = np.full(len(node), -1)
    live = np.arange(len(node))
    rest = u.copy()
    while len(live):
        at = e[live]
        open_ = np.ones(len(live), bool)
        for x in without:
            open_ &= x[live] != at
        rest[live] -= np.where(open_, lat.p[at], 0.0)
        out[live[open_]] = at[open_]
        e[live] += 1
        live = live[(rest[live] >= 0) & (e[live] < stop[live])]
    return out


class Path:
    """A segmentation of each text: edges in order with the unit each is in, the log probability before each,
    and the Gumbel value of what else there was (-inf: nothing, or it is another path's)."""

    def __init__(self, unit: np.ndarray, edge: np.ndarray, docs: np.ndarray, n_docs: int):
        self.unit, self.edge = unit, edge
        self.at = np.searchsorted(docs[unit], np.arange(n_docs + 1))


def samples(lat: Lattice, of: np.ndarray, doc: np.ndarray, keys: np.ndarray, k: int) -> tuple[list[Path], np.ndarray, np.ndarray, np.ndarray]:
    """k paths (fewer where a text has fewer segmentations: the value is then -inf), with log probabilities,
    Gumbel values and, last, the threshold. ``of`` is each unit's string, ``doc`` its text, ``keys`` the texts'."""
    n, m = len(keys), len(of)
    unit_at = np.searchsorted(doc, np.arange(n + 1))
    within = np.arange(m) - unit_at[doc]
    key = keys[doc]

    def walk(number: int, node: np.ndarray, units_: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Edges from the given nodes to their strings' ends: (unit, edge) in order."""
        us, es, steps, step = [], [], [], 0
        while len(units_):
            e = _pick(lat, node, _uniform(key[units_], number, within[units_], step, 1), [])
            us.append(units_), es.append(e), steps.append(np.full(len(e), step))
            go = ~lat.last[e]
            units_, node, step = units_[go], lat.src[e[go]] + lat.width[e[go]], step + 1
        if not us:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        us, es, steps = map(np.concatenate, (us, es, steps))
        count = np.bincount(us, minlength=m)
        place = (np.cumsum(count) - count)[us] + steps
        out_u, out_e = np.empty(len(us), np.int64), np.empty(len(us), np.int64)
        out_u[place], out_e[place] = us, es
        return out_u, out_e

    def weigh(number: int, path: Path, top: np.ndarray, from_: np.ndarray) -> None:
        """Values of the other pieces at each decision at or after ``from_``; before it they are another path's."""
        d = doc[path.unit]
        logs = lat.logp[path.edge]
        c = np.concatenate([[0.0], np.cumsum(logs)])
        path.before = c[:-1] - c[path.at[:-1]][d]
        path.logp = c[path.at[1:]] - c[path.at[:-1]]
        i = np.arange(len(d)) - path.at[:-1][d]
        rest = 1 - lat.p[path.edge]
        choice = (rest > 1e-15) & (i >= from_[d])  # nothing is left where a node has one piece
        path.value = np.full(len(d), -np.inf)
        j = np.flatnonzero(choice)
        phi = path.before[j] + np.log(rest[j])
        noise = -np.log(_uniform(key[path.unit[j]], number, i[j], 0, 2))
        with np.errstate(over="ignore"):
            path.value[j] = phi - np.log(np.exp(np.minimum(phi - top[d[j]], 700)) + noise)

    def best_of(path: Path) -> tuple[np.ndarray, np.ndarray]:
        """The largest value of each text and where; -inf and -1 if there is none."""
        value, where = np.full(n, -np.inf), np.full(n, -1)
        full = np.flatnonzero(np.diff(path.at) > 0)
        if len(full):
            value[full] = np.maximum.reduceat(path.value, path.at[:-1][full])
            hit = np.flatnonzero(path.value == np.repeat(value, np.diff(path.at)))
            where[doc[path.unit[hit]][::-1]] = hit[::-1]
        where[np.isneginf(value)] = -1
        return value, where

    every = np.arange(m)
    first = Path(*walk(0, lat.start[of], every), doc, n)
    value = -np.log(-np.log(_uniform(keys, 0, np.zeros(n), 0, 3)))
    weigh(0, first, value, np.zeros(n, np.int64))
    paths, values = [first], [value]
    extras: list[dict] = []  # what is left at a decision that was taken up again

    def frontier() -> tuple[np.ndarray, np.ndarray]:
        found = [best_of(p)[0] for p in paths] + [x["value"] for x in extras]
        found = np.stack(found)
        return found.max(axis=0), found.argmax(axis=0)

    for number in range(1, k):
        value, source = frontier()
        have = ~np.isneginf(value)
        base, where = np.zeros(n, np.int64), np.full(n, -1)
        taken = [np.full(n, -1) for _ in range(number)]
        for r, p in enumerate(paths):
            mine = have & (source == r)
            w = best_of(p)[1]
            base[mine], where[mine] = r, w[mine]
            taken[0][mine] = p.edge[w[mine]]
        for j, x in enumerate(extras):
            mine = have & (source == len(paths) + j)
            base[mine], where[mine] = x["base"][mine], x["where"][mine]
            for t, own in enumerate(x["taken"]):
                taken[t][mine] = own[mine]
            x["value"] = np.where(mine, -np.inf, x["value"])
        us, es, from_, again = [], [], np.zeros(n, np.int64), np.full(n, -1)
        left = np.full(n, -np.inf)
        for r, p in enumerate(paths):
            g = np.flatnonzero(have & (base == r))
            if not len(g):
                continue
            at = where[g]
            p.value[at] = -np.inf
            gone = [t[g] for t in taken]
            node = lat.src[p.edge[at]]
            e = _pick(lat, node, _uniform(keys[g], number, at - p.at[g], 0, 4), gone)
            again[g] = e
            from_[g] = at - p.at[g] + 1
            # The path up to here, the new piece, the rest of its unit, and all later units.
            size = at - p.at[g]
            pre = np.repeat(p.at[g], size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            u = p.unit[at]
            go = ~lat.last[e]
            later = np.repeat(u + 1, unit_at[g + 1] - u - 1) + np.arange((unit_at[g + 1] - u - 1).sum()) - np.repeat(np.cumsum(unit_at[g + 1] - u - 1) - (unit_at[g + 1] - u - 1), unit_at[g + 1] - u - 1)
            nodes, own = np.concatenate([lat.src[e[go]] + lat.width[e[go]], lat.start[of[later]]]), np.concatenate([u[go], later])
            order = np.argsort(own, kind="stable")
            wu, we = walk(number, nodes[order], own[order])
            parts = [(p.unit[pre], p.edge[pre], 0), (u, e, 1), (wu, we, 2)]
            uu, ee, rank = (np.concatenate([x[0] for x in parts]), np.concatenate([x[1] for x in parts]), np.concatenate([np.full(len(x[0]), x[2]) for x in parts]))
            order = np.lexsort((rank, uu))
            us.append(uu[order]), es.append(ee[order])
            free = 1 - sum(np.where(x >= 0, lat.p[x], 0.0) for x in [*gone, e])
            count = lat.first_edge[node + 1] - lat.first_edge[node] - sum((x >= 0).astype(np.int64) for x in [*gone, e])
            j = np.flatnonzero((count > 0) & (free > 1e-15))
            phi = p.before[at[j]] + np.log(free[j])
            noise = -np.log(_uniform(keys[g[j]], number, at[j] - p.at[g[j]], 0, 5))
            left[g[j]] = phi - np.log(np.exp(np.minimum(phi - value[g[j]], 700)) + noise)
        extras.append({"value": left, "base": base, "where": where, "taken": [*taken, again]})
        uu, ee = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (us, es))
        order = np.argsort(doc[uu], kind="stable") if len(uu) else np.empty(0, np.int64)
        path = Path(uu[order].astype(np.int64), ee[order].astype(np.int64), doc, n)
        weigh(number, path, value, from_)
        paths.append(path), values.append(value)
    return paths, np.stack([p.logp for p in paths]), np.stack(values), frontier()[0]


def piece_ids(p: Pieces, lat: Lattice, path: Path, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids of a path's texts, bytes for characters that are no pieces, and how many each has."""
    piece = lat.piece[path.edge]
    d = np.repeat(np.arange(n), np.diff(path.at))
    if (piece < 0).any():
        size = np.ones(len(piece), np.int64)
        odd = np.flatnonzero(piece < 0)
        coded = [chr(-1 - int(x)).encode("utf-8", "surrogatepass") for x in piece[odd]]
        size[odd] = [len(c) for c in coded]
        out = np.repeat(piece, size)
        out[np.repeat(piece < 0, size)] = p.byte_ids[np.frombuffer(b"".join(coded), np.uint8)]
        return out, np.bincount(d, weights=size, minlength=n).astype(np.int64)
    return piece, np.bincount(d, minlength=n)


ID = "<u4"  # an id in a binary cell


def _cells(flat: np.ndarray, count: np.ndarray, width: str | None) -> pa.Array:
    """One cell for each run of ``count`` ids: a list, or with ``width`` their bytes."""
    at = np.concatenate([[0], np.cumsum(count)]).astype(np.int64)
    if width is None:
        return pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(flat.astype(np.int32, copy=False)))
    raw = np.ascontiguousarray(flat, dtype=width)
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(count), [None, pa.py_buffer(at * raw.itemsize), pa.py_buffer(raw)]).cast(pa.binary())


def _coded(path: str, k: int, as_bytes: bool = False):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = load(path)
        lex = lexicon(path)
        width = ID if as_bytes else None
        for batch in batches:
            for i, j, data, offs in chunks(batch.column(2), CHUNK):
                yield _chunk(p, lex, batch.column(0).slice(i, j - i), batch.column(1).slice(i, j - i), data, offs, k, width)
        _lexicons.clear()  # a worker that stands idle keeps no model

    return run


def _chunk(p: Pieces, lex: Lexicon, names: pa.Array, salts: pa.Array, data: np.ndarray, offs: np.ndarray, k: int, width: str | None) -> pa.RecordBatch:
    n = len(names)
    u = Units(data, offs)
    ids, per = p.encode(data, offs, u)
    exact = _exact(p, ids, per, data, offs)
    own = _cells(ids, per, width)
    del ids
    lat = Lattice(lex, [BLANK + t.replace(" ", BLANK) for t in u.texts])
    keys = mix(salts.to_numpy(zero_copy_only=False).view(np.uint64))
    logp, value, threshold = np.zeros((k, n)), np.full((k, n), -np.inf), np.full(n, -np.inf)
    flat, count = [], np.zeros((k, n), np.int64)
    start = np.zeros((k, n), np.int64)
    a = total = 0
    while a < n:  # the lattice serves all texts of the chunk; paths are drawn for some at a time
        z = max(a + 1, int(np.searchsorted(offs, offs[a] + DRAWN, side="right")) - 1)
        s, e = np.searchsorted(u.doc, [a, z])
        paths, logp[:, a:z], value[:, a:z], threshold[a:z] = samples(lat, u.of[s:e], u.doc[s:e] - a, keys[a:z], k)
        for r, x in enumerate(paths):
            got, count[r, a:z] = piece_ids(p, lat, x, z - a)
            start[r, a:z] = total + np.cumsum(count[r, a:z]) - count[r, a:z]
            flat.append(got.astype(width or np.int32))
            total += len(got)
        del paths
        a = z
    score = logp - threshold
    with np.errstate(over="ignore", divide="ignore", invalid="ignore"):
        inclusion = np.where(score < -30, score, np.log(-np.expm1(-np.exp(np.minimum(score, 700)))))
    inclusion[:, np.isneginf(threshold)] = 0.0
    there = (~np.isneginf(value) & (per > 0)).T  # by text, then in order of value
    size = count.T[there]
    drawn = np.concatenate(flat)[gathered(start.T[there], size)] if len(size) else np.empty(0, np.int32)
    rows = pa.StructArray.from_arrays([_cells(drawn, size, width), *(pa.array(x.T[there]) for x in (logp, value, inclusion))], names=["ids", "logp", "value", "log_inclusion"])
    lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(there.sum(axis=1))]).astype(np.int32)), rows)
    return pa.record_batch([names, own, pa.array(exact), lists], names=["id", "ids", "exact", "samples"])


def _exact(p: Pieces, ids: np.ndarray, per: np.ndarray, data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Whether each text's ids decode to its very bytes."""
    back, at = p.decode(ids, per)
    if len(back) != len(data):
        return np.array([back[at[t] : at[t + 1]].tobytes() == data[offs[t] : offs[t + 1]].tobytes() for t in range(len(per))])
    same = np.concatenate([[0], np.cumsum(back == data, dtype=np.int32 if len(data) < 1 << 31 else np.int64)])
    return (np.diff(at) == np.diff(offs)) & (same[offs[1:]] - same[offs[:-1]] == np.diff(offs))


OUT = "id long, ids {0}, exact boolean, samples array<struct<ids: {0}, logp: double, value: double, log_inclusion: double>>"


def coded(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str = DEFAULT_MODEL, k: int = SAMPLES, seed: int = 1, as_bytes: bool = False) -> DataFrame:
    """(id, ids, exact, samples) for each row of ``docs``: the model's own encoding, whether its decoding gives
    the text back byte by byte, and up to ``k`` different sampled segmentations, largest perturbed value first,
    each with ids, log probability, value and log of its inclusion probability.

    ``model`` is the path of a SentencePiece file, the same on all executors. The noise depends on ``seed`` and
    the row's id alone, so a retry draws the same, and another partitioning too, up to the rounding of sums. A
    null or empty text has no ids and no samples; a text with one segmentation has one sample. Texts that hold
    U+2581 are sampled as if it were a blank, and their decoding is not exact. Repeated rows give equal rows; a
    null id counts as 0 for the noise. Other columns are not looked at. With ``as_bytes`` ids are binary cells of
    little-endian 32-bit numbers.
    """
    key = F.xxhash64(F.coalesce(F.col(id_col).cast("long"), F.lit(0)), F.lit(seed))
    base = docs.select(F.col(id_col).cast("long").alias("id"), key.alias("key"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return in_arrow(base, _coded(model, k, as_bytes), OUT.format("binary" if as_bytes else "array<int>"))


def id_bytes() -> int:
    """Bytes of an id in a binary cell."""
    return np.dtype(ID).itemsize


def op3_sentencepiece(spark, sf_dir: str) -> DataFrame:
    """Each document's ids and those of its sampled segmentations, as binary cells, with digests beside them."""
    found = coded(read(spark, sf_dir, "documents"), as_bytes=True)
    wide = id_bytes()
    sampled = F.transform(
        "samples",
        lambda s: F.struct(s["ids"].alias("ids"), (F.octet_length(s["ids"]) / wide).cast("int").alias("n_ids"), s["logp"].alias("logp"), s["value"].alias("value"), s["log_inclusion"].alias("log_inclusion")),
    )
    return found.select(F.col("id").alias("doc_id"), "ids", (F.octet_length("ids") / wide).cast("int").alias("n_ids"), F.crc32("ids").alias("ids_crc32"), "exact", sampled.alias("samples"))
