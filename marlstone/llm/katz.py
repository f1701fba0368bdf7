"""Language-model scores by a Katz backoff model over words.

Texts are kept as blocks of word numbers with a small vocabulary of their own. Blocks ask partitioned tables
for what they need and get it back by block, so no table is ever held whole anywhere:

* unigrams, partitioned by word: training counts of the block's words;
* n-grams of each order from 2 on, partitioned by context: training counts of the block's distinct n-grams, and
  of each context how many of its successors occur once, twice ... K times, and the mass that the
  next lower order gives to its successors.

A block evaluates its tokens recursively: the probabilities of one order are what the asks of the next one carry
and what that order backs off to. A context of very many tokens is split by its successors into parts of bounded
size; what its parts know of it is added up by context and joined to the blocks that have it. Only counts of
counts (a few numbers) reach the driver.

The tables also tell which words and n-grams stand in one block alone. Whatever follows such a context stands there
too, so the block counts its successors itself and asks nothing: most of the rare contexts are of this kind.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import U, chunks, lean, mix, pack, pack_sorted, part_of, runs, unpack, unpack_sorted, word_hashes
from .store import delete, in_arrow, materialize, partitions, read

ORDER = 3
LEAST = 1  # training count of a context of two words or more, below which it backs off at once: only unseen ones do
BLOCK = 1_000_000  # tokens of a block, if no text is longer
PART = 1_000_000  # tokens of the input for each part of a table
TASK = 32_000_000  # tokens of the input for each task at most
ROUNDS = 2  # the parts of orders above two are asked in so many rounds, which share the room for asks
OFTEN = 1 << 12  # words that get small numbers in a block
HOT = 1 << 18  # training tokens of a context that one part takes
K = 5  # counts up to K are discounted
EDGE = np.uint64(0x2545F4914F6CDD00)  # stands for the end of a text, and as context for its start
GOLD = U(0x9E3779B97F4A7C15)


def discounts(n: list[float]) -> np.ndarray:
    """Katz's discount ratio d[c] of counts 1..K from the counts of counts n[1..K+1]; d[0] is unused. Where
    Good and Turing's estimate leaves (0, 1), as with few data, all ratios are (c - D) / c with
    D = n1 / (n1 + 2 n2), or 1/2 if that is not within (0, 1)."""
    d = np.ones(K + 1)
    c = np.arange(1, K + 1)
    with np.errstate(divide="ignore", invalid="ignore"):
        a = (K + 1) * n[K + 1] / n[1] if n[1] else np.inf
        got = ((c + 1) * np.array(n[2:]) / np.array(n[1:-1]) / c - a) / (1 - a)
    if np.all(np.isfinite(got)) and np.all((got > 0) & (got < 1)):
        d[1:] = got
    else:
        less = n[1] / (n[1] + 2 * n[2]) if n[1] and n[2] else 0.5
        d[1:] = (c - less) / c
    return d


class Unigrams:
    """P(w) from the word's training count: discounted, the rest of the mass is that of all unknown words."""

    def __init__(self, tokens: int, types: int, counts: list[float]):
        self.n, self.v = tokens, types
        self.d = discounts(counts)
        seen = sum(self.d[c] * c * counts[c] for c in range(1, K + 1)) + tokens - sum(c * counts[c] for c in range(1, K + 1))
        self.scale = 1.0
        if tokens and seen >= tokens:  # no word is rare: the unknown get the share of one token
            self.scale = tokens / (tokens + 1)
        self.unknown = 1 - self.scale * seen / tokens if tokens else 1.0

    def p(self, c: np.ndarray) -> np.ndarray:
        if not self.n:
            return np.ones(len(c))
        return np.where(c > 0, self.scale * self.d[np.where(c <= K, c, 0)] * c / self.n, self.unknown)


STORE = [("block", pa.int64()), ("size", pa.int64()), ("ids", pa.list_(pa.int64())), ("train", pa.binary()), ("n", pa.binary()), ("vocab", pa.binary()), ("often", pa.binary()), ("stream", pa.binary())]
STORE_SQL = "block long, size long, ids array<long>, train binary, n binary, vocab binary, often binary, stream binary"
WORDS = [("part", pa.int32()), ("block", pa.int64()), ("words", pa.binary()), ("c", pa.binary())]
WORDS_SQL = "part int, block long, words binary, c binary"
ASK = [("part", pa.int32()), ("block", pa.int64()), *((n, pa.binary()) for n in ("contexts", "grams", "words", "lower", "c", "hot_at", "hot_of"))]
ASK_SQL = "part int, block long, contexts binary, grams binary, words binary, lower binary, c binary, hot_at binary, hot_of binary"
#: Of a context of several parts: its hash, successors that occur 1 .. K times, mass of its successors.
HOT_SQL = f"array<struct<context: long, {', '.join(f'f{k}: long' for k in range(K))}, mass: double>>"
HOT_ROW = pa.list_(pa.struct([("context", pa.int64()), *((f"f{k}", pa.int64()) for k in range(K)), ("mass", pa.float64())]))
ANSWER = [("part", pa.int32()), ("block", pa.int64()), *((n, pa.binary()) for n in ("counts", "few", "mass", "hot_of")), ("tokens", pa.int64()), ("types", pa.int64()), ("cc", pa.list_(pa.int64())), ("hot", HOT_ROW)]
ANSWER_SQL = f"part int, block long, counts binary, few binary, mass binary, hot_of binary, tokens long, types long, cc array<long>, hot {HOT_SQL}"
SCORE_SQL = "id long, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _batch(rows: list[tuple], fields: list[tuple]) -> pa.RecordBatch:
    cols = zip(*rows, strict=True) if rows else [[]] * len(fields)
    return pa.record_batch([pa.array(x, t) for x, (_, t) in zip(cols, fields, strict=True)], names=[n for n, _ in fields])


def _grouped(key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct keys in order, a place of each, and the number of each entry's key; ``key`` is changed."""
    order = np.argsort(key)
    key = key[order]
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    which = np.empty(len(key), np.int32)
    which[order] = np.cumsum(new, dtype=np.int32) - 1
    return key[new], order[new].astype(np.int32), which


def _told(total: np.ndarray, key: np.ndarray, last: bool = False) -> np.ndarray:
    """For each entry the count of its key, and in the lowest bit whether no other entry has it: a block asks for
    a word or an n-gram once, so it then stands in that block alone. Of the last order that is not told."""
    return (total << 1 | (0 if last else np.bincount(key, minlength=len(total)) == 1))[key]


def _heard(told: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (told >> U(1)).astype(np.int64), (told & U(1)).astype(bool)


def _listed(words: np.ndarray) -> bytes:
    """Hashes of 40 bits as places in a list of the distinct ones."""
    own, _, at = _grouped(words)
    head = pack_sorted(own)
    return len(head).to_bytes(8, "little") + head + pack(at, "u4")


def _unlisted(b: bytes) -> np.ndarray:
    n = int.from_bytes(b[:8], "little")
    return unpack_sorted(b[8 : 8 + n])[unpack(b[8 + n :], "u4")]


def _places(often: np.ndarray, n: int) -> np.ndarray:
    """The words by the numbers they have in a stored stream: frequent ones first, which makes it shorter."""
    rest = np.ones(n, bool)
    rest[often] = False
    return np.concatenate([often, np.flatnonzero(rest)])


def _blocks(limit: int):
    def flush(ids: list, train: list, h: list, n: list, number: int) -> pa.RecordBatch:
        vocab, stream = np.unique(np.concatenate(h), return_inverse=True)
        often = np.argsort(-np.bincount(stream), kind="stable")[:OFTEN]
        row = (number, len(stream), pa.chunked_array(ids).to_pylist(), pack(np.concatenate(train), "u1"), pack(np.concatenate(n), "u4"), pack_sorted(vocab >> U(8)), pack(often, "u4"), pack(np.argsort(_places(often, len(vocab)))[stream], "u4"))
        return _batch([row], STORE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        ids, train, h, n, size = [], [], [], [], 0
        for batch in batches:
            flags = batch.column(1).to_numpy(zero_copy_only=False).astype(np.uint8)
            for i, j, data, offs in chunks(batch.column(2)):
                w, doc = word_hashes(data, offs)
                m = np.bincount(doc, minlength=j - i)
                tokens = np.full(len(w) + j - i, EDGE)
                tokens[np.arange(len(w)) + doc] = w  # each text ends with the edge
                ids.append(batch.column(0).slice(i, j - i)), train.append(flags[i:j]), h.append(tokens >> U(8) << U(8)), n.append(m + 1)
                size += len(tokens)
                if size >= limit:
                    yield flush(ids, train, h, n, number)
                    ids, train, h, n, size, number = [], [], [], [], 0, number + 1
        if size:
            yield flush(ids, train, h, n, number)

    return run


class Block:
    """A block's arrays. After level one, grams() fixes the order in which the n-grams and contexts of the next
    order are asked for and answered, and answered() brings the probabilities of the tokens to that order."""

    def __init__(self, row: dict):
        self.ids = row["ids"]
        self.n, self.train = unpack(row["n"], "u4").astype(np.int64), unpack(row["train"], "u1").astype(bool)
        self.vocab = unpack_sorted(row["vocab"]) << U(8)
        self.stream = _places(unpack(row["often"], "u4"), len(self.vocab)).astype(np.int32)[unpack(row["stream"], "u4")]
        self.learn = np.repeat(self.train, self.n)
        self.at = np.cumsum(self.n) - self.n
        self.place = np.arange(len(self.stream), dtype=np.int32) - np.repeat(self.at.astype(np.int32), self.n)

    def words(self, told: np.ndarray, model: Unigrams) -> None:
        """Level one: ``told`` is what the tables say of each word of the vocabulary."""
        count, self.gram_alone = _heard(told)
        self.order, self.count = 1, count
        self.p = model.p(count)[self.stream]
        self.gram, self.gram_hash, self.gram_count = self.stream, self.vocab, count

    def grams(self, hot: int, least: int) -> None:
        self.order += 1
        context = np.full(len(self.stream), -1, np.int32)
        context[1:] = self.gram[:-1]
        if self.order == 2:
            context[self.at] = np.searchsorted(self.vocab, EDGE)
            self.tokens = np.arange(len(context), dtype=np.int32)
        else:
            context[self.place < self.order - 2] = -1
            self.tokens = np.flatnonzero((context >= 0) & (self.gram_count[context] >= least)).astype(np.int32)
        context = context[self.tokens]
        # Slots are contexts, or the parts of one that is split; ranked by hash they come in order of the tables' parts.
        there = np.zeros(len(self.gram_hash), bool)
        there[context] = True
        x = np.flatnonzero(there)
        split = np.where(self.gram_alone[x], 1, np.maximum(1, -(-self.gram_count[x] // hot)))
        at = np.zeros(len(there), np.int64)
        at[x] = np.cumsum(split) - split
        slot_x, slot_hot = np.repeat(x, split), np.repeat(split > 1, split)
        sub = np.arange(len(slot_x)) - at[slot_x]
        h = mix(self.gram_hash[slot_x] + GOLD * np.where(slot_hot, sub + 1, 0).astype(np.uint64))
        order = np.argsort(h)
        rank = np.empty(len(h), np.int64)
        rank[order] = np.arange(len(h))
        slot = at[context]
        many = np.flatnonzero(slot_hot[slot])
        of = np.searchsorted(x, context[many])
        slot[many] += (mix(self.vocab[self.stream[self.tokens[many]]] ^ U(0x1B873593)) % split[of].astype(np.uint64)).astype(np.int64)
        v = len(self.vocab)
        own, first, self.which = _grouped(rank[slot] * v + self.stream[self.tokens])
        del slot, rank, many, of
        self.first, self.y = self.tokens[first], (own % v).astype(np.int32)
        grams_of = np.bincount(own // v, minlength=len(h))
        full = np.flatnonzero(grams_of)  # a part of a split context may hold none of the block's words
        self.slot_n, self.slot_x = grams_of[full], slot_x[order][full]
        self.slot_hash, self.slot_hot = h[order][full], slot_hot[order][full]
        self.slot = np.repeat(np.arange(len(full), dtype=np.int32), self.slot_n)
        self.slot_own = self.gram_alone[self.slot_x]  # contexts that stand in no other block: nobody is asked

    def counts(self) -> np.ndarray:
        """The block's own training counts of its n-grams."""
        return np.bincount(self.which, weights=self.learn[self.tokens], minlength=len(self.y)).astype(np.int64)

    def own_tally(self) -> np.ndarray:
        """Counts of counts of the n-grams that nobody is asked for."""
        c = self.counts()[self.slot_own[self.slot]]
        return np.bincount(c[c <= K + 1], minlength=K + 2)

    def asks(self, parts: int, number: int = 0, rounds: int = 1) -> Iterator[tuple]:
        """For each part of a round the contexts, how many n-grams each has, words, of those in training what gives their lower
        order (the count of a word, or the probability), their counts, and of contexts in several parts their
        places and hashes."""
        ask, of = np.flatnonzero(~self.slot_own), ~self.slot_own[self.slot]
        c, y = self.counts()[of], self.y[of]
        lower, kind = (self.count[y], "u8") if self.order == 2 else (self.p[self.first[of]], "f4")
        words = self.vocab[y] >> U(24)
        h, n, many, x = self.slot_hash[ask], self.slot_n[ask], self.slot_hot[ask], self.slot_x[ask]
        at = np.append(np.cumsum(n) - n, len(y))
        edges = np.searchsorted(part_of(h, parts), np.arange(parts + 1))
        for p in np.flatnonzero(np.diff(edges)):
            if p % rounds != number:
                continue
            s, t = edges[p], edges[p + 1]
            a, b = at[s], at[t]
            hot = np.flatnonzero(many[s:t])
            yield (
                int(p), pack_sorted(h[s:t] >> U(8)), pack(n[s:t], "u4"), _listed(words[a:b]),
                pack(lower[a:b][c[a:b] > 0], kind), pack(c[a:b], "u4"), pack(hot, "u4"), pack(self.hot_of(x[s:t][hot]), "i8"),
            )

    def hot_of(self, x: np.ndarray) -> np.ndarray:
        """What contexts in several parts are known by."""
        return (mix(self.gram_hash[x] ^ U(0x68E31DA4)) >> U(1)).astype(np.int64)

    def hot_contexts(self) -> np.ndarray:
        return np.unique(self.hot_of(np.unique(self.slot_x[self.slot_hot])))

    def answered(self, rows: list[dict], hot: list[dict], d: np.ndarray) -> None:
        """``rows``: the parts' answers in order; ``hot``: what is known of contexts in several parts."""
        none = [np.empty(0)]
        own, ask = self.slot_own[self.slot], ~self.slot_own
        c, alone = self.counts(), own.copy()
        c[~own], alone[~own] = _heard(np.concatenate([unpack(r["counts"], "u8") for r in rows] or [np.empty(0, np.uint64)]))
        # Whatever stands in a text is followed by something, if only by its end: a context's total is its own count.
        total = self.gram_count[self.slot_x].astype(np.float64)
        few, mass = np.empty((K, len(total)), np.uint32), np.empty(len(total))
        few[:, ask] = np.concatenate([unpack(r["few"], "u4").reshape(K, -1) for r in rows] or [np.empty((K, 0), np.uint32)], axis=1)
        mass[ask] = np.concatenate([unpack(r["mass"], "f4") for r in rows] or none)
        if not ask.all():  # as a part does it, and rounded as a part's answer is
            e = np.flatnonzero(own & (c > 0))
            s, lower = self.slot[e], self.p[self.first[e]]
            if self.order > 2:
                lower = lower.astype(np.float32)
            mass[~ask] = np.bincount(s, weights=lower, minlength=len(total))[~ask].astype(np.float32)
            for k in range(K):
                few[k, ~ask] = np.bincount(s[c[e] == k + 1], minlength=len(total))[~ask]
        if self.slot_hot.any():
            known = sorted(hot, key=lambda r: r["context"])
            of = np.searchsorted(np.array([r["context"] for r in known]), self.hot_of(self.slot_x[self.slot_hot]))
            mass[self.slot_hot] = np.array([r["mass"] for r in known])[of]
            for k in range(K):
                few[k, self.slot_hot] = np.array([r[f"f{k}"] for r in known], np.uint32)[of]
        kept = total - sum((1 - d[k + 1]) * (k + 1) * few[k] for k in range(K))
        # No rare successor: nothing is held back by the discounts, so one more token's share is.
        base = np.where((kept >= total) & (total > 0), total + 1, total)
        with np.errstate(divide="ignore", invalid="ignore"):
            alpha = np.where(total > 0, (1 - kept / base) / (1 - mass), 1.0)
            p = np.where(c > 0, d[np.where(c <= K, c, 0)] * c / base[self.slot], alpha[self.slot] * self.p[self.first])
        self.p = self.p.copy()
        self.p[self.tokens] = p[self.which]
        self.gram = np.full(len(self.stream), -1, np.int32)
        self.gram[self.tokens] = self.which
        self.gram_hash, self.gram_count = mix(self.gram_hash[self.slot_x[self.slot]] * U(0xD6E8FEB86659FD93) + self.vocab[self.y]), c
        self.gram_alone = alone


def _unigram_asks(parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, rows in runs(batches, "block"):
            b = Block(rows[0])
            c = np.bincount(b.stream, weights=b.learn, minlength=len(b.vocab)).astype(np.int64)
            e = np.searchsorted(part_of(b.vocab, parts), np.arange(parts + 1))
            yield _batch([(int(p), block, pack_sorted(b.vocab[e[p] : e[p + 1]]), pack(c[e[p] : e[p + 1]], "u4")) for p in np.flatnonzero(np.diff(e))], WORDS)

    return run


def _tallied(part: int, total: np.ndarray, hot: list[dict] | None = None) -> tuple:
    """A part's row of sums: tokens, types, counts of counts, and what it knows of contexts in several parts."""
    return part, None, None, None, None, None, int(total.sum()), int((total > 0).sum()), np.bincount(total[total <= K + 1], minlength=K + 2).tolist(), hot


def _unigram_answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, rows in runs(batches, "part"):
        h, c = [unpack_sorted(r["words"]) for r in rows], [unpack(r["c"], "u4") for r in rows]
        words, at = np.unique(np.concatenate(h), return_inverse=True)
        total = np.bincount(at, weights=np.concatenate(c), minlength=len(words)).astype(np.int64)
        told, out, i = _told(total, at), [], 0
        for r, x in zip(rows, h, strict=True):
            out.append((part, r["block"], pack(told[i : i + len(x)], "u8"), *[None] * 7))
            i += len(x)
        yield _batch([*out, _tallied(part, total)], ANSWER)


def _standing(rows: list[dict], model: Unigrams, ds: list[np.ndarray], hot: int, least: int) -> Block:
    """A block with all that has been answered so far, and the n-grams of the next order if there is one to come."""
    b = Block(next(r for r in rows if r["kind"] == 0))
    of = lambda kind: [r for r in rows if r["kind"] == kind]
    b.words(np.concatenate([unpack(r["counts"], "u8") for r in of(2)]), model)
    for k, d in enumerate(ds):
        b.grams(hot, least)
        b.answered(of(2 * k + 4), [x for r in of(2 * k + 5) for x in r["hot"]], d)
    return b


def _asks(model: Unigrams, ds: list[np.ndarray], parts: int, hot: int, least: int, number: int, rounds: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, rows in lean(runs(batches, "block")):
            b = _standing(rows, model, ds, hot, least)
            b.grams(hot, least)
            out = [(x[0], block, *x[1:]) for x in b.asks(parts, number, rounds)]
            if not number:  # passes the parts untouched
                out.append((int(block % parts), block, *[None] * 4, pack(b.own_tally(), "i8"), None, pack(b.hot_contexts(), "i8")))
            yield _batch(out, ASK)

    return run


def _answers(model: Unigrams | None, last: bool):
    """Of the parts of one order; ``model`` gives the probabilities of words, for order two; ``last``: no order follows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, rows in runs(batches, "part"):
            passed = [x for r in rows if r["contexts"] is None for x in ((-1, r["block"], *[None] * 3, r["hot_of"], *[None] * 4), (part, *[None] * 5, 0, 0, unpack(r["c"], "i8").tolist(), None))]
            rows = [r for r in rows if r["contexts"] is not None]
            if passed:
                yield _batch(passed, ANSWER)
            if rows:
                yield _batch(_part(part, rows, model, last), ANSWER)

    return run


def _part(part: int, rows: list[dict], model: Unigrams | None, last: bool) -> list[tuple]:
    v = [unpack_sorted(r["contexts"]) for r in rows]
    n = np.concatenate([unpack(r["grams"], "u4") for r in rows])
    w = [_unlisted(r["words"]) for r in rows]
    c = np.concatenate([unpack(r["c"], "u4") for r in rows])
    contexts, _, slot = _grouped(np.concatenate(v))
    if len(contexts) >> 24:
        raise ValueError("a part has too many contexts; take more parts")
    keys, _, pair = _grouped(np.repeat(slot, n).astype(np.uint64) << U(40) | np.concatenate(w))
    total = np.bincount(pair, weights=c, minlength=len(keys)).astype(np.int64)
    lower = np.zeros(len(keys))
    if model is None:
        lower[pair[c > 0]] = np.concatenate([unpack(r["lower"], "f4") for r in rows])  # the same from every block
    else:
        lower[pair[c > 0]] = model.p(np.concatenate([unpack(r["lower"], "u8") for r in rows]).astype(np.int64))
    own, seen, m = (keys >> U(40)).astype(np.int64), total > 0, len(contexts)
    few = np.stack([np.bincount(own[total == k], minlength=m) for k in range(1, K + 1)])
    mass = np.bincount(own[seen], weights=lower[seen], minlength=m)
    told, out, i, j, hot = _told(total, pair, last), [], 0, 0, {}
    for r, a, b in zip(rows, v, w, strict=True):
        s = slot[i : i + len(a)]
        out.append((part, r["block"], pack(told[j : j + len(b)], "u8"), pack(few[:, s].ravel(), "u4"), pack(mass[s], "f4"), *[None] * 5))
        hot.update(zip(s[unpack(r["hot_at"], "u4")].tolist(), unpack(r["hot_of"], "i8").tolist(), strict=True))
        i, j = i + len(a), j + len(b)
    known = [{"context": h, **{f"f{k}": int(few[k, s]) for k in range(K)}, "mass": float(mass[s])} for s, h in sorted(hot.items())]
    return [*out, _tallied(part, total, known)]


def _hot_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = [unpack(b, "i8") for b in batch.column("hot_of").to_pylist()]
        yield pa.record_batch([batch.column("block"), pa.array(lists, pa.list_(pa.int64()))], names=["block", "contexts"])


def _by_block(answers: DataFrame) -> DataFrame:
    """(block, hot): what the parts of a split context know, added up, for every block that has the context."""
    sums = [F.sum(c).alias(c) for c in (*(f"f{k}" for k in range(K)), "mass")]
    known = answers.where("hot is not null").selectExpr("inline(hot)").groupBy("context").agg(*sums)
    asked = in_arrow(answers.where("part = -1").select("block", "hot_of"), _hot_lists, "block long, contexts array<long>")
    met = asked.select("block", F.explode("contexts").alias("context")).join(known, "context")
    return materialize(met.groupBy("block").agg(F.collect_list(F.struct("context", *(f"f{k}" for k in range(K)), "mass")).alias("hot")))


def _scores(model: Unigrams, ds: list[np.ndarray], hot: int, least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in lean(runs(batches, "block")):
            b = _standing(rows, model, ds, hot, least)
            with np.errstate(divide="ignore"):
                word = np.log10((b.count + 0.1) / (model.n + 0.1 * (model.v + 1)))[b.stream]
                cols = [np.add.reduceat(x, b.at) for x in (np.log10(b.p), word, (b.count > 0)[b.stream].astype(np.int64))]
            yield pa.record_batch([pa.array(b.ids, pa.int64()), pa.array(b.n), pa.array(cols[2]), pa.array(np.full(len(b.at), model.n, np.int64)), pa.array(cols[1]), pa.array(cols[0])], names=["id", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return run


def _facts(answers: DataFrame) -> tuple[int, int, list[float]]:
    """Tokens, types and counts of counts 0..K+1 over all parts: one row of sums."""
    row = answers.where("block is null").agg(F.sum("tokens"), F.sum("types"), *[F.sum(F.col("cc")[k]) for k in range(K + 2)]).first()
    return int(row[0] or 0), int(row[1] or 0), [float(x or 0) for x in row[2:]]


def katz_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", train_col: str = "train", order: int = ORDER, least: int = LEAST, block: int = BLOCK, hot: int = HOT, rounds: int = ROUNDS) -> DataFrame:
    """(id, n_tokens, n_known, train_tokens, base_score, score) for each row of ``docs``.

    Tokens are the lower-cased (A-Z) words between white space and one end of text. The model learns from rows
    whose ``train_col`` is true (null: false) and scores all. base_score is the add-0.1 unigram log10
    probability; score is that of the Katz model of the given ``order``: a seen n-gram gets its discounted
    relative frequency, another backs off to the next lower order times the context's weight, which makes the
    successors of every context, unknown words included, sum to 1. A text's first words have as long a context as
    there is; its start counts as one word. With ``least`` above one, contexts of two words or more that training
    has fewer times are left out, as if never seen. A null or empty text is its end alone. With no training text every
    score is 0. Rows, also repeated ones, give one row each; other columns are not looked at.

    ``block`` is the number of tokens held together (one text at least), ``hot`` that of a context's training
    tokens in one part. With more ``rounds`` the asks of an order above two take less disk at a time and more
    time. Words are compared by 56-bit hash, in n-grams by 56 bits of their context's and 40 of
    their own. Masses of successors are told in single precision, and above order two summed from such numbers.
    """
    spark = docs.sparkSession
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(train_col).cast("boolean"), F.lit(False)).alias("train"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    store = materialize(in_arrow(base, _blocks(block), STORE_SQL))
    size = store.agg(F.sum("size")).first()[0] or 0
    tasks = max(partitions(spark), -(-size // TASK))
    parts = max(tasks, -(-size // PART))
    store = store.drop("size")

    def meet(asks: DataFrame) -> DataFrame:
        return asks.repartition(tasks, "part").sortWithinPartitions("part", "block")

    given: list[tuple[int, DataFrame]] = []
    own = ["ids", "train", "n", "vocab", "often", "stream"]
    got = ["part", "counts", "few", "mass", "hot"]
    kinds = {"ids": "array<long>", "part": "int", "hot": HOT_SQL}
    none = lambda names: [F.lit(None).cast(kinds.get(c, "binary")).alias(c) for c in names]

    def by_block() -> DataFrame:
        out = store.select("block", F.lit(0).alias("kind"), *own, *none(got))
        for kind, a in given:
            have = [F.col(c) if c in a.columns and c != "hot" or kind % 2 and c == "hot" else none([c])[0] for c in got]
            out = out.unionByName(a.select("block", F.lit(kind).alias("kind"), *none(own), *have))
        return out.repartition(tasks, "block").sortWithinPartitions("block", "kind", "part")

    answers = materialize(in_arrow(meet(in_arrow(store, _unigram_asks(parts), WORDS_SQL)), _unigram_answers, ANSWER_SQL))
    model = Unigrams(*_facts(answers))
    given.append((2, answers.where("block is not null")))
    ds: list[np.ndarray] = []
    for n in range(2, order + 1):
        answers = None
        for number in range(rounds if n > 2 else 1):
            asks = in_arrow(by_block(), _asks(model, ds, parts, hot, least, number, rounds if n > 2 else 1), ASK_SQL)
            if n > 2:  # written first: the blocks' shuffle is given back before the asks are dealt out
                asks = materialize(asks)
            some = materialize(in_arrow(meet(asks), _answers(model if n == 2 else None, n == order), ANSWER_SQL))
            if n > 2:
                delete(asks)
            answers = some if answers is None else answers.unionByName(some)
        ds = [*ds, discounts(_facts(answers)[2])]
        given += [(2 * n, answers.where("block is not null and part >= 0")), (2 * n + 1, _by_block(answers))]
    return in_arrow(by_block(), _scores(model, ds, hot, least), SCORE_SQL)


def op10_katz_backoff(spark, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 10 == 0, F.lit(False))
    found = katz_scores(docs.withColumn("train", ~held))
    return found.select(F.col("id").alias("doc_id"), F.coalesce(F.crc32(F.col("id").cast("string")) % 10 == 0, F.lit(False)).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
