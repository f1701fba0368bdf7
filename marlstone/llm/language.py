"""Language identification by a multilingual mixture.

Each language is a distribution over hashed 4-byte n-grams inside words. A document is a mixture: expectation
maximisation estimates the share of its words that each language of a set gives, and the set grows from the
best single language as long as the likelihood gains more than a penalty for one more language.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import CHUNK, LOWER, NOT_ALNUM, chunks, cuts, words
from .store import in_arrow, materialize, read, row_is

BINS = 1 << 17
TRAIN_DOCS = 20_000  # labelled documents that the model is fitted on, about; chosen by a hash of their id
ROUNDS = 10  # of expectation maximisation
PENALTY = 2.0  # times log(words), for each further language
NO_LETTER = NOT_ALNUM.copy()
NO_LETTER[48:58] = True


def word_grams(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """n-gram bins of all words in order; where each word's begin; each word's text number."""
    start, end, doc = words(data, offs, NO_LETTER)
    if not len(start):
        none = np.empty(0, np.int64)
        return none, none, none
    low = LOWER[data]
    if len(low) > 1:  # capitals of Latin-1: C3 80 to C3 9E
        up = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
        low[1:][up] += 0x20
    size = end - start
    at = np.cumsum(size) - size
    k = np.repeat(np.arange(len(size)), size)
    letters = np.arange(size.sum())
    stream = np.full(size.sum() + 2 * len(size) + 3, 32, dtype=np.uint32)  # a word stands between blanks
    dst = letters + 2 * k + 1
    stream[dst] = low[start[k] + letters - at[k]]
    w = dst - 1
    x = (stream[w] << np.uint32(24)) | (stream[w + 1] << np.uint32(16)) | (stream[w + 2] << np.uint32(8)) | stream[w + 3]
    x = x * np.uint32(0x9E3779B1)
    return ((x ^ (x >> np.uint32(15))) * np.uint32(0x85EBCA77) >> np.uint32(15)).astype(np.int64), at, doc


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[str, np.ndarray] = {}
    for batch in batches:
        langs = np.array(batch.column(0).to_pylist(), dtype=object)
        for i, j, data, offs in chunks(batch.column(1)):
            grams, at, doc = word_grams(data, offs)
            if not len(at):
                continue
            of = np.repeat(doc, np.diff(np.append(at, len(grams))))
            for lang in set(langs[i:j]):
                own = total.setdefault(lang, np.zeros(BINS, np.int64))
                own += np.bincount(grams[(langs[i:j] == lang)[of]], minlength=BINS)
    for lang, own in total.items():
        b = np.flatnonzero(own)
        yield pa.record_batch([pa.array([lang] * len(b), pa.string()), pa.array(b), pa.array(own[b])], names=["lang", "bin", "n"])


class Model:
    """langs, and log probabilities by bin and language."""

    def __init__(self, langs: list[str], logs: np.ndarray):
        self.langs, self.logs = langs, logs

    def mixtures(self, data: np.ndarray, offs: np.ndarray, rounds: int = ROUNDS, penalty: float = PENALTY) -> tuple[np.ndarray, np.ndarray]:
        """Shares by text and language (0: outside its set), and the certainty of the best single language."""
        docs, m = len(offs) - 1, len(self.langs)
        share, sure = np.zeros((docs, m)), np.zeros(docs)
        grams, at, doc = word_grams(data, offs)
        if not len(at) or not m:
            return share, sure
        ll = np.add.reduceat(self.logs[grams], at, axis=0)
        c = cuts(doc)
        own, c = doc[c[:-1]], c[:-1]  # texts that have words
        n = np.diff(np.append(c, len(doc)))
        of = np.repeat(np.arange(len(own)), n)
        single = np.add.reduceat(ll.astype(np.float64), c, axis=0)
        best = single.argmax(axis=1)
        rows = np.arange(len(own))
        gap = single - single[rows, best][:, None]
        sure[own] = 1 / np.exp(np.clip(gap, -700, 0)).sum(axis=1)
        top = ll.max(axis=1)
        like = np.exp(ll - top[:, None]).astype(np.float64) + 1e-30
        chosen = np.zeros((len(own), m), bool)
        chosen[rows, best] = True
        pi = chosen.astype(np.float64)
        score = np.add.reduceat(np.log(like[np.arange(len(of)), best[of]]), c)
        active = rows
        while len(active) and chosen[active].sum(axis=1).max() < m:
            pick = np.isin(of, active)
            sub = np.searchsorted(active, of[pick])
            lk, first = like[pick], cuts(sub)[:-1]
            gain, which, shares = np.full(len(active), -np.inf), np.zeros(len(active), np.int64), pi[active].copy()
            for lang in range(m):
                free = ~chosen[active, lang]
                if not free.any():
                    continue
                s = chosen[active].astype(np.float64)
                s[:, lang] = 1
                p = s / s.sum(axis=1, keepdims=True)
                for _ in range(rounds):
                    r = p[sub] * lk
                    r /= r.sum(axis=1, keepdims=True)
                    p = np.add.reduceat(r, first, axis=0) / n[active][:, None]
                now = np.add.reduceat(np.log((p[sub] * lk).sum(axis=1)), first) - score[active]
                better = free & (now > gain)
                gain[better], which[better], shares[better] = now[better], lang, p[better]
            ok = gain > penalty * np.log(n[active] + 1)
            active, which, shares, gain = active[ok], which[ok], shares[ok], gain[ok]
            chosen[active, which] = True
            pi[active] = shares
            score[active] += gain
        share[own] = pi
        return share, sure


def _cap(sizes: list[int], total: int) -> float:
    """What each size is cut to so that their sum is ``total`` at most."""
    left = total
    for k, n in enumerate(sorted(sizes)):
        if n * (len(sizes) - k) > left:
            return left / (len(sizes) - k)
        left -= n
    return float("inf")


def _sample(have: DataFrame, max_docs: int) -> DataFrame:
    """About ``max_docs`` rows of ``have`` (id, lang, text) if there are more; sizes of languages are estimates."""
    sizes = have.groupBy("lang").agg(F.count("*").alias("n"), F.approx_count_distinct(F.xxhash64("id", "text")).alias("m")).collect()
    if sum(r["n"] for r in sizes) <= max_docs:
        return have
    cap = _cap([r["m"] for r in sizes], max_docs)
    part = have.sparkSession.createDataFrame([(r["lang"], int(min(1.0, cap / r["m"]) * (1 << 31))) for r in sizes], "lang string, below long")
    taken = F.pmod(F.xxhash64("id", "text"), F.lit(1 << 31)) < F.col("below")
    return have.join(F.broadcast(part), "lang").where(taken).dropDuplicates(["id", "lang", "text"])


def train(docs: DataFrame, id_col: str, text_col: str, lang_col: str, max_docs: int = TRAIN_DOCS) -> Model:
    """Fits the n-gram distributions. If there are more labelled rows than ``max_docs``, about that many are
    taken: all of each rare language, and of each other one as many, those of least hash of id and text, without
    repeats of both. The driver gets one number for each language and bin."""
    have = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    have = _sample(have, max_docs)
    table = in_arrow(have.select("lang", "text"), _counts, "lang string, bin long, n long").groupBy("lang", "bin").agg(F.sum("n").alias("n")).toArrow()
    langs = sorted(set(table.column("lang").to_pylist()))
    count = np.zeros((BINS, len(langs)))
    where = {lang: k for k, lang in enumerate(langs)}
    count[table.column("bin").to_numpy(), [where[x] for x in table.column("lang").to_pylist()]] = table.column("n").to_numpy()
    logs = np.log((count + 0.05) / (count.sum(axis=0) + 0.05 * BINS))
    return Model(langs, logs.astype(np.float32))


def _predict(model, rounds: int, penalty: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = model.value
        names = np.array([*m.langs, "und"], dtype=object)
        for batch in batches:
            letter = batch.column("letter").to_numpy(zero_copy_only=False)
            for i, j, data, offs in chunks(batch.column("text"), max(10_000, CHUNK * 4 // max(4, len(m.langs)))):
                share, sure = m.mixtures(data, offs, rounds, penalty)
                known = letter[i:j] & (share.sum(axis=1) > 0) if len(m.langs) else np.zeros(j - i, bool)
                top = np.where(known, share.argmax(axis=1), len(m.langs)) if len(m.langs) else np.zeros(j - i, np.int64)
                score = np.where(known, share.max(axis=1, initial=0) * sure, 0.0)
                order = np.argsort(-share, axis=1, kind="stable")
                sets = [[names[k] for k in o if share[t, k] > 0] if known[t] else [] for t, o in enumerate(order)]
                parts = [[float(share[t, k]) for k in o if share[t, k] > 0] if known[t] else [] for t, o in enumerate(order)]
                own = [n for n in batch.schema.names if n not in ("letter", "text")]
                yield pa.record_batch([*(batch.column(n).slice(i, j - i) for n in own), pa.array(names[top], pa.string()), pa.array(np.clip(score, 0, 1)), pa.array(sets, pa.list_(pa.string())), pa.array(parts, pa.list_(pa.float64()))], names=[*own, "lang_pred", "score", "langs", "shares"])

    return run


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS, penalty: float = PENALTY, with_same: bool = False) -> DataFrame:
    """(id, lang_pred, score, langs, shares) for each row of ``docs``: the language of the largest share, that
    share times the certainty of the best single language, and the selected languages with their shares.

    Whole texts are read. A null text, one without a letter, or any text under a model without languages is
    ``und`` with score 0 and no languages. Ties go to the language first in order. Rows, also repeated ones,
    give one row each; other columns are not looked at. ``with_same`` adds a hash of the text, which tells
    texts of one id apart.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    same = [F.xxhash64(F.col(text_col).cast("string")).alias("same")] if with_same else []
    base = docs.select(F.col(id_col).cast("long").alias("id"), *same, text.rlike(r"\p{L}").alias("letter"), text.alias("text"))
    return in_arrow(base, _predict(docs.sparkSession.sparkContext.broadcast(model), rounds, penalty), f"id long, {'same long, ' if with_same else ''}lang_pred string, score double, langs array<string>, shares array<double>")


def drop_unknown(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text has a language: all but ``und``. Each row is judged by its own text; ids may
    be null or repeated."""
    # Written first: Spark then knows how few they are, and shuffles the texts only if they are many.
    gone = materialize(identify(docs, model, id_col, text_col, with_same=True).where("lang_pred = 'und'").select("id", "same").distinct())
    return docs.join(gone, row_is(docs, id_col, text_col, gone), "left_anti")


def held_out(col: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(col).cast("string")) % 3 == 1, F.lit(False))


def op8_language_mixture(spark, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = train(docs.where(~held_out()), "doc_id", "text", "lang")
    return identify(docs, model).select(F.col("id").alias("doc_id"), held_out("id").alias("held_out"), "lang_pred", "score", "langs", "shares")
