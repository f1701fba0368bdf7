import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from marlstone.llm.lattice import Lattice, coded, lexicon, piece_ids, samples
from marlstone.llm.pieces import DEFAULT_MODEL, load

SCHEMA = "doc_id long, text string"
TEXTS = [None, "", " ", "  ", "a", " a", "Hello  wörld\n x ", "tab\tund\r\nß 漢字 😀 \x00", "nicht " * 300, "x" * 3000, "   three", "tail   ", "12 + 34 = 46", "İstanbul é é"]


def segmentations(p, lex, s):
    """All (ids, probability) of a string by plain recursion."""
    logs = dict(zip((p.names[i] for i in lex.ids), lex.logs, strict=True))

    def go(i):
        if i == len(s):
            yield [], 0.0
        for w in range(1, min(16, len(s) - i) + 1):
            piece = s[i : i + w]
            if piece in logs or (w == 1 and piece not in logs):
                own = [p.sp.piece_to_id(piece)] if piece in logs else [int(p.byte_ids[b]) for b in piece.encode()]
                for ids, score in go(i + w):
                    yield own + ids, score + (logs[piece] if piece in logs else len(own) * lex.byte_log)

    found = [(tuple(ids), math.exp(x)) for ids, x in go(0)]
    total = sum(x for _, x in found)
    return {ids: x / total for ids, x in found}


def draw(strings, n, k):
    p, lex = load(DEFAULT_MODEL), lexicon(DEFAULT_MODEL)
    lat = Lattice(lex, strings)
    of = np.tile(np.arange(len(strings)), n)
    doc = np.repeat(np.arange(n), len(strings))
    keys = np.random.Generator(np.random.PCG64(1)).integers(0, 2**63, n, dtype=np.uint64)
    paths, logp, value, threshold = samples(lat, of, doc, keys, k)
    ids = []
    for x in paths:
        flat, per = piece_ids(p, lat, x, n)
        ids.append([tuple(a.tolist()) for a in np.split(flat, np.cumsum(per)[:-1])])
    return ids, logp, value, threshold


@pytest.mark.parametrize("k", [1, 3])
def test_sampling_follows_the_exact_distribution(k):
    p, lex = load(DEFAULT_MODEL), lexicon(DEFAULT_MODEL)
    strings, n = ["▁into", "▁é"], 20_000
    exact = {a + b: x * y for a, x in segmentations(p, lex, strings[0]).items() for b, y in segmentations(p, lex, strings[1]).items()}
    ids, logp, value, threshold = draw(strings, n, k)
    first = Counter(ids[0])
    for s, prob in exact.items():
        assert abs(first[s] / n - prob) < 4 * math.sqrt(prob / n) + 1e-3
    assert all(abs(logp[0, t] - math.log(exact[ids[0][t]])) < 1e-9 for t in range(0, n, 50))
    if k == 3:
        assert all(len({ids[r][t] for r in range(3)}) == 3 for t in range(n))
        assert (value[0] >= value[1]).all() and (value[1] >= value[2]).all() and (value[2] >= threshold).all()
        second = defaultdict(float)  # probability of the second draw, without the first
        for a, x in exact.items():
            for b, y in exact.items():
                if a != b:
                    second[b] += x * y / (1 - x)
        got = Counter(ids[1])
        for s, prob in second.items():
            assert abs(got[s] / n - prob) < 4 * math.sqrt(prob / n) + 2e-3
        # Weighted by inverse inclusion probabilities, the samples estimate the whole mass without bias.
        score = logp - threshold
        weight = np.exp(logp) / -np.expm1(-np.exp(score))
        assert abs(weight.sum(axis=0).mean() - 1) < 0.02


def test_all_segmentations_come_out_once():
    p, lex = load(DEFAULT_MODEL), lexicon(DEFAULT_MODEL)
    exact = segmentations(p, lex, "▁in")
    ids, _, value, threshold = draw(["▁in"], 50, len(exact) + 2)
    for t in range(50):
        got = [ids[r][t] for r in range(len(ids)) if not np.isneginf(value[r, t])]
        assert sorted(got) == sorted(exact)
    assert np.isneginf(threshold).all()


def test_encoding_equals_the_library_and_decodes_exactly(spark):
    r = random.Random(5)
    texts = TEXTS + ["".join(r.choice(["a", " ", "  ", "\n", "the", "ß", "ción", "▁", "😀"]) for _ in range(40)) for _ in range(60)]
    rows = list(enumerate(texts))
    sp = load(DEFAULT_MODEL).sp
    got = {x.id: x for x in coded(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()}
    for i, t in rows:
        # The library gives nothing for an empty text and drops no blank; one lone blank is its own piece.
        want = sp.encode(t or "")
        assert got[i].ids == want, (t, got[i].ids, want)
        assert got[i].exact == ("▁" not in (t or ""))
        for s in got[i].samples:
            if "▁" not in (t or ""):
                assert sp.decode(s.ids) == t
            assert s.log_inclusion <= 0
        assert len({tuple(s.ids) for s in got[i].samples}) == len(got[i].samples)
    assert len(got[8].samples) == 2 and got[0].samples == [] and got[1].samples == []
    again = {x.id: x for x in coded(spark.createDataFrame(rows[::-1], SCHEMA).repartition(1)).collect()}
    assert all([x.ids for x in again[i].samples] == [x.ids for x in got[i].samples] for i in got)
    assert coded(spark.createDataFrame([], SCHEMA)).count() == 0


def test_query_gives_whole_ids_that_decode_to_the_text(spark):
    from marlstone.llm.lattice import id_bytes, op3_sentencepiece

    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    sp, kind = load(DEFAULT_MODEL).sp, f"<u{id_bytes()}"
    got = op3_sentencepiece(spark, folder).collect()
    assert len(got) == len(texts)
    for r in got:
        text = texts[r.doc_id] or ""
        ids = np.frombuffer(r.ids, kind).tolist()
        assert len(ids) == r.n_ids and ids == sp.encode(text) and sp.decode(ids) == text and r.exact
        for s in r.samples:
            own = np.frombuffer(s.ids, kind).tolist()
            assert len(own) == s.n_ids and sp.decode(own) == text


def test_null_ids_and_columns_of_other_use(spark):
    rows = [(None, "one two", "x", 1), (None, "one two", "x", 1), (7, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, key int")
    got = sorted((r.id or 0, r.ids, len(r.samples)) for r in coded(docs).collect())
    assert got[0] == got[1] and got[2] == (7, [], 0)
