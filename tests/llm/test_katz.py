import math
import random
import re
from collections import Counter, defaultdict

import pytest

from marlstone.llm.katz import K, Unigrams, discounts, katz_scores

SCHEMA = "doc_id long, text string, train boolean"


def tokens(t):
    return re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower()) + ["</s>"]


def brute(rows, order=2, least=2):
    """Scores by plain recursion over dictionaries."""
    uni, grams = Counter(), {m: defaultdict(Counter) for m in range(2, order + 1)}
    for _, t, train in rows:
        if train:
            w = tokens(t)
            uni.update(w)
            w = ["<s>", *w]
            for m in grams:
                for i in range(m, len(w) + 1):
                    grams[m][tuple(w[i - m : i - 1])][w[i - 1]] += 1
    # A context of two words or more that is rarer than ``least`` is left out; what it is counted as is itself an n-gram.
    for m in range(3, order + 1):
        grams[m] = {h: x for h, x in grams[m].items() if sum(x.values()) >= least}
    n, v = sum(uni.values()), len(uni)
    counts = lambda cs: [0.0, *[float(sum(c == k for c in cs)) for k in range(1, K + 2)]]
    model = Unigrams(n, v, counts(uni.values()))
    d = {m: discounts(counts([c for x in grams[m].values() for c in x.values()])) for m in grams}
    import numpy as np

    def p(h, w):
        if not h:
            return float(model.p(np.array([uni[w]]))[0])
        m = len(h) + 1
        seen = grams[m].get(h)
        if not seen:
            return p(h[1:], w)
        total = sum(seen.values())
        kept = sum((d[m][c] if c <= K else 1) * c for c in seen.values())
        base = total + 1 if all(c > K for c in seen.values()) else total
        if w in seen:
            c = seen[w]
            return (d[m][c] if c <= K else 1) * c / base
        return (1 - kept / base) / (1 - sum(p(h[1:], x) for x in seen)) * p(h[1:], w)

    for m in grams:
        for h in list(grams[m])[:20]:
            assert sum(p(h, w) for w in uni) + p(h, "never seen") == pytest.approx(1)
    out = []
    for i, t, _ in rows:
        w = tokens(t)
        base = sum(math.log10((uni[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w)
        s = ["<s>", *w]
        score = sum(math.log10(p(tuple(s[max(0, j - order + 1) : j]), s[j])) for j in range(1, len(s)))
        out.append((i, len(w), sum(uni[x] > 0 for x in w), n, base, score))
    return out


def rows(seed, n=120):
    r = random.Random(seed)
    vocab = [f"W{i}é" for i in range(150)]
    pick = lambda: vocab[min(int(r.paretovariate(0.6)), 149)]
    out = [(0, None, True), (1, "", False), (2, " \n", True), (3, "the only\tone", False), (4, "z" * 3000, True)]
    return out + [(i, r.choice([" ", "\n"]).join(pick() for _ in range(r.choice([1, 5, 60]))), r.random() < 0.8) for i in range(5, n)]


@pytest.mark.parametrize("hot,block,order,least", [(1 << 18, 2_000_000, 2, 2), (7, 150, 2, 2), (1 << 18, 2_000_000, 3, 2), (7, 150, 3, 2), (5, 200, 4, 3)])
def test_scores_match_brute_force(spark, hot, block, order, least):
    data = rows(3)
    got = {r.id: r for r in katz_scores(spark.createDataFrame(data, SCHEMA).repartition(2), block=block, hot=hot, order=order, least=least).collect()}
    for i, n, known, total, base, score in brute(data, order, least):
        r = got[i]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, total)
        assert r.base_score == pytest.approx(base) and r.score == pytest.approx(score, rel=1e-5)


@pytest.mark.parametrize("kwargs", [{}, {"block": 150}, {"block": 150, "hot": 7, "rounds": 3}])
def test_contexts_that_training_has_once_or_twice_count(spark, kwargs):
    data = rows(8)
    got = {r.id: r.score for r in katz_scores(spark.createDataFrame(data, SCHEMA).repartition(2), **kwargs).collect()}
    for i, *_, score in brute(data, 3, 1):
        assert got[i] == pytest.approx(score, rel=1e-5)


def test_nothing_to_learn_from_and_empty_table(spark):
    got = katz_scores(spark.createDataFrame([(1, "a b", False), (None, None, None)], SCHEMA)).collect()
    assert sorted((r.n_tokens, r.n_known, r.score, r.base_score) for r in got) == [(1, 0, 0.0, 0.0), (3, 0, 0.0, 0.0)]
    assert katz_scores(spark.createDataFrame([], SCHEMA)).count() == 0
