import random
import re
from itertools import combinations

import pytest

from marlstone.llm.decontaminate import MASKS, PERCENT, SEGMENT, contamination, drop_contaminated

DOCS, BENCH = "doc_id long, text string", "item_id long, text string"


def toks(t):
    return re.findall(r"[0-9a-z\x80-\U0010ffff]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))


def brute(docs, bench):
    """Every diagonal of every item; a stretch counts if a mask, or the whole short item, agrees somewhere."""
    out = {}
    for d, t in docs:
        w, found = toks(t), []
        for i, b in bench:
            q = toks(b)
            masks = list(MASKS) + (["1" * len(q)] if 0 < len(q) < min(map(len, MASKS)) else [])
            best = None
            for s in range(-len(q), len(w) + 1) if q else ():
                a, e = max(s, 0), min(s + len(q), len(w))
                same = [w[k] == q[k - s] for k in range(a, e)]
                seed = any(all(same[k + x] for x, m in enumerate(mask) if m == "1") for mask in masks for k in range(len(same) - len(mask) + 1))
                need = min(SEGMENT, len(q))
                if seed and any(100 * sum(same[k : k + need]) >= PERCENT * need for k in range(len(same) - need + 1)):
                    best = max(best or 0, sum(same))
            if best:
                found.append((-best, i, len(q)))
        found.sort()
        out[d] = (len(found), found[0][1], -found[0][0], found[0][2]) if found else (0, None, None, None)
    return out


def data(seed=4):
    r = random.Random(seed)
    word = lambda: f"{r.choice('abcdefgh')}{r.randrange(60)}é"
    bench = [(i, " ".join(word() for _ in range(r.choice([1, 4, 7, 9, 13, 20, 40])))) for i in range(30)] + [(90, None), (91, " ,, "), (92, "")]
    docs = [(0, None), (1, ""), (2, "  ..."), (3, "q " * 3000)]
    for i in range(4, 150):
        w = [word() for _ in range(r.choice([2, 30, 120]))]
        if r.random() < 0.6:
            x = toks(r.choice(bench[:30])[1])
            for _ in range(r.choice([0, 0, 1, 2, 4])):
                x[r.randrange(len(x))] = word()
            x = x[r.choice([0, 0, 3]) :]
            at = r.randrange(len(w) + 1)
            w[at:at] = x
        docs.append((i, r.choice([" ", ", ", "\n## "]).join(w).upper() if r.random() < 0.3 else " ".join(w)))
    return docs, bench


@pytest.mark.parametrize("limit", [1_000_000, 150])
def test_against_all_diagonals(spark, limit):
    docs, bench = data()
    got = contamination(spark.createDataFrame(docs, DOCS).repartition(2), spark.createDataFrame(bench, BENCH), index_tokens=limit)
    assert {r.id: (r.n_items, r.item_id, r.agreeing, r.item_tokens) for r in got.collect()} == brute(docs, bench)


def test_drop_keeps_clean_rows_and_columns(spark):
    item = " ".join(f"w{i}" for i in range(20))
    rows = [(1, item, 5), (2, "clean text", 6), (2, "clean text", 6), (None, None, 7), (3, None, 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_items int")
    kept = drop_contaminated(docs, spark.createDataFrame([(1, item)], BENCH))
    assert kept.columns == docs.columns and sorted(r.n_items for r in kept.collect()) == [6, 6, 7, 8]
    empty = spark.createDataFrame([], BENCH)
    assert drop_contaminated(docs, empty).count() == 5
    assert drop_contaminated(spark.createDataFrame([], DOCS), empty).count() == 0


def test_every_pattern_that_the_rule_accepts_is_found(spark):
    """All copies of an item with as many substitutions as 80 % of 13 tokens, or of a shorter item, allow; no masks."""
    docs, bench, want = [], [], {}
    for n in (*range(1, 14), 15, 20):
        item = [f"i{n}w{k}" for k in range(n)]
        bench.append((n, " ".join(item)))
        need = min(SEGMENT, n)
        for subs in range(4):
            for gone in combinations(range(n), subs):
                same = [k not in gone for k in range(n)]
                i = len(docs)
                want[i] = any(100 * sum(same[k : k + need]) >= PERCENT * need for k in range(n - need + 1))
                docs.append((i, " ".join(["before", *(w if s else "other" for w, s in zip(item, same, strict=True)), "after"])))
    got = contamination(spark.createDataFrame(docs, DOCS).repartition(4), spark.createDataFrame(bench, BENCH))
    assert {r.id: r.n_items == 1 for r in got.collect()} == want
