import random
import re

from marlstone.llm.jaccard import keep_first, linked_components

SCHEMA = "doc_id long, text string"


def brute(rows, k=5):
    sets = []
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        sets.append((i, {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()))
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for x in range(len(sets)):
        for y in range(x):
            a, b = sets[x][1], sets[y][1]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                parent[root(x)] = root(y)
    least = {}
    for x, (i, s) in enumerate(sets):
        least[root(x)] = min(least.get(root(x), i), i)
    return sorted((i, len(s), least[root(x)]) for x, (i, s) in enumerate(sets))


def texts(seed, n=300):
    r = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    common = " ".join(r.choice(vocab) for _ in range(40))
    base = [[r.choice(vocab) for _ in range(r.choice([3, 5, 8, 20, 60, 150]))] for _ in range(30)]
    out = [None, "", "   ", "One", "one", "a b c d", "A b c D", "a b c d e", "ß é", "x" * 5000, common, common.upper()]
    while len(out) < n:
        w = list(r.choice(base))
        for _ in range(r.choice([0, 0, 1, 2, 3, 9])):
            w[r.randrange(len(w))] = r.choice(vocab)
        if r.random() < 0.3:
            w += common.split()
        if r.random() < 0.2:
            w = w[r.randrange(4) :]
        out.append(r.choice([" ", "\n", "\t "]).join(w))
    return list(enumerate(out))


def test_components_match_brute_force(spark):
    for seed in (1, 2):
        rows = texts(seed)
        rows += [(5000, rows[40][1]), (5001, rows[40][1])]
        got = linked_components(spark.createDataFrame(rows, SCHEMA).repartition(3))
        assert sorted((r.id, r.n_shingles, r.component_id) for r in got.collect()) == brute(rows)


def test_big_group_of_near_copies(spark):
    r = random.Random(5)
    base = [f"t{i}" for i in range(80)]
    rows = []
    for i in range(400):
        w = list(base)
        w[r.randrange(80)] = f"new{i}"
        rows.append((i, " ".join(w)))
    rows += [(1000 + i, " ".join(base[:40] + [f"o{i}_{j}" for j in range(40)])) for i in range(40)]
    got = linked_components(spark.createDataFrame(rows, SCHEMA))
    assert sorted((x.id, x.n_shingles, x.component_id) for x in got.collect()) == brute(rows)


def test_empty_table_and_clashing_columns(spark):
    assert linked_components(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(7, "a b c d e f", 1, 2), (3, "a b c d e f", 1, 2), (9, None, 1, 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, key int, comp int")
    kept = keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted(x.doc_id for x in kept.collect()) == [3, 9]
