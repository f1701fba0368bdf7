import random
from collections import defaultdict

import numpy as np

from marlstone.llm.packing import best_fit_decreasing, packed
from marlstone.llm.pieces import DEFAULT_MODEL, load

SCHEMA = "doc_id long, text string"


def plain_best_fit(sizes, length):
    packs = []
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        fit = [(length - sum(sizes[x] for x in p), k) for k, p in enumerate(packs) if length - sum(sizes[x] for x in p) >= sizes[i]]
        if fit:
            packs[min(fit)[1]].append(i)
        else:
            packs.append([i])
    return packs


def test_best_fit_fills_like_the_plain_rule():
    r = random.Random(1)
    for length in (1, 7, 64, 100):
        sizes = np.array([r.randint(1, length) for _ in range(200)])
        got, want = best_fit_decreasing(sizes, length), plain_best_fit(sizes.tolist(), length)
        fill = lambda packs: sorted(int(sizes[p].sum()) for p in packs)
        assert fill(got) == fill(want) and sorted(i for p in got for i in p) == list(range(200))
    assert best_fit_decreasing(np.empty(0, np.int64), 5) == []


def test_packs_hold_every_token_once(spark):
    r = random.Random(2)
    rows = [(i, "".join(r.choice(["the ", "ß", "  ", "ción ", "\n"]) for _ in range(r.choice([0, 3, 40, 400])))) for i in range(80)]
    rows += [(100, None), (101, ""), (102, "long " * 5000), (103, "same"), (103, "same")]
    length = 64
    got = packed(spark.createDataFrame(rows, SCHEMA).repartition(2), length=length, block=3000).collect()
    assert len({p.pack_id for p in got}) == len(got)
    parts = defaultdict(list)
    for p in got:
        ids = np.frombuffer(p.ids, "<u2")
        assert len(ids) == length and (ids[p.n_tokens :] == 0).all() and p.cu_seqlens[-1] == p.n_tokens and p.resets == p.cu_seqlens[:-1]
        for d, o, a, b in zip(p.doc_ids, p.doc_offsets, p.cu_seqlens[:-1], p.cu_seqlens[1:], strict=True):
            parts[d].append((o, ids[a:b].tolist()))
    sp = load(DEFAULT_MODEL).sp
    for i, t in rows[:-2]:
        assert [x for _, seg in sorted(parts[i]) for x in seg] == sp.encode(t or "") + [2]
    assert len(parts[103]) == 2
    assert packed(spark.createDataFrame([], SCHEMA)).count() == 0
