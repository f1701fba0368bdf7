import math
import zlib
from collections import Counter, defaultdict

from marlstone.llm.shards import BUCKETS, PRIME, SEED, SPREAD, keys, permuted, sharded, write_shards

SCHEMA = "doc_id long, text string"


def place(x, n, seed=SEED):
    side = math.isqrt(n - 1) + 1 if n > 1 else 1
    while True:
        left, right = divmod(x, side)
        for a, b, c in keys(seed):
            left, right = right, (left + (((right + a) % PRIME) * ((right + b) % PRIME) % PRIME * c) % PRIME) % side
        x = left * side + right
        if x < n:
            return x


def test_permutation_is_a_bijection_and_matches_plain_python(spark):
    for n in (1, 2, 3, 5, 100, 997, 5000):
        got = [r.p for r in spark.range(n).selectExpr(f"{permuted('id', f'{n}L')} as p", "id").orderBy("id").collect()]
        assert got == [place(x, n) for x in range(n)] and sorted(got) == list(range(n))


def test_shards_hold_the_law_of_rows(spark):
    rows = [(i, f"text {i % 50} é") for i in range(3001)] + [(7, "text 7 é"), (7, "text 7 é"), (None, None), (8, None), (9, "")]
    got = sharded(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()
    assert len(got) == len(rows) and {r.law for r in got} == {"rows"} and {r.grown_shard for r in got} == {None}
    counts = Counter(r.shard for r in got)
    assert max(counts.values()) - min(counts.values()) <= 1
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    want = Counter((i, len((t or "").encode()) + 1, None if t is None else zlib.crc32(t.encode())) for i, t in rows)
    assert Counter((r.id, r.size, r.text_crc32) for r in got) == want
    again = sharded(spark.createDataFrame(rows[::-1], SCHEMA)).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))
    order = sorted(((i or 0) % PRIME * SPREAD % PRIME % BUCKETS, i is not None, i or 0, len((t or "").encode()) + 1, -1 if t is None else zlib.crc32(t.encode())) for i, t in rows)
    first = place(0, len(rows))
    assert any(r.shard == first % 8 and r.slot == first // 8 and (r.id or 0) == order[0][2] for r in got)


def test_write_keeps_columns_of_any_name(spark, tmp_path):
    docs = spark.createDataFrame([(i, "x" * i, i, 2 * i, f"s{i}", i, i) for i in range(40)], "doc_id long, text string, bucket int, own int, shard string, row_number int, id int")
    write_shards(docs, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 40 and {r.shard for r in back.select("shard").distinct().collect()} == set(range(8))
    assert all((r.bucket, r.own, r.own_shard, r.row_number, r.id, r.text) == (r.doc_id, 2 * r.doc_id, f"s{r.doc_id}", r.doc_id, r.doc_id, "x" * r.doc_id) for r in back.collect())
    assert sharded(docs.limit(0)).count() == 0
