"""Every operator over columns that are named like its own, repeated rows, null ids, null, empty and odd texts, and no rows."""

import pytest

from marlstone.llm import decontaminate, forest, jaccard, katz, language, lattice, packing, pii, secrets, shards

OWN = "id same key n kind train part block bucket own before row_number row_count gone kept rows comp lang_pred letter x h ids size base spans rest found taken proposed place shard slot text_crc32 counts vocab stream marked i s row values cell bad k".split()


@pytest.fixture(scope="module")
def docs(spark):
    words = " ".join(f"Wort{i}" for i in range(30))
    rows = [(1, words, "de"), (1, words, "de"), (2, words, "de"), (None, words + " a@b.co", "de"), (None, None, None), (None, None, None), (3, "", "en"), (4, " \n ", None), (5, "the " * 2000 + "+1 (743) 555-3824", "en"), (5, "the " * 2000 + "+1 (743) 555-3824", "en"), (6, "one", "en"), (7, "123 !!", None)]
    schema = "doc_id long, text string, lang string, " + ", ".join(f"{c} string" for c in OWN)
    return spark.createDataFrame([(*r, *OWN) for r in rows], schema).repartition(3)


@pytest.fixture(scope="module")
def bench(spark, docs):
    return spark.createDataFrame([(1, "one", "a", "b"), (None, "x", "a", "b"), (2, None, "a", "b"), (3, "", "a", "b")], "item_id long, text string, id string, same string")


def operators(spark, docs, bench):
    model = language.train(docs, "doc_id", "text", "lang")
    return {
        "pii": pii.spans(docs),
        "secrets": secrets.spans(docs),
        "decontaminate": decontaminate.contamination(docs, bench),
        "lattice": lattice.coded(docs),
        "jaccard": jaccard.linked_components(docs),
        "shards": shards.sharded(docs),
        "language": language.identify(docs, model),
        "katz": katz.katz_scores(docs.withColumn("train", docs["doc_id"] < 5)),
    }


def test_one_row_for_each_row(spark, docs, bench):
    for name, df in operators(spark, docs, bench).items():
        assert df.count() == 12, name
    assert sum(len(r.doc_ids) for r in packing.packed(docs).collect()) >= 12


def test_no_rows(spark, docs, bench):
    for name, df in operators(spark, docs.limit(0), bench.limit(0)).items():
        assert df.count() == 0, name
    assert packing.packed(docs.limit(0)).count() == 0


def test_filters_keep_all_columns(spark, docs, bench):
    model = language.train(docs, "doc_id", "text", "lang")
    for name, df, ids in (
        ("unknown", language.drop_unknown(docs, model), [1, 1, 2, 5, 5, 6, None]),
        ("first", jaccard.keep_first(docs), [1, 3, 4, 5, 6, 7, None, None]),
        ("contaminated", decontaminate.drop_contaminated(docs, bench), [1, 1, 2, 3, 4, 5, 5, 7, None, None, None]),
        ("redact", pii.redact(docs), [1, 1, 2, 3, 4, 5, 5, 6, 7, None, None, None]),
    ):
        assert df.columns == docs.columns, name
        got = df.collect()
        assert sorted((r.doc_id for r in got), key=lambda i: (i is None, i)) == ids, name
        assert all(r[c] == c for r in got for c in OWN), name


def test_vectors_with_repeats_nulls_and_clashes(spark):
    rows = [(i, [float(i % 7), 1.0], "a") for i in range(40)] + [(3, [9.0, 9.0], "a"), (None, [1.0, 1.0], "a"), (50, None, "a"), (51, [0.0, 0.0], "a"), (52, [float("nan"), 1.0], "a"), (53, [1.0], "a"), (54, [None, 1.0], "a")]
    x = spark.createDataFrame(rows, "vec_id long, embedding array<double>, id string").withColumns({"cell": forest.F.lit("a"), "v": forest.F.lit("b")})
    got = forest.neighbours(x, x.where("vec_id % 20 = 0"), 2, k=5).collect()
    assert {r.query_id for r in got} == {0, 20} and all(len([r for r in got if r.query_id == q]) == 5 for q in (0, 20))
    assert not {50, 51, 52, 53, 54} & {r.vec_id for r in got} and next(r for r in got if r.query_id == 0 and r["rank"] == 1).vec_id == 3
    assert forest.neighbours(x.limit(0), x.limit(0), 2).count() == 0
