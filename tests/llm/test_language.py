import random

from pyspark.sql import functions as F

from marlstone.llm.language import Model, _sample, identify, op8_language_mixture, train

SCHEMA = "doc_id long, text string, lang string"


def speak(r, lang, n):
    parts = {"a": ["tha", "ing", "ed", "wh"], "b": ["öß", "sch", "ung", "keit"], "c": ["ción", "ñe", "os", "mente"]}[lang]
    return " ".join("".join(r.choice(parts) for _ in range(r.choice([1, 2, 3]))) for _ in range(n))


def corpus():
    r = random.Random(1)
    return [(i, speak(r, lang := r.choice("abc"), r.choice([5, 50])), lang) for i in range(300)]


def test_single_and_mixed_texts(spark):
    r = random.Random(2)
    model = train(spark.createDataFrame(corpus(), SCHEMA), "doc_id", "text", "lang")
    rows = [(i, speak(r, "abc"[i % 3], 40)) for i in range(30)]
    rows += [(100, speak(r, "a", 60) + " " + speak(r, "b", 40)), (101, " ".join(speak(r, x, n) for x, n in zip("abc", (50, 30, 20), strict=True)))]
    rows += [(200, None), (201, ""), (202, "123 --- ###"), (203, "—"), (204, "ing " * 30_000)]
    got = {x.id: x for x in identify(spark.createDataFrame(rows, "doc_id long, text string").repartition(2), model).collect()}
    assert len(got) == len(rows)
    assert all(got[i].lang_pred == "abc"[i % 3] and len(got[i].langs) == 1 for i in range(30))
    assert got[100].langs == ["a", "b"] and abs(got[100].shares[0] - 0.6) < 0.05
    assert set(got[101].langs) == {"a", "b", "c"} and got[101].lang_pred == "a"
    assert all(got[i].lang_pred == "und" and got[i].score == 0 and got[i].langs == [] for i in range(200, 204))
    assert got[204].lang_pred == "a" and 0 <= got[204].score <= 1


def test_nothing_learned_and_empty_table(spark):
    none = train(spark.createDataFrame([(1, "abc", None), (2, None, "a")], SCHEMA), "doc_id", "text", "lang")
    assert none.langs == []
    got = identify(spark.createDataFrame([(1, "abc")], "doc_id long, text string"), none).collect()
    assert [(r.lang_pred, r.score) for r in got] == [("und", 0.0)]
    assert identify(spark.createDataFrame([], "doc_id long, text string"), none).count() == 0
    assert isinstance(none, Model)


def test_sampled_training_still_learns(spark):
    docs = spark.createDataFrame(corpus(), SCHEMA)
    model = train(docs, "doc_id", "text", "lang", max_docs=120)
    got = identify(docs, model).join(docs.withColumnRenamed("doc_id", "id"), "id")
    assert got.where("lang_pred = lang").count() >= 295


def test_held_out_accuracy(spark):
    got = op8_language_mixture(spark, "/root/testdata/sf0.001").join(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), "doc_id")
    row = got.where("held_out and lang_pred <> 'und'").agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("double"))).first()
    assert row[0] > 0.97


def test_sample_keeps_rare_languages_and_its_bound(spark):
    r = random.Random(3)
    rows = [(None, speak(r, "ab"[i % 2], 5), "ab"[i % 2]) for i in range(3000)] + [(None, speak(r, "c", 60), "c")] + [(None, "tha ing", "a")] * 500
    docs = spark.createDataFrame(rows, SCHEMA)
    numbered = spark.createDataFrame([(i, *x[1:]) for i, x in enumerate(rows)], SCHEMA)
    model = train(numbered, "doc_id", "text", "lang", max_docs=300)
    assert model.langs == ["a", "b", "c"]
    got = identify(spark.createDataFrame([(1, speak(r, "c", 40))], "doc_id long, text string"), model).first()
    assert got.lang_pred == "c"
    assert 200 < _sample(docs.withColumnRenamed("doc_id", "id"), 300).count() < 400
