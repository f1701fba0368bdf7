import importlib

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_stages_take_effect(spark, tmp_path):
    pipeline = importlib.import_module("corpus_pipeline")
    item = " ".join(f"w{i}" for i in range(20))
    filler = lambda x: " ".join(f"{x}{i}" for i in range(50))
    rows = [(1, filler("a"), "en", "s", 1), (2, filler("a"), "en", "s", 1), (3, filler("b") + " " + item, "en", "s", 1), (4, "write to a.b@mail.com " + filler("c"), "en", "s", 1), (5, "123 ###", "en", "s", 1), (6, None, None, None, None), (7, filler("d") + " new", "en", "s", 1)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs, kept = spark.read.parquet(str(tmp_path / "documents.parquet")), []
    for i, (_, stage) in enumerate(pipeline.STAGES):
        docs = stage(spark, docs, str(tmp_path))
        docs.write.parquet(str(tmp_path / f"out{i}"))
        docs = spark.read.parquet(str(tmp_path / f"out{i}"))
        kept.append(sorted(r.doc_id for r in docs.collect()))
        if i < 4:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert kept == [[1, 2, 3, 4, 7], [1, 3, 4, 7], [1, 4, 7], [1, 4, 7], [1, 4, 7]]
    clean = {r.doc_id: r for r in spark.read.parquet(str(tmp_path / "out3")).collect()}
    assert clean[4].text.startswith("write to [EMAIL] c0") and clean[4].n_chars == len(clean[4].text)
    assert all(r.exact and len(r.ids) == 4 * r.n_ids for r in docs.collect())
    assert pipeline.run(spark, str(tmp_path)).count() == 3


def test_null_and_repeated_ids_are_judged_by_their_text(spark):
    from marlstone.llm.decontaminate import drop_contaminated
    from marlstone.llm.jaccard import keep_first
    from marlstone.llm.language import drop_unknown, train

    filler = lambda x: " ".join(f"{x}{i}" for i in range(50))
    table = lambda rows: spark.createDataFrame(rows, "doc_id long, text string, row int")
    left = lambda df: sorted(r.row for r in df.collect())
    model = train(spark.createDataFrame([(1, filler("a"), "en")], "doc_id long, text string, lang string"), "doc_id", "text", "lang")
    docs = table([(None, "123", 0), (None, None, 1), (None, filler("a"), 2), (5, "#", 3), (5, filler("b"), 4)])
    assert left(drop_unknown(docs, model)) == [2, 4]

    item = " ".join(f"w{i}" for i in range(20))
    docs = table([(None, item, 0), (None, filler("a"), 1), (None, None, 2), (5, "x " + item, 3), (5, filler("b"), 4)])
    assert left(drop_contaminated(docs, spark.createDataFrame([(1, item)], "item_id long, text string"))) == [1, 2, 4]

    docs = table([(3, filler("a"), 0), (None, filler("a"), 1), (5, filler("a"), 2), (5, filler("b"), 3), (None, filler("c"), 4), (None, filler("c").upper(), 5), (7, filler("d"), 6), (7, filler("d"), 6), (None, None, 8), (None, None, 8), (8, filler("e"), 9), (8, filler("e"), 10)])
    got = left(keep_first(docs))
    assert got[:2] == [0, 3] and len([x for x in got if x in (4, 5)]) == 1 and got.count(6) == 1 and got.count(8) == 2 and len([x for x in got if x > 8]) == 1 and len(got) == 7
    assert keep_first(docs).columns == docs.columns
