"""The pipeline on nulls, empty texts, ties, repeated rows, clashing columns and empty tables."""

import corpus_pipeline

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, component_id string, ids string, __id int"


def written(spark, path, rows):
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, "a passage of the benchmark that no document may hold in full length")], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


def test_edges(spark, tmp_path):
    text = lambda word: " ".join(f"{word}{'abcdefghij'[i % 10]}" for i in range(30))
    rows = [(i, text(w), lang) for i, (w, lang) in enumerate((("the", "en"), ("das", "de"), ("les", "fr"), ("los", "es")) * 3, 10)]
    rows += [(1, None, "en"), (2, "", "en"), (3, " \n", None), (4, "½ 12 !!", "en"), (None, text("the") + " thenb", "en"), (30, text("thex"), None), (30, text("thex"), None)]
    rows += [(31, text("the") + " a passage of the BENCHMARK that no document may hold in full length", "en"), (32, "thea " * 60_000, "en")]
    sf = written(spark, tmp_path / "some", [(i, t, lang, "s", len(t or ""), "mine", "mine", 7) for i, t, lang in rows])
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf)
        if name != "bpe_encode":
            assert out.columns == docs.columns
            out.write.parquet(f"{tmp_path}/{name}")
            docs = spark.read.parquet(f"{tmp_path}/{name}")
            assert docs.filter("component_id <> 'mine' or ids <> 'mine' or __id <> 7").count() == 0
    kept = sorted(r.doc_id for r in docs.select("doc_id").collect())
    assert kept == [10, 11, 12, 13, 30, 32]
    assert sorted(r.doc_id for r in corpus_pipeline.run(spark, sf).collect()) == kept


def test_empty_table(spark, tmp_path):
    assert corpus_pipeline.run(spark, written(spark, tmp_path / "none", [])).count() == 0
