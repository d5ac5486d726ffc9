import pytest
from pyspark.sql import functions as F

from folioflow.llm import langid, queries

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    got = queries.op4_language_id(spark, SF).filter("held_out").join(docs, "doc_id").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double")), F.count("*")).first()
    assert got[0] > 0.99 and got[1] > 200


def test_backoff_is_word_first_then_shorter():
    model = langid.Model.fit([("a", "the", 5), ("b", "der", 5), ("b", "the", 1)])
    assert model.score("the") == model.words["the"]
    assert model.score("thex")[0] > model.score("thex")[1]  # by n-grams of the
    assert model.score("中") == [0.0, 0.0]


@pytest.fixture()
def model():
    return langid.Model.fit([("en", "the", 9), ("en", "house", 3), ("de", "das", 9), ("de", "haus", 3)])


def test_edges(spark, model):
    rows = [(1, None), (2, ""), (3, "12 !!\n"), (4, "The HOUSE"), (4, "The HOUSE"), (5, "das Haus " * 20000), (None, "中文")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, lang_pred string")
    got = sorted(((r.doc_id or 0, r.lang_pred, round(r.score, 3)) for r in langid.predict(df, model).collect()))
    assert got[1:4] == [(1, "und", 0.0), (2, "und", 0.0), (3, "und", 0.0)]
    assert [g[:2] for g in got[4:]] == [(4, "en"), (4, "en"), (5, "de")] and all(g[2] > 0.9 for g in got[4:])
    assert got[0] == (0, "de", 0.5)
    kept = langid.keep_known(df, model)
    assert kept.columns == df.columns and sorted(r.doc_id or 0 for r in kept.collect()) == [4, 4, 5]  # unknown letters go
    assert langid.keep_known(df.limit(0), model).count() == 0


@pytest.mark.parametrize("text", ["½²", "Ⅷ", "①", "¾ 12 Ⅻ", "_", "٣", "\u0301"])
def test_numerals_are_no_letters(spark, model, text):
    df = spark.createDataFrame([(1, text), (2, text + " the"), (3, "the" + text + "house")], "doc_id long, text string")
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.predict(df, model).collect()}
    assert got[1] == ("und", 0.0) and got[2][0] == got[3][0] == "en"


def test_six_languages_of_uneven_size(spark):
    sizes = {"aa": 2000, "bb": 500, "cc": 100, "dd": 20, "ee": 5, "ff": 2}
    rows = [(i * 10_000 + k, f"{lang}word{k % 50} {lang}tail {lang}{k}", lang) for i, (lang, n) in enumerate(sizes.items()) for k in range(n)]
    model = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), rows=300, words=200)
    assert model.languages == sorted(sizes)
    new = spark.createDataFrame([(i, f"{lang}tail {lang}new") for i, lang in enumerate(sizes)], "doc_id long, text string")
    assert [r.lang_pred for r in langid.predict(new, model).orderBy("doc_id").collect()] == list(sizes)


def test_nothing_to_learn_from(spark):
    none = spark.createDataFrame([(1, None, "en"), (2, "x", None)], "doc_id long, text string, lang string")
    got = langid.predict(none, langid.train(none)).collect()
    assert {r.lang_pred for r in got} == {"und"} and langid.predict(none.limit(0), langid.train(none)).count() == 0


def test_a_rare_language_is_learned_beside_a_frequent_one(spark):
    many = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat(F.lit("the house "), F.concat(F.lit("and"), F.hex("id"))).alias("text"), F.lit("en").alias("lang"))
    few = spark.createDataFrame([(9001, "das haus", "de"), (None, "la maison", "fr")], "doc_id long, text string, lang string")
    model = langid.train(many.unionByName(few), rows=20, words=5)
    assert model.languages == ["de", "en", "fr"] and {"das", "haus", "la", "maison", "the", "house"} <= set(model.words)
    assert sum(v[1] == max(v) for v in model.words.values()) <= 5


def test_n_grams_count_words_beyond_the_word_cut(spark):
    df = spark.createDataFrame([(1, "aa " * 9 + "bb " * 8 + "cc " * 7 + "zaa zab", "en")], "doc_id long, text string, lang string")
    model = langid.train(df, words=4)
    assert set(model.words) == {"aa", "bb", "cc", "zaa"} and set(model.grams[1]) == {"a", "b", "c", "z"}
    a, z = (model.grams[1][x][0] for x in "az")
    assert round(langid.math.exp(z - a), 6) == round((2 + langid.SMOOTHING) / (21 + langid.SMOOTHING), 6)
