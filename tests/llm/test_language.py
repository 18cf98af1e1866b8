"""Held-out accuracy; unseen words; odd rows."""

from pyspark.sql import functions as F

from pennyflow.llm import catalog, language

FOLDER = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    found = catalog.op2_language(spark, FOLDER).join(spark.read.parquet(f"{FOLDER}/documents.parquet"), "doc_id")
    held = found.where("held_out and lang is not null and n_chars >= 20")
    right, n = held.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert n > 200 and right > 0.97
    assert found.where("score < 0 or score > 1").count() == 0


def test_shorter_grams_serve_unseen_words():
    model = language.Model([("x", 0, "abc", 9), ("y", 0, "xyz", 9), ("x", 2, "ab", 9), ("y", 2, "xy", 9), ("x", 1, "a", 9), ("y", 1, "x", 9)], {"x": 5, "y": 4})
    judge = language.Judge(model)
    assert judge("abc")[0] == judge("abq")[0] == judge("qqa")[0] == "x" and judge("xyq")[0] == judge("qx")[0] == "y"
    assert judge("ñ") == ("x", 0.5) and judge("12 ,") == judge(None) == judge("") == ("und", 0.0)
    assert model.score("abq")[0] < model.score("abq")[1] * 0.9 or model.score("abq")[0] > model.score("abq")[1]
    assert judge("² ½ ①") == judge("³⁴") == ("und", 0.0) and language.words("a²b ½c ①") == ["a", "b", "c"]
    assert language.Judge(language.Model([], {}))("abc") == ("und", 0.0)


def test_odd_rows(odd, nothing):
    model = language.fitted(odd)
    rows = language.predicted(odd, model).collect()
    assert len(rows) == odd.count() and {r["lang_pred"] for r in rows} <= {"en", "de", "und"}
    assert language.predicted(nothing, model).count() == 0
    empty = language.fitted(nothing)
    assert {r["lang_pred"] for r in language.predicted(odd, empty).collect()} == {"und"}
    assert odd.select(language.in_test_fold(F.col("doc_id")).alias("t")).where("t is null").count() == 0
