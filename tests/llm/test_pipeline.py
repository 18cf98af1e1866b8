"""Stages one after the other, against brute force on their own input; and the registered SQL."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from oracle import compare
from pennyflow.llm import catalog, mixing, quality, sentencepieces, simhash
from tests.llm.test_simhash import brute_groups

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_query_equals_its_sql(spark, name):
    df = catalog.QUERIES[name](spark, FOLDER)
    got = compare.rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = compare.duck(FOLDER).execute(catalog.SQL[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(df.columns) and got == compare.rows_of(names, cur.fetchall())


def test_stages(spark, tmp_path):
    docs, columns = spark.read.parquet(f"{FOLDER}/documents.parquet"), corpus_pipeline.COLUMNS
    inputs = [docs]
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, inputs[-1], FOLDER)
        out.write.parquet(str(tmp_path / str(number)))
        inputs.append(spark.read.parquet(str(tmp_path / str(number))))
    raw, good, cut, single, mix, ids = inputs
    assert all(sorted(x.columns) == sorted(columns) for x in inputs[:-1])

    judged = quality.measured(raw).where("kept")
    assert {r[0] for r in good.select("doc_id").collect()} == {r[0] for r in judged.select("doc_id").collect()}
    assert cut.count() == good.count() and cut.where("n_chars <> char_length(text)").count() == 0

    texts = {r["doc_id"]: r["text"] for r in cut.collect()}
    prints = {i: simhash.fingerprint(t, 3, 64)[0] for i, t in texts.items()}
    groups = brute_groups(set(prints.values()), 3)
    first = {}
    for i in sorted(prints):
        first.setdefault(groups[prints[i]], i)
    assert {r[0] for r in single.select("doc_id").collect()} == set(first.values())

    taken, _ = mixing.mix(single, F.array("source"))
    want = {r["doc_id"]: r["taken"] // r["size"] for r in taken.where("taken > 0").collect()}
    assert {r["doc_id"]: r["count"] for r in mix.groupBy("doc_id").count().collect()} == want
    assert ids.count() == mix.count() and ids.where("not round_trip").count() == 0
    assert [r["ids"] for r in ids.limit(3).collect()] == sentencepieces.model().encode([texts[r["doc_id"]] for r in ids.limit(3).collect()])


def test_run(spark):
    assert corpus_pipeline.run(spark, FOLDER).count() > 100


def test_odd_rows(spark, odd, nothing):
    for docs in (odd, nothing):
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, FOLDER)
        assert docs.count() >= 0


def test_no_copy_survives(spark):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    text = " ".join(f"word{i} of the tale" for i in range(200))
    near = text + " end"
    assert bin(simhash.fingerprint(text)[0] ^ simhash.fingerprint(near)[0]).count("1") <= 3
    rows = [(5, text), (1, text), (1, text), (3, near), (4, "something else " * 9), (None, "no id"), (None, "no id"), (6, None), (7, " ")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], schema)
    kept = [(r["doc_id"], r["text"]) for r in corpus_pipeline.one_of_near_copies(spark, docs, FOLDER).collect()]
    assert sorted(kept, key=str) == sorted([(1, text), (4, "something else " * 9), (None, "no id"), (6, None)], key=str)
