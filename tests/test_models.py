import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from pennyflow import constants as C
from pennyflow.plans import bayes, ml
from pennyflow.sources.tables import write_training_result
from pennyflow.timebox import day_start

TODAY = day_start("2024-01-20")


@pytest.fixture(scope="module")
def training(spark):
    """Offers to users with many earlier saves lead to a save."""
    kinds = C.OFFER_CATEGORIES
    rows = [
        (f"u{i}", f"b{i % 7}", float(1 + i % 9), 1 + i % 28, i % 7, i % 20, i % 3 == 0, kinds[i % len(kinds)], i % 20 >= 12)
        for i in range(400)
    ]
    schema = (
        "user_id string, boost_id string, boost_amount_whole_currency double, day_of_month int, day_of_week int, "
        "boost_prior_saves long, has_prior_redeemed boolean, boost_type_category string, is_save_within_day boolean"
    )
    return ml.materialise(spark, ml.model_input(spark.createDataFrame(rows, schema)))


@pytest.fixture(scope="module")
def linear(training):
    return ml.train_linear(ml.split(training)[0], costs=(1.0, 10.0), max_iter=8)


def test_split_does_not_depend_on_partitions(training):
    train, test = ml.split(training)
    again = ml.split(training.repartition(7))[1]
    ids = lambda df: {(r.user_id, r.boost_id) for r in df.collect()}
    assert ids(test) == ids(again) and not ids(test) & ids(train)
    assert len(ids(test)) + len(ids(train)) == 400 and 40 < len(ids(test)) < 120


def test_classes_weigh_the_same(training):
    sums = ml.weighted(training).groupBy("label").agg(F.sum("weight").alias("w")).collect()
    assert abs(sums[0]["w"] - sums[1]["w"]) < 1e-6


def test_linear_model_learns_and_is_kept(spark, training, linear, tmp_path):
    test = ml.split(training)[1]
    scores = ml.evaluate(linear.transform(test))
    assert scores.first()["accuracy"] > 0.9 and scores.first()["roc_auc"] > 0.95
    ml.save_model(linear, str(tmp_path), "2024-01-20")
    for name in ("latest", "2024-01-20"):
        loaded = ml.load_model(str(tmp_path), name).transform(test)
        assert loaded.select("prediction").collect() == linear.transform(test).select("prediction").collect()
    result = ml.training_result(scores, training, "2024-01-20")
    write_training_result(result, str(tmp_path / "results"))
    kept = spark.read.parquet(str(tmp_path / "results")).first()
    assert (kept["n"], kept["n_positive"]) == (400, 160)


def test_trees(spark, training):
    train, test = ml.split(training)
    model = ml.train_boosted_trees(train, rounds=3)
    assert ml.evaluate(model.transform(test)).first()["f_score"] > 0.9
    importance = ml.feature_importance(spark, model).collect()
    assert importance[0]["feature"] == "boost_prior_saves" and len(importance) == len(ml.INPUTS)
    predictions = model.transform(test)
    all_yes = ml.evaluate(ml.at_threshold(predictions, -0.1)).first()
    assert all_yes["recall"] == 1.0
    assert ml.evaluate(ml.at_threshold(predictions, 1.0)).first()["recall"] == 0.0


def test_scores_by_hand(spark):
    rows = [(1.0, 1.0, 0.9), (1.0, 0.0, 0.4), (0.0, 1.0, 0.6), (0.0, 0.0, 0.1), (0.0, 0.0, 0.2)]
    got = ml.evaluate(spark.createDataFrame(rows, "label double, prediction double, s double"), "s").first()
    assert (got["rows"], got["positives"], got["precision"], got["recall"], got["f_score"]) == (5, 2, 0.5, 0.5, 0.5)
    assert got["accuracy"] == 0.6 and abs(got["macro_f1"] - (0.5 + 2 / 3) / 2) < 1e-9
    assert abs(got["roc_auc"] - 5 / 6) < 1e-9


def test_portfolio(training):
    table = {r["model"]: r for r in ml.compare_models(*ml.split(training)).collect()}
    assert set(table) == set(ml.portfolio()) | {"majority"}
    assert table["tree_depth_5"]["accuracy"] > table["majority"]["accuracy"]
    assert table["majority"]["recall"] == 0.0 and table["majority"]["roc_auc"] == 0.5


def test_dummies(spark):
    got = ml.dummies(spark.createDataFrame([("a",), ("b",), ("a",)], "k string"), "k").collect()
    assert [tuple(r) for r in got] == [("a", 1, 0), ("b", 0, 1), ("a", 1, 0)]
    with pytest.raises(ValueError):
        ml.dummies(spark.createDataFrame([("a",), ("b",)], "k string"), "k", most=1)


def test_dummy_vectors(spark):
    many = spark.range(100_000).select(F.format_string("v%06d", F.pmod(F.col("id") * 7919, F.lit(100_000))).alias("k"))
    frame, places = ml.dummy_vectors(spark, many.union(spark.sql("SELECT cast(null AS string)")), "k")
    assert places.count() == 100_000 and places.where("value <> format_string('v%06d', place)").count() == 0
    wrong = F.concat(F.lit("(100000,["), F.col("k_place").cast("string"), F.lit("],[1.0])")) != F.col("k_vector").cast("string")
    assert frame.count() == 100_001 and frame.where(wrong).count() == 0
    assert [r[0].numNonzeros() for r in frame.where("k IS NULL").select("k_vector").collect()] == [0]


def test_dummy_vectors_without_values(spark):
    frame, places = ml.dummy_vectors(spark, spark.createDataFrame([(None, 1)], "k string, value int").drop("value"), "k")
    assert places.count() == 0 and frame.first()["k_vector"].numNonzeros() == 0


def test_fourier_features_make_the_radial_kernel(spark, training):
    size = 256
    rows = training.limit(40)
    names = [f"fourier_{i}" for i in range(size)]
    for gamma in (0.001, 0.0001):
        made = ml.SQLTransformer(statement=ml.fourier_features(ml.INPUTS, gamma, size)).transform(rows)
        both = np.array([list(r) for r in made.select(*ml.INPUTS, *names).collect()])
        x, z = both[:, : len(ml.INPUTS)], both[:, len(ml.INPUTS) :]
        exact = np.exp(-gamma * ((x[:, None] - x[None]) ** 2).sum(-1))
        error = np.abs(z @ z.T - exact)
        assert np.sqrt((error**2).mean()) < 1 / math.sqrt(size) and error.max() < 4 / math.sqrt(size)


def test_grid_compares_both_kernels(training):
    train, test = ml.split(training)
    best, table = ml.svm_grid(train, costs=(1.0, 10.0), gammas=(0.01,), size=32, max_iter=5)
    rows = table.collect()
    assert [(r["kernel"], r["gamma"], r["cost"]) for r in rows] == [("linear", None, 1.0), ("linear", None, 10.0), ("radial", 0.01, 1.0), ("radial", 0.01, 10.0)]
    top = max(r["accuracy"] for r in rows)
    assert [r["accuracy"] for r in rows if r["chosen"]] == [top]
    assert ml.evaluate(best.transform(test)).first()["accuracy"] > 0.8


def test_the_grid_works_features_out_once_per_kernel(training, monkeypatch):
    """Every fit and every scoring of the grid reads stored features; the chosen model still takes plain rows."""
    stored, materialise = [], ml.materialise

    def watch(spark, df):
        stored.append(df.columns)
        return materialise(spark, df)

    monkeypatch.setattr(ml, "materialise", watch)
    train, test = ml.split(training)
    best, table = ml.svm_grid(train, costs=(1.0,), gammas=(0.01,), size=8, max_iter=2)
    assert stored == [[ml.LABEL, "weight", "fold", "features"]] * 2
    assert table.count() == 2 and best.transform(test).where("prediction IS NOT NULL").count() == test.count()


def test_naive_bayes_by_hand(training):
    train, test = bayes.split_by_digest(training)
    found = bayes.statistics(train)
    table = lambda df: np.array([[float(v) for v in r] for r in df.select(*ml.INPUTS, ml.LABEL).collect()])
    a, b = table(train), table(test)
    x, y, t = a[:, :-1], a[:, -1], b[:, :-1]
    assert len(b) and len(a) + len(b) == 400
    least = bayes.SMOOTHING * x.var(axis=0).max()
    low, width = x.min(axis=0), np.where(np.ptp(x, axis=0) == 0, 1, np.ptp(x, axis=0))
    normal, counts = [], []
    for c in (0, 1):
        own = x[y == c]
        v, prior = own.var(axis=0) + least, math.log(len(own) / len(x))
        normal.append(prior - 0.5 * (np.log(2 * np.pi * v) + (t - own.mean(axis=0)) ** 2 / v).sum(axis=1))
        s = ((own - low) / width).sum(axis=0) + 1
        counts.append(prior + ((t - low) / width) @ np.log(s / s.sum()))
    scored = test.select(bayes.gaussian_score(found).alias("g"), bayes.multinomial_score(found).alias("m")).collect()
    assert np.allclose([r["g"] for r in scored], normal[1] - normal[0], rtol=1e-6, atol=1e-6)
    assert np.allclose([r["m"] for r in scored], counts[1] - counts[0], rtol=1e-9, atol=1e-9)


def test_naive_bayes_with_one_class(training):
    train, test = bayes.split_by_digest(training)
    for label in (0.0, 1.0):
        rows = {r["model"]: r for r in bayes.compare(train.where(F.col("label") == label), test).collect()}
        assert {r["recall"] for r in rows.values()} == {label} and {r["roc_auc"] for r in rows.values()} == {0.5}


def test_unknown_amounts_do_not_end_a_run(spark, training, linear):
    unknown = ml.model_input(training.limit(5).withColumn("boost_amount_whole_currency", F.lit(None).cast("double")))
    assert linear.transform(unknown).count() == 5


def test_area_is_exact_for_many_scores(spark):
    rows = spark.range(6000).select(
        ((F.col("id") * 7919) % 6007 / 6007.0).alias("s"), (F.pmod(F.xxhash64("id"), F.lit(3)) == 0).cast("double").alias("label")
    ).withColumn("prediction", F.lit(0.0))
    pairs = [(r["s"], r["label"]) for r in rows.collect()]
    order = sorted(pairs)
    ranks = sum(i + 1 for i, (_, y) in enumerate(order) if y)
    n = sum(y for _, y in pairs)
    exact = (ranks - n * (n + 1) / 2) / (n * (len(pairs) - n))
    assert abs(ml.evaluate(rows, "s").first()["roc_auc"] - exact) < 1e-9


def test_scoring_users(spark, events, payments, linear):
    users = spark.createDataFrame([("keen",), ("new",)], "user_id string")
    ub = payments([("keen", C.SAVING, 1, TODAY - i * C.DAY_MS) for i in range(1, 19)])
    score = lambda ub, **o: {
        r["user_id"]: r["should_offer"]
        for r in ml.score_users(events([]), ub, users, linear, "2024-01-20", 5, "GAME::TAP_SCREEN", **o).collect()
    }
    assert score(ub) == {"keen": True}
    assert score(ub, keep_missing=True) == {"keen": True, "new": False}
    # nobody is known: everybody is answered, with no
    assert score(payments([])) == {"keen": False, "new": False}
