"""Training, comparing and using the classifiers that decide who gets an offer (Spark ML)."""

from __future__ import annotations

import math
import random
from collections.abc import Sequence
from datetime import date

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    NaiveBayes,
)
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pennyflow import constants as C
from pennyflow.functions.offers import one_hot
from pennyflow.plans.boosts import score_input
from pennyflow.session import shared_folder

LABEL = "label"
NUMBERS = ("boost_amount_whole_currency", "day_of_month", "day_of_week", "boost_prior_saves", "has_prior_redeemed")
CATEGORY_COLUMNS = tuple(f"boost_type_category_{c}" for c in C.OFFER_CATEGORIES)
# '::' in a column name is read as text by the assembler only under these plain names
_PLAIN = {c: c.replace("::", "__") for c in CATEGORY_COLUMNS}
INPUTS = (*NUMBERS, *_PLAIN.values())


# --- inputs ------------------------------------------------------------------------------


def model_input(training: DataFrame) -> DataFrame:
    """The numbers and the fixed 0/1 columns the models use, and the label where there is one.

    A number that is not known, such as the amount of an offer with an unknown unit, counts as 0.
    """
    hot = one_hot(F.col("boost_type_category"))
    frame = training.withColumns({_PLAIN[n]: c.cast("double") for n, c in hot.items()}).withColumns(
        {n: F.coalesce(F.col(n).cast("double"), F.lit(0.0)) for n in NUMBERS}
    )
    if "is_save_within_day" in training.columns:
        frame = frame.withColumn(LABEL, F.col("is_save_within_day").cast("double"))
    return frame


def dummies(df: DataFrame, column: str, most: int = 1_000) -> DataFrame:
    """One 0/1 column per value found in the data, named ``<column>_<value>``, in order of the values.

    The values become columns, so more than ``most`` of them are an error; `dummy_vectors` takes any
    number. A null has 0 everywhere.
    """
    values = sorted(r[0] for r in df.where(F.col(column).isNotNull()).select(column).distinct().limit(most + 1).collect())
    if len(values) > most:
        raise ValueError(f"more than {most} values in {column}")
    is_value = lambda v: F.coalesce(F.col(column) == v, F.lit(False)).cast("int")
    return df.withColumns({f"{column}_{v}": is_value(v) for v in values})


def value_places(spark: SparkSession, df: DataFrame, column: str) -> DataFrame:
    """(value, place): the distinct values, null left out, numbered from 0 in their order.

    The values are sorted by ranges and written once; a value's place is its place in its range behind
    the sizes of the ranges before, so no task numbers all of them and only the sizes are broadcast.
    """
    values = df.select(F.col(column).alias("value")).where("value IS NOT NULL").distinct().orderBy("value")
    # the id counts a range's rows in its lower 33 bits
    numbered = materialise(spark, values.select("value", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("id")))
    sizes = numbered.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select("part", before.alias("start"))  # a row per range
    in_range = F.col("id").bitwiseAND(F.lit((1 << 33) - 1))
    return numbered.join(F.broadcast(starts), "part").select("value", (F.col("start") + in_range).alias("place"))


def dummy_vectors(spark: SparkSession, df: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """``df`` with ``<column>_place`` and the sparse 0/1 vector ``<column>_vector``; and the values with their places.

    However many values there are, a row holds one number. A null has no place and an empty vector.
    """
    place, vector = f"{column}_place", f"{column}_vector"
    places = materialise(spark, value_places(spark, df, column))
    n = places.count()
    placed = df.join(places.withColumnRenamed("place", place), F.col(column) == F.col("value"), "left").drop("value")
    # without any value the vector has one number, which is never set
    known = places if n else spark.createDataFrame([("", 0)], "value string, place long")
    # a place beyond the last, the null's, is none of the categories and so all zeros
    encoder = OneHotEncoder(inputCol="_at", outputCol=vector, handleInvalid="keep", dropLast=True)
    fitted = encoder.fit(known.select(F.col("place").cast("double").alias("_at")))
    at = F.coalesce(place, F.lit(max(n, 1))).cast("double")
    return fitted.transform(placed.withColumn("_at", at)).drop("_at"), places


def materialise(spark: SparkSession, df: DataFrame) -> DataFrame:
    """Write the frame once to the shared folder: every pass of a fit then reads this table instead
    of working the features out again, also after an executor is lost."""
    path = shared_folder(spark, "training")
    df.write.parquet(path)
    return spark.read.parquet(path)


def split(df: DataFrame, test_share: float = 0.2, seed: int = 7, key: Sequence[str] = ("user_id", "boost_id")):
    """(train, test) by a hash of the row's key: the same rows whatever the partitions."""
    bucket = F.pmod(F.xxhash64(F.lit(seed), *key), F.lit(1000))
    is_test = bucket < int(test_share * 1000)
    return df.where(~is_test), df.where(is_test)


def balanced_weight(df: DataFrame) -> Column:
    """Weight rows so that both classes weigh the same."""
    shares = df.agg(F.avg(LABEL).alias("p")).scalar()
    positive = F.lit(0.5) / F.greatest(shares, F.lit(1e-9))
    negative = F.lit(0.5) / F.greatest(F.lit(1.0) - shares, F.lit(1e-9))
    return F.when(F.col(LABEL) == 1.0, positive).otherwise(negative)


def weighted(df: DataFrame) -> DataFrame:
    return df.withColumn("weight", balanced_weight(df))


def _assembler() -> VectorAssembler:
    return VectorAssembler(inputCols=list(INPUTS), outputCol="features")


# --- models ------------------------------------------------------------------------------


def train_linear(
    train: DataFrame,
    costs: Sequence[float] = (1.0, 10.0, 100.0),
    folds: int = 2,
    max_iter: int = 20,
    seed: int = 7,
) -> PipelineModel:
    """Linear support vector machine with balanced classes; the penalty is chosen on ``folds`` folds
    of the training rows only, which a hash of the row's key makes."""
    fold = F.pmod(F.xxhash64(F.lit(seed), F.lit("fold"), "user_id", "boost_id"), F.lit(folds)).cast("int")
    prepared = weighted(train).withColumn("fold", fold)
    n = train.count()
    svc = LinearSVC(labelCol=LABEL, weightCol="weight", maxIter=max_iter, tol=1e-4)
    grid = ParamGridBuilder().addGrid(svc.regParam, [1.0 / (c * max(n, 1)) for c in costs]).build()
    search = CrossValidator(
        estimator=Pipeline(stages=[_assembler(), svc]),
        estimatorParamMaps=grid,
        evaluator=MulticlassClassificationEvaluator(labelCol=LABEL, metricName="accuracy"),
        numFolds=folds,
        foldCol="fold",
        parallelism=2,
    )
    return search.fit(prepared).bestModel


def fourier_features(inputs: Sequence[str], gamma: float, size: int = 128, seed: int = 7) -> str:
    """SQL that adds ``fourier_0`` to ``fourier_<size - 1>``: random Fourier features of the inputs.

    The product of two rows' features is the radial kernel exp(-gamma * distance^2) within a standard error
    of at most 1 / sqrt(size). Directions are drawn from a normal distribution of variance 2 * gamma, shifts
    evenly from a circle. Another gamma stretches the same directions.
    """
    draw, stretch = random.Random(seed), math.sqrt(2.0 * gamma)
    waves = []
    for _ in range(size):
        direction = [draw.gauss(0.0, 1.0) * stretch for _ in inputs]
        numbers = ", ".join(f"{v!r}D" for v in [*direction, draw.uniform(0.0, 2.0 * math.pi)])
        waves.append(f"array({numbers})")
    # one array worked out once a row: as so many expressions the generated code would be too large
    row = ", ".join(f"`{name}`" for name in inputs)
    angle = f"aggregate(zip_with(slice(w, 1, {len(inputs)}), array({row}), (a, x) -> a * x), w[{len(inputs)}], (s, v) -> s + v)"
    made = f"transform(array({', '.join(waves)}), w -> {math.sqrt(2.0 / size)!r}D * cos({angle}))"
    columns = ", ".join(f"fourier[{i}] AS fourier_{i}" for i in range(size))
    return f"SELECT *, {columns} FROM (SELECT *, {made} AS fourier FROM __THIS__)"


def svm_grid(
    train: DataFrame,
    costs: Sequence[float] = (1.0, 10.0, 100.0),
    gammas: Sequence[float] = (0.001, 0.0001),
    size: int = 128,
    folds: int = 2,
    max_iter: int = 20,
    seed: int = 7,
) -> tuple[PipelineModel, DataFrame]:
    """Support vector machines with the linear and the radial kernel, all costs and gammas, on the same folds.

    Returns the most accurate one, fitted to all training rows, and the accuracy of every point of the grid
    (kernel, gamma, cost, accuracy, chosen). The radial kernel is a linear machine over `fourier_features`,
    so its work is linear in the rows. Of equals the linear kernel wins, then the smaller cost.
    """
    fold = F.pmod(F.xxhash64(F.lit(seed), F.lit("fold"), "user_id", "boost_id"), F.lit(folds)).cast("int")
    prepared = weighted(train).withColumn("fold", fold)
    n = max(train.count(), 1)
    accuracy = MulticlassClassificationEvaluator(labelCol=LABEL, metricName="accuracy")

    def search(features: Pipeline, svc: LinearSVC) -> tuple:
        # what the machine reads is worked out once, not by each of its fits
        made = features.fit(prepared)
        rows = materialise(train.sparkSession, made.transform(prepared).select(LABEL, "weight", "fold", "features"))
        grid = ParamGridBuilder().addGrid(svc.regParam, penalties).build()
        found = CrossValidator(
            estimator=svc, estimatorParamMaps=grid, evaluator=accuracy, numFolds=folds, foldCol="fold", parallelism=2
        ).fit(rows)
        return PipelineModel([*made.stages, found.bestModel]), found.avgMetrics

    svc = LinearSVC(labelCol=LABEL, weightCol="weight", maxIter=max_iter, tol=1e-4)
    penalties = [1.0 / (c * n) for c in costs]
    best, means = search(Pipeline(stages=[_assembler()]), svc)
    rows = [("linear", None, float(c), float(m)) for c, m in zip(costs, means)]
    top = max(means)
    waves = VectorAssembler(inputCols=[f"fourier_{i}" for i in range(size)], outputCol="features")
    for gamma in gammas:
        # every feature weighs the same, as the kernel is their plain product
        flat = LinearSVC(labelCol=LABEL, weightCol="weight", maxIter=max_iter, tol=1e-4, standardization=False)
        kernel = SQLTransformer(statement=fourier_features(INPUTS, gamma, size, seed))
        model, means = search(Pipeline(stages=[kernel, waves]), flat)
        rows += [("radial", float(gamma), float(c), float(m)) for c, m in zip(costs, means)]
        if max(means) > top:
            best, top = model, max(means)
    chosen = max(range(len(rows)), key=lambda i: (rows[i][3], -i))
    table = [(*row, i == chosen) for i, row in enumerate(rows)]
    schema = "kernel string, gamma double, cost double, accuracy double, chosen boolean"
    return best, train.sparkSession.createDataFrame(table, schema)


def train_boosted_trees(train: DataFrame, rounds: int = 20, depth: int = 3, seed: int = 7) -> PipelineModel:
    trees = GBTClassifier(
        labelCol=LABEL, maxDepth=depth, maxIter=rounds, minInstancesPerNode=5, seed=seed
    )
    return Pipeline(stages=[_assembler(), trees]).fit(train)


def feature_importance(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """(feature, importance) of a tree model; one row per model input."""
    values = model.stages[-1].featureImportances.toArray()
    rows = [(name, float(value)) for name, value in zip(INPUTS, values)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")


def portfolio() -> dict[str, object]:
    """The models that are compared on the same rows."""
    balanced = {"labelCol": LABEL, "weightCol": "weight"}
    return {
        "gaussian_naive_bayes": NaiveBayes(labelCol=LABEL, modelType="gaussian"),
        "multinomial_naive_bayes": NaiveBayes(labelCol=LABEL, modelType="multinomial"),
        "tree_depth_1": DecisionTreeClassifier(maxDepth=1, seed=7, **balanced),
        "tree_depth_5": DecisionTreeClassifier(maxDepth=5, seed=7, **balanced),
        "logistic_regression": LogisticRegression(regParam=0.01, **balanced),
        "logistic_regression_weak_penalty": LogisticRegression(regParam=0.001, **balanced),
    }


def compare_models(train: DataFrame, test: DataFrame) -> DataFrame:
    """Scores of each model of the portfolio and of always giving the commoner answer."""
    prepared = weighted(train)
    scores = []
    for name, estimator in portfolio().items():
        fitted = Pipeline(stages=[_assembler(), estimator]).fit(prepared)
        scores.append(evaluate(fitted.transform(test)).withColumn("model", F.lit(name)))
    commoner = train.agg((F.avg(LABEL) >= 0.5).cast("double")).scalar()
    constant = test.withColumn("prediction", commoner).withColumn("score", F.lit(0.5))
    scores.append(evaluate(constant, "score").withColumn("model", F.lit("majority")))
    table = scores[0]
    for other in scores[1:]:
        table = table.unionByName(other)
    return table


# --- evaluation --------------------------------------------------------------------------


def at_threshold(predictions: DataFrame, threshold: float) -> DataFrame:
    """Predictions made by comparing the positive class's probability to ``threshold``."""
    positive = vector_to_array("probability")[1]
    return predictions.withColumn("prediction", (positive > threshold).cast("double"))


def evaluate(predictions: DataFrame, score: str = "rawPrediction") -> DataFrame:
    """One row: rows, positives, precision, recall, f_score, accuracy, macro_f1, roc_auc."""
    y, p = F.col(LABEL) == 1.0, F.col("prediction") == 1.0
    share = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    counts = predictions.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(y).alias("positives"),
        F.count_if(y & p).alias("tp"),
        F.count_if(~y & p).alias("fp"),
        F.count_if(y & ~p).alias("fn"),
        F.count_if(~y & ~p).alias("tn"),
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    f1, f0 = share(2 * tp, 2 * tp + fp + fn), share(2 * tn, 2 * tn + fp + fn)
    # without bins every distinct score is a point of the curve
    auc = BinaryClassificationEvaluator(labelCol=LABEL, rawPredictionCol=score, numBins=0).evaluate(predictions)
    return counts.select(
        "rows",
        "positives",
        share(tp, tp + fp).alias("precision"),
        share(tp, tp + fn).alias("recall"),
        f1.alias("f_score"),
        share(tp + tn, F.col("rows")).alias("accuracy"),
        ((f1 + f0) / 2).alias("macro_f1"),
        F.lit(float(auc)).alias("roc_auc"),
    )


def training_result(scores: DataFrame, training: DataFrame, as_of: date | str) -> DataFrame:
    """The row kept of a training run: its size, its positives and its scores."""
    size = training.agg(F.count(F.lit(1)).alias("n"), F.sum(LABEL).cast("long").alias("n_positive"))
    one = lambda name: size.select(name).scalar()
    return scores.select(
        F.lit(str(as_of)).alias("run_date"),
        one("n").alias("n"),
        one("n_positive").alias("n_positive"),
        "precision",
        "recall",
        "f_score",
        "accuracy",
    )


# --- keeping and using a model -----------------------------------------------------------


def save_model(model: PipelineModel, folder: str, as_of: date | str) -> None:
    """Under the run's date and as the latest."""
    for name in (str(as_of), "latest"):
        model.write().overwrite().save(f"{folder.rstrip('/')}/{name}")


def load_model(folder: str, name: str = "latest") -> PipelineModel:
    return PipelineModel.load(f"{folder.rstrip('/')}/{name}")


def score_users(
    events: DataFrame,
    behaviour: DataFrame,
    users: DataFrame,
    model: PipelineModel,
    as_of: date | str,
    boost_amount: float,
    boost_type_category: str,
    keep_missing: bool = False,
) -> DataFrame:
    """(user_id, should_offer) for the candidates.

    Candidates without any save are left out, unless ``keep_missing`` or unless no candidate has
    one; then they are not offered anything.
    """
    known = model_input(score_input(events, behaviour, users, as_of, boost_amount, boost_type_category))
    offered = model.transform(known).select("user_id", (F.col("prediction") == 1.0).alias("should_offer"))
    all_users = users.select("user_id").distinct().join(offered, "user_id", "left")
    result = all_users.select(
        "user_id",
        F.coalesce("should_offer", F.lit(False)).alias("should_offer"),
        F.col("should_offer").isNotNull().alias("known"),
    )
    if keep_missing:
        return result.drop("known")
    any_known = offered.agg(F.count(F.lit(1)) > 0).scalar()
    return result.where(F.col("known") | ~any_known).drop("known")
