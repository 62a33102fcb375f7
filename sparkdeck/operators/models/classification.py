"""Classifiers."""

from __future__ import annotations

import math
import random

from pyspark.ml import Pipeline
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import CountVectorizerModel, VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import DataFrame, functions as F

from ...functions.scalar import score_band
from ...functions.text import clean_social
from ...session import stored
from .regression import evaluate, forest as regression_forest


def logistic(df, label="label", features="features", iters=100, reg=0.01, family="multinomial", **params):
    return LogisticRegression(
        labelCol=label, featuresCol=features, maxIter=iters, regParam=reg, family=family, **params
    ).fit(df)


def tree(df, label="label", features="features", depth=10, bins=32, seed=1):
    return DecisionTreeClassifier(
        labelCol=label, featuresCol=features, impurity="gini", maxDepth=depth, maxBins=bins, seed=seed
    ).fit(df)


def forest(df, label="label", features="features", trees=100, depth=9, bins=32, seed=1, **params):
    return RandomForestClassifier(
        labelCol=label, featuresCol=features, numTrees=trees, maxDepth=depth, maxBins=bins, seed=seed, **params
    ).fit(df)


def boosted(df, label="label", features="features", trees=20, rate=0.1, depth=4, subsample=0.8, seed=1, **params):
    return GBTClassifier(
        labelCol=label, featuresCol=features, maxIter=trees, stepSize=rate, maxDepth=depth,
        subsamplingRate=subsample, seed=seed, **params,
    ).fit(df)


class Boosted:
    """Softmax-boosted trees: per class the sum of `rate` times its trees, on top of the log share of the class."""

    def __init__(self, start: list[float], rate: float, features: str):
        self.start, self.rate, self.features = start, rate, features
        self.rounds: list[list[tuple]] = []
        self.curve: list[tuple[int, float, float]] = []

    def margins(self, rows: DataFrame, out: str = "_margin", rounds: int | None = None) -> DataFrame:
        sums = [F.lit(float(s)) for s in self.start]
        for trees in self.rounds[:rounds]:
            for k, (names, model) in enumerate(trees):
                rows = _picked(rows, self.features, names, "_part")
                rows = model.transform(rows).withColumn(f"_f{k}", F.col("prediction")).drop("prediction", "_part")
            sums = [s + self.rate * F.col(f"_f{k}") for k, s in enumerate(sums)]
            rows = rows.withColumns({f"_s{k}": s for k, s in enumerate(sums)})
            sums = [F.col(f"_s{k}") for k in range(len(self.start))]
        return rows.withColumn(out, F.array(*sums)).drop(*[f"_{n}{k}" for n in "fs" for k in range(len(self.start))])

    def transform(self, rows: DataFrame) -> DataFrame:
        """Rows with `prediction` (the class of the largest sum, the smaller on a tie) and `probability`."""
        found = self.margins(rows)
        return found.withColumns({"prediction": _largest("_margin"), "probability": _softmax("_margin")}).drop("_margin")


def _largest(margin: str):
    return (F.array_position(margin, F.array_max(margin)) - 1).cast("double")


def _softmax(margin: str):
    top = F.array_max(margin)
    shares = F.transform(margin, lambda v: F.exp(v - top))
    total = F.aggregate(shares, F.lit(0.0), lambda s, v: s + v)
    return F.transform(shares, lambda v: v / total)


def _picked(rows: DataFrame, features: str, places: list[int], out: str) -> DataFrame:
    return VectorSlicer(inputCol=features, outputCol=out, indices=places).transform(rows)


def boosted_classes(
    df: DataFrame, key: str, label: str = "label", features: str = "features", rounds: int = 20, rate: float = 0.3, depth: int = 3,
    row_share: float = 0.8, column_share: float = 1.0, patience: int = 3, held_share: float = 0.2, seed: int = 1,
) -> Boosted:
    """Boosted trees for any number of classes 0, 1, …, fitted to the gradient of the log loss (softmax).

    Each round fits one small tree per class to label less probability, on `row_share` of the rows and `column_share` of the
    features, drawn by hashes of `key` and the round. Rows of `held_share` (a hash of `key` too) are not trained on; when their log loss has not
    fallen for `patience` rounds the fit stops and the rounds up to the best one stay. `curve` has (round, loss, held loss).

    The sums of all classes are written after each round, so a round reads one table and a lost executor repeats one round at most.
    Rows are dealt over the cores once: a table of few columns is a small file, which one task would read in every pass. What the
    trees of a round learn from is written too, as each of them reads it several times.
    """
    share = lambda k: F.pmod(F.xxhash64(F.lit(seed), F.lit(k), F.col(key)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    rows = df.select(key, F.col(label).cast("int").alias("_y"), F.col(features).alias("_x"), (share(0) < held_share).alias("_held"))
    counts = dict(rows.filter("not _held").groupBy("_y").count().collect())
    classes, n, width = max(counts) + 1, sum(counts.values()), len(rows.first()["_x"])
    rows = rows.repartition(df.sparkSession.sparkContext.defaultParallelism, key)
    model = Boosted([math.log(max(counts.get(k, 0), 0.5) / n) for k in range(classes)], rate, features)
    state = stored(rows.withColumn("_m", F.array(*[F.lit(s) for s in model.start])), "margins")
    rng, best = random.Random(seed), (float("inf"), 0)
    for number in range(1, rounds + 1):
        trees = []
        names = sorted(rng.sample(range(width), max(1, round(column_share * width))))
        drawn = _picked(state.filter(~F.col("_held") & (share(number) < row_share)), "_x", names, "_part")
        wide = stored(drawn.select("_y", "_part", _softmax("_m").alias("_p")), "drawn")
        for k in range(classes):
            target = wide.withColumn("_g", (F.col("_y") == k).cast("double") - F.col("_p")[k])
            tree = DecisionTreeRegressor(labelCol="_g", featuresCol="_part", maxDepth=depth, seed=seed).fit(target)
            trees.append((names, tree.setFeaturesCol("_part")))
        model.rounds.append(trees)
        scored = _picked(state, "_x", names, "_part")
        for k, (_, tree) in enumerate(trees):
            scored = tree.transform(scored).withColumn(f"_f{k}", F.col("prediction")).drop("prediction")
        new = F.array(*[F.col("_m")[k] + rate * F.col(f"_f{k}") for k in range(classes)])
        state = stored(scored.select(key, "_y", "_x", "_held", new.alias("_m")), "margins")
        loss = -F.log(F.greatest(_softmax("_m")[F.col("_y")], F.lit(1e-12)))
        seen, held = state.agg(F.avg(F.when(~F.col("_held"), loss)), F.avg(F.when(F.col("_held"), loss))).first()
        model.curve.append((number, seen, held))
        best = min(best, (held if held is not None else seen, number))
        if number - best[1] >= patience:
            break
    model.rounds = model.rounds[: best[1]]
    return model


def learning_curve(spark, model: Boosted) -> DataFrame:
    """(round, loss, held_loss) of a boosted model, the rounds after the best one included."""
    return spark.createDataFrame(model.curve, "round int, loss double, held_loss double")


def perceptron(df, layers, label="label", features="features", iters=60, seed=1):
    return MultilayerPerceptronClassifier(
        labelCol=label, featuresCol=features, layers=layers, maxIter=iters, seed=seed
    ).fit(df)


def metric(predictions: DataFrame, name: str = "accuracy", label: str = "label") -> float:
    return MulticlassClassificationEvaluator(labelCol=label, metricName=name).evaluate(predictions)


def chain(stages: list, df: DataFrame):
    """Fitted chain of stages; single fitted stages are in `.stages`."""
    return Pipeline(stages=stages).fit(df)


def two_stage(df: DataFrame, quantity: str, features="features", trees=20, depth=5, seed=1):
    """Zero / non-zero classifier and a regressor on the non-zero rows.

    Returns a scoring function and a quality figure: class accuracy times the fit of the regressor.
    """
    flagged = stored(df.withColumn("label", (F.col(quantity) > 0).cast("double")), "flagged")
    classes = forest(flagged, "label", features, trees, depth, seed=seed)
    positive = flagged.filter("label = 1")
    amounts = regression_forest(positive, quantity, features, trees, depth, seed)

    def score(rows: DataFrame) -> DataFrame:
        sold = classes.transform(rows).select(
            *rows.columns, F.col("prediction").alias("_sold"), vector_to_array("probability")[1].alias("sold_probability")
        )
        amount = amounts.transform(sold)
        expected = F.when(F.col("_sold") == 1, F.col("prediction")).otherwise(F.lit(0.0))
        return amount.withColumn("expected", expected).drop("_sold", "prediction")

    return score, metric(classes.transform(flagged)) * evaluate(amounts.transform(positive), quantity, "r2")


def text_classifier(df: DataFrame, text: str, label: str, vocabulary: list[str], iters: int = 50, reg: float = 0.01):
    """Fixed-vocabulary word counts and a binary logistic model on cleaned short texts."""
    rows = df.select(clean_social(F.col(text)).alias("_words"), F.col(label).cast("double").alias("label"))
    bag = CountVectorizerModel.from_vocabulary(sorted(vocabulary), inputCol="_words", outputCol="features")
    return chain([bag, LogisticRegression(maxIter=iters, regParam=reg)], rows)


def score_text(df: DataFrame, text: str, model, bounds: list[float], labels: list[str]) -> DataFrame:
    """Probability and score band per text, for tables and streams."""
    scored = model.transform(df.withColumn("_words", clean_social(F.col(text))))
    p = vector_to_array("probability")[1]
    return scored.select(*df.columns, p.alias("score"), score_band(p, bounds, labels).alias("band"))
