"""Linear models."""

from __future__ import annotations

import math

import numpy as np
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, functions as F


def linear(df: DataFrame, label: str, features="features", iters=10, reg=0.3, elastic=0.8, **params):
    return LinearRegression(
        labelCol=label, featuresCol=features, maxIter=iters, regParam=reg, elasticNetParam=elastic, **params
    ).fit(df)


def forest(df: DataFrame, label: str, features="features", trees=20, depth=5, seed=1):
    return RandomForestRegressor(labelCol=label, featuresCol=features, numTrees=trees, maxDepth=depth, seed=seed).fit(df)


def training_summary(spark, model) -> DataFrame:
    """Iterations, objective per iteration, error and fit of a trained linear model, long form."""
    s = model.summary
    rows = [("iterations", 0, float(s.totalIterations)), ("rmse", 0, float(s.rootMeanSquaredError)), ("r2", 0, float(s.r2))]
    rows += [("objective", i, float(v)) for i, v in enumerate(s.objectiveHistory)]
    return spark.createDataFrame(rows, "name string, step int, value double")


def residuals(predictions: DataFrame, label: str) -> DataFrame:
    """Rows with `residual`, label less prediction."""
    return predictions.withColumn("residual", F.col(label) - F.col("prediction"))


def residual_sketch(rows: DataFrame, by: list[str] = ()) -> DataFrame:
    """(by, n, sketch): a mergeable quantile sketch of the residuals per key, or of the whole table."""
    return rows.groupBy(*by).agg(F.count("residual").alias("n"), F.kll_sketch_agg_double(F.col("residual").cast("double")).alias("sketch"))


def residual_quantiles(sketches: DataFrame, shares: list[float]) -> DataFrame:
    """(share, residual): quantiles of all residuals from any number of sketches. The rank is off by about 1.7 % of the rows at most."""
    merged = sketches.agg(F.kll_merge_agg_double("sketch").alias("sketch"))
    found = [F.struct(F.lit(float(s)).alias("share"), F.kll_sketch_get_quantile_double("sketch", F.lit(float(s))).alias("residual")) for s in shares]
    return merged.select(F.inline(F.array(*found)))


def gradient_descent(df: DataFrame, cols: list[str], label: str, step: float, iters: int) -> list[float]:
    """Weights (no intercept) after full-batch descent from zero with step / sqrt(t) at iteration t.

    The gradient of the squared error only needs the sums of x·x and x·y, so the table is read once
    whatever the number of iterations.
    """
    sums = [F.avg(F.col(a) * F.col(b)).alias(f"{i}_{j}") for i, a in enumerate(cols) for j, b in enumerate(cols)]
    sums += [F.avg(F.col(a) * F.col(label)).alias(f"y_{i}") for i, a in enumerate(cols)]
    row = df.agg(*sums).first()
    n = len(cols)
    xx = np.array([[row[f"{i}_{j}"] for j in range(n)] for i in range(n)])
    xy = np.array([row[f"y_{i}"] for i in range(n)])
    w = np.zeros(n)
    for t in range(1, iters + 1):
        w = w - step / math.sqrt(t) * (xx @ w - xy)
    return [float(v) for v in w]


def evaluate(predictions: DataFrame, label: str, metric: str = "rmse") -> float:
    return RegressionEvaluator(labelCol=label, predictionCol="prediction", metricName=metric).evaluate(predictions)
