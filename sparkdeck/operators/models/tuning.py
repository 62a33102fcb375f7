"""Parameter search, learning curves, saving and export."""

from __future__ import annotations

import random
import time

from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame

from ...session import stored
from ..relational import sample_by_hash


def grid(params: dict) -> list:
    """All combinations of {param: values}."""
    builder = ParamGridBuilder()
    for param, values in params.items():
        builder = builder.addGrid(param, values)
    return builder.build()


def draws(params: dict, n: int, seed: int = 1) -> list:
    """n random combinations of {param: values}."""
    rng = random.Random(seed)
    return [{p: rng.choice(list(v)) for p, v in params.items()} for _ in range(n)]


def search(df: DataFrame, estimator, settings: list, evaluator, folds: int = 3, seed: int = 1, parallelism: int = 2):
    """Cross-validated model over a list of settings."""
    validator = CrossValidator(
        estimator=estimator, estimatorParamMaps=settings, evaluator=evaluator, numFolds=folds, seed=seed,
        parallelism=parallelism,
    )
    return validator.fit(stored(df, "rows"))  # every setting reads it again


def search_table(spark, model) -> DataFrame:
    """(setting, metric): mean validation figure of every setting."""
    names = [", ".join(f"{p.name}={v}" for p, v in s.items()) for s in model.getEstimatorParamMaps()]
    return spark.createDataFrame(list(zip(names, [float(m) for m in model.avgMetrics])), "setting string, metric double")


def learning_curve(train: DataFrame, test: DataFrame, key: str, rates: list[float], fit, error) -> DataFrame:
    """(rate, rows, seconds, error) of a model trained on growing samples of the same rows."""
    out = []
    for rate in rates:
        part = sample_by_hash(train, key, rate) if rate < 1 else train
        start = time.time()
        model = fit(part)
        out.append((rate, part.count(), time.time() - start, float(error(model.transform(test)))))
    return train.sparkSession.createDataFrame(out, "rate double, rows bigint, seconds double, error double")


def save(model, path: str) -> None:
    model.write().overwrite().save(path)


def export_pmml(model, path: str) -> None:
    """PMML text of a k-means or linear model."""
    model.write().format("pmml").save(path)


def importances(spark, model, names: list[str]) -> DataFrame:
    return spark.createDataFrame(
        [(n, float(v)) for n, v in zip(names, model.featureImportances.toArray())], "feature string, importance double"
    )


def tree_text(spark, model) -> DataFrame:
    """Printed rules of a tree or forest, one row per line."""
    return spark.createDataFrame(list(enumerate(model.toDebugString.splitlines())), "line int, text string")
