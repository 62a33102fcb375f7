"""Isolation forest: trees grown on small fixed-size samples, scored in Arrow batches."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType

#: rows per tree: the sub-sample of the published method, whose trees isolate best on few rows
SAMPLE = 256


def _average_path(n: float) -> float:
    """Mean depth of an unsuccessful search among n points."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2 * (math.log(n - 1) + 0.5772156649015329) - 2 * (n - 1) / n


def _grow(points: np.ndarray, rng: np.random.Generator, depth: int, limit: int, nodes: list) -> int:
    """Append the node of `points` and return its number: (column, cut, left, right, path length)."""
    number = len(nodes)
    nodes.append(None)
    low, high = points.min(axis=0), points.max(axis=0)
    spread = np.flatnonzero(high > low)
    if depth >= limit or len(points) <= 1 or not len(spread):
        nodes[number] = (-1, 0.0, 0, 0, depth + _average_path(len(points)))
        return number
    column = int(rng.choice(spread))
    cut = float(rng.uniform(low[column], high[column]))
    left = points[:, column] < cut
    if not left.any() or left.all():
        left = points[:, column] <= low[column]
    a = _grow(points[left], rng, depth + 1, limit, nodes)
    b = _grow(points[~left], rng, depth + 1, limit, nodes)
    nodes[number] = (column, cut, a, b, 0.0)
    return number


def isolation_forest(df: DataFrame, id_col: str, cols: list[str], trees: int = 50, sample: int = SAMPLE, seed: int = 1):
    """Trees as lists of nodes. Each tree takes about `sample` rows chosen by a hash of the id, so one
    pass draws all samples and every group that reaches a task has a fixed size. Growing on such samples is
    what the method prescribes; all rows are scored."""
    total = df.count()
    rate = min(1.0, 4.0 * sample / max(total, 1))
    def place(tree):
        return F.pmod(F.xxhash64(F.col(id_col), tree, F.lit(seed)), F.lit(1 << 52)) / F.lit(float(1 << 52))

    # a row unfolds only for the trees that draw it
    drawing = F.filter(F.sequence(F.lit(0), F.lit(trees - 1)), lambda tree: place(tree) < rate)
    drawn = (
        df.select(id_col, *[F.col(c).cast("double").alias(c) for c in cols])
        .withColumn("tree", F.explode(drawing))
        .withColumn("_h", place(F.col("tree")))
    )
    limit = math.ceil(math.log2(sample))

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        number = int(pdf["tree"].iloc[0])
        points = pdf.sort_values(["_h", id_col]).head(sample)[cols].to_numpy()
        nodes: list = []
        _grow(points, np.random.default_rng([seed, number]), 0, limit, nodes)
        out = pd.DataFrame(nodes, columns=["col", "cut", "lo", "hi", "path"])
        return out.assign(tree=number, node=range(len(nodes)), size=len(points))

    schema = "tree int, node int, col int, cut double, lo int, hi int, path double, size int"
    grown = drawn.groupBy("tree").applyInPandas(grow, schema).orderBy("tree", "node")
    # at most trees * 2 * sample nodes, whatever the size of the table
    return grown.toPandas()


def isolation_scores(df: DataFrame, cols: list[str], forest: pd.DataFrame, out: str = "score") -> DataFrame:
    """Anomaly score in (0, 1]; rows that are cut off early score high."""
    model = [
        (t[["col", "lo", "hi"]].to_numpy(), t["cut"].to_numpy(), t["path"].to_numpy()) for _, t in forest.groupby("tree")
    ]
    scale = _average_path(float(forest["size"].max()))
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(DoubleType())
    def score(*values: pd.Series) -> pd.Series:
        x = np.column_stack([v.to_numpy(dtype=float) for v in values])
        total = np.zeros(len(x))
        rows = np.arange(len(x))
        for links, cut, path in shared.value:
            node = np.zeros(len(x), dtype=int)
            while True:
                column = links[node, 0]
                inner = column >= 0
                if not inner.any():
                    break
                goes_left = x[rows, np.maximum(column, 0)] < cut[node]
                node = np.where(inner, np.where(goes_left, links[node, 1], links[node, 2]), node)
            total += path[node]
        return pd.Series(np.power(2.0, -total / len(shared.value) / scale))

    return df.withColumn(out, score(*[F.col(c).cast("double") for c in cols]))
