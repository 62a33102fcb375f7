"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a skewed join stays split even where that costs another exchange
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # whole texts travel in these batches, so few rows at a time
    "spark.sql.execution.arrow.maxRecordsPerBatch": "500",
}


def prepare(spark: SparkSession) -> None:
    """Session settings that the operators of this subpackage are tuned for."""
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)


def text_of(column: str) -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(column), F.lit(""))


def carried(df: DataFrame, **keys: Column) -> DataFrame:
    """All columns of `df` as one struct `carried` beside `keys`, so that no name of theirs can clash; `df` is `carried.*`."""
    own = F.struct(*[F.col(f"`{c}`") for c in df.columns]) if df.columns else F.struct(F.lit(None))
    return df.select(own.alias("carried"), *[value.alias(name) for name, value in keys.items()])


def unit_interval(*columns: Column | str, seed: int = 0) -> Column:
    """A number in [0, 1) that depends on the columns' values and the seed only."""
    return F.pmod(F.xxhash64(F.lit(seed), *columns), F.lit(1 << 52)) / F.lit(float(1 << 52))


def whole_groups(frames: Iterable[pd.DataFrame], key: Callable[[pd.DataFrame], np.ndarray]) -> Iterator[pd.DataFrame]:
    """Frames that hold whole groups only, from a stream sorted by the group's key.

    `key` gives one comparable number per row. The last group of a frame is held back until the next
    frame shows that it has ended; callers bound the size of a group.
    """
    held: list[pd.DataFrame] = []
    last = None
    for frame in frames:
        if not len(frame):
            continue
        keys = key(frame)
        if held and keys[-1] == last:
            held.append(frame)
            continue
        cut = int(np.flatnonzero(keys != keys[-1])[-1]) + 1 if keys[0] != keys[-1] else 0
        if held or cut:
            yield pd.concat([*held, frame.iloc[:cut]], ignore_index=True)
        held, last = [frame.iloc[cut:]], keys[-1]
    if held:
        yield pd.concat(held, ignore_index=True)


def spans(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of equal values."""
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.empty(0, np.int64)
    return starts, np.r_[starts[1:], len(keys)].astype(np.int64) if len(keys) else starts


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of n nodes the smallest node it is linked with, by links a[k] - b[k]."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new[root], root):
            break
        root = new[root]
    return root
