"""Missing values of a series from the most alike other series."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..session import stored
from .ordered import row_index, top_k
from .series import complete

#: series and values of a block at the most; two blocks are compared in one task
BLOCK, VALUES = 8192, 1 << 22
#: series compared with a block at a time
ROWS = 256
#: nearest series of a block that are looked at first for the missing values of one, and so many times more if these do not have them
NEAR, WIDER = 48, 8
#: every so many-th of a block is looked at to estimate how far these are
SEEN = 1024


def _dense(frame: pd.DataFrame, names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values and presence of each series on the given dates."""
    sizes = frame["keys"].map(len).to_numpy()
    row = np.repeat(np.arange(len(frame)), sizes)
    at = np.searchsorted(names, np.concatenate(frame["keys"].to_list()))
    values, there = np.zeros((len(frame), len(names))), np.zeros((len(frame), len(names)), bool)
    values[row, at], there[row, at] = np.concatenate(frame["values"].to_list()), True
    return values, there


def _offers(left: pd.DataFrame, right: pd.DataFrame, k: int) -> list[pd.DataFrame]:
    """For every date that a series of `left` lacks, the k most alike of `right` that have it."""
    names = np.unique(np.concatenate([*left["keys"], *right["keys"]]))
    x, seen = _dense(left, names)
    y, held = _dense(right, names)
    own, others = left["number"].to_numpy(), right["number"].to_numpy()
    weight, squares = held.astype(float), (y**2).T
    most = (y**2).sum(1).max(initial=0)
    step = -(-len(right) // SEEN)
    reach = [n // step for n in (NEAR, WIDER * NEAR) if n < len(right)]
    out = []

    def nearest(p: int, among: np.ndarray, upto: float) -> tuple[np.ndarray, np.ndarray]:
        """Those of `among` within the distance `upto`, nearest first, and their exact distances."""
        common = seen[p] & held[among]
        n = common.sum(1)
        distance = np.where(common, (x[p] - y[among]) ** 2, 0.0).sum(1) / np.maximum(n, 1)
        order = np.lexsort((others[among], distance))
        order = order[(n[order] > 0) & (distance[order] <= upto)]
        return among[order], distance[order]

    for start in range(0, len(left), ROWS):
        at = slice(start, start + ROWS)
        # products give every distance at once, a little off: they only tell which series may be near
        count = seen[at].astype(float) @ weight.T
        rough = (x[at] ** 2) @ weight.T + seen[at] @ squares - 2 * (x[at] @ y.T)
        rough = np.where(count > 0, rough / np.maximum(count, 1), np.inf)
        slack = 1e-11 * ((x[at] ** 2).sum(1) + most)
        wanted = ~seen[at] & ((count > 0).astype(float) @ weight > 0)
        ends = np.partition(rough[:, ::step], reach, axis=1)[:, reach] if reach else None
        for p in np.flatnonzero(wanted.any(1)):
            gaps = np.flatnonzero(wanted[p])
            order = None
            for upto in ends[p] if reach else ():
                if not np.isfinite(upto):
                    break
                # what is not among these is farther than `upto`, whatever the products are off
                order, distance = nearest(start + p, np.flatnonzero(rough[p] <= upto + slack[p]), upto)
                if (held[order][:, gaps].sum(0) >= k).all():
                    break
                order = None
            if order is None:
                order, distance = nearest(start + p, np.arange(len(right)), np.inf)
            usable = held[order][:, gaps]
            row, column = np.nonzero(usable & (np.cumsum(usable, axis=0) <= k))
            source, gap = order[row], gaps[column]
            out.append((np.full(len(row), own[start + p]), names[gap], others[source], distance[row], y[source, gap]))
    if not out:
        return []
    return [pd.DataFrame(dict(zip(("number", "key", "other", "distance", "v"), map(np.concatenate, zip(*out)))))]


def knn_fill(
    df: DataFrame, id_col: str, date: str, value: str, k: int = 5, group: str | None = None, block: int = BLOCK, out: str = "filled"
) -> DataFrame:
    """One row per series and date of the table; `out` says that the value was missing and comes from the k most alike series.

    The distance of two series is the mean squared difference on the dates that both have. A missing value is the mean
    of those of the k nearest series that have the date, weighted by 1 / distance; series at distance 0 count alone, and equally.
    Ties go to the smaller id. Without a series to take it from, the value stays null. With `group`, only series of the same
    group (a crop, a region) are compared.

    Series are dealt over blocks and every two blocks of a group are compared in one task, which gives at most k
    offers for each missing value; the best k of all of them are among these. So nothing but offers is shuffled, while the comparisons
    grow with the square of a group: that is what the distance to all others asks for, and `group` is what bounds it.
    Rows with a null value are missing; `(id, date)` must be unique, ids must not be null.
    """
    key = F.xxhash64(date)
    # numbers follow the order of the ids, so that ties go to the smaller one
    names = stored(row_index(df.select(id_col, *([group] if group else [])).distinct(), [], [id_col], "number"), "names")
    kept = df.filter(F.col(value).isNotNull()).select(id_col, key.alias("key"), F.col(value).cast("double").alias("v"))
    whole = kept.join(names, id_col).groupBy("number", *([group] if group else []))
    series = whole.agg(F.collect_list(F.struct("key", "v")).alias("e"))
    of = F.col(group) if group else F.lit(0)
    series = stored(series.select("number", of.alias("of"), F.col("e.key").alias("keys"), F.col("e.v").alias("values")), "series")
    full = F.greatest(F.count(F.lit(1)) / block, F.sum(F.size("keys")) / VALUES)
    sizes = series.groupBy(F.col("of").alias("sized")).agg(F.ceil(full).cast("int").alias("blocks"))
    dealt = series.join(sizes, F.col("of").eqNullSafe(F.col("sized"))).withColumn("own", F.pmod(F.xxhash64("number"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("met", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.withColumns({"low": F.least("own", "met"), "high": F.greatest("own", "met")})

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        low, high = frame["low"].iloc[0], frame["high"].iloc[0]
        left, right = frame[frame["own"] == low], frame[frame["own"] == high]
        found = [] if left.empty or right.empty else _offers(left, right, k)
        if low != high and not (left.empty or right.empty):
            found += _offers(right, left, k)
        empty = pd.DataFrame({c: np.empty(0, t) for c, t in (("number", np.int64), ("key", np.int64), ("other", np.int64), ("distance", float), ("v", float))})
        return pd.concat(found) if found else empty

    offers = dealt.select("of", "number", "keys", "values", "own", "low", "high").groupBy("of", "low", "high").applyInPandas(
        compare, "number long, key long, other long, distance double, v double"
    )
    best = top_k(offers, ["number", "key"], [F.col("distance"), F.col("other")], k, "_r")
    exact = F.avg(F.when(F.col("distance") == 0, F.col("v")))
    weighed = F.sum(F.col("v") / F.nullif("distance", F.lit(0.0))) / F.sum(1 / F.nullif("distance", F.lit(0.0)))
    new = best.groupBy("number", "key").agg(F.coalesce(exact, weighed).alias("_new"))
    new = new.join(names.select(F.col(id_col).alias("_id"), F.col("number").alias("_n")), F.col("number") == F.col("_n")).select("_id", "key", "_new")
    grid = complete(df, id_col, date).withColumn("_key", key)
    joined = grid.join(new, (F.col(id_col) == F.col("_id")) & (F.col("_key") == F.col("key")), "left")
    missing = F.col(value).isNull()
    columns = [F.coalesce(F.col(value), F.col("_new")).alias(c) if c == value else F.col(c) for c in df.columns]
    return joined.select(*columns, (missing & F.col("_new").isNotNull()).alias(out))

