"""Exact nearest neighbours of every row, and oversampling built on them.

Points are looked up on grids of halving cell size. A point takes the finest level at which the cells
around it still hold k other rows; that block bounds its k-th distance, so only cells within the bound
are compared. At the next finer level the block holds at most k rows, hence few points of a cell search
on the same level and the comparisons stay near linear in the table, dense spots included. Rows at the
same coordinates count as one weighted point.

Written points are small files, and a row per level is many times what the planner takes them for, so the joins
are merged: none of the sides is ever collected to be broadcast.
"""

from __future__ import annotations

import math
from functools import reduce
from itertools import product

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from ..session import stored
from .relational import hash_unit

LEVELS_PER_ROUND = 8


def _keyed(df: DataFrame, cols: list[str], low: list[float], size: float, levels: list[int]) -> DataFrame:
    """One row per point and level with its cell numbers."""
    out = df.withColumn("_level", F.explode(F.array(*[F.lit(v) for v in levels])))
    side = F.lit(size) / F.pow(F.lit(2.0), F.col("_level"))
    return out.withColumns({f"_c{i}": F.floor((F.col(c) - lo) / side) for i, (c, lo) in enumerate(zip(cols, low))})


def _shifted(df: DataFrame, n: int, reach: int, keep=lambda step: True) -> DataFrame:
    """One row per cell around the row's own cell; the cell numbers become those of the neighbour."""
    steps = [s for s in product(range(-reach, reach + 1), repeat=n) if keep(s)]
    shifts = F.array(*[F.struct(*[F.lit(v).alias(f"d{i}") for i, v in enumerate(s)]) for s in steps])
    out = df.withColumn("_d", F.explode(shifts))
    return out.withColumns({f"_c{i}": F.col(f"_c{i}") + F.col(f"_d.d{i}") for i in range(n)}).drop("_d")


def neighbours(points: DataFrame, cols: list[str], k: int) -> DataFrame:
    """Nearest others of each distinct point until they make up k rows.

    `points` has the coordinates and a weight `w`. Result: coordinates, `n_`-coordinates of the
    neighbour, `dist`, `upto` = number of other rows up to and including this neighbour. A point with
    several rows is its own first neighbour at distance 0.
    """
    n = len(cols)
    box = points.agg(*[F.min(c) for c in cols], *[F.max(c) for c in cols]).first()
    if box[0] is None:
        box = [0.0] * (2 * n)
    low, high = list(box[:n]), list(box[n:])
    size = max(max(b - a for a, b in zip(low, high)) * 1.001, 1e-300)
    cells = [f"_c{i}" for i in range(n)]
    reach = math.ceil(2 * math.sqrt(n))
    others = points.select(*[F.col(c).alias(f"n_{c}") for c in cols], F.col("w").alias("n_w"))
    # k or more copies already fill the list
    itself = points.filter(F.col("w") > k).select(
        *cols, *[F.col(c).alias(f"n_{c}") for c in cols], F.lit(0.0).alias("dist"), (F.col("w") - 1).alias("upto")
    )
    found, active, base = [itself], stored(points.filter(F.col("w") <= k), "active"), 0
    while True:
        levels = list(range(base, base + LEVELS_PER_ROUND + 1))
        counts = _keyed(points, cols, low, size, levels[1:]).groupBy("_level", *cells).agg(F.sum("w").alias("_n"))
        blocks = _shifted(counts, n, 1).groupBy("_level", *cells).agg(F.sum("_n").alias("_n"))
        full = blocks.filter(F.col("_n") > k)
        deepest = (
            _keyed(active, cols, low, size, levels[1:])
            .join(full.hint("merge"), ["_level", *cells])
            .groupBy(*cols)
            .agg(F.max("_level").alias("_deepest"))
        )
        placed = stored(
            active.join(deepest.hint("merge"), cols, "left").select(*cols, "w", F.coalesce("_deepest", F.lit(base)).alias("_level")), "placed"
        )
        settled = placed.filter(F.col("_level") < levels[-1])
        asking = _keyed(settled.withColumnRenamed("_level", "_at"), cols, low, size, levels[:-1])
        asking = asking.filter(F.col("_level") == F.col("_at")).drop("_at", "w")
        near = _shifted(asking, n, reach, lambda s: sum(max(abs(v) - 1, 0) ** 2 for v in s) <= 4 * n)
        listed = _keyed(others, [f"n_{c}" for c in cols], low, size, levels[:-1])
        dist = F.sqrt(reduce(lambda a, b: a + b, [F.pow(F.col(c) - F.col(f"n_{c}"), 2) for c in cols]))
        pairs = near.join(listed.hint("merge"), ["_level", *cells]).withColumn("dist", dist)
        if base:  # on level 0 every row is in reach
            bound = F.lit(2 * size * math.sqrt(n) * 1.000001) / F.pow(F.lit(2.0), F.col("_level"))
            pairs = pairs.filter(F.col("dist") <= bound)
        own = reduce(lambda a, b: a & b, [F.col(c) == F.col(f"n_{c}") for c in cols])
        pairs = pairs.withColumn("n_w", F.when(own, F.col("n_w") - 1).otherwise(F.col("n_w"))).filter("n_w > 0")
        order = Window.partitionBy(*cols).orderBy("dist", *[f"n_{c}" for c in cols])
        best = pairs.withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= k)
        upto = F.sum("n_w").over(order.rowsBetween(Window.unboundedPreceding, 0))
        best = best.withColumn("upto", upto).filter(F.col("upto") - F.col("n_w") < k)
        found.append(stored(best.select(*cols, *[f"n_{c}" for c in cols], "dist", "upto"), "near"))
        active = placed.filter(F.col("_level") == levels[-1]).drop("_level")
        if active.isEmpty():
            return reduce(lambda a, b: a.unionByName(b), found)
        base = levels[-1]


def _weighted(df: DataFrame, cols: list[str]) -> DataFrame:
    points = df.groupBy(*[F.col(c).cast("double").alias(c) for c in cols]).agg(F.count(F.lit(1)).alias("w"))
    return stored(points, "points")


def kth_distance(df: DataFrame, id_col: str, cols: list[str], k: int) -> DataFrame:
    """(id, dist): distance of every row to its k-th nearest other row; sort it to choose a radius.

    With fewer than k other rows it is the distance to the farthest."""
    near = neighbours(_weighted(df, cols), cols, k)
    far = near.groupBy(*cols).agg(F.max("dist").alias("dist"))
    rows = df.select(F.col(id_col).alias("id"), *[F.col(c).cast("double").alias(c) for c in cols])
    return rows.join(far.hint("merge"), cols).select("id", "dist")


def oversample(
    df: DataFrame, id_col: str, cols: list[str], label: str, minority, over: int = 1, under: float = 3.0, k: int = 5, seed: int = 1
) -> DataFrame:
    """(label, *cols, synthetic): the minority rows, `over` new rows per minority row on the line to one
    of its k nearest minority rows, and about `under` majority rows per new row.

    All choices come from hashes of the id, so a repeated run gives the same rows.
    """
    numbers = [F.col(c).cast("double").alias(c) for c in cols]
    few = stored(df.filter(F.col(label) == minority).select(F.col(id_col).alias("_id"), label, *numbers), "minority")
    many = df.filter(F.col(label) != minority).select(F.col(id_col).alias("_id"), label, *numbers)
    near = neighbours(_weighted(few, cols), cols, k)
    # entry j of the list is the first neighbour that covers j rows; a point has at most k entries
    entries = F.sort_array(F.collect_list(F.struct("upto", *[f"n_{c}" for c in cols])))
    lists = near.groupBy(*cols).agg(entries.alias("_near"))
    drawn = few.join(lists.hint("merge"), cols).withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(over))))
    have = F.least(F.element_at("_near", -1)["upto"], F.lit(k))
    drawn = drawn.withColumn("_j", F.pmod(F.xxhash64("_id", "_copy", F.lit(seed)), have) + 1)
    chosen = F.get(F.filter("_near", lambda e: e["upto"] >= F.col("_j")), F.lit(0))
    gap = hash_unit(F.concat_ws("/", F.col("_id").cast("string"), F.col("_copy").cast("string")), seed + 1)
    drawn = drawn.withColumns({"_to": chosen, "_gap": gap})
    new = drawn.select(
        label, *[(F.col(c) + F.col("_gap") * (F.col(f"_to.n_{c}") - F.col(c))).alias(c) for c in cols], F.lit(True).alias("synthetic")
    )
    sizes = df.agg(F.count(F.when(F.col(label) == minority, 1)), F.count(F.when(F.col(label) != minority, 1))).first()
    rate = under * over * sizes[0] / max(sizes[1], 1)
    times = F.floor(F.lit(rate)) + (hash_unit(F.col("_id"), seed + 2) < rate - math.floor(rate)).cast("int")
    kept = many.withColumn("_t", F.explode(F.array_repeat(F.lit(1), times.cast("int")))).select(label, *cols)
    old = few.select(label, *cols).unionByName(kept).withColumn("synthetic", F.lit(False))
    return old.unionByName(new)
