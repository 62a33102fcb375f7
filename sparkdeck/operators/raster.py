"""Raster work on pixel tables: one row per cell with its coordinates, tile key and band columns.

No-data is NULL (use `nan_to_null` at ingest); arithmetic and aggregates then skip it by themselves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.scalar import clamp_rescale, right_closed
from .ordered import quantiles

NODATA = -2147483648.0
TILE = ["tile_col", "tile_row"]
# Right-closed class edges and names of the vegetation index.
CLASS_EDGES = [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7]
CLASS_NAMES = [
    "0 - NDVI <= 0.0",
    "1 - NDVI in (0.0; 0.1]",
    "2 - NDVI in (0.1; 0.2]",
    "3 - NDVI in (0.2; 0.3]",
    "4 - NDVI in (0.3; 0.4]",
    "5 - NDVI in (0.4; 0.5]",
    "6 - NDVI in (0.5; 0.6]",
    "7 - NDVI in (0.6; 0.7]",
    "8 - NDVI > 0.7",
]
# Colour ramp of the vegetation index.
COLOR_RAMP = (
    "0:ffffe5ff;0.1:f7fcb9ff;0.2:d9f0a3ff;0.3:addd8eff;0.4:78c679ff;"
    "0.5:41ab5dff;0.6:238443ff;0.7:006837ff;1:004529ff"
)


def tile_keys(df: DataFrame, width: int, height: int) -> DataFrame:
    return df.withColumns(
        {"tile_col": F.floor(F.col("x") / width), "tile_row": F.floor(F.col("y") / height)}
    )


def layer_extent(df: DataFrame) -> DataFrame:
    """Cell and tile bounds of a layer, one row."""
    return df.agg(
        *[F.min(c).alias(f"min_{c}") for c in ("x", "y", *TILE)],
        *[F.max(c).alias(f"max_{c}") for c in ("x", "y", *TILE)],
    )


def to_double(df: DataFrame, cols: list[str], nodata) -> DataFrame:
    return df.withColumns({c: F.when(F.col(c) != nodata, F.col(c).cast("double")) for c in cols})


def normalized_difference(df: DataFrame, a: str, b: str, out: str, cap: float | None = None) -> DataFrame:
    """(a - b) / (a + b) in doubles; no-data where the sum is zero."""
    x, y = F.col(a).cast("double"), F.col(b).cast("double")
    value = F.when(x + y != 0, (x - y) / (x + y))
    if cap is not None:
        value = F.when(value > cap, F.lit(float(cap))).otherwise(value)
    return df.withColumn(out, value)


def raster_diff(later: DataFrame, earlier: DataFrame, value: str, out: str = "diff", neg: float = -99.0):
    """Later minus earlier where both have the cell; negative later values are set to `neg` first."""
    v = F.col(value)
    a = later.select("x", "y", F.when(v < 0, F.lit(neg)).otherwise(v).alias("_later"))
    b = earlier.select("x", "y", v.alias("_earlier"))
    return a.join(b, ["x", "y"]).select("x", "y", (F.col("_later") - F.col("_earlier")).alias(out))


def assemble_bands(df: DataFrame, bands: list[str]) -> DataFrame:
    """One row per cell with one column per named band; null for a band the cell lacks."""
    cols = [F.max(F.when(F.col("band") == b, F.col("value"))).alias(b) for b in bands]
    return df.filter(F.col("band").isin(bands)).groupBy("scene", "x", "y").agg(*cols)


def composite(df: DataFrame, bands: list[str], lo: float = 4000.0, hi: float = 15176.0, nodata: float = 0.0):
    """Bands clamped to [lo, hi] and stretched to 0–255; no-data cells keep their value."""
    return df.withColumns(
        {b: F.when(F.col(b) == nodata, F.col(b)).otherwise(clamp_rescale(F.col(b), lo, hi)) for b in bands}
    )


def tile_stats(df: DataFrame, value: str, min_nan: int = 1, by: list[str] | None = None) -> DataFrame:
    """Extent, minimum, maximum, mean and population deviation per tile.

    A tile with at least `min_nan` no-data cells takes the sentinel for all values (deviation 0); with
    fewer, but some, no-data cells its statistics are null.
    """
    by = by or TILE
    v = F.col(value)
    gaps = F.count(F.lit(1)) - F.count(v)

    def rule(stat, sentinel):
        return F.when(gaps >= min_nan, F.lit(sentinel)).when(gaps == 0, stat)

    return df.groupBy(*by).agg(
        F.min("x").alias("xmin"),
        F.min("y").alias("ymin"),
        (F.max("x") + 1).alias("xmax"),
        (F.max("y") + 1).alias("ymax"),
        rule(F.min(v), NODATA).alias("min"),
        rule(F.max(v), NODATA).alias("max"),
        rule(F.avg(v), NODATA).alias("mean"),
        rule(F.stddev_pop(v), 0.0).alias("std"),
    )


def tile_mean_fill(df: DataFrame, value: str, out: str, by: list[str] | None = None) -> DataFrame:
    """Every cell takes the mean of its tile. The mean is aggregated first and joined back, so a tile
    of any size combines before the shuffle."""
    by = by or TILE
    means = df.groupBy(*by).agg(F.avg(value).alias(out))
    return df.join(means, by)


def class_histogram(df: DataFrame, value: str, edges=CLASS_EDGES, names=CLASS_NAMES, by=()) -> DataFrame:
    cls = right_closed(F.col(value), list(edges), list(names))
    return (
        df.select(*by, cls.alias("class"))
        .filter(F.col("class").isNotNull())
        .groupBy(*by, "class")
        .agg(F.count(F.lit(1)).alias("cnt"))
    )


def mosaic(df: DataFrame, value: str, priority: str) -> DataFrame:
    """One value per cell from overlapping tiles: the highest `priority` that has data wins."""
    best = F.max_by(value, F.when(F.col(value).isNotNull(), F.col(priority)))
    return df.groupBy("x", "y").agg(best.alias(value))


def zonal_stats(df: DataFrame, zone: str, value: str) -> DataFrame:
    """Minimum, maximum, mean, exact median and population deviation per zone."""
    v = F.col(value)
    base = df.groupBy(zone).agg(
        F.min(v).alias("min"), F.max(v).alias("max"), F.avg(v).alias("mean"), F.stddev_pop(v).alias("std")
    )
    return base.join(quantiles(df, [zone], value, {"median": 0.5}), zone, "left")


def segment_features(df: DataFrame, segment: list[str], bands: list[str], suffix: str = "") -> DataFrame:
    """Mean and population deviation of every band per segment."""
    aggs = [f(b).alias(f"{b}_{n}{suffix}") for b in bands for n, f in (("mean", F.avg), ("std", F.stddev_pop))]
    return df.groupBy(*segment).agg(*aggs)


def write_back(df: DataFrame, labels: DataFrame, segment: list[str], label: str, band: str, nodata=0.0):
    """Segment label per pixel; -1 on no-data pixels and on pixels of unlabelled segments."""
    joined = df.join(labels.select(*segment, label), segment, "left")
    return joined.withColumn(
        label, F.when(F.col(band) == nodata, F.lit(-1)).otherwise(F.coalesce(F.col(label), F.lit(-1)))
    )


def median_filter(df: DataFrame, value: str, size: int = 3, out: str | None = None) -> DataFrame:
    """Median over a size×size neighbourhood; border cells repeat the edge, no-data cells stay.

    Each cell is sent once to every cell that sees it, with the number of times the repeated edge makes it
    count; the cell's own row rides along. So a group never holds more than size² rows and there
    is one shuffle. Cells missing inside the grid are left out of the median.
    """
    r = size // 2
    bounds = df.agg(F.min("x"), F.max("x"), F.min("y"), F.max("y")).first()
    if bounds[0] is None:
        return df.withColumn(out or value, F.col(value))

    def seen(axis: str, low: int, high: int) -> tuple[Column, Column]:
        """Places along an axis that see a cell, and how often place `_t` sees it."""
        places = F.sequence(F.greatest(F.col(axis) - r, F.lit(low)), F.least(F.col(axis) + r, F.lit(high)))
        at = F.col(f"_t{axis}")
        times = F.when(F.col(axis) == low, low - at + r + 1).when(F.col(axis) == high, at - high + r + 1).otherwise(1)
        return places, F.lit(size) if low == high else times

    (xs, x_times), (ys, y_times) = seen("x", *bounds[:2]), seen("y", *bounds[2:])
    names = df.columns
    sent = df.withColumn("_tx", F.explode(xs)).withColumn("_ty", F.explode(ys))
    own = (F.col("_tx") == F.col("x")) & (F.col("_ty") == F.col("y"))
    sent = sent.select(
        "_tx", "_ty", F.col(value).alias("_v"), (x_times * y_times).alias("_times"), F.when(own, F.struct(*names)).alias("_row")
    )
    middle = sent.groupBy("_tx", "_ty").agg(
        F.percentile("_v", 0.5, F.col("_times")).alias("_m"), F.first("_row", ignorenulls=True).alias("_row")
    )
    rows = middle.filter(F.col("_row").isNotNull()).select("_row.*", "_m")
    return rows.withColumn(out or value, F.when(F.col(value).isNotNull(), F.col("_m"))).drop("_m")


def percentile_stretch(df: DataFrame, cols: list[str], lo: float = 0.02, hi: float = 0.98):
    """Stretch each band between two exact percentiles and clip to [0, 1]; the cut points are two
    scalars per band."""
    new = {}
    for c in cols:
        cut = quantiles(df, [], c, {"lo": lo, "hi": hi}).first()
        if cut is None or cut["hi"] == cut["lo"]:
            new[c] = F.lit(None).cast("double")
        else:
            new[c] = clamp_rescale(F.col(c), cut["lo"], cut["hi"], 0.0, 1.0)
    return df.withColumns(new)


def impute_mean(df: DataFrame, cols: list[str]) -> DataFrame:
    """Nulls take the column mean (one scalar per column)."""
    means = df.agg(*[F.avg(c).alias(c) for c in cols]).first()
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(means[c])) for c in cols})


def overlay(image: DataFrame, labels: DataFrame, value: str, label: str, out: str) -> DataFrame:
    """Label where it is positive, image value elsewhere."""
    joined = image.join(labels.select("x", "y", label), ["x", "y"], "left")
    return joined.withColumn(out, F.when(F.col(label) > 0, F.col(label)).otherwise(F.col(value)))
