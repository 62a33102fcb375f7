"""Numbers, dates and classes as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

EARTH_KM = 6372.8


def score_band(col: Column, bounds: list[float], labels: list[str]) -> Column:
    """First label whose lower bound the value reaches; the last label below all bounds."""
    expr = F.lit(labels[-1])
    for bound, label in reversed(list(zip(bounds, labels))):
        expr = F.when(col >= bound, F.lit(label)).otherwise(expr)
    return F.when(col.isNotNull(), expr)


def right_closed(col: Column, edges: list[float], labels: list | None = None) -> Column:
    """Class i for values in (edge[i-1], edge[i]]; the last class lies above all edges."""
    labels = labels or list(range(len(edges) + 1))
    expr = F.lit(labels[-1])
    for edge, label in reversed(list(zip(edges, labels))):
        expr = F.when(col <= edge, F.lit(label)).otherwise(expr)
    return F.when(col.isNotNull() & ~F.isnan(col), expr)


def color_ramp(col: Column, ramp: str) -> Column:
    """Colour of the highest threshold at or below the value, from a "threshold:colour;…" text;
    values below all thresholds take the first colour."""
    steps = [part.split(":") for part in ramp.split(";")]
    expr = F.lit(steps[0][1])
    for threshold, color in steps[1:]:
        expr = F.when(col >= float(threshold), F.lit(color)).otherwise(expr)
    return F.when(col.isNotNull() & ~F.isnan(col), expr)


def clamp_rescale(col: Column, lo: float, hi: float, out_lo: float = 0.0, out_hi: float = 255.0):
    """Clamp to [lo, hi], then stretch linearly to [out_lo, out_hi]."""
    clamped = F.least(F.greatest(col, F.lit(float(lo))), F.lit(float(hi)))
    return (clamped - lo) / F.lit(float(hi - lo)) * (out_hi - out_lo) + out_lo


def nan_to_null(col: Column) -> Column:
    return F.when(~F.isnan(col), col)


def logistic(col: Column) -> Column:
    """e^x / (1 + e^x) in the form that does not overflow."""
    return 1 / (1 + F.exp(-col))


def haversine(lat1: Column, lon1: Column, lat2: Column, lon2: Column, radius: float = EARTH_KM):
    """Great-circle distance in the unit of `radius`."""
    dlat, dlon = F.radians(lat2 - lat1) / 2, F.radians(lon2 - lon1) / 2
    a = F.pow(F.sin(dlat), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(dlon), 2)
    return 2 * radius * F.asin(F.sqrt(F.least(a, F.lit(1.0))))


def age_years(born: Column, as_of: Column) -> Column:
    """Whole years of 365 days."""
    days = F.datediff(as_of, born)
    return F.when(days >= 0, F.floor(days / 365)).otherwise(F.ceil(days / 365))


def decimal_comma(col: Column) -> Column:
    """Number written with a decimal comma; null when it is not a number."""
    return F.regexp_replace(col, ",", ".").try_cast("double")


def name_date(col: Column) -> Column:
    """Date from the first eight-digit token of a file or column name."""
    return F.try_to_date(F.nullif(F.regexp_extract(col, r"(\d{8})", 1), F.lit("")), "yyyyMMdd")
