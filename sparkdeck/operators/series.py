"""Parcel time series in long form: (parcel, date, value)."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, functions as F

from ..session import stored

#: dates of a list
DATES = 1000


def _date_counts(df: DataFrame, id_col: str, date: str, value: str) -> tuple[DataFrame, int]:
    present = df.groupBy(date).agg(F.count(value).alias("present"))
    parcels = df.agg(F.count_distinct(F.col(id_col))).first()[0]
    return present, parcels


def missing_per_date(df: DataFrame, id_col: str, date: str, value: str) -> DataFrame:
    """(date, kind, n): parcels with and without a value on each date."""
    present, parcels = _date_counts(df, id_col, date, value)
    both = present.withColumn("missing", F.lit(parcels) - F.col("present"))
    return both.unpivot([date], ["missing", "present"], "kind", "n")


def drop_sparse_dates(df: DataFrame, id_col: str, date: str, value: str, share: float) -> DataFrame:
    """Keep the dates on which fewer than `share` of the parcels are missing."""
    present, parcels = _date_counts(df, id_col, date, value)
    kept = present.filter(F.lit(parcels) - F.col("present") < math.floor(share * parcels)).select(date)
    return df.join(kept, date, "left_semi").select(*df.columns)


def complete(df: DataFrame, id_col: str, date: str) -> DataFrame:
    """One row per parcel and date of the table, null where nothing was observed.

    The distinct dates are dealt over lists of about `DATES`, and every parcel unfolds each list by its number, so the
    dates never come to the driver and no row holds all of them; a stray date adds one row per parcel, as it does to the result.
    """
    dates = stored(df.select(F.col(date).alias("_date")).filter(F.col("_date").isNotNull()).distinct(), "dates")
    lists = max(1, -(-dates.count() // DATES))
    dealt = dates.groupBy(F.pmod(F.xxhash64("_date"), F.lit(lists)).cast("int").alias("_list")).agg(F.collect_list("_date").alias("_dates"))
    parcels = df.select(id_col).distinct().withColumn("_of", F.explode(F.sequence(F.lit(0), F.lit(lists - 1))))
    grid = parcels.join(dealt, F.col("_of") == F.col("_list")).select(id_col, F.explode("_dates").alias(date))
    return grid.join(df, [id_col, date], "left")


def pivot_dates(df: DataFrame, id_col: str, date: str, value: str, dates: list[str]) -> DataFrame:
    """Wide table with one column per given date, named yyyymmdd."""
    cells = [
        F.max(F.when(F.col(date) == F.lit(d).cast("date"), F.col(value))).alias(d.replace("-", "")) for d in dates
    ]
    return df.groupBy(id_col).agg(*cells)
