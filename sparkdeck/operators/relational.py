"""Row, join and grouping operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

def lookup(df: DataFrame, dim: DataFrame, on: str, value: str, default, out: str):
    """Left lookup of one column with a default. Whether `dim` is broadcast is decided by its bytes at run time."""
    side = dim.select(F.col(on), F.col(value).alias(out))
    return df.join(side, on, "left").withColumn(out, F.coalesce(F.col(out), F.lit(default)))


def fill_by_type(df: DataFrame, number=0, text="-") -> DataFrame:
    """Nulls become `number` in numeric columns and `text` in string columns."""
    cols = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, T.NumericType):
            cols[f.name] = F.coalesce(F.col(f.name), F.lit(number).cast(f.dataType))
        elif isinstance(f.dataType, T.StringType):
            cols[f.name] = F.coalesce(F.col(f.name), F.lit(text))
    return df.withColumns(cols)


def hash_unit(key: Column, seed: int = 0) -> Column:
    """Number in [0, 1) that depends on the key alone, not on the partitioning."""
    return F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(1 << 52)) / F.lit(float(1 << 52))


def split_by_hash(df: DataFrame, key: str, weights: list[float], seed: int = 0) -> list[DataFrame]:
    """Disjoint parts with about the given shares; the same key always lands in the same part."""
    total = float(sum(weights))
    u = hash_unit(F.col(key), seed)
    parts, low = [], 0.0
    for i, w in enumerate(weights):
        high = 1.0 if i == len(weights) - 1 else low + w / total
        parts.append(df.filter((u >= low) & (u < high)))
        low = high
    return parts


def sample_by_hash(df: DataFrame, key: str, rate: float, seed: int = 0) -> DataFrame:
    return df.filter(hash_unit(F.col(key), seed) < rate)


def split_by_key(df: DataFrame, held: DataFrame, on: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows whose key is not held out, and rows whose key is."""
    keys = held.select(*on).distinct()
    return df.join(keys, on, "left_anti"), df.join(keys, on, "left_semi")


def mean_by_key(df: DataFrame, keys: list[str], value: str, min_count: int = 0) -> DataFrame:
    return (
        df.groupBy(*keys)
        .agg(F.avg(value).alias("mean"), F.count(value).alias("n"))
        .filter(F.col("n") > min_count)
    )


def word_counts(df: DataFrame, pieces: Column) -> DataFrame:
    """Count of every word of an array column; empty pieces are dropped after the unfolding."""
    words = df.select(F.explode(pieces).alias("word")).filter(F.col("word") != "")
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def union_all(parts: list[DataFrame], allow_missing: bool = False) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), parts)


def missing_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """Missing and present values per column, long form."""
    one = df.agg(
        F.count(F.lit(1)).alias("_n"), *[F.count(F.col(c)).alias(c) for c in cols]
    )
    return one.unpivot(["_n"], cols, "name", "present").select(
        "name", (F.col("_n") - F.col("present")).alias("missing"), "present"
    )


def histogram(df: DataFrame, col: str, lo: float, hi: float, bins: int, by: list[str] | None = None):
    """Share of rows per equal-width bin, empty bins included; rows outside [lo, hi] count in the
    denominator only. `hi` itself falls in the last bin."""
    by = by or []
    spot = F.floor((F.col(col) - lo) / F.lit((hi - lo) / bins))
    spot = F.when(F.col(col) == hi, F.lit(bins - 1)).otherwise(spot)
    inside = F.col(col).between(lo, hi)
    counted = df.groupBy(*by, F.when(inside, spot).cast("bigint").alias("bin")).agg(
        F.count(F.lit(1)).alias("_n")
    )
    # one row per key with a fixed number of bin counts
    wide = counted.groupBy(*by).agg(
        F.sum("_n").alias("_total"),
        *[F.coalesce(F.sum(F.when(F.col("bin") == b, F.col("_n"))), F.lit(0)).alias(f"b{b}") for b in range(bins)],
    )
    return wide.unpivot([*by, "_total"], [f"b{b}" for b in range(bins)], "bin", "n").select(
        *by, F.substring("bin", 2, 9).cast("bigint").alias("bin"), (F.col("n") / F.col("_total")).alias("frac")
    )


def contingency(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.groupBy(a, b).agg(F.count(F.lit(1)).alias("n"))


def n_distinct(df: DataFrame, col: str, approx: bool = False) -> DataFrame:
    count = F.approx_count_distinct(col) if approx else F.count_distinct(F.col(col))
    return df.agg(count.alias("n"))

