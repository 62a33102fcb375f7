"""Files in, files out."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line, column `value`."""
    return spark.read.text(path)


def from_rows(spark: SparkSession, rows: list, schema: StructType | list[str] | str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def read_delimited(spark, path, schema=None, sep=",", header=True, infer=False, **options) -> DataFrame:
    """Delimited text; pass a schema wherever it is known, inference costs a second read."""
    reader = spark.read.option("header", header).option("sep", sep).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    elif infer:
        reader = reader.option("inferSchema", True)
    return reader.csv(path)


def cast_columns(df: DataFrame, names: list[str], kinds: list[str]) -> DataFrame:
    """Name and cast the columns of a file without header; a bad value becomes null."""
    named = df.toDF(*names)
    return named.select(*[F.col(n).try_cast(k).alias(n) for n, k in zip(names, kinds)])


def read_json(spark, path, schema=None, multi_line=False) -> DataFrame:
    reader = spark.read.option("multiLine", multi_line)
    return (reader.schema(schema) if schema is not None else reader).json(path)


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists", partition_by: list[str] | None = None):
    writer = df.write.mode(mode)
    if partition_by:
        # only the partitions present in `df` are replaced by an overwrite
        writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def write_by_day(df: DataFrame, path: str, ts: str, mode: str = "append") -> None:
    """One folder per event day."""
    write_parquet(df.withColumn("day", F.to_date(F.col(ts))), path, mode, ["day"])


def append_one_file(df: DataFrame, path: str) -> None:
    """Append a small batch as a single file; meant for micro-batches, not for whole tables."""
    df.coalesce(1).write.mode("append").parquet(path)


def upsert(target: DataFrame, updates: DataFrame, key: list[str], version: str) -> DataFrame:
    """Rows of both sides, highest version per key; new keys are inserted.

    One aggregate over the union: hot keys combine before the shuffle.
    """
    both = target.unionByName(updates)
    rest = [c for c in target.columns if c not in key]
    best = F.max_by(F.struct(*rest), F.col(version)).alias("_row")
    return both.groupBy(*key).agg(best).select(*key, *[F.col(f"_row.{c}").alias(c) for c in rest])


def scene_catalog(paths: DataFrame, col: str = "path") -> DataFrame:
    """Scene, band and path of two-part `.jp2` images inside `.SAFE` folders."""
    parts = F.split(F.col(col), "/")
    file, scene = F.element_at(parts, -1), F.element_at(parts, -2)
    stem = F.split(file, r"\.")
    kept = F.col(col).contains(".SAFE/") & (F.size(stem) == 2) & (F.element_at(stem, -1) == "jp2")
    return paths.filter(kept & (F.size(parts) >= 2)).select(
        scene.alias("scene"), F.element_at(F.split(F.get(stem, F.lit(0)), "_"), -1).alias("band"), F.col(col).alias("path")
    )


def list_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Paths below a folder; file contents are not read because only `path` is selected."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", glob)
    return reader.option("recursiveFileLookup", True).load(path).select("path")


def in_list(col: Column, values: list) -> Column:
    return col.isin(values)


def any_of(tests: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, tests)
