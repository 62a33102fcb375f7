"""Session settings and the folder for written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a skewed join stays split even when an aggregate above it could have reused its partitioning
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # joins whose measured build partitions are at most this large skip the sort
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}

_local_roots: dict[str, str] = {}
_written: list[str] = []


def session(app: str = "sparkdeck", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings the operators are tuned for; `extra` keys use `__` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def workspace(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables: `spark.checkpoint.dir` of the session.

    Only a local master may fall back to a temporary folder; on a cluster the setting is required.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    if context.applicationId not in _local_roots:
        _local_roots[context.applicationId] = tempfile.mkdtemp(prefix="sparkdeck-")
    return _local_roots[context.applicationId]


def fresh_path(spark: SparkSession, name: str) -> str:
    """A folder of its own below the workspace, deleted by `scratch` or `clean`."""
    path = f"{workspace(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    _written.append(path)
    return path


def clean(spark: SparkSession, since: int = 0) -> None:
    """Delete what `fresh_path` and `stored` have given out, from number `since` on."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    while len(_written) > since:
        path = jvm.org.apache.hadoop.fs.Path(_written.pop())
        path.getFileSystem(conf).delete(path, True)


@contextmanager
def scratch(spark: SparkSession):
    """Own the intermediate tables of a block: they are deleted when it ends.

    A result is lazy, so write or collect it inside the block.
    """
    mark = len(_written)
    try:
        yield
    finally:
        clean(spark, mark)


def stored(df: DataFrame, name: str = "stage", **options: str) -> DataFrame:
    """Write `df` to the shared folder and read it back: cuts lineage and survives lost executors."""
    path = fresh_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
