"""Named queries with the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .views import Tables, with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def query(name: str, check: str | None = None):
    """Register `fn(tables) -> DataFrame` under `name`, with an optional check text."""

    def wrap(fn: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(Tables(spark, sf_dir))

        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        run.__name__ = name
        QUERIES[name] = run
        if check is not None:
            CHECKS[name] = with_views(check)
        return fn

    return wrap
