"""Full-text search over several fields, from a stored index.

`build_index` reads the texts once and writes one row per (term, field, row): how often the term occurs and
how long the field is, in folders by a hash of the term, as many as the bytes of the postings ask for. Beside it stand the rows per (term, field) and the
mean field lengths. A query reads only the folders of its own terms.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.text import strip_accents, tokens
from ..session import fresh_path

# Saturation and length weights of the published ranking formula.
K1, B = 1.2, 0.75
#: bytes of postings in a folder of the index, as written by Spark
FOLDER_BYTES = 32 << 20


def _words(col):
    return tokens(F.regexp_replace(F.lower(strip_accents(F.col(col))), r"[^a-z0-9]+", " "), " ")


def query_terms(text: str) -> list[str]:
    return sorted(set(text.lower().split()))


def _bucket(term: Column, folders: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(folders)).cast("int")


def _bytes(spark: SparkSession, path: str) -> int:
    """Bytes of the files under a path, whatever store it is in."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(at).getLength()


def build_index(df: DataFrame, id_col: str, fields: list[str], path: str, folder_bytes: int | None = None) -> None:
    """Write `postings`, `terms`, `fields` and `size` under `path`. Row ids must be unique.

    There is a folder for every `folder_bytes` of the counted postings, so what a query reads does not grow with the number of
    terms in the index. Postings of a folder are sorted by term; those of one term are dealt over several files.
    """
    spark = df.sparkSession
    words = df.select(F.col(id_col).alias("id"), *[F.coalesce(_words(f), F.array().cast("array<string>")).alias(f) for f in fields])
    long = words.select("id", F.inline(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("words")) for f in fields])))
    counted = long.select("id", "field", F.size("words").alias("len"), F.explode("words").alias("term"))
    once = fresh_path(spark, "postings")
    counted.groupBy("term", "field", "id", "len").agg(F.count(F.lit(1)).alias("tf")).write.parquet(once)
    postings = spark.read.parquet(once)
    folders = 1 << max(0, (_bytes(spark, once) // (folder_bytes or FOLDER_BYTES)).bit_length())
    placed = postings.withColumn("bucket", _bucket(F.col("term"), folders))
    dealt = placed.repartition("bucket", "term", F.pmod(F.xxhash64("id"), F.lit(64))).sortWithinPartitions("bucket", "term")
    dealt.write.partitionBy("bucket").parquet(f"{path}/postings")
    frequent = placed.groupBy("bucket", "term", "field").agg(F.count(F.lit(1)).alias("df"))
    frequent.repartition("bucket").sortWithinPartitions("bucket", "term").write.partitionBy("bucket").parquet(f"{path}/terms")
    long.groupBy("field").agg(F.count(F.lit(1)).alias("n"), F.avg(F.size("words")).alias("mean")).write.parquet(f"{path}/fields")
    spark.range(1).select(F.lit(folders).alias("folders")).write.parquet(f"{path}/size")


def _of_terms(spark: SparkSession, path: str, table: str, terms: list[str]) -> DataFrame:
    """Rows of the query's terms; the folders of other terms are not read."""
    folders = spark.read.parquet(f"{path}/size").first()["folders"]
    buckets = spark.range(1).select(F.array(*[_bucket(F.lit(t), folders) for t in terms])).first()[0]
    return spark.read.parquet(f"{path}/{table}").filter(F.col("bucket").isin(*set(buckets)) & F.col("term").isin(*terms))


def matching(spark: SparkSession, path: str, query: str) -> DataFrame:
    """Ids of rows with any query term in any field; the query is an argument, never pasted into a text."""
    return _of_terms(spark, path, "postings", query_terms(query)).select("id").distinct()


def search(spark: SparkSession, path: str, query: str, k: int) -> DataFrame:
    """Top k rows by the sum over fields of the term scores.

    A fixed number of scalars (rows, mean lengths, document frequencies of the query's terms) makes the weights;
    the postings of the terms are then scored one by one and summed per row.
    """
    terms = query_terms(query)
    facts = {r["field"]: r for r in spark.read.parquet(f"{path}/fields").collect()}
    weights = []
    for r in _of_terms(spark, path, "terms", terms).collect():
        n = facts[r["field"]]["n"]
        weight = F.log(F.lit(1 + (n - r["df"] + 0.5) / (r["df"] + 0.5)))
        length = 1 - B + B * F.col("len") / F.lit(facts[r["field"]]["mean"])
        score = weight * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * length)
        weights.append(((F.col("term") == r["term"]) & (F.col("field") == r["field"]), score))
    found = _of_terms(spark, path, "postings", terms)
    score = reduce(lambda rest, w: F.when(w[0], w[1]).otherwise(rest), weights, F.lit(0.0))
    ranked = found.groupBy("id").agg(F.sum(score).alias("score"))
    return ranked.orderBy(F.round("score", 9).desc(), "id").limit(k)
