"""From raw documents to token ids, in stages that are each written and read again.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that works on all its predecessor kept. All but the
last return the columns of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkdeck.llm import bpe, exact, language, mixing, near
from sparkdeck.llm.common import prepare
from sparkdeck.llm.queries import tokenizer_path
from sparkdeck.session import fresh_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; texts without letters go."""
    prepare(spark)
    return language.keep_known(docs).select(*COLUMNS)


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    prepare(spark)
    return exact.keep_one(docs).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    prepare(spark)
    return near.keep_one(docs).select(*COLUMNS)


def target_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    prepare(spark)
    return mixing.mixed(docs).select(*COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, source, n_tokens, ids, decodes) of every row; `decodes` says whether the ids give back the text."""
    prepare(spark)
    tokenizer = bpe.read_file(tokenizer_path())
    found = docs.select("doc_id", "source", F.coalesce("text", F.lit("")).alias("text"), bpe.round_trip(F.col("text"), tokenizer).alias("found"))
    return found.select(
        "doc_id", "source", F.size("found.ids").cast("long").alias("n_tokens"), "found.ids", (F.col("found.text") == F.col("text")).alias("decodes")
    )


STAGES = [
    ("language", known_language),
    ("exact_dedup", exact_duplicates),
    ("near_dedup", near_duplicates),
    ("mix", target_mix),
    ("tokens", tokens),
]

#: the draws of the mix are hashes that SQL engines do not share; tests compare with a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on `documents`; what each returns is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = fresh_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
