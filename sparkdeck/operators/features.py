"""Feature columns for models."""

from __future__ import annotations

from pyspark.ml.feature import (
    CountVectorizerModel,
    HashingTF,
    IDF,
    PCA,
    IndexToString,
    OneHotEncoder,
    StandardScaler,
    StringIndexer,
    VectorAssembler,
    VectorIndexer,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F


def assemble(df: DataFrame, cols: list[str], out: str = "features", invalid: str = "error") -> DataFrame:
    return VectorAssembler(inputCols=cols, outputCol=out, handleInvalid=invalid).transform(df)


def index_labels(df: DataFrame, col: str, out: str = "label"):
    """Alphabetical label index and its model."""
    model = StringIndexer(inputCol=col, outputCol=out, stringOrderType="alphabetAsc").fit(df)
    return model, model.transform(df)


def label_names(df: DataFrame, col: str, labels: list[str], out: str) -> DataFrame:
    return IndexToString(inputCol=col, outputCol=out, labels=labels).transform(df)


def index_categories(df: DataFrame, features: str, out: str, max_categories: int = 4):
    model = VectorIndexer(inputCol=features, outputCol=out, maxCategories=max_categories).fit(df)
    return model, model.transform(df)


def bag_of_words(df: DataFrame, tokens: str, vocabulary: list[str], out: str = "bag", binary: bool = False):
    """Counts (or 0/1) of a fixed vocabulary, in alphabetical order."""
    model = CountVectorizerModel.from_vocabulary(sorted(vocabulary), inputCol=tokens, outputCol=out)
    return model.setBinary(binary).transform(df)


def hashed_counts(df: DataFrame, tokens: str, size: int = 1 << 20, out: str = "tf") -> DataFrame:
    return HashingTF(inputCol=tokens, outputCol=out, numFeatures=size).transform(df)


def hashed_tf_idf(train: DataFrame, tokens: str, size: int = 10_000, out: str = "features"):
    """IDF model fitted on the training rows; apply `weigh` to training and test rows alike."""
    tf = hashed_counts(train, tokens, size, "_tf")
    return IDF(inputCol="_tf", outputCol=out).fit(tf)


def weigh(df: DataFrame, tokens: str, model, size: int = 10_000) -> DataFrame:
    return model.transform(hashed_counts(df, tokens, size, "_tf")).drop("_tf")


def total(vector: str) -> Column:
    """Sum of a vector's entries; only those that a sparse one holds are visited."""
    return F.aggregate(F.unwrap_udt(F.col(vector))["values"], F.lit(0.0), lambda s, x: s + x)


def one_hot(df: DataFrame, col: str, out: str):
    """One indicator per index value, none left out."""
    model = OneHotEncoder(inputCol=col, outputCol=out, dropLast=False).fit(df)
    return model, model.transform(df)


def long_form(df: DataFrame, id_col: str, vector: str, names: list[str] | None = None) -> DataFrame:
    """(id, position or name, value) from a vector column."""
    cells = df.select(id_col, F.posexplode(vector_to_array(vector)).alias("pos", "value"))
    if names is None:
        return cells
    return cells.withColumn("name", F.get(F.array(*[F.lit(n) for n in names]), F.col("pos"))).drop("pos")


def pca(df: DataFrame, cols: list[str], k: int = 3, out: str = "components"):
    """Principal components of standardised columns."""
    vectors = assemble(df, cols, "_raw")
    scaler = StandardScaler(inputCol="_raw", outputCol="_scaled", withMean=True, withStd=True).fit(vectors)
    scaled = scaler.transform(vectors)
    model = PCA(k=k, inputCol="_scaled", outputCol=out).fit(scaled)
    return model, model.transform(scaled).drop("_raw", "_scaled")


def missing_marker(col: Column, marker: float = -2.0) -> Column:
    return F.coalesce(col, F.lit(marker))


def encode_tokens(df: DataFrame, id_col: str, tokens: str, dictionary: DataFrame, offset: int = 3) -> DataFrame:
    """Token arrays to index arrays; unknown words take the index 2."""
    words = df.select(id_col, F.posexplode(tokens).alias("_pos", "word"))
    known = words.join(dictionary.select("word", "idx"), "word", "left")
    index = F.coalesce(F.col("idx") + offset, F.lit(2)).cast("bigint")
    ordered = F.array_sort(F.collect_list(F.struct("_pos", index.alias("i"))))
    return known.groupBy(id_col).agg(F.transform(ordered, lambda s: s["i"]).alias("ids"))


def decode_tokens(df: DataFrame, id_col: str, ids: str, dictionary: DataFrame, offset: int = 3) -> DataFrame:
    """Index arrays to text; `?` for an index without a word. A group is one document."""
    codes = df.select(id_col, F.posexplode(ids).alias("_pos", "_code")).withColumn("idx", F.col("_code") - offset)
    named = codes.join(dictionary.select("idx", "word"), "idx", "left")
    ordered = F.array_sort(F.collect_list(F.struct("_pos", F.coalesce("word", F.lit("?")).alias("w"))))
    return named.groupBy(id_col).agg(F.array_join(F.transform(ordered, lambda s: s["w"]), " ").alias("text"))
