"""Exact duplicates against immutable snapshots.

Two texts are equal when they are identical after every ASCII white space character is deleted. A snapshot
is written once and never changed. It holds the digests it has seen, dealt over buckets by a hash, with the
row that stands for each, and one static binary fuse filter per bucket (8-bit fingerprints, about 9 bits a
digest). An incoming batch is first reduced to its distinct digests. These are screened bucket by bucket:
what the filter refuses is new for certain; what it lets pass joins the exact bucket. Digests that are new
are grouped among themselves and become the next snapshot. Snapshots are folders that later runs open.

Digests are SHA-256. Still, rows that meet under one digest have their bytes compared with the text of the
row that stands for it; rows that differ form classes of their own.

Of equal texts the row with the most code points in the original text stays, then the smallest id.

Odd cases: a null text is empty, so null, empty and all-blank texts are one group; a null id is larger than
any other. Rows that repeat the id and the text of the row that stays are all marked as kept; `keep_one`
leaves one of them. A very long text is one row like others. An empty table gives an empty result. Only the named columns are
read; `keep_one` carries the others along under any names.

Scale: groups are pre-aggregated before each shuffle. Buckets hold about `BUCKET` distinct digests
each, as digests spread evenly; a digest shared by a third of all rows is one entry of one bucket. The
whole texts move once, only in the byte check.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import fresh_path, stored
from .common import carried, text_of

#: distinct digests of a bucket: bounds what one task takes at a time
BUCKET = 2048

_M = np.uint64(0xFF51AFD7ED558CCD)
_N = np.uint64(0xC4CEB9FE1A85EC53)


def _mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    h = keys + np.uint64(seed * 0x9E3779B97F4A7C15 % (1 << 64))
    h ^= h >> np.uint64(33)
    h *= _M
    h ^= h >> np.uint64(33)
    h *= _N
    return h ^ (h >> np.uint64(33))


def _places(keys: np.ndarray, seed: int, segment: int, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """The three slots of each key, in three consecutive segments, and its fingerprint."""
    h = _mixed(keys, seed)
    first = ((h >> np.uint64(32)) * np.uint64(segments)) >> np.uint64(32)
    mask = np.uint64(segment - 1)
    h2 = _mixed(h, seed + 1)
    slots = np.stack(
        [
            first * np.uint64(segment) + (h2 & mask),
            (first + np.uint64(1)) * np.uint64(segment) + ((h2 >> np.uint64(20)) & mask),
            (first + np.uint64(2)) * np.uint64(segment) + ((h2 >> np.uint64(40)) & mask),
        ]
    ).astype(np.int64)
    return slots, (h & np.uint64(0xFF)).astype(np.uint8)


def build_filter(keys: np.ndarray) -> tuple[int, int, int, bytes]:
    """Binary fuse filter of distinct 64-bit keys: seed, segment length, number of segments, fingerprints."""
    keys = np.unique(keys.astype(np.uint64))
    n = max(len(keys), 1)
    segment = 1 << max(2, min(18, int(np.floor(np.log(n) / np.log(3.33) + 2.25))))
    room = int(n * max(1.125, 0.875 + 0.25 * np.log(1e6) / np.log(max(n, 3)))) + 8
    segments = max(1, -(-room // segment) - 2)
    for seed in range(1, 1 << 16):
        if seed % 32 == 0:
            segments += max(1, segments // 16)  # small sets can need more room
        slots, prints = _places(keys, seed, segment, segments)
        size = (segments + 2) * segment
        degree = np.bincount(slots.ravel(), minlength=size)
        held = np.zeros(size, np.int64)  # xor of the keys' numbers in each slot
        number = np.arange(len(keys))
        for row in slots:
            np.bitwise_xor.at(held, row, number)
        layers, left = [], len(keys)
        ready = np.flatnonzero(degree == 1)
        while len(ready):
            ready = ready[degree[ready] == 1]
            key, pick = np.unique(held[ready], return_index=True)
            if not len(key):
                break
            layers.append((key, ready[pick]))
            left -= len(key)
            touched = slots[:, key]
            for row in touched:
                np.subtract.at(degree, row, 1)
                np.bitwise_xor.at(held, row, key)
            ready = np.unique(touched.ravel())
            ready = ready[degree[ready] == 1]
        if left == 0:
            table = np.zeros(size, np.uint8)
            for key, slot in reversed(layers):  # a slot of a later layer is settled first
                table[slot] = 0
                a, b, c = slots[:, key]
                table[slot] = prints[key] ^ table[a] ^ table[b] ^ table[c]
            return seed, segment, segments, table.tobytes()
    raise ValueError("no filter found")


def may_hold(keys: np.ndarray, seed: int, segment: int, segments: int, fingerprints: bytes) -> np.ndarray:
    """False where a key is certainly not in the filter."""
    table = np.frombuffer(fingerprints, np.uint8)
    (a, b, c), prints = _places(keys.astype(np.uint64), seed, segment, segments)
    return (table[a] ^ table[b] ^ table[c]) == prints


def normal_text(text: Column) -> Column:
    return F.regexp_replace(text, "[\\x20\\x09-\\x0D]+", "")


def entries_of(batch: DataFrame) -> DataFrame:
    """(digest, rows, best, key): one row per distinct digest of (id, digest, n_chars), its screening key and the row that stays."""
    best = F.max(F.struct(F.col("n_chars"), F.coalesce(F.bitwise_not("id"), F.lit(-(1 << 63))).alias("minus"), F.col("id")))
    groups = batch.groupBy("digest").agg(F.count(F.lit(1)).alias("rows"), best.alias("best"))
    return groups.withColumn("key", F.xxhash64("digest"))


def _in_buckets(entries: DataFrame, buckets: int) -> DataFrame:
    return entries.withColumn("bucket", F.pmod(F.xxhash64(F.lit(1), "digest"), F.lit(buckets)).cast("int"))


def _filters(entries: DataFrame) -> DataFrame:
    def build(frame: pd.DataFrame) -> pd.DataFrame:
        seed, segment, segments, table = build_filter(frame["key"].to_numpy().astype(np.uint64))
        return pd.DataFrame({"bucket": frame["bucket"].iloc[:1], "seed": seed, "segment": segment, "segments": segments, "prints": [table]})

    return entries.select("bucket", "key").groupBy("bucket").applyInPandas(
        build, "bucket int, seed int, segment int, segments int, prints binary"
    )


class Snapshot:
    """An immutable set of digests under `path`: exact buckets in `entries`, a filter per bucket in `filters`."""

    def __init__(self, spark: SparkSession, path: str):
        self.path, self.entries = path, spark.read.parquet(f"{path}/entries")
        self.filters = spark.read.parquet(f"{path}/filters")
        self.buckets = spark.read.parquet(f"{path}/size").first()["buckets"]


def write_snapshot(entries: DataFrame, path: str) -> Snapshot:
    """Freeze `entries` (of `entries_of`) under `path`, which must not exist; any later run opens it with `Snapshot`."""
    spark = entries.sparkSession
    buckets = max(1, -(-entries.count() // BUCKET))
    _in_buckets(entries, buckets).repartition("bucket").write.parquet(f"{path}/entries")
    _filters(spark.read.parquet(f"{path}/entries")).write.parquet(f"{path}/filters")
    spark.range(1).select(F.lit(buckets).alias("buckets")).write.parquet(f"{path}/size")  # last: marks the snapshot as whole
    return Snapshot(spark, path)


def screen(entries: DataFrame, snapshot: Snapshot) -> DataFrame:
    """(digest, maybe) of `entries`: false where the snapshot certainly lacks the digest."""

    def look(keys: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        maybe = np.zeros(len(keys), bool)
        for f in held.itertuples():
            maybe |= may_hold(keys["key"].to_numpy().astype(np.uint64), f.seed, f.segment, f.segments, f.prints)
        return pd.DataFrame({"digest": keys["digest"], "maybe": maybe})

    left = _in_buckets(entries.select("digest", "key"), snapshot.buckets).groupBy("bucket")
    return left.cogroup(snapshot.filters.groupBy("bucket")).applyInPandas(look, "digest string, maybe boolean")


def known(entries: DataFrame, snapshot: Snapshot) -> DataFrame:
    """(digest): the digests of `entries` that the snapshot holds. The filter screens, the exact bucket decides."""
    maybe = screen(entries, snapshot).filter("maybe").select("digest")
    return stored(maybe.join(snapshot.entries.select("digest"), "digest"), "known")


def keyed_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", batches: int = 1) -> DataFrame:
    """(id, digest, n_chars, batch) of every row; the batch is a hash of the id."""
    text = text_of(text_col)
    return docs.select(
        F.col(id_col).cast("long").alias("id"),
        F.sha2(normal_text(text), 256).alias("digest"),
        F.char_length(text).cast("long").alias("n_chars"),
        F.pmod(F.xxhash64(F.lit(9), F.col(id_col).cast("long")), F.lit(batches)).cast("int").alias("batch"),
    )


def duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", batches: int = 2) -> DataFrame:
    """(id, digest, keep_id, group_size, kept) for every row.

    The rows arrive as `batches` batches (by a hash of the id); each batch but the last is frozen
    as a snapshot once it has been compared with the snapshots before it.
    """
    keyed = stored(keyed_rows(docs, id_col, text_col, batches), "keyed")
    snapshots: list[Snapshot] = []
    states, shared = [], []
    for number in range(batches):
        fresh = entries_of(keyed.filter(F.col("batch") == number))
        fresh = stored(fresh, "entries") if number else fresh
        new = fresh
        for snapshot in snapshots:
            held = known(fresh, snapshot)
            shared.append(held)
            new = new.join(held, "digest", "left_anti")
        if snapshots:
            states.append(fresh.join(reduce(DataFrame.unionByName, shared[-len(snapshots) :]), "digest", "left_semi"))
        if number < batches - 1:
            snapshots.append(write_snapshot(stored(new, "new"), fresh_path(docs.sparkSession, "snapshot")))
            states.append(snapshots[-1].entries)
        else:
            states.append(new)
    groups = reduce(DataFrame.unionByName, [s.select("digest", "rows", "best") for s in states])
    groups = stored(groups.groupBy("digest").agg(F.sum("rows").alias("rows"), F.max("best").alias("best")), "groups")
    checked = _byte_check(docs, id_col, text_col, keyed, groups)
    return _answer(keyed, groups, checked)


def arrivals(docs: DataFrame, snapshots: list[Snapshot], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(digest, rows, best, key): the distinct digests of a new batch that no snapshot holds, grouped among themselves.

    Written as the next snapshot with `write_snapshot`, they let the batch after it be screened in turn.
    """
    fresh = stored(entries_of(keyed_rows(docs, id_col, text_col)), "entries")
    return reduce(lambda left, snapshot: left.join(known(fresh, snapshot), "digest", "left_anti"), snapshots, fresh)


def _byte_check(docs: DataFrame, id_col: str, text_col: str, keyed: DataFrame, groups: DataFrame) -> DataFrame:
    """(id, digest, other) of rows whose bytes differ from the text that stands for their digest."""
    several = groups.filter("rows > 1").select("digest", F.col("best.id").alias("stands"))
    members = keyed.select("id", "digest", "n_chars").join(several, "digest")
    texts = docs.select(F.col(id_col).cast("long").alias("tid"), normal_text(text_of(text_col)).alias("text"))
    rows = members.hint("merge").join(texts, members["id"].eqNullSafe(texts["tid"])).filter(F.sha2("text", 256) == F.col("digest"))
    rows = stored(rows.select("id", "digest", "text", "n_chars", F.col("id").eqNullSafe(F.col("stands")).alias("is_base")), "same")
    base = stored(rows.filter("is_base").select("digest", F.col("text").alias("base")).dropDuplicates(["digest"]), "bases")
    return rows.join(base, "digest").filter(F.col("text") != F.col("base")).select("id", "digest", "n_chars", F.col("text").alias("other"))


def _answer(keyed: DataFrame, groups: DataFrame, differing: DataFrame) -> DataFrame:
    """Every row with the group it belongs to."""
    differing = stored(differing, "differing")
    if differing.isEmpty():
        classes = groups.withColumn("other", F.lit(None).cast("string"))
        rows = keyed.withColumn("other", F.lit(None).cast("string"))
    else:  # two texts under one SHA-256: classes by digest and text
        named = keyed.join(differing.select(F.col("id").alias("oid"), F.col("digest").alias("od"), "other").distinct(),
                           F.col("id").eqNullSafe(F.col("oid")) & (F.col("digest") == F.col("od")), "left")
        rows = named.select("id", "digest", "n_chars", "other")
        best = F.max(F.struct(F.col("n_chars"), F.coalesce(F.bitwise_not("id"), F.lit(-(1 << 63))).alias("minus"), F.col("id")))
        classes = rows.groupBy("digest", "other").agg(F.count(F.lit(1)).alias("rows"), best.alias("best"))
    classes = classes.select(
        F.col("digest").alias("cd"), F.col("other").alias("co"), F.col("rows").alias("group_size"), F.col("best.id").alias("keep_id")
    )
    joined = rows.join(classes, (F.col("digest") == F.col("cd")) & F.col("other").eqNullSafe(F.col("co")))
    return joined.select("id", "digest", "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", batches: int = 2) -> DataFrame:
    """The rows of `docs` that stay: one of each group of equal texts."""
    found = duplicates(docs, id_col, text_col, batches)
    found = stored(found.select("id", "digest", "kept"), "found")
    marked = found.groupBy(F.col("id").alias("odd_id"), F.col("digest").alias("odd_digest")).agg(
        F.first("kept").alias("one_kept"), F.count(F.lit(1)).alias("times")
    )
    # nearly every row stays as it is, so only the exceptions are joined
    odd = stored(marked.filter("not one_kept or times > 1"), "odd")
    rows = carried(docs, own=F.col(id_col).cast("long"), own_digest=F.sha2(normal_text(text_of(text_col)), 256))
    same = F.col("own").eqNullSafe(F.col("odd_id")) & (F.col("own_digest") == F.col("odd_digest"))
    # the exceptions grow with the documents, so the join is planned alike at every size
    joined = rows.join(odd.hint("merge"), same, "left").filter("times is null or one_kept")
    if odd.filter("one_kept").isEmpty():
        return joined.select("carried.*")
    single = joined.filter("times is null").select("carried.*")
    again = joined.filter("times is not null").dropDuplicates(["odd_id", "odd_digest"]).select("carried.*")
    return single.unionByName(again)
