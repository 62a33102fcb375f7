"""Repeated lines by probing a sharded minimal perfect hash.

Lines are compared by key: ASCII white space stripped at both ends, A-Z in lower case. A key of at least
`least_chars` code points found in at least `least_docs` documents is repeated; its lines stay only in the
document with the largest id that holds it. Other lines stay as they are, joined by \\n.

Each key is known by two 64-bit halves of a 128-bit hash. Counting is one aggregate (documents per key and
largest id, combined in the map tasks). All distinct keys are dealt over shards by hash, and each shard becomes a minimal
perfect hash (levels of bit arrays: a key is placed at the first level where it lands alone) that numbers
its keys without gaps, beside arrays at those numbers: 64-bit fingerprint, count, largest id. Documents
send their keys to the shards and probe the arrays, whose counts decide; keys are never joined with lines. The fingerprint is
the second half of the hash, the place depends on both, so a key that is not in the index is refused but for a
chance of 2^-64.

A line that a third of all documents hold sends as many probes to one shard; probes are therefore dealt over copies of a
shard, as many as its counted probes need. Drops are then collected per document and joined with the texts by id.

Odd cases: a null or empty text is one empty line. Rows that repeat an id count as several documents and
lose the same lines. A null id is smaller than any other. A very long text is split in one task, its lines one at a time. An empty table gives an empty result. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored

#: distinct keys of a shard, probes that one copy of a shard takes
SHARD, PROBES = 8192, 1 << 15
_BLANKS = b" \t\n\x0b\x0c\r"
_LOWEST = -(1 << 63)


def key_of(line: bytes, least_chars: int) -> int | None:
    """128-bit hash of a line's key, None if the key is too short."""
    key = line.strip(_BLANKS)
    if len(key) < least_chars or (len(key) < 4 * least_chars and not key.isascii() and len(key.decode()) < least_chars):
        return None
    return xxhash.xxh3_128_intdigest(key.lower())


def _halves(value: int) -> tuple[int, int]:
    high, low = value >> 64, value & 0xFFFFFFFFFFFFFFFF
    return high - (high >> 63 << 64), low - (low >> 63 << 64)


def _mixed(high: np.ndarray, low: np.ndarray, level: int) -> np.ndarray:
    h = high ^ (low * np.uint64(0x9E3779B97F4A7C15)) ^ np.uint64((level + 1) * 0xD6E8FEB86659FD93 % (1 << 64))
    for _ in range(2):
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def build_index(high: np.ndarray, low: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """Levels of bits of a minimal perfect hash for distinct keys, and the number of each key."""
    high, low = high.astype(np.uint64), low.astype(np.uint64)
    numbers, left, levels, used = np.zeros(len(high), np.int64), np.arange(len(high)), [], 0
    while len(left):
        size = 2 * len(left) + 8
        slot = (_mixed(high[left], low[left], len(levels)) % np.uint64(size)).astype(np.int64)
        alone = np.bincount(slot, minlength=size) == 1
        placed = alone[slot]
        numbers[left[placed]] = used + (np.cumsum(alone) - 1)[slot[placed]]
        levels.append(alone)
        used += int(alone.sum())
        left = left[~placed]
        if len(levels) > 200:
            raise ValueError("keys are not distinct")
    return [np.packbits(a).tobytes() + len(a).to_bytes(8, "little") for a in levels], numbers


def number_of(levels: list[bytes], high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """The number of each key, -1 where no level has a place; other keys get some number."""
    high, low = high.astype(np.uint64), low.astype(np.uint64)
    numbers, left, used = np.full(len(high), -1, np.int64), np.arange(len(high)), 0
    for k, packed in enumerate(levels):
        size = int.from_bytes(packed[-8:], "little")
        alone = np.unpackbits(np.frombuffer(packed[:-8], np.uint8), count=size).astype(bool)
        slot = (_mixed(high[left], low[left], k) % np.uint64(size)).astype(np.int64)
        placed = alone[slot]
        numbers[left[placed]] = used + (np.cumsum(alone) - 1)[slot[placed]]
        used += int(alone.sum())
        left = left[~placed]
    return numbers


def _keys(least_chars: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            ids, marks, keys = [], [], []
            for doc, mark, text in zip(frame["id"], frame["mark"], frame["text"]):
                own = {key_of(line, least_chars) for line in (text or "").encode().split(b"\n")} - {None}
                ids += [doc] * len(own)
                marks += [mark] * len(own)
                keys += own
            halves = np.array([_halves(k) for k in keys], np.int64).reshape(-1, 2)
            yield pd.DataFrame({"id": np.array(ids, np.int64), "mark": np.array(marks, np.int64), "high": halves[:, 0], "low": halves[:, 1]})

    return run


def _build(frame: pd.DataFrame) -> pd.DataFrame:
    levels, numbers = build_index(frame["high"].to_numpy(), frame["low"].to_numpy())
    order = np.argsort(numbers)
    arrays = {c: frame[c].to_numpy(np.int64)[order].tobytes() for c in ("low", "docs", "last")}
    return pd.DataFrame({"shard": frame["shard"].iloc[:1], "levels": [levels], **{c: [b] for c, b in arrays.items()}})


def _probe(least_docs: int):
    def run(asked: pd.DataFrame, index: pd.DataFrame) -> pd.DataFrame:
        out = [asked.iloc[:0]]
        for shard in index.itertuples():
            prints, docs, last = (np.frombuffer(b, np.int64) for b in (shard.low, shard.docs, shard.last))
            number = number_of(list(shard.levels), asked["high"].to_numpy(), asked["low"].to_numpy())
            known = (number >= 0) & (prints[number] == asked["low"].to_numpy())
            out.append(asked[known & (docs[number] >= least_docs) & (last[number] != asked["id"].to_numpy())])
        return pd.concat(out)[["id", "mark", "high", "low"]]

    return run


def distinct_keys(keys: DataFrame) -> DataFrame:
    """(high, low, docs, last) of each distinct key: how many documents hold it and the largest id among them."""
    return keys.groupBy("high", "low").agg(F.count(F.lit(1)).alias("docs"), F.max("id").alias("last"))


def drops(keys: DataFrame, least_docs: int) -> DataFrame:
    """(id, mark, high, low): the keys whose lines a document loses, for distinct (high, low) of each row's (id, mark)."""
    found = stored(distinct_keys(keys), "distinct")
    shards = max(1, -(-found.count() // SHARD))
    shard = F.pmod(F.xxhash64("high", "low"), F.lit(shards)).cast("int")
    index = stored(
        found.withColumn("shard", shard).groupBy("shard").applyInPandas(
            _build, "shard int, levels array<binary>, low binary, docs binary, last binary"
        ),
        "index",
    )
    asked = keys.withColumn("shard", shard)
    load = asked.groupBy("shard").count().select(F.col("shard").alias("s"), F.ceil(F.col("count") / PROBES).cast("int").alias("copies"))
    load = stored(load, "load")
    copies = index.join(load, index["shard"] == load["s"]).withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
    dealt = asked.join(load, asked["shard"] == load["s"])
    dealt = dealt.withColumn("copy", F.pmod(F.xxhash64(F.lit(7), "id", "high"), F.col("copies")).cast("int"))
    left = dealt.select("shard", "copy", "id", "mark", "high", "low").groupBy("shard", "copy")
    right = copies.select("shard", "copy", "levels", "low", "docs", "last").groupBy("shard", "copy")
    return left.cogroup(right).applyInPandas(_probe(least_docs), "id long, mark long, high long, low long")


def _cut(least_chars: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            kept, lines, dropped = [], [], []
            for text, gone in zip(frame["text"], frame["gone"]):
                parts = (text or "").split("\n")
                lines.append(len(parts))
                if gone is None or not len(gone):
                    kept.append(text or "")
                else:
                    lost = {(g["high"], g["low"]) for g in gone}
                    keys = [key_of(p.encode(), least_chars) for p in parts]
                    parts = [p for p, k in zip(parts, keys) if k is None or _halves(k) not in lost]
                    kept.append("\n".join(parts))
                dropped.append(lines[-1] - len(parts))
            yield pd.DataFrame({"id": frame["id"], "n_lines": lines, "n_dropped": dropped, "kept_text": kept})

    return run


def drop_repeated(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_chars: int = 40, least_docs: int = 5
) -> DataFrame:
    """(id, n_lines, n_dropped, kept_text) for every row."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    # many rows may have one id, or none: what a row loses is found by its id and a hash of its text
    named = rows.select(F.coalesce("id", F.lit(_LOWEST)).alias("id"), "text", F.xxhash64("text").alias("mark"))
    keys = stored(named.mapInPandas(_keys(least_chars), "id long, mark long, high long, low long"), "keys")
    gone = drops(keys, least_docs).groupBy(F.col("id").alias("gid"), F.col("mark").alias("of"))
    gone = stored(gone.agg(F.collect_set(F.struct("high", "low")).alias("gone")), "gone")
    # the list of drops grows with the documents, so the join is planned alike at every size
    same = (F.col("id") == F.col("gid")) & (F.col("mark") == F.col("of"))
    joined = named.join(gone.hint("merge"), same, "left").select("id", "text", "gone")
    cut = joined.mapInPandas(_cut(least_chars), "id long, n_lines long, n_dropped long, kept_text string")
    return cut.withColumn("id", F.nullif("id", F.lit(_LOWEST)))
