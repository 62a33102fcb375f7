"""Comparing rows that share a key, in tiles of bounded size.

Rows meet under keys (a band of a signature, say). A key with few rows is one tile. The rows of a larger key are
dealt by hash over blocks of about `block` rows, and every two blocks are a tile of their own, so
that no task holds a key. Tiles are sorted next to each other, and a task reads them as one stream. Pairs are
made and judged inside a tile; what leaves it is one row per row of the tile that has partners, never one row per pair.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored
from .common import spans, whole_groups

#: pairs judged at a time
PAIRS = 1 << 15


def tiled(members: DataFrame, block: int) -> DataFrame:
    """`members` (key, node, ...) under `tile`, with `side` 0 or 1 and `single` (both sides are one block).

    Keys with one row are left out.
    """
    sizes = stored(members.groupBy("key").count().filter("count > 1").select(F.col("key").alias("k"), F.col("count").alias("n")), "sizes")
    rows = members.join(sizes, F.col("key") == F.col("k")).withColumn("blocks", F.ceil(F.col("n") / block).cast("int"))
    rows = rows.withColumn("own", F.pmod(F.xxhash64("node", "key"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    low, high = F.least("own", "other"), F.greatest("own", "other")
    return rows.withColumns(
        {"tile": F.xxhash64("key", low, high), "side": (F.col("own") > F.col("other")).cast("int"), "single": F.col("own") == F.col("other")}
    ).drop("k", "n", "blocks", "own", "other")


def together(rows: DataFrame) -> DataFrame:
    """Rows of a tile in one task, next to each other."""
    return rows.repartition("tile").sortWithinPartitions("tile")


def _pairs(frame: pd.DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of all pairs inside the tiles of a frame, about `PAIRS` at a time."""
    side, single = frame["side"].to_numpy(), frame["single"].to_numpy()
    starts, ends = spans(frame["tile"].to_numpy())
    size = ends - starts
    two = (size == 2) & (single[starts] | (side[starts] != side[np.minimum(starts + 1, len(side) - 1)]))
    for k in range(0, int(two.sum()), PAIRS):
        at = starts[two][k : k + PAIRS]
        yield at, at + 1
    held: list[tuple[np.ndarray, np.ndarray]] = []
    n = 0
    for s, e in zip(starts[size > 2], ends[size > 2]):
        if single[s]:
            left = right = np.arange(s, e)
        else:
            left, right = s + np.flatnonzero(side[s:e] == 0), s + np.flatnonzero(side[s:e] == 1)
        step = max(1, PAIRS // max(len(right), 1))
        for k in range(0, len(left), step):
            a = np.repeat(left[k : k + step], len(right))
            b = np.tile(right, len(left[k : k + step]))
            if single[s]:
                a, b = a[a < b], b[a < b]
            held.append((a, b))
            n += len(a)
            if n >= PAIRS:
                yield np.concatenate([x for x, _ in held]), np.concatenate([y for _, y in held])
                held, n = [], 0
    if n:
        yield np.concatenate([x for x, _ in held]), np.concatenate([y for _, y in held])


def partners(rows: DataFrame, judge: Callable[[pd.DataFrame], Callable[[np.ndarray, np.ndarray], np.ndarray]]) -> DataFrame:
    """(tile, node, partners): the rows of each tile that are in a pair `judge` lets through.

    `judge(frame)` gives a function of two arrays of positions that says which pairs pass. A pair stands in the
    list of one of its rows.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in whole_groups(frames, lambda f: f["tile"].to_numpy()):
            passes = judge(frame)
            found = [(a[ok], b[ok]) for a, b in _pairs(frame) for ok in [passes(a, b)] if ok.any()]
            if not found:
                continue
            a, b = np.concatenate([x for x, _ in found]), np.concatenate([y for _, y in found])
            order = np.argsort(a, kind="stable")
            a, b = a[order], b[order]
            node, tile = frame["node"].to_numpy(), frame["tile"].to_numpy()
            starts, ends = spans(a)
            rest = np.setdiff1d(b, a)
            lists = [node[b[s:e]] for s, e in zip(starts, ends)] + [node[:0]] * len(rest)
            at = np.concatenate([a[starts], rest])
            yield pd.DataFrame({"tile": tile[at], "node": node[at], "partners": lists})

    return together(rows).mapInPandas(run, "tile long, node long, partners array<long>")


def listed(frame: pd.DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each tile of a frame with (tile, node, partners): its positions, and the listed pairs as positions."""
    tile, node, lists = frame["tile"].to_numpy(), frame["node"].to_numpy(), frame["partners"].to_numpy()
    for s, e in zip(*spans(tile)):
        order = s + np.argsort(node[s:e], kind="stable")
        times = [0 if p is None else len(p) for p in lists[s:e]]
        a = np.repeat(np.arange(s, e), times)
        wanted = np.concatenate([p for p in lists[s:e] if p is not None and len(p)]) if len(a) else np.empty(0, np.int64)
        yield np.arange(s, e), a, order[np.searchsorted(node[order], wanted)] if len(a) else a
