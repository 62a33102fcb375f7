"""Near duplicates by DartMinHash.

A document is a weighted set: its shingles of `SHINGLE` words (lower-case runs of ASCII letters, digits and
non-ASCII characters), each with the number of times it occurs. Similarity is weighted Jaccard: the sum of the smaller
weights over the sum of the larger ones. Documents of at least `THRESHOLD` are linked; a class is
what links connect.

Signature: every shingle owns, for each unit of weight, a region of a plane whose other axis is rank, and darts
hit the regions at random places that depend on the shingle alone (a Poisson process, thrown by hashing). A
document sees the darts in the regions its weights reach, up to the rank below which about K ln K + 2K
darts are expected; each dart belongs to one of K coordinates, and the earliest of each coordinate is kept. If a
coordinate gets none, the rank is doubled. Two documents share the dart of a coordinate with the
probability of their similarity. So a signature costs one hash per shingle and a few per dart, not K per
shingle. One byte of each dart is kept.

Joining: `BANDS` bands of `ROWS` coordinates; a pair at the threshold meets in none of them with a chance
of 5e-5. Documents with equal weighted sets are one node first. Pairs that meet are judged by the whole
signature (those four standard deviations below the threshold go), each in the first band it shares only. What is
left is compared exactly, on the weighted sets, in the tile in which it met. No bucket is capped.

Large buckets: only classes are asked for, so documents that are linked already need no comparison. Every member of a bucket of
more than `BLOCK` is first compared with one member of it, its pivot; members linked with one pivot are one part. Then only what is
outside the largest part of a bucket is compared, with everything of other parts. A bucket of n near copies of its pivot so writes
rows in proportion to n. Texts that share a band and are not alike, or hang together in other ways, meet in tiles of every two blocks.

Odd cases: a text of fewer words than `SHINGLE` is one shingle; a text without words, or null, is in a class
of its own; a null id is smaller than any other. An id may stand on several texts: what is kept goes by id and
weighted set, so of a class with words the rows with the smallest id and one weighted set are marked as kept, and
`keep_one` leaves one of them. A very long text is hashed in pieces of `PIECE` bytes. An empty table gives an empty result. Only the named
columns are read; `keep_one` carries the others along under any names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.models.clustering import components
from ..session import stored
from .common import carried, whole_groups
from .tiles import listed, partners, tiled, together

SHINGLE, THRESHOLD = 5, 0.8
ROWS, BANDS = 5, 25
K = ROWS * BANDS
#: documents of a block of a large bucket
BLOCK = 256
#: share of equal coordinates below which a pair is not compared: the threshold less four standard deviations
LIKELY = THRESHOLD - 4 * (THRESHOLD * (1 - THRESHOLD) / K) ** 0.5
#: bytes of a text whose words are hashed at a time
PIECE = 1 << 20
_LOWEST = -(1 << 63)

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_WORD = np.array([b >= 128 or chr(b).isalnum() for b in range(256)])
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _power_tables(n: int) -> list[np.ndarray]:
    if len(_powers[0]) < n:
        for k, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(max(n, 4096), base, np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps, dtype=np.uint64)
    return _powers


def word_hashes(text: str) -> np.ndarray:
    """A 64-bit hash of each word, equal for equal words."""
    b = np.frombuffer(text.lower().encode(), np.uint8)
    inside = _WORD[b]
    edge = np.diff(np.r_[False, inside, False].astype(np.int8))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    out = np.empty(len(starts), np.uint64)
    k = 0
    while k < len(starts):  # a polynomial over the bytes of each word, from running sums
        stop = max(int(np.searchsorted(ends, starts[k] + PIECE, "right")), k + 1)
        s, e = starts[k:stop] - starts[k], ends[k:stop] - starts[k]
        power, inverse = _power_tables(int(e[-1]) + 1)
        piece = b[starts[k] : ends[stop - 1]].astype(np.uint64) + np.uint64(1)
        sums = np.r_[np.uint64(0), np.cumsum(piece * power[: len(piece)], dtype=np.uint64)]
        out[k:stop] = mix((sums[e] - sums[s]) * inverse[s] + (e - s).astype(np.uint64))
        k = stop
    return out


def elements(text: str | None) -> np.ndarray:
    """Hashes of the units of weight of a document's shingles, ascending: the weighted set as a plain set."""
    words = word_hashes(text) if text else np.empty(0, np.uint64)
    if not len(words):
        return words
    n = min(SHINGLE, len(words))
    shingles = np.full(len(words) - n + 1, n, np.uint64)
    for k in range(n):
        shingles = mix(shingles * np.uint64(0xD6E8FEB86659FD93) + words[k : len(words) - n + 1 + k])
    known, counts = np.unique(shingles, return_counts=True)
    layer = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    return np.sort(mix(np.repeat(known, counts) + layer.astype(np.uint64) * np.uint64(_BASE)))


def _exponential(h: np.ndarray) -> np.ndarray:
    return -np.log(((h >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53)


def signature(units: np.ndarray) -> bytes:
    """One byte of the earliest dart of each coordinate."""
    expected = K * np.log(K) + 2 * K
    while True:
        limit = expected / len(units)
        darts, ranks = [], []
        column, rank, number = units, np.zeros(len(units)), 0
        while len(column):  # the darts of a unit of weight come at ranks that grow by exponential steps
            number += 1
            dart = mix(column + np.uint64(number * 0xA24BAED4963EE407 % (1 << 64)))
            rank = rank + _exponential(dart)
            seen = rank <= limit
            column, rank = column[seen], rank[seen]
            darts.append(dart[seen])
            ranks.append(rank)
        dart, rank = mix(np.concatenate(darts)), np.concatenate(ranks)
        order = np.lexsort((dart, rank))
        where, first = np.unique((dart % np.uint64(K)).astype(np.int64)[order], return_index=True)
        if len(where) == K:
            return ((dart[order[first]] >> np.uint64(48)) & np.uint64(0xFF)).astype(np.uint8).tobytes()
        expected *= 2


def set_hash(units: np.ndarray) -> tuple[int, int]:
    """128 bits that depend on the set."""
    a = int(mix(units).sum(dtype=np.uint64))
    b = int(mix(units ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64))
    return a - (a >> 63 << 64), b - (b >> 63 << 64)


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard of two ascending arrays of units."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    both = int((b[np.minimum(at, len(b) - 1)] == a).sum())
    return both / (len(a) + len(b) - both)


def _sign(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        rows = []
        for text in frame["text"]:
            units = elements(text)
            rows.append((len(units), *set_hash(units), signature(units) if len(units) else None))
        out = pd.DataFrame(rows, columns=["n", "h1", "h2", "sig"])
        out.insert(0, "id", frame["id"].to_numpy())
        out.insert(1, "mark", frame["mark"].to_numpy())
        yield out


def _units(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        rows = []
        for node, h1, h2, text in zip(frame["node"], frame["h1"], frame["h2"], frame["text"]):
            units = elements(text)
            if set_hash(units) == (h1, h2):  # another text may have the same id and hash
                rows.append((node, units.tobytes()))
        yield pd.DataFrame(rows, columns=["node", "units"])


def _likely(frame: pd.DataFrame):
    """Judge of tiles: the signatures agree enough, this is the first band shared, and the rows are of two parts."""
    sig = np.frombuffer(b"".join(frame["sig"]), np.uint8).reshape(-1, K)
    band = frame["band"].to_numpy()
    part = frame["root"].to_numpy() if "root" in frame else None

    def passes(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        same = sig[a] == sig[b]
        first = same.reshape(-1, BANDS, ROWS).all(2).argmax(1)
        ok = (first == band[a]) & (same.mean(1) >= LIKELY)
        return ok if part is None else ok & (part[a] != part[b])

    return passes


def _likely_star(frame: pd.DataFrame):
    """Judge of star tiles, whose pairs are distinct whatever their band."""
    sig = np.frombuffer(b"".join(frame["sig"]), np.uint8).reshape(-1, K)
    return lambda a, b: (sig[a] == sig[b]).mean(1) >= LIKELY


def _verify(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(a, b): links of the tiles, without those inside what is linked already."""
    for frame in whole_groups(frames, lambda f: f["tile"].to_numpy()):
        node, raw = frame["node"].to_numpy(), frame["units"].to_numpy()
        links = []
        for at, left, right in listed(frame):
            units = [np.frombuffer(raw[k], np.uint64) for k in at]
            part = list(range(len(at)))

            def find(k: int) -> int:
                while part[k] != k:
                    part[k] = part[part[k]]
                    k = part[k]
                return k

            for a, b in zip((left - at[0]).tolist(), (right - at[0]).tolist()):
                x, y = find(a), find(b)
                if x != y and similarity(units[a], units[b]) >= THRESHOLD:
                    part[max(x, y)] = min(x, y)
                    links.append((node[at[a]], node[at[b]]))
        yield pd.DataFrame(links, columns=["a", "b"]).astype("int64")


def _verified(found: DataFrame, units: DataFrame) -> DataFrame:
    """Links (a, b) among the listed pairs of the tiles."""
    return stored(together(found.join(units, "node")).mapInPandas(_verify, "a long, b long").distinct(), "links")


def _ends(links: DataFrame) -> DataFrame:
    return links.select(F.col("a").alias("node")).unionByName(links.select(F.col("b").alias("node"))).distinct()


def _star_tiles(large: DataFrame) -> DataFrame:
    """Tiles of the pivot of each bucket with the other members."""
    draw = F.xxhash64(F.lit("pivot"), "node").alias("draw")
    pivots = large.groupBy(F.col("key").alias("k")).agg(F.min(F.struct(draw, "node"))["node"].alias("pivot"))
    met = large.join(pivots, F.col("key") == F.col("k")).filter(F.col("node") != F.col("pivot"))
    # buckets of several bands often have the same pivot
    rows = met.groupBy("node", "pivot").agg(F.ceil(F.max("of_key") / BLOCK).alias("blocks"))
    rows = rows.withColumn("tile", F.xxhash64(F.lit("star"), "pivot", "blocks", F.pmod(F.xxhash64("node"), F.col("blocks"))))
    # the pivot stands once in each tile
    ends = F.array(F.struct("node", F.lit(1).alias("side")), F.struct(F.col("pivot").alias("node"), F.lit(0).alias("side")))
    return rows.select("tile", F.inline(ends)).distinct().withColumn("single", F.lit(False))


def _with_parts(large: DataFrame, links: DataFrame) -> DataFrame:
    """(key, band, node, root, outside): members of large buckets, and whether they are outside its largest part.

    `links` are pairs of a pivot and a member; a part is a pivot with the members that take it as their own.
    """
    own = links.groupBy(F.col("b").alias("node")).agg(F.min(F.struct(F.xxhash64("a").alias("draw"), "a"))["a"].alias("pivot"))
    rows = large.join(own, "node", "left").select("key", "band", "node", F.coalesce("pivot", "node").alias("root"))
    rows = stored(rows, "parts")
    sizes = rows.groupBy("key", "root").count()
    main = sizes.groupBy(F.col("key").alias("k")).agg(F.max(F.struct("count", F.xxhash64("root").alias("h"), "root"))["root"].alias("main"))
    return rows.join(main, F.col("key") == F.col("k")).select("key", "band", "node", "root", (F.col("root") != F.col("main")).alias("outside"))


def _cross_tiles(members: DataFrame) -> DataFrame:
    """Tiles of what is outside the largest part of its bucket, with itself and with that part."""
    columns = ["tile", "node", "band", "root", "side", "single"]
    outside = members.filter("outside")
    among = tiled(outside.select("key", "band", "node", "root"), BLOCK).select(*columns)
    blocks = members.groupBy(F.col("key").alias("k")).agg(
        F.ceil(F.count_if("outside") / BLOCK).cast("int").alias("outer"), F.ceil(F.count_if(~F.col("outside")) / BLOCK).cast("int").alias("inner")
    )
    rows = members.join(blocks.filter("outer > 0"), F.col("key") == F.col("k"))
    rows = rows.withColumn("own", F.pmod(F.xxhash64("node", "key"), F.when(F.col("outside"), F.col("outer")).otherwise(F.col("inner"))).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.when(F.col("outside"), F.col("inner")).otherwise(F.col("outer")) - 1)))
    outer, inner = F.when(F.col("outside"), F.col("own")).otherwise(F.col("other")), F.when(F.col("outside"), F.col("other")).otherwise(F.col("own"))
    tile = F.xxhash64(F.lit("cross"), "key", outer, inner)
    rows = rows.withColumns({"tile": tile, "side": (~F.col("outside")).cast("int"), "single": F.lit(False)})
    return among.unionByName(rows.select(*columns))


def _links_of_large(large: DataFrame, sigs: DataFrame, units: DataFrame) -> DataFrame:
    """Links (a, b) that connect the members of large buckets as all links among them would."""
    star = stored(partners(_star_tiles(large).join(sigs, "node"), _likely_star), "star")
    links = _verified(star, units)
    met = stored(_cross_tiles(_with_parts(large, links)), "met")
    found = stored(partners(met.join(sigs, "node"), _likely), "likely")
    return links.unionByName(_verified(found, units))


def smallest(parts: DataFrame) -> DataFrame:
    """(node, class_id): the smallest id of each connected part, from (node, root, least)."""
    low = parts.groupBy("root").agg(F.min("least").alias("class_id"))
    return parts.select("node", "root").join(low, "root").select("node", "class_id")


def _labelled(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, h1, h2, n, class_id, kept) for every row, the lowest number for a null id."""
    rows = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(_LOWEST)).alias("id"), F.col(text_col).cast("string").alias("text")
    )
    # many rows may have one id, or none: a row is found again by its id and a hash of its text
    rows = rows.withColumn("mark", F.xxhash64("text"))
    signed = stored(rows.mapInPandas(_sign, "id long, mark long, n long, h1 long, h2 long, sig binary"), "signed")
    nodes = signed.filter("n > 0").groupBy("h1", "h2", "n").agg(F.min(F.struct("id", "mark")).alias("first"), F.first("sig").alias("sig"))
    nodes = nodes.select("h1", "h2", "n", F.col("first.id").alias("least"), F.col("first.mark").alias("of"), "sig")
    nodes = stored(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    keys = F.transform(
        F.sequence(F.lit(0), F.lit(BANDS - 1)),
        lambda j: F.struct(j.alias("band"), F.xxhash64(j, F.substring("sig", j * ROWS + 1, F.lit(ROWS))).alias("key")),
    )
    members = nodes.select("node", F.inline(keys))
    sizes = members.groupBy(F.col("key").alias("k")).agg(F.count(F.lit(1)).alias("of_key")).filter("of_key > 1")
    met = stored(members.join(sizes, F.col("key") == F.col("k")).select("key", "band", "node", "of_key"), "met")
    sigs = nodes.select("node", "sig")
    small = met.filter(F.col("of_key") <= BLOCK).select(
        F.col("key").alias("tile"), "band", "node", F.lit(0).alias("side"), F.lit(True).alias("single")
    )
    found = stored(partners(small.join(sigs, "node"), _likely), "likely")
    large = met.filter(F.col("of_key") > BLOCK)
    compared = found.select("node").unionByName(large.select("node")).distinct()
    wanted = nodes.select("node", "least", "of", "h1", "h2").join(compared, "node", "left_semi")
    same = (F.col("id") == F.col("least")) & (F.col("mark") == F.col("of"))
    units = rows.join(wanted.hint("merge"), same).select("node", "h1", "h2", "text")
    units = stored(units.mapInPandas(_units, "node long, units binary").dropDuplicates(["node"]), "units")
    links = _verified(found, units)
    if not large.isEmpty():
        links = links.unionByName(_links_of_large(large, sigs, units))
    linked = _ends(links)
    parts = stored(components(linked, links).join(nodes.select("node", "least"), "node"), "parts")
    # class_id may be that of another class too, as an id may stand on several texts; the root is not
    own = nodes.join(smallest(parts), "node", "left").join(parts.select("node", "root"), "node", "left")
    own = own.select("h1", "h2", "n", "least", F.coalesce("class_id", "least").alias("class_id"), F.coalesce("root", "node").alias("root"))
    own = stored(own, "own")
    leads = own.filter("least = class_id").groupBy("root").agg(F.min(F.struct("h1", "h2", "n")).alias("lead"))
    named = own.join(leads, "root").select(
        F.col("h1").alias("g1"), F.col("h2").alias("g2"), F.col("n").alias("gn"), "class_id",
        (F.struct("h1", "h2", "n") == F.col("lead")).alias("leads"),
    )
    named = stored(named, "named")
    same = (F.col("h1") == F.col("g1")) & (F.col("h2") == F.col("g2")) & (F.col("n") == F.col("gn"))
    found = signed.select("id", "h1", "h2", "n").join(named, same, "left")
    kept = F.coalesce(F.col("leads") & (F.col("id") == F.col("class_id")), F.lit(True))
    return found.select("id", "h1", "h2", "n", F.coalesce("class_id", "id").alias("class_id"), kept.alias("kept"))


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, class_id, kept) for every row; class_id is the smallest id of the class."""
    return _labelled(docs, id_col, text_col).select(
        F.nullif("id", F.lit(_LOWEST)).alias("id"), F.nullif("class_id", F.lit(_LOWEST)).alias("class_id"), "kept"
    )


def _set_of(text: Column) -> Column:
    """Column struct(n, h1, h2): the size and hash of the weighted set of a text column."""

    @F.pandas_udf("n long, h1 long, h2 long")
    def run(texts: pd.Series) -> pd.DataFrame:
        units = [elements(t) for t in texts]
        return pd.DataFrame([(len(u), *set_hash(u)) for u in units], columns=["n", "h1", "h2"]).astype("int64")

    return run(text)


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` that stay: one document of each class, that with the smallest id."""
    found = stored(_labelled(docs, id_col, text_col).select("id", "h1", "h2", "n", "kept"), "found")
    marked = found.groupBy(F.col("id").alias("odd_id")).agg(F.count(F.lit(1)).alias("times"), F.min("kept").alias("all_kept"))
    # nearly every row stays as it is, so only the exceptions are joined
    odd = stored(marked.filter("not all_kept or times > 1"), "odd")
    rows = carried(docs, own=F.coalesce(F.col(id_col).cast("long"), F.lit(_LOWEST)), text=F.col(text_col).cast("string"))
    # what goes grows with the documents, so the join is planned alike at every size
    single = rows.select("carried", "own").join(odd.hint("merge"), F.col("own") == F.col("odd_id"), "left_anti").select("carried.*")
    several = odd.filter("times > 1").select("odd_id")
    if several.isEmpty():
        return single
    # an id on several rows says nothing of a row, so these go by the weighted set of their text as well
    again = rows.join(several.hint("merge"), F.col("own") == F.col("odd_id"), "left_semi").select("carried", "own", _set_of(F.col("text")).alias("set"))
    stay = found.filter("kept and n > 0").select(F.col("id").alias("i"), F.struct("n", "h1", "h2").alias("s")).distinct()
    worded = again.filter("set.n > 0").join(stay, (F.col("own") == F.col("i")) & (F.col("set") == F.col("s")), "left_semi")
    worded = worded.dropDuplicates(["own", "set"]).select("carried.*")
    return single.unionByName(worded).unionByName(again.filter("set.n = 0").select("carried.*"))
