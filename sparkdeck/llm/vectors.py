"""Near-duplicate embeddings by randomised-rotation binary codes.

Vectors are compared only under equal labels, by cosine. Each vector is turned by a few random rotations (the
same for all), and the signs of the turned vector are its code: the corner of a cube nearest to it. Beside the code stands a
correction factor, the inner product of the vector with that corner. The inner product of a corner with
another turned vector, divided by the factor, is an unbiased estimate of the cosine, and its error is
bounded with a confidence that `CONFIDENCE` standard deviations give. Pairs whose bound stays below the
threshold go; all others are computed anew from the vectors in double precision.

Which pairs are looked at: bits of the codes make bands, and vectors that agree in a band meet. The bits of a band grow with the
logarithm of the largest label, and the bands with them, so that a pair at the threshold is missed with
a chance of `MISS` at most and the pairs that meet by chance grow in proportion to the vectors. Equal vectors
of a label are one node with a weight. No band is capped.

Odd cases: vectors that are null, empty, zero, or hold nulls or non-finite numbers, and those without a label, link with
nothing; vectors of different length neither. A null id is smaller than any other. Rows that repeat an id count as vectors. An empty
table gives an empty result. Only the named columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.models.clustering import components
from ..session import stored
from .common import roots, whole_groups
from .near import smallest
from .tiles import listed, partners, tiled, together

MISS, CONFIDENCE = 1e-6, 4.5
#: vectors of a block of a large band; distinct vectors of a label for which bands of 8 bits are enough
BLOCK, FEW = 512, 16_384
_LOWEST = -(1 << 63)

_turns: dict[tuple[int, int], np.ndarray] = {}


def rotation(dim: int, number: int) -> np.ndarray:
    """The random rotation of that number: an orthogonal matrix that depends on its arguments only."""
    if (dim, number) not in _turns:
        q, r = np.linalg.qr(np.random.default_rng([dim, number]).standard_normal((dim, dim)))
        _turns[dim, number] = q * np.sign(np.diag(r))
    return _turns[dim, number]


def bands_for(largest: int, threshold: float) -> tuple[int, int]:
    """Bits of a band and number of bands, for the distinct vectors of the largest label."""
    bits = 8 + max(0, math.ceil(math.log2(max(largest, 1) / FEW)))
    meet = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(MISS) / math.log1p(-meet))


def turned(unit: np.ndarray, turns: int) -> np.ndarray:
    """Rows turned by each rotation, side by side."""
    return np.hstack([unit @ rotation(unit.shape[1], k) for k in range(turns)])


def coded(unit: np.ndarray, turns: int) -> tuple[np.ndarray, np.ndarray]:
    """Signs of the turned rows, and the correction factor of each row and turn."""
    y = turned(unit, turns)
    dim = unit.shape[1]
    return y > 0, np.abs(y).reshape(len(y), turns, dim).sum(2) / math.sqrt(dim)


def _read(kind: str):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for v in frame["vec"]:
                x = None if v is None else np.asarray(v, kind)
                good = x is not None and len(x) and np.isfinite(x).all() and x.any()
                out.append(x.tobytes() if good else None)
            yield pd.DataFrame({"id": frame["id"], "label": frame["label"], "vec": out})

    return run


def _code(kind: str, bits: int, bands: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for dim, rows in frame.groupby(frame["vec"].map(len) // np.dtype(kind).itemsize):
                x = np.frombuffer(b"".join(rows["vec"]), kind).reshape(-1, dim).astype(np.float64)
                x = x / np.abs(x).max(1, keepdims=True)
                x /= np.linalg.norm(x, axis=1, keepdims=True)
                signs, factors = coded(x, -(-bits * bands // dim))
                scale = np.abs(x).max(1) / 127
                small = np.rint(x / scale[:, None]).astype(np.int8)
                picked = signs[:, : bits * bands].reshape(len(x), bands, bits)
                keys = np.zeros((len(x), bands), np.int64)
                for k in range(bits):
                    keys = keys * 2 + picked[:, :, k]
                yield pd.DataFrame(
                    {
                        "node": rows["node"].to_numpy(), "label": rows["label"].to_numpy(), "dim": dim,
                        "code": [c.tobytes() for c in np.packbits(signs, axis=1)],
                        "factors": [f.tobytes() for f in factors.astype(np.float32)],
                        "small": [s.tobytes() for s in small], "scale": scale, "keys": list(keys),
                    }
                )

    return run


def _likely(bits: int, bands: int, threshold: float):
    def judge(frame: pd.DataFrame):
        dims = frame["dim"].to_numpy()
        band = frame["band"].to_numpy()
        place = np.zeros(len(frame), np.int64)
        parts = {}
        for dim in np.unique(dims):  # a tile has one dim only
            rows = np.flatnonzero(dims == dim)
            place[rows] = np.arange(len(rows))
            turns = -(-bits * bands // int(dim))
            take = frame.iloc[rows]
            width = -(-turns * int(dim) // 8)
            code = np.frombuffer(b"".join(take["code"]), np.uint8).reshape(-1, width)
            signs = np.unpackbits(code, axis=1, count=turns * int(dim))
            factors = np.frombuffer(b"".join(take["factors"]), np.float32).reshape(-1, turns).astype(np.float64)
            scale = take["scale"].to_numpy()
            y = turned(np.frombuffer(b"".join(take["small"]), np.int8).reshape(-1, int(dim)) * scale[:, None], turns)
            corner = (signs * 2.0 - 1) / math.sqrt(dim) / np.repeat(factors, int(dim), axis=1) / turns
            spread = np.sqrt(((1 - np.minimum(factors**2, 1)) / factors**2).mean(1) / max(int(dim) - 1, 1) / turns)
            slack = CONFIDENCE * spread + 1e-5
            rounding = math.sqrt(dim) * scale / 2 * (1 / factors).max(1).max(initial=0)
            cells = signs[:, : bits * bands].reshape(-1, bands, bits)
            keys = np.zeros((len(cells), bands), np.int64)
            for k in range(bits):
                keys = keys * 2 + cells[:, :, k]
            parts[int(dim)] = (corner.astype(np.float32), y.astype(np.float32), slack, rounding, keys)

        def passes(a: np.ndarray, b: np.ndarray) -> np.ndarray:
            ok = np.zeros(len(a), bool)
            for dim, (corner, y, slack, rounding, keys) in parts.items():
                own = np.flatnonzero(dims[a] == dim) if len(parts) > 1 else np.arange(len(a))
                i, j = place[a[own]], place[b[own]]
                first = (keys[i] == keys[j]).argmax(1) == band[a[own]]
                own, i, j = own[first], i[first], j[first]
                one = np.einsum("ij,ij->i", corner[i], y[j]) + slack[i] + rounding[j]
                two = np.einsum("ij,ij->i", corner[j], y[i]) + slack[j] + rounding[i]
                ok[own] = np.minimum(one, two) >= threshold  # either bound may rule a pair out
            return ok

        return passes

    return judge


def _verify(kind: str, threshold: float):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in whole_groups(frames, lambda f: f["tile"].to_numpy()):
            node, weight, raw = frame["node"].to_numpy(), frame["weight"].to_numpy(), frame["vec"].to_numpy()
            out = []
            for at, a, b in listed(frame):
                x = np.frombuffer(b"".join(raw[at]), kind).reshape(len(at), -1).astype(np.float64)
                size = np.sqrt(np.einsum("ij,ij->i", x, x))
                a, b = a - at[0], b - at[0]
                good = np.empty(len(a), bool)
                for k in range(0, len(a), 1 << 14):
                    i, j = a[k : k + (1 << 14)], b[k : k + (1 << 14)]
                    good[k : k + (1 << 14)] = np.einsum("ij,ij->i", x[i], x[j]) / (size[i] * size[j]) >= threshold
                a, b = a[good], b[good]
                if len(a):
                    own = weight[at]
                    links = np.bincount(a, own[b], len(at)) + np.bincount(b, own[a], len(at))
                    low = roots(len(at), a, b)
                    some = np.flatnonzero(links)
                    out.append(pd.DataFrame({"node": node[at][some], "links": links[some].astype(np.int64), "low": node[at][low[some]]}))
            if out:
                yield pd.concat(out)

    return run


def linked(
    table: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", threshold: float = 0.98
) -> DataFrame:
    """(id, n_links, component_id, kept) for every row."""
    kind = "<f4" if dict(table.dtypes)[vec_col] == "array<float>" else "<f8"
    rows = table.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(_LOWEST)).alias("id"),
        F.col(label_col).cast("string").alias("label"),
        F.col(vec_col).cast("array<float>" if kind == "<f4" else "array<double>").alias("vec"),
    )
    rows = stored(rows.mapInPandas(_read(kind), "id long, label string, vec binary"), "vectors")
    fit = rows.filter("label is not null and vec is not null")
    nodes = fit.groupBy("label", "vec").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("weight"))
    nodes = stored(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    largest = nodes.groupBy("label").count().agg(F.max("count")).head()[0] or 1
    bits, bands = bands_for(largest, threshold)
    codes = stored(
        nodes.select("node", "label", "vec").mapInPandas(
            _code(kind, bits, bands),
            "node long, label string, dim int, code binary, factors binary, small binary, scale double, keys array<long>",
        ),
        "codes",
    )
    members = codes.select("node", "label", "dim", F.posexplode("keys").alias("band", "bits"))
    members = members.select("node", "band", F.xxhash64("label", "dim", "band", "bits").alias("key"))
    met = tiled(members, BLOCK).join(codes.select("node", "dim", "code", "factors", "small", "scale"), "node")
    found = stored(partners(met, _likely(bits, bands, threshold)), "likely")
    exact = found.join(nodes.select("node", "weight", "vec"), "node")
    links = stored(together(exact).mapInPandas(_verify(kind, threshold), "node long, links long, low long"), "links")
    counted = stored(links.groupBy("node").agg(F.sum("links").alias("links")), "counted")
    ends = links.select(F.col("node").alias("a"), F.col("low").alias("b")).distinct()
    parts = stored(components(counted.select("node"), ends).join(nodes.select("node", "least"), "node"), "parts")
    named = nodes.join(counted, "node", "left").join(smallest(parts), "node", "left").select(
        F.col("label").alias("l"), F.col("vec").alias("v"), (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
        F.coalesce("class_id", "least").alias("class_id"),
    )
    named = stored(named, "named")
    found = rows.join(named, (F.col("label") == F.col("l")) & (F.col("vec") == F.col("v")), "left")
    found = found.select("id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("class_id", "id").alias("component_id"))
    return found.select(
        F.nullif("id", F.lit(_LOWEST)).alias("id"), "n_links", F.nullif("component_id", F.lit(_LOWEST)).alias("component_id"),
        (F.col("id") == F.col("component_id")).alias("kept"),
    )
