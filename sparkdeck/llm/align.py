"""Alignment of two tokenisations of the same bytes, by merge-path partitioning.

A text is encoded by a byte-level BPE vocabulary (A) and a SentencePiece model (B). The ends of the tokens of A and B are
two ascending lists; merging them gives the overlaps: each distinct end closes one stretch of bytes that
belongs to one token of A and one of B, so overlapping pairs and distinct ends are one to one. Ends that both
have cut the tokens into groups.

The merge is divided by diagonals: every `PIECE` steps a binary search finds how many ends of A and of B the
merge has taken by then (A first where ends are equal). A piece between two diagonals is merged without its
neighbours; it needs its own tokens, one more of each side, and the two offsets at which it begins. Texts that are one piece for certain,
by their bytes, are merged where they are encoded. The pieces of longer texts are rows of a written table, merged as rows, and
stitched by text: what precedes the first common end of a piece joins what the last piece left open.

Counts over documents: the distinct linked id pairs of many texts make a bundle of about `BUNDLE` (text, pair)
entries, with a dictionary of its pairs. Only the dictionaries are counted, summed by pair, and the sums return to
the bundles by a cogroup, so neither texts nor links are shuffled by pair. All lists are compressed.

Odd cases: a null or empty text has no tokens, nor has one whose joined bytes of A or B differ from space and text (as with
U+2581): zeros, and '' as digest. Special strings are plain text. Rows are known by a number of their own, so repeated and null
ids are rows like others, and count as documents of their own. Very long texts are encoded in one task but merged in pieces. An empty table
gives an empty result. Only the named columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored
from . import bpe, pieces
from .words import Memory, gathered, portions

#: ends of a piece; bytes of texts worked on at a time; (text, pair) entries of a bundle
PIECE, TOGETHER, BUNDLE = 1 << 15, 1 << 20, 1 << 21
#: a pair of ids as one number: id of A times this, plus id of B
SIDE = 1 << 24

PIECES = pa.schema(
    [("row", pa.int64()), ("id", pa.int64()), ("piece", pa.int32()), ("n_a", pa.int64()), ("n_b", pa.int64()),
     ("from_a", pa.int64()), ("from_b", pa.int64()), ("ids_a", pa.binary()), ("ids_b", pa.binary())]
)
PIECES_SQL = "row long, id long, piece int, n_a long, n_b long, from_a long, from_b long, ids_a binary, ids_b binary"
MERGED = pa.schema(
    [("row", pa.int64()), ("id", pa.int64()), ("piece", pa.int32())]
    + [(c, pa.binary()) for c in ("ids_a", "ids_b", "closed_a", "closed_b", "codes", "times")]
)
MERGED_SQL = "row long, id long, piece int, ids_a binary, ids_b binary, closed_a binary, closed_b binary, codes binary, times binary"
BUNDLES = pa.schema(
    [("bundle", pa.int64()), ("ids", pa.list_(pa.int64())), ("n_a", pa.list_(pa.int64())), ("n_b", pa.list_(pa.int64())),
     ("n_groups", pa.list_(pa.int64())), ("n_links", pa.list_(pa.int64())), ("digests", pa.list_(pa.string())),
     ("sizes", pa.list_(pa.int64())), ("entries", pa.binary()), ("times", pa.binary()),
     ("codes", pa.list_(pa.int64())), ("holders", pa.list_(pa.int64()))]
)
BUNDLES_SQL = (
    "bundle long, ids array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, digests array<string>, "
    "sizes array<long>, entries binary, times binary, codes array<long>, holders array<long>"
)
RESULT = pa.schema(
    [("id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()),
     ("n_best", pa.int64()), ("count_sum", pa.int64()), ("groups_sha256", pa.string())]
)
RESULT_SQL = "id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def packed(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values).tobytes())


def unpacked(data: bytes, kind: type) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), kind)


class Sides:
    """Both encoders, the bytes of their tokens, and the text of their ids."""

    def __init__(self, tokenizer: str, model: bytes):
        from tokenizers import Tokenizer

        self.a, self.b = bpe.Vocabulary(tokenizer), pieces.Model(model)
        self.a.tokenizer = Tokenizer.from_str(self.a.text)
        self.a.tokenizer.encode_special_tokens = True  # their strings are plain text
        self.memory = Memory(self._learn)
        if max(len(self.a.size), len(self.b.width)) >= SIDE:
            raise ValueError("vocabulary too large")
        # ids as text with what follows them: another id, the end of a side, the end of a group
        count = max(len(self.a.size), len(self.b.width))
        self.shown = [f"{i}{mark}" for i in range(count) for mark in ",|;"]

    def _learn(self, words: list[bytes]) -> list[bytes]:
        self.a.known = {}
        self.a.learn(words)
        return [self.a.known[w] for w in words]

    def encode_a(self, plain: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        data = np.frombuffer(b"".join(plain), np.uint8)
        length = np.fromiter(map(len, plain), np.int64, len(plain))
        ends = np.cumsum(length)
        if not len(data):
            return np.empty(0, np.int32), ends
        wide = data.astype(np.uint16)
        cut = np.r_[True, self.a.cuts[(wide[:-1] << 8) | wide[1:]]]
        cut[(ends - length)[length > 0]] = True
        return self.memory.encode(data, np.flatnonzero(cut), np.r_[0, np.cumsum(cut)][ends])

    def encode(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids of A and B of each text; none where their bytes are not those of space and text."""
        plain = [(" " + t).encode() if t else b"" for t in texts]
        a, stop_a = self.encode_a(plain)
        b, stop_b = self.b.encode([t or "" for t in texts])
        bytes_a = gathered(self.a.flat, self.a.start[a], self.a.size[a])
        bytes_b = gathered(self.b.flat, self.b.first[b], self.b.width[b])
        edge_a, edge_b = np.r_[0, np.cumsum(self.a.size[a])], np.r_[0, np.cumsum(self.b.width[b])]
        out, none = [], (a[:0], b[:0])
        for k, p in enumerate(plain):
            i, j = (stop_a[k - 1], stop_b[k - 1]) if k else (0, 0)
            own_a, own_b = a[i : stop_a[k]], b[j : stop_b[k]]
            same = bytes_a[edge_a[i] : edge_a[stop_a[k]]].tobytes() == p == bytes_b[edge_b[j] : edge_b[stop_b[k]]].tobytes()
            out.append((own_a, own_b) if same else none)
        return out


_loaded: dict[int, Sides] = {}


def sides_of(tokenizer: str, model: bytes) -> Sides:
    key = hash((tokenizer, model))
    if key not in _loaded:
        _loaded[key] = Sides(tokenizer, model)
    return _loaded[key]


def diagonal(ends_a: np.ndarray, ends_b: np.ndarray, taken: int) -> int:
    """How many of the first `taken` ends of the merge are of A, which comes first where ends are equal."""
    low, high = max(0, taken - len(ends_b)), min(taken, len(ends_a))
    while low < high:
        middle = (low + high) // 2
        if ends_a[middle] <= ends_b[taken - middle - 1]:
            low = middle + 1
        else:
            high = middle
    return low


def divided(ends_a: np.ndarray, ends_b: np.ndarray, step: int) -> list[tuple[int, int]]:
    """Ends of A and B taken at each diagonal, from (0, 0) to all."""
    whole = len(ends_a) + len(ends_b)
    at = [(i, taken - i) for taken in range(step, whole, step) for i in [diagonal(ends_a, ends_b, taken)]]
    return [(0, 0), *at, (len(ends_a), len(ends_b))]


class Piece:
    """Tokens of a stretch of the merge: own ones, one more of each side where there is one, and where they begin."""

    __slots__ = ("ids_a", "ids_b", "n_a", "n_b", "from_a", "from_b")

    def __init__(self, ids_a: np.ndarray, ids_b: np.ndarray, n_a: int, n_b: int, from_a: int = 0, from_b: int = 0):
        self.ids_a, self.ids_b, self.n_a, self.n_b, self.from_a, self.from_b = ids_a, ids_b, n_a, n_b, from_a, from_b


def merged(found: list[Piece], width_a: np.ndarray, width_b: np.ndarray):
    """The overlaps and common ends of pieces, each merged by itself, all in one set of arrays.

    Returns (piece, id of A, id of B) of each overlap, and (piece, own ends of A so far, of B so far) of each common end.
    Pieces lie one after another in one space of byte positions, in which ends are marks.
    """
    ids_a, ids_b = np.concatenate([p.ids_a for p in found]), np.concatenate([p.ids_b for p in found])
    held_a, held_b = np.array([len(p.ids_a) for p in found]), np.array([len(p.ids_b) for p in found])
    n_a, n_b = np.array([p.n_a for p in found]), np.array([p.n_b for p in found])
    from_a, from_b = np.array([p.from_a for p in found]), np.array([p.from_b for p in found])
    first_a, first_b = np.cumsum(held_a) - held_a, np.cumsum(held_b) - held_b

    def places(ids, width, held, n, begin, first):
        """Piece and end of each own token, the end as bytes from where the text begins."""
        size = width[ids]
        total = np.r_[0, np.cumsum(size)]
        piece = np.repeat(np.arange(len(held)), held)
        own = np.arange(len(ids)) - first[piece] < n[piece]
        return piece[own], (total[1:] - total[first][piece] + begin[piece])[own]

    piece_a, end_a = places(ids_a, width_a, held_a, n_a, from_a, first_a)
    piece_b, end_b = places(ids_b, width_b, held_b, n_b, from_b, first_b)
    low = np.minimum(from_a, from_b)
    high = low.copy()
    np.maximum.at(high, piece_a, end_a)
    np.maximum.at(high, piece_b, end_b)
    base = np.cumsum(high - low + 1) - (high - low + 1) - low
    room = int((high - low + 1).sum())
    mark_a, mark_b = np.zeros(room, bool), np.zeros(room, bool)
    mark_a[end_a + base[piece_a]], mark_b[end_b + base[piece_b]] = True, True
    count_a, count_b = np.cumsum(mark_a, dtype=np.int32), np.cumsum(mark_b, dtype=np.int32)
    # an end of B that equals the last end of A before the piece: its overlap is the former piece's
    again = (np.r_[end_b, 0][np.minimum(np.cumsum(n_b) - n_b, len(end_b))] == from_a) & (n_b > 0) & (from_a > 0)
    spot = (from_a + base)[again]
    new, common = mark_a | mark_b, mark_a & mark_b
    new[spot], common[spot] = False, True
    stops = np.flatnonzero(new)
    shift_a, shift_b = held_a - n_a, held_b - n_b
    edge = np.cumsum(high - low + 1)
    piece = np.searchsorted(edge, stops, "right")
    more_a, more_b = np.cumsum(shift_a) - shift_a, np.cumsum(shift_b) - shift_b
    a = ids_a[count_a[stops] - mark_a[stops] + more_a[piece]]
    b = ids_b[count_b[stops] - mark_b[stops] + more_b[piece]]
    shut = np.flatnonzero(common)
    where = np.searchsorted(edge, shut, "right")
    before_a, before_b = np.cumsum(n_a) - n_a, np.cumsum(n_b) - n_b
    return (piece, a, b), (where, count_a[shut] - before_a[where], count_b[shut] - before_b[where])


def rendered(ids_a: np.ndarray, ids_b: np.ndarray, closed_a: np.ndarray, closed_b: np.ndarray, shown: list[str]) -> str:
    """`a1,a2|b1;a3|b2,b3` of whole groups: `closed_a` and `closed_b` say how many ids lie before the end of each."""
    if not len(closed_a):
        return ""
    size_a, size_b = np.diff(np.r_[0, closed_a]), np.diff(np.r_[0, closed_b])
    group_a, group_b = np.repeat(np.arange(len(size_a)), size_a), np.repeat(np.arange(len(size_b)), size_b)
    line = np.empty(len(ids_a) + len(ids_b), np.int64)
    at_a = np.arange(len(ids_a)) + (closed_b - size_b)[group_a]
    at_b = np.arange(len(ids_b)) + closed_a[group_b]
    line[at_a], line[at_b] = ids_a.astype(np.int64) * 3, ids_b.astype(np.int64) * 3
    line[closed_a - 1 + closed_b - size_b] += 1
    line[closed_a + closed_b - 1] += 2
    return "".join(map(shown.__getitem__, line.tolist()))[:-1]


def _distinct(piece: np.ndarray, a: np.ndarray, b: np.ndarray, pieces_in_all: int):
    """Distinct pairs of each piece and how often they are linked: codes, times, and entries per piece."""
    if pieces_in_all >= 1 << 15:
        raise ValueError("too many texts at a time")
    key = np.sort((piece.astype(np.int64) << 48) | a.astype(np.int64) * SIDE + b)
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.empty(0, np.int64)
    times = np.diff(np.r_[first, len(key)])
    return key[first] & ((1 << 48) - 1), times, np.bincount(key[first] >> 48, minlength=pieces_in_all)


class Bundle:
    """Texts whose entries are gathered until there are enough."""

    def __init__(self, number: int):
        self.number, self.held, self.rows, self.codes, self.times = number, 0, [], [], []

    def add(self, rows: list[tuple], codes: np.ndarray, times: np.ndarray) -> None:
        """`rows` are (id, n_a, n_b, n_groups, n_links, digest, entries)."""
        self.rows += rows
        self.codes.append(codes)
        self.times.append(times)
        self.held += len(codes)

    def batch(self) -> pa.RecordBatch:
        codes, times = np.concatenate(self.codes), np.concatenate(self.times)
        known, entry, holders = np.unique(codes, return_inverse=True, return_counts=True)
        columns = [list(c) for c in zip(*self.rows)]
        values = [[self.number], *([c] for c in columns), [packed(entry.astype(np.uint32))], [packed(times.astype(np.uint32))], [known], [holders]]
        return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(values, BUNDLES)], schema=BUNDLES)


def _numbers() -> Iterator[int]:
    """Numbers that no other task of the stage gives out."""
    context = TaskContext.get()
    first = (context.partitionId() if context else 0) << 40
    while True:
        yield first
        first += 1


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest() if text else ""


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list]]:
    for batch in batches:
        ids, texts = batch.column("id").to_pylist(), batch.column("text").to_pylist()
        for i, j in portions([len(t or "") + 8 for t in texts], TOGETHER):
            yield ids[i:j], texts[i:j]


def _whole(tokenizer: str, model: bytes):
    """Texts of one piece, from text to bundle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides, numbers = sides_of(tokenizer, model), _numbers()
        bundle = Bundle(next(numbers))
        for ids, texts in _texts(batches):
            tokens = sides.encode(texts)
            (piece, a, b), (where, closed_a, closed_b) = merged([Piece(x, y, len(x), len(y)) for x, y in tokens], sides.a.size, sides.b.width)
            codes, times, entries = _distinct(piece, a, b, len(ids))
            n_links = np.bincount(piece, minlength=len(ids)).tolist()
            edges = np.searchsorted(where, np.arange(len(ids) + 1)).tolist()
            rows = []
            for k, (x, y) in enumerate(tokens):
                s, e = edges[k], edges[k + 1]
                digest = _sha(rendered(x, y, closed_a[s:e], closed_b[s:e], sides.shown))
                rows.append((ids[k], len(x), len(y), e - s, n_links[k], digest, int(entries[k])))
            bundle.add(rows, codes, times)
            if bundle.held >= BUNDLE:
                yield bundle.batch()
                bundle = Bundle(next(numbers))
        if bundle.rows:
            yield bundle.batch()

    return run


def _cut(tokenizer: str, model: bytes, step: int):
    """Longer texts as pieces between diagonals."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides, numbers = sides_of(tokenizer, model), _numbers()
        for ids, texts in _texts(batches):
            for doc, (a, b) in zip(ids, sides.encode(texts)):
                row, ends_a, ends_b = next(numbers), np.cumsum(sides.a.size[a]), np.cumsum(sides.b.width[b])
                path = divided(ends_a, ends_b, step)
                for k, ((i, j), (u, v)) in enumerate(zip(path, path[1:])):
                    values = [row, doc, k, u - i, v - j, int(ends_a[i - 1]) if i else 0, int(ends_b[j - 1]) if j else 0,
                              packed(a[i : u + 1]), packed(b[j : v + 1])]
                    yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(values, PIECES)], schema=PIECES)

    return run


def _merge_rows(width_a: np.ndarray, width_b: np.ndarray):
    """Each piece by itself: its own tokens, its common ends, its overlaps."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                a, b = unpacked(r["ids_a"], np.int32), unpacked(r["ids_b"], np.int32)
                piece = Piece(a, b, r["n_a"], r["n_b"], r["from_a"], r["from_b"])
                (where, x, y), (_, closed_a, closed_b) = merged([piece], width_a, width_b)
                codes, times, _ = _distinct(where, x, y, 1)
                lists = [a[: r["n_a"]], b[: r["n_b"]], closed_a.astype(np.int64), closed_b.astype(np.int64), codes, times]
                values = [r["row"], r["id"], r["piece"], *map(packed, lists)]
                yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, MERGED)], schema=MERGED)

    return run


def _stitch(tokenizer: str, model: bytes):
    """The pieces of one text as a bundle of its own."""

    def run(table: pa.Table) -> pa.Table:
        sides = sides_of(tokenizer, model)
        rows = sorted(table.to_pylist(), key=lambda r: r["piece"])
        ids_a, ids_b, closed_a, closed_b, codes, times = ([] for _ in range(6))
        n_a = n_b = 0
        for r in rows:  # what a piece leaves open is closed by the first common end of a later one
            closed_a.append(unpacked(r["closed_a"], np.int64) + n_a)
            closed_b.append(unpacked(r["closed_b"], np.int64) + n_b)
            ids_a.append(unpacked(r["ids_a"], np.int32))
            ids_b.append(unpacked(r["ids_b"], np.int32))
            codes.append(unpacked(r["codes"], np.int64))
            times.append(unpacked(r["times"], np.int64))
            n_a, n_b = n_a + len(ids_a[-1]), n_b + len(ids_b[-1])
        a, b, ends_a, ends_b = (np.concatenate(x) for x in (ids_a, ids_b, closed_a, closed_b))
        known, at = np.unique(np.concatenate(codes), return_inverse=True)
        linked = np.bincount(at, np.concatenate(times), len(known)).astype(np.int64)
        digest = _sha(rendered(a, b, ends_a, ends_b, sides.shown))
        bundle = Bundle(-1 - rows[0]["row"])
        bundle.add([(rows[0]["id"], n_a, n_b, len(ends_a), int(linked.sum()), digest, len(known))], known, linked)
        return pa.Table.from_batches([bundle.batch()])

    return run


def _answered(bundles: pa.Table, replies: pa.Table) -> pa.Table:
    """The rows of a bundle with the sums over their links."""
    order = np.argsort(replies.column("code").to_numpy())
    count = replies.column("holders").to_numpy()[order]
    best = replies.column("best").to_numpy(zero_copy_only=False).astype(np.int64)[order] if len(order) else count
    out = []
    for r in bundles.to_pylist():
        entry, times = unpacked(r["entries"], np.uint32), unpacked(r["times"], np.uint32).astype(np.int64)
        edge = np.cumsum([0, *r["sizes"]])
        sums, bests = (np.r_[0, np.cumsum(times * values[entry])] for values in (count, best))
        columns = [r["ids"], r["n_a"], r["n_b"], r["n_groups"], r["n_links"], np.diff(bests[edge]), np.diff(sums[edge]), r["digests"]]
        out.append(pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, RESULT)], schema=RESULT))
    return pa.Table.from_batches(out, RESULT)


def align(
    docs: DataFrame, tokenizer: str, model: bytes, id_col: str = "doc_id", text_col: str = "text", step: int = PIECE
) -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) for every row.

    `tokenizer` and `model` are the contents of the files of A and B.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    size = F.coalesce(F.octet_length("text"), F.lit(0))
    # a text has at most as many tokens as bytes, with the space in front
    short, longer = rows.filter(2 * (size + 1) <= step), rows.filter(2 * (size + 1) > step)
    cut = stored(longer.mapInArrow(_cut(tokenizer, model, step), PIECES_SQL), "pieces")
    vocabulary, pieces_model = bpe.Vocabulary(tokenizer), pieces.Model(model)
    stitched = cut.mapInArrow(_merge_rows(vocabulary.size, pieces_model.width), MERGED_SQL).groupBy("row").applyInArrow(
        _stitch(tokenizer, model), BUNDLES_SQL
    )
    bundles = stored(short.mapInArrow(_whole(tokenizer, model), BUNDLES_SQL).unionByName(stitched), "bundles")
    asked = bundles.select("bundle", F.inline(F.arrays_zip("codes", "holders"))).withColumnRenamed("codes", "code")
    counts = asked.groupBy("code").agg(F.sum("holders").alias("holders"))
    counts = stored(counts.withColumn("a", F.expr(f"code div {SIDE}")), "counts")
    highest = counts.groupBy(F.col("a").alias("of")).agg(F.max("holders").alias("highest"))
    judged = counts.join(highest, F.col("a") == F.col("of")).select(F.col("code").alias("known"), "holders", (F.col("holders") == F.col("highest")).alias("best"))
    replies = asked.select(F.col("bundle").alias("to"), "code").join(judged, F.col("code") == F.col("known")).select("to", "code", "holders", "best")
    return bundles.drop("codes", "holders").groupBy("bundle").cogroup(replies.groupBy("to")).applyInArrow(_answered, RESULT_SQL)
