"""SentencePiece (BPE) encoding and decoding by vectorised merge rounds.

A text is cut into words wherever two neighbouring characters stand next to each other inside no piece of the
vocabulary, as nothing can ever be merged across. The distinct words of a batch are one flat array of symbols,
numbered by word. In each round every word finds the smallest rank among its neighbouring pairs, all
leftmost occurrences of that rank are merged at once, and the array is closed up; words without a pair that
can be merged leave it, until none is left.

The library merges one pair at a time: the smallest rank, then the leftmost. Merging at once gives the same
unless a merge makes a new neighbouring pair of the same or a smaller rank, which the library would take next; in
such a word a round stops after that merge. Words of more than `LONG` characters, for which rounds would be
quadratic, are merged one at a time from a heap, which is the library's own order.

Symbols that are no piece become the pieces of their bytes. The end id is added on demand. Decoding puts pieces
together, turns U+2581 into a space, drops the first space and reads bytes that are no UTF-8 as one replacement character each.

Supported are BPE models with byte pieces, without user-defined or unused pieces, whose normaliser only puts a space in
front and turns spaces into U+2581; others are refused.

Odd cases: a null or empty text has no ids but the end id; null ids decode to the empty text; ids outside the
vocabulary are left out. Repeated rows are encoded alike. Very long texts are worked on alone, in
memory that grows with the text. All of it is a column expression: no row moves, other columns are not touched, an empty
table stays empty.
"""

from __future__ import annotations

import codecs
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from .words import Memory, gathered, portions

#: characters of a word beyond which it is merged from a heap; characters of the texts worked on at a time
LONG, TOGETHER = 1024, 1 << 20
_SPACE, _NONE = 0x2581, np.iinfo(np.int32).max
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def _one_each(error: UnicodeError) -> tuple[str, int]:
    return "�", error.start + 1


codecs.register_error("sparkdeck.one_each", _one_each)


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of the fields of a serialised message."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = number()
        if tag & 7 == 0:
            yield tag >> 3, number()
        else:
            size = number() if tag & 7 == 2 else {1: 8, 5: 4}[tag & 7]
            yield tag >> 3, data[at : at + size]
            at += size


def _check(model: bytes) -> None:
    """Refuse models whose rules are not those of the docstring. Field numbers are those of the published format."""
    parts = dict(f for f in _fields(model) if f[0] in (2, 3))
    trainer, normal = dict(_fields(parts.get(2, b""))), dict(_fields(parts.get(3, b"")))
    if trainer.get(3, 1) != 2 or not trainer.get(35) or trainer.get(24):
        raise ValueError("only BPE models with byte pieces and spaces in front of words")
    if normal.get(2) or not normal.get(3, 1) or normal.get(4, 1) or not normal.get(5, 1):
        raise ValueError("only models that put a space in front and keep everything else")


class _Pairs:
    """(left symbol, right symbol) -> number of the merge, by open addressing in arrays."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        bits = max(4, int(len(keys) * 4).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.values = np.full(1 << bits, -1, np.int64), np.full(1 << bits, -1, np.int32)
        slot = self._slot(keys)
        while len(keys):
            free = np.flatnonzero(self.keys[slot] == -1)
            _, first = np.unique(slot[free], return_index=True)
            put = free[first]
            self.keys[slot[put]], self.values[slot[put]] = keys[put], values[put]
            left = np.ones(len(keys), bool)
            left[put] = False
            keys, values, slot = keys[left], values[left], (slot[left] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * _FACTOR) >> self.shift).astype(np.int64)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The merge of each pair, -1 where there is none. Negative symbols are never merged."""
        keys = left.astype(np.int64) << 32 | right.astype(np.int64)
        found = np.full(len(keys), -1, np.int32)
        left_over = np.flatnonzero((left >= 0) & (right >= 0))
        slot = self._slot(keys[left_over])
        while len(left_over):
            held = self.keys[slot]
            same = held == keys[left_over]
            found[left_over[same]] = self.values[slot[same]]
            on = ~same & (held != -1)
            left_over, slot = left_over[on], (slot[on] + 1) & self.mask
        return found


class Model:
    """What a task needs of a model file."""

    def __init__(self, model: bytes):
        import sentencepiece

        _check(model)
        library = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = library.get_piece_size()
        names = [library.id_to_piece(i) for i in range(n)]
        byte = {i: int(names[i][3:5], 16) for i in range(n) if library.is_byte(i)}
        rest = [i for i in range(n) if not (i in byte or library.is_control(i) or library.is_unknown(i))]
        types = [dict(_fields(v)).get(3, 1) for k, v in _fields(model) if k == 1]
        if len(byte) != 256 or any(types[i] != 1 for i in rest):
            raise ValueError("only models with all bytes and without user-defined or unused pieces")
        self.end = library.eos_id()
        self.byte_id = np.zeros(256, np.int32)
        self.byte_id[list(byte.values())] = list(byte)
        # symbols: piece ids, then characters that only occur inside pieces; other characters are negative
        number = {names[i]: i for i in rest}
        for c in sorted({c for name in list(number) for c in name}):
            number.setdefault(c, n + len(number))
        self.size = n
        self.char = -1 - np.arange(0x110000, dtype=np.int32)
        single = [(ord(c), i) for c, i in number.items() if len(c) == 1]
        self.char[[c for c, _ in single]] = [i for _, i in single]
        self.char_of = {i: chr(c) for c, i in single if i >= n}
        ranks = {s: k for k, s in enumerate(sorted({library.get_score(i) for i in rest}, reverse=True))}
        keys, merged, rank = [], [], []
        for i in rest:
            for k in range(1, len(names[i])):
                left, right = number.get(names[i][:k]), number.get(names[i][k:])
                if left is not None and right is not None:
                    keys.append(left << 32 | right)
                    merged.append(i)
                    rank.append(ranks[library.get_score(i)])
        self.merged, self.rank = np.array(merged or [0], np.int32), np.array(rank + [_NONE], np.int32)
        self.pairs = _Pairs(np.array(keys, np.int64), np.arange(len(keys), dtype=np.int32))
        # neighbours inside pieces, by hash: a chance hit only makes a word longer
        self.joined = np.zeros(1 << 20, bool)
        inside = np.array(sorted({(ord(a), ord(b)) for name in number for a, b in zip(name, name[1:])}), np.int64).reshape(-1, 2)
        self.joined[self._hash(inside[:, 0], inside[:, 1])] = True
        # text of every id, for decoding; the last entry is that of ids outside the vocabulary
        shown = [bytes([byte[i]]) if i in byte else b"" if library.is_control(i) else names[i].replace("▁", " ").encode() for i in range(n)]
        shown[library.unk_id()] = library.decode([library.unk_id()]).encode()
        self.bytes_of = [*shown, b""]
        self.control = np.array([library.is_control(i) for i in range(n)] + [True])
        self.leads = np.array([name.startswith("▁") and i not in byte and not library.is_control(i) for i, name in enumerate(names)] + [False])
        self.width = np.array([len(b) for b in self.bytes_of], np.int64)
        self.first = np.cumsum(self.width) - self.width
        self.flat = np.frombuffer(b"".join(self.bytes_of), np.uint8)
        self.memory = Memory(self.learn)

    @staticmethod
    def _hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (a * 0x2545F491 + b * 0x9E3779B1 ^ a >> 7) & ((1 << 20) - 1)

    def rounds(self, symbols: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge all words, given as symbols and ascending word numbers; returns the same, merged."""
        symbols, word = symbols.copy(), word.copy()
        done: list[tuple[np.ndarray, np.ndarray]] = []

        def merges(at: np.ndarray) -> np.ndarray:
            """The merge of the symbols at `at` and `at + 1`, -1 where there is none."""
            inside = (at >= 0) & (at + 1 < len(symbols))
            inside[inside] = word[at[inside]] == word[at[inside] + 1]
            found = np.full(len(at), -1, np.int32)
            found[inside] = self.pairs(symbols[at[inside]], symbols[at[inside] + 1])
            return found

        merge = merges(np.arange(len(symbols)))
        while len(symbols):
            rank = self.rank[merge]
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            length = np.diff(np.r_[starts, len(symbols)])
            best = np.minimum.reduceat(rank, starts)
            if (best == _NONE).any():
                over = np.repeat(best == _NONE, length)
                done.append((symbols[over], word[over]))
                symbols, word, merge, rank = symbols[~over], word[~over], merge[~over], rank[~over]
                length, best = length[best != _NONE], best[best != _NONE]
                if not len(symbols):
                    break
            hit = rank == np.repeat(best, length)
            at = np.flatnonzero(hit)
            # leftmost first: of hits side by side every second one is taken
            run = np.flatnonzero(np.r_[True, np.diff(at) != 1])
            at = at[(np.arange(len(at)) - np.repeat(run, np.diff(np.r_[run, len(at)]))) % 2 == 0]
            new = self.merged[merge[at]]
            # a merge whose new neighbours would be merged next is the last of its word in this round
            before, after = at - 1, at + 2
            follows = np.r_[False, np.diff(at) == 2]
            left = np.where(follows, np.r_[0, new[:-1]], symbols[np.maximum(before, 0)])
            has_left = (at > 0) & (word[np.maximum(before, 0)] == word[at])
            right = symbols[np.minimum(after, len(symbols) - 1)]
            has_right = (after < len(symbols)) & (word[np.minimum(after, len(symbols) - 1)] == word[at])
            own = rank[at]
            last = has_left & (self.rank[self.pairs(left, new)] <= own)
            last |= has_right & (self.rank[self.pairs(new, right)] <= own)
            if last.any():
                stops = at[last]
                lasts, pick = np.unique(word[stops], return_index=True)
                place = np.searchsorted(lasts, word[at])
                held = place < len(lasts)
                held[held] = lasts[place[held]] == word[at[held]]
                keep = np.ones(len(at), bool)
                keep[held] = at[held] <= stops[pick][place[held]]
                at, new = at[keep], new[keep]
            symbols[at] = new
            stays = np.ones(len(symbols), bool)
            stays[at + 1] = False
            symbols, word, merge = symbols[stays], word[stays], merge[stays]
            at = at - np.arange(len(at))
            touched = np.r_[at, at[at > 0] - 1]
            merge[touched] = merges(touched)
        if not done:
            return symbols, word
        symbols, word = np.concatenate([s for s, _ in done]), np.concatenate([w for _, w in done])
        order = np.argsort(word, kind="stable")
        return symbols[order], word[order]

    def one_by_one(self, symbols: np.ndarray) -> np.ndarray:
        """Merge one word from a heap of its pairs, smallest rank and then leftmost first."""
        held: list[int | None] = symbols.tolist()
        after, before = [*range(1, len(held)), -1], [-1, *range(len(held) - 1)]
        first = self.pairs(symbols[:-1], symbols[1:])
        heap = [(int(self.rank[m]), k, held[k], held[k + 1], int(self.merged[m])) for k, m in enumerate(first.tolist()) if m >= 0]
        heapq.heapify(heap)
        while heap:
            _, k, left, right, new = heapq.heappop(heap)
            j = after[k]
            if held[k] != left or j < 0 or held[j] != right:
                continue
            held[k], held[j], after[k] = new, None, after[j]
            if after[j] >= 0:
                before[after[j]] = k
            for i in (before[k], k):
                if i >= 0 and after[i] >= 0:
                    m = int(self.pairs(np.array([held[i]]), np.array([held[after[i]]]))[0])
                    if m >= 0:
                        heapq.heappush(heap, (int(self.rank[m]), i, held[i], held[after[i]], int(self.merged[m])))
        return np.array([s for s in held if s is not None], np.int32)

    def learn(self, words: list[bytes]) -> list[bytes]:
        """The ids of words given as the bytes of their code points."""
        points = np.frombuffer(b"".join(words), np.uint32)
        length = np.fromiter(map(len, words), np.int64, len(words)) // 4
        word = np.repeat(np.arange(len(words), dtype=np.int32), length)
        symbols, long = self.char[points], np.repeat(length > LONG, length)
        found, number = self.rounds(symbols[~long], word[~long])
        if long.any():
            for k in np.flatnonzero(length > LONG):
                own = self.one_by_one(symbols[word == k])
                found, number = np.r_[found, own], np.r_[number, np.full(len(own), k, np.int32)]
            order = np.argsort(number, kind="stable")
            found, number = found[order], number[order]
        odd = np.flatnonzero((found < 0) | (found >= self.size))
        if len(odd):
            texts = [chr(-1 - s) if s < 0 else self.char_of[s] for s in found[odd].tolist()]
            parts = [np.frombuffer(t.encode("utf-8", "surrogatepass"), np.uint8) for t in texts]
            size = np.ones(len(found), np.int64)
            size[odd] = [len(p) for p in parts]
            first = np.cumsum(size) - size
            found, number = np.repeat(found, size), np.repeat(number, size)
            at = np.repeat(first[odd], size[odd]) + np.concatenate([np.arange(len(p)) for p in parts])
            found[at] = self.byte_id[np.concatenate(parts)]
        data = found.astype(np.int32).tobytes()
        ends = (4 * np.cumsum(np.bincount(number, minlength=len(words)))).tolist()
        return [data[a:b] for a, b in zip([0, *ends], ends)]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts one after another, and where each text's ids end."""
        points = np.frombuffer("".join("▁" + t if t else "" for t in texts).encode("utf-32-le", "surrogatepass"), np.uint32).copy()
        points[points == 0x20] = _SPACE
        length = np.array([len(t) + 1 if t else 0 for t in texts], np.int64)
        ends = np.cumsum(length)
        if not len(points):
            return np.empty(0, np.int32), ends
        cut = np.r_[True, ~self.joined[self._hash(points[:-1].astype(np.int64), points[1:].astype(np.int64))]]
        cut[(ends - length)[length > 0]] = True
        edges = np.r_[0, np.cumsum(cut)][ends]
        return self.memory.encode(points, 4 * np.flatnonzero(cut), edges)

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> list[str]:
        """The texts of rows of ids that stand one after another and stop at `ends`."""
        ids = np.where((ids < 0) | (ids >= self.size), self.size, ids)
        data = gathered(self.flat, self.first[ids], self.width[ids]).tobytes()
        edges = np.r_[0, np.cumsum(self.width[ids])]
        shown = np.r_[np.flatnonzero(~self.control[ids]), len(ids)]
        out = []
        for a, b in zip([0, *ends.tolist()], ends.tolist()):
            first = int(shown[np.searchsorted(shown, a)])
            skip = 1 if first < b and self.leads[ids[first]] else 0
            out.append(data[int(edges[a]) + skip : int(edges[b])].decode("utf-8", "sparkdeck.one_each"))
        return out


_loaded: dict[int, Model] = {}


def model_of(data: bytes) -> Model:
    """One model per Python worker."""
    key = hash(data)
    if key not in _loaded:
        _loaded[key] = Model(data)
    return _loaded[key]


def read_file(path: str) -> bytes:
    """The model file, read where the driver runs; tasks get its bytes."""
    with open(path, "rb") as f:
        return f.read()


def _encoded(model: Model, texts: pa.Array, end: bool) -> pa.Array:
    plain = [t or "" for t in texts.to_pylist()]
    parts = []
    for i, j in portions([len(t) for t in plain], TOGETHER):
        ids, ends = model.encode(plain[i:j])
        if end:
            ids, ends = np.insert(ids, ends, model.end), ends + np.arange(1, j - i + 1)
        parts.append(pa.ListArray.from_arrays(pa.array(np.r_[0, ends].astype(np.int32)), pa.array(ids, pa.int32())))
    return pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.int32()))


def _decoded(model: Model, ids: pa.Array) -> pa.Array:
    out: list[str] = []
    sizes = np.nan_to_num(pc.list_value_length(ids).to_numpy(zero_copy_only=False)).astype(np.int64).tolist()
    for i, j in portions(sizes, TOGETHER // 4):
        flat = ids.slice(i, j - i).flatten().to_numpy(zero_copy_only=False)
        out += model.decode(flat, np.cumsum(sizes[i:j]))
    return pa.array(out, pa.string())


def encode(text: Column, model: bytes, end: bool = True) -> Column:
    """Column array<int>: the ids of a text column, with the end id if `end`. `model` is the content of a model file."""

    @F.arrow_udf("array<int>")
    def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield _encoded(model_of(model), batch, end)

    return ids(text)


def decode(ids: Column, model: bytes) -> Column:
    """Column string: the text of an array<int> column."""

    @F.arrow_udf("string")
    def text(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield _decoded(model_of(model), batch)

    return text(ids)


def round_trip(text: Column, model: bytes, end: bool = True) -> Column:
    """Column struct(ids, text): the ids, and the text decoded from them, by one worker with one model."""

    @F.arrow_udf("ids array<int>, text string")
    def both(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            ids = _encoded(model_of(model), batch, end)
            yield pa.StructArray.from_arrays([ids, _decoded(model_of(model), ids)], ["ids", "text"])

    return both(text)
