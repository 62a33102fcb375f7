"""Byte-level BPE with forced boundaries.

A pair of bytes that stands next to each other in no token of the vocabulary can never be merged, so a text
may be cut between them. Cuts are taken where such a pair is also no danger to the rule that splits words
before merging: before white space that follows something else, between two ASCII letters, and where ASCII
letters, digits and other signs meet, which is where that rule splits anyway, but never between an apostrophe and a letter. (Any other place
could change how the rule reads what follows, such as an apostrophe among signs.) The fragments
are encoded independently, each distinct one once per task as long as the task's memory of fragments
lasts, and the ids are put together again. Strings of added tokens are taken out first, as the tokenizer
itself does.

The result is that of the tokenizer with add_special_tokens=False, without truncation or padding. Decoding puts
the tokens' bytes together; bytes that are no UTF-8 become the replacement character.

Odd cases: a null or empty text has no ids; null ids decode to the empty text, ids outside the vocabulary are
left out. Very long texts without a cut are one fragment. Vocabularies with other rules (no split into words, dropout, unknown tokens, word
marks) are refused, and a token across a cut raises an error. All of it is a column expression, so no row moves
and other columns are not touched.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from itertools import chain, filterfalse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

#: fragments that a task remembers, twice; fragments put together for one call of the tokenizer
REMEMBERED, TOGETHER = 100_000, 500
#: bytes of the texts that are worked on at a time
OUT = 1 << 20


def byte_of_char() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary, by its published rule."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    table = {chr(b): b for b in plain}
    rest = [b for b in range(256) if b not in plain]
    return table | {chr(256 + k): b for k, b in enumerate(rest)}


class Vocabulary:
    """What a task needs of a tokenizer file."""

    def __init__(self, text: str):
        data = json.loads(text)
        pre, model = data.get("pre_tokenizer") or {}, data["model"]
        added = data.get("added_tokens") or []
        if model.get("type") != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or data.get("normalizer"):
            raise ValueError("only byte-level BPE without normalizer and prefix space")
        plain = (None, False, 0, 0.0, "")
        settings = ("dropout", "ignore_merges", "byte_fallback", "fuse_unk", "unk_token", "continuing_subword_prefix", "end_of_word_suffix")
        if not pre.get("use_regex", True) or any(model.get(k) not in plain for k in settings):
            raise ValueError("only the usual split into words and merges without dropout, word marks or unknown tokens")
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in added):
            raise ValueError("added tokens that take their surroundings are not supported")
        data["truncation"] = data["padding"] = None
        self.text = json.dumps(data)
        table = byte_of_char()
        self.bytes_of = {i: bytes(table[c] for c in t) for t, i in model["vocab"].items() if all(c in table for c in t)}
        self.bytes_of |= {t["id"]: t["content"].encode() for t in added}
        self.added = {t["content"].encode(): t["id"] for t in added}
        self.cuts = self._cuts([self.bytes_of[i] for i in model["vocab"].values() if i in self.bytes_of])
        contents = sorted(self.added, key=len, reverse=True)
        self.split = re.compile(b"(" + b"|".join(map(re.escape, contents)) + b")") if contents else None
        self.known: dict[bytes, bytes] = {}
        self.former: dict[bytes, bytes] = {}
        self.tokenizer = None
        # the bytes of all tokens in one array, for decoding; ids that the vocabulary lacks have none
        table = [self.bytes_of.get(i, b"") for i in range(max(self.bytes_of, default=-1) + 2)]
        self.size = np.array([len(t) for t in table], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.flat = np.frombuffer(b"".join(table), np.uint8)

    @staticmethod
    def _cuts(tokens: list[bytes]) -> np.ndarray:
        """For each pair of bytes (first * 256 + second) whether a text is cut between them."""
        inside = np.zeros(1 << 16, bool)
        for t in tokens:
            b = np.frombuffer(t, np.uint8).astype(np.int64)
            inside[b[:-1] * 256 + b[1:]] = True
        byte = np.arange(256)
        blank = (byte == 32) | ((byte >= 9) & (byte <= 13))
        letter = ((byte | 32) >= ord("a")) & ((byte | 32) <= ord("z"))
        kind = np.where(letter, 1, np.where((byte >= ord("0")) & (byte <= ord("9")), 2, 3))
        shown = (byte < 128) & ~blank
        apart = (kind[:, None] != kind[None, :]) | (letter[:, None] & letter[None, :])
        apart[ord("'"), letter] = False  # an apostrophe may begin a word of its own, such as 's
        safe = (~blank[:, None] & blank[None, :]) | (shown[:, None] & shown[None, :] & apart)
        return ~inside & safe.ravel()

    def fragments(self, data: bytes) -> list[bytes]:
        if len(data) < 2:
            return [data] if data else []
        b = np.frombuffer(data, np.uint8).astype(np.uint16)
        at = (np.flatnonzero(self.cuts[(b[:-1] << 8) | b[1:]]) + 1).tolist()
        return [data[i:j] for i, j in zip([0, *at], [*at, len(data)])]

    def pieces(self, data: bytes) -> list[bytes]:
        """Fragments and added tokens of a text, in order."""
        if self.split is None:
            return self.fragments(data)
        parts = self.split.split(data)
        if len(parts) == 1:
            return self.fragments(data)
        return [f for k, p in enumerate(parts) for f in ([p] if k % 2 else self.fragments(p))]

    def learn(self, fragments: list[bytes]) -> None:
        """Encode fragments and remember their ids, as the bytes of 32-bit numbers.

        Fragments that may stand side by side (a cut lies between them) are put together for one call; the
        lengths of the tokens tell whose ids are whose.
        """
        if self.tokenizer is None:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer

            self.tokenizer = Tokenizer.from_str(self.text)
        many = getattr(self.tokenizer, "encode_batch_fast", self.tokenizer.encode_batch)  # without offsets
        runs: list[list[bytes]] = []
        for f in fragments:
            if runs and len(runs[-1]) < TOGETHER and self.cuts[runs[-1][-1][-1] << 8 | f[0]]:
                runs[-1].append(f)
            else:
                runs.append([f])
        for k in range(0, len(runs), 64):
            some = runs[k : k + 64]
            for run, code in zip(some, many([b"".join(r).decode() for r in some], add_special_tokens=False)):
                ids = np.array(code.ids, np.int32)
                reached, wanted = np.cumsum(self.size[ids]), np.cumsum([len(f) for f in run])
                ends = np.searchsorted(reached, wanted) + 1
                if not np.array_equal(reached[ends - 1], wanted):
                    raise ValueError("a token stands across a cut")
                data = ids.tobytes()
                self.known.update((f, data[4 * a : 4 * b]) for f, a, b in zip(run, [0, *ends.tolist()], ends.tolist()))

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        """The ids of each text."""
        if len(self.known) > REMEMBERED:  # what is not asked for again is forgotten one round later
            self.known, self.former = {}, self.known
        self.known.update((t, np.array([i], np.int32).tobytes()) for t, i in self.added.items())
        split = [self.pieces(t) for t in texts]
        new = set(filterfalse(self.known.__contains__, chain.from_iterable(split)))
        if self.former:
            again = new.intersection(self.former)
            self.known.update((f, self.former[f]) for f in again)
            new -= again
        self.learn(list(new))
        get = self.known.__getitem__
        return [np.frombuffer(b"".join(map(get, p)), np.int32) for p in split]

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> list[str]:
        """The texts of rows of ids that stand one after another and stop at `ends`."""
        ids = np.where((ids < 0) | (ids >= len(self.size)), len(self.size) - 1, ids)
        size = self.size[ids]
        stop = np.cumsum(size)
        at = np.repeat(self.start[ids] - (stop - size), size) + np.arange(stop[-1] if len(stop) else 0)
        data = self.flat[at].tobytes()
        edges = np.r_[0, stop][np.r_[0, ends]].tolist()
        return [data[a:b].decode("utf-8", "replace") for a, b in zip(edges, edges[1:])]


_loaded: dict[int, Vocabulary] = {}


def _vocabulary(text: str) -> Vocabulary:
    """One vocabulary per Python worker."""
    key = hash(text)
    if key not in _loaded:
        _loaded[key] = Vocabulary(text)
    return _loaded[key]


def read_file(path: str) -> str:
    """The tokenizer file, read where the driver runs; tasks get its text."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def _portions(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    start, held = 0, 0
    for k, n in enumerate(sizes):
        if held and held + n > most:
            yield start, k
            start, held = k, 0
        held += n
    if sizes:
        yield start, len(sizes)


def _encoded(vocabulary: Vocabulary, texts: pa.Array) -> pa.Array:
    """Lists of ids of an array of texts."""
    plain = [t or b"" for t in texts.cast(pa.binary()).to_pylist()]
    parts = []
    for i, j in _portions([len(t) for t in plain], OUT):
        found = vocabulary.encode(plain[i:j])
        ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
        parts.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(found), pa.int32())))
    return pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.int32()))


def _decoded(vocabulary: Vocabulary, ids: pa.Array) -> pa.Array:
    """Texts of an array of lists of ids."""
    out: list[str] = []
    sizes = np.nan_to_num(pc.list_value_length(ids).to_numpy(zero_copy_only=False)).astype(np.int64).tolist()
    for i, j in _portions(sizes, OUT // 4):
        flat = ids.slice(i, j - i).flatten().to_numpy(zero_copy_only=False)
        out += vocabulary.decode(flat, np.cumsum(sizes[i:j]))
    return pa.array(out, pa.string())


def encode(text: Column, tokenizer: str) -> Column:
    """Column array<int>: the ids of a text column. `tokenizer` is the content of a tokenizer file."""

    @F.arrow_udf("array<int>")
    def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield _encoded(_vocabulary(tokenizer), batch)

    return ids(text)


def decode(ids: Column, tokenizer: str) -> Column:
    """Column string: the text of an array<int> column."""

    @F.arrow_udf("string")
    def text(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield _decoded(_vocabulary(tokenizer), batch)

    return text(ids)


def round_trip(text: Column, tokenizer: str) -> Column:
    """Column struct(ids, text): the ids, and the text decoded from them, by one worker with one vocabulary."""

    @F.arrow_udf("ids array<int>, text string")
    def both(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            ids = _encoded(_vocabulary(tokenizer), batch)
            yield pa.StructArray.from_arrays([ids, _decoded(_vocabulary(tokenizer), ids)], ["ids", "text"])

    return both(text)
