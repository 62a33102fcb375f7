"""Texts cut into words of which each distinct one is encoded once and remembered by the task.

Arrays instead of lists: a batch of texts is one flat array with cut positions, Arrow numbers the distinct
words, and the ids of all words are gathered from those of the distinct ones.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

#: words a task remembers, twice
REMEMBERED = 150_000


class Memory:
    """Ids of words as the bytes of 32-bit numbers, in two generations."""

    def __init__(self, learn: Callable[[list[bytes]], list[bytes]]):
        self.learn = learn
        self.known: dict[bytes, bytes] = {}
        self.former: dict[bytes, bytes] = {}

    def ids_of(self, words: list[bytes]) -> list[bytes]:
        if len(self.known) > REMEMBERED:  # what is not asked for again is forgotten one round later
            self.known, self.former = {}, self.known
        known = self.known
        new = [w for w in words if w not in known]
        if new and self.former:
            again = [w for w in new if w in self.former]
            known.update((w, self.former[w]) for w in again)
            new = [w for w in new if w not in known]
        if new:
            known.update(zip(new, self.learn(new)))
        return [known[w] for w in words]

    def encode(self, data: np.ndarray, starts: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and where each text's ids end.

        `data` holds the texts one after another, `starts` the byte at which each word begins, ascending, and
        `edges` the number of words before the end of each text.
        """
        if not len(starts):
            return np.empty(0, np.int32), np.zeros(len(edges), np.int64)
        offsets = np.r_[starts, data.nbytes].astype(np.int32)
        words = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)]).dictionary_encode()
        codes, found = words.indices.to_numpy(), self.ids_of(words.dictionary.to_pylist())
        size = np.fromiter(map(len, found), np.int64, len(found)) // 4
        flat, first = np.frombuffer(b"".join(found), np.int32), np.cumsum(size) - size
        return gathered(flat, first[codes], size[codes]), np.r_[0, np.cumsum(size[codes])][edges]


def gathered(flat: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The runs of `flat` that begin at `first` and have `size` entries, one after another."""
    stop = np.cumsum(size)
    return flat[np.repeat(first - (stop - size), size) + np.arange(stop[-1] if len(stop) else 0)]


def portions(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of neighbours of about `most` in all; a larger one stands alone."""
    start, held = 0, 0
    for k, n in enumerate(sizes):
        if held and held + n > most:
            yield start, k
            start, held = k, 0
        held += n
    if sizes:
        yield start, len(sizes)
