"""Language by rank order of character n-grams.

A profile lists a language's most frequent n-grams of letters in order. A text gets the language whose
profile is nearest by out-of-place distance: the sum, over the text's own most frequent n-grams, of how far
each stands from its place in the profile, or the profile's length if it is not there.

n-grams of 1 to `LONGEST` letters are taken inside words, with one mark for the edge of a word. Whole texts
are counted. Equal counts are ordered by the n-gram's code, equal distances by the language's name.

Odd cases: a null text or one without letters is `und` with score 0; so is every text when there is
nothing to learn from. Rows whose language is null are not learned from. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored
from .common import carried, unit_interval

UNKNOWN = "und"
EDGE = 1
LONGEST = 3
#: letters of a text are counted in pieces of this many, so memory does not follow the length of a text
PIECE = 1 << 20

_letters: list[np.ndarray] = []


def _letter_table() -> np.ndarray:
    if not _letters:
        _letters.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _letters[0]


def grams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the n-grams of a text, ascending, and how often each occurs."""
    codes, counts = np.empty(0, np.uint64), np.empty(0, np.int64)
    if not text:
        return codes, counts
    points = np.frombuffer(text.lower().encode("utf-32-le"), np.uint32)
    letter = _letter_table()[points]
    if not letter.any():
        return codes, counts
    edge = ~letter
    run = np.where(letter, points & 0xFFFF, EDGE)[letter | np.r_[True, ~edge[:-1]]]  # one mark between words
    run = np.r_[EDGE, run[int(run[0] == EDGE) :], EDGE].astype(np.uint64)
    if run[-2] == EDGE:
        run = run[:-1]
    for start in range(0, len(run), PIECE):
        piece = run[start : start + PIECE + LONGEST - 1]
        found = []
        code = piece
        for n in range(1, LONGEST + 1):
            if n > 1:
                if len(piece) < n:
                    break
                code = (code[:-1] << np.uint64(16)) | piece[n - 1 :]
            found.append(code[: PIECE])
        found[0] = found[0][found[0] != EDGE]
        new, times = np.unique(np.concatenate(found), return_counts=True)
        if not len(codes):
            codes, counts = new, times
        else:
            codes, place = np.unique(np.concatenate([codes, new]), return_inverse=True)
            counts = np.bincount(place, np.concatenate([counts, times])).astype(np.int64)
    return codes, counts


def top(codes: np.ndarray, counts: np.ndarray, k: int) -> np.ndarray:
    """The k most frequent codes in order."""
    return codes[np.argsort(-counts, kind="stable")[:k]]


def held_out(id_col: str) -> Column:
    """True for rows that are never learned from: crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        for lang, rows in frame.groupby("lang"):
            found = [grams(t) for t in rows["text"]]
            codes, place = np.unique(np.concatenate([c for c, _ in found]), return_inverse=True)
            if len(codes):
                n = np.bincount(place, np.concatenate([n for _, n in found])).astype(np.int64)
                yield pd.DataFrame({"lang": lang, "code": codes.astype(np.int64), "n": n})


def learn(
    labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    train_docs: int = 4000, profile_size: int = 400,
) -> dict[str, list[int]]:
    """Language -> its most frequent n-grams in order.

    Learns from a bounded sample: about `train_docs` labelled rows of each language, chosen by a hash of the
    id. What comes to the driver is `profile_size` numbers per distinct language.
    """
    rows = labelled.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    rows = rows.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    share = rows.groupBy(F.col("lang").alias("of")).agg(F.least(F.lit(1.0), F.lit(float(train_docs)) / F.count(F.lit(1))).alias("share"))
    # languages are few, but nothing says how few: the written size of `share` decides on the join, so that texts stay where they are
    share = stored(share, "share")
    sample = rows.join(share, F.col("lang") == F.col("of")).filter(unit_interval("id", seed=10) < F.col("share"))
    counted = sample.select("lang", "text").mapInPandas(_count, "lang string, code long, n long")
    counted = counted.groupBy("lang", "code").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.col("n").desc(), "code")
    best = counted.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= profile_size)
    profiles: dict[str, list[tuple[int, int]]] = {}
    for r in best.select("lang", "place", "code").collect():
        profiles.setdefault(r["lang"], []).append((r["place"], r["code"]))
    return {lang: [code for _, code in sorted(found)] for lang, found in sorted(profiles.items())}


def nearest(text: str | None, profiles: list[tuple[str, np.ndarray, np.ndarray]], size: int) -> tuple[str, float]:
    """Language and score of one text; profiles: name, codes ascending, place of each."""
    codes, counts = grams(text)
    if not len(codes) or not profiles:
        return UNKNOWN, 0.0
    own = top(codes, counts, size)
    place = np.arange(len(own))
    best, least = UNKNOWN, 2.0
    for lang, known, ranks in profiles:
        at = np.minimum(np.searchsorted(known, own), len(known) - 1)
        off = np.where(known[at] == own, np.minimum(np.abs(ranks[at] - place), size), size)
        far = float(off.sum()) / (size * len(own))
        if far < least:
            best, least = lang, far
    return best, 1.0 - least


def predict(text_col: str, profiles: dict[str, list[int]], profile_size: int = 400) -> Column:
    """Column struct(lang_pred, score) for a text column; score is 1 minus the distance's share of its maximum."""
    ready = []
    for lang, codes in sorted(profiles.items()):
        known = np.array(codes, np.int64).astype(np.uint64)
        order = np.argsort(known)
        ready.append((lang, known[order], order))

    @F.pandas_udf("lang_pred string, score double")
    def label(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in texts:
            yield pd.DataFrame([nearest(t, ready, profile_size) for t in batch], columns=["lang_pred", "score"])

    return label(F.col(text_col))


def identify(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **bounds: int
) -> DataFrame:
    """(id, held_out, lang_pred, score) for every row, with profiles learned from the rows not held out."""
    profiles = learn(docs.filter(~held_out(id_col)), id_col, text_col, lang_col, **bounds)
    rows = docs.select(F.col(id_col).alias("id"), held_out(id_col).alias("held_out"), F.col(text_col).alias("text"))
    found = rows.select("id", "held_out", predict("text", profiles, bounds.get("profile_size", 400)).alias("found"))
    return found.select(F.col("id").alias(id_col), "held_out", "found.lang_pred", "found.score")


def keep_known(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **bounds: int) -> DataFrame:
    """The rows of `docs` whose language can be told; texts without letters and null texts go."""
    profiles = learn(docs.filter(~held_out(id_col)), id_col, text_col, lang_col, **bounds)
    found = carried(docs, found=predict(text_col, profiles, bounds.get("profile_size", 400)))
    return found.filter(F.col("found.lang_pred") != UNKNOWN).select("carried.*")
