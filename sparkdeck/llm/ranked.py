"""Ranked lexical search by pipelined term partitioning.

Terms of documents are counted once into postings, a row per term and block of `BLOCK` documents. Only the
postings of terms that an item asks for are kept. Terms are dealt over `len(SHARES) + 1` owners by the share of documents
that hold them, rarest first. Items stand in bundles of at most about `ITEMS`; a bundle visits the owners one
after another, block by block, as a cogroup of its accumulators with the owner's postings of that block: each term adds
weight times integer quotient for all its items and documents at once, and the accumulators go on to the next owner.

Accumulators are sparse. After each owner, one is dropped whose sum, with the most that the later owners can add,
stays below the 20th sum of its item in the block: it cannot be among the best any more, so nothing is lost. (If a later owner opens it
again, its sum is too low to matter as well.) After the last owner each block has its best `top`, and the best of those are the result.

Scores are those of the contract: w = floor(1000 ln((2N + 2) / (2 df + 1))) in doubles, everything else 64-bit
integers, sums of w * ((1000000000 tf) div (1000 tf + 12 m)) with m = 100 - 25 + (25 n N) div L.

Odd cases: a null or empty text has no terms, whether a document's or an item's, and such an item has no
result. Equal scores go by ascending id, null ids first. Rows that repeat an id are documents of their own. Items that repeat
both id and text are one item; other texts under the same id are ranked by themselves. Very long texts are one row like others. Empty
tables give an empty result. Only the named columns are read.

Scale: the accumulators of a task are those of one bundle and one block, `ITEMS` times `BLOCK` at the most, whatever a term's number of
postings. Terms of items are joined by their measured size; no hint is used.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored

#: documents of a block, bytes of their texts at most, items of a bundle
BLOCK, BYTES, ITEMS = 1024, 1 << 23, 256
#: a term belongs to the first owner whose share of documents it does not exceed, else to the last
SHARES = (1 / 64, 1 / 12, 1 / 3)

_TERM = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
POSTINGS = pa.schema(
    [("block", pa.int64()), ("term", pa.string()), ("docs", pa.list_(pa.int32())), ("tfs", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())),
     ("ids", pa.list_(pa.int64())), ("with_terms", pa.int64()), ("all_terms", pa.int64())]
)
POSTINGS_SQL = (
    "block long, term string, docs array<int>, tfs array<long>, lengths array<long>, ids array<long>, with_terms long, all_terms long"
)
STATE = pa.schema(
    [("bundle", pa.int32()), ("block", pa.int64()), ("item", pa.int32()), ("rest", pa.list_(pa.int64())), ("docs", pa.list_(pa.int32())),
     ("scores", pa.list_(pa.int64()))]
)
STATE_SQL = "bundle int, block long, item int, rest array<long>, docs array<int>, scores array<long>"


def terms(text: str | None) -> list[bytes]:
    """The terms of a text, A-Z lower-cased."""
    return _TERM.findall((text or "").encode().lower())


def _block(number: int, rows: list[tuple[int | None, Counter]]) -> pa.RecordBatch:
    """A row per term, and one without term that names the documents and counts their terms."""
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0))
    held: dict[bytes, list] = defaultdict(list)
    lengths = [c.total() for _, c in rows]
    for k, (_, counted) in enumerate(rows):
        for term, times in counted.items():
            held[term].append((k, times))
    sizes = list(map(len, held.values()))
    docs = np.array([k for p in held.values() for k, _ in p], np.int32)
    tfs = np.array([t for p in held.values() for _, t in p], np.int64)
    offsets = pa.array(np.r_[0, np.cumsum(sizes, dtype=np.int64), sum(sizes)].astype(np.int32))
    n = len(sizes) + 1

    def lists(values: np.ndarray) -> pa.Array:
        return pa.ListArray.from_arrays(offsets, pa.array(values))

    def last(value, kind) -> pa.Array:
        return pa.concat_arrays([pa.nulls(n - 1, kind), pa.array([value], kind)])

    columns = [
        pa.array([number] * n, pa.int64()), pa.array([*map(bytes.decode, held), None], pa.string()),
        lists(docs), lists(tfs), lists(np.array(lengths, np.int64)[docs]),
        last([i for i, _ in rows], pa.list_(pa.int64())), last(sum(x > 0 for x in lengths), pa.int64()), last(sum(lengths), pa.int64()),
    ]
    return pa.RecordBatch.from_arrays(columns, schema=POSTINGS)


def _postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    context = TaskContext.get()
    number, rows, size = (context.partitionId() if context else 0) << 32, [], 0
    for batch in batches:
        for doc, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist()):
            rows.append((doc, Counter(terms(text))))
            size += len(text or "")
            if len(rows) == BLOCK or size >= BYTES:
                yield _block(number, rows)
                number, rows, size = number + 1, [], 0
    if rows:
        yield _block(number, rows)


def asked_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(bundle, item, name, text, term, times): the terms of each distinct item, which has a number in its bundle."""
    rows = items.select(F.col(id_col).alias("name"), F.col(text_col).cast("string").alias("text")).distinct()
    bundles = max(1, -(-rows.count() // ITEMS))
    rows = rows.withColumn("bundle", F.pmod(F.xxhash64("name", "text"), F.lit(bundles)).cast("int"))
    # a bundle is bounded, so its numbers are given in one task
    order = Window.partitionBy("bundle").orderBy("name", "text")
    rows = rows.withColumn("item", F.row_number().over(order) - 1)
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    found = rows.withColumn("term", F.explode(F.regexp_extract_all(lower, F.lit(r"([0-9A-Za-z\x{80}-\x{10FFFF}]+)"), 1)))
    return found.groupBy("bundle", "item", "name", "term").agg(F.count(F.lit(1)).alias("times"))


def weight(documents: int) -> Column:
    return F.floor(F.lit(1000.0) * F.log(F.lit(2.0 * documents + 2.0) / (F.lit(2.0) * F.col("df") + F.lit(1.0)))).cast("long")


def _stage(owner: int, documents: int, words: int, top: int):
    """Add what one owner's terms contribute to the accumulators of a bundle in a block."""

    def run(state: pa.Table, postings: pa.Table) -> pa.Table:
        if not state.num_rows:
            return state.select(STATE.names).cast(STATE)
        rows, asked = state.to_pydict(), postings.to_pydict()
        place = {item: k for k, item in enumerate(rows["item"])}
        width = 1 + max([d[-1] for d in (*rows["docs"], *asked["docs"]) if d], default=-1)
        sums = np.zeros((len(place), width), np.int64)
        for k, (docs, scores) in enumerate(zip(rows["docs"], rows["scores"])):
            sums[k, docs] = scores
        for docs, tfs, lengths, w, items, times in zip(*(asked[c] for c in ("docs", "tfs", "lengths", "w", "items", "times"))):
            tf, n = np.array(tfs, np.int64), np.array(lengths, np.int64)
            m = 75 + (25 * n * documents) // words
            part = w * ((1000000000 * tf) // (1000 * tf + 12 * m))
            held = [place[i] for i in items]
            sums[np.ix_(held, docs)] += np.array(times, np.int64)[:, None] * part[None, :]
        rest = np.array([r[owner] for r in rows["rest"]], np.int64)
        least = np.partition(sums, width - top, axis=1)[:, width - top] if width >= top else np.zeros(len(place), np.int64)
        keep = (sums > 0) & (sums + rest[:, None] >= least[:, None])
        found = [np.flatnonzero(k) for k in keep]
        if owner == len(SHARES):  # documents are numbered by id, so ties go to the smaller one
            found = [np.sort(f[np.lexsort((f, -sums[k, f]))[:top]]) for k, f in enumerate(found)]
        offsets = pa.array(np.cumsum([0, *map(len, found)]).astype(np.int32))
        docs, scores = np.concatenate(found), np.concatenate([sums[k, f] for k, f in enumerate(found)])
        columns = {c: pa.array(rows[c], STATE.field(c).type) for c in ("bundle", "block", "item", "rest")}
        columns |= {"docs": pa.ListArray.from_arrays(offsets, pa.array(docs, pa.int32())), "scores": pa.ListArray.from_arrays(offsets, pa.array(scores))}
        return pa.table(columns, STATE)

    return run


def rank(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
    top: int = 20,
) -> DataFrame:
    """(item_id, rank, doc_id, score): the best `top` documents of each item, scores above 0 only."""
    asked = stored(asked_terms(items, item_col, item_text_col), "asked")
    wanted = asked.select(F.col("term").alias("wanted")).distinct()
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    found = rows.mapInArrow(_postings, POSTINGS_SQL).join(wanted, F.col("term") == F.col("wanted"), "left")
    found = stored(found.filter("term is null or wanted is not null").drop("wanted"), "postings")
    blocks, postings = found.filter("term is null").select("block", "ids", "with_terms", "all_terms"), found.filter("term is not null")
    documents, words = blocks.agg(F.coalesce(F.sum("with_terms"), F.lit(0)), F.coalesce(F.sum("all_terms"), F.lit(0))).first()

    owner = F.lit(len(SHARES))
    for k in reversed(range(len(SHARES))):
        owner = F.when(F.col("df") <= F.lit(SHARES[k] * documents), F.lit(k)).otherwise(owner)
    known = postings.groupBy("term").agg(F.sum(F.size("docs")).alias("df"), F.max(F.array_max("tfs")).alias("most"))
    known = known.withColumns({"w": weight(documents), "owner": owner.cast("int")})
    # the largest quotient that any document can have for the term: m is 75 at least
    known = stored(known.withColumn("most", F.expr("w * ((1000000000 * most) div (1000 * most + 900))")).withColumnRenamed("term", "known"), "terms")

    parts = asked.join(known, F.col("term") == F.col("known"))
    held = parts.groupBy("bundle", F.col("term").alias("known"), "w", "owner").agg(F.collect_list(F.struct("item", "times")).alias("held"))
    held = held.select("bundle", "known", "w", "owner", F.col("held.item").alias("items"), F.col("held.times").alias("times"))
    owned = postings.join(held, F.col("term") == F.col("known"))
    owned = stored(owned.select("bundle", "block", "owner", "docs", "tfs", "lengths", "w", "items", "times"), "owned")

    # what the owners after each can still add to an item
    later = [F.sum(F.when(F.col("owner") > k, F.col("times") * F.col("most")).otherwise(0)).alias(f"rest{k}") for k in range(len(SHARES) + 1)]
    bounds = parts.groupBy("bundle", "item").agg(*later)
    bounds = bounds.select(F.col("bundle").alias("of"), "item", F.array(*[f"rest{k}" for k in range(len(SHARES) + 1)]).alias("rest"))
    state = owned.select("bundle", "block").distinct().join(bounds, F.col("bundle") == F.col("of")).select(
        "bundle", "block", "item", "rest", F.array().cast("array<int>").alias("docs"), F.array().cast("array<long>").alias("scores")
    )
    for k in range(len(SHARES) + 1):
        own = owned.filter(F.col("owner") == k)
        own = own.select(F.col("bundle").alias("to"), F.col("block").alias("at"), "docs", "tfs", "lengths", "w", "items", "times")
        state = state.groupBy("bundle", "block").cogroup(own.groupBy("to", "at")).applyInArrow(_stage(k, documents, words, top), STATE_SQL)

    best = state.select("bundle", "block", "item", F.inline(F.arrays_zip("docs", "scores")))
    named = blocks.select(F.col("block").alias("of"), "ids")
    best = best.join(named, F.col("block") == F.col("of"))
    best = best.select("bundle", "item", "block", F.col("docs").alias("doc"), F.get("ids", F.col("docs")).alias("doc_id"), F.col("scores").alias("score"))
    order = Window.partitionBy("bundle", "item").orderBy(F.desc("score"), "doc_id", "block", "doc")
    best = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    names = asked.select(F.col("bundle").alias("b"), F.col("item").alias("i"), F.col("name").alias("item_id")).distinct()
    best = best.join(names, (F.col("bundle") == F.col("b")) & (F.col("item") == F.col("i")))
    return best.select("item_id", "rank", "doc_id", "score")
