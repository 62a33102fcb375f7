"""Ranked search, SentencePiece and alignment against plain versions and the library."""

import hashlib
import random

import brute
import numpy as np
import pytest
import sentencepiece
from odd_tables import TYPES, long_text, odd_rows
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sparkdeck.llm import align, bpe, pieces, ranked
from sparkdeck.llm.queries import QUERIES, model_path, tokenizer_path

MODEL, TOKENIZER = pieces.read_file(model_path()), bpe.read_file(tokenizer_path())


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_proto=MODEL)


@pytest.fixture(scope="module")
def model():
    return pieces.Model(MODEL)


def same(model, library, texts):
    ids, ends = model.encode(texts)
    starts = [0, *ends.tolist()]
    want = library.encode(texts)
    for k, w in enumerate(want):
        assert ids[starts[k] : starts[k + 1]].tolist() == w, texts[k][:80]
    assert model.decode(ids, ends) == [library.decode(w) for w in want]


@pytest.mark.parametrize("letters", ["ab", "aab ", "▁ a", " \n\tthe", "lower newest widest ", "0x<>/s", "éàùç你好🙂 a", "\x00퟿ ﬁ"])
def test_rounds_are_the_library(model, library, letters):
    r = random.Random(7)
    same(model, library, ["".join(r.choice(letters) for _ in range(r.randint(0, 70))) for _ in range(1500)])


@pytest.mark.parametrize("size", [pieces.LONG - 2, pieces.LONG - 1, pieces.LONG, 5 * pieces.LONG])
def test_long_words(model, library, size):
    r = random.Random(size)
    same(model, library, [" " * size, "a" * size, "".join(r.choice("abcdefgh") for _ in range(size)), "the" * size])


def test_heap_and_rounds_agree(model):
    r = random.Random(3)
    for _ in range(300):
        points = np.array([ord(r.choice("▁▁theinr ")) for _ in range(r.randint(1, 60))])
        symbols = model.char[points]
        found, _ = model.rounds(symbols, np.zeros(len(symbols), np.int32))
        assert found.tolist() == model.one_by_one(symbols).tolist()


def test_any_ids_decode(model, library):
    r = random.Random(5)
    rows = [[r.randrange(r.choice([300, 32000])) for _ in range(r.randint(0, 20))] for _ in range(3000)]
    got = model.decode(np.array([i for x in rows for i in x]), np.cumsum([len(x) for x in rows]))
    assert got == [library.decode(x) for x in rows]


def test_other_models_are_refused():
    with pytest.raises(ValueError):
        pieces._check(MODEL.replace(b"\x18\x01 \x00", b"\x18\x01 \x01"))
    with pytest.raises(ValueError):
        pieces._check(MODEL.replace(b"\x18\x01 \x00", b"\x18\x00 \x00"))


def test_pieces_of_odd_rows(spark, odd, empty, library):
    found = odd.withColumn("found", pieces.round_trip(F.col("text"), MODEL)).select("doc_id", "text", "found.*").toDF("doc_id", "plain", "ids", "text")
    for r in found.collect():
        want = library.encode(r.plain or "", add_eos=True)
        assert r.ids == want and r.text == library.decode(want)
    parts = odd.select("doc_id", "text", pieces.encode("text", MODEL, end=False).alias("ids"))
    for r in parts.withColumn("again", pieces.decode("ids", MODEL)).collect():
        assert r.ids == library.encode(r.text or "") and r.again == library.decode(r.ids)
    assert empty.select(pieces.round_trip(F.col("text"), MODEL)).count() == 0
    lost = spark.createDataFrame([(None,), ([-1, 32000, 450],), ([],)], "ids array<int>").select(pieces.decode("ids", MODEL).alias("t"))
    assert [r.t for r in lost.collect()] == ["", library.decode([450]), ""]


def test_pieces_query(spark, sf_dir, library):
    import duckdb

    docs = dict(duckdb.sql(f"SELECT doc_id, text FROM '{sf_dir}/documents.parquet'").fetchall())
    rows = QUERIES["op12_pieces"](spark, sf_dir).collect()
    assert len(rows) == len(docs)
    for r in rows:
        ids = library.encode(docs[r.doc_id] or "", add_eos=True)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == brute.sha(library.decode(ids))


def plain_alignment(docs, library):
    tokenizer = Tokenizer.from_str(TOKENIZER)
    tokenizer.encode_special_tokens = True
    table = bpe.byte_of_char()
    a = {i: bytes(table.get(c, 0) for c in t) for t, i in tokenizer.get_vocab().items()}
    names = [library.id_to_piece(i) for i in range(library.get_piece_size())]
    b = [bytes([int(n[3:5], 16)]) if library.is_byte(i) else n.replace("▁", " ").encode() for i, n in enumerate(names)]
    return brute.alignment(docs, lambda t: tokenizer.encode(t, add_special_tokens=False).ids, library.encode, a.__getitem__, b.__getitem__)


def rows_of(found):
    return sorted((tuple(r) for r in found.collect()), key=str)


def test_alignment_query(spark, sf_dir, library):
    import duckdb

    docs = duckdb.sql(f"SELECT doc_id, text FROM '{sf_dir}/documents.parquet'").fetchall()
    assert rows_of(QUERIES["op13_alignment"](spark, sf_dir)) == sorted(plain_alignment(docs, library), key=str)


@pytest.mark.parametrize("step", [align.PIECE, 256, 40, 7])
def test_alignment_of_odd_rows(spark, odd, library, plain, step):
    """Every length of piece gives the same; ids repeat or are null; columns clash with inner names."""
    rows = odd_rows()
    rows = [r for r in rows if len(r[1] or "") < 20_000 or step > 100]
    rows += [(None, *r[1:]) for r in rows[3:30:4]] + rows[5:9]
    want = plain_alignment([r[:2] for r in rows], library)
    assert rows_of(align.align(spark.createDataFrame(rows, TYPES), TOKENIZER, MODEL, step=step)) == sorted(want, key=str)


def test_alignment_of_nothing(spark, empty):
    assert align.align(empty, TOKENIZER, MODEL).count() == 0


def test_diagonals():
    r = np.random.default_rng(1)
    for _ in range(200):
        a, b = (np.unique(r.integers(1, 60, r.integers(1, 40))) for _ in range(2))
        order = sorted([(e, 0) for e in a] + [(e, 1) for e in b])
        for step in (1, 2, 5):
            for i, j in align.divided(a, b, step):
                assert i == sum(side == 0 for _, side in order[: i + j])


def test_ranked_odd_rows(spark, odd, empty, plain):
    items = [(1, "One two THREE"), (2, None), (3, ""), (4, "w1 w2 w3 w1 text"), (5, "is long enough"), (5, "the MIT License"), (None, "four"), (1, "One two THREE")]
    table = spark.createDataFrame(items, "item_id long, text string").withColumns({"term": F.lit(1), "block": F.lit(2), "doc_id": F.lit(3)})
    rows = [*plain, *[(None, t) for _, t in plain[5:12]], *plain[6:9], *[(900 + k, "one two three four") for k in range(40)]]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"term": F.lit(1), "item_id": F.lit(2), "df": F.lit(3)})
    want = brute.ranked(rows, list(dict.fromkeys(items)))
    assert rows_of(ranked.rank(docs, table)) == sorted(want, key=str)
    assert ranked.rank(empty, table).count() == 0
    assert ranked.rank(odd, table.limit(0)).count() == 0
    assert ranked.rank(odd, table.filter("item_id in (2, 3)")).count() == 0


def test_ranked_blocks_and_bundles(spark, monkeypatch):
    """Many blocks, bundles and ties give what one does."""
    r = random.Random(2)
    words = [f"w{k}" for k in range(60)]
    docs = [(k, " ".join(r.choices(words, weights=[1 / (i + 1) for i in range(60)], k=r.randint(1, 30)))) for k in range(400)]
    docs += [(1000 + k, docs[7][1]) for k in range(100)] + [(2000, long_text(1, 500))]
    items = [(k, " ".join(r.choices(words, k=6))) for k in range(30)]
    monkeypatch.setattr(ranked, "ITEMS", 4)
    found = ranked.rank(spark.createDataFrame(docs, "doc_id long, text string").repartition(40), spark.createDataFrame(items, "item_id long, text string"), top=5)
    assert rows_of(found) == sorted(brute.ranked(docs, items, 5), key=str)
