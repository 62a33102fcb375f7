"""Registered queries against their SQL or a plain version, on whole tables."""

import hashlib
import os
import re
from collections import Counter

import brute
import duckdb
import pytest
from compare import compare, database

from sparkdeck.llm.queries import CHECKS, QUERIES, tokenizer_path


@pytest.fixture(scope="module")
def db(sf_dir):
    return database(sf_dir)


@pytest.fixture(scope="module")
def docs(sf_dir):
    return duckdb.sql(f"SELECT doc_id, text, source, lang FROM '{sf_dir}/documents.parquet'").fetchall()


def test_names():
    numbers = [re.match(r"op(\d+)_", name).group(1) for name in QUERIES]
    assert sorted(map(int, numbers)) == list(range(1, 14))


@pytest.mark.parametrize("name", list(CHECKS))
def test_against_sql(spark, sf_dir, db, name):
    assert compare(QUERIES[name](spark, sf_dir), db, CHECKS[name]) == ""


def test_mixing(spark, sf_dir, docs):
    rows = QUERIES["op1_mixing"](spark, sf_dir).collect()
    again = QUERIES["op1_mixing"](spark, sf_dir).collect()
    assert sorted(rows) == sorted(again) and len(rows) == len(docs)
    size = {d: len(re.findall("[^\x20\x09-\x0d]+", text or "")) for d, text, _, _ in docs}
    sources, taken, largest = Counter(), Counter(), Counter()
    for d, _, source, _ in docs:
        sources[source] += size[d]
        largest[source] = max(largest[source], size[d])
    aims = brute.source_targets(sources)
    assert abs(sum(aims.values()) - sum(sources.values())) < 1e-6 * sum(sources.values())
    for r in rows:
        assert r.size == size[r.doc_id] and r.source_size == sources[r.source]
        assert abs(r.target - aims[r.source]) < 1e-9 * max(1, aims[r.source])
        assert r.taken <= 3 * r.size and (r.size == 0 or r.taken % r.size == 0)
        taken[r.source] += r.taken
    for source, aim in aims.items():
        assert abs(taken[source] - aim) <= largest[source]


def test_bpe(spark, sf_dir, docs):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    found = {r.doc_id: r for r in QUERIES["op4_bpe"](spark, sf_dir).collect()}
    assert len(found) == len(docs)
    for doc, text, _, _ in docs:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        r = found[doc]
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == brute.sha(tokenizer.decode(ids, skip_special_tokens=False))


def test_embeddings(spark, sf_dir):
    rows = duckdb.sql(f"SELECT vec_id, embedding, label FROM '{sf_dir}/embeddings.parquet'").fetchall()
    found = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in QUERIES["op6_embeddings"](spark, sf_dir).collect()}
    assert found == {k: (n, c, k == c) for k, (n, c) in brute.vector_links(rows).items()}


def test_near(spark, sf_dir, docs):
    found = {r.doc_id: (r.class_id, r.kept) for r in QUERIES["op8_near"](spark, sf_dir).collect()}
    want = brute.near_classes([d[:2] for d in docs])
    assert found == {k: (c, k == c) for k, c in want.items()}
    assert any(k != c for k, c in want.items())


def test_language(spark, sf_dir, docs):
    import zlib

    found = {r.doc_id: r for r in QUERIES["op10_language"](spark, sf_dir).collect()}
    assert len(found) == len(docs)
    right = asked = 0
    for doc, text, _, lang in docs:
        r = found[doc]
        assert r.held_out == (zlib.crc32(str(doc).encode()) % 4 == 2) and 0 <= r.score <= 1
        if not any(c.isalpha() for c in text or ""):
            assert r.lang_pred == "und"
        elif r.held_out and lang:
            asked += 1
            right += r.lang_pred == lang
    assert asked and right >= 0.95 * asked


def test_no_python_on_native_paths():
    folder = os.path.dirname(QUERIES["op1_mixing"].__wrapped__.__code__.co_filename)
    for name in ("mixing", "chat"):
        text = open(os.path.join(folder, f"{name}.py")).read()
        assert not re.search(r"udf|pandas|InArrow|\.rdd", text), name
