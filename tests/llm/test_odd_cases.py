"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns, operator by operator."""

import hashlib
import re
from collections import Counter

import brute
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from odd_tables import odd_rows, odd_texts
from pyspark.sql import functions as F

from sparkdeck.llm import bpe, chat, exact, language, licences, lines, mixing, near, vectors, warc
from sparkdeck.llm.queries import tokenizer_path
from sparkdeck.session import fresh_path


# --- exact duplicates ---------------------------------------------------------------------------------

@pytest.mark.parametrize("batches", [1, 2, 4])
def test_exact(odd, plain, batches):
    found = {r.id: (r.keep_id, r.group_size, r.kept, r.digest) for r in exact.duplicates(odd, batches=batches).collect()}
    assert found == brute.exact_groups(plain)


def test_exact_keeps_one(odd, plain, repeats, empty):
    kept = sorted(r.doc_id for r in exact.keep_one(odd).collect())
    assert kept == sorted(k for k, v in brute.exact_groups(plain).items() if v[2])
    assert exact.keep_one(odd).columns == odd.columns
    again = exact.keep_one(repeats).collect()
    assert sorted(r.doc_id for r in again if r.doc_id is not None) == kept and len(again) == len(kept)
    assert exact.keep_one(empty).count() == 0 and exact.duplicates(empty).count() == 0


def test_exact_tells_texts_under_one_digest_apart(spark, odd, monkeypatch):
    """With a digest that only counts characters, rows with other bytes still form classes of their own."""
    docs = spark.createDataFrame([(1, "ab"), (2, "ab "), (3, "cd"), (4, "cd"), (5, "xyz")], "doc_id long, text string")
    monkeypatch.setattr(exact.F, "sha2", lambda c, n: F.length(c).cast("string"))
    found = {r.id: (r.keep_id, r.group_size) for r in exact.duplicates(docs, batches=2).collect()}
    assert found == {1: (2, 2), 2: (2, 2), 3: (3, 2), 4: (3, 2), 5: (5, 1)}


@given(st.sets(st.integers(0, 2**64 - 1), max_size=400), st.sets(st.integers(0, 2**64 - 1), max_size=50))
@settings(max_examples=40, deadline=None)
def test_filters_never_miss(keys, others):
    keys = np.array(sorted(keys), np.uint64)
    built = exact.build_filter(keys)
    assert exact.may_hold(keys, *built).all()
    if others:
        exact.may_hold(np.array(sorted(others), np.uint64), *built)


def test_filters_are_small_and_sharp():
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 2**63, 20_000).astype(np.uint64)
    built = exact.build_filter(keys)
    strange = rng.integers(0, 2**63, 50_000).astype(np.uint64)
    assert exact.may_hold(strange, *built).mean() < 0.006
    assert len(built[3]) < 1.4 * len(keys)


# --- near duplicates ----------------------------------------------------------------------------------

def test_near(odd, plain):
    assert {r.id: r.class_id for r in near.classes(odd).collect()} == brute.near_classes(plain)


def test_near_keeps_one(odd, plain, repeats, empty):
    want = sorted(k for k, v in brute.near_classes(plain).items() if k == v)
    kept = near.keep_one(odd)
    assert kept.columns == odd.columns and sorted(r.doc_id for r in kept.collect()) == want
    assert near.classes(repeats).count() == repeats.count()
    assert near.keep_one(empty).count() == 0


def one_of_each_class(spark, rows):
    """Checks what stays of (id, text) rows: the smallest id of each class, and every text without words."""
    kept = Counter((r.doc_id, r.text) for r in near.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert not kept - Counter(rows)
    members = {}
    for at, root in brute.near_classes([(k, text) for k, (_, text) in enumerate(rows)]).items():
        members.setdefault(root, []).append(rows[at])
    plain = Counter(row for row in rows if not brute.units(row[1]))
    assert Counter({row: n for row, n in kept.items() if not brute.units(row[1])}) == plain
    left = sum(kept.values()) - sum(plain.values())
    worded = [m for m in members.values() if brute.units(m[0][1])]
    assert left == len(worded)
    for rows_of in worded:
        stay = [row for row in set(rows_of) if row in kept]
        assert len(stay) == 1 and kept[stay[0]] == 1
        assert stay[0][0] == min((i for i, _ in rows_of), key=lambda i: (i is not None, i))


def test_near_keeps_one_where_ids_repeat(spark, repeats):
    def text(seed, changed=""):
        return " ".join(f"{chr(97 + seed)}{k}" for k in range(100)) + changed

    # id 5 on two texts: in the class {5, 9}, where it is the smallest, and in {3, 5}, where it is not
    one_of_each_class(spark, [(5, text(0)), (9, text(0, " x")), (3, text(1)), (5, text(1, " y"))])
    # near copies that share an id, copies that do, and one id on classes apart
    one_of_each_class(spark, [(7, text(2)), (7, text(2, " z")), (7, text(2)), (7, text(3)), (8, text(4))])
    # no ids at all
    one_of_each_class(spark, [(None, text(k % 3, " w" * (k % 2))) for k in range(9)] + [(None, "."), (None, "."), (None, None), (1, text(0))])
    one_of_each_class(spark, [(r.doc_id, r.text) for r in repeats.collect()])
    assert near.keep_one(repeats).columns == repeats.columns


def test_near_in_a_large_bucket(spark, monkeypatch):
    """A bucket of many blocks: copies of one text with few words changed, and strangers."""
    monkeypatch.setattr(near, "BLOCK", 8)
    rng = np.random.default_rng(2)
    base = [f"b{k}" for k in range(100)]
    docs = []
    for k in range(120):
        words = list(base)
        for at in rng.integers(0, 100, k % 6):
            words[at] = f"x{rng.integers(1000)}"
        docs.append((k, " ".join(words)))
    docs += [(500 + k, " ".join(f"s{k}_{j}" for j in range(60))) for k in range(20)]
    found = near.classes(spark.createDataFrame(docs, "doc_id long, text string"))
    assert {r.id: r.class_id for r in found.collect()} == brute.near_classes(docs)


def test_near_families_that_share_buckets(spark, monkeypatch):
    """Families of near copies whose heads share most words: large buckets hold several classes, chains and strangers."""
    monkeypatch.setattr(near, "BLOCK", 16)
    rng = np.random.default_rng(7)
    base = [f"b{k}" for k in range(120)]
    docs = []
    for family in range(5):
        head = list(base)
        head[family * 20 : family * 20 + 12] = [f"f{family}_{k}" for k in range(12)]
        for k in range(90):
            words = list(head)
            for at in rng.integers(100, 120, k % 5):
                words[at] = f"x{rng.integers(40)}"
            docs.append((family * 1000 + k, " ".join(words)))
    found = near.classes(spark.createDataFrame(docs, "doc_id long, text string"))
    assert {r.id: r.class_id for r in found.collect()} == brute.near_classes(docs)


def test_rows_of_a_bucket_of_near_copies_grow_with_it(spark, monkeypatch):
    """A bucket of n different near copies writes rows in proportion to n, not to its square."""
    kept, written = near.stored, Counter()

    def watched(df, name="stage"):
        out = kept(df, name)
        written[name] += out.count()
        return out

    monkeypatch.setattr(near, "stored", watched)
    per_text = []
    for n in (5_000, 20_000):
        written.clear()
        rows = spark.range(n).selectExpr("id doc_id", "concat(repeat('one two three four five six seven eight nine ten eleven ', 4), 'own', id) text")
        found = near.classes(rows)
        assert found.select("class_id").distinct().count() == 1 and found.filter("kept").count() == 1
        per_text.append(sum(written[name] for name in ("met", "star", "likely", "links")) / n)
    assert per_text[1] < 1.1 * per_text[0] and per_text[1] < 150


def test_signatures_agree_as_often_as_sets_are_alike():
    rng = np.random.default_rng(3)
    words = [f"t{k}" for k in range(400)]
    other = list(words)
    for at in rng.integers(0, 400, 10):
        other[at] = "new"
    a, b = near.elements(" ".join(words)), near.elements(" ".join(other))
    want = brute.jaccard(brute.units(" ".join(words)), brute.units(" ".join(other)))
    assert near.similarity(a, b) == pytest.approx(want)
    same = np.mean(np.frombuffer(near.signature(a), np.uint8) == np.frombuffer(near.signature(b), np.uint8))
    assert abs(same - want) < 0.15


@given(st.lists(st.text(st.sampled_from("ab é.\n'Zß1"), max_size=30), max_size=3))
@settings(max_examples=60, deadline=None)
def test_shingles_are_those_of_words(texts):
    for text in texts:
        assert len(near.elements(text)) == sum(brute.units(text).values())


def test_pieces_do_not_change_words(monkeypatch):
    text = " ".join(odd_texts()[14].split()[:500])
    whole = near.word_hashes(text)
    monkeypatch.setattr(near, "PIECE", 50)
    assert np.array_equal(near.word_hashes(text), whole)


# --- repeated lines -----------------------------------------------------------------------------------

def test_lines(odd, plain, empty):
    found = {r.id: (r.n_lines, r.n_dropped, brute.sha(r.kept_text)) for r in lines.drop_repeated(odd).collect()}
    assert found == brute.kept_lines(plain)
    assert any(v[1] for v in found.values())
    assert lines.drop_repeated(empty).count() == 0


def test_lines_with_many_shards_and_copies(spark, monkeypatch):
    monkeypatch.setattr(lines, "SHARD", 3)
    monkeypatch.setattr(lines, "PROBES", 4)
    docs = [(d, "\n".join(f"line number {(d * k) % 23} is long enough to be looked at" for k in range(9))) for d in range(80)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    found = {r.id: (r.n_lines, r.n_dropped, brute.sha(r.kept_text)) for r in lines.drop_repeated(df).collect()}
    assert found == brute.kept_lines(docs)


def test_lines_of_repeated_rows_and_null_ids(repeats):
    rows = lines.drop_repeated(repeats).collect()
    assert len(rows) == repeats.count() and sum(r.id is None for r in rows) == 4


@given(st.sets(st.tuples(st.integers(-(2**63), 2**63 - 1), st.integers(-(2**63), 2**63 - 1)), max_size=300))
@settings(max_examples=40, deadline=None)
def test_index_numbers_keys_without_gaps(keys):
    high, low = (np.array([k[i] for k in sorted(keys)], np.int64) for i in (0, 1))
    levels, numbers = lines.build_index(high, low)
    assert sorted(numbers.tolist()) == list(range(len(keys)))
    assert np.array_equal(lines.number_of(levels, high, low), numbers)


# --- BPE ----------------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary(bpe.read_file(tokenizer_path()))


def test_bpe_odd_texts(odd, empty, tokenizer):
    text = bpe.read_file(tokenizer_path())
    coded = odd.withColumn("ids", bpe.encode(F.col("text"), text))
    rows = coded.select("text", "ids", bpe.decode(F.col("ids"), text).alias("back")).collect()
    assert len(rows) == len(odd_rows())
    for r in rows:
        assert r.ids == tokenizer.encode(r.text or "", add_special_tokens=False).ids
        assert r.back == (r.text or "")
    both = odd.select("text", bpe.round_trip(F.col("text"), text).alias("b")).collect()
    assert [(r.b.ids, r.b.text) for r in both] == [(r.ids, r.back) for r in rows]
    assert empty.select(bpe.encode(F.col("text"), text)).count() == 0


@given(st.text(max_size=80) | st.text(st.sampled_from("ab 's.!-\n\t\r 'lé9<|endoftext|>"), max_size=60))
@settings(max_examples=400, deadline=None)
def test_bpe_any_text(vocabulary, tokenizer, text):
    assert vocabulary.encode([text.encode()])[0].tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_cuts_lie_between_pairs_of_no_token(vocabulary):
    tokens = [t for i, t in vocabulary.bytes_of.items() if t not in vocabulary.added]
    pairs = {a * 256 + b for t in tokens for a, b in zip(t, t[1:])}
    assert not vocabulary.cuts[sorted(pairs)].any()
    assert vocabulary.fragments(b"one two") == [b"one", b" two"]


def test_ids_that_are_no_text(spark, tokenizer):
    text = bpe.read_file(tokenizer_path())
    lists = [[161, 162], [], [50256, 64], [99999, 64, -1], None, [127, 128, 64]]
    df = spark.createDataFrame([(k, ids) for k, ids in enumerate(lists)], "k int, ids array<int>")
    found = {r.k: r.t for r in df.select("k", bpe.decode(F.col("ids"), text).alias("t")).collect()}
    for k, ids in enumerate(lists):
        known = [i for i in ids or [] if 0 <= i <= 50256]
        assert found[k] == tokenizer.decode(known, skip_special_tokens=False)


# --- language -----------------------------------------------------------------------------------------

def test_language(odd, repeats, empty):
    rows = {r.doc_id: r for r in language.identify(odd).collect()}
    for doc, text, *_ in odd_rows():
        none = not any(c.isalpha() for c in text or "")
        assert (rows[doc].lang_pred == "und") == none and 0 <= rows[doc].score <= 1
    assert language.identify(repeats).count() == repeats.count()
    assert language.identify(empty).count() == 0 and language.keep_known(empty).count() == 0
    kept = language.keep_known(odd)
    assert kept.columns == odd.columns
    assert kept.count() == sum(any(c.isalpha() for c in r[1] or "") for r in odd_rows())


def test_nothing_to_learn_from(odd):
    found = language.identify(odd.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {(r.lang_pred, r.score) for r in found} == {("und", 0.0)}


def test_grams_by_hand(monkeypatch):
    def plain(text):
        words = "".join(c if c.isalpha() else " " for c in text.lower()).split()
        run = "_" + "_".join(words) + "_"
        out = Counter()
        for n in (1, 2, 3):
            out.update(run[k : k + n] for k in range(len(run) - n + 1))
        out.pop("_", None)
        return out

    for text in ("the cat, the hat", "  ab", "a1b", "Été!"):
        codes, counts = language.grams(text)
        assert sorted(counts.tolist()) == sorted(plain(text).values()) and len(codes) == len(plain(text))
    whole = language.grams(odd_texts()[15])
    monkeypatch.setattr(language, "PIECE", 64)
    for a, b in zip(language.grams(odd_texts()[15]), whole):
        assert np.array_equal(a, b)


# --- mixing -------------------------------------------------------------------------------------------

def test_mixing(odd, repeats, empty):
    rows = mixing.mix(odd).collect()
    sizes = {r[0]: len(re.findall("[^\x20\x09-\x0d]+", r[1] or "")) for r in odd_rows()}
    sources = Counter()
    for r in odd_rows():
        sources[r[3]] += sizes[r[0]]
    aims = brute.source_targets(sources)
    assert len(rows) == len(odd_rows())
    for r in rows:
        assert r.size == sizes[r.id] and r.target == pytest.approx(aims[r.source]) and 0 <= r.copies <= 3
    assert mixing.mix(repeats).count() == repeats.count()
    assert mixing.mix(empty).count() == 0 and mixing.mixed(empty).count() == 0
    taken = Counter(r.id for r in rows for _ in range(r.copies))
    drawn = mixing.mixed(odd)
    assert drawn.columns == odd.columns and Counter(r.doc_id for r in drawn.collect()) == taken


def test_mixing_of_one_large_source(spark):
    """A source in many bins meets its target within one document, for every seed, and documents are taken fairly."""
    df = spark.range(9000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 > 0, "big").when(F.col("id") % 9 == 0, "b").otherwise("c").alias("source"),
        F.repeat(F.lit("w "), (F.col("id") % 17).cast("int") + 1).alias("text"),
    )
    share = Counter()
    for seed in (1, 2, 3):
        rows = mixing.mix(df, seed=seed).collect()
        for source in ("big", "b", "c"):
            own = [r for r in rows if r.source == source]
            assert abs(sum(r.taken for r in own) - own[0].target) <= 17
        share.update(r.size for r in rows if r.source == "big" and r.copies)
    big = [r for r in rows if r.source == "big"]
    p = big[0].target / big[0].source_size
    assert p < 1
    for size in range(1, 18):
        n = 3 * sum(r.size == size for r in big)
        assert abs(share[size] / n - p) < 5 * (p * (1 - p) / n) ** 0.5


@given(st.dictionaries(st.none() | st.text("abé", max_size=2), st.integers(0, 1000), min_size=1, max_size=8))
@settings(max_examples=25, deadline=None)
def test_targets(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    found = {r.source: r.target for r in mixing.targets(df).collect()}
    want = brute.source_targets(sizes) if sum(sizes.values()) else dict.fromkeys(sizes, 0.0)
    assert found == pytest.approx(want)


# --- archive ------------------------------------------------------------------------------------------

def test_archive(spark):
    big = "x" * 150
    pages = [
        (3, "http://a", big), (1, "http://b\r\nEvil: 1", big), (2, None, "short"), (5, "u", "short"), (4, "u", None), (6, "u", ""),
        (7, "é", "é" * 50), (8, "é", "é" * 50), (9, "u", "é" * 49), (10, "u", "é" * 49), (None, "u", big), (3, "http://a", big),
    ]
    df = spark.createDataFrame([(*p, "r", 1) for p in pages], "page_id long, url string, html string, id string, digest int")
    path = fresh_path(spark, "archive")
    warc.write_archive(df, path)
    rows = warc.read_archive(spark, path).collect()
    assert len(rows) == len(pages)
    assert spark.read.parquet(f"{path}/payloads").count() == len({p[2] or "" for p in pages})
    kinds = Counter((r.id, r.record_type, r.refers_to) for r in rows)
    assert kinds[(1, "response", None)] == 1 and kinds[(3, "revisit", "1")] == 2 and kinds[(None, "revisit", "1")] == 1
    assert kinds[(7, "response", None)] == 1 and kinds[(8, "revisit", "7")] == 1 and kinds[(10, "response", None)] == 1
    text = {r.id: r for r in rows}
    for page, _, html in pages:
        body = (html or "").encode()
        assert text[page].payload == body and text[page].payload_bytes == len(body)
        assert text[page].payload_digest == hashlib.sha256(body).hexdigest()
        head, _, rest = bytes(text[page].record).partition(b"\r\n\r\n")
        block = b"" if text[page].record_type == "revisit" else body
        assert rest == block + b"\r\n\r\n" and f"Content-Length: {len(block)}".encode() in head
        assert head.startswith(b"WARC/1.1\r\nWARC-Type: ") and b"\r\nEvil" not in head
    empty = fresh_path(spark, "archive")
    warc.write_archive(df.limit(0), empty)
    assert warc.read_archive(spark, empty).count() == 0


def test_damaged_payloads_are_found(spark):
    path = fresh_path(spark, "archive")
    warc.write_archive(spark.createDataFrame([(1, "u", "a" * 200)], "page_id long, url string, html string"), path)
    damaged = spark.read.parquet(f"{path}/payloads").withColumn("payload", F.encode(F.lit("b"), "UTF-8")).collect()
    spark.createDataFrame(damaged, spark.read.parquet(f"{path}/payloads").schema).write.mode("overwrite").parquet(f"{path}/payloads")
    with pytest.raises(Exception, match="damaged payload"):
        warc.read_archive(spark, path).collect()


# --- licences -----------------------------------------------------------------------------------------

MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED."""


def test_licences(spark, odd, empty):
    rows = [
        (1, MIT), (2, "Words.\nReleased under the MIT License.\nmore"), (3, None), (4, ""), (5, "this permission notice"), (6, f"{MIT}\n\n{MIT}"),
        (7, "Licensed under the Apache License, Version 2.0. Licensed under CC BY-SA 4.0."), (8, MIT.split("\n\n")[2]),
    ]
    found = {r.doc_id: (r.licences, r.rest) for r in licences.scanned(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == {
        1: (["MIT"], []), 2: (["MIT"], []), 3: ([], []), 4: ([], []), 5: ([], []), 6: (["MIT", "MIT"], []),
        7: (["Apache-2.0", "CC-BY-SA-4.0"], []), 8: ([], ["mit_disclaimer"]),
    }
    assert licences.scanned(odd).count() == odd.count() and licences.scanned(empty).count() == 0


@pytest.mark.parametrize("end", [".</p>", ".)", '."', ".'", ".\u201d", ".\u00a0", ".[1]", ".*", ".**", ".<br>", "...", "._", ".\u00a0More", ".) More", '."\nMore', ".", ""])
def test_licence_sentences_with_something_after_the_full_stop(end):
    scanner = licences.Scanner(licences.SENTENCES, licences.RULES)
    for text, want in [
        ("Released under the MIT License", "MIT"), ("All rights reserved", "All-rights-reserved"),
        ("Licensed under the Apache License, Version 2.0", "Apache-2.0"),
    ]:
        for start in ("", "<p>", "(", '"', "...", "\u00a0"):
            assert scanner.licences(scanner.identifiers(start + text + end)) == ([want], [])
    assert scanner.identifiers("Licensed under the Apache License, Version 2.0.1") == []
    assert scanner.identifiers("Licensed under the Apache License, Version 2") == []


#: notices as they are published, for the licences that a single sentence shows
NOTICES = {
    "BSD-3-Clause": "Released under the BSD 3-Clause License.", "BSD-2-Clause": "Released under the BSD 2-Clause License.",
    "Apache-2.0": 'Licensed under the Apache License, Version 2.0 (the "License");',
    "BSL-1.0": "Distributed under the Boost Software License, Version 1.0.", "MIT": "Released under the MIT License.",
    "GPL-3.0": "Licensed under the GNU General Public License, version 3.", "GPL-2.0": "Licensed under the GNU General Public License, version 2.",
    "AGPL": "under the terms of the GNU Affero General Public License as published", "LGPL": "under the terms of the GNU Lesser General Public License as published",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public\n * License, v. 2.0. If a copy of the MPL was not distributed",
    "EPL": "under the terms of the Eclipse Public License v. 2.0 which is available", "Artistic-2.0": "under the terms of the Artistic License 2.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.", "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.", "CC-BY-ND-4.0": "Licensed under CC BY-ND 4.0.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.", "CC0-1.0": "CC0 1.0 Universal", "All-rights-reserved": "All rights reserved.",
    "Unlicense": "This is free and unencumbered software released into the public domain.", "WTFPL": "DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE",
}


def test_every_phrase_and_notice_is_found_in_a_text():
    scanner = licences.Scanner(licences.SENTENCES, licences.RULES)
    for name, phrase in licences.SENTENCES.items():
        assert scanner.identifiers(f"Words. {phrase.capitalize()}. More") == [name]
    for licence, rule in licences.RULES:
        text = "\n\n".join(licences.SENTENCES[name] for name in rule.split())
        assert scanner.licences(scanner.identifiers(text)) == ([licence], [])
    assert set(NOTICES) >= {licence for licence, rule in licences.RULES if len(rule.split()) == 1}
    for licence, notice in NOTICES.items():
        assert scanner.licences(scanner.identifiers(notice)) == ([licence], [])


@pytest.mark.parametrize("version", ["v. 2.0", "v.2.0", "V. 2.0", "v.\n2.0", "v.\u00a02.0", "v 2.0"])
def test_version_of_a_licence_stays_in_its_sentence(version):
    scanner = licences.Scanner(licences.SENTENCES, licences.RULES)
    assert scanner.identifiers(f"Subject to the terms of the Mozilla Public License, {version}.") == ["mpl_notice"]
    assert scanner.identifiers("Subject to the terms of the Mozilla Public License, v.\n\n2.0 is a number") == []


def test_phrases_and_rules():
    phrases = [f" {p} " for p in licences.SENTENCES.values()]
    assert not any(a != b and a in b for a in phrases for b in phrases)
    assert all(set(rule.split()) <= set(licences.SENTENCES) for _, rule in licences.RULES)
    for k, (_, late) in enumerate(licences.RULES):  # an earlier rule never hides a later, longer one
        assert not any(early in late and early != late for _, early in licences.RULES[:k])


# --- chat ---------------------------------------------------------------------------------------------

def collapsed(rows):
    """What stays, by comparing all conversations."""
    talks = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: tuple((v is not None, v) for v in r)):
        talks.setdefault(conv, []).append((role, text))
    out = {}
    for conv, turns in sorted(talks.items(), key=lambda t: (t[0] is None, t[0])):
        longer = any(len(o) > len(turns) and o[: len(turns)] == turns for o in talks.values())
        if not longer and turns not in out.values():
            out[conv] = turns
    return {c: "".join(f"<|im_start|>{r or 'unknown'}\n{x or ''}<|im_end|>\n" for r, x in t) for c, t in out.items()}


def test_chat(spark):
    rows = []
    for conv in range(40):
        for turn in range(1 + conv % 7):
            rows.append((conv, turn, "user" if turn % 2 == 0 else "assistant", f"t{turn} {conv % 3 if turn > 2 else ''}"))
    rows += [(None, 0, None, None), (None, 1, "user", ""), (50, None, "user", None), (50, 2, "user", None), (51, 1, "user", ""), (52, 5, "user", "x"), (52, 5, "user", "x")]
    rows += [(60, k, "user", f"long {k}") for k in range(150)] + [(61, k, "user", f"long {k}") for k in range(149)]
    df = spark.createDataFrame([(*r, "conv", 1) for r in rows], "conv_id long, turn long, role string, text string, conv string, position int")
    found = {r.conv_id: r.rendered for r in chat.collapse(df).collect()}
    assert found == collapsed(rows)
    parts = sorted((r.part, r.rendered) for r in chat.collapse(df, part=40).collect() if r.conv_id == 60)
    assert [p for p, _ in parts] == [0, 1, 2, 3] and "".join(x for _, x in parts) == found[60]
    assert chat.collapse(df.limit(0)).count() == 0


def test_chat_orders_ties_by_text(spark, monkeypatch):
    """Different texts under one turn and role, in one conversation and over many blocks of another."""
    rows = [(1, 0, "user", t) for t in ("b", "a", "c", "", None, "aa", "B", "\u00e9", "\U0001f642", "\uffff")]
    rows += [(2, 0, "user", f"t{k * 7919 % 3001}") for k in range(3000)] + [(3, None, None, t) for t in ("z", None, "y")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(7)
    monkeypatch.setattr(chat, "HEAD", 4)  # texts that begin alike stay in one block
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = chat.collapse(df).collect()
        blocks = chat.positions(df, "conv_id", "turn", "role", "text").filter("conv = 2").select("block").distinct().count()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    parts = {}
    for r in found:
        parts.setdefault(r.conv_id, []).append((r.part, r.rendered))
    assert {c: "".join(x for _, x in sorted(p)) for c, p in parts.items()} == collapsed(rows)
    assert blocks > 1


# --- vectors ------------------------------------------------------------------------------------------

def vector_rows():
    rng = np.random.default_rng(5)
    rows = []
    centres = rng.standard_normal((6, 16))
    for k in range(300):
        v = centres[k % 6] + rng.standard_normal(16) * [0.05, 0.12, 0.2, 1.0][k % 4]
        rows.append((k, v.astype(np.float32).tolist(), int(k % 3)))
    rows += [(400 + k, rows[0][1], 0) for k in range(30)]
    rows += [(500, None, 1), (501, [], 1), (502, [0.0] * 16, 1), (503, [1.0] * 15 + [None], 1), (504, [float("nan")] * 16, 1), (505, [float("inf")] * 16, 1)]
    rows += [(506, rows[1][1], None), (507, rows[1][1][:8], 1), (508, rows[1][1][:8], 1), (509, [x * 3.0 for x in rows[1][1]], 1)]
    return rows


def test_vectors(spark, monkeypatch):
    rows = vector_rows()
    df = spark.createDataFrame([(*r, 1, "n") for r in rows], "vec_id long, embedding array<float>, label int, id int, node string")
    found = {r.id: (r.n_links, r.component_id) for r in vectors.linked(df).collect()}
    want = brute.vector_links([(r.vec_id, r.embedding, r.label) for r in df.collect()])
    assert found == want and sum(n for n, _ in want.values()) > 1000
    monkeypatch.setattr(vectors, "BLOCK", 16)
    assert {r.id: (r.n_links, r.component_id) for r in vectors.linked(df).collect()} == want
    doubles = df.withColumn("embedding", F.col("embedding").cast("array<double>"))
    assert {r.id: (r.n_links, r.component_id) for r in vectors.linked(doubles).collect()} == want
    assert vectors.linked(df.limit(0)).count() == 0


def test_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(6)
    x = rng.standard_normal((400, 64))
    x[200:] = x[:200] + 0.4 * rng.standard_normal((200, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    signs, factors = vectors.coded(x, 4)
    corner = (signs * 2.0 - 1) / 8 / np.repeat(factors, 64, axis=1) / 4
    estimate = (corner[:200] * vectors.turned(x[200:], 4)).sum(1)
    true = (x[:200] * x[200:]).sum(1)
    spread = np.sqrt(((1 - factors**2) / factors**2).mean(1) / 63 / 4)[:200]
    assert abs((estimate - true).mean()) < 0.01
    assert (np.abs(estimate - true) < 4.5 * spread).all()


def test_bands_grow_slowly():
    assert vectors.bands_for(100, 0.98) == vectors.bands_for(16_384, 0.98)
    bits, bands = vectors.bands_for(10**9, 0.98)
    assert 20 <= bits <= 26 and bands < 120
