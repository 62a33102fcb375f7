"""The pipeline, stage by stage, against plain versions."""

from collections import Counter

import brute
import corpus_pipeline
import duckdb
from tokenizers import Tokenizer

from sparkdeck.llm import mixing
from sparkdeck.llm.queries import tokenizer_path
from sparkdeck.session import stored


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{sf_dir}/documents.parquet'").fetchall()
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    (_, language), (_, exact), (_, near), (_, mix), (_, tokens) = corpus_pipeline.STAGES

    known = stored(language(spark, docs, sf_dir))
    assert known.columns == docs.columns
    left = [(d, t) for d, t in rows if any(c.isalpha() for c in t or "")]
    assert {r.doc_id for r in known.collect()} == {d for d, _ in left}

    single = stored(exact(spark, known, sf_dir))
    groups = brute.exact_groups(left)
    left = [(d, t) for d, t in left if groups[d][2]]
    assert sorted(r.doc_id for r in single.collect()) == sorted(d for d, _ in left)

    apart = stored(near(spark, single, sf_dir))
    classes = brute.near_classes(left)
    left = [(d, t) for d, t in left if classes[d] == d]
    assert sorted(r.doc_id for r in apart.collect()) == sorted(d for d, _ in left)

    mixed = stored(mix(spark, apart, sf_dir))
    assert mixed.columns == docs.columns
    copies = {r.id: r.copies for r in mixing.mix(apart).collect()}
    times = Counter(r.doc_id for r in mixed.collect())
    assert times == Counter({d: n for d, n in copies.items() if n})

    tokenizer = Tokenizer.from_file(tokenizer_path())
    texts = dict(left)
    final = tokens(spark, mixed, sf_dir).collect()
    assert Counter(r.doc_id for r in final) == times
    for r in final:
        assert r.ids == tokenizer.encode(texts[r.doc_id], add_special_tokens=False).ids and r.n_tokens == len(r.ids) and r.decodes


def test_run(spark, sf_dir):
    assert corpus_pipeline.run(spark, sf_dir).count() > 0
