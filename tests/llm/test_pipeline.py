"""The corpus pipeline against plain restatements of its stages."""

import re

import corpus_pipeline
from casebook.llm import common, langid, mixing, pieces
from tests.llm.conftest import SF_DIR
from tests.llm.test_near import jaccard_keepers


def test_stages_one_by_one(spark, odd):
    docs = common.table(spark, odd, "documents")
    columns = docs.columns
    before = docs.collect()
    stages = dict(corpus_pipeline.STAGES)

    docs = common.stored(stages["language_id"](spark, docs, odd), "t")
    assert docs.columns == columns
    lettered = [r for r in before if r.text and re.search(r"[^\W\d_]", r.text)]
    assert sorted(r.doc_id for r in docs.collect()) == sorted(r.doc_id for r in lettered)

    docs = common.stored(stages["exact_dedup"](spark, docs, odd), "t")
    assert docs.columns == columns
    first = {}
    for r in lettered:
        key = re.sub(r"[\x20\x09-\x0D]+", " ", r.text)
        first[key] = min(first.get(key, r.doc_id), r.doc_id)
    rows = docs.collect()
    assert sorted(r.doc_id for r in rows) == sorted(first.values())

    docs = common.stored(stages["near_dedup"](spark, docs, odd), "t")
    assert docs.columns == columns
    want = jaccard_keepers([(r.doc_id, r.text) for r in rows])
    assert sorted(r.doc_id for r in docs.collect()) == sorted(d for d, _ in want)

    mixed = common.stored(stages["mixing_sources"](spark, docs, odd), "t")
    assert mixed.columns == columns
    copies = {r.doc_id: r.n for r in mixing.mix(docs.drop("mix")).select("doc_id", mixing.F.col("mix.copies").alias("n")).collect()}
    counted = {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert counted == {k: n for k, n in copies.items() if n}

    last = stages["sentencepiece"](spark, mixed, odd).collect()
    coder = pieces.load(pieces.model_path())
    texts = {r.doc_id: r.text for r in mixed.collect()}
    assert len(last) == sum(counted.values()) and all(r.exact for r in last)
    assert all(r.ids == coder.encode([texts[r.doc_id]])[0].tolist() for r in last)


def test_run(spark):
    rows = corpus_pipeline.run(spark, SF_DIR).collect()
    assert rows and all(r.exact and len(r.ids) == r.n_pieces for r in rows)


def test_empty(spark, void):
    assert corpus_pipeline.run(spark, void).count() == 0
