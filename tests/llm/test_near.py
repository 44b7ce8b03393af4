"""The near-duplicate stage against all pairs of five-word shingle sets."""

import random
import re
import time

import corpus_pipeline
from casebook.llm import near, simhash
from tests.llm import brute
from tests.llm.conftest import prose


def jaccard_keepers(rows, least=0.8) -> set:
    """(doc_id, text) of the smallest row of every group."""
    def shingles(text):
        w = brute.WORD.findall((text or "").translate(brute.LOWER))
        return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()

    rows = sorted(set(rows), key=lambda r: (r[0] is None, r))
    sets = [shingles(t) for _, t in rows]
    close = lambda a, b: sets[a] == sets[b] or len(sets[a] & sets[b]) >= least * len(sets[a] | sets[b])
    return {rows[k] for k in brute.roots(range(len(rows)), close).values()}


def edited(rng, words, n):
    words = list(words)
    for k in rng.sample(range(len(words)), n):
        words[k] = "changed" + str(rng.random())
    return " ".join(words)


def test_stage_against_all_pairs(spark, small):
    rng = random.Random(3)
    rows = [(d, t) for d, t in small]
    for k in range(40):
        base = prose(rng, rng.choice([30, 120, 400])).split()
        rows += [(10000 + 20 * k + j, edited(rng, base, rng.randint(0, len(base) // 25))) for j in range(8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    stage = dict(corpus_pipeline.STAGES)["near_dedup"]
    left = stage(spark, docs, None).collect()
    want = jaccard_keepers(rows)
    assert len(want) < len(rows) - 100
    assert sorted(r.doc_id for r in left) == sorted(d for d, _ in want)


def test_large_cluster_in_parts(spark, monkeypatch):
    monkeypatch.setattr(near, "PART", 8)
    rng = random.Random(4)
    base = prose(rng, 150).split()
    rows = [(k, edited(rng, base, rng.randint(1, 5))) for k in range(150)]
    left = near.one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(r.doc_id for r in left) == sorted(d for d, _ in jaccard_keepers(rows))


def test_a_large_family_is_joined_without_all_pairs(spark, monkeypatch):
    """20,000 texts of one family: what is compared grows with the candidates, not their square."""
    rng = random.Random(8)
    base = prose(rng, 60).split()
    rows = []
    for k in range(20000):
        words = list(base)
        words[rng.randrange(4)] = f"head{k}"
        rows.append((k, " ".join(words)))
    compared = spark.sparkContext.accumulator(0)
    plain = near.verified
    monkeypatch.setattr(near, "verified", lambda pairs, *rest: (compared.add(pairs.count()), plain(pairs, *rest))[1])
    left_over = []
    pairwise = near.all_pairs
    monkeypatch.setattr(near, "all_pairs", lambda left, *rest: (left_over.append(left.count()), pairwise(left, *rest))[1])
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    assert [r.doc_id for r in near.one_of_each(docs).collect()] == [0]
    assert compared.value < 40 * len(rows) and left_over == [0]


def test_bands_find_the_pairs_of_given_documents(spark):
    """Recall of the bands over all distinct texts, against every pair at 0.8 or more."""
    texts = sorted({r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect() if r.text})
    sets = [near.shingles(t.encode()) for t in texts]
    keys = [set(near.bands(s)) for s in sets]
    near_pairs = [(a, b) for a in range(len(sets)) for b in range(a) if near._near(sets[a], sets[b], near.LEAST)]
    assert near_pairs and all(keys[a] & keys[b] for a, b in near_pairs)


def test_one_row_of_each_group_with_repeated_and_null_ids(spark):
    rng = random.Random(6)
    texts = [prose(rng, 300) for _ in range(4)]
    copy = lambda t: t.upper()
    # Null ids alone, beside a keeper, and one id over two texts of different groups.
    rows = [(None, texts[0]), (None, copy(texts[0])), (1, texts[1]), (None, copy(texts[1])), (2, texts[2]), (5, copy(texts[3])), (5, copy(texts[2])), (7, texts[3]), (7, texts[3])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for kept in (near.one_of_each(docs), simhash.one_of_each(docs)):
        left = kept.collect()
        assert sorted(r.text.lower() for r in left) == sorted(texts)
        assert {r.text.lower(): r.doc_id for r in left} == dict(zip(texts, [None, 1, 2, 5]))


def test_fingerprints_linked_by_pigeonring_find_near_copies(spark, monkeypatch):
    """Without any shared band, documents whose SimHashes lie within three bits are found."""
    rng = random.Random(9)
    base = prose(rng, 2000).split()
    last = prose(rng, 2000)
    rows = [(k, " ".join([f"head{k}", *base[1:]])) for k in range(6)] + [(9, last)]
    prints = [simhash.fingerprint(t.encode(), near.WORDS) for _, t in rows[:6]]
    assert all((a ^ prints[0]).bit_count() <= simhash.MOST for a in prints)
    rows_of = near.sketches

    def unbanded(docs, words):
        found = rows_of(docs, words)
        return found.withColumn("keys", near.F.array(near.F.xxhash64("node")))

    monkeypatch.setattr(near, "sketches", unbanded)
    left = near.one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(r.doc_id for r in left) == [0, 9]


def test_what_a_step_shuffled_leaves_the_disk_with_it(spark, monkeypatch):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    held, stored = {}, near.common.stored

    def shuffled():
        return set(re.findall(r"shuffle_\d+_\d+_\d+\.data", disk.getAllFiles().mkString(",")))

    def watched(rows, name, **options):
        before = shuffled()
        found = stored(rows, name, **options)
        # Files go a moment after the query that made them has ended.
        for _ in range(100):
            left = shuffled() - before
            if not left:
                break
            time.sleep(0.05)
        held[name] = held.get(name, set()) | left
        return found

    monkeypatch.setattr(near.common, "stored", watched)
    rng = random.Random(12)
    base = prose(rng, 100).split()
    rows = [(k, edited(rng, base, 1 + k % 2)) for k in range(40)] + [(50, prose(rng, 100))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert sorted(r.doc_id for r in near.one_of_each(docs).collect()) == sorted(d for d, _ in jaccard_keepers(rows))
    assert {"near-sets", "near-members", "near-open", "near-keepers", "links"} <= set(held)
    assert not any(held.values())
