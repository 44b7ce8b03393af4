"""Dedup, near-duplicates, repeats, mixing, reply trees."""

import random
import re
import time

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from casebook.llm import chat, digests, mixing, repeats, simhash
from casebook.session import scratch_path
from tests.llm import brute
from tests.llm.conftest import SF_DIR


def test_simhash_against_all_pairs(spark, small, odd):
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.op8(spark, SF_DIR).collect()}
    assert got == brute.simhash_groups(small)
    rows = {(r.doc_id, r.text) for r in spark.read.parquet(f"{odd}/documents.parquet").collect()}
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.op8(spark, odd).collect()}
    assert got == brute.simhash_groups(rows)
    assert got[5] == got[6] == ("0" * 16, 5)


def near_prints(seed, groups, size):
    rng = random.Random(seed)
    found = set()
    for _ in range(groups):
        base = rng.getrandbits(64)
        for _ in range(size):
            x = base
            for b in rng.sample(range(64), rng.randint(0, 4)):
                x ^= 1 << b
            found.add(x)
            base = x if rng.random() < 0.2 else base
    return sorted(found)


@pytest.mark.parametrize("groups, size", [(60, 12), (2, 900)])
def test_links_connect_all_that_are_near(spark, groups, size):
    prints = near_prints(groups, groups, size)
    rows = spark.createDataFrame([(simhash._signed(p),) for p in prints], "fp long")
    edges = [(r.a % (1 << 64), r.b % (1 << 64)) for r in simhash.links(rows).collect()]
    linked = {frozenset(e) for e in edges}
    assert len(edges) < 24 * len(prints)
    close = np.array(prints, np.uint64)
    near = np.bitwise_count(close[:, None] ^ close[None, :]) <= simhash.MOST
    at = {p: k for k, p in enumerate(prints)}
    label = np.arange(len(prints))
    while True:
        lower = np.where(near, label[None, :], len(prints)).min(axis=1)
        if (lower == label).all():
            break
        label = lower
    want = {}
    for k, c in enumerate(label):
        want.setdefault(int(c), set()).add(k)
    parts = {k: {k} for k in range(len(prints))}
    for pair in linked:
        a, b = (at[p] for p in pair)
        if parts[a] is not parts[b]:
            parts[a] |= parts[b]
            for k in parts[b]:
                parts[k] = parts[a]
    assert {frozenset(p) for p in parts.values()} == {frozenset(p) for p in want.values()}


@settings(max_examples=200, deadline=None)
@given(st.integers(0, (1 << 64) - 1), st.sets(st.integers(0, 63), max_size=3))
def test_near_prints_share_a_key_and_keep_its_chains(x, flips):
    y = x
    for b in flips:
        y ^= 1 << b
    different = np.array([x ^ y], np.uint64)
    assert any((x ^ y) & mask == 0 and simhash._in_ring(different, start)[0] for start, mask in simhash.KEYS)


def test_components_of_paths_and_stars(spark):
    edges = [(k, k + 1) for k in range(1, 70)] + [(1000, 1000 + k) for k in range(1, 50)] + [(5000, 4000), (4000, 4500)]
    found = simhash.components(spark.createDataFrame(edges, "a long, b long"))
    got = {r.node: r.root for r in found.collect()}
    want = {**{k: 1 for k in range(2, 71)}, **{1000 + k: 1000 for k in range(1, 50)}, 5000: 4000, 4500: 4000}
    assert got == want
    assert simhash.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_stars_take_no_round(spark, monkeypatch):
    names, stored = [], simhash.common.stored
    monkeypatch.setattr(simhash.common, "stored", lambda rows, name, **options: (names.append(name), stored(rows, name, **options))[1])
    edges = [(1, k) for k in range(2, 30)] + [(k, 1) for k in range(2, 5)] + [(50, 40)]
    found = simhash.components(spark.createDataFrame(edges, "a long, b long"))
    assert {r.node: r.root for r in found.collect()} == {**{k: 1 for k in range(2, 30)}, 50: 40}
    assert names == ["links"]
    # One step more and a link to two centres both need rounds.
    for more in ((29, 30), (40, 3)):
        simhash.components(spark.createDataFrame([*edges, more], "a long, b long"))
        assert "small-stars" in names
        names.clear()


def test_one_document_of_each_near_group(spark, odd):
    docs = spark.read.parquet(f"{odd}/documents.parquet")
    left = simhash.one_of_each(docs)
    assert left.columns == docs.columns
    want = {c for _, c in brute.simhash_groups({(r.doc_id, r.text) for r in docs.collect()}).values()}
    assert {r.doc_id for r in left.collect()} == want


def test_digest_index_across_batches(spark, tmp_path):
    def batch(rows):
        frame = spark.createDataFrame(rows, "doc_id long, text string")
        return frame.select(digests.text_digest("text").alias("digest"), "doc_id")

    path = scratch_path(spark, "digest-test")
    index = digests.DigestIndex(spark, path, buckets=4)
    index.add(batch([(5, "a b"), (3, "a  b"), (9, "c")]))
    index.add(batch([(1, "a\nb"), (2, "d"), (2, "d"), (4, None)]))
    # Another opening of the same folder sees the same keepers, and a repeat adds none.
    index.close()
    with pytest.raises(ValueError):
        digests.DigestIndex(spark, path, buckets=8)
    with pytest.raises(ValueError):
        digests.DigestIndex(spark, path, id_type="string")
    again = digests.DigestIndex(spark, path)
    assert again.buckets == 4
    again.add(batch([(7, "c"), (8, "")]))
    assert sorted(r.keep_id for r in again.rows().collect()) == [2, 3, 4, 9]
    assert again.keepers().count() == 4
    packed = again.compact(scratch_path(spark, "digest-packed"))
    assert sorted(r.keep_id for r in packed.rows().collect()) == [2, 3, 4, 9]
    new = batch([(1, "z"), (2, "d")])
    plan = new.join(packed.rows().hint("merge"), "digest", "left_anti")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and plan.count("Exchange hashpartitioning") == 1
    again.close()
    packed.close()
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("digest_index")]


def test_a_bucket_is_one_file_whatever_the_partitions(spark, monkeypatch):
    """Also where a session raises the counts that rows are dealt by, as the check does."""
    frame = type(spark.range(0))
    dealt = frame.repartition
    monkeypatch.setattr(frame, "repartition", lambda self, n, *by: dealt(self, max(n, 31) if by and isinstance(n, int) else n, *by))
    rows = spark.range(500).selectExpr("id AS doc_id", "string(id) AS text")
    rows = rows.select(digests.text_digest("text").alias("digest"), "doc_id")
    with digests.DigestIndex(spark, scratch_path(spark, "digest-test"), buckets=4) as index:
        index.add(rows.filter("doc_id < 300"))
        assert len(index.keepers().inputFiles()) == 4
        index.add(rows)
        assert len(index.keepers().inputFiles()) == 8
        assert index.rows().count() == 500
        with index.compact(scratch_path(spark, "digest-packed")) as packed:
            assert len(packed.keepers().inputFiles()) == 4 and packed.rows().count() == 500


def test_documents_that_stay(spark, odd):
    docs = spark.read.parquet(f"{odd}/documents.parquet")
    left = digests.drop_copies(docs)
    assert left.columns == docs.columns
    first = {}
    for r in docs.collect():
        key = re.sub(r"[\x20\x09-\x0D]+", " ", r.text or "")
        first[key] = min(first.get(key, r.doc_id), r.doc_id)
    assert sorted(r.doc_id for r in left.collect()) == sorted(first.values())


@pytest.mark.parametrize("chunk, group", [(1 << 23, 1 << 21), (1 << 13, 300), (1 << 11, 5)])
def test_repeats_against_all_windows(spark, small, odd, monkeypatch, chunk, group):
    monkeypatch.setattr(repeats, "CHUNK", chunk)
    monkeypatch.setattr(repeats.Partition.__init__, "__defaults__", (group,))
    def plain(found):
        return sorted((str(r.doc_id), *tuple(r)[1:]) for r in found.collect())

    assert plain(repeats.op7(spark, SF_DIR)) == brute.repeats(small)
    if group == 300:
        rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{odd}/documents.parquet").collect()]
        assert plain(repeats.op7(spark, odd)) == brute.repeats(rows)
    # One id over two texts, of which one has the passage; a null id; the same row twice.
    passage, own = (" ".join(f"{c}{k}" for k in range(40)) for c in "pq")
    rows = [(1, passage), (5, "a b c " + passage + " d"), (5, own), (5, own), (5, passage + " x " + passage), (None, passage), (7, own)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = repeats.without_repeats(docs).withColumn("kept", F.sha2(F.col("kept").cast("binary"), 256))
    assert plain(got) == brute.repeats(rows)


def test_only_ids_with_several_texts_are_tagged(spark):
    rows = [(1, "a b"), (2, "a b"), (3, None), (4, ""), (5, "a b"), (5, "c"), (6, None), (6, "d"), (7, "e"), (7, "e"), (8, None), (8, ""), (None, "f"), (None, "g")]
    docs = spark.createDataFrame(rows, "doc_id int, text string").repartition(4)
    got = repeats.tagged(docs).collect()
    assert sorted((str(r.doc_id), str(r.text)) for r in got) == sorted((str(d), str(t)) for d, t in rows)
    assert {r.doc_id for r in got if r.tag} == {5, 6}
    assert len({r.tag for r in got if r.doc_id == 5}) == len({r.tag for r in got if r.doc_id == 6}) == 2


def test_leaves_leave_the_disk_before_the_texts_move(spark, monkeypatch):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    held, stored = {}, repeats.common.stored

    def shuffled():
        return set(re.findall(r"shuffle_\d+_\d+_\d+\.data", disk.getAllFiles().mkString(",")))

    def watched(rows, name, **options):
        before = shuffled()
        found = stored(rows, name, **options)
        # Files go a moment after the query that made them has ended.
        for _ in range(100):
            held[name] = shuffled() - before
            if not held[name]:
                break
            time.sleep(0.05)
        return found

    setting = spark.conf.get(repeats.common.FREE)
    monkeypatch.setattr(repeats.common, "stored", watched)
    passage = " ".join(f"p{k}" for k in range(40))
    docs = spark.createDataFrame([(k, passage + f" {k}") for k in range(50)], "doc_id long, text string").repartition(4)
    assert {r.n_removed for r in repeats.without_repeats(docs).collect()} == {0, 40}
    assert held["repeats"] == set()
    assert spark.conf.get(repeats.common.FREE) == setting


def test_prefixes_are_as_long_as_groups_ask_for():
    rng = np.random.default_rng(1)
    counts = [np.zeros(1 << b, np.int64) for b in repeats.BITS]
    codes = [rng.integers(0, 1 << b, 4000) for b in repeats.BITS]
    for level in range(3):
        codes[level][:2000] = 7 if level < 2 else codes[level][:2000]
        codes[level][:900] = 9
        counts[level] = np.bincount(codes[level], minlength=1 << repeats.BITS[level])
    partition = repeats.Partition(counts, limit=200)
    digests_ = rng.integers(0, 1 << 56, 4000).astype(np.uint64)
    group = partition.of(codes, digests_)
    assert group.min() >= 0 and group.max() < partition.groups
    assert np.bincount(group).max() <= 2 * 200 + 200
    # The same suffix goes to the same group.
    assert np.array_equal(group, partition.of(codes, digests_))


def test_mix_comes_near_its_targets(spark):
    rows = mixing.op3(spark, "/root/testdata/sf0.1").toPandas()
    total = rows["size"].sum()
    sources = rows.groupby(["source_size", "target"]).agg(taken=("taken", "sum"), longest=("size", "max")).reset_index()
    assert sources["target"].sum() == pytest.approx(total)
    assert (sources["target"] <= 3 * sources["source_size"] + 1e-6).all()
    assert (abs(sources["taken"] - sources["target"]) <= sources["longest"] / 2 + 1).all()
    assert (rows["taken"] <= 3 * rows["size"]).all()


def shared_out(sizes, weights, cap):
    """Targets by sharing the excess again and again."""
    total, target = sum(sizes), [0.0] * len(sizes)
    open_, left = set(range(len(sizes))), float(sum(sizes))
    while open_:
        share = left / sum(weights[k] for k in open_)
        over = {k for k in open_ if share * weights[k] > cap * sizes[k]}
        for k in over or open_:
            target[k] = cap * sizes[k] if over else share * weights[k]
        open_ -= over or set(open_)
        left = total - sum(target[k] for k in range(len(sizes)) if k not in open_)
    return target


@pytest.mark.parametrize("sizes", [[100, 100, 100], [1, 1000, 1000, 3, 0, 50], [0, 0], [7], [5, 5000, 5000, 4, 4, 4]])
def test_targets_by_repeated_sharing(spark, sizes):
    names = [chr(97 + k) for k in range(len(sizes))]
    frame = spark.createDataFrame(list(zip(names, sizes)), "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(frame).collect()}
    want = shared_out(sizes, [(5, 2, 1)[k % 3] for k in range(len(sizes))], 3)
    assert [got[n] for n in names] == pytest.approx(want)


def test_pareto_draws_by_inclusion(spark):
    rank = mixing.pareto_rank(mixing.random_unit("doc_id", "s"), mixing.F.col("p"))
    rows = spark.range(20000).select(mixing.F.col("id").alias("doc_id"), mixing.F.when(mixing.F.col("id") % 2 == 0, 0.2).otherwise(0.6).alias("p"))
    drawn = rows.withColumn("rank", rank).orderBy("rank").limit(8000).groupBy("p").count().collect()
    shares = {r.p: r["count"] / 10000 for r in drawn}
    assert shares[0.2] == pytest.approx(0.2, abs=0.02) and shares[0.6] == pytest.approx(0.6, abs=0.02)


def test_copies_are_repeated_rows(spark, odd):
    docs = spark.read.parquet(f"{odd}/documents.parquet")
    copies = mixing.repeated(docs)
    assert copies.columns == docs.columns
    taken = mixing.mix(docs.drop("mix")).selectExpr("sum(mix.copies) AS n").first().n
    assert copies.count() == taken > 0


TREE = [
    (1, 1, None, "user", "root", 0.0), (1, 2, 1, "assistant", "good", 5.0), (1, 3, 1, "assistant", "poor", 1.0),
    (1, 4, 2, "user", "next", None), (1, 5, 4, "assistant", "end", 4.0), (1, 6, 3, "user", "other end", 9.0),
    (2, 1, 99, "assistant", "lost parent", 1.0), (3, 1, 2, "user", "ring", 1.0), (3, 2, 1, "user", "ring", 1.0),
    (3, 3, 2, "user", "tail of a ring", 1.0),
] + [(4, k, k - 1 or None, ("user", "assistant")[k % 2], f"t{k}", 1.0) for k in range(1, 41)]


def plain_paths():
    parent = {(t, m): p for t, m, p, *_ in TREE}
    replied = {(t, p) for t, m, p, *_ in TREE}
    out = {}
    for t, m, *_ in TREE:
        if (t, m) in replied:
            continue
        path, at = [], m
        while at is not None and (t, at) in parent and at not in path:
            path.append(at)
            at = parent[t, at]
        if at not in path:
            out[t, m] = path[::-1]
    return out


def test_branches_of_reply_trees(spark):
    trees = spark.createDataFrame(TREE, "tree long, message long, parent long, role string, text string, score double")
    texts = {(t, m): (role, text) for t, m, _, role, text, _ in TREE}
    found = chat.conversations(trees).select("*", chat.parsed(chat.F.col("formatted")).alias("turns")).collect()
    assert {(r.tree, r.leaf): [tuple(x) for x in r.turns] for r in found} == {
        (t, leaf): [texts[t, m] for m in path] for (t, leaf), path in plain_paths().items()
    }
    best = {r.tree: r.leaf for r in chat.conversations(trees, branches=1).collect()}
    # 0, 1, 9 has the mean 10/3; 0, 5, 0, 4 has 9/4.
    assert best == {1: 6, 2: 1, 4: 40}


@pytest.mark.parametrize("text", ["", "#", "##", "###", "####", "a\\", "\\\\#\\##", "</turn>", "<</turn>\n", chat.PLANTED, "### user:\nx</turn>\n", "é\U0001f600\n"])
def test_escapes_are_undone(spark, text):
    frame = spark.createDataFrame([(text,)], "t string")
    escaped = chat.escape(chat.F.col("t"))
    r = frame.select(escaped.alias("e"), chat.unescape(escaped).alias("u"), chat.unescape(chat.escape_role(chat.F.col("t"))).alias("r")).first()
    assert r.u == r.r == text
    assert "###" not in r.e and "</turn>" not in r.e


def test_mask_covers_assistant_texts(spark, odd):
    talk = spark.read.parquet(f"{odd}/conversations.parquet")
    for r in chat.conversations(chat.chains(talk, "conv_id", "turn")).collect():
        parts = [r.formatted[s.start : s.start + s.length] for s in r.loss]
        assert all(r.formatted[s.start + s.length :].startswith(chat.END) for s in r.loss)
        assert all("### assistant:\n" == r.formatted[s.start - 15 : s.start] for s in r.loss)
        assert len(parts) == r.formatted.count("### assistant:\n")
