"""Quality, language, SentencePiece, token files, fingerprints."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from casebook.llm import langid, phrases, pieces, quality, token_files
from casebook.session import scratch_path
from tests.llm import brute
from tests.llm.conftest import SF_DIR, prose

LARGER = "/root/testdata/sf0.1"


def test_quality_on_held_out_rows(spark):
    rows = {r.doc_id: r for r in quality.op1(spark, LARGER).collect()}
    labels = spark.read.parquet(f"{LARGER}/labels.parquet").collect()
    held = [(rows[r.doc_id], r.quality) for r in labels if rows[r.doc_id].held_out]
    assert np.mean([r.predicted == q for r, q in held]) > 0.97
    assert np.mean([r.predicted for r, q in held if q]) > 0.98
    assert all(r.held_out == brute.held_out(r.doc_id) and 0 <= r.score <= 1 for r in rows.values())
    assert all(r.predicted == (r.score >= 0.3) for r in rows.values())


def test_votes_are_those_of_the_nearest():
    rng = np.random.default_rng(3)
    counts = np.log1p(rng.poisson(0.05, (300, quality.TERMS))).astype(np.float32)
    labels = rng.integers(0, 2, 300).astype(float)
    voters = quality.fit(counts, labels)
    asked = counts[:40] + np.log1p(rng.poisson(0.01, (40, quality.TERMS)))
    vectors = (asked * voters.weights) @ voters.directions
    for k, v in enumerate(vectors):
        near = sorted(((float(v @ w) / np.linalg.norm(v), y) for w, y in zip(voters.vectors, labels)), reverse=True)
        near = [(max(c, 0) ** quality.SHARPNESS, y) for c, y in near[: quality.NEIGHBOURS]]
        want = sum(w * y for w, y in near) / sum(w for w, _ in near)
        assert quality.vote(voters, asked[k : k + 1])[0] == pytest.approx(want, abs=1e-3)


def test_term_counts_do_not_depend_on_neighbours_or_stretches():
    texts = [b"ab AB 12 !!", b"", b"x", "é one one one one".encode(), b"long " * 150_000]
    data = np.frombuffer(b"".join(texts), np.uint8)
    together = quality.term_counts(data, np.r_[0, np.cumsum([len(t) for t in texts])])
    for k, t in enumerate(texts):
        alone = quality.term_counts(np.frombuffer(t, np.uint8), np.array([0, len(t)]))
        assert np.array_equal(alone[0], together[k])
    assert not together[1].any() and together[4].max() == pytest.approx(np.log1p(150_000), abs=1e-3)


def test_equal_texts_score_alike(spark, odd):
    rows = quality.op1(spark, odd).collect()
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{odd}/documents.parquet").collect()}
    by_text = {}
    for r in rows:
        by_text.setdefault(texts[r.doc_id], set()).add(round(r.score, 9))
    assert all(len(s) == 1 for s in by_text.values())


def test_language_on_held_out_rows(spark):
    rows = {r.doc_id: r for r in langid.op9(spark, LARGER).collect()}
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{LARGER}/documents.parquet").collect()}
    held = [k for k, r in rows.items() if r.held_out]
    assert np.mean([rows[k].lang_pred == truth[k] for k in held]) > 0.97
    assert all(r.held_out == brute.held_out(k) for k, r in rows.items())


def test_language_of_texts_without_letters(spark, odd):
    rows = {r.doc_id: r for r in langid.op9(spark, odd).collect()}
    assert {k for k, r in rows.items() if r.lang_pred == "und"} == {5, 6, 7, 8, 9, 18}
    assert {r.lang_pred for r in rows.values()} <= {"en", "de", "fr", "und"}
    assert all(rows[k].score == 0 for k in (5, 6, 18))


def test_gradients_of_the_recurrent_network():
    rng = np.random.default_rng(0)
    embed = rng.normal(size=(3 * langid.HIDDEN, 256))
    turn = rng.normal(size=(3 * langid.HIDDEN, langid.HIDDEN)) * 0.4
    data = rng.integers(0, 6, (7, 3)).astype(np.uint8)
    weight = rng.normal(size=(7, langid.HIDDEN, 3))

    def loss(e, t):
        kept = langid._forward(e, t, data)
        return sum(float((weight[k] * kept[k + 1][0]).sum()) for k in range(7))

    d_embed, d_turn = langid._backward(embed, turn, data, langid._forward(embed, turn, data), weight)
    for array, gradient in ((embed, d_embed), (turn, d_turn)):
        for at in [tuple(rng.integers(0, [n if n < 256 else 6 for n in array.shape])) for _ in range(12)]:
            moved = [array.copy(), array.copy()]
            moved[0][at] += 1e-5
            moved[1][at] -= 1e-5
            pair = [(m, turn) if array is embed else (embed, m) for m in moved]
            slope = (loss(*pair[0]) - loss(*pair[1])) / 2e-5
            assert gradient[at] == pytest.approx(slope, rel=1e-2, abs=2e-3)


def test_windows_are_labelled_one_by_one():
    sample = [("a", "abab " * 60), ("b", "xyxy " * 60)]
    net = langid.train(sample)
    texts = [b"abab xyxy " * 40, b"", b"q", b"abab"]
    data = np.frombuffer(b"".join(texts), np.uint8)
    got = langid.probabilities(net, data, np.r_[0, np.cumsum([len(t) for t in texts])])
    for k, text in enumerate(texts):
        total = np.zeros(2)
        for at in range(0, len(text), langid.WINDOW):
            part = np.frombuffer(text[at : at + langid.WINDOW], np.uint8)[:, None]
            ahead = langid._forward(net.embed[0], net.turn[0], part)
            back = langid._forward(net.embed[1], net.turn[1], part[::-1])
            for t in range(len(part)):
                state = np.concatenate([ahead[t + 1][0], back[len(part) - t][0]])
                total += langid._position_probabilities(net.label @ state + net.bias)[:, 0]
        assert np.allclose(got[:, k], total / max(len(text), 1), atol=1e-4)


def test_pieces_against_a_plain_search(small):
    path = pieces.model_path()
    coder = pieces.load(path)
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    plain = {
        model.id_to_piece(k).replace(pieces.SPACE, " ").encode(): (k, model.get_score(k))
        for k in range(model.get_piece_size())
        if not (model.is_byte(k) or model.is_control(k) or model.is_unknown(k))
    }
    texts = [t[:600] for _, t in small[:40]] + ["  a   b ", "wörld\n\n\tß 門 \U0001f600", "x" * 400, "\n", " "]
    ids, ends = coder.encode(texts)
    for k, text in enumerate(texts):
        assert ids[ends[k] : ends[k + 1]].tolist() == brute.best_path(text, plain, coder.byte_ids, coder.byte_score)
    # What the model's own decoder reads.
    assert [model.decode(ids[a:b].tolist()) for a, b in zip(ends[:40], ends[1:41])] == texts[:40]


def test_pieces_round_trip(spark, odd):
    docs = spark.read.parquet(f"{odd}/documents.parquet")
    path = pieces.model_path()
    encoded = pieces.encode(docs, path)
    assert sorted(encoded.columns) == sorted({*docs.columns, "ids", "exact"}) and encoded.filter("NOT exact").count() == 0
    back = pieces.decode(encoded, path)
    assert sorted(back.columns) == sorted(encoded.columns)
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert all(r.text == (texts[r.doc_id] or "") for r in back.collect())
    assert all(r.exact for r in pieces.op5(spark, odd).collect())
    nothing = spark.createDataFrame([(1, None), (2, [])], "k int, ids array<int>")
    assert {r.k: r.text for r in pieces.decode(nothing, path).collect()} == {1: None, 2: ""}


def test_token_files_against_whole_texts(spark, small, odd):
    tokenizer = Tokenizer.from_file(token_files.tokenizer_path())
    want = brute.token_rows(small, tokenizer)
    assert {r.doc_id: tuple(r)[1:] for r in token_files.op6(spark, SF_DIR).collect()} == want
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{odd}/documents.parquet").collect()]
    want = brute.token_rows([(d, t or "") for d, t in rows], tokenizer)
    got = [r for r in token_files.op6(spark, odd).collect()]
    assert all(r.n_tokens == want[r.doc_id][1] and r.ids_crc32 == want[r.doc_id][2] for r in got)
    ordered = sorted(got, key=lambda r: r.start)
    assert [r.doc_id for r in ordered] == sorted(r.doc_id for r in got)
    assert all(a.start + a.n_tokens == b.start for a, b in zip(ordered, ordered[1:]))


def test_token_files_read_whole_ids(spark, small):
    path = scratch_path(spark, "token-files-test")
    docs = spark.createDataFrame(small[:30], "doc_id long, text string")
    token_files.write(docs, path, token_files.tokenizer_path())
    tokenizer = Tokenizer.from_file(token_files.tokenizer_path())
    texts = dict(small[:30])
    for r in token_files.read(spark, path).collect():
        assert r.ids == tokenizer.encode(texts[r.doc_id], add_special_tokens=False).ids + [token_files.END_ID]


@pytest.mark.parametrize("n", [0, 1, 3, 4, 5, 4097])
def test_codes_of_every_size(n):
    rng = np.random.default_rng(n)
    few = np.minimum(rng.zipf(1.3, n), 70_000)
    for ids in (few, rng.integers(0, 1 << 32, n), np.zeros(n, np.int64)):
        table, control, data = token_files.pack(ids.astype(np.int64))
        assert token_files.unpack(table, control, data, n).tolist() == ids.tolist()
        frequent = [k for k, _ in sorted(Counter(ids.tolist()).items(), key=lambda x: (-x[1], x[0]))]
        assert np.frombuffer(table, "<u4").tolist() == frequent
        assert len(control) == -(-n // 4)


def test_fingerprints_of_edited_texts(spark, small, odd, monkeypatch):
    monkeypatch.setattr(phrases, "RANGE", 16)
    found = {r.doc_id: r for r in phrases.op4(spark, SF_DIR).collect()}
    rows = sorted(small, reverse=True)
    plain = [brute.phrase_sketch(t) for _, t in rows]
    text = lambda sketch: "".join(f"{level << 30 | x:08x}" for level, names in enumerate(sketch) for x in sorted(names))
    for k, (d, t) in enumerate(rows):
        following = (k + 1) % len(rows)
        third = len(t) // 3
        changed = t[: len(t) - third] + rows[following][1][:third]
        assert found[d].n_chars == len(t)
        assert found[d].edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        new = brute.phrase_sketch(changed)
        assert (found[d].fingerprint, found[d].edited_fingerprint) == (text(plain[k]), text(new))
        assert found[d].near_edited == pytest.approx(brute.phrase_likeness(plain[k], new))
        assert found[d].near_next == pytest.approx(brute.phrase_likeness(plain[k], plain[following]))
    long = [r for r in found.values() if r.n_chars > 400]
    assert np.mean([r.near_edited > 0.4 for r in long]) > 0.97
    assert np.mean([r.near_next < 0.2 for r in long]) > 0.97
    odd_rows = phrases.op4(spark, odd).collect()
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in odd_rows)
    assert {r.fingerprint for r in odd_rows if r.n_chars == 0} == {""}


@pytest.mark.parametrize("words", range(8, 41, 2))
def test_short_texts_have_no_cliff(words):
    rng = random.Random(words)
    texts = [prose(rng, words) for _ in range(200)]
    near, far = [], []
    for a, b in zip(texts, texts[1:]):
        x, y, z = phrases.sketches([t.encode() for t in (a, phrases.edited(a, b), b)])
        near.append(phrases.likeness(x, y))
        far.append(phrases.likeness(x, z))
    assert np.mean(near) > 0.55 and np.mean(np.array(near) < 0.3) < 0.02
    assert np.mean(far) < 0.2


def test_ranges_of_ids(spark):
    for cuts in ([], [5], list(range(0, 3000, 7))):
        ids = [-9, 0, 1, 5, 6, 7, 2990, 2996, 2997, 10**15]
        got = spark.createDataFrame([(k,) for k in ids], "k long").select("k", phrases._below(F.col("k"), cuts).alias("n")).collect()
        assert {r.k: r.n for r in got} == {k: sum(c < k for c in cuts) for k in ids}


@pytest.mark.parametrize("before", [b"", b"x", b"zzz 9 ", b"another beginning of some length"])
def test_equal_substrings_share_phrases(small, before):
    text = small[3][1].encode()
    alone, shifted = (
        [set(names.tolist()) for names, _ in phrases.levels(np.frombuffer(t, np.uint8), np.array([0, len(t)]))]
        for t in (text, before + text)
    )
    for a, b in zip(alone, shifted):
        # A few phrases at the start may differ at each level, none inside.
        assert len(a - b) <= 4


def test_texts_are_parsed_alone():
    texts = [b"abcabd" * 30, b"q", b"aaaa", b"abcabd" * 30, b""]
    together = phrases.sketches(texts)
    assert all(np.array_equal(together[k], phrases.sketches([t])[0]) for k, t in enumerate(texts))
    assert phrases.likeness(together[0], together[3]) == 1.0 and phrases.likeness(together[0], together[4]) == 0.0
