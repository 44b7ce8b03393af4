"""Language ID by a bidirectional gated recurrent network over bytes.

The network reads windows of a text's UTF-8 bytes in both directions, labels every
position, and a document's probabilities are the means over its positions. It is
trained here, in numpy, by backpropagation through time on a bounded sample.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casebook.llm import common

#: Documented bounds of the training sample: texts a language, bytes of each.
TEXTS_PER_LANG, SAMPLE_BYTES = 400, 1024
HIDDEN, WINDOW, STEPS, BATCH, RATE = 8, 96, 320, 160, 0.02
#: Windows evaluated side by side.
LANES = 2048
UNKNOWN = "und"


@dataclass
class Network:
    """Weights, features first. Axis 0 of the recurrent ones is the direction.

    embed (2, 3H, 256) holds gate inputs by byte with their biases, turn (2, 3H, H) the
    recurrent weights, rows in the order update, reset, candidate. label (C, 2H) and
    bias (C, 1) label a position from both states.
    """

    langs: list
    embed: np.ndarray
    turn: np.ndarray
    label: np.ndarray
    bias: np.ndarray


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _forward(embed, turn, data):
    """States and gates of one direction; data (T, B) bytes in reading order."""
    steps, lanes = data.shape
    h = np.zeros((HIDDEN, lanes), np.float32)
    kept = []
    for t in range(steps):
        x, u = embed[:, data[t]], turn @ h
        z = _sigmoid(x[:HIDDEN] + u[:HIDDEN])
        r = _sigmoid(x[HIDDEN : 2 * HIDDEN] + u[HIDDEN : 2 * HIDDEN])
        n = np.tanh(x[2 * HIDDEN :] + r * u[2 * HIDDEN :])
        kept.append((h, z, r, n, u[2 * HIDDEN :]))
        h = n + z * (h - n)
    kept.append((h,))
    return kept


def _backward(embed, turn, data, kept, grads):
    """Gradients of one direction from those of its states, grads (T, H, B)."""
    d_embed, d_turn = np.zeros_like(embed), np.zeros_like(turn)
    carry = np.zeros_like(grads[0])
    flat = d_embed.T
    for t in range(len(data) - 1, -1, -1):
        h, z, r, n, u = kept[t]
        d = grads[t] + carry
        dn = d * (1 - z) * (1 - n * n)
        dz = d * (h - n) * z * (1 - z)
        dr = dn * u * r * (1 - r)
        da = np.concatenate([dz, dr, dn])
        du = np.concatenate([dz, dr, dn * r])
        np.add.at(flat, data[t], da.T)
        d_turn += du @ h.T
        carry = d * z + turn.T @ du
    return d_embed, d_turn


def _position_probabilities(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=0))
    return e / e.sum(axis=0)


def train(sample: list, seed: int = 7) -> Network:
    """Fit the network to (language, text) pairs; the same pairs give the same weights."""
    rng = np.random.default_rng(seed)
    langs = sorted({lang for lang, _ in sample})
    texts = {lang: [np.frombuffer(t.encode(), np.uint8) for g, t in sample if g == lang and t] for lang in langs}
    langs = [lang for lang in langs if texts[lang]]
    size = 3 * HIDDEN
    w = [
        rng.normal(0, 0.3, (2, size, 256)).astype(np.float32),
        rng.normal(0, 0.3, (2, size, HIDDEN)).astype(np.float32),
        rng.normal(0, 0.3, (len(langs), 2 * HIDDEN)).astype(np.float32),
        np.zeros((len(langs), 1), np.float32),
    ]
    if len(langs) < 2:
        return Network(langs, *w)
    first, second = [np.zeros_like(x) for x in w], [np.zeros_like(x) for x in w]
    for step in range(1, STEPS + 1):
        truth = rng.integers(len(langs), size=BATCH)
        data = np.full((WINDOW, BATCH), 32, np.uint8)
        for lane, k in enumerate(truth):
            own = texts[langs[k]]
            text = own[rng.integers(len(own))]
            at = rng.integers(max(1, len(text) - WINDOW + 1))
            part = text[at : at + WINDOW]
            data[: len(part), lane] = part
        ahead, back = _forward(w[0][0], w[1][0], data), _forward(w[0][1], w[1][1], data[::-1])
        states = np.stack([
            np.concatenate([ahead[t + 1][0], back[WINDOW - t][0]]) for t in range(WINDOW)
        ])
        probs = np.stack([_position_probabilities(w[2] @ s + w[3]) for s in states])
        probs[:, truth, np.arange(BATCH)] -= 1
        probs /= WINDOW * BATCH
        d_label = np.einsum("tcb,thb->ch", probs, states)
        d_bias = probs.sum(axis=(0, 2))[:, None]
        d_states = np.einsum("ch,tcb->thb", w[2], probs)
        da = _backward(w[0][0], w[1][0], data, ahead, d_states[:, :HIDDEN])
        db = _backward(w[0][1], w[1][1], data[::-1], back, d_states[::-1, HIDDEN:])
        grads = [np.stack([da[0], db[0]]), np.stack([da[1], db[1]]), d_label, d_bias]
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads))
        rate = RATE * min(1.0, 2 * (1 - step / (STEPS + 1)))
        for k, g in enumerate(grads):
            g = g * min(1.0, 1.0 / (norm + 1e-9))
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.99 * second[k] + 0.01 * g * g
            w[k] -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
    return Network(langs, *[x.astype(np.float32) for x in w])


def _lane_sums(net: Network, data: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """(C, B): position probabilities summed over each lane's own positions.

    data (T, B) is in reading order, padded behind. Both directions step together; the
    backward one starts from zero at each lane's last own byte.
    """
    steps, lanes = data.shape
    size = 3 * HIDDEN
    # Half-scaled gates turn both sigmoids into one tanh.
    scale = np.ones((1, size, 1), np.float32)
    scale[:, : 2 * HIDDEN] = 0.5
    embed, turn = net.embed * scale, net.turn * scale
    states = np.empty((steps, 2 * HIDDEN, lanes), np.float32)
    live = np.arange(steps)[:, None] < lengths[None, :]
    for side in (0, 1):
        h = np.zeros((HIDDEN, lanes), np.float32)
        table, w = np.ascontiguousarray(embed[side]), np.ascontiguousarray(turn[side])
        x, u = np.empty((size, lanes), np.float32), np.empty((size, lanes), np.float32)
        zr, n = np.empty((2 * HIDDEN, lanes), np.float32), np.empty((HIDDEN, lanes), np.float32)
        rows = slice(side * HIDDEN, (side + 1) * HIDDEN)
        for t in range(steps) if side == 0 else range(steps - 1, -1, -1):
            np.take(table, data[t], axis=1, out=x, mode="clip")
            np.matmul(w, h, out=u)
            np.add(x[: 2 * HIDDEN], u[: 2 * HIDDEN], out=zr)
            np.tanh(zr, out=zr)
            zr *= np.float32(0.5)
            zr += np.float32(0.5)
            np.multiply(zr[HIDDEN:], u[2 * HIDDEN :], out=n)
            n += x[2 * HIDDEN :]
            np.tanh(n, out=n)
            h -= n
            h *= zr[:HIDDEN]
            h += n
            if side and not live[t].all():
                h *= live[t]
            states[t, rows] = h
    sums = np.zeros((len(net.langs), lanes), np.float64)
    logits = np.empty((len(net.langs), lanes), np.float32)
    for t in range(steps):
        np.matmul(net.label, states[t], out=logits)
        logits += net.bias
        logits -= logits.max(axis=0)
        np.exp(logits, out=logits)
        logits *= live[t] / logits.sum(axis=0)
        sums += logits
    return sums


def probabilities(net: Network, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(C, n): mean position probabilities of each text in a byte buffer."""
    lengths = np.diff(offsets)
    out = np.zeros((len(net.langs), len(lengths)))
    windows = -(-lengths // WINDOW)
    owner = np.repeat(np.arange(len(lengths)), windows)
    first = np.cumsum(windows) - windows
    start = offsets[:-1][owner] + (np.arange(len(owner)) - first[owner]) * WINDOW
    size = np.minimum(WINDOW, offsets[1:][owner] - start)
    padded = np.concatenate([data, np.full(WINDOW, 32, np.uint8)])
    # Short windows together, so that few lanes are padded.
    order = np.argsort(size, kind="stable")
    for at in range(0, len(order), LANES):
        lanes = order[at : at + LANES]
        steps = int(size[lanes].max())
        block = padded[start[lanes][None, :] + np.arange(steps)[:, None]]
        sums = _lane_sums(net, block, size[lanes])
        for k in range(len(net.langs)):
            out[k] += np.bincount(owner[lanes], weights=sums[k], minlength=len(lengths))
    return out / np.maximum(lengths, 1)


def fit(docs: DataFrame, learn: Column) -> Network:
    """Train on the rows that `learn` admits, of them those with text and a language.

    The bound: TEXTS_PER_LANG distinct texts of each language, SAMPLE_BYTES characters
    from a place in each that its hash picks.
    """
    rows = docs.filter(learn & F.col("lang").isNotNull() & (F.length("text") > 0)).select("lang", "text")
    most = F.greatest(F.length("text") - SAMPLE_BYTES, F.lit(0)) + 1
    part = F.substring(F.col("text"), (F.pmod(F.xxhash64("text"), most) + 1).cast("int"), F.lit(SAMPLE_BYTES))
    return train(common.bounded_sample(rows.withColumn("text", part), "lang", TEXTS_PER_LANG, True))


def predict(docs: DataFrame, net: Network) -> DataFrame:
    """All columns of docs with lang_pred and score, of whole texts.

    Null texts and texts without a letter are `und` with score 0, as are all texts if
    nothing could be learned. Columns of docs called lang_pred or score are replaced.
    """
    common.python_ready(docs.sparkSession)
    docs = docs.drop("lang_pred", "score")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    # The weights have a fixed size: a few dozen kilobytes.
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def run(batches):
        net = shared.value
        for batch in batches:
            texts = batch.column("text")
            lettered = np.array(pc.fill_null(pc.match_substring_regex(texts, r"\p{L}"), False))
            data, offsets = common.utf8(texts)
            best = np.zeros(len(texts), np.int64)
            score = np.zeros(len(texts))
            for a, b in common.slices(offsets, 1 << 20):
                if len(net.langs):
                    own = offsets[a : b + 1] - offsets[a]
                    probs = probabilities(net, data[offsets[a] : offsets[b]], own)
                    best[a:b], score[a:b] = probs.argmax(axis=0), probs.max(axis=0)
            named = lettered & bool(net.langs)
            langs = [net.langs[k] if ok else UNKNOWN for k, ok in zip(best, named)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(langs, pa.string()), pa.array(np.clip(np.where(named, score, 0.0), 0, 1))],
                [*batch.schema.names, "lang_pred", "score"],
            )

    return docs.mapInArrow(run, f"{fields}, lang_pred string, score double")


def learnable(id_column: str = "doc_id") -> Column:
    """Rows outside the held-out fifth; a null id is never learned from."""
    return common.fold_of(id_column) != 0


def accepted(docs: DataFrame) -> DataFrame:
    """The documents with a language, columns as they were; a null lang is the predicted one.

    Texts without a letter go. Where no language could be learned, those with a letter
    stay as they are.
    """
    net = fit(docs, learnable())
    if not net.langs:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    texts = predict(docs.select(F.struct(*docs.columns).alias("_row"), "text"), net)
    filled = F.coalesce("_row.lang", "lang_pred").alias("lang")
    columns = [filled if c == "lang" else F.col(f"_row.`{c}`") for c in docs.columns]
    return texts.filter(F.col("lang_pred") != UNKNOWN).select(*columns)


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    net = fit(docs, learnable())
    held = F.coalesce(common.fold_of() == 0, F.lit(False))
    return predict(docs.select("doc_id", "text"), net).select(
        "doc_id", held.alias("held_out"), "lang_pred", "score"
    )
