"""SentencePiece encoding and decoding by an Aho-Corasick automaton and Viterbi.

The pieces of a model file form one automaton over bytes. A text is cut into units that
no piece can cross: white space before a word belongs to the word, a line break stands
alone. Distinct units are encoded side by side in numpy: each step moves every unit's
state by one byte and follows output links to relax the best score at that position.
Unknown characters fall back to byte pieces, so decoding gives the text back exactly.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casebook.llm import common

SPACE = "\N{LOWER ONE EIGHTH BLOCK}"
#: A unit: a line break, or spaces and what follows them. The sign that stands for a
#: space is a unit of its own where a text holds it, encoded by its bytes.
UNIT = re.compile(rf"\n|{SPACE}| *[^ \n{SPACE}]+| +")
#: Cells of the score table that one run of units may take, and units kept encoded.
CELLS, KEPT = 1 << 21, 300_000


def model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Pieces:
    """The automaton of a model file, the encoder and the decoder."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.byte_ids = np.zeros(256, np.int32)
        texts, plain = [b""] * n, []
        for k in range(n):
            piece = model.id_to_piece(k)
            if model.is_byte(k):
                byte = int(piece[1:-1], 16)
                self.byte_ids[byte] = k
                texts[k] = bytes([byte])
            elif not (model.is_control(k) or model.is_unknown(k) or model.is_unused(k)):
                texts[k] = piece.replace(SPACE, " ").encode()
                plain.append((texts[k], k))
        self.score_of = {k: model.get_score(k) for _, k in plain}
        # A byte costs more than any piece, as an unknown character does.
        self.byte_score = min(self.score_of.values(), default=0.0) - 10
        self._build(plain)
        self.sizes = np.array([len(t) for t in texts])
        self.ends = np.cumsum(self.sizes)
        self.bytes = np.frombuffer(b"".join(texts), np.uint8)
        self._forget()

    def _build(self, plain: list) -> None:
        """Trie, then by depth the failure moves, output links and full transitions."""
        used = sorted({b for text, _ in plain for b in text})
        self.symbol = np.zeros(256, np.int64)
        self.symbol[used] = np.arange(1, len(used) + 1)
        children, ends, levels = [{}], {}, []
        for text, k in plain:
            at = 0
            for depth, b in enumerate(text):
                if b not in children[at]:
                    children[at][b] = len(children)
                    if depth == len(levels):
                        levels.append([])
                    levels[depth].append((at, b, len(children)))
                    children.append({})
                at = children[at][b]
            ends[at] = (k, len(text))
        states = len(children)
        move = np.zeros((states, len(used) + 1), np.int32)
        fail, self.link = np.zeros(states, np.int32), np.zeros(states, np.int32)
        self.piece, self.length = np.zeros(states, np.int32), np.zeros(states, np.int32)
        self.score = np.zeros(states)
        for s, (k, length) in ends.items():
            self.piece[s], self.length[s], self.score[s] = k, length, self.score_of[k]
        for depth, level in enumerate(levels):
            parent, byte, child = (np.array(x) for x in zip(*level))
            if depth:
                fail[child] = move[parent, self.symbol[byte]]
            move[parent, self.symbol[byte]] = child
            move[child] = move[fail[child]]
            self.link[child] = np.where(self.length[fail[child]] > 0, fail[child], self.link[fail[child]])
        self.move = move
        self.output = np.where(self.length > 0, np.arange(states), self.link).astype(np.int32)

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.kept_ids, self.kept_ends = [np.zeros(0, np.int32)], [np.zeros(1, np.int64)]

    def _best_paths(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of each unit, one after the other, and how many each has.

        Of paths with equal scores the one whose last piece is longest wins.
        """
        sizes = np.array([len(u) for u in units])
        steps, lanes = int(sizes.max()), len(units)
        data = np.zeros((lanes, steps), np.uint8)
        data[np.arange(steps)[None, :] < sizes[:, None]] = np.frombuffer(b"".join(units), np.uint8)
        data = np.ascontiguousarray(data.T)
        best = np.zeros((steps + 1, lanes))
        back, came = np.zeros((steps + 1, lanes), np.int32), np.ones((steps + 1, lanes), np.int32)
        state = np.zeros(lanes, np.int32)
        for t in range(steps):
            state = self.move[state, self.symbol[data[t]]]
            top, piece, length = best[t] + self.byte_score, self.byte_ids[data[t]], came[t + 1]
            out = self.output[state]
            lane = np.flatnonzero(out)
            out = out[lane]
            top[lane] = -np.inf  # a byte only where no piece ends
            unreached = lane
            while len(lane):
                at = t + 1 - self.length[out]
                value = best[at, lane] + self.score[out]
                more = value > top[lane]
                hit = lane[more]
                top[hit], piece[hit], length[hit] = value[more], self.piece[out[more]], self.length[out[more]]
                out = self.link[out]
                go = out > 0
                lane, out = lane[go], out[go]
            # A piece may start where only part of a character was read; bytes then win.
            by_byte = best[t, unreached] + self.byte_score
            more = by_byte > top[unreached]
            hit = unreached[more]
            top[hit], piece[hit], length[hit] = by_byte[more], self.byte_ids[data[t][hit]], 1
            best[t + 1], back[t + 1] = top, piece
        counts = np.zeros(lanes, np.int64)
        trail = []
        at, lane = sizes.copy(), np.arange(lanes)
        while len(lane):
            trail.append((lane, back[at[lane], lane]))
            counts[lane] += 1
            at[lane] -= came[at[lane], lane]
            lane = lane[at[lane] > 0]
        ids = np.empty(int(counts.sum()), np.int32)
        place = np.cumsum(counts) - 1
        for lane, piece in trail:
            ids[place[lane]] = piece
            place[lane] -= 1
        return ids, counts

    def _learn(self, units: list[str]) -> None:
        """Encode new units, short ones side by side."""
        coded = [u.encode() for u in units]
        order = sorted(range(len(units)), key=lambda k: len(coded[k]))
        at = 0
        while at < len(order):
            end = at + 1
            while end < len(order) and (end - at + 1) * (len(coded[order[end]]) + 1) <= CELLS:
                end += 1
            group = order[at:end]
            ids, counts = self._best_paths([coded[k] for k in group])
            base = len(self.known)
            for j, k in enumerate(group):
                self.known[units[k]] = base + j
            self.kept_ids.append(ids)
            self.kept_ends.append(self.kept_ends[-1][-1] + np.cumsum(counts))
            at = end

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and the n + 1 offsets of the texts.

        A text is read as if a space stood before it; an empty one has no ids.
        """
        split = [UNIT.findall(" " + t) if t else [] for t in texts]
        if len(self.known) > KEPT:
            self._forget()
        new = set().union(*split) - self.known.keys()
        if new:
            self._learn(sorted(new))
            self.kept_ids = [np.concatenate(self.kept_ids)]
            self.kept_ends = [np.concatenate(self.kept_ends)]
        number = [np.fromiter(map(self.known.__getitem__, units), np.int64, len(units)) for units in split]
        counts = np.array([len(x) for x in number], np.int64)
        number = np.concatenate(number) if len(number) else np.zeros(0, np.int64)
        ends = self.kept_ends[0]
        start, size = ends[number], ends[number + 1] - ends[number]
        upto = np.r_[0, np.cumsum(size)]
        ids = self.kept_ids[0][np.repeat(start - upto[:-1], size) + np.arange(upto[-1])]
        return ids, upto[np.r_[0, np.cumsum(counts)]]

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
        """The texts of runs of ids; the space read before each text is taken off."""
        size = self.sizes[ids]
        upto = np.r_[0, np.cumsum(size)]
        data = self.bytes[np.repeat(self.ends[ids] - size - upto[:-1], size) + np.arange(upto[-1])]
        cut = upto[offsets]
        raw = data.tobytes()
        return [raw[a + 1 : b].decode("utf-8", "replace") for a, b in zip(cut[:-1], cut[1:])]


_LOADED: dict[str, Pieces] = {}


def load(path: str) -> Pieces:
    """The automaton of a model file, built once in a worker."""
    if path not in _LOADED:
        _LOADED[path] = Pieces(path)
    return _LOADED[path]


def _encoded(batch: pa.RecordBatch, path: str):
    """Row ranges of a batch with their texts, ids and offsets."""
    pieces = load(path)
    texts = batch.column("text")
    _, offsets = common.utf8(texts)
    for a, b in common.slices(offsets, 1 << 20):
        own = [t or "" for t in texts.slice(a, b - a).to_pylist()]
        ids, ends = pieces.encode(own)
        yield a, b, own, ids, ends


def encode(docs: DataFrame, path: str, keep_text: bool = True) -> DataFrame:
    """All columns of docs, ids and exact: piece ids of the whole text, and whether
    decoding them gave the text back.

    Null and empty texts have empty arrays. Columns called ids or exact are replaced;
    `keep_text=False` leaves the text out. The model file's path must hold on every
    executor.
    """
    common.python_ready(docs.sparkSession)
    docs = docs.drop("ids", "exact")
    others = [c for c in docs.columns if c != "text"]
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in others]).alias("_row"), "text")

    def run(batches):
        for batch in batches:
            pieces = load(path)
            for a, b, own, ids, ends in _encoded(batch, path):
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids))
                same = pa.array([x == y for x, y in zip(own, pieces.decode(ids, ends))], pa.bool_())
                kept = [batch.column("text").slice(a, b - a)] if keep_text else []
                yield pa.RecordBatch.from_arrays(
                    [batch.column("_row").slice(a, b - a), *kept, lists, same], ["_row", *["text"] * keep_text, "ids", "exact"]
                )

    text = ["text string"] * keep_text
    schema = ", ".join([f"_row {row.schema['_row'].dataType.simpleString()}", *text, "ids array<int>", "exact boolean"])
    return row.mapInArrow(run, schema).select("_row.*", *["text"] * keep_text, "ids", "exact")


def decode(rows: DataFrame, path: str) -> DataFrame:
    """All columns of rows and text, decoded from ids; null ids give null, `text` is replaced."""
    common.python_ready(rows.sparkSession)
    rows = rows.drop("text")
    row = rows.select(F.struct(*rows.columns).alias("_row"), "ids")

    def run(batches):
        for batch in batches:
            lists = batch.column("ids")
            ends = np.r_[0, np.cumsum([0 if x is None else x for x in lists.value_lengths().to_pylist()])].astype(np.int64)
            texts = load(path).decode(np.asarray(lists.flatten()), ends)
            texts = [t if ok else None for t, ok in zip(texts, lists.is_valid().to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("_row"), pa.array(texts, pa.string())], ["_row", "text"])

    schema = f"_row {row.schema['_row'].dataType.simpleString()}, text string"
    return row.mapInArrow(run, schema).select("_row.*", "text")


def round_trips(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_pieces, n_bytes, ids_crc32, exact: encoded, decoded and compared whole.

    n_bytes counts byte pieces, ids_crc32 is over the ids as little-endian 32-bit
    integers, exact tells whether decoding gave the text back (null: empty).
    """
    common.python_ready(docs.sparkSession)
    rows = docs.select("doc_id", "text")

    def run(batches):
        for batch in batches:
            pieces = load(path)
            is_byte = np.zeros(len(pieces.sizes), bool)
            is_byte[pieces.byte_ids] = True
            for a, b, own, ids, ends in _encoded(batch, path):
                back = pieces.decode(ids, ends)
                fallback = np.r_[0, np.cumsum(is_byte[ids])][ends]
                raw = ids.astype("<u4")
                crc = [zlib.crc32(raw[x:y]) for x, y in zip(ends[:-1], ends[1:])]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(a, b - a), pa.array(np.diff(ends)),
                        pa.array(np.diff(fallback)), pa.array(crc, pa.int64()),
                        pa.array([x == y for x, y in zip(own, back)], pa.bool_()),
                    ],
                    ["doc_id", "n_pieces", "n_bytes", "ids_crc32", "exact"],
                )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_pieces long, n_bytes long, ids_crc32 long, exact boolean")


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    return round_trips(docs, model_path())
