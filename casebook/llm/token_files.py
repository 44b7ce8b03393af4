"""Token files: frequency-ranked ids in a byte-aligned code with separate control bytes.

Documents are sorted by id, encoded and cut into blocks. A block ranks its ids by
frequency and stores each id as its rank in one to four bytes; two bits of a control
byte tell how many. Control bytes and data bytes lie apart, so a reader finds all
places by a table lookup and a running sum. Every block carries its own rank table
(most frequent id first), so files are written in one pass and read independently.

The files are Parquet, one row a block: shard, before (ids of the shard before the
block), n_ids, doc_ids, lengths, table, control, data. They can lie in any store that Spark writes, under its commit protocol.
"""

from __future__ import annotations

import os
import re
import zlib
from itertools import chain, compress

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from casebook.llm import common
from casebook.session import scratch_path

END_ID = 2
#: Bytes of text in a block, words kept encoded in a worker, words encoded at a time.
BLOCK, KEPT, SLICE = 3 << 21, 300_000, 2048
FIELDS = (
    "shard int, before long, n_ids long, doc_ids array<long>, lengths array<long>, "
    "table binary, control binary, data binary"
)

#: For every control byte, the sizes of its four values.
SIZES = np.stack([(np.arange(256) >> (2 * k) & 3) + 1 for k in range(4)], axis=1)


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class Encoder:
    """The tokenizers library over whole texts, each distinct unit encoded once.

    The tokenizer lower-cases, drops white space and never joins words across it; signs
    behind an ASCII letter or digit are pieces of their own to it. So a text's ids are
    those of its lower-cased words and the signs that end them, one after the other.
    Texts that may hold special tokens are only cut at white space.

    Words of Latin letters alone pass the tokenizer's normaliser and splitter in one
    piece, so they go straight to its merge model, a byte a symbol; all else goes
    through the whole tokenizer.
    """

    #: Stands between units in one call of the library and in no unit itself.
    MARK = b"\x01"
    #: Ends a document; no byte of UTF-8.
    END = b"\xff"
    SIGNS = re.compile(rb"(?<=[a-z0-9])[.,;:!?|]+(?![^ \t-\r])")
    #: Small letters of ASCII and Latin-1 and capitals of the latter, all composed.
    LETTERS = re.compile("[a-z\u00c0-\u00d6\u00d8-\u00de\u00df-\u00f6\u00f8-\u00ff]+")

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        bytewise = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        letters = filter(self.LETTERS.fullmatch, map(chr, range(256)))
        self.symbols = {ord(c): bytewise.pre_tokenize_str(c.lower())[0][0] for c in letters}
        (self.mark,) = self.tokenizer.encode(self.MARK.decode(), add_special_tokens=False).ids
        # The first unit ends a document.
        self.known: dict[bytes, int] = {self.END: 0}
        self.flat, self.size = np.zeros(1, np.int64), np.ones(1, np.int64)

    def units(self, texts: list[bytes]) -> list[bytes]:
        """Units of all texts, END after each."""
        between = b" " + self.END + b" "
        if any(b"<|" in t for t in texts):
            texts = [t if b"<|" in t else self.SIGNS.sub(rb" \g<0>", t.lower()) for t in texts]
            return between.join([*texts, b""]).split()
        return self.SIGNS.sub(rb" \g<0>", between.join([*texts, b""]).lower()).split()

    def _coded(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of units, one after the other, and how many each has."""
        plain, others, tokens = [], [], []
        for k, unit in enumerate(map(bytes.decode, units)):
            if self.LETTERS.fullmatch(unit):
                plain.append(k)
                tokens.append([t.id for t in self.model.tokenize(unit.translate(self.symbols))])
            else:
                others.append(k)
        flat, size = self._whole([units[k] for k in others]) if others else (self.flat[:0], self.size[:0])
        sizes = np.empty(len(units), np.int64)
        sizes[plain], sizes[others] = list(map(len, tokens)), size
        first = np.cumsum(sizes) - sizes
        out = np.empty(int(sizes.sum()), np.int64)
        for at, runs, ids in ((plain, sizes[plain], chain.from_iterable(tokens)), (others, size, flat)):
            shift = np.cumsum(runs) - runs
            out[np.repeat(first[at] - shift, runs) + np.arange(runs.sum())] = np.fromiter(ids, np.int64, int(runs.sum()))
        return out, sizes

    def _whole(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The same through the whole tokenizer."""
        odd = [k for k, u in enumerate(units) if self.MARK in u]
        alone = {k: self.tokenizer.encode(units[k].decode(), add_special_tokens=False).ids for k in odd}
        ids, sizes = [], []
        # The library's results are large: a slice at a time, and only the ids stay.
        for at in range(0, len(units), SLICE):
            part = [b"" if at + k in alone else u for k, u in enumerate(units[at : at + SLICE])]
            text = (b" " + self.MARK + b" ").join([*part, b""]).decode()
            found = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.int64)
            marks = np.flatnonzero(found == self.mark)
            ids.append(np.delete(found, marks))
            sizes.append(np.diff(marks, prepend=-1) - 1)
        flat, size = np.concatenate(ids), np.concatenate(sizes)
        if alone:
            runs = np.split(flat, np.cumsum(size)[:-1])
            runs = [np.array(alone[k], np.int64) if k in alone else r for k, r in enumerate(runs)]
            flat, size = np.concatenate(runs), np.array([len(r) for r in runs], np.int64)
        return flat, size

    def encode(self, texts: list[bytes], end: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, `end` after each, and how many each text has."""
        units, known = self.units(texts), self.known
        new = list(set(units).difference(known))
        flat, size = self._coded(new) if new else (self.flat[:0], self.size[:0])
        base = len(self.size)
        known.update(zip(new, range(base, base + len(new))))
        unit = np.fromiter(map(known.__getitem__, units), np.int64, len(units))
        sizes, every = np.concatenate([self.size, size]), np.concatenate([self.flat, flat])
        every[0] = end
        first = np.cumsum(sizes) - sizes
        each = sizes[unit]
        upto = np.r_[0, np.cumsum(each)]
        out = every[np.repeat(first[unit] - upto[:-1], each) + np.arange(upto[-1])]
        ends = upto[np.flatnonzero(unit == 0) + 1]
        # Units met once are rarely met again: only the others are kept, while there is room.
        often = np.bincount(unit, minlength=len(sizes))[base:] > 1
        often[np.cumsum(often) > KEPT - base] = False
        kept = np.flatnonzero(often)
        for unit_of_one in compress(new, ~often):
            del known[unit_of_one]
        known.update(zip(compress(new, often), range(base, base + len(kept))))
        runs = size[kept]
        shift = np.cumsum(runs) - runs
        place = np.repeat((np.cumsum(size) - size)[kept] - shift, runs) + np.arange(runs.sum())
        self.flat, self.size = np.concatenate([self.flat, flat[place]]), np.concatenate([self.size, runs])
        return out, np.diff(ends, prepend=0)


_LOADED: dict[str, Encoder] = {}


def load(path: str) -> Encoder:
    if path not in _LOADED:
        _LOADED[path] = Encoder(path)
    return _LOADED[path]


def pack(ids: np.ndarray) -> tuple[bytes, bytes, bytes]:
    """Rank table, control bytes and data bytes of ids from 0 to 2^32 - 1.

    Of ids as frequent as one another the smaller ranks first.
    """
    if len(ids) and ids.max() < 1 << 22:
        # Vocabularies are small: counting beats sorting.
        counts = np.bincount(ids)
        distinct = np.flatnonzero(counts)
        count, place = counts[distinct], (np.cumsum(counts > 0) - 1)[ids]
    else:
        distinct, place, count = np.unique(ids, return_inverse=True, return_counts=True)
    order = np.lexsort((distinct, -count))
    rank = np.empty(len(order), np.uint32)
    rank[order] = np.arange(len(order), dtype=np.uint32)
    values = rank[place]
    extra = (values > 0xFF).astype(np.uint8) + (values > 0xFFFF) + (values > 0xFFFFFF)
    padded = np.zeros(-(-len(values) // 4) * 4, np.uint8)
    padded[: len(values)] = extra
    quads = padded.reshape(-1, 4)
    control = quads[:, 0] | quads[:, 1] << 2 | quads[:, 2] << 4 | quads[:, 3] << 6
    wide = values.astype("<u4").view(np.uint8).reshape(-1, 4)
    data = wide[np.arange(4)[None, :] <= extra[:, None]]
    return distinct[order].astype("<u4").tobytes(), control.astype(np.uint8).tobytes(), data.tobytes()


def unpack(table: bytes, control: bytes, data: bytes, n: int) -> np.ndarray:
    """The n ids that `pack` stored."""
    size = SIZES[np.frombuffer(control, np.uint8)].ravel()[:n]
    at = np.cumsum(size) - size
    raw = np.concatenate([np.frombuffer(data, np.uint8), np.zeros(3, np.uint8)]).astype(np.uint32)
    values = raw[at]
    for k in range(1, int(size.max(initial=1))):
        values = values | np.where(size > k, raw[at + k] << np.uint32(8 * k), np.uint32(0))
    return np.frombuffer(table, "<u4")[values]


def write(docs: DataFrame, path: str, tokenizer: str, end: int = END_ID) -> None:
    """Write the ids of every whole text, `end` after each, in ascending order of doc_id.

    Null texts are empty and have the end mark alone. Null ids come first, repeated ids
    go by text. Shards are ranges of ids. Other columns are not read; an empty table
    gives no blocks.
    """
    common.python_ready(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    dealt = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")

    def run(batches):
        shard, before = TaskContext.get().partitionId(), 0
        ids, texts, size = [], [], 0
        for batch in batches:
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.large_binary())):
                ids.append(doc)
                texts.append(text.as_py())
                size += len(texts[-1])
                if size >= BLOCK:
                    done = packed(shard, before, ids, texts)
                    yield done
                    before += done.column("n_ids")[0].as_py()
                    ids, texts, size = [], [], 0
        if ids:
            yield packed(shard, before, ids, texts)

    def packed(shard, before, ids, texts):
        tokens, lengths = load(tokenizer).encode(texts, end)
        table, control, data = pack(tokens)
        return pa.RecordBatch.from_pydict({
            "shard": pa.array([shard], pa.int32()), "before": pa.array([before], pa.int64()),
            "n_ids": pa.array([len(tokens)], pa.int64()),
            "doc_ids": pa.array([ids], pa.list_(pa.int64())),
            "lengths": pa.array([lengths.tolist()], pa.list_(pa.int64())),
            "table": pa.array([table], pa.binary()), "control": pa.array([control], pa.binary()),
            "data": pa.array([data], pa.binary()),
        })

    dealt.mapInArrow(run, FIELDS).write.parquet(path)


def _placed(spark: SparkSession, path: str) -> DataFrame:
    """The blocks with `start`, the number of ids before them."""
    blocks = spark.read.schema(FIELDS).parquet(path)
    sizes = blocks.groupBy("shard").agg(F.sum("n_ids").alias("total"))
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = sizes.select("shard", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("shard_start"))
    # Stored first, so that its size is known when it is joined with the blocks.
    shards = common.stored(shards, "shard-starts")
    return blocks.join(shards, "shard").withColumn("start", F.col("shard_start") + F.col("before")).drop("shard_start")


def _decoded(spark: SparkSession, path: str, field: str, made) -> DataFrame:
    common.python_ready(spark)
    name = field.split(" ")[0]

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids = unpack(row["table"], row["control"], row["data"], row["n_ids"])
                ends = np.cumsum(row["lengths"])
                starts = ends - row["lengths"]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row["doc_ids"], pa.int64()), pa.array(row["start"] + starts),
                        pa.array(row["lengths"], pa.int64()), made(ids, starts, ends),
                    ],
                    ["doc_id", "start", "n_tokens", name],
                )

    return _placed(spark, path).mapInArrow(run, f"doc_id long, start long, n_tokens long, {field}")


def read(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids of every document; start counts all ids before it.

    One running sum over a row a shard gives the blocks' starts; ids are decoded block
    by block.
    """

    def lists(ids, starts, ends):
        return pa.ListArray.from_arrays(pa.array(np.r_[0, ends].astype(np.int32)), pa.array(ids.astype(np.int64)))

    return _decoded(spark, path, "ids array<long>", lists)


def checksums(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32, over the decoded ids as 32-bit little-endian."""

    def crcs(ids, starts, ends):
        raw = memoryview(ids.astype("<u4")).cast("B")
        return pa.array([zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist())], pa.int64())

    return _decoded(spark, path, "ids_crc32 long", crcs)


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    write(common.table(spark, sf_dir, "documents").select("doc_id", "text"), path, tokenizer_path())
    return checksums(spark, path)
