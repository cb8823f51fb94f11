"""Token-id files: blocks of concatenated ids with Elias-Fano encoded document boundaries.

A file holds blocks in ascending document order. A block has the ids of its documents in one
array, and two Elias-Fano sequences: the document ids and the place of each document's first
id. An Elias-Fano sequence of n values below u takes about n * (2 + log2(u / n)) bits; a sampled
select structure finds the i-th value in constant time without reading those before it.

Files are written and committed by Spark (a block is one binary value), so a lost executor or a
repeated task leaves no partial block, and any store that Spark writes to will do."""

from __future__ import annotations

import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import checkpoint_dir
from .common import map_batches
from .encoders import chunk_encoder, packed_ids

#: Id behind each document; ids of a block (a block has one document at least).
END, BLOCK_IDS = 2, 1 << 20
#: Every so many ones the select structure notes a position.
SAMPLE = 64
MAGIC = b"EFT1"


class EliasFano:
    """A non-decreasing sequence of integers from 0 on, in near-minimal space."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, notes: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.notes = n, low_bits, low, high, notes

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.uint64)
        n = len(values)
        last = int(values[-1]) if n else 0
        width = max(0, (last // max(n, 1)).bit_length() - 1)
        shifts = np.arange(width, dtype=np.uint64)
        low = np.packbits(((values[:, None] >> shifts) & np.uint64(1)).astype(np.uint8).ravel(),
                          bitorder="little")
        at = (values >> np.uint64(width)).astype(np.int64) + np.arange(n)
        bits = np.zeros(int(at[-1]) + 1 if n else 0, np.uint8)
        bits[at] = 1
        return cls(n, width, low, np.packbits(bits, bitorder="little"),
                   at[::SAMPLE].astype("<u4"))

    def to_bytes(self) -> bytes:
        head = struct.pack("<IBIII", self.n, self.low_bits, len(self.low), len(self.high),
                           len(self.notes))
        return head + self.low.tobytes() + self.high.tobytes() + self.notes.tobytes()

    @classmethod
    def read(cls, data: memoryview, at: int) -> tuple[EliasFano, int]:
        n, width, a, b, c = struct.unpack_from("<IBIII", data, at)
        at += struct.calcsize("<IBIII")
        low = np.frombuffer(data, np.uint8, a, at)
        high = np.frombuffer(data, np.uint8, b, at + a)
        notes = np.frombuffer(data, "<u4", c, at + a + b)
        return cls(n, width, low, high, notes), at + a + b + 4 * c

    def _low(self, i: np.ndarray) -> np.ndarray:
        out = np.zeros(len(i), np.uint64)
        for k in range(self.low_bits):
            bit = i * self.low_bits + k
            out |= ((self.low[bit >> 3] >> (bit & 7)) & 1).astype(np.uint64) << np.uint64(k)
        return out

    def select(self, i: int) -> int:
        """The i-th value: from the noted one before it, through at most SAMPLE - 1 ones."""
        pos, skip = int(self.notes[i // SAMPLE]), i % SAMPLE
        byte = pos >> 3
        word = int(self.high[byte]) >> (pos & 7) << (pos & 7)
        while (ones := word.bit_count()) <= skip:
            skip -= ones
            byte += 1
            word = int(self.high[byte])
        for _ in range(skip):
            word &= word - 1
        pos = 8 * byte + (word & -word).bit_length() - 1
        return (pos - i << self.low_bits) | int(self._low(np.array([i]))[0])

    def all(self) -> np.ndarray:
        """Every value, in one pass over the bits."""
        i = np.arange(self.n)
        at = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[:self.n]
        return ((at - i).astype(np.uint64) << np.uint64(self.low_bits)) | self._low(i)


def block(doc_ids: list[int | None], ids: list[bytes], width: int) -> bytes:
    """doc_ids ascending, nulls first; ids: each document's, in width bytes an id."""
    known = np.array([d for d in doc_ids if d is not None], np.int64)
    base = int(known[0]) if len(known) else 0
    apart = (known.astype(np.uint64) - np.array([base], np.int64).astype(np.uint64))
    ends = np.cumsum([len(x) // width for x in ids], dtype=np.uint64)
    head = MAGIC + struct.pack("<BIIq", width, len(ids), len(ids) - len(known), base)
    bounds = EliasFano.of(np.concatenate([np.zeros(1, np.uint64), ends]))
    return head + EliasFano.of(apart).to_bytes() + bounds.to_bytes() + b"".join(ids)


class Block:
    """A block read back: document i has the id doc_id(i) and the ids of tokens(i)."""

    def __init__(self, data: bytes):
        view = memoryview(data)
        if bytes(view[:4]) != MAGIC:
            raise ValueError("not a token block")
        self.width, self.n, self.nulls, self.base = struct.unpack_from("<BIIq", view, 4)
        self.docs, at = EliasFano.read(view, 4 + struct.calcsize("<BIIq"))
        self.bounds, self.at = EliasFano.read(view, at)
        self.view = view

    def doc_id(self, i: int) -> int | None:
        if i < self.nulls:
            return None
        return self.base + self.docs.select(i - self.nulls)

    def doc_ids(self) -> list[int | None]:
        return [None] * self.nulls + [self.base + int(x) for x in self.docs.all()]

    def tokens(self, i: int) -> np.ndarray:
        """The ids of one document, found by two selects."""
        return self._between(self.bounds.select(i), self.bounds.select(i + 1))

    def _between(self, a: int, z: int) -> np.ndarray:
        return np.frombuffer(self.view, f"<u{self.width}", z - a, self.at + a * self.width)


def write_store(docs: DataFrame, folder: str, path: str, drops_space: bool, end: int = END,
                width: int = 2) -> None:
    """Encode docs (doc_id, text, any others) and write the files to folder.

    Documents are dealt out by ranges of their ids, equal ids also by their texts, so shards
    follow each other in ascending order and no id's rows need to fit in one task. Null ids
    come first, null texts are empty."""
    shards = max(docs.rdd.getNumPartitions(), 1)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    tie = F.xxhash64("text")
    rows = rows.repartitionByRange(shards, "doc_id", tie).sortWithinPartitions("doc_id", tie)

    def blocks(batches):
        encoder = chunk_encoder(path, drops_space)
        shard, number, first = TaskContext.get().partitionId(), 0, 0
        names: list[int | None] = []
        parts: list[bytes] = []
        size = 0

        def out():
            nonlocal names, parts, size, number, first
            row = pa.RecordBatch.from_pydict({
                "shard": pa.array([shard], pa.int32()), "block": pa.array([number], pa.int32()),
                "first": pa.array([first], pa.int64()), "n_ids": pa.array([size], pa.int64()),
                "data": pa.array([block(names, parts, width)], pa.binary())})
            number, first = number + 1, first + size
            names, parts, size = [], [], 0
            return row

        for b in batches:
            texts, ids = b.column("text").to_pylist(), b.column("doc_id").to_pylist()
            for doc_id, x in zip(ids, encoder.encode(texts)):
                x = packed_ids(x, end, width)
                if size and size + len(x) // width > BLOCK_IDS:
                    yield out()
                names.append(doc_id)
                parts.append(x)
                size += len(x) // width
        if parts:
            yield out()

    found = map_batches(rows, blocks, "shard int, block int, first long, n_ids long, data binary")
    found.write.option("compression", "zstd").parquet(folder)


def read_store(spark: SparkSession, folder: str) -> DataFrame:
    """The files of folder -> doc_id, start (ids of all documents before it), n_tokens,
    ids_crc32 (of the ids as little-endian unsigned 32-bit integers), from the blocks alone."""
    stored = spark.read.parquet(folder)

    def documents(batches):
        for b in batches:
            for shard, first, data in zip(*(b.column(c).to_pylist()
                                            for c in ("shard", "first", "data"))):
                whole = Block(data)
                bounds = whole.bounds.all().astype(np.int64)
                crcs = [zlib.crc32(whole._between(a, z).astype("<u4").tobytes())
                        for a, z in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
                yield pa.RecordBatch.from_pydict({
                    "shard": pa.array([shard] * whole.n, pa.int32()),
                    "doc_id": pa.array(whole.doc_ids(), pa.int64()),
                    "at": pa.array(first + bounds[:-1], pa.int64()),
                    "n_tokens": pa.array(np.diff(bounds), pa.int64()),
                    "ids_crc32": pa.array(crcs, pa.int64())})

    rows = map_batches(stored.select("shard", "first", "data"), documents,
                       "shard int, doc_id long, at long, n_tokens long, ids_crc32 long")
    sizes = stored.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    return rows.join(_before(sizes), "shard").select(
        "doc_id", (F.col("before") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def _before(sizes: DataFrame) -> DataFrame:
    """sizes (shard, n) -> shard, before: the sum of n over smaller shards, in two levels so
    that no task sees more than a thousandth of the shards and the thousands themselves."""
    part = sizes.withColumn("thousand", F.floor(F.col("shard") / 1000))
    inner = Window.partitionBy("thousand").orderBy("shard")
    totals = part.groupBy("thousand").agg(F.sum("n").alias("total"))
    outer = totals.select("thousand", (F.sum("total").over(
        Window.partitionBy(F.lit(0)).orderBy("thousand")) - F.col("total")).alias("base"))
    return part.withColumn("inside", F.sum("n").over(inner) - F.col("n")).join(
        outer, "thousand").select("shard", (F.col("base") + F.col("inside")).alias("before"))


def store(docs: DataFrame, path: str, drops_space: bool, end: int = END) -> DataFrame:
    """write_store() to a new folder in the shared checkpoint folder, then read_store()."""
    spark = docs.sparkSession
    folder = f"{checkpoint_dir(spark).rstrip('/')}/tokens-{uuid.uuid4().hex}"
    write_store(docs, folder, path, drops_space, end)
    return read_store(spark, folder)
