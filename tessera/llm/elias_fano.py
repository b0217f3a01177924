"""Token-id shards with Elias-Fano document boundaries (operator 5).

A data set is a folder of shards. Shard k is two files:

``shard-k.ids``  the token ids of its documents, concatenated, little-endian,
                 16 bits each if the vocabulary allows, else 32.
``shard-k.ef``   a header and two Elias-Fano sequences: the document boundaries
                 (0, end of document 0, end of document 1, ...) and the document
                 ids. Header, little-endian: ``TEF1``, id bytes (u4), documents
                 with a null id (u8; they come first), length of the first
                 sequence (u8); then the two sequences.

A sequence of n sorted values below u keeps floor(log2(u / n)) low bits of each
value packed, and the high parts in unary, at most 3n bits; a directory of one
32-bit count per 512 bits of the unary part makes select() a short search. So a
boundary takes about 2 + log2(mean length) bits in place of 64.

Documents are range-partitioned and sorted by doc_id, so shards in the order of
their first id hold all documents in ascending order; one partition makes one
shard, streamed batch by batch. Every file is written under a private name and
moved into place, so a retried task leaves one complete file.

Defined cases: a null text is the empty text and holds only the end id; null
ids come first; repeated ids keep one entry per row, ordered by their texts; an
empty table makes a data set without documents; other columns are not read.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tessera.llm.common import AtomicFile, filesystem, quoted, shared_path, stage, text_of

MAGIC = b"TEF1"
BLOCK = 512  # bits of the unary part per directory entry
_HEAD = struct.Struct("<QQqQQQ")


def _pack_low(values: np.ndarray, width: int) -> bytes:
    """The low ``width`` bits of each value, most significant first."""
    out = []
    for at in range(0, len(values), 1 << 16):  # a multiple of 8 values: whole bytes
        bits = np.unpackbits(values[at:at + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        out.append(np.packbits(bits[:, 64 - width:].reshape(-1)).tobytes())
    return b"".join(out)


class EliasFano:
    """A sorted sequence of integers with random access."""

    def __init__(self, n: int, base: int, width: int, low: np.ndarray, high: np.ndarray, directory: np.ndarray):
        self.n, self.base, self.width, self.low, self.high, self.directory = n, base, width, low, high, directory

    @classmethod
    def encode(cls, values: np.ndarray) -> "EliasFano":
        values = np.asarray(values, np.int64)
        n = len(values)
        if n == 0:
            none = np.zeros(0, np.uint8)
            return cls(0, 0, 0, none, none, np.zeros(0, np.uint32))
        base = int(values[0])
        rest = values.astype(np.uint64) - np.uint64(base & (2**64 - 1))
        width = max(0, ((int(rest[-1]) + 1) // n).bit_length() - 1)
        low = np.frombuffer(_pack_low(rest, width), np.uint8) if width else np.zeros(0, np.uint8)
        ones = (rest >> np.uint64(width)).astype(np.int64) + np.arange(n)
        bits = np.zeros(-(-(int(ones[-1]) + 1) // BLOCK) * BLOCK, np.uint8)
        bits[ones] = 1
        counts = bits.reshape(-1, BLOCK).sum(axis=1, dtype=np.int64)
        directory = np.concatenate([[0], np.cumsum(counts)[:-1]]).astype(np.uint32)
        return cls(n, base, width, low, np.packbits(bits), directory)

    def to_bytes(self) -> bytes:
        return (_HEAD.pack(self.n, self.width, self.base, len(self.low), len(self.high), len(self.directory))
                + self.low.tobytes() + self.high.tobytes() + self.directory.astype("<u4").tobytes())

    @classmethod
    def from_bytes(cls, data: bytes) -> "EliasFano":
        n, width, base, a, b, c = _HEAD.unpack_from(data)
        at = _HEAD.size
        low = np.frombuffer(data, np.uint8, a, at)
        high = np.frombuffer(data, np.uint8, b, at + a)
        return cls(n, base, width, low, high, np.frombuffer(data, "<u4", c, at + a + b))

    def select(self, index) -> np.ndarray:
        """Values at the given positions, each found through the directory."""
        index = np.atleast_1d(np.asarray(index, np.int64))
        if not len(index):
            return np.zeros(0, np.int64)
        if index.min() < 0 or index.max() >= self.n:
            raise IndexError("position outside the sequence")
        out = np.empty(len(index), np.int64)
        for at in range(0, len(index), 4096):
            out[at:at + 4096] = self._select(index[at:at + 4096])
        return out

    def _select(self, index: np.ndarray) -> np.ndarray:
        block = np.searchsorted(self.directory, index, side="right") - 1
        own, place = np.unique(block, return_inverse=True)
        bits = np.unpackbits(self.high.reshape(-1, BLOCK // 8)[own], axis=1)
        seen = np.cumsum(bits, axis=1, dtype=np.int32)
        rank = (index - self.directory[block].astype(np.int64) + 1).astype(np.int32)
        # seen rises by 0 or 1 along a row: the place of the rank-th one is the number of smaller counts
        flat = seen.astype(np.int64) + np.arange(len(own))[:, None] * (BLOCK + 1)
        at = np.searchsorted(flat.reshape(-1), rank + place * (BLOCK + 1), side="left") - place * BLOCK
        high = (block * BLOCK + at - index).astype(np.uint64)
        value = high << np.uint64(self.width)
        if self.width:
            first = index * self.width
            window = first[:, None] + np.arange(self.width)
            bit = (self.low[window >> 3] >> (7 - (window & 7)).astype(np.uint8)) & 1
            weight = np.uint64(1) << np.arange(self.width - 1, -1, -1, dtype=np.uint64)
            value |= (bit.astype(np.uint64) * weight).sum(axis=1, dtype=np.uint64)
        return (value + np.uint64(self.base & (2**64 - 1))).astype(np.int64)


def _write_shard(path: str, tokenizer: str, end_id: int, wide: int):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        from tessera.llm.tokens import encoder
        encode, end = encoder(tokenizer).encode, end_id.to_bytes(4, "little")
        uri = f"{path}/shard-{TaskContext.get().partitionId():08d}"
        ids, ends, nulls, total, out = [], [0], 0, 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            if out is None:
                file = AtomicFile(uri + ".ids")
                out = file.__enter__()
            for doc, text in zip(batch.column(0), batch.column(1)):
                got = np.frombuffer(encode(text.as_py()) + end, "<u4")
                out.write((got.astype("<u2") if wide == 2 else got).tobytes())
                total += len(got)
                ends.append(total)
                doc = doc.as_py()
                nulls += doc is None
                ids.append(doc)
        if out is None:
            return
        file.__exit__(None, None, None)
        real = np.array(ids[nulls:], np.int64)
        bounds = EliasFano.encode(np.array(ends, np.int64)).to_bytes()
        with AtomicFile(uri + ".ef") as f:
            f.write(MAGIC + struct.pack("<IQQ", wide, nulls, len(bounds)) + bounds + EliasFano.encode(real).to_bytes())
        yield pa.RecordBatch.from_pydict(
            {"shard": [uri], "has_null": [nulls > 0], "first_id": pa.array([ids[nulls] if nulls < len(ids) else None], pa.int64()),
             "n_docs": [len(ids)], "n_ids": [total]})
    return run


def write_dataset(docs: DataFrame, path: str, tokenizer: str, end_id: int, vocabulary: int,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode every text, append ``end_id``, and write shards under ``path``.
    Returns the manifest, one row per shard with ``start``, the number of ids
    before it."""
    rows = docs.select(F.col(quoted(id_col)).cast("long").alias("doc_id"), text_of(docs, text_col).alias("text"))
    made = (rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
            .mapInArrow(_write_shard(path, tokenizer, end_id, 2 if vocabulary <= 1 << 16 else 4),
                        "shard string, has_null boolean, first_id long, n_docs long, n_ids long"))
    made = stage(made, "shards")
    order = W.orderBy(F.col("has_null").desc(), F.col("first_id").asc_nulls_first())
    before = F.sum("n_ids").over(order.rowsBetween(W.unboundedPreceding, -1))
    return stage(made.withColumn("start", F.coalesce(before, F.lit(0).cast("long"))), "manifest")


class Shard:
    """Random access to one shard: ``span(i)`` and ``ids(i)`` of document i."""

    def __init__(self, uri: str):
        self.fs, self.path = filesystem(uri)
        with self.fs.open_input_stream(self.path + ".ef", compression=None) as f:
            data = f.read()
        if data[:4] != MAGIC:
            raise ValueError(f"{uri}.ef is not a boundary file")
        self.wide, self.nulls, size = struct.unpack_from("<IQQ", data, 4)
        at = 4 + struct.calcsize("<IQQ")
        self.bounds = EliasFano.from_bytes(data[at:at + size])
        self.doc_ids = EliasFano.from_bytes(data[at + size:])
        self.n_docs = self.bounds.n - 1

    def open(self):
        return self.fs.open_input_file(self.path + ".ids")

    def read(self, file, first: int, last: int) -> np.ndarray:
        file.seek(first * self.wide)
        return np.frombuffer(file.read((last - first) * self.wide), f"<u{self.wide}").astype("<u4")


def _read_shards(batches: Iterator) -> Iterator:
    import pyarrow as pa
    for batch in batches:
        for uri, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            shard = Shard(uri)
            with shard.open() as file:
                for at in range(0, shard.n_docs, 1024):
                    to = min(at + 1024, shard.n_docs)
                    cut = shard.bounds.select(np.arange(at, to + 1))
                    null = max(0, min(shard.nulls, to) - at)
                    ids = [None] * null + shard.doc_ids.select(np.arange(at + null, to) - shard.nulls).tolist()
                    got = shard.read(file, int(cut[0]), int(cut[-1]))
                    cut = cut.tolist()
                    crc = [zlib.crc32(got[a - cut[0]:b - cut[0]]) for a, b in zip(cut, cut[1:])]
                    yield pa.RecordBatch.from_pydict({
                        "doc_id": pa.array(ids, pa.int64()), "start": pa.array([start + a for a in cut[:-1]], pa.int64()),
                        "n_tokens": pa.array([b - a for a, b in zip(cut, cut[1:])], pa.int64()),
                        "ids_crc32": pa.array(crc, pa.int64())})


def read_dataset(manifest: DataFrame, shards: int) -> DataFrame:
    """One row per document, from the files alone."""
    return (manifest.select("shard", "start").repartition(max(1, shards))
            .mapInArrow(_read_shards, "doc_id long, start long, n_tokens long, ids_crc32 long"))


def token_dataset(spark: SparkSession, docs: DataFrame, tokenizer: str, end_id: int, vocabulary: int,
                  path: str | None = None) -> DataFrame:
    manifest = write_dataset(docs, path or shared_path(spark, "token-ids"), tokenizer, end_id, vocabulary)
    return read_dataset(manifest, manifest.count())
