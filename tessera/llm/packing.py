"""Best-fit packing of documents into fixed-length sequences (operator 10).

Bounded-space online best-fit: a packer keeps at most ``open_bins`` open
sequences. Their free spaces are the set bits of one integer, with a stack of
sequences per free space, so the tightest sequence that still takes a piece is
the lowest set bit at or above the piece's length. When a new sequence is
needed and all places are taken, the fullest open one closes.

A document longer than a sequence is cut into whole sequences from its end, so
only its first piece can be shorter. Whole pieces fill a sequence by
themselves; the others are dealt by hash to packers of about ``per_packer``
pieces. A packer's pieces arrive in waves of about ``wave`` pieces, drawn by
hash and longest first within a wave: each wave's short pieces fill what its
long ones and the earlier waves left open. Measured on the test lengths this
needs 0.2 % more sequences than all tokens would fill without gaps, against
1.6 % when pieces arrive in random order. A packer's state is its open
sequences, so memory doesn't grow with the input, and dealing costs at most the
last open sequences of each packer.

Defined cases: a null text is the empty text and holds only the end id;
repeated rows and ids are packed row by row; a null doc_id stays null; an empty
table gives no rows; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import quoted, stage, text_of

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


class BestFit:
    """Bounded-space best-fit: place(length) -> (bin, offset)."""

    def __init__(self, capacity: int, open_bins: int):
        self.capacity, self.open_bins = capacity, open_bins
        self.mask, self.stacks, self.open, self.bins = 0, [[] for _ in range(capacity + 1)], 0, 0

    def _take(self, free: int) -> int:
        stack = self.stacks[free]
        got = stack.pop()
        if not stack:
            self.mask ^= 1 << free
        return got

    def place(self, length: int) -> tuple[int, int]:
        if not 0 <= length <= self.capacity:
            raise ValueError("a piece must fit into a sequence")
        fits = self.mask >> length
        if fits:
            free = length + (fits & -fits).bit_length() - 1
            own = self._take(free)
            self.open -= 1
        else:
            free, own = self.capacity, self.bins
            self.bins += 1
        left = free - length
        if left:
            if self.open == self.open_bins:
                self._take((self.mask & -self.mask).bit_length() - 1)  # the fullest closes
                self.open -= 1
            self.stacks[left].append(own)
            self.mask |= 1 << left
            self.open += 1
        return own, self.capacity - free


def _cut(tokenizer: str, end_id: int, capacity: int):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        from tessera.llm.tokens import encoder
        encode, end = encoder(tokenizer).encode, end_id.to_bytes(4, "little")
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column(0), batch.column(1)):
                doc, ids = doc.as_py(), memoryview(encode(text.as_py()) + end)
                n = len(ids) // 4
                at, to = 0, n % capacity or capacity
                for piece in range(-(-n // capacity)):
                    rows.append((doc, piece, at, to - at, zlib.crc32(ids[4 * at:4 * to])))
                    at, to = to, to + capacity
            columns = list(zip(*rows)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[k], pa.int32() if k == 1 else pa.int64()) for k in range(5)],
                names=["doc_id", "piece", "start", "length", "ids_crc32"])
    return run


def pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode every text, append ``end_id`` and cut what is too long."""
    rows = docs.select(F.col(quoted(id_col)).cast("long").alias("doc_id"), text_of(docs, text_col).alias("text"))
    return rows.mapInArrow(_cut(tokenizer, end_id, capacity), PIECES)


def _pack(capacity: int, open_bins: int):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        packers: dict[int, BestFit] = {}
        for batch in batches:
            bins, offsets = [], []
            for deal, length in zip(batch.column("deal").to_pylist(), batch.column("length").to_pylist()):
                packer = packers.get(deal)
                if packer is None:  # rows come sorted by deal: the others are done
                    packers = {deal: (packer := BestFit(capacity, open_bins))}
                own, offset = packer.place(length)
                bins.append((deal << 40) | own)
                offsets.append(offset)
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(bins, pa.int64()), pa.array(offsets, pa.int64())],
                names=[*names, "sequence_id", "offset"])
    return run


def pack(cut: DataFrame, capacity: int, open_bins: int = 4096, per_packer: int = 100_000,
         wave: int = 4000) -> DataFrame:
    """Place every piece of a written table: adds sequence_id and offset."""
    whole = F.col("length") == capacity
    rest = cut.filter(~whole)
    count = rest.count()
    deals = max(1, -(-count // per_packer))
    waves = max(1, -(-count // (deals * wave)))
    mixed = F.xxhash64("doc_id", "piece", "ids_crc32")
    dealt = (rest.withColumn("deal", F.pmod(mixed, F.lit(deals))).withColumn("wave", F.pmod(F.xxhash64(mixed, F.lit(7)), F.lit(waves)))
             .repartition(deals, "deal")
             .sortWithinPartitions("deal", "wave", F.desc("length"), "doc_id", "piece", "start", "ids_crc32")
             .drop("wave").mapInArrow(_pack(capacity, open_bins), PIECES + ", sequence_id long, offset long"))
    # A whole piece is a sequence of its own; negative numbers can't meet the packers'.
    alone = (cut.filter(whole)
             .withColumn("sequence_id", -F.monotonically_increasing_id() - 1)
             .withColumn("offset", F.lit(0).cast("long")))
    return dealt.unionByName(alone)


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int, capacity: int) -> DataFrame:
    return pack(stage(pieces(docs, tokenizer, end_id, capacity), "pieces"), capacity)
