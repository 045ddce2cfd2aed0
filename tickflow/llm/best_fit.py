"""Packing documents into sequences of at most 4096 tokens by bounded-space online best-fit.

Every document is its token ids and one end id.  Only a document longer than
the capacity is cut, into pieces of the capacity and a shorter last one.  The
pieces are taken in the order they come.  A fixed number of bins is open; a
bitset has one bit for each amount of free space that an open bin has, so the
bin that a piece fits best is the lowest set bit not below the piece's length.
A piece that fits nowhere opens a bin, and when that is one too many the
fullest bin closes first, as the least can still come into it.

A piece's sequence and offset are known as soon as it is placed: rows go out
at once and a bin is two numbers, so a task's memory is bounded whatever its
input.  Packing needs no shuffle.  Of a partition's bins at most one ends less
than half full, as the pieces of a second one would have fitted into the first.

Rerunning a task on the same partition gives the same sequences; a sequence id
is the partition's number and the sequence's in it.

Defined results: a null or empty text is the end id alone; repeated rows and
null doc_ids are documents like others; an empty table gives an empty result;
other columns don't matter.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tickflow.session import ship_package

from .packing import encoder

CAPACITY = 4096
OPEN_BINS = 256
END_ID = 1
SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
_TYPES = [pa.int64(), pa.int32()] + [pa.int64()] * 5


class OpenBins:
    """The open bins, by free space; ``place`` gives the bin and the offset of a piece."""

    def __init__(self, capacity: int = CAPACITY, most: int = OPEN_BINS, first: int = 0):
        self.capacity, self.most, self.next = capacity, most, first
        self.spaces = 0  # bit f is set while an open bin has f tokens of free space
        self.bins: dict[int, list[int]] = {}
        self.count = 0

    def _take(self, free: int) -> int:
        same = self.bins[free]
        out = same.pop()
        if not same:
            del self.bins[free]
            self.spaces ^= 1 << free
        self.count -= 1
        return out

    def _put(self, free: int, which: int) -> None:
        if free not in self.bins:
            self.bins[free] = []
            self.spaces |= 1 << free
        self.bins[free].append(which)
        self.count += 1

    def place(self, length: int) -> tuple[int, int]:
        fitting = self.spaces >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            which = self._take(free)
        else:
            free, which, self.next = self.capacity, self.next, self.next + 1
        left = free - length
        if left:  # a full bin is closed
            self._put(left, which)
            if self.count > self.most:
                self._take((self.spaces & -self.spaces).bit_length() - 1)
        return which, self.capacity - free


def pieces(total: int, capacity: int) -> Iterator[tuple[int, int]]:
    """(start, length) of the pieces of a document."""
    for at in range(0, total, capacity):
        yield at, min(capacity, total - at)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(_TYPES)
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _TYPES, strict=True)], names)


def _pack_partition(batches: Iterator[pa.RecordBatch], spec, capacity: int, open_bins: int) -> Iterator[pa.RecordBatch]:
    words = encoder(spec.value)
    bins = OpenBins(capacity, open_bins, TaskContext.get().partitionId() << 40)
    end = END_ID.to_bytes(4, "little")
    rows: list[tuple] = []
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()), strict=True):
            ids = words.encode(text.as_py() or b"") + end
            for number, (at, n) in enumerate(pieces(len(ids) // 4, capacity)):
                which, offset = bins.place(n)
                rows.append((doc_id, number, at, n, zlib.crc32(ids[4 * at:4 * (at + n)]), which, offset))
            if len(rows) >= 20_000:
                yield _batch(rows)
                rows = []
    words.forget()
    yield _batch(rows)


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, open_bins: int = OPEN_BINS) -> DataFrame:
    """A row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    spark = docs.sparkSession
    ship_package(spark)
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = spark.sparkContext.broadcast(f.read())  # one vocabulary file

    def run(batches):
        return _pack_partition(batches, spec, capacity, open_bins)

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)
