"""Packing documents into sequences of at most 2048 tokens by multiway differencing.

Every document is its token ids and one end id.  Whole windows are cut off its
start and are sequences of their own; what remains is cut into items of at
most ``piece`` tokens.  Blocks of ``block`` items are partitioned into windows
by the Karmarkar-Karp method: every item starts as a partial partition with
all but one window empty; the two partial partitions with the largest spread
are merged, the fullest window of one with the emptiest of the other, until
one partition is left, whose windows are nearly equal.  When a window exceeds
the capacity, the window count rises and the block is partitioned again.

A block is a run of rows of one input partition, so packing needs no shuffle
and a task holds one block; each partition ends with at most one partly filled
block.  Window and item counts bound the work of a block.

Padding: a sequence is padded to the capacity unless its length is a power of
two.  Rerunning a task on the same partition gives the same sequences; a
sequence id is the partition's number and the sequence's in it.

Defined results: a null or empty text is the end id alone; repeated rows and
null doc_ids are documents like others; an empty table gives an empty result;
other columns don't matter.
"""

from __future__ import annotations

import heapq
import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tickflow.session import ship_package

CAPACITY = 2048
PIECE = 512
BLOCK = 2048
END_ID = 1
SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")

#: Words of these characters only are their own NFC form and have no character whose class or lower case is in doubt.
_PLAIN = re.compile("[!-~À-ÿ]+")
_CACHE: dict[str, WordEncoder] = {}


class WordEncoder(dict):
    """Token ids (little-endian, 4 bytes each) of a white-space separated word, as a dict that fills itself.

    The tokenizer drops white space and never joins characters across it, so a text's ids
    are those of its words in turn.  For a tokenizer with the expected normalizer and
    pattern, plain words are split by that pattern here, and the model is asked once for
    each piece; all other words go through the whole tokenizer.  ``most`` bounds both caches.
    """

    def __init__(self, spec: str, most: int = 800_000):
        from tokenizers import Tokenizer
        self.tokenizer, self.most, self.pieces = Tokenizer.from_str(spec), most, {}
        parts = json.loads(spec)
        normal = [x["type"] for x in (parts["normalizer"] or {}).get("normalizers", [])]
        split = ((parts["pre_tokenizer"] or {}).get("pretokenizers") or [{}])[0]
        self.pattern = None
        if normal == ["NFC", "Replace", "Lowercase"] and split.get("type") == "Split" and split["invert"]:
            self.pattern = regex.compile(split["pattern"]["Regex"])
        self.special = [x["content"] for x in parts["added_tokens"]]
        self.model = self.tokenizer.model
        # printable bytes stand for themselves in a byte-level vocabulary, the others for code points from 256 on
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in shown]
        self.letters = [chr(b) if b in shown else chr(256 + rest.index(b)) for b in range(256)]

    def whole(self, word: str) -> bytes:
        return np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, "<u4").tobytes()

    def piece(self, text: str) -> bytes:
        found = self.model.tokenize(text if text.isascii() else "".join([self.letters[b] for b in text.encode()]))
        if len(self.pieces) >= self.most:
            self.pieces.clear()
        out = self.pieces[text] = b"".join([x.id.to_bytes(4, "little") for x in found])
        return out

    def split(self, word: str) -> list[str] | None:
        """The pieces of a plain word, None if the tokenizer itself must look at it."""
        if self.pattern is None or ("<" in word and any(s in word for s in self.special)):
            return None
        if word.isascii():
            if not word.isprintable():
                return None
            word = word.lower()
            if word.isalpha():
                return [word]
            if word[:-1].isalpha() and not word[-1].isalpha():  # a full stop or the like after letters
                return [word[:-1], word[-1]]
        elif not _PLAIN.fullmatch(word):
            return None
        return self.pattern.findall(word.lower())

    def __missing__(self, raw: bytes) -> bytes:
        word = raw.decode()
        pieces = self.split(word)
        out = self.whole(word) if pieces is None else b"".join([self.pieces.get(x) or self.piece(x) for x in pieces])
        if len(self) >= self.most:
            self.clear()
        self[raw] = out
        return out

    def forget(self) -> None:
        """Drops what was seen: workers live on between tasks and stages, and their memory with them."""
        self.clear()
        self.pieces.clear()

    def encode(self, text: bytes) -> bytes:
        return b"".join(map(self.__getitem__, text.split()))


def _merge_order(sums: np.ndarray) -> np.ndarray:
    return np.argsort(-sums, kind="stable")


def difference(sizes: np.ndarray, windows: int) -> np.ndarray:
    """The window of each item, by multiway differencing."""
    n = len(sizes)
    sums = [None] * (2 * n - 1)
    merged: list[tuple[int, int, np.ndarray]] = []
    heap = []
    for i, s in enumerate(sizes.tolist()):
        sums[i] = np.zeros(windows, np.int64)
        sums[i][0] = s
        heap.append((-s, i))
    heapq.heapify(heap)
    for at in range(n, 2 * n - 1):
        (_, a), (_, b) = heapq.heappop(heap), heapq.heappop(heap)
        both = sums[a] + sums[b][::-1]  # both are sorted, fullest first: full meets empty
        order = _merge_order(both)
        sums[a] = sums[b] = None
        both = both[order]
        sums[at] = both - both[-1]
        merged.append((a, b, order))
        heapq.heappush(heap, (-int(sums[at][0]), at))
    place = [None] * (2 * n - 1)
    place[-1] = np.arange(windows)
    for at in range(2 * n - 2, n - 1, -1):  # from the last partition back to the items
        a, b, order = merged[at - n]
        where = np.empty(windows, np.int64)
        where[order] = place[at]
        place[a], place[b], place[at] = where, where[::-1], None
    return np.array([place[i][0] for i in range(n)], np.int64)


def windows_of(sizes: np.ndarray, capacity: int = CAPACITY) -> np.ndarray:
    """The window of each item; no window holds more than ``capacity``."""
    if not len(sizes):
        return np.empty(0, np.int64)
    count = -(-int(sizes.sum()) // capacity)
    while True:
        out = difference(sizes, count)
        if np.bincount(out, sizes, count).max() <= capacity:
            return out
        count += 1


class Packer:
    """Packs the documents of one partition; ``sequences`` counts from the partition's first id."""

    def __init__(self, first: int, capacity: int, piece: int, block: int):
        self.next, self.capacity, self.piece, self.block = first, capacity, piece, block
        self.items: list[tuple] = []
        self.rows: list[tuple] = []

    def add(self, doc_id, ids: bytes) -> None:
        total, at = len(ids) // 4, 0
        while at < total:
            n = min(self.capacity if total - at >= self.capacity else self.piece, total - at)
            row = (doc_id, at, n, zlib.crc32(ids[4 * at:4 * (at + n)]), total)
            if n == self.capacity:
                self.rows.append((*row, self.next, 0))
                self.next += 1
            else:
                self.items.append(row)
                if len(self.items) >= self.block:
                    self.flush()
            at += n

    def flush(self) -> None:
        where = windows_of(np.array([x[2] for x in self.items], np.int64), self.capacity)
        used, where = np.unique(where, return_inverse=True)
        offset = [0] * len(used)
        for row, w in zip(self.items, where.tolist(), strict=True):
            self.rows.append((*row, self.next + w, offset[w]))
            offset[w] += row[2]
        self.next += len(used)
        self.items = []

    def take(self) -> pa.RecordBatch:
        kinds = [pa.int64()] * 7
        columns = list(zip(*self.rows, strict=True)) or [()] * 7
        names = [x.split()[0] for x in SCHEMA.split(", ")]
        self.rows = []
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def encoder(spec: str) -> WordEncoder:
    """One encoder per worker process and tokenizer, kept between tasks; what it has seen goes with each task."""
    if spec not in _CACHE:
        _CACHE.clear()
        _CACHE[spec] = WordEncoder(spec)
    return _CACHE[spec]


def _pack_partition(batches: Iterator[pa.RecordBatch], spec, capacity: int, piece: int, block: int) -> Iterator[pa.RecordBatch]:
    words = encoder(spec.value)
    packer = Packer(TaskContext.get().partitionId() << 40, capacity, piece, block)
    end = END_ID.to_bytes(4, "little")
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()), strict=True):
            packer.add(doc_id, words.encode(text.as_py() or b"") + end)
            if len(packer.rows) >= 20_000:
                yield packer.take()
    packer.flush()
    words.forget()
    yield packer.take()


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, piece: int = PIECE, block: int = BLOCK) -> DataFrame:
    """A row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    spark = docs.sparkSession
    ship_package(spark)
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = spark.sparkContext.broadcast(f.read())  # one vocabulary file

    def run(batches):
        return _pack_partition(batches, spec, capacity, piece, block)

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)
