"""A count-min sketch of 128-bit digests whose counters stop at two: it proves digests to occur once.

Each digest has a counter in either of two rows, by its two halves.  The
smaller counter is never below the number of times the digest was added, so
one that stands at one proves that nothing else was.  Tasks send the counters
they have touched, two bytes each; blocks of counters are added up in parallel
and come to the driver as one bit each (two or more).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tickflow.session import ship_package

BLOCK = 1 << 16
#: Counters of a row: 2**28 at most, so that both rows are 64 MB of bits whatever the input.
MAX_WIDTH = 1 << 28
COUNTERS_PER_KEY = 8
_HELD = 1 << 20
_PART = "side int, block int, once binary, more binary"


def width_for(n_keys: int, most: int = MAX_WIDTH) -> int:
    return min(most, max(BLOCK, 1 << (max(1, n_keys) * COUNTERS_PER_KEY - 1).bit_length()))


def _cells(column: pa.Array, width: int) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).view(np.uint64) & np.uint64(width - 1)


def _touched(held: list[list[np.ndarray]]) -> pa.RecordBatch:
    rows = []
    for side, parts in enumerate(held):
        cells, n = np.unique(np.concatenate(parts), return_counts=True)
        block = cells // np.uint64(BLOCK)
        at = (cells % np.uint64(BLOCK)).astype("<u2")
        for b in np.unique(block):
            mine = block == b if len(block) < BLOCK else slice(*np.searchsorted(block, [b, b + np.uint64(1)]))
            rows.append((side, int(b), at[mine][n[mine] == 1].tobytes(), at[mine][n[mine] > 1].tobytes()))
    columns = list(zip(*rows, strict=True))
    kinds = [pa.int32(), pa.int32(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["side", "block", "once", "more"])


def _add_block(key: tuple, parts: pa.Table) -> pa.Table:
    """Adds up one block of counters."""
    seen, twice = np.zeros(BLOCK, bool), np.zeros(BLOCK, bool)
    for once, more in zip(parts.column("once").to_pylist(), parts.column("more").to_pylist(), strict=True):
        once, more = np.frombuffer(once, "<u2"), np.frombuffer(more, "<u2")
        twice[more] = True
        twice[once[seen[once]]] = True
        seen[once] = True
        seen[more] = True
    return pa.table({"side": pa.array([key[0].as_py()], pa.int32()), "block": pa.array([key[1].as_py()], pa.int32()),
                     "bits": pa.array([np.packbits(twice, bitorder="little").tobytes()], pa.binary())})


def repeated(digests: DataFrame, width: int) -> np.ndarray:
    """Bits of the counters that stand at two or more, a row of the sketch each, of the long columns "x1" and "x2"."""
    ship_package(digests.sparkSession)

    def touch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [[], []], 0
        for batch in batches:
            held[0].append(_cells(batch.column(0), width))
            held[1].append(_cells(batch.column(1), width))
            n += batch.num_rows
            if n >= _HELD:
                yield _touched(held)
                held, n = [[], []], 0
        if n:
            yield _touched(held)

    added = (digests.select("x1", "x2").mapInArrow(touch, _PART).groupBy("side", "block")
             .applyInArrow(_add_block, "side int, block int, bits binary").toArrow())
    out = np.zeros((2, width // 8), np.uint8)
    for side, block, bits in zip(*(added.column(c).to_pylist() for c in ("side", "block", "bits")), strict=True):
        out[side, block * BLOCK // 8:(block + 1) * BLOCK // 8] = np.frombuffer(bits, np.uint8)
    return out


def maybe_repeated(bits: np.ndarray, x1: pa.Array, x2: pa.Array) -> np.ndarray:
    """False where the sketch proves that a digest was added once."""
    out = np.ones(len(x1), bool)
    for row, column in zip(bits, (x1, x2), strict=True):
        at = _cells(column, 8 * len(row))
        out &= (row[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
    return out
