"""A Bloom filter of 64-bit hashes with a bounded size, built by Spark and tested in numpy."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize

#: 2**21 words of 64 bits: 16 MB at most, whatever the number of keys. A full filter lets more pass, never less.
MAX_WORDS = 1 << 21
BITS_PER_KEY = 12
_SHIFTS = (40, 46, 52)


def key_filter(keys: DataFrame, max_words: int = MAX_WORDS) -> np.ndarray:
    """The filter of a column "key" of hashes (long): at most ``max_words`` rows come to the driver."""
    keys = materialize(keys.select("key"), "filter-keys")
    need = max(1, keys.count() * BITS_PER_KEY // 64)
    n_words = min(max_words, 1 << (need - 1).bit_length())
    mask = F.lit(0).cast("long")
    for s in _SHIFTS:
        bit = F.shiftrightunsigned("key", s).bitwiseAND(63).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), bit))
    word = F.col("key").bitwiseAND(n_words - 1).cast("int")
    rows = keys.groupBy(word.alias("word")).agg(F.bit_or(mask).alias("bits")).toArrow()
    out = np.zeros(n_words, np.uint64)
    out[rows["word"].to_numpy()] = rows["bits"].to_numpy().view(np.uint64)
    return out


def maybe_in(keys: np.ndarray, bits: np.ndarray) -> np.ndarray:
    found = bits[(keys & np.uint64(len(bits) - 1)).astype(np.int64)]
    out = np.ones(len(keys), bool)
    for s in _SHIFTS:
        out &= ((found >> ((keys >> np.uint64(s)) & np.uint64(63))) & np.uint64(1)).astype(bool)
    return out
