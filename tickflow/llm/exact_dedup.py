"""Exact de-duplication by two-pass Bloom filtering.

Texts are equal when identical after lower-casing A-Z; a null text counts as
empty.  Of equal texts the row with the largest doc_id stays.

Pass 1 sets, for every row, a few bits of one 64-bit word of a Bloom filter
and keeps the bits that were set by two rows or more.  A row whose bits are
not all among those has a text that no other row has.  Pass 2 tests every row
against these bits: only rows that may have a copy are shuffled by their hash,
the rest pass straight through.  False positives cost a little shuffle and
never change the result.

The filter has 16 bits a row up to ``max_words`` words of 64 bits, which bounds
what is broadcast (2**20 words: 16 MB) whatever the input.  Beyond about 4
million rows per 2**18 words it fills up and more hashes are shuffled; texts of
rows without copies still are not until it is full.

Defined results: a null doc_id ranks below every other; of rows equal in text
and doc_id exactly one stays; an empty table gives an empty result; other
columns, whatever their names, don't matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ascii_lower, materialize, sha256_hex

MAX_WORDS = 1 << 20
BITS_PER_ROW = 16
PROBES = 4
MAX_LARGE = 5000


def text_key(text: Column) -> Column:
    return sha256_hex(ascii_lower(F.coalesce(text, F.lit(""))))


def filter_words(n_rows: int, max_words: int = MAX_WORDS) -> int:
    need = max(1, n_rows * BITS_PER_ROW // 64)
    return min(max_words, 1 << (need - 1).bit_length())


def _word(key: Column, n_words: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(n_words))


def _bits(key: Column) -> list[Column]:
    h = F.xxhash64(key, F.lit(1))
    return [F.shiftrightunsigned(h, 6 * j).bitwiseAND(63).cast("int") for j in range(PROBES)]


def _mask(key: Column) -> Column:
    out = F.lit(0).cast("long")
    for b in _bits(key):
        out = out.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), b))
    return out


def repeated_bits(keys: DataFrame, n_words: int) -> DataFrame:
    """Pass 1: (word, bits) of the filter's bits that two rows or more have set."""
    k = F.col("key")
    return (keys.select(_word(k, n_words).alias("word"), F.explode(F.array_distinct(F.array(*_bits(k)))).alias("bit"))
            .groupBy("word", "bit").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
            .groupBy("word").agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit"))).alias("bits")))


def with_maybe_repeated(rows: DataFrame, bits: DataFrame, n_words: int) -> DataFrame:
    """Pass 2: adds ``maybe``, false only where no other row has the key. ``bits`` has n_words rows at most."""
    k = F.col("key")
    return (rows.withColumn("word", _word(k, n_words)).join(F.broadcast(bits), "word", "left")
            .withColumn("maybe", F.coalesce(F.col("bits").bitwiseAND(_mask(k)) == _mask(k), F.lit(False)))
            .drop("word", "bits"))


def exact_dedup(docs: DataFrame, max_words: int = MAX_WORDS) -> DataFrame:
    """A row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = materialize(docs.select("doc_id", text_key(F.col("text")).alias("key"),
                                   F.monotonically_increasing_id().alias("row")), "text-keys")
    n_words = filter_words(rows.count(), max_words)
    tested = with_maybe_repeated(rows, repeated_bits(rows.select("key"), n_words), n_words)
    again = tested.filter("maybe")
    groups = materialize(
        again.groupBy("key").agg(F.max(F.struct("doc_id", "row")).alias("keep"), F.count(F.lit(1)).alias("group_size"))
        .select("key", F.col("keep.doc_id").alias("keep_id"), F.col("keep.row").alias("keep_row"), "group_size"), "text-groups")
    large = F.col("group_size") * MAX_LARGE > rows.count()
    # fewer than MAX_LARGE groups can be so large: they are broadcast, and no key of the shuffled rest is frequent
    hot = groups.filter(large).select("key", *[F.col(c).alias(f"hot_{c}") for c in ("keep_id", "keep_row", "group_size")])
    marked = again.join(F.broadcast(hot), "key", "left")
    in_large = marked.filter("hot_group_size is not null").select(
        "doc_id", "key", "row", *[F.col(f"hot_{c}").alias(c) for c in ("keep_id", "keep_row", "group_size")])
    in_small = marked.filter("hot_group_size is null").select("doc_id", "key", "row").join(groups.filter(~large), "key")
    repeated = in_large.unionByName(in_small).select(
        "doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), F.col("key").alias("text_sha256"))
    alone = tested.filter(~F.col("maybe")).select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), F.col("key").alias("text_sha256"))
    return alone.unionByName(repeated)


def drop_exact_copies(docs: DataFrame, max_words: int = MAX_WORDS) -> DataFrame:
    """The rows that stay, with all their columns. Rows that cannot have a copy are never shuffled.

    Of a group's rows each task forwards its best one only (a limit inside the window), so a
    group of any size shrinks before the shuffle.
    """
    row = F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("r")
    keyed = docs.select(row, text_key(docs["text"]).alias("key"))
    keys = materialize(keyed.select("key"), "text-keys")
    n_words = filter_words(keys.count(), max_words)
    bits = materialize(repeated_bits(keys, n_words), "repeated-bits")
    tested = with_maybe_repeated(keyed, bits, n_words)
    best = Window.partitionBy("key").orderBy(F.col("r.doc_id").desc_nulls_last())
    again = tested.filter("maybe").withColumn("rank", F.row_number().over(best)).filter("rank = 1")
    return tested.filter(~F.col("maybe")).select("r.*").unionByName(again.select("r.*"))
