"""Grouping spelling variants: words one edit apart, found by an FM-index search.

Two words are near if one inserted, deleted or replaced code point turns one
into the other.  With one error between them, at least one half of the shorter
word is exact in both.  So a word of m code points is filed under its first
half and under its second half, and once more under the halves that it would
have as the longer word of a pair (as if it had m - 1); near words meet under
one of these keys.  Keys are gathered into shards, and each shard's words into
a bidirectional FM-index (``fm_index``).  Every word then is searched by two
schemes: first half exact and one error behind it, second half exact and one
error before it.  A pair that both schemes find is the first one's.

A word's form is the near word that occurs most, if it occurs ``ratio`` times
as often or more; forms are followed to the root by pointer doubling, and as
counts grow by the ratio with each step, few rounds suffice.

Bounds: a shard holds ``SHARD`` entries or so.  A key with more than ``GROUP``
words is dealt over blocks by the words' hash, and its queries go to every
block; at most entries / GROUP keys can be so large, so that list is small.
A shard returns a row per word it has seen, never the pairs.  Words and their
counts are aggregated before every shuffle.

Defined results: a null text has no words; a null doc_id is an empty id when
words are altered; repeated rows count again; ties go to the smallest word in
code-point order; an empty table gives an empty result; other columns don't
matter.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickflow.session import ship_package

from .common import ascii_lower, materialize
from .fm_index import FmIndex

MIN_LENGTH = 7
MIN_COUNT = 2
RATIO = 10
ALTERED = 31
SHARD = 32_768
GROUP = 32_768
#: Hot keys are broadcast up to so many; beyond, the join is left to the optimiser.
MAX_BROADCAST = 1_000_000
_FOUND = "word string, n long, n_near long, best_n long, best string"


def word_counts(docs: DataFrame, altered: int = ALTERED, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n): runs of letters, A-Z lower-cased, one in ``altered`` with a code point deleted, by a hash of document and run."""
    runs = F.regexp_extract_all(ascii_lower(F.col("text")), F.lit(f"[a-z\\u00C0-\\u00FF]{{{min_length},}}+"), F.lit(0))
    found = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"), F.explode(runs).alias("run"))
    return (found.select(_altered(F.col("doc"), F.col("run"), altered).alias("word")).filter(F.length("word") >= min_length)
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_count))


def _altered(doc: Column, run: Column, one_in: int) -> Column:
    h = F.crc32(F.concat(doc, F.lit(":"), run))
    at = F.pmod(h, F.length(run)).cast("int")
    less = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
    return F.when(F.pmod(h, F.lit(one_in)) == 0, less).otherwise(run)


def _entries(words: DataFrame, min_length: int) -> DataFrame:
    """(word, n, side, m, key, asks): the word under its halves, those of m = its length (where it asks) and of m one less."""
    length = F.length("word")

    def under(m: Column, side: int) -> Column:
        half = F.floor(m / 2).cast("int")
        part = F.substring("word", F.lit(1), half) if side == 0 else F.right("word", m - half)
        return F.struct(F.lit(side).alias("side"), m.alias("m"), part.alias("key"), (m == length).alias("asks"))

    both = F.array(*[under(length - less, side) for less in (0, 1) for side in (0, 1)])
    return words.select("word", "n", F.explode(F.filter(both, lambda e: e["m"] >= min_length)).alias("e")).select("word", "n", "e.*")


def _shards(entries: DataFrame, n_entries: int, shard: int, group: int) -> DataFrame:
    """(shard, alone, word, n, side, asks, listed): where each entry is listed and where it asks.

    A block of a large key is alone: beside other keys its queries could meet a word of another block twice.
    """
    key = ["side", "m", "key"]
    large = materialize(entries.groupBy(*key).agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") > group)
                        .withColumn("blocks", F.ceil(F.col("size") / group).cast("int")).drop("size"), "large-keys")
    if large.count() <= MAX_BROADCAST:
        large = F.broadcast(large)
    dealt = entries.join(large, key, "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    own = F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int")
    asked = F.when(F.col("asks"), F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array(own))
    rows = dealt.withColumn("own", own).withColumn("block", F.explode(asked))
    shards = max(1, -(-n_entries // shard))
    alone = F.when(F.col("blocks") > 1, F.concat_ws(":", "side", "m", "block", "key")).otherwise(F.lit(""))
    return rows.select(F.pmod(F.xxhash64(*key, "block"), F.lit(shards)).alias("shard"), alone.alias("alone"), "word", "n", "side", "asks",
                       (F.col("block") == F.col("own")).alias("listed"))


def _best(word: np.ndarray, other: np.ndarray, n: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """For each word number, how many pairs it has and its other word of largest n, the smaller number among equals (-1: none)."""
    best = np.full(size, -1, np.int64)
    order = np.lexsort((-other, n[other]))
    best[word[order]] = other[order]  # the last write of a word is its best
    return np.bincount(word, minlength=size), best


def _search(table: pa.Table) -> pa.Table:
    """A row per word of a shard: what the shard knows of its near words."""
    words, counts, sides, asks, listed = (table.column(c).to_pylist() for c in ("word", "n", "side", "asks", "listed"))
    n_of = dict(zip(words, counts, strict=True))
    there = {w for w, x in zip(words, listed, strict=True) if x}
    asking = [{w for w, s, x in zip(words, sides, asks, strict=True) if x and s == side} for side in (0, 1)]
    if there:
        index = FmIndex(list(there), "".join(sorted({c for w in asking[0] | asking[1] for c in w})))
        listed_words = index.words
    else:
        index, listed_words = None, []
    everyone = listed_words + sorted((asking[0] | asking[1]) - there)
    number = {w: i for i, w in enumerate(everyone)}
    one, other = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for side in (0, 1) if index else ():
        queries = sorted(asking[side])
        exact = [len(q) // 2 if side == 0 else len(q) - len(q) // 2 for q in queries]
        q, w = index.one_more_or_other(queries, exact, rightward=side == 0)
        if side == 1:  # pairs with the first half in common are the other scheme's
            fresh = [listed_words[b][:len(queries[a]) // 2] != queries[a][:len(queries[a]) // 2] for a, b in zip(q, w, strict=True)]
            q, w = q[np.array(fresh, bool)], w[np.array(fresh, bool)]
        q = np.array([number[x] for x in queries], np.int64)[q]
        one.append(q)
        other.append(w)
    one, other = np.concatenate(one), np.concatenate(other)
    n = np.array([n_of[w] for w in everyone], np.int64)
    length = np.fromiter(map(len, everyone), np.int64, len(everyone))
    longer = length[other] > length[one]  # only the shorter word of such a pair asks
    one, other = np.concatenate([one, other[longer]]), np.concatenate([other, one[longer]])
    # ties go to the smaller word: numbers must be in code-point order
    order = sorted(range(len(everyone)), key=everyone.__getitem__)
    rank = np.empty(len(everyone), np.int64)
    rank[order] = np.arange(len(everyone))
    in_order = [everyone[i] for i in order]
    near, best = _best(rank[one], rank[other], n[order], len(everyone))
    return pa.table({"word": pa.array(in_order, pa.string()), "n": n[order], "n_near": near,
                     "best_n": pa.array([None if b < 0 else int(n[order[b]]) for b in best], pa.int64()),
                     "best": pa.array([None if b < 0 else in_order[b] for b in best], pa.string())})


def near_words(words: DataFrame, min_length: int = MIN_LENGTH, shard: int = SHARD, group: int = GROUP) -> DataFrame:
    """(word, n, n_near, best, best_n) of (word, n), distinct words of ``min_length`` code points or more."""
    ship_package(words.sparkSession)
    words = materialize(words, "words")
    rows = _shards(_entries(words, min_length), 4 * words.count(), shard, group)
    found = rows.groupBy("shard", "alone").applyInArrow(_search, _FOUND)
    best = F.min(F.when(F.col("best").isNotNull(), F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("word"))))
    return (found.groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), best.alias("b"))
            .select("word", "n", "n_near", F.col("b.word").alias("best"), (-F.col("b.less")).alias("best_n")))


def roots(links: DataFrame) -> DataFrame:
    """(word, root) of (word, form): forms followed to the last, the way doubling each round."""
    now = materialize(links.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        now = materialize(now.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"),
                                                                 F.col("next").isNotNull().alias("moved")), "roots")
        if now.filter("moved").isEmpty():
            return now.select("word", "root")
        now = now.select("word", "root")


def variant_groups(words: DataFrame, min_length: int = MIN_LENGTH, ratio: int = RATIO, shard: int = SHARD, group: int = GROUP) -> DataFrame:
    """A row per word of (word, n): word, form, root, n, n_near, form_n."""
    near = near_words(words, min_length, shard, group)
    formed = materialize(near.withColumn("is_form", F.coalesce(F.col("best_n") >= ratio * F.col("n"), F.lit(False)))
                         .select("word", "n", "n_near", F.when(F.col("is_form"), F.col("best")).alias("form"),
                                 F.when(F.col("is_form"), F.col("best_n")).alias("form_n")), "forms")
    linked = formed.filter("form is not null")
    own = formed.filter("form is null").withColumn("root", F.col("word"))
    return own.unionByName(linked.join(roots(linked.select("word", "form")), "word")).select("word", "form", "root", "n", "n_near", "form_n")
