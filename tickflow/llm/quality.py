"""Quality rules: base counts of each text, and a likelihood ratio between two n-gram models.

Words and word pairs are hashed into ``2 * BUCKETS`` buckets.  Two multinomials
over these buckets are counted: one over the whole raw corpus and one over the
trusted target, the documents labelled good.  A document's score is the mean
log ratio of target to raw over its n-grams; every document is judged by the
same threshold, without chance: kept when the score reaches ``threshold``.

Smoothing: the raw model adds 1 to every bucket; the target model takes the
raw one as its prior with the weight of as many n-grams as there are buckets,
so with few labels the scores stay near 0 and documents are kept.  The mean
divides by n + LEAN, which pulls very short texts towards 0.

The counts cover every n-gram of every row.  Trusted ids are a bounded sample of
the labelled rows, at most ``max_trusted`` (the smallest hashes), so that they
can be broadcast; a document is trusted when it has labels and all of them are
good.  The model that goes to the tasks has ``2 * BUCKETS`` numbers always.

Defined results: null text has no words and fails the base rules; a null
doc_id is never trusted; repeated rows are judged alike, each on its own; an
empty table gives an empty result; without labels all ratios are 0.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, let, words

BUCKETS = 1 << 13
MAX_TRUSTED = 1 << 16
THRESHOLD = -0.2
LEAN = 8
MIN_WORDS = 50
SYMBOLS = "#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "log_ratio")
#: Up to so many different repeated windows are looked up one by one; beyond, a sort finds them in n log n.
LOOKUP = 32


def _total(values: Column, kind: str) -> Column:
    return F.aggregate(values, F.lit(0).cast(kind), lambda a, x: a + x)


def word_hashes(found: Column) -> Column:
    return F.transform(found, lambda w: F.xxhash64(w))


def _following(h: Column, other: Column, by: int) -> Column:
    """Hashes of ``other[i]`` with ``h[i + by]``, as far as both go."""
    n = F.greatest(F.size(h) - by, F.lit(0))
    return F.zip_with(F.slice(other, F.lit(1), n), F.slice(h, F.lit(1 + by), n), lambda a, b: F.xxhash64(a, b))


def pair_hashes(h: Column) -> Column:
    return _following(h, h, 1)


def ngram_buckets(h: Column, pairs: Column, buckets: int = BUCKETS) -> Column:
    """Buckets (a power of two) of the words, then of the word pairs."""
    return F.concat(F.transform(h, lambda x: x.bitwiseAND(buckets - 1).cast("int")),
                    F.transform(pairs, lambda x: x.bitwiseAND(buckets - 1).bitwiseOR(buckets).cast("int")))


def repeated_words(h: Column, pairs: Column) -> Column:
    """Words covered by 3-word windows that occur twice or more, from the hashes of words and pairs."""
    def covered(at: Column) -> Column:
        step = F.transform(at, lambda p, i: F.when(i == 0, F.lit(3).cast("long")).otherwise(
            F.least(p - F.get(at, i - 1), F.lit(3).cast("long"))))
        return _total(step, "long")

    def found_twice(sorted_hashes: Column) -> Column:
        n = F.size(sorted_hashes) - 1
        same = F.zip_with(F.slice(sorted_hashes, F.lit(1), n), F.slice(sorted_hashes, F.lit(2), n),
                          lambda a, b: F.when(a == b, a))
        return F.array_distinct(F.filter(same, lambda a: a.isNotNull()))

    def by_lookup(g: Column, again: Column) -> Column:
        at = F.transform(g, lambda x, i: F.when(F.array_contains(again, x), i.cast("long")))
        return let(F.filter(at, lambda i: i.isNotNull()), covered)

    def by_sort(g: Column) -> Column:
        runs = F.sort_array(F.transform(g, lambda x, i: F.struct(x.alias("h"), i.cast("long").alias("p"))))
        return let(runs, lambda r: let(F.sort_array(F.transform(F.filter(
            r, lambda x, i: F.coalesce(x["h"] == F.get(r, i - 1)["h"], F.lit(False))
            | F.coalesce(x["h"] == F.get(r, i + 1)["h"], F.lit(False))), lambda x: x["p"])), covered))

    def counted(g: Column) -> Column:
        return F.when(F.size(F.array_distinct(g)) == F.size(g), F.lit(0).cast("long")).otherwise(
            let(found_twice(F.sort_array(g)), lambda again: F.when(
                F.size(again) <= LOOKUP, by_lookup(g, again)).otherwise(by_sort(g))))

    return let(_following(h, pairs, 2), counted)


def duplicate_lines(text: Column) -> Column:
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: x.rlike("[^" + SPACE[1:]))
    return let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))


def symbols(text: Column) -> Column:
    """Characters of SYMBOLS; the search by single characters spares most texts the regular expression."""
    some = F.lit(False)
    for c in SYMBOLS:
        some = some | F.contains(text, F.lit(c))
    return F.when(some, F.length(text) - F.length(F.regexp_replace(text, f"[{SYMBOLS}]+", ""))).otherwise(0).cast("long")


def trusted_ids(labels: DataFrame, max_trusted: int = MAX_TRUSTED) -> DataFrame:
    """At most ``max_trusted`` ids whose labels are all good, by smallest hash."""
    good = (labels.filter("doc_id is not null").groupBy("doc_id")
            .agg(F.min(F.coalesce("quality", F.lit(0))).alias("q")).filter("q = 1"))
    return good.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_trusted).select(F.col("doc_id").alias("trusted_id"))


def log_ratios(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS,
               max_trusted: int = MAX_TRUSTED) -> list[float]:
    """log(target / raw) for each of the ``2 * buckets`` buckets."""
    ids = trusted_ids(labels, max_trusted)
    marked = docs.select("doc_id", "text").join(F.broadcast(ids), F.col("doc_id") == F.col("trusted_id"), "left")
    grams = marked.select(F.col("trusted_id").isNotNull().cast("long").alias("good"),
                          F.explode(let(word_hashes(words(F.col("text"))), lambda h: ngram_buckets(
                              h, pair_hashes(h), buckets))).alias("b"))
    counts = grams.groupBy("b").agg(F.count(F.lit(1)).alias("n"), F.sum("good").alias("good")).collect()  # 2 * buckets rows at most
    size = 2 * buckets
    raw, good = [0] * size, [0] * size
    for r in counts:
        raw[r["b"]], good[r["b"]] = r["n"], r["good"]
    all_raw, all_good = sum(raw) + size, sum(good) + size
    out = []
    for n, g in zip(raw, good, strict=True):
        p = (n + 1) / all_raw
        out.append(math.log((g + size * p) / all_good / p))
    return out


def verdict(text: Column, ratios: list[float], threshold: float = THRESHOLD) -> Column:
    """A struct of the base counts, ``log_ratio``, ``base_failed`` and ``kept`` for a text column."""
    text = F.coalesce(text, F.lit(""))
    # a foldable cast, which the optimizer turns into one literal array
    model = F.split(F.lit(",".join(map(repr, ratios))), ",").cast("array<double>")
    buckets = len(ratios) // 2

    def counts(found: Column, h: Column, pairs: Column) -> Column:
        n = F.size(h).cast("long")
        total = F.aggregate(ngram_buckets(h, pairs, buckets), F.lit(0.0), lambda a, b: a + F.get(model, b))
        return F.struct(
            n.alias("n_words"),
            _total(F.transform(found, lambda w: F.length(w).cast("long")), "long").alias("word_chars"),
            symbols(text).alias("n_symbols"),
            duplicate_lines(text).alias("n_dup_lines"),
            repeated_words(h, pairs).alias("n_repeat_words"),
            (total / (F.greatest(2 * n - 1, F.lit(0)) + LEAN)).alias("log_ratio"))

    def judged(v: Column) -> Column:
        failed = (v["n_words"] < MIN_WORDS) | (100 * v["n_repeat_words"] > 50 * v["n_words"])
        return F.struct(*[v[c].alias(c) for c in COUNTS], failed.alias("base_failed"),
                        (~failed & (v["log_ratio"] >= threshold)).alias("kept"))

    return let(let(words(text), lambda found: let(word_hashes(found), lambda h: let(
        pair_hashes(h), lambda pairs: counts(found, h, pairs)))), judged)
