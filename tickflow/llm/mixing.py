"""Mixing sources to target weights along a time-varying curriculum.

Targets: sources in code-point order (null last) weigh ``WEIGHTS`` in turn and
share ``share`` times all words; a target stops at ``limit`` times its source's
words and the excess is shared again by weight until none is above.  What a
source gives at most is reached at a level common to all others, so each round
is one aggregation over the table of sources.

Order: a source's documents form a stream in the order of a hash of id and
text.  The mix takes the stream as often as the target asks, whole passes
first; the last pass ends at the word that meets the target, so only one
document of a source is taken in part.

Positions: a source's weight over training time t in [0, 1) is 1 + a (2t - 1),
with the slope a from ``SLOPES`` in turn.  Its integral is the share of the
source's words asked for up to t; inverting it at a document's place in the stream
gives the training position.  Sorting by position mixes the sources.

A source's stream is summed in hash ranges of about ``RANGE`` documents: sums of
the ranges first, then a running sum within each, so no source, however large,
is one task.  Null ids or repeated rows spread by their text.

Defined results: null and empty texts have size 0, are never taken and have no
position; equal rows are taken like different documents; a null source is a source of its own,
the last; an empty table gives an empty result.  Reruns agree, whatever the partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, words

WEIGHTS = (3, 1, 2)
SLOPES = (-0.5, 0.0, 0.5)
SHARE = 1.5
LIMIT = 2
RANGE = 1024


def sizes(docs: DataFrame, *keep: Column) -> DataFrame:
    """source, size, key (the place in the stream's order) and ``keep``."""
    return docs.select(*keep, docs["source"].alias("source"), F.size(words(docs["text"])).cast("long").alias("size"),
                       F.xxhash64(docs["doc_id"], F.xxhash64(docs["text"])).alias("key"))


def ranked(rows: DataFrame, by: str) -> DataFrame:
    """Adds ``rank`` (from 0) in the order of ``by``, null last: ranges are counted, then numbered within."""
    order = F.col(by).asc_nulls_last()
    parts = materialize(rows.repartitionByRange(order).withColumn("range", F.spark_partition_id()), "ranges")
    counts = parts.groupBy("range").agg(F.count(F.lit(1)).alias("n"))
    before = counts.select("range", (F.sum("n").over(Window.orderBy("range")) - F.col("n")).alias("before"))
    within = F.row_number().over(Window.partitionBy("range").orderBy(order)) - 1
    return parts.join(before, "range").withColumn("rank", F.col("before") + within).drop("range", "before")


def targets(rows: DataFrame, share: float = SHARE, limit: float = LIMIT) -> DataFrame:
    """A row per source: source, source_size, weight, slope, target."""
    one = ranked(rows.groupBy("source").agg(F.sum("size").alias("source_size")), "source")
    turn = lambda values: F.array(*map(F.lit, values))
    one = materialize(one.select(
        "source", "source_size", F.get(turn(WEIGHTS), (F.col("rank") % len(WEIGHTS)).cast("int")).alias("weight"),
        F.get(turn(SLOPES), (F.col("rank") % len(SLOPES)).cast("int")).alias("slope")), "sources")
    most = limit * F.col("source_size")
    asked = share * (one.agg(F.sum("source_size")).first()[0] or 0)
    level = 0.0
    while True:  # the level at which the sources below their limit share what the others cannot give
        above = F.col("weight") * level > most
        full, weight = one.agg(F.sum(F.when(above, most)), F.sum(F.when(~above, F.col("weight")))).first()
        new = (asked - (full or 0)) / weight if weight else level
        if new <= level:
            break
        level = new
    return one.withColumn("target", F.least(F.col("weight") * F.lit(level), most.cast("double")))


def _same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def plan(rows: DataFrame, goals: DataFrame, narrow: DataFrame) -> DataFrame:
    """``rows`` with source_size, target, slope, goal (words), bucket and nth (its place in the stream), start (words before
    it there), passes, extra, taken; ``narrow`` holds their sources, sizes and keys.

    ``rows`` are shuffled once: the running sum and the join use the same keys, null sources told apart by one of their own.
    """
    ranges = max(1, -(-narrow.count() // RANGE))
    stretch = ["no_source", "of_source", "bucket"]

    def placed(df: DataFrame) -> DataFrame:
        place = F.shiftrightunsigned("key", 33) * F.lit(ranges).cast("long")
        return df.withColumns({"no_source": F.isnull("source"), "of_source": F.coalesce("source", F.lit("")), "bucket": F.shiftright(place, 31)})

    goals = goals.select(F.col("source").alias("g"), "source_size", "target", "slope", F.round("target").cast("long").alias("goal"))
    sums = placed(narrow).groupBy("source", *stretch).agg(F.sum("size").alias("n"))
    before = sums.withColumn("before", F.sum("n").over(Window.partitionBy("source").orderBy("bucket")) - F.col("n"))
    before = before.join(goals, _same(F.col("source"), F.col("g"))).drop("source", "n", "g")
    order = Window.partitionBy(*stretch).orderBy("key", "size")
    out = (placed(rows).withColumn("within", F.coalesce(F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
           .withColumn("nth", F.row_number().over(order))
           .join(before, stretch)
           .withColumn("start", F.col("before") + F.col("within")))
    size = F.col("source_size")
    passes = F.when(size > 0, F.floor(F.col("goal") / size)).otherwise(0)
    left = F.col("goal") - F.col("passes") * size
    extra = F.greatest(F.lit(0), F.least(left - F.col("start"), F.col("size")))
    return (out.withColumn("passes", passes).withColumn("extra", extra)
            .withColumn("taken", F.col("passes") * F.col("size") + F.col("extra"))
            .drop("no_source", "of_source", "before", "within"))


def position(words_before: Column, goal: Column, slope: Column) -> Column:
    """The training time at which a source has given so many words: the inverse of t + slope (t**2 - t)."""
    u = words_before / F.greatest(goal, F.lit(1))
    b = 1 - slope
    return F.when(slope == 0, u).otherwise((F.sqrt(b * b + 4 * slope * u) - b) / (2 * slope))


def uses(planned: DataFrame, unused: bool = False) -> DataFrame:
    """A row per pass that takes words of a document: all columns, ``words_taken`` and ``position``; with ``unused`` also one,
    without a ``use``, for each document that no pass takes words of."""
    partly = F.when(F.col("extra") > 0, F.array(F.col("passes"))).otherwise(F.array().cast("array<bigint>"))
    whole = F.when((F.col("passes") > 0) & (F.col("size") > 0), F.sequence(F.lit(0).cast("long"), F.col("passes") - 1)).otherwise(
        F.array().cast("array<bigint>"))
    each = planned.withColumn("use", (F.explode_outer if unused else F.explode)(F.concat(whole, partly)))
    return (each.withColumn("words_taken", F.when(F.col("use") < F.col("passes"), F.col("size")).otherwise(F.col("extra")))
            .withColumn("position", position(F.col("use") * F.col("source_size") + F.col("start"), F.col("goal"), F.col("slope"))))


def mix_plan(docs: DataFrame) -> DataFrame:
    """A row per document: doc_id, size, source_size, target, taken, first_position."""
    rows = materialize(sizes(docs, docs["doc_id"].alias("doc_id")), "mix-sizes")
    out = plan(rows, targets(rows), rows)
    first = F.when(F.col("taken") > 0, position(F.col("start"), F.col("goal"), F.col("slope")))
    return out.select("doc_id", "size", "source_size", "target", "taken", first.alias("first_position"))


def mixed_uses(docs: DataFrame, unused: bool = False) -> DataFrame:
    """The uses in training order, with the columns of ``docs`` under ``r``; the text of one used in part is cut after the words taken."""
    narrow = materialize(sizes(docs), "mix-sizes")
    row = F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("r")
    used = uses(plan(sizes(docs, row), targets(narrow), narrow), unused)
    head = F.array_join(F.slice(words(F.col("r.text")), F.lit(1), F.col("words_taken").cast("int")), " ")
    text = F.when(F.col("words_taken") < F.col("size"), head).otherwise(F.col("r.text"))
    mixed = used.withColumn("r", F.col("r").withField("text", text))
    return mixed.repartitionByRange("position", "key", "use").sortWithinPartitions("position", "key", "use")


def mix(docs: DataFrame) -> DataFrame:
    """The mix itself in training order: the columns of ``docs``, a row for each time a document is used.

    A document used in part, one per source, has its text cut after the words taken.
    """
    return mixed_uses(docs).select(*[F.col(f"r.`{c}`").alias(c) for c in docs.columns])


def mix_digest(docs: DataFrame) -> DataFrame:
    """What the mix takes of each document: doc_id, size, source_size, target, taken (words counted in the mixed texts), first_position.

    Equal rows stay apart by their places in the stream.
    """
    mixed = mixed_uses(docs.select("doc_id", "text", "source"), unused=True)
    words_in = F.when(F.col("use").isNotNull(), F.size(words(F.col("r.text")))).otherwise(0).cast("long")
    narrow = mixed.select("source", "bucket", "nth", F.col("r.doc_id").alias("doc_id"), "size", "source_size", "target",
                          words_in.alias("words_in"), F.when(F.col("use").isNotNull(), F.col("position")).alias("position"))
    first = [F.first(c).alias(c) for c in ("doc_id", "size", "source_size", "target")]
    each = narrow.groupBy("source", "bucket", "nth").agg(*first, F.sum("words_in").alias("taken"), F.min("position").alias("first_position"))
    return each.select("doc_id", "size", "source_size", "target", "taken", "first_position")
