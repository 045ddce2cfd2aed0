"""Chat formatting by multi-party perspective rotation.

For every participant of a dialogue the dialogue is rendered once more with
that participant as the assistant, everyone else as named users, and a mask of
what the assistant says.  System turns set the scene for everyone and are no
participant.

    <|im_start|>system\\n...<|im_end|>\\n
    <|im_start|>user name=ann\\n...<|im_end|>\\n
    <|im_start|>assistant\\n...<|im_end|>\\n

``targets`` lists the mask as start:end of code points, comma-joined: the
assistant's words and the end marker after them.  Markers inside a turn's own
text are written "< |im_" so that no text can open or close a turn.

A dialogue is rendered whole: every participant gets a view of every turn, also
of those before they join.  A view of more than ``PART`` turns goes over several rows,
parts of PART consecutive turns, so no row and no task grows with a dialogue;
each later part opens with the system turns of the first, which set its scene, and
these are not counted again.

Defined results: a turn repeated in full is a turn like others; turns are ordered by
number (null first), then speaker and text; a null text is empty; turns with a
null conversation id are one dialogue; a null role is the participant
"unknown"; markers and line breaks in a role can open no turn either (they are
written "< |im_" and as spaces); a dialogue of system turns alone has no view; an empty
table gives an empty result; other columns don't matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PART = 512
#: Turn numbers are ranked in stretches of 2**12, so a long dialogue is ranked by many tasks.
STRETCH_BITS = 12
START, END = "<|im_start|>", "<|im_end|>"


def _escaped(text: Column) -> Column:
    return F.replace(text, F.lit("<|im_"), F.lit("< |im_"))


def _placed(rows: DataFrame) -> DataFrame:
    """Adds ``place``, a turn's number in its dialogue from 0: within stretches by a window, the stretches before by their counts."""
    stretch = F.coalesce(F.shiftright(F.col("turn").cast("long"), STRETCH_BITS), F.lit(-(1 << 60)))
    rows = rows.withColumn("stretch", stretch)
    inside = Window.partitionBy("conv_id", "stretch").orderBy(F.asc_nulls_first("turn"), "role", "said")
    earlier = Window.partitionBy("conv_id").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    before = (rows.groupBy("conv_id", "stretch").agg(F.count(F.lit(1)).alias("n"))
              .select(F.col("conv_id").alias("c"), F.col("stretch").alias("s"), F.sum("n").over(earlier).alias("before")).filter("before is not null"))
    ranked = rows.withColumn("rank", F.row_number().over(inside).cast("long") - 1)
    met = ranked.join(before, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("stretch") == F.col("s")), "left")
    return met.select("conv_id", "role", "said", (F.col("rank") + F.coalesce("before", F.lit(0))).alias("place"))


def rotate(turns: DataFrame, part: int = PART) -> DataFrame:
    """A row per dialogue, part and participant: conv_id, part, speaker, n_turns, n_targets, text, targets."""
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit("unknown")).alias("role"), _escaped(F.coalesce("text", F.lit(""))).alias("said"))
    people = rows.filter("role <> 'system'").select(F.col("conv_id").alias("c"), F.col("role").alias("speaker")).distinct()
    parts = (_placed(rows).groupBy("conv_id", F.floor(F.col("place") / part).alias("part"))
             .agg(F.sort_array(F.collect_list(F.struct("place", "role", "said"))).alias("turns")))  # at most ``part`` turns
    system = F.filter("turns", lambda t: t["role"] == "system")
    scene = parts.filter("part = 0").select(F.col("conv_id").alias("s"), system.alias("scene")).filter(F.size("scene") > 0)
    first = parts.filter("part = 0").withColumn("scene", F.slice("turns", 1, 0))
    later = parts.filter("part > 0").join(scene, F.col("conv_id").eqNullSafe(F.col("s")), "left").drop("s").withColumn(
        "scene", F.coalesce("scene", F.slice("turns", 1, 0)))
    views = first.unionByName(later).join(people, F.col("conv_id").eqNullSafe(F.col("c")))
    own = F.filter("turns", lambda t: t["role"] == F.col("speaker"))
    done = views.withColumn("view", render(F.concat("scene", "turns"), F.col("speaker")))
    return done.select(
        "conv_id", "part", "speaker", F.size("turns").cast("long").alias("n_turns"), F.size(own).cast("long").alias("n_targets"),
        F.col("view.text").alias("text"), F.array_join("view.spans", ",").alias("targets"))


def render(turns: Column, speaker: Column) -> Column:
    """A struct of the text and the spans that ``speaker`` says, of an array of (turn, role, said)."""
    def head(t: Column) -> Column:
        who = (F.when(t["role"] == speaker, F.lit("assistant")).when(t["role"] == "system", F.lit("system"))
               .otherwise(F.concat(F.lit("user name="), F.translate(_escaped(t["role"]), "\r\n", "  "))))
        return F.concat(F.lit(START), who, F.lit("\n"))

    parts = F.transform(turns, lambda t: F.struct(
        head(t).alias("head"), F.concat(t["said"], F.lit(END)).alias("body"), (t["role"] == speaker).alias("own")))

    def step(acc: Column, p: Column) -> Column:
        start = acc["at"] + F.length(p["head"])
        end = start + F.length(p["body"])
        span = F.concat(start.cast("string"), F.lit(":"), end.cast("string"))
        return F.struct((end + 1).alias("at"), F.when(p["own"], F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"]).alias("spans"))

    none = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("spans"))
    text = F.concat(F.array_join(F.transform(parts, lambda p: F.concat(p["head"], p["body"])), "\n"), F.lit("\n"))
    return F.struct(text.alias("text"), F.aggregate(parts, none, step)["spans"].alias("spans"))
