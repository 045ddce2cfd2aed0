"""A trie of conversation prefixes, screened by a count-min sketch.

A prefix of d turns has a 128-bit digest: the exclusive or of a hash of each
turn with its place, so digests run along a conversation, and a prefix's
parent is found by taking its last turn out again.  A count-min sketch of all
digests (``count_min``) proves most prefixes to be of one conversation alone;
their nodes are emitted where they are.  Only the possibly shared prefixes are
shuffled and grouped exactly.

What a node says of its subtree is summed without visiting descendants: each
node below it is accounted to its smallest member, whose row at this node
carries the sum of what it accounts for from here down, and the rows of a node
are added up.

Bounds: texts are read once and never shuffled, only digests are (and the
first 64 code points, for the order of turns with one number).  Order and
running sums within a conversation go by stretches of 4096 turn numbers, with
the totals of the stretches before, so a very long conversation is spread over
tasks.  Counts are partial aggregates; children of the few nodes that hold more
than 1/2000 of the shared rows meet them by broadcast (fewer than 2000 rows), all other keys are small.  The sketch has 64 MB at
most: beyond some 100 million prefixes more of them are shuffled, as digests,
and the result stays the same.

Defined results: rows without a conv_id belong to no conversation and are left
out; turns are in order of their number (null first), then role, the first 64
code points of the text, and hash; null roles and texts are empty; a repeated
row is a turn like others; an empty table gives an empty result; other columns
don't matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickflow.session import ship_package

from . import count_min
from .common import materialize

STRETCH_BITS = 12
HEAD = 64
#: Nodes with more than this share of the shared rows are broadcast to their children.
HOT_SHARE = 2000
NODE = ["depth", "x1", "x2"]


def _running(rows: DataFrame, key: str, order: list[Column], stretch: Column, what: dict[str, tuple[Callable, str]],
             put: Callable[[Column, Column], Column], backward: bool = False) -> DataFrame:
    """Adds running aggregates per key: within stretches by a window, and the stretches before by their totals."""
    rows = rows.withColumn("_s", stretch)
    inside = Window.partitionBy(key, "_s").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy(key).orderBy(F.desc("_s") if backward else F.asc("_s")).rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy(key, "_s").agg(*[f(c).alias(c) for f, c in what.values()])
    carried = totals.select(key, "_s", *[f(c).over(before).alias(f"_c_{o}") for o, (f, c) in what.items()]).filter(
        F.coalesce(*[F.col(f"_c_{o}") for o in what]).isNotNull())
    done = rows.select("*", *[f(c).over(inside).alias(f"_w_{o}") for o, (f, c) in what.items()]).join(carried, [key, "_s"], "left")
    for o in what:
        done = done.withColumn(o, put(F.col(f"_w_{o}"), F.coalesce(F.col(f"_c_{o}"), F.lit(0))))
    return done.drop("_s", *[f"_{k}_{o}" for k in "wc" for o in what])


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, e1, e2, n_chars): the turns of each conversation in order, as digests, numbered from 1."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), F.left(text, F.lit(HEAD)).alias("head"),
        F.xxhash64(F.lit(1), role, text).alias("e1"), F.xxhash64(F.lit(2), role, text).alias("e2"),
        F.length(text).cast("long").alias("n_chars"), F.lit(1).cast("long").alias("one"))
    order = [F.asc_nulls_first("turn"), F.asc("role"), F.asc("head"), F.asc("e1"), F.asc("e2")]
    stretch = F.coalesce(F.shiftright(F.col("turn").cast("long"), STRETCH_BITS), F.lit(-(1 << 60)))
    placed = _running(turns, "conv_id", order, stretch, {"pos": (F.sum, "one")}, lambda a, b: a + b)
    return placed.select("conv_id", "pos", "e1", "e2", "n_chars")


def with_shared_starts(turns: DataFrame, family: int = 100, most: int = 5) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt on their family's first turns: (steps, conversations) as ``prefix_trie`` takes them.

    Conversation c starts with the first h turns of conversation c - c % family (h: the crc32
    of the decimal c, modulo most + 1) and goes on with its own turns after its first h.
    """
    h = F.pmod(F.crc32(F.col("conv_id").cast("string")), F.lit(most + 1))
    first = F.col("conv_id") - F.col("conv_id") % family
    heads = turns.filter((F.col("conv_id") % family == 0) & (F.col("pos") <= most)).select(
        F.col("conv_id").alias("first"), F.struct("pos", "e1", "e2", "n_chars").alias("turn"))
    heads = heads.groupBy("first").agg(F.sort_array(F.collect_list("turn")).alias("head"))  # five turns at most
    convs = (turns.groupBy("conv_id").agg(F.max("pos").alias("n_own")).select("conv_id", "n_own", h.alias("h"), first.alias("first"))
             .join(heads, "first", "left"))
    convs = materialize(convs.select("conv_id", "n_own", "h", F.coalesce(F.slice("head", F.lit(1), F.col("h").cast("int")),
                                                                         F.array().cast(heads.schema["head"].dataType)).alias("head")), "conversations")
    size = F.size("head").cast("long") + F.greatest(F.col("n_own") - F.col("h"), F.lit(0))
    listed = convs.select("conv_id", size.alias("n_steps"))
    start = convs.select("conv_id", F.explode("head").alias("t")).select("conv_id", F.col("t.pos").alias("depth"), "t.e1", "t.e2", "t.n_chars")
    own = turns.filter(F.col("pos") > h).join(convs.select("conv_id", "h", F.size("head").alias("m")), "conv_id").select(
        "conv_id", (F.col("m") + F.col("pos") - F.col("h")).alias("depth"), "e1", "e2", "n_chars")
    return start.unionByName(own), listed


def _prefixes(steps: DataFrame, conversations: DataFrame) -> DataFrame:
    """(conv_id, depth, x1, x2, p1, p2, n_chars): every prefix's digest and its parent's; depth 0 included."""
    terms = steps.select("conv_id", "depth", "n_chars", F.xxhash64(F.lit(1), "depth", "e1").alias("t1"), F.xxhash64(F.lit(2), "depth", "e2").alias("t2"))
    run = _running(terms, "conv_id", [F.asc("depth")], F.shiftright("depth", STRETCH_BITS),
                   {"x1": (F.bit_xor, "t1"), "x2": (F.bit_xor, "t2")}, lambda a, b: a.bitwiseXOR(b))
    zero = F.lit(0).cast("long")
    root = conversations.select("conv_id", zero.alias("depth"), *[zero.alias(c) for c in ("x1", "x2", "p1", "p2", "n_chars")])
    return run.select("conv_id", "depth", "x1", "x2", F.col("x1").bitwiseXOR(F.col("t1")).alias("p1"),
                      F.col("x2").bitwiseXOR(F.col("t2")).alias("p2"), "n_chars").unionByName(root)


def _screened(prefixes: DataFrame, max_width: int) -> DataFrame:
    """Adds ``maybe`` and ``parent_maybe``, false where the sketch proves one conversation alone."""
    spark = prefixes.sparkSession
    ship_package(spark)
    width = count_min.width_for(prefixes.count(), max_width)
    sketch = spark.sparkContext.broadcast(count_min.repeated(prefixes, width))  # 64 MB at most

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, of in (("maybe", ("x1", "x2")), ("parent_maybe", ("p1", "p2"))):
                b = b.append_column(name, pa.array(count_min.maybe_repeated(sketch.value, b.column(of[0]), b.column(of[1]))))
            yield b

    schema = ", ".join(f"{n} {t}" for n, t in prefixes.dtypes) + ", maybe boolean, parent_maybe boolean"
    out = materialize(prefixes.mapInArrow(test, schema), "screened")
    sketch.destroy()
    return out


def prefix_trie(steps: DataFrame, conversations: DataFrame, max_width: int = count_min.MAX_WIDTH) -> tuple[DataFrame, DataFrame]:
    """The nodes, and the members that end at nodes of several members.

    Takes (conv_id, depth, e1, e2, n_chars), a row per turn with its digest and depth from 1,
    and (conv_id, n_steps), a row per conversation.  Nodes: conv_id (the smallest member), depth, x1, x2
    (the prefix's digest), parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, n_ends.
    Ends: depth, x1, x2, conv_id.
    """
    with_size = _prefixes(steps, conversations).join(conversations, "conv_id").withColumn("last", F.col("depth") == F.col("n_steps")).drop("n_steps")
    rows = _screened(materialize(with_size, "prefixes"), max_width)
    shared, alone = rows.filter("maybe"), rows.filter("not maybe")
    has_parent = (F.col("depth") > 0) & F.col("parent_maybe")
    groups = materialize(shared.groupBy(*NODE).agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("n_chars").alias("n_chars"), F.max("p1").alias("p1"),
        F.max("p2").alias("p2"), F.max("parent_maybe").alias("parent_maybe"), F.sum(F.col("last").cast("long")).alias("n_ends")), "nodes")
    above = [(F.col("depth") - 1).alias("depth"), F.col("p1").alias("x1"), F.col("p2").alias("x2")]
    children = (groups.filter(has_parent).select(*above).unionByName(alone.filter(has_parent).select(*above))
                .groupBy(*NODE).agg(F.count(F.lit(1)).alias("n_children")))
    # a shared node's child may be alone although the sketch could not say so of the parent: then it is in `alone`
    groups = materialize(groups.join(children, NODE, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)).cast("long")), "grown-nodes")

    # each node's own share goes to its smallest member's row, each lone leaf's to its conversation
    share = groups.select("conv_id", "depth", ((F.col("n_convs") - 1) * F.col("n_chars")).alias("saved"),
                          (F.col("n_children") == 0).cast("long").alias("leaf"))
    none = F.lit(0).cast("long")
    carried = shared.join(share, ["conv_id", "depth"], "left").select(
        "conv_id", *NODE, F.coalesce("saved", none).alias("saved"), F.coalesce("leaf", none).alias("leaf"), F.lit(True).alias("here"))
    lone = alone.filter("last").select("conv_id", *NODE, none.alias("saved"), F.lit(1).cast("long").alias("leaf"), F.lit(False).alias("here"))
    below = _running(carried.unionByName(lone), "conv_id", [F.desc("depth")], F.shiftright("depth", STRETCH_BITS),
                     {"saved_tokens": (F.sum, "saved"), "n_leaves": (F.sum, "leaf")}, lambda a, b: a + b, backward=True)
    sums = below.filter("here").groupBy(*NODE).agg(F.sum("saved_tokens").alias("saved_tokens"), F.sum("n_leaves").alias("n_leaves"))

    columns = ["conv_id", *NODE, "p1", "p2", "parent_maybe", "n_convs", "n_children", "n_leaves", "saved_tokens", "n_ends"]
    one = F.lit(1).cast("long")
    nodes = groups.join(sums, NODE).select(*columns)
    tails = alone.select("conv_id", *NODE, "p1", "p2", "parent_maybe", one.alias("n_convs"), (~F.col("last")).cast("long").alias("n_children"),
                         one.alias("n_leaves"), none.alias("saved_tokens"), F.col("last").cast("long").alias("n_ends"))
    every = nodes.unionByName(tails)
    named = _with_parents(every.filter(has_parent), groups, shared.count())
    # a parent proven alone has the same single member
    rest = every.filter(~has_parent).withColumn("parent_conv_id", F.when(F.col("depth") > 0, F.col("conv_id")))
    out = [c for c in columns if c not in ("p1", "p2", "parent_maybe")]
    out.insert(4, "parent_conv_id")
    many = groups.filter("n_convs > 1 and n_ends > 0").select(*NODE)
    ends = shared.filter("last").select(*NODE, "conv_id").join(many, NODE, "left_semi")
    return materialize(named.select(*out).unionByName(rest.select(*out)), "trie"), ends


def _with_parents(nodes: DataFrame, groups: DataFrame, n_rows: int) -> DataFrame:
    """Adds the smallest member of each node's parent; nodes with very many rows are broadcast, no other key is frequent."""
    parents = groups.select((F.col("depth") + 1).alias("depth"), F.col("x1").alias("p1"), F.col("x2").alias("p2"),
                            F.col("conv_id").alias("parent_conv_id"), (F.col("n_convs") * HOT_SHARE > n_rows).alias("hot"))
    key = ["depth", "p1", "p2"]
    hot = F.broadcast(parents.filter("hot").drop("hot").withColumnRenamed("parent_conv_id", "hot_conv_id"))
    met = nodes.join(hot, key, "left")
    rest = met.filter("hot_conv_id is null").drop("hot_conv_id").join(parents.filter("not hot").drop("hot"), key)
    return met.filter("hot_conv_id is not null").withColumnRenamed("hot_conv_id", "parent_conv_id").unionByName(rest)


def _chunks(batches: Iterator[pa.RecordBatch], most: int = 50_000) -> Iterator[pa.RecordBatch]:
    """Runs of one node's members, sorted, as comma-joined texts: (depth, x1, x2, first, ids)."""
    node, ids, out = None, [], []

    def close():
        out.append((*node, ids[0], ",".join(map(str, ids))))

    def batch():
        columns = list(zip(*out, strict=True))
        kinds = [pa.int64()] * 4 + [pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], [*NODE, "first", "ids"])

    for b in batches:
        for *key, conv_id in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if key != node or len(ids) >= most:
                if ids:
                    close()
                node, ids = key, []
            ids.append(conv_id)
        if sum(len(r[4]) for r in out) > 4_000_000:
            yield batch()
            out.clear()
    if ids:
        close()
    if out:
        yield batch()


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sha256 of each node's comma-joined chunks, which come in order: a node is read, never held."""
    node, state, out = None, None, []

    def batch():
        columns = list(zip(*out, strict=True))
        kinds = [pa.int64()] * 3 + [pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], [*NODE, "ends_sha256"])

    for b in batches:
        for *key, _, ids in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if key == node:
                state.update(b",")
            else:
                if node is not None:
                    out.append((*node, state.hexdigest()))
                node, state = key, hashlib.sha256()
            state.update(ids.encode())
        if len(out) > 50_000:
            yield batch()
            out.clear()
    if node is not None:
        out.append((*node, state.hexdigest()))
    if out:
        yield batch()


def ends_hash(ends: DataFrame) -> DataFrame:
    """(depth, x1, x2, ends_sha256) of (depth, x1, x2, conv_id): the members in ascending order, comma-joined.

    Members are range-sorted, so a frequent node's are first joined to long texts by many tasks.
    """
    ship_package(ends.sparkSession)
    order = [*NODE, "conv_id"]
    chunks = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        _chunks, "depth long, x1 long, x2 long, first long, ids string")
    return (chunks.repartition(*NODE).sortWithinPartitions(*NODE, "first")
            .mapInArrow(_hashes, "depth long, x1 long, x2 long, ends_sha256 string"))
