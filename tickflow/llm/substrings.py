"""Substring de-duplication on the de Bruijn graph of the corpus.

Every window of ``WINDOW`` words is an edge from its first to its last
WINDOW - 1 words.  A window goes when the same words also start in a document with a smaller
doc_id; the words it covers are removed.  The first source of an edge is its
smallest (doc_id, position).

1. Minimizers: each window's least 5-word hash.  Equal windows have equal
   minimizers, so windows whose minimizer is found in one document only cannot repeat.
   Repeated minimizers are counted over all rows and put into a Bloom filter of
   bounded size (bloom.MAX_WORDS: 16 MB), which goes to the tasks.
2. Repeated edges: windows that pass the filter are sorted by their 96-bit hash.
   The first row of a run is the edge's first source; every other row in another
   document is a repeat.  A false positive of the filter is a run of one.
   Hot edges (more often than one in ``HOT`` repeated minimizers, the most frequent ``HOT_EDGES`` of
   them) are counted and given their first source beforehand, in a table of that size
   at most; so their rows can be dealt over ``SALTS`` parts. All others are sorted whole.
3. Compaction: repeats of a document that follow each other, from sources that follow
   each other too, are edges through a node with one way in and one way out. They are
   compacted within stretches of ``STRETCH`` windows first; pieces that end and begin at a
   stretch's border in the same node (place, source, place in the source) are joined there, and
   the chains they form are followed to their heads by pointer doubling. Where document and source
   part, or the edge's first source is another document, the path ends.  A path is one
   row: its place, its length and its source's coordinates.
4. Verification: the words at a path's source coordinates are read from the source's
   text, and their digest (128-bit BLAKE2b) goes to the path.  A path is cut only where the document's own
   words have that digest, so no hash of step 1 or 2 decides alone that words go.
5. The paths of each document are joined to it and cut out.  Bloom filters of the
   documents that have paths, and of their sources, let all others pass without a shuffle.

An edge that follows itself (one word over and over) is one row for as long as it
does, so even an edge in every document is a small part of the rows sorted; the
rows of an edge are read as a stream and never held whole.  Such a row is a path of its own,
whose source is one window.  Per document Spark collects its paths (one per start at most) and
the spans asked of it as a source (one per start and length at most).

Defined results: null and empty texts have no words; documents shorter than
a window keep all; a null doc_id counts as larger than any; rows of the same
doc_id don't remove each other's words, repeated rows give equal results; an empty table
gives an empty result; other columns don't matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickflow.session import ship_package

from .bloom import MAX_WORDS, key_filter, maybe_in
from .common import materialize
from .textwindows import WordHashes, hashed, in_chunks, text_numbers, texts_of, window_hashes

WINDOW = 13
SEED_WORDS = 5
LAST = (1 << 63) - 1
HOT = 1024
HOT_EDGES = 4096
SALTS = 4096
#: Windows of a document that are compacted in one group; a longer path goes on over joins.
STRETCH = 4096


def _windows(texts: list[bytes], words: WordHashes, k: int):
    """Per chunk: the first text's number, then of each window its text, its position, its minimizer and its word hashes."""
    for a, b in in_chunks(texts):
        h, counts = hashed(texts[a:b], words)
        text, at = text_numbers(counts)
        n = len(h) - k + 1
        if n <= 0:
            continue
        inside = np.flatnonzero(text[:n] == text[k - 1:])
        seeds = window_hashes(h, SEED_WORDS)
        least = seeds[:n].copy()
        for j in range(1, k - SEED_WORDS + 1):
            np.minimum(least, seeds[j:j + n], out=least)
        yield a, text, at, inside, least, h


def _minimizers(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    words = WordHashes()
    for batch in batches:
        docs = batch.column(0).to_numpy(zero_copy_only=False)
        for a, text, _, inside, least, _ in _windows(texts_of(batch.column(1)), words, k):
            m, t = least[inside], text[inside]
            new = np.ones(len(m), bool)
            new[1:] = (m[1:] != m[:-1]) | (t[1:] != t[:-1])
            yield pa.RecordBatch.from_arrays([pa.array(m[new].view(np.int64)), pa.array(docs[a + t[new]])], ["m", "doc"])


_HOT_COUNTS = "hash long, extra int, doc long, key long, at int, n long"
_EDGES = "hash long, extra int, doc long, key long, at int, run int, salt int"
_REPEATS = "key long, at int, run int, source long, source_at int"


def _edge_hashes(h: np.ndarray, i: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The 64 and 31 bits that name the windows at ``i``."""
    other = h * np.uint64(0xD6E8FEB86659FD93) ^ (h >> np.uint64(31))
    if 8 * len(i) < len(h):  # few: only theirs are reckoned
        edge, extra = window_hashes(h, k, i), window_hashes(other, k, i)
    else:
        edge, extra = window_hashes(h, k)[i], window_hashes(other, k)[i]
    return edge.view(np.int64), (extra >> np.uint64(33)).astype(np.int32)


class HotEdges:
    """The first sources of the edges found most often, sorted by hash; one edge a hash."""

    def __init__(self, rows: pa.Table):
        cols = [rows[c].to_numpy() for c in ("hash", "extra", "doc", "key", "at")]
        _, one = np.unique(cols[0], return_index=True)
        self.hash, self.extra, self.doc, self.key, self.at = (c[one] for c in cols)

    def find(self, edge: np.ndarray, extra: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the edges are hot, and those edges' places here."""
        if not len(self.hash):
            return np.zeros(len(edge), bool), np.empty(0, np.int64)
        place = np.minimum(np.searchsorted(self.hash, edge), len(self.hash) - 1)
        hot = (self.hash[place] == edge) & (self.extra[place] == extra)
        return hot, place[hot]


def _hot_counts(batches: Iterator[pa.RecordBatch], k: int, minimizers: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The windows with a hot minimizer, counted within a chunk of texts, with their first source there."""
    words = WordHashes()
    low = np.zeros(1 << 16, bool)
    low[minimizers & np.uint64(0xFFFF)] = True
    for batch in batches:
        docs, keys = (batch.column(j).to_numpy(zero_copy_only=False) for j in (0, 2))
        for a, text, at, inside, least, h in _windows(texts_of(batch.column(1)), words, k):
            i = inside[low[least[inside] & np.uint64(0xFFFF)]]
            i = i[np.isin(least[i], minimizers)]
            edge, extra = _edge_hashes(h, i, k)
            doc, key, place = docs[a + text[i]], keys[a + text[i]], at[i].astype(np.int32)
            order = np.lexsort((place, key, doc, extra, edge))
            edge, extra, doc, key, place = (c[order] for c in (edge, extra, doc, key, place))
            first = np.flatnonzero(np.append(True, (edge[1:] != edge[:-1]) | (extra[1:] != extra[:-1])))[:len(edge)]
            n = np.diff(np.append(first, len(edge)))
            yield pa.RecordBatch.from_arrays([pa.array(c[first]) for c in (edge, extra, doc, key, place)] + [pa.array(n.astype(np.int64))],
                                             [x.split()[0] for x in _HOT_COUNTS.split(", ")])


def _hot_edges(docs: DataFrame, again: DataFrame, k: int) -> HotEdges:
    """``again``: repeated minimizers (key) and the number of their documents (n), a written table."""
    total = again.agg(F.sum("n")).first()[0] or 0
    hot = again.filter(F.col("n") * HOT > total).select("key").toArrow()["key"].to_numpy().view(np.uint64)  # under HOT of them
    counts = docs.select("doc", "text", "key").mapInArrow(lambda b: _hot_counts(b, k, hot), _HOT_COUNTS)
    edges = (counts.groupBy("hash", "extra").agg(F.sum("n").alias("n"), F.min(F.struct("doc", "key", "at")).alias("first"))
             .filter(F.col("n") * HOT > total).orderBy(F.desc("n"), "hash", "extra").limit(HOT_EDGES))
    return HotEdges(edges.select("hash", "extra", "first.*").toArrow() if len(hot) else pa.schema(
        [(c, pa.int64()) for c in ("hash", "extra", "doc", "key", "at")]).empty_table())


def _candidate_edges(batches: Iterator[pa.RecordBatch], k: int, bits, hot) -> Iterator[pa.RecordBatch]:
    words = WordHashes()
    for batch in batches:
        docs, keys = (batch.column(j).to_numpy(zero_copy_only=False) for j in (0, 2))
        for a, text, at, inside, least, h in _windows(texts_of(batch.column(1)), words, k):
            i = inside[maybe_in(least[inside], bits.value)]
            edge, extra = _edge_hashes(h, i, k)
            # one word over and over repeats the same window at once: one row for the run
            new = np.ones(len(i), bool)
            new[1:] = (edge[1:] != edge[:-1]) | (extra[1:] != extra[:-1]) | (i[1:] != i[:-1] + 1) | (text[i[1:]] != text[i[:-1]])
            run = np.diff(np.append(np.flatnonzero(new), len(i))).astype(np.int32)
            edge, extra, i = edge[new], extra[new], i[new]
            doc, key, place = docs[a + text[i]], keys[a + text[i]], at[i].astype(np.int32)
            salt = np.where(hot.value.find(edge, extra)[0], (key + place) % SALTS + 1, 0).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (edge, extra, doc, key, place, run, salt)],
                                             [x.split()[0] for x in _EDGES.split(", ")])


def _repeats(batches: Iterator[pa.RecordBatch], hot) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by edge, document and position: those in another document than the edge's first source."""
    edge = source = last = None
    for batch in batches:
        h, x, doc, key, at, run = (batch.column(j).to_numpy(zero_copy_only=False) for j in range(6))
        n = len(h)
        if not n:
            continue
        new = np.ones(n, bool)
        new[1:] = (h[1:] != h[:-1]) | (x[1:] != x[:-1])
        same = np.zeros(n, bool)  # the same place of a repeated row
        same[1:] = ~new[1:] & (doc[1:] == doc[:-1]) & (key[1:] == key[:-1]) & (at[1:] == at[:-1])
        first = np.flatnonzero(new)
        sources = [c[first] for c in (doc, key, at)]
        is_hot, place = hot.value.find(h[first], x[first])
        for c, known in zip(sources, (hot.value.doc, hot.value.key, hot.value.at), strict=True):
            c[is_hot] = known[place]
        if edge == (h[0], x[0]):
            for c, value in zip(sources, source, strict=True):
                c[0] = value
            same[0] = last == (doc[0], key[0], at[0])
        edge, source, last = (h[-1], x[-1]), [c[-1] for c in sources], (doc[-1], key[-1], at[-1])
        source_doc, source_key, source_at = (c[np.cumsum(new) - 1] for c in sources)
        out = np.flatnonzero((doc != source_doc) & ~same)
        yield pa.RecordBatch.from_arrays([pa.array(c[out]) for c in (key, at, run, source_key, source_at)],
                                         ["key", "at", "run", "source", "source_at"])


def _pieces(repeats: DataFrame, stretch: int) -> DataFrame:
    """Nonbranching pieces within stretches of a document: key, at, windows, source, source_at, source_windows."""
    by = Window.partitionBy("key", "stretch").orderBy("at")
    before = F.lag(F.struct("at", "run", "source", "source_at")).over(by)
    linked = ((before["run"] == 1) & (F.col("run") == 1) & (before["at"] + 1 == F.col("at"))
              & (before["source"] == F.col("source")) & (before["source_at"] + 1 == F.col("source_at")))
    in_stretch = repeats.withColumn("stretch", F.floor(F.col("at") / stretch))
    return (in_stretch.withColumn("linked", linked).withColumn("piece", F.sum(F.when(F.col("linked"), 0).otherwise(1)).over(by))
            .groupBy("key", "stretch", "piece").agg(
                F.min("at").cast("long").alias("at"), F.sum("run").alias("windows"), F.min("source").alias("source"),
                F.min("source_at").cast("long").alias("source_at"),
                F.when(F.max("run") > 1, F.lit(1).cast("long")).otherwise(F.sum("run")).alias("source_windows"))
            .drop("stretch", "piece"))


def _joined_over_borders(pieces: DataFrame, stretch: int) -> DataFrame:
    """Pieces joined at the nodes they share on the borders of stretches; ``pieces`` is a written table."""
    plain = pieces.filter(F.col("windows") == F.col("source_windows"))
    end = F.col("at") + F.col("windows")
    ends = plain.filter(end % stretch == 0).select(
        "key", end.alias("at"), "source", (F.col("source_at") + F.col("windows")).alias("source_at"), F.col("at").alias("to"))
    starts = plain.filter((F.col("at") > 0) & (F.col("at") % stretch == 0)).select("key", "at", "source", "source_at", "windows")
    links = materialize(starts.join(ends, ["key", "at", "source", "source_at"]).select("key", "at", "to", "windows"), "links")
    if links.isEmpty():
        return pieces
    while True:  # each round doubles the distance a link goes back; a head has no link
        further = links.select("key", F.col("at").alias("to"), F.col("to").alias("head"))
        moved = materialize(links.join(further, ["key", "to"], "left"), "links")
        links = moved.select("key", "at", F.coalesce("head", "to").alias("to"), "windows")
        if moved.filter(F.col("head").isNotNull()).isEmpty():
            break
    more = links.groupBy("key", F.col("to").alias("at")).agg(F.sum("windows").alias("more"))
    longer = F.coalesce("more", F.lit(0))
    return (pieces.join(links.select("key", "at"), ["key", "at"], "left_anti").join(more, ["key", "at"], "left")
            .select("key", "at", (F.col("windows") + longer).alias("windows"), "source", "source_at",
                    (F.col("source_windows") + longer).alias("source_windows")))


def repeated_paths(docs: DataFrame, k: int = WINDOW, max_words: int = MAX_WORDS, stretch: int = STRETCH) -> DataFrame:
    """A row per path: key, at, windows, source (a key), source_at, source_windows (one for a window that follows itself).

    ``docs``: doc (long, not null), text, key (long, of document and text).
    """
    spark = docs.sparkSession
    ship_package(spark)
    found = docs.select("doc", "text").mapInArrow(lambda b: _minimizers(b, k), "m long, doc long")
    again = materialize(found.groupBy(F.col("m").alias("key")).agg(F.min("doc").alias("a"), F.max("doc").alias("b"), F.count("*").alias("n"))
                        .filter("a < b").select("key", "n"), "minimizers")
    bits = spark.sparkContext.broadcast(key_filter(again, max_words))
    hot = spark.sparkContext.broadcast(_hot_edges(docs, again, k))
    edges = docs.select("doc", "text", "key").mapInArrow(lambda b: _candidate_edges(b, k, bits, hot), _EDGES)
    repeats = (edges.repartition("hash", "salt").sortWithinPartitions("hash", "extra", "doc", "key", "at")
               .mapInArrow(lambda b: _repeats(b, hot), _REPEATS))
    return _joined_over_borders(materialize(_pieces(repeats, stretch), "pieces"), stretch)


def _digest(words: list[bytes]) -> bytes:
    return hashlib.blake2b(b" ".join(words), digest_size=16).digest()


_DIGESTS = "source long, source_at long, source_windows long, digest binary"


def _source_digests(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for key, text, starts, counts in zip(batch.column(0).to_pylist(), texts_of(batch.column(1)),
                                             batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
            words = text.split()
            digests = [_digest(words[s:s + c + k - 1]) for s, c in zip(starts, counts, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([key] * len(starts), pa.int64()), pa.array(starts, pa.int64()), pa.array(counts, pa.int64()), pa.array(digests, pa.binary())],
                [x.split()[0] for x in _DIGESTS.split(", ")])


def with_source_digests(paths: DataFrame, docs: DataFrame, k: int = WINDOW) -> DataFrame:
    """``paths`` with the digest of the words at their source coordinates. ``docs``: key, text."""
    spans = materialize(paths.select("source", "source_at", "source_windows").distinct(), "spans")
    bits = docs.sparkSession.sparkContext.broadcast(key_filter(spans.select(F.col("source").alias("key")).distinct()))
    asked = spans.groupBy(F.col("source").alias("key")).agg(F.collect_list(F.struct("source_at", "source_windows")).alias("spans"))
    texts = docs.select("key", "text")
    sources = texts.mapInArrow(lambda b: _others(b, bits), texts.schema).join(asked, "key").select(
        "key", "text", F.col("spans.source_at").alias("starts"), F.col("spans.source_windows").alias("counts"))
    digests = materialize(sources.mapInArrow(lambda b: _source_digests(b, k), _DIGESTS).distinct(), "digests")
    return paths.join(digests, ["source", "source_at", "source_windows"])


_KEPT = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string"


def _verified(words: list[bytes], path: dict, k: int) -> bool:
    """Whether the path's words are those at its source; a window that follows itself is one word over and over."""
    at, end = path["at"], path["at"] + path["windows"] + k - 1
    if end > len(words) or _digest(words[at:at + path["source_windows"] + k - 1]) != path["digest"]:
        return False
    return path["windows"] == path["source_windows"] or words[at:end] == [words[at]] * (end - at)


def _kept(doc_ids: pa.Array, texts: list[bytes], paths: list, k: int, with_text: bool) -> pa.RecordBatch:
    """Rows of _KEPT; ``paths``: for each text None or its paths."""
    n_words, n_removed, digest, kept_text = [], [], [], []
    for text, found in zip(texts, paths, strict=True):
        words = text.split()
        n_words.append(len(words))
        if found is not None:
            keep = np.ones(len(words), bool)
            for path in found:
                if _verified(words, path, k):
                    keep[path["at"]:path["at"] + path["windows"] + k - 1] = False
            words = [words[i] for i in np.flatnonzero(keep)]
        kept = b" ".join(words)
        n_removed.append(n_words[-1] - len(words))
        digest.append(hashlib.sha256(kept).hexdigest())
        kept_text.append(kept.decode() if with_text else None)
    return pa.RecordBatch.from_arrays(
        [doc_ids, pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(digest, pa.string()),
         pa.array(kept_text, pa.string())], [x.split()[0] for x in _KEPT.split(", ")])


def _cut(batches: Iterator[pa.RecordBatch], k: int, with_text: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield _kept(batch.column(0), texts_of(batch.column(1)), batch.column(2).to_pylist(), k, with_text)


def _whole(batches: Iterator[pa.RecordBatch], bits, k: int, with_text: bool) -> Iterator[pa.RecordBatch]:
    """The documents that have no path for sure."""
    for batch in batches:
        rest = pa.RecordBatch.from_arrays(batch.columns, batch.schema.names).filter(pa.array(~_maybe(batch, bits)))
        yield _kept(rest.column(1), texts_of(rest.column(2)), [None] * rest.num_rows, k, with_text)


def _others(batches: Iterator[pa.RecordBatch], bits) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield batch.filter(pa.array(_maybe(batch, bits)))


def _maybe(batch: pa.RecordBatch, bits) -> np.ndarray:
    """By the documents' keys, column 0."""
    return maybe_in(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64), bits.value)


def remove_repeats(docs: DataFrame, k: int = WINDOW, with_text: bool = False, stretch: int = STRETCH) -> DataFrame:
    """A row per document: doc_id, n_words, n_removed, kept_sha256, kept_text (null unless asked for)."""
    doc, text = F.coalesce("doc_id", F.lit(LAST)), F.coalesce("text", F.lit(""))
    keyed = docs.select(F.xxhash64(doc, text).alias("key"), "doc_id", text.alias("text"), doc.alias("doc"))
    paths = materialize(with_source_digests(repeated_paths(keyed, k, stretch=stretch), keyed, k), "paths")
    bits = docs.sparkSession.sparkContext.broadcast(key_filter(paths.select("key").distinct()))
    keyed = keyed.drop("doc")
    whole = keyed.mapInArrow(lambda b: _whole(b, bits, k, with_text), _KEPT)
    found = paths.groupBy("key").agg(F.collect_list(F.struct("at", "windows", "source_windows", "digest")).alias("paths"))
    joined = keyed.mapInArrow(lambda b: _others(b, bits), keyed.schema).join(found, "key", "left").select("doc_id", "text", "paths")
    return whole.unionAll(joined.mapInArrow(lambda b: _cut(b, k, with_text), _KEPT))
