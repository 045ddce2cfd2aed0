"""Language-model scoring: a log-bilinear model with noise-contrastive estimation, in numpy.

Tokens are the lower-cased (A-Z) words of a text and one end.  Documents whose
crc32(doc_id as text) mod 10 is 0 are held out; counts and the model come from
all others, every token of them.

Every word seen at least ``LEAST`` times is an entry with an input and an output vector of
its own; the words below it share hashed entries, one for ``SHARED`` different words, in which a word
has its smoothed share of the counts (0.1 added to each, one more for unknown words).
So the vectors grow with the corpus.  The score of an entry or node w after the entries u and v is
score(w | u, v) = (r_u C_1 + r_v C_2) . q_w + b_w.

Probabilities are normalised in full, level by level and each by context: over the
``CLASSES - 1`` most frequent words and one class of all others; in that class over sections; in
a section over groups of entries of like frequency; in a group over its entries.  So probabilities
of all tokens, unknown included, add up to 1, and a token costs the third root of the entries.

Training is noise-contrastive estimation in two steps.  The class trigrams of all training text are
counted by Spark (CLASSES**3 counts at most); from them come C_1, C_2 and the starting
vectors.  Then all vectors learn from every training token: in ``ROUNDS`` rounds, each over its
share of the documents, the tasks take the model, train it on batches of their own text with noise
samples at each level (for an entry from its group), and send what changed of the rows they
touched; the changes are averaged by touches in Spark. A task has at least ``TOKENS_A_ROW`` tokens for
each row of the model, so the changes sent are a fixed share of the text at most.

Words: the entries go to the tasks with their counts; the words of
a text beyond them are joined to the table of all counts, so every count is exact.

Defined results: null and empty texts are the end alone; a null doc_id is held
out; repeated rows are scored alike; without any training text all
probabilities are 1; an empty table gives an empty result; other columns don't matter.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickflow.session import ship_package

from .common import materialize

CLASSES = 128
LEAST = 16
SHARED = 64
ROUNDS = 2
WIDTH = 16
NOISE = 10
STEPS = 150
BATCH = 4096
DRAWN = 32
DRAWN_INSIDE = 3
BLOCK = 4096
RATE = 0.05
CALM = 1.0
ADDED = 0.1
END = b""
TOKENS_A_ROW = 8
CHUNK = 3_000_000
SLICE = 1 << 19


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 10 == 0


def tokens(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """The number of tokens of each text, and the tokens of all in turn."""
    texts = pc.ascii_trim_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))  # A-Z and the six separators only
    empty = pc.equal(texts, "")
    ended = pc.binary_join_element_wise(texts, pc.if_else(empty, "", " "), "")  # the empty word after the last separator is the end
    found = pc.ascii_split_whitespace(ended)
    return found.value_lengths().to_numpy().astype(np.int64), found.flatten()


def _chunks(texts: pa.Array, most: int = CHUNK) -> Iterator[tuple[int, pa.Array]]:
    """Pieces of at most so many bytes, one text at least, each with its first text's number."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    a = 0
    while a < len(texts):
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + most, "right")))
        yield a, texts.slice(a, b - a)
        a = b


# --- counts -----------------------------------------------------------------

def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, texts in _chunks(batch.column(0), 16_000_000):
            found = tokens(texts)[1].value_counts()
            yield pa.RecordBatch.from_arrays([found.field(0), found.field(1)], ["word", "n"])


def word_counts(training: DataFrame) -> DataFrame:
    """(word, n) of all training tokens; the end is the empty word."""
    part = training.select("text").mapInArrow(_count_words, "word string, n long")
    return materialize(part.groupBy("word").agg(F.sum("n").alias("n")), "word-counts")


@dataclass
class Vocabulary:
    """The words with vectors of their own, by count; the first ``head`` are classes of their own. The other words share the ``buckets``."""
    words: list[bytes]
    counts: np.ndarray
    head: int
    n: int
    different: int
    buckets: np.ndarray = field(default_factory=lambda: np.zeros((1, 2), np.int64))  # of each the tokens and the different words

    @property
    def classes(self) -> int:
        return self.head + 1

    @property
    def entries(self) -> int:
        return len(self.words) + len(self.buckets)

    @property
    def base_norm(self) -> float:
        return float(np.log10(self.n + ADDED * (self.different + 1)))

    @property
    def rest_norm(self) -> float:
        rest = self.n - int(self.counts[:self.head].sum())
        return float(np.log10(rest + ADDED * (self.different - self.head + 1)))

    @property
    def bucket_norms(self) -> np.ndarray:
        return np.log10(self.buckets[:, 0] + ADDED * (self.buckets[:, 1] + 1))

    def ranks(self) -> Ranks:
        return Ranks(self.words, len(self.buckets))


def vocabulary(counts: DataFrame, classes: int = CLASSES, least: int = LEAST, lookup: int | None = None) -> Vocabulary:
    """All words seen ``least`` times or more (the ``lookup`` most frequent of them, if given)."""
    n, different = counts.agg(F.sum("n"), F.count(F.lit(1))).first()
    top = counts.filter(F.col("n") >= least).orderBy(F.col("n").desc(), "word")
    top = (top if lookup is None else top.limit(lookup)).toArrow()
    words, c = top["word"].to_pylist(), top["n"].to_numpy()
    rest = counts
    if words:
        rest = counts.filter((F.col("n") < int(c[-1])) | (F.col("n") == int(c[-1])) & (F.col("word") > words[-1]))
    buckets = np.zeros((1 + (different - len(words)) // SHARED, 2), np.int64)
    at = F.crc32(F.col("word").cast("binary")) % len(buckets)
    found = rest.groupBy(at.alias("at")).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("words")).toArrow()  # a row per bucket
    buckets[found["at"].to_numpy()] = np.stack([found["n"].to_numpy(), found["words"].to_numpy()], axis=1)
    return Vocabulary([w.encode() for w in words], c, min(classes - 1, len(words)), n or 0, different, buckets)


class Ranks:
    """The entries of words: a word's rank, or the bucket of its hash after all ranks."""

    def __init__(self, words: list[bytes], buckets: int):
        self.names = pa.array(words, pa.binary()).cast(pa.string())
        self.words, self.buckets = len(words), buckets
        self.end = int(self.of(pa.array([END.decode()]))[0])

    def of(self, words: pa.Array) -> np.ndarray:
        rank = pc.index_in(words, value_set=self.names.cast(words.type))
        out = rank.fill_null(self.words).to_numpy(zero_copy_only=False).astype(np.int64)
        if rank.null_count:
            rest = words.filter(rank.is_null()).dictionary_encode()
            bucket = np.fromiter((zlib.crc32(w) % self.buckets for w in rest.dictionary.cast(pa.binary()).to_pylist()), np.int64)
            out[out == self.words] += bucket[rest.indices.to_numpy()]
        return out


def _contexts(rank: np.ndarray, counts: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each token the two before it; before a text stands the end."""
    start = np.cumsum(counts) - counts
    one, two = np.empty_like(rank), np.empty_like(rank)
    one[1:], two[2:] = rank[:-1], rank[:-2]
    one[start], two[start] = end, end
    two[np.minimum(start + 1, len(rank) - 1)[counts > 1]] = end
    return one, two


def _ranked(texts: pa.Array, ranks: Ranks, most: int = CHUNK) -> Iterator[tuple[int, pa.Array, np.ndarray, np.ndarray]]:
    """Per chunk: the first text's number, the tokens of all its texts, the number of each text and the entries of all."""
    for a, chunk in _chunks(texts, most):
        counts, found = tokens(chunk)
        yield a, found, counts, ranks.of(found)


def _count_trigrams(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    vocab: Vocabulary = shared.value
    ranks, k = Ranks(vocab.words[:vocab.head], 1), vocab.classes
    total = np.zeros(k ** 3, np.int64)
    for batch in batches:
        for _, _, counts, own in _ranked(batch.column(0), ranks, 8_000_000):
            one, two = _contexts(own, counts, ranks.end)
            total += np.bincount((two * k + one) * k + own, minlength=k ** 3)
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["code", "n"])


# --- the model --------------------------------------------------------------

@dataclass
class LogBilinear:
    r: np.ndarray
    c1: np.ndarray
    c2: np.ndarray
    q: np.ndarray
    b: np.ndarray

    def scores(self, two: np.ndarray, one: np.ndarray) -> np.ndarray:
        return (self.r[two] @ self.c2 + self.r[one] @ self.c1) @ self.q.T + self.b

    def log10(self, two: np.ndarray, one: np.ndarray) -> np.ndarray:
        """Normalised log10 probabilities of all classes after each context."""
        s = self.scores(two, one)
        s -= s.max(axis=1, keepdims=True)
        s -= np.log(np.exp(s).sum(axis=1, keepdims=True))
        return s * np.float32(1 / np.log(10))


def train(code: np.ndarray, n: np.ndarray, k: int, width: int = WIDTH, noise: int = NOISE, steps: int = STEPS) -> LogBilinear:
    """Noise-contrastive estimation over counted trigrams (code: two, one, own in base k), by Adam with the full gradient."""
    rng = np.random.default_rng(7)
    model = LogBilinear(*(rng.normal(0, 0.1, s).astype(np.float32) for s in ((k, width), (width, width), (width, width), (k, width))),
                        np.zeros(k, np.float32))
    model.c1 += np.eye(width, dtype=np.float32)
    model.c2 += np.eye(width, dtype=np.float32)
    if not len(code):
        return model
    own = code % k
    context, row = np.unique(code // k, return_inverse=True)
    two, one = context // k, context % k
    data = np.zeros((len(context), k), np.float32)
    data[row, own] = n / n.sum()
    p = np.bincount(own, n, k) + 1.0
    p = (p / p.sum()).astype(np.float32)
    model.b[:] = np.log(p)
    asked = np.log(noise * p)
    negative = noise * data.sum(axis=1, keepdims=True) * p
    names = ("r", "c1", "c2", "q", "b")
    first, second = ({x: np.zeros_like(getattr(model, x)) for x in names} for _ in range(2))
    for step in range(1, steps + 1):
        r1, r2 = model.r[one], model.r[two]
        h = r1 @ model.c1 + r2 @ model.c2
        true = 1 / (1 + np.exp(asked - (h @ model.q.T + model.b)))  # the chance that a sample is data
        g = data * (1 - true) - negative * true
        gh = g @ model.q
        gr = np.zeros_like(model.r)
        np.add.at(gr, one, gh @ model.c1.T)
        np.add.at(gr, two, gh @ model.c2.T)
        for x, d in zip(names, (gr, r1.T @ gh, r2.T @ gh, g.T @ h, g.sum(axis=0)), strict=True):
            first[x] = 0.9 * first[x] + 0.1 * d
            second[x] = 0.99 * second[x] + 0.01 * d * d
            rate = 0.05 * (1 - step / (steps + 1))
            setattr(model, x, (getattr(model, x) + rate * (first[x] / (1 - 0.9 ** step))
                               / (np.sqrt(second[x] / (1 - 0.99 ** step)) + 1e-9)).astype(np.float32))
    return model


# --- all entries ------------------------------------------------------------

def _dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->i", a, b)


def _rows(vectors: np.ndarray, row: np.ndarray) -> np.ndarray:
    return np.take(vectors, row, axis=0, mode="clip")  # much faster than vectors[row]; no row is out of bounds


def _sums(vectors: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The sum of each run of vectors, by the runs' first rows."""
    size = np.diff(np.append(at, len(vectors)))
    out = _rows(vectors, at)
    several = np.flatnonzero(size > 1)
    if len(several):
        own = size[several]
        rest = _rows(vectors, np.flatnonzero(np.repeat(size > 1, size)))
        out[several] = np.add.reduceat(rest.view(np.complex64), np.cumsum(own) - own).view(np.float32)  # a pair of floats at once
    return out


def _order(key: np.ndarray) -> np.ndarray:
    """A stable order by ``key``, by a sort of numbers."""
    bits = max(1, int(len(key) - 1).bit_length())
    return np.sort((key.astype(np.int64) << bits) | np.arange(len(key))) & ((1 << bits) - 1)


@dataclass
class WordModel:
    """Vectors of all entries. Rows of ``p``: inputs of the entries, outputs of the classes, the sections, the groups and the entries; ``bias`` of each."""
    p: np.ndarray
    bias: np.ndarray
    c1: np.ndarray
    c2: np.ndarray
    head: int
    bounds: np.ndarray     # the first entry of each group, and the end
    sections: np.ndarray   # the first group of each section, and the end
    class_p: np.ndarray    # noise
    section_p: np.ndarray

    @property
    def entries(self) -> int:
        return int(self.bounds[-1])

    @property
    def first_class(self) -> int:
        return self.entries

    @property
    def first_section(self) -> int:
        return self.entries + self.head + 1

    @property
    def first_group(self) -> int:
        return self.first_section + len(self.sections) - 1

    @property
    def first_entry(self) -> int:
        return self.first_group + len(self.bounds) - 1

    def hidden(self, two: np.ndarray, one: np.ndarray) -> np.ndarray:
        h = _rows(self.p, two) @ self.c2
        h += _rows(self.p, one) @ self.c1
        return h

    def groups(self, entry: np.ndarray) -> np.ndarray:
        """Of entries beyond the head."""
        return np.take(np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds)), entry - self.head)

    def _score(self, h: np.ndarray, row: np.ndarray) -> np.ndarray:
        return _dots(h, _rows(self.p, row)) + np.take(self.bias, row)

    def _log_sums(self, h: np.ndarray, first: int, end: int, longest: float) -> np.ndarray:
        """Of each context (of at most that squared length) the log of the sum of exp(score) over the nodes first..end."""
        q, b = np.ascontiguousarray(self.p[first:end].T), self.bias[first:end]
        most = float(np.sqrt(longest * (q * q).sum(axis=0).max()))  # no score without bias is larger
        out = np.empty(len(h), np.float32)
        size, share = max(1, (1 << 17) // (end - first)), np.exp(b)
        for a in range(0, len(h), size):
            s = h[a:a + size] @ q
            if most < 60:
                out[a:a + size] = np.log(np.exp(s, out=s) @ share)
            else:
                s += b
                top = s.max(axis=1)
                s -= top[:, None]
                out[a:a + size] = top + np.log(np.exp(s, out=s).sum(axis=1))
        return out

    def _inside(self, h: np.ndarray, own: np.ndarray, parent: np.ndarray, bounds: np.ndarray, first: int, longest: float) -> np.ndarray:
        """Log probability of each node ``own`` among the children of its parent; rows are sorted by parent."""
        out = self._score(h, first + own)
        at = np.searchsorted(parent, np.arange(len(bounds)))
        for g in np.flatnonzero(np.diff(at)):
            x = slice(at[g], at[g + 1])
            out[x] -= self._log_sums(h[x], first + bounds[g], first + bounds[g + 1], longest)
        return out

    def log10(self, two: np.ndarray, one: np.ndarray, entry: np.ndarray) -> np.ndarray:
        """Normalised log10 probability of each entry after its context."""
        return np.concatenate([self._log10(two[a:a + SLICE], one[a:a + SLICE], entry[a:a + SLICE]) for a in range(0, len(entry), SLICE)] or [np.empty(0)])

    def _log10(self, two: np.ndarray, one: np.ndarray, entry: np.ndarray) -> np.ndarray:
        h = self.hidden(two, one)
        longest = float(_dots(h, h).max())
        out = (self._score(h, self.first_class + np.minimum(entry, self.head))
               - self._log_sums(h, self.first_class, self.first_section, longest)).astype(np.float64)
        rest = np.flatnonzero(entry >= self.head)
        if len(rest):
            group = self.groups(entry[rest])
            order = _order(group)
            rest, group = rest[order], group[order]
            section = np.searchsorted(self.sections, group, "right") - 1
            h = _rows(h, rest)
            out[rest] += (self._score(h, self.first_section + section) - self._log_sums(h, self.first_section, self.first_group, longest)
                          + self._inside(h, group, section, self.sections, self.first_group, longest)
                          + self._inside(h, entry[rest], group, self.bounds, self.first_entry, longest))
        return out / np.log(10)


def grouped(counts: np.ndarray, head: int) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of the groups of the entries from ``head`` on, so that all have like sums of root counts, and bounds of the sections of the groups."""
    root = np.cumsum(np.sqrt(counts[head:] + 1.0))
    n = int(np.ceil(len(root) ** (1 / 3) * 0.75))
    first = np.searchsorted(root, root[-1] * np.arange(n * n) / (n * n), "right")
    bounds = head + np.unique(np.append(first, len(root)))
    return bounds, np.unique((len(bounds) - 1) * np.arange(n + 1) // n)


def word_model(vocab: Vocabulary, classes: LogBilinear) -> WordModel:
    """The model before it learns more than classes: entries beyond the head are used as their class, and by their counts in it."""
    counts = np.concatenate([vocab.counts, vocab.buckets[:, 0]])
    head, n, width = vocab.head, vocab.entries, classes.r.shape[1]
    bounds, sections = grouped(counts, head)
    smooth = counts + ADDED
    group_n = np.add.reduceat(smooth, bounds[:-1])
    section_n = np.add.reduceat(group_n, sections[:-1])
    class_p = np.append(smooth[:head], smooth[head:].sum())
    section, group = n + head + 1, n + head + len(sections)
    entry = group + len(bounds) - 1
    p, bias = np.zeros((entry + n, width), np.float32), np.zeros(entry + n, np.float32)
    p[:n] = classes.r[np.minimum(np.arange(n), head)]
    p[n:section], bias[n:section] = classes.q, classes.b
    bias[section:group] = np.log(section_n / section_n.sum())
    bias[group:entry] = np.log(group_n / np.repeat(section_n, np.diff(sections)))
    bias[entry + head:] = np.log(smooth[head:] / np.repeat(group_n, np.diff(bounds)))
    return WordModel(p, bias, classes.c1, classes.c2, head, bounds, sections, class_p / class_p.sum(), section_n / section_n.sum())


def learn(m: WordModel, two: np.ndarray, one: np.ndarray, entry: np.ndarray, squares: np.ndarray, touches: np.ndarray, rng, rate: float = RATE) -> None:
    """A step of noise-contrastive estimation over a batch of tokens, by Adagrad for each row of ``m.p``; the biases stay at the counts."""
    beyond = entry >= m.head
    order = np.concatenate([np.flatnonzero(beyond), np.flatnonzero(~beyond)])  # so that slices do for the tokens beyond the head
    two, one, entry, rest = two[order], one[order], entry[order], slice(0, np.count_nonzero(beyond))
    p, h, n = m.p, m.hidden(two, one), len(entry)
    rows, sources, factors = [], [], []  # the gradient of a row is the sum of its factors times the vectors of their sources
    vectors = [h]

    def add(row: np.ndarray, source: np.ndarray, factor: np.ndarray) -> None:
        rows.append(row)
        sources.append(source)
        factors.append(factor)

    def add_vectors(row: np.ndarray, more: np.ndarray) -> None:
        start = sum(map(len, vectors))
        vectors.append(more)
        add(row, np.arange(start, start + len(more)), np.ones(len(more), np.float32))

    def level(first: int, noise_p: np.ndarray, own: np.ndarray, h: np.ndarray, source: np.ndarray) -> np.ndarray:
        drawn = rng.choice(len(noise_p), DRAWN, p=noise_p)
        asked = np.log(NOISE * noise_p).astype(np.float32)
        mine, noise = _rows(p, first + own), p[first + drawn]
        true = 1 / (1 + np.exp(_dots(h, mine) + np.take(m.bias, first + own) - np.take(asked, own)))
        false = h @ noise.T
        np.subtract(asked[drawn] - m.bias[first + drawn], false, out=false)
        np.exp(false, out=false)
        false += 1
        np.divide(np.float32(NOISE / DRAWN), false, out=false)
        add(first + own, source, true)
        add_vectors(first + drawn, -false.T @ h)
        return true[:, None] * mine - false @ noise

    def inside(first: int, bounds: np.ndarray, parent: np.ndarray, own: np.ndarray, h: np.ndarray, source: np.ndarray) -> np.ndarray:
        # inside a parent the noise is uniform: its children are about as frequent
        start, size = bounds[parent], bounds[parent + 1] - bounds[parent]
        asked = np.log(DRAWN_INSIDE / size).astype(np.float32)
        drawn = start + (rng.random((DRAWN_INSIDE, len(own)), np.float32) * size.astype(np.float32)).astype(np.int64)
        x = first + np.concatenate([own[None], np.minimum(drawn, start + size - 1)])
        v = _rows(p, x)
        g = -1 / (1 + np.exp(asked - np.einsum("jik,ik->ji", v, h) - np.take(m.bias, x)))
        g[0] += 1
        add(x.ravel(), np.tile(source, len(x)), g.ravel())
        return np.einsum("ji,jik->ik", g, v)

    gh = level(m.first_class, m.class_p, np.minimum(entry, m.head), h, np.arange(n))
    if rest.stop:
        own, inner, which = entry[rest], h[rest], np.arange(rest.stop)
        group = np.searchsorted(m.bounds, own, "right") - 1
        section = np.searchsorted(m.sections, group, "right") - 1
        gh[rest] += (level(m.first_section, m.section_p, section, inner, which)
                     + inside(m.first_group, m.sections, section, group, inner, which)
                     + inside(m.first_entry, m.bounds, group, own, inner, which))
    for row, c in ((one, m.c1), (two, m.c2)):
        add_vectors(row, gh @ c.T)
    row = np.concatenate(rows)
    order = _order(row)
    row = row[order]
    grad = _rows(np.concatenate(vectors), np.concatenate(sources)[order])
    grad *= np.concatenate(factors)[order, None]
    at = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
    grad, row = _sums(grad, at), row[at]
    squares[row] += _dots(grad, grad) / grad.shape[1]
    touches[row] += np.diff(np.append(at, len(order)))
    grad *= (rate / np.sqrt(squares[row] + CALM))[:, None]
    grad += _rows(p, row)
    whole = f"V{p.strides[0]}"
    p.view(whole)[row] = grad.view(whole)  # a row at once


_CHANGES = "block int, rows binary, touches binary, changes binary"


def _block(block: int, rows: np.ndarray, touches: np.ndarray, changes: np.ndarray) -> pa.RecordBatch:
    """Changes go as half floats, three digits of a step."""
    return pa.RecordBatch.from_arrays(
        [pa.array([block], pa.int32()), *(pa.array([x.tobytes()], pa.binary()) for x in (
            rows.astype(np.int32), touches.astype(np.float32), changes.astype(np.float16)))], ["block", "rows", "touches", "changes"])


def _learn(batches: Iterator[pa.RecordBatch], shared, seed: int) -> Iterator[pa.RecordBatch]:
    """What a task's text changes, by blocks of rows: touches and changes. Biases never change."""
    vocab, before = shared.value
    ranks = vocab.ranks()
    m = replace(before, p=before.p.copy())
    squares, touches = np.zeros(len(m.p), np.float32), np.zeros(len(m.p), np.float32)
    rng = np.random.default_rng((seed, TaskContext.get().partitionId()))
    for batch in batches:
        for _, _, counts, entry in _ranked(batch.column(0), ranks):
            one, two = _contexts(entry, counts, ranks.end)
            for a in range(0, len(entry), BATCH):
                x = slice(a, a + BATCH)
                learn(m, two[x], one[x], entry[x], squares, touches, rng)
    for block in range(0, -(-len(m.p) // BLOCK)):
        rows = block * BLOCK + np.flatnonzero(touches[block * BLOCK:(block + 1) * BLOCK])
        if len(rows):
            yield _block(block, rows, touches[rows], m.p[rows] - before.p[rows])


def _averaged(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by block: one row per block, with the changes averaged by touches."""
    def out():
        at = np.flatnonzero(touches)
        return _block(block, block * BLOCK + at, touches[at], total[at] / touches[at, None])

    block = None
    for batch in batches:
        for b, rows, t, changes in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if b != block:
                if block is not None:
                    yield out()
                block, total, touches = b, np.zeros((BLOCK, width), np.float32), np.zeros(BLOCK, np.float32)
            at, t = np.frombuffer(rows, np.int32) - b * BLOCK, np.frombuffer(t, np.float32)
            total[at] += np.frombuffer(changes, np.float16).reshape(-1, width) * t[:, None]
            touches[at] += t
    if block is not None:
        yield out()


def train_words(training: DataFrame, vocab: Vocabulary, m: WordModel, rounds: int = ROUNDS) -> WordModel:
    """Training of all vectors over the partitions of the text; each document is in one round."""
    sc, width = training.sparkSession.sparkContext, m.p.shape[1]
    learners = max(1, vocab.n // (rounds * TOKENS_A_ROW * len(m.p)))
    for i in range(rounds):
        shared = sc.broadcast((vocab, m))
        mine = training.filter(F.pmod(F.xxhash64("doc_id"), F.lit(rounds)) == i).select("text").coalesce(learners)
        changes = (mine.mapInArrow(lambda b, shared=shared, i=i: _learn(b, shared, i), _CHANGES)
                   .repartition("block").sortWithinPartitions("block").mapInArrow(lambda b: _averaged(b, width), _CHANGES)).toArrow()
        p = m.p.copy()
        for rows, x in zip(changes["rows"].to_pylist(), changes["changes"].to_pylist(), strict=True):
            p[np.frombuffer(rows, np.int32)] += np.frombuffer(x, np.float16).reshape(-1, width)
        m = replace(m, p=p)
        shared.unpersist()
    return m


# --- scoring ----------------------------------------------------------------

_PARTS = "row long, doc_id long, held_out boolean, n_tokens long, known long, base double, score double, rare array<string>"


def _score(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    vocab, model = shared.value
    ranks, words = vocab.ranks(), len(vocab.words)
    logs = np.append(np.log10(vocab.counts + ADDED), np.zeros(len(vocab.buckets)))  # of words in buckets: added by the join
    shares = np.append(np.zeros(words), vocab.bucket_norms)
    row = TaskContext.get().partitionId() << 40
    for batch in batches:
        for a, found, counts, entry in _ranked(batch.column(1), ranks):
            start = np.cumsum(counts) - counts
            one, two = _contexts(entry, counts, ranks.end)
            base = np.add.reduceat(np.take(logs, entry), start) - counts * vocab.base_norm
            score = np.add.reduceat(model.log10(two, one, entry) - np.take(shares, entry), start)
            known = np.add.reduceat((entry < words).astype(np.int64), start)
            ends = np.append(0, np.cumsum(counts - known)).astype(np.int32)
            rare = pa.ListArray.from_arrays(ends, found.filter(pa.array(entry >= words)).cast(pa.string()))
            size = len(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(row, row + size)), batch.column(0).slice(a, size), batch.column(2).slice(a, size),
                 pa.array(counts), pa.array(known), pa.array(base), pa.array(score), rare],
                [x.split()[0] for x in _PARTS.split(", ")])
            row += size


def score_documents(docs: DataFrame, classes: int = CLASSES, lookup: int | None = None) -> DataFrame:
    """A row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    ship_package(spark)
    rows = docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out"))
    training = rows.filter(~F.col("held_out"))
    counts = word_counts(training)
    vocab = vocabulary(counts, classes, lookup=lookup)
    small = spark.sparkContext.broadcast(Vocabulary(vocab.words[:vocab.head], vocab.counts[:vocab.head], vocab.head, vocab.n, vocab.different))
    trigrams = (training.select("text").mapInArrow(lambda b: _count_trigrams(b, small), "code int, n long")
                .groupBy("code").agg(F.sum("n").alias("n")).orderBy("code").toArrow())  # classes**3 rows at most
    start = train(trigrams["code"].to_numpy().astype(np.int64), trigrams["n"].to_numpy(), vocab.classes)
    model = train_words(training, vocab, word_model(vocab, start))
    shared = spark.sparkContext.broadcast((vocab, model))
    parts = materialize(rows.mapInArrow(lambda b: _score(b, shared), _PARTS), "score-parts")
    rare = parts.select("row", F.explode("rare").alias("word")).join(counts, "word", "left")
    added = rare.groupBy("row").agg(F.sum(F.log10(F.coalesce("n", F.lit(0)) + F.lit(ADDED))).alias("more"),
                                    F.count("n").alias("more_known"))
    more = F.coalesce("more", F.lit(0.0))
    return parts.drop("rare").join(added, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(vocab.n).cast("long").alias("train_tokens"), (F.col("base") + more).alias("base_score"),
        (F.col("score") + more).alias("score"))
