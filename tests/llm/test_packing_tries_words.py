"""Best-fit packing, prefix tries and spelling variants against plain versions."""

import hashlib
import random
import zlib
from collections import Counter

import brute
import numpy as np
import pytest
from llm_cases import SF
from pyspark.sql import functions as F

from tickflow.llm import best_fit, count_min, prefix_trie, queries, spelling
from tickflow.llm.fm_index import FmIndex

# ------------------------------------------------------------------ best-fit packing


def plain_best_fit(sizes, capacity, most):
    """(bin, offset) of each piece, with a list of open bins."""
    free, out, n = {}, [], 0
    for s in sizes:
        fit = [f for f in free.values() if f >= s]
        if fit:
            least = min(fit)
            b = [k for k, f in free.items() if f == least][-1]  # of equal ones the one that came to it last
            f = free.pop(b)
        else:
            b, f, n = n, capacity, n + 1
        out.append((b, capacity - f))
        if f > s:
            free[b] = f - s
            if len(free) > most:
                fullest = min(free.values())
                free.pop([k for k, f in free.items() if f == fullest][-1])
    return out


@pytest.mark.parametrize("capacity,most", [(10, 1), (10, 3), (100, 4), (4096, 256), (7, 1000)])
def test_bins_are_those_of_a_plain_search(capacity, most):
    rng = random.Random(capacity + most)
    sizes = [rng.randint(1, capacity) if rng.random() < 0.7 else rng.randint(1, max(1, capacity // 5)) for _ in range(3000)]
    bins = best_fit.OpenBins(capacity, most)
    got = [bins.place(s) for s in sizes]
    assert got == plain_best_fit(sizes, capacity, most)
    assert bins.count <= most and sum(map(len, bins.bins.values())) == bins.count
    assert {f for f in range(capacity + 1) if bins.spaces >> f & 1} == set(bins.bins)


def test_pieces_of_a_document():
    assert list(best_fit.pieces(1, 4)) == [(0, 1)]
    assert list(best_fit.pieces(8, 4)) == [(0, 4), (4, 4)]
    assert list(best_fit.pieces(9, 4)) == [(0, 4), (4, 4), (8, 1)]


@pytest.mark.parametrize("capacity,open_bins", [(4096, 256), (64, 2)])
def test_packed_documents(docs, rows, capacity, open_bins):
    import public_tokenizers
    from tokenizers import Tokenizer
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    got = best_fit.pack(docs, path, capacity, open_bins).collect()
    by_doc, total = {}, 0
    want = Counter()
    for d, t, _ in rows:
        ids = np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [1], "<u4")
        total += len(ids)
        want.update((d, i, at, n, zlib.crc32(ids[at:at + n].tobytes())) for i, (at, n) in enumerate(best_fit.pieces(len(ids), capacity)))
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    for r in got:
        by_doc.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for placed in by_doc.values():
        end = 0
        for at, n in sorted(placed):
            assert at == end
            end += n
        assert end <= capacity
    if open_bins > 2:  # little over the least number that could hold the tokens
        assert len(by_doc) <= 1.03 * total / capacity + docs.rdd.getNumPartitions()


def test_packing_again_gives_the_same(docs, no_docs):
    import public_tokenizers
    path = public_tokenizers.path("word_bpe_49k.json")
    first, again = (sorted(map(str, best_fit.pack(docs, path).collect())) for _ in range(2))
    assert first == again
    assert best_fit.pack(no_docs, path).count() == 0


# ------------------------------------------------------------------ conversation prefixes

def plain_trie(rows):
    """{(conv_id, depth): (parent, n, children, leaves, saved, ends)} of (conv_id, turn, role, text)."""
    own = {}
    for c, n, r, t in rows:
        if c is not None:
            own.setdefault(c, []).append((n is not None, n or 0, r or "", t or ""))
    own = {c: [x[2:] for x in sorted(v)] for c, v in own.items()}
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = abs(c) // 100 * 100 * (1 if c >= 0 else -1)
        rebuilt[c] = [*own.get(base, [])[:h], *turns[h:]]
    members = {}
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    children = Counter(k[:-1] for k in members if k)
    leaves, saved = Counter(), Counter()
    for k, m in members.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += k not in children
            saved[k[:d]] += (len(m) - 1) * len(k[-1][1]) if k else 0
    out = {}
    for k, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(rebuilt[c]) == len(k))
        out[min(m), len(k)] = (min(members[k[:-1]]) if k else None, len(m), children[k], leaves[k], saved[k], hashlib.sha256(ends.encode()).hexdigest())
    return out


TURNS = [(100, 0, "user", "a"), (100, 1, "assistant", "b"), (100, 1, "assistant", "b"), (100, 2, "user", "c"), (100, None, "system", "s"),
         *[(c, n, r, t) for c in range(101, 160) for n, r, t in [(0, "user", f"q{c % 7}"), (1, "assistant", "b"), (2, "user", None), (3, None, "Ünï")][:c % 5]],
         (200, 0, None, None), (201, 5, "user", ""), (201, 5, "assistant", ""), (201, 5, "user", "x"), (None, 0, "user", "nobody"),
         (-5, 0, "user", "minus"), (-105, 0, "user", "minus"), (-105, 1, "user", "more"), (-100, 0, "user", "base"), (300, 0, "user", "é" * 70_000),
         (303, 0, "user", "é" * 70_000), (10**15, 0, "user", "far"), *[(700, i, "user", f"t{i % 3}") for i in range(60)],
         *[(c, i, "user", f"t{i % 3}") for c in (701, 702, 703) for i in range(60)], (9_000, 3, "user", "only")]


@pytest.fixture(scope="module")
def talks(spark):
    base = spark.read.parquet(f"{SF}/conversations.parquet").limit(0)
    odd = spark.createDataFrame(TURNS, base.schema)
    out = spark.read.parquet(f"{SF}/conversations.parquet").unionByName(odd)
    for c in ("depth", "pos", "one", "_s", "h", "first", "last", "x1"):
        out = out.withColumn(c, F.lit(3))
    return out


def trie_rows(talks):
    turns = prefix_trie.ordered_turns(talks).cache()
    nodes, ends = prefix_trie.prefix_trie(*prefix_trie.with_shared_starts(turns))
    hashes = {(r["depth"], r["x1"], r["x2"]): r["ends_sha256"] for r in prefix_trie.ends_hash(ends).collect()}
    out = {}
    for r in nodes.collect():
        own = str(r["conv_id"]) if r["n_ends"] and r["n_convs"] == 1 else ""
        ended = hashes[r["depth"], r["x1"], r["x2"]] if r["n_ends"] and r["n_convs"] > 1 else hashlib.sha256(own.encode()).hexdigest()
        assert (r["conv_id"], r["depth"]) not in out
        out[r["conv_id"], r["depth"]] = (r["parent_conv_id"], r["n_convs"], r["n_children"], r["n_leaves"], r["saved_tokens"], ended)
    turns.unpersist()
    return out


@pytest.fixture(scope="module")
def plain_nodes(talks):
    return plain_trie([tuple(r) for r in talks.select("conv_id", "turn", "role", "text").collect()])


def test_trie(talks, plain_nodes):
    assert trie_rows(talks) == plain_nodes


def test_trie_with_short_stretches_and_hot_nodes(talks, plain_nodes, monkeypatch):
    """Stretches of two turn numbers, so totals are carried; no node but the root is broadcast to its children."""
    monkeypatch.setattr(prefix_trie, "STRETCH_BITS", 1)
    monkeypatch.setattr(prefix_trie, "HOT_SHARE", 2)
    assert trie_rows(talks) == plain_nodes


def test_trie_with_a_full_sketch(talks, plain_nodes, monkeypatch):
    """A sketch that proves nothing sends every prefix to the exact grouping."""
    monkeypatch.setattr(count_min, "maybe_repeated", lambda bits, x1, x2: np.ones(len(x1), bool))
    nodes, _ = prefix_trie.prefix_trie(*prefix_trie.with_shared_starts(prefix_trie.ordered_turns(talks)))
    assert nodes.count() == len(plain_nodes)
    assert trie_rows(talks) == plain_nodes


def test_tails_are_not_grouped(spark):
    """The sketch proves nearly every prefix of unlike conversations to be alone."""
    rows = spark.range(3000).select(F.col("id"), F.explode(F.sequence(F.lit(1), F.lit(4))).alias("d")).select(
        F.col("id").alias("conv_id"), F.col("d").cast("long").alias("depth"), F.xxhash64("id", "d").alias("x1"), F.xxhash64("d", "id").alias("x2"))
    bits = count_min.repeated(rows, count_min.width_for(12_000))
    table = rows.toArrow()
    maybe = count_min.maybe_repeated(bits, table.column("x1").combine_chunks(), table.column("x2").combine_chunks())
    assert maybe.mean() < 0.1
    twice = rows.filter("conv_id < 100")
    bits = count_min.repeated(rows.unionByName(twice), count_min.width_for(12_000))
    maybe = count_min.maybe_repeated(bits, table.column("x1").combine_chunks(), table.column("x2").combine_chunks())
    assert maybe[np.array(table.column("conv_id")) < 100].all()


def test_members_that_end_are_hashed_in_order(spark, monkeypatch):
    ids = list(range(5_000))
    random.Random(2).shuffle(ids)
    df = spark.createDataFrame([(1, 7, 8, i) for i in ids] + [(1, 7, 9, 5), (1, 7, 9, -5)], "depth long, x1 long, x2 long, conv_id long").repartition(7)
    got = {r["x2"]: r["ends_sha256"] for r in prefix_trie.ends_hash(df).collect()}
    assert got == {8: hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest(), 9: hashlib.sha256(b"-5,5").hexdigest()}


def test_trie_of_nothing(talks):
    assert trie_rows(talks.limit(0)) == {}
    assert trie_rows(talks.filter("conv_id = 9000")) == plain_trie([(9_000, 3, "user", "only")])


# ------------------------------------------------------------------ spelling variants

def plain_words(rows, min_length=7):
    import re
    n = Counter()
    for d, t, _ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate(brute.UPPER)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= min_length:
                n[run] += 1
    return {w: c for w, c in n.items() if c >= 2}


def plain_variants(n):
    """{word: (form, root, n, n_near, form_n)}."""
    less = {}
    for w in n:
        for i in range(len(w)):
            less.setdefault((i, w[:i] + w[i + 1:]), set()).add(w)
    near = {w: set() for w in n}
    for (_, short), ws in less.items():
        for w in ws:
            near[w] |= ws - {w}
            if short in n:
                near[w].add(short)
                near[short].add(w)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-n[x], x), default=None)
        if best is not None and n[best] >= 10 * n[w]:
            form[w] = best
    out = {}
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out[w] = (form.get(w), root, n[w], len(near[w]), n[form[w]] if w in form else None)
    return out


def variant_rows(df):
    got = df.collect()
    out = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in got}
    assert len(out) == len(got)
    return out


def test_word_counts(docs, rows):
    got = {r["word"]: r["n"] for r in spelling.word_counts(docs).collect()}
    assert got == plain_words(rows)


def test_variants_of_documents(docs, rows):
    assert variant_rows(spelling.variant_groups(spelling.word_counts(docs))) == plain_variants(plain_words(rows))


def test_variants_of_nothing(no_docs):
    assert spelling.variant_groups(spelling.word_counts(no_docs)).count() == 0


@pytest.fixture(scope="module")
def crowd():
    """Words over few letters, so that keys are crowded, ties common and forms form chains."""
    rng = random.Random(5)
    words = {"".join(rng.choice("abÿ") for _ in range(rng.randint(7, 9))) for _ in range(1500)}
    out = {w: rng.choice([2, 2, 3, 20, 30, 200, 300, 2000, 30_000]) for w in sorted(words)}
    return out | {"x" * 3000: 5, "x" * 3001: 70, "x" * 1500 + "y" + "x" * 1500: 9_000}


@pytest.mark.parametrize("shard,group", [(spelling.SHARD, spelling.GROUP), (40, 6)])
def test_variants_of_a_crowd(spark, crowd, shard, group):
    """Also with tiny shards and keys cut into blocks."""
    df = spark.createDataFrame(sorted(crowd.items()), "word string, n long")
    want = plain_variants(crowd)
    assert max(len([1 for w in want if want[w][1] == r]) for r in {x[1] for x in want.values()}) > 2
    assert variant_rows(spelling.variant_groups(df, shard=shard, group=group)) == want


def test_long_chains_of_forms(spark):
    links = [(f"w{i:03}", f"w{i + 1:03}") for i in range(40)] + [("z", "w010")]
    got = {r["word"]: r["root"] for r in spelling.roots(spark.createDataFrame(links, "word string, form string")).collect()}
    assert got == {a: "w040" for a, _ in links}


@pytest.mark.parametrize("seed", range(6))
def test_index_against_all_edits(seed):
    rng = random.Random(seed)
    letters = "abÿ"[:rng.choice([1, 2, 3])] + "c"
    words = sorted({"".join(rng.choice(letters) for _ in range(rng.randint(2, 9))) for _ in range(rng.choice([1, 3, 150, 600]))})
    there, index = set(words), FmIndex(words, "z")
    want = set()
    for w in words:
        for i in range(len(w) + 1):
            for c in letters:
                want |= {(w, v) for v in (w[:i] + c + w[i:], w[:i] + c + w[i + 1:]) if v in there and v != w and len(v) >= len(w)}
    found = set()
    for rightward in (True, False):
        exact = [len(w) // 2 if rightward else len(w) - len(w) // 2 for w in words]
        a, b = index.one_more_or_other(words, exact, rightward)
        pairs = [(words[x], index.words[y]) for x, y in zip(a, b)]
        assert len(pairs) == len(set(pairs))
        if rightward:
            assert set(pairs) == {(x, y) for x, y in want if x[:len(x) // 2] == y[:len(x) // 2]}
        found |= set(pairs)
    assert found == want
    a, _ = index.one_more_or_other(["zzzzzzz"], [3], True)
    assert len(a) == 0


@pytest.mark.parametrize("name", ["op12_prefix_trie", "op13_spelling_variants"])
def test_new_oracles(spark, name):
    from oracle_compare import compare
    assert compare(spark, SF, name, queries.QUERIES[name], queries.ORACLE_SQL[name])["status"] == "ok"
