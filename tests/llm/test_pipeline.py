"""The pipeline against plain versions of its stages."""

from collections import Counter

import brute
import pytest
from llm_cases import SF, on_disk
from pyspark.sql import functions as F

import corpus_pipeline
from tickflow.llm import quality
from tickflow.llm.common import materialize, table


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = table(spark, SF, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, SF), "test-stage")
        out.append((name, docs))
    return out


def ids(df):
    return Counter(r["doc_id"] for r in df.select("doc_id").collect())


def test_stages_keep_what_they_must(spark, stages):
    docs = table(spark, SF, "documents")
    named = dict(stages)
    assert all(df.columns == docs.columns for _, df in stages[:-1])
    rows = [(r["doc_id"], r["text"], r["source"]) for r in docs.collect()]
    v = quality.verdict(F.col("text"), quality.log_ratios(docs, table(spark, SF, "labels")))
    kept = {r["doc_id"] for r in docs.select("doc_id", v["kept"].alias("k")).filter("k").collect()}
    rows = [r for r in rows if r[0] in kept]
    assert ids(named["quality rules"]) == Counter(r[0] for r in rows)
    rows = [r for r in rows if r[0] in {d for (_, d) in brute.exact_groups(rows)[1]}]
    assert ids(named["exact dedup"]) == Counter(r[0] for r in rows)
    rows = [r for r, (d, _, c) in zip(rows, brute.components(rows)) if d == c]
    assert ids(named["n-gram join"]) == Counter(r[0] for r in rows)
    size, target = brute.mix_targets(rows)
    taken = Counter()
    for r in named["mixing"].select("source", "text").collect():
        taken[r["source"]] += len(brute.words(r["text"]))
    assert all(abs(taken[s] - target[s]) <= 1 for s in size)


def test_near_copies_of_a_stage_leave_little_on_disk(spark):
    """Stage 3 on texts that all have near copies: what stays is the shuffle of the rows themselves."""
    rows = []
    for family in range(40):
        for copy in range(24):
            words = [f"g{family * i * i % 99991}c{copy}" if i % 100 == copy else f"g{family * i * i % 99991}_{i}" for i in range(300)]
            rows.append((1000 * family + copy, " ".join(words), "en", "src0", 0))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(4)
    before = on_disk(spark)
    got = corpus_pipeline.near_copies(spark, docs, SF).collect()
    grown = on_disk(spark) - before
    assert sorted(r["doc_id"] for r in got) == [1000 * family for family in range(40)]
    assert grown < 1.25 * sum(len(r[1]) for r in rows), grown / sum(len(r[1]) for r in rows)


def test_run_gives_the_last_stage(spark, stages):
    from tickflow.llm import queries
    got = corpus_pipeline.run(spark, SF)
    last = dict(stages)["packing"]
    assert Counter(map(tuple, got.select("doc_id", "start", "ids_crc32").collect())) == Counter(map(tuple, last.select("doc_id", "start", "ids_crc32").collect()))
    assert len(queries.QUERIES) == 13
