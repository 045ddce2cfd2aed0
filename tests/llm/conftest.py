import pytest

from llm_cases import LONG, SF


@pytest.fixture(scope="session")
def docs(spark, tmp_path_factory):
    """The smallest documents and odd ones: nulls in every column, empty and very long texts, ties and
    repeated rows, and extra columns whose names the operators use themselves."""
    from pyspark.sql import functions as F

    base = spark.read.parquet(f"{SF}/documents.parquet")
    near = " ".join(f"t{i}" for i in range(60))
    odd = [
        (1000, None, "en", "srcA"), (1001, "", "en", "srcA"), (1002, " \n\t ", None, None), (1003, "one", "en", "srcB"),
        (1004, "One", "en", "srcB"), (1004, "One", "en", "srcB"), (None, "one two three four five six", "en", ""),
        (None, None, None, None), (None, "one two three four five six", "fr", None), (1005, LONG, "en", "srcA"), (1006, LONG, "de", "srcC"),
        (1007, "Ünï çode\u2003ÄÖ " * 30, "de", "srcC"), (1008, near, "en", "srcD"), (1009, near + " more", "en", "srcD"),
        (1010, "zz " + near, "en", "srcD"), (1008, near.replace("t30", "u30"), "en", "srcD"), (1011, "same " * 400, "en", "srcE"),
        (1012, "same " * 500, "en", "srcE"), (1013, "1.2.3.4, 5.6.7.888 a@b.c x@y.z_w@v.u +1 (555) 010-9999 4111 1111 1111 1111", "en", "srcE"),
        (1014, "a b\x1cc\x85d\u3000e <|endoftext|> x's", "en", "srcF"),
    ]
    extra = spark.createDataFrame([(d, t, la, s, None if t is None else len(t)) for d, t, la, s in odd], base.schema)
    clash = ["key", "word", "n", "node", "label", "r", "size", "position", "maybe", "rank"]
    out = base.unionByName(extra)
    for c in clash:
        out = out.withColumn(c, F.lit(7))
    path = str(tmp_path_factory.mktemp("docs") / "documents.parquet")
    out.write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def rows(docs):
    """(doc_id, text, source) in Python."""
    return [(r["doc_id"], r["text"], r["source"]) for r in docs.collect()]


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.limit(0)
