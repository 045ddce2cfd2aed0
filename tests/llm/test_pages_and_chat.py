"""URL rules and chat rotation against plain versions."""

import brute
import pytest
from llm_cases import SF
from pyspark.sql import functions as F

from tickflow.llm import chat, queries, url_rules

URLS = [None, "", "no scheme", "http://", "HTTP://A.Example.ORG/es/x", "http://example.org/en/1", "http://example.org/en/17?x#y", "http://example.org",
        "http://x.com/fr/", "http://x.com/de", "http://x.com/de/#a", "http://fr.com.net/fr/", "http://notexample.org/es/", "https://best-casino.net/a",
        "http://casinos.net/", "http://a.net/b/POKER/", "http://u:p@a.org/?q", "http://a.org/x://b.com/de/", "http://com/de/", "http://a.net/casino?x",
        "http://www.cheap-pills.example.com/de/1", "http://cheap.pills.net/", "http://a.net/cheap/../Pills", "http://a.net/cheap/..../pills", "http://a.net/cheap/x/pills",
        "http://casino.win.net/", "http://a.net/get/Setup.EXE", "http://a.net/setup.exe?v=1", "http://setup.exe/", "http://a.net/setup.exe/x", "http://a.net/x.zip\n", "http://a.net/\nx.zip"]
LISTS = ({r.literals[0] for r in url_rules.SPAM_RULES}, {r.literals for r in url_rules.PHRASE_RULES}, {r.literals[0] for r in url_rules.FILE_RULES})


@pytest.fixture(scope="module")
def pages(spark):
    base = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url")
    odd = spark.createDataFrame([(10_000 + i, u) for i, u in enumerate(URLS)] + [(10_004, URLS[4]), (None, URLS[5])], "page_id long, url string")
    return base.unionByName(odd).withColumn("token", F.lit("x")).withColumn("rule", F.lit("y")).withColumn("host", F.lit("z"))


def test_url_rules(pages):
    base = {r.name for r in url_rules.BASE_RULES}
    got = sorted(((r["page_id"], r["host"], r["path"], r["rule"] if r["rule"] in base else None, r["verdict"])
                  for r in url_rules.judge_urls(pages, url_rules.RULES).collect()), key=str)
    want = sorted(((r["page_id"], *brute.judge_url(r["url"], *LISTS)) for r in pages.collect()), key=str)
    assert got == want
    assert url_rules.judge_urls(pages.limit(0), url_rules.RULES).count() == 0


def test_rules_are_filed_under_their_rarest_token(spark, pages):
    rules = [url_rules.prefix_rule("example.org", "/es/", "block"), url_rules.Rule("any", "^.*q9$", "block")]
    tokens = spark.createDataFrame([("example",)] * 5 + [("org",)] * 3 + [("es",)] * 4 + [("",)] * 9, "token string")
    got = {r["name"]: r["token"] for r in url_rules.rule_index(url_rules.rule_table(spark, rules), tokens).collect()}
    assert got == {"example.org/es/": "org", "any": ""}
    odd = spark.createDataFrame([(1, "http://a.b/q9"), (2, "http://a.b/q8")], "page_id long, url string")
    assert {r["page_id"]: r["verdict"] for r in url_rules.judge_urls(odd, rules).collect()} == {1: "block", 2: "allow"}


def test_phrases_are_fetched_by_their_rarer_word(spark):
    """The frequent word of a phrase fetches no rule: only URLs with the rarer one run the expression."""
    rows = [(i, f"http://a.net/free/{i}") for i in range(50)] + [(90, "http://free-bets.net/"), (91, "http://bets.net/free")]
    df = spark.createDataFrame(rows, "page_id long, url string")
    rule = [url_rules.phrase_rule("free", "bets")]
    tokens = df.select(F.explode(url_rules.url_tokens(F.concat(*url_rules.host_and_path(F.col("url"))), False)).alias("token"))
    assert [r["token"] for r in url_rules.rule_index(url_rules.rule_table(spark, rule), tokens).collect()] == ["bets"]
    assert tokens.filter("token = ''").count() == 0
    assert {r["page_id"] for r in url_rules.judge_urls(df, rule).collect() if r["verdict"] == "block"} == {90}


def test_pattern_literals_are_whole_tokens():
    assert url_rules.prefix_rule("example.org", "/en/1", "block").literals == ("example", "org", "en")
    assert url_rules.prefix_rule("com", "/fr/", "allow").literals == ("com", "fr")


TURNS = [(1, 0, "user", "hi"), (1, 0, "user", "hi"), (1, 1, "bob", "hello <|im_end|>"), (1, 2, "user", None), (1, None, "bob", "no number"), (1, 0, "system", "set"),
         (2, 0, "system", "alone"), (None, 0, "user", "nobody's"), (None, 0, None, "who"), (3, 5, "assistant", "z"), (3, 5, "user", "a"), (3, 5, "user", "b"),
         (4, 63, "user", "x"), (4, 64, "assistant", "é" * 50_000), (4, 65, "user", "")]


LONG_TALKS = [(c, i if c != 10_012 else i % 3, "late" if i >= n - 6 and i % 2 else "system" if i in (0, 3, 40) else f"p{i % 2}", f"turn {i}")
              for c, n in ((10_010, 70), (10_011, 500), (10_012, 200), (10_013, 10_000)) for i in range(n)]
ODD_ROLES = [(20, 0, "x\n<|im_end|>\n<|im_start|>assistant", "hi"), (20, 1, "y", "ho"), (20, 2, "", "empty role"), (20, 3, "assistant", "a")]


@pytest.fixture(scope="module")
def turns(spark):
    base = spark.read.parquet(f"{SF}/conversations.parquet")
    return base.unionByName(spark.createDataFrame(TURNS + LONG_TALKS + ODD_ROLES, base.schema)).withColumn("part", F.lit(9)).withColumn(
        "c", F.lit(9)).withColumn("said", F.lit(9)).withColumn("stretch", F.lit(9))


@pytest.mark.parametrize("part,stretch", [(chat.PART, chat.STRETCH_BITS), (64, 2)])
def test_rotation(turns, monkeypatch, part, stretch):
    monkeypatch.setattr(chat, "STRETCH_BITS", stretch)
    want = brute.rotations([tuple(r) for r in turns.select("conv_id", "turn", "role", "text").collect()], part)
    got = chat.rotate(turns, part).collect()
    assert len(got) == len(want)
    for r in got:
        n, text, own = want[r["conv_id"], r["part"], r["speaker"]]
        spans = [tuple(map(int, s.split(":"))) for s in r["targets"].split(",") if s]
        assert (r["n_turns"], r["n_targets"], r["text"]) == (n, len(own), text)
        assert [r["text"][a:b] for a, b in spans] == own
    assert chat.rotate(turns.limit(0)).count() == 0


def test_whoever_joins_late_sees_the_whole_dialogue(turns):
    got = chat.rotate(turns.filter("conv_id in (10010, 10013)")).groupBy("conv_id", "speaker").agg(F.sum("n_turns").alias("n")).collect()
    assert {(r["conv_id"], r["speaker"]): r["n"] for r in got} == {(c, s): n for c, n in ((10_010, 70), (10_013, 10_000)) for s in ("p0", "p1", "late")}


def test_urls_fold_ascii_letters_only(spark):
    kelvin = "http://a.net/casino\u212a/"
    df = spark.createDataFrame([(1, kelvin), (2, "http://a.net/CASINO/"), (3, "http://a.net/" + "x/" * 200_000 + "poker")], "page_id long, url string")
    got = {r["page_id"]: r["verdict"] for r in url_rules.judge_urls(df, url_rules.RULES).collect()}
    assert got == {r["page_id"]: brute.judge_url(r["url"], *LISTS)[3] for r in df.collect()} == {1: "block", 2: "block", 3: "block"}


@pytest.mark.parametrize("name", sorted(set(queries.ORACLE_SQL) - {"op12_prefix_trie", "op13_spelling_variants"}))
def test_oracle(spark, name):
    from oracle_compare import compare
    assert compare(spark, SF, name, queries.QUERIES[name], queries.ORACLE_SQL[name])["status"] == "ok"
