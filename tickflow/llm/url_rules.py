"""URL filter: pattern rules indexed by their rarest literal token.

A rule is a regular expression on host and path, with literal tokens that
every URL it matches has among its own tokens (lower-case runs of a-z and
0-9 in host and path).  One pass over all URLs counts the rules' tokens; each
rule is filed under its rarest one.  A URL's tokens fetch the rules filed
under them, and only those run their regular expressions.  Rules without
literal tokens are filed under the empty token, which every URL is given when
there are such rules.

URLs are judged once each: pages with the same URL share the verdict, so a
very frequent URL is one row until the last join, which Spark can split.
The rule list is a parameter; up to ``MAX_BROADCAST`` rules it is broadcast,
beyond that joined by a shuffle.

A URL's verdict comes from its highest-ranking matching rule; ``rank`` orders
rules, then longer names win, then block beats allow.  No match: ``default``.

Defined results: a null URL or one without "://" has an empty host and path,
no rule, and the default verdict; repeated rows and null page_ids are kept as they are;
an empty table gives an empty result.
"""

from __future__ import annotations

import itertools
import json
import re
import string
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower

MAX_BROADCAST = 100_000


@dataclass(frozen=True)
class Rule:
    name: str
    pattern: str
    verdict: str
    literals: tuple[str, ...] = ()
    rank: int = 0


def prefix_rule(host: str, path: str, verdict: str) -> Rule:
    """Fits ``host`` and its subdomains where the path starts with ``path``."""
    whole = re.findall(r"[a-z0-9]+", host.lower()) + re.findall(r"(?<![A-Za-z0-9])[a-z0-9]+(?![A-Za-z0-9])(?!$)", path)
    return Rule(host + path, "^(?:[^/]*[.])?" + re.escape(host) + re.escape(path), verdict, tuple(whole), 1)


def label_rule(word: str, verdict: str = "block") -> Rule:
    """Fits URLs with ``word`` as a whole token of the host or the path."""
    return Rule(f"*{word}*", f"(?i)(?:^|[^a-z0-9]){re.escape(word)}(?:[^a-z0-9]|$)", verdict, (word,))


def phrase_rule(first: str, second: str, verdict: str = "block") -> Rule:
    """Fits URLs with the two words as neighbouring tokens, one to three other characters between them."""
    return Rule(f"*{first} {second}*", f"(?i)(?:^|[^a-z0-9]){re.escape(first)}[^a-z0-9]{{1,3}}{re.escape(second)}(?:[^a-z0-9]|$)",
                verdict, (first, second))


def file_rule(ending: str, verdict: str = "block") -> Rule:
    """Fits URLs whose path ends with ``.ending``."""
    return Rule(f"*.{ending}", rf"(?i)/(?s:.*)[.]{re.escape(ending)}\z", verdict, (ending,))


#: Prefix rules of the contract: fixed values.
BASE_RULES = [
    prefix_rule("org", "/", "allow"),
    prefix_rule("example.org", "/es/", "block"),
    prefix_rule("example.org", "/en/1", "block"),
    prefix_rule("com", "/fr/", "allow"),
    prefix_rule("com", "/de/", "block"),
]
#: Words that mark gambling, adult, warez and pill sites.
SPAM_RULES = [label_rule(w) for w in (
    "betting", "casino", "escort", "jackpot", "lottery", "poker", "porn", "roulette", "sex", "slots",
    "torrent", "viagra", "warez", "xxx")]
#: Neighbouring words that mark a site though each alone is harmless: any of the left with any of the right.
PHRASES = [
    (("best", "buy", "cheap", "discount", "free", "instant", "online", "order"),
     ("bets", "cialis", "credits", "essays", "followers", "likes", "loans", "meds", "pharmacy", "pills", "replica", "spins", "watches")),
    (("casino", "jackpot", "lottery", "poker", "slots"), ("bonus", "club", "games", "online", "win")),
    (("adult", "sexy"), ("cam", "cams", "chat", "dating", "video", "videos", "x")),
    (("ad", "ads", "click", "popup"), ("farm", "network", "server", "serving", "track", "tracker", "tracking")),
    (("doorway", "link", "seo", "spam"), ("exchange", "farm", "farms", "network", "wheel")),
    (("free", "full", "nulled"), ("crack", "download", "keygen", "serial", "torrents")),
]
PHRASE_RULES = [phrase_rule(a, b) for left, right in PHRASES for a, b in itertools.product(left, right)]
#: Paths that end in a program or an archive, not a page.
FILE_RULES = [file_rule(e) for e in ("7z", "apk", "bin", "deb", "dmg", "exe", "iso", "jar", "msi", "rar", "rpm", "zip")]
PATTERN_RULES = [*SPAM_RULES, *PHRASE_RULES, *FILE_RULES]
RULES = [*BASE_RULES, *PATTERN_RULES]


def host_and_path(url: Column) -> tuple[Column, Column]:
    parts = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    text = F.coalesce(url, F.lit(""))
    host = F.translate(F.regexp_extract(text, parts, 1), string.ascii_uppercase, string.ascii_lowercase)
    return host, F.regexp_extract(text, parts, 2)


def rule_table(spark: SparkSession, rules: list[Rule]) -> DataFrame:
    kind = "array<struct<name:string,pattern:string,verdict:string,literals:array<string>,rank:int>>"
    rows = F.from_json(F.lit(json.dumps([asdict(r) for r in rules])), kind)
    return spark.range(1).select(F.explode(rows).alias("r")).select("r.*")


def url_tokens(target: Column, empty: bool) -> Column:
    """The distinct tokens of a URL, with ``empty`` also the one of rules without literals."""
    own = F.regexp_extract_all(ascii_lower(target), F.lit("[a-z0-9]+"), 0)
    return F.array_distinct(F.concat(F.array(F.lit("")), own) if empty else own)


def rule_index(rules: DataFrame, tokens: DataFrame) -> DataFrame:
    """``rules`` with the token under which each is filed: its rarest in ``tokens`` (a column "token")."""
    literals = rules.select("name", "pattern", F.explode(F.when(F.size("literals") == 0, F.array(F.lit("")))
                                                         .otherwise(F.col("literals"))).alias("token"))
    used = literals.select("token").distinct()
    counts = tokens.join(used, "token").groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    filed = (literals.join(counts, "token", "left").groupBy("name", "pattern")
             .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token")).alias("least")))
    return rules.join(filed, ["name", "pattern"]).select("name", "pattern", "verdict", "rank", F.col("least.token").alias("token"))


def judge_urls(pages: DataFrame, rules: list[Rule], default: str = "allow") -> DataFrame:
    """A row per page: page_id, host, path, rule, verdict; rule only for prefix rules' names and patterns alike."""
    spark = pages.sparkSession
    host, path = host_and_path(F.col("url"))
    urls = pages.select("url").distinct().withColumn("target", F.concat(host, path))
    spread = urls.select("url", "target", F.explode(url_tokens(F.col("target"), not all(r.literals for r in rules))).alias("token"))
    index = rule_index(rule_table(spark, rules), spread.select("token"))
    if len(rules) <= MAX_BROADCAST:
        index = F.broadcast(index)
    order = F.struct("rank", F.length("name").alias("long"), (F.col("verdict") == "block").alias("block"), "name", "verdict")
    best = (spread.join(index, "token").filter((F.col("target") != "") & F.expr("target rlike pattern"))
            .groupBy("url").agg(F.max(order).alias("best")))
    return pages.select("page_id", "url").join(best, "url", "left").select(
        "page_id", host.alias("host"), path.alias("path"), F.col("best.name").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
