"""Personal data: generators propose spans, boosted trees and calibrated thresholds select redactions.

1. Generators.  For each kind (email, ip, card, phone) the base pattern proposes
   spans, and several looser patterns propose more: masked, spelled and accented addresses, IPv6 and defanged
   addresses, cards grouped by other characters, national phone numbers and numbers after "tel".  Two more kinds
   have looser patterns only: account (runs of 12 to 19 digits) and secret (values of keys, tokens and
   passwords, long hexadecimal runs, keys with well-known beginnings).  Proposals may overlap.
2. Base spans are the base pattern's matches that pass their check (parts at most
   255, Luhn, digit counts).  They are always redacted.
3. Every proposal gets a verdict (``right``) from a test of its digits or letters that no
   feature shows: the host ends in letters, the parts are at most 255, Luhn, no leading zero,
   a number that is no time stamp, book number, round number or run of like digits, a value that mixes letters and digits.
   Boosted trees learn from the verdicts on all proposals of the corpus which format and
   context go with personal data.  All features are small integers, so
   the corpus is summed up in at most ``CELLS`` cells; trees of depth two
   are fitted to the cells on the driver and become one expression.
4. A threshold for each kind is calibrated on the same proposals: the lowest
   score at which at least ``PRECISION`` of those at or above it are right.  A
   looser proposal is redacted when its score reaches its kind's threshold, its verdict is right
   and it overlaps no base span of its kind (account, secret: of any kind).  Without right proposals of a kind nothing is added to it.

The patterns only add possessive quantifiers and look-behinds to the contract's,
which changes no match and keeps the search linear on very long runs.

Defined results: null and empty texts have no spans; null doc_ids and repeated
rows are judged each on their own; an empty table gives an empty result; other columns don't matter.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, materialize

KINDS = ("email", "ip", "card", "phone", "account", "secret")
PRECISION = 0.98
SLACK = 1e-6  # scores as near as this are one: sums of the same values differ in their last bits
ROUNDS = 20
RATE = 0.5

_LOCAL = "A-Za-z0-9._%+-"
BASE = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_WORD = r"\p{L}\p{N}._%+-"
_VALUE = "A-Za-z0-9+/_.~-"
_NAME = "(?i:key|token|secret|passwd|password|pwd|passphrase|credential)"
LOOSE = {
    "email": (
        rf"(?<![{_LOCAL}])[{_LOCAL}]++\x20?[\[({{](?:at|AT)[\])}}]\x20?[A-Za-z0-9-]++(?:\x20?(?:[\[({{](?:dot|DOT)[\])}}]|\.)\x20?[A-Za-z0-9-]++)++",
        rf"(?<![{_LOCAL}])[{_LOCAL}]++\x20(?:at|AT)\x20[A-Za-z0-9-]++(?:\x20(?:dot|DOT)\x20[A-Za-z0-9-]++)++",
        r"(?<![A-Za-z0-9._+-])[A-Za-z0-9._+-]++%40[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        rf"(?<![{_WORD}])[{_WORD}]++@[\p{{L}}\p{{N}}-]++(?:\.[\p{{L}}\p{{N}}-]++)++"),
    "ip": (
        r"(?<![0-9A-Za-z:.])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}"
        r"|(?=[0-9A-Fa-f:]*+(?![0-9A-Za-z:]))(?=(?:[0-9A-Fa-f]*+:){2,7}+[0-9A-Fa-f]*+(?![0-9A-Fa-f:]))"
        r"(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,6})?::(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,6})?)(?![0-9A-Za-z:])",
        r"(?<![0-9])[0-9]{1,3}(?:(?:\[\.\]|\(\.\))[0-9]{1,3}){3}(?![0-9])"),
    "card": (r"(?<![0-9])(?:[0-9]{4}(?:[./_][0-9]{4}){3}|[0-9]{4}[./_][0-9]{6}[./_][0-9]{4,5})(?![0-9])",),
    "phone": (
        r"(?<![0-9A-Za-z+.-])(?:(?:\([0-9]{3}\)\x20?|[0-9]{3}[.\x20-])[0-9]{3}[.\x20-][0-9]{4}"
        r"|00[1-9][0-9]{0,2}(?:[\x20./-]?[0-9]{2,4}){2,4}|0[1-9][0-9]{1,4}[\x20/-][0-9]{2,4}(?:[\x20-]?[0-9]{2,4}){1,2})(?![0-9A-Za-z-])",
        r"(?<![0-9])(?=[0-9]{9})(?<=(?i:tel|phone|fax|mobile)[.:]?\x20{0,2})[0-9]{9,15}(?![0-9])"),
    "account": (r"(?<![0-9A-Za-z.,_/+-])[0-9]{12,19}(?![0-9A-Za-z_/-]|[.,][0-9])",),
    "secret": (
        rf"(?<![{_VALUE}])(?=[{_VALUE}]{{8}})(?<={_NAME}[\"']?\x20{{0,2}}[:=]\x20{{0,2}}[\"']?)[{_VALUE}]++={{0,2}}",
        r"(?<![0-9A-Za-z])(?:[0-9a-f]{32,128}|[0-9A-F]{32,128})(?![0-9A-Za-z])",
        r"(?<![0-9A-Za-z])(?:A[KS]IA[0-9A-Z]{16}|gh[opsu]_[0-9A-Za-z]{36}|xox[abprs]-[0-9A-Za-z-]{10,100}"
        r"|eyJ[0-9A-Za-z_-]{10,2000}\.[0-9A-Za-z_-]{10,2000}\.[0-9A-Za-z_-]{10,2000})(?![0-9A-Za-z_-])"),
}
#: A text without this has no match of the kind.
NEEDS = {"email": r"@|[(\[{](?:at|AT)[)\]}]|%40|\x20(?:dot|DOT)\x20", "ip": r"[0-9][.]|:[0-9A-Fa-f]|[0-9A-Fa-f]:|[0-9][\[(]\.",
         "card": "[0-9]{4}|[0-9][\\x20-][0-9]", "phone": "[+][0-9]|[0-9][.)\\x20/-]|00[1-9]|[0-9]{9}", "account": "[0-9]{12}",
         "secret": rf"{_NAME}[\"']?\x20{{0,2}}[:=]|[0-9a-f]{{32}}|[0-9A-F]{{32}}|A[KS]IA[0-9A-Z]|gh[opsu]_|xox[abprs]-|eyJ"}
#: Words before a span that speak for its kind.
CONTEXT = {"email": "mail|contact|write|kontakt|correo", "ip": "addr|host|server|ip", "card": "card|visa|karte|carte|tarjeta|pay",
           "phone": "phone|call|tel|fax|mobile|numero", "account": "account|konto|cuenta|compte|customer|kunde|passport|member",
           "secret": "key|token|secret|pass|auth|bearer"}

#: Feature: number of values.
FEATURES = {"digits": 6, "marks": 4, "left": 3, "right": 3, "context": 2, "check": 3}
CELLS = len(KINDS) * math.prod(FEATURES.values())


# --- proposals --------------------------------------------------------------

def matches(text: Column, pattern: str) -> Column:
    """array<struct<start, end, found, before, after>> of all matches, in code points, end exclusive.

    The pieces between the matches (split) and the matches themselves alternate, which gives the places.
    """
    def placed(found: Column, pieces: Column) -> Column:
        def step(acc: Column, i: Column) -> Column:
            start = acc["at"] + F.length(F.get(pieces, i))
            end = start + F.length(F.get(found, i))
            span = F.struct(start.alias("start"), end.alias("end"), F.get(found, i).alias("found"),
                            F.right(F.get(pieces, i), F.lit(24)).alias("before"), F.left(F.get(pieces, i + 1), F.lit(1)).alias("after"))
            return F.struct(end.alias("at"), F.concat(acc["spans"], F.array(span)).alias("spans"))

        none = F.struct(F.lit(0).alias("at"), F.array().cast(
            "array<struct<start:int,end:int,found:string,before:string,after:string>>").alias("spans"))
        return F.aggregate(F.sequence(F.lit(0), F.size(found) - 1), none, step)["spans"]

    def some(found: Column) -> Column:
        empty = F.array().cast("array<struct<start:int,end:int,found:string,before:string,after:string>>")
        return F.when(F.size(found) == 0, empty).otherwise(let(F.split(text, pattern), lambda p: placed(found, p)))

    return let(F.regexp_extract_all(text, F.lit(pattern), 0), some)


def luhn(digits: Column) -> Column:
    def one(i: Column) -> Column:
        d = F.substring(F.reverse(digits), i, F.lit(1)).cast("int")
        return F.when(i % 2 == 0, F.when(d > 4, 2 * d - 9).otherwise(2 * d)).otherwise(d)

    return F.aggregate(F.transform(F.sequence(F.lit(1), F.length(digits)), one), F.lit(0), lambda a, x: a + x) % 10 == 0


def passes(kind: str, found: Column) -> Column:
    """Whether a base match is kept."""
    digits = F.regexp_replace(found, "[^0-9]", "")
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        part = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
        return found.rlike(rf"^{part}\.{part}\.{part}\.{part}$")
    if kind == "card":
        return F.when(F.length(digits).between(13, 19), luhn(digits)).otherwise(False)
    return F.length(digits).between(9, 15)


def _edge(c: Column) -> Column:
    return F.when((c == "") | c.rlike(r"\s"), 0).when(c.rlike(r"[\p{L}\p{N}]"), 2).otherwise(1)


def identifier(digits: Column) -> Column:
    """Whether a long number may name somebody: no time stamp, book number, round number, run of like digits or count-up."""
    dated = r"^(?:19|20)[0-9]{2}(?:0[1-9]|1[0-2])(?:0[1-9]|[12][0-9]|3[01])(?:[01][0-9]|2[0-3])[0-5][0-9](?:[0-5][0-9][0-9]{0,5})?$"
    return ~digits.rlike(rf"{dated}|^1[0-9]{{12}}$|^97[89][0-9]{{10}}$|0{{6}}$|([0-9])\1{{6}}|01234567|12345678|98765432|87654321")


def plausible(kind: str, found: Column) -> Column:
    """The verdict on a proposal that the trees learn from: by its digits and letters, which are no features."""
    digits = F.regexp_replace(found, "[^0-9]", "")
    if kind == "email":
        return found.rlike(r"[\p{L}]{2,}$")
    if kind == "ip":
        return (found.contains(":") & found.rlike("[0-9]")) | passes("ip", F.regexp_replace(found, r"[\[\]()]", ""))
    if kind == "card":
        return passes("card", found)
    if kind == "phone":
        return passes("phone", found) & ~found.rlike(r"^\+0")
    if kind == "account":
        return identifier(digits)
    letters = F.length(F.regexp_replace(found, "[^A-Za-z]", ""))
    return (letters >= 2) & (F.length(digits) >= 2) & (F.size(F.array_distinct(F.split(found, ""))) >= 8)


def second_check(kind: str, found: Column) -> Column:
    """A test of the value that does not decide the verdict: 0 fails, 2 passes, 1 for kinds without one."""
    if kind == "ip":
        return F.when(found.rlike(r"^[0-9](?:\.[0-9]){3}$"), 0).otherwise(2)  # as short as a version number
    if kind == "account":
        return F.when(luhn(found), 2).otherwise(0)
    if kind == "secret":
        return F.when(found.rlike("[./]"), 0).otherwise(2)  # as a file or package
    return F.lit(1)


def described(kind: str, base: bool, m: Column) -> Column:
    """A proposal with its features; ``proposed``: by the base pattern, ``base``: and redacted for that."""
    n = F.length(F.regexp_replace(m["found"], "[^0-9]", "")) if kind != "secret" else F.length(m["found"])
    size = F.when(n == 0, 0).when(n < 4, 1).when(n < 9, 2).when(n < 13, 3).when(n < 20, 4).otherwise(5)
    return F.struct(
        F.lit(KINDS.index(kind)).alias("kind"), m["start"].alias("start"), m["end"].alias("end"), F.lit(base).alias("proposed"),
        (passes(kind, m["found"]) if base else F.lit(False)).alias("base"), plausible(kind, m["found"]).alias("right_kind"),
        size.alias("digits"),
        F.least(F.size(F.array_distinct(F.split(F.regexp_replace(m["found"], "[A-Za-z0-9]", ""), ""))) - 1, F.lit(3)).alias("marks"),
        _edge(F.right(m["before"], F.lit(1))).alias("left"), _edge(m["after"]).alias("right"),
        F.lower(m["before"]).rlike(CONTEXT[kind]).cast("int").alias("context"), second_check(kind, m["found"]).alias("check"))


def _described_all(kind: str, base: bool, text: Column, pattern: str) -> Column:
    return F.transform(matches(text, pattern), lambda m: described(kind, base, m))


def proposals(text: Column) -> Column:
    """All proposals of all generators for a text."""
    text = F.coalesce(text, F.lit(""))
    out = []
    for kind in KINDS:
        generators = [(True, BASE[kind])] if kind in BASE else []
        generators += [(False, p) for p in LOOSE[kind]]
        out.append(F.when(text.rlike(NEEDS[kind]), F.concat(*[_described_all(kind, base, text, p) for base, p in generators])))
    return F.flatten(F.filter(F.array(*out), lambda x: x.isNotNull()))


# --- the model --------------------------------------------------------------

@dataclass(frozen=True)
class Split:
    feature: str
    value: int


@dataclass(frozen=True)
class Tree:
    """Depth two: a split, and in each branch a split and two values."""
    top: Split
    yes: tuple[Split, float, float]
    no: tuple[Split, float, float]


def _holds(cell: dict, s: Split) -> bool:
    return cell[s.feature] <= s.value


def _best(cells: list[tuple[dict, float, float]]) -> tuple[Split, float, float, float]:
    """The split of (cell, gradient, hessian) rows with the largest gain, its two values and the gain."""
    names = [("kind", len(KINDS)), *FEATURES.items()]
    best = (Split("kind", len(KINDS)), 0.0, 0.0, -1.0)
    for name, n in names:
        sums = [[0.0, 0.0] for _ in range(n)]
        for cell, g, h in cells:
            sums[cell[name]][0] += g
            sums[cell[name]][1] += h
        all_g, all_h = sum(s[0] for s in sums), sum(s[1] for s in sums)
        g = h = 0.0
        for v in range(n):
            g, h = g + sums[v][0], h + sums[v][1]
            gain = g * g / (h + 1) + (all_g - g) ** 2 / (all_h - h + 1)
            if gain > best[3] + 1e-9:
                best = (Split(name, v), RATE * g / (h + 1), RATE * (all_g - g) / (all_h - h + 1), gain)
    return best


def boost(cells: list[tuple[dict, int, int]], rounds: int = ROUNDS) -> list[Tree]:
    """Trees for the log odds, from (features, matches, right matches) of each cell."""
    score = [0.0] * len(cells)
    trees = []
    for _ in range(rounds if cells else 0):
        rows = []
        for (cell, n, right), s in zip(cells, score, strict=True):
            p = 1 / (1 + math.exp(-s))
            rows.append((cell, right - n * p, n * p * (1 - p)))
        top = _best(rows)[0]
        sides = [_best([r for r in rows if _holds(r[0], top) == side])[:3] for side in (True, False)]
        tree = Tree(top, *sides)
        trees.append(tree)
        score = [s + value(tree, cell) for (cell, _, _), s in zip(cells, score, strict=True)]
    return trees


def value(tree: Tree, cell: dict) -> float:
    split, yes, no = tree.yes if _holds(cell, tree.top) else tree.no
    return yes if _holds(cell, split) else no


def thresholds(cells: list[tuple[dict, int, int]], trees: list[Tree], precision: float = PRECISION) -> list[float]:
    """For each kind the lowest score at which ``precision`` of the labelled matches from there on are right."""
    out = []
    for k in range(len(KINDS)):
        rows = sorted(((sum(value(t, c) for t in trees), n, r) for c, n, r in cells if c["kind"] == k), key=lambda x: -x[0])
        best, n, right = math.inf, 0, 0
        for i, (s, a, b) in enumerate(rows):
            n, right = n + a, right + b
            last = i + 1 == len(rows) or rows[i + 1][0] < s - SLACK
            if last and right and right >= precision * n:
                best = s - SLACK
        out.append(best)
    return out


def score(trees: list[Tree], p: Column) -> Column:
    """The trees as one expression on a proposal."""
    def branch(b) -> Column:
        return F.when(p[b[0].feature] <= b[0].value, b[1]).otherwise(b[2])

    total = F.lit(0.0)
    for t in trees:
        total = total + F.when(p[t.top.feature] <= t.top.value, branch(t.yes)).otherwise(branch(t.no))
    return total


# --- the operator -----------------------------------------------------------

def feature_cells(proposed: DataFrame) -> list[tuple[dict, int, int]]:
    """(features, matches, right matches) of all proposals, in at most CELLS cells.

    Digit runs that are too short or too long for a card say nothing of cards and are left out.
    """
    names = ["kind", *FEATURES]
    learned = (F.col("p.kind") != KINDS.index("card")) | (F.col("p.digits") == 4)
    rows = (proposed.select(F.explode("proposals").alias("p")).filter(learned)
            .groupBy(*[F.col(f"p.{n}").alias(n) for n in names])
            .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("p.right_kind").cast("long")).alias("good")).collect())
    return sorted(((({n: r[n] for n in names}, r["n"], r["good"])) for r in rows), key=lambda x: tuple(x[0].values()))


def selected(found: Column, trees: list[Tree], limits: list[float]) -> Column:
    """The spans to redact, of an array of proposals: array<struct<kind, start, end, base>>, by kind and start."""
    limit_of = F.array(*[F.lit(min(x, 1e300)) for x in limits])

    def chosen(all_: Column) -> Column:
        def add(base: Column) -> Column:
            def accepted(p: Column) -> Column:
                free = ~F.exists(base, lambda b: ((b["kind"] == p["kind"]) | (p["kind"] >= len(BASE)))
                                 & (b["start"] < p["end"]) & (p["start"] < b["end"]))
                return ~p["proposed"] & free & p["right_kind"] & (score(trees, p) >= F.element_at(limit_of, p["kind"] + 1))

            both = F.concat(base, F.filter(all_, accepted))
            return F.sort_array(F.array_distinct(F.transform(both, lambda p: F.struct(p["kind"], p["start"], p["end"], p["base"]))))

        return let(F.filter(all_, lambda p: p["base"]), add)

    return let(found, chosen)


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def is_kind(k: int):
    return lambda kind: kind == k


def find_personal_data(docs: DataFrame) -> DataFrame:
    """A row per document: doc_id and ``spans``: array<struct<kind (index in KINDS), start, end, base>>."""
    proposed = materialize(docs.select("doc_id", proposals(F.col("text")).alias("proposals")), "proposals")
    cells = feature_cells(proposed)
    trees = boost(cells)
    return proposed.select("doc_id", selected(F.col("proposals"), trees, thresholds(cells, trees)).alias("spans"))


def redact(text: Column, spans: Column) -> Column:
    """The text with each span replaced by [kind]; of overlapping spans the first counts, stretched over the rest."""
    names = F.array(*[F.lit(f"[{k}]") for k in KINDS])
    order = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))

    def step(acc: Column, s: Column) -> Column:
        fresh = s["start"] >= acc["at"]
        piece = F.concat(F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.element_at(names, s["kind"] + 1))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"),
                        F.when(fresh, F.concat(acc["out"], piece)).otherwise(acc["out"]).alias("out"))

    none = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    return F.aggregate(order, none, step, lambda a: F.concat(a["out"], F.substring(text, a["at"] + 1, F.length(text))))
