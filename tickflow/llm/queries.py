"""The registered queries: each applies its operator to its whole table with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (best_fit, chat, exact_dedup, language_model, mixing, ngram_join, packing, personal_data, prefix_trie, quality, spelling,
               substrings, url_rules)
from .common import materialize, sha256_hex, table


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    ratios = quality.log_ratios(docs, table(spark, sf_dir, "labels"))
    return docs.select("doc_id", quality.verdict(F.col("text"), ratios).alias("v")).select("doc_id", "v.*")


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_data.find_personal_data(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["base"])
    kinds = F.transform(base, lambda s: s["kind"])
    counts = [F.size(F.filter(kinds, personal_data.is_kind(k))).cast("long").alias(f"n_{name}")
              for k, name in enumerate(personal_data.BASE)]
    return found.select("doc_id", *counts, sha256_hex(personal_data.listed(base)).alias("base_sha256"),
                        personal_data.listed(F.col("spans")).alias("spans"), F.size("spans").cast("long").alias("n_spans"),
                        (F.size("spans") - F.size(base)).cast("long").alias("n_added"))


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"))


def op5_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score_documents(table(spark, sf_dir, "documents"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_digest(table(spark, sf_dir, "documents"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(table(spark, sf_dir, "documents")).drop("kept_text")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op9_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_rules.judge_urls(table(spark, sf_dir, "pages"), url_rules.RULES)
    base = F.col("rule").isin([r.name for r in url_rules.BASE_RULES])
    return judged.select("page_id", "host", "path", F.when(base, F.col("rule")).alias("rule"), "verdict",
                         F.when(~base, F.col("rule")).alias("pattern_rule"))


def op10_chat_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.rotate(table(spark, sf_dir, "conversations"))


def op11_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return best_fit.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = materialize(prefix_trie.ordered_turns(table(spark, sf_dir, "conversations")), "turns")
    nodes, ends = prefix_trie.prefix_trie(*prefix_trie.with_shared_starts(turns))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    several = (F.col("n_convs") > 1) & (F.col("n_ends") > 0)
    hashed = nodes.filter(several).join(prefix_trie.ends_hash(ends), prefix_trie.NODE)
    own = F.when(F.col("n_ends") > 0, F.col("conv_id").cast("string")).otherwise(F.lit(""))
    return hashed.select(*columns, "ends_sha256").unionByName(nodes.filter(~several).select(*columns, sha256_hex(own).alias("ends_sha256")))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variant_groups(spelling.word_counts(table(spark, sf_dir, "documents")))


QUERIES = {f.__name__: f for f in (
    op1_quality_rules, op2_exact_dedup, op3_personal_data, op4_ngram_join, op5_language_model, op6_mixing, op7_substring_dedup, op8_packing, op9_url_rules, op10_chat_rotation,
    op11_best_fit_packing, op12_prefix_trie, op13_spelling_variants)}

#: DuckDB SQL of the queries that SQL can express. Hashed n-grams, tokenizers, models and hash orders
#: (1, 3, 5, 6, 8, 11) are tested against brute force instead.
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"[x FOR x IN string_split_regex({}, '[\x20\x09-\x0D]+') IF x <> '']"
#: The unsigned crc32 of {0}, the upper-case hex of some bytes: a bit at a time.
_CRC32 = """xor(list_reduce([4294967295::BIGINT] || [('0x' || substr({0}, 2 * i + 1, 2))::BIGINT FOR i IN range(length({0}) // 2)],
    lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295)"""
_RULES = ", ".join(f"('{r.name}', '{r.name.partition('/')[0]}', '/{r.name.partition('/')[2]}', '{r.verdict}')" for r in url_rules.BASE_RULES)
_PATTERNS = ", ".join(f"('{r.name}', '{r.pattern.removeprefix('(?i)')}', '{r.verdict}')" for r in url_rules.PATTERN_RULES)

ORACLE_SQL: dict[str, str] = {
    "op2_exact_dedup": f"""
WITH t AS (SELECT doc_id, sha256({_LOWER}) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, text_sha256
FROM t""",
    "op4_ngram_join": f"""
WITH RECURSIVE w AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS.format(_LOWER)} AS w FROM documents),
s AS (SELECT r, doc_id, CASE WHEN len(w) >= 5 THEN list_distinct([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)])
                             WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s FROM w),
g AS (SELECT r, len(s) AS n, unnest(s) AS g FROM s),
l AS (SELECT a.r AS a, b.r AS b FROM g a JOIN g b ON a.g = b.g AND a.r <> b.r GROUP BY a.r, b.r
      HAVING 100 * count(*) >= 75 * (any_value(a.n) + any_value(b.n) - count(*))),
c AS (SELECT r, r AS t FROM s UNION SELECT c.r, l.b FROM c JOIN l ON c.t = l.a),
m AS (SELECT c.r, min(s.doc_id) AS component_id FROM c JOIN s ON s.r = c.t GROUP BY c.r)
SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id FROM s JOIN m USING (r)""",
    "op7_substring_dedup": f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
v AS (SELECT r, coalesce(doc_id, 9223372036854775807) AS doc, t.i, w[t.i:t.i + 12] AS g FROM d, unnest(range(1, len(w) - 11)) t(i)),
f AS (SELECT g, min(doc) AS doc FROM v GROUP BY g),
h AS (SELECT DISTINCT v.r, v.i + k.k AS p FROM v JOIN f ON v.g = f.g AND f.doc < v.doc, range(13) k(k)),
k AS (SELECT d.r, t.p, d.w[t.p] AS word FROM d, unnest(range(1, len(w) + 1)) t(p)
      WHERE NOT EXISTS (FROM h WHERE h.r = d.r AND h.p = t.p)),
a AS (SELECT r, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS kept FROM k GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN a USING (r)""",
    "op9_url_rules": f"""
WITH rules(rule, rule_host, rule_path, verdict) AS (VALUES {_RULES}), patterns(rule, pattern, verdict) AS (VALUES {_PATTERNS}),
u AS (SELECT row_number() OVER () AS r, page_id,
             translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path FROM pages),
b AS (SELECT r, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict FROM u JOIN rules
      ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path) GROUP BY r),
p AS (SELECT r, arg_max(rule, (length(rule), rule)) AS rule, 'block' AS verdict FROM u JOIN patterns
      ON regexp_matches(translate(host || path, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), pattern) GROUP BY r)
SELECT page_id, host, path, b.rule AS rule, coalesce(b.verdict, p.verdict, 'allow') AS verdict,
       CASE WHEN b.rule IS NULL THEN p.rule END AS pattern_rule
FROM u LEFT JOIN b USING (r) LEFT JOIN p USING (r)""",
    "op10_chat_rotation": f"""
WITH t AS (SELECT conv_id, coalesce(role, 'unknown') AS role, replace(coalesce(text, ''), '<|im_', '< |im_') AS said, row_number() OVER (
             PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, 'unknown'), replace(coalesce(text, ''), '<|im_', '< |im_')) - 1 AS place FROM conversations),
s AS (SELECT DISTINCT conv_id, role AS speaker FROM t WHERE role <> 'system'),
n AS (SELECT DISTINCT conv_id, place // {chat.PART} AS part FROM t),
p AS (SELECT conv_id, place // {chat.PART} AS part, false AS scene, place, role, said FROM t
      UNION ALL SELECT n.conv_id, n.part, true, place, role, said FROM t JOIN n ON t.conv_id IS NOT DISTINCT FROM n.conv_id
      WHERE n.part > 0 AND t.place < {chat.PART} AND t.role = 'system'),
v AS (SELECT p.*, s.speaker, p.role = s.speaker AS own, '<|im_start|>' || CASE WHEN p.role = s.speaker THEN 'assistant' WHEN p.role = 'system' THEN 'system'
             ELSE 'user name=' || translate(replace(p.role, '<|im_', '< |im_'), chr(13) || chr(10), '  ') END || chr(10) AS head, said || '<|im_end|>' AS body
      FROM p JOIN s ON p.conv_id IS NOT DISTINCT FROM s.conv_id),
w AS (SELECT *, sum(length(head) + length(body) + 1) OVER (PARTITION BY conv_id, part, speaker ORDER BY scene DESC, place) - length(body) - 1 AS start FROM v)
SELECT conv_id, part, speaker, count(*) FILTER (NOT scene) AS n_turns, count(*) FILTER (own) AS n_targets,
       string_agg(head || body || chr(10), '' ORDER BY scene DESC, place) AS text,
       coalesce(string_agg(start::BIGINT || ':' || (start + length(body))::BIGINT, ',' ORDER BY scene DESC, place) FILTER (own), '') AS targets
FROM w GROUP BY conv_id, part, speaker""",
    "op12_prefix_trie": f"""
WITH t AS (SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS p,
                  {{'role': coalesce(role, ''), 'text': coalesce(text, '')}} AS s FROM conversations WHERE conv_id IS NOT NULL),
k AS (SELECT c, list(s ORDER BY p) AS s FROM t GROUP BY c),
h AS (SELECT c, s, {_CRC32.format("hex(encode(c::VARCHAR))")} % 6 AS h FROM k),
q AS (SELECT h.c, coalesce(k.s[1:h.h], []) || h.s[h.h + 1:] AS s FROM h LEFT JOIN k ON k.c = h.c - h.c % 100),
x AS (SELECT c, u.d, s[1:u.d] AS key, len(s) AS n FROM q, unnest(range(0, len(s) + 1)) u(d)),
n AS (SELECT key, d, min(c) AS conv_id, count(*) AS n_convs, coalesce(string_agg(c, ',' ORDER BY c) FILTER (n = d), '') AS ends,
             CASE WHEN d > 0 THEN length(key[d].text) ELSE 0 END AS chars FROM x GROUP BY key, d),
ch AS (SELECT key[1:d - 1] AS key, d - 1 AS d, count(*) AS n_children FROM n WHERE d > 0 GROUP BY ALL),
b AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN ch USING (key, d)),
sub AS (SELECT key[1:u.d] AS key, u.d, count(*) FILTER (n_children = 0) AS n_leaves, sum((n_convs - 1) * chars) AS saved
        FROM b, unnest(range(0, b.d + 1)) u(d) GROUP BY ALL)
SELECT b.conv_id, b.d AS depth, p.conv_id AS parent_conv_id, b.n_convs, b.n_children, sub.n_leaves, sub.saved::BIGINT AS saved_tokens, sha256(b.ends) AS ends_sha256
FROM b JOIN sub USING (key, d) LEFT JOIN n p ON p.d = b.d - 1 AND p.key = b.key[1:b.d - 1]""",
    "op13_spelling_variants": f"""
WITH RECURSIVE r AS (SELECT unnest(regexp_extract_all({_LOWER}, '[A-Za-z\u00C0-\u00FF]{{7,}}')) AS run, coalesce(doc_id::VARCHAR, '') AS doc FROM documents),
o AS (SELECT run, doc, count(*) AS n FROM r GROUP BY ALL),
h AS (SELECT run, n, {_CRC32.format("hex(encode(doc || ':' || run))")} AS h FROM o),
a AS (SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM h),
w AS (SELECT word, sum(n)::BIGINT AS n FROM a WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
d AS (SELECT word, n, t.i, substr(word, 1, t.i) || substr(word, t.i + 2) AS less FROM w, unnest(range(length(word))) t(i)),
p AS (SELECT a.word, b.word AS other, b.n FROM d a JOIN d b ON a.less = b.less AND a.i = b.i AND a.word <> b.word
      UNION SELECT d.word, w.word, w.n FROM d JOIN w ON d.less = w.word UNION SELECT w.word, d.word, d.n FROM d JOIN w ON d.less = w.word),
m AS (SELECT word, count(*) AS n_near, max(n) AS best_n FROM p GROUP BY word),
f AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 10 * w.n THEN best_n END AS form_n FROM w LEFT JOIN m USING (word)),
g AS (SELECT f.*, (SELECT min(other) FROM p WHERE p.word = f.word AND p.n = f.form_n) AS form FROM f),
z AS (SELECT word, word AS root FROM g UNION SELECT z.word, g.form FROM z JOIN g ON g.word = z.root WHERE g.form IS NOT NULL)
SELECT g.word, g.form, z.root, g.n, g.n_near, g.form_n FROM g JOIN z ON z.word = g.word JOIN g e ON e.word = z.root WHERE e.form IS NULL""",
}
