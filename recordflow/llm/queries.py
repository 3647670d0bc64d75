"""Queries of the text operators, each over its whole tables, with the SQL they agree with."""

from __future__ import annotations

import math
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from recordflow.llm import (
    decontaminate,
    jaccard_join,
    license_scan,
    line_dedup,
    mixing,
    packing,
    prefix_trie,
    quality_rules,
    spelling,
    substring_dedup,
    suffix_dedup,
    token_counts,
    toxicity,
)
from recordflow.session import configure


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return line_dedup.report(_table(spark, sf, "documents"))


def op2_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard_join.report(_table(spark, sf, "documents")).drop("_print")


def op3_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    return decontaminate.report(_table(spark, sf, "documents"), _table(spark, sf, "benchmark"))


def op4_license_scan(spark: SparkSession, sf: str) -> DataFrame:
    return license_scan.scan(_table(spark, sf, "documents"))


def op5_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return substring_dedup.report(_table(spark, sf, "documents"))


def op6_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents").select("doc_id", "text")
    rules = quality_rules.fit(docs, _table(spark, sf, "labels"))
    return quality_rules.judge(docs, rules).drop("text")


def op7_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, _table(spark, sf, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id",
        (toxicity.fold("doc_id") == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op8_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    counted = token_counts.count_tokens(
        _table(spark, sf, "documents").select("doc_id", "text"),
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.PATTERN,
    )
    n_bytes = F.octet_length(F.coalesce("text", F.lit(""))).cast("long")
    return counted.select(
        "doc_id", n_bytes.alias("n_bytes"), "n_tokens", (F.col("n_tokens") > 512).alias("over_limit")
    )


def op9_suffix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return suffix_dedup.report(_table(spark, sf, "documents"))


def op10_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack(_table(spark, sf, "documents"))


def op11_mixing(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.report(mixing.mix(_table(spark, sf, "documents")))


def op12_prefix_trie(spark: SparkSession, sf: str) -> DataFrame:
    return prefix_trie.trie(_table(spark, sf, "conversations"))


def op13_spelling(spark: SparkSession, sf: str) -> DataFrame:
    return spelling.variants(spelling.count_words(_table(spark, sf, "documents"), slips=199))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_jaccard_join": op2_jaccard_join,
    "op3_decontaminate": op3_decontaminate,
    "op4_license_scan": op4_license_scan,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_quality_rules": op6_quality_rules,
    "op7_toxicity": op7_toxicity,
    "op8_token_counts": op8_token_counts,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_packing": op10_packing,
    "op11_mixing": op11_mixing,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_spelling": op13_spelling,
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

_TEMPLATES = ", ".join(
    f"({number}, '{label}', {len(found)}, {math.ceil(license_scan.THRESHOLD * len(found) - 1e-9)}, {sorted(found)})"
    for number, (label, found) in enumerate(license_scan.template_words())
)
_PHRASES = ", ".join(f"('{label}', {phrase.split()})" for phrase, label in license_scan.PHRASES.items())



def _crc_table() -> list[int]:
    """The checksum of each byte, by its rule."""
    out = []
    for c in range(256):
        for _ in range(8):
            c = (c >> 1) ^ (0xEDB88320 if c & 1 else 0)
        out.append(c)
    return out


def _crc32(code_bytes: str) -> str:
    """SQL of the unsigned crc32 of a list of bytes."""
    step = f"xor(c >> 8, {_crc_table()}[(xor(c, b) & 255) + 1])"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {code_bytes}), lambda c, b: {step}), 4294967295)"


def _utf8(text: str) -> str:
    """SQL of the bytes of a text of characters up to U+00FF."""
    codes = f"list_transform(string_split({text}, ''), lambda x: CAST(ord(x) AS BIGINT))"
    return f"flatten(list_transform({codes}, lambda x: CASE WHEN x < 128 THEN [x] ELSE [192 + (x >> 6), 128 + (x & 63)] END))"


_SIZE = r"CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT)"
# Letters beyond ASCII as single bytes, for an edit distance that counts bytes.
_BEYOND = "".join(chr(c) for c in range(0xC0, 0x100))
_SINGLE = "".join(chr(c) for c in range(33, 127) if not chr(c).islower() and chr(c) != "'")[:64]
_ROUNDS = 8


def _mixing_sql() -> str:
    """Targets by rounds (no more than a few change anything), then blocks in the permuted order."""
    rounds = ["r0 AS (SELECT tot.n AS left_words, (SELECT sum(weight) FROM src) AS w FROM tot)"]
    for k in range(1, _ROUNDS + 1):
        over = f"weight * r{k - 1}.left_words / r{k - 1}.w >= 3 * source_size"
        rounds.append(f"""r{k} AS (SELECT tot.n - coalesce(sum(CASE WHEN {over} THEN 3 * source_size END), 0) AS left_words,
    coalesce(nullif(sum(CASE WHEN {over} THEN 0 ELSE weight END), 0), any_value(r{k - 1}.w)) AS w FROM src, r{k - 1}, tot GROUP BY tot.n)""")
    return rf"""
WITH d AS (SELECT doc_id, source, substr(md5(coalesce(text, '')), 1, 16) AS print, {_SIZE} AS size FROM documents),
u AS (SELECT doc_id, source, print, size, count(*) AS copies FROM d GROUP BY ALL),
sz AS (SELECT source, CAST(sum(size * copies) AS BIGINT) AS source_size FROM u GROUP BY source),
src AS (SELECT *, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight FROM sz),
tot AS (SELECT CAST(coalesce(sum(source_size), 0) AS BIGINT) AS n FROM src),
{", ".join(rounds)},
t AS (SELECT source, source_size, least(CAST(3 * source_size AS DOUBLE), weight * left_words / w) AS target FROM src, r{_ROUNDS}),
p AS (SELECT *, CAST(round(target) AS BIGINT) AS wanted,
      CASE WHEN source_size > 0 THEN CAST(ceil(round(target) / source_size) AS BIGINT) ELSE 0 END AS passes FROM t),
c AS (SELECT u.*, unnest(range(0, copies)) AS copy FROM u),
e AS (SELECT c.*, wanted, p.source_size, unnest(range(0, passes)) AS pass FROM c JOIN p ON c.source IS NOT DISTINCT FROM p.source),
b AS (SELECT e.*, unnest(range(0, CAST(ceil(size / 512.0) AS BIGINT))) AS block FROM e),
o AS (SELECT *, least(512, size - 512 * block) AS words, md5(concat_ws(':', 11, pass, coalesce(CAST(doc_id AS VARCHAR), ''), print, copy, block)) AS h FROM b),
q AS (SELECT *, wanted - pass * source_size
      - (sum(words) OVER (PARTITION BY source, pass ORDER BY h, size ROWS UNBOUNDED PRECEDING) - words) AS more FROM o),
k AS (SELECT doc_id, source, print, size, copy, CAST(sum(least(words, more)) AS BIGINT) AS taken FROM q WHERE more > 0 GROUP BY ALL)
SELECT c.doc_id, c.size, t.source_size, t.target, coalesce(k.taken, 0) AS taken
FROM c JOIN t ON c.source IS NOT DISTINCT FROM t.source
LEFT JOIN k ON c.doc_id IS NOT DISTINCT FROM k.doc_id AND c.source IS NOT DISTINCT FROM k.source
  AND c.print = k.print AND c.size = k.size AND c.copy = k.copy
"""


ORACLES: dict[str, str] = {
    "op4_license_scan": rf"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
t AS (SELECT * FROM (VALUES {_TEMPLATES}) AS v(number, label, size, need, ws)),
b AS (SELECT doc_id, list_slice(w, 64 * k + 1, 64 * k + 128) AS block
      FROM (SELECT doc_id, w, unnest(range(0, 1 + CAST(greatest(0, ceil((len(w) - 128) / 64.0)) AS BIGINT))) AS k FROM d)),
m AS (SELECT doc_id, label, len(list_intersect(ws, block)) AS shared, size FROM b, t
      WHERE len(list_intersect(ws, block)) >= need),
p AS (SELECT * FROM (VALUES {_PHRASES}) AS v(label, parts)),
f AS (SELECT doc_id, p.label, i FROM (SELECT doc_id, w, unnest(range(0, len(w))) AS i FROM d) x, p
      WHERE w[i + 1] = parts[1] AND list_slice(w, i + 1, i + len(parts)) = parts),
fs AS (SELECT doc_id, count(*) AS n, min(i) AS a, max(i) AS z, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM f GROUP BY doc_id),
ls AS (SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
       FROM (SELECT doc_id, label FROM f UNION ALL SELECT doc_id, label FROM m) GROUP BY doc_id),
ms AS (SELECT doc_id, max(shared / size) AS best FROM m GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_base, CAST(a AS BIGINT) AS first_word,
       CAST(z AS BIGINT) AS last_word, coalesce(fs.labels, '') AS base_labels, coalesce(ls.labels, '') AS labels,
       CAST(CASE WHEN n > 0 THEN 1 ELSE coalesce(best, 0) END AS DOUBLE) AS score
FROM d LEFT JOIN fs USING (doc_id) LEFT JOIN ls USING (doc_id) LEFT JOIN ms USING (doc_id)
""",
    "op9_suffix_dedup": """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
c AS (SELECT doc_id, j, substr(h, 2000 * j + 1, 2098) AS part
      FROM (SELECT doc_id, h, unnest(range(0, (len(h) // 2 + 950) // 1000)) AS j FROM d WHERE len(h) >= 100)),
w AS (SELECT doc_id, 1000 * j + q AS p, substr(part, 2 * q + 1, 100) AS k
      FROM (SELECT doc_id, j, part, unnest(range(0, least(1000, len(part) // 2 - 49))) AS q FROM c)),
f AS (SELECT k, min(doc_id) AS first_doc FROM w GROUP BY k HAVING min(doc_id) < max(doc_id)),
hit AS (SELECT doc_id, p FROM w JOIN f USING (k) WHERE first_doc < doc_id),
mark AS (SELECT doc_id, p, CASE WHEN p - lag(p) OVER (PARTITION BY doc_id ORDER BY p) <= 50 THEN 0 ELSE 1 END AS fresh FROM hit),
num AS (SELECT doc_id, p, sum(fresh) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM mark),
run AS (SELECT doc_id, min(p) AS a, max(p) + 50 AS z FROM num GROUP BY doc_id, run),
gap AS (SELECT doc_id, a, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) AS from_byte FROM run),
cut AS (SELECT doc_id, from_byte, a FROM gap UNION ALL SELECT doc_id, max(z), NULL FROM run GROUP BY doc_id),
kept AS (SELECT doc_id, string_agg(substr(h, 2 * from_byte + 1, 2 * (coalesce(a, len(h) // 2) - from_byte)), '' ORDER BY from_byte) AS k
         FROM cut JOIN d USING (doc_id) GROUP BY doc_id),
total AS (SELECT doc_id, sum(z - a) AS n, count(*) AS runs FROM run GROUP BY doc_id)
SELECT d.doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(runs, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(k, h))) AS kept_sha256
FROM d LEFT JOIN total USING (doc_id) LEFT JOIN kept USING (doc_id)
""",
    "op3_decontaminate": rf"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
bw AS (SELECT item_id, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i, w FROM b WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, n, list_slice(w, i, i + n - 1) AS k FROM bw),
dw AS (SELECT doc_id, x.n, unnest(range(1, len(w) - x.n + 2)) AS i, w
       FROM d, (SELECT DISTINCT n FROM win) x WHERE len(w) >= x.n),
hit AS (SELECT DISTINCT doc_id, i, dw.n, item_id FROM (SELECT doc_id, i, n, list_slice(w, i, i + n - 1) AS k FROM dw) dw JOIN win USING (n, k)),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS t
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(t, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)
""",
    "op11_mixing": _mixing_sql(),
    "op12_prefix_trie": rf"""
WITH t AS (SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
      row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
        md5(octet_length(encode(coalesce(role, ''))) || ':' || coalesce(role, '') || coalesce(text, ''))) AS i
      FROM conversations WHERE conv_id IS NOT NULL),
cs AS (SELECT c, c - c % 20 AS base, {_crc32(_utf8("CAST(c AS VARCHAR)"))} % 4 AS h FROM (SELECT DISTINCT c FROM t)),
x AS (SELECT cs.c, t.i, t.role, t.text FROM cs JOIN t ON t.c = cs.base AND t.i <= cs.h
      UNION ALL SELECT cs.c, 4 + t.i, t.role, t.text FROM cs JOIN t ON t.c = cs.c AND t.i > cs.h),
s AS (SELECT c, list({{'role': role, 'text': text}} ORDER BY i) AS seq FROM x GROUP BY c),
a AS (SELECT cs.c, coalesce(seq, []) AS seq FROM cs LEFT JOIN s USING (c)),
p AS (SELECT c, seq, unnest(range(0, len(seq) + 1)) AS d FROM a),
k AS (SELECT c, d, seq[1:d] AS key, seq[1:greatest(d - 1, 0)] AS up, d = len(seq) AS whole FROM p),
n AS (SELECT d, key, any_value(up) AS up, min(c) AS conv_id, count(*) AS n,
      coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE whole), '') AS ends FROM k GROUP BY d, key),
w AS (SELECT *, CASE WHEN d = 0 THEN 0 ELSE (n - 1) * len(regexp_extract_all(key[d].text, '[^\x20\x09-\x0D]+')) END AS v FROM n),
ch AS (SELECT d - 1 AS d, up AS key, count(*) AS n_children FROM n WHERE d > 0 GROUP BY ALL),
sub AS (SELECT b.d, b.key, sum(w.v) AS saved, count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM ch WHERE ch.d = w.d AND ch.key = w.key)) AS leaves
        FROM w JOIN (SELECT d, key FROM n) b ON w.d >= b.d AND w.key[1:b.d] = b.key GROUP BY b.d, b.key)
SELECT w.conv_id, w.d AS depth, pa.conv_id AS parent_conv_id, w.n AS n_convs, CAST(coalesce(ch.n_children, 0) AS BIGINT) AS n_children,
       CAST(sub.leaves AS BIGINT) AS n_leaves, CAST(sub.saved AS BIGINT) AS saved_tokens, sha256(w.ends) AS ends_sha256
FROM w LEFT JOIN ch ON ch.d = w.d AND ch.key = w.key LEFT JOIN sub ON sub.d = w.d AND sub.key = w.key
LEFT JOIN n pa ON w.d > 0 AND pa.d = w.d - 1 AND pa.key = w.up
""",
    "op13_spelling": rf"""
WITH RECURSIVE r AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]{{6,}}')) AS run FROM documents),
l AS (SELECT id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w, count(*) AS times FROM r GROUP BY ALL),
h AS (SELECT w, times, {_crc32(_utf8("id || ':' || w"))} AS h FROM l),
g AS (SELECT CASE WHEN h % 199 = 0 THEN substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word, times FROM h),
v AS (SELECT word, CAST(sum(times) AS BIGINT) AS n, length(word) AS size, translate(word, '{_BEYOND}', '{_SINGLE}') AS plain
      FROM g WHERE length(word) >= 6 GROUP BY word HAVING sum(times) >= 5),
e AS (SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM v a JOIN v b ON b.size = a.size WHERE levenshtein(a.plain, b.plain) = 1
      UNION ALL SELECT a.word, a.n, b.word, b.n FROM v a JOIN v b ON b.size = a.size + 1 WHERE levenshtein(a.plain, b.plain) = 1
      UNION ALL SELECT a.word, a.n, b.word, b.n FROM v a JOIN v b ON b.size = a.size - 1 WHERE levenshtein(a.plain, b.plain) = 1),
best AS (SELECT word, count(*) AS n_near, list({{'n': -other_n, 'w': other}} ORDER BY -other_n, other)[1] AS top FROM e GROUP BY word),
f AS (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN -top.n >= 5 * v.n THEN top.w END AS form,
      CASE WHEN -top.n >= 5 * v.n THEN -top.n END AS form_n FROM v LEFT JOIN best USING (word)),
way AS (SELECT word, word AS here, 0 AS step FROM f UNION ALL SELECT way.word, f.form, step + 1 FROM way JOIN f ON f.word = way.here WHERE f.form IS NOT NULL)
SELECT word, form, (SELECT arg_max(here, step) FROM way WHERE way.word = f.word) AS root, n, CAST(n_near AS BIGINT) AS n_near, CAST(form_n AS BIGINT) AS form_n FROM f
""",
}
