"""Registered queries of the training-data operators and their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barmarts.llm import bpe, decontaminate, langid, licenses, line_dedup, minhash, quality, repair, sharding, substrings, tokalign, toxicity, url_lm
from barmarts.llm.common import id_fold
from barmarts.sources.tables import read_table

RANK_FILE = "byte_bpe_multi_50k.tiktoken"
SHARDS = [f"shard-{k:03d}" for k in range(64)]


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    fold = id_fold(F.col("doc_id"), 3)
    model = toxicity.fit(docs, labels, fold != 1)
    return toxicity.score(docs, model).select(
        "doc_id", F.coalesce(fold == 1, F.lit(False)).alias("held_out"), "score",
        F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"))


URL_RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    return url_lm.judge(pages, URL_RULES, whole=True).select("page_id", "host", "path", "rule", "verdict")


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")
    found = decontaminate.with_matches(docs.select("doc_id", "text"), items)
    return found.select("doc_id", F.inline("matches"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(read_table(spark, sf_dir, "documents").select("doc_id"), SHARDS)


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = bpe.read_ranks(public_tokenizers.path(RANK_FILE))
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    ids = bpe.encode(docs, ranks, public_tokenizers.PATTERN).select("doc_id", "ids")
    return bpe.digests(bpe.decode(ids, ranks)).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    fold = id_fold(F.col("doc_id"), 5)
    model = langid.fit(docs, fold != 0)
    return langid.predict(docs, model).select(
        "doc_id", F.coalesce(fold == 0, F.lit(False)).alias("held_out"), "lang_pred", "score", "accepted")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(read_table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_dedup(read_table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "text", "n_lines", "n_dropped")


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read_table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def op10_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_classes(read_table(spark, sf_dir, "documents"), width=2, threshold=80).select(
        "doc_id", "n_shingles", "component_id", (F.col("doc_id").isNull() | (F.col("doc_id") == F.col("component_id"))).alias("kept"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return repair.with_digest(repair.repair(repair.damage(rows))).select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = tokalign.read_files(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.PATTERN)
    return tokalign.score_links(read_table(spark, sf_dir, "documents").select("doc_id", "text"), files)


def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.substring_dedup(read_table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_toxicity, op2_url_filter, op3_decontamination, op4_sharding, op5_bpe, op6_language_id, op7_quality_rules, op8_line_dedup,
        op9_license_scan, op10_minhash_dedup, op11_conversation_repair, op12_token_alignment, op13_substring_dedup)}


OP7_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT rid, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
win AS (SELECT rid, i, words[i:i + 2] AS win FROM (SELECT rid, words, unnest(range(1, len(words) - 1)) AS i FROM w)),
twice AS (SELECT rid, i FROM win QUALIFY count(*) OVER (PARTITION BY rid, win) > 1),
rep AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY rid),
c AS (SELECT doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
             length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
             len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
             coalesce(rep.n, 0) AS n_repeat_words, len(list_distinct(words)) AS n_distinct
      FROM w LEFT JOIN rep USING (rid)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM c)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 100 * n_distinct < 2 * n_words OR 100 * n_dup_lines > 40 * n_lines OR word_chars < 2 * n_words
            OR word_chars > 30 * n_words OR 100 * n_symbols > 10 * n_words) AS kept
FROM b
"""

OP8_SQL = r"""
WITH l AS (SELECT doc_id, no, raw, trim(raw, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS line
           FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS raw,
                        unnest(range(0, len(string_split(text, chr(10))))) AS no FROM documents)),
d AS (SELECT line, min((doc_id, no)) AS first, string_split(line, ' ') AS w FROM l WHERE line <> '' GROUP BY line),
v AS (SELECT line, first, len(w) AS n, cut, list_concat(w[:cut - 1], w[cut + 1:]) AS rest
      FROM (SELECT line, first, w, unnest(range(1, len(w) + 1)) AS cut FROM d WHERE len(w) >= 10)),
same AS (SELECT rest, cut, min(first) AS w FROM v GROUP BY rest, cut),
longer AS (SELECT rest, min(first) AS w FROM v GROUP BY rest),
near AS (SELECT v.line FROM v JOIN same USING (rest, cut) WHERE same.w < v.first
         UNION SELECT v.line FROM v JOIN d ON d.w = v.rest WHERE len(d.w) >= 10 AND d.first < v.first
         UNION SELECT d.line FROM d JOIN longer ON longer.rest = d.w WHERE len(d.w) >= 10 AND longer.w < d.first),
judged AS (SELECT l.doc_id, l.no, l.raw, l.line <> '' AND ((l.doc_id, l.no) <> d.first OR near.line IS NOT NULL) AS dropped
           FROM l LEFT JOIN d ON d.line = l.line LEFT JOIN near ON near.line = l.line),
out AS (SELECT doc_id, string_agg(raw, chr(10) ORDER BY no) FILTER (WHERE NOT dropped) AS text,
               count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped FROM judged GROUP BY doc_id)
SELECT doc_id, coalesce(out.text, CASE WHEN documents.text IS NOT NULL THEN '' END) AS text,
       coalesce(n_lines, 0) AS n_lines, coalesce(n_dropped, 0) AS n_dropped FROM documents LEFT JOIN out USING (doc_id)
"""

OP10_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 2 THEN list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])
                                         ELSE w END) AS sh FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
i AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS i FROM s x JOIN s y ON x.sh = y.sh AND x.doc_id < y.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM i JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * i >= 80 * (p.n + q.n - i)),
sym AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
reach AS (SELECT doc_id AS node, doc_id AS seen FROM d UNION SELECT reach.node, sym.b FROM reach JOIN sym ON sym.a = reach.seen)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT node AS doc_id, min(seen) AS component_id FROM reach GROUP BY node) c USING (doc_id)
"""


def _op9_sql() -> str:
    def text(value: str) -> str:
        return "'" + value.replace("'", "''") + "'"
    # words are joined by two blanks here, so that a match can take one on each side
    rows = ", ".join(f"({r.priority}, {text(licenses.key_literal(r))}, {text(' (?:' + r.pattern.replace(' ?', '(?:  )?').replace('[^ ]', '[^~]').replace(' ', '  ').replace('[^~]', '[^ ]') + ') ')}, {text(r.label)}, {r.confidence})"
                     for r in licenses.rules())
    base = ", ".join(f"({text(' ' + p.replace(' ', '  ') + ' ')}, {text(label)})" for p, label in licenses.BASE)
    spaces = "(length({0}) - length(replace({0}, ' ', '')))"
    found = """SELECT rid, label, {more} unnest(range(1, len(m) + 1)) AS k, m, string_split_regex(c2, pattern) AS p
               FROM (SELECT *, regexp_extract_all(c2, pattern) AS m FROM {source}) WHERE len(m) > 0"""
    start = (f"(list_sum(list_transform(p[:k], lambda x: {spaces.format('x')})) + coalesce(list_sum(list_transform(m[:k - 1], lambda x: {spaces.format('x')})), 0) + 1) // 2 - 1")
    size = f"({spaces.format('m[k]')} - 2) // 2 + 1"
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_replace(' ' || translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') || ' ',
        '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+', ' ', 'g') AS c FROM documents),
g AS (SELECT rid, c, replace(c, ' ', '  ') AS c2 FROM d),
rules(priority, keyword, pattern, label, confidence) AS (VALUES {rows}),
base(pattern, label) AS (VALUES {base}),
b AS (SELECT rid, label, {start} AS start FROM ({found.format(more='', source='(SELECT g.*, base.* FROM g, base)')})),
h AS (SELECT rid, label, priority, confidence, {start} AS start, {size} AS size
      FROM ({found.format(more='priority, confidence,', source='(SELECT g.*, rules.* FROM g JOIN rules ON contains(g.c, rules.keyword))')})),
kept AS (SELECT rid, label, confidence FROM h
         QUALIFY coalesce(max(start + size) OVER (PARTITION BY rid ORDER BY start, start + size DESC, priority ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) < start + size),
bs AS (SELECT rid, count(*) AS n_base, min(start) AS first_word, max(start) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM b GROUP BY rid),
ls AS (SELECT rid, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM (SELECT rid, label FROM b UNION SELECT rid, label FROM kept) GROUP BY rid),
sc AS (SELECT rid, max(confidence) AS score FROM kept GROUP BY rid)
SELECT doc_id, {spaces.format('c')} - 1 AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels,
       coalesce(labels, '') AS labels, coalesce(score, CASE WHEN n_base > 0 THEN 0.6 END, 0.0)::DOUBLE AS score
FROM d LEFT JOIN bs USING (rid) LEFT JOIN ls USING (rid) LEFT JOIN sc USING (rid)
"""


def llm_sql() -> dict[str, str]:
    return {"op7_quality_rules": OP7_SQL, "op8_line_dedup": OP8_SQL, "op9_license_scan": _op9_sql(), "op10_minhash_dedup": OP10_SQL}
