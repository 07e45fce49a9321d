"""Registered queries of the numbered operators over the benchmark tables, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugemill.llm import bpe_reuse, decontaminate, digest_index, divergence, filter_audit, langid_crf, near_dup, pii, quality_gam, quality_rules, secret_scan, token_files, warc


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_gam.quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op2_language_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid_crf.languages(_table(spark, sf_dir, "documents"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
    )


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.quality_rules(_table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_file_round_trip(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(_table(spark, sf_dir, "documents"), width=4)


def op7_bpe_reuse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_reuse.encoding_digests(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_counts(_table(spark, sf_dir, "documents"))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_spans(_table(spark, sf_dir, "documents"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    kind = dict(pages.dtypes)["page_id"]
    back = warc.archive_round_trip(pages)
    return back.select(F.col("page_id").try_cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to"))


def op11_exact_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest_index.exact_duplicates(_table(spark, sf_dir, "documents"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.filter_audit(spark, f"{sf_dir}/documents.parquet", _table(spark, sf_dir, "labels"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.source_divergence(_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_quality_gam": op1_quality_gam,
    "op2_language_crf": op2_language_crf,
    "op3_decontamination": op3_decontamination,
    "op4_quality_rules": op4_quality_rules,
    "op5_token_files": op5_token_files,
    "op6_near_duplicates": op6_near_duplicates,
    "op7_bpe_reuse": op7_bpe_reuse,
    "op8_pii": op8_pii,
    "op9_secret_scan": op9_secret_scan,
    "op10_warc": op10_warc,
    "op11_exact_duplicates": op11_exact_duplicates,
    "op12_filter_audit": op12_filter_audit,
    "op13_source_divergence": op13_source_divergence,
}


# --- SQL --------------------------------------------------------------------------------------------------------

_BLANK_WORDS = r"regexp_extract_all(t, '[^\x20\x09-\x0D]+')"
_LOWERED = f"translate(coalesce(text, ''), '{decontaminate.UPPER}', '{decontaminate.LOWER}')"


def _rules_sql() -> str:
    """The threshold table as one SQL condition."""
    parts = []
    for r in quality_rules.RULES:
        bounds = [f"1e0 * {r.numerator} / nullif({r.denominator}, 0) {op} {limit}" for op, limit in ((">=", r.low), ("<=", r.high)) if abs(limit) != float("inf")]
        parts += [f"coalesce({b}, false)" for b in bounds]
    return " AND ".join(parts)


def _stop_words_sql() -> str:
    words = dict.fromkeys([*quality_rules.STOP_WORDS, *(w.capitalize() for w in quality_rules.STOP_WORDS)])
    return ", ".join(f"'{w}'" for w in words)


def _audit_sql() -> str:
    """Rows per part and mask against a table of all orders and steps; every figure is counted from the masks."""
    steps = ", ".join(f"('{order}', {step}, {1 << place}, {before})" for order, step, place, before, _ in filter_audit.orders())
    return rf"""WITH
d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, {_BLANK_WORDS} AS ws FROM d),
m AS (SELECT part, w.doc_id IN (SELECT doc_id FROM labels WHERE quality = 1) AS good, w.doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1) AS toxic,
  CASE WHEN len(ws) < 200 THEN 1 ELSE 0 END + CASE WHEN 100 * len(list_distinct(ws)) < 50 * len(ws) THEN 2 ELSE 0 END
  + CASE WHEN 100 * len(regexp_extract_all(t, '[A-Z]')) > 2 * length(t) THEN 4 ELSE 0 END + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
  + CASE WHEN min(doc_id) OVER (PARTITION BY t) < doc_id THEN 16 ELSE 0 END AS mask FROM w),
counts AS (SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS g, count(*) FILTER (toxic) AS x FROM m GROUP BY part, mask),
steps(filter_order, step, own, before) AS (VALUES {steps}),
figures AS (SELECT part, filter_order, step, own, sum(CASE WHEN mask & (own | before) = 0 THEN n ELSE 0 END) AS kept,
  sum(CASE WHEN mask & before = 0 AND mask & own > 0 THEN n ELSE 0 END) AS removed, sum(CASE WHEN mask & before > 0 AND mask & own > 0 THEN n ELSE 0 END) AS redundant,
  sum(CASE WHEN mask = own THEN n ELSE 0 END) AS unique_fails, sum(CASE WHEN mask & before = 0 AND mask & own > 0 THEN g ELSE 0 END) AS good_lost,
  sum(CASE WHEN mask & before = 0 AND mask & own > 0 THEN x ELSE 0 END) AS toxic_lost FROM counts, steps GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
  CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley FROM figures"""


ORACLE: dict[str, str] = {
    "op3_decontamination": rf"""WITH
dw AS (SELECT doc_id, regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
iw AS (SELECT item_id, ws, least(13, len(ws)) AS n FROM (
  SELECT item_id, regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark) WHERE len(ws) > 0),
item_windows AS (SELECT DISTINCT item_id, n, unnest(list_transform(range(1, len(ws) - n + 2), lambda i: array_to_string(ws[i:i + n - 1], ' '))) AS g FROM iw),
widths AS (SELECT DISTINCT n FROM item_windows),
doc_windows AS (SELECT doc_id, n, unnest(list_transform(range(1, len(ws) - n + 2), lambda i: {{'i': i, 'g': array_to_string(ws[i:i + n - 1], ' ')}})) AS s FROM dw, widths),
hits AS (SELECT doc_id, s.i AS i, d.n, item_id FROM doc_windows d JOIN item_windows w ON s.g = w.g AND d.n = w.n),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, array_to_string(list_sort(list(DISTINCT CAST(item_id AS VARCHAR))), ',') AS ids FROM hits GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit > 0 AND 20 * n_hit >= len(ws), false) AS contaminated
FROM dw LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op4_quality_rules": rf"""WITH
d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, {_BLANK_WORDS} AS ws, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
windows AS (SELECT doc_id, unnest(list_transform(range(1, len(ws) - 1), lambda i: {{'i': i, 'g': ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]}})) AS s FROM w),
found AS (SELECT doc_id, s.i AS i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, s.g) > 1),
covered AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM found, range(3) r(j) GROUP BY doc_id),
m AS (SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
  CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
  coalesce(n, 0) AS n_repeat_words, len(regexp_extract_all(t, '[!?]')) AS n_marks, len(ls) AS n_lines,
  len(list_filter(ws, lambda x: x IN ({_stop_words_sql()}))) AS n_stop_words,
  len(list_filter(ls, lambda x: regexp_matches(ltrim(x), '^[-*•]'))) AS n_bullet_lines,
  len(list_filter(ls, lambda x: regexp_matches(rtrim(x), '(\.\.\.|…)$'))) AS n_cut_lines
  FROM w LEFT JOIN covered USING (doc_id)),
judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND {_rules_sql()} AS kept FROM judged""",
    "op6_near_duplicates": rf"""WITH RECURSIVE
w AS (SELECT doc_id, {_BLANK_WORDS} AS ws FROM (SELECT doc_id, {_LOWERED} AS t FROM documents)),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 4 THEN list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' '))
  WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] END) AS g FROM w),
sizes AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM shared JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * c >= 80 * (p.n + q.n - c)),
reach AS (SELECT doc_id, doc_id AS other FROM documents UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other),
named AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept FROM named LEFT JOIN sizes USING (doc_id)""",
    "op11_exact_duplicates": """SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC) = 1 AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))""",
    "op12_filter_audit": _audit_sql(),
    "op13_source_divergence": rf"""WITH
d AS (SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, {_LOWERED} AS t FROM documents),
w AS (SELECT lang, source, row_number() OVER () AS row, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS ln FROM (SELECT lang, term, row, count(*) AS c FROM w GROUP BY ALL) GROUP BY ALL HAVING count(*) >= 10),
g AS (SELECT DISTINCT lang, source FROM d),
n AS (SELECT lang, source, term, count(*) AS n FROM w GROUP BY ALL),
lang_totals AS (SELECT lang, term, sum(n) AS ln FROM n SEMI JOIN kept USING (lang, term) GROUP BY ALL),
cells AS (SELECT g.lang, g.source, k.term, coalesce(n.n, 0) AS n, k.ln, count(*) OVER (PARTITION BY g.lang, g.source) AS v
  FROM g JOIN lang_totals k USING (lang) LEFT JOIN n USING (lang, source, term)),
totals AS (SELECT *, sum(n) OVER (PARTITION BY lang, source) AS total, sum(ln) OVER (PARTITION BY lang, source) AS lang_total FROM cells),
p AS (SELECT lang, source, term, n, CAST(1 + 1000000000 * CAST(n + 2 AS HUGEINT) // CAST(total + 2 * v AS HUGEINT) AS HUGEINT) AS p,
  CAST(1 + 1000000000 * CAST(ln + 2 AS HUGEINT) // CAST(lang_total + 2 * v AS HUGEINT) AS HUGEINT) AS q FROM totals),
prices AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN prices x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // (p + q) AS value FROM p WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR rank <= 10""",
}
