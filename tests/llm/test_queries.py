"""Registered text queries over the smallest tables against plain versions, or held-out accuracy for models."""

from pathlib import Path

import pytest

import brute
from gaugemill.llm.queries import ORACLE, QUERIES

SMALL = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SMALL).is_dir(), reason="benchmark tables are not there")


def rows_of(spark, table, *columns):
    return [tuple(r) for r in spark.read.parquet(f"{SMALL}/{table}.parquet").select(*columns).collect()]


def got(spark, name, *columns):
    return sorted(tuple(r) for r in QUERIES[name](spark, SMALL).select(*columns).collect())


@pytest.fixture(scope="module")
def texts(spark):
    return sorted(rows_of(spark, "documents", "doc_id", "text"))


def test_contamination(spark, texts):
    want = brute.contamination(texts, rows_of(spark, "benchmark", "item_id", "text"))
    assert got(spark, "op3_decontamination", "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated") == want
    assert any(w[5] for w in want)


def test_quality_rules(spark, texts):
    columns = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert got(spark, "op4_quality_rules", *columns) == brute.quality_measures(texts)


def test_quality_rules_agree_with_labels(spark):
    kept = dict(got(spark, "op4_quality_rules", "doc_id", "kept"))
    labels = rows_of(spark, "labels", "doc_id", "quality")
    good = [kept[d] for d, q in labels if q == 1]
    assert sum(good) >= 0.8 * len(good)


def test_token_files(spark, texts):
    assert got(spark, "op5_token_files", "doc_id", "start", "n_tokens", "ids_crc32") == brute.token_files(texts)


def test_near_duplicates(spark, texts):
    assert got(spark, "op6_near_duplicates", "doc_id", "n_shingles", "component_id", "kept") == brute.near_duplicates(texts, 4)


def test_encodings(spark, texts):
    assert got(spark, "op7_bpe_reuse", "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == brute.encodings(texts)


def test_personal_data(spark, texts):
    assert got(spark, "op8_pii", "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256") == brute.personal_data(texts)


def test_secrets(spark, texts):
    assert got(spark, "op9_secret_scan", "doc_id", "n_assign", "n_access", "n_hex", "base_sha256") == brute.secrets(texts)


def test_archives(spark):
    want = sorted(brute.archives(rows_of(spark, "pages", "page_id", "html")))
    assert got(spark, "op10_warc", "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to") == want


def test_quality_model_on_held_out_rows(spark):
    scores = {d: (h, s) for d, h, s in got(spark, "op1_quality_gam", "doc_id", "held_out", "score")}
    labels = [(scores[d][1], q) for d, q in rows_of(spark, "labels", "doc_id", "quality") if scores[d][0]]
    pairs = [(a > b) + 0.5 * (a == b) for a, p in labels for b, q in labels if p > q]
    assert pairs and sum(pairs) / len(pairs) > 0.9


def test_language_on_held_out_rows(spark):
    found = {d: (h, x) for d, h, x in got(spark, "op2_language_crf", "doc_id", "held_out", "lang_pred")}
    held = [(found[d][1], x) for d, x in rows_of(spark, "documents", "doc_id", "lang") if found[d][0] and x]
    assert held and sum(a == b for a, b in held) >= 0.95 * len(held)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql(spark, name):
    from check_oracle import compare, connect

    assert compare(QUERIES[name](spark, SMALL).toPandas(), connect(SMALL).execute(ORACLE[name]).fetchdf()).startswith("ok")


def test_pipeline(spark, texts):
    import corpus_pipeline

    out = corpus_pipeline.run(spark, SMALL)
    rows = {r["doc_id"]: r for r in out.collect()}
    near = {d: keep for d, _, _, keep in brute.near_duplicates(texts, 5)}
    bad = {r[0] for r in brute.contamination(texts, rows_of(spark, "benchmark", "item_id", "text")) if r[5]}
    assert set(rows) == {d for d, _ in texts if near[d] and d not in bad}
    assert out.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"]
    want = brute.encodings([(d, rows[d]["text"]) for d in sorted(rows)])
    assert [(d, len(rows[d]["ids"])) for d in sorted(rows)] == [w[:2] for w in want]
