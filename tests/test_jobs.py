"""Monitoring from paths, reports that are repeated, and requests answered or refused as a whole."""

import json
from pathlib import Path

import pytest
from conftest import house_row
from pyspark.sql import functions as F

from gaugemill.contracts import FULL_ROW_RULES, HOUSE, MINIMAL_DEFAULTS, MINIMAL_ROW_RULES
from gaugemill.operators.constraints import judge_requests
from gaugemill.plans.monitoring import monitoring_job
from gaugemill.plans.scoring import predict_requests
from gaugemill.sources.readers import read_all
from gaugemill.sources.reports import read_reports, report_summary, write_report
from gaugemill.sources.writers import write_rows


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    """Raw CSV tables of houses in two areas, and of what was predicted for them."""
    from conftest import HOUSE_SCHEMA
    from gaugemill.contracts import DEMOGRAPHIC_COLUMNS

    base = str(tmp_path_factory.mktemp("raw"))
    names = [c.split()[0] for c in HOUSE_SCHEMA.split(", ")]
    rows = [house_row(id=i, price=1e5 + 1000.0 * i, sqft_living=800.0 + 10 * i, lat=47 + i / 300, zipcode="98178" if i % 2 else "98001") for i in range(300)]
    sold = spark.createDataFrame([tuple(r[n] for n in names) for r in rows], HOUSE_SCHEMA)
    zips = spark.createDataFrame(
        [(k, *(float(i + j) for i in range(len(DEMOGRAPHIC_COLUMNS)))) for j, k in enumerate(("98178", "98001"))],
        "zipcode string, " + ", ".join(f"{c} double" for c in DEMOGRAPHIC_COLUMNS),
    )
    write_rows(sold, f"{base}/kc_house_data.csv")
    write_rows(zips, f"{base}/zipcode_demographics.csv")
    write_rows(sold.where("id >= 100").drop("id", "date", "price"), f"{base}/future_unseen_examples.csv")
    write_rows(sold.select(F.col("price").alias("actual_price"), (F.col("price") + 5).alias("predicted_price")), f"{base}/scored.csv")
    return base


def test_raw_tables_have_declared_types(spark, raw):
    found = read_all(spark, raw)
    assert dict(found["sales"].dtypes)["zipcode"] == "string" and dict(found["unseen"].dtypes)["sqft_living"] == "double"
    assert [found[n].count() for n in ("sales", "demographics", "unseen")] == [300, 2, 200]


def test_monitoring_job_writes_one_document_per_run(spark, raw, tmp_path):
    reports = f"{tmp_path}/reports"
    first = monitoring_job(spark, raw, reports, "r1", HOUSE, drift_columns=["sqft_living", "lat"], stats=f"{tmp_path}/stats.csv").first()
    assert first["quality"]["ok"] and first["data_drift"]["summary"]["n_features_evaluated"] == 2
    assert first["prediction_drift"]["reason"] == "predictions_file_missing" and first["prediction_drift"]["skipped"]
    assert first["model_performance"]["reason"] == "no_labels_file_configured"
    stats = spark.read.option("header", True).csv(f"{tmp_path}/stats.csv").first()
    assert stats["column"] == "price" and float(stats["mean"]) == 249500.0

    scored = f"{raw}/scored.csv"
    monitoring_job(spark, raw, reports, "r2", HOUSE, predictions=f"{raw}/none.csv", labels=scored, drift_columns=["lat"])
    again = monitoring_job(spark, raw, reports, "r2", HOUSE, predictions=scored, labels=scored, drift_columns=["lat"])
    assert again.count() == 1
    row = again.first()
    assert not row["prediction_drift"]["skipped"] and row["prediction_drift"]["n_current"] == 300
    assert row["model_performance"]["status"] == "ok" and row["model_performance"]["mae"] == 5.0
    flat = {r["run_id"]: r for r in report_summary(read_reports(spark, reports)).collect()}
    assert set(flat) == {"r1", "r2"} and flat["r2"]["mae"] == 5.0 and flat["r1"]["mae"] is None


def test_report_of_failed_quality_skips_drift(spark, raw, tmp_path):
    bad = f"{tmp_path}/raw"
    for name in ("zipcode_demographics.csv", "future_unseen_examples.csv"):
        write_rows(spark.read.option("header", True).csv(f"{raw}/{name}"), f"{bad}/{name}")
    write_rows(spark.read.option("header", True).csv(f"{raw}/kc_house_data.csv").withColumn("price", F.lit("x")), f"{bad}/kc_house_data.csv")
    row = monitoring_job(spark, bad, f"{tmp_path}/reports", "r", HOUSE).first()
    assert not row["quality"]["ok"] and row["quality"]["errors"] and row["data_drift"]["reason"] == "upstream_quality_failed"


def test_write_that_fails_keeps_the_earlier_report(spark, tmp_path):
    base = f"{tmp_path}/reports"
    report = spark.range(1).select(F.lit("1.0").alias("report_version"))
    write_report(report, base, "r")
    with pytest.raises(Exception, match="stop here"):
        write_report(report.withColumn("report_version", F.raise_error(F.lit("stop here")).cast("string")), base, "r")
    assert read_reports(spark, base, "r").first()["report_version"] == "1.0"


def test_text_that_is_no_report_raises(spark, tmp_path):
    folder = Path(tmp_path, "reports", "run_id=r")
    folder.mkdir(parents=True)
    (folder / "a.json").write_text(json.dumps({"quality": 3}))
    with pytest.raises(Exception, match="(?i)malformed|parse|FAILFAST"):
        read_reports(spark, f"{tmp_path}/reports").collect()


class Echo:
    """A model that predicts the living area."""

    def transform(self, features):
        return features.withColumn("prediction", F.col("sqft_living").cast("double"))


INFO = {"model_name": "m", "model_version": "3", "model_source": "registry"}


@pytest.fixture
def asked(houses):
    good, bad = {"id": 1, "sqft_living": 100.0}, {"id": 2, "grade": 14, "yr_built": None}
    rows = [("good", good), ("good", good), ("mixed", good), ("mixed", bad), *[("many", good)] * 501, *[("full", good)] * 500, (None, good)]
    frame = houses(*(c for _, c in rows)).drop("id", "date", "price")
    named = frame.sparkSession.createDataFrame([(i, r) for i, (r, _) in enumerate(rows)], "at long, request string")
    numbered = frame.rdd.zipWithIndex().map(lambda p: (*p[0], p[1])).toDF(frame.schema.add("at", "long"))
    return numbered.join(named, "at")


def test_requests_are_answered_or_refused_as_a_whole(spark, asked, zips):
    known = spark.createDataFrame([("good",), ("silent",)], "request string")
    answers, verdicts = predict_requests(asked, "request", zips("98178"), Echo(), HOUSE, INFO, keep=["at"], expected=known)
    got = {r["request"]: r for r in verdicts.collect()}
    assert {k: (r["n_rows"], r["n_bad"], r["reason"]) for k, r in got.items()} == {
        "good": (2, 0, None), "mixed": (2, 1, "1 rows break a rule"), "many": (501, 0, "501 rows, at most 500 allowed"), "full": (500, 0, None),
        None: (1, 0, None), "silent": (0, 0, "no rows"),
    }
    assert got["mixed"]["broken"] == ["grade", "yr_built"] and got["good"]["broken"] == []
    sizes = {r["request"]: r["count"] for r in answers.groupBy("request").count().collect()}
    assert sizes == {"good": 2, "full": 500, None: 1}
    row = answers.where("request = 'good'").first()
    assert row["predicted_price"] == 100.0 and row["model_version"] == "3" and row["at"] in (0, 1)


def test_minimal_requests_are_completed_and_judged_again(spark, zips):
    minimal = [r.column for r in MINIMAL_ROW_RULES]
    rows = [house_row(sqft_living=90.0), house_row(sqft_lot=-1.0), house_row()]
    kinds = ", ".join(f"{c} {'string' if c == 'zipcode' else 'double'}" for c in minimal)
    frame = spark.createDataFrame([(*(r[c] if c == "zipcode" else float(r[c]) for c in minimal), q) for r, q in zip(rows, "aab", strict=True)], kinds + ", request string")
    answers, verdicts = predict_requests(
        frame, "request", zips("98178"), Echo(), HOUSE, INFO, MINIMAL_ROW_RULES, defaults=MINIMAL_DEFAULTS
    )
    assert {r["request"]: r["reason"] for r in verdicts.collect()} == {"a": "1 rows break a rule", "b": None}
    assert [r["request"] for r in answers.collect()] == ["b"]
    late = {**MINIMAL_DEFAULTS, "waterfront": -1}
    answers, verdicts = predict_requests(frame.where("request = 'b'"), "request", zips("98178"), Echo(), HOUSE, INFO, MINIMAL_ROW_RULES, defaults=late)
    assert answers.count() == 0 and verdicts.first()["broken"] == ["waterfront"]


def test_no_requests(spark, asked):
    rows, verdicts = judge_requests(asked.limit(0), "request", FULL_ROW_RULES, 500, ["at"])
    assert rows.count() == 0 and verdicts.count() == 0


def test_monitoring_job_parses_its_tables_once(spark, raw, tmp_path, monkeypatch):
    from gaugemill.plans import monitoring

    parsed = {name: spark.sparkContext.accumulator(0) for name in ("sales", "unseen")}

    def counting(df, seen):
        def count(batches):
            for batch in batches:
                seen.add(batch.num_rows)
                yield batch

        return df.mapInArrow(count, df.schema)

    tables = read_all(spark, raw)
    counted = tables | {name: counting(tables[name], seen) for name, seen in parsed.items()}
    monkeypatch.setattr(monitoring, "read_all", lambda *_: counted)
    row = monitoring_job(spark, raw, f"{tmp_path}/reports", "r1", HOUSE, drift_columns=["lat"]).first()
    assert row["quality"]["n_fact_rows"] == 300 and row["data_drift"]["features"][0]["n_current"] == 200
    assert {name: seen.value for name, seen in parsed.items()} == {"sales": 300, "unseen": 200}
