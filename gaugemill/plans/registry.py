"""Run log and model versions as append-only tables."""

from __future__ import annotations

import json
import logging
import uuid
from collections.abc import Mapping
from datetime import UTC, datetime
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugemill.plans.models import load_model
from gaugemill.sources.readers import path_exists
from gaugemill.sources.writers import create_once

log = logging.getLogger(__name__)

RUN_SCHEMA = (
    "run_id string, parent_run_id string, experiment string, key string, params map<string,string>, "
    "metrics map<string,double>, model_path string, logged_at timestamp"
)
VERSION_SCHEMA = (
    "name string, version int, path string, run_id string, metrics map<string,double>, "
    "tags map<string,string>, registered_at timestamp"
)


def new_run_id() -> str:
    return uuid.uuid4().hex


def log_run(
    spark: SparkSession, base: str, experiment: str, key: str, params: Mapping, metrics: Mapping,
    parent: str | None = None, run_id: str | None = None, model_path: str | None = None,
) -> str:
    """Append one run; returns its id."""
    run_id = run_id or new_run_id()
    numbers = {k: float(v) for k, v in metrics.items() if v is not None}
    texts = {k: v if isinstance(v, str) else json.dumps(v) for k, v in params.items()}
    row = (run_id, parent, experiment, key, texts, numbers, model_path, datetime.now(UTC))
    spark.createDataFrame([row], RUN_SCHEMA).write.mode("append").parquet(f"{base}/runs")
    return run_id


def runs(spark: SparkSession, base: str) -> DataFrame:
    return spark.read.schema(RUN_SCHEMA).parquet(f"{base}/runs")


def versions(spark: SparkSession, base: str) -> DataFrame:
    return spark.read.schema(VERSION_SCHEMA).parquet(f"{base}/model_versions")


def latest_versions(table: DataFrame) -> DataFrame:
    """The row with the highest version per model name."""
    return table.groupBy("name").agg(F.max_by(F.struct(*table.columns), "version").alias("v")).select("v.*")


def last_version(spark: SparkSession, base: str, name: str) -> int:
    """The highest version of ``name`` in the table, 0 without any."""
    if not path_exists(spark, f"{base}/model_versions"):
        return 0
    return versions(spark, base).filter(F.col("name") == name).agg(F.max("version")).first()[0] or 0


def claim_version(spark: SparkSession, base: str, name: str, after: int) -> int:
    """The first version above ``after`` that nobody has claimed, now claimed.

    A claim is a file that can be created once; a file system on which creating is exclusive (HDFS, for one) gives a number
    to one writer only, however many read the table at the same time. A writer that fails later leaves a gap.
    """
    folder = f"{base}/model_claims/{quote(name, safe='')}"
    version = after + 1
    while not create_once(spark, f"{folder}/{version}"):
        version += 1
    return version


def register_model(
    spark: SparkSession, base: str, name: str, path: str, run_id: str | None = None,
    metrics: Mapping | None = None, tags: Mapping[str, str] | None = None,
) -> int | None:
    """Append the next version of ``name``; writers at the same time get numbers of their own. A failure is only logged."""
    try:
        version = claim_version(spark, base, name, last_version(spark, base, name))
        numbers = {k: float(v) for k, v in (metrics or {}).items() if v is not None}
        row = (name, version, path, run_id, numbers, dict(tags or {}), datetime.now(UTC))
        spark.createDataFrame([row], VERSION_SCHEMA).write.mode("append").parquet(f"{base}/model_versions")
        return version
    except Exception as problem:  # registration must not fail a finished training
        log.warning("model not registered: %s", problem)
        return None


def tag_version(spark: SparkSession, base: str, name: str, version: int, tags: Mapping[str, str]) -> None:
    """Append a tag row for a version; readers merge them with :func:`version_tags`."""
    rows = [(name, version, k, v, datetime.now(UTC)) for k, v in tags.items()]
    schema = "name string, version int, tag string, value string, tagged_at timestamp"
    spark.createDataFrame(rows, schema).write.mode("append").parquet(f"{base}/version_tags")


def version_tags(spark: SparkSession, base: str) -> DataFrame:
    """``(name, version, tag, value)`` with the last value given to each tag."""
    table = spark.read.parquet(f"{base}/version_tags")
    return table.groupBy("name", "version", "tag").agg(F.max_by("value", "tagged_at").alias("value"))


def resolve_model(spark: SparkSession, base: str | None, name: str, local_path: str | None = None):
    """``(model, info)``: the latest registered version, else the model at ``local_path``, else an error.

    ``info`` tells ``model_name``, ``model_version`` and ``model_source``.
    """
    if base is not None and path_exists(spark, f"{base}/model_versions"):
        try:
            found = latest_versions(versions(spark, base).filter(F.col("name") == name)).first()
            if found is not None:
                info = {"model_name": name, "model_version": str(found["version"]), "model_source": "registry"}
                return load_model(spark, found["path"]), info
        except Exception as problem:
            log.warning("registered model not readable, trying the local one: %s", problem)
    if local_path is None or not path_exists(spark, local_path):
        raise RuntimeError(f"no registered version of {name!r} and no model at {local_path!r}")
    return load_model(spark, local_path), {"model_name": name, "model_version": "local", "model_source": "local_artifact"}
