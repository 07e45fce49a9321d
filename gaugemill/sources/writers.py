"""Sinks of jobs: predictions, reports, contracts and statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gaugemill.contracts import FeatureContract, TrainingParams


def write_rows(df: DataFrame, path: str, mode: str = "overwrite", partition_by: tuple[str, ...] = ()) -> str:
    """Parquet, or CSV with a header where the path ends in ``.csv``."""
    fmt = "csv" if path.rstrip("/").endswith(".csv") else "parquet"
    writer = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    return path


def create_once(spark: SparkSession, path: str) -> bool:
    """Create an empty file; False if it is there already."""
    file = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = file.getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        system.create(file, False).close()
    except Exception:
        if system.exists(file):
            return False
        raise
    return True


def _write_document(spark: SparkSession, text: str, path: str) -> str:
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)
    return path


def _read_document(spark: SparkSession, path: str) -> str:
    return "".join(r["value"] for r in spark.read.option("wholetext", True).text(path).collect())


def write_contract(spark: SparkSession, contract: FeatureContract, path: str) -> str:
    """Contract as one JSON text."""
    return _write_document(spark, contract.to_json(), path)


def read_contract(spark: SparkSession, path: str) -> FeatureContract:
    return FeatureContract.from_json(_read_document(spark, path))


def write_params(spark: SparkSession, params: TrainingParams, path: str) -> str:
    """Training parameters as one JSON text."""
    return _write_document(spark, params.to_json(), path)


def read_params(spark: SparkSession, path: str) -> TrainingParams:
    """Parameters of a training job from a JSON text, written by :func:`write_params` or by hand."""
    return TrainingParams.from_json(_read_document(spark, path))
