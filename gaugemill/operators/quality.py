"""Data-quality checks as rows ``(seq, dataset, check, column, severity, n_rows, message)``.

All row-level counts of a table come from one aggregate over one scan; duplicate checks add one shuffle of
the key alone, with the counts combined before it. Errors block, warnings do not.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugemill.contracts import FeatureContract
from gaugemill.functions.keys import normalize_key
from gaugemill.functions.numeric import missing

FINDING_COLUMNS = ("seq", "dataset", "check", "column", "severity", "n_rows", "message")
FINDING_SCHEMA = "seq int, dataset string, check string, column string, severity string, n_rows long, message string"


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def schema_findings(df: DataFrame, expected: Sequence[str], dataset: str, extras: bool = True, seq: int = 0) -> DataFrame:
    """Missing columns as an error, unexpected ones as a warning. Reads no rows."""
    rows = []
    absent = [c for c in expected if c not in df.columns]
    surplus = [c for c in df.columns if c not in set(expected)]
    if absent:
        rows.append((seq, dataset, "schema", ",".join(absent), "error", 0, f"{dataset} lacks {absent}"))
    if surplus and extras:
        rows.append(
            (seq + 1, dataset, "schema", ",".join(surplus), "warning", 0,
             f"{dataset} has columns beyond the contract: {surplus}")
        )
    return df.sparkSession.createDataFrame(rows, FINDING_SCHEMA)


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row ``(column, n_null)`` per column, from a single aggregate."""
    counts = df.agg(*(F.count_if(missing(df, c)).alias(c) for c in columns))
    return counts.unpivot([], list(columns), "column", "n_null")


def _counted(df: DataFrame, checks: list[tuple[int, str, str, str, str, Column, str]]) -> DataFrame:
    """Findings from row predicates, all counted in one pass: the scan is not repeated per check."""
    if not checks:
        return df.sparkSession.createDataFrame([], FINDING_SCHEMA)
    counts = df.agg(*(F.count_if(c[5]).alias(f"n{i}") for i, c in enumerate(checks)))
    rows = F.array(
        *(
            F.struct(
                F.lit(seq).alias("seq"), F.lit(dataset).alias("dataset"), F.lit(check).alias("check"),
                F.lit(column).alias("column"), F.lit(severity).alias("severity"),
                F.col(f"n{i}").alias("n_rows"), F.format_string(text, F.col(f"n{i}")).alias("message"),
            )
            for i, (seq, dataset, check, column, severity, _, text) in enumerate(checks)
        )
    )
    return counts.select(F.inline(rows)).filter("n_rows > 0")


def _null_checks(df: DataFrame, columns: Sequence[str], dataset: str, seq: int) -> list:
    return [
        (seq + i, dataset, "nulls", c, "error", missing(df, c), f"{dataset}.{c}: %d values missing")
        for i, c in enumerate(columns)
        if c in df.columns
    ]


def _key_check(df: DataFrame, key: str, dataset: str, seq: int) -> list:
    if key not in df.columns:
        return []
    lost = normalize_key(F.col(key), df.schema[key].dataType).isNull()
    return [(seq, dataset, "null_key", key, "error", lost, f"{dataset}.{key}: no key left once normalized")]


def _absent_findings(df: DataFrame, columns: Sequence[str], dataset: str, seq: int) -> DataFrame:
    rows = [
        (seq + i, dataset, "nulls", c, "error", 0, f"{dataset}.{c}: not there to be checked for missing values")
        for i, c in enumerate(columns)
        if c not in df.columns
    ]
    return df.sparkSession.createDataFrame(rows, FINDING_SCHEMA)


def null_findings(df: DataFrame, columns: Sequence[str], dataset: str, seq: int = 10) -> DataFrame:
    """Error per critical column with missing values; asking for an absent column is an error too."""
    return _counted(df, _null_checks(df, columns, dataset, seq)).unionByName(_absent_findings(df, columns, dataset, seq))


def null_key_findings(df: DataFrame, key: str, dataset: str, seq: int = 60) -> DataFrame:
    """Error if a key is missing after normalization."""
    return _counted(df, _key_check(df, key, dataset, seq))


def _duplicates(df: DataFrame, keys: Sequence[str], counted: str, finding: tuple[int, str, str, str, str, str]) -> DataFrame:
    seq, dataset, check, column, severity, text = finding
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    total = groups.agg(F.coalesce(F.sum(F.when(F.col("n") > 1, F.expr(counted))), F.lit(0)).alias("n_rows"))
    return total.filter("n_rows > 0").select(
        F.lit(seq).alias("seq"), F.lit(dataset).alias("dataset"), F.lit(check).alias("check"),
        F.lit(column).alias("column"), F.lit(severity).alias("severity"), "n_rows",
        F.format_string(text, "n_rows").alias("message"),
    )


def duplicate_id_findings(df: DataFrame, column: str, dataset: str, seq: int = 50) -> DataFrame:
    """Warning counting every row of a repeated id; no finding if there is no id column."""
    if column not in df.columns:
        return df.sparkSession.createDataFrame([], FINDING_SCHEMA)
    text = f"{dataset}.{column}: %d rows share their id"
    return _duplicates(df, [column], "n", (seq, dataset, "duplicate_ids", column, "warning", text))


def duplicate_key_findings(df: DataFrame, key: str, dataset: str, seq: int = 50) -> DataFrame:
    """Error counting every row of a repeated dimension key, on the raw values."""
    if key not in df.columns:
        row = (seq, dataset, "duplicate_keys", key, "error", 0, f"{dataset}.{key}: not there to be checked for repeats")
        return df.sparkSession.createDataFrame([row], FINDING_SCHEMA)
    text = f"{dataset}.{key}: %d rows share their key"
    return _duplicates(df, [key], "n", (seq, dataset, "duplicate_keys", key, "error", text))


def duplicate_row_findings(df: DataFrame, dataset: str, seq: int = 50) -> DataFrame:
    """Warning counting all but the first of each group of equal rows."""
    text = f"{dataset}: %d rows repeat another"
    return _duplicates(df, df.columns, "n - 1", (seq, dataset, "duplicate_rows", "*", "warning", text))


def check_sales(df: DataFrame, contract: FeatureContract, dataset: str = "sales") -> DataFrame:
    """Schema, missing values, repeated ids and lost keys of the labeled fact table.

    Missing values and lost keys are counted in one aggregate.
    """
    checks = _null_checks(df, contract.critical, dataset, 10) + _key_check(df, contract.key, dataset, 60)
    return _union([
        schema_findings(df, contract.sales_columns, dataset),
        _counted(df, checks),
        _absent_findings(df, contract.critical, dataset, 10),
        duplicate_id_findings(df, contract.row_id, dataset),
    ])


def check_dimension(df: DataFrame, contract: FeatureContract, dataset: str = "dimension", seq: int = 100) -> DataFrame:
    """Schema, repeated keys and missing keys of the dimension."""
    return _union([
        schema_findings(df, (*contract.attributes, contract.key), dataset, seq=seq),
        duplicate_key_findings(df, contract.key, dataset, seq + 10),
        null_findings(df, [contract.key], dataset, seq + 20),
    ])


def check_inference(df: DataFrame, contract: FeatureContract, dataset: str = "inference") -> DataFrame:
    """Schema, missing values and equal rows of the rows to be scored."""
    return _union([
        schema_findings(df, contract.inference_columns, dataset),
        null_findings(df, contract.critical_inference, dataset),
        duplicate_row_findings(df, dataset),
    ])


def check_training(sales: DataFrame, dim: DataFrame, contract: FeatureContract) -> DataFrame:
    """Checks of both training inputs."""
    return check_sales(sales, contract).unionByName(check_dimension(dim, contract))


def check_merged(df: DataFrame, contract: FeatureContract, dataset: str) -> DataFrame:
    """All fact and attribute columns are there after the join."""
    return schema_findings(df, contract.merged_columns, dataset, extras=False)


def gate(findings: DataFrame, context: str) -> list[str]:
    """Raise on any error, else return the warnings. Findings are a handful of rows."""
    rows = findings.orderBy("seq").collect()
    errors = [r["message"] for r in rows if r["severity"] == "error"]
    if errors:
        raise ValueError(f"{context} refused: {'; '.join(errors)}")
    return [r["message"] for r in rows if r["severity"] == "warning"]


def summarize(findings: DataFrame, fact: DataFrame, dim: DataFrame) -> DataFrame:
    """One row ``(ok, errors, warnings, n_fact_rows, n_dim_rows)``; messages in check order."""
    def messages(severity: str) -> Column:
        found = F.collect_list(F.when(F.col("severity") == severity, F.struct("seq", "message")))
        return F.transform(F.array_sort(found), lambda m: m["message"])

    told = findings.select("seq", "severity", "message", F.lit(0).alias("n_fact"), F.lit(0).alias("n_dim"))
    blank = [F.lit(None).cast(t).alias(c) for c, t in (("seq", "int"), ("severity", "string"), ("message", "string"))]
    sizes = _union([
        fact.agg(F.count(F.lit(1)).alias("n_fact")).select(*blank, "n_fact", F.lit(0).alias("n_dim")),
        dim.agg(F.count(F.lit(1)).alias("n_dim")).select(*blank, F.lit(0).alias("n_fact"), "n_dim"),
    ])
    return told.unionByName(sizes).agg(
        (F.count_if(F.col("severity") == "error") == 0).alias("ok"),
        messages("error").alias("errors"),
        messages("warning").alias("warnings"),
        F.sum("n_fact").alias("n_fact_rows"),
        F.sum("n_dim").alias("n_dim_rows"),
    )
