"""Table readers. CSV columns are matched by header name and get declared types; nothing is inferred."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugemill.contracts import DEMOGRAPHIC_COLUMNS, SALES_COLUMNS
from gaugemill.functions.numeric import to_double

# Texts that stand for a missing value.
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>",
    "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
# Default file names and column types.
SALES_FILE = "kc_house_data.csv"
DEMOGRAPHICS_FILE = "zipcode_demographics.csv"
UNSEEN_FILE = "future_unseen_examples.csv"
SALES_TYPES: Mapping[str, str] = {c: "double" for c in SALES_COLUMNS} | {"id": "bigint", "date": "string", "zipcode": "string"}
DEMOGRAPHIC_TYPES: Mapping[str, str] = {c: "double" for c in DEMOGRAPHIC_COLUMNS} | {"zipcode": "string"}


def read_table(spark: SparkSession, path: str, types: Mapping[str, str] | None = None, fmt: str | None = None) -> DataFrame:
    """CSV with a header or parquet, by suffix unless ``fmt`` is given.

    CSV columns named in ``types`` are cast (unreadable numbers become NULL), others stay text.
    """
    fmt = fmt or ("csv" if path.rstrip("/").endswith(".csv") else "parquet")
    if fmt != "csv":
        return spark.read.format(fmt).load(path)
    raw = spark.read.option("header", True).option("mode", "PERMISSIVE").csv(path)
    types = types or {}

    def typed(name: str):
        c = F.col(f"`{name}`")
        present = F.when(~c.isin(*NULL_TOKENS), c)
        wanted = types.get(name, "string")
        if wanted == "double":
            return to_double(present, T.StringType()).alias(name)
        return present.try_cast(wanted).alias(name)

    return raw.select(*(typed(c) for c in raw.columns))


@dataclass(frozen=True)
class RawTables:
    """Names and column types of the three raw tables below one folder."""

    sales: str = SALES_FILE
    demographics: str = DEMOGRAPHICS_FILE
    unseen: str = UNSEEN_FILE
    sales_types: Mapping[str, str] = field(default_factory=lambda: SALES_TYPES)
    demographic_types: Mapping[str, str] = field(default_factory=lambda: DEMOGRAPHIC_TYPES)


HOUSE_TABLES = RawTables()


def read_sales(spark: SparkSession, base: str = "data/raw", tables: RawTables = HOUSE_TABLES) -> DataFrame:
    """Labeled fact rows."""
    return read_table(spark, f"{base.rstrip('/')}/{tables.sales}", tables.sales_types)


def read_demographics(spark: SparkSession, base: str = "data/raw", tables: RawTables = HOUSE_TABLES) -> DataFrame:
    """Dimension rows."""
    return read_table(spark, f"{base.rstrip('/')}/{tables.demographics}", tables.demographic_types)


def read_unseen(spark: SparkSession, base: str = "data/raw", tables: RawTables = HOUSE_TABLES) -> DataFrame:
    """Unlabeled rows to be scored."""
    return read_table(spark, f"{base.rstrip('/')}/{tables.unseen}", tables.sales_types)


def read_all(spark: SparkSession, base: str = "data/raw", tables: RawTables = HOUSE_TABLES) -> dict[str, DataFrame]:
    """All three tables, lazily."""
    readers = {"sales": read_sales, "demographics": read_demographics, "unseen": read_unseen}
    return {name: read(spark, base, tables) for name, read in readers.items()}


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, on any file system Spark can reach."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)


def read_if_usable(
    spark: SparkSession, path: str | None, required: Sequence[str], types: Mapping[str, str] | None = None,
    absent: str = "predictions_file_missing", incomplete: str = "missing_predicted_price_column",
) -> tuple[DataFrame | None, str | None]:
    """``(rows, None)``, or ``(None, reason)`` if the source or a required column is not there."""
    if path is None or not path_exists(spark, path):
        return None, absent
    df = read_table(spark, path, types)
    return (None, incomplete) if set(required) - set(df.columns) else (df, None)
