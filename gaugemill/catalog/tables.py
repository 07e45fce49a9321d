"""The benchmark tables seen through two contracts, as DataFrames and as the same views in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugemill.contracts import FeatureContract


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- listing: order lines with the attributes of their part -------------------------------------------------

LISTING = FeatureContract(
    name="listing",
    key="part_key",
    target="price",
    row_id="l_orderkey",
    metadata=("l_orderkey", "l_linenumber", "price"),
    numeric=("quantity", "discount", "tax", "line", "made_year", "redone_year"),
    categorical=("l_returnflag", "l_linestatus", "part_key"),
    attributes=("p_size", "p_retailprice"),
    roles={
        "built": "made_year", "renovated": "redone_year", "above": "quantity", "basement": "tax",
        "living": "quantity", "lot": "discount", "bathrooms": "tax", "bedrooms": "line",
    },
    critical=("price", "part_key", "quantity", "tax"),
    reference_year=2000,
)


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines; some keys have no part and some values are missing."""
    year = F.year("l_shipdate")
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.col("l_extendedprice").alias("price"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_discount").alias("discount"),
        F.when(F.col("l_linenumber") != 3, F.col("l_tax")).alias("tax"),
        F.col("l_linenumber").cast("double").alias("line"),
        year.cast("double").alias("made_year"),
        F.when(F.col("l_returnflag") == "R", year + F.col("l_linenumber") - 2).otherwise(0).cast("double").alias("redone_year"),
        "l_returnflag", "l_linestatus",
        (F.col("l_partkey") + F.col("l_suppkey")).alias("part_key"),
    )


def parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("part_key"), F.col("p_size").cast("double").alias("p_size"), "p_retailprice")


LISTING_SQL = """
listing AS (
  SELECT l_orderkey, l_linenumber, l_extendedprice AS price, l_quantity AS quantity, l_discount AS discount,
    CASE WHEN l_linenumber <> 3 THEN l_tax END AS tax, CAST(l_linenumber AS DOUBLE) AS line,
    CAST(year(l_shipdate) AS DOUBLE) AS made_year,
    CAST(CASE WHEN l_returnflag = 'R' THEN year(l_shipdate) + l_linenumber - 2 ELSE 0 END AS DOUBLE) AS redone_year,
    l_returnflag, l_linestatus,
    lpad(CAST(l_partkey + l_suppkey AS VARCHAR), CAST(greatest(length(CAST(l_partkey + l_suppkey AS VARCHAR)), 5) AS INTEGER), '0') AS part_key
  FROM lineitem),
parts AS (
  SELECT lpad(CAST(p_partkey AS VARCHAR), CAST(greatest(length(CAST(p_partkey AS VARCHAR)), 5) AS INTEGER), '0') AS part_key,
    CAST(p_size AS DOUBLE) AS p_size, p_retailprice
  FROM part)"""


def engineered_sql(p: dict[str, str], year: int, policy: str = "zero") -> dict[str, str]:
    """The engineered columns as SQL, from SQL expressions per role."""
    if policy == "null":
        total = f"({p['above']} + {p['basement']})"
        return {
            "house_age": f"{year}e0 - {p['built']}",
            "renovated_flag": f"CASE WHEN {p['renovated']} > 0 THEN 1 ELSE 0 END",
            "renovation_age": f"CASE WHEN {p['renovated']} > 0 THEN {year}e0 - {p['renovated']} END",
            "total_sqft": total,
            "living_to_lot_ratio": f"{p['living']} / nullif({p['lot']}, 0)",
            "bath_bed_ratio": f"{p['bathrooms']} / nullif({p['bedrooms']}, 0)",
            "basement_ratio": f"{p['basement']} / nullif({total}, 0)",
        }
    z = {k: f"coalesce({v}, 0e0)" for k, v in p.items()}
    done = f"({z['renovated']} > 0 AND {z['renovated']} > {z['built']})"
    total = f"({z['above']} + {z['basement']})"
    return {
        "house_age": f"CASE WHEN {p['built']} IS NOT NULL THEN greatest({year}e0 - {p['built']}, 0e0) END",
        "renovated_flag": f"CASE WHEN {done} THEN 1 ELSE 0 END",
        "renovation_age": f"CASE WHEN {done} THEN greatest({year}e0 - {z['renovated']}, 0e0) ELSE 0e0 END",
        "total_sqft": total,
        "living_to_lot_ratio": f"CASE WHEN {z['lot']} > 1e-9 THEN {z['living']} / {z['lot']} ELSE 0e0 END",
        "bath_bed_ratio": f"{z['bathrooms']} / greatest({z['bedrooms']}, 1e0)",
        "basement_ratio": f"CASE WHEN {total} > 1e-9 THEN {z['basement']} / {total} ELSE 0e0 END",
    }


def features_sql(contract: FeatureContract, policy: str = "zero", year: int | None = None) -> str:
    """Select list of the contract's final columns over an enriched row."""
    made = engineered_sql(dict(contract.roles), year or contract.reference_year, policy)
    made |= {c: f"coalesce(CAST({c} AS DOUBLE), 0e0)" for c in contract.attributes}
    made |= {
        "geo_zip_bucket": f"CAST(coalesce(TRY_CAST({contract.key} AS BIGINT), 0) % 1000 AS INTEGER)",
        "geo_cluster_placeholder": "0",
    }
    return ", ".join(f"{made.get(c, c)} AS {c}" for c in contract.final)


# --- accounts: customers with their orders and the attributes of their nation -------------------------------

ACCOUNTS = FeatureContract(
    name="accounts",
    key="nation",
    target="balance",
    row_id="c_custkey",
    metadata=("c_custkey", "balance"),
    numeric=(
        "n_orders", "total_price", "avg_price", "max_price", "open_price", "done_price", "first_year", "last_year",
        "urgent_orders",
    ),
    categorical=("c_mktsegment", "nation"),
    attributes=("n_suppliers", "supplier_balance"),
    roles={
        "built": "first_year", "renovated": "last_year", "above": "done_price", "basement": "open_price",
        "living": "avg_price", "lot": "max_price", "bathrooms": "urgent_orders", "bedrooms": "n_orders",
    },
    critical=("balance", "nation", "n_orders", "total_price"),
    reference_year=2002,
)
ACCOUNT_DEFAULTS = {
    "avg_price": "max_price", "open_price": "total_price", "done_price": 0.0, "last_year": "first_year",
    "urgent_orders": 0.0,
}


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with order figures. Orders are summed per customer before the join; sums are exact decimals."""
    money = F.col("o_totalprice").cast("decimal(14,2)")
    year = F.year("o_orderdate").cast("double")

    def total(condition):
        return F.coalesce(F.sum(F.when(condition, money)), F.lit(0)).cast("double")

    orders = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).cast("double").alias("n_orders"),
        total(F.lit(True)).alias("total_price"),
        (total(F.lit(True)) / F.count(F.lit(1))).alias("avg_price"),
        F.max("o_totalprice").alias("max_price"),
        total(F.col("o_orderstatus") == "O").alias("open_price"),
        total(F.col("o_orderstatus") != "O").alias("done_price"),
        F.min(year).alias("first_year"),
        F.max(year).alias("last_year"),
        F.count_if(F.col("o_orderpriority") == "1-URGENT").cast("double").alias("urgent_orders"),
    )
    return table(spark, sf_dir, "customer").join(orders, "c_custkey", "left").select(
        "c_custkey", F.col("c_acctbal").alias("balance"), *ACCOUNTS.numeric, "c_mktsegment", F.col("c_nationkey").alias("nation")
    )


def nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Supplier figures per nation."""
    balance = F.sum(F.col("s_acctbal").cast("decimal(14,2)")).cast("double")
    return table(spark, sf_dir, "supplier").groupBy(F.col("s_nationkey").alias("nation")).agg(
        F.count(F.lit(1)).cast("double").alias("n_suppliers"), balance.alias("supplier_balance")
    )


ACCOUNTS_SQL = """
accounts AS (
  SELECT c.c_custkey, c.c_acctbal AS balance, n_orders, total_price, avg_price, max_price, open_price, done_price,
    first_year, last_year, urgent_orders, c.c_mktsegment, lpad(CAST(c.c_nationkey AS VARCHAR), 5, '0') AS nation
  FROM customer c LEFT JOIN (
    SELECT o_custkey, CAST(count(*) AS DOUBLE) AS n_orders,
      CAST(sum(CAST(o_totalprice AS DECIMAL(14,2))) AS DOUBLE) AS total_price,
      CAST(sum(CAST(o_totalprice AS DECIMAL(14,2))) AS DOUBLE) / count(*) AS avg_price,
      max(o_totalprice) AS max_price,
      CAST(coalesce(sum(CASE WHEN o_orderstatus = 'O' THEN CAST(o_totalprice AS DECIMAL(14,2)) END), 0) AS DOUBLE) AS open_price,
      CAST(coalesce(sum(CASE WHEN o_orderstatus <> 'O' THEN CAST(o_totalprice AS DECIMAL(14,2)) END), 0) AS DOUBLE) AS done_price,
      CAST(min(year(o_orderdate)) AS DOUBLE) AS first_year, CAST(max(year(o_orderdate)) AS DOUBLE) AS last_year,
      CAST(count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS DOUBLE) AS urgent_orders
    FROM orders GROUP BY o_custkey) o ON c.c_custkey = o.o_custkey),
nations AS (
  SELECT lpad(CAST(s_nationkey AS VARCHAR), 5, '0') AS nation, CAST(count(*) AS DOUBLE) AS n_suppliers,
    CAST(sum(CAST(s_acctbal AS DECIMAL(14,2))) AS DOUBLE) AS supplier_balance
  FROM supplier GROUP BY s_nationkey)"""


def in_share_sql(key: str, share: float, seed: int) -> str:
    """The hash split condition as SQL."""
    return f"substr(md5(CAST({key} AS VARCHAR) || ':{seed}'), 1, 8) < '{format(int(share * 16**8), '08x')}'"
