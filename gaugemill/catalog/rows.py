"""Queries on rows: keys, joins, features, checks, constraints, splits."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugemill.catalog.tables import (
    ACCOUNT_DEFAULTS,
    ACCOUNTS,
    ACCOUNTS_SQL,
    LISTING,
    LISTING_SQL,
    accounts,
    features_sql,
    in_share_sql,
    listing,
    nations,
    parts,
    table,
)
from gaugemill.contracts import Rule
from gaugemill.functions.keys import clean_key_text, key_bucket, normalize_key, prediction_key
from gaugemill.functions.numeric import to_double
from gaugemill.operators import constraints, quality, sampling
from gaugemill.operators.drift import common_numeric_columns
from gaugemill.operators.enrich import duplicate_keys, enrich, fill_attributes
from gaugemill.plans.features import build_features, drop_metadata, expand_minimal, features_and_target, to_contract
from gaugemill.plans.training import inference_frame, training_frame
from gaugemill.session import work_dir
from gaugemill.sources.readers import read_table
from gaugemill.sources.writers import write_rows

QUERIES, ORACLE = {}, {}


def query(sql: str | None = None, name: str | None = None):
    def add(fn):
        QUERIES[name or fn.__name__] = fn
        if sql is not None:
            ORACLE[name or fn.__name__] = sql
        return fn

    return add


# --- keys and numbers -----------------------------------------------------------------------------------------

KEY_TEXT = """CASE o_orderkey % 9
  WHEN 0 THEN CAST(o_custkey AS VARCHAR) WHEN 1 THEN '"' || CAST(o_custkey AS VARCHAR) || '"'
  WHEN 2 THEN '  ' || CAST(o_custkey AS VARCHAR) || '.0 ' WHEN 3 THEN '''' || CAST(o_custkey AS VARCHAR) || ''''
  WHEN 4 THEN '000000' || CAST(o_custkey AS VARCHAR) WHEN 5 THEN 'K' || CAST(o_custkey AS VARCHAR)
  WHEN 6 THEN '-' || CAST(o_custkey AS VARCHAR) WHEN 7 THEN NULL ELSE CAST(o_custkey AS VARCHAR) || 'd' END"""
KEY_TEXT_SPARK = KEY_TEXT.replace("VARCHAR", "STRING").replace("''''", "\"'\"")


@query(f"""WITH k AS (SELECT o_orderkey, {KEY_TEXT} AS raw FROM orders),
s AS (SELECT *, trim(trim(trim(raw), '"'), '''') AS bare FROM k)
SELECT o_orderkey, raw,
  CASE WHEN regexp_full_match(bare, '[0-9]+\\.?[0-9]*')
    THEN lpad(CAST(CAST(floor(CAST(bare AS DOUBLE)) AS BIGINT) AS VARCHAR),
              CAST(greatest(length(CAST(CAST(floor(CAST(bare AS DOUBLE)) AS BIGINT) AS VARCHAR)), 5) AS INTEGER), '0')
    ELSE bare END AS key_text,
  trim(replace(raw, '"', '')) AS key_clean,
  trim(replace(coalesce(raw, ''), '"', '')) AS key_predict,
  CAST(CASE WHEN regexp_full_match(trim(replace(raw, '"', '')), '-?[0-9]+\\.?[0-9]*')
    THEN ((CAST(trunc(CAST(trim(replace(raw, '"', '')) AS DOUBLE)) AS BIGINT) % 1000) + 1000) % 1000 ELSE 0 END AS INTEGER) AS bucket,
  CASE WHEN regexp_full_match(trim(raw), '-?[0-9]+\\.?[0-9]*') THEN CAST(trim(raw) AS DOUBLE) END AS number
FROM s""", "normalize_key")
def normalize_key_text(spark, sf_dir):
    """Key texts in nine spellings."""
    raw = table(spark, sf_dir, "orders").select("o_orderkey", F.expr(KEY_TEXT_SPARK).alias("raw"))
    text = T.StringType()
    return raw.select(
        "o_orderkey", "raw", normalize_key(F.col("raw"), text).alias("key_text"), clean_key_text(F.col("raw")).alias("key_clean"),
        prediction_key(F.col("raw")).alias("key_predict"), key_bucket(F.col("raw")).alias("bucket"),
        to_double(F.col("raw"), text).alias("number"),
    )


@query(f"""WITH {LISTING_SQL}
SELECT CAST(CAST(part_key AS BIGINT) % 1000 AS INTEGER) AS geo_zip_bucket, 0 AS geo_cluster_placeholder, count(*) AS n_rows
FROM listing GROUP BY 1""")
def geo_bucket(spark, sf_dir):
    """rows per key bucket."""
    return listing(spark, sf_dir).groupBy(
        key_bucket(normalize_key(F.col("part_key"), T.LongType())).alias("geo_zip_bucket"),
        F.lit(0).alias("geo_cluster_placeholder"),
    ).agg(F.count(F.lit(1)).alias("n_rows"))


# --- joins ----------------------------------------------------------------------------------------------------

JOINED = """coalesce(l_orderkey, -1) AS l_orderkey, coalesce(l_linenumber, -1) AS l_linenumber, price,
  coalesce(l.part_key, p.part_key) AS part_key, p_size, p_retailprice"""


def _joined(spark, sf_dir, how):
    found = enrich(listing(spark, sf_dir), parts(spark, sf_dir), "part_key", how)
    return found.fillna(-1, ["l_orderkey", "l_linenumber"]).select("l_orderkey", "l_linenumber", "price", "part_key", "p_size", "p_retailprice")


@query(f"""WITH {LISTING_SQL}
SELECT l_orderkey, l_linenumber, price, l.part_key, coalesce(CAST(p_size AS DOUBLE), 0e0) AS p_size,
  coalesce(p_retailprice, 0e0) AS p_retailprice
FROM listing l LEFT JOIN parts p ON l.part_key IS NOT DISTINCT FROM p.part_key""")
def enrich_left(spark, sf_dir):
    """Order lines with part attributes, 0 where there is no part."""
    return fill_attributes(_joined(spark, sf_dir, "left"), list(LISTING.attributes))


@query(f"WITH {LISTING_SQL} SELECT {JOINED} FROM listing l JOIN parts p ON l.part_key = p.part_key")
def enrich_inner(spark, sf_dir):
    return _joined(spark, sf_dir, "inner")


@query(f"""WITH {LISTING_SQL} SELECT {JOINED}
FROM listing l RIGHT JOIN parts p ON l.part_key = p.part_key""")
def enrich_right(spark, sf_dir):
    return _joined(spark, sf_dir, "right")


@query(f"""WITH {LISTING_SQL} SELECT {JOINED}
FROM listing l FULL JOIN parts p ON l.part_key = p.part_key""")
def enrich_full(spark, sf_dir):
    return _joined(spark, sf_dir, "full")


@query("SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def enrich_many_to_one_check(spark, sf_dir):
    """Keys that would break a many-to-one join."""
    return duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


# --- features -------------------------------------------------------------------------------------------------

LISTING_ENRICHED = "listing l LEFT JOIN parts p USING (part_key)"


@query(f"WITH {LISTING_SQL} SELECT l_orderkey, l_linenumber, {features_sql(LISTING)} FROM {LISTING_ENRICHED}")
def engineered_features(spark, sf_dir):
    """Contract columns of every order line."""
    merged = enrich(listing(spark, sf_dir), parts(spark, sf_dir), "part_key")
    keep = ["l_orderkey", "l_linenumber"]
    return to_contract(build_features(merged, LISTING, keep), LISTING, keep)


@query(f"WITH {LISTING_SQL} SELECT l_orderkey, l_linenumber, {features_sql(LISTING, 'null')} FROM {LISTING_ENRICHED}")
def engineered_features_null_policy(spark, sf_dir):
    """F16: missing instead of zero."""
    merged = enrich(listing(spark, sf_dir), parts(spark, sf_dir), "part_key")
    return build_features(merged, LISTING, ["l_orderkey", "l_linenumber"], policy="null")


@query(f"WITH {LISTING_SQL} SELECT {', '.join(LISTING.merged_columns)}, price FROM {LISTING_ENRICHED}")
def features_and_target_split(spark, sf_dir):
    """Metadata dropped, target last, over the checked training frame."""
    merged = enrich(listing(spark, sf_dir), parts(spark, sf_dir), "part_key")
    without = drop_metadata(merged, LISTING)
    return features_and_target(merged, LISTING).select(*without.select(*LISTING.merged_columns).columns, "price")


SCENE_SQL = f"""WITH {ACCOUNTS_SQL}
SELECT {{columns}} FROM accounts a LEFT JOIN nations n USING (nation)"""


@query(SCENE_SQL.format(columns="c_custkey, " + ", ".join(ACCOUNTS.merged_columns) + ", balance").replace(
    "FROM accounts a", "FROM (SELECT * REPLACE (coalesce(n_orders, 0) AS n_orders, coalesce(total_price, 0) AS total_price) FROM accounts) a"))
def checked_training_frame(spark, sf_dir):
    """Inputs checked, joined and checked again; customers without orders count as 0 orders."""
    facts = accounts(spark, sf_dir).fillna(0.0, ["n_orders", "total_price"])
    merged = training_frame(facts, nations(spark, sf_dir), ACCOUNTS)
    return merged.select("c_custkey", *ACCOUNTS.merged_columns, "balance")


@query(SCENE_SQL.format(columns=", ".join(ACCOUNTS.merged_columns)).replace(
    "FROM accounts a", "FROM (SELECT * REPLACE (coalesce(n_orders, 0) AS n_orders, coalesce(total_price, 0) AS total_price) FROM accounts) a"))
def checked_inference_frame(spark, sf_dir):
    """The same for unlabeled rows."""
    facts = drop_metadata(accounts(spark, sf_dir), ACCOUNTS).fillna(0.0, ["n_orders", "total_price"])
    return inference_frame(facts, nations(spark, sf_dir), ACCOUNTS).select(*ACCOUNTS.merged_columns)


@query(f"""WITH {ACCOUNTS_SQL}
SELECT c_custkey, n_orders, total_price, max_price AS avg_price, max_price, total_price AS open_price, 0e0 AS done_price,
  first_year, first_year AS last_year, 0e0 AS urgent_orders, c_mktsegment, nation FROM accounts""")
def minimal_expansion(spark, sf_dir):
    """Minimal rows completed to all fact columns."""
    minimal = accounts(spark, sf_dir).drop("balance", *ACCOUNT_DEFAULTS)
    full = expand_minimal(minimal, ACCOUNTS, ACCOUNT_DEFAULTS)
    return full.withColumn("nation", normalize_key(F.col("nation"), T.IntegerType()))


# --- sources and sinks ------------------------------------------------------------------------------------------

@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders")
def csv_round_trip(spark, sf_dir):
    """Rows written as CSV and read back by header with declared types."""
    path = work_dir(spark, "orders") + ".csv"
    columns = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]
    write_rows(table(spark, sf_dir, "orders").select(*columns), path)
    return read_table(spark, path, {"o_orderkey": "bigint", "o_custkey": "bigint", "o_totalprice": "double"})


@query("SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders")
def parquet_round_trip(spark, sf_dir):
    """Rows written as parquet, partitioned, and read back."""
    path = work_dir(spark, "orders")
    write_rows(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus"), path, partition_by=("o_orderstatus",))
    return read_table(spark, path).select("o_orderkey", "o_totalprice", "o_orderstatus")


# --- quality ----------------------------------------------------------------------------------------------------

FINDING = ["dataset", "check", "column", "severity", "n_rows", "message"]


def _plain(findings):
    return findings.select(*FINDING)


ORDERS_WITH_GAPS = """SELECT o_orderkey, CASE WHEN o_orderpriority <> '1-URGENT' THEN o_custkey END AS o_custkey,
  CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS o_totalprice, o_orderstatus FROM orders"""


def _orders_with_gaps(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderpriority") != "1-URGENT", F.col("o_custkey")).alias("o_custkey"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("o_totalprice"),
        "o_orderstatus",
    )


@query(f"""WITH g AS ({ORDERS_WITH_GAPS}),
n AS (SELECT 'o_custkey' AS "column", count(*) - count(o_custkey) AS n_rows FROM g
  UNION ALL SELECT 'o_totalprice', count(*) - count(o_totalprice) FROM g
  UNION ALL SELECT 'o_orderstatus', count(*) - count(o_orderstatus) FROM g)
SELECT 'orders' AS dataset, 'nulls' AS "check", "column", 'error' AS severity, n_rows,
  'orders.' || "column" || ': ' || n_rows || ' values missing' AS message FROM n WHERE n_rows > 0
UNION ALL SELECT 'orders', 'nulls', 'o_clerk', 'error', 0, 'orders.o_clerk: not there to be checked for missing values'""")
def quality_nulls(spark, sf_dir):
    """V4."""
    gaps = _orders_with_gaps(spark, sf_dir)
    return _plain(quality.null_findings(gaps, ["o_custkey", "o_totalprice", "o_orderstatus", "o_clerk"], "orders"))


@query(f"""WITH g AS ({ORDERS_WITH_GAPS}), n AS (SELECT count(*) - count(o_custkey) AS n_rows FROM g)
SELECT 'orders' AS dataset, 'null_key' AS "check", 'o_custkey' AS "column", 'error' AS severity, n_rows,
  'orders.o_custkey: no key left once normalized' AS message FROM n WHERE n_rows > 0""")
def quality_null_key(spark, sf_dir):
    """V8."""
    return _plain(quality.null_key_findings(_orders_with_gaps(spark, sf_dir), "o_custkey", "orders"))


@query("""WITH n AS (SELECT sum(n) AS n_rows FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1))
SELECT 'lineitem' AS dataset, 'duplicate_keys' AS "check", 'l_orderkey' AS "column", 'error' AS severity, CAST(n_rows AS BIGINT) AS n_rows,
  'lineitem.l_orderkey: ' || n_rows || ' rows share their key' AS message FROM n WHERE n_rows > 0""")
def quality_duplicate_keys(spark, sf_dir):
    """V6."""
    return _plain(quality.duplicate_key_findings(table(spark, sf_dir, "lineitem"), "l_orderkey", "lineitem"))


@query(f"""WITH g AS ({ORDERS_WITH_GAPS}),
n AS (SELECT sum(n) AS n_rows FROM (SELECT count(*) AS n FROM g GROUP BY o_custkey HAVING count(*) > 1))
SELECT 'orders' AS dataset, 'duplicate_ids' AS "check", 'o_custkey' AS "column", 'warning' AS severity, CAST(n_rows AS BIGINT) AS n_rows,
  'orders.o_custkey: ' || n_rows || ' rows share their id' AS message FROM n WHERE n_rows > 0""")
def quality_duplicate_ids(spark, sf_dir):
    """V5: missing ids count as equal."""
    return _plain(quality.duplicate_id_findings(_orders_with_gaps(spark, sf_dir), "o_custkey", "orders"))


@query("""WITH n AS (SELECT sum(n - 1) AS n_rows FROM (SELECT count(*) AS n FROM lineitem
  GROUP BY l_quantity, l_discount, l_tax, l_returnflag, l_linestatus))
SELECT 'lines' AS dataset, 'duplicate_rows' AS "check", '*' AS "column", 'warning' AS severity, CAST(n_rows AS BIGINT) AS n_rows,
  'lines: ' || n_rows || ' rows repeat another' AS message FROM n WHERE n_rows > 0""")
def quality_duplicate_rows(spark, sf_dir):
    """V7."""
    lines = table(spark, sf_dir, "lineitem").select("l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus")
    return _plain(quality.duplicate_row_findings(lines, "lines"))


@query("""WITH f AS (
  SELECT 'orders' AS dataset, 'o_clerk,o_comment' AS "column", 'error' AS severity, 'orders lacks [''o_clerk'', ''o_comment'']' AS message
  UNION ALL SELECT 'orders', 'o_orderdate', 'warning', 'orders has columns beyond the contract: [''o_orderdate'']'
  UNION ALL SELECT 'part', 'p_weight', 'error', 'part lacks [''p_weight'']'),
n AS (SELECT 'orders' AS dataset, count(*) AS n_table_rows FROM orders UNION ALL SELECT 'part', count(*) FROM part)
SELECT f.*, n_table_rows FROM f JOIN n USING (dataset)""")
def quality_schema(spark, sf_dir):
    """Column sets against the contract, with the size of the table at fault."""
    orders, part = table(spark, sf_dir, "orders"), table(spark, sf_dir, "part")
    wanted = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority", "o_clerk", "o_comment"]
    findings = quality.schema_findings(orders, wanted, "orders").unionByName(
        quality.schema_findings(part, ["p_partkey", "p_weight"], "part", extras=False)
    )
    sizes = orders.agg(F.count(F.lit(1)).alias("n_table_rows")).withColumn("dataset", F.lit("orders")).unionByName(
        part.agg(F.count(F.lit(1)).alias("n_table_rows")).withColumn("dataset", F.lit("part"))
    )
    return findings.join(sizes, "dataset").select("dataset", "column", "severity", "message", "n_table_rows")


QUALITY_COUNTS = f"""WITH {LISTING_SQL}, raw AS (SELECT * FROM listing),
c AS (SELECT count(*) AS n, count(*) - count(tax) AS no_tax FROM raw),
d AS (SELECT sum(n) AS dup FROM (SELECT count(*) AS n FROM raw GROUP BY l_orderkey HAVING count(*) > 1)),
p AS (SELECT count(*) AS n_dim FROM part)"""


@query(f"""{QUALITY_COUNTS}
SELECT no_tax = 0 AS ok, 'sales.tax: ' || no_tax || ' values missing' AS errors,
  'sales.l_orderkey: ' || dup || ' rows share their id' AS warnings,
  n AS n_fact_rows, n_dim AS n_dim_rows FROM c, d, p""")
def quality_summary(spark, sf_dir):
    """Both training inputs checked, one row."""
    facts, dim = listing(spark, sf_dir), parts(spark, sf_dir)
    found = quality.summarize(quality.check_training(facts, dim, LISTING), facts, dim)
    return found.select(
        "ok", F.concat_ws("|", "errors").alias("errors"), F.concat_ws("|", "warnings").alias("warnings"), "n_fact_rows", "n_dim_rows"
    )


# --- constraints ------------------------------------------------------------------------------------------------

LINE_RULES = (
    Rule("quantity", ge=2, le=48),
    Rule("discount", gt=0),
    Rule("tax", ge=0.01),
    Rule("line", ge=1, le=6, integral=True),
    Rule("made_year", ge=1996, le=2001, integral=True),
    Rule("l_returnflag", min_length=1),
)
LINE_CHECKED = f"""WITH {LISTING_SQL},
marked AS (SELECT l_orderkey, l_linenumber, quantity, discount, tax, line, made_year, l_returnflag,
  list_filter([
    CASE WHEN NOT coalesce(quantity >= 2 AND quantity <= 48, false) THEN 'quantity' END,
    CASE WHEN NOT coalesce(discount > 0 AND l_linenumber <> 2, false) THEN 'discount' END,
    CASE WHEN NOT coalesce(tax >= 0.01, false) THEN 'tax' END,
    CASE WHEN NOT coalesce(line >= 1 AND line <= 6 AND line = floor(line), false) THEN 'line' END,
    CASE WHEN NOT coalesce(made_year >= 1996 AND made_year <= 2001, false) THEN 'made_year' END,
    CASE WHEN NOT coalesce(length(l_returnflag) >= 1, false) THEN 'l_returnflag' END], lambda x: x IS NOT NULL) AS broken
  FROM listing)"""


def _lines_split(spark, sf_dir):
    columns = ["l_orderkey", "l_linenumber", *(r.column for r in LINE_RULES)]
    lines = listing(spark, sf_dir).withColumn("discount", F.when(F.col("l_linenumber") == 2, F.lit(float("nan"))).otherwise(F.col("discount")))
    return constraints.split_by_rules(lines.select(*columns), LINE_RULES, ["l_orderkey", "l_linenumber"])


@query(f"{LINE_CHECKED} SELECT * EXCLUDE (broken) FROM marked WHERE len(broken) = 0")
def row_constraints_valid(spark, sf_dir):
    """P9, P10."""
    return _lines_split(spark, sf_dir)[0]


@query(f"""{LINE_CHECKED} SELECT l_orderkey, l_linenumber, array_to_string(broken, ',') AS reasons FROM marked WHERE len(broken) > 0""")
def row_constraints_rejected(spark, sf_dir):
    """Rejected rows with every broken rule."""
    return _lines_split(spark, sf_dir)[1].select("l_orderkey", "l_linenumber", F.concat_ws(",", "broken").alias("reasons"))


@query("""SELECT 'l_quantity' AS "column", 0 AS seq, count(l_quantity) FILTER (WHERE l_shipdate < TIMESTAMP '2000-01-01') AS n_reference,
  count(l_quantity) FILTER (WHERE l_shipdate >= TIMESTAMP '2000-01-01') AS n_current FROM lineitem
UNION ALL SELECT 'l_discount', 1, count(l_discount) FILTER (WHERE l_shipdate < TIMESTAMP '2000-01-01'),
  count(l_discount) FILTER (WHERE l_shipdate >= TIMESTAMP '2000-01-01') FROM lineitem""", "common_numeric_columns")
def common_numeric_values(spark, sf_dir):
    """P5: shared numeric columns of two frames, excluding metadata, with the values each frame has."""
    lines = table(spark, sf_dir, "lineitem")
    reference = lines.filter("l_shipdate < timestamp_ntz'2000-01-01'").select("l_orderkey", "l_quantity", "l_returnflag", "l_tax", "l_discount")
    current = lines.filter("l_shipdate >= timestamp_ntz'2000-01-01'").select("l_discount", "l_returnflag", "l_orderkey", "l_quantity")
    columns = common_numeric_columns(reference, current, exclude=("l_orderkey",))

    def counts(df, name):
        return df.agg(*(F.count(c).alias(c) for c in columns)).unpivot([], columns, "column", name)

    order = F.array_position(F.array(*(F.lit(c) for c in columns)), F.col("column")).cast("int") - 1
    return counts(reference, "n_reference").join(counts(current, "n_current"), "column").withColumn("seq", order)


# --- splits and samples -----------------------------------------------------------------------------------------

@query(f"SELECT o_orderkey, {in_share_sql('o_orderkey', 0.2, 42)} AS is_test FROM orders")
def split_hash(spark, sf_dir):
    """T4: seeded split by key."""
    fit, test = sampling.split_by_hash(table(spark, sf_dir, "orders").select("o_orderkey"), ["o_orderkey"])
    return fit.withColumn("is_test", F.lit(False)).unionByName(test.withColumn("is_test", F.lit(True)))


ORDER_RANKS = "SELECT o_orderkey, row_number() OVER (ORDER BY md5(CAST(o_orderkey AS VARCHAR) || ':42'), o_orderkey) - 1 AS r, count(*) OVER () AS n FROM orders"


@query(f"SELECT o_orderkey, r < ceil(n * 0.2e0) AS is_test FROM ({ORDER_RANKS})")
def split_exact_size(spark, sf_dir):
    """T4: exactly ceil(0.2 n) test rows."""
    fit, test = sampling.split_exact(table(spark, sf_dir, "orders").select("o_orderkey"), ["o_orderkey"])
    return fit.withColumn("is_test", F.lit(False)).unionByName(test.withColumn("is_test", F.lit(True)))


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY md5(CAST(o_orderkey AS VARCHAR) || ':42'), o_orderkey LIMIT 12000")
def sample_hash(spark, sf_dir):
    """Seeded sample of an exact number of rows."""
    return sampling.sample_rows(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), ["o_orderkey"], 12_000)


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 5000")
def row_cap(spark, sf_dir):
    """First rows by key."""
    return sampling.first_rows(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), ["o_orderkey"], 5_000)


@query("""SELECT o_orderkey, CAST(CAST('0x' || substr(md5(CAST(o_orderkey AS VARCHAR) || ':42'), 1, 8) AS BIGINT) % 5 AS INTEGER) AS fold FROM orders""")
def kfold_hash(spark, sf_dir):
    """T5: fold by key digest."""
    return sampling.with_fold(table(spark, sf_dir, "orders").select("o_orderkey"), ["o_orderkey"], 5)


@query(f"""SELECT o_orderkey, CAST(CASE WHEN r < (n % 7) * (n // 7 + 1) THEN r // (n // 7 + 1)
  ELSE n % 7 + (r - (n % 7) * (n // 7 + 1)) // (n // 7) END AS INTEGER) AS fold FROM ({ORDER_RANKS})""")
def kfold_contiguous(spark, sf_dir):
    """T5: contiguous folds of even size over the shuffled rows."""
    return sampling.with_fold(table(spark, sf_dir, "orders").select("o_orderkey"), ["o_orderkey"], 7, contiguous=True)


@query("""WITH a AS (SELECT o_orderkey, o_totalprice, o_orderpriority,
    row_number() OVER (ORDER BY md5(CAST(o_orderkey AS VARCHAR) || ':0'), o_orderkey) AS here,
    row_number() OVER (ORDER BY md5(CAST(o_orderkey AS VARCHAR) || ':43'), o_orderkey) AS there FROM orders)
SELECT a.o_orderkey, a.o_totalprice, b.o_totalprice AS o_totalprice__permuted, b.o_orderpriority AS o_orderpriority__permuted
FROM a JOIN a b ON a.here = b.there""")
def permute_columns(spark, sf_dir):
    """Values of two columns dealt out in another row order."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    return sampling.permuted_values(orders, ["o_orderkey"], ["o_totalprice", "o_orderpriority"], 43).drop("o_orderpriority")
