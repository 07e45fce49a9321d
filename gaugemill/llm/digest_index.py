"""Exact duplicates by a persistent index of text digests.

The index is a table bucketed and sorted by the SHA-256 of the text. A batch of documents is first grouped by digest
(equal texts are counted before the shuffle, so a text that makes up a third of all rows is one record per map task).
Its groups meet the index in a sort-merge anti-join that reads the buckets where they lie: digests that no earlier batch
had are new, and one row of each is handed on. The batch's groups are then appended to the same buckets, each marked as
new or known, so the table also tells the size and the last row of every group of all batches.

Batches are numbered, and each is a partition that its append replaces: a batch whose append was cut short, or that is
given again, leaves the index as if it had run once. Batches are appended in the order of their numbers.

Defined results: NULL counts as empty text. NULL ids are smaller than all others; among rows of a group with the same
largest id one is the last. An empty batch appends nothing. Other columns are neither read nor changed, whatever their
names.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugemill.llm._rows import numbered, written
from gaugemill.session import work_dir

ENTRY = "digest BINARY, size BIGINT, last STRUCT<id: BIGINT, batch: BIGINT, row: BIGINT>, fresh BOOLEAN, batch BIGINT"
BUCKETS = 64


def digests(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Id, row number and digest of every row, written: a row keeps its number however often tasks are repeated."""
    rows = docs.select(docs[doc_id].cast("bigint").alias("id"), F.monotonically_increasing_id().alias("row"), digest_of(docs[text]).alias("digest"))
    return written(rows, "digests")


def digest_of(text):
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))


class DigestIndex:
    """Index at a path that all executors see. ``buckets`` is fixed when the index is made: choose it so that a bucket holds
    some million digests, of about 100 bytes each, of all batches to come."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS):
        self.spark, self.path = spark, path
        self.table = f"digest_index_{uuid.uuid4().hex}"
        nothing = spark.createDataFrame([], "digest binary, batch bigint")
        nothing.write.mode("append").partitionBy("batch").parquet(path)  # makes the folder, if there is none
        spark.sql(
            f"CREATE TABLE {self.table} ({ENTRY}) USING parquet PARTITIONED BY (batch) "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {int(buckets)} BUCKETS LOCATION '{path}'"
        )
        spark.sql(f"MSCK REPAIR TABLE {self.table}")
        self.buckets = int(buckets)

    def entries(self) -> DataFrame:
        return self.spark.table(self.table)

    def append(self, rows: DataFrame, batch: int) -> None:
        """Add the groups of ``rows`` (of :func:`digests`) as batch number ``batch``."""
        known = self.entries().where(F.col("batch") < batch).select("digest", "fresh")
        last = F.max(F.struct("id", F.lit(batch).cast("bigint").alias("batch"), "row")).alias("last")
        groups = rows.groupBy("digest").agg(F.count(F.lit(1)).alias("size"), last)
        new = groups.join(known.where("fresh").hint("merge"), "digest", "left_anti").withColumn("fresh", F.lit(True))
        old = groups.join(known.where("fresh").hint("merge"), "digest", "left_semi").withColumn("fresh", F.lit(False))
        entries = written(new.unionByName(old), "digest-entries")  # the index can't be read while it is written
        view = f"{self.table}_batch"
        entries.select("digest", "size", "last", "fresh").repartition(self.buckets, "digest").createOrReplaceTempView(view)
        self.spark.sql(f"INSERT OVERWRITE TABLE {self.table} PARTITION (batch = {int(batch)}) SELECT * FROM {view}")
        self.spark.catalog.dropTempView(view)

    def new_rows(self, rows: DataFrame, batch: int) -> DataFrame:
        """The rows of a batch that go on: the last one of each digest that no earlier batch had."""
        fresh = self.entries().where((F.col("batch") == batch) & F.col("fresh")).select("digest", F.col("last.row").alias("row"))
        return rows.join(fresh, ["digest", "row"], "left_semi")

    def groups(self) -> DataFrame:
        """Size and last row of every digest over all batches; grouped bucket by bucket, without a shuffle."""
        return self.entries().groupBy("digest").agg(F.sum("size").alias("size"), F.max("last").alias("last"))

    def close(self) -> None:
        """Forget the table's name; the files stay and can be opened again."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")


def batches(docs: DataFrame, index: DigestIndex, by) -> DataFrame:
    """Append the rows of ``docs`` in two batches (the second where ``by`` holds) and return every row with its group.

    Most groups have one row and need no join: only rows of larger groups take part in one, and a group of any size is
    split by adaptive execution, since the join's left side is what is large.
    """
    rows = digests(docs)
    second = F.coalesce(by(F.col("id")), F.lit(False))
    index.append(rows.where(~second), 0)
    index.append(rows.where(second), 1)
    repeated = written(index.groups().where("size > 1"), "digest-repeated")
    own = rows.withColumn("batch", second.cast("bigint"))
    joined = own.join(repeated, "digest", "left")
    alone = F.col("size").isNull()
    return joined.select(
        F.col("id").alias("doc_id"),
        F.when(alone, F.col("id")).otherwise(F.col("last.id")).alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("bigint").alias("group_size"),
        F.coalesce((F.col("last.row") == F.col("row")) & (F.col("last.batch") == F.col("batch")), F.lit(True)).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """Every row with its group of equal texts, through a fresh index that gets ``docs`` in two batches.

    Two batches (by a hash of the id) so that the second is met by an index that holds something, as new data would be.
    """
    spark = docs.sparkSession
    index = DigestIndex(spark, work_dir(spark, "digest-index"), max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    found = batches(docs, index, lambda i: F.pmod(F.xxhash64(i), F.lit(2)) == 1)
    index.close()
    return found


def without_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` with all their columns, one of each group of equal texts: that with the largest id."""
    columns, names = numbered(docs, text)
    id_name = names[docs.columns.index(doc_id)]
    held = written(columns.withColumn("row", F.monotonically_increasing_id()).withColumn("digest", digest_of(F.col("text"))), "digest-rows")
    index = DigestIndex(docs.sparkSession, work_dir(docs.sparkSession, "digest-index"))
    rows = held.select(held[id_name].cast("bigint").alias("id"), "row", "digest")
    index.append(rows, 0)
    kept = held.join(index.new_rows(rows, 0).select("row"), "row", "left_semi")
    return kept.select(*names).toDF(*docs.columns)
