"""What each filter removes in every order of five filters, counted by a stream that retracts.

All files of the table go through one stateful stream in available-now micro-batches. Filters A to D need the text alone.
Filter E (the text of a smaller id) needs the whole table, so it is kept as state: under the digest of a text stand its
smallest id so far and the rows that have it. Digests are dealt into buckets of some hundred by their hash, as many as the
table needs, and a bucket is one entry of the state store. A row counts as failing E when it comes in; when a smallest id is
found its rows are counted again as passing, and when a later batch brings a smaller one, what was said of the earlier
rows is taken back. The stream's output are these signed counts per part and mask of failed filters; they are summed once.

From the sums of a part, a table of the rows that survive each of the 32 sets of filters gives every figure of every order:
what a filter removes depends only on the set before it.

Hot texts: each task hands on one row per text (its smallest id), and one count per part and mask, so a text that makes up
a third of the table is one row per task. Labels are joined on a salted id: rows of one hot id are spread over ``SALTS`` keys.

The state takes about 100 bytes a text. It lies in the state store that the session names: Spark's own keeps it in executor
memory, RocksDB on their disks at 4 MB a partition or more; both save it in the shared folder.

Recovery: offsets, state and output are in the shared work folder; Spark's file sink writes each micro-batch once.

Defined results: NULL texts are empty, a NULL source is the part ``''``. Rows without id are nobody's smaller copy and have
none, so they pass E; all rows of a text that have its smallest id pass E. Of several label rows of an id one with the value
1 decides. An empty table has no parts, so no rows. Other columns are not read.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import permutations
from math import factorial

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from gaugemill.session import work_dir

FILTERS = "ABCDE"
COPY, GOOD, TOXIC = 16, 32, 64  # bits of a mask after those of A to D
SALTS = 16
HELD_TEXTS = 50_000  # texts and counts a task holds before it hands them on
ROUNDS = 4
BUCKET_TEXTS = 500  # rows of the table per bucket of texts: Spark calls Python once per bucket, which costs milliseconds
WORD_GAP = r"[\x20\x09-\x0D]+"


def failed_by_text(text: str, words: str) -> Column:
    """Mask of the filters A to D that a text with these words fails."""
    n, length = F.size(words).cast("bigint"), F.length(text).cast("bigint")
    failed = (
        n < 200,
        100 * F.size(F.array_distinct(words)) < 50 * n,
        100 * (length - F.length(F.regexp_replace(text, "[A-Z]", ""))) > 2 * length,
        F.col(text).rlike(r"[#$%&*|]"),
    )
    return sum((F.when(f, F.lit(1 << i)).otherwise(F.lit(0)) for i, f in enumerate(failed)), F.lit(0))


def masked(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Id, part, digest and mask of every row; native, and the same for a table and a stream."""
    flags = labels.groupBy("doc_id").agg(*[F.max((F.col(c) == 1).cast("int")).alias(c) for c in ("quality", "toxic")])
    flags = flags.where("doc_id IS NOT NULL AND (quality = 1 OR toxic = 1)")
    flags = flags.select(F.col("doc_id").alias("id"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"), "quality", "toxic")
    rows = docs.select(
        docs["doc_id"].cast("bigint").alias("id"),
        F.coalesce(docs["source"].cast("string"), F.lit("")).alias("part"),
        F.coalesce(docs["text"], F.lit("")).alias("text"),
    )
    rows = rows.withColumn("words", F.filter(F.split("text", WORD_GAP), lambda w: w != ""))
    rows = rows.select(
        "id", "part", F.sha2(F.col("text").cast("binary"), 256).alias("digest"), failed_by_text("text", "words").alias("mask"),
        F.floor(F.rand() * SALTS).cast("int").alias("salt"),
    )
    rows = rows.withColumn("own", F.coalesce("id", -F.abs(F.hash("digest")).cast("bigint") - 1))  # spreads rows without id
    # by the labels' bytes on disk the planner would broadcast their SALTS copies, which grow with the table
    joined = rows.join(flags.withColumnRenamed("id", "own").hint("merge"), ["own", "salt"], "left")
    bits = F.when((F.col("quality") == 1) & F.col("id").isNotNull(), GOOD).otherwise(0) + F.when((F.col("toxic") == 1) & F.col("id").isNotNull(), TOXIC).otherwise(0)
    return joined.select("id", "part", "digest", (F.col("mask") + bits).cast("int").alias("mask"))


CHANGE = "key string, id long, part string, mask int, n long"


def gathered(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's rows as counts of failing rows (key ``#``, part and mask) and the smallest id of each text (key: digest).

    A row with an id counts as failing E here; the state says which ones pass after all.
    """
    counts: Counter = Counter()
    texts: dict[str, tuple[int, Counter]] = {}
    for batch in batches:
        for i, part, digest, mask in zip(*(batch.column(c).to_pylist() for c in ("id", "part", "digest", "mask")), strict=True):
            if i is None:
                counts[part, mask] += 1
                continue
            counts[part, mask | COPY] += 1
            held = texts.get(digest)
            if held is None or i < held[0]:
                texts[digest] = held = (i, Counter())
            if i == held[0]:
                held[1][part, mask] += 1
        if len(texts) + len(counts) > HELD_TEXTS:
            yield _changes(counts, texts)
            counts, texts = Counter(), {}
    if counts:
        yield _changes(counts, texts)


def _changes(counts: Counter, texts: dict[str, tuple[int, Counter]]) -> pa.RecordBatch:
    rows = [(f"#{mask}#{part}", None, part, mask, n) for (part, mask), n in counts.items()]
    rows += [(digest, i, part, mask, n) for digest, (i, own) in texts.items() for (part, mask), n in own.items()]
    kinds = (pa.string(), pa.int64(), pa.string(), pa.int32(), pa.int64())
    return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=["key", "id", "part", "mask", "n"])


def retract(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Signed counts from the changes of a bucket of texts; the state has each text's smallest id and the rows with it."""
    texts = {digest: (i, Counter({(part, mask): n for part, mask, n in own})) for digest, i, own in json.loads(state.get[0])} if state.exists else {}
    signed: Counter = Counter()

    def passing(own: Counter, sign: int) -> None:
        for (part, mask), n in own.items():
            signed[part, mask] += sign * n
            signed[part, mask | COPY] -= sign * n

    for frame in frames:
        for digest, i, part, mask, n in zip(*(frame[c].tolist() for c in ("key", "id", "part", "mask", "n")), strict=True):
            if digest.startswith("#"):
                signed[part, mask] += n
                continue
            i, own = int(i), Counter({(part, mask): n})
            held = texts.get(digest)
            if held is None or i < held[0]:
                if held is not None:
                    passing(held[1], -1)
                texts[digest] = (i, own)
                passing(own, 1)
            elif i == held[0]:
                held[1].update(own)
                passing(own, 1)
    state.update((json.dumps([(digest, i, [(part, mask, n) for (part, mask), n in own.items()]) for digest, (i, own) in texts.items()]),))
    yield pd.DataFrame([(part, mask, n) for (part, mask), n in signed.items() if n], columns=["part", "mask", "n"])


def streamed_counts(spark: SparkSession, path: str, labels: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """Rows per part and mask over all files at ``path``, by a stream of about ``rounds`` micro-batches."""
    table = spark.read.parquet(path)
    buckets = -(-table.count() // BUCKET_TEXTS) + 1
    per_round = max(1, -(-len(table.inputFiles()) // rounds))
    pattern = f"{path[:-1]}[{path[-1]}]"  # as a pattern the path may also be that of a single file
    docs = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", per_round).parquet(pattern)
    signed = (
        masked(docs, labels).mapInArrow(gathered, CHANGE).withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets))).groupBy("bucket")
        .applyInPandasWithState(retract, "part string, mask int, n long", "texts string", "append", GroupStateTimeout.NoTimeout)
    )
    folder = work_dir(spark, "filter-audit")
    query = (
        signed.writeStream.format("parquet").option("path", f"{folder}/counts").option("checkpointLocation", f"{folder}/checkpoint")
        .outputMode("append").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    counts = spark.read.schema("part string, mask int, n long").parquet(f"{folder}/counts")
    return counts.groupBy("part", "mask").agg(F.sum("n").alias("n")).where("n <> 0")


def orders() -> list[tuple[str, int, int, int, int]]:
    """Every order and step with the place of its filter and the sets of filters before and after it."""
    out = []
    for order in map("".join, permutations(FILTERS)):
        before = 0
        for step, name in enumerate(order, 1):
            place = FILTERS.index(name)
            after = before | 1 << place
            out.append((order, step, place, before, after))
            before = after
    return out


def audit(counts: DataFrame) -> DataFrame:
    """Figures of every order and step per part, from rows per part and mask."""
    bits = [1 << i for i in range(len(FILTERS))]
    sets = range(1 << len(FILTERS))
    failed = F.col("mask").bitwiseAND(F.lit(len(sets) - 1))

    def rows_where(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col("n")).otherwise(F.lit(0)))

    def survivors(which: Column) -> Column:
        """Rows that survive each set of filters, at the place of the set."""
        return F.array(*[rows_where(which & (failed.bitwiseAND(F.lit(s)) == 0)) for s in sets])

    good, toxic = (F.col("mask").bitwiseAND(F.lit(b)) != 0 for b in (GOOD, TOXIC))
    parts = counts.groupBy("part").agg(
        survivors(F.lit(True)).alias("left"), survivors(good).alias("good"), survivors(toxic).alias("toxic"),
        F.array(*[rows_where(failed == b) for b in bits]).alias("only"),
    )

    def over_all_orders(bit: int) -> Column:
        """Rows that a filter removes, summed over the orders: a set stands before it in so many of them."""
        parts_of_sum = []
        for s in sets:
            if not s & bit:
                before = s.bit_count()
                times = factorial(before) * factorial(len(FILTERS) - 1 - before)
                parts_of_sum.append(times * (F.col("left")[s] - F.col("left")[s | bit]))
        return sum(parts_of_sum[1:], parts_of_sum[0])

    parts = parts.withColumn("shared", F.array(*[over_all_orders(b) for b in bits]))
    table = F.array(*[F.struct(*[F.lit(v).alias(k) for k, v in zip(("filter_order", "step", "place", "before", "after"), row, strict=True)]) for row in orders()])
    rows = parts.withColumn("s", F.explode(table)).select("*", "s.*")

    def lost(survivors: str) -> Column:
        return F.col(survivors)[F.col("before")] - F.col(survivors)[F.col("after")]

    failing = F.col("left")[0] - F.col("left")[F.element_at(F.array(*map(F.lit, bits)), F.col("place") + 1)]
    return rows.select(
        "part", "filter_order", "step", F.col("left")[F.col("after")].alias("kept"), lost("left").alias("removed"), (failing - lost("left")).alias("redundant"),
        F.col("only")[F.col("place")].alias("unique_fails"), lost("good").alias("good_lost"), lost("toxic").alias("toxic_lost"),
        F.col("shared")[F.col("place")].alias("shapley"),
    )


def filter_audit(spark: SparkSession, path: str, labels: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """One row per part, order and step of the table of documents whose files lie at ``path``."""
    return audit(streamed_counts(spark, path, labels, rounds))
