"""Helpers shared by the text operators: row identity, written intermediate tables, bounded membership filters."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugemill.session import work_dir

SIEVE_WORDS = 1 << 17
BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20


def text_key(text: str) -> Column:
    """Hash of a text; with the document id it names a row, and equal rows share it (they have equal results)."""
    return F.xxhash64(F.col(text))


def same_row(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    """Join condition on all keys in which NULL equals NULL."""
    condition = F.lit(True)
    for k in keys:
        condition = condition & left[k].eqNullSafe(right[k])
    return condition


def written(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared work folder and read back, so that later jobs and lost executors don't repeat the work."""
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sieve(keys: DataFrame, column: str, words: int = SIEVE_WORDS) -> DataFrame:
    """A bitmap of the hashes in ``column``: at most ``words`` rows of 64 bits, however many hashes there are."""
    return keys.groupBy(_word(F.col(column), words).alias("sieve_word")).agg(F.bit_or(_bit(F.col(column))).alias("sieve_bits"))


def sifted(df: DataFrame, key: Column, bitmap: DataFrame, words: int = SIEVE_WORDS) -> DataFrame:
    """Rows whose key may be in the bitmap. Its size is fixed by ``words``, so it can be broadcast whatever the input."""
    kept = df.withColumn("sieve_word", _word(key, words)).withColumn("sieve_bit", _bit(key))
    kept = kept.join(F.broadcast(bitmap), "sieve_word").where(F.col("sieve_bits").bitwiseAND(F.col("sieve_bit")) != 0)
    return kept.drop("sieve_word", "sieve_bit", "sieve_bits")


def unlisted(df: DataFrame, listed: DataFrame, keys: list[str], words: int = SIEVE_WORDS) -> DataFrame:
    """Rows of ``df`` whose keys are in no row of ``listed`` (NULL equals NULL).

    Rows whose hash is not in the bitmap of the listed keys pass where they are read. Only the others are moved, to be
    compared by the keys themselves, however many are listed.
    """
    bitmap = sieve(listed.select(F.xxhash64(*keys).alias("key")), "key", words)
    word, bit = _word(F.xxhash64(*keys), words), _bit(F.xxhash64(*keys))
    clear = df.withColumn("sieve_word", word).withColumn("sieve_bit", bit).join(F.broadcast(bitmap), "sieve_word", "left")
    clear = clear.where(F.coalesce("sieve_bits", F.lit(0).cast("long")).bitwiseAND(F.col("sieve_bit")) == 0).select(*df.columns)
    met = sifted(df, F.xxhash64(*keys), bitmap, words)
    own = listed.select(*[F.col(k).alias(f"listed_{k}") for k in keys]).distinct().withColumn("is_listed", F.lit(True))
    condition = F.lit(True)
    for k in keys:
        condition = condition & met[k].eqNullSafe(own[f"listed_{k}"])
    # an anti-join would be pushed below the bitmap, and move all rows
    return clear.unionByName(met.join(own, condition, "left").where("is_listed is null").select(*df.columns))


def _word(key: Column, words: int) -> Column:
    return F.pmod(F.shiftright(key, 6), F.lit(words))


def _bit(key: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), key.bitwiseAND(F.lit(63)).cast("int"))


def pairwise(first: str, second: str, by: int, fn) -> Column:
    """``fn`` of each element of ``first`` and the element of ``second`` that is ``by`` places further on."""
    n = F.greatest(F.size(second) - by, F.lit(0))
    return F.zip_with(F.slice(first, F.lit(1), n), F.slice(second, F.lit(by + 1), n), fn)


def numbered(docs: DataFrame, text: str = "text") -> tuple[DataFrame, list[str]]:
    """All columns as ``c0``, ``c1``, ... with the text once more as ``text``, so that added columns can't clash."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    return docs.toDF(*names).withColumn("text", F.col(names[docs.columns.index(text)])), names


def small_batches(spark: SparkSession, most_bytes: int = BATCH_BYTES) -> None:
    """Let the session hand rows to Python in batches of at most so many bytes, unless it names fewer itself.

    By rows alone a batch of long texts has no bound, and it is held by the JVM and by Python, in each task.
    """
    held = spark.conf.get(BATCH_SETTING, None)
    if held is None or not held.isdigit() or int(held) > most_bytes:
        spark.conf.set(BATCH_SETTING, str(most_bytes))


def slices(batch: pa.RecordBatch, column: str, most_bytes: int | None) -> Iterator[pa.RecordBatch]:
    """The batch in slices of rows whose texts take at most so many bytes together; a longer text is a slice of its own."""
    start, held = 0, 0
    for i, n in enumerate(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist() if most_bytes else ()):
        if held and held + n > most_bytes:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    yield batch.slice(start)


def map_texts(
    docs: DataFrame, keep: Iterable[str], text: str, start: Callable[[], Callable[[list], list]], added: str, most_bytes: int | None = None,
) -> DataFrame:
    """Columns computed from whole texts, beside the columns in ``keep``, which pass through unread.

    ``start()`` is called once in each task and returns the function from a list of texts (None for NULL) to a list of
    Arrow arrays, one per column of the schema text ``added``. With ``most_bytes`` a list has no more text than that,
    or one text; else it is an Arrow batch.
    """
    keep = list(keep)
    own = [f"kept_{i}" for i in range(len(keep))]
    rows = docs.select(*[docs[c].alias(k) for k, c in zip(own, keep, strict=True)], docs[text].alias("text"))
    names = [x.split()[0] for x in added.split(", ")]
    schema = T.StructType([rows.schema[k] for k in own] + [T.StructField(x.split()[0], T._parse_datatype_string(x.split()[1])) for x in added.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = start()
        for batch in batches:
            for part in slices(batch, "text", most_bytes):
                if part.num_rows:
                    yield pa.record_batch([*part.select(own).columns, *compute(part.column("text").to_pylist())], names=[*own, *names])

    out = rows.mapInArrow(run, schema)
    return out.select(*[F.col(k).alias(c) for k, c in zip(own, keep, strict=True)], *names)
