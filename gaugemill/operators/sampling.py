"""Splits, samples, folds and permutations that depend on a row key and a seed only.

Spark rows have no position, so the random order of a table is the order of ``md5(key:seed)``. A share of the
rows is a comparison with that digest and needs no shuffle. An exact number of rows needs ranks: rows are
counted per digest prefix, and only inside one prefix are they sorted, each prefix in a task of its own.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugemill.session import work_dir

PREFIX_DIGITS = 3
MIXING_ROUNDS = 4


def row_digest(keys: Sequence[str], seed: int) -> Column:
    """Hex digest of the row key and the seed."""
    return F.md5(F.concat_ws(":", *(F.col(k).cast("string") for k in keys), F.lit(str(seed))))


def in_share(keys: Sequence[str], share: float, seed: int) -> Column:
    """True for about ``share`` of the keys."""
    if share >= 1:
        return F.lit(True)
    return F.substring(row_digest(keys, seed), 1, 8) < F.lit(format(int(share * 16**8), "08x"))


def split_by_hash(df: DataFrame, keys: Sequence[str], test_size: float = 0.2, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """``(train, test)``, the same for every run and every layout of the table; no shuffle."""
    test = in_share(keys, test_size, seed)
    return df.filter(~test), df.filter(test)


def with_hash_rank(df: DataFrame, keys: Sequence[str], seed: int, name: str = "rank", digits: int = PREFIX_DIGITS) -> DataFrame:
    """``df`` with the position (from 0) of each row in digest order and the row count ``<name>_of``.

    ``keys`` must identify a row. Digest prefixes are evenly filled, so the 16^digits sorts are of even size
    for any distribution of the keys; take more digits for more than about 10 billion rows.
    """
    digest = f"__{name}_digest"
    marked = df.withColumn(digest, row_digest(keys, seed)).withColumn(f"__{name}_prefix", F.substring(digest, 1, digits))
    prefix = f"__{name}_prefix"
    whole = Window.partitionBy(F.lit(0))  # one row per prefix
    below = whole.orderBy(prefix).rowsBetween(Window.unboundedPreceding, -1)
    starts = df.select(F.substring(row_digest(keys, seed), 1, digits).alias(prefix)).groupBy(prefix).agg(
        F.count(F.lit(1)).alias("n")
    ).select(
        prefix,
        F.coalesce(F.sum("n").over(below), F.lit(0)).alias("__start"),
        F.sum("n").over(whole).alias(f"{name}_of"),
    )
    inside = F.row_number().over(Window.partitionBy(prefix).orderBy(digest, *keys))
    # at most 16^digits rows: safe to broadcast
    return (
        marked.withColumn("__inside", inside)
        .join(F.broadcast(starts), prefix)
        .withColumn(name, F.col("__start") + F.col("__inside") - 1)
        .drop("__inside", "__start", digest, prefix)
    )


def split_exact(df: DataFrame, keys: Sequence[str], test_size: float = 0.2, seed: int = 42, digits: int = PREFIX_DIGITS) -> tuple[DataFrame, DataFrame]:
    """``(train, test)`` with exactly ``ceil(test_size * n)`` test rows."""
    ranked = with_hash_rank(df, keys, seed, digits=digits)
    test = F.col("rank") < F.ceil(F.col("rank_of") * F.lit(test_size))
    return ranked.filter(~test).drop("rank", "rank_of"), ranked.filter(test).drop("rank", "rank_of")


def sample_rows(df: DataFrame, keys: Sequence[str], n: int, seed: int = 42, digits: int = PREFIX_DIGITS) -> DataFrame:
    """The first ``n`` rows in digest order, in as many partitions as the prefixes fill."""
    return with_hash_rank(df, keys, seed, digits=digits).filter(F.col("rank") < n).drop("rank", "rank_of")


def first_rows(df: DataFrame, keys: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` rows by key.

    Rows are dealt into key ranges, written, and counted per range: ranges wholly below ``n`` pass, the one that
    ``n`` falls into is cut by rank, later ones are not read.
    """
    part = "__range"
    path = work_dir(df.sparkSession, "key-ranges")
    df.repartitionByRange(*keys).withColumn(part, F.spark_partition_id()).write.parquet(path)
    rows = df.sparkSession.read.parquet(path)
    below = Window.partitionBy(F.lit(0)).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    starts = rows.groupBy(part).agg(F.count(F.lit(1)).alias("n")).select(part, F.coalesce(F.sum("n").over(below), F.lit(0)).alias("__start"))
    inside = F.row_number().over(Window.partitionBy(part).orderBy(*keys))
    kept = rows.join(F.broadcast(starts.filter(F.col("__start") < n)), part).withColumn("__inside", inside)
    return kept.filter(F.col("__start") + F.col("__inside") <= n).select(*df.columns)


def with_fold(df: DataFrame, keys: Sequence[str], folds: int, seed: int = 42, contiguous: bool = False, digits: int = PREFIX_DIGITS) -> DataFrame:
    """``df`` with a fold number from 0.

    By default the fold is the digest modulo ``folds``, without a shuffle. ``contiguous`` cuts the digest order
    into blocks whose sizes differ by at most one, the larger ones first.
    """
    if not contiguous:
        number = F.conv(F.substring(row_digest(keys, seed), 1, 8), 16, 10).cast("long")
        return df.withColumn("fold", F.pmod(number, F.lit(folds)).cast("int"))
    ranked = with_hash_rank(df, keys, seed, digits=digits)
    small = F.floor(F.col("rank_of") / folds)
    large = F.pmod(F.col("rank_of"), F.lit(folds))
    edge = large * (small + 1)
    block = F.when(F.col("rank") < edge, F.floor(F.try_divide(F.col("rank"), small + 1))).otherwise(
        large + F.floor(F.try_divide(F.col("rank") - edge, small))
    )
    return ranked.withColumn("fold", block.cast("int")).drop("rank", "rank_of")


def permuted_values(df: DataFrame, keys: Sequence[str], columns: Sequence[str], seed: int, digits: int = PREFIX_DIGITS) -> DataFrame:
    """``df`` with columns ``<c>__permuted``: the same values handed out in another order of the rows.

    Both orders are digest ranks, so each row gets the values of exactly one other row.
    """
    here = with_hash_rank(df, keys, 0, "here", digits).drop("here_of")
    there = with_hash_rank(df.select(*dict.fromkeys([*keys, *columns])), keys, seed, "there", digits)
    there = there.select(F.col("there").alias("here"), *(F.col(c).alias(f"{c}__permuted") for c in columns))
    return here.join(there, "here").drop("here")


def grid_of(n: int) -> tuple[int, int]:
    """Sides ``(a, b)`` of a grid of at least ``n`` cells, as few more as can be with ``a`` near the square root of ``n``."""
    top = max(1, math.isqrt(n))
    widths = range(top, max(0, top // 2 - 1, top - 1001), -1)
    return min(((a, -(-n // a)) for a in widths), key=lambda side: side[0] * side[1])


def permuted_rank(rank: Column, n: int, seed: Column) -> Column:
    """A permutation of the ranks ``0 .. n - 1`` that depends on ``seed`` alone: no sort, no table.

    The rank is a cell of a grid; in each round one coordinate is moved by a digest of the other, which can be undone, so
    no two cells meet. A cell beyond ``n`` is moved again until it lies within; there are fewer such cells than columns,
    and no walk can take more steps than there are cells beyond.
    """
    a, b = grid_of(n)

    def draw(value: Column, i: Column) -> Column:
        digest = F.md5(F.concat_ws(":", value.cast("string"), i.cast("string"), seed.cast("string")))
        return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")

    def cell(left: Column, right: Column) -> Column:
        return F.struct(left.cast("bigint").alias("left"), right.cast("bigint").alias("right"))

    def moved(c: Column, i: Column) -> Column:
        across = cell(F.pmod(c["left"] + draw(c["right"], i), F.lit(a)), c["right"])
        down = cell(c["left"], F.pmod(c["right"] + draw(c["left"], i), F.lit(b)))
        return F.when(i % 2 == 0, across).otherwise(down)

    def mixed(x: Column) -> Column:
        start = cell(F.pmod(x, F.lit(a)), F.floor(x / F.lit(a)))
        return F.aggregate(F.sequence(F.lit(0), F.lit(MIXING_ROUNDS - 1)), start, moved, lambda c: c["left"] + F.lit(a) * c["right"])

    out, beyond = mixed(rank), a * b - n
    if not beyond:
        return out
    return F.aggregate(F.sequence(F.lit(1), F.lit(beyond)), out, lambda x, _: F.when(x < n, x).otherwise(mixed(x)))


def dealt_values(ranked: DataFrame, n: int, columns: Sequence[str], seeds: Sequence[int], rank: str = "rank") -> DataFrame:
    """Rows of ``ranked`` once per seed, numbered ``repeat``, with ``<c>__permuted``: the values of the row that the seed's
    permutation of the ranks names. One join serves all seeds; every row gives its values away exactly once per seed."""
    numbered = F.posexplode(F.array(*(F.lit(s).cast("bigint") for s in seeds))).alias("repeat", "__seed")
    rows = ranked.select("*", numbered).withColumn("__from", permuted_rank(F.col(rank), n, F.col("__seed")))
    values = ranked.select(F.col(rank).alias("__from"), *(F.col(c).alias(f"{c}__permuted") for c in columns))
    return rows.join(values, "__from").drop("__from", "__seed")
