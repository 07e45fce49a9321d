"""Exact distribution statistics of many columns at once: order statistics and two-sample KS.

A running sum over all values of a column would put the whole column into one task. Instead the value range
of each column is cut at approximate quantiles of a row sample (like the range partitioner of a sort; the
cuts decide the balance, never the result), rows are counted per range, and only ranges that can hold an
asked-for rank or the largest distance are looked at value by value, one task per range. Equal values are
counted before every shuffle, so a value shared by a third of all rows is one record per map task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugemill.functions.numeric import numeric_column
from gaugemill.session import work_dir

ROWS_PER_RANGE = 1_000_000
MAX_RANGES = 16_384
SAMPLE_PER_RANGE = 40


def tagged_sides(
    reference: DataFrame | None, current: DataFrame | None, columns: Sequence[str], sides: DataFrame | None = None
) -> DataFrame:
    """Coerced values of both frames under each other, with ``is_ref`` telling them apart.

    ``sides`` brings both already marked, out of one scan. ``+ 0.0`` turns -0.0 into 0.0, so that both fall into
    the same range.
    """
    def values(df: DataFrame, is_ref: Column) -> DataFrame:
        return df.select(is_ref.alias("is_ref"), *((numeric_column(df, c) + F.lit(0.0)).alias(c) for c in columns))

    if sides is not None:
        return values(sides, F.col("is_ref"))
    both = values(reference, F.lit(True))
    return both if current is None else both.unionByName(values(current, F.lit(False)))


def range_cuts(
    sides: DataFrame, columns: Sequence[str], n: int, rows_per_range: int = ROWS_PER_RANGE, seed: int = 7
) -> dict[str, list[float]]:
    """Inner cut points per column of ``n`` rows, collected: at most ``MAX_RANGES`` numbers each.

    Small inputs need no cuts. The sample size depends on the number of ranges, not on the table.
    """
    ranges = min(MAX_RANGES, -(-n // rows_per_range))
    if ranges <= 1:
        return {c: [] for c in columns}
    fraction = min(1.0, ranges * SAMPLE_PER_RANGE / n)
    sample = sides if fraction == 1.0 else sides.sample(False, fraction, seed)
    at = [i / ranges for i in range(1, ranges)]
    found = sample.agg(*(F.percentile_approx(c, at, ranges * 10).alias(c) for c in columns)).first()
    inf = float("inf")
    return {c: sorted({v for v in found[c] or [] if -inf < v < inf}) for c in columns}


def long_values(sides: DataFrame, columns: Sequence[str], cuts: Mapping[str, list[float]]) -> DataFrame:
    """Rows ``(f, is_ref, part, v)``, missing values left out; ``f`` is the column's position, ``part`` numbers the
    value ranges."""
    inf = float("inf")
    cut = [c for c in columns if cuts.get(c)]
    if cut:
        sides = Bucketizer(
            splitsArray=[[-inf, *cuts[c], inf] for c in cut],
            inputCols=cut,
            outputCols=[f"{c}__part" for c in cut],
            handleInvalid="keep",
        ).transform(sides)
    cells = ", ".join(
        f"struct({i} AS f, {f'CAST(`{c}__part` AS INT)' if c in cut else '0'} AS part, `{c}` AS v)"
        for i, c in enumerate(columns)
    )
    return sides.select("is_ref", F.expr(f"inline(array({cells}))")).filter("v IS NOT NULL")


COUNTS = ("count_if(is_ref) AS n_ref", "count_if(NOT is_ref) AS n_cur")


def _counts() -> list[Column]:
    return [F.expr(c) for c in COUNTS]


def _rank(p: float, size: str, end: str) -> str:
    """Rank (from 0) below or above the quantile ``p`` of ``size`` values, as SQL; ``end`` is floor or ceil."""
    return f"{end}(({size} - 1) * {float(p)!r}D)"


def _range_table(long: DataFrame) -> DataFrame:
    """Counts per value range with the counts of all lower ranges; at most ranges × features rows."""
    by_feature = Window.partitionBy("f")
    below = by_feature.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return long.groupBy("f", "part").agg(*_counts()).select(
        "f", "part", "n_ref", "n_cur",
        F.coalesce(F.sum("n_ref").over(below), F.lit(0)).alias("below_ref"),
        F.coalesce(F.sum("n_cur").over(below), F.lit(0)).alias("below_cur"),
        F.sum("n_ref").over(by_feature).alias("size_ref"),
        F.sum("n_cur").over(by_feature).alias("size_cur"),
    )


def _with_needed(ranges: DataFrame, probabilities: Sequence[float], ks: bool) -> DataFrame:
    """Mark the ranges whose values matter; ``edge_distance`` is the KS distance seen at range ends alone."""
    needed = [
        f"(below_ref <= {_rank(p, 'size_ref', end)} AND {_rank(p, 'size_ref', end)} < below_ref + n_ref)"
        for p in probabilities
        for end in ("floor", "ceil")
    ]
    edge_distance = F.lit(None).cast("double")
    if ks:
        # between the ends the distance stays within [start - current share, start + reference share]
        ranges = ranges.withColumn("start", F.expr("try_divide(below_ref, size_ref) - try_divide(below_cur, size_cur)"))
        ranges = ranges.withColumns({
            "up": F.expr("try_divide(n_ref, size_ref)"), "down": F.expr("try_divide(n_cur, size_cur)"),
        })
        edge_distance = F.max(F.expr("abs(start + up - down)")).over(Window.partitionBy("f"))
        needed.append("greatest(abs(start + up), abs(start - down)) >= edge_distance - 1e-12")
    ranges = ranges.withColumn("edge_distance", edge_distance)
    return ranges.withColumn("needed", F.expr(f"coalesce({' OR '.join(needed) or 'false'}, false)"))


def _summarize(running: DataFrame, probabilities: Sequence[float], ks: bool, *extra: Column) -> DataFrame:
    """Per column the largest distance and the rows holding an asked-for rank, from running counts.

    A rank lies in exactly one row, so the list holds at most two rows per probability.
    """
    distance = "max(abs(try_divide(upto_ref, size_ref) - try_divide(upto_cur, size_cur)))" if ks else "max(CAST(NULL AS DOUBLE))"
    found = [F.expr(f"{distance} AS inner_distance"), *extra]
    if not probabilities:
        return running.groupBy("f").agg(*found, F.lit(None).alias("holders"))
    holds = " OR ".join(
        f"(upto_ref - n_ref <= {_rank(p, 'size_ref', 'ceil')} AND {_rank(p, 'size_ref', 'floor')} < upto_ref)" for p in probabilities
    )
    row = "named_struct('first', upto_ref - n_ref, 'end', upto_ref, 'v', v)"
    # used twice, the column stays a generated projection and is not evaluated inside collect_list
    marked = running.withColumn("holder", F.expr(f"CASE WHEN n_ref > 0 AND ({holds}) THEN {row} END"))
    return marked.groupBy("f").agg(*found, F.collect_list("holder").alias("holders"), F.count("holder").alias("n_holders"))


def _quantiles(probabilities: Sequence[float]) -> Column:
    """Interpolated from whichever end is nearer, so that equal ends give that very value."""
    if not probabilities:
        return F.expr("CAST(array() AS array<double>)")
    numbers = ", ".join(f"{float(p)!r}D" for p in probabilities)

    def value(rank: str) -> str:
        return f"get(filter(holders, r -> r.first <= {rank} AND {rank} < r.end), 0).v"

    at = "(n_reference - 1) * p"
    ends = f"transform(array({numbers}), p -> named_struct('w', {at} - floor({at}), 'lo', {value(f'floor({at})')}, 'hi', {value(f'ceil({at})')}))"
    between = "CASE WHEN e.w >= 0.5 THEN e.hi - (e.hi - e.lo) * (1 - e.w) ELSE e.lo + (e.hi - e.lo) * e.w END"
    return F.expr(f"CASE WHEN n_holders > 0 THEN transform({ends}, e -> {between}) END")


def rank_profile(
    reference: DataFrame | None,
    current: DataFrame | None,
    columns: Sequence[str],
    probabilities: Sequence[float] = (),
    ks: bool = True,
    rows_per_range: int = ROWS_PER_RANGE,
    sides: DataFrame | None = None,
    n_rows: int | None = None,
) -> DataFrame:
    """One row per column with values: ``feature, n_reference, n_current, ks_statistic, quantiles``.

    ``quantiles`` holds the exact linearly interpolated quantiles of the reference side. Columns without a
    single value have no row. Up to ``rows_per_range`` rows a column is one range and one scan does; beyond,
    the cuts and the counts per range are found first.
    """
    sides = tagged_sides(reference, current, columns, sides)
    n_rows = sides.count() if n_rows is None else n_rows
    cuts = range_cuts(sides, columns, n_rows, rows_per_range)
    if any(cuts.values()):
        return _profile_by_range(long_values(sides, columns, cuts), columns, probabilities, ks)
    # a small table often is a single split: dealing out at most ``rows_per_range`` rows uses all cores
    dealt = sides.repartition(sides.sparkSession.sparkContext.defaultParallelism, *columns)
    long = long_values(dealt, columns, {})
    by_feature = Window.partitionBy("f")
    upto = by_feature.orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    running = long.groupBy("f", "v").agg(*_counts()).select(
        "f", "v", "n_ref",
        F.sum("n_ref").over(upto).alias("upto_ref"), F.sum("n_cur").over(upto).alias("upto_cur"),
        F.sum("n_ref").over(by_feature).alias("size_ref"), F.sum("n_cur").over(by_feature).alias("size_cur"),
    )
    found = _summarize(
        running, probabilities, ks, F.max("size_ref").alias("n_reference"), F.max("size_cur").alias("n_current")
    )
    return found.select(
        _name(columns), "n_reference", "n_current", F.col("inner_distance").alias("ks_statistic"), _quantiles(probabilities).alias("quantiles")
    )


def _name(columns: Sequence[str]) -> Column:
    return F.get(F.array(*(F.lit(c) for c in columns)), F.col("f")).alias("feature")


def _profile_by_range(long: DataFrame, columns: Sequence[str], probabilities: Sequence[float], ks: bool) -> DataFrame:
    spark = long.sparkSession
    # written once: several joins below read it, and none may count the source again
    path = work_dir(spark, "ranges")
    _with_needed(_range_table(long), probabilities, ks).write.parquet(path)
    ranges = spark.read.parquet(path)
    # at most MAX_RANGES rows per feature: safe to broadcast
    wanted = F.broadcast(ranges.filter("needed").select("f", "part", "below_ref", "below_cur", "size_ref", "size_cur"))
    values = (
        long.join(wanted.select("f", "part"), ["f", "part"], "left_semi")
        .groupBy("f", "part", "v")
        .agg(*_counts())
    )
    upto = Window.partitionBy("f", "part").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    running = values.select(
        "f", "part", "v", "n_ref",
        F.sum("n_ref").over(upto).alias("run_ref"), F.sum("n_cur").over(upto).alias("run_cur"),
    ).join(wanted, ["f", "part"]).withColumns(
        {"upto_ref": F.expr("below_ref + run_ref"), "upto_cur": F.expr("below_cur + run_cur")}
    )
    detail = _summarize(running, probabilities, ks)
    sizes = ranges.groupBy("f").agg(
        F.max("size_ref").alias("n_reference"),
        F.max("size_cur").alias("n_current"),
        F.max("edge_distance").alias("edge_distance"),
    )
    return sizes.join(detail, "f", "left").select(
        _name(columns), "n_reference", "n_current",
        F.greatest("edge_distance", "inner_distance").alias("ks_statistic"),
        _quantiles(probabilities).alias("quantiles"),
    )
