"""How the sources of a language differ in their words, priced by segment trees over term ids.

Terms are counted per language and source in one pass over the texts. The terms a language keeps are dealt by hash into
blocks of some hundred; within a block a term's id is its rank. The counts of one source in one block are the leaves of a
segment tree. Trees are hash-consed: on every level a node's name is the rank of its content among the contents of the
block's sources (a count for leaves, the names of both children above), so identical subtrees of any sources are one node.
Two trees are walked at the same time from their roots: a pair of nodes that turns up at several places of the walk is
held once with the number of its places and priced once, on the leaves, where a pair is two counts. The price of two
sources is the sum over the blocks, which are independent tasks; sources are dealt into squares of ``SIDE`` x ``SIDE``,
so no task gets more than two sides of one block.

All arithmetic is exact: decimals or integers in Spark, integers in the tasks.

Defined results: NULL text, language and source are empty strings; a group without a kept term has the price of its zero
counts; a language without kept terms has price 0 throughout. Groups occur if a row does. Repeated rows count as often as
they occur. An empty table has no rows. Other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugemill.llm._rows import written

LEAST_DOCS = 10
TOP = 10
BLOCK_TERMS = 512
SIDE = 32
HELD_TERMS = 250_000  # terms a task counts before it hands them on
LONG = 1 << 20  # bytes of text from which terms are walked one by one, not held in one list

UNIT = 1_000_000_000
TERM = re.compile(rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWERED = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


# --- counting ---------------------------------------------------------------------------------------------------------


def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's texts as (lang, source, term, occurrences, documents), equal terms of a group added up as far as memory goes."""
    groups: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    held = 0
    for batch in batches:
        for lang, source, text in zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), batch.column("text"), strict=True):
            text = text.as_buffer().to_pybytes().translate(LOWERED)
            terms = Counter(TERM.findall(text)) if len(text) < LONG else Counter(m.group() for m in TERM.finditer(text))
            n, docs = groups.setdefault((lang, source), (Counter(), Counter()))
            held -= len(n)
            n.update(terms)
            docs.update(terms.keys())
            held += len(n)
            if held > HELD_TERMS:
                yield from _counts(groups)
                groups, held = {}, 0
    yield from _counts(groups)


def _counts(groups: dict[tuple[str, str], tuple[Counter, Counter]]) -> Iterator[pa.RecordBatch]:
    for (lang, source), (n, docs) in groups.items():
        if n:
            size = len(n)
            columns = [
                pa.repeat(pa.scalar(lang, pa.string()), size), pa.repeat(pa.scalar(source, pa.string()), size),
                pa.array(n.keys(), pa.binary()).cast(pa.string()), pa.array(n.values(), pa.int64()), pa.array([docs[t] for t in n], pa.int64()),
            ]
            yield pa.record_batch(columns, names=["lang", "source", "term", "n", "docs"])


def probability(count: Column, total: Column, terms: Column) -> Column:
    """``1 + floor(UNIT * (count + 2) / (total + 2 * terms))`` in exact arithmetic."""
    wide = lambda c: c.cast("decimal(20,0)")
    return 1 + F.call_function("div", F.lit(UNIT).cast("decimal(10,0)") * wide(count + 2), wide(total + 2 * terms))


def price(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


# --- trees ------------------------------------------------------------------------------------------------------------


def consed(counts: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Trees over the rows of ``counts`` (sources x terms, a power of two wide), nodes shared by content.

    Returns the distinct counts (the leaves' contents) and, from the leaves' parents up to the root, the distinct pairs of
    children; a node's name on a level is its place in that level's table. The last table's places per source are the roots.
    """
    leaves, names = np.unique(counts, return_inverse=True)
    names = names.reshape(counts.shape)
    tables = []
    while names.shape[1] > 1:
        pairs = names[:, 0::2].astype(np.int64) << 32 | names[:, 1::2]
        contents, places = np.unique(pairs, return_inverse=True)
        names = places.reshape(pairs.shape)
        tables.append(np.stack([contents >> 32, contents & 0xFFFFFFFF], axis=1))
    return leaves, [*tables, names[:, 0]]


def walk(roots: np.ndarray, tables: list[np.ndarray], first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, ...]:
    """Walk the trees ``first[i]`` and ``second[i]`` together; pairs of leaves per ``i`` with the number of their places."""
    pair, a, b, places = np.arange(len(first)), roots[first], roots[second], np.ones(len(first), np.int64)
    for table in reversed(tables):
        pair, a, b, places = np.tile(pair, 2), table[a].T.ravel(), table[b].T.ravel(), np.tile(places, 2)
        width = int(max(a.max(), b.max())) + 1
        if len(first) * width * width < 1 << 62:
            key, start = np.unique((pair * width + a) * width + b, return_inverse=True)
            a, b, pair = key // width % width, key % width, key // width // width
        else:
            key, start = np.unique(np.stack([pair, a, b], axis=1), axis=0, return_inverse=True)
            pair, a, b = key.T
        places = np.bincount(start.ravel(), weights=places, minlength=len(key)).astype(np.int64)  # at most the block's terms
    return pair, a, b, places


def priced(rows: pd.DataFrame) -> pd.DataFrame:
    """Prices of the pairs of sources of one square in one block.

    Rows have a source's number ``g``, its ``whole`` (its total and twice the language's terms), and a term's count ``n``;
    every source of the square is there, with one row without term.
    """
    lang, side_a, side_b = rows["lang"].iat[0], int(rows["square_a"].iat[0]), int(rows["square_b"].iat[0])
    named = rows["term"].notna().to_numpy()
    alone = rows[~named].sort_values("g")
    sources, wholes = alone["g"].to_numpy(), [int(x) for x in alone["whole"]]
    rows = rows[named]
    terms, t = np.unique(rows["term"].to_numpy(), return_inverse=True)
    counts = np.zeros((len(sources), 1 << max(0, len(terms) - 1).bit_length()), np.int64)
    counts[np.searchsorted(sources, rows["g"].to_numpy()), t] = rows["n"].to_numpy()
    side = alone["side"].to_numpy()
    first, second = np.triu_indices(len(sources), 1)
    wanted = (side[first] == side_a) & (side[second] == side_b)
    first, second = first[wanted], second[wanted]
    leaves, (*tables, roots) = consed(counts)
    p = np.array([[1 + UNIT * (int(c) + 2) // whole for c in leaves] for whole in wholes], np.int64)
    pair, a, b, places = walk(roots, tables, first, second)
    x, y = p[first[pair], a], p[second[pair], b]
    value = np.zeros(len(first), np.int64)
    np.add.at(value, pair, (x - y) ** 2 // (x + y) * places)
    padding = counts.shape[1] - len(terms)  # places beyond the block's terms are pairs of zero counts
    if padding:
        zero = p[:, np.searchsorted(leaves, 0)]
        value -= (zero[first] - zero[second]) ** 2 // (zero[first] + zero[second]) * padding
    return pd.DataFrame({"lang": lang, "a": sources[first], "b": sources[second], "value": value, "seen": len(terms)})


# --- plan -------------------------------------------------------------------------------------------------------------


def source_divergence(docs: DataFrame) -> DataFrame:
    """Part ``pair``: price of each other source of the language; part ``term``: the terms a source uses above its language."""
    rows = docs.select(*[F.coalesce(docs[c].cast("string"), F.lit("")).alias(c) for c in ("lang", "source")], F.coalesce(docs["text"], F.lit("")).cast("binary").alias("text"))
    occurring = docs.select(*[F.coalesce(docs[c].cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
    counts = rows.mapInArrow(counted, "lang string, source string, term string, n long, docs long")
    counts = written(counts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "divergence-counts")
    kept = counts.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs")).where(F.col("docs") >= LEAST_DOCS).drop("docs")
    kept = written(kept, "divergence-terms")
    found = written(counts.drop("docs").join(kept, ["lang", "term"]), "divergence-kept")

    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("lang_n").alias("lang_total"))
    totals = found.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    number = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    groups = occurring.join(totals, ["lang", "source"], "left").join(langs, "lang", "left").na.fill(0, ["total", "terms", "lang_total"])
    groups = written(groups.withColumn("g", number.cast("bigint")), "divergence-groups")

    pairs = _pairs(found, groups)
    terms = _terms(found, groups)
    return pairs.unionByName(terms)


def _terms(found: DataFrame, groups: DataFrame) -> DataFrame:
    rows = found.join(groups, ["lang", "source"])
    p, q = probability(F.col("n"), F.col("total"), F.col("terms")), probability(F.col("lang_n"), F.col("lang_total"), F.col("terms"))
    rows = rows.select("lang", "source", "term", p.alias("p"), q.alias("q")).where(F.col("p") > F.col("q"))
    rows = rows.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), price(F.col("p"), F.col("q")).alias("value"))
    return _ranked(rows).where(F.col("rank") <= TOP)


def _pairs(found: DataFrame, groups: DataFrame) -> DataFrame:
    last_side = groups.groupBy("lang").agg(F.floor(F.max("g") / SIDE).alias("last_side"))
    blocks = F.ceil(F.col("terms") / BLOCK_TERMS)
    sources = groups.where("terms > 0").join(last_side, "lang").select(
        "lang", "source", "g", (F.col("total") + 2 * F.col("terms")).alias("whole"), blocks.alias("blocks"), F.floor(F.col("g") / SIDE).alias("side"), "last_side",
    )
    with_terms = found.join(sources, ["lang", "source"]).withColumn("block", F.pmod(F.xxhash64("term"), F.col("blocks")))
    without = sources.select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("block"), F.lit(None).cast("string").alias("term"), F.lit(0).cast("bigint").alias("n"))
    shared = ["lang", "block", "g", "whole", "side", "last_side", "term", "n"]
    cells = with_terms.select(*shared).unionByName(without.select(*shared))
    cells = cells.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("last_side"))))
    cells = cells.select(
        "lang", "block", F.least("side", "other").alias("square_a"), F.greatest("side", "other").alias("square_b"), "g", "side", "whole", F.col("term").cast("binary").alias("term"), "n",
    )
    prices = cells.groupBy("lang", "block", "square_a", "square_b").applyInPandas(priced, "lang string, a long, b long, value long, seen long")
    prices = prices.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"), F.sum("seen").alias("seen"))

    one = groups.select("lang", F.col("g").alias("a"), F.col("source").alias("source_a"), F.col("total").alias("total_a"), "terms")
    two = groups.select("lang", F.col("g").alias("b"), F.col("source").alias("source_b"), F.col("total").alias("total_b"))
    every = one.join(two, "lang").where("a < b").join(prices, ["lang", "a", "b"], "left").na.fill(0, ["value", "seen"])
    zero = F.lit(0).cast("bigint")
    unseen = price(probability(zero, F.col("total_a"), F.col("terms")), probability(zero, F.col("total_b"), F.col("terms"))) * (F.col("terms") - F.col("seen"))
    value = F.when(F.col("terms") > 0, F.col("value") + unseen).otherwise(zero)
    ends = F.explode(F.array(F.struct(F.col("source_a").alias("source"), F.col("source_b").alias("item")), F.struct(F.col("source_b").alias("source"), F.col("source_a").alias("item"))))
    both = every.select("lang", value.alias("value"), ends.alias("ends"))
    return _ranked(both.select("lang", "ends.source", F.lit("pair").alias("part"), "ends.item", "value"))


def _ranked(rows: DataFrame) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    return rows.withColumn("rank", F.row_number().over(order)).select("lang", "source", "part", "item", "value", "rank")
