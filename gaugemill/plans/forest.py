"""Random forests whose large nodes are split by summed histograms and whose small nodes are grown to the end in one task.

Spark's learner adds up a table of all bins for every node of every level, also for nodes of two rows; a deep forest on
small leaves spends its time on shuffling zeros. Here only nodes of more than ``LOCAL_ROWS`` rows are split that way. The rows
of a smaller node, at most that many, meet in one task, which grows the whole subtree. Rows, trees, depth and the other
settings are those asked for.

The model is Spark's own, whose nodes the driver holds, or (:class:`NodeForestRegressor`) one whose nodes stay in files, a tree
in each: the nodes of deep trees grow with the rows. Tasks read the trees one after the other and score their rows by each.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.ml import Model, regression
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasPredictionCol
from pyspark.ml.regression import RandomForestRegressionModel
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLWritable
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugemill.session import work_dir

LOCAL_ROWS = 100_000  # rows of a node, resampled ones counted, that one task takes
TABLE_BYTES = 64_000_000  # histograms a task holds before it hands them on
TASK_RECORDS = 400_000  # rows of nodes that a task gets, about
LOT_BYTES = 64_000_000  # features of rows that a task scores by a tree at a time
QUANTILE_ERROR = 0.001
TINY = 1e-14  # share of a tree's variance below which a gain or an impurity is rounding
TIE = 1e-9  # share of a node's squares within which two splits are equal, so that the first one wins whatever the order of sums

NODE = "tree int, root int, local int, prediction double, impurity double, n double, s double, q double, gain double, l int, r int, f int, cut int"
PACKED = "tree int, n long, nodes binary"  # column (-1: leaf), left child, threshold and prediction of each node
SPLIT = "tree int, node int, n double, s double, q double, gain double, f int, cut int, ln double"


# --- candidate thresholds -----------------------------------------------------------------------------------------------


def _matrix(batch: pa.RecordBatch, name: str = "x") -> np.ndarray:
    column = batch.column(name)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def thresholds(rows: DataFrame, width: int, most: int) -> list[np.ndarray]:
    """Per column at most ``most`` - 1 thresholds: between all values where there are at most ``most``, else above quantiles.

    ``rows`` has the column ``x``, arrays of ``width`` numbers. All rows are looked at.
    """

    def few(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: list[np.ndarray | None] = [np.empty(0)] * width
        for batch in batches:
            x = _matrix(batch)
            for j, known in enumerate(seen):
                if known is not None:
                    found = np.union1d(known, x[:, j])
                    seen[j] = found if len(found) <= most else None
        yield pa.RecordBatch.from_pydict({"f": pa.array(range(width), pa.int32()), "v": pa.array([None if v is None else v.tolist() for v in seen], pa.list_(pa.float64()))})

    values: list[np.ndarray | None] = [np.empty(0)] * width
    for r in rows.mapInArrow(few, "f int, v array<double>").collect():
        known = values[r["f"]]
        values[r["f"]] = None if known is None or r["v"] is None else np.union1d(known, r["v"])
    out = [np.empty(0) if v is None or len(v) > most else (v[:-1] + v[1:]) / 2 for v in values]
    many = [j for j, v in enumerate(values) if v is None or len(v) > most]
    if not many:
        return out
    shares = [i / most for i in range(1, most)]
    found = rows.select(*(F.col("x")[j].alias(f"x{j}") for j in many)).approxQuantile([f"x{j}" for j in many], shares, QUANTILE_ERROR)
    cuts = {j: np.unique(v) for j, v in zip(many, found, strict=True)}

    def following(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least = {j: np.full(len(c), np.inf) for j, c in cuts.items()}
        for batch in batches:
            x = _matrix(batch)
            for j, c in cuts.items():
                v = np.append(np.unique(x[:, j]), np.inf)
                least[j] = np.minimum(least[j], v[np.searchsorted(v[:-1], c, "right")])
        yield pa.RecordBatch.from_pydict({"f": pa.array(least, pa.int32()), "v": pa.array([v.tolist() for v in least.values()], pa.list_(pa.float64()))})

    above = {j: np.full(len(c), np.inf) for j, c in cuts.items()}
    for r in rows.mapInArrow(following, "f int, v array<double>").collect():
        above[r["f"]] = np.minimum(above[r["f"]], r["v"])
    for j, c in cuts.items():
        inside = np.isfinite(above[j])
        out[j] = (c[inside] + above[j][inside]) / 2
    return out


# --- rows of a tree -----------------------------------------------------------------------------------------------------


def _uniform(rows: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """Numbers in [0, 1) that depend on row, tree and seed alone (the finalizer of SplitMix64)."""
    start = (seed * 0x9E3779B97F4A7C15 + (tree + 1) * 0xD1B54A32D192ED03) & (2**64 - 1)
    z = rows.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(start)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB), (31, 0x9E3779B97F4A7C15), (29, 0xBF58476D1CE4E5B9)):
        z = (z ^ (z >> np.uint64(shift))) * np.uint64(factor)
    return ((z ^ (z >> np.uint64(32))) >> np.uint64(11)).astype(np.float64) / 2**53


def times_drawn(rows: np.ndarray, tree: int, seed: int, rate: float, bootstrap: bool) -> np.ndarray:
    """How often each row is in the tree's sample: Poisson with resampling, else a share ``rate`` of the rows once."""
    if not bootstrap:
        return np.ones(len(rows)) if rate >= 1 else (_uniform(rows, tree, seed) < rate).astype(np.float64)
    chances = [math.exp(-rate)]
    while chances[-1] > 1e-18 or len(chances) < 2:
        chances.append(chances[-1] * rate / len(chances))
    return np.searchsorted(np.cumsum(chances)[:-1], _uniform(rows, tree, seed), "right").astype(np.float64)


@dataclass(frozen=True)
class Growth:
    """Settings of a forest that the tasks need; ``widths`` are the bins of each column."""

    widths: tuple[int, ...]
    trees: int
    depth: int
    least: int
    min_gain: float
    tried: int
    seed: int
    rate: float
    bootstrap: bool

    def columns_tried(self, nodes: int, rng: np.random.Generator) -> np.ndarray | None:
        """Which columns each node may be split by; None: any."""
        d = len(self.widths)
        if self.tried >= d:
            return None
        allowed = np.zeros((nodes, d), bool)
        allowed[np.arange(nodes)[:, None], np.argsort(rng.random((nodes, d)), axis=1)[:, : self.tried]] = True
        return allowed

    def best_cut(self, hn: np.ndarray, hs: np.ndarray, n: np.ndarray, s: np.ndarray, tie: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per node the best last bin of the left side of a column, and the score n_l mean_l² + n_r mean_r² of that cut."""
        ln, ls = hn.cumsum(1)[:, :-1], hs.cumsum(1)[:, :-1]
        rn, rs = n[:, None] - ln, s[:, None] - ls
        with np.errstate(divide="ignore", invalid="ignore"):
            score = ls * ls / ln + rs * rs / rn
        score[(ln < self.least) | (rn < self.least)] = -np.inf
        cut = (score >= (score.max(1) - tie)[:, None]).argmax(1)
        return cut, score[np.arange(len(n)), cut]

    def splits(self, score: np.ndarray, n: np.ndarray, s: np.ndarray, tiny: float) -> tuple[np.ndarray, np.ndarray]:
        """Fall of the variance, and whether it is enough for a split."""
        gain = (score - s * s / n) / n
        return gain, (gain > tiny) & (gain >= self.min_gain)


def grow(bins: np.ndarray, times: np.ndarray, y: np.ndarray, g: Growth, levels: int, rng: np.random.Generator) -> dict[str, np.ndarray]:
    """Subtree of the rows given, level by level; children come after their parents."""
    mean = float(np.average(y, weights=times))
    y = y - mean
    columns, wy = np.ascontiguousarray(bins.T), times * y
    tiny = TINY * float(wy @ y) / float(times.sum())
    at, m, first, told = np.zeros(len(y), np.int64), 1, 0, []
    for level in range(levels + 1):
        n, s, q = (np.bincount(at, v, m) for v in (times, wy, wy * y))
        impurity = np.maximum(q / n - (s / n) ** 2, 0)
        f, cut, gain = np.full(m, -1), np.full(m, -1), np.full(m, -1.0)
        live = np.flatnonzero((impurity > tiny) & (n >= 2 * g.least)) if level < levels else np.empty(0, np.int64)
        if len(live):
            place = np.full(m, -1)
            place[live] = np.arange(len(live))
            inside = place[at] >= 0
            at, times, y, wy, columns = place[at[inside]], times[inside], y[inside], wy[inside], columns[:, inside]
            best, best_f, best_cut = np.full(len(live), -np.inf), np.full(len(live), -1), np.full(len(live), -1)
            allowed, tie = g.columns_tried(len(live), rng), TIE * (q - s * s / n)[live]
            for j, k in enumerate(g.widths):
                if k < 2:
                    continue
                key = at * k + columns[j]
                hn, hs = (np.bincount(key, v, len(live) * k).reshape(-1, k) for v in (times, wy))
                at_cut, score = g.best_cut(hn, hs, n[live], s[live], tie)
                better = score > best + tie if allowed is None else (score > best + tie) & allowed[:, j]
                best[better], best_f[better], best_cut[better] = score[better], j, at_cut[better]
            fall, split = g.splits(best, n[live], s[live], tiny)
            f[live[split]], cut[live[split]], gain[live[split]] = best_f[split], best_cut[split], fall[split]
            place = np.full(len(live), -1)
            place[split] = np.arange(split.sum())
            inside = place[at] >= 0
            times, y, wy, columns = times[inside], y[inside], wy[inside], columns[:, inside]
            at = at[inside]
            right = columns[best_f[at], np.arange(len(at))] > best_cut[at]
            at = 2 * place[at] + right
        left = np.full(m, -1)
        left[f >= 0] = first + m + 2 * np.arange((f >= 0).sum())
        told.append({
            "prediction": mean + s / n, "impurity": impurity, "n": n, "s": s + n * mean, "q": q + 2 * mean * s + n * mean * mean,
            "gain": gain, "l": left, "r": np.where(left >= 0, left + 1, -1), "f": f, "cut": cut,
        })
        first, m = first + m, 2 * int((f >= 0).sum())
        if not m:
            break
    return {k: np.concatenate([t[k] for t in told]) for k in told[0]}


# --- the forest ---------------------------------------------------------------------------------------------------------


@dataclass
class Top:
    """Nodes of a tree that were split over all tasks, as lists by node number. A node without column is a leaf, or handed to
    one task (``local``), or still to be split (``wide``)."""

    f: list[int]
    cut: list[int]
    left: list[int]
    depth: list[int]
    told: list[tuple]  # n, s, q, gain
    local: set[int]
    wide: set[int]

    def place(self, bins: np.ndarray) -> np.ndarray:
        """The node that each row ends in."""
        f, cut, left = (np.array(v) for v in (self.f, self.cut, self.left))
        at = np.zeros(len(bins), np.int64)
        moving = np.flatnonzero(f[at] >= 0)
        while len(moving):
            node = at[moving]
            at[moving] = left[node] + (bins[moving, f[node]] > cut[node])
            moving = moving[f[at[moving]] >= 0]
        return at


def _binary(rows: np.ndarray) -> pa.Array:
    n, width = rows.shape
    offsets = np.arange(n + 1, dtype=np.int32) * np.int32(width)
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(rows))])


def _bins(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    chunks = column.chunks if isinstance(column, pa.ChunkedArray) else [column]
    parts = []
    for c in chunks:
        offsets = np.frombuffer(c.buffers()[1], np.int32)[c.offset : c.offset + len(c) + 1]
        parts.append(np.frombuffer(c.buffers()[2], np.uint8)[offsets[0] : offsets[-1]].reshape(len(c), width))
    return np.concatenate(parts)


def _split_wide(rows: DataFrame, tops: Mapping[int, Top], g: Growth, tiny: float) -> DataFrame:
    """The best split of every node in ``wide``: histograms per task, summed per node."""
    starts = np.concatenate([[0], np.cumsum(g.widths)]).tolist()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], np.ndarray] = {}

        def told() -> pa.RecordBatch:
            keys, tables = list(held), [v.tobytes() for v in held.values()]
            held.clear()
            return pa.RecordBatch.from_pydict({"tree": pa.array([t for t, _ in keys], pa.int32()), "node": pa.array([v for _, v in keys], pa.int32()), "h": pa.array(tables, pa.binary())})

        for batch in batches:
            bins, number, y = _bins(batch.column("bins"), len(g.widths)), batch.column("row").to_numpy(), batch.column("y").to_numpy()
            for tree, top in tops.items():
                if not top.wide:
                    continue
                times, at = times_drawn(number, tree, g.seed, g.rate, g.bootstrap), top.place(bins)
                for node in top.wide:
                    mine = np.flatnonzero((at == node) & (times > 0))
                    t, v, b = times[mine], y[mine], bins[mine]
                    if (tree, node) not in held:
                        held[tree, node] = np.zeros((3, starts[-1]))
                    h = held[tree, node]
                    for j, k in enumerate(g.widths):
                        for i, weight in enumerate((t, t * v, t * v * v) if j == 0 else (t, t * v)):
                            h[i, starts[j] : starts[j + 1]] += np.bincount(b[:, j], weight, k)
                if len(held) * 24 * starts[-1] > TABLE_BYTES:
                    yield told()
        yield told()

    def best(key: tuple, table: pa.Table) -> pa.Table:
        tree, node = (k.as_py() for k in key)
        h = sum(np.frombuffer(v.as_py()).reshape(3, -1) for v in table.column("h"))
        n, s, q = (h[i, : g.widths[0]].sum(keepdims=True) for i in range(3))
        allowed = g.columns_tried(1, np.random.default_rng([g.seed, tree, node]))
        score, f, cut, tie = np.array([-np.inf]), -1, -1, TIE * (q - s * s / n)
        for j, k in enumerate(g.widths):
            if k > 1 and (allowed is None or allowed[0, j]):
                at_cut, found = g.best_cut(h[None, 0, starts[j] : starts[j + 1]], h[None, 1, starts[j] : starts[j + 1]], n, s, tie)
                if found[0] > score[0] + tie[0]:
                    score, f, cut = found, j, int(at_cut[0])
        gain, split = g.splits(score, n, s, tiny)
        f, cut = (f, cut) if split[0] and tops[tree].depth[node] < g.depth else (-1, -1)
        ln = h[0, starts[f] : starts[f] + cut + 1].sum() if f >= 0 else 0.0
        values = [tree, node, n[0], s[0], q[0], gain[0] if f >= 0 else -1.0, f, cut, ln]
        return pa.Table.from_arrays([pa.array([v], pa.int32() if i in (0, 1, 6, 7) else pa.float64()) for i, v in enumerate(values)], [c.split()[0] for c in SPLIT.split(", ")])

    return rows.mapInArrow(count, "tree int, node int, h binary").groupBy("tree", "node").applyInArrow(best, SPLIT)


def grow_tops(rows: DataFrame, n: int, variance: float, g: Growth) -> dict[int, Top]:
    """The upper nodes of all trees, down to where a node has at most ``LOCAL_ROWS`` rows."""
    drawn = n * g.rate
    tops = {t: Top([-1], [-1], [-1], [0], [()], set(), set()) for t in range(g.trees)}
    for top in tops.values():
        (top.wide if drawn > LOCAL_ROWS else top.local).add(0)
    while any(top.wide for top in tops.values()):
        for r in sorted(_split_wide(rows, tops, g, TINY * variance).collect(), key=lambda r: (r["tree"], r["node"])):
            top, node = tops[r["tree"]], r["node"]
            top.told[node] = (r["n"], r["s"], r["q"], r["gain"])
            top.wide.discard(node)
            if r["f"] < 0:
                continue
            top.f[node], top.cut[node], top.left[node] = r["f"], r["cut"], len(top.f)
            for size in (r["ln"], r["n"] - r["ln"]):
                child, depth = len(top.f), top.depth[node] + 1
                for values, v in ((top.f, -1), (top.cut, -1), (top.left, -1), (top.depth, depth), (top.told, ())):
                    values.append(v)
                (top.wide if size > LOCAL_ROWS else top.local).add(child)
    return tops


def grow_rest(rows: DataFrame, n: int, tops: Mapping[int, Top], g: Growth) -> DataFrame:
    """Nodes (``NODE``) of all subtrees: the rows of a node in ``local`` meet in one task."""
    width = len(g.widths)

    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins, number, y = _bins(batch.column("bins"), width), batch.column("row").to_numpy(), batch.column("y").to_numpy()
            for tree, top in tops.items():
                times, at = times_drawn(number, tree, g.seed, g.rate, g.bootstrap), top.place(bins)
                mine = np.flatnonzero((times > 0) & np.isin(at, list(top.local)))
                yield pa.RecordBatch.from_pydict({
                    "tree": pa.array(np.full(len(mine), tree, np.int32)), "root": pa.array(at[mine].astype(np.int32)), "row": pa.array(number[mine]),
                    "times": pa.array(times[mine]), "y": pa.array(y[mine]), "bins": _binary(bins[mine]),
                })

    def grown(key: tuple, table: pa.Table) -> pa.Table:
        tree, root = (k.as_py() for k in key)
        order = np.argsort(table.column("row").to_numpy())  # sums do not depend on the way rows came
        bins = _bins(table.column("bins"), width)[order]
        times, y = (table.column(c).to_numpy()[order] for c in ("times", "y"))
        found = grow(bins, times, y, g, g.depth - tops[tree].depth[root], np.random.default_rng([g.seed, tree, root]))
        size = len(found["n"])
        found = {"tree": np.full(size, tree), "root": np.full(size, root), "local": np.arange(size), **found}
        fields = [c.split() for c in NODE.split(", ")]
        return pa.table({c: pa.array(found[c].astype(np.int32 if t == "int" else np.float64)) for c, t in fields})

    records = n * g.trees * min(1.0, g.rate)
    parts = max(g.trees, math.ceil(records / TASK_RECORDS))
    routed = rows.mapInArrow(sent, "tree int, root int, row long, times double, y double, bins binary")
    return routed.repartition(parts, "tree", "root").groupBy("tree", "root").applyInArrow(grown, NODE)


def node_data(nodes: DataFrame, tops: Mapping[int, Top], cuts: Sequence[np.ndarray]) -> DataFrame:
    """Nodes as Spark's forests are saved: per tree numbered from 0, upper nodes first, parents before children."""
    spark = nodes.sparkSession
    sizes = nodes.groupBy("tree", "root").agg(F.count(F.lit(1)).alias("size"))
    upper = spark.createDataFrame([(t, len(top.f)) for t, top in tops.items()], "tree int, upper int")
    before = Window.partitionBy("tree").orderBy("root").rowsBetween(Window.unboundedPreceding, -1)
    # one row per subtree
    starts = sizes.join(F.broadcast(upper), "tree").select("tree", "root", (F.col("upper") - 1 + F.coalesce(F.sum(F.col("size") - 1).over(before), F.lit(0))).cast("int").alias("start"))
    table = F.array(*(F.array(*(F.lit(float(v)) for v in c)).cast("array<double>") for c in cuts))
    placed = nodes.join(F.broadcast(starts), ["tree", "root"])

    def number(local: Column) -> Column:
        return F.when(local == 0, F.col("root")).when(local < 0, F.lit(-1)).otherwise(F.col("start") + local).cast("int")

    columns = ["prediction", "impurity", "n", "s", "q", "gain", "f", "cut"]
    placed = placed.select("tree", number(F.col("local")).alias("id"), number(F.col("l")).alias("l"), number(F.col("r")).alias("r"), *columns)
    told = [
        (t, i, top.left[i], top.left[i] + 1 if top.left[i] >= 0 else -1, s / m, max(q / m - (s / m) ** 2, 0.0), m, s, q, gain, top.f[i], top.cut[i])
        for t, top in tops.items() for i in range(len(top.f)) if top.told[i] for m, s, q, gain in [top.told[i]]
    ]
    if told:
        placed = placed.unionByName(spark.createDataFrame(told, placed.schema))
    leaf = F.col("f") < 0
    at = F.when(leaf, F.array().cast("array<double>")).otherwise(F.array(table[F.col("f")][F.col("cut")]))
    split = F.struct(F.col("f").alias("featureIndex"), at.alias("leftCategoriesOrThreshold"), F.lit(-1).alias("numCategories"))
    return placed.select(
        F.col("tree").alias("treeID"),
        F.struct(
            "id", "prediction", "impurity", F.array("n", "s", "q").alias("impurityStats"), F.col("n").cast("long").alias("rawCount"), "gain",
            F.col("l").alias("leftChild"), F.col("r").alias("rightChild"), split.alias("split"),
        ).alias("nodeData"),
    )


def packed(nodes: DataFrame, tops: Mapping[int, Top], cuts: Sequence[np.ndarray]) -> DataFrame:
    """Nodes (``NODE``) of all subtrees with the upper nodes, one row (``PACKED``) per tree. A right child follows its left one."""

    def pack(key: tuple, table: pa.Table) -> pa.Table:
        tree = key[0].as_py()
        top = tops[tree]
        root, local, prediction, left, column, cut = (table.column(c).to_numpy() for c in ("root", "local", "prediction", "l", "f", "cut"))
        order = np.lexsort((local, root))
        root, local, prediction, left, column, cut = (v[order] for v in (root, local, prediction, left, column, cut))
        upper = len(top.f)
        _, first, sizes = np.unique(root, return_index=True, return_counts=True)
        start = np.repeat(upper - 1 + np.cumsum(sizes - 1) - (sizes - 1), sizes)
        at = np.where(local == 0, root, start + local)
        n = upper + int((sizes - 1).sum())
        f, to, p, v = np.array([*top.f, *[-1] * (n - upper)], np.int32), np.full(n, -1, np.int32), np.zeros(n), np.zeros(n)
        to[:upper], where = top.left, np.zeros(n, np.int64)
        where[:upper] = top.cut
        p[:upper] = [told[1] / told[0] if told else 0.0 for told in top.told]
        f[at], p[at], to[at], where[at] = column, prediction, np.where(left < 0, -1, start + left), cut
        for j, values in enumerate(cuts):
            mine = f == j
            v[mine] = values[where[mine]]
        return pa.table({"tree": pa.array([tree], pa.int32()), "n": pa.array([n], pa.int64()), "nodes": pa.array([b"".join(x.tobytes() for x in (f, to, v, p))], pa.binary())})

    return nodes.select("tree", "root", "local", "prediction", "l", "f", "cut").repartition(len(tops), "tree").groupBy("tree").applyInArrow(pack, PACKED)


def write_trees(trees: DataFrame, path: str) -> None:
    """One file per tree, so that a reader holds one at a time."""
    trees.write.option("maxRecordsPerFile", 1).parquet(path)


def _tree(uri: str) -> tuple[np.ndarray, ...]:
    system, name = pafs.FileSystem.from_uri(uri)
    with system.open_input_file(name) as file:
        row = pq.read_table(file, columns=["n", "nodes"])
    n, held = row.column("n")[0].as_py(), row.column("nodes")[0].as_buffer()
    f, to = (np.frombuffer(held, np.int32, n, 4 * n * i) for i in range(2))
    return f, to, *(np.frombuffer(held, np.float64, n, 8 * n * i) for i in (1, 2))


def predicted(x: np.ndarray, tree: tuple[np.ndarray, ...]) -> np.ndarray:
    """The tree's prediction per row."""
    f, left, threshold, prediction = tree
    values, width = np.ascontiguousarray(x).ravel(), x.shape[1]
    at = np.zeros(len(x), np.int64)
    moving = np.arange(len(x)) if f[0] >= 0 else np.empty(0, np.int64)
    while len(moving):
        node = at[moving]
        node = left[node] + ~(values[moving * width + f[node]] <= threshold[node])
        at[moving] = node
        moving = moving[f[node] >= 0]
    return prediction[at]


class _NodesWriter(DefaultParamsWriter):
    def saveImpl(self, path: str) -> None:
        super().saveImpl(path)
        write_trees(self.sparkSession.read.parquet(self.instance.nodes), f"{path}/nodes")


class _NodesReader(DefaultParamsReader):
    def load(self, path: str) -> NodeForestModel:
        model = super().load(path)
        model.nodes = f"{path}/nodes"
        return model


class NodeForestModel(Model, HasFeaturesCol, HasPredictionCol, MLWritable, MLReadable):
    """A forest whose trees lie in files of the folder ``nodes``; predictions are their mean, as those of Spark's forests."""

    numTrees: Param[int] = Param(Params._dummy(), "numTrees", "number of trees", TypeConverters.toInt)

    def __init__(self, nodes: str | None = None):
        super().__init__()
        self.nodes = nodes

    @property
    def getNumTrees(self) -> int:
        return self.getOrDefault(self.numTrees)

    def write(self) -> _NodesWriter:
        return _NodesWriter(self)

    @classmethod
    def read(cls) -> _NodesReader:
        return _NodesReader(cls)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        trees = dataset.sparkSession.read.parquet(self.nodes).select("tree", "_metadata.file_path").collect()
        files = [r["file_path"] for r in sorted(trees)]  # sums do not depend on the way files are listed

        @F.arrow_udf("double")
        def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            lot: list[np.ndarray] = []
            for batch in batches:
                lot.append(batch.flatten().to_numpy(zero_copy_only=False).reshape(len(batch), -1) if len(batch) else np.zeros((0, 0)))
                if sum(x.nbytes for x in lot) >= LOT_BYTES:
                    yield from scored(lot)
                    lot = []
            yield from scored(lot)

        def scored(lot: list[np.ndarray]) -> Iterator[pa.Array]:
            totals = [np.zeros(len(x)) for x in lot]
            for file in files if lot else ():
                tree = _tree(file)
                for x, total in zip(lot, totals, strict=True):
                    if len(x):
                        total += predicted(x, tree)
            yield from (pa.array(total / len(files)) for total in totals)

        return dataset.withColumn(self.getPredictionCol(), predict(vector_to_array(F.col(self.getFeaturesCol()))))


def columns_tried(strategy: str, width: int, trees: int) -> int:
    """Number of columns a node of a regression forest may be split by."""
    if strategy == "auto":
        strategy = "onethird" if trees > 1 else "all"
    named = {"all": width, "onethird": math.ceil(width / 3), "sqrt": math.ceil(math.sqrt(width)), "log2": max(1, math.ceil(math.log2(width)))}
    if strategy in named:
        return named[strategy]
    if strategy.isdigit():
        return min(width, int(strategy))
    return math.ceil(float(strategy) * width)


class RandomForestRegressor(regression.RandomForestRegressor):
    """Spark's regression forest with its settings and its model, grown as this module says.

    Columns of the vector are numbers, whatever their metadata: a split is a threshold. Rows weighted by a column and nodes
    bounded by a share of the weight are left to Spark's learner.
    """

    def _fit(self, dataset: DataFrame) -> RandomForestRegressionModel:
        if self._left_to_spark():
            return super()._fit(dataset)
        # a forest of roots brings the saved form's settings
        roots = regression.RandomForestRegressor._fit(self.copy({self.maxDepth: 0}), dataset)
        nodes, tops, cuts = self._grown(dataset, roots.numFeatures)
        saved = work_dir(dataset.sparkSession, "forest")
        roots.save(saved)
        node_data(nodes, tops, cuts).write.mode("overwrite").parquet(f"{saved}/data")
        model = RandomForestRegressionModel.load(saved)
        model.set(model.maxDepth, self.getMaxDepth())
        return model

    def _left_to_spark(self) -> bool:
        return self.isDefined("weightCol") or self.getMinWeightFractionPerNode() > 0

    def _grown(self, dataset: DataFrame, width: int) -> tuple[DataFrame, dict[int, Top], list[np.ndarray]]:
        """Nodes (``NODE``) of all subtrees, written; the upper nodes; the thresholds of each column."""
        spark, depth, most = dataset.sparkSession, self.getMaxDepth(), self.getMaxBins()
        if most > 256:
            raise ValueError(f"at most 256 bins, not {most}")
        rows = dataset.select(vector_to_array(F.col(self.getFeaturesCol())).alias("x"), F.col(self.getLabelCol()).cast("double").alias("y"))
        cuts = thresholds(rows.select("x"), width, most)

        def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = _matrix(batch)
                bins = np.stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(cuts)], axis=1).astype(np.uint8)
                yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("y"), _binary(bins)], ["row", "y", "bins"])

        path = work_dir(spark, "forest-rows")
        rows.withColumn("row", F.monotonically_increasing_id()).mapInArrow(binned, "row long, y double, bins binary").write.parquet(path)
        rows = spark.read.parquet(path)
        n, variance = rows.agg(F.count(F.lit(1)), F.var_pop("y")).first()
        g = Growth(
            tuple(len(c) + 1 for c in cuts), self.getNumTrees(), depth, self.getMinInstancesPerNode(), self.getMinInfoGain(),
            columns_tried(self.getFeatureSubsetStrategy(), width, self.getNumTrees()), self.getSeed() & (2**63 - 1), self.getSubsamplingRate(), self.getBootstrap(),
        )
        tops = grow_tops(rows, n, variance, g)
        grown = work_dir(spark, "forest-nodes")
        grow_rest(rows, n, tops, g).write.parquet(grown)
        return spark.read.parquet(grown), tops, cuts


class NodeForestRegressor(RandomForestRegressor):
    """The same forest as a model whose nodes stay in files."""

    def _fit(self, dataset: DataFrame) -> NodeForestModel | RandomForestRegressionModel:
        if self._left_to_spark():
            return super()._fit(dataset)
        # Spark's checks of labels and features, by a single root
        root = regression.RandomForestRegressor._fit(self.copy({self.maxDepth: 0, self.numTrees: 1}), dataset)
        nodes, tops, cuts = self._grown(dataset, root.numFeatures)
        path = work_dir(dataset.sparkSession, "forest")
        write_trees(packed(nodes, tops, cuts), path)
        model = NodeForestModel(path)
        return model._set(featuresCol=self.getFeaturesCol(), predictionCol=self.getPredictionCol(), numTrees=self.getNumTrees())
