"""Exact k-nearest-neighbour join and the inverse-distance regressor on top of it.

Training rows are put into the cells of a tree, cut at medians of a sample along the column (number or category) that
spreads most; neighbouring cells are packed into groups of bounded size. A query row is first looked up in the group it
falls into. The distance of its k-th row there bounds the distance of its k-th neighbour, and the boxes around the rows of
the cells tell which other groups can hold a nearer one: it visits these and no others, so the result is exact. A group of more
rows than a chunk is dealt into chunks, so a large cell becomes many small blocks. Within a block the boxes say which
cells a query row is compared with, by a matrix product that finds the candidates; only these are measured. A block hands on
at most ``k`` rows per query row, never the pairs.

Of training rows with equal vectors only the ``k`` of the lowest ids can be among the nearest, whatever the query, so
the index keeps no others: repeated rows neither add distances to compute nor ties to sort.

Distance is Euclidean over numeric columns and one-hot coded categories. Two different known categories are sqrt(2)
apart, a known and an unknown one 1.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugemill.session import work_dir

CELL_ROWS = 1_000  # training rows of a cell, about
MAX_CELLS = 4_096
SAMPLE_ROWS = 16  # rows of the sample per cell
CHUNK_ROWS = 20_000
SMALL_QUERY_CHUNK = 2_000
STEP_PAIRS = 200_000  # distances worked on at a time: their arrays stay in a core's cache
MAX_CODES = 64  # categories of a cell that the matrix product takes as columns
SLACK = 1e-9


def _pair_distances(a: np.ndarray, b: np.ndarray, n_codes: int) -> np.ndarray:
    """Squared distance of each row of ``a`` to the row of ``b`` beside it; the last ``n_codes`` columns are category
    codes, negative for unknown. Columns are added one after the other, so sums do not depend on the layout."""
    n = a.shape[1] - n_codes
    out = np.zeros(len(a))
    for i in range(n):
        gap = a[:, i] - b[:, i]
        out += gap * gap
    for i in range(n, n + n_codes):
        known = (a[:, i] >= 0).astype(np.float64) + (b[:, i] >= 0)
        out += np.where((a[:, i] == b[:, i]) & (a[:, i] >= 0), 0.0, known)
    return out


def _box_distances(x: np.ndarray, low: np.ndarray, high: np.ndarray, n_codes: int) -> np.ndarray:
    """Per row a squared distance that no row of the box is nearer than."""
    n = x.shape[1] - n_codes
    gap = np.fmax(np.fmax(low[:n] - x[:, :n], x[:, :n] - high[:n]), 0)
    out = np.einsum("ij,ij->i", gap, gap)
    for i in range(n, n + n_codes):
        outside = (x[:, i] < low[i]) | (x[:, i] > high[i])
        out += np.where(outside, (x[:, i] >= 0).astype(np.float64) + (low[i] >= 0), 0.0)
    return out


def _within(squared: np.ndarray) -> np.ndarray:
    """A limit of squared distances with room for rounding."""
    return squared * (1 + SLACK) + SLACK


def _matrix(values: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    """Vectors of equal length as rows of one array."""
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    if values.null_count:
        raise ValueError("a vector is missing")
    return values.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


# --- cells --------------------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Cells:
    """A binary tree over the vectors: a node sends rows with at most ``cut`` in column ``axis`` to ``left``, others to the
    node after. Nodes without a column are cells, numbered from left to right."""

    axis: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    cell: np.ndarray

    def count(self) -> int:
        return int((self.axis < 0).sum())

    def place(self, x: np.ndarray) -> np.ndarray:
        """The cell of each row."""
        at = np.zeros(len(x), np.int64)
        moving = np.flatnonzero(self.axis[at] >= 0)
        while len(moving):
            node = at[moving]
            at[moving] = np.where(x[moving, self.axis[node]] <= self.cut[node], self.left[node], self.right[node])
            moving = moving[self.axis[at[moving]] >= 0]
        return self.cell[at]

    def document(self) -> dict[str, list]:
        return {k: v.tolist() for k, v in self.__dict__.items()}

    @classmethod
    def read(cls, document: dict[str, list]) -> Cells:
        return cls(**{k: np.array(v, np.float64 if k == "cut" else np.int64) for k, v in document.items()})


def _cut(x: np.ndarray, n_codes: int) -> tuple[int, float] | None:
    """Column and value at which to halve the rows; None where all are equal. A column counts by how far two rows are apart
    in it; for numbers that is told by the middle four fifths, so that a few far rows do not decide."""
    n = x.shape[1] - n_codes
    spread = np.zeros(x.shape[1])
    if n:
        low, high = np.quantile(x[:, :n], [0.1, 0.9], axis=0)
        spread[:n] = 0.28 * (high - low) ** 2
    for i in range(n, x.shape[1]):
        share = np.unique(x[:, i], return_counts=True)[1] / len(x)
        spread[i] = 2 * (1 - (share * share).sum())
    if not np.nanmax(spread, initial=0) > 0:
        spread = x.max(axis=0) - x.min(axis=0)
    spread = np.nan_to_num(spread, nan=0.0, posinf=np.finfo(float).max)
    for axis in np.argsort(-spread, kind="stable"):
        values, counts = np.unique(x[:, axis], return_counts=True)
        values, counts = values[np.isfinite(values)], counts[: np.isfinite(values).sum()]
        if len(values) > 1:
            at = int(np.abs(counts.cumsum()[:-1] - len(x) / 2).argmin())
            return int(axis), float(values[at])
        if spread[axis] <= 0:
            break
    return None


def plant(points: np.ndarray, n_codes: int, cells: int) -> Cells:
    """A tree with about ``cells`` cells, each with as many of the points."""
    most = max(1.0, len(points) / max(1, cells))
    axis, cut, left, right, cell, found = [], [], [], [], [], 0
    waiting: list[tuple[np.ndarray, int]] = [(np.arange(len(points)), -1)]
    while waiting:
        rows, parent = waiting.pop()
        node = len(axis)
        if parent >= 0:
            (left if left[parent] < 0 else right)[parent] = node
        split = _cut(points[rows], n_codes) if len(rows) > most else None
        for values, v in ((axis, -1), (cut, 0.0), (left, -1), (right, -1), (cell, -1)):
            values.append(v)
        if split is None:
            cell[node], found = found, found + 1
            continue
        axis[node], cut[node] = split
        low = points[rows, axis[node]] <= cut[node]
        waiting += [(rows[~low], node), (rows[low], node)]
    return Cells(np.array(axis), np.array(cut, np.float64), np.array(left), np.array(right), np.array(cell))


# --- the index ----------------------------------------------------------------------------------------------------------


@dataclass
class NeighbourIndex:
    """Training rows ``(t_id, t_y, t_vec, cell, spread)``, at most ``k`` per vector, with the tree of their cells and per
    cell the number of rows and the box around them."""

    rows: DataFrame
    k: int
    n_codes: int
    cells: Cells
    size: np.ndarray
    low: np.ndarray
    high: np.ndarray
    chunk_rows: int = CHUNK_ROWS

    def groups(self) -> np.ndarray:
        """Group number per cell: cells from left to right, packed until a group holds ``chunk_rows`` rows."""
        group, current, load = np.zeros(len(self.size), dtype=np.int64), 0, 0
        for cell, n in enumerate(self.size):
            if load and load + n > self.chunk_rows:
                current, load = current + 1, 0
            group[cell] = current
            load += n
        return group


def _placing(cells: Cells, width: int):
    @F.pandas_udf(T.IntegerType())
    def place(vec: pd.Series) -> pd.Series:
        x = np.concatenate(vec.to_numpy()).reshape(-1, width) if len(vec) else np.zeros((0, width))
        return pd.Series(cells.place(x).astype("int32"))

    return place


def build_index(
    train: DataFrame,
    row_id: str,
    target: str,
    vector: Column,
    n_codes: int = 0,
    k: int = 5,
    cells: int | None = None,
    chunk_rows: int = CHUNK_ROWS,
    path: str | None = None,
) -> NeighbourIndex:
    """Assign rows to about ``cells`` cells and summarize these. Only a sample of some rows per cell and one row per cell
    reach the driver.

    The rows that can be neighbours are written once, and once placed to ``path`` (a fresh folder of the shared work
    folder by default), from where every later job reads them.
    """
    spark = train.sparkSession
    path = path or work_dir(spark, "neighbours")
    rows = train.select(F.col(row_id).alias("t_id"), F.col(target).cast("double").alias("t_y"), vector.cast("array<double>").alias("t_vec"))
    # the rank filter is also applied before the shuffle, so equal vectors are not gathered
    lowest = F.row_number().over(Window.partitionBy("t_vec").orderBy("t_id", "t_y"))
    usable = work_dir(spark, "distinct-vectors")
    rows.withColumn("r", lowest).filter(F.col("r") <= k).drop("r").write.parquet(usable)
    rows = spark.read.parquet(usable)
    n = rows.count()
    if n < k:
        raise ValueError(f"{n} training rows are fewer than k = {k} neighbours")
    cells = min(MAX_CELLS, math.ceil(n / CELL_ROWS)) if cells is None else cells
    chosen = rows.orderBy(F.xxhash64("t_id"), "t_id").limit(SAMPLE_ROWS * cells).select("t_vec").toArrow().column("t_vec")
    points = _matrix(chosen, len(chosen[0]))
    tree = plant(points, n_codes, cells)
    # ``spread`` deals the rows of a cell into chunks, whatever their ids; it is fixed once written
    placed = rows.withColumn("cell", _placing(tree, points.shape[1])("t_vec")).select(
        "t_id", "t_y", "t_vec", "cell", F.xxhash64(F.monotonically_increasing_id()).alias("spread")
    )
    placed.write.parquet(path)
    return load_index(spark, path, tree, points.shape[1], k, n_codes, chunk_rows)


def load_index(
    spark: SparkSession, path: str, cells: Cells, width: int, k: int, n_codes: int, chunk_rows: int = CHUNK_ROWS
) -> NeighbourIndex:
    """Index over placed rows, vectors of ``width`` numbers, written by :func:`build_index`."""
    rows = spark.read.parquet(path)
    bounds = (f(F.col("t_vec")[i]).alias(f"{f.__name__}{i}") for f in (F.min, F.max) for i in range(width))
    count = cells.count()
    size, low, high = np.zeros(count, np.int64), np.full((count, width), np.inf), np.full((count, width), -np.inf)
    for r in rows.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), *bounds).collect():
        size[r[0]], low[r[0]], high[r[0]] = r[1], r[2 : 2 + width], r[2 + width :]
    return NeighbourIndex(rows, k, n_codes, cells, size, low, high, chunk_rows)


# --- the join -----------------------------------------------------------------------------------------------------------


def _groups_to_visit(index: NeighbourIndex, group: np.ndarray):
    """The groups, without the query row's own, that can hold a row as near as ``reach``."""
    tree, n_codes, filled = index.cells, index.n_codes, index.size > 0
    nodes = len(tree.axis)
    low, high = (np.full((nodes, index.low.shape[1]), v) for v in (np.inf, -np.inf))
    for node in reversed(range(nodes)):  # children come after their parents
        if tree.axis[node] < 0:
            low[node], high[node] = index.low[tree.cell[node]], index.high[tree.cell[node]]
        else:
            both = [tree.left[node], tree.right[node]]
            low[node], high[node] = np.fmin(*low[both]), high[both].max(axis=0)  # a NaN in ``high`` bounds nothing

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def visit(vec: pd.Series, reach: pd.Series, own: pd.Series) -> pd.Series:
        if not len(vec):
            return pd.Series([], dtype=object)
        x = np.concatenate(vec.to_numpy()).reshape(len(vec), -1)
        limit = _within(reach.to_numpy(np.float64) ** 2)
        near = np.zeros((len(x), group.max() + 1), bool)
        waiting = [(0, np.arange(len(x)))]
        while waiting:
            node, rows = waiting.pop()
            rows = rows[_box_distances(x[rows], low[node], high[node], n_codes) <= limit[rows]]
            if not len(rows):
                continue
            if tree.axis[node] >= 0:
                waiting += [(tree.left[node], rows), (tree.right[node], rows)]
            elif filled[tree.cell[node]]:
                near[rows, group[tree.cell[node]]] = True
        near[np.arange(len(x)), own.to_numpy(np.int64)] = False
        return pd.Series([np.flatnonzero(row).tolist() for row in near])

    return visit


class _Cell:
    """Training rows of a cell within a block: vectors, their places in the order of ids, the box around them, and the
    factor of the matrix product that gives rough squared distances."""

    def __init__(self, x: np.ndarray, rank: np.ndarray, n_codes: int):
        self.x, self.rank, self.n_codes, n = x, rank, n_codes, x.shape[1] - n_codes
        self.low, self.high = x.min(axis=0), x.max(axis=0)
        y, codes = x[:, :n], x[:, n:]
        self.names = [np.unique(c[c >= 0]) for c in codes.T]
        squares = np.einsum("ij,ij->i", y, y)
        self.largest = squares.max()
        self.one_hot = all(len(v) <= MAX_CODES for v in self.names)
        parts = [-2 * y, squares[:, None]]
        if self.one_hot:
            parts[1] = (squares + (codes >= 0).sum(axis=1))[:, None]
            parts += [-2.0 * (c[:, None] == v) for c, v in zip(codes.T, self.names, strict=True)]
        self.factor = np.ascontiguousarray(np.hstack(parts).T)

    def rough(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Squared distances of all rows of ``q`` to all rows of the cell, but for rounding, and the room to leave for it."""
        n = q.shape[1] - self.n_codes
        x, codes = q[:, :n], q[:, n:]
        squares = np.einsum("ij,ij->i", x, x)
        parts = [x, np.ones((len(q), 1))]
        own = squares
        if self.one_hot:
            own = squares + (codes >= 0).sum(axis=1)
            parts += [(c[:, None] == v).astype(np.float64) for c, v in zip(codes.T, self.names, strict=True)]
        out = np.hstack(parts) @ self.factor
        out += own[:, None]
        if not self.one_hot:
            for a, b in zip(codes.T, self.x[:, n:].T, strict=True):
                known = (a >= 0).astype(np.float64)[:, None] + (b >= 0)
                out += np.where((a[:, None] == b) & (a >= 0)[:, None], 0.0, known)
        return out, 1e-10 * (1 + squares + self.largest)


def _search(cells: Sequence[_Cell], q: np.ndarray, reach: np.ndarray, k: int, n_codes: int) -> tuple[np.ndarray, np.ndarray]:
    """Squared distances and places (-1: none) of the k nearest rows per row of ``q`` that are within ``reach`` (squared);
    ties by place. Nearer cells come first, so that ``reach`` soon keeps the others out."""
    away, place = np.full((len(q), k), np.inf), np.full((len(q), k), -1)
    boxes = np.stack([_box_distances(q, c.low, c.high, n_codes) for c in cells])
    for which in np.argsort(boxes.mean(axis=1), kind="stable"):
        cell = cells[which]
        asked = np.flatnonzero(boxes[which] <= _within(np.minimum(reach, away[:, -1])))
        step = max(1, STEP_PAIRS // len(cell.x))
        for start in range(0, len(asked), step):
            rows = asked[start : start + step]
            rough, room = cell.rough(q[rows])
            limit = _within(np.minimum(reach[rows], away[rows, -1])) + 2 * room
            if len(cell.x) > k and not np.isfinite(limit).all():
                limit = np.minimum(limit, np.partition(rough, k - 1, axis=1)[:, k - 1] + 4 * room)
            who, found = np.nonzero(rough <= limit[:, None])
            if not len(who):
                continue
            gap = _pair_distances(q[rows[who]], cell.x[found], n_codes)
            met, at = np.unique(who, return_inverse=True)
            mine = rows[met]
            # what was known and what is new, the k nearest of them
            owner = np.concatenate([np.repeat(np.arange(len(mine)), k), at])
            gaps, places = np.concatenate([away[mine].ravel(), gap]), np.concatenate([place[mine].ravel(), cell.rank[found]])
            order = np.lexsort((places, gaps, owner))
            owner = owner[order]
            first = np.arange(len(owner)) - np.searchsorted(owner, owner) < k
            away[mine], place[mine] = gaps[order][first].reshape(-1, k), places[order][first].reshape(-1, k)
    return away, place


FOUND = ("t_id", "t_y", "distance")


def _joined(index: NeighbourIndex, asked: DataFrame, group: np.ndarray, keep: Sequence[str]) -> DataFrame:
    """``keep`` columns of each row of ``asked`` (``q_id``, ``q_vec``, ``q_cell``, ``group``, ``reach``), once per chunk of its group,
    with the number of the chunk and the nearest rows found there as lists."""
    k, n_codes, chunk, width, spark = index.k, index.n_codes, index.chunk_rows, index.low.shape[1], asked.sparkSession
    sizes = {r["group"]: r["count"] for r in asked.groupBy("group").count().collect()}
    # query chunks are full where that leaves enough blocks for all cores, and smaller otherwise
    spread = sum(sizes.values()) // (4 * spark.sparkContext.defaultParallelism)
    query_chunk = min(chunk, max(SMALL_QUERY_CHUNK, spread))
    rows_of = np.bincount(group, weights=index.size)
    parts = {g: (max(1, math.ceil(int(rows_of[g]) / chunk)), math.ceil(n / query_chunk)) for g, n in sizes.items()}
    # one row per group and one per cell; every pair of chunks of a group is one block
    of_group = F.broadcast(spark.createDataFrame([(g, *p) for g, p in parts.items()], "group int, t_parts int, q_parts int"))
    of_cell = F.broadcast(
        spark.createDataFrame([(c, int(g), *parts[g]) for c, g in enumerate(group) if g in parts], "cell int, group int, t_parts int, q_parts int")
    )
    t = index.rows.join(of_cell, "cell").select(
        "group", "cell", "t_id", "t_y", "t_vec",
        F.pmod("spread", "t_parts").cast("int").alias("t_part"),
        F.explode(F.sequence(F.lit(0), F.col("q_parts") - 1)).alias("q_part"),
    )
    q = asked.join(of_group, "group").select(
        "group", "q_id", "q_vec", "q_cell", "reach",
        F.explode(F.sequence(F.lit(0), F.col("t_parts") - 1)).alias("t_part"),
        F.pmod(F.xxhash64("q_id"), F.col("q_parts")).cast("int").alias("q_part"),
    )
    schema = T.StructType([*(q.schema[c] for c in ("t_part", *keep)), *(
        T.StructField(c, T.ArrayType(kind)) for c, kind in zip(FOUND, (index.rows.schema["t_id"].dataType, T.DoubleType(), T.DoubleType()), strict=True)
    )])

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        left = left.sort_by([("t_id", "ascending"), ("t_y", "ascending")])  # equal distances: lowest id first
        right = right.sort_by("q_cell")
        asked, reach = _matrix(right.column("q_vec"), width), right.column("reach").to_numpy() ** 2
        away, place = np.full((len(asked), k), np.inf), np.full((len(asked), k), -1)
        if len(left) and len(asked):
            points, of = _matrix(left.column("t_vec"), width), left.column("cell").to_numpy()
            order = np.argsort(of, kind="stable")
            cells = [_Cell(points[rows], rows, n_codes) for rows in np.split(order, np.flatnonzero(np.diff(of[order])) + 1)]
            own = right.column("q_cell").to_numpy()
            # rows of a cell have the same cells near them; many small lots are put together
            edges = np.append(np.flatnonzero(np.diff(own, prepend=-1)), len(own))
            start = 0
            for stop in edges[1:]:
                if stop - start >= 256 or stop == len(own):
                    away[start:stop], place[start:stop] = _search(cells, asked[start:stop], reach[start:stop], k, n_codes)
                    start = stop
        hit = place >= 0
        offsets = pa.array(np.concatenate([[0], hit.sum(axis=1).cumsum()]).astype(np.int32))
        taken = pa.array(place[hit])
        ids, ys = (pc.take(left.column(c).combine_chunks(), taken) for c in ("t_id", "t_y"))
        lists = [pa.ListArray.from_arrays(offsets, v) for v in (ids, ys, pa.array(np.sqrt(away[hit])))]
        return pa.table([*(right.column(c) for c in ("t_part", *keep)), *lists], names=["t_part", *keep, *FOUND])

    block = ["group", "t_part", "q_part"]
    # blocks are small in bytes and long in work: an explicit number of tasks keeps them from being merged
    blocks = sum(t_parts * q_parts for t_parts, q_parts in parts.values())
    tasks = min(2 * blocks, max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    t, q = (side.repartition(max(1, tasks), *block) for side in (t, q))
    return t.groupBy(*block).cogroup(q.groupBy(*block)).applyInArrow(compare, schema)


def nearest_neighbours(index: NeighbourIndex, queries: DataFrame, row_id: str, vector: Column) -> DataFrame:
    """``(q_id, t_id, t_y, distance)``: the k nearest training rows per query row, ties by ``t_id``.

    ``row_id`` must identify a query row.
    """
    k, group, spark = index.k, index.groups(), queries.sparkSession
    rows = queries.select(F.col(row_id).alias("q_id"), vector.cast("array<double>").alias("q_vec"))
    at = F.array(*(F.lit(int(g)) for g in group))
    path, own_path = work_dir(spark, "placed-queries"), work_dir(spark, "own-groups")
    placed = rows.withColumn("q_cell", _placing(index.cells, index.low.shape[1])("q_vec"))
    placed.select("*", at[F.col("q_cell")].alias("group"), F.lit(math.inf).alias("reach")).write.parquet(path)
    _joined(index, spark.read.parquet(path), group, ["q_id", "q_vec", "q_cell", "group"]).write.parquet(own_path)
    own = spark.read.parquet(own_path)
    found = own.select("q_id", *FOUND)
    if group.max():
        # any chunk bounds the distance; the visits are written, since they are counted, then read again
        reach = F.when(F.size("distance") == k, F.element_at("distance", k)).otherwise(F.lit(math.inf))
        visits = own.filter(F.col("t_part") == 0).select("q_id", "q_vec", "q_cell", F.col("group").alias("own"), reach.alias("reach"))
        path = work_dir(spark, "visits")
        visits.withColumn("group", F.explode(_groups_to_visit(index, group)("q_vec", "reach", "own"))).drop("own").write.parquet(path)
        visits = spark.read.parquet(path)
        if not visits.isEmpty():
            found = found.unionByName(_joined(index, visits, group, ["q_id"]).select("q_id", *FOUND))
    found = found.select("q_id", F.explode(F.arrays_zip(*FOUND)).alias("t")).select("q_id", "t.*")
    order = Window.partitionBy("q_id").orderBy("distance", "t_id", "t_y")
    return found.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= k).drop("r")


def weighted_mean(neighbours: DataFrame) -> DataFrame:
    """``(q_id, prediction)``: mean of the neighbours' targets weighted by 1 / distance; neighbours at distance
    zero, where there are any, share the whole weight."""
    exact = F.sum(F.when(F.col("distance") == 0, 1).otherwise(0))
    at_zero = F.avg(F.when(F.col("distance") == 0, F.col("t_y")))
    inverse = F.try_divide(F.lit(1.0), F.col("distance"))
    return neighbours.groupBy("q_id").agg(
        F.when(exact > 0, at_zero).otherwise(F.try_divide(F.sum(inverse * F.col("t_y")), F.sum(inverse))).alias("prediction")
    )


def knn_predict(index: NeighbourIndex, queries: DataFrame, vector: Column) -> DataFrame:
    """``queries`` with a column ``prediction``.

    A prediction depends on the vector alone, so equal vectors are looked up once under a digest of their
    numbers; rows need no id. The rows are written to the shared work folder first: they are read three times, and
    an input that picks its rows anew on every run (a limit without an order) must not lose predictions by it.
    """
    digest = F.md5(F.concat_ws(",", F.transform(vector, lambda x: (x + F.lit(0.0)).cast("string"))))
    path = work_dir(queries.sparkSession, "queries")
    queries.withColumn("__digest", digest).write.parquet(path)
    keyed = queries.sparkSession.read.parquet(path)
    distinct = keyed.select("__digest", vector.alias("__vector")).groupBy("__digest").agg(F.any_value("__vector").alias("__vector"))
    found = weighted_mean(nearest_neighbours(index, distinct, "__digest", F.col("__vector")))
    return keyed.join(found.withColumnRenamed("q_id", "__digest"), "__digest", "left").drop("__digest")


def feature_vector(numeric: Sequence[Column], codes: Sequence[Column] = ()) -> Column:
    """Array of scaled numbers followed by category codes."""
    return F.array(*(c.cast("double") for c in (*numeric, *codes)))
