"""Quality classifier: a generalised additive model with pairwise interactions.

Every feature of a text is binned; the model is a lookup table per feature and a small table per chosen pair of features.
The tables are learned by boosting that goes round the features in a cycle, each step adding a shallow tree over the
bins of one feature; then the pairs that reduce the loss most get their round. A score is the sum of the bins that a
row falls into, through the logistic function.

Features are computed in one pass over the whole texts and written once; training reads a sample of at most
``max_rows`` labelled rows (chosen by the hash of their id), scoring all rows. No label, language, source or id is a
feature.

Defined results: a NULL or empty text has zero features and a score like any other; a row without id is held out;
without labelled rows, or with one class only, every score is the share of the class (0.5 without rows); repeated rows
have equal scores; other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugemill.llm._rows import map_texts, written

MAX_ROWS = 20_000
FOLDS, TEST_FOLD = 5, 0
BINS, PAIR_BINS = 48, 12
ROUNDS, PAIR_ROUNDS, PAIRS = 120, 40, 10
RATE, RIDGE = 0.15, 4.0
THRESHOLD = 0.3
HASH_RANGE = 1 << 40

FEATURES = (
    "log_words", "word_length", "symbols", "marks", "upper", "digits", "distinct", "same_next", "dup_lines",
    "repeated_threes", "short_words", "line_words", "stops", "beyond_ascii", "top_word", "sentence_words",
)
SYMBOLS, MARKS = re.compile(r"[#*$%&|<>{}\\^~_=+@]"), re.compile("[!?]")
UPPER, DIGITS, STOPS = re.compile("[A-Z]"), re.compile("[0-9]"), re.compile("[.,;:]")


def features(text: str | None) -> list[float]:
    """Shares and means of a text; all zero without words."""
    words = text.split() if text else []
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    chars = len(text)
    counts = Counter(words)
    lines = [x for x in text.split("\n") if x and not x.isspace()]
    threes = n - 2
    return [
        np.log1p(n), (chars - text.count(" ") - text.count("\n")) / n, len(SYMBOLS.findall(text)) / n, len(MARKS.findall(text)) / n,
        len(UPPER.findall(text)) / chars, len(DIGITS.findall(text)) / chars, len(counts) / n, sum(map(str.__eq__, words, words[1:])) / n,
        1 - len(set(lines)) / max(1, len(lines)), 1 - len(set(zip(words, words[1:], words[2:], strict=False))) / threes if threes > 0 else 0.0,
        sum(c for w, c in counts.items() if len(w) <= 3) / n, np.log1p(n / max(1, len(lines))), len(STOPS.findall(text)) / n,
        1 - len(text.encode("ascii", "ignore")) / chars, max(counts.values()) / n, np.log1p(n / (1 + text.count("."))),
    ]


def feature_table(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and ``x`` (array of the features) of every row."""

    def start():
        return lambda texts: [pa.array([features(t) for t in texts], pa.list_(pa.float64()))]

    return map_texts(docs, [doc_id], text, start, "x array<double>").withColumnRenamed(doc_id, "doc_id")


def fold(doc_id: str, folds: int) -> Column:
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds


@dataclass
class AdditiveModel:
    """Edges of the bins per feature, a table per feature, and tables of feature pairs over coarser bins."""

    base: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    pairs: dict[tuple[int, int], np.ndarray] = field(default_factory=dict)

    def logit(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        for j, (edges, table) in enumerate(zip(self.edges, self.tables, strict=True)):
            out += table[np.searchsorted(edges, x[:, j], side="right")]
        for (i, j), table in self.pairs.items():
            out += table[np.searchsorted(self.coarse[i], x[:, i], side="right"), np.searchsorted(self.coarse[j], x[:, j], side="right")]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(x), -30, 30)))


def _edges(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1]))


def _split(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """Best place to cut a row of bins: (gain, bins on the left)."""
    if len(g) < 2:
        return 0.0, 0
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gain = gl**2 / (hl + RIDGE) + (g.sum() - gl) ** 2 / (h.sum() - hl + RIDGE) - g.sum() ** 2 / (h.sum() + RIDGE)
    at = int(np.argmax(gain))
    return max(0.0, float(gain[at])), at + 1


def _leaf(g: np.ndarray, h: np.ndarray) -> float:
    return float(g.sum() / (h.sum() + RIDGE))


def shallow_tree(g: np.ndarray, h: np.ndarray, depth: int = 2) -> np.ndarray:
    """Value per bin of a tree over one feature."""
    gain, at = _split(g, h)
    if depth == 0 or gain <= 0:
        return np.full(len(g), _leaf(g, h))
    return np.concatenate([shallow_tree(g[:at], h[:at], depth - 1), shallow_tree(g[at:], h[at:], depth - 1)])


def pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """(gain, value per cell) of the better of two trees: a cut along one feature, then one along the other on each side."""
    best = (0.0, np.zeros_like(g))
    for turn in (False, True):
        gt, ht = (g.T, h.T) if turn else (g, h)
        for at in range(1, len(gt)):
            total, values = 0.0, np.empty_like(gt)
            for part in (slice(0, at), slice(at, len(gt))):
                gs, hs = gt[part].sum(axis=0), ht[part].sum(axis=0)
                _, cut = _split(gs, hs)
                for side in (slice(0, cut), slice(cut, gt.shape[1])) if cut else (slice(0, gt.shape[1]),):
                    values[part, side] = _leaf(gs[side], hs[side])
                    total += gs[side].sum() ** 2 / (hs[side].sum() + RIDGE)
            if total > best[0]:
                best = (total, values.T if turn else values)
    return best


def fit(x: np.ndarray, y: np.ndarray) -> AdditiveModel:
    """Learn from features and 0/1 labels."""
    share = (y.sum() + 0.5) / (len(y) + 1) if len(y) else 0.5
    model = AdditiveModel(base=float(np.log(share / (1 - share))))
    if len(np.unique(y)) < 2:
        return model
    width = x.shape[1]
    model.edges = [_edges(x[:, j], BINS) for j in range(width)]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    fine = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(model.edges)]
    logit = np.full(len(y), model.base)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-logit))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for j in range(width):
            g, h = slopes()
            n = len(model.tables[j])
            step = RATE * shallow_tree(np.bincount(fine[j], g, n), np.bincount(fine[j], h, n))
            model.tables[j] += step
            logit += step[fine[j]]
    model.coarse = [_edges(x[:, j], PAIR_BINS) for j in range(width)]
    coarse = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(model.coarse)]
    sizes = [len(e) + 1 for e in model.coarse]

    def cells(i: int, j: int, values: np.ndarray) -> np.ndarray:
        return np.bincount(coarse[i] * sizes[j] + coarse[j], values, sizes[i] * sizes[j]).reshape(sizes[i], sizes[j])

    g, h = slopes()
    gains = {(i, j): pair_tree(cells(i, j, g), cells(i, j, h))[0] for i, j in combinations(range(width), 2)}
    chosen = sorted(gains, key=gains.get, reverse=True)[:PAIRS]
    model.pairs = {p: np.zeros((sizes[p[0]], sizes[p[1]])) for p in chosen}
    for _ in range(PAIR_ROUNDS):
        for i, j in chosen:
            g, h = slopes()
            step = RATE * pair_tree(cells(i, j, g), cells(i, j, h))[1]
            model.pairs[i, j] += step
            logit += step[coarse[i], coarse[j]]
    return model


def train(table: DataFrame, labels: DataFrame, target: str = "quality", max_rows: int = MAX_ROWS, folds: int = FOLDS, test_fold: int = TEST_FOLD) -> AdditiveModel:
    """Fit on at most ``max_rows`` labelled rows outside the test fold."""
    known = labels.where(F.col(target).isNotNull() & (fold("doc_id", folds) != test_fold)).select("doc_id", F.col(target).cast("int").alias("y"))
    at = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(HASH_RANGE)).alias("at")
    # rows far above the wanted place in hash order are left out before the sort, so few reach its last task
    reach = min(1.0, 1.2 * (max_rows + 1000) / max(1, known.count()))
    near = table.join(known, "doc_id").select(at, "x", "y").where(F.col("at") < int(reach * HASH_RANGE))
    rows = near.orderBy("at", "y").limit(max_rows).toPandas()
    x = np.stack(rows["x"].to_list()) if len(rows) else np.zeros((0, len(FEATURES)))
    return fit(x, rows["y"].to_numpy(float))


def scored(table: DataFrame, model: AdditiveModel) -> DataFrame:
    """doc_id and score of every row of a feature table."""

    def start():
        return lambda rows: [pa.array(model.score(np.array(rows, float)), pa.float64())]

    return map_texts(table, ["doc_id"], "x", start, "score double")


def quality_scores(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    table = written(feature_table(docs), "quality-features")
    model = train(table, labels, max_rows=max_rows)
    held_out = F.coalesce(fold("doc_id", FOLDS) == TEST_FOLD, F.lit(True))
    return scored(table, model).select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
