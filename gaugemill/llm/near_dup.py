"""Near-duplicate documents: minima of many universal hashes, banding, verified links, connected components.

A document is the set of its distinct shingles (runs of ``width`` words). 128 multiply-shift hashes give its minima; 32
bands of four minima are the keys in which candidates meet: at a similarity of 0.8 two sets share no band in one of
twenty million cases. Candidates pass an estimate from the minima and are then confirmed on the full sets.

Equal sets are one node, so copies are never compared. Within a key no pairs of all members are made:

1. every member is compared with the key's smallest node (a star), and the links found are closed to components;
2. keys whose members already are in one component are done, however many they are;
3. in other keys of at most ``KEY_ROWS`` members, members of different components are compared;
4. in larger ones, members outside the key's largest component are left over. All left-overs of a component are
   compared with its members and with each other, in blocks: a task holds two blocks of about ``BLOCK_ROWS`` rows, so a
   key of any size becomes many small tasks. Within a task the minima are compared first, sets only where these agree,
   and only until a left-over is linked to the component. Every pair that shares a key is covered by 1 to 4.

Components come from alternating large-star and small-star steps on (node, neighbour) rows: minima per node by grouped
aggregation, then a join back, never a list of neighbours.

Nodes are numbered sets; a row is named by the hashes of its id and of its text, so rows without id and rows of one id
with several texts are told apart.

Defined results: a NULL text and a text without words have an empty set, are linked with nothing and are kept; an id with
several texts is as many documents; a component is named by its smallest id, NULL if no row has one, and its own row is
the one of the smallest id (rows without id last) and then the smallest text hash; of equal ids and texts ``kept`` is
alike and ``deduplicated`` keeps one row; other columns are not read, but for which of these rows that is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugemill.llm._rows import map_texts, numbered, sieve, sifted, text_key, unlisted, written

WIDTH = 5
SIMILAR, OUT_OF = 80, 100
HASHES, BAND = 128, 4
BANDS = HASHES // BAND
ESTIMATE = 0.62  # of the minima; at a similarity of 0.8 fewer agree in one of a million cases
KEY_ROWS = 48
BLOCK_ROWS = 256
BLOCK = 2048
MAX_WORDS = 500_000
KEY = ["id_key", "text_key"]

_rng = np.random.default_rng(20240607)
FACTORS = _rng.integers(0, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
OFFSETS = _rng.integers(0, 1 << 63, HASHES, dtype=np.uint64)
STEP = np.uint64(0x9E3779B97F4A7C15)


class WordHashes(dict):
    """64-bit hashes of words, kept while the worker lives and emptied when full."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_hashes = WordHashes()


def shingles(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes. Fewer words than ``width`` are one shingle; no words, none.

    ``bytes.lower`` and ``bytes.split`` change and cut at ASCII characters only.
    """
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    if len(_hashes) > MAX_WORDS:
        _hashes.clear()
    values = np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))
    width, salt = (width, 0) if len(words) >= width else (len(words), len(words))
    n = len(values) - width + 1
    out = np.full(n, np.uint64(salt), np.uint64)
    for j in range(width):
        out = (out ^ values[j : j + n]) * STEP
        out ^= out >> np.uint64(29)
    return np.unique(out)


def minima(items: np.ndarray) -> np.ndarray:
    """The smallest of each universal hash over a set that isn't empty."""
    low = np.full(HASHES, np.iinfo(np.uint32).max, np.uint32)
    for at in range(0, len(items), BLOCK):
        hashed = (items[at : at + BLOCK, None] * FACTORS + OFFSETS) >> np.uint64(32)
        low = np.minimum(low, hashed.min(axis=0).astype(np.uint32))
    return low


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Jaccard similarity of at least SIMILAR / OUT_OF, in whole numbers."""
    small, large = sorted((len(a), len(b)))
    if OUT_OF * small < SIMILAR * large:
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return OUT_OF * both >= SIMILAR * (small + large - both)


def signatures(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, the row's KEY, set_key, n_shingles, bands (keys), marks (low bytes of the minima) of every row."""

    def start():
        return sign

    def sign(texts: list) -> list[pa.Array]:
        rows, known = [], {}
        for text in texts:
            if (row := known.get(text)) is None:
                items = shingles(text, width)
                row = (0, None, None, None)
                if len(items):
                    low = minima(items)
                    keys = [xxhash.xxh3_64_intdigest(low[b * BAND : (b + 1) * BAND].tobytes(), seed=b) for b in range(BANDS)]
                    key = hashlib.blake2b(items.tobytes(), digest_size=16).digest()
                    row = (len(items), key, np.array(keys, np.uint64).view(np.int64), low.astype(np.uint8).tobytes())
                known[text] = row
            rows.append(row)
        sizes, keys, bands, marks = zip(*rows, strict=True)
        return [pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(bands, pa.list_(pa.int64())), pa.array(marks, pa.binary())]

    return map_texts(docs, ["doc_id", *KEY], "text", start, "n_shingles long, set_key binary, bands array<long>, marks binary")


def estimated(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs whose minima agree often enough."""
    marks = nodes.select("node", "marks")
    both = pairs.join(marks.select(F.col("node").alias("a"), F.col("marks").alias("ma")), "a").join(marks.select(F.col("node").alias("b"), F.col("marks").alias("mb")), "b")

    def agree(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                ma, mb = (np.frombuffer(b"".join(batch[c]), np.uint8).reshape(-1, HASHES) for c in ("ma", "mb"))
                yield batch.loc[(ma == mb).mean(axis=1) >= ESTIMATE, ["a", "b"]]

    return both.select("a", "b", "ma", "mb").mapInPandas(agree, "a long, b long")


def confirmed(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, width: int) -> DataFrame:
    """Pairs that are similar on their full sets. Only texts of nodes in pairs are moved."""
    texts = _texts(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct(), nodes, docs)
    both = pairs.join(texts.select(F.col("node").alias("b"), F.col("text").alias("tb")), "b").join(texts.select(F.col("node").alias("a"), F.col("text").alias("ta")), "a")

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, items = None, None
        for batch in batches:
            keep = []
            for r in batch.itertuples(index=False):
                if held != r.a:
                    held, items = r.a, shingles(r.ta, width)
                keep.append(similar(items, shingles(r.tb, width)))
            yield batch.loc[keep, ["a", "b"]]

    return both.select("a", "b", "ta", "tb").mapInPandas(compare, "a long, b long")


def keyed(docs: DataFrame) -> DataFrame:
    """The rows with their KEY; NULL ids have a hash like any other value."""
    return docs.withColumns({"id_key": F.xxhash64("doc_id"), "text_key": text_key("text")})


def _texts(wanted: DataFrame, nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """node and text of the wanted nodes, from one row each; other rows are dropped by a bitmap where they are read."""
    named = nodes.select("node", "own.id_key", "own.text_key").join(wanted, "node", "left_semi")
    named = written(named, "candidate-rows")
    bitmap = sieve(named.select(F.xxhash64(*KEY).alias("key")), "key")
    texts = sifted(docs.select(*KEY, "text"), F.xxhash64(*KEY), bitmap).dropDuplicates(KEY)
    return written(texts.join(named, KEY).select("node", "text"), "candidate-texts")


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node with a link; the component is its smallest node."""
    edges = written(_oriented(links.toDF("u", "v")), "links")
    state = None
    while True:
        both = edges.union(edges.select("v", "u"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = _oriented(both.join(low, "u").where("v > u").select("v", "m").toDF("u", "v"))
        large = written(large, "large-star")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select("v", "m").union(low.select("u", "m")).toDF("u", "v")
        edges = written(_oriented(small), "small-star")
        new = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if new == state:
            return edges.toDF("node", "component")
        state = new


def _oriented(edges: DataFrame) -> DataFrame:
    """Distinct edges from the larger to the smaller node."""
    return edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _pair(a: Column, b: Column) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def similar_links(nodes: DataFrame, docs: DataFrame, width: int) -> DataFrame | None:
    """Labels (node, component) of all nodes with a confirmed link; None if there are none."""
    every = written(nodes.select("node", F.explode("bands").alias("key")), "bands")
    shared = every.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("first")).where("n > 1")
    members = written(every.join(shared, "key").select("key", "node", "n", "first"), "members")
    stars = members.where("node <> first").select(*_pair(F.col("node"), F.col("first")))
    links, labels = _extended(None, None, stars, nodes, docs, width, "stars")
    named = _named(members, labels)
    ends = named.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high")
    open_keys = written(named.join(ends.select("key"), "key"), "open-keys")
    few = open_keys.where(F.col("n") <= KEY_ROWS).select("key", "node", "component")
    pairs = few.join(few.toDF("key", "node2", "component2"), "key").where("node < node2 and component <> component2")
    links, labels = _extended(links, labels, pairs.select(*_pair(F.col("node"), F.col("node2"))), nodes, docs, width, "pairs")
    many = _named(open_keys.where(F.col("n") > KEY_ROWS).drop("component"), labels)
    return _with_left_overs(labels, written(many, "large-keys"), nodes, docs, width)


def _with_left_overs(labels: DataFrame | None, many: DataFrame, nodes: DataFrame, docs: DataFrame, width: int) -> DataFrame | None:
    """The labels with the links between the left-overs of large keys and all that they share a key with."""
    sizes = many.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n"))
    main = sizes.groupBy("key").agg(F.max_by("component", F.struct("n", "component")).alias("main"))
    placed = many.join(main, "key").select("main", "node", "component").distinct()
    placed = written(placed.withColumn("left_over", F.col("component") != F.col("main")), "placed")
    if placed.where("left_over").isEmpty():
        return labels
    blocks = placed.groupBy("main").agg(
        F.ceil(F.count_if("left_over") / BLOCK_ROWS).cast("int").alias("n_left"), F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("int").alias("n_all")
    ).where("n_left > 0")
    texts = _texts(placed.select("node").distinct(), nodes, docs)
    rows = placed.join(blocks, "main").join(nodes.select("node", "marks"), "node").join(texts, "node")
    block = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    cells = ["main", "left_block", "block"]
    content = ["node", "component", "marks", "text"]
    asked = rows.where("left_over").withColumn("left_block", block("n_left")).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("n_all") - 1)))
    given = rows.withColumn("block", block("n_all")).withColumn("left_block", F.explode(F.sequence(F.lit(0), F.col("n_left") - 1)))
    both = asked.select(*cells, F.lit(True).alias("asks"), *content).unionByName(given.select(*cells, F.lit(False).alias("asks"), *content))

    def compare(cell: pd.DataFrame) -> pd.DataFrame:
        left, right = (cell[cell["asks"] == side].sort_values("node") for side in (True, False))
        found = []
        if len(left) and len(right):
            own, other = (np.frombuffer(b"".join(x["marks"]), np.uint8).reshape(-1, HASHES) for x in (left, right))
            sets: dict = {}
            members = list(right[["node", "component", "text"]].itertuples(index=False))
            for row, marks in zip(left.itertuples(index=False), own, strict=True):
                agree = (other == marks).mean(axis=1)
                done = {row.component}
                for i in np.argsort(-agree, kind="stable"):
                    if agree[i] < ESTIMATE:
                        break
                    node, component, text = members[i]
                    if component in done:
                        continue
                    for key, value in ((row.node, row.text), (node, text)):
                        if key not in sets:
                            sets[key] = shingles(value, width)
                    if similar(sets[row.node], sets[node]):
                        found.append((min(row.node, node), max(row.node, node)))
                        done.add(component)
        return pd.DataFrame(found, columns=["a", "b"])

    links = written(both.groupBy(*cells).applyInPandas(compare, "a long, b long"), "left-over-links")
    if links.isEmpty():
        return labels
    return components(links if labels is None else links.union(labels.toDF("a", "b")))


def _named(members: DataFrame, labels: DataFrame | None) -> DataFrame:
    if labels is None:
        return members.withColumn("component", F.col("node"))
    return members.join(labels, "node", "left").select(*members.columns, F.coalesce("component", "node").alias("component"))


def _extended(links, labels, pairs: DataFrame, nodes: DataFrame, docs: DataFrame, width: int, name: str):
    """The links with those found among the pairs, and the components they make."""
    pairs = pairs.distinct()
    if labels is not None:
        of_a, of_b = (labels.select(F.col("node").alias(c), F.col("component").alias(f"c{c}")) for c in "ab")
        pairs = pairs.join(of_a, "a", "left").join(of_b, "b", "left").where(~F.coalesce("ca", "a").eqNullSafe(F.coalesce("cb", "b"))).select("a", "b")
    likely = written(estimated(pairs, nodes), f"likely-{name}")
    if likely.isEmpty():
        return links, labels
    found = written(confirmed(likely, nodes, docs, width), f"confirmed-{name}")
    if found.isEmpty():
        return links, labels
    # a node's component stands for the links found before
    links = found if labels is None else found.union(labels.toDF("a", "b"))
    return links, components(links)


def judged(rows: DataFrame, width: int) -> DataFrame:
    """doc_id, KEY, n_shingles, component_id and kept of every row with a doc_id, a KEY and a text."""
    signed = written(signatures(rows, width), "signatures")
    own = F.struct(F.col("doc_id").isNull().alias("without_id"), "doc_id", "text_key", "id_key")
    nodes = signed.where("set_key is not null").groupBy("set_key").agg(F.min(own).alias("own"), F.first("bands").alias("bands"), F.first("marks").alias("marks"))
    # numbers hold once they are written
    nodes = written(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    labels = similar_links(nodes.select("node", "own", "bands", "marks"), rows, width)
    names = nodes.select("set_key", "node", "own")
    if labels is not None:
        labels = written(labels.union(labels.select("component", "component").distinct()), "components")
        firsts = labels.join(nodes.select("node", "own"), "node").groupBy("component").agg(F.min("own").alias("first"))
        firsts = labels.join(firsts, "component").select("node", "first")
        names = names.join(firsts, "node", "left").select("set_key", F.coalesce("first", "own").alias("own"))
    names = names.select("set_key", F.col("own.doc_id").alias("name"), *[F.col(f"own.{k}").alias(f"own_{k}") for k in KEY])
    out = signed.select("doc_id", *KEY, "n_shingles", "set_key").join(names, "set_key", "left")
    kept = F.col("set_key").isNull() | ((F.col("id_key") == F.col("own_id_key")) & (F.col("text_key") == F.col("own_text_key")))
    return out.select("doc_id", *KEY, "n_shingles", F.when(F.col("set_key").isNull(), F.col("doc_id")).otherwise(F.col("name")).alias("component_id"), kept.alias("kept"), F.col("set_key").isNull().alias("empty"))


def near_duplicates(docs: DataFrame, width: int = WIDTH, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id and kept (the component's own row) of every row."""
    rows = keyed(docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text")))
    return judged(rows, width).select("doc_id", "n_shingles", "component_id", "kept")


def deduplicated(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """The rows of ``docs`` with one row of each component left, all columns kept."""
    rows, names = numbered(docs)
    rows = keyed(rows.withColumn("doc_id", F.col(names[docs.columns.index("doc_id")])))
    found = judged(rows.select("doc_id", *KEY, "text"), width).where("not empty")
    marks = found.groupBy(*KEY).agg(F.first("kept").alias("kept"), F.count(F.lit(1)).alias("n")).where("not kept or n > 1")
    marks = written(marks, "duplicates")
    out = unlisted(rows, marks, KEY).select(*names)
    repeated = marks.where("kept").select(*KEY)
    if not repeated.isEmpty():
        # rows of one id and text are reduced where they are read; they can differ in other columns only
        again = sifted(rows, F.xxhash64(*KEY), sieve(repeated.select(F.xxhash64(*KEY).alias("key")), "key"))
        row = F.struct(*names)
        # not a semi-join, which would be pushed below the bitmap
        again = again.groupBy(*KEY).agg(F.min_by(row, F.to_json(row)).alias("row")).join(repeated, KEY)
        out = out.union(again.select("row.*"))
    return out.toDF(*docs.columns)
