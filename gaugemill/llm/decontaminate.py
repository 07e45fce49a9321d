"""Benchmark decontamination by winnowing, with built-in functions only.

Every text is cut into words; the hashes of its k-grams run past a window of w positions and the rightmost smallest hash
of each window is its fingerprint. A span of ``k + w - 1`` words therefore has a fingerprint that depends on nothing
outside it, so every shared span of that length meets in the join of document and benchmark fingerprints, on the same
alignment. A meeting is then extended: the item is laid over the document at that alignment and all runs of equal
words that are long enough count. Items shorter than a window are found by their first word and compared whole.

Shuffles: fingerprints (about two words in nine), and the texts of documents that met an item. Those are picked with a
bitmap of fixed size, so documents without a meeting are not moved.

Defined results: a NULL or empty text has no words and no hits; a benchmark row without id or words is not searched;
repeated document rows each get their result; an item id that occurs twice counts once; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugemill.llm._rows import numbered, pairwise, same_row, sieve, sifted, text_key, unlisted, written

# The word definition and the length of a window in words.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"  # taken before A-Z are lower-cased
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPAN = 13

# Runs of GRAM + WINDOW - 1 words, at most SPAN, share a fingerprint; both are powers of two.
GRAM, WINDOW = 4, 8
POSITION_BITS = 28
POSITIONS = (1 << POSITION_BITS) - 1
BROADCAST_ROWS = 2_000_000
KEY = ["doc_id", "text_key"]


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def lowered(word: Column) -> Column:
    """A-Z in lower case, all else as it is. ``translate`` is slow, so only words that ``lower`` changes pass it."""
    return F.when(F.lower(word) == word, word).otherwise(F.translate(word, UPPER, LOWER))


def lowered_words(text: Column) -> Column:
    return F.transform(words_of(text), lowered)


def fingerprints(rows: DataFrame, keep: list[str], words: str) -> DataFrame:
    """``prints`` beside ``keep``: hash bits and position of the rightmost smallest k-gram of each window, packed.

    The low bits hold the distance from the last possible position, so the smallest value of a window is its rightmost
    smallest hash. Texts of fewer than ``GRAM + WINDOW - 1`` words have none.
    """
    rows = rows.select(*keep, F.transform(words, lambda w: F.xxhash64(lowered(w))).alias("_grams"))
    rows = _doubled(rows, keep, GRAM, lambda a, b: F.xxhash64(a, b))
    packed = F.transform("_grams", lambda g, i: F.shiftleft(g, POSITION_BITS).bitwiseOR(F.lit(POSITIONS) - i))
    rows = _doubled(rows.select(*keep, packed.alias("_grams")), keep, WINDOW, lambda a, b: F.least(a, b))
    return rows.select(*keep, F.array_distinct("_grams").alias("prints"))


def _doubled(rows: DataFrame, keep: list[str], width: int, fn) -> DataFrame:
    """``_grams`` combined over all runs of ``width`` elements, a power of two, by doubling the width of runs."""
    by = 1
    while by < width:
        rows = rows.select(*keep, pairwise("_grams", "_grams", by, fn).alias("_grams"))
        by *= 2
    return rows


def unpacked(rows: DataFrame, keep: list[str], position: str) -> DataFrame:
    rows = rows.select(*keep, F.explode("prints").alias("_print"))
    return rows.select(*keep, F.shiftright("_print", POSITION_BITS).alias("print"), (F.lit(POSITIONS) - F.col("_print").bitwiseAND(F.lit(POSITIONS))).cast("int").alias(position))


def contamination(docs: DataFrame, benchmark: DataFrame, span: int = SPAN, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """Per document row: doc_id, text_key, n_words, n_hit, items (ids as text, sorted) and whether it is contaminated."""
    base = docs.select(F.col(doc_id).alias("doc_id"), text_key(text).alias("text_key"), F.col(text).alias("text"))
    rows = base.select(*KEY, words_of(F.col("text")).alias("_words"))
    rows = rows.select(*KEY, F.size("_words").cast("long").alias("n_words"), "_words")
    prints = written(fingerprints(rows, [*KEY, "n_words"], "_words"), "doc-prints")

    items = benchmark.where(F.col(item_id).isNotNull()).select(F.col(item_id).alias("item_id"), text_key(item_text).alias("item_key"), lowered_words(F.col(item_text)).alias("item_words"))
    items = written(items.where(F.size("item_words") > 0).dropDuplicates(["item_id", "item_key"]), "item-words")
    item_prints = unpacked(written(fingerprints(items, ["item_id", "item_key"], "item_words"), "item-prints"), ["item_id", "item_key"], "item_at")
    small = items.count() <= BROADCAST_ROWS // 100 and item_prints.count() <= BROADCAST_ROWS
    shared = F.broadcast if small else (lambda df: df)

    diagonal = (F.col("doc_at") - F.col("item_at")).alias("offset")
    seeds = unpacked(prints, KEY, "doc_at").join(shared(item_prints), "print").select(*KEY, "item_id", "item_key", diagonal)
    short = items.where(F.size("item_words") < span).select("item_id", "item_key", F.get("item_words", F.lit(0)).alias("word"))
    if not short.isEmpty():
        every = base.select(*KEY, F.posexplode(lowered_words(F.col("text"))).alias("offset", "word"))
        seeds = seeds.unionByName(every.join(shared(short), "word").select(*KEY, "item_id", "item_key", "offset"))
    seeds = written(seeds.distinct(), "seeds")

    met = seeds.join(shared(items), ["item_id", "item_key"])
    keys = seeds.select(*KEY).distinct().select(F.xxhash64(*KEY).alias("_key"))
    texts = sifted(base, F.xxhash64(*KEY), sieve(keys, "_key")).dropDuplicates(KEY)
    laid = met.join(texts, same_row(met, texts, KEY)).select(met["doc_id"], met["text_key"], "item_id", "item_words", "offset", lowered_words(texts["text"]).alias("_words"))
    # empty hits go after the write: a filter before it would be pushed below, with all that computes it
    hits = written(_extended(laid, span), "hits").where(F.size("at") > 0)

    hit_words = hits.select(*KEY, F.explode("at").alias("at")).distinct().groupBy(*KEY).agg(F.count(F.lit(1)).alias("n_hit"))
    hit_items = hits.select(*KEY, F.col("item_id").cast("string").alias("item")).distinct().groupBy(*KEY).agg(F.sort_array(F.collect_list("item")).alias("items"))
    found = hit_words.join(hit_items, same_row(hit_words, hit_items, KEY)).select(*[hit_words[k].alias(f"_{k}") for k in KEY], "n_hit", "items")
    condition = F.lit(True)
    for k in KEY:
        condition = condition & prints[k].eqNullSafe(found[f"_{k}"])
    out = prints.select(*KEY, "n_words").join(found, condition, "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return out.select(
        *KEY, "n_words", n_hit.alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"),
    )


def _extended(laid: DataFrame, span: int) -> DataFrame:
    """Positions of the document words in runs of equal words that are a window long or hold a whole short item."""
    need = F.least(F.lit(span), F.size("item_words"))
    equal = F.transform("item_words", lambda w, j: F.coalesce(F.get("_words", j + F.col("offset")) == w, F.lit(False)))
    equal = F.when(F.size("_words") > 0, equal).otherwise(F.array())  # two uses of the words keep them out of the lambda
    laid = laid.select(*KEY, "item_id", "offset", need.alias("_need"), equal.alias("_equal"))
    starts = F.filter(
        F.transform("_equal", lambda e, j: F.when((j <= F.size("_equal") - F.col("_need")) & F.forall(F.slice("_equal", j + 1, F.col("_need")), lambda x: x), j)),
        lambda j: j.isNotNull(),
    )
    laid = laid.select(*KEY, "item_id", "offset", "_need", starts.alias("_starts"))
    at = F.flatten(F.transform("_starts", lambda s: F.sequence(s + F.col("offset"), s + F.col("offset") + F.col("_need") - 1)))
    return laid.select(*KEY, "item_id", F.array_distinct(at).alias("at"))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that aren't contaminated, all columns kept."""
    bad = written(contamination(docs, benchmark).where("contaminated").select(*KEY).distinct(), "contaminated")
    rows, names = numbered(docs)
    rows = rows.select(*names, F.col(names[docs.columns.index("doc_id")]).alias("doc_id"), text_key("text").alias("text_key"))
    return unlisted(rows, bad, KEY).select(*names).toDF(*docs.columns)
