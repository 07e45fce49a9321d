"""Quality rules: a threshold table compiled into one projection of built-in functions.

``measured`` adds the counts of a text, ``RULES`` bounds ratios of them, ``verdicts`` turns the table into one boolean
per rule. A row never leaves its task, so there is no shuffle and no state that grows with the corpus.

Defined results: a NULL or empty text has no words and fails; ties and repeated rows are judged alike; columns other
than the id and the text are not read.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugemill.llm._rows import pairwise

# The word definition, symbols that are counted.
WORD = r"[^\x20\x09-\x0D]+"
SYMBOL = "[#*$%&|<>]"
MARK = "[!?]"

# Common function words of English, German, French and Spanish.
STOP_WORDS = (
    "the of and to in a is that it for was on with as be by this from at or are an not which have "
    "der die und den von das mit sich des auf für ist im dem nicht ein eine als auch es zu "
    "de la le et les des en un du une est que pour qui dans par sur au pas avec "
    "el los y del se las por con no una su para al lo como"
).split()



@dataclass(frozen=True)
class Rule:
    """``low <= numerator / denominator <= high``; with an empty denominator the rule fails."""

    name: str
    numerator: str
    denominator: str
    low: float = float("-inf")
    high: float = float("inf")

    def holds(self) -> Column:
        over = F.col(self.denominator).cast("double")
        ratio = F.col(self.numerator) / F.when(over > 0, over)
        return F.coalesce((ratio >= self.low) & (ratio <= self.high), F.lit(False))


RULES = (
    Rule("word_length", "word_chars", "n_words", 2.0, 15.0),
    Rule("symbols_per_word", "n_symbols", "n_words", high=0.1),
    Rule("marks_per_word", "n_marks", "n_words", high=0.5),
    Rule("stop_words", "n_stop_words", "n_words", low=0.02),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", high=0.5),
    Rule("bullet_lines", "n_bullet_lines", "n_lines", high=0.9),
    Rule("cut_lines", "n_cut_lines", "n_lines", high=0.3),
)
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50


def measured(docs: DataFrame, keep: Iterable[str] = ("doc_id",), text: str = "text") -> DataFrame:
    """Counts per text, beside the columns named in ``keep``.

    ``n_repeat_words`` counts the words that lie in a 3-word window found twice or more. Windows are sorted by the 64 bits
    of their hash, then their position; neighbours of equal hash are confirmed on the words themselves.
    """
    keep = list(keep)
    rows = docs.select(*keep, F.coalesce(F.col(text), F.lit("")).alias("_text"))
    rows = rows.select(
        *keep, "_text",
        F.regexp_extract_all("_text", F.lit(WORD), F.lit(0)).alias("_words"),
        F.filter(F.split("_text", "\n"), lambda line: line.rlike(WORD)).alias("_lines"),
    )
    carried = [*keep, "_text", "_words", "_lines"]
    rows = rows.select(*carried, F.transform("_words", lambda w: F.xxhash64(w)).alias("_hashes"))
    rows = rows.select(*carried, "_hashes", pairwise("_hashes", "_hashes", 1, lambda a, b: F.xxhash64(a, b)).alias("_pairs"))
    rows = rows.select(*carried, pairwise("_pairs", "_hashes", 2, lambda a, b: F.xxhash64(a, b)).alias("_windows"))
    placed = F.transform("_windows", lambda h, i: F.struct(h.alias("hash"), i.alias("at")))
    rows = rows.select(*carried, F.sort_array(placed).alias("_windows"))

    def both(a: Column, b: Column) -> Column:
        equal = a["hash"] == b["hash"]
        for j in range(3):
            equal = equal & (F.get("_words", a["at"] + j) == F.get("_words", b["at"] + j))
        return F.when(equal, F.array(a["at"], b["at"]))

    found = F.flatten(F.filter(pairwise("_windows", "_windows", 1, both), lambda x: x.isNotNull()))
    rows = rows.select(*carried, F.sort_array(F.array_distinct(found)).alias("_found"))
    covered = F.transform("_found", lambda p, i: F.least(F.lit(3), F.coalesce(F.get("_found", i + 1) - p, F.lit(3))))
    return rows.select(
        *keep,
        F.size("_words").cast("long").alias("n_words"),
        F.aggregate("_words", F.lit(0).cast("long"), lambda a, w: a + F.length(w)).alias("word_chars"),
        F.regexp_count("_text", F.lit(SYMBOL)).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.aggregate(covered, F.lit(0), lambda a, b: a + b).cast("long").alias("n_repeat_words"),
        F.regexp_count("_text", F.lit(MARK)).cast("long").alias("n_marks"),
        F.size("_lines").cast("long").alias("n_lines"),
        F.size(F.filter("_words", lambda w: w.isin(STOP_WORDS + [w.capitalize() for w in STOP_WORDS]))).cast("long").alias("n_stop_words"),
        F.size(F.filter("_lines", lambda line: F.ltrim(line).rlike("^[-*•]"))).cast("long").alias("n_bullet_lines"),
        F.size(F.filter("_lines", lambda line: F.rtrim(line).rlike(r"(\.\.\.|…)$"))).cast("long").alias("n_cut_lines"),
    )


def verdicts(measures: DataFrame, rules: Iterable[Rule] = RULES, min_words: int = MIN_WORDS, max_repeat_percent: int = MAX_REPEAT_PERCENT) -> DataFrame:
    """``base_failed`` (too short or too repetitive), one boolean ``ok_<rule>`` per rule, and ``kept``."""
    rules = list(rules)
    base = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    judged = measures.select("*", base.alias("base_failed"), *[r.holds().alias(f"ok_{r.name}") for r in rules])
    kept = ~F.col("base_failed")
    for r in rules:
        kept = kept & F.col(f"ok_{r.name}")
    return judged.withColumn("kept", kept)


def quality_rules(docs: DataFrame, keep: Iterable[str] = ("doc_id",), text: str = "text", rules: Iterable[Rule] = RULES) -> DataFrame:
    """Measures and verdicts of every row."""
    return verdicts(measured(docs, keep, text), rules)
