"""Personal data: patterns propose spans, checksums confirm them, words nearby adjust the score. Built-in functions only.

A kind is a pattern, a validity test, a starting score and context words. Positions come from the pieces between the
matches (``split`` and ``regexp_extract_all`` with one pattern), in code points, end exclusive. Patterns are written
with possessive repeats and starts that can't lie within a run, so a long run of letters or digits is read once.

Defined results: a NULL text is an empty one and has no spans; equal rows have equal spans; spans of different kinds
may overlap and are all reported; columns other than the id and the text are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CONTEXT = 48


@dataclass(frozen=True)
class Kind:
    """What is looked for. ``base`` spans are always reported, others from ``min_score`` on."""

    name: str
    pattern: str
    valid: Callable[[Column], Column]
    score: float
    words: str
    base: bool = False


def digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def octets(match: Column) -> Column:
    """All parts of a dotted address at most 255, leading zeros allowed."""
    return F.forall(F.split(match, r"\."), lambda part: part.rlike("^0*(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])$"))


def luhn(match: Column) -> Column:
    """Sum of the digits from the right, every second one doubled, is a multiple of ten."""
    chars = F.split(F.reverse(digits(match)), "")

    def value(c: Column, i: Column) -> Column:
        d = F.try_to_number(c, F.lit("9")).cast("int")
        twice = 2 * d
        return F.when(i % 2 == 0, d).when(twice > 9, twice - 9).otherwise(twice)

    return F.aggregate(F.transform(F.filter(chars, lambda c: c != ""), value), F.lit(0), lambda a, b: a + b) % 10 == 0


def mod97(match: Column) -> Column:
    """Account number check: the first four characters moved to the end, letters as 10 to 35, rest 1 modulo 97."""
    bare = F.regexp_replace(match, " ", "")
    chars = F.filter(F.split(F.concat(F.substring(bare, 5, 64), F.substring(bare, 1, 4)), ""), lambda c: c != "")

    def step(rest: Column, c: Column) -> Column:
        code = F.ascii(c)
        letter = code >= 65
        return (rest * F.when(letter, 100).otherwise(10) + F.when(letter, code - 55).otherwise(code - 48)) % 97

    return F.aggregate(chars, F.lit(0), step) == 1


def always(match: Column) -> Column:
    return F.lit(True)


# The patterns of the first four kinds and their limits.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?+[0-9]){13,18}+(?![\x20-]?[0-9])"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"

KINDS = (
    Kind("email", EMAIL, always, 0.9, "mail|contact|write", base=True),
    Kind("ip", IP, octets, 0.6, "ip|host|server|address", base=True),
    Kind("card", CARD, luhn, 0.8, "card|visa|credit|karte|carte|tarjeta", base=True),
    Kind("phone", PHONE, lambda m: F.length(digits(m)).between(10, 15), 0.7, "phone|call|tel|fax|mobile", base=True),
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])", mod97, 0.8, "iban|account|konto|compte|cuenta"),
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", lambda m: ~m.rlike("^(000|666|9)|-00-|-0000$"), 0.3, "ssn|social security|tax id"),
)
MIN_SCORE = 0.5
NEARBY_BONUS = 0.3
SPAN = "struct<start:int,rank:int,end:int,kind:string,match:string,score:double>"


def pii_spans(docs: DataFrame, keep: Iterable[str] = ("doc_id",), text: str = "text", kinds: Iterable[Kind] = KINDS, min_score: float = MIN_SCORE) -> DataFrame:
    """``spans``: array of (start, rank, end, kind, match, score) by start and rank of the kind, beside ``keep``."""
    keep, kinds = list(keep), list(kinds)
    rows = docs.select(*keep, F.coalesce(F.col(text), F.lit("")).alias("_text"))
    rows = rows.select(
        *keep, "_text",
        *[F.regexp_extract_all("_text", F.lit(k.pattern), F.lit(0)).alias(f"_m{i}") for i, k in enumerate(kinds)],
    )
    none = F.array().cast("array<int>")
    pieces = [
        F.when(F.size(f"_m{i}") > 0, F.transform(F.split("_text", k.pattern, -1), lambda p: F.length(p))).otherwise(none).alias(f"_g{i}")
        for i, k in enumerate(kinds)
    ]
    matches = [f"_m{i}" for i in range(len(kinds))]
    rows = rows.select(*keep, "_text", *matches, *pieces)
    found = [_spans(i, k).alias(f"_s{i}") for i, k in enumerate(kinds)]
    rows = rows.select(*keep, "_text", *found)
    scored = [_scored(f"_s{i}", i, k, min_score) for i, k in enumerate(kinds)]
    return rows.select(*keep, F.sort_array(F.concat(*scored)).alias("spans"))


def _spans(i: int, kind: Kind) -> Column:
    """(start, end, match) of the confirmed matches. A start is the sum of the pieces and matches before it."""
    def row(match: Column, at: Column) -> Column:
        ahead = F.aggregate(F.slice(f"_g{i}", F.lit(1), at + 1), F.lit(0), lambda a, b: a + b)
        taken = F.aggregate(F.slice(f"_m{i}", F.lit(1), at), F.lit(0), lambda a, b: a + F.length(b))
        return F.struct((ahead + taken).alias("start"), (ahead + taken + F.length(match)).alias("end"), match.alias("match"))

    spans = F.filter(F.transform(f"_m{i}", row), lambda s: kind.valid(s["match"]))
    return F.when(F.size(f"_g{i}") > 0, spans).otherwise(F.array())  # two uses of the pieces keep them out of the lambda


def _scored(column: str, rank: int, kind: Kind, min_score: float) -> Column:
    def row(s: Column) -> Column:
        begin = F.greatest(s["start"] - CONTEXT, F.lit(0))
        around = F.lower(F.concat_ws(" ", F.substring("_text", begin + 1, s["start"] - begin), F.substring("_text", s["end"] + 1, F.lit(CONTEXT))))
        near = around.rlike(rf"(?<![a-z])(?:{kind.words})")
        score = F.least(F.lit(1.0), F.lit(kind.score) + F.when(near, NEARBY_BONUS).otherwise(0.0))
        return F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end"), F.lit(kind.name).alias("kind"), s["match"].alias("match"), score.alias("score"))

    spans = F.transform(column, row)
    if not kind.base:
        spans = F.filter(spans, lambda s: s["score"] >= min_score)
    return spans.cast(f"array<{SPAN}>")


def _count(kind: str) -> Column:
    return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")


def span_list(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def pii_counts(docs: DataFrame, keep: Iterable[str] = ("doc_id",), text: str = "text") -> DataFrame:
    """Counts and digests per document: base kinds in ``base_sha256``, all spans in ``spans``."""
    keep = list(keep)
    base = [k.name for k in KINDS if k.base]
    found = pii_spans(docs, keep, text)
    return found.select(
        *keep,
        *[_count(k).alias(f"n_{k}") for k in base],
        F.sha2(span_list(F.filter("spans", lambda s: s["kind"].isin(base))), 256).alias("base_sha256"),
        span_list(F.col("spans")).alias("spans"),
    )
