"""Exact duplicates, filter audit and source divergence: small tables against plain versions, and the defined cases."""

import math
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import brute
from gaugemill.llm import digest_index, divergence, filter_audit
from gaugemill.session import work_dir

LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture
def table(spark):
    """Rows (doc_id, text, lang, source) as a documents table with columns whose names the operators use themselves."""

    def build(rows, files=1):
        rows = [(*r, None, 1, "x", "y") for r in rows]
        df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, n int, digest string, `part` string")
        path = work_dir(spark, "test-documents")
        df.repartitionByRange(files, F.desc("doc_id")).write.parquet(path)
        return path

    return build


# --- exact duplicates -------------------------------------------------------------------------------------------------


def test_groups_and_their_last_rows(spark, docs):
    rows = [(1, "a"), (2, "b"), (3, "a"), (4, None), (5, ""), (None, "a"), (7, "A"), (None, "n"), (None, "n"), (9, "z" * 200_000), (10, "z" * 200_000)]
    out = digest_index.exact_duplicates(docs(*rows)).collect()
    assert len(out) == len(rows)
    got = {(r.doc_id, r.text_sha256): (r.keep_id, r.group_size, r.kept) for r in out}
    assert got[1, brute.sha("a")] == (3, 3, False)
    assert got[3, brute.sha("a")] == (3, 3, True)
    assert got[None, brute.sha("a")] == (3, 3, False)
    assert got[4, brute.sha("")] == (5, 2, False)
    assert got[7, brute.sha("A")] == (7, 1, True)
    assert got[10, brute.sha("z" * 200_000)] == (10, 2, True)
    unnamed = [r for r in out if r.text_sha256 == brute.sha("n")]
    assert sorted(r.kept for r in unnamed) == [False, True] and {r.keep_id for r in unnamed} == {None}


def test_repeated_rows_keep_one(docs):
    out = digest_index.exact_duplicates(docs((1, "a"), (1, "a"), (1, "b"))).collect()
    assert Counter((r.text_sha256, r.kept) for r in out) == {(brute.sha("a"), True): 1, (brute.sha("a"), False): 1, (brute.sha("b"), True): 1}
    kept = digest_index.without_duplicates(docs((1, "a"), (1, "a"), (2, "b"), (3, "b"))).collect()
    assert sorted(r.doc_id for r in kept) == [1, 3]


def test_rows_without_duplicates_have_all_columns(spark, table):
    df = spark.read.parquet(table([(1, "a", "en", "s"), (2, "a", "en", "s"), (3, None, None, None)]))
    out = digest_index.without_duplicates(df)
    assert out.columns == df.columns
    assert sorted(r.doc_id for r in out.collect()) == [2, 3]


def test_empty_table_has_no_groups(docs):
    assert digest_index.exact_duplicates(docs()).count() == 0
    assert digest_index.without_duplicates(docs()).count() == 0


def test_index_is_opened_again_and_batches_can_be_repeated(spark, docs):
    path = work_dir(spark, "index")
    index = digest_index.DigestIndex(spark, path, buckets=3)
    first, second = digest_index.digests(docs((1, "a"), (2, "b"), (3, "a"))), digest_index.digests(docs((9, "a"), (8, "c"), (7, "c")))
    index.append(first, 0)
    index.append(second, 1)
    sizes = lambda i: sorted((r["size"], r["last"]["id"]) for r in i.groups().collect())
    want = [(1, 2), (2, 8), (3, 9)]
    assert sizes(index) == want
    assert [r["id"] for r in index.new_rows(second, 1).collect()] == [8]
    index.append(second, 1)  # as after a run that was cut short
    assert sizes(index) == want
    index.close()
    again = digest_index.DigestIndex(spark, path, buckets=3)
    assert sizes(again) == want
    third = digest_index.digests(docs((20, "b"), (21, "d")))
    again.append(third, 2)
    assert [r["id"] for r in again.new_rows(third, 2).collect()] == [21]


def test_anti_join_reads_the_buckets_in_place(spark, docs):
    index = digest_index.DigestIndex(spark, work_dir(spark, "index"), buckets=4)
    rows = digest_index.digests(docs((1, "a"), (2, "b")))
    index.append(rows, 0)
    groups = rows.groupBy("digest").count()
    plan = groups.join(index.entries().hint("merge"), "digest", "left_anti")._jdf.queryExecution().toString()
    physical = plan[plan.index("== Physical Plan") :]
    assert "SortMergeJoin" in physical and "Bucketed: true" in physical
    assert physical.count("Exchange hashpartitioning") == 1  # of the new rows alone
    assert "Exchange" not in index.groups()._jdf.queryExecution().toString().split("== Physical Plan")[1]


# --- filter audit -----------------------------------------------------------------------------------------------------


def audited(rows, labels):
    """The audit by its wording: each order applied to each row."""
    smallest = {}
    for i, text, _, _ in rows:
        if i is not None:
            smallest[text or ""] = min(i, smallest.get(text or "", i))
    good, toxic = ({i for i, *flags in labels if i is not None and flags[k] == 1} for k in (0, 1))
    parts = defaultdict(list)
    for i, text, _, source in rows:
        text = text or ""
        words = brute.BLANK_WORD.findall(text)
        fails = {
            "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * sum("A" <= c <= "Z" for c in text) > 2 * len(text),
            "D": any(c in "#$%&*|" for c in text), "E": i is not None and smallest[text] < i,
        }
        parts[source or ""].append((fails, i in good, i in toxic))
    out = {}
    for part, members in parts.items():
        shapley = Counter()
        for order in map("".join, permutations("ABCDE")):
            left = members
            for step, f in enumerate(order, 1):
                removed = [m for m in left if m[0][f]]
                left = [m for m in left if not m[0][f]]
                shapley[f] += len(removed)
                failing = sum(m[0][f] for m in members)
                only = sum(m[0][f] and sum(m[0].values()) == 1 for m in members)
                out[part, order, step] = [len(left), len(removed), failing - len(removed), only, sum(m[1] for m in removed), sum(m[2] for m in removed), f]
        for key in [k for k in out if k[0] == part]:
            out[key][6] = shapley[out[key][6]]
    return {k: tuple(v) for k, v in out.items()}


def audit_of(spark, path, labels, rounds):
    out = filter_audit.filter_audit(spark, path, spark.createDataFrame(labels, LABELS), rounds).collect()
    return {(r["part"], r["filter_order"], r["step"]): tuple(r[3:]) for r in out}


LONG_TEXT = " ".join(f"w{i}" for i in range(250))
AUDITED = [
    (9, LONG_TEXT, "en", "s"), (8, LONG_TEXT, "en", "t"), (3, LONG_TEXT, None, None), (3, LONG_TEXT, None, "t"), (None, LONG_TEXT, "en", "s"), (None, LONG_TEXT, "en", "s"),
    (1, None, "en", "s"), (2, "", "en", ""), (4, "Big WORDS # here", "en", "s"), (5, "a " * 300, "en", "t"), (5, "a " * 300, "en", "t"), (6, LONG_TEXT + " $", "en", "s"),
    (7, "é" * 100_000, "en", "long"),
]
AUDIT_LABELS = [(9, 1, 0), (9, 0, 1), (3, 1, 1), (5, 0, 1), (4, None, 1), (None, 1, 1), (99, 1, 1), (-1, 1, 1)]


def test_audit_retracts_when_smaller_ids_come_later(spark, table):
    """Files come in order of falling ids, so each batch takes back what the one before it said of the smallest id."""
    path = table(AUDITED, files=5)
    assert audit_of(spark, path, AUDIT_LABELS, rounds=5) == audited(AUDITED, AUDIT_LABELS)


def test_audit_of_one_batch_and_of_no_rows(spark, table):
    assert audit_of(spark, table(AUDITED), AUDIT_LABELS, rounds=1) == audited(AUDITED, AUDIT_LABELS)
    assert audit_of(spark, table([]), AUDIT_LABELS, rounds=4) == {}
    assert audit_of(spark, table(AUDITED[:3]), [], rounds=4) == audited(AUDITED[:3], [])


def test_task_hands_on_when_full(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(filter_audit, "HELD_TEXTS", 1)
    batch = pa.record_batch({"id": pa.array([5, 4, None]), "part": ["p", "p", "q"], "digest": ["d", "d", "d"], "mask": pa.array([1, 1, 1], pa.int32())})
    rows = [tuple(r.values()) for b in filter_audit.gathered([batch, batch]) for r in b.to_pylist()]
    assert Counter(rows) == {("#17#p", None, "p", 17, 2): 2, ("#1#q", None, "q", 1, 1): 2, ("d", 4, "p", 1, 1): 2}


# --- source divergence ------------------------------------------------------------------------------------------------


def diverging(rows, least=10):
    """Both parts by their wording."""
    import re

    term = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    counts, seen = defaultdict(Counter), defaultdict(Counter)
    for _, text, lang, source in rows:
        found = term.findall((text or "").translate(brute.LOWER))
        counts[lang or "", source or ""].update(found)
        seen[lang or ""].update(set(found))
    out = set()
    for lang in seen:
        kept = [t for t, n in seen[lang].items() if n >= least]
        whole = Counter()
        for (x, _), c in counts.items():
            if x == lang:
                whole.update({t: c[t] for t in kept})

        def p(c):
            total = sum(c[t] for t in kept) + 2 * len(kept)
            return {t: 1 + 1_000_000_000 * (c[t] + 2) // total for t in kept}

        price = lambda a, b: (a - b) * (a - b) // (a + b)
        q, own = p(whole), {s: p(c) for (x, s), c in counts.items() if x == lang}
        for s in own:
            pairs = sorted((-sum(price(own[s][t], own[o][t]) for t in kept), o.encode(), o) for o in own if o != s)
            terms = sorted((-price(own[s][t], q[t]), t.encode(), t) for t in kept if counts[lang, s][t] and own[s][t] > q[t])
            out |= {(lang, s, "pair", o, -v, i) for i, (v, _, o) in enumerate(pairs, 1)}
            out |= {(lang, s, "term", t, -v, i) for i, (v, _, t) in enumerate(terms[:10], 1)}
    return out


def divergence_of(spark, path):
    out = [tuple(r) for r in divergence.source_divergence(spark.read.parquet(path)).collect()]
    assert len(out) == len(set(out))
    return set(out)


def worded(seed, n, langs=("en", "de"), sources=5):
    draw = np.random.default_rng(seed)
    words = ["Red", "blue", "élan", "Été", "zebra", "x", "日本", "don", "t", *(f"w{chr(97 + i)}" for i in range(26))]
    return [(i, " ".join(draw.choice(words, draw.integers(0, 40))) + " don't 5", langs[draw.integers(len(langs))], f"s{draw.integers(sources) ** 2 % 7}") for i in range(n)]


def test_divergence_against_plain_counts(spark, table):
    rows = worded(1, 150) + [(500, None, None, None), (501, "a", "en", "lonely"), (502, "", "xx", "a"), (503, "b c", "xx", "b"), (504, "Red " * 50_000, "de", "s1"), (504, "Red " * 50_000, "de", "s1")]
    assert divergence_of(spark, table(rows, files=3)) == diverging(rows)


def test_divergence_over_several_sides_and_blocks(spark, table, monkeypatch):
    monkeypatch.setattr(divergence, "SIDE", 2)
    monkeypatch.setattr(divergence, "BLOCK_TERMS", 4)
    rows = worded(2, 200, langs=("en",), sources=9)
    assert divergence_of(spark, table(rows, files=2)) == diverging(rows)


def test_divergence_of_no_rows(spark, table):
    assert divergence_of(spark, table([])) == set()


def test_tasks_hand_on_counts_and_walk_long_texts(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(divergence, "HELD_TERMS", 1)
    monkeypatch.setattr(divergence, "LONG", 4)
    batch = pa.record_batch({"lang": ["l", "l"], "source": ["s", "s"], "text": pa.array([b"A b a", "ß".encode()], pa.binary())})
    rows = [tuple(r.values()) for b in divergence.counted([batch]) for r in b.to_pylist()]
    assert rows == [("l", "s", "a", 2, 1), ("l", "s", "b", 1, 1), ("l", "s", "ß", 1, 1)]


@settings(deadline=None, max_examples=60)
@given(st.lists(st.lists(st.integers(0, 2), min_size=8, max_size=8), min_size=2, max_size=5))
def test_walk_counts_every_place(rows):
    counts = np.array(rows)
    leaves, (*tables, roots) = divergence.consed(counts)
    first, second = np.triu_indices(len(rows), 1)
    pair, a, b, places = divergence.walk(roots, tables, first, second)
    got = {(int(p), int(leaves[x]), int(leaves[y])): int(n) for p, x, y, n in zip(pair, a, b, places, strict=True)}
    want = Counter((k, x, y) for k, (i, j) in enumerate(zip(first, second, strict=True)) for x, y in zip(rows[i], rows[j], strict=True))
    assert got == dict(want)


def test_equal_subtrees_are_one_node():
    counts = np.array([[1, 2, 1, 2, 1, 2, 1, 2], [1, 2, 1, 2, 0, 0, 0, 0]])
    leaves, (*tables, roots) = divergence.consed(counts)
    assert [len(t) for t in tables] == [2, 2, 2] and math.prod(roots.shape) == 2 and len(leaves) == 3


def test_labels_of_the_audit_are_not_broadcast(spark):
    docs = spark.createDataFrame([(1, "a b", "s")], "doc_id long, text string, source string")
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    plan = filter_audit.masked(docs, labels)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
