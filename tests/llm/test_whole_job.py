"""Cases in which an operator once did less than its docstring says."""

import numpy as np

LANGUAGES = {
    "aa": ["tion", "the", "ing", "er", "and", "of", "re", "on"],
    "bb": ["schau", "keit", "ung", "ver", "ein", "zu", "pf", "ge"],
}
OTHER = ["kaik", "tyvät", "ollu", "hmis", "yys", "ssä", "vapa", "ikko"]


def spoken(parts, words, seed):
    rng = np.random.default_rng(seed)
    return " ".join("".join(rng.choice(parts, rng.integers(1, 4))) for _ in range(words))


def test_pipeline_language_stage_rejects_other_languages_and_junk(spark, docs):
    import corpus_pipeline

    rows = [(i, spoken(LANGUAGES[x], 120, i), x, None, None) for i, x in enumerate(["aa", "bb"] * 60)]
    rng = np.random.default_rng(9)
    junk = " ".join("".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 6)) for _ in range(80))
    clean = {
        1000: spoken(LANGUAGES["aa"], 80, 501), 1001: spoken(LANGUAGES["bb"], 3, 502), 1002: "the", 1003: "keitung",
        1004: spoken(LANGUAGES["aa"], 60, 503) + " " + spoken(LANGUAGES["bb"], 60, 504), 1005: "the " * 300,
        1006: "token 2abc3ff2ca8fb1e4c565a0eb63815530a948bdde " + spoken(LANGUAGES["aa"], 3, 505),
        1007: spoken(LANGUAGES["aa"], 100, 506) + " " + junk[:200],
    }
    bad = {2000: junk, 2001: spoken(OTHER, 80, 507), 2002: "все люди рождаются свободными и равными", 2003: spoken(LANGUAGES["bb"], 15, 508) + " " + junk, 2004: "12 !!", 2005: None}
    rows += [(i, t, None, None, None) for i, t in (clean | bad).items()]
    kept = {r["doc_id"] for r in corpus_pipeline.languages(spark, spark.createDataFrame(rows, docs().schema), "").collect()}
    assert kept == {*range(120), *clean}


def test_letters_of_all_training_rows_are_counted(spark, docs):
    """Words that only rows beside the field's sample hold are usual ones too, and so is the end of a long text."""
    import corpus_pipeline
    from gaugemill.llm import langid_crf

    frame = spark.createDataFrame([(i, f"word {i}", "aa", None, None) for i in range(1200)], docs().schema)
    sampled = set(langid_crf.sample(frame)[0])
    rows = [(i, spoken(LANGUAGES["aa"] if f"word {i}" in sampled else OTHER, 40, i), "aa", None, None) for i in range(1200)]
    kept = {r["doc_id"] for r in corpus_pipeline.languages(spark, spark.createDataFrame(rows, docs().schema), "").collect()}
    assert 0 < len(sampled) <= langid_crf.PER_LANGUAGE and kept == set(range(1200))


def test_support_of_a_table_has_all_its_letters(spark, docs, monkeypatch):
    """Letter counts equal those of all training rows, however often a worker empties its tables; the limits are near those of lists."""
    from collections import Counter
    from zlib import crc32

    from gaugemill.llm import langid_crf

    rows = [(i, spoken(LANGUAGES["aa" if i % 3 else "bb"], 60, i), "aa" if i % 3 else "bb", None, None) for i in range(900)]
    rows += [(5000, spoken(LANGUAGES["aa"], 60_000, 77) + " " + spoken(OTHER, 2000, 78), "aa", None, None), (5001, None, "aa", None, None), (5002, "12", "cc", None, None)]
    rows += [(6000 + i, "one text only", "dd", None, None) for i in range(20)] + [(6100, "two texts", "ee", None, None), (6103, "no more than two", "ee", None, None)]
    known = [r for r in rows if crc32(str(r[0]).encode()) % 4 != 2 and r[1]]
    names = sorted({r[2] for r in known})
    monkeypatch.setattr(langid_crf, "COUNTED_WORDS", 50)
    counted = list(langid_crf.counted_runs((r[2], 0, r[1]) for r in known))
    assert len(counted) > 50
    monkeypatch.undo()
    found = langid_crf.taught_support(spark.createDataFrame(rows, docs().schema).repartition(7), names)
    of = {name: Counter(w for r in known if r[2] == name for w in langid_crf.words_of(r[1])) for name in names}
    for j, name in enumerate(names):
        if of[name]:
            runs, n = langid_crf.letter_runs(of[name])
            alone = langid_crf.Letters(runs, n[:, None])
            words = [*of[name], "zzxy"]
            assert np.allclose(found.letters.per_word(words)[:, j], alone.per_word(words)[:, 0], atol=1e-4)
            total = Counter()
            for language, _, runs_of, times in counted:
                if language == name:
                    total.update(dict(zip(runs_of.tolist(), times.tolist(), strict=True)))
            assert total == dict(zip(runs.tolist(), n.tolist(), strict=True))
    limits = dict(zip(names, found.limits, strict=True))
    lists = langid_crf.fit_support([r[1] for r in known], [r[2] for r in known])
    assert np.abs(limits["aa"][:5] - lists.limits[names.index("aa")][:5]).max() < 0.5
    assert (limits["cc"] == langid_crf.ALPHABET).all() and (limits["dd"] == langid_crf.ALPHABET).all()
    assert len({r[0] for r in known if r[2] == "ee"}) == 2 and limits["ee"][0] < 100  # two texts are never in one part


def test_secrets_by_structure_of_urls_and_armoured_blocks():
    import base64
    import time

    from gaugemill.llm import secret_scan

    def field(data):
        return len(data).to_bytes(4, "big") + data

    def block(label, data, headers=""):
        text = base64.b64encode(data).decode()
        lines = "\n".join(text[i : i + 64] for i in range(0, len(text), 64))
        return f"-----BEGIN {label}-----\n{headers}{lines}\n-----END {label}-----"

    kinds = lambda t: {s[0] for s in secret_scan.find_secrets(t)}
    url = "see https://user:pass-word@host.example/path, http://host:80/a@b and mailto://user@host"
    assert secret_scan.find_secrets(url) == [("basic", 4, url.index("host."))]
    assert secret_scan.redacted(url).startswith("see [SECRET]host.example/path, http://host:80/a@b")
    assert kinds("redis://:sesame99@cache 1http://a:b@c") == {"basic"} and not kinds("://a:b@c")
    ssh = b"openssh-key-v1\0" + field(b"none") + field(b"none") + field(b"") + (1).to_bytes(4, "big") + field(bytes(51)) + field(bytes(range(136)))
    assert kinds(block("OPENSSH PRIVATE KEY", ssh)) == {"pem"}
    assert not kinds(block("OPENSSH PRIVATE KEY", ssh[:-1])) and not kinds(block("OPENSSH PRIVATE KEY", ssh + b"x"))
    der = bytes([0x30, 0x26, 0x02, 0x01, 0x00, 0x30, 0x0D, 0x06, 0x09, *range(9), 0x05, 0x00, 0x04, 0x12, *range(18)])
    assert "pem" in kinds(block("RSA PRIVATE KEY", der, "Comment: a key,\n of mine\n\n"))
    cipher = "Proc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,00112233445566778899AABBCCDDEEFF\n\n"
    assert kinds(block("RSA PRIVATE KEY", bytes(range(64)), cipher)) == {"pem"}
    assert "pem" not in kinds(block("RSA PRIVATE KEY", bytes(range(63)), cipher)) | kinds(block("RSA PRIVATE KEY", bytes(range(64))))
    start = time.monotonic()
    for part in ("-----BEGIN KEY-----", "a://b:", "://", "a" * 50, "://u:"):
        secret_scan.find_secrets(part * 20_000)
    assert time.monotonic() - start < 20


def test_near_duplicates_keep_one_row_of_each_component(spark, docs):
    from gaugemill.llm import near_dup

    texts = [" ".join(f"{name}{i}" for i in range(60)) for name in "abcdef"]
    near = texts[5] + " more"
    rows = [
        (1, texts[0]), (None, texts[0]), (None, texts[1]),  # a copy without id, and an unrelated row without id
        (None, texts[2]), (None, texts[2]), (None, texts[2].upper()),  # copies of which none has an id
        (7, texts[0]), (7, texts[3]), (8, texts[3]),  # one id with two texts, each with a copy
        (9, texts[4]), (9, texts[4]), (9, texts[4]),  # repeated rows
        (None, near), (12, texts[5]), (None, None), (None, None), (13, ""), (13, ""),
    ]
    kept = [(r["doc_id"], (r["text"] or "").lower()) for r in near_dup.deduplicated(docs(*rows)).collect()]
    want = [(1, texts[0]), (None, texts[1]), (None, texts[2]), (7, texts[3]), (9, texts[4]), (12, texts[5]), (None, ""), (None, ""), (13, ""), (13, "")]
    assert sorted(kept, key=repr) == sorted(want, key=repr)
    found = near_dup.near_duplicates(docs(*rows)).collect()
    assert len(found) == len(rows) and {r["component_id"] for r in found if r["doc_id"] == 7} == {1, 7}
    other = spark.createDataFrame([(1, texts[0], "x"), (1, texts[0], "y")], "doc_id long, text string, lang string")
    assert [tuple(r) for r in near_dup.deduplicated(other).collect()] == [(1, texts[0], "x")]


def test_archives_of_repeated_ids_and_pages_without_id(spark, tmp_path):
    from gaugemill.llm import warc

    big = ["é" * 90_000, "b" * 150_000, "c" * 200_000, "d" * 150_000]
    pages = [(1, big[0]), (1, big[0]), (1, big[1]), (2, big[0]), (2, big[0]), (None, big[2]), (None, big[2]), (None, big[3]), (3, "small"), (3, "small"), (4, "small"), (5, "one")]
    frame = spark.createDataFrame([(i, "u", h) for i, h in pages], "page_id long, url string, html string").repartition(3)
    uri = f"file://{tmp_path}/warc"
    manifest = warc.write_archives(frame, uri)
    found = sorted((r["page_id"], r["payload_bytes"], r["record_type"], r["refers_to"] or "") for r in warc.read_payloads(spark, manifest, uri).collect())
    revisits = {(2, big[0]): "1", (4, "small"): "3"}
    assert found == sorted((str(i) if i else "null", len(h.encode()), "revisit" if (i, h) in revisits else "response", revisits.get((i, h), "")) for i, h in pages)
    fields = [f for m in manifest.collect() for f, _ in warc.parse(open(m["path"], "rb"))]
    ids = [f["WARC-Record-ID"] for f in fields]
    assert len(set(ids)) == len(ids)
    responses = {f["WARC-Record-ID"]: f for f in fields if f["WARC-Type"] == "response"}
    named = [(f, responses[f["WARC-Refers-To"]]) for f in fields if f["WARC-Type"] == "revisit"]
    assert len(named) == 3 and all(f["WARC-Payload-Digest"] == r["WARC-Payload-Digest"] and r["X-Page-ID"] == f["X-Refers-To-Page-ID"] for f, r in named)


def test_pipeline_keeps_rows_that_teach_no_language(spark, docs, tmp_path):
    import corpus_pipeline

    rows = [(i, f"Some words that nobody has labelled, number {i}, and more of them." * 3, None, "s", 1) for i in range(5)]
    for part in (rows, []):
        frame = spark.createDataFrame(part, docs().schema)
        assert sorted(r["doc_id"] for r in corpus_pipeline.languages(spark, frame, "").collect()) == [r[0] for r in part]
    for name, frame in (("documents", spark.createDataFrame([], docs().schema)), ("benchmark", spark.createDataFrame([(1, "a b c")], "item_id long, text string"))):
        frame.write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_pipeline_rejects_foreign_texts_of_a_table(spark, docs, tmp_path):
    """Foreign and letterless rows added to a table go, and every other row of the run stays as without them."""
    import corpus_pipeline

    known = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    foreign = ["Це зовсім інша мова, якої ніхто не вчив у цій таблиці, і вона має піти геть звідси." * 4, "これは別の言語で書かれた文章です。誰も教えていません。" * 6, "12345 67890 !!!"]
    more = spark.createDataFrame([(10**9 + i, t, None, "s", 1) for i, t in enumerate(foreign)], docs().schema)
    known.select(*docs().columns).unionByName(more).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    ids = {r["doc_id"] for r in corpus_pipeline.run(spark, str(tmp_path)).select("doc_id").collect()}
    assert not ids & {10**9, 10**9 + 1, 10**9 + 2}
    assert ids == {r["doc_id"] for r in corpus_pipeline.run(spark, "/root/testdata/sf0.001").select("doc_id").collect()}


def test_bounded_table_of_pieces(docs):
    import public_tokenizers

    from gaugemill.llm import _bpe, bpe_reuse

    path = public_tokenizers.path("word_bpe_49k.json")
    texts = [" ".join(f"word{chr(97 + (i * j) % 26)}{chr(97 + i % 26)}" for i in range(40)) for j in range(30)]
    want = [_bpe.encoder(path).encode(t) for t in texts]
    _bpe._held.clear()
    few = _bpe.encoder(path, 20)
    for text, ids in zip(texts, want, strict=True):
        assert few.encode(text) == ids and len(few) <= 20 + 40
    rows = docs(*texts)
    whole, bounded = (sorted(map(tuple, bpe_reuse.encoded(rows, path, most_pieces=n).collect())) for n in (None, 20))
    assert whole == bounded and len(whole) == 30


def _moved(df):
    """The rows of a frame and how many records its shuffles wrote."""
    rows, found, plans = df.collect(), 0, [df._jdf.queryExecution().executedPlan()]
    while plans:
        node = plans.pop()
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            plans.append(node.executedPlan())
        elif kind.endswith("QueryStageExec"):
            plans.append(node.plan())
        else:
            if kind == "ShuffleExchangeExec":
                found += node.metrics().get("shuffleRecordsWritten").get().value()
            plans += [node.children().apply(i) for i in range(node.children().size())]
    return rows, found


def test_texts_that_are_kept_are_not_moved(spark, docs, tmp_path):
    """Joins with what goes are made for the rows that its bitmap meets, also where it is too large to broadcast."""
    from gaugemill.llm import decontaminate, near_dup
    from gaugemill.llm._rows import unlisted

    own = [(i, " ".join(f"word{i}x{j}" for j in range(30))) for i in range(600)]
    passage = " ".join(f"item{j}" for j in range(20))
    rows = [*own, (700, own[5][1]), (701, own[9][1]), (701, own[9][1]), (None, own[9][1]), (702, passage), (703, passage + " end")]
    bench = spark.createDataFrame([(1, passage)], "item_id long, text string")
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept, moved = _moved(near_dup.deduplicated(docs(*rows)))
        assert sorted(r["doc_id"] for r in kept) == [*range(600), 702] and moved < 100
        kept, moved = _moved(decontaminate.clean(docs(*rows), bench))
        assert len(kept) == 604 and not {702, 703} & {r["doc_id"] for r in kept} and moved < 100
        twice = docs(*rows, *rows)
        listed = spark.createDataFrame([(None, own[9][1]), (3, own[4][1]), (4, own[4][1])], "doc_id long, text string")
        for words in (1, 1 << 17):  # a full bitmap costs work and changes nothing
            found = sorted((r["doc_id"] or -1, r["text"]) for r in unlisted(twice, listed, ["doc_id", "text"], words).collect())
            assert found == sorted((-1 if i is None else i or -1, t) for i, t in rows * 2 if (i, t) not in {(None, own[9][1]), (4, own[4][1])})
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
