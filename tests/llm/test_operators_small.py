"""Defined results for NULLs, empty and long texts, ties, repeats, empty tables and clashing names."""

import hashlib
import time
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import public_tokenizers
from ledgerline.llm import ann, bpe, chat, decontamination, language, quality, simhash, token_files, url_filters, warc
from ledgerline.llm.queries import BPE_RANKS, URL_RULES, WORD_TOKENIZER
from ledgerline.sinks.files import Stage

LONG = "the rain in spain stays mainly in the plain and so on " * 4000
DOCS = [
    (1, "The quick brown fox jumps over the lazy dog and runs away fast.", "en", "x"),
    (2, None, None, None),
    (3, "", "en", "x"),
    (4, LONG, "en", "x"),
    (5, "!!! ??? 123", "de", "y"),
    (5, "!!! ??? 123", "de", "y"),
    (None, "The quick brown fox jumps over the lazy dog and runs away fast.", None, "y"),
]


@pytest.fixture(scope="module")
def docs(spark):
    # Extra columns are named like results of the operators.
    return spark.createDataFrame(DOCS, "doc_id bigint, text string, lang string, score string").withColumns(
        {"n_words": F.lit("mine"), "ids": F.lit("mine"), "lang_pred": F.lit("mine"), "row": F.lit(1), "fp": F.lit("mine"), "_found": F.lit("mine"), "_both": F.lit("mine"), "_scan": F.lit("mine")}
    )


@pytest.fixture(scope="module")
def empty(docs):
    return docs.where("false")


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_url_filter(spark):
    urls = [
        ("https://WWW.Example.ORG/es/1?q", "example.org/es/", "block"), ("http://example.org", None, "allow"),
        ("http://badexample.org/es/", "org/", "allow"), ("http://a.example.org/en/17", "example.org/en/1", "block"),
        ("http://example.org:80/es/", None, "allow"), ("x.com/de/", None, "allow"), (None, None, "allow"), ("", None, "allow"),
        ("a://b.com/de/x#y", "com/de/", "block"), ("a://b.com?x/de/", None, "allow"), ("ä://é.com/fr/ü", "com/fr/", "allow"),
        ("p://q://com/de/", None, "allow"), ("p://" + "s." * 500 + "org/" + "z" * 5000, "org/", "allow"), ("a://com/de/", "com/de/", "block"),
    ]
    frame = spark.createDataFrame([(i, u, "mine") for i, (u, _, _) in enumerate(urls)] * 2, "page_id int, url string, host string")
    got = url_filters.judge(frame, url_filters.rule_table(spark, URL_RULES)).collect()
    assert len(got) == 2 * len(urls)
    for r in got:
        assert (r["rule"], r["verdict"]) == urls[r["page_id"]][1:], r
    assert got[0]["path"] is not None and {r["host"] for r in got if r["url"] is None} == {""}
    assert url_filters.judge(frame.where("false"), url_filters.rule_table(spark, URL_RULES)).count() == 0
    none = url_filters.rule_table(spark, [(None, "block"), ("/x", "block")])
    assert {r["verdict"] for r in url_filters.judge(frame, none).collect()} == {"allow"}
    both = url_filters.rule_table(spark, [("org/", "allow"), ("ORG/", "block"), ("org/", "allow")])
    assert {r["verdict"] for r in url_filters.judge(frame, both).where("rule = 'org/'").collect()} == {"block"}


def test_chat(spark):
    said = [
        (1, 0, "user", "hi"), (1, 1, "bot", "yo"),
        (2, 0, "user", "hi"), (2, 1, "bot", "yo"), (2, 2, "user", "bye"), (2, 2, "user", "bye"),
        (3, 0, "user", "hi"), (3, 1, "bot", "yo"), (3, 2, "user", "bye"),
        (4, 0, "user", None), (5, 0, None, "hi"), (6, None, "user", "hi"), (None, 0, "user", "hi"),
        (7, 0, "user", "hi"), (7, 1, "bot", "YO"), (8, 0, "user", LONG),
    ]
    frame = spark.createDataFrame(said, "conv_id bigint, turn bigint, role string, text string").withColumns({"h1": F.lit(0), "pos": F.lit("x")})
    got = {r["conv_id"]: r for r in chat.render(frame).collect()}
    # 1 is a prefix of 2 and 6 (one turn, whatever its number) of 1; 3 equals 2.
    assert sorted(got) == [2, 4, 5, 7, 8]
    assert (got[2]["n_turns"], got[2]["n_copies"]) == (3, 2)
    assert got[7]["text"] == "<|im_start|>user\nhi<|im_end|>\n<|im_start|>bot\nYO<|im_end|>\n"
    assert got[4]["text"] == "<|im_start|>user\n<|im_end|>\n"
    assert chat.render(frame.where("false")).count() == 0


@pytest.mark.parametrize(("ranges", "chunk_turns"), [(7, 3), (40, 1), (2, 256)])
def test_long_conversations_lie_in_parts(spark, ranges, chunk_turns):
    """One conversation with half of all turns, a copy, prefixes of it, ties of ``turn``."""
    said = [(1, i // 2, "user" if i % 2 else "bot", f"turn {i}") for i in range(200)]
    said += [(2, *t[1:]) for t in said[:200]] + [(3, *t[1:]) for t in said[:90]] + [(4, *t[1:]) for t in said[1:90]]
    said += [(5, 0, "bot", "turn 0"), (6, None, "bot", "alone")] + [(1, 7, "bot", "turn 14")] * 50
    frame = spark.createDataFrame(said, "conv_id bigint, turn bigint, role string, text string").repartition(6)
    plain = {}
    for conv, turn, role, text in sorted(set(said), key=lambda t: (t[0], -1 if t[1] is None else t[1], t[2])):
        plain.setdefault(conv, []).append(f"<|im_start|>{role}\n{text}<|im_end|>\n")
    got = {}
    for r in sorted(chat.render(frame, ranges=ranges, chunk_turns=chunk_turns).collect(), key=lambda r: (r["conv_id"], r["chunk"])):
        assert r["text"].count("<|im_start|>") <= chunk_turns
        got.setdefault(r["conv_id"], []).append((r["n_turns"], r["n_copies"], r["chunk"], r["text"]))
    assert sorted(got) == [1, 4, 6]
    for conv, chunks in got.items():
        assert "".join(c[3] for c in chunks) == "".join(plain[conv])
        assert [c[2] for c in chunks] == list(range(-(-len(plain[conv]) // chunk_turns)))
        assert {c[:2] for c in chunks} == {(len(plain[conv]), 2 if conv == 1 else 1)}


def test_query_renders_whole_conversations(spark, tmp_path):
    from ledgerline.llm.queries import QUERIES as LLM_QUERIES

    said = [(1, i, "user", f"turn {i}") for i in range(700)] + [(2, i, "user", f"turn {i}") for i in range(300)]
    spark.createDataFrame(said, "conv_id bigint, turn int, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    rendered = LLM_QUERIES["op2_chat_formatting"](spark, str(tmp_path))
    assert rendered.columns == ["conv_id", "n_turns", "n_copies", "text"]
    text = "".join(f"<|im_start|>user\nturn {i}<|im_end|>\n" for i in range(700))
    assert [tuple(r) for r in rendered.collect()] == [(1, 700, 1, text)]


ITEM = "quick brown fox jumps over the lazy dog and runs away"


def test_samples_are_the_least_hashes(spark, monkeypatch):
    monkeypatch.setattr(language, "SAMPLE_TEXTS", 9)
    monkeypatch.setattr(language, "LONG_CHARS", 30)
    data = [(i, f"word{i % 150} " * (1 + i % 7), "en" if i % 3 else "de") for i in range(600)]
    data += [(1000 + i, "the same text", "en") for i in range(300)] + [(2000, "one", "fr"), (2004, None, "fr"), (None, "no", "it")]
    want = {}
    for lang in ("en", "de", "fr"):
        texts = {t for i, t, k in data if k == lang and t is not None and i is not None and zlib.crc32(str(i).encode()) % 5}
        keys = sorted((len(t) > 30, np.uint64(xxhash.xxh64_intdigest(t.encode(), 42)).astype(np.int64), t) for t in texts)
        want |= {(lang, n): t for n, (*_, t) in enumerate(keys[:9], 1)}
    drawn = language.drawn_texts(spark.createDataFrame(data, "doc_id bigint, text string, lang string").repartition(5))
    assert {(r["lang"], r["n"]): r["text"] for r in drawn.collect()} == want
    assert language.drawn_texts(spark.createDataFrame([], "doc_id bigint, text string, lang string")).count() == 0


def test_helper_columns_do_not_clash(spark, docs):
    for result in (language.identify(docs, language.train(docs)), bpe.round_trip(docs, BPE_RANKS, public_tokenizers.PATTERN)):
        assert set(docs.columns) <= set(result.columns)
        assert {(r["_found"], r["_both"], r["_scan"]) for r in result.collect()} == {("mine",) * 3}


def test_decontamination(spark, docs, empty):
    items = [(10, ITEM), (9, ITEM.upper()), (9, ITEM), (11, "stays mainly"), (12, None), (13, "--"), (None, "123")]
    items = spark.createDataFrame(items, "item_id bigint, text string").withColumn("n_words", F.lit(1))
    found = decontamination.scan(docs, items)
    got = {(r["doc_id"], r["text"]): r for r in found.collect()}
    fox = got[(1, DOCS[0][1])]
    assert (fox["n_words"], fox["n_hit"], fox["items"]) == (13, 11, ["10", "9"])
    assert [(s["start"], s["stop"]) for s in fox["spans"]] == [(1, 12)]
    assert (got[(4, LONG)]["n_hit"], got[(4, LONG)]["items"]) == (8000, ["11"])
    assert (got[(5, "!!! ??? 123")]["n_hit"], got[(5, "!!! ??? 123")]["items"]) == (1, [])
    assert (got[(2, None)]["n_words"], got[(3, "")]["n_hit"]) == (0, 0)
    assert found.count() == len(DOCS)
    clean = decontamination.without_contaminated(docs, items)
    assert clean.columns == docs.columns and rows(clean, "doc_id") == [(2,), (3,)]
    cut = {r["doc_id"]: r["text"] for r in decontamination.without_spans(docs, items).collect()}
    assert cut[1] == "The  fast." and cut[2] is None and "mainly" not in cut[4]
    assert decontamination.scan(empty, items).count() == 0
    assert rows(decontamination.scan(docs, items.where("false")), "n_hit") == [(0,)] * len(DOCS)


def test_nearest(spark):
    data = [
        (0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.5, 0.5]), (4, [0.0, 0.0]), (5, None), (6, []),
        (7, [float("nan"), 1.0]), (8, [float("inf"), 1.0]), (9, [None, 1.0]), (None, [1.0, 0.0]), (10, [1.0]), (3, [0.5, 0.5]),
        (20, [-1.0, 0.0]), (40, [0.0]), (60, [3.0]),
    ]
    frame = spark.createDataFrame(data, "id bigint, vector array<float>").withColumn("rank", F.lit("mine"))
    def near(df, k):
        return rows(ann.nearest(df, F.col("id") % 20 == 0, Stage(spark), k=k), "query_id", "rank", "id", "score")

    assert near(frame, 2) == [
        (0, 1, 1, 1.0), (0, 2, 2, 1.0), (20, 1, 3, -0.5), (20, 2, 0, -1.0), (60, 1, 10, 3.0)]
    assert [r[2] for r in near(frame, 50) if r[0] == 0] == [1, 2, 3, 20]
    assert near(frame.where("false"), 2) == []
    same = spark.range(3000).select("id", F.array(F.lit(1.0), F.lit(2.0)).cast("array<float>").alias("vector"))
    assert [r[2] for r in near(same, 3) if r[0] == 0] == [1, 2, 3]
    assert [r[2] for r in near(same, 3) if r[0] == 2980] == [0, 1, 2]


def test_warc(spark):
    html = "<html><head><title>A &amp; B</title><script>x<y</script></head><body><p>one</p>two<a href='u'>é &lt;3</a><!-- no --></body>"
    pages = [(1, "http://a/", html), (1, "http://a/", html), (2, None, None), (3, "u", ""), (None, "u", "a < b " * 30_000)]
    frame = spark.createDataFrame(pages, "page_id bigint, url string, html string")
    derived = warc.derive(warc.responses(frame).withColumn("block", F.lit("mine")))
    got = derived.collect()
    assert len(got) == 10
    text = [r for r in got if r["page_id"] == 1 and r["warc_type"] == "conversion"][0]
    assert text["block"] == "A & B\none\ntwoé <3"
    meta = [r for r in got if r["page_id"] == 1 and r["warc_type"] == "metadata"][0]
    assert meta["refers_to"] == text["refers_to"] != meta["record_id"] != text["record_id"]
    assert meta["block"].startswith("title: A & B\r\nlinks: 1\r\n") and meta["source_header"] in meta["block"]
    assert meta["source_digest"] == text["source_digest"] == "sha256:" + hashlib.sha256(html.encode()).hexdigest()
    assert [r["content_length"] for r in got if r["page_id"] == 3 and r["warc_type"] == "conversion"] == [0]
    assert len([r for r in got if r["page_id"] is None][1]["block"]) > 100_000
    for r in warc.serialized(derived).collect():
        head, _, rest = bytes(r["record"]).partition(b"\r\n\r\n")
        fields = dict(x.split(": ", 1) for x in head.decode().replace("\r\n ", "\n").split("\r\n")[1:])
        block = rest[: int(fields["Content-Length"])]
        assert rest[len(block):] == b"\r\n\r\n" and block.decode() == r["block"]
        assert fields["WARC-Refers-To"] == f"<{r['refers_to']}>"
        assert fields["WARC-Refers-To-Payload-Digest"] == r["source_digest"]
        assert fields["WARC-Refers-To-HTTP-Header"].replace("\n", "\r\n") + "\r\n" == r["source_header"]
        assert fields["WARC-Block-Digest"] == "sha256:" + hashlib.sha256(block).hexdigest()
    assert warc.derive(warc.responses(frame.where("false"))).count() == 0


def test_warc_of_broken_markup(spark):
    """Whatever is never closed takes time in proportion to its length."""
    size = 3_000_000
    starts = ["<a", "<script", "<script>", "<!--", "<title>", "<style x", "</script", "<p ", "<script>x</script ", "<!- ", "<a href"]
    pages = [(i, "u", s * (size // len(s))) for i, s in enumerate(starts)]
    pages += [(98, "u", "<a " + "x" * size), (99, "u", "seen<script>a<b<!-- x --></scripty>hidden")]
    frame = spark.createDataFrame(pages, "page_id bigint, url string, html string").repartition(4)
    begun = time.time()
    got = {(r.page_id, r.warc_type): r.block for r in warc.derive(warc.responses(frame)).collect()}
    assert time.time() - begun < 60
    assert got[99, "conversion"] == "seen hidden" and got[3, "conversion"] == got[2, "conversion"] == ""
    assert got[0, "conversion"] == "<a" * (size // 2) and "links: 0" in got[0, "metadata"]


def test_bpe(docs, empty):
    coded = bpe.encode(docs, BPE_RANKS, public_tokenizers.PATTERN)
    assert coded.columns == docs.columns
    back = bpe.decode(coded, BPE_RANKS, public_tokenizers.PATTERN).collect()
    assert len(back) == len(DOCS)
    for r in back:
        assert bytes(r["decoded"]).decode() == (r["text"] or "")
        assert (r["ids"] == []) == (not r["text"])
    assert bpe.encode(empty, BPE_RANKS, public_tokenizers.PATTERN).count() == 0


def test_language(spark, docs, empty):
    many = [(i, t, "en" if i % 2 else "de") for i in range(60) for t in ["the and of that is" if i % 2 else "der die und nicht das"]]
    model = language.train(spark.createDataFrame(many, "doc_id bigint, text string, lang string"))
    assert model.languages == ["de", "en"]
    got = rows(language.identify(docs, model), "doc_id", "lang_pred", "score")
    assert len(got) == len(DOCS)
    found = {r[0]: r for r in got}
    assert found[4][1] == "en" and found[1][1] == "en" and 0 < found[1][2] <= 1
    assert found[2][1:] == found[3][1:] == found[5][1:] == ("und", 0.0)
    kept = language.with_language(docs, model)
    assert kept.columns == docs.columns and not {2, 3, 5} & {r["doc_id"] for r in kept.collect()}
    nothing = language.train(docs.where("false"))
    assert {r[1:] for r in rows(language.identify(docs, nothing), "doc_id", "lang_pred", "score")} == {("und", 0.0)}
    assert language.with_language(docs, nothing).count() == len(DOCS)  # nothing learned, nothing rejected
    assert language.identify(empty, model).count() == 0
    unlabelled = spark.createDataFrame([(1, "abc", None), (None, "abc", "en")], "doc_id bigint, text string, lang string")
    assert language.train(unlabelled).languages == []


def test_a_one_word_label_does_not_win_other_texts(spark):
    prose = "the rain in spain stays mainly in the plain and so on, but that is another story for later days "
    rows_ = [(i, prose * 5, "en") for i in range(10)] + [(i, "hello", "xx") for i in range(10, 20)]
    model = language.train(spark.createDataFrame(rows_, "doc_id bigint, text string, lang string"))
    assert model.languages == ["en", "xx"]
    names, score, _ = model.predict(["another rainy day in spain for the plain people", "hello", "zq 7 wk"])
    assert names[:2] == ["en", "xx"] and 0 < score[0] <= 1
    for word in ("ok", "yes", "hello"):
        tiny = language.Model({"en": prose * 20, "xx": word})
        assert tiny.predict(["so is that story, but the days are later in another plain"])[0] == ["en"]


def test_with_language_judges_a_text_by_its_own_letters(spark):
    """A script of many letters has short phrases; a small sample has few bits a phrase."""
    rng = np.random.default_rng(7)
    signs = [chr(0x4E00 + i) for i in range(600)]
    words = ["".join(rng.choice(signs, 2)) for _ in range(800)]
    prose = lambda n: "".join(rng.choice(words, n))
    noise = lambda letters, n: "".join(rng.choice(letters, n))
    latin = list("abcdefghijklmnopqrstuvwxyz   ")
    model = language.Model({"zh": prose(1500), "en": LONG[:110]})
    texts = {1: prose(150), 2: prose(40), 3: noise(signs, 300), 4: noise(latin, 300), 5: "the plain in spain and so on", 6: "Здравствуй, мир и все люди"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    assert rows(language.with_language(docs, model), "doc_id") == [(1,), (2,), (5,)]
    assert model.predict([texts[1]])[2][0] > 6  # bits per letter
    small = language.Model({"en": LONG[:110]})
    assert rows(language.with_language(docs, small), "doc_id") == [(5,)]


def test_quality(spark, docs, empty):
    labels = spark.createDataFrame([(1, 1, 0), (4, 1, 0), (4, None, 0), (3, 0, 0), (None, 1, 0), (99, 1, 1)], "doc_id bigint, quality int, toxic int")
    trees = quality.train(docs, labels)
    scored = quality.score(docs, trees).collect()
    assert len(scored) == len(DOCS) and all(0 <= r["score"] <= 1 for r in scored)
    assert quality.accepted(docs, trees).columns == docs.columns
    untrained = quality.train(docs, labels.where("false"))
    assert {r["score"] for r in quality.score(docs, untrained).collect()} == {0.5}
    assert quality.score(empty, trees).count() == 0 and quality.train(empty, labels).base == 0
    assert np.isfinite([quality.statistics_of(t) for t in (b"", b" ", b"\n\n", b"a", LONG.encode())]).all()


def test_simhash(spark, docs, empty):
    got = rows(simhash.near_duplicates(docs, Stage(spark)), "doc_id", "component_id")
    assert got == sorted([(1, 1), (None, 1), (2, 2), (3, 2), (4, 4), (5, 5), (5, 5)], key=repr)
    kept = simhash.without_near_duplicates(docs, Stage(spark))
    assert kept.columns == docs.columns
    assert rows(kept, "doc_id") == [(1,), (2,), (4,), (5,)]
    assert simhash.near_duplicates(empty, Stage(spark)).count() == 0
    assert simhash.without_near_duplicates(empty, Stage(spark)).count() == 0
    nameless = docs.where("doc_id IS NULL OR doc_id = 5").withColumn("doc_id", F.lit(None).cast("bigint"))
    assert rows(simhash.near_duplicates(nameless, Stage(spark)), "doc_id", "component_id") == [(None, None)] * 3
    assert simhash.without_near_duplicates(nameless, Stage(spark)).count() == 2


def test_token_files(docs, empty):
    manifest, found = token_files.export(docs, WORD_TOKENIZER)
    got = found.orderBy("start").collect()
    assert [r["doc_id"] for r in got] == [None, 1, 2, 3, 4, 5, 5]
    assert [r["n_tokens"] for r in got if r["doc_id"] in (2, 3)] == [1, 1]
    total = 0
    for r in got:
        assert r["start"] == total
        total += r["n_tokens"]
    assert got[5]["ids_crc32"] == got[6]["ids_crc32"]
    assert token_files.export(empty, WORD_TOKENIZER)[1].count() == 0
