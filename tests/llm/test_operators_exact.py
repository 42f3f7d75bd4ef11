"""Each operator against a plain version of what it computes, on whole small tables."""

import hashlib
import re
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import public_tokenizers
import pytest
import regex
import tiktoken
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry
import check
from ledgerline.llm import ann, bpe, components, decontamination, language, quality, simhash, token_files, url_filters
from ledgerline.llm.oracle import ORACLE
from ledgerline.llm.queries import BPE_RANKS, QUERIES, WORD_TOKENIZER
from ledgerline.sinks.files import Stage


@pytest.fixture(scope="module")
def texts(sf_dir):
    return pd.read_parquet(f"{sf_dir}/documents.parquet").set_index("doc_id").text


@pytest.fixture(scope="module")
def result(spark, sf_dir):
    kept = {}

    def get(name):
        if name not in kept:
            kept[name] = QUERIES[name](spark, sf_dir).toPandas()
        return kept[name]

    return get


def test_every_query_is_registered():
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_twin(spark, sf_dir, name):
    assert check.compare(spark, check.connect(sf_dir), sf_dir, name) == []


def test_native_queries_run_no_python(spark, sf_dir):
    plan = QUERIES["op1_url_filters"](spark, sf_dir)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "Join"))


def test_bpe_equals_the_tiktoken_library(result, texts):
    ranks = bpe.read_ranks(BPE_RANKS)
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = result("op6_byte_bpe").set_index("doc_id")
    assert len(got) == len(texts)
    for doc_id, text in texts.items():
        ids = plain.encode_ordinary(text)
        row = got.loc[doc_id]
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


ODD_TEXTS = [
    "", " ", "\n", "a  b\n c \n d", "a \x1c b \u3000 c", " x  ", "it's  's 12 3", "ab" * 3000, "漢" * 900, "😀" * 300,
    " ".join("x" * i for i in range(200)), "é" * 2047 + "a", "\u00a0a \u00a0 b", "'ll we'll\t'LL",
]


@pytest.mark.parametrize("widest", [8, 2048])
def test_bpe_of_odd_texts(monkeypatch, widest):
    monkeypatch.setattr(bpe, "WIDEST", widest)
    ranks = bpe.read_ranks(BPE_RANKS)
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    codec = bpe.Codec(ranks, public_tokenizers.PATTERN)
    ids, lengths = codec.encode(ODD_TEXTS)
    assert [x.tolist() for x in np.split(ids, np.cumsum(lengths)[:-1])] == [plain.encode_ordinary(t) for t in ODD_TEXTS]
    assert codec.decode(ids, lengths) == [t.encode() for t in ODD_TEXTS]


def test_bpe_memory_does_not_change_results(monkeypatch, texts):
    codec = bpe.Codec(bpe.read_ranks(BPE_RANKS), public_tokenizers.PATTERN)
    some = texts.tolist()[:60]
    whole = codec.encode(some)[0].tolist()
    monkeypatch.setattr(bpe, "YOUNG", 5)
    small = bpe.Codec(codec.ranks, public_tokenizers.PATTERN)
    assert [i for t in some for i in small.encode([t])[0].tolist()] == whole


def test_bpe_classes_agree_with_tiktoken():
    """The pattern means the same in both libraries, for a sample of all code points."""
    ranks = bpe.read_ranks(BPE_RANKS)
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    codec = bpe.Codec(ranks, public_tokenizers.PATTERN)
    points = [*range(0x300), *range(0x2000, 0x2070), *range(0x300, 0x11000, 97), 0x3000, 0xFEFF]
    made = [f"s{c}t 1{c}1 !{c}! {c}{c}b" for c in map(chr, points) if not "\ud800" <= c <= "\udfff"]
    ids, lengths = codec.encode(made)
    assert [x.tolist() for x in np.split(ids, np.cumsum(lengths)[:-1])] == [plain.encode_ordinary(t) for t in made]


def test_token_files_equal_the_tokenizers_library(result, texts):
    tokenizer = Tokenizer.from_file(WORD_TOKENIZER)
    got = result("op10_token_files").sort_values("doc_id").reset_index(drop=True)
    start = 0
    for (doc_id, text), row in zip(sorted(texts.items()), got.itertuples()):
        ids = np.array(tokenizer.encode(text, add_special_tokens=False).ids + [1], "<u4")
        assert (row.doc_id, row.start, row.n_tokens, row.ids_crc32) == (doc_id, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert len(got) == len(texts)


def test_words_tokenise_alone_as_in_whole_texts():
    own = token_files.Encoder(WORD_TOKENIZER)
    made = [*ODD_TEXTS, "ΣΑΣ Σ e\u0301 \u0301x It's<|endoftext|>x <|startoftext|> ½ ² \u2003wide\x85x"]
    for text in made:
        assert own.encode([text.encode()])[0].tolist() == own.tokenizer.encode(text, add_special_tokens=False).ids


def test_words_of_pieces_tokenise_as_whole_texts():
    own, chance = token_files.Encoder(WORD_TOKENIZER), np.random.default_rng(3)
    assert own.by_words
    letters = [*map(chr, range(33, 127)), *map(chr, range(0xC0, 0x100)), "'s", "'t", "'LL", "ΐ", "́", "½", "İ"]
    made = [" ".join("".join(chance.choice(letters, chance.integers(1, 9))) for _ in range(400)) for _ in range(30)]
    for text, ids in zip(made, own.encode([t.encode() for t in made])):
        assert ids.tolist() == own.tokenizer.encode(text, add_special_tokens=False).ids


def test_other_tokenizers_read_whole_texts():
    own = token_files.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    assert not own.by_words
    for text in ODD_TEXTS:
        assert own.encode([text.encode()])[0].tolist() == own.tokenizer.encode(text, add_special_tokens=False).ids


def test_repeats_of_one_document_fill_several_files(spark, tmp_path):
    docs = spark.range(4000).select(F.lit(7).cast("bigint").alias("doc_id"), F.lit("the same text again").alias("text")).repartition(8)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        manifest, found = token_files.export(docs, WORD_TOKENIZER, folder=str(tmp_path), length=64)
        assert manifest.count() > 1 and found.count() == 4000
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_s3_names_of_hadoop_are_understood():
    for scheme in ("s3", "s3a", "s3n"):
        assert token_files._opened(f"{scheme}://bucket/folder?region=us-east-1")[1] == "bucket/folder"


def test_sequences_are_views_of_the_file(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").limit(40)
    manifest, found = token_files.export(docs, WORD_TOKENIZER, folder=str(tmp_path), length=64)
    files = token_files.offsets_of(manifest).orderBy("part").collect()
    assert sum(f["n_docs"] for f in files) == 40
    total = 0
    for f in files:
        stream = np.concatenate([ids for _, ids in token_files.documents_in(f["path"])])
        assert len(stream) == f["n_tokens"] and f["first"] == total
        total += len(stream)
        for i in (0, f["n_sequences"] // 2, f["n_sequences"] - 1):
            ids, mask = token_files.sequence(f["path"], i)
            assert len(ids) == len(mask) == 64 and ids.base is not None
            assert ids[mask].tolist() == stream[64 * i : 64 * (i + 1)].tolist()


def plain_fingerprint(text):
    words = regex.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text))
    runs = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, ids):
    parent = list(range(len(prints)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(prints):
        for j in range(i):
            if bin(a ^ prints[j]).count("1") <= 4:
                parent[top(i)] = top(j)
    least = {}
    for i in range(len(prints)):
        least[top(i)] = min(least.get(top(i), ids[i]), ids[i])
    return [least[top(i)] for i in range(len(prints))]


def test_simhash_equals_all_pairs(result, texts):
    got = result("op9_simhash_dedup").set_index("doc_id")
    prints = [plain_fingerprint(t) for t in texts]
    assert [f"{p:016x}" for p in prints] == got.fingerprint.loc[texts.index].tolist()
    assert plain_components(prints, texts.index.tolist()) == got.component_id.loc[texts.index].tolist()


def test_spark_hash_is_the_shingle_hash(spark):
    texts = ["", "a", "häß 漢字 x", "w" * 100]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(F.xxhash64("t")).collect()
    assert [r[0] % 2**64 for r in rows] == [xxhash.xxh64_intdigest(t.encode(), 42) for t in texts]


@pytest.mark.parametrize("leaf", [0, 16, 10**9])
@pytest.mark.parametrize("spread", [3, 12, 64])
def test_trie_join_equals_all_pairs(monkeypatch, leaf, spread):
    monkeypatch.setattr(simhash, "LEAF_CELLS", leaf)
    monkeypatch.setattr(simhash, "FRONTIER", 50)
    rng = np.random.default_rng(spread)
    centres = rng.integers(0, 2**63, 4, dtype=np.uint64)
    flips = [sum(1 << int(b) for b in rng.choice(64, rng.integers(0, spread), replace=False)) for _ in range(150)]
    values = np.unique([int(c) ^ f for c, f in zip(np.resize(centres, 150), flips)]).astype(np.uint64)
    parent = simhash.Forest(len(values))
    for pair in range(len(simhash.PAIRS)):
        a, b = simhash.links_in(values, np.full(len(values), pair), np.zeros(len(values)))
        parent.link(np.searchsorted(values, a), np.searchsorted(values, b))
    assert parent.root.tolist() == plain_components([int(v) for v in values], list(range(len(values))))


@pytest.mark.parametrize("bucket_rows", [3, 40, 10**6])
def test_large_buckets_are_joined_in_parts(spark, bucket_rows):
    """A cluster of near copies larger than a bucket may be: no link is lost."""
    rng = np.random.default_rng(9)
    flips = {sum(1 << int(b) for b in rng.choice(64, 2, replace=False)) for _ in range(120)}
    values = [f ^ 0x0123456789ABCDEF for f in flips] + [int(v) for v in rng.integers(0, 2**62, 50)]
    frame = spark.createDataFrame([(v - 2**64 if v >= 2**63 else v,) for v in values], "fp bigint")
    stage = Stage(spark)
    links = simhash.fingerprint_links(frame, stage, bucket_rows)
    roots = {r["node"]: r["root"] for r in components.components(links, stage).collect()}
    got = [roots.get(r["fp"], r["fp"]) for r in frame.collect()]
    want = plain_components(values, list(range(len(values))))
    assert len(set(zip(got, want))) == len(set(got)) == len(set(want)) < 60


def test_components_of_chains_stars_and_loops(spark):
    chain = [(i, i + 1) for i in range(100, 140)]
    star = [(7, i) for i in range(200, 260)]
    rows = chain + star + [(1, 1), (3, 2), (2, 3), (2, 3)]
    found = components.components(spark.createDataFrame(rows, "a bigint, b bigint"), Stage(spark)).collect()
    roots = {r["node"]: r["root"] for r in found}
    assert len(found) == len(roots)
    assert {roots[i] for i in range(100, 141)} == {100}
    assert {roots[i] for i in [7, *range(200, 260)]} == {7}
    assert roots[2] == roots[3] == 2 and 1 not in roots


def test_nearest_neighbours_recall(spark, sf_dir, result):
    rows = pd.read_parquet(f"{sf_dir}/embeddings.parquet")
    vectors = np.stack(rows.embedding).astype(float)
    got = result("op4_nearest_neighbours")
    hits = 0
    queries = [i for i, v in enumerate(rows.vec_id) if v % 20 == 0]
    for i in queries:
        scores = vectors @ vectors[i]
        scores[i] = -np.inf
        want = rows.vec_id.to_numpy()[np.lexsort((rows.vec_id, -scores))[:20]]
        own = got[got.query_id == rows.vec_id[i]].sort_values("rank")
        assert own["rank"].tolist() == list(range(1, 21))
        hits += len(set(want) & set(own.vec_id))
        at = rows.set_index("vec_id").index.get_indexer(own.vec_id)
        assert np.allclose(own.score, vectors[at] @ vectors[i], rtol=1e-12, atol=1e-12)
        assert own.score.is_monotonic_decreasing
    assert hits >= 0.9 * 20 * len(queries)


def test_recall_over_several_shards(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(12, 24))
    vectors = (centres[rng.integers(0, 12, 1500)] + 0.5 * rng.normal(size=(1500, 24))).astype(np.float32)
    rows = spark.createDataFrame(list(enumerate(vectors.tolist())), "id bigint, vector array<float>")
    found = ann.nearest(rows, F.col("id") % 20 == 0, Stage(spark), k=10, shard_bytes=100_000, query_bytes=3000).toPandas()
    hits = 0
    for q in range(0, 1500, 20):
        scores = vectors.astype(float) @ vectors[q].astype(float)
        scores[q] = -np.inf
        hits += len(set(np.argsort(-scores)[:10]) & set(found[found.query_id == q].id))
    assert hits >= 0.9 * 10 * 75


def test_languages_are_told_apart(spark, sf_dir):
    folder = sf_dir.replace("sf0.001", "sf0.01")
    docs = pd.read_parquet(f"{folder}/documents.parquet")
    got = QUERIES["op7_language_id"](spark, folder).toPandas().merge(docs[["doc_id", "lang"]], on="doc_id")
    assert len(got) == len(docs)
    assert got.score.between(0, 1).all()
    held = [zlib.crc32(str(i).encode()) % 5 == 0 for i in got.doc_id]
    assert got.held_out.tolist() == held
    assert (got[got.held_out].lang_pred == got[got.held_out].lang).mean() > 0.97


def plain_phrases(text, sample):
    """Longest match by longest match; a letter without a match is a phrase."""
    n = at = 0
    while at < len(text):
        size = 1
        while at + size <= len(text) and text[at : at + size] in sample:
            size += 1
        at += max(1, size - 1)
        n += 1
    return n


@pytest.mark.parametrize("segment", [1, 3, 7, 64, 1024])
@pytest.mark.parametrize("dense", [64 << 20, 0])
def test_phrases_are_longest_matches(monkeypatch, texts, segment, dense):
    monkeypatch.setattr(language, "DENSE_BYTES", dense)
    samples = {"a": "der die das und nicht " * 3, "b": "the and of that", "c": " ".join(texts.tolist()[:2])[:3000], "d": "漢字仮名交じり文"}
    model = language.Model(samples)
    assert all((a.table is None) == (dense == 0) for a in model.automata)
    some = ["das und der", "that is nicht", "thedasund", "漢字と仮名 the ΩΩ", "", "x" * 50, *[t[:700] for t in texts.tolist()[2:10]]]
    cut = [language.normalized(t) for t in some]
    got = model.phrases([model.numbered(t) for t in cut], segment=segment)
    assert got.tolist() == [[plain_phrases(t, language.normalized(samples[k])) for k in model.languages] for t in cut]
    # Predictions follow from these counts.
    lacking = [[sum(c not in language.normalized(samples[k]) for c in t) for k in model.languages] for t in cut]
    bits = got * model.phrase_bits + np.array(lacking) * model.letter_bits
    for text, name, own in zip(some, model.predict(some)[0], bits):
        assert name == (model.languages[int(own.argmin())] if regex.search(r"\p{L}", text) else "und")


def test_alphabet_of_thousands_of_letters_stays_small():
    letters = [chr(0x4E00 + i) for i in range(4000)]
    chance = np.random.default_rng(4)
    model = language.Model({"zh": "".join(chance.choice(letters, 20_000)), "en": "the quick brown fox " * 1000})
    size = sum(x.nbytes for a in model.automata for x in (a.own, a.table, a.keys, a.targets) if x is not None)
    assert size < 20_000_000
    assert model.predict(["".join(letters[:30]), "the brown fox"])[0] == ["zh", "en"]


def test_sample_takes_different_texts_whole(spark, monkeypatch):
    monkeypatch.setattr(language, "SAMPLE_TEXTS", 3)
    monkeypatch.setattr(language, "SAMPLE_CHARS", 100)
    monkeypatch.setattr(language, "LONG_CHARS", 60)
    seen = {}
    monkeypatch.setattr(language, "Model", lambda samples: seen.update(samples))
    able = [i for i in range(1000) if zlib.crc32(str(i).encode()) % 5]
    data = [(able[i], "copied", "xx") for i in range(50)] + [(able[50 + i], f"text number {i} of xx", "xx") for i in range(9)]
    data += [(able[70], "one long text only " * 30, "long"), (able[71], "short one", "mixed"), (able[72], "long " * 20, "mixed"), (able[73], "1 2", "digits")]
    data += [(able[74], None, "none"), (None, "no id", "xx"), (able[75], "no label", None)]
    language.train(spark.createDataFrame(data, "doc_id bigint, text string, lang string").repartition(4))
    assert set(seen) == {"xx", "long", "mixed"} and seen["long"] == "one long text only " * 30
    assert seen["mixed"] == "short one"  # both do not fit
    drawn = re.findall(r"copied|text number \d of xx", seen["xx"])
    assert len(drawn) == len(set(drawn)) == 3 and " ".join(drawn) == seen["xx"]


def test_quality_on_held_out_labels(spark, sf_dir):
    folder = sf_dir.replace("sf0.001", "sf0.01")
    labels = pd.read_parquet(f"{folder}/labels.parquet")
    got = QUERIES["op8_quality_classifier"](spark, folder).toPandas()
    assert len(got) == len(pd.read_parquet(f"{folder}/documents.parquet", columns=["doc_id"]))
    assert got.score.between(0, 1).all() and (got.predicted == (got.score >= 0.3)).all()
    both = got[got.held_out].merge(labels, on="doc_id")
    assert (both.predicted == both.quality).mean() > 0.95


def test_trees_learn_a_rule_and_walk_alike():
    rng = np.random.default_rng(1)
    x = rng.random((2000, len(quality.STATISTICS)))
    y = ((x[:, 3] > 0.5) ^ (x[:, 5] > 0.3)).astype(float)
    trees = quality.grow(x, y)
    assert ((trees.score(x) > 0.5) == y).mean() > 0.97
    for row in x[:20]:  # node by node
        margin = trees.base
        for statistic, edge, leaf in zip(trees.statistic, trees.edge, trees.leaf):
            node = 0
            while node < 2**quality.DEPTH - 1:
                node = 2 * node + (2 if row[statistic[node]] > edge[node] else 1)
            margin += leaf[node - (2**quality.DEPTH - 1)]
        assert np.isclose(margin, trees.margin(row[None])[0])


def test_cascade_is_exact_on_its_universe(spark):
    universe = spark.range(20_000).select(F.concat(F.lit("k"), "id").alias("key"))
    listed = universe.where("pmod(xxhash64(key), 40) = 0")
    cascade = url_filters.build_cascade(listed, universe, 20_000, Stage(spark), "t")
    assert len(cascade.levels) > 1
    wrong = universe.where(cascade.lists(F.col("key")) != (F.expr("pmod(xxhash64(key), 40) = 0")))
    assert wrong.count() == 0


def test_blocks_of_items_give_the_same_spans(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    one = decontamination.scan(docs, items).drop("text").toPandas().set_index("doc_id").sort_index()
    many = decontamination.scan(docs, items, block_bytes=4000).drop("text").toPandas().set_index("doc_id").sort_index()
    assert (one.n_hit > 0).any()
    assert one.n_hit.equals(many.n_hit)
    assert [list(i) for i in one["items"]] == [list(i) for i in many["items"]]
    assert [[tuple(x) for x in s] for s in one.spans] == [[tuple(x) for x in s] for s in many.spans]


def test_blocks_are_bounded_and_repeated_items_count_once(spark):
    items = spark.createDataFrame([(i % 3, f"one two three four five six seven eight nine ten w{i % 3}") for i in range(3000)], "item_id int, text string")
    assert [len(b) for b in decontamination.item_blocks(items, 10_000)] == [3]
    assert sum(len(b) for b in decontamination.item_blocks(items, 60)) == 3
    docs = spark.createDataFrame([(1, "x One two three four five six seven eight nine ten w1 w2", "a")] * 2 + [(2, None, "b"), (3, "", "c")], "doc_id int, text string, _scan string")
    found = decontamination.scan(docs.withColumns({"_k1": F.lit(1), "_K2": F.lit(2)}), items, block_bytes=60)
    assert found.columns == ["doc_id", "text", "_scan", "_k1", "_K2", "n_words", "spans", "items", "n_hit"]
    got = sorted((r["doc_id"], r["_scan"], r["n_words"], r["n_hit"], tuple(r["items"])) for r in found.collect())
    assert got == [(1, "a", 13, 11, ("0", "1", "2"))] * 2 + [(2, "b", 0, 0, ()), (3, "c", 0, 0, ())]


def test_buckets_join_alike_however_few_are_held(spark, monkeypatch):
    rng = np.random.default_rng(4)
    values = np.unique(rng.integers(0, 2**63, 30)[rng.integers(0, 30, 3000)] ^ (1 << rng.integers(0, 64, 3000).astype(np.uint64)).astype(np.int64))
    keys = rng.integers(0, 4, len(values))
    order = np.argsort(keys, kind="stable")
    batches = [
        pa.RecordBatch.from_arrays([pa.array(values[o]), pa.array(np.full(len(o), 1)), pa.array(keys[o]), pa.array(np.full(len(o), -1))], ["fp", "pair", "key", "part"])
        for o in np.array_split(order, 9)
    ]
    one = pa.Table.from_batches(simhash._joined(iter(batches))).to_pandas()
    monkeypatch.setattr(simhash, "TOGETHER", 16)
    few = pa.Table.from_batches(simhash._joined(iter(batches))).to_pandas()
    by_key = {}
    for key in range(4):
        a, b = simhash.links_in(values[keys == key].view(np.uint64), np.full((keys == key).sum(), 1), np.full((keys == key).sum(), -1))
        by_key[key] = {frozenset((int(x), int(y))) for x, y in zip(a.view(np.int64), b.view(np.int64))}
    assert len(one) and len(few)
    assert {frozenset((int(x), int(y))) for x, y in few.values} == set().union(*by_key.values())


def test_slices_cover_the_column():
    from ledgerline.llm.batches import slices

    column = pa.array(["a" * n for n in (3, 0, 50, 7, 7, 7)] + [None, ""])
    for size in (1, 8, 1000):
        assert [t for part in slices(column, size) for t in part.to_pylist()] == column.to_pylist()
