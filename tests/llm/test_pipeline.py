"""The pipeline's stages: their decisions take effect, and each equals a plain version."""

import pandas as pd
import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from ledgerline.llm import bpe
from ledgerline.llm.queries import BPE_RANKS, QUERIES
from test_operators_exact import plain_components, plain_fingerprint

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    docs, out = spark.read.parquet(f"{FOLDER}/documents.parquet"), [pd.read_parquet(f"{FOLDER}/documents.parquet")]
    for name, step in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        step(spark, docs, FOLDER).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs.toPandas())
    return out


def test_stages(steps):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "language", "near_dedup", "decontamination", "tokens"]
    for before, after in zip(steps, steps[1:-1]):
        assert list(after.columns) == list(before.columns)
        merged = after.merge(before, how="left", indicator=True)
        assert (merged._merge == "both").all() and 0 < len(after) <= len(before)


def test_quality_stage_follows_the_classifier(spark, steps):
    scores = QUERIES["op8_quality_classifier"](spark, FOLDER).toPandas()
    assert set(steps[1].doc_id) == set(scores[scores.predicted == 1].doc_id)


def test_language_stage_keeps_documents_with_words(steps):
    gone = steps[1][~steps[1].doc_id.isin(steps[2].doc_id)]
    assert len(gone) <= 0.02 * len(steps[1])


def test_dedup_stage_keeps_the_first_of_each_group(steps):
    before = steps[2].sort_values("doc_id")
    prints = [plain_fingerprint(t) for t in before.text]
    assert set(steps[3].doc_id) == set(plain_components(prints, before.doc_id.tolist()))
    assert steps[3].doc_id.is_unique


def test_decontamination_stage(spark, steps):
    found = QUERIES["op3_decontamination"](spark, FOLDER).toPandas()
    assert set(steps[4].doc_id) == set(steps[3].doc_id) - set(found[found.contaminated].doc_id)


def test_token_stage_equals_the_library(steps):
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(BPE_RANKS), special_tokens={})
    texts = steps[4].set_index("doc_id").text
    assert len(steps[5]) == len(texts)
    for r in steps[5].itertuples():
        assert list(r.ids) == plain.encode_ordinary(texts[r.doc_id]) and r.n_tokens == len(r.ids)


def test_run_equals_the_stages(spark, steps):
    got = corpus_pipeline.run(spark, FOLDER).toPandas()
    assert sorted(got.doc_id) == sorted(steps[5].doc_id)
