import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as C
import messy

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stage_names_and_order():
    assert [n for n, _ in C.STAGES] == ["language_id", "exact_dedup", "near_dedup", "mix_sources", "bpe_tokens"]


@pytest.mark.parametrize("data", [None, [], [(1, None, None, None, None)]])
def test_stages_follow_each_other(spark, scratch, data):
    docs, before = messy.documents(spark, data), None
    for name, stage in C.STAGES:
        out = stage(spark, docs, scratch)
        out.write.parquet(f"{scratch}/{name}")
        out = spark.read.parquet(f"{scratch}/{name}")
        if name != "bpe_tokens":
            assert out.columns == docs.columns
        if data is None and name == "language_id":
            assert {r.doc_id for r in out.collect()} & {301, 302, 303, 304, 309} == set()
        if data is None and name == "exact_dedup":
            assert [r.doc_id for r in out.collect() if r.doc_id in range(200, 211)] == [210]
        if data is None and name == "near_dedup":
            assert [r.doc_id for r in out.collect() if r.doc_id in range(200, 213)] == [210]
        if data is None and name == "mix_sources":
            assert {r.doc_id for r in out.collect()} <= {r.doc_id for r in before.collect()}
        before, docs = out, out
    assert before.count() == (before.count() if data is None else 0)


def test_run_equals_brute_tokens(spark, scratch):
    messy.documents(spark).select(COLUMNS).write.parquet(f"{scratch}/documents.parquet")
    got = C.run(spark, scratch).collect()
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts = {}
    for r in messy.rows():
        texts.setdefault(r[0], r[1])
    assert got and all(r.ids == tok.encode(texts[r.doc_id], add_special_tokens=False).ids for r in got)
    assert all(r.n_tokens == len(r.ids) for r in got)
