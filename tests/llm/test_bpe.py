import random

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ratewise.llm import bpe
import messy

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def reference():
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


@pytest.fixture(scope="module")
def own():
    return bpe.WordBpe(bpe.load_spec(PATH))


def same(own, reference, text):
    ids = reference.encode(text, add_special_tokens=False).ids
    assert own.encode(text) == ids
    assert own.decode(ids) == reference.decode(ids, skip_special_tokens=False)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.characters(max_codepoint=0x24F), max_size=60))
def test_any_latin_text(text):
    tok = test_any_latin_text.tokenizer = getattr(test_any_latin_text, "tokenizer", None) or Tokenizer.from_file(PATH)
    enc = test_any_latin_text.own = getattr(test_any_latin_text, "own", None) or bpe.WordBpe(bpe.load_spec(PATH))
    same(enc, tok, text)


@pytest.mark.parametrize("text", [
    "", " ", "\x1c\x1d", "it's they'll I'M", "<|endoftext|>", "a<|startoftext|>b<|endoftext|>", "<|endoftext", "ΑΣ ΑΣΑ", "İI",
    "é é", "a b　c d", "中文字 かな", "😀😃 !!?", "x" * 63, "x" * 64, "x" * 65, "x" * 3000, "ab" * 2000,
    "12 345 ½ ²"])
def test_cases(own, reference, text):
    same(own, reference, text)


def test_long_random_words(own, reference):
    rng = random.Random(3)
    for n in (60, 64, 66, 400, 5000):
        same(own, reference, "".join(rng.choice("aeinothrs") for _ in range(n)))


def test_documents(spark, reference):
    docs = messy.documents(spark)
    got = docs.select("doc_id", "text", bpe.encoded(spark, "text", PATH).alias("e")).collect()
    assert len(got) == len(messy.rows())
    for r in got:
        ids = reference.encode(r.text or "", add_special_tokens=False).ids
        assert r.e.ids == ids and r.e.decoded == reference.decode(ids, skip_special_tokens=False)
    assert messy.documents(spark, []).select(bpe.encoded(spark, "text", PATH)).count() == 0
