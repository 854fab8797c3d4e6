import itertools

import public_tokenizers
import pytest
from conftest import TEXTS, rows
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from panelforge.llm import tokencount

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
COUNTER = tokencount.Counter(PATH)


def tokens(text):
    return len(LIBRARY.encode(text or "", add_special_tokens=False).ids)


def test_table(docs, no_docs):
    want = [(k, len((t or "").encode()), tokens(t), tokens(t) > 2048) for k, t in TEXTS]
    assert rows(tokencount.count_tokens(docs, PATH)) == sorted(want, key=lambda r: tuple((v is None, str(type(v)), v) for v in r))
    assert tokencount.count_tokens(no_docs, PATH).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(codec="utf-8"), max_size=40))
def test_any_text(text):
    assert COUNTER.count([text])[0] == tokens(text)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["<|endoftext|>", "<|startoftext|>", "'", "'s", "'ll", " ", "\n", "A", "é", "İ", "ſ", "12", "!", "ber", "ing", "ﬁ", "Å", "é"]), max_size=12).map("".join))
def test_pieces(text):
    assert COUNTER.count([text])[0] == tokens(text)


def test_every_plain_character():
    chars = [chr(c) for c in itertools.chain(range(0x250), range(0x2010, 0x2028), [0x20AC])]
    texts = [f"a{c}a 1{c} {c}{c}'s\n{c} '{c} {c}'ll Thing{c}THING" for c in chars]
    assert list(COUNTER.count(texts)) == [tokens(t) for t in texts]


@pytest.mark.parametrize("size", [1, 2, 50, 5000])
def test_long_words(size):
    for unit in ("a", "ab", "the", "xyzzy"):
        assert COUNTER.count([unit * size])[0] == tokens(unit * size)


def test_query(spark, sf):
    from panelforge.llm.queries import op7_token_counts

    texts = dict(tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    got = op7_token_counts(spark, sf).collect()
    assert len(got) == len(texts)
    for r in got:
        assert r["n_tokens"] == tokens(texts[r["doc_id"]]) and r["n_bytes"] == len(texts[r["doc_id"]].encode())
