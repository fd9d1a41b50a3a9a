"""Counts equal the library's, for tables, odd characters and specials."""

import random

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tracklab.llm import tokens
from tracklab.llm.common import table

PATH = public_tokenizers.path("byte_bpe_50k.json")
TABLES = tokens.load(PATH)
LIBRARY = Tokenizer.from_file(PATH)
COUNT = tokens.counter(TABLES)


def library(text):
    return len(LIBRARY.encode(text or "", add_special_tokens=False).ids)


def test_table(spark, sf):
    rows = tokens.count_tokens(table(spark, sf, "documents"), TABLES).collect()
    assert rows and all(r.n_tokens == library(r.text) and r.n_bytes == len(r.text.encode()) and r.over_limit == (r.n_tokens > 1024) for r in rows)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(codec="utf-8"), st.sampled_from(" \n\t'sdlre<|endoftext>  ‍")), max_size=40))
def test_any_text(text):
    assert COUNT(text) == library(text)


@pytest.mark.parametrize("text", ["", "<|endoftext|>", "a<|endoftext|><|endoftext|> b", "x" * 50_000, "ab" * 40 + " 'll 'LL", " " * 3000 + "\n" * 99])
def test_corner(text):
    assert COUNT(text) == library(text)


def test_long_texts_in_chunks(monkeypatch):
    rng = random.Random(1)
    text = "".join(rng.choice("ab c'\n.é1 ") for _ in range(20_000))
    monkeypatch.setattr(tokens, "CHUNK", 500)
    assert tokens.counter(TABLES)(text) == library(text)


def test_proven_strings_are_one_token():
    rng = random.Random(3)
    some = rng.sample(sorted(TABLES.whole), 2000)
    assert all(tokens.merged_length(s.encode(), TABLES.byte_ids, TABLES.merges) == 1 for s in some)
    assert len(TABLES.whole) > 49_000


def test_short_and_long_merges_agree(monkeypatch):
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdeéß ") for _ in range(rng.randint(1, 30))).encode() for _ in range(500)]
    want = [tokens.merged_length(w, TABLES.byte_ids, TABLES.merges) for w in words]
    monkeypatch.setattr(tokens, "SCAN_BYTES", 1)
    assert [tokens.merged_length(w, TABLES.byte_ids, TABLES.merges) for w in words] == want


def test_nulls_repeats_clashes(frame):
    df = frame([(1, None, "x"), (1, None, "x"), (None, "", "y"), (2, "hi", "z")], "doc_id long, text string, n_tokens string")
    rows = tokens.count_tokens(df, TABLES).collect()
    assert sorted((r.n_bytes, r.n_tokens, r.over_limit) for r in rows) == [(0, 0, False)] * 3 + [(2, 1, False)]
    assert tokens.count_tokens(frame([], "doc_id long, text string", 1), TABLES).count() == 0
