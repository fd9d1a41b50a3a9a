"""Tokens and bytes equal the library's: tables, odd characters, windows, spans."""

import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from tracklab.llm import bpe_codec
from tracklab.llm.common import table
from tracklab.llm.queries import QUERIES

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
TABLES = bpe_codec.load(PATH)
with open(PATH, "rb") as f:
    RANKS = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def ids(packed):
    return np.frombuffer(packed, "<u4").tolist()


def encoded(texts):
    return [ids(p) for p in bpe_codec.Encoder(TABLES).encode(texts)]


@settings(max_examples=500, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.characters(codec="utf-8"), st.sampled_from(" \n\t'sdlretvm<|é١ \x1c　")), max_size=40), max_size=5))
def test_any_texts_in_a_row(texts):
    assert encoded(texts) == [LIBRARY.encode_ordinary(t) for t in texts]


def test_every_code_point_between_letters():
    text = "".join(f"a{chr(c)}" for c in range(0x20000) if not 0xD800 <= c <= 0xDFFF)
    assert encoded([text]) == [LIBRARY.encode_ordinary(text)]


CORNERS = ["", " ", "  ", "a", " a", "  a", "\na", " \na", "\n a", "a ", "a  ", "'s", "''s", " 's", "\n's", "x's's'll'LL", "'", "'r", "'re",
           "'rea", "'ree", "1'd2", "!'m", "a'", "\x1c", "a\x1cb", "x" * 50_000, "ab" * 40, " " * 3000 + "\n" * 99 + "z", "<|endoftext|>"]


def test_corners():
    assert encoded(CORNERS) == [LIBRARY.encode_ordinary(t) for t in CORNERS]


@pytest.mark.parametrize("window", [1, 2, 3, 64, 500])
def test_long_texts_in_windows(monkeypatch, window):
    rng = random.Random(1)
    texts = ["".join(rng.choice("ab c'stlre\n.é1 ") for _ in range(n)) for n in (3_000, 499, 500, 501, 1, 64, 65)]
    monkeypatch.setattr(bpe_codec, "WINDOW", window)
    assert encoded(texts) == [LIBRARY.encode_ordinary(t) for t in texts]


def test_scan_equals_stepping():
    rng, scan = np.random.default_rng(2), TABLES.scan
    for n in (1, 63, 64, 65, 4097, 70_000):
        functions = scan.of_symbol[rng.integers(0, 16, n)]
        state, want = 0, []
        for g in functions.tolist():
            want.append(state)
            state = int(scan.apply[g, state])
        assert scan.apply[bpe_codec.prefixes(functions, scan), 0].tolist() == want


def test_composition_is_associative():
    scan = TABLES.scan
    m = scan.compose.reshape(scan.count, scan.count).astype(int)
    rng = np.random.default_rng(3)
    a, b, c = rng.integers(0, scan.count, (3, 5000))
    assert (m[m[a, b], c] == m[a, m[b, c]]).all()


def test_short_and_long_merges_agree(monkeypatch):
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdeéß日") for _ in range(rng.randint(1, 13))).encode() for _ in range(500)]
    want = [bpe_codec.merge_pairs(w, RANKS) for w in words]
    monkeypatch.setattr(bpe_codec, "SCAN_BYTES", 0)
    assert [bpe_codec.merge_pairs(w, RANKS) for w in words] == want


def test_spans_by_offsets():
    text = "Ein Märchen, it's 12345 – ok?\n" * 30
    packed = bpe_codec.Encoder(TABLES).encode([text])[0]
    at = bpe_codec.offsets(packed, TABLES)
    data = text.encode()
    assert bpe_codec.decode_tokens(packed, at, TABLES) == data
    for a, b in [(0, 0), (0, 1), (3, 9), (5, len(data)), (100, 101), (len(data) - 1, len(data)), (7, 7)]:
        assert bpe_codec.decode_span(packed, at, a, b, TABLES) == data[a:b]


def test_table(spark, sf):
    texts = {r.doc_id: r.text or "" for r in table(spark, sf, "documents").collect()}
    rows = QUERIES["op11_bpe_codec"](spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = np.array(LIBRARY.encode_ordinary(texts[r.doc_id]), "<u4")
        assert (r.n_tokens, r.ids_sha256) == (len(want), hashlib.sha256(want.tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_nulls_repeats_clashes_empty(frame):
    schema = "doc_id long, text string, ids string, coded string, n_tokens string"
    df = frame([(1, None, "x", "q", "z"), (1, None, "x", "q", "z"), (None, "", "y", "q", None), (2, "hi there", "z", "q", "")], schema)
    out = bpe_codec.decode(bpe_codec.encode(df, TABLES), TABLES)
    rows = out.collect()
    assert sorted((r.n_tokens, bytes(r.decoded), r.coded) for r in rows) == [(0, b"", "q")] * 3 + [(2, b"hi there", "q")]
    assert out.columns == ["doc_id", "text", "coded", "ids", "offsets", "n_tokens", "decoded"]
    assert bpe_codec.encode(frame([], schema, 1), TABLES).count() == 0


def test_decoded_in_the_same_pass(frame, monkeypatch):
    monkeypatch.setattr(bpe_codec, "RESULT_CHARS", 5)
    texts = [None, "", "über", "a" * 20, "x", "y", "it's"] * 3
    df = frame([(i, t, "old") for i, t in enumerate(texts)], "doc_id long, text string, Decoded string")
    rows = bpe_codec.encode(df, TABLES, decoded="decoded").collect()
    assert {r.doc_id: bytes(r.decoded) for r in rows} == {i: (t or "").encode() for i, t in enumerate(texts)}


def test_incomplete_ranks_are_refused(tmp_path):
    path = tmp_path / "few.tiktoken"
    path.write_bytes(base64.b64encode(b"a") + b" 0\n")
    with pytest.raises(ValueError):
        bpe_codec.load(str(path))
