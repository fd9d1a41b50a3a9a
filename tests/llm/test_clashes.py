"""Input columns with the names of helper columns come out as they went in, and change no result."""

import pytest

import corpus_pipeline
from tracklab.llm import chat, mixing, partenum, quality, warc

DOCS = [(i, f"word{i % 3} some more of the text here\n- and line {i}", "ab"[i % 2], "en", 40 + i) for i in range(12)]
TALK = [(1, 1, "user", "Where is the station, please?"), (1, 2, "assistant", "> Where is the station, please?\nStraight on."),
        (2, 1, "user", "> nothing known\nOk."), (None, 1, "user", None)]
DOC_SCHEMA = "doc_id long, text string, source string, lang string, n_chars long"
CASES = {
    "judge": (quality.judge, DOCS, DOC_SCHEMA, ["_w", "_lines", "_keys", "_tagged", "_heads", "_at", "_LINES"]),
    "mix": (lambda df: mixing.mix(mixing.sized(df)), DOCS, DOC_SCHEMA,
            ["_source", "_range", "_s", "_c", "_cut", "_before", "copies", "rest", "_extra", "Rest", "upto"]),
    "mix_sources": (lambda df: corpus_pipeline.mix_sources(df.sparkSession, df, ""), DOCS, DOC_SCHEMA, ["size", "order_key", "taken", "copies", "Size"]),
    "keep_one": (partenum.keep_one, DOCS, DOC_SCHEMA, ["_leave", "_r", "_key", "n", "fp", "label", "node"]),
    "warc": (lambda df: warc.linked(df, "doc_id", "text"), DOCS, DOC_SCHEMA, ["_key", "_k", "_first", "_id", "_n", "_FIRST"]),
    "chat": (chat.linked, TALK, "conv_id long, turn long, role string, text string", ["_m", "_c", "_t", "_r", "_pc", "_pt", "_C", "msg", "conv"]),
}


@pytest.mark.parametrize("name", CASES)
def test_helper_names_are_free(frame, name):
    run, rows, schema, helpers = CASES[name]
    plain = run(frame(rows, schema, 1))
    want = sorted(map(str, (tuple(r) for r in plain.collect())))
    distinct = [h for i, h in enumerate(helpers) if h.lower() not in {x.lower() for x in helpers[:i]}]
    for some in (distinct, [h for h in helpers if h not in distinct]):
        if not some:
            continue
        wide = [(*r, *(f"{h}!" for h in some)) for r in rows]
        out = run(frame(wide, schema + "".join(f", `{h}` string" for h in some), 1))
        assert sorted(map(str, (tuple(r) for r in out.select(*[f"`{c}`" for c in plain.columns]).collect()))) == want
        assert all({r[0] for r in out.select(f"`{h}`").collect()} == {f"{h}!"} for h in some)
        assert set(out.columns) == {*plain.columns, *some}
