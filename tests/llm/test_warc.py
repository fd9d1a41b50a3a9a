"""Round trip of archives: monolithic streams, members, index."""

import gzip
import hashlib
import base64
import random

import pytest

from tracklab.llm import warc


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


PAGES = [(1, "http://a", "<p>one</p>"), (2, "http://b", "<p>one</p>"), (3, "http://c\r\nX: y", None), (4, None, ""), (9, "http://d", "<p>one</p>"),
         (5, "u", "\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"), (6, "u", "ends\r\n"), (7, "u", "ends\r\n\r\n\r"),
         (8, "u", "é🙂" * 50_000), (None, "u", "<p>one</p>"), (None, "u", "lonely"), (10, "u", "same"), (10, "u", "same"), (11, "u", "\x00\x1f|")]


def test_round_trip(spark, frame, tmp_path):
    df = frame(PAGES, "page_id long, url string, html string", 3)
    warc.write_monolithic(warc.records(warc.linked(df, "page_id", "html")), f"{tmp_path}/whole")
    index = warc.normalise(spark, f"{tmp_path}/whole", f"{tmp_path}/split")
    rows = warc.read_members(index, f"{tmp_path}/split").collect()
    assert len(rows) == len(PAGES) == index.count()
    of = lambda urn: int(urn[10:-1]) if urn and urn != "<urn:page:>" else None
    got = sorted(((of(r.record_id), r.payload_bytes, r.payload_digest, r.record_type, of(r.refers_to_id)) for r in rows), key=str)
    want = []
    for page, _, text in PAGES:
        first = max((p for p, _, t in PAGES if (t or "") == (text or "") and p is not None), default=None)
        refers = first if page != first else None
        want.append((page, len((text or "").encode()), digest(text), "revisit" if refers is not None else "response", refers))
    assert got == sorted(want, key=str)
    texts = {p: t or "" for p, _, t in PAGES}
    for r in rows:
        if r.record_type == "response" and of(r.record_id) is not None:
            assert bytes(r.payload).decode() == texts[of(r.record_id)]
        assert "\n" not in (r.target_uri or "")


def test_files_are_one_stream_then_one_member_per_record(spark, frame, tmp_path):
    df = frame([(i, "u", f"<p>{i % 50}</p>") for i in range(200)], "page_id long, url string, html string", 2)
    warc.write_monolithic(warc.records(warc.linked(df, "page_id", "html")), f"{tmp_path}/whole")
    index = warc.normalise(spark, f"{tmp_path}/whole", f"{tmp_path}/split").collect()
    whole = {p.name.removesuffix(".txt.gz"): p for p in (tmp_path / "whole").glob("*.gz")}
    for file in {r.file for r in index}:
        data = (tmp_path / "split" / "members" / file).read_bytes()
        assert gzip.decompress(data) == gzip.decompress(whole[file.removesuffix(".warc.gz")].read_bytes())
        places = sorted((r.offset, r.length, r.record_id) for r in index if r.file == file)
        assert places[0][0] == 0 and sum(n for _, n, _ in places) == len(data)
        for offset, length, record_id in places:
            member = gzip.decompress(data[offset:offset + length])
            assert member.startswith(b"WARC/1.1\r\n") and member.endswith(b"\r\n\r\n") and record_id.encode() in member


def test_any_cut_of_a_stream(spark):
    rng = random.Random(1)
    recs = [b"WARC/1.1\r\nContent-Length: %d\r\n\r\n" % len(b) + b + b"\r\n\r\n" for b in (b"", b"\r\n\r\n", b"x" * 999, b"\r\n" * 7)]
    stream = b"".join(recs * 3)
    for _ in range(50):
        cuts = sorted(rng.sample(range(len(stream)), 20))
        pieces = [stream[a:b] for a, b in zip([0, *cuts], [*cuts, len(stream)])]
        assert list(warc.split_records(pieces)) == recs * 3
    with pytest.raises(ValueError):
        list(warc.split_records([stream[:-30]]))


def test_min_bytes_and_empty(spark, frame, tmp_path):
    df = frame([(1, "", "ab"), (2, "", "ab"), (3, "", "a"), (4, "", "a")], "page_id long, refers_to string, html string")
    got = {r.page_id: r.refers_to for r in warc.linked(df, "page_id", "html", min_bytes=2).collect()}
    assert got == {1: 2, 2: None, 3: None, 4: None}
    none = frame([], "page_id long, url string, html string", 1)
    warc.write_monolithic(warc.records(warc.linked(none, "page_id", "html")), f"{tmp_path}/whole")
    index = warc.normalise(spark, f"{tmp_path}/whole", f"{tmp_path}/split")
    assert index.count() == 0 == warc.read_members(index, f"{tmp_path}/split").count()
