"""Passages found equal those of a full edit distance table."""

import random

from tracklab.llm import decontam


def least_edits(pattern, text):
    row = [0] * (len(text) + 1)
    for i, c in enumerate(pattern, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
        row = new
    return min(row)


def test_matcher_equals_full_table():
    rng = random.Random(3)
    letters = "abc de"
    for _ in range(300):
        items = [(k, "".join(rng.choice(letters) for _ in range(rng.randint(0, 40)))) for k in range(4)]
        planted = "".join(c if rng.random() > 0.08 else rng.choice(letters) for c in items[0][1])
        noise = "".join(rng.choice(letters) for _ in range(rng.randint(0, 30)))
        text = f"{noise} {planted} {noise}"
        got = {(i, e) for i, e, _, _ in decontam.Matcher(items, 0.15).find(text)}
        want = set()
        for k, item in items:
            body = decontam.normal(item)
            if body and (d := least_edits(body, decontam.normal(text))) <= int(0.15 * len(body)):
                want.add((k, d))
        assert got == want, (items, text)


def test_best_match_equals_full_table():
    rng = random.Random(8)
    for _ in range(300):
        p = "".join(rng.choice("abc") for _ in range(rng.randint(1, 80)))
        t = "".join(rng.choice("abc") for _ in range(rng.randint(0, 120)))
        assert decontam.best_match(decontam.masks(p), len(p), t)[0] == least_edits(p, t)


def test_spans_point_into_the_text(frame):
    passage = "The quick brown fox jumps over the lazy dog, twice a day."
    item = [(7, passage), (8, None), (9, ""), (7, passage)]
    docs = [(1, "İntro!! " + passage.upper().replace(" ", " \n") + " end"), (2, "nothing of it"), (3, None), (3, None), (4, ""),
            (5, "see: " + passage.replace("lazy", "lxzy"))]
    out = decontam.matches(frame(docs, "doc_id long, text string"), frame(item, "item_id long, text string")).collect()
    texts = dict(docs)
    assert sorted((r.doc_id, r.item_id, r.n_errors) for r in out) == [(1, 7, 0)] * 2 + [(5, 7, 1)] * 2
    for r in out:
        found = texts[r.doc_id][r.start:r.stop].lower()
        assert found.startswith("the") and found.endswith("day")


def test_blocks_and_filter(frame, monkeypatch):
    rng = random.Random(4)
    items = [(k, " ".join(f"w{rng.randrange(10 ** 6)}" for _ in range(12))) for k in range(6)]
    docs = [(k, f"before {items[k][1]} after" if k < 6 else "clean words only", k) for k in range(9)] + [(9, None, 1), (None, items[0][1], 2)]
    d, i = frame(docs, "doc_id long, text string, item_id long"), frame(items, "item_id long, text string")
    monkeypatch.setattr(decontam, "BLOCK_CHARS", 100)
    assert sorted((r.doc_id or -1, r.item_id) for r in decontam.matches(d, i).collect()) == sorted([(k or -1, k) for k in range(6)] + [(-1, 0)])
    kept = decontam.decontaminated(d, i)
    assert kept.columns == d.columns and sorted(r.doc_id for r in kept.collect()) == [6, 7, 8, 9]


def test_empty_tables(frame):
    docs, items = frame([], "doc_id long, text string", 1), frame([], "item_id long, text string", 1)
    some = frame([(1, "x")], "doc_id long, text string", 1)
    assert decontam.matches(docs, items).count() == 0 == decontam.matches(some, items).count()
    assert decontam.decontaminated(some, items).count() == 1
