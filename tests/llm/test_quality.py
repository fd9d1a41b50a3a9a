"""Measures and verdicts against a plain count."""

import random
import re

from tracklab.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    at = {}
    for i in range(len(words) - 2):
        at.setdefault(tuple(words[i:i + 3]), []).append(i)
    covered = {i + k for places in at.values() if len(places) > 1 for i in places for k in range(3)}
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return (len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered))


def texts():
    rng = random.Random(5)
    out = [None, "", " \n\t", "one", "a b", "a b c", "a b c a b c", "x " * 300, "the of " + "word " * 10, "\x0bv\x0cf\rr",
           "a b c d", "0 1 0 1 0 1", "# * $ %\n# * $ %\n\n", "a b c\x01 a b c", "long " * 5000 + "end",
           "a " * 20000 + "b"]
    for _ in range(60):
        out.append("".join(rng.choice(["a", "b", "c", " ", " ", "\n", "é", "🙂", "#"]) for _ in range(rng.randint(0, 120))))
    return out


def test_measures_equal_a_plain_count(frame):
    rows = [(i, t) for i, t in enumerate(texts())]
    got = quality.judge(frame(rows, "doc_id long, text string")).collect()
    assert len(got) == len(rows)
    for r in got:
        want = plain(rows[r.doc_id][1])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want, rows[r.doc_id]
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r.kept and r.base_failed)


def test_null_empty_repeated_and_clashing(frame):
    rows = [(1, None, 7, "x"), (1, None, 7, "x"), (None, "", 8, "y")]
    out = quality.judge(frame(rows, "doc_id long, text string, n_words long, kept string"))
    assert sorted(out.columns).count("n_words") == 1 and out.columns.count("kept") == 1
    assert [(r.n_words, r.base_failed, r.kept) for r in out.collect()] == [(0, True, False)] * 3
    assert quality.judge(frame([], "doc_id long, text string", 1)).count() == 0


def test_each_rule_can_fail(frame):
    rng = random.Random(2)
    good = lambda n: " ".join(rng.choice(["the", "of", "plain", "words", "stand", "here", "again", f"w{rng.random()}"]) for _ in range(n))
    rows = {
        "good": good(200), "short words": "the of " + " ".join(chr(97 + rng.randrange(26)) for _ in range(200)),
        "symbols": " ".join(f"{w}##" for w in good(200).split()), "capitals": "the of " + good(200).upper(),
        "no stop words": " ".join(f"zz{rng.random()}" for _ in range(200)),
        "duplicate lines": good(100) + "\n" + "\n".join(f"same line {i % 2}" for i in range(10)),
        "bullets": "\n".join("- " + good(10) for _ in range(20)), "ellipsis": "\n".join(good(10) + "..." for _ in range(20)),
    }
    got = {r.name: r.kept for r in quality.judge(frame(list(rows.items()), "name string, text string")).collect()}
    assert got == {k: k == "good" for k in rows}
