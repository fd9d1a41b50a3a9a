"""Extraction on held-out pages, the field's arithmetic, and odd markup."""

import itertools
import math
import random
import time

import pytest

from tracklab.llm import html_crf as crf
from tracklab.llm.common import table


@pytest.fixture(scope="module")
def field(spark, sf):
    return crf.train(table(spark, sf, "pages"))


def test_real_pages(spark, sf, field):
    rows = crf.extract(table(spark, sf, "pages"), field).collect()
    right = sum(r.text == "\n".join(b.text for b in crf.blocks(r.html) if crf.marked_label(b)) for r in rows)
    assert right >= 0.98 * len(rows) and all(r.n_chars == len(r.text) for r in rows)


def test_held_out_built_pages(field):
    pages = [crf.blocks(p) for p in crf.built_pages(["A sentence of the article, with words.", "Another one stands here!", "And a third."], 200, seed=77)]
    blocks = [(y, b.label or 0) for p in pages for b, y in zip(p, crf.labels(field, p))]
    assert sum(a == b for a, b in blocks) >= 0.97 * len(blocks)


def test_another_layout(field):
    page = ("<body><div class='topnav'><a href=/>Home</a></div><div class='post'><h1>My title here</h1><p>First paragraph, with &lt;text&gt; &amp; more.</p>"
            "<p>Second\n  one.</p><!-- <p>no</p> --><script>var x = '<p>no</p>';</script></div><div class='sidebar'><p>Read our other stories.</p></div>"
            "<div id='comments'><p>I disagree with this, really.</p></div><form><p>Sign up now.</p></form><div class='cookie-banner'><p>We use cookies.</p></div></body>")
    assert crf.main_text(field, page) == "My title here\nFirst paragraph, with <text> & more.\nSecond one."


def test_fit_reaches_the_brute_force_optimum():
    rng = random.Random(2)
    pages = [([["bias", f"x={rng.randrange(3)}"] for _ in range(n)], [rng.randrange(2) for _ in range(n)]) for n in (1, 2, 3, 4, 5, 3, 2)]

    def likelihood(f):
        total = 0.0
        for x, y in pages:
            s = [sum(f.weights.get(k, 0.0) for k in b) for b in x]
            value = lambda z: sum(a for a, b in zip(s, z) if b) + sum(f.moves[a][b] for a, b in zip(z, z[1:]))
            total += value(y) - math.log(sum(math.exp(value(z)) for z in itertools.product((0, 1), repeat=len(y))))
        return total - crf.RIDGE / 2 * (sum(w * w for w in f.weights.values()) + sum(m * m for r in f.moves for m in r))

    best = crf.fit(pages, 4000)
    top = likelihood(best)
    for name in best.weights:
        for step in (-0.05, 0.05):
            assert likelihood(best._replace(weights=best.weights | {name: best.weights[name] + step})) < top
    for a, b, step in itertools.product((0, 1), (0, 1), (-0.05, 0.05)):
        moves = [list(r) for r in best.moves]
        moves[a][b] += step
        assert likelihood(best._replace(moves=moves)) < top


def test_viterbi_is_the_best_of_all():
    rng = random.Random(1)
    for _ in range(200):
        s = [rng.gauss(0, 1) for _ in range(rng.randint(1, 8))]
        m = [[rng.gauss(0, 1) for _ in range(2)] for _ in range(2)]
        value = lambda z: sum(a for a, b in zip(s, z) if b) + sum(m[a][b] for a, b in zip(z, z[1:]))
        assert math.isclose(value(crf.viterbi(s, m)), max(map(value, itertools.product((0, 1), repeat=len(s)))))
    assert crf.viterbi([], [[0, 0], [0, 0]]) == []


@pytest.mark.parametrize("page,texts", [
    ("", []), ("  ", []), ("a<br>b", ["a b"]), ("<p>a<p>b", ["a", "b"]), ("<p>a <b>b<p>c</b> d", ["a b", "c d"]), ("<ul><li>a<li>b</ul>c", ["a", "b", "c"]),
    ("x<p>y &am", ["x", "y &am"]), ("<p>y</p><di", ["y"]), ("<p>y</p><!-- cut", ["y"]), ("<p>y</p></arti", ["y"]), ("<script>z", []), ("<table><tr><td>1<td>2<tr><td>3</table>", ["1", "2", "3"]),
    ("</p></div>t</x>", ["t"]), ("1 < 2 &copy; &#65;&#x42;", ["1 < 2 © AB"]), ("<p>a\x00b</p>", ["a\x00b"]), ("<![foo[x]]>y<p>z", ["y", "z"]), ("<a <a <a ", []), ("<div>" * 300 + "deep", ["deep"]), ("<textarea>q</textarea><select><option>w</select>r", ["r"]),
])
def test_blocks_of_odd_markup(page, texts):
    assert [b.text for b in crf.blocks(page)] == texts


@pytest.mark.parametrize("page,texts", [
    ('<script>document.write("<!--")</script><p>a</p>', ["a"]), ("<style><!-- p {} </style><p>a</p>", ["a"]), ("<p>x</p><textarea><!-- </textarea><p>a</p>", ["x", "a"]),
    ("<div title='<!--'><p>a</p></div>b", ["a", "b"]), ("<head><title>Of <!-- marks</title></head><p>a</p>", ["a"]), ("<title>b &amp; c <!--</title><p>a</p>", ["b & c <!--", "a"]),
    ("<p>a</p><!-- <p>b</p>", ["a"]), ("<!-- x --><p>a</p><!-- cut <p>b</p>", ["a"]), ("<!--><p>a</p>", ["a"]), ("<!-- x --!><p>a</p>", ["a"]),
    ("<textarea>q<p>a</p>", []), ("<title>q<p>a</p>", ["q", "a"]), ("<script><!--</script><p>a</p><![CDATA[ x ><p>b</p><!-- <p>c</p>", None),
])
def test_comments_that_never_end(page, texts):
    got = [b.text for b in crf.blocks(page)]
    assert got == texts if texts is not None else "a" in got and "c" not in got


def test_elements_of_any_depth():
    assert [b.text for b in crf.blocks("<p>a</p><svg>" + "<path d=x>" * 300 + "</svg><p>b</p>")] == ["a", "b"]
    assert [(b.text, b.link_chars) for b in crf.blocks("<nav>" + "<a href=x>m" * 150 + "</nav><p>article</p>")] == [("m" * 150, 150), ("article", 0)]
    deep = crf.blocks("<nav class='menu'><article data-label='1'>" + "<div>" * 500 + "t")
    assert {"in=nav", "in=article", "name=menu", "sect=article", "own=menu"} <= set(crf.block_features(deep[0], 0, 1)) and deep[0].label == 1


def test_deep_pages_take_linear_time():
    spent = []
    for n in (4_000, 40_000):
        start = time.process_time()
        page = crf.blocks("".join(f"<x{i} class=c{chr(97 + i % 26)}>t" for i in range(n)) + "</p></y>" * n)
        crf.labels(crf.Field({"in=x0": 1.0}, [[0.0, 0.0], [0.0, 0.0]]), page)
        spent.append(time.process_time() - start)
    assert len(page) == 40_000 and spent[1] < 40 * spent[0]


def test_nulls_repeats_long_and_clashes(frame, field):
    long = "<article><h1>T</h1>" + "<p>Some words of a paragraph, over and over.</p>" * 20_000 + "</article>"
    df = frame([(1, None, 5), (1, None, 5), (2, "", 6), (3, long, 7), (None, "<article><p>Hello to you, reader.</p></article>", 8)], "page_id long, html string, n_chars long")
    rows = sorted(crf.extract(df, field).collect(), key=str)
    assert [r.n_chars for r in rows if r.page_id in (1, 2)] == [0, 0, 0]
    assert next(r.text for r in rows if r.page_id is None) == "Hello to you, reader."
    assert next(r.text for r in rows if r.page_id == 3).count("\n") >= 20_000 - 1
    empty = frame([], "page_id long, html string", 1)
    assert crf.extract(empty, crf.train(empty)).count() == 0
