"""The join against all pairs, its signatures against the claim behind them, and its components."""

import random
from fractions import Fraction

import numpy as np
import pytest

from tracklab.llm import partenum
from tracklab.llm.partenum import NEAR, Join

WORDS = [f"w{i}" for i in range(3000)]


def plain_sets(rows, n):
    out = []
    for _, text in rows:
        words = (text or "").encode().lower().split()
        runs = [tuple(words[i:i + n]) for i in range(len(words) - n + 1)] if len(words) >= n else ([tuple(words)] if words else [])
        out.append(frozenset(runs))
    return out


def plain_join(rows, join):
    sets = plain_sets(rows, join.words)
    group = list(range(len(rows)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and join.of * len(a & b) >= join.similar * len(a | b):
                group[root(i)] = root(j)
    first = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            first[root(i)] = min(first.get(root(i), doc_id), doc_id)
    return sorted(((d, len(s), first.get(root(i), d)) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str)


def edited(rng, words, share):
    return [rng.choice(WORDS) if rng.random() < share else w for w in words]


def corpus(rng, families, size, shares, passage=()):
    rows, n = [], 0
    for _ in range(families):
        base = [rng.choice(WORDS) for _ in range(rng.randint(3, 200))]
        for _ in range(size):
            words = list(passage) + edited(rng, base, rng.choice(shares))
            rows.append((n, rng.choice([" ", "\n", "\t "]).join(words)))
            n += 1
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("join", [Join(), NEAR, Join(parts=3, slack_share=0.2), Join(similar=50, parts=1, left_out=0)])
def test_equals_all_pairs(spark, frame, join):
    rng = random.Random(join.parts)
    rows = corpus(rng, 25, 6, (0, 0.005, 0.01, 0.02, 0.05, 0.2), passage=[f"common{i}" for i in range(20)])
    rows += [(1000, None), (1001, ""), (1002, " \n"), (1003, "one"), (1004, "ONE"), (1005, "one two"), (1006, "a b c"), (1007, "A b\tC")]
    rows += [rows[0], (None, rows[1][1]), (None, "only here x y z"), (None, None)]
    got = partenum.join_components(frame(rows, "doc_id long, text string"), join=join).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain_join(rows, join)


def test_large_clusters_in_blocks(spark, frame, monkeypatch):
    monkeypatch.setattr(partenum, "BLOCK", 16)
    monkeypatch.setattr(partenum, "SAMPLE_SETS", 20)
    rng = random.Random(9)
    rows = corpus(rng, 2, 120, (0.002, 0.01, 0.03))
    got = partenum.join_components(frame(rows, "doc_id long, text string")).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain_join(rows, Join())


def test_large_clusters_are_not_copied_to_all_blocks(spark, frame, monkeypatch):
    """Sets of a large cluster that are not similar are not sent to every block; the links stay those of all pairs."""
    monkeypatch.setattr(partenum, "BLOCK", 16)
    rng = random.Random(5)
    rows = corpus(rng, 60, 4, (0, 0.002, 0.02)) + [(1000 + i, " ".join(WORDS[:90]) + f" x{i % 40}") for i in range(60)]
    docs = frame(rows, "doc_id long, text string")
    nodes = partenum._nodes(docs, "doc_id", "text", Join())
    clusters = nodes.select("fp").distinct().selectExpr("fp AS node", "0L AS label")
    sent, plain = [], partenum._compare

    def counted(cells, join):
        sent.append(cells.count())
        return plain(cells, join)

    monkeypatch.setattr(partenum, "_compare", counted)
    links = partenum._links(docs, "doc_id", "text", nodes, clusters, Join())
    fps = {r.doc_id: r.fp for r in nodes.collect()}
    group = {r.node: r.label for r in partenum.components(links).collect()}
    wanted, first = plain_join(rows, Join()), {}
    for doc_id, _, least in wanted:
        first.setdefault(group.get(fps[doc_id], fps[doc_id]), set()).add(least)
    assert all(len(x) == 1 for x in first.values()) and len(first) == len({least for *_, least in wanted})
    assert sum(sent) < 5 * len(rows)


def test_parities_say_at_most_the_difference():
    rng = np.random.default_rng(1)
    for join in (Join(), NEAR, Join(similar=30)):
        sets = [np.unique(rng.integers(0, 1 << 63, int(n), dtype=np.uint64)) for n in rng.integers(1, 3000, 12)]
        sets += [np.unique(np.r_[s[int(len(s) * cut):], rng.integers(0, 1 << 63, int(len(s) * cut), dtype=np.uint64)]) for s in sets for cut in (0, 0.05, 0.1, 0.4)]
        by = {}
        for k, s in enumerate(sets):
            for width, own, bits in partenum.parities(s, join):
                by.setdefault(width, []).append((k, len(s), own, bits))
        joined = set()
        for held in by.values():
            k, n, own, bits = (np.array(x) for x in zip(*held))
            side = n, own, bits
            names = np.r_[k, k]
            pairs = [(int(names[a]), int(names[b])) for a, b in partenum.connected(side, side, join)]
            assert len(pairs) < 2 * len(held)
            joined |= set(pairs)
        root = {}
        for a, b in joined:
            ga, gb = root.setdefault(a, {a}), root.setdefault(b, {b})
            ga |= gb
            for x in gb:
                root[x] = ga
        for a, x in enumerate(sets):
            for b, y in enumerate(sets[:a]):
                inter = len(np.intersect1d(x, y))
                if join.of * inter >= join.similar * (len(x) + len(y) - inter):
                    assert b in root[a]


@pytest.mark.parametrize("common", [0, 200, 100_000])
def test_similar_sets_share_a_signature(common):
    rng = np.random.default_rng(3)
    frequent = np.sort(rng.integers(0, 1 << 63, common, dtype=np.uint64))
    for join in (Join(), NEAR, Join(parts=4, left_out=2, slack=1, slack_share=0.1)):
        for _ in range(150):
            n = int(rng.integers(1, 300))
            a = np.unique(np.r_[rng.integers(0, 1 << 63, n, dtype=np.uint64), rng.choice(frequent, min(n, common)) if common else frequent])
            g = Fraction(join.similar, join.of)
            drop = int(rng.integers(0, 1 + int(len(a) * (1 - g))))
            b = np.setdiff1d(a, rng.choice(a, drop, replace=False)) if drop else a
            add = int(len(b) / g - len(a)) if len(b) / g > len(a) else 0
            b = np.unique(np.r_[b, rng.integers(0, 1 << 63, add, dtype=np.uint64)])
            inter, union = len(np.intersect1d(a, b)), len(np.union1d(a, b))
            if join.of * inter >= join.similar * union:
                assert len(np.intersect1d(partenum.signatures(a, join, frequent), partenum.signatures(b, join, frequent)))


def test_bands_are_narrow_enough():
    for join in (Join(), NEAR):
        for small in range(1, 3000):
            large = small * join.of // join.similar
            low, _, above = partenum.band_edges(small, join)
            high, own, _ = partenum.band_edges(large, join)
            assert high in (low, low + 1) and (high == low or own == above)


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 130)] + [(200, 200), (-5, 300), (300, -7)]
    got = {r.node: r.label for r in partenum.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {got[i] for i in range(61)} == {0} and {got[i] for i in range(100, 130)} == {100}
    assert got[-5] == got[300] == got[-7] == -7 and 200 not in got


def test_keep_one(frame):
    words = " ".join(WORDS[:80])
    rows = [(5, words, "a"), (3, words, "b"), (9, words + " more", "c"), (7, "other text altogether here now", "d"), (None, words, "e"),
            (11, None, "f"), (12, "", "g"), (7, "other text altogether here now", "d"), (7, "Other text altogether here now", "h")]
    df = frame(rows, "doc_id long, text string, component_id string")
    out = partenum.keep_one(df)
    assert out.columns == df.columns
    assert sorted((r.doc_id or -1) for r in out.collect()) == [-1, 3, 7, 11, 12]
    assert partenum.keep_one(frame([], "doc_id long, text string", 1)).count() == 0


def test_empty(frame):
    assert partenum.join_components(frame([], "doc_id long, text string", 1)).count() == 0
    assert [tuple(r) for r in partenum.join_components(frame([(1, None)], "doc_id long, text string", 1)).collect()] == [(1, 0, 1)]
