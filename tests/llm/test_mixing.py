"""Targets, taken words and reruns of the mix."""

import random
from fractions import Fraction

import pytest

from tracklab.llm import mixing


def plain_targets(sizes, weights, share, most):
    order = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, open_, out = share * sum(sizes.values()), set(sizes), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] > most * sizes[s]}
        if not over:
            return out | {s: level * weight[s] for s in open_}
        for s in over:
            out[s] = Fraction(most * sizes[s])
            left -= out[s]
        open_ -= over
    return out


@pytest.mark.parametrize("seed,share,most", [(1, Fraction(3, 2), 2), (2, Fraction(1, 3), 2), (3, Fraction(2), 2), (4, Fraction(5, 2), 3)])
def test_targets_and_taken(frame, seed, share, most):
    rng = random.Random(seed)
    rows = [(i, rng.choice(["a", "b", "B", "ä", "z", None, "", "𝒳", "￿"]), " ".join("w" * 1 for _ in range(rng.choice([0, 1, 3, 20, 400])))) for i in range(300)]
    rows += [(1000, "only empty", ""), (1001, "nothing", None)] + [rows[0]] * 3
    sizes = {}
    for _, s, t in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    want = plain_targets(sizes, mixing.WEIGHTS, share, most)
    out = mixing.mix(mixing.sized(frame(rows, "doc_id long, source string, text string")), share=share, max_epochs=most).collect()
    assert len(out) == len(rows)
    taken = {}
    for r in out:
        assert r.size == len((r.text or "").split()) and 0 <= r.taken <= most * r.size
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) <= 1e-9 * max(1, want[r.source])
        taken[r.source] = taken.get(r.source, 0) + r.taken
    assert taken == {s: int(t) for s, t in want.items()}


def test_reruns_agree_whatever_the_partitions(frame):
    rows = [(i, f"s{i % 3}", "w " * (i % 17)) for i in range(200)]
    schema = "doc_id long, source string, text string"
    once = [sorted((r.doc_id, r.taken) for r in mixing.mix(mixing.sized(frame(rows[::k], schema, p))).collect()) for k, p in ((1, 1), (-1, 7))]
    assert once[0] == once[1]


def test_empty_and_clashing(frame):
    schema = "doc_id long, source string, text string, target string, size string"
    assert mixing.mix(mixing.sized(frame([], schema, 1))).count() == 0
    out = mixing.mix(mixing.sized(frame([(None, None, "a b", "x", "y")], schema, 1))).collect()
    assert [(r.size, r.taken, r.target) for r in out] == [(2, 3, 3.0)]
