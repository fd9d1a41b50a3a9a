"""Proposals stay in range, follow the seed, and beat random draws on a known function."""

import math
import time

import pytest

from tracklab.operators import parzen, tuning

RANGES = {"x": ("float", -5.0, 5.0), "n": ("int", 1, 60), "rate": ("log", 1e-5, 1.0), "kind": ("one", ["a", "b", "c"])}


def score(p):
    """Greatest, 0, at x = 2, n = 17, rate = 0.01, kind = b."""
    return -((p["x"] - 2) / 2) ** 2 - ((p["n"] - 17) / 15) ** 2 - (math.log10(p["rate"]) + 2) ** 2 - (0 if p["kind"] == "b" else 1.5)


def random_best(trials, seed):
    sampler = parzen.ParzenSampler(RANGES, seed)
    return max(score(sampler.propose(i, [])) for i in range(trials))


def test_beats_random_draws():
    wins, gains = 0, []
    for seed in range(20):
        best = max(s for _, s in parzen.search(RANGES, score, 60, seed))
        gains.append(best - random_best(60, seed))
        wins += gains[-1] > 0
    assert wins >= 16 and sum(gains) > 0


def test_in_range_and_reproducible():
    first = parzen.search(RANGES, score, 40, seed=3)
    assert first == parzen.search(RANGES, score, 40, seed=3) != parzen.search(RANGES, score, 40, seed=4)
    for p, _ in first:
        assert -5 <= p["x"] <= 5 and 1 <= p["n"] <= 60 and isinstance(p["n"], int) and 1e-5 <= p["rate"] <= 1 and p["kind"] in "abc"


def test_timing_does_not_matter():
    def slow(p):
        time.sleep((p["n"] % 7) / 500)
        return score(p)

    assert parzen.search(RANGES, slow, 30, 5, side_by_side=4) == parzen.search(RANGES, score, 30, 5, side_by_side=4)


def test_first_trials_are_uniform_and_running_ones_are_avoided():
    sampler = parzen.ParzenSampler({"x": ("float", 0.0, 1.0)}, 1)
    assert len({sampler.propose(i, [])["x"] for i in range(50)}) == 50
    past = [({"x": 0.3}, 1.0)] + [({"x": 0.9}, 0.0)] * 10
    near = [abs(sampler.propose(i, past, [])["x"] - 0.3) for i in range(40)]
    apart = [abs(sampler.propose(i, past, [{"x": 0.3}] * 20)["x"] - 0.3) for i in range(40)]
    assert sum(near) < sum(apart)


def test_layers_are_conditional():
    for p, _ in parzen.search(tuning.RANGES["MLP"], lambda p: -p["n_layers"], 25, 2):
        assert [f"n_units_l{i}" in p for i in range(3)] == [i < p["n_layers"] for i in range(3)]


@pytest.mark.parametrize("spec", [("int", 4, 4), ("float", 1.5, 1.5), ("log", 2.0, 2.0), ("one", ["only"])])
def test_ranges_of_one_value(spec):
    value = spec[1][0] if spec[0] == "one" else spec[1]
    found = [p["v"] for p, _ in parzen.search({"v": spec}, lambda p: 1.0, 15, 0)]
    assert found == ([value] * 15 if spec[0] == "one" else pytest.approx([value] * 15))
