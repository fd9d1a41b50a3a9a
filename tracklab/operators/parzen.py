"""Sequential search over parameter ranges with Parzen estimators of good and bad trials (T4).

Past trials are split by score.  For every parameter the good ones and the bad ones give a density
each, a mixture of kernels at their values and a wide one over the whole range; of some values
drawn from the good density the one with the greatest ratio of the two is proposed.  Ranges: ("int",
low, high), ("float", low, high), ("log", low, high), ("one", choices).  A parameter ``name_l<i>``
belongs to layer i and is only drawn for trials with more than i layers (``n_layers``).

The number of trials is a parameter of the search, so this is driver code; what a trial costs is
the evaluation, which the caller runs as Spark jobs.
"""

from __future__ import annotations

import math
import random
import re
from collections.abc import Callable, Sequence
from concurrent.futures import Future, ThreadPoolExecutor
from typing import Any

# Trials drawn at random before densities are used, and values compared per proposal.
FIRST_TRIALS, CANDIDATES = 10, 24
# Share of good trials, and how many they are at most.
GOOD_SHARE, MOST_GOOD = 0.1, 25
# The least width of a kernel, as a share of the range, is 1 / min(so many, trials + 1).
FINEST = 100


def _cdf(x: float) -> float:
    return 0.5 * math.erfc(-x / math.sqrt(2))


class _Kernels:
    """Density over an interval: truncated normal kernels at points, and one over the whole."""

    def __init__(self, points: Sequence[float], low: float, high: float):
        self.low, self.high, width = low, high, high - low
        inside = sorted(points)
        least = width / min(FINEST, len(inside) + 2)
        self.parts = [((low + high) / 2, width or 1.0)]
        for i, x in enumerate(inside):
            left = x - inside[i - 1] if i else x - low
            right = inside[i + 1] - x if i + 1 < len(inside) else high - x
            self.parts.append((x, min(max(left, right, least), width) or 1.0))

    def draw(self, rng: random.Random) -> float:
        middle, width = rng.choice(self.parts)
        while self.low < self.high:
            x = rng.gauss(middle, width)
            if self.low <= x <= self.high:
                return x
        return self.low

    def mass(self, a: float, b: float) -> float:
        """Mean probability of [a, b] under the kernels, each cut to the interval."""
        total = 0.0
        for middle, width in self.parts:
            whole = _cdf((self.high - middle) / width) - _cdf((self.low - middle) / width)
            total += (_cdf((b - middle) / width) - _cdf((a - middle) / width)) / max(whole, 1e-300)
        return total / len(self.parts)


class _Number:
    """An int, float or log range on the scale on which its kernels live."""

    def __init__(self, kind: str, low: float, high: float):
        self.kind = kind
        scale = math.log if kind == "log" else float
        half = 0.5 if kind == "int" else 0.0
        self.low, self.high = scale(low) - half, scale(high) + half
        self.ends = low, high

    def place(self, value: float) -> float:
        return math.log(value) if self.kind == "log" else float(value)

    def value(self, place: float):
        low, high = self.ends
        if self.kind == "int":
            return min(max(round(place), low), high)
        return min(max(math.exp(place) if self.kind == "log" else place, low), high)

    def uniform(self, rng: random.Random):
        return self.value(rng.uniform(self.low, self.high))

    def propose(self, good: list, bad: list, rng: random.Random):
        known = [_Kernels([self.place(v) for v in some], self.low, self.high) for some in (good, bad)]
        step = 0.5 if self.kind == "int" else (self.high - self.low) * 1e-6

        def ratio(value) -> float:
            at = self.place(value)
            here = [max(k.mass(max(at - step, self.low), min(at + step, self.high)), 1e-300) for k in known]
            return math.log(here[0]) - math.log(here[1])

        return max([self.value(known[0].draw(rng)) for _ in range(CANDIDATES)], key=ratio)


class _Choice:
    """One of some values; every value counts once more than it was seen."""

    def __init__(self, choices: Sequence):
        self.choices = list(choices)

    def uniform(self, rng: random.Random):
        return rng.choice(self.choices)

    def propose(self, good: list, bad: list, rng: random.Random):
        def shares(some: list) -> list[float]:
            return [(some.count(c) + 1 / len(self.choices)) / (len(some) + 1) for c in self.choices]

        g, b = shares(good), shares(bad)
        drawn = rng.choices(range(len(self.choices)), g, k=CANDIDATES)
        return self.choices[max(drawn, key=lambda i: g[i] / b[i])]


class ParzenSampler:
    """Proposes parameters from past trials; equal seeds and trials give equal proposals."""

    def __init__(self, ranges: dict[str, tuple], seed: int):
        self.seed = seed
        self.ranges = {name: _Choice(spec[1]) if spec[0] == "one" else _Number(*spec) for name, spec in ranges.items()}

    @staticmethod
    def _wanted(name: str, drawn: dict[str, Any]) -> bool:
        layer = re.fullmatch(r".*_l(\d+)", name)
        return not layer or "n_layers" not in drawn or int(layer.group(1)) < drawn["n_layers"]

    def propose(self, number: int, past: Sequence[tuple[dict, float]], running: Sequence[dict] = ()) -> dict[str, Any]:
        """Parameters of trial ``number``.  Trials that still run count as bad ones, so that
        proposals made side by side keep apart."""
        rng = random.Random(f"{self.seed}/{number}")
        ranked = sorted(past, key=lambda t: -t[1])
        n = min(math.ceil(GOOD_SHARE * len(ranked)), MOST_GOOD)
        good, bad = [p for p, _ in ranked[:n]], [p for p, _ in ranked[n:]] + list(running)
        out: dict[str, Any] = {}
        for name, spec in self.ranges.items():
            if self._wanted(name, out):
                some = [[p[name] for p in trials if name in p] for trials in (good, bad)]
                out[name] = spec.uniform(rng) if len(past) < FIRST_TRIALS or not some[0] else spec.propose(*some, rng)
        return out


def search(ranges: dict[str, tuple], evaluate: Callable[[dict], float], trials: int, seed: int, side_by_side: int = 1) -> list[tuple[dict, float]]:
    """All trials (parameters, score) in order of proposal.

    ``side_by_side`` trials run at a time.  A trial is proposed from the scores of those at least so many
    before it, whatever else has ended by then: the course does not depend on timing.
    """
    sampler, running, results = ParzenSampler(ranges, seed), [], []
    with ThreadPoolExecutor(side_by_side) as pool:
        for number in range(trials):
            if len(running) == side_by_side:
                params, score = running.pop(0)
                results.append((params, score.result()))
            params = sampler.propose(number, results, [p for p, _ in running])
            future: Future = pool.submit(evaluate, params)
            running.append((params, future))
        results += [(params, score.result()) for params, score in running]
    return results
