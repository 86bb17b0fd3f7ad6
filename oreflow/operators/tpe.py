"""Model-based search of settings by a tree-structured Parzen estimator, a few trials at a time.

The trials so far are split into the better ones and the rest. Of each setting two densities are made, one over the
better trials and one over the rest: for a choice by counts, for a range by normal curves around the tried values
(cut at the ends) over an even floor. Candidates are drawn from the density of the better trials, and the one whose
density there is the largest against that of the rest is tried next. Trials of a round that have not ended yet count
among the rest, which keeps the round from proposing one setting several times.

Every fourth trial is drawn evenly instead, so no part of the space is left out for good.

The first trials spread over the space evenly: setting k of trial i is the digits of i, in the k-th prime base,
mirrored at the point.
"""

from __future__ import annotations

import math
import random
from collections.abc import Callable
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

STARTUP = 8
CANDIDATES = 4
BETTER = 0.25
EVEN = 4
PRIMES = (2, 3, 5, 7, 11, 13, 17, 19, 23, 29, 31, 37)


@dataclass(frozen=True)
class Choice:
    values: tuple

    def draw(self, rng: random.Random):
        return rng.choice(self.values)

    def at(self, share: float):
        return self.values[min(int(share * len(self.values)), len(self.values) - 1)]

    def holds(self, value) -> bool:
        return value in self.values

    def near(self, seen: list, rng: random.Random):
        return rng.choices(self.values, [seen.count(v) + 1 for v in self.values])[0]

    def density(self, value, seen: list) -> float:
        return (seen.count(value) + 1) / (len(seen) + len(self.values))


@dataclass(frozen=True)
class Uniform:
    low: float
    high: float
    digits: int = 4

    def draw(self, rng: random.Random) -> float:
        return self.at(rng.random())

    def at(self, share: float) -> float:
        return round(self.low + share * (self.high - self.low), self.digits)

    def holds(self, value: float) -> bool:
        return self.low <= value <= self.high

    def _width(self, seen: list) -> float:
        return max((self.high - self.low) / (1 + len(seen)), (self.high - self.low) / 50)

    def near(self, seen: list, rng: random.Random) -> float:
        if rng.random() * (len(seen) + 1) < 1:
            return self.draw(rng)
        centre, width = rng.choice(seen), self._width(seen)
        while not self.holds(value := rng.gauss(centre, width)):
            pass
        return round(value, self.digits)

    def density(self, value: float, seen: list) -> float:
        width = self._width(seen)
        total = 1 / (self.high - self.low)
        for centre in seen:
            inside = (math.erf((self.high - centre) / width / 2**0.5) - math.erf((self.low - centre) / width / 2**0.5)) / 2
            total += math.exp(-(((value - centre) / width) ** 2) / 2) / width / math.sqrt(2 * math.pi) / inside
        return total / (len(seen) + 1)


Space = dict[str, Choice | Uniform]


@dataclass(frozen=True)
class Trial:
    number: int
    settings: dict
    loss: float


def mirrored(i: int, base: int) -> float:
    """The digits of i behind the point, the last one first: 1, 2, 3 in base 2 are 0.5, 0.25, 0.75."""
    out, unit = 0.0, 1.0
    while i:
        unit /= base
        out += unit * (i % base)
        i //= base
    return out


def propose(space: Space, ended: list[Trial], pending: list[dict], number: int, seed: int, startup: int = STARTUP) -> dict:
    """The settings of trial ``number`` (from 1); the same for the same trials and seed."""
    if number <= startup or not ended:
        return {name: part.at(mirrored(number, PRIMES[k % len(PRIMES)])) for k, (name, part) in enumerate(space.items())}
    rng = random.Random(f"{seed}/{number}")
    if number % EVEN == 0:
        return {name: part.draw(rng) for name, part in space.items()}
    ranked = sorted(ended, key=lambda t: (t.loss, t.number))
    few = max(1, math.ceil(BETTER * len(ranked)))
    better = [t.settings for t in ranked[:few]]
    rest = [t.settings for t in ranked[few:]] + pending
    best, best_ratio = None, -math.inf
    for _ in range(CANDIDATES):
        settings, ratio = {}, 0.0
        for name, part in space.items():
            good, bad = [s[name] for s in better], [s[name] for s in rest]
            settings[name] = value = part.near(good, rng)
            ratio += math.log(part.density(value, good)) - math.log(part.density(value, bad))
        if ratio > best_ratio:
            best, best_ratio = settings, ratio
    return best


def minimise(
    loss: Callable[[dict], float], space: Space, trials: int, parallelism: int = 4, seed: int = 42, startup: int = STARTUP
) -> list[Trial]:
    """Trials in rounds of ``parallelism``, all proposed from the rounds before; in order of their numbers."""
    ended: list[Trial] = []
    with ThreadPool(parallelism) as pool:
        while len(ended) < trials:
            proposed: list[dict] = []
            for _ in range(min(parallelism, trials - len(ended))):
                proposed.append(propose(space, ended, proposed, len(ended) + len(proposed) + 1, seed, startup))
            found = pool.map(loss, proposed)
            ended += [Trial(len(ended) + k, s, x) for k, (s, x) in enumerate(zip(proposed, found), 1)]
    return ended
