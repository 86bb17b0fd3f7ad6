"""Personal data: the patterns as they stand, the dynamic program by enumeration, and texts that are hard to search."""

import random
import re
import time

import numpy as np
import pytest

from oreflow.llm import personal
from oreflow.llm.personal import KINDS, base_spans, find_personal


def luhn(digits):
    doubled = [int(d) * 2 if k % 2 else int(d) for k, d in enumerate(reversed(digits))]
    return sum(x - 9 if x > 9 else x for x in doubled) % 10 == 0


def by_pattern(text):
    """Matches of the patterns as written, leftmost and non-overlapping per kind, failing ones dropped."""
    rules = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda d, t: True),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda d, t: all(int(p) <= 255 for p in t.split("."))),
        "card": (r"[0-9]([\x20-]?[0-9])+", lambda d, t: 12 <= len(d) <= 19 and luhn(d)),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda d, t: 9 <= len(d) <= 15),
    }
    out = []
    for order, (kind, (pattern, passes)) in enumerate(rules.items()):
        for m in re.finditer(pattern, text):
            if passes("".join(re.findall("[0-9]", m.group())), m.group()):
                out.append((m.start(), order, m.end(), kind))
    return [(a, b, kind) for a, _, b, kind in sorted(out)]


@pytest.mark.parametrize("letters", ["aZ09.@+-_% ()5é", "0123456789 -", "01.25 ", "+0123456789 ().-", "a.@-b_"])
def test_patterns(letters):
    rng = random.Random(letters)
    found = 0
    for _ in range(20_000):
        text = "".join(rng.choice(letters) for _ in range(rng.randrange(50)))
        assert base_spans(text) == by_pattern(text), text
        found += len(by_pattern(text))
    assert found > 20


HARD = ["see 1.2.3.²", "v 10.0.0.① x", "²³ 4111 1111 1111 111①", "١٢٣.٤.٥.٦ 12", "@", "a@", "1@²", "+²1 555 0100 200", "\u0000 7   8"]


def test_digits_of_other_scripts_are_no_numbers(spark):
    rows = [(k, t) for k, t in enumerate(HARD)]
    got = {r.doc_id: r for r in find_personal(spark.createDataFrame(rows, "doc_id BIGINT, text STRING")).collect()}
    for k, t in rows:
        assert [(s.start, s.end, s.kind) for s in got[k].base] == by_pattern(t)


@pytest.mark.parametrize("text", ["1" * 10**6, "a@" + "b" * 10**6, "a" * 10**6 + "@", "1." * 500_000, "x@y.zz " * 100_000, "+1" * 500_000])
def test_long_texts_take_linear_time(text):
    start = time.perf_counter()
    base = base_spans(text)
    assert sum(b - a for a, b in personal.surroundings(text)) < 2 * len(text)
    assert time.perf_counter() - start < 10
    assert len(base) == (100_000 if text.startswith("x@") else 0) or text.startswith(("1.", "+1"))


def test_added_spans_of_a_text_with_many_base_spans():
    text = "x@y.zz 10.0.0.1 no 12 " * 3000
    base = base_spans(text)
    start = time.perf_counter()
    field = personal.Field.fit(["ba 10.0.0.7 no", "x@y.zz la"] * 20)
    added = personal.added_spans(field, text, base)
    assert time.perf_counter() - start < 60
    covered = np.zeros(len(text), int)
    for a, b, _ in base:
        covered[a:b] += 1
    assert all(covered[a:b].sum() == 0 for a, b, _ in added)


def segmentations(lattice, at=0):
    """All ways to cut the atoms from one on into single atoms (label 0) and labelled candidate segments."""
    if at == lattice.n:
        yield []
        return
    for rest in segmentations(lattice, at + 1):
        yield [(at, at + 1, 0), *rest]
    for (i, j), _ in lattice.number.items():
        if i == at:
            for label in range(1, len(KINDS) + 1):
                for rest in segmentations(lattice, j):
                    yield [(i, j, label), *rest]


def score(field, lattice, parts):
    total, last = 0.0, 0
    for i, j, label in parts:
        total += field.steps[last, label]
        if label:
            total += field.weights[label, lattice.features[lattice.number[i, j]]].sum()
        last = label
    return total


@pytest.mark.parametrize("text", ["a 1", "1.2", "x@y 3", "+1 2-3", "9\n8", "ab"])
def test_decoding_finds_the_best_of_all_segmentations(text):
    lattice = personal.Lattice(text)
    every = list(segmentations(lattice))
    rng = np.random.default_rng(len(text))
    for _ in range(20):
        field = personal.Field(rng.normal(size=(len(KINDS) + 1, personal.FEATURES)), rng.normal(size=(len(KINDS) + 1,) * 2))
        best = max(every, key=lambda p: score(field, lattice, p))
        assert field.decode(lattice) == [p for p in best if p[2]]


def test_gradient_is_that_of_the_likelihood():
    lattice = personal.Lattice("x@y 3")
    every = list(segmentations(lattice))
    rng = np.random.default_rng(1)
    field = personal.Field(0.3 * rng.normal(size=(len(KINDS) + 1, personal.FEATURES)), 0.3 * rng.normal(size=(len(KINDS) + 1,) * 2))
    (i, j), number = next(iter(lattice.number.items()))
    gold = [p for p in every if [x for x in p if x[2]] == [(i, j, 1)]][0]

    def likelihood():
        scores = np.array([score(field, lattice, p) for p in every])
        return score(field, lattice, gold) - np.logaddexp.reduce(scores)

    parts, steps = field._gradient(lattice, {(i, j): 1})
    for label in range(1, len(KINDS) + 1):
        feature = lattice.features[number][0]
        shared = sum(parts.get(s, np.zeros(len(KINDS) + 1))[label] * lattice.features[s].count(feature) for s in range(len(lattice.features)))
        before = likelihood()
        field.weights[label, feature] += 1e-5
        assert (likelihood() - before) / 1e-5 == pytest.approx(shared, abs=1e-3)
        field.weights[label, feature] -= 1e-5
    before = likelihood()
    field.steps[0, 0] += 1e-5
    assert (likelihood() - before) / 1e-5 == pytest.approx(steps[0, 0], abs=1e-3)
