"""Alignments against the longest common subsequence, and edited copies of licence texts."""

import random
import re

import pytest

from oreflow.llm import licenses

TEXTS = [name for name, text in licenses.TEMPLATES.items() if len(text.split()) > 20]


def longest_common(x, y):
    row = [0] * (len(y) + 1)
    for a in x:
        last = 0
        for j, b in enumerate(y, 1):
            last, row[j] = row[j], last + 1 if a == b else max(row[j], row[j - 1])
    return row[-1]


def test_alignments_are_common_subsequences():
    rng = random.Random(2)
    near = 0
    for _ in range(400):
        y = [rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(30))]
        x = [w for w in y if rng.random() > 0.1]
        for _ in range(rng.randrange(4)):
            x.insert(rng.randrange(len(x) + 1), rng.choice("abcdefgh"))
        pairs = licenses.align(x, y)
        assert all(x[a] == y[b] for a, b in pairs)
        assert all(p < q and r < s for (p, r), (q, s) in zip(pairs, pairs[1:]))
        best = longest_common(x, y)
        assert len(pairs) <= best
        near += best - len(pairs) <= 2
        if len(set(x)) == len(x) and len(set(y)) == len(y):  # all words are anchors: patience sorting finds the best
            assert len(pairs) == best
    assert near > 350


def edited(name, rng, share):
    """The text with a share of its words dropped, replaced and doubled, in other lines, between other words."""
    own = licenses.TEMPLATES[name].split()
    out = []
    for w in own:
        r = rng.random()
        if r < share / 2:
            continue
        out.append(rng.choice(["whatsoever", "hereunder", "etc"]) if r < share else w)
        if rng.random() < share:
            out.append("moreover")
    lines = "\n * ".join(" ".join(out[k : k + 9]) for k in range(0, len(out), 9))
    return f"Copyright 2001 someone\n * {lines}\nint main() {{ return 0; }}"


@pytest.mark.parametrize("name", TEXTS)
def test_edited_copies_are_found(spark, name):
    rng = random.Random(name)
    rows = [(k, edited(name, rng, 0.04)) for k in range(12)]
    # only those that a fixed search does not find
    own = " ".join(licenses.TEMPLATES[name].lower().split())
    rows = [(k, t) for k, t in rows if own not in re.sub(r"[*\s]+", " ", t.lower())]
    assert len(rows) > 3
    template = licenses.template_words(licenses.TEMPLATES[name])
    got = {r.doc_id: r for r in licenses.scan_licenses(spark.createDataFrame(rows, "doc_id BIGINT, text STRING")).collect() if r.license == name}
    for k, t in rows:
        words = [licenses.plain(w.encode()) for w in t.lower().split()]
        share = longest_common(words, template) / len(template)
        if share >= 0.93:
            assert k in got and got[k].n_template == len(template), share
        if k in got:
            assert 0.9 * len(template) <= got[k].matched <= longest_common(words, template)


def test_texts_told_apart(spark):
    rows = [(k, f"ba no {licenses.TEMPLATES[name]} re lu") for k, name in enumerate(TEXTS)]
    got = licenses.scan_licenses(spark.createDataFrame(rows, "doc_id BIGINT, text STRING")).collect()
    assert {(r.doc_id, r.license) for r in got if r.n_template > 20} == set(enumerate(TEXTS))
