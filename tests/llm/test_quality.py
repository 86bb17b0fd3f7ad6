"""Distances, references and verdicts of the quality rules, recomputed text by text."""

import math
import random
import re
from collections import Counter

import pytest

from oreflow.llm.quality import COMMON, Rules, quality_rules


def chars_of(text):
    """Shares of lower-case letters, white space, capitals, digits, common marks, other ASCII, and the rest."""
    classes = [r"[a-z]", r"[\x20\x09-\x0D]", r"[A-Z]", r"[0-9]", r"""[.,;:!?'"()-]""", r"[\x21-\x7e]"]
    out = [0] * 7
    for c in text:
        out[next((k for k, p in enumerate(classes) if re.match(p, c)), 6)] += 1
    return [n / max(1, len(text)) for n in out]


def common_of(text, lang):
    words = [w for w in re.split(r"[\x20\x09-\x0D.,;:!?]+", text.lower()) if w]
    listed = COMMON.get(lang, "").split()
    found = Counter(w for w in words if w in listed)
    cells = [found[w] for w in listed] + [len(words) - sum(found.values())]
    return [n / max(1, len(words)) for n in cells]


def distance(p, q):
    total = 0.0
    for x, y in zip(p, q):
        m = (x + y) / 2
        total += (x * math.log2(x / m) if x else 0) + (y * math.log2(y / m) if y else 0)
    return math.sqrt(max(0.0, total / 2))


def verdicts(rows, rules):
    """(char distance, word distance, kept) of rows (id, lang, text)."""
    texts = [(k, lang, t or "", len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))) for k, lang, t in rows]
    references = {}
    for lang in {r[1] for r in texts}:
        own = [(chars_of(t), common_of(t, lang)) for _, g, t, n in texts if g == lang and n]
        references[lang] = [[sum(c) / len(own) for c in zip(*(o[k] for o in own))] for k in (0, 1)] if own else None
    out = {}
    for k, lang, t, n in texts:
        reference = references[lang]
        far = [distance(h, r) for h, r in zip((chars_of(t), common_of(t, lang)), reference)] if reference else [0.0, 0.0]
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        count = Counter(tuple(w[i : i + 5]) for i in range(n - 4))
        covered = {j for i in range(n - 4) if count[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
        failed = n < 10 or 100 * len(covered) > 20 * n
        strange = n >= rules.char_words and far[0] > rules.char_distance
        odd = n >= rules.both_words and far[0] > rules.both_char_distance and far[1] > rules.both_word_distance + rules.both_word_scatter / math.sqrt(max(n, 1))
        out[k] = (*far, not (failed or strange or odd))
    return out


def sample():
    rng = random.Random(6)
    rows = []
    for k in range(120):
        lang = rng.choice(["en", "fr", "xx", None])
        listed = COMMON.get(lang, "ba no re").split()
        n = rng.randrange(5, 160)
        words = [rng.choice(listed) if rng.random() < 0.45 else "".join(rng.choice("abcdeéilnorst") for _ in range(rng.randrange(2, 9))) for _ in range(n)]
        words = [w.capitalize() + "." if rng.random() < 0.1 else w for w in words]
        if k % 10 == 3:
            words = [f"{rng.randrange(10**6)}|#" for _ in range(n)]
        if k % 10 == 4:
            words = [w.upper() for w in words]
        if k % 10 == 5:
            words = words[:8] * (n // 8)
        rows.append((k, lang, " ".join(words) + "\n"))
    return rows + [(200, "en", None), (201, "en", ""), (202, None, "日本 " * 40), (203, "de", " \n\t")]


@pytest.mark.parametrize("rules", [Rules(), Rules(char_distance=0.2, both_char_distance=0.05, both_word_distance=0.05, both_word_scatter=0.3)])
def test_distances_and_verdicts(spark, rules):
    rows = sample()
    docs = spark.createDataFrame(rows, "doc_id LONG, lang STRING, text STRING").repartition(5)
    got = {r.doc_id: r for r in quality_rules(docs, rules=rules).collect()}
    want = verdicts(rows, rules)
    for k, (chars, words, kept) in want.items():
        assert got[k].char_distance == pytest.approx(chars, abs=1e-9), k
        assert got[k].word_distance == pytest.approx(words, abs=1e-9), k
        assert got[k].kept == kept, k
    assert 10 < sum(kept for *_, kept in want.values()) < len(want) - 10
