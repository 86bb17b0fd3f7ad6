"""Blocks of word numbers, tiles of counts and phrases against brute force."""

import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from oreflow.llm import blocks as bl
from oreflow.llm import phrases

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def pieces(text):
    for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
        yield re.findall(r"[^\x20\x09]+", piece)


def brute(rows, least, longest, inside):
    """(lang, phrase, words, a, l, r, n, score) of rows (lang, text)."""
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        for w in pieces(text):
            totals[lang or "und"] += len(w)
            for size in range(1, longest + 1):
                counts.update((lang or "und", tuple(w[k : k + size])) for k in range(len(w) - size + 1))
    out = []
    frequent = [(g, p, a) for (g, p), a in counts.items() if 2 <= len(p) and a >= least]
    for g, p, a in frequent:
        longer = [b for h, q, b in frequent if h == g and len(q) > len(p) and any(q[k : k + len(p)] == p for k in range(len(q)))]
        if any(100 * b >= inside * a for b in longer):
            continue
        n = totals[g]
        cuts = [(1000 * a * n // (counts[g, p[:k]] * counts[g, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        out.append((g, " ".join(p), len(p), a, counts[g, p[:k]], counts[g, p[k:]], n, score))
    return sorted(out)


def sample(seed=3):
    rng = random.Random(seed)
    common = ["Aa", "b", "É", "dd", "ee", "日本", "g"]
    rows = []
    for k in range(300):
        words = [rng.choice(common) if rng.random() < 0.7 else f"w{rng.randrange(400)}" for _ in range(rng.randrange(30))]
        if k % 3 == 0:
            words[3:3] = "new york city hall now".split()
        rows.append((rng.choice(["en", "fr", None, "und"]), rng.choice([" ", "\t", "  "]).join(words).replace("ee", "ee,", 3)))
    rows += [("en", None), ("en", ""), ("fr", " \t.\n,"), ("one", "a a a a a a a a a a a a a a a")]
    return rows + [("en", "same same; words here " * 200)] * 2


@pytest.mark.parametrize(
    "block_bytes,inside,longest,few", [(bl.BLOCK_BYTES, 100, 5, 10_000), (2000, 100, 5, 0), (2000, 100, 5, 10_000), (500, 80, 3, 0)]
)
def test_phrases(spark, block_bytes, inside, longest, few):
    rows = sample()
    clashing = [F.lit("x").alias(c) for c in ("grp", "block", "words", "n", "a", "id", "rank", "score")]
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(5).select("*", *clashing)
    got = phrases.mine_phrases(docs, least=10, longest=longest, inside=inside, block_bytes=block_bytes, few=few)
    want = brute(rows, 10, longest, inside)
    assert sorted(tuple(r) for r in got.collect()) == want
    assert len(want) > 30 and any(w[2] == longest for w in want)
    best = phrases.best_phrases(got, first=5).collect()
    order = {}
    for w in sorted(want, key=lambda w: (-w[7], -w[3], w[1].encode())):
        order.setdefault(w[0], []).append(w[1])
    assert {(r.lang, r["rank"], r.phrase) for r in best} == {(g, k, p) for g, ps in order.items() for k, p in enumerate(ps[:5], 1)}


def test_no_phrases(spark, no_docs, odd_docs):
    assert phrases.mine_phrases(no_docs).count() == 0
    assert phrases.mine_phrases(odd_docs).count() == 0


def test_scores_beyond_64_bits(spark):
    rows = [([3_000_000_000_000], [4_000_000_000], 2_999_999_999, 90_000_000_000_000_000)]
    df = spark.createDataFrame(rows, "heads array<long>, tails array<long>, f long, n long")
    best = df.select(phrases.lowest_cut("f", "n").alias("c")).first().c
    assert best.score == 1000 * 2_999_999_999 * 90_000_000_000_000_000 // (3_000_000_000_000 * 4_000_000_000)


@pytest.mark.parametrize("size", [0, 10, 200_000])
@pytest.mark.parametrize("weighted", [False, True])
def test_cells(size, weighted):
    rng = np.random.default_rng(size)
    area = np.array([phrases.SIDE**2] * 4 + [1 << 40] * 3)
    tile = rng.zipf(1.5, size) % 7 if size else np.zeros(0, np.int64)
    cell = rng.integers(0, phrases.SIDE**2, size) // rng.integers(1, 5000, size)
    counts = rng.integers(1, 1 << 40, size) if weighted else None
    tiles, cells, sums = phrases.count_cells(tile, cell, area, counts)
    want = Counter()
    for k, key in enumerate(zip(tile.tolist(), cell.tolist())):
        want[key] += int(counts[k]) if weighted else 1
    got = list(zip(tiles.tolist(), cells.tolist()))
    assert dict(zip(got, sums.tolist())) == want and got == sorted(want)


def test_tiles_cover_all_ids():
    ids = np.array([0, 1, 511, 512, 1023, 1024, 2047, 2048, 5000, (1 << 31) - 1], np.int64)
    tile = phrases.tile_of(ids)
    assert (phrases.base_of(tile) <= ids).all() and (ids < phrases.base_of(tile) + phrases.width_of(tile)).all()
    assert tile[:9].tolist() == [0, 0, 0, 1, 1, 2, 2, 3, 4] and tile.max() < 64


def test_hot_tiles_are_split(spark):
    rng = random.Random(1)
    rows, want = [], Counter()
    for block in range(300):
        tiles = (0, 0), (3, 2), (1, 0)
        rt, ct = tiles[block % 3]
        cells = sorted(rng.sample(range(2000), 20))
        rows.append(("en", rt, ct, block, cells, [block + 1] * 20))
        want.update({(block % 3, c): block + 1 for c in cells})
    chunks = spark.createDataFrame(rows, phrases.CHUNK).repartition(6)
    for size in (30, 1000, 1 << 22):
        got = phrases.add_up(chunks, 300, group_cells=size).collect()
        found = {}
        for r in got:
            k = {(0, 0): 0, (3, 2): 1, (1, 0): 2}[int(phrases.tile_of(r.a)), int(phrases.tile_of(r.b))]
            base, width = (lambda t: int(phrases.base_of(t))), (lambda t: int(phrases.width_of(t)))
            rt, ct = tiles[k]
            found[k, (r.a - base(rt)) * width(ct) + r.b - base(ct)] = r.n
        assert found == {k: v for k, v in want.items() if v >= 300}


def test_waiting_words_take_little_memory():
    """A task keeps a number for each word that waits for its block, not the word's bytes, hash and place."""
    rng = np.random.default_rng(5)
    texts = [" ".join(f"word{k}" for k in rng.integers(0, 5000, 4000)) for _ in range(60)]
    marks, rows = bl.bytes_set(b"\x20\x09.\x0a"), pa.RecordBatch.from_arrays([pa.array(range(10))], ["id"])
    waiting, size = bl.Waiting(), 0
    breaks = bl.bytes_set(b".\x0a")
    bl.Words(pa.array(texts[:10])).hashes()  # makes the table of powers
    tracemalloc.start()
    for k in range(0, len(texts), 10):
        waiting.add(bl.Words(pa.array(texts[k : k + 10]), lower=True, apart=marks), breaks, False, rows)
        size += 10 * 4000
    held = tracemalloc.get_traced_memory()[0]
    tracemalloc.reset_peak()
    block = waiting.block()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert held < 10 * size and peak - held < 20 * size
    numbers, words = block["numbers"], block["words"].to_pylist()
    assert [words[k] for k in numbers[numbers >= 0]] == [w for t in texts for w in t.split()]
    assert (numbers < 0).sum() == len(texts) and block["counts"].sum() == size
    assert block["counts"].tolist() == sorted(block["counts"], reverse=True)
