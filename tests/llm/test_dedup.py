"""Near duplicates, repeated passages and similar lines against brute force."""

import re
import time
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from oreflow.llm import lines, near, numbering
from oreflow.llm.graph import components
from oreflow.llm.lines import dedup_lines
from oreflow.llm.near import near_duplicates
from oreflow.llm.substrings import merged, remove_repeats

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingles(text):
    w = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) > 4 else frozenset([tuple(w)] if w else [])


def groups(texts):
    sets = [shingles(t) for t in texts]
    label = list(range(len(sets)))
    for i, x in enumerate(sets):
        for j, y in enumerate(sets[:i]):
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                a, b = label[i], label[j]
                label = [min(a, b) if v in (a, b) else v for v in label]
    return [(k, len(s), label[k]) for k, s in enumerate(sets)]


def test_near_duplicates(docs, texts):
    got = sorted(tuple(r) for r in near_duplicates(docs).collect())
    want = groups(texts)
    assert got == want
    assert sum(k != c for k, _, c in want) > 10


def test_near_duplicates_of_odd_rows(odd_docs, no_docs):
    got = Counter((r.doc_id, r.component_id) for r in near_duplicates(odd_docs).collect())
    assert got[0, 0] == 2 and got[None, 0] == 1 and got[None, None] == 1 and got[41, 40] == 1
    assert near_duplicates(no_docs).count() == 0


def test_near_duplicates_by_text_not_id(spark):
    """Near copies without an id, one of them a bridge, and different texts under one id."""
    word = lambda k: [f"w{k}x{i}" for i in range(100)]
    edit = lambda w, *at: " ".join("changed" if i in at else x for i, x in enumerate(w))
    rows, want = [], []
    for k in range(0, 200, 10):
        a, b, c = word(k), word(k + 1), word(k + 2)
        rows += [(k, edit(a)), (None, edit(a, 30)), (k + 1, edit(a, 30, 60))]  # the first and the last only link by the second
        want += [(k, k), (None, k), (k + 1, k)]
        rows += [(k + 2, edit(b)), (k + 2, edit(c)), (k + 3, edit(b, 50)), (k + 4, edit(c, 50))]
        want += [(k + 2, k + 2), (k + 2, k + 2), (k + 3, k + 2), (k + 4, k + 2)]
        rows += [(None, edit(word(k + 3))), (None, edit(word(k + 3), 40))]
        want += [(None, None)] * 2
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING").repartition(5)
    found = near_duplicates(docs, named=True).collect()
    assert Counter((r.doc_id, r.component_id) for r in found) == Counter(want)
    assert len({r.component for r in found}) == 80  # no link to, nor between, the two texts of one id
    kept = Counter((r.doc_id, r.text) for r in corpus_pipeline.near_dedup(spark, docs, "").collect())
    want = [r for r in rows if r[0] is None or r[0] % 10 in (0, 2)]
    assert kept == Counter(want)


def test_every_pair_within_the_bound_meets():
    """Two similar sets share an entry that the smaller one looks up, whatever it leaves out."""
    rng = np.random.default_rng(5)
    for n in (1, 4, 5, 9, 16, 31, 33, 63, 64, 100, 127, 128, 255, 256, 400):
        for _ in range(20):
            x = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64) * np.uint64(2))
            grow = rng.integers(0, n // 4 + 1)
            y = np.unique(np.concatenate([x[rng.integers(0, max(1, n // 9)) :], rng.integers(0, 1 << 63, grow).astype(np.uint64)]))
            both = len(np.intersect1d(x, y))
            if 100 * both < 80 * (len(x) + len(y) - both):
                continue
            if (len(y), near.set_key(y)) < (len(x), near.set_key(x)):
                x, y = y, x
            band, high = (len(s).bit_length() - 1 for s in (x, y))
            short = near.spare(x, 80) < 0
            found, kind = near.entries(x, band, 80, short)
            other, other_kind = near.entries(y, band, 80, False)
            if high > band:
                assert -(-len(y) * 80 // 100) < 1 << high
            spared = found[kind == near.SPARED]
            left_out = rng.permutation(spared)[: max(0, near.spare(x, 80) - 1)]
            asked = np.setdiff1d(found[np.isin(kind, (near.SPARED, near.ASKED, near.EMPTY_ASKED))], left_out)
            listed = other if short else other[other_kind != near.EMPTY]
            assert len(np.intersect1d(asked, listed)) >= 1 + (near.spare(x, 80) > 0)


def test_parity_never_excludes_similar_sets():
    rng = np.random.default_rng(2)
    for n in (5, 60, 700, 5000):
        x = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
        y = x[n // 9 :]
        (bits,) = near.parity_distance(pa.array([near.parity(x)]), pa.array([near.parity(y)]))
        assert bits <= len(x) - len(y)
    x = np.unique(rng.integers(0, 1 << 63, near.LARGE + 9).astype(np.uint64))  # a map of either size
    y = x[20:]
    pairs = [near.parity(a) for a in (x, y, x[:100], y)], [near.parity(b) for b in (y, x, x[:90], y)]
    assert {len(m) for m in pairs[0]} == {near.PARITY_BITS // 8, near.LARGE_BITS // 8}
    bits = near.parity_distance(*(pa.array(m) for m in pairs))
    assert (0 < bits[:3]).all() and (bits <= [20, 20, 10, 0]).all()


def test_maps_in_the_join_of_lists(spark):
    """Those that go along with index entries keep all similar pairs, and few of sets that only share passages."""
    rng = np.random.default_rng(4)
    rows, alike = [], []
    for n in (40, 210, 250, 300, 420, 600, 1500, 1900, 2040, 2500, 5000):
        x = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
        grow = rng.integers(0, 1 << 63, 2 * n).astype(np.uint64)
        for part, more, similar in ((n // 10, n // 10, True), (0, n // 5, True), (n // 3, n // 3, False), (9 * n // 10, n, False)):
            rows.append((len(alike), [(len(s), near.parity(s)) for s in (x, np.unique(np.concatenate([x[part:], grow[:more]])))]))
            alike.append(similar)
    sets = [(2 * k + i, size, bytearray(map)) for k, pair in rows for i, (size, map) in enumerate(pair)]
    sets = spark.createDataFrame(sets, "set long, size long, parity binary")
    sized = near.folds(sets).join(sets.select("set", "size"), "set")
    pairs = sized.alias("x").join(sized.alias("y"), F.expr("x.set + 1 = y.set and x.set % 2 = 0"))
    for sides in (("x", "y"), ("y", "x")):  # a longer map on either side
        found = {r.set // 2 for r in pairs.where(near.folds_match(*sides, 80)).select("x.set").collect()}
        assert found >= {k for k, same in enumerate(alike) if same}
        assert not [k for k in found if not alike[k] and rows[k][1][0][0] >= near.WIDE_FROM]


def test_components_of_chains_and_loops(spark):
    links = [(k, k + 1) for k in range(60)] + [(100, 101), (101, 102), (102, 100), (7, 7), (None, 3)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a BIGINT, b BIGINT")).collect()}
    assert got == {**{k: 0 for k in range(61)}, 100: 100, 101: 100, 102: 100}


def without_repeats(texts, width):
    lists = [WORD.findall(t or "") for t in texts]
    count = Counter(tuple(w[k : k + width]) for w in lists for k in range(len(w) - width + 1))
    out = []
    for w in lists:
        gone = [False] * len(w)
        for k in range(len(w) - width + 1):
            if count[tuple(w[k : k + width])] > 1:
                gone[k : k + width] = [True] * width
        out.append((len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return out


@pytest.mark.parametrize("width,gram", [(35, 8), (10, 3)])
def test_repeated_passages(docs, texts, width, gram):
    rows = {r.doc_id: r for r in remove_repeats(docs, width=width, gram=gram).collect()}
    want = without_repeats(texts, width)
    for k, (n, gone, kept) in enumerate(want):
        r = rows[k]
        assert (r.n_words, sum(x.end - x.first for x in r.removed), r.kept) == (n, gone, kept), k
        assert all(a.end < b.first for a, b in zip(r.removed, r.removed[1:]))
    assert sum(g for _, g, _ in want) > 1000


def test_repeated_passages_of_odd_rows(odd_docs, no_docs):
    got = Counter((r.doc_id, r.n_words > 0, r.kept == "") for r in remove_repeats(odd_docs).collect())
    assert got[0, True, True] == 2 and got[None, True, True] == 1 and got[None, False, True] == 1
    assert remove_repeats(no_docs).count() == 0
    assert merged([(5, 9), (1, 3), (3, 4), (8, 12)]) == [(1, 4), (5, 12)]


def similar_lines(rows):
    """Removed line numbers of (id, text) rows in order of id."""
    seen, out = [], {}
    for k, text in rows:
        gone = []
        for n, line in enumerate(text.split("\n") if text is not None else []):
            s = frozenset(WORD.findall(line.lower()))
            if s:
                if any(100 * len(s & t) >= 80 * len(s | t) for t in seen):
                    gone.append(n)
                seen.append(s)
        out[k] = gone
    return out


def test_similar_lines(docs, texts):
    got = {r.doc_id: r for r in dedup_lines(docs).collect()}
    want = similar_lines(enumerate(texts))
    assert {k: r.removed for k, r in got.items()} == want
    assert sum(map(len, want.values())) > 30
    for k, t in enumerate(texts):
        kept = None if t is None else "\n".join(x for n, x in enumerate(t.split("\n")) if n not in want[k])
        assert got[k].kept == kept and got[k].n_lines == (0 if t is None else t.count("\n") + 1)


def test_similar_lines_of_odd_rows(odd_docs, no_docs, texts):
    rows = dedup_lines(odd_docs, carry=["key", "set", "carry"]).collect()
    assert len(rows) == odd_docs.count()
    # the row without an id comes first, so equal lines of document 0 go, in both of its rows
    first = [r for r in rows if r.doc_id is None and r.kept is not None]
    again = [r for r in rows if r.doc_id == 0]
    assert len(first) == 1 and len(again) == 2 and again[0] == again[1]
    assert len(again[0].removed) == len([x for x in texts[0].split("\n") if x.split()])
    assert dedup_lines(no_docs).count() == 0


def test_prefixes_of_lines_do_not_stay(spark, docs, monkeypatch):
    """Once the lists of words are stored, prefixes and maps lie nowhere else; in the end no large table is left."""
    there, with_prefix = {}, []
    stored, discard = lines.stored, lines.discard

    def storing(df, name, *more):
        table = stored(df, name, *more)
        there[table.stored_at] = name, table.columns
        if name == "similar":
            with_prefix.append([n for n, columns in there.values() if "prefix" in columns])
        return table

    def discarding(table):
        there.pop(table.stored_at)
        discard(table)

    for module in (lines, numbering):
        monkeypatch.setattr(module, "stored", storing)
        monkeypatch.setattr(module, "discard", discarding)
    assert dedup_lines(docs).count() == docs.count()
    assert with_prefix == [[], []]
    assert not {n for n, _ in there.values()} & {"lines", "numbered", "less", "met", "pairs", "ranged"}


def test_unlike_lines_all_stay(spark):
    """Lines of one word each, all different, and long ones that share no word."""
    short = [(k, "\n".join(f"w{k}x{i}" for i in range(1000))) for k in range(100)]
    long = [(k, "\n".join(" ".join(f"v{k}x{i}x{j}" for j in range(20)) for i in range(100))) for k in range(100, 120)]
    rows = dedup_lines(spark.createDataFrame(short + long, "doc_id BIGINT, text STRING").repartition(8)).collect()
    assert len(rows) == 120 and sum(len(r.removed) for r in rows) == 0


@pytest.mark.parametrize("percent", [60, 80, 100])
def test_similar_lines_of_common_words(spark, percent):
    """Few words, so that lists are long and many lines resemble several others."""
    rng = np.random.default_rng(3)
    common = [f"w{int(x)}" for x in range(30)]
    docs = [(k, "\n".join(" ".join(rng.choice(common, rng.integers(1, 14))) for _ in range(8))) for k in range(60)]
    base = [f"b{x}" for x in range(40)]
    for k in range(60, 120):  # copies of one line with words changed and added
        copy = list(base)
        for at in rng.integers(0, 40, k % 6):
            copy[at] = f"new{k}x{at}"
        docs.append((k, " ".join(copy + [f"more{k}"] * (k % 2))))
    got = {r.doc_id: r.removed for r in dedup_lines(spark.createDataFrame(docs, "doc_id BIGINT, text STRING"), percent=percent).collect()}
    seen, want = [], {}
    for k, text in docs:
        want[k] = []
        for n, line in enumerate(text.split("\n")):
            s = frozenset(line.split())
            if any(100 * len(s & t) >= percent * len(s | t) for t in seen):
                want[k].append(n)
            seen.append(s)
    assert got == want and sum(map(len, want.values())) > (10 if percent == 100 else 50)


def test_words_of_lines(spark):
    """Texts without tabs and the like are split at spaces, with the same words; tokens are never null, so sort unboxed."""
    texts = ["A b  b c ", " ", "", None, "x\ty Z\x0bw", "one\ntwo  three\n", "a\r\nb\x0cc", "\u0130stanbul\xa0ok fine", "\n\n"]
    rows = spark.createDataFrame(list(enumerate(texts)), "k int, text string")
    found = dict(rows.select("k", lines.word_list(F.col("text"))).collect())
    for k, text in enumerate(texts):
        want = None if text is None else [w for w in re.split(r"[\x20\x09-\x0D]+", text.lower()) if w]
        assert found[k] == want
    steps = F.array(F.lit(0).cast("long"), F.lit(1 << 56).cast("long"))
    made = rows.select(lines.tokens(F.col("text"), steps, 2).alias("tokens"))
    assert not made.schema["tokens"].dataType.containsNull
    for row, text in zip(made.collect(), texts):
        assert row.tokens is None if text is None else row.tokens == sorted(set(row.tokens))


def test_one_window_lists_lines(spark, monkeypatch):
    """A list's head and length come from one window, and what is stored of a head is its place."""
    seen = {}
    real = lines.stored

    def stored(df, name, *more):
        if name == "met":
            seen["windows"] = df._jdf.queryExecution().executedPlan().toString().count("Window [")
            seen["columns"] = df.columns
        return real(df, name, *more)

    monkeypatch.setattr(lines, "stored", stored)
    docs = spark.createDataFrame([(1, "a b c d e f\nsome other line of words"), (2, "a b c d e f g"), (3, "")], "doc_id long, text string")
    got = {r.doc_id: r.removed for r in lines.dedup_lines(docs, buckets=64).collect()}
    assert got == {1: [], 2: [0], 3: []}
    assert seen == {"windows": 1, "columns": ["word", "place", "at", "map", "near_head"]}


def test_stored_tables_leave_no_shuffle_files(spark, docs):
    """A table's shuffle files go when it is written, not when the driver happens to collect garbage."""
    resolver = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffles = lambda: {str(f) for f in re.findall(r"shuffle_\d+_\d+_\d+\.data", resolver.getAllFiles().mkString(" "))}
    before = shuffles()
    table = lines.stored(docs.repartition(7, "doc_id").groupBy("lang").count(), "freed")
    for _ in range(50):
        if not shuffles() - before:
            break
        time.sleep(0.1)
    assert not shuffles() - before
    assert table.collect()[0]["count"] == docs.count()
    again = docs.repartition(3, "doc_id")
    assert again.count() == docs.count() and shuffles() - before  # what is not stored is left to Spark


def test_lists_are_made_and_joined_in_parts(spark, docs, texts, monkeypatch):
    """No two parts share a word, and a part's list is deleted as soon as it is joined."""
    met, alive, most = [], set(), []
    stored, discard = lines.stored, lines.discard

    def storing(df, name, *more):
        table = stored(df, name, *more)
        if name == "met":
            met.append({r.word for r in table.select("word").distinct().collect()})
            alive.add(table.stored_at)
        if name == "pairs":
            most.append(len(alive))
        return table

    monkeypatch.setattr(lines, "stored", storing)
    monkeypatch.setattr(lines, "discard", lambda t: (alive.discard(t.stored_at), discard(t)))
    dedup_lines(docs).collect()
    assert len(met) == lines.PARTS and len(set().union(*met)) == sum(map(len, met)) > 0
    assert most == [4, 4, 3, 2, 1, 0]
