"""Operators that look at one text at a time, and the benchmark search."""

import gzip
import hashlib
import random
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from oreflow.llm import leaks, licenses, packing, personal, toxicity, warc
from oreflow.llm.leaks import decontaminate
from oreflow.llm.personal import base_spans, find_personal
from oreflow.llm.quality import quality_rules
from oreflow.llm.words import Words, windows

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_words_and_hashes(texts):
    w = Words(pa.array(texts))
    for k, t in enumerate(texts):
        own = range(w.first[k], w.first[k + 1])
        assert [w.data[w.start[i] : w.end[i]].tobytes().decode() for i in own] == WORD.findall(t or "")
    assert len(np.unique(w.hashes())) == len({x for t in texts for x in WORD.findall(t or "")})
    grams, begin = windows(w.hashes(), w.first, 3)
    want = [tuple(x[i : i + 3]) for t in texts for x in [WORD.findall(t or "")] for i in range(len(x) - 2)]
    assert len(grams) == len(want) and len(np.unique(grams)) == len(set(want))


def test_tokens_are_those_of_the_tokenizer(texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    reference = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    reference.encode_special_tokens = True
    ids = packing.encoder(packing.vocabulary())
    more = ["a  b\n\n c\t", "it's   <|endoftext|> x", " ", "1234 don't　x", "é\r\n\r\nz"]
    for t in [t or "" for t in texts] + more:
        assert ids(t) == reference.encode(t, add_special_tokens=False).ids


def test_added_tokens_are_those_of_the_tokenizer(spark, texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    reference = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = packing.encoder(packing.vocabulary(), packing.added_tokens())
    more = ["a <|endoftext|> b", "<|endoftext|>  <|endoftext|><|endoftext|>b", "it's   <|endoftext|>   x", "<|endoftext|>", "<|ENDOFTEXT|> <|endoftext"]
    for t in [t or "" for t in texts] + more:
        assert ids(t) == reference.encode(t, add_special_tokens=False).ids
    assert ids(more[0]) == [64, 220, 50256, 275]
    rows = packing.tokenise(spark.createDataFrame(list(enumerate(more)), "doc_id BIGINT, text STRING")).collect()
    for r in rows:
        assert np.frombuffer(r.ids, "<u4").tolist() == [*reference.encode(more[r.doc_id], add_special_tokens=False).ids, packing.END]


def test_packing(docs, odd_docs, no_docs, texts):
    rows = packing.pack_documents(docs, length=64).collect()
    ids = packing.encoder(packing.vocabulary())
    own = {k: [*ids(t or ""), 0] for k, t in enumerate(texts)}
    pieces, places = {}, {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
        part = np.array(own[r.doc_id][r.start : r.start + r.length], "<u4").tobytes()
        assert r.ids_crc32 == zlib.crc32(part)
    for k, found in pieces.items():
        found.sort(key=lambda r: r.piece)
        assert [r.piece for r in found] == list(range(len(found)))
        assert [r.start for r in found] == [sum(x.length for x in found[:n]) for n in range(len(found))]
        assert sum(r.length for r in found) == len(own[k]) and all(r.length == 64 for r in found[1:])
    for found in places.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at
            at += length
        assert at <= 64
    least = -(-sum(map(len, own.values())) // 64)
    assert len(pieces) == len(texts) and len(places) <= least + 2
    assert packing.pack_documents(odd_docs).count() == odd_docs.count()
    assert packing.pack_documents(no_docs).count() == 0


def test_sequences_hold_the_ids(docs, texts):
    ids = packing.encoder(packing.vocabulary())
    rows = packing.sequences(docs, length=256).collect()
    total = sum(len(r.ids) // 4 for r in rows)
    assert total == sum(len(ids(t or "")) + 1 for t in texts) and max(len(r.ids) for r in rows) <= 1024


def test_local_search_empties_sequences():
    lengths = np.array([6, 4, 4, 3, 3, 5, 5])
    bins = [[0, 3], [1, 2], [4, 5], [6]]  # 9, 8, 8, 5 of 10: three suffice
    search = packing.Search(lengths, bins, 10)
    search.run(10)
    left = [b for b in search.bins if b]
    assert len(left) == 3 and sorted(i for b in left for i in b) == list(range(7))
    assert all(lengths[b].sum() <= 10 for b in left)
    rng = np.random.default_rng(0)
    for _ in range(20):
        lengths = rng.integers(1, 101, 200)
        sequence, offset = packing.place(lengths, 100)
        assert np.bincount(sequence, lengths).max() <= 100
        assert sequence.max() + 1 <= len(packing.best_fit(lengths, 100))


def toxic_texts(n, seed):
    rng = random.Random(seed)
    syllables = ["ba", "no", "ti", "re", "lu", "sha", "ko", "mi"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(1, 4)))
    out = []
    for k in range(n):
        words, label = [word() for _ in range(rng.randint(20, 200))], int(k % 3 == 0)
        if label:
            for _ in range(3):
                words[rng.randrange(len(words))] = rng.choice(["grumpfel", "zworkig", "vlixen"]) + rng.choice(["", "s", "er"])
        out.append((" ".join(words), label))
    return out


def test_toxicity_model():
    rows = toxic_texts(240, 1)
    model = toxicity.fit([t for t, _ in rows], [y for _, y in rows])
    test = toxic_texts(120, 2)
    score = toxicity.scores(model, pa.array([t for t, _ in test] + [None, "", "ba zworkiger no"]))
    assert np.mean((score[:120] >= 0.5) == [y for _, y in test]) > 0.97
    assert score[120] == score[121] < 0.5 < score[122]  # unseen forms share n-grams


def test_toxicity_fit_takes_little_memory():
    """The driver fits the model: no array but the n-grams of all words, the table and its momentum is large."""
    texts = [" ".join(f"wordy{(k * 400 + j) * 7919}s" for j in range(400)) for k in range(200)]
    tracemalloc.start()
    model = toxicity.fit(texts, [k % 2 for k in range(200)])
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert model.rows.any() and peak < 150e6


def test_toxicity_wherever_a_phrase_begins():
    """A neutral word in front changes nothing: every run of two words is scored."""
    rows = toxicity.Words(pa.array(["zwo grum ba"]))
    where, begin = toxicity.word_rows(rows, np.arange(3))
    value = np.zeros(toxicity.ROWS, np.float32)
    for k, weight in enumerate((2, 2, -3)):
        value[where[begin[k] : begin[k + 1]]] = weight
    model = toxicity.Model(value, -3.0)
    texts = [f"{'qqq ' * n}ba zwo grum ba{' qqq' * m}" for n in range(4) for m in range(3)]
    assert len({round(x, 6) for x in toxicity.scores(model, pa.array(texts)).tolist()}) == 1
    assert toxicity.scores(model, pa.array(texts[:1]))[0] > 0.5
    rows = toxic_texts(240, 1)
    model = toxicity.fit([t for t, _ in rows], [y for _, y in rows])
    test = [t for t, _ in toxic_texts(120, 2)]
    plain, moved = (toxicity.scores(model, pa.array(x)) >= 0.5 for x in (test, ["qqq " + t for t in test]))
    assert (plain == moved).all()
    start, size, of = toxicity.chunks(np.array([0, 3, 3, 4, 6]))
    assert (start.tolist(), size.tolist(), of.tolist()) == ([0, 1, 3, 4], [2, 2, 1, 2], [0, 2, 2, 3, 4])


def test_toxicity_of_tables(spark, docs, no_docs):
    rows = [(k, t) for k, (t, _) in enumerate(toxic_texts(90, 3))] + [(None, "ba"), (4, "no ti"), (5, None)]
    table = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    labels = [(k, int(k % 3 == 0)) for k in range(90)] + [(3, None), (1, 7), (None, 1), (1000, 1)]
    labels = spark.createDataFrame(labels, "doc_id BIGINT, toxic INT")
    got = toxicity.score_toxicity(table, labels).collect()
    assert len(got) == len(rows)
    for r in got:
        held = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0
        assert r.held_out == held and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
    sample = toxicity.training_sample(table, labels, "doc_id", "text", "toxic", 10).collect()
    assert Counter(r.label for r in sample) == {0: 10, 1: 10}
    assert toxicity.score_toxicity(no_docs, labels.limit(0)).count() == 0
    assert {r.score for r in toxicity.score_toxicity(docs, labels.limit(0)).collect()} == {0.5}


def test_personal_patterns():
    text = "a@b.c, x.y+z@mail-1.example.com; 300.1.1.1, 10.0.0.255, 4111 1111-1111 1111, +1 (017) 555-7713, 4111111111111112"
    assert [(k, text[a:b]) for a, b, k in base_spans(text)] == [
        ("email", "a@b.c"), ("email", "x.y+z@mail-1.example.com"), ("ip", "10.0.0.255"), ("card", "4111 1111-1111 1111"),
        ("phone", "+1 (017) 555-7713"),
    ]
    assert base_spans("1" * 10_000 + ".1.1.1") == []


def personal_texts(n, seed):
    rng = random.Random(seed)
    digits = lambda k: "".join(rng.choice("0123456789") for _ in range(k))

    def card():
        body = digits(15)
        return next(body + c for c in "0123456789" if personal.luhn(body + c))

    make = [
        lambda: f"tom{digits(2)}@mail{digits(1)}.example.com",
        lambda: ".".join(str(rng.randrange(256)) for _ in range(4)),
        card,
        lambda: f"+1 ({digits(3)}) 555-{digits(4)}",
        lambda: f"{digits(2)}.{digits(1)}",
        lambda: digits(5),
    ]
    return [f"ba no tire lu {rng.choice(make)()} sha no {rng.choice(make)()} re." for _ in range(n)]


def test_field_finds_the_patterns_spans_and_more():
    field = personal.Field.fit(personal_texts(150, 1))
    hits = total = wrong = 0
    for text in personal_texts(80, 2):
        base = set(base_spans(text))
        got = set(personal.added_spans(field, text, []))
        hits, total, wrong = hits + len(base & got), total + len(base), wrong + len(got - base)
    assert hits > 0.95 * total and wrong < 0.05 * total
    # two numbers in a row are one match of the pattern, which fails; the field parts them
    text = "no +1 (017) 555-7713 10.20.30.40 re"
    assert [k for _, _, k in base_spans(text)] == ["ip"]
    added = personal.added_spans(field, text, base_spans(text))
    assert [(text[a:b], k) for a, b, k in added] == [("+1 (017) 555-7713", "phone")]
    assert personal.Field.fit(["no 12 ba"]).decode(personal.Lattice("call 12 a@b.c")) == []


def test_personal_tables(spark, odd_docs, no_docs):
    rows = list(enumerate(personal_texts(40, 3))) + [(100, None), (101, ""), (102, "x" * 50_000 + " a@b.de"), (0, "tel 5")]
    got = find_personal(spark.createDataFrame(rows, "doc_id BIGINT, text STRING")).collect()
    want = Counter((k, tuple(base_spans(t or ""))) for k, t in rows)
    assert Counter((r.doc_id, tuple((s.start, s.end, s.kind) for s in r.base)) for r in got) == want
    assert all(set(r.base) <= set(r.spans) for r in got)
    assert find_personal(odd_docs).count() == odd_docs.count() and find_personal(no_docs).count() == 0


def test_field_sample_has_no_copies(spark):
    stretches = [f"no {k} ba" for k in range(20)]
    docs = spark.createDataFrame([(t,) for t in stretches for _ in range(30)], "text STRING")
    assert sorted(personal.sample_surroundings(docs, "text", 20)) == sorted({t[a:b] for t in stretches for a, b in personal.surroundings(t)})


def base_figures(text):
    w = WORD.findall(text or "")
    count, again = Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4)), [False] * len(w)
    for k in range(len(w) - 4):
        if count[tuple(w[k : k + 5])] > 1:
            again[k : k + 5] = [True] * 5
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    failed = len(w) < 10 or 100 * sum(again) > 20 * len(w)
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), sum(again), failed


def test_quality(spark, docs, odd_docs, no_docs, texts):
    for r in quality_rules(docs).collect():
        got = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
        assert got == base_figures(texts[r.doc_id]), r.doc_id
        assert not (r.kept and r.base_failed) and 0 <= r.char_distance <= 1 and 0 <= r.word_distance <= 1
    assert quality_rules(odd_docs).count() == odd_docs.count() and quality_rules(no_docs).count() == 0
    rng = random.Random(4)
    plain = [" ".join(rng.choice(["the", "of", "and", "to", "house", "river", "green", "walks"]) for _ in range(300)) for _ in range(30)]
    strange = " ".join("".join(rng.choice("#%&$*") for _ in range(6)) for _ in range(300))
    rows = [(k, t, "en") for k, t in enumerate([*plain, strange])]
    got = {r.doc_id: r for r in quality_rules(spark.createDataFrame(rows, "doc_id BIGINT, text STRING, lang STRING")).collect()}
    assert not got[30].kept and not got[30].base_failed and got[30].char_distance > 0.5
    assert all(r.char_distance < 0.2 for k, r in got.items() if k < 30)


def leak_brute(texts, items):
    """Best (shared, mass) of every window of an item's length, all of them compared."""
    cut = lambda t: [w for w in re.split(r"""[\x20\x09-\x0D.,;:!?"'()\[\]]+""", (t or "").lower()) if w]
    grams = lambda w: [tuple(w[k : k + 5]) for k in range(len(w) - 4)]
    sets = {k: Counter(grams(cut(t))) for k, t in items if len(cut(t)) > 4}
    held = Counter(g for s in sets.values() for g in s)
    weight = lambda g: min(8, 1 + int(np.floor(np.log2(len(sets) / held[g])))) if g in held else 8
    out = {}
    for d, t in enumerate(texts):
        own = grams(cut(t))
        for k, s in sets.items():
            n = sum(s.values())
            for a in range(len(own) - n + 1):
                if not any(g in s for g in own[a : a + n : max(1, n // 6)]):
                    continue
                w = Counter(own[a : a + n])
                shared = sum(weight(g) * min(c, s[g]) for g, c in w.items())
                mass = sum(weight(g) * max(w[g], s[g]) for g in set(w) | set(s))
                if 100 * shared >= 80 * mass:
                    out[d, k] = max(out.get((d, k), 0), shared / mass)
    return out


def test_leaks(spark, docs, odd_docs, no_docs, texts):
    long = texts[0].replace("\n", " ").split()
    items = [(1, texts[7].split("\n")[0]), (2, " ".join(long[:30])), (3, "Never seen " * 9), (4, None), (5, "too short")]
    items += [(6, " ".join(texts[44].split()[20:60])), (7, " ".join(long[5:40])), (2, " ".join(long[:30])), (8, "")]
    bench = spark.createDataFrame(items, "item_id BIGINT, text STRING").selectExpr("*", "1 AS key", "2 AS g")
    got = {(r.doc_id, r.item): r.shared / r.mass for r in decontaminate(docs, bench).collect()}
    want = leak_brute(texts, list(dict(items).items()))
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in want)
    assert {(0, 2), (0, 7), (44, 6)} <= want.keys()
    assert decontaminate(docs, bench.limit(0)).count() == 0 and decontaminate(no_docs, bench).count() == 0
    assert {r.doc_id for r in decontaminate(odd_docs, bench).collect()} >= {None, 0}


def made_items(n, size=64):
    """Items of words that no other has."""
    return [" ".join(f"w{k}x{i}" for i in range(size)) for k in range(n)]


@pytest.mark.parametrize("n", [1, 40, 200])
def test_leaks_with_a_word_changed(spark, n):
    """A changed word in the middle takes 5 of 60 n-grams: 55 of 65, whatever the number of items."""
    items = made_items(n)
    bench = spark.createDataFrame(list(enumerate(items)), "item_id BIGINT, text STRING")
    copies = [(k, " ".join("changed" if i == 32 else w for i, w in enumerate(t.split()))) for k, t in enumerate(items[:10])]
    got = decontaminate(spark.createDataFrame(copies, "doc_id BIGINT, text STRING"), bench).collect()
    assert sorted((r.doc_id, r.item) for r in got) == [(k, k) for k, _ in copies]
    assert all(abs(r.shared / r.mass - 55 / 65) < 1e-12 for r in got)


def test_leaks_of_cut_items(spark):
    """Items without their first or last words, as whole texts and at the ends of longer ones."""
    items = made_items(10, 50)
    bench = spark.createDataFrame(list(enumerate(items)), "item_id BIGINT, text STRING")
    other, docs = " ".join(f"v{i}" for i in range(70)), []
    for k, t in enumerate(items):
        w, cut = t.split(), 1 + k // 4
        first, last = " ".join(w[cut:]), " ".join(w[:-cut])
        docs += [(k, first), (k, last), (k, f"{first} {other}"), (k, f"{other} {last}"), (k, f"{other} {t} {other}")]
    table = spark.createDataFrame([(100 * n + k, t) for n, (k, t) in enumerate(docs)], "doc_id BIGINT, text STRING")
    got = {r.doc_id: r for r in decontaminate(table, bench).collect()}
    assert sorted(got) == [100 * n + k for n, (k, _) in enumerate(docs)]
    for n, (k, t) in enumerate(docs):
        r, left = got[100 * n + k], 50 - (n % 5 < 4) * (1 + k // 4)
        assert (r.item, r.n_words) == (k, left) and abs(r.shared / r.mass - (left - 4) / 46) < 1e-12
        assert t.split()[r.first_word : r.first_word + left] == [x for x in t.split() if x[0] == "w"]


def every_window(text, item):
    """Largest plain similarity of an item and any window of its size."""
    grams = lambda w: [tuple(w[k : k + 5]) for k in range(len(w) - 4)]
    own, want = grams(text.split()), Counter(grams(item.split()))
    n, best = sum(want.values()), 0.0
    for a in range(max(1, len(own) - n + 1)):
        have = Counter(own[a : a + n])
        best = max(best, sum((have & want).values()) / sum((have | want).values()))
    return best


def test_leaks_with_parts_in_another_order(spark):
    """Recall over all item-sized windows: halves and thirds swapped, sentences dropped and put in, inside other text."""
    rng = random.Random(9)
    items = made_items(60, 120)
    bench = spark.createDataFrame(list(enumerate(items)), "item_id BIGINT, text STRING")
    docs = []
    for k, t in enumerate(items):
        w = t.split()
        cut = sorted(rng.sample(range(20, 100), 1 + k % 2))
        parts = [w[a:b] for a, b in zip([0, *cut], [*cut, 120])]
        rng.shuffle(parts)
        if k % 3 == 0:
            parts.insert(1, [f"in{k}x{i}" for i in range(rng.randrange(8))])
        before, after = ([f"o{k}x{i}" for i in range(rng.randrange(200))] for _ in range(2))
        docs.append((k, " ".join(before + sum(parts, []) + after)))
    got = {(r.doc_id, r.item) for r in decontaminate(spark.createDataFrame(docs, "doc_id BIGINT, text STRING"), bench).collect()}
    similar = [k for k, t in docs if every_window(t, items[k]) >= 0.8]
    assert len(similar) > 40 and all(a == b for a, b in got)
    assert sum((k, k) in got for k in similar) >= 0.95 * len(similar)


def test_leaks_at_the_bound(spark):
    """A changed word in the middle of 49 leaves 40 of 50 n-grams, whatever bits of the fingerprint it turns."""
    items = made_items(200, 49)
    bench = spark.createDataFrame(list(enumerate(items)), "item_id BIGINT, text STRING")
    copies = [(k, " ".join("changed" if i == 20 else w for i, w in enumerate(t.split()))) for k, t in enumerate(items)]
    docs = spark.createDataFrame(copies, "doc_id BIGINT, text STRING")
    got = decontaminate(docs, bench).collect()
    assert sorted((r.doc_id, r.item) for r in got) == [(k, k) for k, _ in copies]
    assert {(r.shared * 50, r.mass * 40) for r in got} == {(r.shared * 50,) * 2 for r in got}
    assert leaks.leaks(docs, bench, radius=0).select("item").distinct().count() == len(items)


def test_blocks_find_every_print_within_the_radius():
    rng = random.Random(1)
    patterns = set(leaks.flips(15, 8))
    for _ in range(300):
        flipped = 0
        for bit in rng.sample(range(64), 15):
            flipped |= 1 << bit
        assert any((flipped >> (8 * k)) & 255 in patterns for k in range(8))


def test_license_alignment(spark, docs, odd_docs, no_docs):
    assert licenses.align(list("axbyc"), list("abc")) == [(0, 0), (2, 1), (4, 2)]
    assert licenses.ascending([(0, 3), (1, 0), (2, 1), (3, 4)]) == [(1, 0), (2, 1), (3, 4)]
    mit = licenses.TEMPLATES["MIT-text"]
    edited = mit.replace("furnished to do so", "given").replace("Software without", "program\nwithout")
    rows = [(1, f"no ba {mit} re"), (2, f"ti {edited}"), (3, "Released under the MIT  License"), (4, None), (5, ""),
            (6, "Released under the other License. " * 500), (3, "Licensed under CC BY-NC 4.0. x Released under the MIT License.")]
    got = licenses.scan_licenses(spark.createDataFrame(rows, "doc_id BIGINT, text STRING")).collect()
    assert Counter((r.doc_id, r.license) for r in got) == {
        (1, "MIT-text"): 1, (2, "MIT-text"): 1, (3, "MIT"): 2, (3, "CC-BY-NC-4.0"): 1
    }
    whole = next(r for r in got if r.doc_id == 1)
    assert whole.matched == whole.n_template == whole.end_word - whole.first_word and whole.first_word == 2
    assert licenses.scan_licenses(odd_docs).count() == 0 and licenses.scan_licenses(no_docs).count() == 0


@pytest.fixture(scope="module")
def pages(spark):
    big, other = "<p>é" + "x" * 2000, "y" * 1000
    rows = [(1, "http://a.example.com/x", big), (2, "https://B.a.org", big), (9, "http://a.example.com/x", big), (3, None, None),
            (4, "http://a.example.com/y?q=1", "small"), (5, "weird\r\nurl", "small"), (6, "", other), (7, "http://z.com", other),
            (None, "http://n.com", "\r\n\r\nWARC/1.1\r\n"), (8, "http://l.com", "long " * 300_000), (9, "http://a.example.com/x", big)]
    return spark.createDataFrame(rows, "page_id BIGINT, url STRING, html STRING").selectExpr("*", "1 AS key", "2 AS digest")


def test_archives(pages, spark):
    rows = [(r.page_id, r.html) for r in pages.collect()]
    got = warc.round_trip(pages).collect()
    assert len(got) == len(rows)
    for page, html in rows:
        raw = (html or "").encode()
        best = max((p for p, h in rows if h == html and p is not None), default=None)
        revisit = len(raw) >= 1000 and page != best
        found = [r for r in got if r.page_id == page]
        assert {(r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found} == {
            (len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if revisit else "response", best if revisit else None)
        }
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_index_looks_up_single_addresses(pages, spark):
    captures = warc.write_archives(pages)
    index = warc.CaptureIndex.build(captures, block_lines=2, part_lines=3)
    urls = spark.createDataFrame([("http://a.example.com/x",), ("http://not.there",), ("http://z.com",)], "url STRING")
    got = Counter((r.key, r.page) for r in index.lookup(urls).collect())
    key = "com,example,a)/x"
    assert got == {(key, "1"): 1, (key, "9"): 2, ("com,z)", "7"): 1}
    fs, root = warc.filesystem(captures.archives)
    row = captures.first()
    with fs.open_input_file(f"{root}/{row.file}") as f:
        fields, _ = warc.parse(gzip.decompress(f.read_at(row.length, row.offset)))
    assert fields["WARC-Record-ID"] == f"<urn:page:{row.page or ''}>"
    with pytest.raises(ValueError):
        warc.parse(b"WARC/1.1\r\nContent-Length: 5\r\n\r\nab")


def test_search_needs_fewer_sequences_than_best_fit():
    """Lengths of which two or three fill a sequence badly: exchanges empty sequences that best fit had to open."""
    rng = np.random.default_rng(4)
    saved = 0
    for n in (300, 600, 1000):
        lengths = rng.integers(500, 1100, n)
        first = len(packing.best_fit(lengths, 2048))
        sequence, offset = packing.place(lengths, 2048)
        used = int(sequence.max()) + 1
        assert np.bincount(sequence, lengths).max() <= 2048 and used >= -(-lengths.sum() // 2048)
        ends = sorted(zip(sequence.tolist(), offset.tolist(), lengths.tolist()))
        assert all(a[1] + a[2] == b[1] for a, b in zip(ends, ends[1:]) if a[0] == b[0])
        assert used <= first
        saved += first - used
    assert saved >= 10
