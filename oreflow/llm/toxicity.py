"""Toxicity of texts: subword-bag embeddings averaged into a linear softmax, trained jointly in numpy.

A word is the bag of its byte n-grams between end marks, hashed to a table of embeddings, so that misspelt words
share most vectors with the words they come from. The vectors of a word are averaged, then those of a chunk, any run
of consecutive words, and a softmax over the average gives the chunk's score. A text scores as its highest chunk:
an insult in a long text counts as much as in a short one. Only texts carry labels, so training gives each text's
gradient to its chunks in proportion to a softmax over their scores. The vectors start along the softmax, by the
log odds of their n-grams; then both learn together, by gradient steps with momentum.

The model is fitted on a bounded sample of labelled rows (``PER_CLASS``, those with the smallest hash of their id).
The two classes' softmax over an average is linear in the n-grams, so scoring needs one number per table row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreflow.llm.words import Words, mix, rolling, slices

#: Most labelled texts of each class that a model is fitted on.
PER_CLASS = 2000
ROWS = 1 << 18
SIZE = 8
GRAMS = (3, 4, 5, 6, 7)
CHUNK = 2
#: N-grams of fewer training texts than this are not learnt.
LEAST_TEXTS = 4
#: Texts whose weight the prior odds have, and the first bias.
PRIOR_TEXTS = 20
START_BIAS = -3.0
STEPS = 100
BATCH = 256
#: Texts that are cut to words, words whose n-grams are looked at, and table rows that are moved, at once; they bound
#: the memory of a fit, which is the driver's.
TEXTS_AT_ONCE = 100
ROWS_AT_ONCE = 1 << 14
#: Bytes of texts that are scored at once; their words' n-grams take some hundred times as much memory.
SCORED_BYTES = 1 << 19
WORDS_AT_ONCE = 2_000
RATE = 4.0
DECAY = 1e-4
HELD_OUT = 5


@dataclass(frozen=True)
class Model:
    """One number per table row, and the bias; a chunk's logit is the mean over words of their rows' mean."""

    rows: np.ndarray
    bias: float


def word_rows(words: Words, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Table rows of the n-grams of some words, and where each word's begin; the whole word is one of them."""
    length = words.end[at] - words.start[at]
    begin = np.concatenate([[0], np.cumsum(length + 2)])
    text = np.full(begin[-1], ord("<"), np.uint64)
    inside = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
    text[inside + np.repeat(begin[:-1] + 1, length)] = words.data[inside + np.repeat(words.start[at], length)]
    text[begin[1:] - 1] = ord(">")
    first, last, owner = [begin[:-1]], [begin[1:]], [np.arange(len(at))]
    for n in GRAMS:
        count = np.maximum(length + 2 - n, 0)  # the whole is there anyway
        place = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(begin[:-1], count)
        first.append(place)
        last.append(place + n)
        owner.append(np.repeat(np.arange(len(at)), count))
    owner = np.concatenate(owner)
    order = np.argsort(owner, kind="stable")
    hashed = mix(rolling(text + np.uint64(1), np.concatenate(first)[order], np.concatenate(last)[order]))
    return (hashed & np.uint64(ROWS - 1)).astype(np.int64), np.searchsorted(owner[order], np.arange(len(at) + 1))


def distinct(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """One place of each different word, and for every word which of them it is."""
    _, at, which = np.unique(words.hashes(), return_index=True, return_inverse=True)
    return at, which


def chunks(first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and size of each chunk in words, and where each text's chunks begin; a text without words has none.

    Every run of CHUNK words is a chunk; a shorter text is one.
    """
    words = np.diff(first)
    count = np.where(words > 0, np.maximum(words - CHUNK + 1, 1), 0)
    begin = np.concatenate([[0], np.cumsum(count)])
    number = np.arange(begin[-1]) - np.repeat(begin[:-1], count)
    return np.repeat(first[:-1], count) + number, np.repeat(np.minimum(words, CHUNK), count), begin


def chunk_sums(values: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Sum of the word values of each chunk."""
    total = values[start]
    for k in range(1, CHUNK):
        total += np.where(size > k, values[np.minimum(start + k, len(values) - 1)], 0)
    return total


def means(values: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Mean of each run of values; begin has the end of the last one too, no run is empty."""
    if len(begin) < 2:
        return np.zeros(0)
    return np.add.reduceat(values, begin[:-1]) / np.diff(begin)


def scores(model: Model, texts: pa.Array) -> np.ndarray:
    """Probability of label 1 of each text."""
    words = Words(texts, lower=True)
    logit = np.full(len(texts), -np.inf)
    if len(words.start):
        at, which = distinct(words)
        rows, begin = word_rows(words, at)
        word = means(model.rows[rows].astype(np.float64), begin)
        start, size, of = chunks(words.first)
        chunk = CHUNK * chunk_sums(word[which], start, size) / size
        some = np.flatnonzero(np.diff(of))
        logit[some] = np.maximum.reduceat(chunk, of[some])
    logit[np.isinf(logit)] = 0.0
    return 1 / (1 + np.exp(-np.clip(logit + model.bias, -30, 30)))


@dataclass
class Vocabulary:
    """The different words of some texts, numbered: their table rows, and in how many texts of each class they are.

    Words and n-grams are only held as numbers, a block of words at a time is cut to n-grams.
    """

    which: np.ndarray  #: number of each word of the texts
    first: np.ndarray  #: where each text's words begin
    rows: np.ndarray  #: table rows of the n-grams of all different words
    begin: np.ndarray  #: where each word's rows begin
    texts_of: tuple[np.ndarray, np.ndarray]  #: texts of class 0 and 1 that hold each different word


def vocabulary(texts: pa.Array | pa.ChunkedArray, y: np.ndarray) -> Vocabulary:
    seen, number = np.zeros(0, np.uint64), np.zeros(0, np.int32)  # hashes of words, ascending, and the words' numbers
    which, count = [np.zeros(0, np.int32)], [np.zeros(1, np.int64)]
    parts, sizes, texts_of = [], [np.zeros(1, np.int64)], [np.zeros(0, np.int64)] * 2
    for k in range(0, len(texts), TEXTS_AT_ONCE):
        words = Words(texts.slice(k, TEXTS_AT_ONCE), lower=True)
        hashes, at, own = np.unique(words.hashes(), return_index=True, return_inverse=True)
        count.append(words.counts())
        place = np.searchsorted(seen, hashes)
        new = np.ones(len(hashes), bool)
        new[place < len(seen)] = seen[place[place < len(seen)]] != hashes[place < len(seen)]
        for n in range(0, new.sum(), WORDS_AT_ONCE):
            found, begin = word_rows(words, at[new][n : n + WORDS_AT_ONCE])
            parts.append(found.astype(np.int32))
            sizes.append(np.diff(begin))
        number = np.insert(number, place[new], np.arange(len(seen), len(seen) + new.sum(), dtype=np.int32))
        seen = np.insert(seen, place[new], hashes[new])
        own = number[np.searchsorted(seen, hashes)][own].astype(np.int32)
        which.append(own)
        pair = np.unique(np.repeat(np.arange(len(count[-1])), count[-1]) * len(seen) + own)
        label = y[k : k + TEXTS_AT_ONCE][pair // max(len(seen), 1)]
        for c in (0, 1):
            more = np.bincount(pair[label == c] % max(len(seen), 1), minlength=len(seen))
            more[: len(texts_of[c])] += texts_of[c]
            texts_of[c] = more
    begin = np.cumsum(np.concatenate(sizes))
    rows = np.empty(begin[-1], np.int32)
    end = len(rows)
    while parts:  # each part goes as soon as it is copied
        part = parts.pop()
        rows[end - len(part) : end] = part
        end -= len(part)
    return Vocabulary(np.concatenate(which), np.cumsum(np.concatenate(count)), rows, begin, tuple(texts_of))


def grams_of(words: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the n-grams of some words, the word (0, 1, ...) of each, and the words' numbers of n-grams."""
    count = begin[words + 1] - begin[words]
    place = np.arange(count.sum()) + np.repeat(begin[words] - (np.cumsum(count) - count), count)
    return place, np.repeat(np.arange(len(words)), count), count


def blocks(n: int, size: int) -> Iterator[slice]:
    return (slice(k, min(k + size, n)) for k in range(0, n, size))


def descend(p: np.ndarray, grad: np.ndarray, momentum: np.ndarray) -> None:
    momentum += 0.1 * (grad - momentum)
    p -= RATE * (momentum + DECAY * p)


def fit(texts: list[str] | pa.Array | pa.ChunkedArray, labels: list[int], seed: int = 0) -> Model:
    """Fit embeddings and softmax on texts with labels 0 and 1."""
    rng = np.random.default_rng(seed)
    y = np.array(labels, np.float64)
    found = vocabulary(pa.array(texts, pa.large_string()) if isinstance(texts, list) else texts, y)
    which, first, rows, begin = found.which, found.first, found.rows, found.begin
    if len(begin) < 2:
        return Model(np.zeros(ROWS, np.float32), 0.0)
    # only n-grams of enough texts are learnt; the others stay zero, all in one row of their own
    texts_of = [np.zeros(ROWS), np.zeros(ROWS)]
    for at in blocks(len(begin) - 1, WORDS_AT_ONCE):
        own = rows[begin[at.start] : begin[at.stop]]
        for n, total in zip(found.texts_of, texts_of):
            total += np.bincount(own, np.repeat(n[at], np.diff(begin[at.start : at.stop + 1])), ROWS)
    known = np.flatnonzero(texts_of[0] + texts_of[1] >= LEAST_TEXTS)
    compact = np.full(ROWS, len(known), np.int32)
    compact[known] = np.arange(len(known), dtype=np.int32)
    for at in blocks(len(rows), ROWS):
        rows[at] = compact[rows[at]]
    # first vectors: along the softmax by the n-gram's log odds, less sure the fewer texts have it
    seen = texts_of[0][known], texts_of[1][known]
    odds = np.log((seen[1] + 1) / (y.sum() + 2)) - np.log((seen[0] + 1) / (len(y) - y.sum() + 2))
    odds *= (seen[0] + seen[1]) / (seen[0] + seen[1] + PRIOR_TEXTS)
    softmax = rng.uniform(-1, 1, SIZE)
    softmax /= np.sqrt(softmax @ softmax)
    table = rng.uniform(-1, 1, (len(known) + 1, SIZE))
    table /= 100
    for at in blocks(len(known), ROWS_AT_ONCE):
        table[at] += np.outer(odds[at], softmax)
    table[-1] = 0
    bias = np.full(1, START_BIAS)
    share = np.where(y == 1, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1)) * len(y)
    state = [np.zeros_like(p) for p in (table, softmax, bias)]
    with_words = np.flatnonzero(np.diff(first))
    for step in range(1, STEPS + 1):
        sharp = 2.0
        batch = rng.choice(with_words, min(BATCH, len(with_words)), replace=False)
        own = np.concatenate([which[first[k] : first[k + 1]] for k in batch])
        start, size, of = chunks(np.concatenate([[0], np.cumsum(np.diff(first)[batch])]))
        used, local = np.unique(own, return_inverse=True)
        value = table @ softmax
        word = np.empty(len(used))
        for at in blocks(len(used), WORDS_AT_ONCE):
            place, gram_of, count = grams_of(used[at], begin)
            word[at] = np.bincount(gram_of, value[rows[place]], len(count)) / count
        logit = CHUNK * chunk_sums(word[local], start, size) / size + bias[0]
        # each text's gradient goes to its chunks by their scores
        text_of = np.repeat(np.arange(len(batch)), np.diff(of))
        peak = np.maximum.reduceat(logit, of[:-1])
        pull = np.exp(sharp * (logit - peak[text_of]))
        pull /= np.add.reduceat(pull, of[:-1])[text_of]
        whole = np.add.reduceat(pull * logit, of[:-1])
        error = (1 / (1 + np.exp(-np.clip(whole, -30, 30))) - y[batch]) * share[batch] / len(batch)
        to_chunk = error[text_of] * pull
        to_place = np.zeros(len(local))
        for k in range(CHUNK):
            inside = size > k
            to_place += np.bincount(start[inside] + k, (CHUNK * to_chunk / size)[inside], len(local))
        to_word = np.bincount(local, to_place, len(used))
        to_row = np.zeros(len(table))
        for at in blocks(len(used), WORDS_AT_ONCE):
            place, gram_of, count = grams_of(used[at], begin)
            np.add.at(to_row, rows[place], (to_word[at] / count)[gram_of])
        to_row[-1] = 0
        grads = [table.T @ to_row, np.array([error.sum()])]
        # plain gradient steps: n-grams that agree in many texts outrun those of a few
        for at in blocks(len(table), ROWS_AT_ONCE):
            descend(table[at], np.outer(to_row[at], softmax), state[0][at])
        for p, g, m in zip((softmax, bias), grads, state[1:]):
            descend(p, g, m)
    value = np.zeros(ROWS, np.float32)
    value[known] = (table @ softmax)[:-1]
    return Model(value, float(bias[0]))


def training_sample(docs: DataFrame, labels: DataFrame, id: str, text: str, label: str, per_class: int) -> DataFrame:
    """(text, label): at most so many labelled texts of each class, none that are held out."""
    marked = labels.select(F.col(id).alias("id"), F.col(label).alias("label")).where("id is not null")
    marked = marked.where(F.col("label").isin(0, 1)).groupBy("id").agg(F.max("label").alias("label"))
    marked = marked.where(~held_out("id")).withColumn("order", F.xxhash64("id"))
    chosen = [marked.where(F.col("label") == k).orderBy("order", "id").limit(per_class) for k in (0, 1)]
    chosen = F.broadcast(chosen[0].unionByName(chosen[1]))  # twice ``per_class`` rows at most
    own = docs.select(F.col(id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    found = own.join(chosen, "id").groupBy("id").agg(F.min("text").alias("text"), F.first("label").alias("label"))
    return found.orderBy("id").select("text", "label")


def held_out(id: str, folds: int = HELD_OUT):
    return F.crc32(F.col(id).cast("string").cast("binary")) % folds == 0


def train(
    docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "toxic",
    per_class: int = PER_CLASS,
) -> Model:
    """A model from the labelled rows that are not held out; without any, one that scores everything one half."""
    sample = training_sample(docs, labels, id, text, label, per_class).toArrow()
    return fit(sample["text"], sample["label"].to_pylist())


def score_toxicity(
    docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "toxic",
    model: Model | None = None,
) -> DataFrame:
    """(id, held_out, score, predicted) per row; only the text decides the score.

    Defined cases. Null and empty texts, and texts without words, score by the bias alone. A null id is not held
    out. Repeated rows repeat their result; if they train, the alphabetically first text of an id does. Labels
    other than 0 and 1, null ones too, are not learnt from; an id labelled both is toxic. An empty table gives an
    empty result. Columns other than the named ones are not read.
    """
    model = model or train(docs, labels, id, text, label)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", SCORED_BYTES):
            score = scores(model, part.column(2))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(score), pa.array((score >= 0.5).astype(np.int32))],
                names=[id, "held_out", "score", "predicted"],
            )

    kind = docs.schema[id].dataType.simpleString()
    own = docs.select(F.col(id), F.coalesce(held_out(id), F.lit(False)).alias("held_out"), F.col(text).alias("text"))
    return own.mapInArrow(rows, f"`{id}` {kind}, held_out boolean, score double, predicted int")
