"""Personal data in texts: fixed patterns, and a semi-Markov conditional random field that adds spans.

The patterns find addresses and numbers of fixed form. The field looks at the surroundings of digits and @ signs:
they are cut into atoms (letters, digits, spaces, other characters), and every run of at most ``LONGEST`` atoms that
holds a digit or @ is a candidate segment with features of the whole span: its shape, groups and number of digits,
check sum, parts, length, and the atoms around it. A dynamic program over segments, bounded by their longest
length, chooses boundaries and kinds together. The weights maximise the conditional likelihood of the patterns'
spans on a bounded sample of surroundings (``SAMPLE``), by forward and backward sums; as the features don't repeat
the patterns, the field also finds spans that look like them. What overlaps a pattern's span is not added.
"""

from __future__ import annotations

import bisect
import itertools
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
# The base patterns.
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# The same for searches in linear time. A match of ip begins where a run of digits does: if it fails there, it fails
# anywhere in the run. An email is looked for at its @.
_IP = re.compile(r"(?<![0-9])" + PATTERNS["ip"])
_CARD, _PHONE = re.compile(PATTERNS["card"]), re.compile(PATTERNS["phone"])
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
#: Surroundings that weights are fitted on, in order of their hashes.
SAMPLE = 400
EPOCHS = 12
RATE = 0.5
LONGEST = 16
AROUND = 40
#: Feature numbers are hashed to so many.
FEATURES = 1 << 14
PIECE = 2000
_HOT = re.compile(r"[0-9@]")
_ATOM = re.compile(r"[^\W\d_]+|[0-9]+|\s+|.", re.DOTALL)

Span = tuple[int, int, str]


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _passes(kind: str, found: str) -> bool:
    if kind == "ip":
        return all(len(p.lstrip("0")) <= 3 and int(p[-9:]) <= 255 for p in found.split("."))
    if kind == "card":
        digits = _digits(found)
        return 12 <= len(digits) <= 19 and luhn(digits)
    return kind != "phone" or 9 <= len(_digits(found)) <= 15


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of the email pattern: before an @ all that may stand there, back to the last match at most."""
    last, at = 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > last and text[begin - 1] in _LOCAL_CHARS:
            begin -= 1
        domain = _DOMAIN.match(text, at) if begin < at else None
        if domain:
            last = domain.end()
            yield begin, last
        at = text.find("@", at + 1)


def base_spans(text: str) -> list[Span]:
    """Spans of the patterns in a text: (start, end, kind), by start, then kind. Takes linear time."""
    if not _HOT.search(text):
        return []
    found = {
        "email": _emails(text),
        "ip": (m.span() for m in _IP.finditer(text)) if "." in text else (),
        "card": (m.span() for m in _CARD.finditer(text)),
        "phone": (m.span() for m in _PHONE.finditer(text)) if "+" in text else (),
    }
    out = [(a, order, b) for order, kind in enumerate(KINDS) for a, b in found[kind] if _passes(kind, text[a:b])]
    return [(start, end, KINDS[order]) for start, order, end in sorted(out)]


def surroundings(text: str) -> Iterator[tuple[int, int]]:
    """Stretches of a text from AROUND characters before to as many after digits and @ signs, cut where they get long."""
    first = last = None
    for m in _HOT.finditer(text):
        a, b = max(0, m.start() - AROUND), m.end() + AROUND
        if first is None:
            first, last = a, b
        elif a <= last and b - first <= PIECE:
            last = b
        else:
            yield first, min(last, len(text))
            first, last = max(a, min(last, m.start())), b
    if first is not None:
        yield first, min(last, len(text))


def _bucket(n: int) -> int:
    return n if n < 12 else 12 + min(8, n // 4)


class Lattice:
    """Candidate segments of one stretch of text with their feature numbers."""

    def __init__(self, text: str):
        self.atoms = [(m.start(), m.end()) for m in _ATOM.finditer(text)]
        words = [text[a:b] for a, b in self.atoms]
        self.number: dict[tuple[int, int], int] = {}
        self.features: list[list[int]] = []
        n = len(words)
        hot = [bool(_HOT.search(w)) for w in words]
        for i in range(n):
            if words[i].isspace():
                continue
            seen = False
            for j in range(i, min(n, i + LONGEST)):
                seen = seen or hot[j]
                if words[j].isspace() and "\n" in words[j]:
                    break
                if seen and not words[j].isspace():
                    self.number[i, j + 1] = len(self.features)
                    self.features.append(self._of(words, i, j + 1))
        self.n = n

    @staticmethod
    def _of(words: list[str], i: int, j: int) -> list[int]:
        own = words[i:j]
        text = "".join(own)
        digits = _digits(text)
        runs = [len(w) for w in own if w[0].isdigit()]
        kinds = "".join("9" if w[0].isdigit() else "a" if w[0].isalpha() else " " if w.isspace() else w for w in own)
        parts = text.split(".")
        octets = len(parts) == 4 and all(0 < len(p) < 4 and len(_digits(p)) == len(p) and int(p) < 256 for p in parts)
        before = words[i - 1] if i else "^"
        after = words[j] if j < len(words) else "$"
        names = [
            f"shape {kinds}",
            f"groups {'-'.join(map(str, runs[:6]))}",
            f"digits {_bucket(len(digits))}",
            f"atoms {_bucket(j - i)}",
            f"sum {len(digits) >= 12 and luhn(digits)} {_bucket(len(digits))}",
            f"octets {octets}",
            f"at {text.count('@')} {'.' in text.rpartition('@')[2]}",
            f"ends {kinds[0]} {kinds[-1]}",
            f"only {''.join(sorted(set(kinds)))}",
            f"before {before.isspace()} {before[-1:] if not before.isalnum() else ''}",
            f"after {after.isspace()} {after[:1] if not after.isalnum() else ''}",
            f"joined {before[-1:].isalnum()} {after[:1].isalnum()}",
        ]
        return [hash_name(x) for x in names]


def hash_name(name: str) -> int:
    return zlib.crc32(name.encode()) % FEATURES


class Field:
    """Weights of a semi-Markov conditional random field: label 0 is a single atom outside of any span."""

    def __init__(self, weights: np.ndarray | None = None, steps: np.ndarray | None = None):
        k = len(KINDS) + 1
        self.weights = np.zeros((k, FEATURES)) if weights is None else weights
        self.steps = np.zeros((k, k)) if steps is None else steps

    def _scores(self, lattice: Lattice) -> list[np.ndarray]:
        return [self.weights[:, f].sum(axis=1) for f in lattice.features]

    def _ending(self, lattice: Lattice) -> list[list[tuple[int, int]]]:
        """By end: (begin, number) of the candidate segments."""
        out: list[list[tuple[int, int]]] = [[] for _ in range(lattice.n + 1)]
        for (i, j), number in lattice.number.items():
            out[j].append((i, number))
        return out

    def decode(self, lattice: Lattice) -> list[tuple[int, int, int]]:
        """The best segmentation's spans: (first atom, end, label)."""
        scores, ending, k = self._scores(lattice), self._ending(lattice), len(KINDS) + 1
        best = np.full((lattice.n + 1, k), -np.inf)
        best[0, 0] = 0.0
        back: dict[tuple[int, int], tuple[int, int]] = {}
        for j in range(1, lattice.n + 1):
            came = best[j - 1] + self.steps[:, 0]
            best[j, 0], back[j, 0] = came.max(), (j - 1, int(came.argmax()))
            for i, number in ending[j]:
                came = best[i][:, None] + self.steps[:, 1:]
                total = came.max(axis=0) + scores[number][1:]
                for y in np.flatnonzero(total > best[j, 1:]):
                    best[j, y + 1] = total[y]
                    back[j, y + 1] = i, int(came[:, y].argmax())
        spans, j, y = [], lattice.n, int(best[lattice.n].argmax())
        while j:
            i, x = back[j, y]
            if y:
                spans.append((i, j, y))
            j, y = i, x
        return spans[::-1]

    def _gradient(self, lattice: Lattice, gold: dict[tuple[int, int], int]) -> tuple[dict, np.ndarray]:
        """Gradient of the log likelihood: by segment number for its features, and of the steps."""
        scores, ending, k = self._scores(lattice), self._ending(lattice), len(KINDS) + 1
        n = lattice.n
        ahead = np.full((n + 1, k), -np.inf)
        ahead[0, 0] = 0.0
        for j in range(1, n + 1):
            rows = [np.logaddexp.reduce(ahead[j - 1] + self.steps[:, 0])]
            inner = [
                np.logaddexp.reduce(ahead[i][:, None] + self.steps[:, 1:], axis=0) + scores[s][1:] for i, s in ending[j]
            ]
            rest = np.logaddexp.reduce(inner, axis=0) if inner else np.full(k - 1, -np.inf)
            ahead[j] = np.concatenate([rows, rest])
        behind = np.full((n + 1, k), -np.inf)
        behind[n] = 0.0
        starting: list[list[tuple[int, int]]] = [[] for _ in range(n + 1)]
        for j, found in enumerate(ending):
            for i, s in found:
                starting[i].append((j, s))
        total = np.logaddexp.reduce(ahead[n])
        steps = np.zeros((k, k))
        parts: dict[int, np.ndarray] = {}
        for i in range(n - 1, -1, -1):
            out = behind[i + 1, 0] + self.steps[:, 0]
            steps[:, 0] -= np.exp(ahead[i] + out - total)
            for j, s in starting[i]:
                via = self.steps[:, 1:] + (scores[s][1:] + behind[j, 1:])[None, :]
                p = np.exp(ahead[i][:, None] + via - total)
                steps[:, 1:] -= p
                parts[s] = -np.concatenate([[0.0], p.sum(axis=0)])
                out = np.logaddexp(out, np.logaddexp.reduce(via, axis=1))
            behind[i] = out
        j = last = 0
        while j < n:
            ends = [(e, y) for (i, e), y in gold.items() if i == j]
            end, label = ends[0] if ends else (j + 1, 0)
            steps[last, label] += 1
            if label:
                parts[lattice.number[j, end]][label] += 1
            j, last = end, label
        return parts, steps

    @classmethod
    def fit(cls, texts: list[str]) -> Field:
        """Weights from the base spans of some stretches of text; without any, the field finds nothing."""
        field = cls()
        cases = []
        for text in texts:
            lattice = Lattice(text)
            starts = {a: k for k, (a, _) in enumerate(lattice.atoms)}
            ends = {b: k + 1 for k, (_, b) in enumerate(lattice.atoms)}
            gold, at = {}, 0
            for start, end, kind in base_spans(text):
                i, j = starts.get(start), ends.get(end)
                if start >= at and i is not None and j is not None and (i, j) in lattice.number:
                    gold[i, j] = KINDS.index(kind) + 1
                    at = end
            cases.append((lattice, gold))
        if not any(gold for _, gold in cases):
            field.steps[:, 1:] = -50.0
            return field
        squares, step_squares = np.full_like(field.weights, 1e-6), np.full_like(field.steps, 1e-6)
        for _ in range(EPOCHS):
            for lattice, gold in cases:
                parts, steps = field._gradient(lattice, gold)
                grad: dict[int, np.ndarray] = {}
                for s, g in parts.items():
                    if np.abs(g).max() > 1e-4:
                        for f in lattice.features[s]:
                            grad[f] = grad.get(f, 0) + g
                if grad:
                    at = np.fromiter(grad, np.int64)
                    g = np.array(list(grad.values())).T
                    squares[:, at] += g * g
                    field.weights[:, at] += RATE * g / np.sqrt(squares[:, at])
                step_squares += steps * steps
                field.steps += RATE * steps / np.sqrt(step_squares)
        return field


def added_spans(field: Field, text: str, base: list[Span]) -> list[Span]:
    """Spans of the field that overlap none of the base."""
    out = []
    starts = [a for a, _, _ in base]  # ascending
    ends = list(itertools.accumulate((b for _, b, _ in base), max))
    for first, end in surroundings(text):
        lattice = Lattice(text[first:end])
        if not lattice.number:
            continue
        for i, j, label in field.decode(lattice):
            a, b = first + lattice.atoms[i][0], first + lattice.atoms[j - 1][1]
            before = bisect.bisect_left(starts, b)
            if not before or ends[before - 1] <= a:
                out.append((a, b, KINDS[label - 1]))
    return out


def sample_surroundings(docs: DataFrame, text: str, sample: int) -> list[str]:
    """So many different stretches round digits and @ signs of the whole table, those with the smallest hashes."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [t[a:b] for t in batch.column(0).to_pylist() for a, b in surroundings(t)]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.string())], names=["stretch"])

    hot = docs.select(F.col(text).alias("text")).where(F.col("text").rlike("[0-9@]"))
    found = hot.mapInArrow(rows, "stretch string").distinct()  # copies of one would take all the places
    found = found.orderBy(F.xxhash64("stretch"), "stretch").limit(sample)
    return [r["stretch"] for r in found.collect()]


def find_personal(docs: DataFrame, id: str = "doc_id", text: str = "text", field: Field | None = None) -> DataFrame:
    """(id, base, spans) per row: arrays of (kind, start, end), in code points, by start, then kind.

    ``base`` has the patterns' spans, ``spans`` also those that the field adds.

    Defined cases. A null text is empty and has no spans. Rows are searched one by one, so repeated rows repeat their
    result, and ids may be null. An empty table gives an empty result. Other columns are not read.
    """
    field = field or Field.fit(sample_surroundings(docs, text, SAMPLE))
    kind = docs.schema[id].dataType.simpleString()
    item = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    order = {k: n for n, k in enumerate(KINDS)}

    def listed(spans: list[Span]) -> list[dict]:
        ordered = sorted(spans, key=lambda s: (s[0], order[s[2]], s[1]))
        return [{"kind": k, "start": a, "end": b} for a, b, k in ordered]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                base, spans = [], []
                for t in part.column(1).to_pylist():
                    own = base_spans(t or "")
                    base.append(listed(own))
                    spans.append(listed(own + added_spans(field, t or "", own)))
                columns = [part.column(0), pa.array(base, item), pa.array(spans, item)]
                yield pa.RecordBatch.from_arrays(columns, names=[id, "base", "spans"])

    one = "array<struct<kind: string, start: bigint, end: bigint>>"
    return docs.select(F.col(id), F.col(text)).mapInArrow(rows, f"`{id}` {kind}, base {one}, spans {one}")
