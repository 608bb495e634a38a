"""Personal data by candidate generation, gradient boosted trees and calibrated thresholds.

Generators with high recall propose spans that may overlap: what the four strict rules match, and looser forms such as
spelled-out e-mail addresses and all neighbouring groups of digits with any separators. Trees see the form of a candidate
(length, digits, separators, group sizes, checksum) and its context (neighbouring signs, words before it) and score it.
They are fitted per corpus on at most ``SAMPLE`` documents. Strict matches written loosely in their own context are the
positives; what else overlaps them, and loose forms without a cue word before them, are the negatives;
a separate fold calibrates the scores. A
candidate is redacted if it is a strict match or if its calibrated probability reaches ``threshold``; of overlapping
ones that are not strict, the most probable stays, and none may overlap a strict match.

Strict rules, each leftmost and without overlap in its kind; failing matches are dropped, not retried:
e-mail; four dotted numbers of at most 255; 12 to 19 digits passing the Luhn sum; + and 9 to 15 digits.

Defined cases: null text is empty; rows without doc_id and rows that repeat one are treated alike, each by itself;
without a candidate to learn from, only strict matches count; other columns are ignored. Offsets are code points.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
import hashlib
from itertools import islice
import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tickloom.llm.boosting import Trees, calibrated

KINDS = ("email", "ip", "card", "phone")
SAMPLE = 20_000
#: Positives that each fold must have; with fewer only strict matches count.
LEAST = 20
#: Candidates that are scored at once.
CHUNK = 20_000
#: The feature that tells a cue word.
CUE = 21
_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DIGITS = frozenset("0123456789")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
_DOTTED_RUN = re.compile(r"[0-9.]{7,}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_AT = re.compile(r" ?(?:@|\(at\)|\[at\]| at ) ?", re.I)
_PART = re.compile(r"[A-Za-z0-9-]{1,63}")
_DOT = re.compile(r" ?(?:\.|\(dot\)|\[dot\]| dot ) ?", re.I)
_RUN = re.compile(r"[0-9]+(?:[\x20().:/-]{1,3}[0-9]+)*")
_WORD = re.compile(r"[^\W\d_]+")
_NUMBER = re.compile(r"[0-9]+")
_TAIL = re.compile(r"[A-Za-z0-9]*\Z")
_DOT_WORD = re.compile("dot", re.I)
_AT_SIGN = re.compile(r"[(\[]at[)\]]", re.I)


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        d = int(d)
        if k % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    at, done = text.find("@"), 0
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        match = _DOMAIN.match(text, at) if start < at else None
        if match:
            yield start, match.end()
            done = match.end()
        at = text.find("@", match.end() if match else at + 1)


def strict(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind) of every strict match, by start and then kind."""
    found = [(s, e, 0) for s, e in _emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        for run in _DOTTED_RUN.finditer(text):
            if run.group().count(".") >= 3:
                for m in _DOTTED.finditer(text, run.start(), run.end()):
                    if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
                        found.append((m.start(), m.end(), 1))
        for m in _CARD.finditer(text):
            digits = m.group().replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), m.end(), 2))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= sum(c in "0123456789" for c in m.group()) <= 15:
                    found.append((m.start(), m.end(), 3))
    return sorted(found, key=lambda x: (x[0], x[2]))


def _spelled(text: str) -> Iterator[tuple[int, int]]:
    """Addresses around each sign or word for "at", with one to four dots in the domain, whatever stands for them.

    64 characters of a local part and 63 of a label are what mail allows; a longer run ends or begins there.
    """
    for m in _AT.finditer(text):
        start = m.start()
        while start > max(0, m.start() - 64) and text[start - 1] in _LOCAL:
            start -= 1
        part = _PART.match(text, m.end()) if start < m.start() else None
        for _ in range(4):
            dot = _DOT.match(text, part.end()) if part else None
            part = _PART.match(text, dot.end()) if dot else None
            if part and len(part.group()) > 1:
                yield start, part.end()


def _groups(text: str) -> Iterator[tuple[int, int, int]]:
    """(start, end, digits) of all neighbouring digit groups with 4 to 19 digits together, signs before them included."""
    for run in _RUN.finditer(text):
        own = [(m.start(), m.end()) for m in re.finditer("[0-9]+", run.group())]
        for k, (low, _) in enumerate(own):
            start, n = run.start() + low, 0
            while start > 0 and text[start - 1] in "+(" and run.start() + low - start < 2:
                start -= 1
            for j in range(k, len(own)):
                s, e = own[j]
                n += e - s
                if n > 19:
                    break
                if n >= 4:
                    yield start, run.start() + e, n


def proposed(text: str) -> Iterator[tuple[int, int, int]]:
    """Proposed spans, which may overlap each other and strict matches. A place begins a bounded number of them."""
    yield from ((s, e, 0) for s, e in dict.fromkeys(_spelled(text)))
    for s, e, n in _groups(text):
        part = text[s:e]
        if n <= 12 and part.count(".") == 3 and len(re.findall("[0-9]+", part)) == 4:
            yield s, e, 1
        if n >= 12 and luhn("".join(filter(_DIGITS.__contains__, part))):
            yield s, e, 2
        if 7 <= n <= 15:
            yield s, e, 3


class Covered:
    """Disjoint spans in order of place."""

    def __init__(self, spans: list[tuple[int, int, int]]):
        self.starts: list[int] = []
        self.ends: list[int] = []
        for s, e, _ in sorted(spans):
            if self.ends and s < self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], e)
            else:
                self.starts.append(s)
                self.ends.append(e)

    def meets(self, start: int, end: int) -> bool:
        at = bisect_left(self.starts, end) - 1
        return at >= 0 and self.ends[at] > start

    def add(self, start: int, end: int) -> None:
        """A span that meets none."""
        at = bisect_left(self.starts, start)
        self.starts.insert(at, start)
        self.ends.insert(at, end)


def loosened(part: str, kind: int, way: int) -> str:
    """A strict match as people also write it."""
    if kind == 0:
        at, dot = ((" at ", " dot "), ("(at)", "(dot)"), (" [at] ", " [dot] "), (" (at) ", "."))[way % 4]
        return part.replace("@", at).replace(".", dot)
    if kind == 1:
        return part.replace(".", (". ", " . ", " .")[way % 3])
    digits = re.sub("[^0-9]", "", part)
    if kind == 2:
        return "./:"[way % 3].join(digits[k:k + 4] for k in range(0, len(digits), 4))
    return (part[1:], "0" + digits[2:5] + " " + digits[5:], "(0" + digits[2:4] + ") " + digits[4:], "0" + digits[2:5] + "/" + digits[5:])[way % 4]


#: Words that announce personal data, by kind; fixed values.
CUES = (
    ("mail", "email", "contact", "write"),
    ("ip", "host", "address", "server", "from", "by"),
    ("card", "visa", "mastercard", "credit", "pay", "account"),
    ("phone", "tel", "call", "mobile", "fax", "whatsapp"),
)


def _context(text: str, start: int) -> tuple[str, list[str], int, str]:
    """What stands before a place: the last character, the last words, the quotes open, and the last sign."""
    before = text[max(0, start - 24):start]
    return (before[-1:], [w.lower() for w in _WORD.findall(before)[-3:]], text[max(0, start - 40):start].count("\"") % 2,
            before[-2:].strip()[-1:])


def features(text: str, start: int, end: int, kind: int, context: tuple | None = None) -> list[float]:
    """Form and context of a candidate."""
    b, cue, quotes, last = context or _context(text, start)
    part = text[start:end]
    groups = _NUMBER.findall(part)
    sizes = [len(g) for g in groups]
    digits = "".join(groups)
    after = text[end:end + 2]
    a = after[:1]
    word = _TAIL.search(part).group()
    return [
        kind, end - start, len(digits), len(groups), max(sizes, default=0), min(sizes, default=0),
        len(digits) / (end - start), part.count("."), part.count("-"), part.count(" "), part.count("@"),
        part.startswith("+"), "(" in part, luhn(digits) if digits else -1,
        max((int(g[k:k + 9]) for g in groups for k in range(0, len(g), 9)), default=-1) if kind == 1 else -1,
        b.isalnum(), a.isalnum(), b.isspace() or not b, a.isspace() or not a, b in "\"'=:#", a in "\"'.,;!",
        any(w in CUES[kind] for w in cue), sum(map(str.isalpha, part)) / (end - start), quotes,
        len(_DOT_WORD.findall(part)), len(_AT_SIGN.findall(part)), len(word), part[-1:].isalpha() and word[:1].isupper(),
        part.count("/") + part.count(":"), after.strip()[:1].isdigit() or last.isdigit(),
    ]


def examples(text: str) -> Iterator[tuple[list[float], bool]]:
    """Features and label of loose candidates, by evidence that is no strict match of the candidate itself.

    A strict match written loosely is a positive, and what else is proposed around it with its kind a negative. Of the
    text's own loose forms those right after a cue word of their kind are left out, as they may be either; others are negatives.
    """
    matches = strict(text)
    known = Covered(matches)
    for s, e, kind in proposed(text):
        if not known.meets(s, e):
            x = features(text, s, e, kind)
            if not x[CUE]:
                yield x, False
    for k, (s, e, kind) in enumerate(matches):
        loose = loosened(text[s:e], kind, s + k)
        low = max(0, s - 64)
        around = text[low:s] + loose + text[e:e + 64]
        s, e = s - low, s - low + len(loose)
        for b, f, other in proposed(around):
            if other == kind and b < e and s < f:
                yield features(around, b, f, kind), (b, f) == (s, e)


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """At most ``CHUNK`` at a time, whatever a text holds."""
    def rows() -> Iterator[tuple]:
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for own, label in examples(text or ""):
                    yield key, [float(v) for v in own], label

    held = rows()
    while part := list(islice(held, CHUNK)):
        fold, x, y = zip(*part)
        yield pa.RecordBatch.from_arrays(
            [pa.array(fold, pa.int32()), pa.array(x, pa.list_(pa.float64())), pa.array(y, pa.bool_())], ["fold", "x", "y"])


class Detector:
    """Fitted trees, their calibration and the probability from which a candidate is redacted."""

    def __init__(self, threshold: float = 0.9, sample: int = SAMPLE):
        self.threshold, self.sample = threshold, sample
        self.trees: Trees | None = None
        self.known = self.share = np.zeros(0)

    def fit(self, docs: DataFrame) -> "Detector":
        """Learn from about ``sample`` documents, taken evenly by a hash of their text; 8 candidates each at most reach the driver."""
        step = max(1, math.ceil(docs.count() / self.sample))
        text = docs.where(F.pmod(F.xxhash64("text"), F.lit(step)) == 0)
        rows = (
            text.select(F.pmod(F.xxhash64("text", F.lit(1)), F.lit(2)).cast("int").alias("fold"), "text")
            .mapInArrow(_examples, "fold int, x array<double>, y boolean")
            .orderBy(F.xxhash64("x", "y", "fold"), "fold", "x", "y").limit(8 * self.sample).collect()
        )
        if not rows:
            return self
        fold = np.array([r.fold for r in rows])
        x, y = np.array([r.x for r in rows]), np.array([r.y for r in rows], float)
        order = np.lexsort((*x.T, y, fold))  # rows come in any order; the model must not depend on it
        fold, x, y = fold[order], x[order], y[order]
        if any(y[fold == k].sum() < LEAST or (y[fold == k] == 0).sum() == 0 for k in (0, 1)):
            return self
        self.trees = Trees().fit(x[fold == 0], y[fold == 0])
        self.known, self.share = calibrated(self.trees.predict(x[fold == 1]), y[fold == 1])
        return self

    def probability(self, x: np.ndarray) -> np.ndarray:
        if self.trees is None or not len(x):
            return np.zeros(len(x))
        at = np.searchsorted(self.known, self.trees.predict(x), "right") - 1
        return np.where(at < 0, 0.0, self.share[np.maximum(at, 0)])

    def spans(self, texts: list[str]) -> list[tuple[list, list]]:
        """For each text its strict matches and all redacted spans, (start, end, kind) each."""
        matches = [strict(t) for t in texts]
        rated = self._rated(texts, matches)
        out = []
        for found, own in zip(matches, rated):
            taken, more = Covered(found), []
            for _, (s, e, kind) in sorted(own):
                if not taken.meets(s, e):
                    taken.add(s, e)
                    more.append((s, e, kind))
            out.append((found, sorted(found + more, key=lambda v: (v[0], v[2]))))
        return out

    def _rated(self, texts: list[str], matches: list[list]) -> list[list]:
        """For each text (-probability, candidate) of those that reach the threshold; ``CHUNK`` are in memory at once."""
        out: list[list] = [[] for _ in texts]
        if self.trees is None:
            return out

        def new() -> Iterator[tuple]:
            for k, (text, found) in enumerate(zip(texts, matches)):
                known, start, context = Covered(found), None, None
                for c in proposed(text):
                    if not known.meets(c[0], c[1]):
                        if c[0] != start:
                            start, context = c[0], _context(text, c[0])
                        yield k, c, features(text, *c, context)

        held = new()
        while part := list(islice(held, CHUNK)):
            score = self.probability(np.array([x for _, _, x in part], float))
            for at in np.flatnonzero(score >= self.threshold).tolist():
                out[part[at][0]].append((-score[at], part[at][1]))
        return out


def listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{s}:{e}" for s, e, kind in spans)


def redacted(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with each run of overlapping spans replaced by the kind that begins it."""
    out, done = [], 0
    for s, e, kind in spans:
        if s >= done:
            out += [text[done:s], f"[{KINDS[kind].upper()}]"]
        done = max(done, e)
    return "".join(out) + text[done:]


def detect(docs: DataFrame, detector: Detector) -> DataFrame:
    """One row per row of ``docs``: doc_id, a count by kind of strict matches, their digest and list, all spans."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = detector.spans([t or "" for t in batch.column(1).to_pylist()])
            counts = [[sum(k == kind for _, _, k in own) for own, _ in found] for kind in range(4)]
            digest = [hashlib.sha256(listed(own).encode()).hexdigest() for own, _ in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in counts), pa.array(digest, pa.string()),
                 pa.array([listed(all_) for _, all_ in found], pa.string())],
                ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def redact(docs: DataFrame, detector: Detector) -> DataFrame:
    """``docs`` with personal data in ``text`` replaced by its kind in brackets; null texts stay null."""
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(place).to_pylist()
            found = detector.spans([t or "" for t in texts])
            clean = pa.array([t if t is None else redacted(t, all_) for t, (_, all_) in zip(texts, found)], pa.string())
            yield batch.set_column(place, batch.schema.field(place).name, clean)

    return docs.mapInArrow(run, docs.schema)
