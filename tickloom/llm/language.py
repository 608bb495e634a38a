"""Language identification by rank-order profiles.

A profile is the list of the most frequent letter n-grams (n of 1 to 3, words padded with a blank) by falling count. A
language's profile comes from all its labelled documents together. A document is given the language whose profile is
nearest by out-of-place distance: the sum over the document's own profile of how far each n-gram's rank is from its rank
in the language, ``size`` for an n-gram that the language's profile lacks. Equal distances go to the language that comes
first in alphabetical order, equal counts to the n-gram that does.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; documents without ``lang`` or doc_id are
not learned from; without any labelled document everything is ``und``; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tickloom.llm.text import pieces

SIZE = 400
UNKNOWN = "und"
#: Alphabets up to this size are counted in arrays of all n-grams, larger ones by sorting.
DENSE = 64


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)])


class Grams:
    """n-grams of some texts: codes that order as their letters do, shorter n-grams first."""

    def __init__(self, texts: list[str]):
        lowered = [t.lower() for t in texts]
        points = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
        ends = np.cumsum([len(t) for t in lowered], dtype=np.int64)
        begins = ends - [len(t) for t in lowered]
        # a blank before each text and after the last; runs of blanks and other signs become one blank
        letter = _letters()[points]
        flow = np.zeros(len(points) + len(texts) + 1, np.uint32)
        place = np.arange(len(points)) + np.repeat(np.arange(1, len(texts) + 1), ends - begins)
        flow[place] = np.where(letter, points + 1, 0)
        keep = np.ones(len(flow), bool)
        keep[1:] = (flow[1:] != 0) | (flow[:-1] != 0)
        blank = np.concatenate([begins + np.arange(len(texts)), [len(flow) - 1]])
        at = np.cumsum(keep)[blank] - 1
        self.flow = flow[keep]
        self.start, self.end = at[:-1], at[1:] + 1  # with the blanks before and after
        self.alphabet, self.dense = np.unique(self.flow, return_inverse=True)
        self.dense = self.dense.astype(np.int64)
        size = len(self.alphabet)
        self.small = size <= DENSE
        d = self.dense
        pair = d[:-1] * size + d[1:]
        triple = pair[:-1] * size + d[2:] if len(d) > 2 else pair[:0]
        self.levels = [d, pair, triple]
        self.spaces = [size, size * size, size ** 3]

    def _counted(self, level: int, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
        own = self.levels[level][low:max(low, high - level)]
        if self.small:
            count = np.bincount(own, minlength=self.spaces[level])
            code = np.flatnonzero(count)
            return code, count[code]
        return np.unique(own, return_counts=True)

    def counts(self, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
        """Codes in order and their counts in a range of the flow, without blanks alone or inside."""
        codes, counts = [], []
        size = len(self.alphabet)
        blank = self.alphabet[0] == 0
        letters = self.alphabet.astype(np.uint64) + np.uint64(1)
        for level in range(3):
            code, count = self._counted(level, low, high)
            if level == 0 and blank:
                code, count = code[code > 0], count[code > 0]
            wide = np.zeros(len(code), np.uint64)
            for k in range(level + 1):
                wide = (wide << np.uint64(21)) | letters[code // size ** (level - k) % size]
            if level == 2 and blank:
                inner = code // size % size > 0
                count, wide = count[inner], wide[inner]
            codes.append(wide)
            counts.append(count)
        return np.concatenate(codes), np.concatenate(counts)

    def profile(self, row: int, size: int) -> np.ndarray:
        code, count = self.counts(self.start[row], self.end[row])
        if len(code) > size:
            # all counts above the size-th largest, then the smallest codes of that count
            least = np.partition(count, len(count) - size)[len(count) - size]
            more, equal = np.flatnonzero(count > least), np.flatnonzero(count == least)
            keep = np.concatenate([more, equal[:size - len(more)]])
            code, count = code[keep], count[keep]
        return code[np.lexsort((code, -count))]


def _texts(column: pa.Array) -> Iterator[tuple[int, list[str]]]:
    lengths = pa.compute.fill_null(pa.compute.binary_length(column), 0).to_numpy()
    for low, high in pieces(np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])):
        yield low, [t or "" for t in column.slice(low, high - low).to_pylist()]


def _learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of n-grams by language, summed over the task."""
    held: dict[str, tuple[np.ndarray, np.ndarray]] = {}

    def flush() -> Iterator[pa.RecordBatch]:
        for lang, (code, count) in held.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(code), pa.string()), pa.array(code.view(np.int64)), pa.array(count)],
                ["lang", "code", "count"])
        held.clear()

    for batch in batches:
        langs = np.array(batch.column(0).to_pylist())
        order = np.argsort(langs, kind="stable")
        column = batch.column(1).take(pa.array(order))
        for low, texts in _texts(column):
            grams = Grams(texts)
            own = langs[order[low:low + len(texts)]]
            cut = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
            for begin, end in zip(cut.tolist(), [*cut[1:].tolist(), len(own)]):
                code, count = grams.counts(int(grams.start[begin]), int(grams.end[end - 1]))
                lang = str(own[begin])
                if lang in held:
                    code = np.concatenate([held[lang][0], code])
                    code, at = np.unique(code, return_inverse=True)
                    count = np.bincount(at, np.concatenate([held[lang][1], count])).astype(np.int64)
                held[lang] = code, count
            if sum(len(c) for c, _ in held.values()) > 1_000_000:
                yield from flush()
    yield from flush()


def profiles(labelled: DataFrame, size: int = SIZE) -> list[tuple[str, np.ndarray]]:
    """Each language's n-gram codes in rank order; ``labelled`` has lang and text.

    Counts cover all rows. What reaches the driver is ``size`` codes a language.
    """
    counts = (
        labelled.where("lang is not null and text is not null").select("lang", "text")
        .mapInArrow(_learn, "lang string, code long, count long")
        .groupBy("lang", "code").agg(F.sum("count").alias("count"))
    )
    best = [F.col("count").desc(), F.col("code")]
    part = Window.partitionBy("lang", F.pmod(F.xxhash64("code"), F.lit(16))).orderBy(*best)
    top = counts.withColumn("rank", F.row_number().over(part)).where(F.col("rank") <= size).drop("rank")
    top = top.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best))).where(F.col("rank") <= size)
    found: dict[str, list[tuple[int, int]]] = {}
    for row in top.select("lang", "rank", "code").collect():
        found.setdefault(row.lang, []).append((row.rank, row.code))
    return [(lang, np.array([c for _, c in sorted(rows)], np.int64).view(np.uint64)) for lang, rows in sorted(found.items())]


def _scored(texts: list[str], known: list[tuple[str, np.ndarray]], union: np.ndarray, ranks: np.ndarray, size: int) -> Iterator[tuple[str, float]]:
    grams = Grams(texts)
    for row in range(len(texts)):
        own = grams.profile(row, size) if known else union
        if not len(own):
            yield UNKNOWN, 0.0
            continue
        at = np.searchsorted(union, own)
        at[at < len(union)] = np.where(union[at[at < len(union)]] == own[at < len(union)], at[at < len(union)], len(union))
        place = ranks[at]
        far = np.where(place < 0, size, np.abs(place - np.arange(len(own))[:, None])).sum(0)
        best = int(far.argmin())
        rest = np.delete(far, best)
        second = rest.min() if len(rest) else size * len(own)
        yield known[best][0], float(second / max(1, second + far[best]))


def _ranked(known: list[tuple[str, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """All profiles' codes in order, and the rank of each in each language, or -1."""
    union = np.unique(np.concatenate([c for _, c in known])) if known else np.zeros(0, np.uint64)
    ranks = np.full((len(union) + 1, len(known)), -1, np.int64)
    for k, (_, codes) in enumerate(known):
        ranks[np.searchsorted(union, codes), k] = np.arange(len(codes))
    return union, ranks


def _predict(known: list[tuple[str, np.ndarray]], size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        union, ranks = _ranked(known)
        for batch in batches:
            found = [x for _, texts in _texts(batch.column(1)) for x in _scored(texts, known, union, ranks, size)]
            langs, scores = [x for x, _ in found], [x for _, x in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "lang_pred", "score"])

    return run


def identify(docs: DataFrame, known: list[tuple[str, np.ndarray]], size: int = SIZE) -> DataFrame:
    """One row per row of ``docs``: doc_id, lang_pred, score.

    The score is the runner-up's share of the two least distances: 0.5 where two languages tie, 1 where one fits exactly.
    """
    return docs.select("doc_id", "text").mapInArrow(_predict(known, size), "doc_id long, lang_pred string, score double")


def accepted(docs: DataFrame, known: list[tuple[str, np.ndarray]], least: float = 0.505, size: int = SIZE) -> DataFrame:
    """The rows of ``docs`` in a language that is known, told from the others with a score of ``least``.

    Where nothing was learned nothing can be rejected: all rows stay.
    """
    if not known:
        return docs
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        union, ranks = _ranked(known)
        for batch in batches:
            keep = [lang != UNKNOWN and score >= least
                    for _, texts in _texts(batch.column(place)) for lang, score in _scored(texts, known, union, ranks, size)]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def held_out():
    """Whether a document belongs to the fold that is not learned from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
