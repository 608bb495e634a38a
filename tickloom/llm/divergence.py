"""Divergence of the sources of a language by pairwise merges of sparse term counts.

Each language keeps the terms that enough of its documents hold. They get ids, block by block: a block is a share of the
terms by hash, of about ``BLOCK``, and an id is a term's place in its block. A source's counts in a block are one array
sorted by id. A pair task takes two sources of a language and a block: a search of one sorted array in the other, which
goes on from where the last hit was, finds the terms both hold; these, those that only one holds, and those that neither
holds, priced once and multiplied, give both directed divergences. The sums over blocks are the pair's.

So that an array is not copied to each of its source's partners, sources are dealt into bundles of about ``BUNDLE`` and
two bundles' pairs share a task: an array is copied once per bundle, and a task holds at most two bundles of one block.

All arithmetic is on whole numbers. Shares are parts of a thousand million, found by long division in three steps of a
thousand, so that counts may reach 9e15; a squared difference is at most 1e18.

Defined cases: null text, lang and source count as empty text; a row is a document, also where rows repeat; a source
without terms has the share of an unseen term everywhere; a language without kept terms has pairs of value 0; a
language with one source has no pairs; ties are ranked by item; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import combinations, product
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tickloom.llm.store import Workspace

#: As bytes of UTF-8: A-Z, a-z and every byte of a code point from U+0080 on.
TERM = re.compile(rb"[A-Za-z\x80-\xFF]+")
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
SCALE = 1_000_000_000
BLOCK = 8192
BUNDLE = 16


def _tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents of each term by language and source, a batch at a time; term null marks the group."""
    names = ["lang", "source", "term", "n", "docs"]
    for batch in batches:
        groups: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        texts = batch.column(2).cast(pa.binary()).to_pylist()
        for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts):
            n, docs = groups.setdefault((lang, source), (Counter(), Counter()))
            own = Counter(TERM.findall(text.translate(LOWER)))
            n.update(own)
            docs.update(own.keys())
        for (lang, source), (n, docs) in groups.items():
            terms = pa.array([None, *n], pa.binary()).cast(pa.string())
            same = [pa.repeat(pa.scalar(x, pa.string()), len(terms)) for x in (lang, source)]
            counts = [pa.array([0, *n.values()], pa.int64()), pa.array([0, *(docs[t] for t in n)], pa.int64())]
            yield pa.RecordBatch.from_arrays([*same, terms, *counts], names)


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n and docs; each group has one row without a term. Counted in tasks first."""
    texts = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    return texts.mapInArrow(_tally, "lang string, source string, term string, n long, docs long").groupBy(
        "lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def shares(count: np.ndarray, whole: int) -> np.ndarray:
    """1 + floor(SCALE * (count + 1) / whole), exact."""
    rest, out = count + 1, np.zeros_like(count)
    for _ in range(3):
        rest = rest * 1000
        out = out * 1000 + rest // whole
        rest = rest % whole
    return out + 1


def gaps(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def priced(a: tuple, b: tuple, size: int) -> tuple[int, int]:
    """Both directed sums over a block of ``size`` terms. A source is (ids, shares, share of an absent term)."""
    small, large = (a, b) if len(a[0]) <= len(b[0]) else (b, a)
    at = np.searchsorted(large[0], small[0])
    hit = np.zeros(len(at), bool)
    inner = at < len(large[0])
    hit[inner] = large[0][at[inner]] == small[0][inner]
    low, high = np.flatnonzero(hit), at[hit]
    in_a, in_b = (low, high) if small is a else (high, low)
    only_a, only_b = np.delete(a[1], in_a), np.delete(b[1], in_b)
    neither = size - len(only_a) - len(only_b) - len(low)
    out = []
    for p, q, p_only, q_only, p_none, q_none in (
        (a[1][in_a], b[1][in_b], only_a, only_b, a[2], b[2]), (b[1][in_b], a[1][in_a], only_b, only_a, b[2], a[2])
    ):
        out.append(int(gaps(p, q).sum() + gaps(p_only, q_none).sum() + gaps(p_none, q_only).sum()
                       + neither * gaps(p_none, q_none)))
    return out[0], out[1]


def _pair_task(rows: pa.Table) -> pa.Table:
    """One block, and the pairs of two bundles, or within one."""
    sides: dict[int, list[tuple]] = {}
    size = rows["size"][0].as_py()
    for k in range(rows.num_rows):
        entries, whole = rows["entries"][k], max(1, rows["whole"][k].as_py())
        held = entries.values if entries.is_valid else None
        ids, n = (np.zeros(0, np.int64),) * 2 if held is None else (
            held.field(0).to_numpy().astype(np.int64), held.field(1).to_numpy().astype(np.int64))
        source = (ids, shares(n, whole), shares(np.zeros(1, np.int64), whole)[0])
        sides.setdefault(rows["bundle"][k].as_py(), []).append((rows["source"][k].as_py(), source))
    low, high = rows["low"][0].as_py(), rows["high"][0].as_py()
    pairs = combinations(sides[low], 2) if low == high else product(sides.get(low, []), sides.get(high, []))
    made = [(a, b, *priced(x, y, size)) if a < b else (b, a, *priced(y, x, size)) for (a, x), (b, y) in pairs]
    columns = list(zip(*made)) or [[]] * 4
    kinds = [pa.string(), pa.string(), pa.int64(), pa.int64()]
    lang = pa.repeat(pa.scalar(rows["lang"][0].as_py(), pa.string()), len(made))
    return pa.table([lang, *(pa.array(c, t) for c, t in zip(columns, kinds))], ["lang", "a", "b", "ab", "ba"])


def _share(count: str, whole: Column) -> Column:
    """As ``shares``, in SQL."""
    return F.lit(1) + F.call_function(
        "div", F.lit(SCALE).cast("decimal(10,0)") * (F.col(count) + 1).cast("decimal(20,0)"), whole.cast("decimal(20,0)"))


def audit(docs: DataFrame, least: int = 3, top: int = 200) -> DataFrame:
    """lang, source, part, item, value and rank.

    Part ``pair``: the divergence from each other source of the language. Part ``term``: the ``top`` terms that a source
    has more of than its language. Kept terms are those that ``least`` documents of the language hold.
    """
    space = Workspace(docs.sparkSession, "divergence")
    counts = space.save(term_counts(docs), "counts")
    kept = counts.where("term is not null").groupBy("lang", "term").agg(
        F.sum("docs").alias("docs"), F.sum("n").alias("lang_n")).where(F.col("docs") >= least).drop("docs")
    kept = space.save(kept, "kept")
    sources = counts.where("term is null").select("lang", "source")
    langs = space.save(
        sources.groupBy("lang").agg(F.count(F.lit(1)).alias("sources"))
        .join(kept.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("lang_n").alias("lang_whole")), "lang", "left")
        .select("lang", F.coalesce("terms", F.lit(0)).alias("terms"), F.coalesce("lang_whole", F.lit(0)).alias("lang_whole"),
                F.greatest(F.lit(1), F.ceil(F.col("terms") / BLOCK)).alias("blocks"),
                F.ceil(F.col("sources") / BUNDLE).alias("bundles")), "langs")
    block = Window.partitionBy("lang", "block").orderBy("term")
    dealt = space.save(
        kept.join(langs, "lang").withColumn("block", F.pmod(F.xxhash64("term"), "blocks"))
        .select("lang", "term", "lang_n", "block", (F.row_number().over(block) - 1).alias("id")), "dealt")
    entries = space.save(
        counts.where("term is not null").select("lang", "source", "term", "n").join(dealt, ["lang", "term"]), "entries")
    groups = space.save(
        sources.join(entries.groupBy("lang", "source").agg(F.sum("n").alias("n")), ["lang", "source"], "left")
        .join(langs, "lang")
        .select("lang", "source", (F.coalesce("n", F.lit(0)) + F.col("terms")).alias("whole"), "blocks", "bundles",
                (F.col("lang_whole") + F.col("terms")).alias("lang_whole"),
                F.pmod(F.xxhash64("source"), "bundles").alias("bundle")), "groups")
    return _pairs(groups, entries, dealt).unionByName(_terms(groups, entries, top))


def _pairs(groups: DataFrame, entries: DataFrame, dealt: DataFrame) -> DataFrame:
    arrays = entries.groupBy("lang", "source", "block").agg(
        F.sort_array(F.collect_list(F.struct("id", "n"))).alias("entries"))
    sizes = dealt.groupBy("lang", "block").agg(F.count(F.lit(1)).alias("size"))
    every = groups.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    tasks = (
        every.join(arrays, ["lang", "source", "block"], "left").join(sizes, ["lang", "block"], "left")
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("bundles") - 1)))
        .select("lang", "block", F.least("bundle", "other").alias("low"), F.greatest("bundle", "other").alias("high"),
                "bundle", "source", "whole", F.coalesce("size", F.lit(0)).alias("size"), "entries")
    )
    sums = (
        tasks.groupBy("lang", "block", "low", "high")
        .applyInArrow(_pair_task, "lang string, a string, b string, ab long, ba long")
        .groupBy("lang", "a", "b").agg(F.sum("ab").alias("ab"), F.sum("ba").alias("ba"))
    )
    ways = F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item"), F.col("ab").alias("value")),
                   F.struct(F.col("b").alias("source"), F.col("a").alias("item"), F.col("ba").alias("value")))
    return _ranked(sums.select("lang", F.inline(ways)), "pair")


def _terms(groups: DataFrame, entries: DataFrame, top: int) -> DataFrame:
    shared = entries.join(groups.select("lang", "source", "whole", "lang_whole"), ["lang", "source"]).select(
        "lang", "source", F.col("term").alias("item"), _share("n", F.col("whole")).alias("p"),
        _share("lang_n", F.col("lang_whole")).alias("q")).where("p > q")
    value = F.call_function("div", (F.col("p") - F.col("q")) * (F.col("p") - F.col("q")), F.col("q"))
    return _ranked(shared.select("lang", "source", "item", value.alias("value")), "term").where(F.col("rank") <= top)


def _ranked(rows: DataFrame, part: str) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))
