"""Near-duplicate documents by b-bit MinHash, confirmed on full shingle sets.

A document is the set of its distinct five-word shingles. 128 minima give 32 band keys of four minima each, and two low
bits of every minimum are packed into four longs. Documents that share a band key are candidates; candidates whose
similarity, estimated by bit counts and corrected for chance agreement, is far below the threshold are dropped; the rest
are confirmed on full sets. A pair at similarity 0.75 shares no band with probability 5e-6, and the estimate drops a
pair at the threshold with probability below 1e-6.

Documents with equal sets are one class from the start. Within a band, pairs are not listed: each class is first
confirmed against its most similar band centre, the member with the most company in all its bands. Only classes that
then lie in different components, and that nothing keeps apart, neither sizes, nor signatures, nor shingles found in no
other class or in none of the other component, are confirmed one by one. A link left out this way joins what is already one component.

Defined cases: a null or empty text, or one of blanks, has no shingles and links with nothing; rows that repeat a
doc_id, with its text or another, and rows without one are documents of their own; a component's id is the smallest
doc_id in it, null where no row of it has one; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tickloom.llm.components import components
from tickloom.llm.store import Workspace, free_name, own_ids
from tickloom.llm.text import mix, pieces, raw, sets, shingles

HASHES, BANDS, LOW_BITS = 128, 32, 2
ROWS = HASHES // BANDS
_draw = np.random.default_rng(9)
_HIGH = _draw.integers(0, 1 << 31, HASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_LOW = _draw.integers(0, 1 << 31, HASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)

SKETCH = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("n", T.LongType()),
    T.StructField("set_a", T.LongType()), T.StructField("set_b", T.LongType()),
    *[T.StructField(f"s{k}", T.LongType()) for k in range(4)],
    T.StructField("bands", T.ArrayType(T.LongType())),
])


def minima(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The HASHES minima of each set; sets begin at ``starts``, none is empty."""
    high, low = (values >> np.uint64(32)).astype(np.uint32), values.astype(np.uint32)
    out = np.empty((HASHES, len(starts)), np.uint32)
    for j in range(HASHES):
        out[j] = np.minimum.reduceat(high * _HIGH[j] + low * _LOW[j], starts)
    return out


def _packed(bits: np.ndarray) -> np.ndarray:
    """64 rows of bits to one long per column."""
    return (bits.astype(np.uint64) << np.arange(64, dtype=np.uint64)[:, None]).sum(0, dtype=np.uint64).view(np.int64)


def _sketches(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, at = raw(batch.column(1))
            for low, high in pieces(at):
                ids = batch.column(0).slice(low, high - low)
                hashes, rows, _, _ = shingles(buf[at[low]:at[high]], at[low:high + 1] - at[low], size)
                values, rows = sets(hashes, rows)
                count = np.bincount(rows, minlength=high - low)
                some = np.flatnonzero(count)
                starts = (np.cumsum(count) - count)[some]
                sums = np.zeros((2, high - low), np.int64)
                longs = np.zeros((4, high - low), np.int64)
                bands: list = [[] for _ in range(high - low)]
                if len(some):
                    sums[0, some] = np.add.reduceat(values, starts).view(np.int64)
                    sums[1, some] = np.add.reduceat(mix(values ^ np.uint64(0xA5A5A5A5)), starts).view(np.int64)
                    least = minima(values, starts)
                    bits = (least * np.uint32(0x9E3779B1)) >> np.uint32(30)
                    for half in range(2):
                        own = bits[64 * half:64 * half + 64]
                        longs[half, some] = _packed(own & np.uint32(1))
                        longs[2 + half, some] = _packed(own >> np.uint32(1))
                    keys = np.empty((len(some), BANDS), np.int64)
                    for k in range(BANDS):
                        key = np.full(len(some), k + 1, np.uint64)
                        for j in range(k * ROWS, k * ROWS + ROWS):
                            key = mix(key * np.uint64(31) + least[j])
                        keys[:, k] = key.view(np.int64)
                    for place, own in zip(some.tolist(), keys):
                        bands[place] = own
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(count.astype(np.int64)), *map(pa.array, sums), *map(pa.array, longs),
                     pa.array(bands, pa.list_(pa.int64()))], SKETCH.names)

    return run


def sketch(docs: DataFrame, size: int = 5) -> DataFrame:
    """Set size, 128-bit set fingerprint, b-bit signature and band keys of each document."""
    return docs.select("doc_id", "text").mapInArrow(_sketches(size), SKETCH)


def agreeing(least: float, sigmas: float = 5.0) -> int:
    """Matching positions that a pair at similarity ``least`` has but for one in millions.

    Two positions agree with probability J + (1 - J) / 2**b, as unequal minima agree by chance.
    """
    p = least + (1 - least) / 2 ** LOW_BITS
    return math.floor(HASHES * p - sigmas * math.sqrt(HASHES * p * (1 - p)))


def _matches(a: str, b: str):
    off = [F.bit_count((F.col(f"{a}.s{k}").bitwiseXOR(F.col(f"{b}.s{k}")))
                       .bitwiseOR(F.col(f"{a}.s{k + 2}").bitwiseXOR(F.col(f"{b}.s{k + 2}")))) for k in range(2)]
    return F.lit(HASHES) - off[0] - off[1]


def estimate(a: str, b: str):
    """Similarity of two signatures, corrected for chance agreement."""
    chance = 1 / 2 ** LOW_BITS
    return (_matches(a, b) / HASHES - chance) / (1 - chance)


def _full_sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, at = raw(batch.column(1))
            for low, high in pieces(at):
                hashes, rows, _, _ = shingles(buf[at[low]:at[high]], at[low:high + 1] - at[low], size)
                values, rows = sets(hashes, rows)
                cut = np.searchsorted(rows, np.arange(high - low + 1))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(low, high - low),
                     pa.array([values[i:j].tobytes() for i, j in zip(cut[:-1], cut[1:])], pa.binary())],
                    ["doc_id", "shingles"])

    return run


def _confirm(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            for k, (a, b) in enumerate(zip(batch.column(2), batch.column(3))):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (a, b))
                if len(x) > len(y):
                    x, y = y, x
                both = np.count_nonzero(y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x)
                keep[k] = 100 * both >= percent * (len(x) + len(y) - both)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["x", "y"]).filter(pa.array(keep))

    return run


def confirmed(pairs: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    """The pairs (x, y) whose full sets are similar enough. Sets are large, so they are sorted and merged at any size."""
    x, y = full.select(F.col("doc_id").alias("x"), F.col("shingles").alias("sx")), full.select(F.col("doc_id").alias("y"), F.col("shingles").alias("sy"))
    return pairs.hint("merge").join(x, "x").hint("merge").join(y, "y").select("x", "y", "sx", "sy").mapInArrow(_confirm(percent), "x long, y long")


def near_duplicates(docs: DataFrame, percent: int = 75, size: int = 5) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id.

    Where doc_ids repeat or lack, rows are numbered and the numbers stand for them until the end.
    """
    if own_ids(docs):
        return _components(docs, percent, size)
    rows = Workspace(docs.sparkSession, "near_dup_rows").numbered(docs.select("doc_id", "text"), "row")
    found = _numbered_components(rows, "row", percent, size)
    least = found.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    return found.join(least, "component").select("doc_id", "n_shingles", "component_id")


def _numbered_components(rows: DataFrame, number: str, percent: int, size: int) -> DataFrame:
    """The number, doc_id, n_shingles and component (a number) of every row."""
    found = _components(rows.select(F.col(number).alias("doc_id"), "text"), percent, size)
    found = found.select(F.col("doc_id").alias(number), "n_shingles", F.col("component_id").alias("component"))
    return rows.select(number, "doc_id").join(found, number)


def keep_one(docs: DataFrame, percent: int = 75, size: int = 5) -> DataFrame:
    """``docs`` with one row of each component: that of the smallest doc_id, or any if none has one."""
    if own_ids(docs):
        gone = _components(docs, percent, size).where("doc_id <> component_id").select("doc_id")
        return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
    number = free_name(docs, "row")
    rows = Workspace(docs.sparkSession, "near_dup_rows").numbered(docs, number)
    found = _numbered_components(rows, number, percent, size)
    stays = found.groupBy("component").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", number))[number].alias(number)).select(number)
    return rows.join(stays, number, "left_semi").select(*docs.columns)


def _components(docs: DataFrame, percent: int, size: int) -> DataFrame:
    """doc_id, n_shingles and component_id of every row, where each row has a doc_id of its own."""
    space = Workspace(docs.sparkSession, "near_dup")
    texts = docs.select("doc_id", "text")
    sketches = space.save(sketch(texts, size), "sketches")
    some = sketches.where("n > 0")
    classes = some.groupBy("set_a", "set_b").agg(F.min("doc_id").alias("doc_id"))
    chosen = space.save(some.join(classes.select("doc_id"), "doc_id", "left_semi"), "chosen")

    # Band members with company, and each one's company over all bands.
    entries = chosen.select("doc_id", F.explode("bands").alias("band"))
    shared = entries.groupBy("band").agg(F.count("*").alias("members")).where("members > 1")
    members = space.save(entries.join(shared, "band"), "members")
    company = members.groupBy("doc_id").agg(F.sum("members").alias("company"))
    signed = chosen.select("doc_id", "n", "s0", "s1", "s2", "s3").join(company, "doc_id")
    signed = space.save(signed, "signed")
    full = space.save(
        texts.join(signed.select("doc_id").hint("merge"), "doc_id", "left_semi")
        .mapInArrow(_full_sets(size), "doc_id long, shingles binary"), "full")

    # First each class against its most similar centre.
    rank = F.struct("company", (-F.col("doc_id")).alias("low"))
    centres = members.join(company, "doc_id").groupBy("band").agg((-F.max(rank)["low"]).alias("centre"))
    star = members.join(centres, "band").where("doc_id <> centre").select("doc_id", "centre").distinct()
    near = (
        star.withColumnRenamed("doc_id", "x").withColumnRenamed("centre", "y")
        .join(signed.alias("a"), F.col("x") == F.col("a.doc_id"))
        .join(signed.alias("b"), F.col("y") == F.col("b.doc_id"))
        .where(_matches("a", "b") >= agreeing(percent / 100))
        .where(F.least("a.n", "b.n") * 100 >= F.greatest("a.n", "b.n") * percent)
        .select("x", "y", estimate("a", "b").alias("similar"))
    )
    best = near.groupBy("x").agg((-F.max(F.struct("similar", (-F.col("y")).alias("low")))["low"]).alias("y"))
    links = space.save(confirmed(best, full, percent), "links")
    labels = components(links, space, "first")

    # Then what shares a band but not yet a component.
    placed = (
        members.select("doc_id", "band").join(labels, "doc_id", "left")
        .select("doc_id", "band", F.coalesce("component", "doc_id").alias("component"))
    )
    parts = placed.groupBy("band", "component").agg(F.count("*").alias("size"))
    mixed = (
        parts.groupBy("band")
        .agg(F.count("*").alias("parts"), F.max(F.struct("size", "component"))["component"].alias("main"))
        .where("parts > 1").select("band", "main")
    )
    open_ = space.save(placed.join(mixed, "band"), "open")
    undecided = open_.select("doc_id").distinct()
    alone = (
        full.join(undecided, "doc_id", "left_semi").withColumn("part", F.lit(0).cast("long"))
        .mapInArrow(_spread, "shingle long, doc_id long, part long")
        .groupBy("shingle").agg(F.count("*").alias("found"), F.min("doc_id").alias("doc_id"))
        .where("found = 1").groupBy("doc_id").agg(F.count("*").alias("alone"))
    )
    facts = space.save(
        chosen.join(undecided, "doc_id", "left_semi").join(alone, "doc_id", "left")
        .select("doc_id", "n", "s0", "s1", "s2", "s3", "bands", (F.col("n") - F.coalesce("alone", F.lit(0))).alias("common")),
        "facts")
    # What an outsider shares with all of a band's main component bounds what it shares with a member.
    union = (
        full.join(open_.where("component = main").select("doc_id", F.col("main").alias("part")).distinct(), "doc_id")
        .select("doc_id", "shingles", "part").mapInArrow(_spread, "shingle long, doc_id long, part long")
        .select("shingle", "part").distinct()
    )
    reach = space.save(
        full.join(open_.where("component <> main").select("doc_id", F.col("main").alias("part")).distinct(), "doc_id")
        .select("doc_id", "shingles", "part").mapInArrow(_spread, "shingle long, doc_id long, part long")
        .join(union, ["shingle", "part"]).groupBy("doc_id", F.col("part").alias("main")).agg(F.count("*").alias("reach")), "reach")
    rows = open_.join(facts, "doc_id").where("common * 100 >= n * %d" % percent)
    outside = rows.where("component <> main").join(reach, ["doc_id", "main"], "left").fillna(0, ["reach"])
    both = F.least("a.common", "b.common")
    total = F.col("a.n") + F.col("b.n")
    first = F.array_position(F.zip_with("a.bands", "b.bands", lambda p, q: p == q), True)
    rest = (
        outside.alias("a").join(rows.alias("b"), (
            (F.col("a.band") == F.col("b.band")) & (F.col("a.component") != F.col("b.component"))
            & (((F.col("b.component") == F.col("b.main")) & (F.col("a.reach") * 100 >= (total - F.col("a.reach")) * percent))
               | ((F.col("b.component") != F.col("b.main")) & (F.col("a.doc_id") < F.col("b.doc_id"))))
            & (F.least("a.n", "b.n") * 100 >= F.greatest("a.n", "b.n") * percent)
            & (both * 100 >= (total - both) * percent)
            & (_matches("a", "b") >= agreeing(percent / 100))
            & (first == F.array_position("a.bands", F.col("a.band")))))
        .select(F.col("a.doc_id").alias("x"), F.col("b.doc_id").alias("y"))
    )
    more = space.save(confirmed(rest, full, percent), "more")
    final = components(links.unionByName(more), space, "final")

    found = (
        some.select("doc_id", "set_a", "set_b")
        .join(classes.withColumnRenamed("doc_id", "class"), ["set_a", "set_b"])
        .join(final.withColumnRenamed("doc_id", "class"), "class", "left")
        .select("doc_id", F.coalesce("component", "class").alias("component"))
    )
    return (
        sketches.select("doc_id", "n").join(found, "doc_id", "left")
        .select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))
    )


def _spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per shingle of (doc_id, shingles, part)."""
    for batch in batches:
        ids, parts = batch.column(0).to_numpy(), batch.column(2).to_numpy()
        for low in range(0, batch.num_rows, 50):
            values = [np.frombuffer(v.as_buffer(), np.int64) for v in batch.column(1).slice(low, 50)]
            size = [len(v) for v in values]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(values)), pa.array(np.repeat(ids[low:low + 50], size)),
                 pa.array(np.repeat(parts[low:low + 50], size))], ["shingle", "doc_id", "part"])
