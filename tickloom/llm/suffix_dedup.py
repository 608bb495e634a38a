"""Exact substring removal by a logarithmic family of suffix arrays.

A byte goes if a string of ``length`` bytes covering it also starts anywhere else. Sorting every suffix of a large
corpus is not needed for that: in each ``length``-byte string the 32-byte gram with the least fingerprint, the leftmost
of equals, is its anchor, so equal strings have equal anchors at equal offsets. A batch of documents becomes a suffix
array of its anchors (one position in 85), in the order of the grams' fingerprints. An insert merge-scans the new array
against every level for grams in common, and two levels of one size merge into the next, so n batches leave at most
log2(n) + 1 arrays.

Anchors with equal contexts, all bytes that a string through them can reach, by fingerprint, are repeats as far as
these go. For one of each such class, and all others, the suffixes are fetched and sorted by their bytes. Around one
anchor, for each offset of a string before it, equal strings are those in one interval of the common-prefix array with
equal bytes to the left. A gram with more than ``MOST`` contexts is dealt out by document: each part finds its own repeats and passes on one copy of
every string, and the parts' strings are counted together, dealt out by the strings' own fingerprints.

Defined cases: null text is empty, and a text shorter than ``length`` loses nothing; a document is compared with itself
too; rows that repeat a doc_id, with its text or another, and rows without one are documents of their own; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tickloom.llm.store import Workspace, free_name, own_ids
from tickloom.llm.text import BYTE, Prefix, mix, pieces, powers, raw

GRAM = 32
#: Contexts of one gram that are compared in one task; more are dealt out.
MOST = 512
SEGMENT = 1 << 22
_LOW = np.uint64((1 << 24) - 1)


def anchors(buf: np.ndarray, ranges: list[tuple[int, int]], length: int) -> tuple[np.ndarray, np.ndarray, Prefix]:
    """Anchor positions of the strings that start in ``ranges``, all grams' fingerprints, and those of the bytes."""
    width = length - GRAM + 1
    n = len(buf) - GRAM + 1
    prefix = Prefix(buf)
    if n < width:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), prefix
    grams = mix((prefix.sums[GRAM:] - prefix.sums[:n]) * prefix.inverse[:n])
    blocks = -(-n // width)
    packed = np.full(blocks * width, ~np.uint64(0))
    packed[:n] = (grams & ~_LOW) | np.arange(n, dtype=np.uint64)
    packed = packed.reshape(blocks, width)
    ahead = np.minimum.accumulate(packed, axis=1).ravel()
    behind = np.minimum.accumulate(packed[:, ::-1], axis=1)[:, ::-1].ravel()
    windows = n - width + 1
    least = np.minimum(behind[:windows], ahead[width - 1:width - 1 + windows])
    inside = np.zeros(windows + 1, np.int8)
    for low, high in ranges:
        if high > low:
            inside[low] += 1
            inside[high] -= 1
    where = (least[np.cumsum(inside[:-1], dtype=np.int8) > 0] & _LOW).astype(np.int64)
    return where[np.flatnonzero(np.diff(where, prepend=-1))], grams, prefix


def _found(buf: np.ndarray, at: np.ndarray, ranges: list, length: int) -> tuple[np.ndarray, ...]:
    """Row, place in the row, gram and whole context's fingerprint of each anchor."""
    where, grams, prefix = anchors(buf, ranges, length)
    row = np.searchsorted(at, where, "right") - 1
    low = np.maximum(at[row], where - (length - GRAM))
    high = np.minimum(at[row + 1], where + length)
    around = mix(prefix(low, high) ^ mix((where - low).astype(np.uint64)))
    return row, where - at[row], grams[where] if len(where) else grams[:0], around


def _anchor_rows(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left = length - GRAM
        for batch in batches:
            buf, at = raw(batch.column(1))
            ids = batch.column(0).to_numpy()
            for low, high in pieces(at):
                if at[high] - at[low] <= SEGMENT:
                    own = at[low:high + 1] - at[low]
                    ranges = [(s, e - length + 1) for s, e in zip(own[:-1].tolist(), own[1:].tolist())]
                    row, place, grams, around = _found(buf[at[low]:at[high]], own, ranges, length)
                else:  # one very long row, in parts that overlap by all that an anchor's context can hold
                    parts, size = [], int(at[high] - at[low])
                    for begin in range(0, size - length + 1, SEGMENT):
                        start, end = max(0, begin - left), min(size, begin + SEGMENT + left + length)
                        strings = min(begin + SEGMENT, size - length + 1)
                        part = _found(buf[at[low] + start:at[low] + end], np.array([0, end - start]),
                                      [(begin - start, strings - start)], length)
                        parts.append((part[0], part[1] + start, part[2], part[3]))
                    row, place, grams, around = (np.concatenate(c) for c in zip(*parts))
                    place, first = np.unique(place, return_index=True)
                    row, grams, around = row[first], grams[first], around[first]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(grams.view(np.int64)), pa.array(around.view(np.int64)), pa.array(ids[low + row]),
                     pa.array(place)], ["gram", "around", "doc_id", "place"])

    return run


class SuffixFamily:
    """Suffix arrays of the batches inserted so far, in levels of 1, 2, 4, ... batches."""

    def __init__(self, spark: SparkSession, length: int = 200):
        self.space = Workspace(spark, "suffix")
        self.length = length
        self.levels: list[tuple[int, str, DataFrame]] = []
        self.shared: list[DataFrame] = []
        self.batches = 0

    def insert(self, docs: DataFrame) -> DataFrame:
        """Add a batch and return the grams it shares, within itself or with any level, with their places so far."""
        self.batches += 1
        name = f"array_{self.batches}"
        rows = docs.where("doc_id is not null").select("doc_id", "text").mapInArrow(
            _anchor_rows(self.length), "gram long, around long, doc_id long, place long")
        new = self.space.save(rows.sortWithinPartitions("gram"), name)
        places = new.select("gram", F.lit(1).alias("new"))
        for _, _, level in self.levels:
            places = places.unionByName(level.select("gram", F.lit(0).alias("new")))
        found = (
            places.groupBy("gram").agg(F.count("*").alias("places"), F.max("new").alias("new"))
            .where("places > 1 and new = 1").select("gram", "places")
        )
        found = self.space.save(found, f"shared_{self.batches}")
        self.shared.append(found)
        self.levels.append((1, name, new))
        while len(self.levels) > 1 and self.levels[-1][0] == self.levels[-2][0]:
            self._merge()
        return found

    def _merge(self) -> None:
        (size, a, x), (_, b, y) = self.levels.pop(), self.levels.pop()
        name = f"merged_{self.batches}_{2 * size}"
        both = x.unionByName(y).repartitionByRange("gram", "doc_id", "place").sortWithinPartitions("gram")
        self.levels.append((2 * size, name, self.space.save(both, name)))
        self.space.drop(a)
        self.space.drop(b)

    def candidates(self) -> DataFrame:
        """Every anchor whose gram has another place: gram, around, doc_id, place."""
        shared = self.shared[0].select("gram")
        for more in self.shared[1:]:
            shared = shared.unionByName(more.select("gram"))
        level = self.levels[0][2]
        for _, _, more in self.levels[1:]:
            level = level.unionByName(more)
        return level.join(shared.distinct(), "gram")


def _contexts(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left = length - GRAM
        for batch in batches:
            buf, at = raw(batch.column(1))
            ids = batch.column(0).to_numpy()
            lists = batch.column(2)
            for low in range(0, batch.num_rows, 64):
                part = lists.slice(low, min(64, batch.num_rows - low))
                flat = part.flatten()
                row = low + np.repeat(np.arange(len(part)), pa.compute.list_value_length(part).to_numpy())
                place = flat.field("place").to_numpy()
                start = np.maximum(at[row] + place - left, at[row])
                end = np.minimum(at[row] + place + length, at[row + 1])
                for k in range(0, len(row), 20_000):
                    s, e = start[k:k + 20_000], end[k:k + 20_000]
                    here = at[row[k:k + 20_000]] + place[k:k + 20_000]
                    yield pa.RecordBatch.from_arrays(
                        [flat.field("gram").slice(k, len(s)), flat.field("part").slice(k, len(s)),
                         flat.field("parts").slice(k, len(s)), pa.array(ids[row[k:k + 20_000]]),
                         pa.array(place[k:k + 20_000]), pa.array((here - s).astype(np.int32)),
                         pa.array([buf[i:j].tobytes() for i, j in zip(s.tolist(), e.tolist())], pa.binary())],
                        ["gram", "part", "parts", "doc_id", "place", "before", "bytes"])

    return run


def repeats(gram: np.ndarray, before: np.ndarray, context: list[bytes], length: int):
    """For each offset before the anchor: (offset, rows with a string there, repeated?, first of its equals?, prints).

    The suffixes are sorted; those that begin alike for as long as the string goes on lie in one interval.
    """
    n, left = len(gram), length - GRAM
    suffix = [c[b:] for c, b in zip(context, before.tolist())]
    order = np.array(sorted(range(n), key=lambda i: (gram[i], suffix[i])), np.int64)
    gram, before = gram[order], before[order]
    after = np.array([len(suffix[i]) for i in order])
    ahead = np.zeros((n, length), np.uint8)
    back = np.zeros((n, left), np.uint8)
    for k, i in enumerate(order.tolist()):
        s, c = suffix[i], context[i]
        ahead[k, :len(s)] = np.frombuffer(s, np.uint8)
        b = int(before[k])
        back[k, :b] = np.frombuffer(c, np.uint8, b)[::-1]
    common = np.zeros(n, np.int64)
    if n > 1:
        differ = ahead[1:] != ahead[:-1]
        common[1:] = np.where(differ.any(1), differ.argmax(1), length)
        common[1:] = np.minimum(common[1:], np.minimum(after[1:], after[:-1]))
        common[1:][gram[1:] != gram[:-1]] = 0
    heads = np.cumsum(BYTE[ahead] * powers(length)[0], axis=1, dtype=np.uint64)
    tail = np.zeros(n, np.uint64)
    for offset in range(left + 1):
        if offset:
            tail = mix(tail * np.uint64(0x9E3779B97F4A7C15) + back[:, offset - 1].astype(np.uint64) + np.uint64(1))
        has = np.flatnonzero((before >= offset) & (after >= length - offset))
        interval = np.cumsum(common < length - offset)[has].astype(np.uint64)
        code = mix(mix(interval) ^ tail[has])
        by = np.argsort(code)
        same = np.zeros(len(has) + 1, bool)
        same[1:-1] = code[by][1:] == code[by][:-1]
        again = np.zeros(len(has), bool)
        again[by] = same[1:] | same[:-1]
        first = np.zeros(len(has), bool)
        first[by] = ~same[:-1]
        yield offset, order[has], again, first, np.stack([mix(tail[has] + np.uint64(offset)), heads[has, length - offset - 1]], 1)


#: A string that is passed on; ``open`` where its span is not yet within what its own part has found.
_PASSED = np.dtype([
    ("share", "<i4"), ("a", "<u8"), ("b", "<u8"), ("doc_id", "<i8"), ("place", "<i8"), ("offset", "<i2"), ("open", "?")])
#: Passed strings that one share may hold; there are as many shares as that asks for.
PER_SHARE = 1 << 20


def _scan(length: int, shares: int):
    """Spans of repeated strings; strings of a dealt-out gram go on, packed, to one of ``shares``."""
    def whole(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        gram = rows.column("gram").to_numpy()
        before = rows.column("before").to_numpy().astype(np.int64)
        doc, place = rows.column("doc_id").to_numpy(), rows.column("place").to_numpy()
        dealt = rows.column("parts").to_numpy() > 1
        context = rows.column("bytes").to_pylist()
        most, least = np.full(len(gram), -1), np.full(len(gram), -1)
        passed = []
        for offset, row, again, first, prints in repeats(gram, before, context, length):
            hit = row[again]
            most[hit] = offset
            least[hit] = np.where(least[hit] < 0, offset, least[hit])
            own = dealt[row] & first
            go, prints = row[own], prints[own]
            if len(go):
                out = np.empty(len(go), _PASSED)
                out["a"], out["b"], out["doc_id"], out["place"], out["offset"] = *prints.T, doc[go], place[go], offset
                out["share"] = mix(out["a"] ^ mix(out["b"])) % np.uint64(shares)
                passed.append((go, offset, out))
        hit = np.flatnonzero(most >= 0)
        none = pa.nulls(len(hit), pa.int32())
        yield pa.RecordBatch.from_arrays(
            [pa.array(doc[hit]), pa.array(place[hit] - most[hit]), pa.array(place[hit] - least[hit] + length), none,
             pa.nulls(len(hit), pa.binary())], ["doc_id", "start", "end", "share", "strings"])
        if passed:
            for go, offset, out in passed:
                out["open"] = (offset > most[go]) | (offset < least[go])
            rows = np.concatenate([out for _, _, out in passed])
            rows = rows[np.argsort(rows["share"], kind="stable")]
            share = rows["share"]
            cut = np.flatnonzero(np.diff(share, prepend=-1))
            blobs = [r.tobytes() for r in np.split(rows, cut[1:])]
            nothing = pa.nulls(len(cut), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [nothing, nothing, nothing, pa.array(share[cut]), pa.array(blobs, pa.binary())],
                ["doc_id", "start", "end", "share", "strings"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        count, last = 0, None
        for batch in batches:
            gram, part = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            begin = 0
            news = np.ones(len(gram), bool)
            news[1:] = (gram[1:] != gram[:-1]) | (part[1:] != part[:-1])
            if len(gram):
                news[0] = last != (gram[0], part[0])
                last = gram[-1], part[-1]
            for k in np.flatnonzero(news).tolist():
                if count + k - begin >= 8192:
                    held.append(batch.slice(begin, k - begin))
                    yield from whole(pa.Table.from_batches(held))
                    held, count, begin = [], 0, k
            held.append(batch.slice(begin))
            count += batch.num_rows - begin
        if count:
            yield from whole(pa.Table.from_batches(held))

    return run


def _count_strings(length: int):
    """Spans of the strings that several parts of a gram's places have. A string's copies are all in one share."""
    def whole(blobs: list[bytes]) -> pa.RecordBatch:
        rows = np.frombuffer(b"".join(blobs), _PASSED)
        rows = rows[np.lexsort((rows["b"], rows["a"]))]
        same = np.zeros(len(rows) + 1, bool)
        same[1:-1] = (rows["a"][1:] == rows["a"][:-1]) & (rows["b"][1:] == rows["b"][:-1])
        rows = rows[(same[1:] | same[:-1]) & rows["open"]]
        # strings around one anchor overlap in it, so their union is one span
        rows = rows[np.lexsort((rows["offset"], rows["place"], rows["doc_id"]))]
        new = np.ones(len(rows) + 1, bool)
        new[1:-1] = (rows["doc_id"][1:] != rows["doc_id"][:-1]) | (rows["place"][1:] != rows["place"][:-1])
        least, most = rows[new[:-1]], rows[new[1:]]
        return pa.RecordBatch.from_arrays(
            [pa.array(least["doc_id"]), pa.array(least["place"]), pa.array(most["place"] - most["offset"]),
             pa.array(least["place"] - least["offset"] + length)], ["doc_id", "place", "start", "end"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, last = [], None
        for batch in batches:
            for share, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if share != last and held:
                    yield whole(held)
                    held = []
                last = share
                held.append(blob)
        if held:
            yield whole(held)

    return run


def repeated_spans(docs: DataFrame, length: int = 200, batches: int = 3) -> DataFrame:
    """(doc_id, spans) for each document with repeated strings; spans is an array of overlapping (start, end)."""
    spark = docs.sparkSession
    family = SuffixFamily(spark, length)
    for k in range(batches):
        family.insert(docs.where(F.pmod(F.hash("doc_id"), F.lit(batches)) == k))
    left = length - GRAM
    found = family.space.save(family.candidates(), "candidates")
    contexts = found.groupBy("gram", "around").agg(
        F.count("*").alias("copies"), F.min(F.struct("doc_id", "place")).alias("first"))
    kinds = contexts.groupBy("gram").agg(F.count("*").alias("kinds"))
    contexts = family.space.save(contexts.join(kinds, "gram"), "contexts")
    dealt_out = contexts.where(F.col("kinds") > MOST).count()
    placed = family.space.save(found.join(contexts, ["gram", "around"]), "placed")
    family.space.drop("candidates")
    family.space.drop("contexts")
    alike = placed.where("copies > 1").select(
        "doc_id", F.greatest(F.col("place") - left, F.lit(0)).alias("start"), (F.col("place") + length).alias("end"))
    parts = F.ceil(F.col("kinds") / MOST).cast("int")
    dealt = placed.where("kinds > 1 and (copies = 1 or first = struct(doc_id, place))").select(
        "doc_id", F.struct("place", "gram", F.pmod(F.hash("doc_id", "place"), parts).alias("part"), parts.alias("parts")).alias("anchor"))
    wanted = dealt.groupBy("doc_id").agg(F.collect_list("anchor").alias("anchors"))
    fetched = (
        docs.select("doc_id", "text").join(wanted, "doc_id")
        .mapInArrow(_contexts(length), "gram long, part int, parts int, doc_id long, place long, before int, bytes binary")
        .repartition("gram", "part").sortWithinPartitions("gram", "part")
    )
    shares = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-dealt_out * (left + 1) // PER_SHARE))
    scanned = family.space.save(
        fetched.mapInArrow(_scan(length, shares), "doc_id long, start long, end long, share int, strings binary"), "scanned")
    several = (
        scanned.where("share is not null").select("share", "strings").repartition(shares, "share").sortWithinPartitions("share")
        .mapInArrow(_count_strings(length), "doc_id long, place long, start long, end long")
        .groupBy("doc_id", "place").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("place")
    )
    spans = scanned.where("share is null").select("doc_id", "start", "end").unionByName(several).unionByName(alike)
    return spans.groupBy("doc_id").agg(F.collect_set(F.struct("start", "end")).alias("spans"))


def merged(spans: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs of overlapping or touching (start, end) rows."""
    out: list[list[int]] = []
    for s, e in spans[np.lexsort((spans[:, 1], spans[:, 0]))].tolist():
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [tuple(x) for x in out]


def _gone(spans: pa.Scalar, size: int) -> tuple[np.ndarray, int]:
    """Which bytes of a document its spans cover, and in how many runs."""
    gone = np.zeros(size, bool)
    if not spans.is_valid:
        return gone, 0
    flat = spans.values
    rows = merged(np.stack([flat.field("start").to_numpy(), flat.field("end").to_numpy()], 1))
    rows = [(s, e) for s, e in rows if s < size]
    for s, e in rows:
        gone[s:e] = True
    return gone, len(rows)


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        buf, at = raw(batch.column(1))
        lists = batch.column(2)
        removed, runs, kept = [], [], []
        for k in range(batch.num_rows):
            own = buf[at[k]:at[k + 1]]
            gone, n = _gone(lists[k], len(own))
            removed.append(int(gone.sum())), runs.append(n), kept.append(own[~gone].tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(np.diff(at)), pa.array(removed, pa.int64()), pa.array(runs, pa.int64()),
             pa.array(kept, pa.binary())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])


def _told_apart(docs: DataFrame) -> tuple[DataFrame, str]:
    """The rows, and a column that tells them apart: doc_id where every row has its own, else a number."""
    if own_ids(docs):
        return docs, "doc_id"
    number = free_name(docs, "row")
    return Workspace(docs.sparkSession, "suffix_rows").numbered(docs, number), number


def remove_repeats(docs: DataFrame, length: int = 200, batches: int = 3) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept (the bytes that remain)."""
    rows, key = _told_apart(docs.select("doc_id", "text"))
    spans = repeated_spans(rows.select(F.col(key).alias("doc_id"), "text"), length, batches)
    joined = rows.join(spans.withColumnRenamed("doc_id", key), key, "left").select("doc_id", "text", "spans")
    return joined.mapInArrow(_kept, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def cut_repeats(docs: DataFrame, length: int = 200, batches: int = 3) -> DataFrame:
    """``docs`` with repeated strings cut from ``text``; of a sign that is cut in part nothing stays. Null stays null."""
    rows, key = _told_apart(docs)
    place, width, found = docs.columns.index("text"), len(docs.columns), free_name(docs, "spans")
    spans = repeated_spans(rows.select(F.col(key).alias("doc_id"), "text"), length, batches)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            buf, at = raw(batch.column(place))
            lists, texts = batch.column(width), []
            for k, text in enumerate(batch.column(place)):
                own = buf[at[k]:at[k + 1]]
                kept = own[~_gone(lists[k], len(own))[0]] if lists[k].is_valid else own
                texts.append(kept.tobytes().decode("utf-8", "ignore") if text.is_valid else None)
            rest = pa.RecordBatch.from_arrays(batch.columns[:width], schema=pa.schema(list(batch.schema)[:width]))
            yield rest.set_column(place, batch.schema.field(place).name, pa.array(texts, pa.string()))

    spans = spans.select(F.col("doc_id").alias(key), F.col("spans").alias(found))
    return rows.join(spans, key, "left").select(*docs.columns, found).mapInArrow(run, docs.schema)
