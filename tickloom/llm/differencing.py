"""Training windows by Karmarkar-Karp multiway differencing.

A document is its token ids and one end id. What fills whole windows is cut off first, each such piece a window of its
own. What is left is shared out over k windows by differencing: every piece begins as a partial partition of its own,
one window that holds it and k - 1 empty ones. The two partial partitions with the largest imbalances (largest window
less smallest) are merged, the largest windows of one with the smallest of the other, so that imbalances cancel, until
one partition is left, whose windows are nearly equal. k begins at the least number that could hold all; whenever the
largest window exceeds the capacity k rises, by doubled steps and then back to the least k found that fits.

Windows can only be nearly equal if there are small pieces to make up for large ones. So the rest of a cut document, and
a share of the documents that would fit a window (``share``, by row), are cut into lengths that are powers of two.

Pieces are dealt by a hash of document and row into groups of about ``GROUP``, shared out side by side. A group adds at
most the padding of its own last window.

Defined cases: a null or empty text is its end id alone; equal lengths are taken by doc_id, row and start; rows that
repeat a doc_id are packed each, as are rows without one; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from bisect import insort
from collections.abc import Iterator
import heapq
import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tickloom.llm.store import Workspace
from tickloom.llm.tokens import tokens

GROUP = 8192
PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, row long"


def cuts(size: int, most: int, fine: bool) -> list[int]:
    """Lengths of a document's pieces, in order: whole windows, then the rest, cut fine if it is to balance others."""
    whole, rest = divmod(size, most)
    if whole == 0 and not fine:
        return [size]
    return [most] * whole + [1 << bit for bit in range(rest.bit_length() - 1, -1, -1) if rest >> bit & 1]


def _pieces(vocabulary: tuple, end_id: int, most: int, share: float):
    schema = pa.schema([("doc_id", pa.int64()), *((n, pa.int64()) for n in ("start", "length", "ids_crc32", "doc_tokens", "row"))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, row = tokens(*vocabulary), 0
        for batch in batches:
            columns: list[list] = [[] for _ in schema]
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.append(encode(text.as_py() or ""), np.uint32(end_id)).astype("<u4")
                row += 1
                fine = math.floor(row * share) > math.floor((row - 1) * share)
                start = 0
                for length in cuts(len(ids), most, fine):
                    crc = zlib.crc32(ids[start:start + length].tobytes())
                    for column, value in zip(columns, (doc_id, start, length, crc, len(ids), row)):
                        column.append(value)
                    start += length
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=schema)

    return run


def tokenized(docs: DataFrame, vocabulary: tuple, end_id: int = 0, most: int = 1024, share: float = 0.5) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens and row (its document's place in the task) of every piece."""
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_pieces(vocabulary, end_id, most, share), PIECE)


def difference(lengths: list[int], k: int) -> list[tuple[int, list[int]]]:
    """(sum, indexes) of at most k windows; the rest of the k are empty. ``lengths`` must fall.

    A partial partition is the list of its windows that hold something, from the smallest up; its others are empty.
    """
    items = [[i] for i in range(len(lengths))]
    heap = [(-size, i, [(size, i)]) for i, size in enumerate(lengths)]
    made = len(heap)
    while len(heap) > 1:
        large, small = heapq.heappop(heap)[2], heapq.heappop(heap)[2]
        if len(large) < len(small):
            large, small = small, large
        both = max(0, len(large) + len(small) - k)
        joined = []
        for (s, i), (t, j) in zip(large[:both], reversed(small[:both])):
            if len(items[i]) < len(items[j]):
                i, j = j, i
            items[i] += items[j]
            items[j] = []
            joined.append((s + t, i))
        joined += small[both:]
        del large[:both]
        if len(joined) < 16:
            for window in joined:
                insort(large, window)
        else:
            large = sorted(large + joined)
        least = large[0][0] if len(large) == k else 0
        heapq.heappush(heap, (least - large[-1][0], made, large))
        made += 1
    return [(total, items[i]) for total, i in heap[0][2]] if heap else []


def windows(lengths: list[int], most: int) -> list[tuple[int, list[int]]]:
    """Nearly equal windows of at most ``most`` tokens, as few as differencing fits; ``lengths`` must fall."""
    def tried(k: int) -> list[tuple[int, list[int]]] | None:
        found = difference(lengths, k)
        return found if max((total for total, _ in found), default=0) <= most else None

    low = math.ceil(sum(lengths) / most)
    if (found := tried(low)) is not None:
        return found
    step = 1
    while (found := tried(low + step)) is None:
        low, step = low + step, 2 * step
    high = low + step
    while high - low > 1:
        middle = (low + high) // 2
        less = tried(middle)
        low, high, found = (middle, high, found) if less is None else (low, middle, less)
    return found


def share_out(pieces: DataFrame, most: int = 1024) -> DataFrame:
    """``pieces`` with sequence_id and offset."""
    groups = max(1, math.ceil(pieces.count() / GROUP))
    dealt = pieces.withColumn("group", F.pmod(F.xxhash64("doc_id", "row", "start"), F.lit(groups)))

    def packed(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("length", "descending"), ("doc_id", "ascending"), ("row", "ascending"), ("start", "ascending")])
        lengths = rows["length"].to_pylist()
        whole = sum(size == most for size in lengths)
        sequence, offset = np.arange(len(lengths)), np.zeros(len(lengths), np.int64)
        for k, (_, members) in enumerate(windows(lengths[whole:], most)):
            at = 0
            for i in sorted(members):
                sequence[whole + i], offset[whole + i] = whole + k, at
                at += lengths[whole + i]
        sequence += rows["group"].to_numpy() << 32
        return rows.drop_columns(["group", "row"]).append_column("sequence_id", pa.array(sequence)).append_column(
            "offset", pa.array(offset))

    schema = PIECE.removesuffix(", row long")
    return dealt.groupBy("group").applyInArrow(packed, f"{schema}, sequence_id long, offset long")


def pack_evenly(
    docs: DataFrame, vocabulary: tuple, end_id: int = 0, most: int = 1024, share: float = 0.5,
) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id and offset of every piece.

    ``vocabulary`` are the arguments of ``tokens.Tokens``. With ``share`` 0 only documents longer than a window are cut.
    """
    space = Workspace(docs.sparkSession, "differencing")
    return share_out(space.save(tokenized(docs, vocabulary, end_id, most, share), "pieces"), most)
