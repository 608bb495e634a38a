"""Training sequences by vector best fit.

Documents become token ids with one end id each; those longer than a sequence are cut into whole sequences, the odd
piece first. A piece demands three things of a sequence: its tokens, one place among its documents, and its attention
cost, the square of its length. Pieces are placed by falling length. Of the open sequences with room for all three, a
piece takes the one that is left with the smallest weighted norm of what remains (``norm``), or the one whose remaining
room has the largest weighted dot product with the demand (``dot``); if none has room it opens another.

Pieces are dealt by a hash of document and piece into groups of about ``GROUP``, packed side by side; a group wastes
less than one sequence in a thousand. A piece that fills a sequence has one to itself.

Defined cases: a null or empty text is its end id alone; equal lengths are placed by doc_id and piece; rows that repeat
a doc_id are packed each; rows without doc_id are packed too; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tickloom.llm.store import Workspace
from tickloom.llm.tokens import tokens

GROUP = 8192
PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cuts(tokens: int, most: int) -> list[tuple[int, int]]:
    """(start, length) of each piece of a document; only the first may be shorter than ``most``."""
    if tokens <= most:
        return [(0, tokens)]
    first = tokens % most
    starts = ([0] if first else []) + list(range(first, tokens, most))
    return [(s, e - s) for s, e in zip(starts, [*starts[1:], tokens])]


def _pieces(vocabulary: tuple, end_id: int, most: int, with_ids: bool):
    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokens(*vocabulary)
        for batch in batches:
            rows: list[list] = [[] for _ in names]
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.append(encode(text.as_py() or ""), np.uint32(end_id)).astype("<u4")
                for k, (start, length) in enumerate(cuts(len(ids), most)):
                    own = ids[start:start + length].tobytes()
                    for column, value in zip(rows, (doc_id, k, start, length, zlib.crc32(own), own)):
                        column.append(value)
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds)], names)

    return run


def tokenized(
    docs: DataFrame, vocabulary: tuple, end_id: int = 0, most: int = 2048, with_ids: bool = False,
) -> DataFrame:
    """The pieces of every document: doc_id, piece, start, length, ids_crc32 and, if asked for, ids as bytes.

    ``vocabulary`` are the arguments of ``tokens.Tokens``.
    """
    return docs.select("doc_id", "text").mapInArrow(
        _pieces(vocabulary, end_id, most, with_ids), PIECE + ", ids binary" * with_ids)


def best_fit(
    length: np.ndarray, capacity: tuple[float, float, float], weights: tuple[float, float, float], rule: str = "norm",
) -> tuple[np.ndarray, np.ndarray]:
    """The bin of each piece and its offset there, for pieces in the order given."""
    room = np.asarray(capacity, float)
    scale = np.sqrt(np.asarray(weights, float)) / room
    left = np.empty((1024, 3))
    opened = 0
    live = np.empty(0, np.int64)
    place, offset = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
    least = int(length.min()) if len(length) else 0
    for k, size in enumerate(length.tolist()):
        need = np.array([size, 1.0, float(size) ** 2])
        if (need > room).any():
            raise ValueError(f"a piece of {size} tokens exceeds a sequence's capacities")
        rest = left[live] - need
        fits = np.flatnonzero((rest >= 0).all(1))
        if len(fits):
            if rule == "dot":
                score = -((left[live[fits]] * scale) @ (need * scale))
            else:
                score = ((rest[fits] * scale) ** 2).sum(1)
            at = int(fits[score.argmin()])
            chosen = int(live[at])
        else:
            if opened == len(left):
                left = np.concatenate([left, np.empty_like(left)])
            chosen, at = opened, len(live)
            left[chosen] = room
            live = np.append(live, chosen)
            opened += 1
        place[k] = chosen
        offset[k] = room[0] - left[chosen, 0]
        left[chosen] -= need
        if left[chosen, 0] < least or left[chosen, 1] < 1:
            live = np.delete(live, at)
    return place, offset


def pack(
    pieces: DataFrame, most: int = 2048, documents: int | None = None, attention: float | None = None,
    weights: tuple[float, float, float] = (1.0, 1e-9, 1e-9), rule: str = "norm",
) -> DataFrame:
    """``pieces`` (doc_id, piece, length, ...) with sequence_id and offset.

    ``documents`` and ``attention`` default to what a sequence of ``most`` tokens can hold at all.
    """
    capacity = (most, documents or most, attention or float(most) ** 2)
    groups = max(1, math.ceil(pieces.count() / GROUP))
    order = pieces.withColumn("group", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(groups)))

    def packed(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending")])
        place, offset = best_fit(rows["length"].to_numpy(), capacity, weights, rule)
        sequence = (rows["group"].to_numpy() << 32) + place
        return rows.drop_columns("group").append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return order.groupBy("group").applyInArrow(packed, f"{schema}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, vocabulary: tuple, end_id: int = 0, most: int = 2048, **options) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset of every piece."""
    space = Workspace(docs.sparkSession, "packing")
    pieces = space.save(tokenized(docs, vocabulary, end_id, most), "pieces")
    return pack(pieces, most, **options)
