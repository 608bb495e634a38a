"""Exact top-k inner products by MaxScore over shards.

A vector is a bag of terms: a dimension with a sign, whose weight is the component's size. A shard keeps a posting list
per term, by falling weight. A query component scores on the list of its own sign, and takes away on the other. Terms
are ordered by their score bound, the query's weight times the list's largest. With the k-th best score of some rows at
the heads of the best lists as threshold, the terms whose bounds together stay below it are non-essential: a row on none
of the other lists cannot reach the threshold. Rows on essential lists are scored there, then probed for the rest, a few
terms at a time, while score and remaining bounds together still reach the threshold. The shards' best are merged.

Queries come in blocks, each of which meets a shard at once: one product of matrices scores the essential terms of all
its queries and begins to probe; a row's score so far with the bounds of the other terms tells whether it is probed on.
Blocks are dealt into sets and shards into bundles. A task holds one set and reads one bundle shard by shard, so what it
holds does not grow with the data, and what one shard found is the least threshold for the next. A set is sent once a
bundle, not once a shard, and bundles are so few that queries sent are about as many as vectors. Blocks and shards meet
in a task, not in a join, so nothing is broadcast. Ties of score go to the smaller vec_id.

Defined cases: vectors that are null, or hold null or a value that is not finite, and rows without vec_id take no part;
of rows that repeat a vec_id each is a candidate, and a query, of its own; vectors of another length than the query's
are not its candidates; other columns are ignored. Scores are exact while they fit 63 bits.
"""

from __future__ import annotations

from collections.abc import Iterator
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from tickloom.llm.store import Workspace

SHARD, BLOCK = 8192, 256
#: Queries of a set, about.
SET = 1 << 15
#: Rows at the head of a list, and lists, that give the first threshold.
HEAD, LISTS = 16, 8
#: Non-essential terms probed between two prunings.
STEP = 6
#: A block's first probe goes on until what the other terms can add is below this part of the threshold: up to there
#: about every row is probed, by the product that scores the essential terms.
REST = 0.25


class Block:
    """Some queries and the k best that were found for each of them."""

    def __init__(self, keys: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int):
        self.keys, self.ids, self.rows, self.k = keys, ids, rows.astype(np.int64), k
        self.real, self.most = rows.astype(np.float64), _most(rows)
        self.found = (np.zeros(0, np.int64),) * 3  # query, score, id
        self.least = np.full(len(keys), -np.inf)  # the k-th best score so far

    def take(self, query: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        query, score, ids = (np.concatenate(v) for v in zip(self.found, (query, score, ids)))
        order = np.lexsort((ids, -score, query))
        query, score, ids = query[order], score[order], ids[order]
        rank = np.arange(len(query)) - np.searchsorted(query, query)
        keep = rank < self.k
        self.found = query[keep], score[keep], ids[keep]
        last = rank == self.k - 1
        self.least[query[last]] = score[last]


def _most(rows: np.ndarray) -> int:
    """The size of the largest component."""
    return max(int(rows.max()), -int(rows.min())) if rows.size else 0


class Shard:
    """Posting lists of some vectors; ``keys`` tell them apart."""

    def __init__(self, keys: np.ndarray, ids: np.ndarray, rows: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.keys, self.ids, self.rows = keys[order], ids[order], rows[order]
        self.real, self.most, self.by_key = self.rows.astype(np.float64), _most(rows), np.argsort(self.keys)
        order = np.argsort(self.rows, axis=0, kind="stable")
        self.lists = []  # by dimension: rows with a positive, with a negative component, the largest first
        self.heads, self.top = np.full((2, rows.shape[1], HEAD), -1), np.zeros((2, rows.shape[1]))
        for d in range(rows.shape[1]):
            own = order[:, d]
            value = self.rows[own, d]
            self.lists.append((own[value > 0][::-1], own[value < 0]))
            for side, rows_on in enumerate(self.lists[-1]):
                self.heads[side, d, :len(rows_on[:HEAD])] = rows_on[:HEAD]
                self.top[side, d] = abs(int(self.rows[rows_on[0], d])) if len(rows_on) else 0

    def meet(self, block: Block) -> None:
        """Give a block its queries' best rows here. Doubles are exact while no sum reaches 2**53."""
        if self.most * block.most * self.rows.shape[1] < 1 << 53:
            block.take(*self._best_of(block))
            return
        for n, (key, query) in enumerate(zip(block.keys.tolist(), block.rows)):
            ids, score = self.best(key, query, block.k)
            block.take(np.full(len(ids), n), score, ids)

    def _best_of(self, block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Queries, scores and ids of what can be among the best; all queries of a block at once."""
        query, k, (n, width) = block.real, block.k, self.rows.shape
        side = (query < 0).astype(np.int64)
        bound = np.abs(query) * self.top[side, np.arange(width)]
        order = np.argsort(-bound, axis=1, kind="stable")
        bound, sorted_query, side = (np.take_along_axis(v, order, 1) for v in (bound, query, side))
        after = np.cumsum(bound[:, ::-1], axis=1)[:, ::-1]  # what a term and all later ones can add
        after, terms, weights = (np.pad(v, ((0, 0), (0, STEP))) for v in (after, order, sorted_query))
        place = self.by_key[np.minimum(np.searchsorted(self.keys, block.keys, sorter=self.by_key), n - 1)]
        own = np.where(self.keys[place] == block.keys, place, -1)

        threshold = block.least
        head = np.sort(self.heads[side[:, :LISTS], order[:, :LISTS]].reshape(len(query), -1), axis=1)
        if head.shape[1] >= k:
            other = (head >= 0) & (head != own[:, None])
            other[:, 1:] &= head[:, 1:] != head[:, :-1]
            score = np.where(other, np.matmul(self.real[head], query[:, :, None])[:, :, 0], -np.inf)
            threshold = np.maximum(threshold, np.partition(score, head.shape[1] - k, axis=1)[:, head.shape[1] - k])
        whole = threshold <= 0  # rows on no list may count
        scored = np.where(whole, width, np.count_nonzero(after[:, :width] >= REST * threshold[:, None], axis=1))
        used = np.zeros(query.shape, bool)
        np.put_along_axis(used, order, np.arange(width) < scored[:, None], 1)
        # a row on no essential list cannot pass: what all other terms add to it stays below the threshold
        score = np.where(used, query, 0) @ self.real.T
        self_at = np.flatnonzero(own >= 0)
        score[self_at, own[self_at]] = -np.inf
        if whole.any() and n >= k:
            threshold = threshold.copy()
            threshold[whole] = np.maximum(threshold[whole], np.partition(score[whole], n - k, axis=1)[:, n - k])
        row, at = np.nonzero(score >= (threshold - after[np.arange(len(query)), scored])[:, None])
        left = at != own[row]
        row, at = row[left], at[left]
        score, begin = score[row, at], scored[row]
        while (begin < width).any():
            of = row[:, None], begin[:, None] + np.arange(STEP)
            score = score + (self.real[at[:, None], terms[of]] * weights[of]).sum(1)
            begin = np.minimum(begin + STEP, width)
            left = score + after[row, begin] >= threshold[row]
            row, at, score, begin = row[left], at[left], score[left], begin[left]
        return row, score.astype(np.int64), self.ids[at]

    def best(self, key: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best rows other than the query's."""
        dims = np.flatnonzero(query)
        lists = [self.lists[d][0 if query[d] > 0 else 1] for d in dims.tolist()]
        bound = np.array([abs(int(query[d]) * int(self.rows[own[0], d])) if len(own) else 0 for d, own in zip(dims.tolist(), lists)], np.int64)
        order = np.argsort(-bound, kind="stable")
        dims, bound, lists = dims[order], bound[order], [lists[i] for i in order.tolist()]
        others = self.keys != key
        threshold = None
        if lists:
            head = np.unique(np.concatenate([own[:HEAD] for own in lists[:LISTS]]))
            head = head[others[head]]
            if len(head) >= k:
                threshold = int(np.partition(self.rows[head] @ query, len(head) - k)[len(head) - k])
        if threshold is None or threshold <= 0:
            at, essential = np.flatnonzero(others), len(dims)  # rows on no list may count
        else:
            after = np.cumsum(bound[::-1])[::-1]  # what a term and all later ones can add
            essential = int(np.count_nonzero(after >= threshold))
            on = np.zeros(len(self.ids), bool)
            for own in lists[:essential]:
                on[own] = True
            at = np.flatnonzero(on & others)
        score = self.rows[at][:, dims[:essential]] @ query[dims[:essential]]
        for begin in range(essential, len(dims), STEP):
            keep = score + int(bound[begin:].sum()) >= threshold
            at, own = at[keep], dims[begin:begin + STEP]
            score = score[keep] + self.rows[at][:, own] @ query[own]
        top = np.lexsort((at, -score))[:k]
        return self.ids[at[top]], score[top]


PACK = "pack long, size int, keys binary, ids binary, rows binary"


def _packed(most: int):
    """Rows (row, vec_id, vector) of one length together, about ``most`` at a time, in the fewest bytes a number."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, count = TaskContext.get().partitionId() << 32, {}, 0

        def out() -> Iterator[pa.RecordBatch]:
            nonlocal number
            for size, parts in held.items():
                keys, ids, rows = (np.concatenate(v) for v in zip(*parts))
                for own in np.array_split(np.arange(len(keys)), max(1, round(len(keys) / most))):
                    kind = next(t for t in ("<i2", "<i4", "<i8") if _most(rows[own]) <= np.iinfo(t).max)
                    packs = [v[own].astype(t).tobytes() for v, t in ((keys, "<i8"), (ids, "<i8"), (rows, kind))]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([number], pa.int64()), pa.array([size], pa.int32()), *(pa.array([p], pa.binary()) for p in packs)],
                        [f.split()[0] for f in PACK.split(", ")])
                    number += 1

        for batch in batches:
            sizes = pa.compute.list_value_length(batch.column(2)).to_numpy()
            for size in np.unique(sizes).tolist():
                part = batch.filter(pa.array(sizes == size))
                keys, ids, flat = part.column(0).to_numpy(), part.column(1).to_numpy(), part.column(2).flatten().to_numpy()
                held.setdefault(size, []).append((keys, ids, flat.reshape(len(keys), size)))
            count += batch.num_rows
            if count >= most:
                yield from out()
                held, count = {}, 0
        yield from out()

    return run


def _search(k: int):
    def best(blocks: list[Block]) -> Iterator[pa.RecordBatch]:
        for block in blocks:
            query, score, ids = block.found
            yield pa.RecordBatch.from_arrays(
                [pa.array(block.keys[query]), pa.array(block.ids[query]), pa.array(ids), pa.array(score)],
                ["query_key", "query_id", "vec_id", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, asked = None, {}
        for batch in batches:
            for own, given, size, *packs in zip(*(batch.column(i) for i in range(6))):
                if cell != own.as_py():
                    for blocks in asked.values():
                        yield from best(blocks)
                    cell, asked = own.as_py(), {}
                keys, ids = (np.frombuffer(v.as_buffer(), "<i8") for v in packs[:2])
                size, rows = size.as_py(), packs[2].as_buffer()
                kind = f"<i{rows.size // (len(keys) * size) if size else 8}"
                rows = np.frombuffer(rows, kind).reshape(len(keys), size)
                if not given.as_py():
                    asked.setdefault(size, []).append(Block(keys, ids, rows, k))
                elif size in asked:
                    shard = Shard(keys, ids, rows)
                    for block in asked[size]:
                        shard.meet(block)
        for blocks in asked.values():
            yield from best(blocks)

    return run


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """``vectors`` and ``queries`` have row long, which tells them apart, vec_id long and vector array<long>.

    Returns query_id, rank, vec_id and score. A query's own row is not its candidate.
    """
    n, asked = vectors.count(), queries.count()
    sets = max(1, math.ceil(asked / SET))
    bundles = max(1, min(math.ceil(n / SHARD), math.ceil(n * sets / max(1, asked))))

    def dealt(rows: DataFrame, most: int, given: int, bundle, own) -> DataFrame:
        packs = rows.select("row", "vec_id", "vector").mapInArrow(_packed(most), PACK)
        return packs.withColumn("bundle", bundle).withColumn("own", own).select(
            (F.col("bundle") * sets + F.col("own")).alias("cell"), F.lit(given).alias("given"), "size", "keys", "ids", "rows")

    def one_of(parts: int):
        return F.pmod(F.xxhash64("pack"), F.lit(parts)).cast("int")

    def each_of(parts: int):
        return F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))

    met = (
        dealt(queries, BLOCK, 0, each_of(bundles), one_of(sets))
        .unionByName(dealt(vectors, SHARD, 1, one_of(bundles), each_of(sets)))
        .repartition(bundles * sets, "cell").sortWithinPartitions("cell", "given"))
    found = met.mapInArrow(_search(k), "query_key long, query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_key").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def integers(table: DataFrame, scale: int = 1024) -> DataFrame:
    """vec_id and floor(scale * component) of each vector that takes part."""
    value = F.transform("embedding", lambda x: x.cast("double"))
    finite = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (
        table.where("vec_id is not null and embedding is not null").where(finite).select("vec_id", value.alias("value"))
        .select(F.col("vec_id").cast("long").alias("vec_id"), F.transform("value", lambda x: F.floor(x * scale)).alias("vector")))


def search(table: DataFrame, step: int = 100, k: int = 10) -> DataFrame:
    """The k best of all rows for each row whose vec_id is divisible by ``step``."""
    vectors = Workspace(table.sparkSession, "topk").numbered(integers(table), "row")
    return top_k(vectors, vectors.where(F.col("vec_id") % step == 0), k)
