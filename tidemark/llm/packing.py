"""Packing of documents into token windows by Karmarkar-Karp differencing.

Full windows are cut off each document; what remains is cut into short pieces
that wait in a pool.  A pool is divided by multiway differencing: every piece
starts as a partial partition with one loaded window, and the two partial
partitions with the largest imbalance are merged, heavy windows against light
ones, until one is left.  Its windows are near-equal; while one exceeds the
capacity, the window count rises and the pool is divided anew.

A pool is closed at a total that nearly fills its windows, the rest of the
piece at hand opening the next pool.  Everything happens in the task that
reads the documents: no shuffle, and a pool's size is fixed.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame

from tidemark.llm.vocabulary import load_encoder

CAPACITY = 1024
POOL_WINDOWS = 256          # windows a full pool fills
PIECES_PER_WINDOW = 4       # a pooled piece is at most this fraction of a window
SLACK = 1                   # tokens a window of a full pool is short of its capacity
END_ID = 0                  # closes every document
TASK_BITS = 31              # a sequence id is the task's number, then a count in these bits

SCHEMA = ("doc_id long, start long, length long, ids binary, doc_tokens long, "
          "sequence_id long, offset long")


def differencing(sizes: list[int], windows: int) -> np.ndarray:
    """The window of each size, by Karmarkar-Karp multiway differencing."""
    if windows == 1 or not sizes:
        return np.zeros(len(sizes), np.int64)
    heap = []
    for i, s in enumerate(sizes):
        sums = np.zeros(windows, np.int64)
        sums[0] = s
        heap.append((-s, i, sums, None))
    heapq.heapify(heap)
    nth = len(sizes)
    while len(heap) > 1:
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        sums = a[2] + b[2][::-1]                # a's heaviest with b's lightest
        order = np.argsort(-sums, kind="stable")
        sums = sums[order] - sums[order[-1]]    # only differences matter
        heapq.heappush(heap, (-int(sums[0]), nth, sums, (a, b, order)))
        nth += 1
    out = np.zeros(len(sizes), np.int64)
    stack = [(heap[0], np.arange(windows))]
    while stack:
        (_, i, _, parts), window = stack.pop()
        if parts is None:
            out[i] = window[0]
            continue
        a, b, order = parts
        of_slot = np.empty(windows, np.int64)
        of_slot[order] = window
        stack.append((a, of_slot))
        stack.append((b, of_slot[::-1]))
    return out


def fit(sizes: list[int], capacity: int) -> np.ndarray:
    """Windows of near-equal load, as few as differencing can fill within capacity."""
    total = sum(sizes)
    windows = max(1, -(-total // capacity))
    while True:
        place = differencing(sizes, windows)
        if np.bincount(place, sizes, windows).max(initial=0) <= capacity:
            return place
        windows += 1


class Packer:
    """Takes one task's documents; ``rows`` holds finished pieces."""

    def __init__(self, capacity: int, first_sequence: int):
        self.capacity, self.sequence = capacity, first_sequence
        self.short = max(1, capacity // PIECES_PER_WINDOW)
        self.full = POOL_WINDOWS * max(1, capacity - SLACK)
        self.pool, self.load, self.rows = [], 0, []

    def add(self, doc_id, ids: np.ndarray) -> None:
        n, at = len(ids), 0
        while n - at >= self.capacity:
            self._put(doc_id, at, ids[at:at + self.capacity], n, 0)
            self.sequence += 1
            at += self.capacity
        while at < n:
            take = min(self.short, n - at, self.full - self.load)
            self.pool.append((doc_id, at, ids[at:at + take].copy(), n))
            self.load += take
            at += take
            if self.load == self.full:
                self.close()

    def close(self) -> None:
        sizes = [len(p[2]) for p in self.pool]
        if sizes:
            place = fit(sizes, self.capacity)
            filled: dict[int, int] = {}
            number: dict[int, int] = {}
            for (doc_id, at, ids, n), w in zip(self.pool, place.tolist()):
                number.setdefault(w, self.sequence + len(number))
                self._put(doc_id, at, ids, n, filled.get(w, 0), number[w])
                filled[w] = filled.get(w, 0) + len(ids)
            self.sequence += len(number)
        self.pool, self.load = [], 0

    def _put(self, doc_id, at, ids, n, offset, sequence=None) -> None:
        self.rows.append((doc_id, at, len(ids), ids.astype("<u4").tobytes(), n,
                          self.sequence if sequence is None else sequence, offset))

    def batch(self) -> pa.RecordBatch:
        kinds = [pa.int64()] * 7
        kinds[3] = pa.binary()
        columns = list(zip(*self.rows)) or [[]] * 7
        self.rows = []
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)],
            [f.split()[0] for f in SCHEMA.split(", ")])


def pack(docs: DataFrame, vocabulary: Broadcast, capacity: int = CAPACITY,
         end_id: int = END_ID) -> DataFrame:
    """Pieces of all documents: ``SCHEMA``; ``ids`` are little-endian 32-bit.

    A document is its text's ids and ``end_id``; a null or empty text is only
    ``end_id``.  Null ids stay null and repeated rows are documents of their
    own; an empty table gives no pieces; further columns are ignored."""
    if capacity < 1:
        raise ValueError("capacity must be positive")

    def run(batches):
        encode = load_encoder(vocabulary.value)
        packer = Packer(capacity, TaskContext.get().partitionId() << TASK_BITS)
        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                packer.add(doc_id, np.append(encode(text or ""), np.uint32(end_id)))
            if packer.rows:
                yield packer.batch()
        packer.close()
        yield packer.batch()

    return docs.selectExpr("cast(doc_id as long) as doc_id", "text").mapInArrow(run, SCHEMA)
