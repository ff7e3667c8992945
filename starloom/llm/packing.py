"""Best-fit packing of documents into sequences of a fixed capacity.

Only the histogram of piece lengths decides, so the plan is made once for all documents and
its size follows the capacity:

1. Lengths are grouped into ``UNITS`` units. All patterns of up to ``PATTERN`` documents that
   fill a sequence are enumerated, and non-negative least squares fits how often each repeats
   so that together they use the histogram. Counts are rounded down.
2. What is left, and the slack which exact lengths leave in the patterns, is packed best-fit:
   longest pieces first, each into the fullest sequence with room for it.

The plan maps ranges of pieces of one length to ranges of sequences at a fixed offset. Pieces
get their number among equal lengths by counting within their partition and adding the counts
of the partitions before, so no task sees more than its own pieces.

Null or empty text is a document of the end id only; repeated rows are packed each; an empty
table gives no rows.
"""

from __future__ import annotations

import struct
from bisect import bisect_left, insort
from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.common import crc, scratch
from starloom.llm.tokens import batched, encoded_documents

UNITS = 64
PATTERN = 4
#: Units of length up to which pieces are kept to fill slack.
RESERVES = (0, 4, 8, 12, 16, 20, 24, 28)

_PIECES = pa.schema([
    ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
    ("length", pa.int64()), ("ids_crc32", pa.int64()), ("partition", pa.int32()),
    ("place", pa.int64())])
_PIECES_SQL = ("doc_id long, piece int, start long, length long, ids_crc32 long, "
               "partition int, place long")


def nnls(a: np.ndarray, b: np.ndarray, rounds: int = 1000) -> np.ndarray:
    """x >= 0 with the least squared difference of a @ x and b (active set method)."""
    x = np.zeros(a.shape[1])
    active = np.zeros(a.shape[1], bool)
    limit = 1e-9 * max(1.0, np.abs(a.T @ b).max(initial=0))
    for _ in range(rounds):
        gain = a.T @ (b - a @ x)
        gain[active] = -np.inf
        best = int(gain.argmax())
        if gain[best] <= limit:
            break
        active[best] = True
        while True:
            index = np.flatnonzero(active)
            trial = np.linalg.lstsq(a[:, index], b, rcond=None)[0]
            low = trial <= 0
            if not low.any():
                break
            old = x[index]
            step = (old[low] / np.maximum(old[low] - trial[low], 1e-300)).min()
            x[index] = old + step * (trial - old)
            gone = index[low & (x[index] <= 1e-12 * (1 + old))]
            if not len(gone):
                gone = index[[int(np.argmin(np.where(low, x[index], np.inf)))]]
            x[gone], active[gone] = 0, False
            if not active.any():
                break
        x[:] = 0
        if active.any():
            x[np.flatnonzero(active)] = trial
    return x


def patterns(units: int, most: int) -> list[tuple[int, ...]]:
    """Up to ``most`` unit lengths, longest first, that fill ``units`` together."""
    found = [(units,)]
    for n in range(2, most + 1):
        for head in combinations_with_replacement(range(1, units), n - 1):
            last = units - sum(head)
            if last >= head[-1]:
                found.append((*head, last)[::-1])
    return found


class Plan:
    """Places for ``counts[length]`` pieces of each length, found from the counts alone.

    ``ranges`` has (length, first piece, number of pieces, first sequence, offset) rows.
    """

    def __init__(self, counts: dict[int, int], capacity: int, units: int = UNITS,
                 most: int = PATTERN, reserve: int = 0):
        self.capacity = capacity
        self.left = {n: c for n, c in counts.items() if c > 0}
        self.next = dict.fromkeys(self.left, 0)
        self.sequences = 0
        self.ranges: list[tuple[int, int, int, int, int]] = []
        self.open: dict[int, list[tuple[int, int]]] = {}
        self.slacks: list[int] = []
        if self.left:
            self._fill_patterns(min(units, capacity), most, reserve)
            self._fill_rest()

    def _place(self, length: int, n: int, sequence: int, offset: int) -> None:
        self.ranges.append((length, self.next[length], n, sequence, offset))
        self.next[length] += n
        self.left[length] -= n

    def _release(self, slack: int, sequence: int, n: int) -> None:
        if slack and n:
            if slack not in self.open:
                insort(self.slacks, slack)
            self.open.setdefault(slack, []).append((sequence, n))

    def _fill_patterns(self, units: int, most: int, reserve: int) -> None:
        width = -(-self.capacity // units)
        lengths: dict[int, list[int]] = {}
        for n in sorted(self.left):  # the longest of a unit are taken first
            lengths.setdefault(-(-n // width), []).append(n)
        total = -(-self.capacity // width)
        have = np.array([sum(self.left[n] for n in lengths.get(u, []))
                         for u in range(1, total + 1)], float)
        have[:reserve] = 0
        shapes = [s for s in patterns(total, most) if s[-1] > reserve]
        a = np.zeros((total, len(shapes)))
        for j, shape in enumerate(shapes):
            for u in shape:
                a[u - 1, j] += 1
        repeats = np.floor(nnls(a, have) + 1e-6).astype(np.int64)
        for j in np.argsort(-repeats, kind="stable"):
            if repeats[j] <= 0:
                break
            self._repeat(shapes[j], int(repeats[j]), lengths)

    def _repeat(self, shape: tuple[int, ...], n: int, lengths: dict[int, list[int]]) -> None:
        """Use a pattern up to ``n`` times, a block for each mixture of exact lengths."""
        need = {u: shape.count(u) for u in shape}
        while n > 0:
            for u in need:
                while lengths.get(u) and not self.left[lengths[u][-1]]:
                    lengths[u].pop()
                if not lengths.get(u):
                    return
            rich = all(self.left[lengths[u][-1]] >= k for u, k in need.items())
            block = min([n, *(self.left[lengths[u][-1]] // k for u, k in need.items())]
                        ) if rich else 1
            if not rich and any(sum(self.left[x] for x in lengths[u]) < k
                                for u, k in need.items()):
                return
            offset, first = 0, self.sequences
            for u in shape:
                while not self.left[lengths[u][-1]]:
                    lengths[u].pop()
                length = lengths[u][-1]
                self._place(length, block, first, offset)
                offset += length
            self.sequences += block
            self._release(self.capacity - offset, first, block)
            n -= block

    def _fill_rest(self) -> None:
        for length in sorted(self.left, reverse=True):
            while n := self.left[length]:
                at = bisect_left(self.slacks, length)
                if at == len(self.slacks):
                    self._new(length, n)
                    continue
                slack = self.slacks[at]
                sequence, free = self.open[slack].pop()
                if not self.open[slack]:
                    del self.open[slack], self.slacks[at]
                used = min(n, free)
                self._place(length, used, sequence, self.capacity - slack)
                self._release(slack - length, sequence, used)
                self._release(slack, sequence + used, free - used)

    def _new(self, length: int, n: int) -> None:
        each = self.capacity // length
        full, rest = divmod(n, each)
        for n_sequences, n_pieces in ((full, each), (1, rest)):
            if n_sequences and n_pieces:
                for j in range(n_pieces):
                    self._place(length, n_sequences, self.sequences, j * length)
                self._release(self.capacity - n_pieces * length, self.sequences, n_sequences)
                self.sequences += n_sequences

    def arrays(self) -> tuple[np.ndarray, ...]:
        """Ranges ordered by length and first piece, a column each."""
        rows = np.array(sorted(self.ranges), np.int64).reshape(-1, 5)
        return tuple(np.ascontiguousarray(rows[:, i]) for i in range(5))


def best_plan(counts: dict[int, int], capacity: int) -> Plan:
    found = [Plan(counts, capacity, reserve=r) for r in RESERVES]
    return min(found, key=lambda plan: plan.sequences)


def pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int) -> DataFrame:
    """Pieces of all documents, with their partition and their number among the pieces of
    the same length there. The last two are only stable once the frame is stored."""

    def cut(batches):
        partition, end = TaskContext.get().partitionId(), struct.pack("<I", end_id)
        places = np.zeros(capacity + 1, np.int64)
        for doc, ids in encoded_documents(batches, tokenizer):
            ids += end
            for i, at in enumerate(range(0, len(ids), 4 * capacity)):
                part = ids[at:at + 4 * capacity]
                n = len(part) // 4
                yield doc, i, at // 4, n, crc(part), partition, int(places[n])
                places[n] += 1

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        lambda batches: batched(cut(batches), _PIECES), _PIECES_SQL)


def pack(docs: DataFrame, tokenizer: str, end_id: int = 1, capacity: int = 4096) -> DataFrame:
    """Pack all documents; a row per piece: doc_id, piece, start, length, ids_crc32,
    sequence_id, offset."""
    spark = docs.sparkSession
    store = scratch(spark)
    stored = store.keep(pieces(docs, tokenizer, end_id, capacity), "pieces")
    counts = store.keep(stored.groupBy("length", "partition").agg(
        F.count(F.lit(1)).alias("n")), "piece_counts")
    # At most one row per length, that is as many as the capacity.
    totals = counts.groupBy("length").agg(F.sum("n").alias("n")).collect()
    plan = spark.sparkContext.broadcast(
        best_plan({r["length"]: r["n"] for r in totals}, capacity).arrays())
    before = Window.partitionBy("length").orderBy("partition").rowsBetween(
        Window.unboundedPreceding, -1)
    # Stored, so that Spark knows its size and broadcasts it only while that is small.
    firsts = store.keep(counts.select(
        "length", "partition", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")),
        "firsts")
    numbered = stored.join(firsts, ["length", "partition"])

    def put(batches):
        lengths, first, _, sequence, offset = plan.value
        starts = np.searchsorted(lengths, np.arange(capacity + 2))
        for batch in batches:
            length = batch.column("length").to_numpy()
            number = batch.column("number").to_numpy()
            at = np.empty(len(length), np.int64)
            for n in np.unique(length):
                rows = length == n
                low, high = starts[n], starts[n + 1]
                at[rows] = low + np.searchsorted(first[low:high], number[rows], "right") - 1
            sequences = sequence[at] + number - first[at]
            columns = [batch.column(c) for c in ("doc_id", "piece", "start", "length",
                                                 "ids_crc32")]
            yield pa.record_batch([*columns, pa.array(sequences), pa.array(offset[at])],
                                  names=["doc_id", "piece", "start", "length", "ids_crc32",
                                         "sequence_id", "offset"])

    return numbered.select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("first") + F.col("place")).alias("number"),
    ).mapInArrow(put, "doc_id long, piece int, start long, length long, ids_crc32 long, "
                      "sequence_id long, offset long")
