"""Token-id files: frequency-ranked ids in byte-aligned variable-length coding.

A set of files is a folder with two tables. ``ranks`` has the rank of every id that occurs: ids
are counted over all documents, the most frequent one has rank 0, ties go by id. ``segments`` has
the documents in ascending doc_id order, some whole documents each, in a binary column:

    4 bytes magic; unsigned 32 bit: documents; unsigned 64 bit: ids
    doc_ids          signed 64 bit each
    known            one byte each, 0 where the doc_id is null
    lengths          unsigned 32 bit ids of each document
    control bytes    four values each, two bits a value: bytes of the value less one
    data bytes       the ranks, low bytes first, without leading zero bytes

All numbers are little-endian. Frequent ids take one byte, and a reader looks ranks up in one table.
Parquet lies on any store that Spark writes to, and Spark's commit protocol keeps the files of
lost or repeated attempts out.

Null or empty text has the end id only; a null doc_id comes first and stays null; rows that
repeat a doc_id are all written, next to each other, by a hash of their ids. An empty table gives
no segments. Only doc_id and text are read.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starloom.llm.common import crc, scratch
from starloom.llm.tokens import batched, encoded_documents

MAGIC = b"FRS2"
_HEAD = struct.Struct("<4sIQ")
#: Value lengths by control byte.
_LENGTHS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3).astype(np.uint8) + 1
SEGMENT_IDS = 1 << 20


def rank_table(counts: dict[int, int]) -> np.ndarray:
    """Ids by rank: the most frequent first, ties by id."""
    return np.array(sorted(counts, key=lambda i: (-counts[i], i)), "<u4")


def ranks_by_id(ids: np.ndarray) -> np.ndarray:
    """The rank of each id, for ids by rank."""
    found = np.zeros(int(ids.max(initial=0)) + 1, "<u4")
    found[ids] = np.arange(len(ids), dtype="<u4")
    return found


def write_segment(doc_ids: list, lengths: list[int], ranks: np.ndarray) -> bytes:
    """One segment from document ids, their numbers of ids, and the ranks of all ids in a row."""
    ranks = ranks.astype("<u4")
    sizes = np.ones(len(ranks), np.uint8)
    for bits in (8, 16, 24):
        sizes += ranks >= (1 << bits)
    codes = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    codes[: len(ranks)] = sizes - 1
    control = (codes.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(1, dtype=np.uint8)
    used = np.arange(4, dtype=np.uint8) < sizes[:, None]
    data = ranks.view(np.uint8).reshape(-1, 4)[used]
    return b"".join([
        _HEAD.pack(MAGIC, len(doc_ids), len(ranks)),
        np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
        np.array([d is not None for d in doc_ids], np.uint8).tobytes(),
        np.array(lengths, "<u4").tobytes(),
        control.tobytes(), data.tobytes(),
    ])


def read_segment(blob: bytes) -> tuple[list, np.ndarray, np.ndarray]:
    """(doc_ids, lengths, ranks) of a segment."""
    magic, n_docs, n_ids = _HEAD.unpack_from(blob)
    if magic != MAGIC:
        raise ValueError("not a segment of ranked ids")
    at = _HEAD.size

    def part(kind: str, n: int) -> np.ndarray:
        nonlocal at
        found = np.frombuffer(blob, kind, n, at)
        at += found.nbytes
        return found

    doc_ids, known, lengths = part("<i8", n_docs), part("u1", n_docs), part("<u4", n_docs)
    control = part("u1", -(-n_ids // 4))
    data = np.frombuffer(blob, np.uint8, offset=at)
    sizes = _LENGTHS[control].reshape(-1)[:n_ids]
    place = np.cumsum(sizes, dtype=np.int64) - sizes
    ranks = data[place].astype(np.uint32)
    for j in (1, 2, 3):
        more = np.flatnonzero(sizes > j)
        if len(more):
            ranks[more] |= data[place[more] + j].astype(np.uint32) << (8 * j)
    return [int(d) if k else None for d, k in zip(doc_ids, known)], lengths, ranks


_SEGMENTS = pa.schema([("partition", pa.int32()), ("segment", pa.int32()),
                       ("n_docs", pa.int64()), ("n_ids", pa.int64()), ("payload", pa.binary())])
_ENCODED = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary())])


def encoded(docs: DataFrame, tokenizer: str, end_id: int, kind: str) -> DataFrame:
    """(doc_id, ids) with the end id, as numbers of the type ``kind``."""

    def rows(batches):
        end = np.array([end_id], kind).tobytes()
        for doc, ids in encoded_documents(batches, tokenizer):
            yield doc, np.frombuffer(ids, "<u4").astype(kind).tobytes() + end

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        lambda batches: batched(rows(batches), _ENCODED, 256), "doc_id long, ids binary")


def id_counts(stored: DataFrame, kind: str) -> DataFrame:
    """(id, n): occurrences of every id in all documents, summed in each task first."""

    def count(batches):
        total = np.zeros(0, np.int64)
        for batch in batches:
            column = batch.column("ids")
            ends = np.frombuffer(column.buffers()[1], "<i4")[column.offset:][:len(column) + 1]
            ids = np.frombuffer(column.buffers()[2] or b"", np.uint8)[ends[0]:ends[-1]].view(kind)
            found = np.bincount(ids, minlength=len(total))
            found[:len(total)] += total
            total = found
        seen = np.flatnonzero(total)
        yield pa.record_batch([pa.array(seen, pa.int64()), pa.array(total[seen], pa.int64())],
                              names=["id", "n"])

    return stored.select("ids").mapInArrow(count, "id long, n long").groupBy("id").agg(
        F.sum("n").alias("n"))


def write_files(docs: DataFrame, tokenizer: str, end_id: int, path: str,
                segment_ids: int = SEGMENT_IDS) -> None:
    """Encode all texts and write them to ``path`` in ascending doc_id order.

    Encoded texts are stored once, so that ids can be counted before any is written. The one
    shuffle ranges them by doc_id; equal doc_ids are told apart, so a hot one is split. A task
    holds one segment at a time.
    """
    from tokenizers import Tokenizer

    spark = docs.sparkSession
    largest = max(Tokenizer.from_file(tokenizer).get_vocab_size(), end_id + 1)
    kind = "<u2" if largest <= 1 << 16 else "<u4"
    folder = scratch(spark).path("encoded")
    made = encoded(docs, tokenizer, end_id, kind)
    made.withColumn("_row", F.monotonically_increasing_id()).write.option(
        "compression", "zstd").parquet(folder)
    stored = spark.read.schema("doc_id long, ids binary, _row long").parquet(folder)
    # At most one row per id of the vocabulary.
    table = rank_table({r["id"]: r["n"] for r in id_counts(stored, kind).collect()})
    spark.createDataFrame(
        [(rank, int(i)) for rank, i in enumerate(table)], "rank long, id long"
    ).coalesce(1).write.parquet(f"{path}/ranks")
    shared = spark.sparkContext.broadcast(ranks_by_id(table))

    def segments(batches):
        partition = TaskContext.get().partitionId()
        held, lengths, parts, n, number = [], [], [], 0, 0

        def segment():
            ranks = shared.value[np.frombuffer(b"".join(parts), kind)]
            return partition, number, len(held), len(ranks), write_segment(held, lengths, ranks)

        width = np.dtype(kind).itemsize
        for batch in batches:
            for doc, ids in zip(batch.column("doc_id").to_pylist(),
                                batch.column("ids").to_pylist()):
                held.append(doc)
                lengths.append(len(ids) // width)
                parts.append(ids)
                n += lengths[-1]
                if n >= segment_ids:
                    yield segment()
                    held, lengths, parts, n, number = [], [], [], 0, number + 1
        if held:
            yield segment()

    def write(batches):
        yield from batched(segments(batches), _SEGMENTS, 1)

    order = ["doc_id", F.xxhash64("ids"), "_row"]
    rows = stored.repartitionByRange(*order).sortWithinPartitions(*order)
    rows.select("doc_id", "ids").mapInArrow(
        write, "partition int, segment int, n_docs long, n_ids long, payload binary"
    ).write.option("compression", "none").parquet(f"{path}/segments")


def segment_starts(segments: DataFrame) -> DataFrame:
    """(partition, segment, start): the ids before each segment. Sums run within a file, and
    over one row per file."""
    before = (Window.unboundedPreceding, -1)
    files = segments.groupBy("partition").agg(F.sum("n_ids").alias("_ids")).select(
        "partition",
        F.coalesce(F.sum("_ids").over(Window.orderBy("partition").rowsBetween(*before)),
                   F.lit(0)).alias("_before"))
    within = Window.partitionBy("partition").orderBy("segment").rowsBetween(*before)
    return segments.select(
        "partition", "segment",
        F.coalesce(F.sum("n_ids").over(within), F.lit(0)).alias("_within"),
    ).join(files, "partition").select(
        "partition", "segment", (F.col("_before") + F.col("_within")).alias("start"))


def read_files(spark: SparkSession, path: str, decoded=None, schema: str | None = None
               ) -> DataFrame:
    """Read files back: per document doc_id, start, n_tokens and what ``decoded(ids)`` returns
    for its ids (a numpy array), a tuple in the order of ``schema``. Without it, the ids."""
    decoded = decoded or (lambda ids: (ids.astype(np.int64),))
    schema = schema or "ids array<long>"
    stored = spark.read.parquet(f"{path}/segments")
    # At most one row per id of the vocabulary.
    table = np.array([r["id"] for r in spark.read.parquet(f"{path}/ranks").orderBy("rank")
                      .collect()], "<u4")
    shared = spark.sparkContext.broadcast(table)
    starts = scratch(spark).keep(
        segment_starts(stored.select("partition", "segment", "n_ids")), "segment_starts")
    rows = stored.select("partition", "segment", "payload").join(
        starts, ["partition", "segment"])
    full = f"doc_id long, start long, n_tokens long, {schema}"
    fields = spark.createDataFrame([], full).schema
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(fields)

    def documents(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                start = batch.column("start")[i].as_py()
                docs, lengths, ranks = read_segment(batch.column("payload")[i].as_py())
                ids = shared.value[ranks]
                ends = np.cumsum(lengths, dtype=np.int64)
                for doc, end, n in zip(docs, ends.tolist(), lengths.tolist()):
                    yield doc, start + end - n, n, *decoded(ids[end - n:end])

    return rows.select("start", "payload").mapInArrow(
        lambda batches: batched(documents(batches), arrow), full)


def checksum(ids: np.ndarray) -> tuple[int]:
    """Unsigned crc32 of ids as little-endian unsigned 32-bit integers."""
    return (crc(ids.astype("<u4").tobytes()),)
