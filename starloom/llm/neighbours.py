"""Nearest neighbours by multi-index hashing of learnt binary codes.

Codes are the signs of vectors after learnt rotations (principal axes, then rotations that bring
them close to the corners of a cube); several rotations give several words of 64 bits or
so. Rotations and the search radius are fitted on a bounded sample (``SAMPLE`` vectors, those
with the smallest hash). The radius covers ``COVER`` of the sample's own nearest
neighbours; neighbours in the whole table are nearer.

Rows are indexed in blocks. In a block, each substring of 16 bits has a directory of the values
that occur and the rows that have them. If two codes differ in at most r bits, then in some
substring j they differ in at most r_j bits, where the r_j + 1 add up to r + 1. So probing
the directories within r_j gives every code within the radius. These are confirmed on the whole
code, and the nearest are ranked by cosine of the original vectors in double precision.

The query set goes against all blocks in blocks of its own. A query with fewer than k ids in
the radius is searched again with no limit, so each gets k neighbours if there are as many.

Vectors that are null or zero or hold a null or a non-finite component, and rows without an id,
take no part; nor do vectors of another length than most of the sample. Equal rows count once.
Neighbours are ids other than the query's own. If an id has several vectors, each of them is
sought and found, and the pair of ids has the highest score of theirs. Empty tables give no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.common import scratch

SAMPLE = 8192
SAMPLE_QUERIES = 512
COVER = 0.99
ROTATIONS = 4
BLOCK_ROWS = 2048
BLOCK_QUERIES = 256
SUBSTRING = 16
#: Scores this close to the last kept one are computed again in one fixed order of additions.
CLOSE = 1e-9


@dataclass(frozen=True)
class Codes:
    """``rotations`` maps centred unit vectors to values whose signs are the bits."""

    centre: np.ndarray
    rotations: np.ndarray
    radius: int

    @property
    def bits(self) -> int:
        return self.rotations.shape[1]

    def substrings(self, unit: np.ndarray) -> np.ndarray:
        """Codes of unit vectors as 16-bit substrings, zero-filled at the end."""
        signs = (unit - self.centre) @ self.rotations > 0
        width = -(-self.bits // SUBSTRING) * SUBSTRING
        padded = np.zeros((len(signs), width), bool)
        padded[:, :self.bits] = signs
        return np.packbits(padded, axis=1).view(np.uint16).reshape(len(signs), -1)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hamming distances of all codes in ``a`` to all in ``b``, given as substrings."""
    total = np.zeros((len(a), len(b)), np.int32)
    for j in range(a.shape[1]):
        total += np.bitwise_count(a[:, j, None] ^ b[None, :, j])
    return total


def unit_rows(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def learn(x: np.ndarray, k: int, seed: int = 7, rotations: int = ROTATIONS, rounds: int = 25,
          cover: float = COVER) -> Codes:
    """Codes and radius from sampled vectors."""
    if not len(x):
        return Codes(np.zeros(1), np.zeros((1, 1)), 0)
    unit = unit_rows(x)
    centre = unit.mean(0)
    centred = unit - centre
    _, axes = np.linalg.eigh(centred.T @ centred)
    projected = centred @ axes
    rng, found = np.random.default_rng(seed), []
    for _ in range(rotations):
        r = np.linalg.qr(rng.normal(size=(x.shape[1],) * 2))[0]
        for _ in range(rounds):
            u, _, v = np.linalg.svd(projected.T @ np.where(projected @ r > 0, 1.0, -1.0))
            r = u @ v
        found.append(axes @ r)
    codes = Codes(centre, np.concatenate(found, 1), 0)
    queries = unit[:SAMPLE_QUERIES]
    near = queries @ unit.T
    near[np.arange(len(queries)), np.arange(len(queries))] = -np.inf
    k = min(k, len(x) - 1)
    if not k:
        return Codes(centre, codes.rotations, codes.bits)
    best = np.argpartition(-near, k - 1, axis=1)[:, :k]
    own = codes.substrings(unit)
    apart = np.take_along_axis(distances(own[:len(queries)], own), best, 1)
    return Codes(centre, codes.rotations, int(np.quantile(apart, cover, method="higher")))


def part_radii(radius: int, parts: int) -> list[int]:
    """Radii per substring whose successors add up to ``radius`` + 1; -1: not probed."""
    each, more = divmod(radius + 1, parts)
    return [each + (j < more) - 1 for j in range(parts)]


def probe(codes: np.ndarray, queries: np.ndarray, radius: int) -> np.ndarray:
    """Whether a row of ``codes`` is within ``radius`` of a query (query by row)."""
    hit = np.zeros((len(queries), len(codes)), bool)
    for j, r in enumerate(part_radii(radius, codes.shape[1])):
        if r >= 0:
            values, rows = np.unique(codes[:, j], return_inverse=True)
            near = np.bitwise_count(queries[:, j, None] ^ values[None, :]) <= r
            hit |= near[:, rows]
    query, row = np.nonzero(hit)
    away = np.zeros(len(query), np.int32)
    for j in range(codes.shape[1]):
        away += np.bitwise_count(codes[row, j] ^ queries[query, j])
    hit[query, row] = away <= radius
    return hit


def search_block(ids, x, query_ids, q, codes: Codes, k: int, radius: int):
    """(number of the query in ``q``, vec_id, score) of the k nearest ids within the radius for
    each query."""
    order = np.argsort(ids, kind="stable")
    ids, x = ids[order], x[order]
    starts = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]]) if len(ids) else order
    unit, asked = unit_rows(x), unit_rows(q)
    hit = probe(codes.substrings(unit), codes.substrings(asked), radius)
    hit &= ids[None, :] != query_ids[:, None]
    rough = np.where(hit, asked @ unit.T, -np.inf)
    best = rough if len(starts) == len(ids) else np.maximum.reduceat(rough, starts, axis=1)
    for i in range(len(query_ids)):
        n = min(k, int((best[i] > -np.inf).sum()))
        if not n:
            continue
        last = -np.partition(-best[i], n - 1)[n - 1]
        rows = np.flatnonzero(rough[i] >= last - CLOSE)
        a, b = x[rows], q[i]
        score = (a * b).sum(1) / (np.sqrt((a * a).sum(1)) * np.sqrt((b * b).sum()))
        nearest_ids: dict[int, float] = {}
        for r in np.lexsort((ids[rows], -score)):
            nearest_ids.setdefault(int(ids[rows[r]]), float(score[r]))
            if len(nearest_ids) == k:
                break
        for vec_id, value in nearest_ids.items():
            yield i, vec_id, value


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding) of rows that take part, components as double."""
    e = F.col("embedding").cast("array<double>")
    finite = F.forall(e, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    nonzero = F.exists(e, lambda v: v != 0)
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), e.alias("embedding")
                          ).where(F.col("vec_id").isNotNull() & finite & nonzero)


def _blocks(rows: DataFrame, n: int, salt: str) -> DataFrame:
    """(block, ids, hashes, vectors): about equal parts of the rows, vectors as one run of
    numbers and the hash of each."""
    block = F.pmod(F.xxhash64(F.lit(salt), "vec_id", "embedding"), F.lit(n)).cast("int")
    # A block is bounded by its planned size: rows are distinct, vectors of an id are spread.
    return rows.groupBy(block.alias("block")).agg(
        F.collect_list(F.struct("vec_id", "embedding")).alias("rows")
    ).select("block", F.col("rows.vec_id").alias("ids"),
             F.transform("rows.embedding", lambda e: F.xxhash64(e)).alias("hashes"),
             F.flatten("rows.embedding").alias("vectors"))


def nearest(vectors: DataFrame, queries: Column, k: int = 5) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest rows found for each row of ``vectors``
    which meets the condition ``queries`` (on vec_id)."""
    spark = vectors.sparkSession
    store = scratch(spark)
    rows = store.keep(usable(vectors).distinct(), "vectors")
    sample = rows.orderBy(F.xxhash64("vec_id", "embedding"), "vec_id").limit(SAMPLE).select(
        "embedding").collect()
    sizes = [len(r["embedding"]) for r in sample]
    width = max(sorted(set(sizes)), key=sizes.count, default=1)
    rows = rows.where(F.size("embedding") == width)
    x = np.array([r["embedding"] for r in sample if len(r["embedding"]) == width])
    codes = spark.sparkContext.broadcast(learn(x.reshape(-1, width), k))
    asked = rows.where(queries)
    n_rows, n_queries = rows.count(), asked.count()
    n_blocks = max(1, -(-n_rows // BLOCK_ROWS))
    index = _blocks(rows, n_blocks, "row")

    def search(queries: DataFrame, n: int, radius: int | None) -> DataFrame:
        groups = _blocks(queries, max(1, -(-n // BLOCK_QUERIES)), "query")
        pairs = groups.select(
            F.col("ids").alias("query_ids"), F.col("hashes").alias("query_hashes"),
            F.col("vectors").alias("query_vectors"),
            F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("block"))
        found = index.drop("hashes").join(pairs, "block")

        def run(batches):
            for batch in batches:
                for i in range(batch.num_rows):
                    ids, flat, query_ids, query_hashes, query_flat = (
                        batch.column(c)[i].values.to_numpy(zero_copy_only=False)
                        for c in ("ids", "vectors", "query_ids", "query_hashes",
                                  "query_vectors"))
                    limit = codes.value.radius if radius is None else radius
                    hits = list(search_block(
                        ids, flat.reshape(-1, width), query_ids, query_flat.reshape(-1, width),
                        codes.value, k, limit))
                    at = np.array([h[0] for h in hits], int)
                    yield pa.record_batch([
                        pa.array(query_ids[at], pa.int64()),
                        pa.array(query_hashes[at], pa.int64()),
                        pa.array([h[1] for h in hits], pa.int64()),
                        pa.array([h[2] for h in hits], pa.float64())],
                        names=["query_id", "query_hash", "vec_id", "score"])

        # A query comes up with k rows from each block.
        return found.select("ids", "vectors", "query_ids", "query_hashes", "query_vectors"
                            ).mapInArrow(
            run, "query_id long, query_hash long, vec_id long, score double")

    # A query is an id with one of its vectors.
    first = store.keep(search(asked, n_queries, None), "found")
    counts = first.groupBy("query_id", "query_hash").agg(
        F.count_distinct("vec_id").alias("n")).where(F.col("n") >= k)
    poor = store.keep(asked.join(
        counts, (F.col("vec_id") == F.col("query_id"))
        & (F.xxhash64("embedding") == F.col("query_hash")), "left_anti"), "poor")
    n_poor = poor.count()
    found = first
    if n_poor:
        # What the first search found of these queries is found again.
        again = store.keep(search(poor, n_poor, codes.value.bits), "found_again")
        found = first.unionByName(again)
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(
        F.col("rank") <= k).select("query_id", F.col("rank").cast("int"), "vec_id", "score")
