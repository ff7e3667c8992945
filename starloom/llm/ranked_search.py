"""Ranked lexical search with range-maximum tables over posting lists.

A term is a maximal stretch of ASCII letters, digits and characters beyond ASCII; only A-Z are
put in lower case. Scores are sums of integer impacts, one per term of an item:

    w * ((10**9 * tf) div (1000 * tf + 8 * m)),  w = floor(1000 * ln((2N + 2) / (2df + 1))),
    m = 10 + (90 * n * N) div L

1. One pass over the documents writes shards: posting lists of the items' terms over some
   thousand documents each, with the numbers that N, L and df are summed from.
2. A shard gets its impacts and, over all posting lists laid end to end, a sparse table of range
   maxima. A maximum also tells which document has it.
3. For each item, the shard's documents are one interval at first. Intervals are taken best
   first, several at once. The sum of the range maxima of all terms bounds every score inside. An
   interval is split at the document with the largest impact, whose score is summed exactly;
   one of few documents is scored whole. Intervals below the k-th best score so far go; that
   score is carried to the next shards of the task.
4. The best of all tasks meet in two steps, first by a hash of the document.

Items are searched in blocks of about ``BLOCK_TERMS`` terms, so what a task holds of them has a
bound; each block takes one pass. An item is an item_id: rows that repeat it add their terms. Items
without terms find nothing. A document is a row: rows that repeat a doc_id are documents each,
one without doc_id comes after others of its score, null, empty and termless texts are found by
nothing and do not count for N. Empty tables give no rows. Only the columns named are read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starloom.llm.common import scratch, text_groups

BLOCK_TERMS = 65_536
SHARD_DOCS = 8192
SHARD_HITS = 1 << 19
#: Documents up to which an interval is scored whole, and intervals taken at once.
LEAF = 128
AT_ONCE = 32

_BITS = 20
_MASK = (1 << _BITS) - 1
_LAST = np.iinfo(np.int64).max
#: Bytes to what they are in a term; a blank separates.
_LETTERS = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))

_SHARD = ("n_filled long, n_terms long, doc_ids array<long>, sizes array<long>, "
          "terms array<int>, dfs array<int>, ords binary, tfs binary")


def terms_of(text: str | None) -> list[bytes]:
    """All terms of a text, in order."""
    return text.encode().translate(_LETTERS).split() if text else []


def item_terms(items: DataFrame) -> DataFrame:
    """Distinct (item_id, term)."""

    def rows(batches):
        for batch in text_groups(batches):
            ids, terms = [], []
            for item, text in zip(batch.column("item_id").to_pylist(),
                                  batch.column("text").to_pylist()):
                found = set(terms_of(text))
                ids += [item] * len(found)
                terms += found
            yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(terms, pa.binary())],
                                  names=["item_id", "term"])

    return items.select(F.col("item_id").cast("long"), "text").mapInArrow(
        rows, "item_id long, term binary").distinct()


def build_shards(docs: DataFrame, vocabulary, shard_docs: int = SHARD_DOCS,
                 shard_hits: int = SHARD_HITS) -> DataFrame:
    """Posting lists of the terms in ``vocabulary`` (a broadcast dictionary to their numbers)
    over some rows of ``docs`` each."""

    def shard(ids, sizes, hits):
        ords = np.repeat(np.arange(len(ids)), [len(h) for h in hits])
        keys, tfs = np.unique(np.concatenate(hits) << _BITS | ords, return_counts=True)
        terms, dfs = np.unique(keys >> _BITS, return_counts=True)
        return pa.record_batch([
            pa.array([sum(n > 0 for n in sizes)], pa.int64()),
            pa.array([sum(sizes)], pa.int64()),
            pa.array([ids], pa.list_(pa.int64())), pa.array([sizes], pa.list_(pa.int64())),
            pa.array([terms], pa.list_(pa.int32())), pa.array([dfs], pa.list_(pa.int32())),
            pa.array([(keys & _MASK).astype("<i4").tobytes()], pa.binary()),
            pa.array([tfs.astype("<i4").tobytes()], pa.binary()),
        ], names=["n_filled", "n_terms", "doc_ids", "sizes", "terms", "dfs", "ords", "tfs"])

    def rows(batches):
        number = vocabulary.value.get
        ids, sizes, hits, held = [], [], [], 0
        for batch in text_groups(batches):
            for doc, text in zip(batch.column("doc_id").to_pylist(),
                                 batch.column("text").to_pylist()):
                words = terms_of(text)
                found = [x for x in map(number, words) if x is not None]
                ids.append(doc)
                sizes.append(len(words))
                hits.append(np.array(found, np.int64))
                held += len(found)
                if len(ids) >= shard_docs or held >= shard_hits:
                    yield shard(ids, sizes, hits)
                    ids, sizes, hits, held = [], [], [], 0
        if ids:
            yield shard(ids, sizes, hits)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(rows, _SHARD)


class Lists:
    """The posting lists of a shard and the range maxima of their impacts.

    A maximum is a number whose high bits are the impact and whose low bits tell the document,
    the first one of equal impacts.
    """

    def __init__(self, terms, dfs, ords, tfs, sizes, weights, filled: int, total: int):
        m = 10 + (90 * sizes * filled) // total
        self.impacts = np.repeat(weights[terms], dfs) * (
            (10 ** 9 * tfs) // (1000 * tfs + 8 * m[ords]))
        self.ords, self.docs = ords, len(sizes)
        ends = np.cumsum(dfs)
        self.slots = {int(t): (int(e - n), int(e)) for t, n, e in zip(terms, dfs, ends)}
        slot = np.repeat(np.arange(len(terms)), dfs)
        self.keys = slot << _BITS | ords
        self.table = [self.impacts << _BITS | (_MASK - ords)]
        longest, step = int(dfs.max(initial=0)), 1
        while 2 * step <= longest:
            last = self.table[-1]
            self.table.append(np.maximum(last[:-step], last[step:]))
            step *= 2

    def best(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The maximum of each range of a list, 0 for empty ones."""
        found = np.zeros(low.shape, np.int64)
        level = np.frexp((high - low).astype(float))[1] - 1
        for k in range(len(self.table)):
            at = np.nonzero(level == k)
            if len(at[0]):
                row = self.table[k]
                found[at] = np.maximum(row[low[at]], row[high[at] - (1 << k)])
        return found

    def search(self, terms: list[int], k: int, held: tuple, ids: np.ndarray, leaf: int = LEAF,
               at_once: int = AT_ONCE) -> tuple:
        """The k best of ``held`` and this shard's documents, as (scores, ids), best first."""
        ranges = [self.slots[t] for t in terms if t in self.slots]
        if not ranges:
            return held
        low, high = (np.array(c, np.int64)[None, :] for c in zip(*ranges))
        slot = self.keys[low[0]] >> _BITS << _BITS
        first, end = np.zeros(1, np.int64), np.full(1, self.docs, np.int64)
        best = self.best(low, high)
        bound = (best >> _BITS).sum(1)
        while True:
            floor = max(1, int(held[0][k - 1])) if len(held[0]) >= k else 1
            open_ = np.flatnonzero(bound >= floor)
            if not len(open_):
                return held
            low, high, best, first, end, bound = (
                x[open_] for x in (low, high, best, first, end, bound))
            take = np.zeros(len(bound), bool)
            take[np.argpartition(-bound, min(at_once, len(bound)) - 1)[:at_once]] = True
            small = end - first <= leaf
            scores, docs, kept = [], [], [tuple(x[~take] for x in (low, high, best, first, end))]
            whole = np.flatnonzero(take & small)
            if len(whole):
                n, d = self._all_scores(low[whole], high[whole])
                scores.append(n)
                docs.append(d)
            split = np.flatnonzero(take & ~small)
            if len(split):
                at = _MASK - (best[split].max(1) & _MASK)
                place = np.searchsorted(self.keys, slot + at[:, None])
                there = np.minimum(place, len(self.keys) - 1)
                has = self.keys[there] == slot + at[:, None]
                scores.append((self.impacts[there] * has).sum(1))
                docs.append(at)
                for a, b, f, e in ((low[split], place, first[split], at),
                                   (place + has, high[split], at + 1, end[split])):
                    kept.append((a, b, self.best(a, b), f, e))
            held = _merged(held, np.concatenate(scores), ids[np.concatenate(docs)], k)
            low, high, best, first, end = (np.concatenate(c) for c in zip(*kept))
            bound = (best >> _BITS).sum(1)

    def _all_scores(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scores of all documents that the given ranges of postings hold."""
        sizes = (high - low).ravel()
        at = np.repeat(low.ravel() - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
        docs, place = np.unique(self.ords[at], return_inverse=True)
        scores = np.zeros(len(docs), np.int64)
        np.add.at(scores, place, self.impacts[at])
        return scores, docs


def _merged(held: tuple, scores: np.ndarray, ids: np.ndarray, k: int) -> tuple:
    """The k best of two lists of (scores, ids): high scores first, then small ids."""
    some = scores > 0
    if len(held[0]) >= k:
        some &= scores >= held[0][-1]
    scores = np.concatenate([held[0], scores[some]])
    ids = np.concatenate([held[1], ids[some]])
    order = np.lexsort((ids, -scores))[:k]
    return scores[order], ids[order]


def _block_search(spark: SparkSession, docs: DataFrame, pairs, k: int, store,
                  shard_docs: int, shard_hits: int, leaf: int) -> DataFrame | None:
    """The best of each task for a block of items, given as rows (item_id, term)."""
    vocabulary: dict[bytes, int] = {}
    items: dict[int | None, list[int]] = {}
    for item, term in pairs:
        items.setdefault(item, []).append(
            vocabulary.setdefault(bytes(term), len(vocabulary)))
    size = len(vocabulary)
    shards = store.keep(build_shards(docs, spark.sparkContext.broadcast(vocabulary), shard_docs,
                                     shard_hits), "shards")
    filled, total = shards.agg(F.sum("n_filled"), F.sum("n_terms")).first()
    if not total:
        return None
    # One row per term of the block.
    counts = shards.select(F.explode(F.arrays_zip("terms", "dfs")).alias("t")).groupBy(
        "t.terms").agg(F.sum("t.dfs").alias("df")).collect()
    weights = np.zeros(size, np.int64)
    for term, df in counts:
        weights[term] = math.floor(1000 * math.log((2 * filled + 2) / (2 * df + 1)))
    shared = spark.sparkContext.broadcast((items, weights))

    def search(batches):
        wanted, weight = shared.value
        none = np.zeros(0, np.int64)
        held = {item: (none, none) for item in wanted}
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i] for name in batch.schema.names}
                ints = {n: row[n].values.to_numpy().astype(np.int64)
                        for n in ("sizes", "terms", "dfs")}
                ids = row["doc_ids"].values.fill_null(_LAST).to_numpy()
                ords, tfs = (np.frombuffer(row[n].as_py(), "<i4").astype(np.int64)
                             for n in ("ords", "tfs"))
                lists = Lists(ints["terms"], ints["dfs"], ords, tfs, ints["sizes"], weight,
                              filled, total)
                for item, terms in wanted.items():
                    held[item] = lists.search(terms, k, held[item], ids, leaf)
        rows = [(item, int(d) if d != _LAST else None, int(s))
                for item, (scores, docs_) in held.items() for s, d in zip(scores, docs_)]
        columns = list(zip(*rows)) or [[], [], []]
        yield pa.record_batch([pa.array(c, pa.int64()) for c in columns],
                              names=["item_id", "doc_id", "score"])

    return shards.drop("n_filled", "n_terms").mapInArrow(
        search, "item_id long, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, k: int = 10, block_terms: int = BLOCK_TERMS,
           shard_docs: int = SHARD_DOCS, shard_hits: int = SHARD_HITS, leaf: int = LEAF
           ) -> DataFrame:
    """item_id, rank, doc_id, score: the k best rows of ``docs`` (doc_id, text) for each item of
    ``items`` (item_id, text)."""
    spark = docs.sparkSession
    store = scratch(spark)
    pairs = store.keep(item_terms(items), "item_terms")
    blocks = -(-pairs.count() // block_terms)
    number = F.pmod(F.xxhash64("item_id"), F.lit(max(1, blocks)))
    found = spark.createDataFrame([], "item_id long, doc_id long, score long")
    for block in range(blocks):
        some = pairs.where(number == block).orderBy("item_id", "term").collect()
        best = _block_search(spark, docs, some, k, store, min(shard_docs, _MASK), shard_hits,
                             leaf) if some else None
        if best is not None:
            found = found.unionByName(store.keep(best, "best"))

    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    part = F.pmod(F.xxhash64("doc_id"), F.lit(64))
    for keys in (["item_id", part], ["item_id"]):
        found = found.withColumn("rank", F.row_number().over(
            Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= k)
    return found.select("item_id", "rank", "doc_id", "score")
