"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics of every whole text are computed where the text is. Trees are grown in numpy on
a bounded sample of labelled documents (``SAMPLE`` at most, those with the smallest hash of
their id), on statistics binned by quantiles, and flattened into arrays. Scoring walks all
trees of all rows of a batch at once.

Null text counts as empty. Labels that are null or of unknown documents are left out; of several
labels of a document the largest counts. Without usable labels every score is 0.5, with
labels of one class only it is that class. Rows that repeat a doc_id are scored each. An empty
table gives no rows. Only doc_id and text are read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import fold_of, text_groups

SAMPLE = 20_000
THRESHOLD = 0.3
FOLDS, HELD_OUT = 5, 0
_LOUD = re.compile(r"[!?#$%&*@|<>{}=^~_\\]{2,}")

STATISTICS = (
    "log_chars", "log_words", "mean_word", "longest_word", "letters", "digits", "upper",
    "spaces", "points", "marks", "symbols", "other", "shouted", "capitalised", "loud",
    "distinct_words", "top_word", "distinct_pairs", "log_lines", "distinct_lines", "line_words",
    "ended_lines", "short_words", "entropy",
)

_CLASS = np.full(256, 7, np.uint8)
for _code in range(128):
    _c = chr(_code)
    _CLASS[_code] = (0 if _c.islower() else 1 if _c.isupper() else 2 if _c.isdigit()
                     else 3 if _c.isspace() else 4 if _c in ".,;:'\"()-" else 5 if _c in "!?"
                     else 6)


def statistics(text: str) -> list[float]:
    """Values in the order of ``STATISTICS``."""
    data = text.encode()
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    lower, upper, digits, spaces, points, marks, symbols, other = np.bincount(
        _CLASS, weights=counts, minlength=8).tolist()
    total = max(1, len(data))
    some = counts[counts > 0] / total
    words = data.split()
    n = len(words)
    each = max(1, n)
    tally = Counter(words)
    lines = [line for line in data.split(b"\n") if line.strip()]
    filled = max(1, len(lines))
    sizes = [len(w) for w in words]
    return [
        math.log1p(len(text)), math.log1p(n), (len(data) - spaces) / each,
        math.log1p(max(sizes, default=0)), (lower + upper + other) / total, digits / total,
        upper / max(1.0, lower + upper), spaces / total, points / total, marks / total,
        symbols / total, other / total,
        sum(w.isupper() for w in words) / each, sum(w.istitle() for w in words) / each,
        len(_LOUD.findall(text)) / each,
        len(tally) / each, max(tally.values(), default=0) / each,
        len(set(zip(words, words[1:]))) / max(1, n - 1),
        math.log1p(len(lines)), len(set(lines)) / filled, math.log1p(n / filled),
        sum(line[-1:] in b".!?:\"" for line in lines) / filled,
        sum(s <= 3 for s in sizes) / each, float(-(some * np.log2(some)).sum()),
    ]


@dataclass(frozen=True)
class Trees:
    """Trees as arrays: a row per tree, a column per node, children at 2i+1 and 2i+2.

    A row goes left if its value of ``feature`` is at most ``threshold``; leaves hold values.
    """

    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    depth: int
    start: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1 for each row of ``x``."""
        trees = np.arange(len(self.feature))[None, :]
        rows = np.arange(len(x))[:, None]
        node = np.zeros((len(x), len(self.feature)), np.int32)
        for _ in range(self.depth):
            right = x[rows, self.feature[trees, node]] > self.threshold[trees, node]
            node = 2 * node + 1 + right
        leaf = node - (2 ** self.depth - 1)
        return 1 / (1 + np.exp(-(self.start + self.value[trees, leaf].sum(axis=1))))


def grow(x: np.ndarray, y: np.ndarray, rounds: int = 80, depth: int = 4, rate: float = 0.15,
         bins: int = 64, weight: float = 1.0, least: float = 2.0) -> Trees:
    """Boost trees of a fixed depth for log loss; splits lie on quantile edges of ``x``."""
    share = float(y.mean()) if len(y) else 0.5
    start = math.log(min(max(share, 1e-6), 1 - 1e-6) / min(max(1 - share, 1e-6), 1 - 1e-6))
    nodes, leaves, width = 2 ** depth - 1, 2 ** depth, x.shape[1]
    if len(y) == 0 or share in (0.0, 1.0):
        rounds = 0
    feature = np.zeros((rounds, nodes), np.int32)
    threshold = np.full((rounds, nodes), np.inf)
    value = np.zeros((rounds, leaves))
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1]))
             if len(x) else np.zeros(0) for f in range(width)]
    binned = np.stack([np.searchsorted(e, x[:, f]) for f, e in enumerate(edges)], 1)
    cell = binned + np.arange(width) * bins
    raw = np.full(len(y), start)
    for t in range(rounds):
        p = 1 / (1 + np.exp(-raw))
        grad, hess = p - y, np.maximum(p * (1 - p), 1e-9)
        node = np.zeros(len(y), np.int64)
        for level in range(depth):
            first, n = 2 ** level - 1, 2 ** level
            at = ((node - first)[:, None] * (width * bins) + cell).ravel()
            shape = (n, width, bins)
            g = np.bincount(at, np.repeat(grad, width), n * width * bins).reshape(shape)
            h = np.bincount(at, np.repeat(hess, width), n * width * bins).reshape(shape)
            gl, hl = g.cumsum(2), h.cumsum(2)
            ga, ha = gl[:, :, -1:], hl[:, :, -1:]
            gain = (gl ** 2 / (hl + weight) + (ga - gl) ** 2 / (ha - hl + weight)
                    - ga ** 2 / (ha + weight))
            gain[(hl < least) | (ha - hl < least)] = -1
            for f, e in enumerate(edges):
                gain[:, f, len(e):] = -1
            best = gain.reshape(n, -1).argmax(1)
            for i, b in enumerate(best):
                if gain[i].flat[b] > 1e-9:
                    feature[t, first + i] = b // bins
                    threshold[t, first + i] = edges[b // bins][b % bins]
            right = x[np.arange(len(x)), feature[t, node]] > threshold[t, node]
            node = 2 * node + 1 + right
        leaf = node - nodes
        g = np.bincount(leaf, grad, leaves)
        h = np.bincount(leaf, hess, leaves)
        value[t] = -rate * g / (h + weight)
        raw += value[t][leaf]
    return Trees(feature, threshold, value, depth, start)


def _statistics_of(batches):
    for batch in text_groups(batches):
        rows = [statistics(text or "") for text in batch.column("text").to_pylist()]
        yield batch, np.array(rows).reshape(-1, len(STATISTICS))


def with_statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, statistics) of every row."""

    def rows(batches):
        for batch, x in _statistics_of(batches):
            yield pa.record_batch([batch.column("doc_id"), pa.array(x.tolist(), pa.list_(
                pa.float64()))], names=["doc_id", "statistics"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        rows, "doc_id long, statistics array<double>")


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, **options) -> Trees:
    """Trees for ``labels`` (doc_id, quality), learnt outside the held-out fold."""
    usable = (
        labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
        .where(fold_of("doc_id", FOLDS) != HELD_OUT)
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max("quality").cast("int").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    )
    # At most ``sample`` rows on the one side; on the other, the texts of those.
    chosen = docs.join(F.broadcast(usable.select("doc_id")), "doc_id", "left_semi")
    found = with_statistics(chosen.select("doc_id", "text")).dropDuplicates(["doc_id"]).join(
        F.broadcast(usable), "doc_id").orderBy("doc_id").collect()
    x = np.array([r["statistics"] for r in found]).reshape(-1, len(STATISTICS))
    return grow(x, np.array([r["quality"] for r in found], float), **options)


def scores(docs: DataFrame, trees: Trees) -> DataFrame:
    """(doc_id, score) of every row."""
    model = docs.sparkSession.sparkContext.broadcast(trees)

    def rows(batches):
        for batch, x in _statistics_of(batches):
            yield pa.record_batch([batch.column("doc_id"), pa.array(model.value.score(x))],
                                  names=["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        rows, "doc_id long, score double")


def accepted(docs: DataFrame, trees: Trees, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, with a score of at least ``threshold``."""
    from pyspark.sql.pandas.types import to_arrow_schema

    model, schema = docs.sparkSession.sparkContext.broadcast(trees), docs.schema
    place = docs.columns.index("text")
    arrow = to_arrow_schema(schema)

    def rows(batches):
        for batch in batches:
            named = pa.record_batch([batch.column(place)], names=["text"])
            keep = np.concatenate([model.value.score(x) for _, x in _statistics_of([named])]
                                  or [np.zeros(0)]) >= threshold
            yield pa.RecordBatch.from_arrays(
                batch.filter(pa.array(keep, pa.bool_())).columns, schema=arrow)

    return docs.mapInArrow(rows, schema)
