"""Periodic runs of words, found in a grammar of the text.

A run is a stretch of consecutive words with smallest period q that is at least ``least`` words
and ``times`` periods long and that no neighbouring word extends. Runs are found per slice of
documents:

1. Inside a run every window of ``least - least // times`` words comes again one period away.
   Words that no repeated window of their document covers are in no run. What remains are
   stretches; a run lies within one of them, whole.
2. Re-Pair replaces pairs of symbols by nonterminals. A round replaces the most frequent pair,
   and every other pair where it is more frequent than those it overlaps, ties by a hash of the
   pair. When no pair repeats, neighbours are joined two by two until each stretch is one symbol.
3. For each nonterminal the runs that cross the border of its two sides are found once, by the
   longest extensions of equal words to both sides of the border, for all periods together.
   Extensions are exact: numbers tell equal substrings of 1, 2, 4, ... words.
4. They are translated to all positions where the nonterminal stands, and intervals of one
   period that lie in others are merged with them. The lowest nonterminal that holds a run
   whole has its border inside it, so every run comes out whole.

Null, empty and blank texts have no words and no runs. Rows stand for themselves: a doc_id that
is null or repeated changes nothing. An empty table gives no rows; only doc_id and text are
read. A task holds a slice of texts, or one text if that is longer.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import mixed, text_groups

LEAST = 24
TIMES = 3
#: (border, period) pairs whose extensions are sought at once.
CHUNK = 1 << 20

_P = np.uint64(0x9E3779B97F4A7C15)
_RUN = "struct<start: bigint, length: bigint, period: bigint>"


class _Numbers(dict):
    """Numbers for words, in order of appearance."""

    def __missing__(self, word):
        self[word] = found = len(self)
        return found


def covered_stretches(ids: np.ndarray, starts: np.ndarray, window: int
                      ) -> tuple[np.ndarray, np.ndarray]:
    """(first, end) of the stretches that repeated windows cover; documents begin at
    ``starts`` and are told apart. Windows are compared by hashes, so a stretch may be longer
    than it had to be, but never shorter."""
    n = len(ids)
    if n < window:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    sizes = np.diff(np.append(starts, n))
    doc = np.repeat(np.arange(len(starts)), sizes)
    base = mixed(ids.astype(np.uint64) + np.uint64(1))
    h = mixed(doc[:n - window + 1].astype(np.uint64) + np.uint64(1))
    for j in range(window):
        h = h * _P + base[j:n - window + 1 + j]
    at = np.flatnonzero(doc[:n - window + 1] == doc[window - 1:])
    _, number, counts = np.unique(h[at], return_inverse=True, return_counts=True)
    at = at[counts[number] > 1]
    if not len(at):
        return at, at
    depth = np.zeros(n + 1, np.int64)
    np.add.at(depth, at, 1)
    np.add.at(depth, at + window, -1)
    held = np.flatnonzero(np.cumsum(depth[:n]) > 0)
    new = np.concatenate([[True], (np.diff(held) > 1) | (np.diff(doc[held]) > 0)])
    first = held[new]
    return first, held[np.append(np.flatnonzero(new)[1:], len(held)) - 1] + 1


class Grammar:
    """A Re-Pair grammar of several stretches of symbols, laid end to end in ``text``.

    Nonterminal ``t + i`` is ``left[i] right[i]``, where terminals are the numbers below t.
    ``roots`` has the symbol of each stretch.
    """

    def __init__(self, text: np.ndarray, stretch: np.ndarray):
        self.terminals = int(text.max()) + 1
        self.left: list[int] = []
        self.right: list[int] = []
        self._made: dict[int, int] = {}
        symbols = text.astype(np.int64)
        while True:
            pair, chosen = self._frequent(symbols, stretch)
            if not len(chosen):
                break
            symbols, stretch = self._replace(symbols, stretch, pair, chosen)
        while True:
            chosen = self._neighbours(stretch)
            if not len(chosen):
                break
            pair = symbols[:-1] << 32 | symbols[1:]
            symbols, stretch = self._replace(symbols, stretch, pair, chosen)
        self.roots = symbols
        self.sizes = np.ones(self.terminals + len(self.left), np.int64)
        for i, (a, b) in enumerate(zip(self.left, self.right)):
            self.sizes[self.terminals + i] = self.sizes[a] + self.sizes[b]
        self.left, self.right = np.array(self.left, np.int64), np.array(self.right, np.int64)

    @staticmethod
    def _frequent(symbols: np.ndarray, stretch: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All pairs of neighbours, and the places of those to be replaced."""
        pair = symbols[:-1] << 32 | symbols[1:]
        inside = np.flatnonzero(stretch[:-1] == stretch[1:])
        kinds, kind, counts = np.unique(pair[inside], return_inverse=True, return_counts=True)
        rank = np.zeros(len(kinds), np.int64)
        rank[np.lexsort((mixed(kinds.astype(np.uint64)), counts))] = np.arange(1, len(kinds) + 1)
        rank[counts < 2] = 0
        ranks = np.zeros(len(pair), np.int64)
        ranks[inside] = rank[kind]
        if not ranks.any():
            return pair, inside[:0]
        # Equal neighbouring ranks are one symbol several times: every other pair is taken.
        first = np.flatnonzero(np.concatenate([[True], ranks[1:] != ranks[:-1]]))
        top = np.concatenate([[0], ranks[first], [0]])
        wins = (top[1:-1] > top[:-2]) & (top[1:-1] > top[2:])
        lengths = np.diff(np.append(first, len(ranks)))
        place = np.arange(len(ranks)) - np.repeat(first, lengths)
        return pair, np.flatnonzero(np.repeat(wins, lengths) & (place % 2 == 0))

    @staticmethod
    def _neighbours(stretch: np.ndarray) -> np.ndarray:
        """Places of every other symbol of each stretch that has one behind it."""
        first = np.flatnonzero(np.concatenate([[True], stretch[1:] != stretch[:-1]]))
        place = np.arange(len(stretch)) - np.repeat(
            first, np.diff(np.append(first, len(stretch))))
        return np.flatnonzero((place[:-1] % 2 == 0) & (stretch[:-1] == stretch[1:]))

    def _replace(self, symbols, stretch, pair, chosen):
        kinds, kind = np.unique(pair[chosen], return_inverse=True)
        made = []
        for code in kinds.tolist():
            if code not in self._made:
                self._made[code] = self.terminals + len(self.left)
                self.left.append(code >> 32)
                self.right.append(code & 0xFFFFFFFF)
            made.append(self._made[code])
        symbols[chosen] = np.array(made, np.int64)[kind]
        kept = np.ones(len(symbols), bool)
        kept[chosen + 1] = False
        return symbols[kept], stretch[kept]

    def places(self, first: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
        """(symbol, place) of all nonterminals of at least ``least`` words in the derivation;
        the stretches begin at ``first``."""
        symbol, place, found = self.roots, first, []
        while len(symbol):
            large = (self.sizes[symbol] >= least) & (symbol >= self.terminals)
            symbol, place = symbol[large], place[large]
            found.append((symbol, place))
            left, right = self.left[symbol - self.terminals], self.right[symbol - self.terminals]
            symbol, place = (np.concatenate([left, right]),
                             np.concatenate([place, place + self.sizes[left]]))
        return tuple(np.concatenate(c) for c in zip(*found))


class Extensions:
    """How far words agree from two places on, to either side: exact, in steps of powers of
    two, for which equal substrings have equal numbers."""

    def __init__(self, text: np.ndarray, longest: int):
        self.levels = [np.unique(text, return_inverse=True)[1]]
        while 2 << (len(self.levels) - 1) <= longest:
            last, step = self.levels[-1], 1 << (len(self.levels) - 1)
            joined = last[:-step].astype(np.int64) << 32 | last[step:]
            self.levels.append(np.unique(joined, return_inverse=True)[1].astype(np.int32))

    def forward(self, i: np.ndarray, j: np.ndarray, most: np.ndarray) -> np.ndarray:
        found = np.zeros(len(i), np.int64)
        for k in reversed(range(len(self.levels))):
            number, step = self.levels[k], 1 << k
            at = np.flatnonzero(found + step <= most)
            p = found[at]
            found[at[number[i[at] + p] == number[j[at] + p]]] += step
        return found

    def backward(self, i: np.ndarray, j: np.ndarray, most: np.ndarray) -> np.ndarray:
        """The same for the words up to i and j, which may be one before the first."""
        found = np.zeros(len(i), np.int64)
        for k in reversed(range(len(self.levels))):
            number, step = self.levels[k], 1 << k
            at = np.flatnonzero(found + step <= most)
            p = found[at] + step - 1
            found[at[number[i[at] - p] == number[j[at] - p]]] += step
        return found


def _shortest(node: np.ndarray, start: np.ndarray, end: np.ndarray, period: np.ndarray):
    """Of equal intervals of a node only the one with the smallest period."""
    order = np.lexsort((period, end, start, node))
    node, start, end, period = node[order], start[order], end[order], period[order]
    new = np.ones(len(node), bool)
    new[1:] = (node[1:] != node[:-1]) | (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    return node[new], start[new], end[new], period[new]


def border_runs(text: np.ndarray, first: np.ndarray, border: np.ndarray, end: np.ndarray,
                least: int, times: int) -> tuple[np.ndarray, ...]:
    """(node, start, end, period) of the runs of each node that contain a period next to its
    border; node i lies at ``first[i] : end[i]`` of the text."""
    sizes = end - first
    extend = Extensions(text, int(sizes.max()))
    parts = []
    heads = np.cumsum(sizes // times)
    low = 0
    while low < len(sizes):
        high = max(low + 1, int(np.searchsorted(
            heads, (heads[low - 1] if low else 0) + CHUNK, "right")))
        n = sizes[low:high] // times
        node = np.repeat(np.arange(low, high), n)
        period = np.arange(len(node)) - np.repeat(np.cumsum(n) - n, n) + 1
        for shift in (0, 1):  # the period behind the border, then the one before it
            i = border[node] - shift * period
            j = i + period
            fits = (i >= first[node]) & (j <= end[node])
            # A run has two periods of agreements, so one lies next to i on either side.
            back = fits & (i > first[node])
            back[back] = text[i[back] - 1] == text[j[back] - 1]
            on = fits & (j < end[node])
            on[on] = text[i[on]] == text[j[on]]
            at = np.flatnonzero(back | on)
            i, j, p, at = i[at], j[at], period[at], node[at]
            start = i - extend.backward(i - 1, j - 1, i - first[at])
            stop = j + extend.forward(i, j, end[at] - j)
            long = stop - start >= np.maximum(least, times * p)
            parts.append((at[long], start[long], stop[long], p[long]))
        low = high
    return _shortest(*(np.concatenate(c) for c in zip(*parts)))


def maximal(start: np.ndarray, end: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, ...]:
    """Intervals that lie in no other of the same period, by start and period."""
    order = np.lexsort((-end, start, period))
    start, end, period = start[order], end[order], period[order]
    reach = np.maximum.accumulate(period * (int(end.max(initial=0)) + 1) + end)
    new = np.ones(len(start), bool)
    new[1:] = reach[1:] > reach[:-1]
    _, start, end, period = _shortest(np.zeros(int(new.sum()), np.int64), start[new], end[new],
                                      period[new])
    order = np.lexsort((period, start))
    return start[order], end[order], period[order]


def find_runs(ids: np.ndarray, starts: np.ndarray, least: int = LEAST, times: int = TIMES
              ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of all runs by start and period, as places in ``ids``, the numbered
    words of documents that begin at ``starts``."""
    none = np.zeros(0, np.int64)
    first, stop = covered_stretches(ids, starts, least - least // times)
    first, stop = first[stop - first >= least], stop[stop - first >= least]
    if not len(first):
        return none, none, none
    sizes = stop - first
    begin = np.cumsum(sizes) - sizes
    stretch = np.repeat(np.arange(len(first)), sizes)
    source = np.arange(sizes.sum()) + (first - begin)[stretch]
    text = np.unique(ids[source], return_inverse=True)[1].astype(np.int64)
    grammar = Grammar(text, stretch)
    symbol, place = grammar.places(begin, least)
    nodes, node_at, node = np.unique(symbol, return_index=True, return_inverse=True)
    left = grammar.left[nodes - grammar.terminals]
    at = place[node_at]
    found, start, end, period = border_runs(
        text, at, at + grammar.sizes[left], at + grammar.sizes[nodes], least, times)
    if not len(found):
        return none, none, none
    # Every place of a node has each of its runs.
    order = np.argsort(node, kind="stable")
    n_places = np.bincount(node, minlength=len(nodes))
    head = np.cumsum(n_places) - n_places
    each = n_places[found]
    row = np.repeat(np.arange(len(found)), each)
    k = np.arange(len(row)) - np.repeat(np.cumsum(each) - each, each)
    moved = place[order[head[found[row]] + k]] - at[found[row]]
    start, end, period = maximal(start[row] + moved, end[row] + moved, period[row])
    return source[start], source[end - 1] + 1, period


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words without those behind the first period of a run, joined by single blanks."""
    if runs:
        kept = np.ones(len(words), bool)
        for start, length, period in runs:
            kept[start + period:start + length] = False
        words = [words[i] for i in np.flatnonzero(kept)]
    return b" ".join(words)


def runs_of(texts: list[str | None], least: int = LEAST, times: int = TIMES
            ) -> tuple[list[list[bytes]], list[list[tuple[int, int, int]]]]:
    """Words, and runs as (start, length, period), of each text."""
    words = [text.encode().split() if text else [] for text in texts]
    number = _Numbers()
    sizes = np.array([len(w) for w in words], np.int64)
    ids = np.fromiter((number[w] for doc in words for w in doc), np.int64, int(sizes.sum()))
    starts = np.cumsum(sizes) - sizes
    found: list[list[tuple[int, int, int]]] = [[] for _ in words]
    filled = np.flatnonzero(sizes)
    start, end, period = find_runs(ids, starts[filled], least, times)
    owner = filled[np.searchsorted(starts[filled], start, "right") - 1] if len(start) else []
    for d, s, e, p in zip(owner, start.tolist(), end.tolist(), period.tolist()):
        found[d].append((s - int(starts[d]), e - s, p))
    return words, found


def periodic_runs(docs: DataFrame, least: int = LEAST, times: int = TIMES) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, runs (start, length, period; by start, then
    period) and collapsed, the text's words without repeated periods."""
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def rows(batches):
        for batch in text_groups(batches):
            words, runs = runs_of(batch.column("text").to_pylist(), least, times)
            named = [[{"start": s, "length": n, "period": p} for s, n, p in r] for r in runs]
            yield pa.record_batch(
                [batch.column("doc_id"), pa.array([len(w) for w in words], pa.int64()),
                 pa.array(named, pa.list_(run)),
                 pa.array([collapsed(w, r).decode() for w, r in zip(words, runs)], pa.string())],
                names=["doc_id", "n_words", "runs", "collapsed"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        rows, f"doc_id long, n_words long, runs array<{_RUN}>, collapsed string")


def edited_text(doc_id: str = "doc_id", text: str = "text"):
    """The text with its words from some place on replaced by repetitions of the first of
    them, for a tenth of all documents, drawn by crc32 of the id; others as they are."""
    h = F.crc32(F.col(doc_id).cast("string").cast("binary"))
    g = F.floor(h / 10)

    def repeated(words):
        n = F.size(words)
        a = g % n
        p = F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))
        tail = F.transform(F.sequence(F.lit(0).cast("long"), n - a - 1),
                           lambda i: F.get(words, (a + i % p).cast("int")))
        return F.array_join(F.concat(F.slice(words, F.lit(1), a.cast("int")), tail), " ")

    # The words are named once, inside a one-element array, and not cut again for each.
    words = F.regexp_extract_all(F.col(text), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    made = F.transform(F.array(words), repeated)[0]
    return F.when((h % 10 == 0) & F.col(text).rlike(r"[^\x20\x09-\x0D]"), made).otherwise(
        F.col(text))
