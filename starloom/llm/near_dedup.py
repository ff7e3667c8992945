"""MinHash near-dedup with bottom-k sketches from one hash function.

1. A document's set is its distinct word shingles (A-Z in lower case, words cut at ASCII white
   space; all words as one if there are fewer than a shingle has). Documents with equal sets form
   a class, so exact copies are only counted, never paired.
2. Each class keeps the k smallest hashes of its set. Two sets whose likeness reaches the
   threshold share most of their sketches. So of each sketch only the hashes that fewest classes
   retain are listed, one more than what a partner may miss: linked classes meet in some
   list, and hashes that are frequent are hardly ever listed.
3. Lists give pairs, the sketch of the union estimates their likeness, and what may reach the
   threshold is compared exactly, on the full shingle sets of the whole texts.
4. Pairs are taken in rounds, so that a list of many copies doesn't yield all its pairs: members
   against the list's first one; then members of different components against one drawn for the
   list; then all pairs of a list that still lie in different components. There a component
   of many classes is first compared as a whole: by the sketches of all its members together,
   of which a linked class shares as much as of one member's; then by their shingles, which
   bound the likeness to each member; and then in blocks. No pair of a list is left out unless
   its sides are linked already or these bounds show that they can't be.

A link is missed only if its estimate falls short by six standard deviations: with k = 64, below
0.5 for a likeness of at least 0.8. Sets of up to k shingles are estimated exactly.

Null, empty and blank texts have an empty set, are linked with nothing and stay. Repeated rows
count each. A doc_id with several texts is one document with several sets: each is compared, and
its rows may lie in different groups or, by way of the doc_id as the smallest, have one component
id. Rows without a doc_id are not compared, get no component and stay. Empty tables give no rows.
Columns can have any names.
"""

from __future__ import annotations

import hashlib
import math
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import mixed, scratch, text_groups
from starloom.llm.components import components, with_links
from starloom.operators.loaded_keys import BITS_PER_KEY, BLOCK_BITS, PROBES, has_bit
from starloom.session import Scratch

WORDS = 5
PERCENT = 80
SKETCH = 64
SIGMAS = 6.0
#: Classes from which on a component is compared as a whole first.
LARGE = 8
#: Classes of such a component, and of those around it, that a task compares at once.
BLOCK = 256
#: Hashes of a group of classes that a task counts at once.
SLICE = 1 << 18
#: Bitmaps of 4 KB that a filter of texts has at most, as it is broadcast.
FILTER_BLOCKS = 2048

_P = np.uint64(0x9E3779B97F4A7C15)


def word_list(text: str | None) -> list[bytes]:
    """Words of a text: A-Z in lower case, cut at the six ASCII white space characters."""
    return text.encode().lower().split() if text else []


def shingle_set(text: str | None, words: int = WORDS) -> set[tuple[bytes, ...]]:
    """The full set of shingles, as tuples of words."""
    found = word_list(text)
    if len(found) < words:
        return {tuple(found)} if found else set()
    return set(zip(*(found[i:] for i in range(words))))


_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64)]


def _powers(n: int) -> np.ndarray:
    if len(_POWERS[0]) < n:
        _POWERS[0] = np.multiply.accumulate(
            np.concatenate([np.ones(1, np.uint64), np.full(2 * n, _P, np.uint64)]))
    return _POWERS[0][:n]


def shingle_hashes(text: str | None, words: int = WORDS) -> np.ndarray:
    """Distinct 64-bit hashes of a text's shingles, ascending (unsigned)."""
    data = np.frombuffer(text.encode().lower(), np.uint8) if text else np.zeros(0, np.uint8)
    space = _SPACE[data]
    filled = ~space
    starts = np.flatnonzero(filled & np.concatenate([[True], space[:-1]])) if len(data) else data
    if not len(starts):
        return np.zeros(0, np.uint64)
    # Words as polynomials of their bytes, one pass over the text: a byte counts by its place
    # in the text, and words are told apart by their length and then mixed.
    ends = np.flatnonzero(filled & np.concatenate([space[1:], [True]])) + 1
    powers = _powers(int((ends - starts).max()) + 1)
    place = np.arange(len(data)) - np.repeat(starts, np.diff(np.append(starts, len(data)))
                                             ) if starts[0] == 0 else None
    if place is None:
        place = np.zeros(len(data), np.int64)
        place[starts[0]:] = np.arange(len(data) - starts[0]) - np.repeat(
            starts - starts[0], np.diff(np.append(starts, len(data))))
    place = np.where(filled, place, 0)
    terms = np.where(filled, (data.astype(np.uint64) + np.uint64(1)) * powers[place],
                     np.uint64(0))
    word = mixed(np.add.reduceat(terms, starts) + (ends - starts).astype(np.uint64) * _P)
    n = max(1, len(word) - words + 1)
    h = np.full(n, len(word) if len(word) < words else words, np.uint64)
    for j in range(min(words, len(word))):
        h = mixed(h * _P + word[j:j + n])
    return np.unique(h)


def sketches(docs: DataFrame, words: int, k: int) -> DataFrame:
    """(doc_id, text_hash, size, set_key, sketch) of every row with a doc_id; the key identifies
    the whole set, the sketch is ascending. Hashes are shifted to signed numbers in order."""

    def rows(batches):
        for batch in text_groups(batches):
            keys, sizes, kept = [], [], []
            for text in batch.column("text").to_pylist():
                hashes = shingle_hashes(text, words)
                sizes.append(len(hashes))
                keys.append(hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()
                            if len(hashes) else None)
                kept.append((hashes[:k] ^ np.uint64(1 << 63)).view(np.int64))
            yield pa.record_batch(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array(sizes, pa.int64()),
                 pa.array(keys, pa.binary()), pa.array(kept, pa.list_(pa.int64()))],
                names=["doc_id", "text_hash", "size", "set_key", "sketch"])

    return hashed_texts(docs).mapInArrow(
        rows, "doc_id long, text_hash long, size long, set_key binary, sketch array<long>")


def hashed_texts(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, text) of every row with a doc_id."""
    return docs.where("doc_id IS NOT NULL").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"),
        "text")


def likely(texts: DataFrame, wanted: DataFrame, store: Scratch) -> DataFrame:
    """``texts`` without most of the rows that the stored ``wanted`` does not name by doc_id and
    text_hash, and with all that it does: a Bloom filter, in blocks of one bitmap, drops texts
    before they are shuffled. Its size follows ``wanted`` up to ``FILTER_BLOCKS``; a fuller one
    lets more texts through."""
    row = ("doc_id", "text_hash")
    n = max(1, min(FILTER_BLOCKS, math.ceil(wanted.count() * BITS_PER_KEY / BLOCK_BITS)))
    block = F.pmod(F.xxhash64(F.lit("block"), *row), F.lit(n)).alias("block")
    spots = [F.pmod(F.xxhash64(F.lit(f"spot{i}"), *row), F.lit(BLOCK_BITS)).cast("long")
             for i in range(PROBES)]
    bits = wanted.select(block, F.explode(F.array(*spots)).alias("spot")).groupBy("block").agg(
        F.bitmap_construct_agg("spot").alias("bitmap"))
    bits = F.broadcast(store.keep(bits, "filter"))
    return texts.select("*", block).join(bits, "block").where(
        reduce(Column.__and__, map(has_bit, spots))).select(*texts.columns)


def needed(k: int, percent: int):
    """How many hashes of its sketch a class of ``size`` shares with the sketch of any class
    it is linked with, at least."""
    share = percent / 100
    low = share * k - SIGMAS * math.sqrt(k * share * (1 - share))
    found = F.when(F.col("size") <= share * k, F.ceil(F.col("size") * percent / 100)).otherwise(
        F.floor(F.least("size", F.lit(k)) * (low / k)))
    return F.greatest(found, F.lit(1))


def lists(classes: DataFrame, k: int, percent: int, store: Scratch) -> DataFrame:
    """(value, id, size): the listed hashes of each class, those with two classes or more.

    Hashes travel with the number of their class and nothing else, once to those of the same value
    and, if there are any, once to the others of their class."""
    values = classes.select("id", F.explode("sketch").alias("value"))
    shared = values.groupBy("value").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    # Few hashes of a class lie in one task before, so they are put together behind the shuffle.
    found = values.join(shared, "value").select("id", "n", "value").repartition("id").groupBy(
        "id").agg(F.sort_array(F.collect_list(F.struct("n", "value"))).alias("found"))
    found = found.join(classes.select("id", "size"), "id")
    kept = F.least("size", F.lit(k))
    # Hashes that no other class retains come first and are listed nowhere.
    listed = kept - needed(k, percent) + 1
    alone = kept - F.size("found")
    found = found.select("id", "size", F.slice(
        "found", 1, F.greatest(listed - alone, F.lit(0)).cast("int")).alias("found"))
    return found.select("id", "size", F.explode("found.value").alias("value"))


def _fits(a: str, b: str, percent: int):
    """Sets whose sizes differ more than the threshold allows are never linked."""
    return (F.least(a, b) * 100) >= F.greatest(a, b) * percent


def may_reach(a: np.ndarray, b: np.ndarray, size_a: int, size_b: int, percent: int, k: int
              ) -> bool:
    """Whether two sets may reach the threshold, by the sketch of their union."""
    common = np.intersect1d(a, b, assume_unique=True)
    if size_a <= k and size_b <= k:
        return 100 * len(common) >= percent * (size_a + size_b - len(common))
    # The union's k smallest hashes, and how many of them both sides have.
    union = np.union1d(a, b)[:k]
    hits, share = int(np.searchsorted(common, union[-1], "right")), percent / 100
    return hits >= len(union) * share - SIGMAS * math.sqrt(len(union) * share * (1 - share))


def promising(pairs: DataFrame, classes: DataFrame, percent: int, k: int) -> DataFrame:
    """Pairs (x, y) whose likeness may reach the threshold. Sketches travel with the upper 32 bits
    of their hashes, which keep their order; hashes that agree in them by chance count as equal
    and only raise the estimate."""
    upper = F.transform("sketch", lambda h: F.shiftright(h, 32).cast("int"))
    a = classes.select(F.col("id").alias("x"), upper.alias("sx"), F.col("size").alias("nx"))
    b = classes.select(F.col("id").alias("y"), upper.alias("sy"), F.col("size").alias("ny"))

    def estimate(batches):
        for batch in batches:
            parts = []
            for name in ("sx", "sy"):
                column = batch.column(name)
                ends = column.offsets.to_numpy()
                flat = column.values.to_numpy()
                parts.append([flat[i:j] for i, j in zip(ends, ends[1:])])
            sizes = zip(batch.column("nx").to_pylist(), batch.column("ny").to_pylist())
            keep = [may_reach(p, q, m, n, percent, k) for p, q, (m, n) in zip(*parts, sizes)]
            yield batch.select(["x", "y"]).filter(pa.array(keep, pa.bool_()))

    both = pairs.select("x", "y").join(a, "x").join(b, "y")
    return both.select("x", "y", "sx", "sy", "nx", "ny").mapInArrow(estimate, "x long, y long")


def confirmed(pairs: DataFrame, firsts: DataFrame, texts: DataFrame, words: int, percent: int
              ) -> DataFrame:
    """The pairs whose full shingle sets reach the threshold. ``firsts`` (id, doc_id, text_hash)
    names the text of each class, and ``texts`` has it, each once. Both sides of a pair are found
    in the same shuffle of texts, by the name of the text."""
    def named(side: str) -> DataFrame:
        return firsts.select(F.col("id").alias(side), F.col("doc_id").alias(f"d{side}"),
                             F.col("text_hash").alias(f"h{side}"))

    def texts_of(side: str) -> DataFrame:
        return texts.select(F.col("doc_id").alias(f"d{side}"), F.col("text_hash").alias(f"h{side}"),
                            F.col("text").alias(f"t{side}"))

    def compare(batches):
        held: tuple = (None, None)
        for batch in batches:
            keep = []
            for y, tx, ty in zip(batch.column("y").to_pylist(), batch.column("tx"),
                                 batch.column("ty")):
                # Rows come by y, whose set is made once.
                if held[0] != y:
                    held = (y, shingle_set(ty.as_py(), words))
                other = shingle_set(tx.as_py(), words)
                both = len(held[1] & other)
                keep.append(100 * both >= percent * (len(held[1]) + len(other) - both))
            yield batch.select(["x", "y"]).filter(pa.array(keep, pa.bool_()))

    both = pairs.join(named("x"), "x").join(named("y"), "y")
    both = both.join(texts_of("x"), ["dx", "hx"]).join(texts_of("y"), ["dy", "hy"])
    return both.select("x", "y", "tx", "ty").mapInArrow(compare, "x long, y long")


def class_components(docs: DataFrame, words: int = WORDS, percent: int = PERCENT,
                     k: int = SKETCH) -> tuple[DataFrame, DataFrame]:
    """(doc_id, text_hash, size, id, label) of every row with a doc_id, where id is a number of its class and
    label the smallest doc_id of it, and (id, component) of all classes that are linked with
    others, where component is the smallest label reachable."""
    store = scratch(docs.sparkSession)
    # Removed at the end, and what only one step needs with that step.
    work = store.part("work")
    first = work.part("sketches")
    made = first.keep(sketches(docs, words, k), "sketches")
    # A class is its set. Its first row stands for it; other texts of that doc_id do not. All its
    # rows have one sketch, which is reduced with them and travels once.
    classes = made.where("size > 0").groupBy("set_key").agg(
        F.min(F.struct("doc_id", "text_hash")).alias("first"), F.first("size").alias("size"),
        F.first("sketch").alias("sketch"))
    classes = work.keep(classes.select(
        "set_key", F.col("first.doc_id").alias("label"), F.col("first.text_hash").alias("_hash"),
        F.monotonically_increasing_id().alias("id"), "size", "sketch"), "classes")
    made = store.keep(made.select("doc_id", "text_hash", "size", "set_key"), "rows")
    first.clear()
    ids = store.keep(classes.select("set_key", "label", "_hash", "id"), "ids")
    listed = work.keep(lists(classes, k, percent, work), "lists")

    def firsts_of(nodes: DataFrame, step: Scratch) -> DataFrame:
        """(id, doc_id, text_hash) of the classes in ``nodes`` (id), stored."""
        return step.keep(ids.join(nodes, "id").select(
            "id", F.col("label").alias("doc_id"), F.col("_hash").alias("text_hash")), "firsts")

    def texts_of(nodes: DataFrame) -> DataFrame:
        """(id, text) of the classes in ``nodes`` (id)."""
        firsts = firsts_of(nodes, work)
        found = likely(hashed_texts(docs), firsts, work).join(firsts, ["doc_id", "text_hash"])
        return found.dropDuplicates(["doc_id", "text_hash"]).select("id", "text")

    def test(pairs: DataFrame, name: str) -> DataFrame:
        step = work.part(name)
        found = step.keep(promising(pairs, classes, percent, k), f"{name}_promising")
        nodes = step.keep(found.select(F.explode(F.array("x", "y")).alias("id")).distinct(),
                          f"{name}_nodes")
        firsts = firsts_of(nodes, step)
        # A text that repeats is kept once, in the shuffle that brings it to its pairs.
        some = likely(hashed_texts(docs), firsts, step).dropDuplicates(["doc_id", "text_hash"])
        links = work.keep(confirmed(found, firsts, some, words, percent), f"{name}_links")
        step.clear()
        return links

    def labelled(found: DataFrame, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
        found = work.keep(found, "components")
        marked = rows.join(found, rows["id"] == found["node"], "left").select(
            "value", "id", "size", F.coalesce("component", "id").alias("component"))
        return found, marked

    links = test(_stars(listed.withColumn("component", F.col("id")), percent, None), "first")
    found, marked = labelled(components(links, work), listed)
    marked = work.keep(_undecided(marked.withColumn("large", F.lit(False))), "undecided")
    links = test(_stars(marked, percent, "drawn"), "drawn")
    # Components only grow, so a list that lay in one of them still does.
    found, marked = labelled(with_links(found, links, work),
                             marked.select("value", "id", "size"))
    sizes = found.groupBy("component").agg(F.count(F.lit(1)).alias("members"))
    marked = work.keep(_undecided(_with_large(marked, sizes)), "undecided")
    pairs = _small_pairs(marked, percent).unionByName(
        _large_pairs(marked, found, classes, texts_of, words, percent, k, work))
    found = store.keep(with_links(found, test(pairs, "last"), work), "components")
    work.clear()
    members = made.join(ids, "set_key", "left").select("doc_id", "text_hash", "size", "id",
                                                       "label")
    named = found.select(F.col("node").alias("id"), F.col("component").alias("_of")).join(
        ids.select("id", "label"), "id")
    least = named.groupBy("_of").agg(F.min("label").alias("component"))
    return members, named.join(least, "_of").select("id", "component")


def _undecided(marked: DataFrame) -> DataFrame:
    """Lists whose classes are not all in one component yet; ``beside`` tells whether a list
    has a large component."""
    mixed = marked.groupBy("value").agg(
        F.min("component").alias("_a"), F.max("component").alias("_b"),
        F.max("large").alias("beside")).where("_a < _b")
    return marked.join(mixed.select("value", "beside"), "value")


def _stars(marked: DataFrame, percent: int, draw: str | None) -> DataFrame:
    """Pairs of a list's members with one of them: the first by id, or one drawn by a hash of
    value and id. Pairs within a component are left out."""
    if draw is None:
        heads = marked.groupBy("value").agg(F.min("id").alias("head"))
        paired = marked.join(heads, "value")
    else:
        # The draw is carried in one number, so that a hot list is reduced before the shuffle.
        rank = F.xxhash64(F.lit(draw), "value", "id")
        heads = marked.groupBy("value").agg(F.min(rank).alias("_rank"))
        first = marked.withColumn("_r", rank).join(
            heads.withColumnRenamed("value", "_v"),
            (F.col("value") == F.col("_v")) & (F.col("_r") == F.col("_rank")))
        heads = first.groupBy("value").agg(F.min("id").alias("head"))
        paired = marked.join(heads, "value")
    head = marked.select(F.col("id").alias("head"), F.col("size").alias("_size"),
                         F.col("component").alias("_component")).dropDuplicates(["head"])
    paired = paired.where("id <> head").select(
        "id", "size", "component", "head").distinct().join(head, "head")
    paired = paired.where(_fits("size", "_size", percent)
                          & (F.col("component") != F.col("_component")))
    return paired.select(F.least("id", "head").alias("x"), F.greatest("id", "head").alias("y")
                         ).distinct()


def _with_large(marked: DataFrame, sizes: DataFrame) -> DataFrame:
    """``marked`` with a flag for components of at least ``LARGE`` classes."""
    return marked.join(sizes, "component", "left").withColumn(
        "large", F.coalesce("members", F.lit(1)) >= LARGE).drop("members")


def _small_pairs(marked: DataFrame, percent: int) -> DataFrame:
    """All pairs of different components in lists without a large one."""
    some = marked.where("NOT beside").select("value", "id", "size", "component")
    other = some.select("value", F.col("id").alias("x"), F.col("size").alias("_size"),
                        F.col("component").alias("_component"))
    pairs = some.join(other, "value").where(
        (F.col("id") < F.col("x")) & (F.col("component") != F.col("_component"))
        & _fits("size", "_size", percent))
    return pairs.select(F.col("id").alias("x"), F.col("x").alias("y")).distinct()


def _alone(held: DataFrame, key: list[str], owner: str, within: tuple[str, ...] = ()) -> DataFrame:
    """(*within, owner, alone): the hashes that a unit has to itself. ``held`` has a row for each
    hash, named by ``key``, of each owner in a group. A hash that comes once names its owner, so
    rows are only reduced: no row meets those of others that have the same hash. ``_shared`` counts
    the same without a row per hash; tests hold it against this."""
    once = held.groupBy(*key).agg(
        F.count(F.lit(1)).alias("_n"), F.min(owner).alias(owner), F.max("unit").alias("unit")
    ).where("_n = 1 AND unit")
    return once.groupBy(*within, owner).agg(F.count(F.lit(1)).alias("alone"))


def _shared(held: DataFrame, store: Scratch, name: str) -> DataFrame:
    """(target, id, shared): how many of a row's values others of its group hold. Of a unit it
    counts what any other row has, of a member what a unit has. ``held`` has (target, id, unit,
    n, values), a row for each class of a group, with n distinct hashes.

    The hashes of a row stay together in an array, with 32 bits each; hashes that agree in them by
    chance only raise the number. A group with more than ``SLICE`` of them is dealt by hash, so
    that a task counts about as many and equal ones still meet."""
    slices = held.groupBy("target").agg(
        F.ceil(F.sum("n") / SLICE).cast("int").alias("slices"))

    def cut(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            values = batch.column("values")
            lengths = pc.list_value_length(values).to_numpy()
            flat = values.flatten().to_numpy()
            row = np.repeat(np.arange(len(lengths)), lengths)
            place = flat.view(np.uint64) % batch.column("slices").to_numpy().astype(
                np.uint64)[row]
            order = np.lexsort((place, row))
            row, place, flat = row[order], place[order], flat[order]
            starts = np.flatnonzero(np.concatenate(
                [[True], (row[1:] != row[:-1]) | (place[1:] != place[:-1])]))
            kept = batch.select(["target", "id", "unit"]).take(pa.array(row[starts]))
            parts = pa.ListArray.from_arrays(
                pa.array(np.append(starts, len(flat)), pa.int32()),
                pa.array(flat.astype(np.int32)))
            yield pa.record_batch(
                [*kept.columns, pa.array(place[starts].astype(np.int32)), parts],
                names=["target", "id", "unit", "slice", "values"])

    def count(rows: pa.Table) -> pa.Table:
        values = rows.column("values").combine_chunks()
        owner = np.repeat(np.arange(len(rows)), pc.list_value_length(values).to_numpy())
        unit = rows.column("unit").to_numpy()[owner]
        _, place, total = np.unique(values.flatten().to_numpy(), return_inverse=True,
                                    return_counts=True)
        of_units = np.bincount(place[unit], minlength=len(total))
        hit = np.where(unit, total[place] > 1, of_units[place] > 0)
        shared = np.bincount(owner[hit], minlength=len(rows))
        return pa.table([rows.column("target"), rows.column("id"), pa.array(shared, pa.int64())],
                        names=["target", "id", "shared"])

    cuts = held.join(slices, "target").select(
        "target", "id", "unit", "slices", "values").mapInArrow(
        cut, "target long, id long, unit boolean, slice int, values array<int>")
    counts = cuts.groupBy("target", "slice").applyInArrow(
        count, "target long, id long, shared long")
    return store.keep(counts.groupBy("target", "id").agg(F.sum("shared").alias("shared")), name)


def _large_pairs(marked: DataFrame, found: DataFrame, classes: DataFrame, texts_of,
                 words: int, percent: int, k: int, store: Scratch) -> DataFrame:
    """Pairs from lists with a large component, as far as sketches and shingles allow them.

    A large component and the classes that share a list with it are a group. A class shares
    no more with another one than what it shares with all others of the group together, and one
    of the component no more than with all those beside it. That number, one for each class,
    and the sizes bound its likeness to each. It is first taken from sketches, and from the full
    sets of what they leave. What it leaves is compared in blocks, from which only links come.
    """
    heads = marked.where("large").select(
        "value", F.col("component").alias("target")).distinct()
    units = marked.join(heads, "value").where(
        (F.col("component") != F.col("target"))
        & (~F.col("large") | (F.col("component") < F.col("target"))))
    units = store.keep(units.select("id", "size", "component", "target").distinct(), "units")
    targets = store.keep(units.select(F.col("target").alias("component")).distinct(), "targets")
    if not targets.head(1):
        return units.select(F.col("id").alias("x"), F.col("id").alias("y")).limit(0)
    members = found.join(targets, "component").select(F.col("node").alias("id"), "component")
    members = members.join(classes.select("id", "size"), "id").withColumn(
        "target", F.col("component"))
    group = store.keep(units.withColumn("unit", F.lit(True)).unionByName(
        members.withColumn("unit", F.lit(False))), "groups")
    shared = _shared(group.join(classes.select("id", "sketch"), "id").select(
        "target", "id", "unit", F.least("size", F.lit(k)).alias("n"),
        F.col("sketch").alias("values")), store, "sketch_shares")
    group = store.keep(group.join(shared, ["target", "id"]).where(
        F.col("shared") >= needed(k, percent)).drop("shared"), "near_units")
    nodes = store.keep(group.select("id").distinct(), "group_nodes")

    def hashes(batches):
        for batch in text_groups(batches):
            kept = [shingle_hashes(t, words).view(np.int64)
                    for t in batch.column("text").to_pylist()]
            yield pa.record_batch([batch.column("id"), pa.array(kept, pa.list_(pa.int64()))],
                                  names=["id", "hashes"])

    full = texts_of(nodes).mapInArrow(hashes, "id long, hashes array<long>")
    full = store.keep(full, "group_sets")
    covered = _shared(group.join(full, "id").select(
        "target", "id", "unit", F.col("size").alias("n"), F.col("hashes").alias("values")),
        store, "set_shares").withColumnRenamed("shared", "covered")
    lowest = group.groupBy("target").agg(F.min("size").alias("_low"))
    least = F.greatest("_low", "covered")
    group = group.join(covered, ["target", "id"]).join(lowest, "target").where(
        F.col("covered") * 100 >= (F.col("size") + least - F.col("covered")) * percent)
    group = store.keep(group.select("id", "component", "target", "unit"), "open_units")
    units = group.where("unit").drop("unit")
    others = group.select("target", F.col("id").alias("other"),
                          F.col("component").alias("_component"))
    return _linked_by_blocks(units, others, full, percent, store)


def _linked_by_blocks(units: DataFrame, others: DataFrame, full: DataFrame, percent: int,
                      store: Scratch) -> DataFrame:
    """Pairs of ``units`` and ``others`` of one target whose full sets of hashes reach the
    threshold. Both come in blocks of about ``BLOCK`` classes, and a task gets one block of each,
    so what it holds is bounded and only linked pairs leave it."""

    def blocks(frame: DataFrame, name: str) -> DataFrame:
        return frame.groupBy("target").agg(
            F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias(name))

    n_units, n_others = blocks(units, "_units"), blocks(others, "_others")
    sizes = n_units.join(n_others, "target")
    left = units.join(full, "id").join(sizes, "target").select(
        "target", F.pmod(F.xxhash64("id"), "_units").cast("int").alias("u"),
        F.explode(F.sequence(F.lit(0), F.col("_others") - 1)).alias("o"),
        "id", "component", "hashes")
    right = others.join(full.select(F.col("id").alias("other"), "hashes"), "other").join(
        sizes, "target").select(
        "target", F.explode(F.sequence(F.lit(0), F.col("_units") - 1)).alias("u"),
        F.pmod(F.xxhash64("other"), "_others").cast("int").alias("o"),
        "other", "_component", "hashes")

    def compare(left, right):
        import pandas as pd

        pairs = []
        if len(left) and len(right):
            sets = [np.asarray(h, np.int64) for h in right["hashes"]]
            sizes = np.array([len(s) for s in sets])
            owner = np.repeat(np.arange(len(sets)), sizes)
            values = np.concatenate(sets)
            order = np.argsort(values, kind="stable")
            values, owner = values[order], owner[order]
            other, component = right["other"].to_numpy(), right["_component"].to_numpy()
            for id_, comp, hashes in zip(left["id"], left["component"], left["hashes"]):
                mine = np.sort(np.asarray(hashes, np.int64))
                low = np.searchsorted(values, mine, "left")
                high = np.searchsorted(values, mine, "right")
                found = [owner[i:j] for i, j in zip(low, high) if j > i]
                common = np.bincount(np.concatenate(found), minlength=len(sets)) if found else (
                    np.zeros(len(sets), np.int64))
                hit = 100 * common >= percent * (len(mine) + sizes - common)
                hit &= component != comp
                pairs += [(min(id_, x), max(id_, x)) for x in other[hit]]
        return pd.DataFrame(pairs, columns=["x", "y"]).astype("int64")

    key = ["target", "u", "o"]
    left, right = store.keep(left, "unit_blocks"), store.keep(right, "other_blocks")
    return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(
        compare, "x long, y long").distinct()


def _labelled_rows(docs: DataFrame, words: int, percent: int, k: int) -> DataFrame:
    """doc_id, text_hash, n_shingles, component_id, kept for every row with a doc_id."""
    members, found = class_components(docs, words, percent, k)
    own = F.coalesce("component", "label", "doc_id")
    return members.join(found, "id", "left").select(
        "doc_id", "text_hash", F.col("size").alias("n_shingles"), own.alias("component_id"),
        (F.col("doc_id") == own).alias("kept"))


def near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT,
                    k: int = SKETCH) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row with a doc_id."""
    return _labelled_rows(docs, words, percent, k).drop("text_hash")


def kept_documents(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` without the near duplicates of smaller doc_ids. Of rows that
    repeat the kept doc_id, all stay."""
    found = _labelled_rows(docs, words, percent, SKETCH).where(~F.col("kept")).select(
        F.col("doc_id").alias("_dropped"), F.col("text_hash").alias("_hash")).distinct()
    gone = scratch(docs.sparkSession).keep(found, "dropped")
    return docs.join(gone, (docs["doc_id"].cast("long") == gone["_dropped"])
                     & (F.xxhash64(docs["text"]) == gone["_hash"]), "left_anti")
