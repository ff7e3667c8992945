"""Nearest neighbours, near duplicates, components and the pipeline."""

from __future__ import annotations

import time
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from starloom.llm import near_dedup, neighbours, queries
from starloom.llm.common import scratch
from starloom.llm.components import components, with_links
from starloom.session import Scratch


def brute_nearest(rows, k, asked):
    rows = [(i, np.array(v, float)) for i, v in rows
            if i is not None and v is not None and len(v) and None not in v
            and np.isfinite(np.array(v, float)).all() and np.any(v)]
    out = set()
    for q, a in rows:
        if asked(q):
            near = sorted((-(a * b).sum() / (np.sqrt((a * a).sum()) * np.sqrt((b * b).sum())), i)
                          for i, b in rows if i != q)
            out |= {(q, n + 1, i) for n, (_, i) in enumerate(near[:k])}
    return out


def test_probing_finds_every_code_in_the_radius():
    rng = np.random.default_rng(0)
    codes = rng.integers(0, 2 ** 16, (400, 4)).astype(np.uint16)
    queries_ = codes[:20] ^ (1 << rng.integers(0, 16, (20, 4))).astype(np.uint16)
    for radius in (0, 3, 9, 25, 64):
        assert (neighbours.probe(codes, queries_, radius)
                == (neighbours.distances(queries_, codes) <= radius)).all()
    assert all(sum(r + 1 for r in neighbours.part_radii(n, 7)) == n + 1 for n in range(50))


def test_neighbours_recall(llm):
    folder = "/root/testdata/sf0.01"
    rows = llm.read.parquet(f"{folder}/embeddings.parquet").collect()
    expected = brute_nearest([(r.vec_id, r.embedding) for r in rows], 5, lambda q: q % 50 == 0)
    found = {(r.query_id, r.rank, r.vec_id) for r in queries.op7_neighbours(llm, folder).collect()}
    assert len(found) == len(expected) and len(found & expected) >= 0.9 * len(expected)


def test_neighbours_of_odd_vectors(llm):
    rows = [(0, [1.0, 0.0]), (50, [0.0, 0.0]), (1, [2.0, 0.0]), (2, [3.0, 0.0]), (3, None),
            (4, [float("nan"), 1.0]), (5, [1.0, None]), (6, [0.0, 1.0]), (7, [-1.0, 0.0]),
            (None, [1.0, 1.0]), (8, [float("inf"), 1.0]), (9, [1.0, 1.0]), (100, [1.0, 0.5])]
    frame = llm.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn(
        "block", F.lit(1))
    found = neighbours.nearest(frame, F.col("vec_id") % 50 == 0).collect()
    assert {(r.query_id, r.rank, r.vec_id) for r in found} == brute_nearest(
        rows, 5, lambda q: q % 50 == 0)
    assert neighbours.nearest(frame.limit(0), F.col("vec_id") == 0).count() == 0
    assert neighbours.nearest(frame.limit(1), F.col("vec_id") == 0).count() == 0


def distinct_nearest(rows, k, asked):
    """(query_id, rank, vec_id) over pairs of ids with their highest cosine."""
    unit = np.array([v for _, v in rows], float)
    unit /= np.sqrt((unit * unit).sum(1))[:, None]
    scores, out = unit @ unit.T, set()
    for q in {i for i, _ in rows if asked(i)}:
        best = {}
        for n in (n for n, (i, _) in enumerate(rows) if i == q):
            for (i, _), s in zip(rows, scores[n]):
                if i != q:
                    best[i] = max(s, best.get(i, -2))
        near = sorted(best, key=lambda i: (-best[i], i))[:k]
        out |= {(q, n + 1, i) for n, i in enumerate(near)}
    return out


@pytest.mark.parametrize("block_rows,radius", [(2048, 64), (40, 64), (40, 0)])
def test_neighbours_of_repeated_rows(llm, monkeypatch, block_rows, radius):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(150)]
    rows += [(200, rng.normal(size=8).tolist()) for _ in range(60)]  # a hot id, many vectors
    rows += [(100, rng.normal(size=8).tolist())]                     # a query of two vectors
    near = distinct_nearest(rows, 1, lambda q: q % 50 == 0)
    copied = {i for _, _, i in near} | {50}
    repeated = rows + [r for r in rows if r[0] in copied for _ in range(5)]
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", block_rows)
    learn = neighbours.learn  # a radius for all rows, or one that sends each query round again
    monkeypatch.setattr(neighbours, "learn", lambda x, k: replace(learn(x, k), radius=radius))
    frame = llm.createDataFrame(repeated, "vec_id long, embedding array<double>")
    found = neighbours.nearest(frame, F.col("vec_id") % 50 == 0).collect()
    expected = distinct_nearest(rows, 5, lambda q: q % 50 == 0)
    assert {(r.query_id, r.rank, r.vec_id) for r in found} == expected
    assert len(found) == len(expected) == 4 * 5


def test_copies_of_a_near_row_leave_room_for_others(llm):
    rows = [(0, [1.0, 0.0])] + [(1, [1.0, 0.01])] * 5 + [(i, [1.0, 0.1 * i]) for i in range(2, 9)]
    frame = llm.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = neighbours.nearest(frame, F.col("vec_id") == 0).collect()
    assert [(r.rank, r.vec_id) for r in sorted(found)] == [(n, n) for n in range(1, 6)]


def brute_components(rows, words, percent):
    sets = {d: near_dedup.shingle_set(t, words) for d, t in rows if d is not None}
    label = {d: d for d in sets}
    changed = True
    linked = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b]
              and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    while changed:
        changed = False
        for a, b in linked:
            low = min(label[a], label[b])
            changed |= (label[a], label[b]) != (low, low)
            label[a] = label[b] = low
    return {d: (len(s), label[d]) for d, s in sets.items()}


def edited(rng, words, share):
    return " ".join(w if rng.random() > share else f"x{rng.integers(10 ** 6)}" for w in words)


def family_rows():
    """Copies, chains and a family of near copies with many borderline members."""
    rng = np.random.default_rng(5)
    base = [f"b{i}" for i in rng.integers(0, 400, 120)]
    rows = [(i, edited(rng, base, rng.choice([0.0, 0.02, 0.04, 0.06, 0.09, 0.2])))
            for i in range(120)]
    chain = [f"c{i}" for i in range(100)]
    rows += [(200 + i, " ".join(chain[i * 4:i * 4 + 60])) for i in range(10)]
    rows += [(300 + i, f"of the {'and' if i % 2 else 'or'}") for i in range(6)]
    rows += [(400 + i, " ".join(base[:60]) + " " + edited(rng, base[60:], 1.0)) for i in range(9)]
    return rows


@pytest.mark.parametrize("words", [2, 5])
def test_near_duplicates_match_brute_force(make, odd, sample, words):
    rows = [r for r in odd if r[0] is not None] + [(1000 + d, t) for d, t in family_rows()]
    rows += [(5000 + r.doc_id, r.text) for r in sample.itertuples()]
    found = near_dedup.near_duplicates(make(rows, ["id", "size", "component"]), words, 80).collect()
    expected = brute_components(rows, words, 80)
    assert len(found) == len(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == expected
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_texts_that_share_a_doc_id_keep_their_links(make):
    a, b, other = ([f"{c}{i}" for i in range(60)] for c in "abz")
    near = lambda words: " ".join(words[:-1] + ["x"])
    rows = [(1, " ".join(a)), (1, " ".join(b)), (2, near(a)), (3, near(b)), (4, " ".join(a)),
            (5, " ".join(b)), (6, " ".join(other)), (6, near(a)), (7, None), (7, near(other))]
    found = near_dedup.near_duplicates(make(rows, ["label", "text_hash"]), 2, 80).collect()
    ids = sorted((r.doc_id, r.component_id) for r in found)
    assert ids == [(1, 1), (1, 1), (2, 1), (3, 1), (4, 1), (5, 1), (6, 1), (6, 6), (7, 6), (7, 7)]
    kept = near_dedup.kept_documents(make(rows), 2, 80).collect()
    assert sorted((r.doc_id, r.text) for r in kept if r.doc_id != 1) == [
        (6, " ".join(other)), (7, None)]
    assert sum(r.doc_id == 1 for r in kept) == 2


def test_families_with_common_passages_match_brute_force(make):
    """Near copies within each family, and a third of each text common to all."""
    rng = np.random.default_rng(11)
    common, rows = [f"of{i}" for i in range(30)], []
    for family in range(12):
        own = [f"f{family}w{i}" for i in range(60)]
        rows += [(family * 40 + i, edited(rng, common + own, 0.03)) for i in range(20)]
    found = near_dedup.near_duplicates(make(rows), 2, 80).collect()
    expected = brute_components(rows, 2, 80)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == expected


def test_shared_hashes_are_counted_without_joins(llm, make, monkeypatch):
    """Rows of a large group are not joined by their hashes to find what its others hold."""
    rows = [(1, g, i, h, unit) for g in (1, 2) for i, unit, held in (
        (10, True, "abcd"), (11, False, "bcx"), (12, True, "cyz"), (13, True, "abcd"))
        for h in held if (g, i) != (2, 13)]
    held = llm.createDataFrame(rows, "one int, target int, id long, hash string, unit boolean")
    alone = near_dedup._alone(held, ["target", "hash"], "id", ("target",)).collect()
    assert {(r.target, r.id): r.alone for r in alone} == {(1, 12): 2, (2, 10): 2, (2, 12): 2}

    plans, keep = {}, near_dedup.Scratch.keep

    def watched(store, df, name):
        plans[name] = df._jdf.queryExecution().optimizedPlan().toString()
        return keep(store, df, name)

    monkeypatch.setattr(near_dedup.Scratch, "keep", watched)
    near_dedup.near_duplicates(make(family_rows()), 2, 80).collect()
    for name, column in (("near_units", "key"), ("open_units", "hash")):
        joins = [line for line in plans[name].splitlines() if "Join" in line]
        assert joins and not any(f"({column}#" in line for line in joins)


@pytest.mark.parametrize("limit", [4, 1 << 18])
def test_hashes_of_a_group_travel_in_arrays(llm, make, monkeypatch, limit):
    """Shares are those of a row per hash, in one slice or many, and no such row is made."""
    rng = np.random.default_rng(2)
    held = [(g, i, bool(i % 3), sorted({int(v) - 40 for v in rng.integers(0, 90, 3 + i)}))
            for g, n in ((1, 12), (2, 2), (3, 25)) for i in range(n)]
    expected = {}
    for g, i, unit, values in held:
        others = {v for h, j, u, more in held if h == g and j != i and (unit or u) for v in more}
        expected[g, i] = len(set(values) & others)
    monkeypatch.setattr(near_dedup, "SLICE", limit)
    frame = llm.createDataFrame([(*r, len(r[3])) for r in held],
                                "target long, id long, unit boolean, values array<long>, n int")
    found = near_dedup._shared(frame, scratch(llm), "shares")
    found = {(r.target, r.id): r.shared for r in found.collect()}
    assert found == expected
    alone = near_dedup._alone(frame.withColumn("hash", F.explode("values")), ["target", "hash"],
                              "id", ("target",)).collect()
    alone = {(r.target, r.id): r.alone for r in alone}
    assert all(found[g, i] == len(v) - alone.get((g, i), 0) for g, i, unit, v in held if unit)

    plans, keep = {}, near_dedup.Scratch.keep

    def watched(store, df, name):
        plans[name] = df._jdf.queryExecution().optimizedPlan().toString()
        return keep(store, df, name)

    monkeypatch.setattr(near_dedup.Scratch, "keep", watched)
    rows = family_rows()
    labels = near_dedup.near_duplicates(make(rows), 2, 80).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in labels} == brute_components(rows, 2, 80)
    assert not any("Generate explode" in plans[name] for name in (
        "sketch_shares", "near_units", "group_sets", "set_shares", "open_units"))


def test_kept_documents(make, odd):
    docs = make(odd, ["id", "_dropped"])
    kept = near_dedup.kept_documents(docs, 2, 80)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 1, 2, 3, 4, 5, 8, 9, 10, 11]
    assert near_dedup.kept_documents(make([])).count() == 0


def test_hashes_stand_for_shingles(odd):
    texts = [t for _, t in odd] + [t for _, t in family_rows()[:20]] + ["A a", "a A", "aa", "a a a"]
    hashes = {}
    for words in (1, 2, 5):
        for text in texts:
            found, real = near_dedup.shingle_hashes(text, words), near_dedup.shingle_set(text, words)
            assert len(found) == len(real)
            assert hashes.setdefault((words, frozenset(real)), found.tobytes()) == found.tobytes()


def test_components_of_a_long_chain_and_a_star(llm):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7)]
    frame = llm.createDataFrame(links, "x long, y long")
    found = {r.node: r.component for r in components(frame, scratch(llm)).collect()}
    assert found == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}}
    assert components(frame.limit(0), scratch(llm)).count() == 0


def test_links_added_to_components(llm):
    first = llm.createDataFrame([(1, 2), (2, 3), (10, 11), (20, 21)], "x long, y long")
    more = llm.createDataFrame([(3, 10), (30, 31), (11, 2), (31, 32), (40, 40)], "x long, y long")
    store = scratch(llm)
    found = with_links(store.keep(components(first, store), "first"), more, store)
    groups = {}
    for r in found.collect():
        groups.setdefault(r.component, set()).add(r.node)
    assert sorted(map(sorted, groups.values())) == [[1, 2, 3, 10, 11], [20, 21], [30, 31, 32], [40]]
    assert with_links(found, more.limit(0), store).count() == found.count()


def test_pipeline_stages(llm, tables):
    """Each stage on what the one before kept, against what its operator promises."""
    docs = llm.read.parquet(f"{tables}/documents.parquet")
    columns, store, seen = docs.columns, scratch(llm), {"documents": docs}
    for name, stage in corpus_pipeline.STAGES:
        docs = store.keep(stage(llm, docs, tables), name)
        seen[name] = docs
        if name != "packing":
            assert docs.columns == columns
    ids = {n: {r.doc_id for r in f.collect()} for n, f in seen.items()}
    labels = llm.read.parquet(f"{tables}/labels.parquet").collect()
    good = {r.doc_id for r in labels if r.quality == 1}
    assert len(good - ids["quality_filter"]) <= 0.03 * len(good)
    assert ids["line_dedup"] == ids["quality_filter"]
    rows = [(r.doc_id, r.text) for r in seen["line_dedup"].collect()]
    expected = {d for d, (_, c) in brute_components(rows, 5, 80).items() if d == c}
    assert ids["near_dedup"] == expected
    texts = {r.doc_id: r.text for r in seen["near_dedup"].collect()}
    assert ids["mixing"] <= {d for d, t in texts.items() if (t or "").split()}
    assert all(texts[r.doc_id] == r.text for r in seen["mixing"].collect())
    packed = seen["packing"].groupBy("sequence_id").agg(F.sum("length").alias("n"))
    assert packed.where("n > 4096").count() == 0
    assert seen["packing"].where("piece = 0").count() == seen["mixing"].count()


def test_registered_names(llm):
    names = queries.registered()
    assert [n.split("_")[0] for n in names] == [f"op{i}" for i in range(1, 14)] + ["pipeline"]
    assert set(queries.statements()) <= set(names) and corpus_pipeline.ORACLE_SQL is None


def test_texts_that_no_pair_needs_are_left_out_before_the_join(llm, make, monkeypatch):
    docs = make([(i, f"text number {i}") for i in range(3000)])
    store = scratch(llm)
    texts = store.keep(near_dedup.hashed_texts(docs), "texts")
    named = [7 * i for i in range(200)]
    wanted = texts.where(texts["doc_id"].isin(named)).select("doc_id", "text_hash")
    found = {r.doc_id: r.text for r in
             near_dedup.likely(texts, store.keep(wanted, "wanted"), store).collect()}
    assert set(named) <= set(found) and len(found) < 300
    assert all(text == f"text number {i}" for i, text in found.items())
    # A filter that is too small lets texts through and loses none.
    monkeypatch.setattr(near_dedup, "BITS_PER_KEY", 0)
    many = store.keep(texts.select("doc_id", "text_hash"), "all")
    assert near_dedup.likely(texts, many, store).count() == 3000
    assert near_dedup.likely(texts, store.keep(wanted.limit(0), "none"), store).count() == 0


def test_a_run_leaves_neither_shuffles_nor_what_only_its_steps_need(llm, make, monkeypatch, tmp_path):
    """Disk holds the step at hand: texts, sketches and files of shuffles go with it."""
    monkeypatch.setattr(near_dedup, "scratch", lambda _: Scratch(llm, str(tmp_path / "run")))
    rows = family_rows()
    found = near_dedup.near_duplicates(make(rows), 2, 80)
    left = {path.name.rsplit("-", 1)[0] for path in (tmp_path / "run").iterdir()}
    assert left == {"rows", "ids", "components"}
    expected = brute_components(rows, 2, 80)
    for _ in range(2):  # what is removed with one query is made again for another
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in found.collect()} == expected
    disk = llm.sparkContext._jsc.sc().env().blockManager().diskBlockManager()
    files = lambda: sum("shuffle_" in str(f) for f in disk.getAllFiles().mkString(" ").split())
    before = files()
    assert llm.range(5000).repartition(7).groupBy(F.col("id") % 11).count().count() == 11
    for _ in range(50):
        if files() <= before:
            break
        time.sleep(0.1)
    assert files() <= before


@pytest.mark.parametrize("shift", [0, 58, 62])
def test_upper_halves_of_hashes_never_lower_an_estimate(llm, shift):
    """With many hashes that agree in their upper halves, too."""
    rng = np.random.default_rng(shift)
    rows, pairs = [], []
    for i in range(60):
        base = rng.integers(0, 1 << 63, 90, dtype=np.uint64) >> np.uint64(shift // 2)
        for j in range(2):
            kept = np.unique(np.concatenate([base[:int(rng.integers(20, 90))], rng.integers(
                0, 1 << 63, 6, dtype=np.uint64) >> np.uint64(shift // 2)]))
            rows.append((2 * i + j, len(kept), [int(h) for h in kept[:64].astype(np.int64)]))
        pairs.append((2 * i, 2 * i + 1))
    classes = llm.createDataFrame(rows, "id long, size long, sketch array<long>")
    found = near_dedup.promising(llm.createDataFrame(pairs, "x long, y long"), classes, 80, 64)
    full = {x for x, y in pairs if near_dedup.may_reach(
        np.array(rows[x][2]), np.array(rows[y][2]), rows[x][1], rows[y][1], 80, 64)}
    assert full and full <= {r.x for r in found.collect()}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("shiftright") == 2


def test_texts_of_pairs_are_shuffled_once(llm, make, monkeypatch):
    """Both sides of the pairs read one shuffle, which also drops repeated texts."""
    plans, keep = {}, near_dedup.Scratch.keep

    def watched(store, df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return keep(store, df, name)

    monkeypatch.setattr(near_dedup.Scratch, "keep", watched)
    rows = family_rows()
    labels = near_dedup.near_duplicates(make(rows + rows[:30]), 2, 80).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in labels} == brute_components(rows, 2, 80)
    assert len(labels) == len(rows) + 30
    assert not any(name.endswith("_texts") for name in plans)
    sent = [line for line in plans["first_links"].splitlines()
            if "Exchange hashpartitioning(doc_id#" in line and "text_hash#" in line]
    # Not more than one for each side; Spark then reuses the one for the other.
    assert len(sent) == 2
