"""Fingerprints, line dedup, mixing, quality and language."""

from __future__ import annotations

import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from starloom.llm import fingerprints, language, line_dedup, mixing, quality, queries


def test_fingerprints_and_next_documents(make, odd):
    rows = [r for r in odd if r[0] is not None]
    found = fingerprints.with_next(make(rows, ["sketch", "next_text"])).collect()
    ordered = sorted(((d, t or "") for d, t in rows), key=lambda r: (r[0], r[1]))
    follows = Counter((ordered[i][0], ordered[i][1], ordered[(i + 1) % len(ordered)][1])
                      for i in range(len(ordered)))
    assert Counter((r.doc_id, r.text, r.next_text) for r in found) == follows
    by_text = {}
    for r in found:
        assert by_text.setdefault(r.text, r.sketch) == r.sketch
        assert bool(r.sketch) == bool(r.text.split())
    assert {tuple(r.next_sketch) for r in found if r.next_text == ""} <= {()}


def test_next_documents_over_many_buckets(make):
    ids = [*range(0, 300, 7), 10 ** 12, -5]
    found = fingerprints.with_next(make([(i, f"text {i}") for i in ids])).collect()
    ordered = sorted(ids)
    assert {r.doc_id: r.next_text for r in found} == {
        d: f"text {ordered[(i + 1) % len(ordered)]}" for i, d in enumerate(ordered)}


def test_one_document_follows_itself(make):
    assert fingerprints.with_next(make([(None, "a b")])).first().next_text == "a b"
    assert fingerprints.with_next(make([])).count() == 0


def test_likeness_follows_the_shared_shingles(make):
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in rng.integers(0, 9000, 6000)]
    texts = [" ".join(words[:4000]), " ".join(words[1000:5000]), " ".join(words[:400])]
    a, b, c = [r.sketch for r in fingerprints.fingerprints(
        make(list(enumerate(texts)))).orderBy("doc_id").collect()]
    frame = make([(1, "x")]).select(*[
        F.array(*map(F.lit, x)).alias(n) for n, x in (("a", a), ("b", b), ("c", c))])
    near, inside = frame.select(fingerprints.likeness(F.col("a"), F.col("b")),
                                fingerprints.containment(F.col("c"), F.col("a"))).first()
    assert near == pytest.approx(3000 / 5000, abs=0.08) and inside == 1.0


def duck(rows):
    import pandas as pd

    connection = duckdb.connect()
    frame = pd.DataFrame(rows, columns=["doc_id", "text", "source"])
    connection.register("frame", frame)
    connection.execute("create table documents as select cast(doc_id as bigint) doc_id, "
                       "cast(text as varchar) as text, cast(source as varchar) as source from frame")
    return connection


def test_line_dedup_matches_sql(llm, make, tables):
    passage = "one\ntwo two\nthree\nfour"
    rows = [(1, f"a\n{passage}\nb"), (2, f"{passage}\nc"), (3, "x\nx\nx\nx\nx\nx"), (4, None),
            (5, ""), (6, "short"), (7, "short"), (8, "two\nlines"), (9, "two\nlines"),
            (10, f"c\nd\n{passage}"), (11, "\n\n\n"), (12, "\n\n\n"), (13, "one\ntwo two\nother"),
            *((100 + r.doc_id, r.text) for r in
              llm.read.parquet(f"{tables}/documents.parquet").collect())]
    found = line_dedup.dedup_lines(make(rows, ["row", "marked", "line"])).drop("row").collect()
    sql = duck([(d, t, None) for d, t in rows]).execute(
        f"select doc_id, text, n_lines, n_removed from ({queries.statements()['op6_line_dedup']})"
    ).fetchall()
    assert sorted(map(tuple, found), key=lambda r: r[0]) == sorted(sql, key=lambda r: r[0])
    by_id = {r.doc_id: r.text for r in found}
    assert by_id[1] == f"a\n{passage}\nb" and by_id[2] == "c" and by_id[10] == "c\nd"
    assert by_id[3] == "x" and by_id[7] == "" and by_id[9] == "" and by_id[13].endswith("other")


def test_line_dedup_keeps_rows_without_id_and_columns(make, odd):
    docs = make(odd, ["a", "b", "_id"])
    found = line_dedup.cleaned_documents(docs)
    assert found.columns == docs.columns and found.count() == len(odd)
    assert found.where("doc_id IS NULL").first().text == "no id at all"
    assert line_dedup.cleaned_documents(make([])).count() == 0


def test_lines_of_texts_that_share_a_doc_id(make):
    """Texts are told apart by more than the doc_id: no line goes that occurs once."""
    lines = lambda t: t.replace(" ", "\n")
    rows = [(1, lines("a b c")), (5, lines("a b c d")), (5, lines("u1 u2 u3 u4")),
            (7, lines("q r s")), (7, lines("q r s"))]
    found = line_dedup.cleaned_documents(make(rows, ["text_key"])).collect()
    assert sorted((r.doc_id, r.text) for r in found) == [
        (1, lines("a b c")), (5, "d"), (5, lines("u1 u2 u3 u4")), (7, lines("q r s")),
        (7, lines("q r s"))]


def mixed_rows(sample):
    return [(r.doc_id, r.text, r.source) for r in sample.itertuples()] + [
        (5000, None, "src1"), (5001, "", None), (5002, "a b c", None), (5003, "a b", "zero")]


def test_mixing_matches_sql_and_targets(make, sample):
    rows = mixed_rows(sample)
    found = mixing.mixture(make([(d, t, None, s) for d, t, s in rows], ["size", "taken", "_key"])
                           ).select("doc_id", "size", "source_size", "target", "taken").collect()
    sql = duck(rows).execute("select doc_id, size, source_size, target, taken from "
                             f"({queries.statements()['op9_mixing']})").fetchall()
    key = lambda r: r[0]
    assert sorted(map(tuple, found), key=key) == sorted(sql, key=key)
    source = dict((d, s) for d, _, s in rows)
    taken, target = Counter(), {}
    for r in found:
        taken[source[r.doc_id]] += r.taken
        target[source[r.doc_id]] = r.target
        assert r.taken <= 2 * r.size and r.target <= 2 * r.source_size + 1e-6
    # Documents are taken whole, so a source misses its target by half of one at most.
    most = Counter()
    for r in found:
        most[source[r.doc_id]] = max(most[source[r.doc_id]], r.size)
        assert r.taken % max(r.size, 1) == 0
    assert all(abs(taken[s] - t) <= most[s] / 2 + 0.5 for s, t in target.items())
    assert sum(target.values()) == pytest.approx(1.5 * sum(r.size for r in found))


def water_fill(sizes, weights, budget, most):
    """Targets the slow way: share, clamp, share the excess again."""
    clamped = set()
    while True:
        rest = budget - sum(most * sizes[i] for i in clamped)
        total = sum(w for i, w in enumerate(weights) if i not in clamped)
        target = [most * s if i in clamped else rest * weights[i] / total
                  for i, s in enumerate(sizes)]
        new = {i for i, s in enumerate(sizes) if i not in clamped and target[i] > most * s}
        if not new:
            return target
        clamped |= new


@pytest.mark.parametrize("sizes", [[10, 1000, 300], [5, 5, 5, 5], [1, 90, 3, 70, 0, 9, 1000]])
def test_water_filling(llm, sizes):
    frame = llm.createDataFrame([(f"s{i}", s) for i, s in enumerate(sizes)],
                                "source string, source_size long")
    found = mixing.source_targets(frame, (5, 2, 1), 1.5, 2.0).orderBy("source").collect()
    weights = [(5, 2, 1)[i % 3] for i in range(len(sizes))]
    expected = water_fill(sizes, weights, 1.5 * sum(sizes), 2.0)
    assert [r.target for r in found] == pytest.approx(expected)


def test_mixed_documents_have_the_words_taken(make, odd):
    rows = [(d, t, "en", f"s{i % 2}") for i, (d, t) in enumerate(odd) if d != 11]
    docs = make(rows, ["row", "_copy"])
    words = lambda t: len((t or "").encode().split())
    mix = mixing.mixed_documents(docs).collect()
    taken = mixing.mixture(docs).agg(F.sum("taken")).first()[0]
    assert sum(words(r.text) for r in mix) == taken and mix[0].asDict().keys() == set(docs.columns)
    assert all(words(r.text) for r in mix)
    assert mixing.mixed_documents(make([])).count() == 0 and mixing.mixture(make([])).count() == 0


def test_pipeline_mix_takes_documents_whole(llm, make, sample):
    rows = [(r.doc_id, r.text, None, r.source) for r in sample.itertuples()]
    rows.append((5000, " ".join(f"w{i}" for i in range(20_000)), None, "long"))
    docs = make(rows)
    mix = corpus_pipeline.mix_sources(llm, docs, "").collect()
    texts = {d: t for d, t, _, _ in rows}
    assert all(r.text == texts[r.doc_id] and r.n_chars == len(r.text) for r in mix)
    assert max(Counter(r.doc_id for r in mix).values()) <= 2
    size = {d: len((t or "").encode().split()) for d, t in texts.items()}
    got, target, most = Counter(), {}, Counter()
    for r in mix:
        got[r.source] += size[r.doc_id]
    for r in mixing.mixture(docs).collect():
        target[r.source] = r.target
        most[r.source] = max(most[r.source], r.size)
    assert all(abs(got[s] - t) <= most[s] / 2 + 0.5 for s, t in target.items())


def test_documents_stay_below_the_cap(make):
    rows = [(i, "a b c d", None, "small") for i in range(3)] + [(9, "a " * 90, None, "large")]
    options = {"weights": (1, 9), "max_epochs": 1.5}
    for r in mixing.mixture(make(rows), **options).groupBy("source", "source_size").agg(
            F.sum("taken").alias("taken")).collect():
        assert r.taken <= 1.5 * r.source_size


def fold(doc, parts):
    return zlib.crc32(str(doc).encode()) % parts


def test_quality_on_held_out_documents(llm):
    folder = "/root/testdata/sf0.01"
    found = queries.op5_quality(llm, folder).toPandas().merge(
        llm.read.parquet(f"{folder}/labels.parquet").toPandas(), on="doc_id")
    held = found[found.held_out]
    assert (found.held_out == found.doc_id.map(lambda d: fold(d, 5) == 0)).all()
    good, bad = held[held.quality == 1], held[held.quality == 0]
    assert (good.score.values[:, None] > bad.score.values[None, :]).mean() > 0.95
    assert good.predicted.mean() > 0.97 and bad.predicted.mean() < 0.5


def test_quality_of_odd_documents(llm, make, odd):
    docs = make(odd, ["score", "statistics"])
    none = llm.createDataFrame([(1, None), (None, 1), (999, 1)], "doc_id long, quality int")
    assert {r.score for r in quality.scores(docs, quality.fit(docs, none)).collect()} == {0.5}
    labels = llm.createDataFrame([(d, d % 2) for d, _ in odd if d] * 2, "doc_id long, quality int")
    trees = quality.fit(docs, labels)
    scores = quality.scores(docs, trees)
    assert scores.count() == len(odd) and scores.where("score < 0 OR score > 1").count() == 0
    assert quality.accepted(docs, trees, 0.0).columns == docs.columns
    assert quality.accepted(docs, trees, 0.0).count() == len(odd)
    assert quality.accepted(make([]), trees).count() == 0


def test_flat_trees_follow_their_splits():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(500, 3))
    y = ((x[:, 0] > 0.2) & (x[:, 2] < 0.5)).astype(float)
    trees = quality.grow(x, y, rounds=20, depth=3)
    for row, score in zip(x[:50], trees.score(x)[:50]):
        raw = trees.start
        for t in range(len(trees.feature)):
            node = 0
            for _ in range(trees.depth):
                node = 2 * node + 1 + int(row[trees.feature[t, node]] > trees.threshold[t, node])
            raw += trees.value[t, node - (2 ** trees.depth - 1)]
        assert score == pytest.approx(1 / (1 + np.exp(-raw)))
    assert ((trees.score(x) > 0.5) == (y > 0.5)).mean() > 0.97


def test_language_on_held_out_documents(llm):
    folder = "/root/testdata/sf0.01"
    found = queries.op8_language(llm, folder).toPandas().merge(
        llm.read.parquet(f"{folder}/documents.parquet").toPandas()[["doc_id", "lang"]])
    assert (found.held_out == found.doc_id.map(lambda d: fold(d, 4) == 2)).all()
    held = found[found.held_out & found.lang.notna()]
    assert (held.lang == held.lang_pred).mean() > 0.97


def test_language_of_odd_documents(make, odd):
    docs = make([(d, t, "en", "s") for d, t in odd], ["gram", "rate"])
    found = language.predict(docs, language.fit(docs)).collect()
    assert len(found) == len(odd)
    for (_, text), r in zip(odd, found):
        has = any(c.isalpha() for c in text or "")
        assert r.lang_pred == ("en" if has else "und") and 0 <= r.score <= 1
    assert language.predict(make([]), language.fit(make([]))).count() == 0
    assert {r.lang_pred for r in language.predict(docs, language.fit(make([]))).collect()} == {
        "und"}


def test_filters_answer_for_more_than_64_languages():
    rng = np.random.default_rng(1)
    grams = {f"l{i:02}": rng.integers(0, 2 ** 63, 200).astype(np.uint64) for i in range(70)}
    learnt = language.build(grams, "l00")
    for i, name in enumerate(sorted(grams)):
        assert learnt.shares(grams[name]).argmax() == i
