"""Registered queries of the operators, over the whole given tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm import (
    fingerprints,
    language,
    line_dedup,
    mixing,
    near_dedup,
    neighbours,
    packing,
    periodic_runs,
    quality,
    ranked_search,
    token_counts,
    token_files,
    vector_packing,
)
from starloom.llm.common import fold_of, ready, scratch, table
from starloom.llm.tokens import tokenizer_path

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function):
    _QUERIES[function.__name__] = lambda spark, folder: function(ready(spark), folder)
    return function


@query
def op1_packing(spark, folder):
    return packing.pack(table(spark, folder, "documents"),
                        tokenizer_path("word_bpe_49k.json"), end_id=1, capacity=4096)


@query
def op2_fingerprints(spark, folder):
    rows = fingerprints.with_next(table(spark, folder, "documents"))
    n, half = F.length("text"), F.floor(F.length("text") / 2).cast("int")
    rows = rows.withColumns({"n_chars": n.cast("long"), "_half": half})
    edited = F.concat(F.substring("text", F.lit(1), F.col("n_chars").cast("int") - F.col("_half")),
                      F.substring("next_text", F.lit(1), F.col("_half")))
    rows = rows.withColumn("_edited", edited).withColumn(
        "_edited_sketch", fingerprints.sketch(F.col("_edited")))
    return rows.select(
        "doc_id", "n_chars", F.sha2(F.col("_edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprints.as_text(F.col("sketch")).alias("fingerprint"),
        fingerprints.as_text(F.col("_edited_sketch")).alias("edited_fingerprint"),
        fingerprints.likeness(F.col("sketch"), F.col("_edited_sketch")).alias("near_edited"),
        fingerprints.likeness(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
        fingerprints.containment(F.col("sketch"), F.col("_edited_sketch")).alias("in_edited"),
        fingerprints.containment(F.col("sketch"), F.col("next_sketch")).alias("in_next"),
    )


@query
def op3_token_counts(spark, folder):
    lengths = token_counts.encoded_lengths(
        table(spark, folder, "documents"), tokenizer_path("byte_bpe_50k.json"))
    counts = scratch(spark).keep(token_counts.histogram(lengths), "length_histogram")
    return token_counts.with_suffix_sums(counts)


@query
def op4_token_files(spark, folder):
    path = scratch(spark).path("token_files")
    token_files.write_files(table(spark, folder, "documents"),
                            tokenizer_path("byte_bpe_50k.json"), 0, path)
    return token_files.read_files(spark, path, token_files.checksum, "ids_crc32 long")


@query
def op5_quality(spark, folder):
    docs = table(spark, folder, "documents")
    trees = quality.fit(docs, table(spark, folder, "labels"))
    return quality.scores(docs, trees).select(
        "doc_id", (fold_of("doc_id", quality.FOLDS) == quality.HELD_OUT).alias("held_out"),
        "score", (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))


@query
def op6_line_dedup(spark, folder):
    return line_dedup.dedup_lines(table(spark, folder, "documents")).drop("row")


@query
def op7_neighbours(spark, folder):
    return neighbours.nearest(table(spark, folder, "embeddings"),
                              F.col("vec_id") % 50 == 0, k=5)


@query
def op8_language(spark, folder):
    docs = table(spark, folder, "documents")
    found = language.predict(docs, language.fit(docs))
    return found.select(
        "doc_id", (fold_of("doc_id", language.FOLDS) == language.HELD_OUT).alias("held_out"),
        "lang_pred", "score")


@query
def op9_mixing(spark, folder):
    return mixing.mixture(table(spark, folder, "documents"), weights=(5, 2, 1), budget=1.5,
                          max_epochs=2.0).select(
        "doc_id", "size", "source_size", "target", "taken")


@query
def op10_near_dedup(spark, folder):
    return near_dedup.near_duplicates(table(spark, folder, "documents"), words=2, percent=80)


@query
def op11_periodic_runs(spark, folder):
    docs = table(spark, folder, "documents").select(
        "doc_id", periodic_runs.edited_text().alias("text"))
    found = periodic_runs.periodic_runs(docs)
    # Runs come by start and period, so the first of equal exponents stays.
    none = F.lit(None).cast("struct<start: bigint, length: bigint, period: bigint>")
    top = F.aggregate("runs", none, lambda best, run: F.when(
        best.isNull() | (run["length"] * best["period"] > best["length"] * run["period"]),
        run).otherwise(best))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(
        F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")

    def sha256(column):
        return F.sha2(column.cast("binary"), 256)

    return found.withColumn("_top", top).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "_top.start", "_top.length",
        "_top.period",
        F.expr("1000 * _top.length div _top.period").alias("exponent_milli"),
        sha256(lines).alias("runs_sha256"), sha256(F.col("collapsed")).alias("collapsed_sha256"))


@query
def op12_vector_packing(spark, folder):
    found = vector_packing.pack(table(spark, folder, "documents"),
                                tokenizer_path("byte_bpe_50k.json"), end_id=1, capacity=2048)
    return found.select(
        "doc_id", "start", F.expr("octet_length(ids) div 4").alias("length"),
        F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "loss_tokens")


@query
def op13_ranked_search(spark, folder):
    return ranked_search.search(table(spark, folder, "documents"),
                                table(spark, folder, "benchmark"), k=10)


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {**_QUERIES, "pipeline": pipeline}


_OP6 = r"""
WITH lines AS (
    SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line,
           generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos,
           len(string_split(text, chr(10))) AS n
    FROM documents WHERE text IS NOT NULL
), windows AS (
    SELECT doc_id, pos, n, row(line, l2, l3) AS w,
           trim(line) <> '' OR coalesce(trim(l2), '') <> '' OR coalesce(trim(l3), '') <> '' AS filled
    FROM (SELECT *, lead(line) OVER p AS l2, lead(line, 2) OVER p AS l3
          FROM lines WINDOW p AS (PARTITION BY doc_id ORDER BY pos))
    WHERE pos <= greatest(n - 3, 0)
), later AS (
    SELECT doc_id, pos FROM (
        SELECT doc_id, pos, row_number() OVER (PARTITION BY w ORDER BY doc_id, pos) AS k
        FROM windows WHERE filled)
    WHERE k > 1
), covered AS (
    SELECT DISTINCT doc_id, pos + i AS pos FROM later, (SELECT unnest([0, 1, 2]) AS i)
), kept AS (
    SELECT l.doc_id, count(*) FILTER (c.pos IS NOT NULL) AS n_removed,
           coalesce(string_agg(line, chr(10) ORDER BY l.pos) FILTER (c.pos IS NULL), '') AS text
    FROM lines l LEFT JOIN covered c ON c.doc_id = l.doc_id AND c.pos = l.pos
    GROUP BY l.doc_id
)
SELECT d.doc_id, k.text, coalesce(len(string_split(d.text, chr(10))), 0) AS n_lines,
       coalesce(k.n_removed, 0) AS n_removed
FROM documents d LEFT JOIN kept k ON k.doc_id = d.doc_id
"""

_OP9 = r"""
WITH sized AS (
    SELECT doc_id, source, md5(concat('mix-1:', CAST(doc_id AS VARCHAR), ':',
                                      md5(coalesce(text, '')))) AS draw,
           coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size
    FROM documents
), sources AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source
), numbered AS (
    SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS turn, source_size * 2.0::DOUBLE AS cap,
           (sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE AS budget
    FROM sources
), weighted AS (
    SELECT *, CASE (turn - 1) % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END::DOUBLE AS weight
    FROM numbered
), levels AS (
    SELECT *, (budget - coalesce(sum(cap) OVER (l ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
              / sum(weight) OVER (l ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level,
           row_number() OVER l AS k
    FROM weighted WINDOW l AS (ORDER BY cap / weight, turn)
), final AS (
    SELECT (SELECT level FROM levels WHERE cap > weight * level ORDER BY k LIMIT 1) AS level
), targets AS (
    SELECT source, source_size,
           CASE WHEN final.level IS NULL THEN cap ELSE least(cap, weight * final.level) END AS target
    FROM levels, final
), parts AS (
    SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS times
    FROM targets
), placed AS (
    SELECT s.doc_id, s.size, p.source_size, p.target, p.times,
           CAST(round(p.target) AS BIGINT) - p.times * p.source_size AS rest,
           coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.draw, s.doc_id, s.size
                                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
    FROM sized s JOIN parts p ON s.source IS NOT DISTINCT FROM p.source
)
SELECT doc_id, size, source_size, target,
       CAST(times * size + CASE
           WHEN rest - ahead >= size THEN size
           WHEN 2 * (rest - ahead) >= size
                AND times * source_size + ahead + size <= source_size * 2.0::DOUBLE THEN size
           ELSE 0 END AS BIGINT) AS taken
FROM placed
"""

_OP13 = r"""
WITH found AS (
    SELECT doc_id, unnest(regexp_extract_all(
               translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM documents
), sizes AS (
    SELECT doc_id, count(*) AS n FROM found GROUP BY doc_id
), corpus AS (
    SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM sizes
), postings AS (
    SELECT doc_id, term, count(*) AS tf FROM found GROUP BY doc_id, term
), weights AS (
    SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
    FROM postings, corpus GROUP BY term, docs
), wanted AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all(
               translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark
), scores AS (
    SELECT item_id, doc_id, CAST(sum(
               w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // terms)))
           ) AS BIGINT) AS score
    FROM wanted JOIN postings USING (term) JOIN weights USING (term) JOIN sizes USING (doc_id),
         corpus
    GROUP BY item_id, doc_id
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)
                     AS INTEGER) AS rank, doc_id, score
FROM scores WHERE score > 0
QUALIFY rank <= 10
"""


def statements() -> dict[str, str]:
    """SQL for the operators that SQL can express on whole tables. The others are tested
    against brute force or round trips in tests/llm."""
    return {"op6_line_dedup": _OP6, "op9_mixing": _OP9, "op13_ranked_search": _OP13}
