"""Line dedup over overlapping windows of three consecutive lines.

Lines are cut at line feeds and compared as they are. Every three consecutive lines form
a window; a text of one or two lines is one window. A window that occurs more than once anywhere
stays where it occurs first (smallest doc_id, then position). All its other occurrences are
marked, marked windows that overlap or touch merge into runs, and the lines of the runs go.
Windows of blank lines only do not count.

Windows are compared by two independent 64-bit hashes. A frequent window is reduced to its first
place before anything is shuffled, and the join which marks the others can be split.

A null text stays null, an empty one empty. Rows that repeat a doc_id with another text are
documents of their own, in the order of a hash of the text; rows that repeat both are copies of
one document and are cleaned alike. Rows without a doc_id stay as they are. Other columns are
kept, whatever their names. An empty table gives no rows. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import scratch

WINDOW = 3


def _lines(text):
    return F.split(text, "\n", -1)


def _text_key(text) -> Column:
    """31 bits that tell the texts of one doc_id apart."""
    return F.xxhash64(F.lit("text"), text).bitwiseAND(F.lit((1 << 31) - 1))


def line_windows(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, text_key, first line, two hashes) of every window of every text."""
    hashed = F.transform(_lines(F.col("text")), lambda line: F.struct(
        F.xxhash64(line).alias("a"), F.xxhash64(F.lit("second"), line).alias("b"),
        (F.length(F.trim(line)) > 0).alias("filled")))
    lines = docs.where("doc_id IS NOT NULL AND text IS NOT NULL").select(
        F.col("doc_id").cast("long").alias("doc_id"), _text_key(F.col("text")).alias("text_key"),
        hashed.alias("_lines"))

    def joined(i):
        parts = [F.get("_lines", i + j) for j in range(window)]
        filled = F.lit(False)
        for part in parts:
            filled = filled | F.coalesce(part["filled"], F.lit(False))
        # A line that a short text lacks is null, which leaves the hash as it was.
        return F.struct(i.cast("int").alias("line"),
                        F.xxhash64(*[p["a"] for p in parts]).alias("a"),
                        F.xxhash64(*[p["b"] for p in parts]).alias("b"), filled.alias("filled"))

    starts = F.sequence(F.lit(0), F.greatest(F.size("_lines") - window, F.lit(0)))
    return (
        lines.select("doc_id", "text_key", F.explode(F.transform(starts, joined)).alias("_w"))
        .where("_w.filled").select("doc_id", "text_key", "_w.line", "_w.a", "_w.b")
    )


def removed_lines(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, text_key, marked): the first lines of the windows to remove, for documents with
    any."""
    store = scratch(docs.sparkSession)
    # Document, text and line as one number: it can be reduced in place by a hash aggregate.
    within = F.shiftleft("text_key", 31) + F.col("line")
    place = F.col("doc_id").cast("decimal(19,0)") * F.lit(1 << 62).cast("decimal(19,0)") + (
        within.cast("decimal(19,0)"))
    windows = store.keep(line_windows(docs, window), "line_windows").withColumn(
        "_place", place.cast("decimal(38,0)"))
    first = windows.groupBy("a", "b").agg(
        F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_n")
    ).where("_n > 1").drop("_n")
    later = windows.join(first, ["a", "b"]).where(F.col("_place") > F.col("_first"))
    return later.groupBy("doc_id", "text_key").agg(F.collect_set("line").alias("marked"))


def dedup_lines(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """All rows of ``docs`` with their text cleaned, as the struct ``row`` of the input row
    and the columns doc_id, text, n_lines and n_removed."""
    removed = removed_lines(docs, window).withColumnsRenamed(
        {"doc_id": "_doc", "text_key": "_text"})
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"),
                       F.col("doc_id").cast("long").alias("_id"),
                       _text_key(docs["text"]).alias("_key"))
    rows = rows.join(removed, (F.col("_id") == F.col("_doc")) & (F.col("_key") == F.col("_text")),
                     "left")
    lines = _lines(F.col("row.text"))
    numbers = F.sequence(F.lit(0), F.size(lines) - 1)
    covered = F.flatten(F.transform("marked", lambda i: F.sequence(i, i + (window - 1))))
    kept = F.array_except(numbers, covered)
    # The lines are named once, inside a one-element array, and not cut again for each.
    cleaned = F.transform(F.array(lines), lambda cut: F.array_join(
        F.transform(kept, lambda i: F.get(cut, i)), "\n"))[0]
    hit = F.col("marked").isNotNull() & F.col("row.text").isNotNull()
    n_lines = F.when(F.col("row.text").isNotNull(), F.size(lines)).otherwise(0)
    return rows.select(
        "row", F.col("row.doc_id").alias("doc_id"),
        F.when(hit, cleaned).otherwise(F.col("row.text")).alias("text"),
        n_lines.cast("long").alias("n_lines"),
        F.when(hit, F.size(numbers) - F.size(kept)).otherwise(0).cast("long").alias("n_removed"),
    )


def cleaned_documents(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` in their own columns, with cleaned text and its n_chars."""
    cleaned = dedup_lines(docs, window)
    out = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        out["n_chars"] = F.when(F.col("n_removed") > 0, F.length("text")).otherwise(
            F.col("row.n_chars")).cast(docs.schema["n_chars"].dataType)
    return cleaned.select(*[out.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])
