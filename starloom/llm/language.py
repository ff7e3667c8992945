"""Language identification with language-bitmask n-gram filters.

One Bloom filter of positions holds a bitmask per position, a bit for each language. The masks
at an n-gram's positions, and-ed, give all languages that have it. Set bits are counted per
language over a text's n-grams, the hits that the fill of a language's slice makes by chance are
taken off, and the largest share decides.

An n-gram belongs to a language if it is frequent there: its rate is at least ``SHARE`` of its
largest rate in any language. Rates come from a sample of about ``SAMPLE`` documents a language,
those with a small hash of their id; languages are counted over all documents.

N-grams are of three and four characters; all that is not a letter counts as one blank, and
letters are in lower case. Text that is null or has no letter is ``und`` with score 0. A text
without any known n-gram gets the language with most documents. Without learnt languages
everything is ``und``. Null ids and repeated rows make no difference; an empty table gives no
rows. Only doc_id, text and, for learning, lang are read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import fold_of, mixed, text_groups

SIZES = (3, 4)
POSITIONS = 1 << 20
HASHES = 3
SAMPLE = 1500
SHARE = 0.34
LEAST = 3
FOLDS, HELD_OUT = 4, 2
UNKNOWN = "und"

_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool))
    return _LETTERS[0]


def characters(text: str) -> np.ndarray:
    """Code points of a text in lower case, runs of anything but letters as one blank, and
    a blank at both ends. Without letters: empty."""
    codes = np.frombuffer((" " + text.lower() + " ").encode("utf-32-le", "replace"), "<u4")
    letter = _letters()[codes]
    if not letter.any():
        return np.zeros(0, np.uint32)
    kept = letter.copy()
    kept[1:] |= letter[:-1]  # the first blank of a run
    kept[0] = True
    return np.where(letter, codes, 32)[kept].astype(np.uint32)


def ngrams(text: str, sizes: tuple[int, ...] = SIZES) -> np.ndarray:
    """64-bit hashes of all n-grams of a text, repeats included."""
    codes = characters(text).astype(np.uint64)
    found = []
    for n in sizes:
        if len(codes) >= n:
            h = np.full(len(codes) - n + 1, n, np.uint64)
            for j in range(n):
                h = h * np.uint64(0x100000001B3) + codes[j:len(codes) - n + 1 + j]
            found.append(mixed(h))
    return np.concatenate(found) if found else np.zeros(0, np.uint64)


@dataclass(frozen=True)
class Filter:
    """``masks``: a row of positions for every 64 languages, a bit for each language."""

    languages: tuple[str, ...]
    masks: np.ndarray
    chance: np.ndarray
    usual: int
    hashes: int = HASHES

    def _words(self, grams: np.ndarray) -> np.ndarray:
        size = np.uint64(self.masks.shape[1])
        first, step = grams & np.uint64(0xFFFFFFFF), (grams >> np.uint64(32)) | np.uint64(1)
        found = self.masks[:, first % size]
        for k in range(1, self.hashes):
            found = found & self.masks[:, (first + np.uint64(k) * step) % size]
        return found

    def shares(self, grams: np.ndarray) -> np.ndarray:
        """Share of the n-grams that each language has, corrected for chance hits."""
        found = self._words(grams)
        hits = np.array([
            np.count_nonzero(found[i // 64] & np.uint64(1 << (i % 64)))
            for i in range(len(self.languages))], float) / max(1, len(grams))
        return np.clip((hits - self.chance) / np.maximum(1 - self.chance, 1e-9), 0, 1)

    def decide(self, text: str | None) -> tuple[str, float]:
        grams = ngrams(text) if text else np.zeros(0, np.uint64)
        if not len(grams):
            has = bool(text) and len(characters(text)) > 0
            return (self.languages[self.usual], 0.0) if has and self.languages else (UNKNOWN, 0.0)
        if not self.languages:
            return UNKNOWN, 0.0
        shares = self.shares(grams)
        best = int(shares.argmax())
        if shares[best] <= 0:
            best = self.usual
        return self.languages[best], float(shares[best])


def build(grams: dict[str, np.ndarray], usual: str | None, positions: int = POSITIONS,
          hashes: int = HASHES) -> Filter:
    """A filter from the n-grams of each language."""
    languages = tuple(sorted(grams))
    masks = np.zeros((-(-len(languages) // 64) or 1, positions), np.uint64)
    for i, language in enumerate(languages):
        g = grams[language]
        first, step = g & np.uint64(0xFFFFFFFF), (g >> np.uint64(32)) | np.uint64(1)
        for k in range(hashes):
            at = ((first + np.uint64(k) * step) % np.uint64(positions)).astype(np.int64)
            masks[i // 64, np.unique(at)] |= np.uint64(1 << (i % 64))
    fill = np.array([np.count_nonzero(masks[i // 64] & np.uint64(1 << (i % 64))) / positions
                     for i in range(len(languages))])
    return Filter(languages, masks, fill ** hashes,
                  languages.index(usual) if usual in languages else 0, hashes)


def fit(docs: DataFrame, sample: int = SAMPLE, share: float = SHARE) -> Filter:
    """Learn from documents with a language, outside the held-out fold."""
    spark = docs.sparkSession
    usable = docs.where("lang IS NOT NULL AND doc_id IS NOT NULL").where(
        fold_of("doc_id", FOLDS) != HELD_OUT).select("doc_id", "text", "lang")
    counts = usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    per_language = {r["lang"]: r["n"] for r in counts.collect()}  # a row per language
    if not per_language:
        return build({}, None)
    # A document is in the sample if its hash lies below its language's share of the range.
    limits = spark.createDataFrame(
        [(lang, -(1 << 63) + min((1 << 64) - 1, (1 << 64) * sample // n))
         for lang, n in per_language.items()], "lang string, _limit long")
    chosen = usable.join(F.broadcast(limits), "lang").where(
        F.xxhash64(F.lit("language"), "doc_id") <= F.col("_limit"))

    def count(batches):
        held: dict[str, list[np.ndarray]] = {}
        size = 0

        def flush():
            for lang, parts in held.items():
                found, n = np.unique(np.concatenate(parts), return_counts=True)
                yield pa.record_batch([
                    pa.array([lang] * len(found)), pa.array(found.view(np.int64)),
                    pa.array(n.astype(np.int64))], names=["lang", "gram", "n"])

        for batch in text_groups(batches):
            for lang, text in zip(batch.column("lang").to_pylist(),
                                  batch.column("text").to_pylist()):
                if text:
                    held.setdefault(lang, []).append(ngrams(text))
                    size += len(held[lang][-1])
            if size > 4_000_000:
                yield from flush()
                held, size = {}, 0
        yield from flush()

    grams = chosen.select("lang", "text").mapInArrow(count, "lang string, gram long, n long")
    grams = grams.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    totals = grams.groupBy("lang").agg(F.sum("n").alias("total"))
    rates = grams.join(F.broadcast(totals), "lang").withColumn("rate", F.col("n") / F.col("total"))
    best = rates.groupBy("gram").agg(F.max("rate").alias("best"))
    # What reaches the driver is bounded by the sampled documents.
    found = rates.where(F.col("n") >= LEAST).join(best, "gram").where(
        F.col("rate") >= share * F.col("best")).select("lang", "gram").toArrow()
    langs, values = found.column("lang").to_numpy(), found.column("gram").to_numpy()
    learnt = {lang: values[langs == lang].view(np.uint64) for lang in per_language}
    usual = max(sorted(per_language), key=per_language.get)
    return build(learnt, usual)


def predict(docs: DataFrame, learnt: Filter) -> DataFrame:
    """(doc_id, lang_pred, score) of every row."""
    model = docs.sparkSession.sparkContext.broadcast(learnt)

    def rows(batches):
        for batch in text_groups(batches):
            found = [model.value.decide(text) for text in batch.column("text").to_pylist()]
            yield pa.record_batch([
                batch.column("doc_id"), pa.array([f[0] for f in found], pa.string()),
                pa.array([f[1] for f in found], pa.float64())],
                names=["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        rows, "doc_id long, lang_pred string, score double")
