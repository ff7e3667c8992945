"""Shared helpers: tables, scratch storage, word rules, checksums."""

from __future__ import annotations

import tempfile
import zipfile
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.session import Scratch, tune

#: What separates words, and what a word is.
SPACES = r"\x20\x09-\x0D"
WORD = rf"[^{SPACES}]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


#: Bytes of an Arrow batch, on its way to a Python worker. Spark counts rows by itself, and 10,000
#: long texts, or pairs of them, are held several times over in each task.
BATCH = 4 << 20
SETTINGS = {"spark.sql.execution.arrow.maxBytesPerBatch": str(BATCH)}

_SHIPPED: set[str] = set()


def ready(spark: SparkSession) -> SparkSession:
    """Runtime settings, and this package on the executors' Python path."""
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        package = Path(__file__).resolve().parents[1]
        archive = Path(tempfile.mkdtemp()) / f"{package.name}.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for file in sorted(package.rglob("*.py")):
                out.write(file, file.relative_to(package.parent))
        context.addPyFile(str(archive))
        _SHIPPED.add(context.applicationId)
    return tune(tune(spark), SETTINGS)


def scratch(spark: SparkSession) -> Scratch:
    """A fresh folder below the one all executors share."""
    return Scratch(tune(spark))


def fold_of(column: str, parts: int) -> Column:
    """Fold of an integer id: crc32 of its decimal text modulo ``parts``."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % parts


def text_groups(batches, column: str = "text", limit: int = 1 << 18):
    """Slices of Arrow record batches that hold about ``limit`` bytes of text each, at
    least one row, so that what is made of a slice stays small however long texts are."""
    for batch in batches:
        sizes = pc.binary_length(batch.column(column)).to_pylist()
        start = held = 0
        for i, size in enumerate(sizes):
            if held and held + (size or 0) > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size or 1
        if start < len(sizes):
            yield batch.slice(start)


def crc(data: bytes) -> int:
    return zlib.crc32(data)


def mixed(h: np.ndarray) -> np.ndarray:
    """64-bit numbers with their bits well mixed (an invertible function)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))
