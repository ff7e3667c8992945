from __future__ import annotations

import pytest

from starloom.llm.common import ready

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def llm(spark):
    return ready(spark)


@pytest.fixture(scope="session")
def make(llm):
    """Documents from (doc_id, text) or (doc_id, text, lang, source) tuples."""

    def build(rows, extra=()):
        full = [(*r, *([None] * (4 - len(r))), len(r[1]) if r[1] is not None else None)
                for r in rows]
        frame = llm.createDataFrame(full, SCHEMA)
        for name in extra:
            frame = frame.selectExpr("*", f"'x' AS {name}")
        return frame

    return build


#: Nulls, empty and blank texts, ties, repeats, a very long text and odd characters.
ODD = [
    (1, "the cat sat on the mat\nand looked at the dog\nwhich slept"), (2, None), (3, ""),
    (4, " \t\n "), (5, "word"), (6, "the cat sat on the mat\nand looked at the dog\nwhich slept"),
    (6, "the cat sat on the mat\nand looked at the dog\nwhich slept"), (None, "no id at all"),
    (8, "É́ ñandú, ça va. \x1c x"), (9, "a  b \n\n c "), (10, "end\n"),
    (11, " ".join(f"w{i % 997}" for i in range(60_000))),
]


@pytest.fixture(scope="session")
def odd():
    return ODD


@pytest.fixture(scope="session")
def sample(llm, tables):
    """Whole small documents table as pandas, by doc_id."""
    return llm.read.parquet(f"{tables}/documents.parquet").toPandas().sort_values("doc_id")
