"""Token counts, token files and packing against the tokenizers library itself."""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from starloom.llm import packing, token_counts, token_files
from starloom.llm.common import BATCH
from starloom.llm.tokens import PartEncoder, tokenizer_path

BYTES, WORDS = "byte_bpe_50k.json", "word_bpe_49k.json"
_KNOWN = {}


def plain(name, text):
    if name not in _KNOWN:
        _KNOWN[name] = Tokenizer.from_file(tokenizer_path(name))
    return _KNOWN[name].encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("name", [BYTES, WORDS])
@settings(max_examples=300, deadline=None)
@given(text=st.text(alphabet="ab \n\t.,'s!É1ß́ \x1c  Σ-<|>", max_size=30))
def test_parts_give_the_ids_of_the_whole_text(name, text):
    if (name, "parts") not in _KNOWN:
        _KNOWN[name, "parts"] = PartEncoder(tokenizer_path(name), held=50)
    encoder = _KNOWN[name, "parts"]
    assert encoder.encode(text) == np.array(plain(name, text), "<u4").tobytes()


SPECIAL = [
    "foo <|endoftext|> bar", "<|endoftext|>", "a<|startoftext|>b c", "a b.<|endoftext|>\n\nc ",
    "<|endoftext|><|startoftext|> x", "<|ENDOFTEXT|> x", "<|endoftext |> a", "É́ <|endoftext|>É́",
]


@pytest.mark.parametrize("name", [BYTES, WORDS])
def test_added_tokens_in_a_text_are_the_librarys(name):
    untouched = Tokenizer.from_file(tokenizer_path(name))
    assert not untouched.encode_special_tokens
    encoder = PartEncoder(tokenizer_path(name))
    for text in SPECIAL + [f"some words {s}, more words" for s in SPECIAL]:
        ids = untouched.encode(text, add_special_tokens=False).ids
        assert encoder.encode(text) == np.array(ids, "<u4").tobytes(), text
    assert {i for t in SPECIAL for i in np.frombuffer(encoder.encode(t), "<u4")} >= {
        t for t in untouched.get_added_tokens_decoder()}


def test_batches_of_long_texts_are_cut_by_their_bytes(llm):
    docs = llm.range(0, 4000, 1, 1).selectExpr("repeat('long text ', 1000) AS text")

    def sizes(batches):
        for batch in batches:
            yield pa.record_batch([pa.array([batch.nbytes])], names=["n"])

    found = [row.n for row in docs.mapInArrow(sizes, "n long").collect()]
    assert sum(found) > 40_000_000 and max(found) < 2 * BATCH


@settings(max_examples=60, deadline=None)
@given(docs=st.lists(st.tuples(st.one_of(st.none(), st.integers(-9, 9)), st.lists(
    st.integers(0, 70_000), max_size=12)), max_size=6))
def test_segments_round_trip(docs):
    ids = np.array([i for _, d in docs for i in d], "<u4")
    table = token_files.rank_table(Counter(ids.tolist()))
    ranks = token_files.ranks_by_id(table)[ids] if len(ids) else ids
    blob = token_files.write_segment([d for d, _ in docs], [len(x) for _, x in docs], ranks)
    doc_ids, lengths, back = token_files.read_segment(blob)
    assert doc_ids == [d for d, _ in docs] and list(lengths) == [len(x) for _, x in docs]
    assert (table[back] == ids).all()


def test_many_ranks_need_more_bytes():
    ranks = np.arange(70_000, dtype="<u4").repeat(2)
    blob = token_files.write_segment([1], [len(ranks)], ranks)
    assert (token_files.read_segment(blob)[2] == ranks).all()


def expected_files(rows, end=0):
    out, start = [], 0
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = plain(BYTES, text) + [end]
        out.append((doc, start, len(ids), crc(ids)))
        start += len(ids)
    return out


def files(llm, docs, tmp_path, **options):
    path = str(tmp_path / "files")
    token_files.write_files(docs, tokenizer_path(BYTES), 0, path, **options)
    return token_files.read_files(llm, path, token_files.checksum, "ids_crc32 long")


def test_token_files(llm, make, odd, sample, tmp_path):
    rows = odd + [(100 + d, t) for d, t in zip(sample.doc_id, sample.text)]
    found = files(llm, make(rows, ["start", "partition", "payload"]), tmp_path, segment_ids=3000)
    assert sorted(map(tuple, found.collect()), key=lambda r: r[1]) == expected_files(rows)
    counts = Counter(i for _, t in rows for i in plain(BYTES, t) + [0])
    ranks = llm.read.parquet(str(tmp_path / "files" / "ranks")).orderBy("rank").collect()
    assert [r["id"] for r in ranks] == sorted(counts, key=lambda i: (-counts[i], i))


def test_token_files_order_texts_of_one_doc_id_alike(llm, make, tmp_path):
    rows = [(7, f"text number {i}") for i in range(40)] + [(None, f"none {i}") for i in range(40)]
    rows += [(7, "twice")] * 2 + [(3, "before")]
    found = [sorted(map(tuple, files(llm, make(some).repartition(n), tmp_path / str(n),
                                     segment_ids=20).collect()), key=lambda r: r[1])
             for n, some in ((2, rows), (5, rows[::-1]))]
    assert found[0] == found[1] and len(found[0]) == 83
    assert [r[0] for r in found[0]] == [None] * 40 + [3] + [7] * 42


def test_token_files_of_nothing(llm, make, tmp_path):
    assert files(llm, make([]), tmp_path).count() == 0


def test_token_counts(make, odd, sample):
    rows = odd + [(100 + d, t) for d, t in zip(sample.doc_id, sample.text)]
    lengths = [len(plain(BYTES, t)) + 1 for _, t in rows]
    found = token_counts.encoded_lengths(make(rows, ["n_tokens"]), tokenizer_path(BYTES))
    counts = token_counts.histogram(found)
    sums = token_counts.with_suffix_sums(counts).collect()
    assert {r.n_tokens: r.n_docs for r in sums} == Counter(lengths)
    for r in sums:
        longer = [n for n in lengths if n >= r.n_tokens]
        assert (r.docs_at_least, r.tokens_at_least) == (len(longer), sum(longer))
        assert r.truncated_tokens == sum(min(n, r.n_tokens) for n in lengths)
        assert r.share_at_most == pytest.approx(
            sum(n <= r.n_tokens for n in lengths) / len(lengths))
    limits = token_counts.at_limits(token_counts.with_suffix_sums(counts), [1, 100, 10 ** 6])
    for r in limits.collect():
        assert r.truncated_tokens == sum(min(n, r.limit) for n in lengths)
        assert r.docs_longer == sum(n > r.limit for n in lengths)
    median = token_counts.quantile(token_counts.with_suffix_sums(counts), 0.5).first()[0]
    assert median == sorted(lengths)[(len(lengths) - 1) // 2]


def test_token_counts_of_nothing(make):
    found = token_counts.encoded_lengths(make([]), tokenizer_path(BYTES))
    assert token_counts.with_suffix_sums(token_counts.histogram(found)).count() == 0


def check_packing(found, rows, capacity):
    expected = Counter()
    for doc, text in rows:
        ids = plain(WORDS, text) + [1]
        for at in range(0, len(ids), capacity):
            part = ids[at:at + capacity]
            expected[doc, at // capacity, at, len(part), crc(part)] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == expected
    filled = {}
    for r in sorted(found, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == filled.get(r.sequence_id, 0)
        filled[r.sequence_id] = r.offset + r.length
    assert max(filled.values()) <= capacity
    return len(filled), sum(filled.values())


def test_packing(make, odd, sample):
    rows = odd + [(100 + d, t) for d, t in zip(sample.doc_id, sample.text)]
    docs = make(rows, ["length", "offset", "number"])
    found = packing.pack(docs, tokenizer_path(WORDS), 1, 512).collect()
    n, tokens = check_packing(found, rows, 512)
    assert n <= 1.01 * -(-tokens // 512) + 1


def test_packing_of_nothing(make):
    assert packing.pack(make([]), tokenizer_path(WORDS)).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_plans_place_every_piece_once(seed):
    rng = np.random.default_rng(seed)
    lengths = np.clip(np.exp(rng.normal(6, 1.2, 20_000)).astype(int) + 1, 1, 4096)
    plan = packing.best_plan({int(k): int(v) for k, v in Counter(lengths.tolist()).items()}, 4096)
    length, first, n, sequence, offset = plan.arrays()
    placed = Counter()
    ends = {}
    for row in zip(length, first, n, sequence, offset):
        placed[row[0]] += row[2]
        for s in range(row[3], row[3] + row[2]):
            ends.setdefault(s, []).append((row[4], row[0]))
    assert placed == Counter(lengths.tolist())
    for parts in ends.values():
        parts.sort()
        assert [p[0] for p in parts] == list(np.cumsum([0] + [p[1] for p in parts])[:-1])
        assert sum(p[1] for p in parts) <= 4096
    assert len(ends) <= 1.002 * -(-lengths.sum() // 4096) + 1


def test_nnls_finds_a_known_solution():
    a = np.array([[1.0, 0, 2, 0], [0, 1, 0, 3], [1, 1, 0, 0]])
    x = np.array([3.0, 0, 1, 2])
    found = packing.nnls(a, a @ x)
    assert (found >= 0).all() and np.allclose(a @ found, a @ x, atol=1e-6)
