"""Token ids of whole texts, word by word.

The tokenizers used here never look across certain places in a text, so that a text's ids
are the ids of its parts, one after the other. Parts recur: each distinct one is encoded
once and kept in a table of bounded size. Ids are the library's own for every part.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from starloom.llm.common import text_groups

#: A blank or line end before other white space or the end: the tokenizer may join them.
_LOOSE = re.compile(r"[ \n](?=\s|$)")
_LONGEST_PART = 64
#: Marks the first part of a text among the parts of many; texts that hold it are taken whole.
_FIRST = "\x01"
#: Bytes of text that are cut into parts together.
GROUP = 1 << 20
#: Parts that a worker remembers, and as many older ones: some 100 MB together at most.
HELD = 300_000

_ENCODERS: dict[tuple[str, int], "PartEncoder"] = {}


def byte_table() -> list[str]:
    """Bytes to the letters by which byte-level models write them: printable bytes stand for
    themselves, the others follow from code point 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    other = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(other)) for b in range(256)]


def byte_letters() -> dict[int, str]:
    """Code points below 256 to the letters for their UTF-8."""
    letter = byte_table()
    return {c: "".join(letter[b] for b in chr(c).encode()) for c in range(256)}


class PartEncoder(dict):
    """Encodes texts with a tokenizer file of the ``tokenizers`` library.

    ``keeps_spaces`` tells how the tokenizer treats white space. If it drops it, texts are cut
    at ASCII white space. If a blank belongs to the word behind it, they are cut before each
    blank or line end; a text with one before white space or at its end is taken whole. So is
    a text that holds an added token: the library seeks those before it splits a text.

    Many texts are cut together, in Arrow: each distinct part is looked up once, and the ids are
    laid out in the order of the texts.

    The dictionary maps parts to their ids as little-endian unsigned 32-bit integers and fills
    itself. When it holds ``held`` parts it becomes the old one, from which parts that come
    again move to the next, so at most twice as many are remembered per Python worker, and
    frequent ones always are.

    A part of Latin letters, and points or commas behind them, is what the tokenizer's own
    splitting would hand to its model as one or two pieces, so the model is asked directly.
    """

    def __init__(self, path: str, held: int = HELD):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        # Sought in the text as it is: no added token of the files used is a normalized one.
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.keeps_spaces = bool(self.tokenizer.encode("a b", add_special_tokens=False).ids
                                 != self.tokenizer.encode("a  b", add_special_tokens=False).ids)
        self.ask = self.tokenizer.model.tokenize
        self.letters = byte_letters()
        self.of_bytes = byte_table()
        self.held, self.old, self.fixed = held, {}, {}
        vocabulary = np.arange(self.tokenizer.get_vocab_size(), dtype="<u4")
        self.packed = [x.tobytes() for x in vocabulary]

    def _whole(self, text: str) -> bytes:
        found = self.tokenizer.encode(text, add_special_tokens=False)
        return np.array(found.ids, dtype="<u4").tobytes()

    def _piece(self, piece: str) -> bytes:
        """Ids of what the tokenizer's splitting would hand to its model as one piece."""
        packed = self.packed
        return b"".join([packed[x.id] for x in self.ask(piece)])

    def _word(self, part: bytes) -> str | None:
        """A part of Latin letters only as the model knows it."""
        if part.isalpha():  # ASCII letters only
            return part.decode() if self.keeps_spaces else part.lower().decode()
        word = part.decode()
        if not word.isalpha() or max(word) > "\xff":
            return None
        if not self.keeps_spaces:
            part = word.lower().encode()
        return "".join(map(self.of_bytes.__getitem__, part))

    @staticmethod
    def _ends_in_letter(part: bytes) -> bool:
        if part[-1] < 128:
            return part[-1:].isalpha()
        last = part.decode()[-1]
        return last.isalpha() and last <= "\xff"

    def __missing__(self, part: bytes) -> bytes:
        ids = self.old.get(part)
        if ids is None:
            ids = self._new(part)
        if len(part) <= _LONGEST_PART:
            self[part] = ids
        return ids

    def _new(self, part: bytes) -> bytes:
        if part.isalpha():  # ASCII letters only
            return self._piece(self.letters[32] + part.decode() if self.keeps_spaces
                               else part.lower().decode())
        stem = part.rstrip(b".,")
        tail = part[len(stem):]
        if tail and stem and self._ends_in_letter(stem):
            return self[stem] + self._fixed(tail.decode())
        return self._ids(part)

    def _fixed(self, piece: str) -> bytes:
        """The same as ``_piece`` for the few pieces that come again and again."""
        ids = self.fixed.get(piece)
        if ids is None:
            ids = self._piece(piece)
            if len(piece) <= 2:
                self.fixed[piece] = ids
        return ids

    def _ids(self, part: bytes) -> bytes:
        start, bare = "", part
        if self.keeps_spaces:
            # Parts of a text stand for themselves and a blank in front of them, but for the
            # first one, which has a blank too many, and those behind a line end.
            start = {b" ": "", b"\n": "\n"}.get(part[:1], " ")
            bare = part if start == " " else part[1:]
        word = self._word(bare)
        if word is None:
            return self._whole(start + bare.decode())
        if start == " ":
            return self._piece(self.letters[32] + word)
        return (self._fixed(self.letters[10]) if start else b"") + self._piece(word)

    def _is_loose(self, text: str) -> bool:
        """Whether a text has to be taken whole."""
        if _FIRST in text or any(token in text for token in self.added):
            return True
        if not self.keeps_spaces:
            return False
        flat = text.replace("\n", " ")
        # Printable text has no white space but blanks; the search tells for the others.
        return ("  " in flat or flat.endswith(" ") or not flat.isprintable()) and bool(
            _LOOSE.search(text))

    def _distinct_ids(self, parts: pa.Array) -> pa.Array:
        """Ids of distinct parts, in their order."""
        stored = parts.cast(pa.large_binary())
        ends = np.frombuffer(stored.buffers()[1], "<i8")[:len(stored) + 1].tolist()
        data = bytes(stored.buffers()[2] or b"")
        known = [data[i:j] for i, j in zip(ends, ends[1:])]
        if self.keeps_spaces:  # a part that begins a text stands behind a blank too many
            known = [part if part[:1] != b"\x01" else b" " + part[1:] if len(part) > 1 else b""
                     for part in known]
        ids = list(map(self.get, known))
        old, blank = self.old.get, self.letters[32] if self.keeps_spaces else ""
        ask, packed = self.ask, self.packed
        for i, found in enumerate(ids):
            if found is not None:
                continue
            part = known[i]
            found = old(part)
            if found is None:
                if part.isalpha():  # ASCII letters only: one piece of the model
                    word = part.decode() if blank else part.lower().decode()
                    found = b"".join([packed[x.id] for x in ask(blank + word)])
                else:
                    found = self._new(part) if part else b""
            if len(part) <= _LONGEST_PART:
                self[part] = found
            ids[i] = found
        return pa.array(ids, pa.large_binary())

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers; null: none."""
        if len(self) > self.held:
            self.old = dict(self)
            self.clear()
        loose = {i for i, text in enumerate(texts) if text and self._is_loose(text)}
        cut = ["" if i in loose else text or "" for i, text in enumerate(texts)]
        if self.keeps_spaces:
            marked = pa.array([_FIRST + text for text in cut], pa.large_string())
            parts = pc.split_pattern(pc.replace_substring(marked, "\n", " \n"), " ")
        else:
            parts = pc.ascii_split_whitespace(pa.array(cut, pa.large_string()))
        words = parts.values.dictionary_encode()
        ids = self._distinct_ids(words.dictionary).take(words.indices)
        ends = np.frombuffer(ids.buffers()[1], "<i8")[:len(ids) + 1][parts.offsets.to_numpy()]
        data = memoryview(ids.buffers()[2] or b"")
        return [self._whole(texts[i]) if i in loose else bytes(data[start:end])
                for i, (start, end) in enumerate(zip(ends.tolist(), ends[1:].tolist()))]

    def encode(self, text: str | None) -> bytes:
        return self.encode_all([text])[0]


def encoder(path: str, held: int = HELD) -> PartEncoder:
    """The worker's encoder for a file; it lives as long as the Python worker."""
    if (path, held) not in _ENCODERS:
        _ENCODERS[path, held] = PartEncoder(path, held)
    return _ENCODERS[path, held]


def encoded_documents(batches, path: str):
    """(doc_id, ids as bytes) of record batches with the columns doc_id and text."""
    found = encoder(path)
    for batch in text_groups(batches, limit=GROUP):
        ids = found.encode_all(batch.column("text").to_pylist())
        yield from zip(batch.column("doc_id").to_pylist(), ids)


def batched(rows, schema: pa.Schema, size: int = 4096):
    """Record batches of at most ``size`` of the given row tuples."""
    held = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)


def _batch(rows, schema):
    columns = zip(*rows)
    return pa.record_batch([pa.array(c, type=f.type) for c, f in zip(columns, schema)],
                           schema=schema)


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
