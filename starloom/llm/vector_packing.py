"""Vector bin packing of instruction data under three limits at once.

A sequence has room for so many tokens, segments and loss-bearing tokens. Sequences are filled
one after the other. Of the pieces at hand, the one goes in next that fits and whose vector
(tokens, one segment, loss-bearing tokens) has the largest dot product with the room left, each
measured in shares of its limit; ties go to the piece that came first into its place. If no
piece fits, the one that fills most of the room is cut, and its rest goes back; the last segment
of a sequence is chosen to fill it. So sequences are full unless a limit besides tokens closes
them or a task runs out of pieces. Such a sequence is given as several whose lengths are powers
of two, which need no padding.

A task packs what it reads, without a shuffle. It holds ``WINDOW`` pieces of at most a sequence
each, and a group of documents.

Null or empty text is a document of the end id only. Rows are packed each, whether or not they
repeat a doc_id, and a null doc_id stays null. An empty table gives no rows. Only the columns
named are read.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import text_groups
from starloom.llm.tokens import GROUP, batched, encoder

CAPACITY = 2048
SEGMENTS = 64
#: Pieces to choose from.
WINDOW = 1024

_ROWS = pa.schema([
    ("doc_id", pa.int64()), ("start", pa.int64()), ("ids", pa.binary()),
    ("loss_tokens", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()),
    ("segment", pa.int64()), ("offset", pa.int64())])
_ROWS_SQL = ("doc_id long, start long, ids binary, loss_tokens long, doc_tokens long, "
             "sequence_id long, segment long, offset long")


class Piece:
    """Ids ``start:end`` of a document; those from ``prompt`` on bear loss."""

    __slots__ = ("doc", "ids", "start", "end", "prompt")

    def __init__(self, doc, ids: bytes, start: int, end: int, prompt: int):
        self.doc, self.ids, self.start, self.end, self.prompt = doc, ids, start, end, prompt

    @property
    def tokens(self) -> int:
        return self.end - self.start

    @property
    def loss(self) -> int:
        return max(0, self.end - max(self.start, self.prompt))

    def head(self, n: int) -> Piece:
        return Piece(self.doc, self.ids, self.start, self.start + n, self.prompt)

    def rest(self, n: int) -> Piece:
        return Piece(self.doc, self.ids, self.start + n, self.end, self.prompt)


class Packer:
    """Packs pieces into sequences (lists of pieces) of at most ``limits`` tokens, segments and
    loss-bearing tokens. ``powers`` splits sequences that are not full."""

    def __init__(self, limits: tuple[int, int, int], window: int = WINDOW, powers: bool = True):
        if min(limits) < 1 or window < 1:
            raise ValueError("every limit and the window must be at least 1")
        self.limits, self.window, self.powers = limits, window, powers
        self.held: list[Piece] = []
        self.tokens = np.zeros(window + 1, np.int64)
        self.loss = np.zeros(window + 1, np.int64)
        self.before = np.zeros(window + 1, np.int64)  # tokens in front of the loss

    def _set(self, i: int, piece: Piece) -> None:
        self.tokens[i], self.loss[i] = piece.tokens, piece.loss
        self.before[i] = piece.tokens - piece.loss

    def _hold(self, piece: Piece) -> None:
        self._set(len(self.held), piece)
        self.held.append(piece)

    def _take(self, i: int, n: int) -> Piece:
        piece = self.held[i]
        if n < piece.tokens:
            self.held[i] = piece.rest(n)
            self._set(i, self.held[i])
            return piece.head(n)
        last = self.held.pop()
        if i < len(self.held):
            self.held[i] = last
            self._set(i, last)
        return piece

    def _sequence(self) -> list[Piece]:
        room, segments, loss_room = self.limits
        most, most_segments, most_loss = self.limits
        found: list[Piece] = []
        while self.held and room and segments:
            n = len(self.held)
            tokens, loss = self.tokens[:n], self.loss[:n]
            fits = (tokens <= room) & (loss <= loss_room)
            if segments == 1:
                fits &= tokens == room
            if fits.any():
                dot = (tokens * (room / most ** 2) + loss * (loss_room / most_loss ** 2)
                       + segments / most_segments ** 2)
                i = int(np.where(fits, dot, -1.0).argmax())
                piece = self._take(i, int(tokens[i]))
            else:
                part = np.minimum(np.minimum(tokens, room), self.before[:n] + loss_room)
                i = int(part.argmax())
                if not part[i]:
                    break
                piece = self._take(i, int(part[i]))
            found.append(piece)
            room, segments, loss_room = (room - piece.tokens, segments - 1,
                                         loss_room - piece.loss)
        return found

    def _emit(self, sequence: list[Piece]):
        total = sum(p.tokens for p in sequence)
        if not self.powers or total == self.limits[0]:
            yield sequence
            return
        left = sequence[::-1]
        for bit in reversed(range(total.bit_length())):
            room, part = total & 1 << bit, []
            while room:
                piece = left.pop()
                if piece.tokens > room:
                    left.append(piece.rest(room))
                    piece = piece.head(room)
                part.append(piece)
                room -= piece.tokens
            if part:
                yield part

    def add(self, piece: Piece):
        """Hold a piece; yields sequences as soon as there are more pieces than the window."""
        capacity, _, most_loss = self.limits
        while piece.tokens > capacity:
            head = piece.head(capacity)
            yield from self._whole(head) if head.loss <= most_loss else self._buffered(head)
            piece = piece.rest(capacity)
        yield from self._buffered(piece)

    def _whole(self, piece: Piece):
        yield [piece]

    def _buffered(self, piece: Piece):
        self._hold(piece)
        while len(self.held) > self.window:
            yield from self._emit(self._sequence())

    def finish(self):
        while self.held:
            yield from self._emit(self._sequence())


def whole_documents(batches, tokenizer: str, end_id: int):
    """A piece per row of record batches with doc_id, text and perhaps prompt."""
    code, end = encoder(tokenizer), struct.pack("<I", end_id)
    for part in text_groups(batches, limit=GROUP):
        doc_ids, *texts = (part.column(c).to_pylist() for c in part.schema.names)
        # All texts of a group together, so that each distinct part is looked up once.
        answers, *before = map(code.encode_all, texts)
        heads = before[0] if before else [b""] * len(answers)
        for doc, head, answer in zip(doc_ids, heads, answers):
            ids = head + answer + end
            yield Piece(doc, ids, 0, len(ids) // 4, len(head) // 4)


def pack(docs: DataFrame, tokenizer: str, end_id: int = 1, capacity: int = CAPACITY,
         segments: int = SEGMENTS, loss_tokens: int | None = None, prompt: str | None = None,
         window: int = WINDOW, powers: bool = True) -> DataFrame:
    """Pack all rows of ``docs`` (doc_id, text). ``prompt`` names a column whose ids come before
    those of the text and bear no loss. ``loss_tokens`` is at most ``capacity``, the default.

    A row per piece: doc_id, start (ids of the document before it), ids (little-endian unsigned
    32 bit), loss_tokens, doc_tokens, sequence_id (partition and number), segment, offset.
    """
    limits = (capacity, segments, loss_tokens or capacity)

    def packed(batches):
        partition, packer = TaskContext.get().partitionId(), Packer(limits, window, powers)
        number = partition << 40

        def rows(sequences):
            nonlocal number
            for sequence in sequences:
                offset = 0
                for i, p in enumerate(sequence):
                    yield (p.doc, p.start, p.ids[4 * p.start:4 * p.end], p.loss,
                           len(p.ids) // 4, number, i, offset)
                    offset += p.tokens
                number += 1

        for piece in whole_documents(batches, tokenizer, end_id):
            yield from rows(packer.add(piece))
        yield from rows(packer.finish())

    columns = [F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text")]
    if prompt:
        columns.append(F.col(prompt).alias("prompt"))
    return docs.select(*columns).mapInArrow(
        lambda batches: batched(packed(batches), _ROWS, 512), _ROWS_SQL)


def turn_examples(conversations: DataFrame, answers: str = "assistant") -> DataFrame:
    """(doc_id, prompt, text) of each turn with the role ``answers``: doc_id is the conversation,
    prompt the text of the turn before (the smallest if a turn repeats), if there is one."""
    turns = conversations.select(F.col("conv_id").cast("long").alias("doc_id"), "turn", "role",
                                 "text")
    before = turns.groupBy("doc_id", (F.col("turn") + 1).alias("turn")).agg(
        F.min("text").alias("prompt"))
    return turns.where(F.col("role") == answers).join(
        before, ["doc_id", "turn"], "left").select("doc_id", "prompt", "text")
