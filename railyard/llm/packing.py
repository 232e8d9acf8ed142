"""Vector bin packing of tokenized examples into training sequences (operator 8).

An example is a vector of three demands: tokens, segments (one a piece) and
loss-bearing tokens (those after its prompt). A sequence has a limit on each.
Pieces are placed by the dot-product heuristic: of the waiting pieces that
fit, the one whose demands align best with what is left of the open sequence.
Examples may be cut: what is longer than a sequence is cut into full ones at
once, and a sequence that nothing fits is filled with the head of a waiting
piece. A sequence that reaches its segment or loss limit early, and the last
one of a task, is cut down to a power of two, where no padding is due; the
rest goes back to the waiting pieces.

Each task packs its own partition as a stream, with at most ``POOL`` waiting
pieces in memory; nothing is shuffled, and a retried task packs the same rows
in the same order again. Sequence ids are the partition's number and a count.

Defined cases: a null text is empty and has the end token only; a null prompt
is empty; a null doc_id is carried through; repeated rows are packed each on
their own; texts of any length are encoded whole and cut into pieces; other
columns, also those named like the ones used here, are ignored; an empty table
gives an empty table.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SEQUENCE = 2048
MAX_SEGMENTS = 64
END_TOKEN = 1
POOL = 256
#: Added tokens of the vocabulary's JSON form; the rank file does not have them.
ADDED_TOKENS = {"<|endoftext|>": 50256}


def default_vocabulary() -> str:
    """Ranks of the public 50k byte-level BPE; with ``ADDED_TOKENS`` the same
    ids as its JSON form, byte_bpe_50k.json."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


class Encoder:
    """Token ids of whole texts; an added token's string is that token."""

    def __init__(self, vocabulary: str):
        import public_tokenizers
        import tiktoken

        with open(vocabulary, "rb") as f:
            ranks = {base64.b64decode(k): int(v) for k, v in map(bytes.split, f)}
        self.coder = tiktoken.Encoding(
            "bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=ADDED_TOKENS
        )

    def ids(self, text: str | None) -> np.ndarray:
        return np.array(self.coder.encode(text, allowed_special="all") if text else [], dtype=np.uint32)


@dataclass(slots=True)
class Piece:
    doc_id: int | None
    ids: np.ndarray
    start: int  # the example's ids before it
    prompt: int  # ids of the example that bear no loss
    total: int  # ids of the whole example
    turn: int = 0  # when the example came

    def loss(self) -> int:
        return self.loss_of(len(self.ids))

    def loss_of(self, length: int) -> int:
        """Loss-bearing ids among the first ``length``."""
        return max(0, self.start + length - max(self.start, self.prompt))

    def cut(self, length: int) -> tuple[Piece, Piece]:
        head = Piece(self.doc_id, self.ids[:length], self.start, self.prompt, self.total, self.turn)
        tail = Piece(self.doc_id, self.ids[length:], self.start + length, self.prompt, self.total, self.turn)
        return head, tail


class Packer:
    """Packs pieces into sequences; ``out`` collects finished ones.

    ``in_order`` fills the first half of a sequence with the pieces that have
    waited longest, so that none is left behind for long.
    """

    def __init__(self, sequence: int, max_segments: int, max_loss: int, in_order: bool = False):
        self.in_order, self.came = in_order, 0
        self.limits = np.array([sequence, max_segments, max_loss], dtype=float)
        self.sequence, self.max_segments, self.max_loss = sequence, max_segments, max_loss
        self.pool: list[Piece] = []
        self.demand = np.empty((0, 3))
        self.out: list[list[Piece]] = []

    def add(self, piece: Piece) -> None:
        """Full sequences are cut off at once, the rest waits."""
        self.came += 1
        piece.turn = self.came
        while len(piece.ids) >= self.sequence and piece.loss_of(self.sequence) <= self.max_loss:
            full, piece = piece.cut(self.sequence)
            self.out.append([full])
        if len(piece.ids):
            self._wait(piece)

    def _wait(self, piece: Piece) -> None:
        self.pool.append(piece)
        self.demand = np.vstack([self.demand, [len(piece.ids), 1, piece.loss()]])

    def _take(self, at: int) -> Piece:
        piece = self.pool[at]
        last = self.pool.pop()
        if at < len(self.pool):
            self.pool[at] = last
            self.demand[at] = self.demand[-1]
        self.demand = self.demand[:-1]
        return piece

    def pack_one(self) -> None:
        """Fill and close one sequence from the waiting pieces."""
        held, left = [], self.limits.copy()
        while self.pool and left.min() >= 1:
            fits = np.flatnonzero((self.demand <= left).all(axis=1))
            if len(fits) and self.in_order and 2 * left[0] > self.sequence:
                piece = self._take(int(min(fits, key=lambda i: self.pool[i].turn)))
            elif len(fits):
                score = (self.demand[fits] / self.limits) @ (left / self.limits)
                piece = self._take(int(fits[np.argmax(score)]))
            else:
                at = int(np.argmax(self.demand[:, 0]))
                piece = self.pool[at]
                length = int(min(left[0], left[2] + max(0, piece.prompt - piece.start), len(piece.ids)))
                head, tail = self._take(at).cut(length)
                if len(tail.ids):
                    self._wait(tail)
                piece = head
            held.append(piece)
            left -= [len(piece.ids), 1, piece.loss()]
        self._close(held)

    def _close(self, held: list[Piece]) -> None:
        """Cut down to a power of two unless full; the rest waits again."""
        filled = sum(len(p.ids) for p in held)
        keep = filled if filled == self.sequence else 1 << (filled.bit_length() - 1)
        while filled > keep:
            piece = held.pop()
            filled -= len(piece.ids)
            if filled < keep:
                head, piece = piece.cut(keep - filled)
                held.append(head)
                filled = keep
            self._wait(piece)
        self.out.append(held)

    def finish(self) -> None:
        while self.pool:
            self.pack_one()


OUTPUT = pa.schema(
    [
        ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
        ("doc_tokens", pa.int64()), ("loss_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()),
    ]
)
OUTPUT_DDL = (
    "doc_id long, start long, length long, ids binary, doc_tokens long, loss_tokens long, "
    "sequence_id long, offset long"
)


def _rows(sequences: list[list[Piece]], first: int) -> pa.RecordBatch:
    columns: list[list] = [[] for _ in OUTPUT]
    for n, pieces in enumerate(sequences):
        offset = 0
        for p in pieces:
            row = (p.doc_id, p.start, len(p.ids), p.ids.astype("<u4").tobytes(), p.total, p.loss(), first + n, offset)
            for column, value in zip(columns, row):
                column.append(value)
            offset += len(p.ids)
    return pa.record_batch([pa.array(c, t.type) for c, t in zip(columns, OUTPUT)], schema=OUTPUT)


def pack(
    df: DataFrame,
    vocabulary: str | None = None,
    sequence: int = SEQUENCE,
    max_segments: int = MAX_SEGMENTS,
    max_loss: int | None = None,
    end_token: int = END_TOKEN,
    pool: int = POOL,
    order: str | None = None,
) -> DataFrame:
    """One row per piece, with its ids, from ``doc_id, text`` and, if there is
    one, ``prompt`` (put before the text; its tokens bear no loss).

    With ``order``, a column, the documents are dealt to the tasks in ranges of
    it and packed in its order: numbers of sequences then rise with it, but for
    the pieces that wait in the pool of a task, and none waits for long.
    """
    vocabulary = vocabulary or default_vocabulary()
    limits = (sequence, max_segments, sequence if max_loss is None else max_loss)
    prompt = F.col("prompt") if "prompt" in df.columns else F.lit(None).cast("string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, packer = Encoder(vocabulary), Packer(*limits, in_order=order is not None)
        first = TaskContext.get().partitionId() << 40
        for batch in batches:
            for doc_id, text, before in zip(*(batch.column(c).to_pylist() for c in range(3))):
                head, body = encoder.ids(before), encoder.ids(text)
                ids = np.concatenate([head, body, [end_token]]).astype(np.uint32)
                packer.add(Piece(doc_id, ids, 0, len(head), len(ids)))
                while len(packer.pool) >= pool:
                    packer.pack_one()
                if len(packer.out) >= 1000:
                    yield _rows(packer.out, first)
                    first += len(packer.out)
                    packer.out = []
        packer.finish()
        yield _rows(packer.out, first)

    docs = df.select("doc_id", "text", prompt.alias("prompt"), *([order] if order else []))
    if order:
        docs = docs.repartitionByRange(order).sortWithinPartitions(order).drop(order)
    return docs.mapInArrow(run, OUTPUT_DDL)
