"""Token sequences packed by a dot-product heuristic under several limits at once.

A document's ids are cut into full sequences; what is left over is an example
with three sizes: tokens, segments (one) and tokens that bear loss. Examples
wait in a block of some hundreds. A sequence is filled by taking, again and
again, the example that fits within every limit and whose sizes have the
largest dot product with what is still free, each dimension weighted by its
scarcity in the block. When none fits but tokens are free, the example
with the largest product is cut and its first part fills the gap.

A sequence that ends up short (its segments or loss tokens are used up, or the
partition ends) is divided at powers of two, which need no padding. Everything
happens in one pass over the scan's partitions, with no shuffle; memory holds a
block of examples and one open sequence.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from ledgerlight.llm.storage import map_batches
from ledgerlight.llm.text_arrays import blocks
from ledgerlight.llm.tokens import encoder

SEQUENCES = (
    "sequence_id long, n_tokens int, n_loss int, ids binary, "
    "segments array<struct<id:long,start:long,length:long,doc_tokens:long,offset:long>>"
)
_SEGMENT = pa.struct([(n, pa.int64()) for n in ("id", "start", "length", "doc_tokens", "offset")])
_BATCH = 256


@dataclass(frozen=True)
class Limits:
    tokens: int = 4096
    segments: int = 1024
    loss: int = 4096
    block: int = 600


@dataclass
class Piece:
    """A run of a document's ids; the first ``silent`` of them bear no loss."""

    id: int | None
    start: int
    ids: np.ndarray
    silent: int
    doc_tokens: int

    @property
    def loss(self) -> int:
        return len(self.ids) - self.silent

    def split(self, n: int) -> tuple[Piece, Piece]:
        quiet = min(self.silent, n)
        return (
            Piece(self.id, self.start, self.ids[:n], quiet, self.doc_tokens),
            Piece(self.id, self.start + n, self.ids[n:], self.silent - quiet, self.doc_tokens),
        )

    def longest(self, tokens: int, loss: int) -> int:
        """How many ids may be taken with so much free."""
        n = min(tokens, len(self.ids))
        return n if n <= self.silent else min(n, self.silent + loss)


class Packer:
    def __init__(self, limits: Limits) -> None:
        self.limits = limits
        self.waiting: list[Piece] = []
        self.open: list[Piece] = []

    def add(self, piece: Piece) -> Iterator[list[Piece]]:
        limits = self.limits
        while len(piece.ids) >= limits.tokens:
            n = piece.longest(limits.tokens, limits.loss)
            if n < limits.tokens:
                break
            whole, piece = piece.split(n)
            yield [whole]
        if len(piece.ids):
            self.waiting.append(piece)
        if len(self.waiting) >= limits.block:
            yield from self._place(last=False)

    def finish(self) -> Iterator[list[Piece]]:
        yield from self._place(last=True)
        if self.open:
            yield from self._divided(self.open)
            self.open = []

    def _place(self, last: bool) -> Iterator[list[Piece]]:
        """Fills sequences from the waiting examples; the last, unfinished one stays open."""
        limits, items = self.limits, self.waiting
        most = np.array([limits.tokens, limits.segments, limits.loss], dtype=float)
        sizes = np.array([[len(p.ids), 1, p.loss] for p in items], dtype=float).reshape(-1, 3)
        left = np.ones(len(items), dtype=bool)
        # Scarce dimensions weigh more: the block's mean demand as a share of the limit.
        weight = sizes.mean(axis=0) / most**2 if len(items) else most
        free = most - np.array([[len(p.ids), 1, p.loss] for p in self.open]).reshape(-1, 3).sum(axis=0)
        remaining = len(items)
        while remaining:
            value = sizes @ (weight * free / most)
            fits = left & (sizes <= free).all(axis=1)
            if fits.any():
                k = int(np.where(fits, value, -1).argmax())
                self.open.append(items[k])
                free -= sizes[k]
                left[k] = False
                remaining -= 1
            else:
                k = int(np.where(left, value, -1).argmax())
                n = items[k].longest(int(free[0]), int(free[2])) if free[1] >= 1 else 0
                if n:
                    part, items[k] = items[k].split(n)
                    sizes[k] = len(items[k].ids), 1, items[k].loss
                    self.open.append(part)
                yield from self._divided(self.open)
                self.open, free = [], most.copy()
            if free[0] < 1:
                yield from self._divided(self.open)
                self.open, free = [], most.copy()
        self.waiting = []

    def _divided(self, pieces: list[Piece]) -> Iterator[list[Piece]]:
        """A full sequence as it is, a short one as sequences of 2**k ids each."""
        n = sum(len(p.ids) for p in pieces)
        if n == self.limits.tokens or n & (n - 1) == 0:
            if pieces:
                yield pieces
            return
        queue = pieces[::-1]
        for k in range(n.bit_length() - 1, -1, -1):
            if not n >> k & 1:
                continue
            room, out = 1 << k, []
            while room:
                piece = queue.pop()
                if len(piece.ids) > room:
                    piece, rest = piece.split(room)
                    queue.append(rest)
                room -= len(piece.ids)
                out.append(piece)
            yield out


def _row(pieces: list[Piece]) -> tuple[int, int, bytes, list[dict]]:
    segments, offset = [], 0
    for p in pieces:
        segments.append({"id": p.id, "start": p.start, "length": len(p.ids), "doc_tokens": p.doc_tokens, "offset": offset})
        offset += len(p.ids)
    ids = np.concatenate([p.ids for p in pieces]).astype("<u4").tobytes()
    return offset, sum(p.loss for p in pieces), ids, segments


def _packer(tokenizer: str, end_id: int | None, limits: Limits):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, packer = encoder(tokenizer), Packer(limits)
        number, rows = TaskContext.get().partitionId() << 40, []

        def batch() -> pa.RecordBatch:
            nonlocal number, rows
            n, loss, ids, segments = zip(*rows, strict=True)
            numbers = pa.array(range(number, number + len(rows)), pa.int64())
            number, rows = number + len(rows), []
            return pa.RecordBatch.from_arrays(
                [numbers, pa.array(n, pa.int32()), pa.array(loss, pa.int32()), pa.array(ids, pa.binary()),
                 pa.array(segments, pa.list_(_SEGMENT))],
                names=["sequence_id", "n_tokens", "n_loss", "ids", "segments"],
            )

        for source in batches:
            keys, silent = source.column(0).to_pylist(), source.column(2).to_pylist()
            for block in blocks(source.column(1)):
                flat, counts = code.encode(block)
                begin = 0
                for i, n in enumerate(counts.tolist(), block.first):
                    ids = flat[begin : begin + n]
                    begin += n
                    if end_id is not None:
                        ids = np.append(ids, flat.dtype.type(end_id))
                    quiet = min(max(silent[i] or 0, 0), len(ids))
                    for pieces in packer.add(Piece(keys[i], 0, ids.copy(), quiet, len(ids))):
                        rows.append(_row(pieces))
                    if len(rows) >= _BATCH:
                        yield batch()
        rows += [_row(pieces) for pieces in packer.finish()]
        if rows:
            yield batch()

    return run


def pack(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int | None = 2,
    silent_col: str | None = None,
    limits: Limits = Limits(),
) -> DataFrame:
    """One row per packed sequence: its ids (unsigned 32-bit, little-endian) and the segments they come from.

    ``silent_col`` counts a document's leading ids that bear no loss (a prompt);
    null or absent means none. A null text is empty, so only its end id is packed; without an
    end id it takes no room. Rows that share an id are packed each on its own; an
    empty table gives no sequence; other columns are ignored.
    """
    silent = F.col(silent_col).cast("int") if silent_col else F.lit(0)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), silent.alias("silent"))
    return map_batches(rows, _packer(tokenizer, end_id, limits), SEQUENCES)


def pieces(packed: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row per segment of the packed sequences, with the CRC-32 of its ids."""
    segment = F.col("segment")
    ids = F.substring(F.col("ids"), (segment["offset"] * 4 + 1).cast("int"), (segment["length"] * 4).cast("int"))
    return packed.select("sequence_id", "ids", F.explode("segments").alias("segment")).select(
        segment["id"].alias(id_col),
        segment["start"].alias("start"),
        segment["length"].alias("length"),
        F.crc32(ids).alias("ids_crc32"),
        segment["doc_tokens"].alias("doc_tokens"),
        "sequence_id",
        segment["offset"].alias("offset"),
    )
