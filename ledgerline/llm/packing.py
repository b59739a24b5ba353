"""Vector bin packing of documents and instruction examples into
training sequences.

A sequence is a bin with three limits: tokens, segments (pieces in it)
and loss-bearing tokens.  The dot-product heuristic fills one sequence
at a time: of all waiting pieces that fit, it places the one whose
demand vector (each part as a share of its limit) has the largest dot
product with what is left of the sequence.

Every task packs the rows of its own input partition as they stream in,
with at most ``POOL`` waiting pieces: no shuffle, bounded memory, and no
source or group of copies can load one task more than another.  Sequence
ids are the partition's number and a counter, so a retried task gives
the same rows.

Documents (``pack_documents``) may be cut.  Full sequences are cut off
long documents first; the rest competes by the heuristic.  A gap of
``LEAST_CUT`` tokens or more that no waiting piece fits is filled with
the head of the longest one, whose tail goes on waiting.  What a
partition has at its end is cut at powers of two, which need no padding.
Every id of a document bears loss, so its loss demand is its length.

Examples (``pack_examples``) are never cut; one that exceeds a limit by
itself gets its own sequence, marked ``oversize``.

Defined results.  Null text: the empty text, which still has the closing
id.  Very long texts are cut into many sequences; none is dropped.  Rows
with a null or repeated id are packed like others, one by one.  Ties go
to the piece that has waited in the lowest slot.  Null token or loss
counts are 0.  Empty table: no rows.  Columns other than those named are
not read, so their names cannot clash.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.bpe import tokenizer_path
from ledgerline.llm.common import id_and_text
from ledgerline.llm.wordbpe import library_words

MAX_TOKENS = 2048
MAX_SEGMENTS = 512
POOL = 512
LEAST_CUT = 16
CLOSING_ID = 1
ROWS_IN = 1024  # encoded at once
ROWS_OUT = 8192


class DotProductPacker:
    """Waiting pieces and the heuristic.  A piece is (payload, start,
    tokens, loss); with ``cut`` its loss equals its tokens."""

    def __init__(self, max_tokens: int, max_segments: int, max_loss: int, cut: bool):
        self.limits = np.array([max_tokens, 1, max_loss], np.int64)
        self.max_segments, self.cut = max_segments, cut
        self.share = np.array([max_tokens, max_segments, max_loss], float)
        self.demand = np.zeros((POOL, 3), np.int64)  # tokens, segments, loss; tokens 0: free slot
        self.waiting = np.zeros(POOL, bool)
        self.pieces: list = [None] * POOL
        self.free = list(range(POOL - 1, -1, -1))

    def __len__(self) -> int:
        return POOL - len(self.free)

    def add(self, payload, start: int, tokens: int, loss: int) -> None:
        slot = self.free.pop()
        self.demand[slot] = tokens, 1, loss
        self.waiting[slot] = True
        self.pieces[slot] = (payload, start, tokens, loss)

    def _take(self, slot: int):
        self.waiting[slot] = False
        self.free.append(slot)
        piece, self.pieces[slot] = self.pieces[slot], None
        return piece

    def sequence(self) -> list:
        """The pieces of one more sequence, in order."""
        left = np.array([self.limits[0], self.max_segments, self.limits[2]], np.int64)
        placed = []
        while left[1]:
            fits = self.waiting & (self.demand <= left).all(axis=1)
            if fits.any():
                slot = int(np.argmax(np.where(fits, (self.demand / self.share) @ (left / self.share), -1.0)))
                piece = self._take(slot)
                placed.append(piece)
                left -= (piece[2], 1, piece[3])
                continue
            gap = int(min(left[0], left[2]))
            if not (self.cut and gap >= LEAST_CUT and self.waiting.any()):
                break
            slot = int(np.argmax(np.where(self.waiting, self.demand[:, 0], 0)))
            payload, start, tokens, _ = self._take(slot)
            placed.append((payload, start, gap, gap))
            self.add(payload, start + gap, tokens - gap, tokens - gap)
            left -= (gap, 1, gap)
        return placed


def powers_of_two(pieces: list) -> Iterator[list]:
    """The pieces in order, cut into sequences whose lengths are the
    powers of two that their sum consists of."""
    total = sum(p[2] for p in pieces)
    queue = pieces[::-1]
    for power in range(total.bit_length() - 1, -1, -1):
        room = total & (1 << power)
        out = []
        while room:
            payload, start, tokens, _ = queue.pop()
            n = min(tokens, room)
            out.append((payload, start, n, n))
            if n < tokens:
                queue.append((payload, start + n, tokens - n, tokens - n))
            room -= n
        if out:
            yield out


def pack_documents(docs: DataFrame, path: str | None = None, max_tokens: int = MAX_TOKENS,
                   max_segments: int = MAX_SEGMENTS, max_loss: int | None = None, with_ids: bool = False,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: its document, where it starts there, its place
    in its sequence, and (``with_ids``) its ids."""
    path = path or tokenizer_path()
    max_loss = max_loss or max_tokens
    full = min(max_tokens, max_loss)
    schema = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
              "offset long" + ", ids binary" * with_ids)
    names = [f.split()[0] for f in schema.split(", ")]
    kinds = [pa.int64()] * 7 + [pa.binary()] * with_ids

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = library_words(path)
        packer = DotProductPacker(max_tokens, max_segments, max_loss, cut=True)
        number = TaskContext.get().partitionId() << 40
        closing = CLOSING_ID.to_bytes(4, "little")
        rows: list[tuple] = []

        def emit(pieces: list) -> None:
            nonlocal number
            offset = 0
            for (doc_id, ids), start, tokens, _ in pieces:
                part = memoryview(ids)[4 * start:4 * (start + tokens)]
                rows.append((doc_id, start, tokens, zlib.crc32(part), len(ids) // 4, number, offset)
                            + (bytes(part),) * with_ids)
                offset += tokens
            number += 1

        def drain(keep: int) -> None:
            while len(packer) > keep:
                pieces = packer.sequence()
                total = sum(p[2] for p in pieces)
                if len(packer) or total + LEAST_CUT > full:
                    emit(pieces)
                else:
                    for part in powers_of_two(pieces):
                        emit(part)

        def out() -> pa.RecordBatch:
            columns = zip(*rows)
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
            rows.clear()
            return pa.RecordBatch.from_arrays(arrays, names)

        def encoded(batch: pa.RecordBatch, encoder) -> Iterator[tuple]:
            for s in range(0, batch.num_rows, ROWS_IN):
                part = batch.slice(s, ROWS_IN)
                yield from zip(part.column("doc_id").to_pylist(), encoder.encode_all(part.column("text").to_pylist()))

        for batch in batches:
            for doc_id, ids in encoded(batch, encoder):
                ids += closing
                tokens, start = len(ids) // 4, 0
                while tokens - start >= full:
                    emit([((doc_id, ids), start, full, full)])
                    start += full
                if tokens > start:
                    packer.add((doc_id, ids), start, tokens - start, tokens - start)
                    if len(packer) == POOL:
                        drain(POOL // 2)
                if len(rows) >= ROWS_OUT:
                    yield out()
        drain(0)
        if rows:
            yield out()

    return id_and_text(docs, id_col, text_col).mapInArrow(pack, schema)


def pack_examples(examples: DataFrame, id_col: str, tokens_col: str, loss_col: str, max_tokens: int = MAX_TOKENS,
                  max_segments: int = MAX_SEGMENTS, max_loss: int = MAX_TOKENS) -> DataFrame:
    """Instruction examples placed whole: (id, n_tokens, n_loss,
    sequence_id, offset, oversize)."""
    schema = "id long, n_tokens long, n_loss long, sequence_id long, offset long, oversize boolean"
    names = [f.split()[0] for f in schema.split(", ")]
    kinds = [pa.int64()] * 5 + [pa.bool_()]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = DotProductPacker(max_tokens, max_segments, max_loss, cut=False)
        number = TaskContext.get().partitionId() << 40
        rows: list[tuple] = []

        def emit(pieces: list, oversize: bool = False) -> None:
            nonlocal number
            offset = 0
            for key, _, tokens, loss in pieces:
                rows.append((key, tokens, loss, number, offset, oversize))
                offset += tokens
            number += 1

        def out() -> pa.RecordBatch:
            arrays = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
            rows.clear()
            return pa.RecordBatch.from_arrays(arrays, names)

        for batch in batches:
            for key, tokens, loss in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if tokens > max_tokens or loss > max_loss:
                    emit([(key, 0, tokens, loss)], True)
                    continue
                packer.add(key, 0, tokens, loss)
                if len(packer) == POOL:
                    while len(packer) > POOL // 2:
                        emit(packer.sequence())
            if len(rows) >= ROWS_OUT:
                yield out()
        while len(packer):
            emit(packer.sequence())
        if rows:
            yield out()

    def count(c: str):
        return F.greatest(F.coalesce(F.col(c).cast("long"), F.lit(0)), F.lit(0))

    return examples.select(F.col(id_col).cast("long").alias("id"), count(tokens_col).alias("n_tokens"),
                           F.least(count(loss_col), count(tokens_col)).alias("n_loss")).mapInArrow(pack, schema)
