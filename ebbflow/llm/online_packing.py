"""Online packing by sums of squares (operator 11).

Documents are taken as they come. A window is a sequence that is being filled, its level how much
it holds. The level array counts the partially filled windows of each level. A document goes to
the level whose choice makes the sum of the squared counts least: that keeps the levels apart, so
that a later document of any length finds a gap that it fills. Ties go to the fullest window.

Each task packs its own documents, without a shuffle; what it holds is bounded by OPEN windows.
Documents longer than a window are cut into full windows and a rest. At the end, or when more
than OPEN windows are open, the emptiest windows are cut up to fill the gaps of the others. What
then is left is one window, which is dealt to sequences whose lengths are powers of two: those,
like full ones, need no padding.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ebbflow.llm.tokens import memo, slices

OPEN = 1024  # windows a task keeps open, at most 16 KB of ids each at 4096
FLUSH = 4 << 20  # bytes of ids in a batch of finished pieces
SEQUENCE_BITS = 33  # sequences of a task
PIECES = (
    "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
)


class Piece(NamedTuple):
    """Consecutive ids of a document as little-endian unsigned 32-bit integers."""

    doc_id: int | None
    start: int
    ids: bytes
    doc_tokens: int

    @property
    def length(self) -> int:
        return len(self.ids) // 4

    def cut(self, at: int) -> tuple["Piece", "Piece"]:
        return (
            self._replace(ids=self.ids[: 4 * at]),
            self._replace(start=self.start + at, ids=self.ids[4 * at :]),
        )


class Packer:
    """Windows of one task. `add` and `finish` give the sequences that are done, as lists of
    pieces; those of `finish` may be shorter than the capacity, by then powers of two."""

    def __init__(self, capacity: int, most_open: int = OPEN):
        self.capacity, self.most_open = capacity, most_open
        self.levels = np.zeros(capacity + 1, dtype=np.int64)
        self.windows: dict[int, list[list[Piece]]] = defaultdict(list)
        self.n_open = 0

    def choose(self, size: int) -> int:
        """The level to place a document of this size at; 0 opens a window."""
        there = np.flatnonzero(self.levels[1 : self.capacity - size + 1]) + 1
        # growth of the sum of squares; a window that is full leaves the sum
        to = there + size
        growth = np.where(
            to == self.capacity,
            1 - 2 * self.levels[there],
            2 * (self.levels[to] - self.levels[there]) + 2,
        )
        fresh = 2 * int(self.levels[size]) + 1 if size < self.capacity else 0
        if not len(there) or growth.min() > fresh:
            return 0
        return int(there[len(there) - 1 - growth[::-1].argmin()])

    def add(self, piece: Piece) -> Iterator[list[Piece]]:
        while piece.length >= self.capacity:
            full, piece = piece.cut(self.capacity)
            yield [full]
        if not piece.length:
            return
        level = self.choose(piece.length)
        if level:
            window = self._take(level)
        else:
            window = []
        window.append(piece)
        if level + piece.length == self.capacity:
            yield window
        else:
            self._put(level + piece.length, window)
        if self.n_open > self.most_open:
            yield from self._close_gaps()

    def _take(self, level: int) -> list[Piece]:
        self.levels[level] -= 1
        self.n_open -= 1
        return self.windows[level].pop()

    def _put(self, level: int, window: list[Piece]) -> None:
        self.levels[level] += 1
        self.n_open += 1
        self.windows[level].append(window)

    def _close_gaps(self) -> Iterator[list[Piece]]:
        """Fill the fullest windows from the emptiest ones until one is left open at most."""
        while self.n_open > 1:
            levels = np.flatnonzero(self.levels)
            high, low = int(levels[-1]), int(levels[0])
            target, source = self._take(high), self._take(low)
            gap = self.capacity - high
            while gap and source:
                piece = source.pop()
                if piece.length > gap:  # its end goes, its beginning keeps its place
                    rest, piece = piece.cut(piece.length - gap)
                    source.append(rest)
                target.append(piece)
                gap -= piece.length
            if gap:
                self._put(self.capacity - gap, target)
            else:
                yield target
            if source:
                self._put(sum(p.length for p in source), source)

    def finish(self) -> Iterator[list[Piece]]:
        yield from self._close_gaps()
        for level in np.flatnonzero(self.levels):
            pieces = self._take(int(level))
            power = 1 << (int(level).bit_length() - 1)
            while power:
                if int(level) & power:
                    sequence, need = [], power
                    while need:
                        piece = pieces.pop(0)
                        if piece.length > need:
                            piece, rest = piece.cut(need)
                            pieces.insert(0, rest)
                        sequence.append(piece)
                        need -= piece.length
                    yield sequence
                power >>= 1


def _batch(sequences: list[tuple[int, list[Piece]]]) -> pa.RecordBatch:
    rows = []
    for number, pieces in sequences:
        offset = 0
        for p in pieces:
            rows.append((p.doc_id, p.start, p.length, p.ids, p.doc_tokens, number, offset))
            offset += p.length
    names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    kinds = [pa.binary() if n == "ids" else pa.int64() for n in names]
    return pa.record_batch([pa.array(list(c), type=k) for c, k in zip(zip(*rows), kinds)], names=names)


def pack_online(
    docs: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 2, most_open: int = OPEN
) -> DataFrame:
    """doc_id, start, length, ids (little-endian u32 bytes), doc_tokens, sequence_id, offset.

    Every whole text is tokenised and gets `end_id`; each id lies in exactly one piece. Every
    sequence is full or has a power of two of ids. A null or empty text is the end id alone;
    repeated rows are packed each; columns other than doc_id and text are ignored; an empty table
    gives no rows. Sequence ids hold the number of the task that packed them.
    """
    if capacity < 1:
        raise ValueError("capacity must be at least 1")

    def work(batches):
        from pyspark import TaskContext

        first = TaskContext.get().partitionId() << SEQUENCE_BITS
        coder, end = memo(tokenizer), np.array([end_id], dtype="<u4").tobytes()
        packer, done, held, number = Packer(capacity, most_open), [], 0, 0

        def finished():
            for batch in (part for whole in batches for part in slices(whole)):
                coded = coder.ids(batch.column(1).to_pylist())
                for key, ids in zip(batch.column(0).to_pylist(), coded):
                    yield from packer.add(Piece(key, 0, ids + end, len(ids) // 4 + 1))
            yield from packer.finish()

        for sequence in finished():
            done.append((first + number, sequence))
            number += 1
            held += sum(len(p.ids) for p in sequence)
            if held >= FLUSH:
                yield _batch(done)
                done, held = [], 0
        if done:
            yield _batch(done)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(work, PIECES)
