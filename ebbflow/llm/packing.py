"""Packing documents into fixed-length sequences by exact complements (operator 6).

Lengths are whole numbers up to the capacity, so how many pieces there are of each length says
all that packing needs: a histogram of at most `capacity` counts, however large the corpus. The
driver plans on the histogram; Spark then sends each piece to its place by its length and its
number among the pieces of that length.

Planning goes from long to short. A piece leaves a gap; the lengths still in stock are searched
for one, two or three that sum exactly to it, and as many copies are consumed at once as the
stock allows. What is left over is packed best-fit, longest first.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ebbflow.joins import small
from ebbflow.llm.tokens import default_tokenizer, memo, slices
from ebbflow.session import settled

PIECES = "doc_id long, piece int, start long, length long, ids binary, _task long, _nth long"


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """Start and length of a document's pieces: full ones, only the first may be shorter."""
    first = n % capacity or capacity
    if n <= capacity:
        return [(0, n)]
    return [(0, first), *((at, capacity) for at in range(first, n, capacity))]


def pieces(docs: DataFrame, capacity: int, tokenizer: str | None = None, end_id: int = 2) -> DataFrame:
    """Tokenised pieces in their input order, with the task and the piece's number among those
    of its length in that task. One pass, no shuffle; a few megabytes of text at a time."""
    path = tokenizer or default_tokenizer()

    def work(batches):
        from pyspark import TaskContext

        task, seen = TaskContext.get().partitionId(), defaultdict(int)
        coder, end = memo(path), np.array([end_id], dtype="<u4").tobytes()
        for batch in (part for whole in batches for part in slices(whole)):
            rows = []
            for key, ids in zip(
                batch.column(0).to_pylist(), coder.ids(batch.column(1).to_pylist())
            ):
                ids += end
                for number, (at, length) in enumerate(cut(len(ids) // 4, capacity)):
                    rows.append(
                        (key, number, at, length, ids[4 * at : 4 * (at + length)], task, seen[length])
                    )
                    seen[length] += 1
            if rows:
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64()]
                names = ["doc_id", "piece", "start", "length", "ids", "_task", "_nth"]
                columns = [pa.array(list(c), type=k) for c, k in zip(zip(*rows), kinds)]
                yield pa.record_batch(columns, names=names)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(work, PIECES)


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Patterns (lengths of one sequence, longest first) and how many sequences have each."""
    stock = np.zeros(capacity + 1, dtype=np.int64)
    for length, count in histogram.items():
        stock[length] = count
    found: list[tuple[tuple[int, ...], int]] = []
    if stock[capacity]:
        found.append(((capacity,), int(stock[capacity])))
        stock[capacity] = 0
    for length in range(capacity - 1, 0, -1):
        while stock[length]:
            stock[length] -= 1  # the piece itself is not there to fill its own gap
            rest = _fill(stock, capacity - length)
            stock[length] += 1
            if not rest:
                break
            pattern = (length, *rest)
            need = {x: pattern.count(x) for x in pattern}
            times = min(int(stock[x]) // k for x, k in need.items())
            for x, k in need.items():
                stock[x] -= k * times
            found.append((pattern, times))
    return found + _best_fit(stock, capacity)


def _fill(stock: np.ndarray, gap: int) -> tuple[int, ...] | None:
    """One, two or three lengths in stock that sum to the gap, the longest ones first."""
    if stock[gap]:
        return (gap,)
    if pair := _pair(stock, gap, gap - 1):
        return pair
    for first in np.flatnonzero(stock[: gap - 1])[::-1]:
        first = int(first)
        if 3 * first < gap:
            break
        stock[first] -= 1
        pair = _pair(stock, gap - first, first)
        stock[first] += 1
        if pair:
            return (first, *pair)
    return None


def _pair(stock: np.ndarray, gap: int, most: int) -> tuple[int, int] | None:
    """The pair a >= b with a + b = gap and a <= most whose longer part is longest."""
    high, low = min(most, gap - 1), -(-gap // 2)
    if high < low:
        return None
    longer = np.arange(high, low - 1, -1)
    there = (stock[longer] > 0) & (stock[gap - longer] > 0)
    if gap % 2 == 0 and low == gap // 2:
        there[-1] = stock[gap // 2] > 1
    if not there.any():
        return None
    a = int(longer[there.argmax()])
    return a, gap - a


def _best_fit(stock: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Longest first, each into the fullest sequence that has room; equal ones in bulk."""
    opened: dict[int, dict[tuple[int, ...], int]] = defaultdict(lambda: defaultdict(int))
    for length in range(capacity, 0, -1):
        left = int(stock[length])
        gap = length
        while left:
            while gap <= capacity and not opened[gap]:
                gap += 1
            if gap > capacity:
                each = capacity // length
                opened[capacity - each * length][(length,) * each] += left // each
                if left % each:
                    opened[capacity - (left % each) * length][(length,) * (left % each)] += 1
                break
            pattern, count = opened[gap].popitem()
            used = min(count, left)
            if count > used:
                opened[gap][pattern] += count - used
            opened[gap - length][(*pattern, length)] += used
            left -= used
            gap = length
    return [(p, n) for bins in opened.values() for p, n in bins.items() if n]


def intervals(patterns: list[tuple[tuple[int, ...], int]]) -> dict[int, tuple[np.ndarray, ...]]:
    """For each length: first numbers of its runs, each run's first sequence, and its offset."""
    runs, used, sequence = defaultdict(list), defaultdict(int), 0
    for pattern, count in patterns:
        offset = 0
        for length in pattern:
            runs[length].append((used[length], sequence, offset))
            used[length] += count
            offset += length
        sequence += count
    return {k: tuple(np.array(c, dtype=np.int64) for c in zip(*v)) for k, v in runs.items()}


def pack(
    docs: DataFrame, capacity: int = 1024, tokenizer: str | None = None, end_id: int = 2
) -> DataFrame:
    """doc_id, piece, start, length, ids (little-endian u32 bytes), sequence_id, offset.

    Every whole text is tokenised and gets `end_id`; only documents longer than `capacity` are
    cut. A null or empty text is the end id alone; repeated rows are packed each; columns other
    than doc_id and text are ignored; an empty table gives no rows. The pieces are stored once
    in the shared folder. The driver gets one count for each length, at most `capacity`.
    """
    if capacity < 1:
        raise ValueError("capacity must be at least 1")
    stored = settled(pieces(docs, capacity, tokenizer, end_id))
    counts = stored.groupBy("_task", "length").agg(F.count("*").alias("_rows"))
    before = (
        Window.partitionBy("length").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    )
    first = settled(
        counts.select(
            "_task", "length", "_rows", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_first")
        )
    )
    histogram = {r["length"]: r["n"] for r in first.groupBy("length").agg(F.sum("_rows").alias("n")).collect()}
    runs = intervals(plan(histogram, capacity))

    @F.pandas_udf("sequence_id long, offset long")
    def place(length, number):
        import pandas as pd

        lengths, numbers = length.to_numpy(), number.to_numpy()
        sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
        order = np.argsort(lengths, kind="stable")
        for mine in np.split(order, np.flatnonzero(np.diff(lengths[order])) + 1) if len(order) else []:
            begins, sequences, offsets = runs[int(lengths[mine[0]])]
            run = np.searchsorted(begins, numbers[mine], side="right") - 1
            sequence[mine] = sequences[run] + numbers[mine] - begins[run]
            offset[mine] = offsets[run]
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    # tasks x lengths rows: broadcast below a row bound, else a shuffle join
    placed = (
        stored.join(small(first, ["_task", "length", "_first"]), ["_task", "length"])
        .withColumn("_place", place("length", F.col("_first") + F.col("_nth")))
    )
    return placed.select(
        "doc_id", "piece", "start", "length", "ids", "_place.sequence_id", "_place.offset"
    )


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, n_tokens, ids: the sequences written out; each holds at most `capacity` ids."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))["ids"]
    joined = F.aggregate("_parts", F.lit(b""), lambda done, part: F.concat(done, part))
    return (
        packed.groupBy("sequence_id")
        .agg(F.sum("length").alias("n_tokens"), parts.alias("_parts"))
        .select("sequence_id", "n_tokens", joined.alias("ids"))
    )
