"""Token-id files in Simple-8b coding (operator 1).

Simple-8b packs as many ids as fit into each 64-bit word: four selector bits say how many of
which width. A file holds frames; a frame holds whole documents, its ids cut into blocks of 256.
Every block begins a word, and the frame lists where, so all blocks of a frame are decoded at
once by array operations and any of them alone.

Frame, little-endian, ended by a line feed:
  4s magic, u32 partition, u32 frame, u64 ids before it in its partition, u32 documents,
  u64 ids, u32 words, u32 escapes
  i64 doc_id x documents; u8 doc_id-is-null x documents; u64 ids x documents
  u32 first word x (blocks + 1); u64 escaped id x escapes; u64 word x words
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ebbflow.joins import small
from ebbflow.llm.tokens import default_tokenizer, memo, slices

MAGIC = b"S8B1"
HEAD = struct.Struct("<4sIIQIQII")
BLOCK = 256
FRAME_IDS = 1 << 18
FRAMES_PER_FILE = 64

# Fixed values of Simple-8b: ids per word and bits per id, by selector. Selector 0 stands here
# for an escape (one id, its place in the frame's list of escapes) and 1 for a run of zeros.
COUNTS = np.array([1, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
WIDTHS = np.array([60, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])
ESCAPE = 0


def encode(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words, first word of each block (and the end), and escaped ids of an array of ids."""
    ids = np.asarray(ids, dtype=np.uint64)
    n, blocks = len(ids), -(-len(ids) // BLOCK)
    padded = np.zeros(blocks * BLOCK + 128, dtype=np.uint64)
    padded[:n] = ids
    choice = _choice(padded[: blocks * BLOCK].reshape(blocks, BLOCK)).reshape(-1)
    words, starts = _chain(padded, choice, blocks)
    escaped = words[1][words[0] == ESCAPE]
    return _pack(padded, *words), starts, padded[escaped]


def _choice(values: np.ndarray) -> np.ndarray:
    """At each place of each block (row), the selector of most ids that fits from there on.

    The maximum over a run of ids is had from those over shorter runs; what lies past a block's
    end counts as zeros, for the reader drops it.
    """
    top = int(values.max()) if values.size else 0
    most = int(COUNTS[1:].max())
    level = np.zeros((len(values), BLOCK + most), dtype=np.uint8)  # narrowest selector, less 1
    for width in WIDTHS[1:]:
        if top >> int(width):
            level[:, :BLOCK] += values >= np.uint64(1 << int(width))
    choice = np.full(values.shape, ESCAPE, dtype=np.int8)
    highest = {1: level}
    for selector in range(15, 0, -1):
        count = int(COUNTS[selector])
        if count not in highest:
            longest = max(k for k in highest if k < count)
            rest = min(k for k in highest if k >= count - longest)
            first = highest[longest]
            second = highest[rest][:, count - rest :]
            size = BLOCK + most - count
            highest[count] = np.maximum(first[:, :size], second[:, :size])
        np.copyto(choice, selector, where=highest[count][:, :BLOCK] <= selector - 1)
    return choice


def _chain(padded, choice, blocks):
    """Selector and place of every word, by block, and where each block's words begin."""
    at = np.arange(blocks, dtype=np.int64) * BLOCK
    ends, alive = at + BLOCK, np.arange(blocks)
    owners, places, selectors = [], [], []
    while len(alive):
        here = at[alive]
        selector = choice[here]
        owners.append(alive)
        places.append(here)
        selectors.append(selector)
        at[alive] = here + COUNTS[selector]
        alive = alive[at[alive] < ends[alive]]
    if not owners:
        return (np.zeros(0, np.int8), np.zeros(0, np.int64)), np.zeros(1, np.uint32)
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    counts = np.bincount(owner, minlength=blocks)
    starts = np.concatenate([[0], np.cumsum(counts)]).astype(np.uint32)
    return (np.concatenate(selectors)[order], np.concatenate(places)[order]), starts


def _pack(padded, selectors, places):
    words = selectors.astype(np.uint64) << np.uint64(60)
    rank = np.cumsum(selectors == ESCAPE) - 1
    words[selectors == ESCAPE] |= rank[selectors == ESCAPE].astype(np.uint64)
    for selector in range(2, 16):
        mine = np.flatnonzero(selectors == selector)
        count, width = int(COUNTS[selector]), int(WIDTHS[selector])
        if not len(mine):
            continue
        k = np.arange(count)
        values = padded[places[mine, None] + k]
        values[k >= (BLOCK - places[mine] % BLOCK)[:, None]] = 0
        values <<= (k * width).astype(np.uint64)
        words[mine] |= np.bitwise_or.reduce(values, axis=1)
    return words


def decode(words: np.ndarray, starts: np.ndarray, escapes: np.ndarray, n: int) -> np.ndarray:
    """The `n` ids, all blocks at once."""
    blocks = len(starts) - 1
    out = np.zeros((blocks, BLOCK + 128), dtype=np.uint64)
    selectors = (words >> np.uint64(60)).astype(np.int64)
    ends = np.concatenate([[0], np.cumsum(COUNTS[selectors])])
    owner = np.repeat(np.arange(blocks), np.diff(starts.astype(np.int64)))
    place = ends[:-1] - ends[starts[:-1].astype(np.int64)][owner] if blocks else ends[:-1]
    for selector in range(2, 16):
        mine = np.flatnonzero(selectors == selector)
        if not len(mine):
            continue
        width, k = int(WIDTHS[selector]), np.arange(COUNTS[selector])
        values = (words[mine, None] >> (k * width).astype(np.uint64)) & np.uint64((1 << width) - 1)
        out[owner[mine, None], place[mine, None] + k] = values
    mine = np.flatnonzero(selectors == ESCAPE)
    out[owner[mine], place[mine]] = escapes[(words[mine] & np.uint64((1 << 60) - 1)).astype(np.int64)]
    return out[:, :BLOCK].reshape(-1)[:n]


def frame(partition: int, number: int, before: int, docs: list[int | None], ids: list[bytes]) -> bytes:
    lengths = np.array([len(x) // 4 for x in ids], dtype="<u8")
    words, starts, escapes = encode(np.frombuffer(b"".join(ids), dtype="<u4"))
    head = HEAD.pack(
        MAGIC, partition, number, before, len(docs), int(lengths.sum()), len(words), len(escapes)
    )
    parts = [
        np.array([d or 0 for d in docs], dtype="<i8"),
        np.array([d is None for d in docs], dtype="u1"),
        lengths,
        starts.astype("<u4"),
        escapes.astype("<u8"),
        words.astype("<u8"),
    ]
    return head + b"".join(p.tobytes() for p in parts)


def frames(content: bytes) -> Iterator[dict]:
    """The frames of a file, their arrays still packed."""
    at = 0
    while at < len(content):
        magic, partition, number, before, docs, ids, words, escapes = HEAD.unpack_from(content, at)
        if magic != MAGIC:
            raise ValueError(f"no frame at byte {at}")
        blocks = -(-ids // BLOCK)
        at += HEAD.size
        found = {"partition": partition, "frame": number, "before": before, "ids": ids}
        for name, kind, count in (
            ("doc_id", "<i8", docs),
            ("null", "u1", docs),
            ("lengths", "<u8", docs),
            ("starts", "<u4", blocks + 1),
            ("escapes", "<u8", escapes),
            ("words", "<u8", words),
        ):
            found[name] = np.frombuffer(content, dtype=kind, count=count, offset=at)
            at += found[name].nbytes
        at += 1
        yield found


def write_token_ids(
    docs: DataFrame, folder: str, tokenizer: str | None = None, end_id: int = 0
) -> None:
    """Encode every whole text and write the ids, with `end_id` after each document.

    Files and the frames in them are in ascending doc_id order (nulls first; equal doc_ids by
    their place in the input). A null or empty text has the end id alone. Only doc_id and text
    are read; other columns are ignored. An empty table writes a file without frames. Ranges of
    doc_id are sampled by Spark; a repeated doc_id is split among ranges by its place. Spark's
    committer keeps one attempt of each task, so a lost executor leaves no half file.
    """
    path = tokenizer or default_tokenizer()

    def write(batches):
        from pyspark import TaskContext

        partition = TaskContext.get().partitionId()
        coder, number, before = memo(path), 0, 0
        end = np.array([end_id], dtype="<u4").tobytes()
        keys, ids, held = [], [], 0
        for batch in (part for whole in batches for part in slices(whole)):
            for key, coded in zip(
                batch.column(0).to_pylist(), coder.ids(batch.column(1).to_pylist())
            ):
                keys.append(key)
                ids.append(coded + end)
                held += len(ids[-1]) // 4
                if held >= FRAME_IDS:
                    yield _payload(frame(partition, number, before, keys, ids))
                    number, before = number + 1, before + held
                    keys, ids, held = [], [], 0
        if keys:
            yield _payload(frame(partition, number, before, keys, ids))

    ranges = (
        docs.select("doc_id", "text", F.monotonically_increasing_id().alias("_at"))
        .repartitionByRange("doc_id", "_at")
        .sortWithinPartitions("doc_id", "_at")
        .select(F.col("doc_id").cast("long"), "text")
    )
    packed = ranges.mapInArrow(write, "payload binary").select(
        F.col("payload").cast("string").alias("value")
    )
    # The text sink puts the bytes as they are and a line feed after each row.
    packed.write.option("maxRecordsPerFile", FRAMES_PER_FILE).text(folder)


def _payload(data: bytes) -> pa.RecordBatch:
    return pa.record_batch([pa.array([data], type=pa.binary())], names=["payload"])


def read_token_ids(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids (little-endian u32 bytes).

    A file (at most 64 frames of about 262,144 ids, unless one document is larger) is one row.
    A first look at the frame heads gives each partition's count of ids.
    """
    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder).select("content")
    )

    def totals(batches):
        for batch in batches:
            for content in batch.column(0):
                heads = [(f["partition"], f["before"] + f["ids"]) for f in frames(content.as_py())]
                yield pa.record_batch(
                    [pa.array([h[i] for h in heads], type=pa.int64()) for i in (0, 1)],
                    names=["partition", "ids_so_far"],
                )

    def documents(batches):
        for batch in batches:
            for content in batch.column(0):
                for f in frames(content.as_py()):
                    yield _documents(f)

    sums = files.mapInArrow(totals, "partition long, ids_so_far long")
    # One row for each written partition: a window over all of them is small.
    first = (
        sums.groupBy("partition")
        .agg(F.max("ids_so_far").alias("_ids"))
        .select(
            "partition",
            F.coalesce(
                F.sum("_ids").over(
                    Window.orderBy("partition").rowsBetween(Window.unboundedPreceding, -1)
                ),
                F.lit(0),
            ).alias("_first"),
        )
    )
    rows = files.mapInArrow(
        documents, "partition long, doc_id long, _before long, n_tokens long, ids binary"
    )
    return rows.join(small(first), "partition").select(
        "doc_id", (F.col("_first") + F.col("_before")).alias("start"), "n_tokens", "ids"
    )


def _documents(f: dict) -> pa.RecordBatch:
    ids = decode(f["words"], f["starts"], f["escapes"], f["ids"]).astype("<u4").tobytes()
    ends = np.cumsum(f["lengths"].astype(np.int64))
    begins = ends - f["lengths"].astype(np.int64)
    n = len(ends)
    return pa.record_batch(
        [
            pa.array(np.full(n, f["partition"], dtype=np.int64)),
            pa.array(f["doc_id"], mask=f["null"].astype(bool)),
            pa.array(begins + f["before"]),
            pa.array(f["lengths"].astype(np.int64)),
            pa.array([ids[4 * a : 4 * b] for a, b in zip(begins, ends)], type=pa.binary()),
        ],
        names=["partition", "doc_id", "_before", "n_tokens", "ids"],
    )
