"""Repeated passages by content-defined chunking with a gear rolling hash (operator 8).

A gear hash of the last 16 bytes is rolled over the text; where it falls below a bound at the end
of a word, a chunk may end, unless the word before could end one too. All of this looks at a few
words only, so after an insertion the same chunks come back. Chunks with the same digest in
several documents belong to the document with the least doc_id; elsewhere they are repeats.
Repeats that follow one another make a span. A span counts if enough of its words belong to one
and the same other document: chance repeats of a few words and short lines do not add up.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ebbflow.llm.secrets import redacted

GEAR_BYTES = 16
CUT = 0.3  # share of word ends where a chunk may end
MIN_WORDS = 16  # words of a span that one document must own
LONG_WORD = 64  # bytes without white space after which a chunk may end at any character

# One random number for each byte, by a rule.
GEAR = np.random.RandomState(20_240_611).randint(0, 1 << 32, 256, dtype=np.uint64).astype(np.uint32)
SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def rolling(data: np.ndarray) -> np.ndarray:
    """Gear hash of the last 16 bytes at each place, by doubling the span four times."""
    h = GEAR[data]
    span = 1
    while span < GEAR_BYTES:
        h[span:] += h[:-span] << np.uint32(span)
        span *= 2
    return h


def chunks(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
    """First code point, code points, words and bytes of each chunk; they join to the text."""
    raw = text.encode("utf-8", "surrogatepass")
    if not raw:
        none = np.zeros(0, dtype=np.int64)
        return none, none, none, []
    data = np.frombuffer(raw, dtype=np.uint8)
    space = SPACE[data]
    starts_char = (data & 0xC0) != 0x80
    next_visible = np.append(~space[1:], True)
    low = rolling(data) < np.uint32(int(CUT * (1 << 32)))
    word_end = np.flatnonzero(space & next_visible)
    may = low[word_end]
    may[1:] &= ~low[word_end[:-1]]
    ends = word_end[may]
    last_space = np.maximum.accumulate(np.where(space, np.arange(len(data)), -1))
    stretch = np.arange(len(data)) - last_space >= LONG_WORD
    if stretch.any():
        char_end = np.append(starts_char[1:], True)
        rare = rolling(data) < np.uint32((1 << 32) // 32)
        ends = np.union1d(ends, np.flatnonzero(stretch & char_end & rare))
    ends = ends + 1
    if not len(ends) or ends[-1] != len(data):
        ends = np.append(ends, len(data))
    begins = np.append(0, ends[:-1])
    points = np.append(0, np.cumsum(starts_char))
    word_starts = np.append(0, np.cumsum(~space & np.append(True, space[:-1])))
    sizes = points[ends] - points[begins]
    n_words = np.maximum(word_starts[ends] - word_starts[begins], sizes // 16)
    return points[begins], sizes, n_words, [raw[a:b] for a, b in zip(begins, ends)]


CHUNK = "digest long, doc_id long, place long, extent long"


def digests(docs: DataFrame) -> DataFrame:
    """One narrow row for each chunk: digest, doc_id, place (16 bits of the text's hash, first
    code point) and extent (code points, words)."""

    def work(batches):
        from xxhash import xxh3_64_intdigest, xxh32_intdigest

        for batch in batches:
            parts = []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                start, size, n_words, pieces = chunks(text or "")
                if key is None or not len(start):
                    continue
                part = xxh32_intdigest(text.encode("utf-8", "surrogatepass")) & 0xFFFF
                digest = np.fromiter(map(xxh3_64_intdigest, pieces), dtype=np.uint64, count=len(pieces))
                parts.append(
                    (
                        digest.view(np.int64),
                        np.full(len(start), key, dtype=np.int64),
                        (part << 40) | start,
                        (size << 24) | np.minimum(n_words, (1 << 24) - 1),
                    )
                )
            if parts:
                columns = [pa.array(np.concatenate(c)) for c in zip(*parts)]
                yield pa.record_batch(columns, names=["digest", "doc_id", "place", "extent"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(work, CHUNK)


def repeats(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, text_part, start, stop (code points, stop exclusive), n_words, kept_doc_id,
    kept_words: each repeated span outside the document that keeps it.

    The owner of a chunk is the least doc_id that has it; kept_doc_id owns most of the span's
    words, at least `min_words`. Rows that share a doc_id are one document, told apart by
    text_part (16 bits of the text's hash) only for their places; rows without doc_id neither
    own nor are reported; null and empty texts have no chunks. Other columns are ignored.
    A passage that half of all documents hold is one sum per task before the shuffle, and its
    rows meet its owner in a join that adaptive execution can split.
    """
    chunk = digests(docs)
    owners = (
        chunk.groupBy("digest")
        .agg(F.min("doc_id").alias("owner"), F.max("doc_id").alias("last"))
        .where("owner < last")
        .select("digest", "owner")
    )
    start = F.col("place").bitwiseAND((1 << 40) - 1)
    repeated = (
        chunk.join(owners, "digest")
        .where("doc_id > owner")
        .select(
            "doc_id",
            F.shiftright("place", 40).cast("int").alias("text_part"),
            start.alias("start"),
            (start + F.shiftright("extent", 24)).alias("stop"),
            F.col("extent").bitwiseAND((1 << 24) - 1).alias("words"),
            "owner",
        )
        .distinct()
    )
    inside = Window.partitionBy("doc_id", "text_part").orderBy("start")
    fresh = F.coalesce(F.lag("stop").over(inside) != F.col("start"), F.lit(True)).cast("int")
    runs = repeated.withColumn("fresh", fresh).withColumn("run", F.sum("fresh").over(inside))
    by_owner = runs.groupBy("doc_id", "text_part", "run", "owner").agg(
        F.min("start").alias("start"), F.max("stop").alias("stop"), F.sum("words").alias("words")
    )
    spans = by_owner.groupBy("doc_id", "text_part", "run").agg(
        F.min("start").alias("start"),
        F.max("stop").alias("stop"),
        F.sum("words").alias("n_words"),
        F.max_by("owner", F.struct("words", -F.col("owner"))).alias("kept_doc_id"),
        F.max("words").alias("kept_words"),
    )
    return spans.where(F.col("kept_words") >= min_words).drop("run")


def without_repeats(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """`docs` with the spans of `repeats` cut out of their texts; rows are kept, also empty ones.

    Documents without a span are as they were. The join is on doc_id; a document is its own
    group, so no group is larger than its text.
    """
    span = F.struct(F.col("start").cast("int").alias("start"), F.col("stop").cast("int").alias("stop"))
    own = spans.groupBy("doc_id").agg(F.array_sort(F.collect_set(span)).alias("_spans"))
    cut = redacted(F.col("text"), F.col("_spans"), "")
    return docs.join(own, "doc_id", "left").withColumn(
        "text", F.when(F.col("_spans").isNull(), F.col("text")).otherwise(cut)
    ).drop("_spans")
