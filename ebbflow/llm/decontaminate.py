"""Benchmark decontamination by SimHash of item-sized windows (operator 3), column expressions only.

A window of a document is a run of as many word shingles as a benchmark item has. It is a leak
if its weighted (repeats counted) Jaccard similarity with the item is at least the threshold.

1. Windows worth a look. Both sides have n shingles, so similarity s needs at least
   2 s n / (1 + s) of them in common. A bit map of the items' shingles (a fixed number of bits,
   whatever the corpus) finds the places of a document whose shingle may belong to an item of
   n shingles; only windows with enough such places are kept. The bit map has false hits but
   misses none. So nearly all documents end here, in the scan, without a shuffle.
2. Each window and each item gets a 64-bit SimHash. Cut into radius + 1 blocks, two fingerprints
   within the radius agree in a block; windows and items are joined on size, block and value.
3. The pairs within the radius are verified by the exact similarity.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, functions as F

from ebbflow.llm.common import indices, let

SHINGLE = 5
SIMILARITY = 0.8
# At similarity 0.8 two fingerprints differ in about 10 bits of 64, with a deviation of 3.
RADIUS = 22
MAX_BITS = 1 << 20


def words(text: Column) -> Column:
    """Runs of letters and digits, in lower case."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def shingles(tokens: Column, k: int) -> Column:
    """XXH64 of each run of k words, repeats kept."""

    def runs(h: Column) -> Column:
        return F.transform(
            indices(F.lit(0), F.size(h) - (k - 1)), lambda i: F.xxhash64(*(F.get(h, i + j) for j in range(k)))
        )

    return let(F.transform(tokens, lambda w: F.xxhash64(w)), runs)


def simhash(grams: Column) -> Column:
    """Bit b is set if more than half of the shingles have it."""

    def bit(b: Column) -> Column:
        votes = F.aggregate(grams, F.lit(0), lambda n, g: n + F.getbit(g, b).cast("int"))
        return F.when(votes * 2 > F.size(grams), F.call_function("shiftleft", F.lit(1).cast("long"), b)).otherwise(
            F.lit(0).cast("long")
        )

    bits = F.transform(F.sequence(F.lit(0), F.lit(63)), bit)
    return F.aggregate(bits, F.lit(0).cast("long"), lambda a, x: a.bitwiseOR(x))


def blocks(radius: int) -> list[tuple[int, int]]:
    """First bit and width of radius + 1 blocks that cut 64 bits as evenly as possible."""
    n = radius + 1
    edges = [64 * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def _block_values(print_: Column, radius: int) -> Column:
    return F.array(
        *(F.shiftrightunsigned(print_, at).bitwiseAND((1 << width) - 1) for at, width in blocks(radius))
    )


def similarity(a: Column, b: Column) -> Column:
    """Weighted Jaccard of two non-empty lists of shingles."""

    def of(common: Column) -> Column:
        return common / (F.size(a) + F.size(b) - common)

    plain = (F.size(F.array_distinct(a)) == F.size(a)) & (F.size(F.array_distinct(b)) == F.size(b))

    def times(x: Column, g: Column) -> Column:
        return F.size(F.filter(x, lambda y: y == g))

    counted = F.aggregate(
        F.array_distinct(F.array_intersect(a, b)),
        F.lit(0),
        lambda n, g: n + F.least(times(a, g), times(b, g)),
    )
    return of(F.when(plain, F.size(F.array_intersect(a, b))).otherwise(counted))


def needed(n: int, threshold: float) -> int:
    """Shingles in common without which two lists of n cannot reach the threshold."""
    return max(1, math.ceil(2 * threshold * n / (1 + threshold) - 1e-9))


class BitMap:
    """Membership of shingles by size of item, in a literal of at most MAX_BITS bits."""

    def __init__(self, keys: DataFrame, column: str, count: int):
        self.bits = 1 << 10
        while self.bits < min(32 * count, MAX_BITS):
            self.bits *= 2
        slot = self._slot(F.col(column))
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), slot.bitwiseAND(63).cast("int"))
        cells = keys.select(F.shiftright(slot, 6).alias("cell"), bit.alias("bit"))
        filled = {r["cell"]: r["v"] for r in cells.groupBy("cell").agg(F.bit_or("bit").alias("v")).collect()}
        text = ",".join(str(filled.get(i, 0)) for i in range(self.bits // 64))
        self.cells = F.split(F.lit(text), ",").cast("array<bigint>")

    def _slot(self, key: Column) -> Column:
        return F.shiftrightunsigned(key, 20).bitwiseAND(self.bits - 1)

    def has(self, key: Column) -> Column:
        slot = self._slot(key)
        return F.getbit(F.get(self.cells, F.shiftright(slot, 6).cast("int")), slot.bitwiseAND(63).cast("int")) == 1


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    threshold: float = SIMILARITY,
    radius: int = RADIUS,
    shingle: int = SHINGLE,
) -> DataFrame:
    """doc_id, text_key (XXH64 of the text), item_id, start_word, n_words, similarity, distance:
    for each document and item the best window at or above the threshold, the first if equal.

    Items with fewer words than a shingle are one shingle of all their words; items without
    words never match. Null or empty texts have no windows. Repeated rows give one result; a
    null doc_id is kept and told apart by its text. Other columns are ignored. An empty table
    on either side gives no rows. Work on the driver: the distinct sizes of items, and the bit
    map, whose size is bounded.
    """
    items = benchmark.select("item_id", words(F.col("text")).alias("w")).where(F.size("w") > 0)
    items = items.select("item_id", F.size("w").alias("n_words"), "w")
    sizes = sorted(r["n_words"] for r in items.select("n_words").distinct().collect())
    parts = []
    for k in sorted({min(shingle, n) for n in sizes}):
        mine = [n for n in sizes if min(shingle, n) == k]
        parts.append(_leaks_of(docs, items, k, mine, threshold, radius))
    if not parts:
        return docs.sparkSession.createDataFrame([], RESULT)
    found = parts[0]
    for part in parts[1:]:
        found = found.union(part)
    best = F.max_by(
        F.struct("start_word", "n_words", "similarity", "distance"), F.struct("similarity", -F.col("start_word"))
    )
    return (
        found.groupBy("doc_id", "text_key", "item_id")
        .agg(best.alias("b"))
        .select("doc_id", "text_key", "item_id", "b.*")
    )


RESULT = (
    "doc_id long, text_key long, item_id long, start_word int, n_words int, similarity double, distance int"
)


def _leaks_of(docs, items, k, sizes, threshold, radius) -> DataFrame:
    """Leaks of the items whose shingles have k words."""
    items = items.where(F.col("n_words").isin(sizes)).select(
        "item_id", "n_words", shingles(F.col("w"), k).alias("grams")
    )
    keyed = items.select("n_words", F.explode("grams").alias("g")).distinct()
    any_size = keyed.select("g").distinct()
    some = BitMap(any_size, "g", any_size.count())
    by_size = keyed.select(F.xxhash64("g", "n_words").alias("g"))
    exact = BitMap(by_size, "g", by_size.count())
    # for each size of item: its words, its shingles, and how many of them a window needs
    facts = [(n, n - k + 1, needed(n - k + 1, threshold)) for n in sizes]
    least = min(need for _, _, need in facts)
    text = json.dumps([dict(zip(("words", "size", "need"), f)) for f in facts])
    of_size = F.from_json(F.lit(text), "array<struct<words:int,size:int,need:int>>")

    def hits(grams: Column) -> Column:
        return F.filter(indices(F.lit(0), F.size(grams)), lambda i: some.has(F.get(grams, i)))

    def windows(grams: Column, places: Column, item: Column) -> Column:
        """First shingles of the windows with enough places of this size."""
        size, need = item["size"], item["need"]

        def spread(mine: Column) -> Column:
            last = lambda j: F.get(mine, j + (need - 1))
            close = F.filter(
                indices(F.lit(0), F.size(mine) - (need - 1)), lambda j: last(j) - F.get(mine, j) < size
            )
            starts = F.transform(
                close,
                lambda j: indices(
                    F.greatest(F.lit(0), last(j) - (size - 1)),
                    F.least(F.get(mine, j), F.size(grams) - size) + 1,
                ),
            )
            return F.transform(
                F.array_distinct(F.flatten(starts)),
                lambda s: F.struct(s.alias("start"), item["words"].alias("n_words")),
            )

        of_item = F.filter(places, lambda i: exact.has(F.xxhash64(F.get(grams, i), item["words"])))
        return let(of_item, spread)

    def found(text: Column) -> Column:
        """The windows of a text, each with its shingles."""

        def with_grams(grams: Column) -> Column:
            def with_places(places: Column) -> Column:
                every = F.flatten(F.transform(of_size, lambda item: windows(grams, places, item)))
                return F.when(
                    F.size(places) >= least,
                    F.transform(
                        every,
                        lambda w: F.struct(
                            w["start"].alias("start"),
                            w["n_words"].alias("n_words"),
                            F.slice(grams, w["start"] + 1, w["n_words"] - (k - 1)).alias("grams"),
                        ),
                    ),
                )

            return let(hits(grams), with_places)

        return let(shingles(words(text), k), with_grams)

    looked = (
        docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_key"), found(F.col("text")).alias("ws"))
        .select("doc_id", "text_key", F.explode("ws").alias("w"))
        .select("doc_id", "text_key", "w.*")
        .withColumn("print", let(F.col("grams"), simhash))
    )
    left = looked.select("*", F.posexplode(_block_values(F.col("print"), radius)).alias("block", "value"))
    right = items.withColumn("item_print", let(F.col("grams"), simhash)).select(
        "item_id",
        "n_words",
        F.col("grams").alias("item_grams"),
        "item_print",
        F.posexplode(_block_values(F.col("item_print"), radius)).alias("block", "value"),
    )
    differing = F.col("print").bitwiseXOR(F.col("item_print"))
    first_equal = F.array_position(
        F.transform(_block_values(differing, radius), lambda v: v == 0), True
    ) == F.col("block") + 1
    near = (
        left.join(right, ["n_words", "block", "value"])
        .where(F.bit_count(differing) <= radius)
        .where(first_equal)  # a pair that agrees in several blocks counts once
    )
    scored = near.withColumn("similarity", similarity(F.col("grams"), F.col("item_grams")))
    return scored.where(F.col("similarity") >= threshold).select(
        "doc_id",
        "text_key",
        "item_id",
        F.col("start").alias("start_word"),
        "n_words",
        "similarity",
        F.bit_count(differing).alias("distance"),
    )


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """`docs` without the documents that hold a benchmark passage, columns as they were."""
    found = leaks(docs, benchmark).select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).distinct()
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_key"))
    return docs.join(found, same, "left_anti")
