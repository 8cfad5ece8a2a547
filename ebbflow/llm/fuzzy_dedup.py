"""Near duplicates by SimHash and Golay-code fuzzy keys (operator 4).

A text's fingerprint has 64 bits, one vote of all its word shingles each. Two texts are linked
if their fingerprints differ in at most two bits. The links are found without comparing all:

* The fingerprint is cut into three segments. Two errors leave at least one segment whole, and
  the segment after it has at most two errors.
* The binary Golay code (23, 12) is perfect: every 23-bit word lies within three bits of exactly
  one codeword. A word's fuzzy keys are the codewords nearest to it and to its 23 neighbours
  (one to six of them). Two words at most two bits apart have a neighbour in common, or are
  neighbours, so they share a key.
* A key of the join is a whole segment with one fuzzy key of the next. Any two fingerprints
  within two bits meet in such a key; then their distance is verified.

A key that many fingerprints share (a family of near copies) would give all their pairs. Their
fingerprints are linked by common neighbours instead: two fingerprints are within two bits if
and only if some 64-bit word lies within one bit of both, and no word is near more than 65.
"""

from __future__ import annotations

from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ebbflow.session import settled

SEED = 42
SHINGLE = 3
BUCKET = 16  # fingerprints of a key that are compared one by one

# Fixed values of the code: its generator x^11+x^10+x^6+x^5+x^4+x^2+1, and the cut of 64 bits.
GENERATOR = 0b110001110101
BITS, PARITY = 23, 11
SEGMENTS = [(0, 22), (22, 21), (43, 21)]  # first bit, bits; padded with zeros to 23

LANES = np.uint64(0x0001000100010001)
LANE_ROWS = 65_000  # votes that a lane of 16 bits can count


def _remainder(word: int) -> int:
    for bit in range(BITS - 1, PARITY - 1, -1):
        if word >> bit & 1:
            word ^= GENERATOR << (bit - PARITY)
    return word


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """The syndrome of each 12-bit and 11-bit half, and the error that each syndrome means."""
    halves = np.zeros((2, 1 << 12), dtype=np.int64)
    for half in range(2):
        for value in range(1 << (12 - half)):
            halves[half, value] = _remainder(value << (12 * half))
    errors = np.zeros(1 << PARITY, dtype=np.int64)
    for weight in range(4):
        for bits in combinations(range(BITS), weight):
            error = sum(1 << b for b in bits)
            errors[_remainder(error)] = error
    return halves, errors


HALVES, ERRORS = _tables()


def nearest_codeword(words: np.ndarray) -> np.ndarray:
    """The 12 information bits of the codeword within three bits of each 23-bit word."""
    syndromes = HALVES[0][words & 0xFFF] ^ HALVES[1][words >> 12]
    return (words ^ ERRORS[syndromes]) >> PARITY


def fuzzy_keys(words: np.ndarray) -> np.ndarray:
    """One row of 24 for each word: its keys in order, repeats marked -1."""
    flips = np.concatenate([[0], 1 << np.arange(BITS)])
    keys = np.sort(nearest_codeword(words[:, None] ^ flips), axis=1)
    keys[:, 1:][keys[:, 1:] == keys[:, :-1]] = -1
    return keys


def join_keys(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the fingerprints and their join keys: segment number, whole segment, fuzzy key."""
    parts = [((prints >> np.uint64(at)) & np.uint64((1 << n) - 1)).astype(np.int64) for at, n in SEGMENTS]
    rows, keys = [], []
    for number, whole in enumerate(parts):
        fuzzy = fuzzy_keys(parts[(number + 1) % 3])
        row, column = np.nonzero(fuzzy >= 0)
        rows.append(row)
        keys.append((number << 34) | (whole[row] << 12) | fuzzy[row, column])
    return np.concatenate(rows), np.concatenate(keys)


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """SimHash of the text's word shingles; 0 without words."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if len(words) > shingle:
        grams = list(map(b" ".join, zip(*(words[i:] for i in range(shingle)))))
    elif words:
        grams = [b" ".join(words)]
    else:
        return 0
    hashes = np.fromiter(map(xxh64_intdigest, grams, repeat(SEED)), dtype=np.uint64, count=len(grams))
    votes = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), LANE_ROWS):
        chunk = hashes[at : at + LANE_ROWS]
        for k in range(16):
            lanes = int(((chunk >> np.uint64(k)) & LANES).sum())
            for lane in range(4):
                votes[k + 16 * lane] += lanes >> (16 * lane) & 0xFFFF
    return int(sum(1 << b for b in range(64) if 2 * votes[b] > len(hashes)))


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, text_key (XXH64 of the text) and fingerprint as longs, in one pass over whole texts."""

    def work(batches):
        for batch in batches:
            prints = np.array([fingerprint(t) for t in batch.column(1).to_pylist()], dtype=np.uint64)
            yield pa.record_batch(
                [batch.column(0), batch.column(2), pa.array(prints.view(np.int64))],
                names=["doc_id", "text_key", "fingerprint"],
            )

    narrow = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("text_key"))
    return narrow.mapInArrow(work, "doc_id long, text_key long, fingerprint long")


def links(prints: DataFrame) -> DataFrame:
    """Pairs u < v of different fingerprints that connect all within two bits of one another.

    Few fingerprints under a key: every pair within two bits. Many: each is linked to the least
    of those that share a neighbour with it, which connects the same ones.
    """

    def keyed(batches):
        for batch in batches:
            values = batch.column(0).to_numpy()
            row, keys = join_keys(values.view(np.uint64))
            yield pa.record_batch([pa.array(keys), pa.array(values[row])], names=["key", "fingerprint"])

    keys = prints.select("fingerprint").mapInArrow(keyed, "key long, fingerprint long")
    sizes = keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    shared = settled(keys.join(sizes, "key"))
    few = shared.where(F.col("n") <= BUCKET)
    distance = F.bit_count(F.col("u").bitwiseXOR(F.col("v")))
    near = (
        few.select("key", F.col("fingerprint").alias("u"))
        .join(few.select("key", F.col("fingerprint").alias("v")), "key")
        .where(F.col("u") < F.col("v"))
        .where(distance <= 2)
        .select("u", "v")
    )

    def neighbours(batches):
        flips = np.concatenate([[np.uint64(0)], np.uint64(1) << np.arange(64, dtype=np.uint64)])
        for batch in batches:
            values = batch.column(0).to_numpy()
            around = (values.view(np.uint64)[:, None] ^ flips).view(np.int64)
            yield pa.record_batch(
                [pa.array(around.reshape(-1)), pa.array(np.repeat(values, 65))],
                names=["middle", "fingerprint"],
            )

    many = shared.where(F.col("n") > BUCKET).select("fingerprint").distinct()
    around = many.mapInArrow(neighbours, "middle long, fingerprint long")
    stars = (  # at most 65 fingerprints around a word
        around.groupBy("middle")
        .agg(F.collect_set("fingerprint").alias("all"))
        .where(F.size("all") > 1)
        .select(F.array_min("all").alias("u"), F.explode("all").alias("v"))
        .where(F.col("u") < F.col("v"))
    )
    return near.union(stars).distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, component (its least node) of every node of an edge list u, v.

    Large and small stars in turn: neighbours above a node, then those below, are moved to the
    least one met, until nothing changes; rounds grow with the logarithm of the size. Only
    minima are aggregated, never lists of neighbours; a busy node is a skewed join, which
    adaptive execution splits. Each round is stored in the shared folder.
    """

    def state(df):
        return df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    # u > v from here on
    now = settled(
        edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    )
    before = state(now)
    while before[0]:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(least, "u")
            .select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
            .where("u <> v")
            .distinct()
        )
        now = settled(small)
        after = state(now)
        if after == before:
            break
        before = after
    rooted = now.groupBy("u").agg(F.min("v").alias("component"))
    return rooted.select(F.col("u").alias("node"), "component").union(
        rooted.select(F.col("component").alias("node"), "component").distinct()
    )


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, fingerprint (longs), component, component_id: one row for each document.

    component is a number of the group, its least fingerprint.
    component_id is the least doc_id that can be reached over fingerprints at most two bits
    apart, the row's own included. A null, empty or blank text has fingerprint 0 and is linked
    like any other; repeated rows are kept and share a component; a null doc_id is linked but
    names a component only as null, when all its doc_ids are null. Only doc_id and text are
    read. Equal fingerprints count once in the search, so thousands of copies cost one row.
    """
    rows = settled(fingerprints(docs))
    prints = settled(rows.groupBy("fingerprint").agg(F.min("doc_id").alias("least")))
    member = components(links(prints)).withColumnRenamed("node", "fingerprint")
    linked = prints.join(member, "fingerprint", "left").select(
        "fingerprint", "least", F.coalesce("component", "fingerprint").alias("component")
    )
    names = linked.groupBy("component").agg(F.min("least").alias("component_id"))
    named = linked.join(names, "component").select("fingerprint", "component", "component_id")
    return rows.join(named, "fingerprint").select(
        "doc_id", "text_key", "fingerprint", "component", "component_id"
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """`docs` with one row of each group of near duplicates: the one with the least doc_id (a
    null comes last; of rows that share it, the text and then the other columns decide), columns
    as they were. An empty table stays empty."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key"))
    kept = near_duplicates(docs).groupBy("component").agg(first.alias("k")).select(
        F.col("k.doc_id").alias("doc_id"), F.col("k.text_key").alias("text_key")
    )
    rows = docs.select(
        F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("key"), F.struct("*").alias("row")
    )
    same = F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("key") == F.col("text_key"))
    least = rows.join(kept, same, "left_semi").groupBy("id", "key").agg(F.min("row").alias("row"))
    return least.select("row.*")
