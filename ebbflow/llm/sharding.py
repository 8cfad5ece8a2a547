"""Jump consistent hashing of rows to shards, in column expressions only (operator 2).

The jump hash walks from shard to shard with a linear congruential generator seeded by the key;
the last shard below the count is the row's. With one more shard a row either stays or goes to
the new one. No ring table is kept: the key and the count say it all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import IntegralType

from ebbflow.llm.common import let, numbered

# Fixed values of the published algorithm: the generator's multiplier, in halves of 32 bits.
MULTIPLIER = 2862933555777941757
HIGH, LOW = MULTIPLIER >> 32, MULTIPLIER & 0xFFFFFFFF
MASK = 0xFFFFFFFF
SHORT_WALK = 64


def _step(state: Column) -> Column:
    """key * MULTIPLIER + 1 modulo 2**64 on two halves of 32 bits (a long product would
    overflow, an error in ANSI mode), then the next shard to jump to."""
    low0, low1 = LOW & 0xFFFF, LOW >> 16
    high, low, at = state["high"], state["low"], state["next"]
    part = low * F.lit(low1)
    total = low * F.lit(low0) + F.shiftleft(part.bitwiseAND(0xFFFF), 16) + 1
    carry = F.shiftright(total, 32) + F.shiftright(part, 16)

    def times(a: Column, b: int) -> Column:  # modulo 2**32
        return a * F.lit(b & 0xFFFF) + F.shiftleft((a * F.lit(b >> 16)).bitwiseAND(0xFFFF), 16)

    new_high = (carry + times(high, LOW) + times(low, HIGH)).bitwiseAND(MASK)
    span = F.shiftright(new_high, 1) + 1
    jump = F.floor((at + 1) * (F.lit(float(1 << 31)) / span))
    return F.struct(
        at.alias("last"),
        jump.alias("next"),
        new_high.alias("high"),
        total.bitwiseAND(MASK).alias("low"),
    )


def jump_hash(key: Column, shards: int) -> Column:
    """The shard, 0 to `shards` - 1, of a 64-bit key.

    A walk takes about ln(shards) steps and never more than `shards`: 64 steps are tried, and
    only a key that is still under way goes on with as many as there are shards.
    """
    if shards < 1:
        raise ValueError("shards must be at least 1")
    start = F.struct(
        F.lit(-1).cast("long").alias("last"),
        F.lit(0).cast("long").alias("next"),
        F.shiftrightunsigned(key, 32).alias("high"),
        key.bitwiseAND(MASK).alias("low"),
    )

    def walk(state: Column, steps: int) -> Column:
        return F.aggregate(
            F.sequence(F.lit(1), F.lit(steps)),
            state,
            lambda s, _: F.when(s["next"] < shards, _step(s)).otherwise(s),
        )

    if shards <= SHORT_WALK:
        return walk(start, shards)["last"].cast("int")
    return let(
        walk(start, SHORT_WALK),
        lambda s: F.when(s["next"] >= shards, s["last"]).otherwise(walk(s, shards)["last"]),
    ).cast("int")


def stable_key(df: DataFrame, columns: list[str]) -> Column:
    """One whole-number column as it is, anything else as its XXH64; a null counts as 0."""
    kinds = [df.schema[c].dataType for c in columns]
    if len(columns) == 1 and isinstance(kinds[0], IntegralType):
        return F.coalesce(F.col(columns[0]).cast("long"), F.lit(0).cast("long"))
    return F.xxhash64(*columns)


def shard(
    df: DataFrame, key: list[str], shards: int, order: list[str] | None = None
) -> DataFrame:
    """`df` with shard, slot (gapless from 0 within the shard, by `order` or the key) and
    grown_shard (the shard if there were one more).

    Equal keys share a shard; a null key is key 0 (one column) or has the hash of a null. Rows
    that are equal in `order` are numbered by their place in the input. A table without rows
    gives none. Columns named shard, slot and grown_shard are replaced. Give narrow rows: the
    numbering shuffles them; no task ever holds a whole shard.
    """
    key_column = stable_key(df, key)
    placed = df.withColumns(
        {
            "shard": jump_hash(key_column, shards),
            "grown_shard": jump_hash(key_column, shards + 1),
        }
    )
    return numbered(placed.drop("slot"), ["shard"], order or key)
