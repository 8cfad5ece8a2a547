"""Operator 2 against the published loop in Python integers."""

from cases import ROWS
from pyspark.sql import functions as F

from ebbflow.llm import sharding


def jump(key, shards):
    last, at = -1, 0
    key &= (1 << 64) - 1
    while at < shards:
        last = at
        key = (key * 2862933555777941757 + 1) & ((1 << 64) - 1)
        at = int((last + 1) * (float(1 << 31) / ((key >> 33) + 1)))
    return last


def test_walk_equals_the_published_one(spark):
    keys = [0, 1, -1, 10, 2**63 - 1, -(2**63), *range(1000, 1300)]
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    for shards in (1, 2, 8, 9, 64, 1000):
        got = {r.k: r.s for r in df.select("k", sharding.jump_hash(F.col("k"), shards).alias("s")).collect()}
        assert got == {k: jump(k, shards) for k in keys}


def test_slots_are_gapless_and_growth_moves_to_the_new_shard_only(spark, docs, none):
    rows = sharding.shard(docs.select("doc_id", "text", "slot"), ["doc_id"], 3).collect()
    assert len(rows) == len(ROWS)
    for shard in range(3):
        mine = sorted(r.slot for r in rows if r["shard"] == shard)
        assert mine == list(range(len(mine)))
    assert all(r["shard"] == jump(r.doc_id or 0, 3) for r in rows)
    assert all(r.grown_shard in (r["shard"], 3) for r in rows)
    order = [(r.slot, r.doc_id) for r in rows if r["shard"] == rows[0]["shard"] and r.doc_id is not None]
    assert [d for _, d in sorted(order)] == sorted(d for _, d in order)
    assert sharding.shard(none.select("doc_id"), ["doc_id"], 8).count() == 0
    text = sharding.shard(docs.select("doc_id", "text"), ["text"], 8, ["doc_id"]).collect()
    assert len({r["shard"] for r in text if r.text and r.text.startswith("The quick")}) == 1
