"""Session settings the library is written for, and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that matter for the plans in this package:
#  * AQE coalesces small shuffle partitions, splits skewed join partitions and
#    turns a shuffle join into a broadcast one once a side is measured small;
#  * the broadcast threshold is the only thing that lets a table be broadcast:
#    no operator forces it on a table whose size is not known;
#  * dates carry no time zone, so the session clock is pinned to UTC.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(app: str = "ebbflow", master: str | None = None, **extra) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """A fresh folder under the cluster's shared `spark.checkpoint.dir`.

    A machine-local folder is used only by a local master, where there is no
    other machine; on a cluster a missing setting is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="ebbflow-")
    return f"{root.rstrip('/')}/ebbflow-{uuid.uuid4().hex}"


def settled(df: DataFrame) -> DataFrame:
    """The table written to the shared folder and read back: same values at every read."""
    path = shared_dir(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
