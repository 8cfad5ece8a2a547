"""Incremental ingest of the movement and population feeds: every file once, whatever is lost.

A batch writes its additive sums to a folder of its own and publishes it together with the list
of the files it was made of (`sources.published`). A file that the table already holds is left
out, so a batch that is replayed, or a whole run after a lost checkpoint, adds nothing twice; a
batch that dies before it publishes has added nothing. A file whose content changed after it
was taken fails, since its sums can no longer be told apart. `compact` merges the folders of
each month into one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StructType

from ebbflow.contracts import require_columns
from ebbflow.joins import small
from ebbflow.operators import population, mobility
from ebbflow.sources.published import FileChanged, MonthTable, entry

FILE = ["_file", "_modified"]


def stream_files(
    spark: SparkSession, path: str, schema: StructType, fmt: str = "csv", pattern: str = "*", **options
) -> DataFrame:
    """The feed, each row with the file it came in and when that file was last changed."""
    feed = (
        spark.readStream.schema(schema)
        .format(fmt)
        .options(**options)
        .option("pathGlobFilter", pattern)
        .load(path)
    )
    return feed.select(
        "*",
        F.col("_metadata.file_path").alias(FILE[0]),
        F.col("_metadata.file_modification_time").cast("string").alias(FILE[1]),
    )


def _ingest(
    feed: DataFrame,
    to_sums: Callable[[DataFrame], DataFrame],
    order: list[str],
    value: str,
    output: str,
    checkpoint: str,
) -> None:
    """Take every file that arrived since the last run, then stop."""
    require_columns(feed, FILE, "feed")

    def write(batch: DataFrame, batch_id: int) -> None:
        take(batch, to_sums, order, value, output)

    query = (
        feed.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def take(
    batch: DataFrame,
    to_sums: Callable[[DataFrame], DataFrame],
    order: list[str],
    value: str,
    output: str,
) -> None:
    """Add the batch's new files to the table; the batch is read once."""
    spark = batch.sparkSession
    table = MonthTable(spark, output)
    versions = table.versions()
    held = table.files()
    known = spark.createDataFrame(sorted(held.items()), "path string, modified string")
    seen = Observation()
    # One short text for each file of the batch comes to the driver.
    named = F.concat_ws("\n", *FILE[::-1])
    watched = batch.observe(seen, F.collect_set(named).alias("files"))
    taken = (F.col(FILE[0]) == F.col("path")) & (F.col(FILE[1]) == F.col("modified"))
    sums = to_sums(watched.join(small(known), taken, "left_anti").drop(*FILE))
    run = table.stage(sums, order)
    months = table.measure(run, sums, value)
    if not months:  # no new rows; adaptive execution may then have dropped what was watched
        return
    files = {path: at for at, path in (f.split("\n", 1) for f in seen.get["files"] or [])}
    changed = sorted(f for f, at in files.items() if held.get(f, at) != at)
    if changed:
        raise FileChanged(f"changed since they were taken: {', '.join(changed)}")
    fresh = [entry(path=f, modified=at) for f, at in sorted(files.items()) if f not in held]
    table.publish([*months, *fresh], base=versions[-1] if versions else 0)


def _read(spark: SparkSession, output: str) -> DataFrame:
    return MonthTable(spark, output).read().drop("yyyymm")


def ingest_movement(
    feed: DataFrame, cells: DataFrame, output: str, checkpoint: str, keep_purpose: bool = False
) -> None:
    order = mobility.partial_keys(keep_purpose)
    to_sums = lambda batch: mobility.refine_partials(batch, cells, keep_purpose)
    _ingest(feed, to_sums, order, "total", output, checkpoint)


def read_movement(spark: SparkSession, output: str, areas: DataFrame) -> DataFrame:
    """The refined movement table: sums of all batches merged, then turned into means."""
    return mobility.with_names(mobility.finish_partials(_read(spark, output)), areas)


def compact_movement(spark: SparkSession, output: str) -> list[str]:
    """One folder for each month; gives the months that had several."""

    def merge(sums: DataFrame) -> DataFrame:
        keys = [*mobility.partial_keys("purpose" in sums.columns), "yyyymm"]
        return sums.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in ("total", "dist_total", "time_total")])

    return MonthTable(spark, output).compact(merge, mobility.partial_keys(), "total")


def ingest_population(
    feed: DataFrame, areas: DataFrame, output: str, checkpoint: str, age: str = "age_10"
) -> None:
    order = ["date", "hour", "admdong_cd", age]
    _ingest(feed, lambda batch: population.sums(batch, areas, age), order, "pop", output, checkpoint)


def read_population(
    spark: SparkSession, output: str, areas: DataFrame, age: str = "age_10"
) -> DataFrame:
    merged = _read(spark, output).groupBy("date", "hour", "admdong_cd", age).agg(F.sum("pop").alias("pop"))
    return population.with_names(merged, areas, age)


def compact_population(spark: SparkSession, output: str, age: str = "age_10") -> list[str]:
    """One folder for each month; gives the months that had several."""
    keys = ["date", "hour", "admdong_cd", age]

    def merge(sums: DataFrame) -> DataFrame:
        return sums.groupBy(*keys, "yyyymm").agg(F.sum("pop").alias("pop"))

    return MonthTable(spark, output).compact(merge, keys, "pop")
