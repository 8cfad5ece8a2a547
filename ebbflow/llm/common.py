"""Helpers that several operators of this package share."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable
from weakref import WeakSet

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ebbflow.session import settled

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

_shipped: WeakSet = WeakSet()


def ship(spark: SparkSession) -> None:
    """Give this package to the Python workers, unless their PYTHONPATH has it."""
    context = spark.sparkContext
    if context in _shipped or ROOT in os.environ.get("PYTHONPATH", "").split(":"):
        return
    path = os.path.join(tempfile.mkdtemp(prefix="ebbflow-"), "ebbflow.zip")
    with zipfile.ZipFile(path, "w") as out:
        for folder, _, names in os.walk(os.path.join(ROOT, "ebbflow")):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.relpath(full, ROOT))
    context.addPyFile(path)
    _shipped.add(context)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with `value` computed once.

    A column used inside a lambda is copied into it by the optimiser and computed again for
    every element; a lambda's own argument is not.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def indices(first: Column, stop: Column) -> Column:
    """The whole numbers from `first` up to and without `stop`; empty when there are none."""
    return F.when(stop > first, F.sequence(first, stop - 1)).otherwise(F.array().cast("array<int>"))


def numbered(df: DataFrame, group: list[str], order: list[str], name: str = "slot") -> DataFrame:
    """`df` with the row's number from 0 within its group, by `order`, whatever a group's size.

    Rows are cut into ranges of `order` and stored with the number of their range, so that a
    repeated task finds the same ranges. Counts per range and group (ranges x groups rows) give
    each range's first number; within a range a window counts on. No task holds a group.
    Equal rows are spread by their place in the input. Give narrow rows: they are shuffled twice.
    """
    cut = df.withColumn("_at", F.monotonically_increasing_id()).repartitionByRange(*order, "_at")
    stored = settled(cut.withColumn("_range", F.spark_partition_id()))
    before = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    first = (
        stored.groupBy("_range", *group)
        .agg(F.count("*").alias("_rows"))
        .select("_range", *group, F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_first"))
    )
    within = Window.partitionBy("_range", *group).orderBy(*order, "_at")
    placed = stored.withColumn("_within", F.row_number().over(within).cast("long") - 1)
    joined = placed.alias("p").join(
        first.alias("f"), [F.col(f"p.{c}").eqNullSafe(F.col(f"f.{c}")) for c in ["_range", *group]]
    )
    return joined.select("p.*", (F.col("f._first") + F.col("p._within")).alias(name)).drop(
        "_at", "_range", "_within"
    )
