"""Month tables published by manifest: a reader sees a run whole or not at all.

Data folders never change. A run writes a folder of its own; a manifest, one small file, then
names the folders that make up the table, with the counts of each and the feed files they were
made of. Readers take the newest manifest. A run that ends before its manifest leaves a folder
that nobody reads, and the old months stay as they were.

  root/data/run=<id>/yyyymm=<month>/part-*.parquet
  root/manifest/<version>/part-*.json

One writer at a time: a second one that publishes the same version fails.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession, functions as F, types as T

from ebbflow.functions.columns import month_key
from ebbflow.sources import readers, sinks

# An entry is a month in a run's folder, or (yyyymm null) a feed file that the table holds.
ENTRY_SCHEMA = (
    "yyyymm string, run string, output_rows bigint, total_sum double, stray_rows bigint, "
    "output_bytes bigint, elapsed_sec double, columns string, path string, modified string"
)
_FIELDS = [f.split()[0] for f in ENTRY_SCHEMA.split(", ")]


def entry(**values) -> Row:
    return Row(**{f: values.get(f) for f in _FIELDS})


def _columns(df: DataFrame) -> T.StructType:
    """The columns of a month's files, which do not say the month."""
    return T.StructType([f for f in df.schema.fields if f.name != "yyyymm"])


class FileChanged(ValueError):
    """A feed file is not the one that was taken before."""


@dataclass(frozen=True)
class MonthTable:
    spark: SparkSession
    root: str

    def versions(self) -> list[int]:
        """Published versions, oldest first; a folder listing."""
        try:
            listed = readers.files(self.spark, f"{self.root}/manifest", "part-*").select(
                F.regexp_extract("path", r"/manifest/(\d+)/", 1).cast("bigint").alias("v")
            )
            return sorted(r.v for r in listed.distinct().collect())
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return []

    def entries(self, version: int | None = None) -> list[Row]:
        """What the newest manifest (or the given one) lists: a row for each month and folder and
        one for each feed file."""
        if version is None:
            found = self.versions()
            if not found:
                return []
            version = found[-1]
        return self._manifest(f"{self.root}/manifest/{version:020d}").collect()

    def _manifest(self, path: str) -> DataFrame:
        return self.spark.read.schema(ENTRY_SCHEMA).json(path)

    def months(self) -> DataFrame:
        """The published months and their counts."""
        parts = [e for e in self.entries() if e.yyyymm is not None]
        return self.spark.createDataFrame(parts, ENTRY_SCHEMA).drop("columns", "path", "modified")

    def files(self) -> dict[str, str]:
        """The feed files that the table holds, and when each was last changed."""
        return {e.path: e.modified for e in self.entries() if e.path is not None}

    def read(
        self, first: str | None = None, last: str | None = None, schema: T.StructType | None = None
    ) -> DataFrame:
        """The published months, or those from `first` to `last`: only their folders are listed.

        `schema` is that of an unpublished table, which has no rows.
        """
        wanted = [
            e
            for e in self.entries()
            if e.yyyymm is not None and (first or e.yyyymm) <= e.yyyymm <= (last or e.yyyymm)
        ]
        return self._folders(wanted, schema)

    def _folders(self, parts: Sequence[Row], schema: T.StructType | None = None) -> DataFrame:
        """The rows of these folders, with the columns of all of them: null where one has none."""
        parts = sorted((e for e in parts if e.output_rows), key=lambda e: (e.yyyymm, e.run))
        if not parts:
            if schema is None:
                raise ValueError(f"{self.root} has no such month: say its schema")
            return self.spark.createDataFrame([], schema)
        paths = [f"{self.root}/data/run={e.run}/yyyymm={e.yyyymm}" for e in parts]
        columns = readers.merge_schemas(T.StructType.fromJson(json.loads(e.columns)) for e in parts)
        placed = columns.add("run", T.StringType()).add("yyyymm", T.StringType())
        found = self.spark.read.schema(placed).option("basePath", f"{self.root}/data").parquet(*paths)
        return found.drop("run")

    def stage(self, df: DataFrame, order: Sequence[str], run: str | None = None) -> str:
        """Write a run's folder, which nobody reads yet; gives its id."""
        run = run or uuid.uuid4().hex
        sinks.write_months(df, f"{self.root}/data/run={run}", order)
        return run

    def staged(self, run: str, df: DataFrame) -> DataFrame:
        """The rows of a run's folder, which was written from `df`; none if it had none."""
        schema = _columns(df).add("yyyymm", T.StringType())
        return self.spark.read.schema(schema).parquet(f"{self.root}/data/run={run}")

    def measure(self, run: str, df: DataFrame, value: str) -> list[Row]:
        """An entry for each month in a run's folder: rows, total, rows dated in another month (none
        in a table without dates) and bytes. Reads that folder only."""
        stray = month_key(F.col("date")) != F.col("yyyymm") if "date" in df.columns else F.lit(False)
        counts = self.staged(run, df).groupBy("yyyymm").agg(
            F.count("*").alias("output_rows"),
            F.sum(value).cast("double").alias("total_sum"),
            F.count_if(stray).alias("stray_rows"),
        )
        sizes = readers.files(self.spark, f"{self.root}/data/run={run}", "*.parquet").groupBy("yyyymm").agg(
            F.sum("bytes").alias("output_bytes")
        )
        joined = counts.join(sizes, "yyyymm", "left").collect()
        columns = _columns(df).json()
        return [entry(run=run, columns=columns, **r.asDict()) for r in joined]

    def publish(
        self, add: Iterable[Row], replace: Callable[[Row], bool] = lambda e: False, base: int | None = None
    ) -> int:
        """One new version: the entries of the newest (which must be `base`, if given), without
        those that `replace` names, and `add`. The one file it writes is the commit."""
        found = self.versions()
        newest = found[-1] if found else 0
        if base is not None and base != newest:
            raise RuntimeError(f"version {newest} was published since {base}")
        kept = [e for e in (self.entries(newest) if newest else []) if not replace(e)]
        manifest = self.spark.createDataFrame([*kept, *add], ENTRY_SCHEMA).coalesce(1)
        manifest.write.mode("error").json(f"{self.root}/manifest/{newest + 1:020d}")
        return newest + 1

    def publish_months(self, add: Sequence[Row], base: int | None = None) -> int:
        """Put these months in the place of those of the same name."""
        months = {e.yyyymm for e in add if e.yyyymm is not None}
        return self.publish(add, lambda e: e.yyyymm in months, base)

    def ledger(self) -> DataFrame:
        """Every month of every version that first published it: the ledger, from the manifests
        alone."""
        parts = [
            self._manifest(f"{self.root}/manifest/{v:020d}").withColumn("version", F.lit(v).cast("bigint"))
            for v in self.versions()
        ]
        if not parts:
            return self.spark.createDataFrame([], f"{ENTRY_SCHEMA}, version bigint")
        every = parts[0]
        for more in parts[1:]:
            every = every.unionByName(more)
        keys = [c for c in _FIELDS if c not in ("columns", "path", "modified")]
        return every.filter("yyyymm IS NOT NULL").groupBy(*keys).agg(F.min("version").alias("version"))

    def compact(
        self, merge: Callable[[DataFrame], DataFrame], order: Sequence[str], value: str
    ) -> list[str]:
        """Merge the folders of each month that has several; gives these months.

        The total of `value` must stay what it was to nine digits, or nothing is published.
        """
        found = self.versions()
        parts = [e for e in (self.entries() if found else []) if e.yyyymm is not None]
        of: dict[str, list[Row]] = {}
        for e in parts:
            of.setdefault(e.yyyymm, []).append(e)
        many = {m: es for m, es in of.items() if len(es) > 1}
        if not many:
            return []
        merged = merge(self._folders([e for es in many.values() for e in es]))
        run = self.stage(merged, order)
        made = self.measure(run, merged, value)
        for month in many:
            before = sum(e.total_sum or 0.0 for e in many[month])
            after = sum(e.total_sum or 0.0 for e in made if e.yyyymm == month)
            if abs(before - after) > 1e-9 * max(abs(before), abs(after)):
                raise RuntimeError(f"{month}: total {before} became {after} when merged")
        self.publish_months(made, found[-1])
        return sorted(many)

    def unpublished(self) -> list[str]:
        """Runs with a folder that no manifest names: of dead runs, or of one still at work."""
        try:
            listed = readers.files(self.spark, f"{self.root}/data", "*").select(
                F.regexp_extract("path", r"/run=([^/]+)/", 1).alias("run")
            )
            there = {r.run for r in listed.distinct().collect()}
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return []
        return sorted(there - {r.run for r in self.ledger().select("run").distinct().collect()})
