"""Idempotent monthly ingest: all pending months in one Spark job, published together, with a ledger."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from ebbflow.contracts import require_columns
from ebbflow.session import settled
from ebbflow.sources.published import MonthTable, entry

# From the rows a run wrote and its months: the months that may not be published, and why.
Audit = Callable[[DataFrame, list[str]], dict[str, str]]

LEDGER_SCHEMA = (
    "yyyymm string, status string, output_rows bigint, total_sum double, stray_rows bigint, "
    "output_bytes bigint, elapsed_sec double, error string, quarantined_rows bigint"
)


def plan(expected: DataFrame, done: DataFrame, available: DataFrame) -> DataFrame:
    """Status of each expected month: SKIPPED (done), PENDING or MISSING_INPUT."""
    have = done.select("yyyymm").distinct().withColumn("_done", F.lit(True))
    input_ = available.select("yyyymm").distinct().withColumn("_in", F.lit(True))
    return (
        expected.select("yyyymm")
        .distinct()
        .join(have, "yyyymm", "left")
        .join(input_, "yyyymm", "left")
        .select(
            "yyyymm",
            F.when(F.col("_done"), "SKIPPED")
            .when(F.col("_in"), "PENDING")
            .otherwise("MISSING_INPUT")
            .alias("status"),
        )
    )


def pending(expected: DataFrame, done: DataFrame) -> DataFrame:
    """Expected months that the output does not have yet."""
    return expected.select("yyyymm").distinct().join(done.select("yyyymm"), "yyyymm", "left_anti")


def run(
    spark: SparkSession,
    load: Callable[[list[str]], DataFrame],
    refine: Callable[[DataFrame], DataFrame],
    expected: DataFrame,
    done: DataFrame,
    available: DataFrame,
    output: str,
    ledger: str,
    value: str,
    order: list[str],
    audit: Audit | None = None,
    malformed: Callable[[list[str]], DataFrame] | None = None,
) -> DataFrame:
    """Ingest the pending months and append to the ledger; returns this run's rows.

    `available` lists the months there is input for (see `readers.files`: a folder listing,
    not a read). `load` reads the feeds of the given months and says in a column `yyyymm` which
    feed a row came in; `refine` keeps it. Output is written by that month, so a row dated in
    another month cannot replace that month; the ledger counts it in `stray_rows`. Each month
    gets one row, also one without any output. Just the month list, one short text per month,
    comes to the driver. The pending months are one job, whose seconds each of them reports. If
    that job fails, each month is tried alone, so that a bad month is recorded as FAILED, with
    the whole error, and the others are kept.

    Months are written, audited and then published together by one manifest (`published`): a
    reader sees the old months until then, whenever the run ends. `audit` gives the months it
    objects to, with the reason; they are recorded as FAILED and not published. `malformed` gives
    the lines of the months' feeds that do not parse (`readers.split_feed`): they are written to
    `output`/quarantine by run and month and counted in the ledger. The ledger comes
    last; what it says of published months can be had from the manifests (`MonthTable.ledger`).
    """
    table = MonthTable(spark, output)
    versions = table.versions()
    status = plan(expected, done, available).collect()
    todo = sorted(r.yyyymm for r in status if r.status == "PENDING")
    rows = [_line({"yyyymm": r.yyyymm, "status": r.status}) for r in status if r.status != "PENDING"]
    made: list[Row] = []

    def write(months: list[str]) -> None:
        start = time.monotonic()
        feed = load(months)
        require_columns(feed, ["yyyymm"], "feed")
        refined = refine(feed.withColumn("yyyymm", F.col("yyyymm").cast("string")))
        require_columns(refined, ["yyyymm", "date", value], "refined feed")
        run = table.stage(refined, order)
        measured = {e.yyyymm: e for e in table.measure(run, refined, value)}
        bad = audit(table.staged(run, refined), months) if audit else {}
        held = _quarantine(malformed(months), f"{output}/quarantine/run={run}") if malformed else None
        took = time.monotonic() - start
        for month in months:
            found = measured.get(month)
            values = found.asDict() if found else entry(
                yyyymm=month, run=run, output_rows=0, stray_rows=0, output_bytes=0
            ).asDict()
            values["elapsed_sec"] = took
            counted = {"quarantined_rows": None if held is None else held.get(month, 0)}
            if month in bad:
                told = {"yyyymm": month, "status": "FAILED", "error": f"audit: {bad[month]}"}
                rows.append(_line({**told, **counted}))
            else:
                made.append(Row(**values))
                rows.append(_line({**values, **counted, "status": "OK"}))

    if todo:
        try:
            write(todo)
        except Exception:  # noqa: BLE001 - the cause is found month by month
            for month in todo:
                try:
                    write([month])
                except Exception as error:  # noqa: BLE001
                    told = f"{type(error).__name__}: {error}"
                    rows.append(_line({"yyyymm": month, "status": "FAILED", "error": told}))
    if made:
        table.publish_months(made, versions[-1] if versions else 0)
    result = settled(spark.createDataFrame(rows, LEDGER_SCHEMA))
    result.write.mode("append").parquet(ledger)
    return result


def _quarantine(lines: DataFrame, folder: str) -> dict[str, int]:
    """Store the lines by month; how many each month has."""
    lines.write.partitionBy("yyyymm").parquet(folder)
    schema = "file string, line string, yyyymm string"
    found = lines.sparkSession.read.schema(schema).parquet(folder).groupBy("yyyymm").count().collect()
    return {r.yyyymm: r["count"] for r in found}


def _line(values: dict) -> tuple:
    """A row of the ledger."""
    return tuple(values.get(f.split()[0]) for f in LEDGER_SCHEMA.split(", "))


def keeps_totals(feed_totals: DataFrame, value: str, tolerance: float = 1e-9) -> Audit:
    """An audit: the total of each month is that of its feed (yyyymm, total), to `tolerance`."""

    def audit(made: DataFrame, months: list[str]) -> dict[str, str]:
        wanted = feed_totals.filter(F.col("yyyymm").isin(months)).select("yyyymm", F.col("total").cast("double").alias("w"))
        sums = made.groupBy("yyyymm").agg(F.sum(value).cast("double").alias("g"))
        both = wanted.join(sums, "yyyymm", "full").na.fill(0.0, ["w", "g"])
        off = F.abs(F.col("w") - F.col("g")) > tolerance * F.greatest(F.abs("w"), F.abs("g"))
        return {r.yyyymm: f"total {r.g}, feed has {r.w}" for r in both.filter(off).collect()}

    return audit


def full_groups(keys: list[str], size: int) -> Audit:
    """An audit: every group of `keys` within a month has exactly `size` rows."""

    def audit(made: DataFrame, months: list[str]) -> dict[str, str]:
        wrong = made.groupBy("yyyymm", *keys).count().filter(F.col("count") != size)
        found = wrong.groupBy("yyyymm").agg(F.count("*").alias("n"))
        return {r.yyyymm: f"{r.n} groups of {keys} have not {size} rows" for r in found.collect()}

    return audit


def all_of(*audits: Audit) -> Audit:
    """The objections of several audits; a month's first one counts."""

    def audit(made: DataFrame, months: list[str]) -> dict[str, str]:
        found: dict[str, str] = {}
        for one in audits:
            found = {**one(made, months), **found}
        return found

    return audit
