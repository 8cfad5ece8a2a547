"""Mean daily flows kept up to date month by month.

A month adds its sums by week part, origin, destination, 7 ages and hour, and the dates present
in it. Both are additive, so the mean flow of any run of months and day type comes from them
without the trips, and a new or corrected month costs a read of that month.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from ebbflow import vocab
from ebbflow.contracts import fail_if_empty, require_choice, require_columns
from ebbflow.functions import calendar
from ebbflow.functions.columns import month_key, ratio, top_code
from ebbflow.joins import small
from ebbflow.sources.published import MonthTable

ENDS = ["o_admdong_cd", "d_admdong_cd"]
SCHEMA = (
    "part string, o_admdong_cd string, d_admdong_cd string, age_7 int, hour int, total double, date int, yyyymm string"
)


def month_parts(od: DataFrame, holidays="mobility") -> DataFrame:
    """The additive parts of refined movement, by month: rows of sums, whose date is null, and rows
    of the dates present, whose ends and total are null."""
    part = calendar.week_part(F.col("date"), holidays).alias("part")
    month = month_key(F.col("date")).alias("yyyymm")
    kept = od.filter(F.col("age_10").isin(vocab.MOBILITY_AGES_RAW))
    age = top_code(F.col("age_10"), 70).cast("int").alias("age_7")
    sums = kept.groupBy(part, *ENDS, age, "hour", month).agg(F.sum("total").cast("double").alias("total"))
    days = od.select("date").distinct().select("date", part, month)
    return sums.unionByName(days, allowMissingColumns=True)


@dataclass(frozen=True)
class FlowTable:
    """The parts of all months, published together; `holidays` as in `mobility.daily_flow`."""

    spark: SparkSession
    root: str
    holidays: str = "mobility"

    def add(self, od: DataFrame) -> list[str]:
        """Put the months of these trips in, each in the place of what it had; gives the months.
        Reads the given trips only. A row counts for the month of its date."""
        require_columns(od, ["date", *ENDS, "age_10", "hour", "total"], "movement")
        table = MonthTable(self.spark, self.root)
        versions = table.versions()
        parts = month_parts(od, self.holidays)
        run = table.stage(parts, ["part", *ENDS])
        made = table.measure(run, parts, "total")
        if made:
            table.publish_months(made, versions[-1] if versions else 0)
        return sorted(e.yyyymm for e in made)

    def drop(self, months: list[str]) -> None:
        """Take months out."""
        MonthTable(self.spark, self.root).publish([], lambda e: e.yyyymm in months)

    def flow(
        self, first: str | None = None, last: str | None = None, daytype: str = "weekday", index: DataFrame | None = None
    ) -> DataFrame:
        """Mean daily flow pi of the months from `first` to `last`, as `mobility.daily_flow` has it
        from the trips. No such day at all is an error."""
        require_choice(daytype, ("weekday", "weekend", "all"), "daytype")
        table = MonthTable(self.spark, self.root)
        empty = self.spark.createDataFrame([], SCHEMA).schema
        parts = table.read(first, last, schema=empty)
        if daytype != "all":
            parts = parts.filter(F.col("part") == daytype)
        days = parts.filter(F.col("date").isNotNull()).select("date").distinct()
        n_days = days.agg(F.count("*")).scalar()
        sums = parts.filter(F.col("date").isNull())
        if index is not None:
            known = small(index, ["admdong_cd"])
            for end in ENDS:
                sums = sums.join(known.toDF(end), end, "left_semi")
        pi = sums.groupBy(*ENDS, "age_7", "hour").agg(F.sum("total").alias("_sum")).select(
            *ENDS, "age_7", "hour", ratio(F.col("_sum"), n_days).alias("pi")
        )
        return fail_if_empty(pi, days, f"no {daytype} dates in the data")
