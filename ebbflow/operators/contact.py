"""Contact matrices as a long table (setting, contact_idx, participant_idx, value)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from ebbflow import vocab
from ebbflow.contracts import fail_if_any, require_choice
from ebbflow.functions.columns import lookup


def swap_orientation(long: DataFrame) -> DataFrame:
    """[participant, contact] to [contact, participant] and back."""
    return long.select(
        "setting",
        F.col("participant_idx").alias("contact_idx"),
        F.col("contact_idx").alias("participant_idx"),
        "value",
    )


def shape_report(long: DataFrame, size: int = 15) -> DataFrame:
    """Cells per setting and whether the matrix is complete."""
    return long.groupBy("setting").agg(
        F.count("*").alias("n_cells"),
        (
            (F.count("*") == size * size)
            & (F.count_distinct("contact_idx", "participant_idx") == size * size)
            & (F.min(F.least("contact_idx", "participant_idx")) >= 0)
            & (F.max(F.greatest("contact_idx", "participant_idx")) < size)
        ).alias("is_square"),
    )


def checked(long: DataFrame, size: int = 15) -> DataFrame:
    """The table, failing when it is computed if a setting is not a full square matrix."""
    broken = shape_report(long, size).filter(~F.col("is_square"))
    return fail_if_any(long, broken, f"a contact matrix is not {size} x {size}")


def _weight(setting: Column, weights: Mapping[str, float]) -> Column:
    """Weight of a setting; settings that are not named count 0."""
    return lookup(setting, {k: float(v) for k, v in weights.items()}, 0.0)


def combine(
    long: DataFrame, daytype: str | None = None, weights: Mapping[str, float] | None = None
) -> DataFrame:
    """Weighted sum of the settings for a day type or for own weights."""
    if weights is None:
        require_choice(daytype, vocab.DAYTYPES, "daytype")
        weights = vocab.SETTING_WEIGHTS[daytype]
    return long.groupBy("contact_idx", "participant_idx").agg(
        F.sum(_weight(F.col("setting"), weights) * F.col("value")).alias("value")
    )


def matrix_summary(long: DataFrame) -> DataFrame:
    """Per setting: sum, mean of the diagonal, maximum and where it is (first on ties)."""
    on_diagonal = F.when(F.col("contact_idx") == F.col("participant_idx"), F.col("value"))
    where = F.struct(
        F.col("value").alias("v"), (-F.col("contact_idx")).alias("c"), (-F.col("participant_idx")).alias("p")
    )
    return (
        long.groupBy("setting")
        .agg(
            F.sum("value").alias("total"),
            F.avg(on_diagonal).alias("mean_diagonal"),
            F.max(where).alias("_m"),
        )
        .select(
            "setting",
            "total",
            "mean_diagonal",
            F.col("_m.v").alias("max_value"),
            (-F.col("_m.c")).alias("max_contact_idx"),
            (-F.col("_m.p")).alias("max_participant_idx"),
        )
    )


def scenarios() -> dict[str, dict[str, float]]:
    named = {d: vocab.SETTING_WEIGHTS[d] for d in ("weekday_school", "vacation_weekday", "weekend")}
    return {**named, "school_closed": {**vocab.SETTING_WEIGHTS["weekday_school"], "school": 0.0}}


def compare_scenarios(
    long: DataFrame, cases: Mapping[str, Mapping[str, float]], base: str
) -> DataFrame:
    """Total contacts per scenario and the reduction against the base scenario."""
    sums = long.groupBy("setting").agg(F.sum("value").alias("value"))
    weights = [_weight(F.col("setting"), w) for w in cases.values()]
    totals = sums.agg(
        *[F.sum(w * F.col("value")).alias(name) for name, w in zip(cases, weights)]
    )
    long_form = totals.unpivot([F.col(base).alias("_base")], list(cases), "scenario", "total")
    return long_form.select(
        "scenario", "total", (F.col("_base") - F.col("total")).alias("reduction")
    )


def daily_series(long: DataFrame, days: DataFrame) -> DataFrame:
    """Matrix of every calendar day: the few day-type matrices met by the day's type."""
    ages = len(vocab.AGE_LABELS_15)
    inside = F.col("contact_idx").between(0, ages - 1) & F.col("participant_idx").between(0, ages - 1)
    outside = long.filter(~F.coalesce(inside, F.lit(False)))
    known = fail_if_any(long, outside, f"age indexes outside 0..{ages - 1}")
    per_type = known.groupBy("contact_idx", "participant_idx").agg(
        *[
            F.sum(_weight(F.col("setting"), vocab.SETTING_WEIGHTS[d]) * F.col("value")).alias(d)
            for d in vocab.DAYTYPES
        ]
    )
    tall = per_type.unpivot(
        ["contact_idx", "participant_idx"], vocab.DAYTYPES, "daytype", "value"
    )
    # 15 x 15 cells for four day types: 900 rows at most, while the day types are skewed keys.
    return days.join(F.broadcast(tall), "daytype").select(
        "date", "daytype", "contact_idx", "participant_idx", "value"
    )
