"""Insurance claims: normalisation, filters, weekly roll-up and season slices."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ebbflow import vocab
from ebbflow.contracts import require_choice, require_columns, require_subset
from ebbflow.functions.calendar import iso_monday, with_iso_week
from ebbflow.functions.columns import lookup, strict_map

COLUMNS = ["date", "sido_code", "sex", "age_group", "episodes"]
COLLAPSIBLE = ("sido_code", "sex")


def normalise(raw: DataFrame) -> DataFrame:
    """Raw export to (date, sido_code, sex, age_group, episodes); unmapped labels fail."""
    require_columns(raw, vocab.CLAIMS_COLUMNS, "claims export")
    named = raw.select(*[F.col(f"`{k}`").alias(v) for k, v in vocab.CLAIMS_COLUMNS.items()])
    return named.select(
        F.to_date("date", "yyyy-MM-dd").alias("date"),
        F.col("sido_code").cast("long"),
        strict_map(F.col("sex_raw"), vocab.CLAIMS_SEXES, "sex").alias("sex"),
        strict_map(F.col("age_group_raw"), vocab.CLAIMS_AGE_LABELS, "age group").alias("age_group"),
        F.col("episodes").cast("long"),
    )


def select(
    claims: DataFrame | dict[str, DataFrame],
    setting: str | None = None,
    sido_codes: Sequence[int] | None = None,
    age_groups: Sequence[str] | None = None,
    sex: str = "all",
    date_range: tuple[str, str] | None = None,
) -> DataFrame:
    """Filtered claims. Arguments are checked before anything runs; the range is closed."""
    if setting is not None:
        require_choice(setting, vocab.CLAIMS_SETTINGS, "setting")
    if age_groups is not None:
        require_subset(age_groups, vocab.CLAIMS_AGE_GROUPS, "age_groups")
    require_choice(sex, ("M", "F", "all"), "sex")
    df = claims[setting or vocab.CLAIMS_SETTINGS[0]] if isinstance(claims, dict) else claims
    if sido_codes is not None:
        df = df.filter(F.col("sido_code").isin(list(sido_codes)))
    if age_groups is not None:
        df = df.filter(F.col("age_group").isin(list(age_groups)))
    if sex != "all":
        df = df.filter(F.col("sex") == sex)
    if date_range is not None:
        first, last = (dt.date.fromisoformat(d) for d in date_range)
        df = df.filter(F.col("date").between(F.lit(first), F.lit(last)))
    return df


def merge_successors(claims: DataFrame) -> DataFrame:
    """Optional: count a province under the code that replaced it."""
    code = F.col("sido_code")
    return claims.withColumn("sido_code", F.coalesce(lookup(code, vocab.SIDO_SUCCESSOR), code).cast("long"))


def weekly(claims: DataFrame, sum_over: Sequence[str] = COLLAPSIBLE) -> DataFrame:
    """Episodes per ISO week and age group; dimensions in `sum_over` are summed away."""
    require_columns(claims, COLUMNS, "claims")
    require_subset(sum_over, COLLAPSIBLE, "sum_over")
    keep = [c for c in COLLAPSIBLE if c not in set(sum_over)]
    # Days are combined before the week keys are computed: fewer rows to classify.
    daily = claims.groupBy("date", "age_group", *keep).agg(F.sum("episodes").alias("episodes"))
    return (
        with_iso_week(daily)
        .groupBy("week_start_date", "iso_year", "iso_week", "age_group", *keep)
        .agg(F.sum("episodes").cast("long").alias("episodes"))
    )


def season(
    weeks: DataFrame,
    start_year: int,
    start_week: int = vocab.SEASON_FIRST_ISO_WEEK,
    length: int = vocab.SEASON_WEEKS,
) -> DataFrame:
    """`length` consecutive weeks from the Monday of the start week, numbered from 0."""
    require_columns(weeks, ["week_start_date"], "weekly claims")
    first = iso_monday(start_year, start_week)
    last = first + dt.timedelta(weeks=length - 1)
    days = F.date_diff(F.col("week_start_date"), F.lit(first))
    return weeks.filter(F.col("week_start_date").between(F.lit(first), F.lit(last))).withColumn(
        "week_in_season", F.floor(days / 7).cast("int")
    )
