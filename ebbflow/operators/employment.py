"""Employment rates by province and age, and their spread over areas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ebbflow import vocab
from ebbflow.contracts import require_choice, require_columns
from ebbflow.functions.columns import ratio, sido_by_prefix, strict_map

RAW_COLUMNS = [
    "region_raw", "sex", "age_label", "population_15plus", "worked_total", "worked_mainly",
    "worked_occasionally", "on_leave", "did_not_work",
]


def rates(raw: DataFrame, sex: str = "계") -> DataFrame:
    """Employed over population per (province, age); totals and sub-regions are dropped."""
    require_choice(sex, vocab.EMPLOYMENT_SEXES, "sex")
    require_columns(
        raw, ["region_raw", "sex", "age_label", "population_15plus", "worked_total"], "employment"
    )
    kept = raw.filter(
        (F.col("sex") == sex)
        & (F.col("age_label") != vocab.EMPLOYMENT_TOTAL_AGE)
        & F.col("region_raw").isin(list(vocab.EMPLOYMENT_SIDO))
    )
    return kept.select(
        strict_map(F.col("region_raw"), vocab.EMPLOYMENT_SIDO, "region").alias("sido_nm"),
        "age_label",
        strict_map(F.col("age_label"), vocab.EMPLOYMENT_AGE_IDX, "age label").cast("int").alias("age_idx"),
        "population_15plus",
        F.col("worked_total").alias("employed"),
        ratio(F.col("worked_total"), F.col("population_15plus")).alias("employment_rate"),
    )


def rate_pivot(rates_table: DataFrame, provinces: list[str]) -> DataFrame:
    """Rates in percent, one row per age, one column per province."""
    pct = F.round(F.col("employment_rate") * 100, 1)
    cells = [F.max(F.when(F.col("sido_nm") == p, pct)).alias(p) for p in provinces]
    return rates_table.groupBy("age_idx").agg(*cells)


def area_rates(
    areas: DataFrame,
    rates_table: DataFrame,
    sido: Column | None = None,
    fill_under_15: float = 0.0,
    fill_unknown: float = 0.0,
) -> DataFrame:
    """Rate of each area x 15 ages: under 15 and unknown provinces take the fills."""
    province = sido_by_prefix(F.col("admdong_cd")) if sido is None else sido
    ages = F.explode(F.array(*[F.lit(i) for i in range(15)])).alias("age_idx")
    frame = areas.select("admdong_cd", province.alias("sido_nm"), ages)
    known = rates_table.select("sido_nm", "age_idx", F.col("employment_rate").alias("_rate"))
    return frame.join(known, ["sido_nm", "age_idx"], "left").select(
        "admdong_cd",
        "sido_nm",
        "age_idx",
        F.when(F.col("age_idx") < 3, F.lit(float(fill_under_15)))
        .otherwise(F.coalesce("_rate", F.lit(float(fill_unknown))))
        .alias("rho"),
    )
