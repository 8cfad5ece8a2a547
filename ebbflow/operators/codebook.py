"""Area code book: capital-region mapping and counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

COLUMNS = ["sido_cd", "sido_nm", "sgg_cd", "sgg_nm", "admdong_cd", "admdong_nm"]


def region(areas: DataFrame, sido_codes: list[str]) -> DataFrame:
    return areas.select(*COLUMNS).filter(F.col("sido_cd").isin(sido_codes))


def counts(areas: DataFrame) -> DataFrame:
    return areas.groupBy("sido_cd", "sido_nm").agg(
        F.count("*").alias("n_areas"), F.count_distinct("sgg_cd").alias("n_districts")
    )


def code_lengths(areas: DataFrame) -> DataFrame:
    return areas.groupBy(F.length("admdong_cd").alias("code_length")).agg(
        F.count("*").alias("n_codes")
    )
