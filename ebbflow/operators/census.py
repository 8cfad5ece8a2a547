"""Registered population: raw text tables to long ages, 10-year and 15-group forms."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, functions as F

from ebbflow import vocab
from ebbflow.functions.columns import age10_from_age5, age_idx15, plain_number

AREA_KEYS = ["admdong_cd", "admdong_nm", "sgg_nm", "sido_nm"]


def age_columns(header: list[str]) -> dict[str, int]:
    """Age columns of a census header and their first ages; the count must be right."""
    found = {}
    for name in header:
        hit = re.match(vocab.CENSUS_AGE_COLUMN_PATTERN, name)
        if hit:
            found[name] = int(hit.group(1))
    if len(found) != vocab.CENSUS_AGE_COLUMNS:
        raise ValueError(f"expected {vocab.CENSUS_AGE_COLUMNS} age columns, got {len(found)}")
    return found


def without_subtotals(raw: DataFrame) -> DataFrame:
    return raw.filter(~F.col(vocab.CENSUS_AREA_COLUMN).rlike(vocab.CENSUS_SUBTOTAL_PATTERN))


def split_area(raw: DataFrame) -> DataFrame:
    """Address and 10-digit code, then province, district and area name.

    A row that does not match fails the job.
    """
    text = F.col(vocab.CENSUS_AREA_COLUMN)
    part = lambda i: F.regexp_extract(text, vocab.CENSUS_AREA_PATTERN, i)
    code = F.when(part(2) != "", part(2)).otherwise(
        F.raise_error(F.concat(F.lit("unparsed area: "), text))
    )
    tokens = F.split(part(1), " ")
    return raw.withColumns(
        {
            "admdong_cd_10": code,
            "sido_nm": F.element_at(tokens, 1),
            "admdong_nm": F.element_at(tokens, -1),
            "sgg_nm": F.array_join(
                F.slice(tokens, F.lit(2), F.greatest(F.size(tokens) - 2, F.lit(0))), " "
            ),
        }
    )


def parse(raw: DataFrame) -> DataFrame:
    """Raw wide text table to long (area, age_5_start, pop_5)."""
    ages = age_columns(raw.columns)
    named = split_area(without_subtotals(raw))
    numbers = named.select(
        "admdong_cd_10", "sido_nm", "sgg_nm", "admdong_nm",
        *[plain_number(F.col(f"`{c}`")).alias(str(start)) for c, start in ages.items()],
    )
    long = numbers.unpivot(
        ["admdong_cd_10", "sido_nm", "sgg_nm", "admdong_nm"],
        [str(s) for s in ages.values()],
        "age_col",
        "pop_5",
    )
    return long.select(
        F.substring("admdong_cd_10", 1, 8).alias("admdong_cd"),
        "admdong_nm",
        "sgg_nm",
        "sido_nm",
        F.col("age_col").cast("int").alias("age_5_start"),
        "pop_5",
    )


def to_decades(long: DataFrame) -> DataFrame:
    """Ten-year groups, 80 and over merged."""
    return long.groupBy(*AREA_KEYS, age10_from_age5(F.col("age_5_start")).alias("age_10")).agg(
        F.sum("pop_5").alias("pop")
    )


def to_15_groups(long: DataFrame, provinces: list[str] | None = None) -> DataFrame:
    """Exactly 15 rows per area, zero-filled.

    The sums are spread over the scaffold inside the aggregation's own shuffle: areas
    and groups are built from one grouped row per area, so no join is needed.
    """
    if provinces is not None:
        long = long.filter(F.col("sido_nm").isin(provinces))
    idx = age_idx15(F.col("age_5_start"))
    sums = [
        F.coalesce(F.sum(F.when(idx == i, F.col("pop_5"))), F.lit(0)).alias(f"_{i}")
        for i in range(15)
    ]
    wide = long.groupBy(*AREA_KEYS).agg(*sums)
    rows = F.array(
        *[
            F.struct(
                F.lit(label).alias("age_group"),
                F.lit(i).alias("age_idx"),
                F.col(f"_{i}").cast("long").alias("pop"),
            )
            for i, label in enumerate(vocab.AGE_LABELS_15)
        ]
    )
    return wide.select(*AREA_KEYS, F.inline(rows))


def scaffold_15(long: DataFrame) -> DataFrame:
    """Every area with every one of the 15 groups, by left join onto the grouped sums.

    The code alone joins; the names, which may be null, come from the frame.
    """
    grouped = long.groupBy("admdong_cd", age_idx15(F.col("age_5_start")).alias("age_idx")).agg(
        F.sum("pop_5").alias("pop")
    )
    groups = F.explode(F.array(*[F.lit(i) for i in range(15)])).alias("age_idx")
    frame = long.select(*AREA_KEYS).distinct().select(*AREA_KEYS, groups)
    return frame.join(grouped, ["admdong_cd", "age_idx"], "left").select(
        *AREA_KEYS, "age_idx", F.coalesce("pop", F.lit(0)).cast("long").alias("pop")
    )


def matrix(groups15: DataFrame) -> DataFrame:
    """Wide form: one row per area, columns a0..a14."""
    cells = [
        F.max(F.when(F.col("age_idx") == i, F.col("pop"))).alias(f"a{i}") for i in range(15)
    ]
    return groups15.groupBy("admdong_cd").agg(*cells)


def pivot_matrix(groups15: DataFrame) -> DataFrame:
    wide = groups15.groupBy("admdong_cd").pivot("age_idx", list(range(15))).agg(F.first("pop"))
    return wide.toDF("admdong_cd", *[f"a{i}" for i in range(15)])
