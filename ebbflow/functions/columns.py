"""Column expressions shared by the operators (all JVM-side)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ebbflow import vocab


def ratio(num: Column, den: Column) -> Column:
    """Division that gives null on a zero denominator (plain `/` raises under ANSI)."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def hour_of(time_code: Column) -> Column:
    """Hour from a time code whose first two characters are the hour."""
    return F.substring(time_code, 1, 2).cast("int")


def age5_of(sex_age_code: Column) -> Column:
    """Five-year age from a code made of one sex letter and two age digits."""
    return F.substring(sex_age_code, 2, 2).cast("int")


def decade(age: Column) -> Column:
    return (age - age % 10).cast("int")


def age10_of(sex_age_code: Column) -> Column:
    return decade(age5_of(sex_age_code))


def top_code(age: Column, top: int) -> Column:
    """Ages at or above `top` become `top`."""
    return F.least(age, F.lit(top)).cast("int")


def age10_from_age5(age5: Column) -> Column:
    return decade(top_code(age5, 80))


def age_idx15(age5: Column) -> Column:
    """Index 0..14 of the five-year group that holds `age5`."""
    return F.floor(top_code(age5, 70) / 5).cast("int")


def strict_map(c: Column, mapping: dict, what: str) -> Column:
    """Map values; a value outside the mapping fails the job instead of passing silently."""
    hit = lookup(c, mapping)
    message = F.concat(F.lit(f"unmapped {what}: "), F.coalesce(c.cast("string"), F.lit("null")))
    return F.coalesce(hit, F.raise_error(message))


def lookup(c: Column, mapping: dict, default=None) -> Column:
    """Map values through a small fixed dictionary, with an optional default."""
    pairs = [F.lit(v) for kv in mapping.items() for v in kv]
    hit = F.try_element_at(F.create_map(*pairs), c)
    return hit if default is None else F.coalesce(hit, F.lit(default))


def sido_by_prefix(code: Column, mapping: dict | None = None, default: str = "unknown") -> Column:
    return lookup(F.substring(code, 1, 2), mapping or vocab.SIDO_BY_PREFIX, default)


def kind_of(origin: Column, destination: Column) -> Column:
    """'within' for a trip that stays in its area, else 'cross'."""
    return F.when(origin == destination, "within").otherwise("cross")


def distance_band(metres: Column) -> Column:
    chain = None
    for upper, label in vocab.DISTANCE_BANDS:
        if upper is None:
            return chain.otherwise(label)
        test = metres < upper
        chain = F.when(test, label) if chain is None else chain.when(test, label)
    return chain


def speed_kmh(dist: Column, minutes: Column, hypothesis: str) -> Column:
    metres_per_unit, minutes_per_unit = vocab.SPEED_HYPOTHESES[hypothesis]
    km = dist * metres_per_unit / 1000
    return ratio(km, minutes * minutes_per_unit / 60)


def straight_distance(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    dx, dy = x1 - x2, y1 - y2
    return F.sqrt(dx * dx + dy * dy)


def none_if_nan(c: Column) -> Column:
    """Missing values are null everywhere; NaN is turned into null at ingest."""
    return F.when(~F.isnan(c), c)


def plain_number(c: Column) -> Column:
    """Text with thousands separators to BIGINT."""
    return F.regexp_replace(c, ",", "").cast("long")


def year_of_key(yyyymm: Column) -> Column:
    return F.substring(yyyymm, 1, 4)


def month_key(ymd: Column) -> Column:
    """yyyymmdd integer to a 'yyyymm' text key."""
    return F.floor(ymd / 100).cast("int").cast("string")
