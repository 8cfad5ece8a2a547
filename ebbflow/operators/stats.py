"""Quantiles, weighted quantiles, histograms, profiles and top-k.

Two families of quantiles live here on purpose:

* `summary` uses Spark's `percentile`. It keeps one counter per distinct value of a
  group in one task, so it is for tables bounded by the area and age vocabularies
  (area x age tables), never for trip rows.
* `exact_quantiles` is for trip rows, and `measured_quantiles` for several values of each. No
  group is ever held by one task and the rows are not shuffled: a first read sums narrow bins
  and locates the bin of each wanted rank, a second read keeps the values of those bins only.
  These few are cut into slices between their own ends, and the slices that hold a wanted rank
  are cut again, until few enough values are left in each to be ordered.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ebbflow.functions.columns import ratio
from ebbflow.session import settled

# Bins per e-fold of the value: 0.1 % wide.
BINS_PER_EFOLD = 1000
WEIGHT_TYPE = "decimal(38,18)"
# The logarithms of all positive numbers, in bins, lie above minus this.
LOWEST_BIN = 750_000
# Even slices that a bracket of values is cut into, and the different values of a bracket that
# one task puts in order.
SLICES = 4096
FEW = 200_000
# A candidate table is hinted for broadcast only when its proven row bound is below this.
BROADCAST_ROW_BOUND = 10_000


def quantile_name(q: float) -> str:
    return f"p{q * 100:g}".replace(".", "_")


def summary(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    quantiles: dict[str, float],
    extra: Sequence[Column] = (),
) -> DataFrame:
    """Linear percentiles and further aggregates of a vocabulary-bounded table."""
    wanted = [
        F.percentile(F.col(value), F.lit(q)).alias(name) for name, q in quantiles.items()
    ]
    return df.groupBy(*keys).agg(*wanted, *extra)


def _bin_of(value: Column) -> Column:
    """Order-preserving bin that needs no pass over the data, 0.1 % wide at any magnitude."""
    size = F.abs(value)
    log = F.when(size > 1.7e308, F.lit(710.0)).otherwise(F.log(size))
    steps = (F.floor(log * BINS_PER_EFOLD) + LOWEST_BIN).cast("int")
    return F.when(size == 0, 0).when(value < 0, -steps).otherwise(steps)


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probs: Sequence[float],
    weight: str | None = None,
    method: str = "linear",
    max_groups: int | None = None,
    settle: bool = True,
    few: int = FEW,
) -> DataFrame:
    """Exact quantiles per group: one row per group, columns p25, p50, ...

    method: 'linear' (interpolated), 'nearest' (value at rank round((n-1)q)) or
    'weighted' (smallest value whose running weight reaches q of the total; needs `weight`,
    which is taken to 18 decimals, below 1e20: a smaller or larger one fails).
    Also returns n (rows or total weight), min, max and mean (weighted by `weight`).
    `max_groups` is the caller's bound on the number of groups; with it the located
    bins have a known size and may be broadcast, without it the planner joins them.

    The input is read twice and must give the same values both times, as a stored table
    does. The last bits of sums of fractions depend on the order of addition; so the few columns
    are first written to the shared folder, unless the caller says the input is stored
    (`settle=False`). `few` bounds the different values that one task puts in order.
    """
    if method not in ("linear", "nearest", "weighted"):
        raise ValueError(f"method must be linear/nearest/weighted, got {method!r}")
    if (method == "weighted") != (weight is not None):
        raise ValueError("a weight column goes with method='weighted' and only with it")
    keys = list(keys)
    narrow = df.select(
        *keys, F.col(value).cast("double").alias("_v"), *([F.col(weight).alias("_w")] if weight else [])
    )
    rows = settled(narrow) if settle else narrow
    # Decimal weights add up to the same total in any order, so no rank falls in between.
    rows = rows.withColumn("_w", _exact_weight(F.col("_w")) if weight else F.lit(1))
    return _quantiles(rows, keys, probs, method, max_groups, few)


def measured_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    measures: dict[str, Column],
    probs: Sequence[float],
    method: str = "linear",
    max_groups: int | None = None,
    settle: bool = True,
    few: int = FEW,
) -> DataFrame:
    """`exact_quantiles` of several values of each row at once: one row per group and measure.

    The rows are read twice for all measures together; a row is never copied for a measure
    before its values are summed into bins, or found to lie in a located bin. A null value takes
    no part. `max_groups` bounds the groups of `keys`.
    """
    if method not in ("linear", "nearest"):
        raise ValueError(f"method must be linear/nearest, got {method!r}")
    keys, names = list(keys), list(measures)
    narrow = df.select(*keys, *[measures[m].cast("double").alias(f"_m{i}") for i, m in enumerate(names)])
    if settle:
        narrow = settled(narrow)
    each = F.array(
        *[F.struct(F.lit(m).alias("measure"), F.col(f"_m{i}").alias("_v")) for i, m in enumerate(names)]
    )
    rows = narrow.select(*keys, F.inline(each)).withColumn("_w", F.lit(1))
    bound = None if max_groups is None else max_groups * len(names)
    return _quantiles(rows, [*keys, "measure"], probs, method, bound, few)


def _exact_weight(weight: Column) -> Column:
    exact = weight.cast(WEIGHT_TYPE)
    lost = F.raise_error(F.lit("a weight is below 1e-18")).cast(WEIGHT_TYPE)
    return F.when((weight > 0) & (exact == 0), lost).otherwise(exact)


def _quantiles(
    rows: DataFrame, keys: list[str], probs: Sequence[float], method: str, max_groups: int | None, few: int
) -> DataFrame:
    """Quantiles of the values `_v` with weights `_w`."""
    probs = [float(p) for p in probs]
    rows = rows.filter(F.col("_v").isNotNull() & ~F.isnan("_v") & F.col("_w").isNotNull())
    rows = rows.withColumn("_bin", _bin_of(F.col("_v")))
    bins = rows.groupBy(*keys, "_bin").agg(
        F.sum("_w").alias("_bw"),
        F.sum(F.col("_v") * F.col("_w")).alias("_bs"),
        F.min("_v").alias("_lo"),
        F.max("_v").alias("_hi"),
    )
    # At most a few ten thousand bins per group, whatever the number of rows.
    ordered = Window.partitionBy(*keys).orderBy("_bin")
    whole = Window.partitionBy(*keys)
    located = bins.select(
        *keys,
        "_bin",
        _sum_before("_bw", ordered).alias("_before"),
        "_bw",
        "_lo",
        "_hi",
        F.sum("_bw").over(whole).alias("_n"),
        F.sum("_bs").over(whole).alias("_s"),
        F.min("_lo").over(whole).alias("_min"),
        F.max("_hi").over(whole).alias("_max"),
    )
    ranks = _wanted_ranks(probs, method)
    located = located.filter(_any_covered(ranks, F.col("_before"), F.col("_bw"), method)).drop("_bw")
    bound = None if max_groups is None else max_groups * len(ranks)

    # The values of the located bins; copies of a value are combined before the shuffle, and
    # the shuffle is on the value, so a crowded bin is spread over all tasks. From here on a
    # bracket, a run of values with a wanted rank in it, is known by the weight before it.
    carried = ["_n", "_s", "_min", "_max", "_lo", "_hi"]
    hit = _meet(rows, _bounded(located, bound), keys + ["_bin"])
    hit = settled(
        hit.groupBy(*keys, "_before", "_v").agg(
            F.sum("_w").alias("_w"), *[F.max(c).alias(c) for c in carried]
        )
    )
    while _crowded(hit, keys, few):
        hit = settled(_cut(hit, keys, ranks, method, bound))
    inside = Window.partitionBy(*keys, "_before").orderBy("_v")
    hit = hit.withColumn("_start", F.col("_before") + _sum_before("_w", inside))
    picks = [
        F.min(F.when(_covers(rank, F.col("_start"), F.col("_w"), method), F.col("_v"))).alias(
            f"_r{i}"
        )
        for i, rank in enumerate(ranks)
    ]
    total = F.first("_n")
    per_group = hit.groupBy(*keys).agg(
        (total.cast("double") if method == "weighted" else total).alias("n"),
        F.first("_min").alias("min"),
        F.first("_max").alias("max"),
        ratio(F.first("_s"), total).alias("mean"),
        *picks,
    )
    out = []
    for i, q in enumerate(probs):
        if method == "linear":
            low, high = F.col(f"_r{2 * i}"), F.col(f"_r{2 * i + 1}")
            pos = (F.col("n") - 1) * q
            out.append((low + (high - low) * (pos - F.floor(pos))).alias(quantile_name(q)))
        else:
            out.append(F.col(f"_r{i}").alias(quantile_name(q)))
    return per_group.select(*keys, "n", "min", "max", "mean", *out)


def _crowded(hit: DataFrame, keys: Sequence[str], few: int) -> bool:
    """Has a bracket more than `few` different values? Only counts come to the driver."""
    if hit.count() <= few:  # from the footers of the stored files
        return False
    return (hit.groupBy(*keys, "_before").count().agg(F.max("count")).first()[0] or 0) > few


def _cut(
    hit: DataFrame, keys: Sequence[str], ranks: Sequence[Column], method: str, bound: int | None
) -> DataFrame:
    """The values of those slices of each bracket that hold a wanted rank, as new brackets.

    Slices are even between the bracket's own ends, so values that crowd in one corner of it are
    alone in their slice and are spread by the next cut.
    """
    width = F.col("_hi") - F.col("_lo")
    slot = F.coalesce(F.floor(F.try_divide(F.col("_v") - F.col("_lo"), width) * SLICES), F.lit(0))
    hit = hit.withColumn("_slice", F.least(slot, F.lit(SLICES - 1)).cast("int"))
    in_bracket = Window.partitionBy(*keys, "_before").orderBy("_slice")
    slices = (
        hit.groupBy(*keys, "_before", "_slice")
        .agg(
            F.sum("_w").alias("_sw"),
            F.min("_v").alias("_low"),
            F.max("_v").alias("_high"),
            F.max("_n").alias("_n"),
        )
        .withColumn("_from", F.col("_before") + _sum_before("_sw", in_bracket))
        .filter(_any_covered(ranks, F.col("_from"), F.col("_sw"), method))
        .select(*keys, "_before", "_slice", "_from", "_low", "_high")
    )
    kept = _meet(hit, _bounded(slices, bound), [*keys, "_before", "_slice"])
    return kept.select(
        *keys,
        F.col("_from").alias("_before"),
        "_v",
        "_w",
        "_n",
        "_s",
        "_min",
        "_max",
        F.col("_low").alias("_lo"),
        F.col("_high").alias("_hi"),
    )


def _sum_before(column: str, window) -> Column:
    """Running sum of the rows before the current one, 0 for the first."""
    before = window.rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(column).over(before), F.lit(0))


def _bounded(located: DataFrame, bound: int | None) -> DataFrame:
    """Each wanted rank lies in one bin of one group: that bounds the located rows."""
    return F.broadcast(located) if bound is not None and bound <= BROADCAST_ROW_BOUND else located


def _meet(rows: DataFrame, located: DataFrame, on: Sequence[str]) -> DataFrame:
    """Inner join that treats null keys as a group of their own."""
    other = located.withColumnsRenamed({k: f"_k_{k}" for k in on})
    same = F.lit(True)
    for k in on:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return rows.join(other, same).drop(*[f"_k_{k}" for k in on])


def _wanted_ranks(probs: Sequence[float], method: str) -> list[Column]:
    """Target positions per probability, as expressions over the group total `_n`."""
    n = F.col("_n")
    out: list[Column] = []
    for q in probs:
        if method == "linear":
            pos = (n - 1) * q
            out += [F.floor(pos), F.ceil(pos)]
        elif method == "nearest":
            out.append(F.floor((n - 1) * q + 0.5))
        else:
            out.append(n * q)
    return out


def _any_covered(ranks: Sequence[Column], start: Column, width: Column, method: str) -> Column:
    hit = F.lit(False)
    for rank in ranks:
        hit = hit | _covers(rank, start, width, method)
    return hit


def _covers(rank: Column, start: Column, width: Column, method: str) -> Column:
    """Does the run [start, start + width) hold the position?"""
    end = start + width
    if method == "weighted":
        # First value whose running weight reaches the target.
        return (end >= rank) & ((start < rank) | ((rank <= 0) & (start <= 0)))
    return (rank >= start) & (rank < end)


def histogram(
    df: DataFrame,
    value: str,
    bins: int,
    keys: Sequence[str] = (),
    weight: str | None = None,
    scale: str = "linear",
    low: float | None = None,
    high: float | None = None,
    open_interval: bool = False,
    density: bool = False,
    floor: float | None = None,
) -> DataFrame:
    """Equal-width histogram of `value` (or of its log10) with `bins` bins.

    Without low/high the range is the observed one; the last bin includes its right
    edge. `open_interval` drops values on or outside the given ends first. `floor` is
    the smallest left end of a log scale. Returns keys, bin, left, right and count: every group
    that has a value has all its bins, those without values with a count of 0.
    """
    if scale not in ("linear", "log10"):
        raise ValueError(f"scale must be linear/log10, got {scale!r}")
    keys = list(keys)
    x = F.col(value).cast("double")
    data = df.select(
        *keys, x.alias("_x"), (F.col(weight) if weight else F.lit(1)).alias("_w")
    ).filter(F.col("_x").isNotNull())
    if scale == "log10":
        data = data.filter(F.col("_x") > 0)
    if open_interval:
        data = data.filter((F.col("_x") > low) & (F.col("_x") < high))

    tx = F.log10("_x") if scale == "log10" else F.col("_x")
    if low is None or high is None or open_interval:
        ends = data.agg(F.min("_x").alias("lo"), F.max("_x").alias("hi"))
        if floor is not None:
            ends = ends.select(F.greatest("lo", F.lit(float(floor))).alias("lo"), "hi")
        if scale == "log10":
            ends = ends.select(F.log10("lo").alias("lo"), F.log10("hi").alias("hi"))
        lo = ends.select("lo").scalar()
        hi = ends.select("hi").scalar()
    else:
        a, b = (math.log10(low), math.log10(high)) if scale == "log10" else (low, high)
        lo, hi = F.lit(float(a)), F.lit(float(b))
        data = data.filter(tx.between(lo, hi))
    data = data.select(*keys, tx.alias("_t"), "_w", lo.alias("_lo"), hi.alias("_hi"))
    if floor is not None:
        data = data.filter(F.col("_t") >= F.col("_lo"))
    width = (F.col("_hi") - F.col("_lo")) / bins
    slot = F.coalesce(F.floor(F.try_divide(F.col("_t") - F.col("_lo"), width)), F.lit(0))
    counted = (
        data.withColumn("bin", F.greatest(F.least(slot, F.lit(bins - 1)), F.lit(0)).cast("int"))
        .groupBy(*keys, "bin", "_lo", "_hi")
        .agg(F.sum("_w").alias("count"))
    )
    # A group has at most `bins` counts: they are one row, which is dealt out again.
    filled = F.map_from_entries(F.collect_list(F.struct("bin", "count")))
    none = F.lit(0).cast(counted.schema["count"].dataType)
    counted = (
        counted.groupBy(*keys, "_lo", "_hi")
        .agg(filled.alias("_of"))
        .select("*", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
        .withColumn("count", F.coalesce(F.try_element_at("_of", F.col("bin")), none))
    )
    left = F.col("_lo") + F.col("bin") * width
    right = F.col("_lo") + (F.col("bin") + 1) * width
    if scale == "log10":
        left, right = F.pow(F.lit(10.0), left), F.pow(F.lit(10.0), right)
    out = counted.select(*keys, "bin", left.alias("left"), right.alias("right"), "count")
    if density:
        total = F.sum("count").over(Window.partitionBy(*keys))
        out = out.withColumn("density", ratio(F.col("count"), total * (F.col("right") - F.col("left"))))
    return out


def share_of_group(df: DataFrame, keys: Sequence[str], value: str, alias: str) -> DataFrame:
    """Each row's share of its group's total, on an already aggregated table; null on zero."""
    total = F.sum(value).over(Window.partitionBy(*keys))
    return df.withColumn(alias, ratio(F.col(value), total))


def relative_to_group_mean(
    df: DataFrame, keys: Sequence[str], value: str, alias: str
) -> DataFrame:
    """Each row divided by its group's mean, on an already aggregated table."""
    mean = F.avg(value).over(Window.partitionBy(*keys))
    return df.withColumn(alias, ratio(F.col(value), mean))


def top_per_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, rank: str = "rank"
) -> DataFrame:
    """The k first rows per group; `order` must break every tie.

    Spark trims each map task to k rows per group before the shuffle.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= k)

