import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from ebbflow.operators import stats
from ebbflow.session import shared_dir

PROBS = [0.0, 0.05, 0.25, 0.5, 0.75, 0.9, 0.99, 1.0]


def make(spark, rows):
    return spark.createDataFrame(rows, "g string, v double, w double").repartition(4)


@pytest.fixture(scope="module")
def skewed():
    """One value holds a third of a hot group; the groups differ by orders of magnitude."""
    rng = np.random.default_rng(7)
    hot = [("hot", 5.0, 2.0)] * 700 + [("hot", float(x), 1.0) for x in rng.lognormal(8, 2, 1400).round(2)]
    cold = [("cold", float(x), 3.0) for x in rng.normal(0, 50, 31).round(3)]
    return hot + cold + [("one", 4.5, 1.0), ("hot", None, 1.0), (None, 1.0, 1.0), (None, 3.0, 1.0)]


def grouped(rows):
    out = {}
    for g, v, w in rows:
        if v is not None:
            out.setdefault(g, []).append((v, w))
    return {g: (np.array([a for a, _ in x]), np.array([b for _, b in x])) for g, x in out.items()}


def test_linear_quantiles_equal_numpy(spark, skewed):
    got = {r.g: r for r in stats.exact_quantiles(make(spark, skewed), ["g"], "v", PROBS).collect()}
    want = grouped(skewed)
    assert set(got) == set(want)
    for g, (v, _) in want.items():
        for q in PROBS:
            assert math.isclose(got[g][stats.quantile_name(q)], np.quantile(v, q), rel_tol=1e-9, abs_tol=1e-9)
        assert got[g].n == len(v) and got[g].min == v.min() and got[g].max == v.max()
        assert math.isclose(got[g].mean, v.mean(), rel_tol=1e-9)


def test_nearest_quantiles_are_values_at_the_rounded_rank(spark, skewed):
    got = {r.g: r for r in stats.exact_quantiles(make(spark, skewed), ["g"], "v", PROBS, method="nearest", max_groups=4).collect()}
    for g, (v, _) in grouped(skewed).items():
        for q in PROBS:
            assert got[g][stats.quantile_name(q)] == np.sort(v)[math.floor((len(v) - 1) * q + 0.5)]


def test_weighted_quantiles_equal_cumulative_search(spark, skewed):
    out = stats.exact_quantiles(make(spark, skewed), ["g"], "v", PROBS, weight="w", method="weighted")
    got = {r.g: r for r in out.collect()}
    for g, (v, w) in grouped(skewed).items():
        order = np.argsort(v, kind="stable")
        v, w = v[order], w[order]
        cum = np.cumsum(w)
        for q in PROBS:
            want = v[min(np.searchsorted(cum, q * cum[-1]), len(v) - 1)]
            assert got[g][stats.quantile_name(q)] == want, (g, q)
        assert math.isclose(got[g].mean, (v * w).sum() / w.sum())


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.floats(-1e6, 1e6, allow_nan=False), min_size=1, max_size=60))
def test_any_values(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    row = stats.exact_quantiles(df, [], "v", [0.1, 0.5, 0.9], max_groups=1).first()
    for q in (0.1, 0.5, 0.9):
        assert math.isclose(row[stats.quantile_name(q)], np.quantile(values, q), rel_tol=1e-9, abs_tol=1e-6)


def test_quantile_arguments(spark):
    df = spark.createDataFrame([(1.0,)], "v double")
    with pytest.raises(ValueError):
        stats.exact_quantiles(df, [], "v", [0.5], method="lower")
    with pytest.raises(ValueError):
        stats.exact_quantiles(df, [], "v", [0.5], method="weighted")


def test_histogram_equals_numpy(spark):
    values = np.random.default_rng(1).exponential(100, 500).round(1) + 0.1
    df = spark.createDataFrame([(float(v), 2.0) for v in values], "v double, w double")
    counts, edges = np.histogram(values, bins=20)
    got = {r.bin: r for r in stats.histogram(df, "v", 20).collect()}
    assert [got[b]["count"] for b in range(20)] == list(counts) and 0 in counts
    assert all(math.isclose(got[b].left, edges[b]) for b in got)
    dense = stats.histogram(df, "v", 20, density=True).collect()
    assert math.isclose(sum(r.density * (r.right - r.left) for r in dense), 1.0)


def test_log_histogram_keeps_all_weight(spark):
    values = np.random.default_rng(2).lognormal(5, 2, 400)
    df = spark.createDataFrame([(float(v), 2.0) for v in values], "v double, w double")
    out = stats.histogram(df, "v", 59, weight="w", scale="log10").collect()
    assert math.isclose(sum(r["count"] for r in out), 800) and max(r.bin for r in out) == 58


def test_fixed_range_and_open_interval(spark):
    df = spark.createDataFrame([(float(v),) for v in (-1, 0, 1, 2, 3, 4, 5)], "v double")
    closed = {r.bin: r["count"] for r in stats.histogram(df, "v", 2, low=0, high=4).collect()}
    assert closed == {0: 2, 1: 3}
    assert sum(r["count"] for r in stats.histogram(df, "v", 2, low=0, high=4, open_interval=True).collect()) == 3


def test_single_value_histogram(spark):
    df = spark.createDataFrame([(3.0,), (3.0,)], "v double")
    assert sorted((r.bin, r["count"]) for r in stats.histogram(df, "v", 5).collect()) == [
        (0, 2), (1, 0), (2, 0), (3, 0), (4, 0)]


def test_histogram_has_every_bin_of_every_group(spark):
    rows = [("a", 0.0), ("a", 10.0), ("b", 4.9)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = stats.histogram(df, "v", 4, keys=["g"], density=True).orderBy("g", "bin").collect()
    assert [(r.g, r.bin, r["count"]) for r in got] == [
        ("a", 0, 1), ("a", 1, 0), ("a", 2, 0), ("a", 3, 1), ("b", 0, 0), ("b", 1, 1), ("b", 2, 0), ("b", 3, 0)]
    assert [(r.left, r.right) for r in got[:4]] == [(0.0, 2.5), (2.5, 5.0), (5.0, 7.5), (7.5, 10.0)]
    assert stats.histogram(df.limit(0), "v", 4).count() == 0


def test_shares_sum_to_one_and_zero_group_is_null(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("z", 0.0)], "g string, v double")
    got = stats.share_of_group(df, ["g"], "v", "share").collect()
    assert sum(r.share for r in got if r.g == "a") == 1.0
    assert [r.share for r in got if r.g == "z"] == [None]


def test_top_per_group_breaks_ties(spark):
    df = spark.createDataFrame([("a", "x", 1.0), ("a", "y", 1.0), ("a", "z", 2.0)], "g string, k string, v double")
    got = stats.top_per_group(df, ["g"], [F.desc("v"), F.col("k")], 2).orderBy("rank")
    assert [r.k for r in got.collect()] == ["z", "x"]


def test_settled_input_gives_the_same(spark, skewed):
    df = make(spark, skewed).filter("g = 'cold'")
    plain = stats.exact_quantiles(df, [], "v", [0.5], max_groups=1).first()
    assert stats.exact_quantiles(df, [], "v", [0.5], max_groups=1, settle=True).first() == plain


def test_narrow_range_is_cut_again(spark):
    """All values share one bin, a third of the rows are one value."""
    values = [1000.0 + k / 1e6 for k in range(2000)] + [1000.0005] * 1000
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(4)
    row = stats.exact_quantiles(df, [], "v", PROBS, max_groups=1).first()
    for q in PROBS:
        assert math.isclose(row[stats.quantile_name(q)], np.quantile(values, q), rel_tol=1e-12)


def test_fractional_and_zero_weights(spark):
    rng = np.random.default_rng(5)
    data = [(float(v), round(float(w), 3)) for v, w in zip(rng.lognormal(3, 1, 500), rng.random(500))]
    data = [(0.001, 0.0)] + data
    df = spark.createDataFrame(data, "v double, w double").repartition(4)
    row = stats.exact_quantiles(df, [], "v", PROBS, weight="w", method="weighted", max_groups=1).first()
    data.sort()
    v = np.array([a for a, _ in data])
    units = np.cumsum([round(b * 1000) for _, b in data])
    for q in PROBS:
        assert row[stats.quantile_name(q)] == v[np.searchsorted(units, q * units[-1])], q


def test_tiny_and_huge_weights_keep_their_ranks(spark):
    for unit in (1e-7, 1e15):
        df = spark.createDataFrame([("a", float(v), unit) for v in range(10)], "k string, v double, w double")
        got = stats.exact_quantiles(df, ["k"], "v", [0.5], method="weighted", weight="w").first()
        assert 4.0 in got.asDict().values()


def test_a_weight_that_would_vanish_fails(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 1e-30)], "v double, w double")
    with pytest.raises(Exception, match="below 1e-18"):
        stats.exact_quantiles(df, [], "v", [0.5], method="weighted", weight="w").collect()


def test_crowded_corners_are_cut_again(spark, monkeypatch):
    """20,000 tiny values and an outlier, then values that differ in their last bits only."""
    cuts, cut = [], stats._cut

    def counting(hit, *args):
        out = cut(hit, *args)
        cuts.append(hit.count())
        return out

    monkeypatch.setattr(stats, "_cut", counting)
    tiny = [1e-8 + k * 5e-13 for k in range(20_000)] + [9e-4]
    close = list(1e6 + np.arange(4000) * 1e-9) + [1e6 + 900.0]
    for values, few in ((tiny, 10), (close, 20), ([-v for v in tiny] + [0.0, 5e-324], 10)):
        cuts.clear()
        df = spark.createDataFrame([(float(v),) for v in values], "v double").repartition(4)
        row = stats.exact_quantiles(df, [], "v", PROBS, max_groups=1, few=few).first()
        for q in PROBS:
            assert math.isclose(row[stats.quantile_name(q)], np.quantile(values, q), rel_tol=1e-9, abs_tol=1e-300)
        assert cuts, few


def test_several_measures_of_each_row(spark, skewed):
    df = make(spark, skewed).withColumn("u", -F.col("v") / 7)
    measures = {"v": F.col("v"), "u": F.col("u"), "few": F.when(F.col("v") > 100, F.col("v"))}
    got = stats.measured_quantiles(df, ["g"], measures, PROBS, max_groups=4)
    found = {(r.g, r.measure): r for r in got.collect()}
    for g, (v, _) in grouped(skewed).items():
        for name, x in {"v": v, "u": -v / 7, "few": v[v > 100]}.items():
            if not len(x):
                assert (g, name) not in found
                continue
            row = found[g, name]
            assert row.n == len(x) and row.min == x.min() and row.max == x.max()
            for q in PROBS:
                assert math.isclose(row[stats.quantile_name(q)], np.quantile(x, q), rel_tol=1e-9, abs_tol=1e-9)
    with pytest.raises(ValueError):
        stats.measured_quantiles(df, [], measures, [0.5], method="weighted")


def test_a_stored_table_is_read_twice(spark, skewed):
    """Counted by the tasks that read it, whatever the number of measures."""
    path = shared_dir(spark)
    make(spark, skewed).write.parquet(path)
    reads = spark.sparkContext.accumulator(0)
    seen = F.udf(lambda x: reads.add(1) or x, "double").asNondeterministic()
    df = spark.read.parquet(path)
    watched = df.withColumn("v", seen("v"))
    measures = {"a": F.col("v"), "b": F.col("v") * 2, "c": F.col("v") * 3}
    out = stats.measured_quantiles(watched, ["g"], measures, [0.5], max_groups=4, settle=False)
    out.collect()
    out.collect()
    assert reads.value == 2 * df.count()
