"""Quantiles, segments, distributions and tests against pandas, numpy and brute force."""

import math

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from procurelens.functions.student_t import two_sided_tail, upper_quantile
from procurelens.operators import segments, stats
from procurelens.operators.quantiles import exact_quantiles, quantile_row, with_thresholds


def frame(spark, **columns):
    return spark.createDataFrame(pd.DataFrame(columns))


def by_series(df):
    return df.toPandas().set_index("series")


PROBS = {"p0": 0.0, "p15": 0.15, "third": 1 / 3, "half": 0.5, "p85": 0.85, "p100": 1.0}


def test_quantiles_match_pandas(spark):
    rng = np.random.default_rng(5)
    n = 20_011
    data = pd.DataFrame({
        "wide": rng.normal(0, 1e5, n),
        "money": np.round(rng.lognormal(3, 2, n), 2),
        "few": rng.integers(0, 5, n).astype(float),
        "hot": np.where(rng.random(n) < 0.4, 7.25, rng.normal(0, 1e-6, n)),
    })
    data.loc[::7, "money"] = np.nan
    got = by_series(exact_quantiles(spark.createDataFrame(data), list(data), PROBS))
    want = data.quantile(list(PROBS.values())).T
    want.columns = list(PROBS)
    np.testing.assert_allclose(got.loc[want.index].to_numpy(), want.to_numpy(), rtol=1e-13)


def test_quantiles_by_class(spark):
    data = pd.DataFrame({"k": list("aab") * 11, "x": np.arange(33.0)})
    got = exact_quantiles(spark.createDataFrame(data), ["x"], {"q": 0.3}, "k", ["a", "b"]).toPandas().set_index("k")["q"]
    want = data.groupby("k")["x"].quantile(0.3)
    np.testing.assert_allclose(got.sort_index(), want)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(-1e9, 1e9), min_size=1, max_size=40), st.floats(0, 1))
def test_any_quantile_of_any_list(spark, values, prob):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = quantile_row(df, {"q": ("x", prob)}).first().q
    assert got == pytest.approx(float(np.quantile(values, prob)), rel=1e-9, abs=1e-6)


def test_quantile_of_nothing_is_null(spark):
    assert quantile_row(spark.createDataFrame([(None,)], "x double"), {"q": ("x", 0.5)}).first().q is None


def test_many_near_values_and_edges(spark):
    df = spark.range(100_000).selectExpr("cast(id AS double) AS x")
    row = quantile_row(df, {"a": ("x", 0.25), "b": ("x", 0.75), "c": ("x", 0.15)}).first()
    assert (row.a, row.b, row.c) == (24999.75, 74999.25, pytest.approx(14999.85))


def test_thresholds_need_no_join(spark):
    df = frame(spark, x=[1.0, 2.0, 3.0])
    plan = with_thresholds(df, df.selectExpr("max(x) AS most"))._jdf.queryExecution().optimizedPlan().toString()
    assert "scalar-subquery" in plan and "Join" not in plan


def summary_rows(spark, n=60, seed=3):
    rng = np.random.default_rng(seed)
    bought = rng.integers(1, 40, n)
    sold = rng.integers(0, 60, n)
    price = np.round(rng.uniform(1, 20, n), 2)
    data = pd.DataFrame({
        "vendorname": rng.choice(["Acme", "Bolt", "Coil"], n), "description": rng.choice(list("abcdefgh"), n),
        "purchaseprice": price, "total_purchase_quantity": bought, "total_purchase_dollars": bought * price,
        "total_sales_quantity": sold, "total_sales_dollars": np.round(sold * price * rng.uniform(0.8, 2, n), 2),
    })
    data["gross_profit"] = data.total_sales_dollars - data.total_purchase_dollars
    data["profit_margin"] = np.where(
        data.total_sales_dollars == 0, 0, data.gross_profit / data.total_sales_dollars.replace(0, 1) * 100)
    data["stock_turnover"] = data.total_sales_quantity / data.total_purchase_quantity
    good = data[(data.gross_profit > 0) & (data.profit_margin > 0) & (data.total_sales_quantity > 0)]
    return spark.createDataFrame(data), data, good


def test_target_brands_are_the_labelled_ones(spark):
    df, _, good = summary_rows(spark)
    perf = good.groupby("description").agg(s=("total_sales_dollars", "sum"), m=("profit_margin", "mean"))
    want = set(perf[(perf.s <= perf.s.quantile(0.15)) & (perf.m >= perf.m.quantile(0.85))].index)
    labelled = segments.brand_categories(df).where("brand_category = 'Target Brand'")
    assert {r.description for r in segments.target_brands(df).collect()} == want
    assert {r.description for r in labelled.collect()} == want


def test_brand_at_both_thresholds_is_a_target(spark):
    one = pd.DataFrame({"description": ["a"] * 2, "total_sales_dollars": [5.0, 6.0], "profit_margin": [10.0, 20.0],
                        "gross_profit": [1.0, 1.0], "total_sales_quantity": [1, 1]})
    assert segments.target_brands(spark.createDataFrame(one)).count() == 1


def test_order_sizes_match_pandas(spark):
    df, _, good = summary_rows(spark)
    want = pd.qcut(good.total_purchase_quantity, q=3, labels=segments.ORDER_SIZES).astype(str)
    got = segments.with_order_size(segments.profitable(df)).toPandas()
    assert sorted(zip(got.total_purchase_quantity, got.order_size)) == sorted(zip(good.total_purchase_quantity, want))


def test_equal_order_size_edges_are_an_error(spark):
    df = frame(spark, total_purchase_quantity=[5, 5, 5, 5, 9])
    with pytest.raises(Exception, match="not distinct"):
        segments.with_order_size(df).collect()


def test_unsold_total_is_the_sum_over_vendors(spark):
    df, _, good = summary_rows(spark)
    want = ((good.total_purchase_quantity - good.total_sales_quantity) * good.purchaseprice).sum()
    assert segments.unsold_total(df).first()[0] == pytest.approx(want)
    assert sum(r.unsold_value for r in segments.unsold_by_vendor(df).collect()) == pytest.approx(want)


def test_turnover_filters(spark):
    df, data, good = summary_rows(spark)
    slow = data[data.stock_turnover < 1].groupby("vendorname").stock_turnover.mean().sort_values()
    assert [r.vendorname for r in segments.low_turnover(df).collect()] == list(slow.index)
    mean = data.groupby("vendorname").stock_turnover.mean()
    assert {r.vendorname for r in segments.low_turnover_having(df).collect()} == set(mean[mean < 1].index)


def test_describe_matches_pandas(spark):
    data = pd.DataFrame({"a": [1.0, 2.0, np.nan, 10.0], "b": [5.0] * 4, "c": [np.nan] * 3 + [1.0]})
    got = by_series(stats.describe(spark.createDataFrame(data)))
    want = data.describe().T
    want.columns = got.columns
    pd.testing.assert_frame_equal(got.loc[want.index], want, check_dtype=False, check_names=False)


def test_describe_keeps_an_empty_column(spark):
    df = spark.createDataFrame([(1.0, None)], "a double, b double")
    assert {r.series: r["count"] for r in stats.describe(df).collect()} == {"a": 1, "b": 0}


def test_correlation_is_pairwise_and_null_for_constants(spark):
    rng = np.random.default_rng(1)
    data = pd.DataFrame(rng.normal(size=(50, 3)), columns=list("abc"))
    data["d"], data["e"] = 4.0, data.a * 2 + 1
    data.loc[3:9, "a"] = np.nan
    got = stats.correlation_matrix(spark.createDataFrame(data)).toPandas().pivot(index="col_a", columns="col_b", values="corr")
    np.testing.assert_allclose(got.to_numpy(float), data.corr().to_numpy(), atol=1e-12)


@pytest.mark.parametrize("values", [
    np.arange(0, 151.0), np.r_[np.zeros(5), 0.1, 0.3, 1.0], np.full(4, 2.5), np.linspace(-3, 7, 301), np.array([1e-9, 3e5])])
def test_histogram_matches_numpy(spark, values):
    got = stats.histogram(frame(spark, x=values)).toPandas().sort_values("bin")
    counts, edges = np.histogram(values, bins=np.histogram_bin_edges(values, bins=30))
    assert list(got["rows"]) == list(counts)
    np.testing.assert_allclose(got.bin_low, edges[:-1])


def test_density_matches_the_formula(spark):
    values = np.r_[np.random.default_rng(2).gamma(2, 3, 80), [4.0] * 20]
    got = stats.density(frame(spark, x=values, flat=np.ones(100))).toPandas()
    assert set(got.series) == {"x"}
    got = got.sort_values("point")
    grid, h = np.linspace(values.min(), values.max(), 200), values.std(ddof=1) * 100 ** -0.2
    want = np.exp(-0.5 * ((grid[:, None] - values) / h) ** 2).sum(1) / (100 * h * np.sqrt(2 * np.pi))
    np.testing.assert_allclose(got.x, grid)
    np.testing.assert_allclose(got.density, want)


@pytest.mark.parametrize("values", [
    np.random.default_rng(4).normal(5, 2, 3000), np.r_[np.random.default_rng(6).exponential(1, 2000), 400.0, -9000.0],
    np.array([0.0, 1.0]), np.r_[np.full(500, 3.25), 3.5], np.linspace(-1e6, 1e6, 777), np.array([1e-9, 2e-9, 7e-9])])
def test_density_terms_left_out_are_below_rounding(spark, values):
    n, h = len(values), values.std(ddof=1) * len(values) ** -0.2
    grid = np.linspace(values.min(), values.max(), 200)
    want = np.exp(-0.5 * ((grid[:, None] - values) / h) ** 2).sum(1) / (n * h * np.sqrt(2 * np.pi))
    for terms, bound in ((18, 1e-10), (10, 2 * 8.0**-5 / math.sqrt(math.factorial(10)))):
        got = stats.density(frame(spark, x=values), terms=terms).toPandas().sort_values("point")
        assert len(got) == 200
        np.testing.assert_allclose(got.density * h, want * h, rtol=0, atol=bound)


def test_density_shuffles_cells_and_not_values(spark):
    df = spark.range(200_000, numPartitions=4).selectExpr("randn(3) AS x")
    plan = stats.density(df)._jdf.queryExecution().optimizedPlan().toString()
    grouped = [line for line in plan.splitlines() if "Aggregate [" in line]
    assert grouped and not any("value" in line.split("],")[0] for line in grouped)


def test_hermite_polynomials_match_numpy():
    for k, own in enumerate(stats.hermite(18)):
        np.testing.assert_array_equal(own, np.polynomial.hermite.herm2poly([0] * k + [1]))


def test_box_statistics(spark):
    x = np.r_[np.arange(1, 12.0), 40.0, -30.0]
    row = stats.box_stats(frame(spark, x=x)).first()
    q1, q3 = np.quantile(x, [0.25, 0.75])
    inside = x[(x >= q1 - 1.5 * (q3 - q1)) & (x <= q3 + 1.5 * (q3 - q1))]
    assert (row.q1, row.q3, row.whisker_low, row.whisker_high, row.outliers) == (q1, q3, inside.min(), inside.max(), 2)


DEGREES = [1.0, 2.0, 3.5, 9.0, 30.0, 99.0, 250.0, 1e4, 1e6]


def test_student_t_against_the_jvm(spark):
    jvm = spark.sparkContext._jvm.org.apache.commons.math3.distribution
    for v in DEGREES:
        law = jvm.TDistribution(None, v)
        t = np.array([0.1, 0.7, 1.0, 2.5, 6.0])
        tails = two_sided_tail(t, np.full_like(t, v))
        np.testing.assert_allclose(tails, [2 * law.cumulativeProbability(-x) for x in t], rtol=1e-9)
        levels = np.array([0.6, 0.9, 0.975, 0.9995])
        quantiles = upper_quantile(levels, np.full_like(levels, v))
        np.testing.assert_allclose(two_sided_tail(quantiles, np.full_like(levels, v)), 2 * (1 - levels), rtol=1e-9)
        np.testing.assert_allclose(quantiles, [law.inverseCumulativeProbability(p) for p in levels], rtol=1e-6)


def test_known_quantiles():
    assert upper_quantile(np.array([0.975]), np.array([9.0]))[0] == pytest.approx(2.262157162798239, rel=1e-13)
    assert upper_quantile(np.array([0.975]), np.array([1e9]))[0] == pytest.approx(1.959963984540054, rel=1e-8)
    assert upper_quantile(np.array([0.5]), np.array([5.0]))[0] == pytest.approx(0.0, abs=1e-12)


def test_interval_per_group(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", 6.0), ("a", None), ("b", 5.0)], "g string, x double")
    got = {r.g: r for r in stats.mean_interval(df, "x", ["g"]).collect()}
    half = 4.302652729911275 * np.std([1, 2, 6], ddof=1) / np.sqrt(3)
    assert (got["a"].n, got["a"].lower, got["a"].upper) == (3, pytest.approx(3 - half), pytest.approx(3 + half))
    assert (got["b"].mean, got["b"].std, got["b"].lower) == (5.0, None, None)


def test_welch_and_its_edges(spark):
    a, b = np.array([1.0, 2, 3, 4, 9]), np.array([4.0, 8, 9, 12])
    df = spark.createDataFrame([("a", float(x)) for x in a] + [("b", float(x)) for x in b], "g string, x double")
    row = stats.welch_test(df, "x", df.g == "a", df.g == "b").first()
    u, v = a.var(ddof=1) / 5, b.var(ddof=1) / 4
    assert row.t_stat == pytest.approx((a.mean() - b.mean()) / np.sqrt(u + v))
    assert row.df == pytest.approx((u + v) ** 2 / (u**2 / 4 + v**2 / 3))
    assert row.p_value == pytest.approx(float(two_sided_tail(np.array([row.t_stat]), np.array([row.df]))[0]))
    assert row.reject == (row.p_value < 0.05)
    lone = stats.welch_test(df.where("x = 9"), "x", df.g == "a", df.g == "b").first()
    assert (lone.n_a, lone.n_b, lone.t_stat, lone.p_value, lone.reject) == (1, 1, None, None, None)


def test_bands_keep_ties_on_both_sides(spark):
    df = frame(spark, total_sales_dollars=[1.0, 1.0, 1.0, 1.0], profit_margin=[1.0, 2.0, 3.0, 4.0])
    assert {r.band: r.n for r in stats.margin_intervals(df).collect()} == {"top": 4, "low": 4}
