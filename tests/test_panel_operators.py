"""Behaviour of the panel operators on small frames, several series at a time."""

import datetime as dt
import math
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from weftline.functions import quantiles
from weftline.functions.expr import mae, mape, mdape, right_closed_bin, wape
from weftline.operators import daily, decisions, factors, growth, models, prep, promo, stores, weekly
from weftline.operators.rollout import rollout, rule_model
from weftline.sources import tables

MONDAY = dt.date(2025, 1, 6)


def weeks(spark, values, sku="A", branch="B", **more):
    rows = [{"week": MONDAY + dt.timedelta(weeks=i), "sku_id": sku, "branch_id": branch, "units": None if v is None else float(v), **{k: x[i] if isinstance(x, list) else x for k, x in more.items()}} for i, v in enumerate(values)]
    return spark.createDataFrame(rows, ", ".join(["week date", "sku_id string", "branch_id string", "units double"] + [f"{k} {_kind(x)}" for k, x in more.items()]))


def _kind(x):
    x = x[0] if isinstance(x, list) else x
    return {int: "int", float: "double", str: "string"}[type(x)]


def test_lags_and_averages_stay_in_their_series(spark):
    both = weeks(spark, [1, 2, 3, 4, 5]).union(weeks(spark, [100, 200, 300], sku="Z"))
    got = {(r.sku_id, r.week): r for r in weekly.lag_features(both).collect()}
    first = got["Z", MONDAY]
    assert first.lag_1 is None and first.roll_4_mean is None and first.ema_4 is None
    last = got["A", MONDAY + dt.timedelta(weeks=4)]
    assert (last.lag_1, last.lag_2, last.lag_4, last.roll_4_mean) == (4, 3, 1, 2.5)
    one = weekly.lag_features(weeks(spark, [1, 2, 3, 4, 5])).orderBy("week").collect()
    assert [r.ema_4 for r in one] == [got["A", r.week].ema_4 for r in one]


def test_ema_is_pandas_with_gaps(spark):
    values = [3.0, None, 5.0, 8.0, None, None, 2.0, 4.0]
    got = [r.e for r in weekly.ema_sales(weeks(spark, values), name="e", span=4).orderBy("week").collect()]
    expected = pd.Series(values).ewm(span=4, adjust=False).mean().shift(1)
    assert all((g is None and math.isnan(e)) or abs(g - e) < 1e-12 for g, e in zip(got, expected, strict=True))


@pytest.mark.parametrize("span", [1, 4, 30])
def test_ema_carries_over_any_gap_and_any_length(spark, span):
    rng = random.Random(span)
    values = [rng.uniform(0, 100) if rng.random() < 0.7 else None for _ in range(2500)] + [None] * 1000 + [7.0, None, 9.0, float("nan"), 1.0]
    got = [r.e for r in weekly.with_ema_prior(weeks(spark, values), {"e": ("units", span)}).orderBy("week").collect()]
    expected = pd.Series(values, dtype=float).ewm(span=span, adjust=False).mean().shift(1)
    assert got[3400] is not None
    assert all((g is None and math.isnan(e)) or abs(g - e) < 1e-9 for g, e in zip(got, expected, strict=True))


def test_averages_share_one_exchange(spark):
    plan = weekly.lag_features(weeks(spark, [1.0, 2.0]))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("cells", [3, 256])
def test_quantiles_are_exact(spark, monkeypatch, cells):
    monkeypatch.setattr(quantiles, "CELLS", cells)
    rng = random.Random(cells)
    rows = [(rng.choice([0.0, -1.5, rng.gauss(0, 1)]), rng.choice([None, float(rng.randint(0, 3))]), None) for _ in range(999)]
    df = spark.createDataFrame(rows, "a double, b double, none double")
    shares = [0.0, 0.1, 0.25, 0.5, 0.77, 1.0]
    got = quantiles.exact_quantiles(df, {c: F.col(c) for c in df.columns}, shares)
    for i, c in enumerate("ab"):
        assert got[c] == pytest.approx(list(pd.Series([r[i] for r in rows], dtype=float).quantile(shares)))
    assert got["none"] == [None] * 6


def test_future_rows_change_nothing_before_them(spark):
    short = {r.week: r for r in weekly.lag_features(weeks(spark, [5, 6, 7])).collect()}
    long = {r.week: r for r in weekly.lag_features(weeks(spark, [5, 6, 7, 99, 100])).collect()}
    assert all(long[w] == r for w, r in short.items())


@pytest.mark.parametrize(
    ("row", "depth"),
    [
        (("direct_discount", 0.3, 0, 0, 0.0, 100.0), 0.3),
        (("discount_bundle", 0.4, 0, 0, 0.0, 100.0), 0.4),
        (("buy_x_get_y", 0.0, 2, 1, 0.0, 100.0), 1 / 3),
        (("buy_x_get_y", 0.0, 1, 1, 0.0, 100.0), 0.5),
        (("buy_gift", 0.0, 1, 0, 15.0, 100.0), 0.15),
        (("buy_gift", 0.0, 1, 0, 500.0, 100.0), 1.0),
        ((" Direct_Discount ", 1.5, 0, 0, 0.0, 100.0), 1.0),
        ((None, 0.9, 0, 0, 0.0, 100.0), 0.0),
        (("no_promo", 0.9, 0, 0, 0.0, 100.0), 0.0),
    ],
)
def test_promo_depth(spark, row, depth):
    df = spark.createDataFrame([row], "promo_type string, promo_discount double, promo_x_qty int, promo_y_qty int, gift_value double, price double")
    assert prep.promo_depth(df).first().promo_depth == pytest.approx(depth, abs=1e-4)


def test_promo_depth_defaults_and_keeps_what_is_there(spark):
    df = spark.createDataFrame([(1,)], "x int")
    assert prep.promo_depth(df).first().promo_depth == 0.0
    done = df.withColumn("promo_depth", F.lit(0.7))
    assert prep.promo_depth(done) is done


def test_validation_names_missing_columns(spark):
    with pytest.raises(ValueError, match="Missing columns"):
        prep.validate_columns(spark.createDataFrame([], "week date"))
    df = spark.createDataFrame([], ", ".join(f"{c} string" for c in prep.REQUIRED))
    assert prep.validate_columns(df) is df


def test_stockouts_take_the_median_of_their_own_series(spark):
    both = weeks(spark, [10, 12, 0, 11, 13, 0], stockout_flag=[0, 0, 1, 0, 0, 1]).union(weeks(spark, [0, 500, 700], sku="Z", stockout_flag=[1, 0, 0]))
    got = {(r.sku_id, r.week): r.units for r in prep.impute_stockouts(both).collect()}
    assert got["A", MONDAY + dt.timedelta(weeks=2)] == 11
    assert got["A", MONDAY + dt.timedelta(weeks=5)] == 11.5
    assert got["Z", MONDAY] == 600
    assert got["A", MONDAY] == 10


@pytest.mark.parametrize(("velocity", "weeks_"), [(15.0, 1), (6.0, 2), (3.0, 4), (0.0, 4), (None, 4)])
def test_lead_time(spark, velocity, weeks_):
    df = spark.createDataFrame([(10, velocity)], "display_units int, ema_sales_8w double")
    assert prep.lead_time(df).first().lead_time_weeks == weeks_


def test_split_is_a_partition(spark):
    got = {r.split: r["count"] for r in prep.time_split(weeks(spark, range(20))).groupBy("split").count().collect()}
    assert got == {"train": 11, "val": 4, "test": 5}


def test_scenarios(spark):
    df = weeks(spark, [1], price=100.0, promo_flag=0)
    got = {r.scenario: (r.promo_flag, r.price) for r in prep.scenarios(df).collect()}
    assert got == {"A": (0, 100.0), "B": (1, 50.0)}
    assert prep.scenarios(df, keep=["?"]).count() == 0


def _days(spark, n, units=lambda i: float(i + 1)):
    return spark.createDataFrame([(dt.date(2025, 1, 6) + dt.timedelta(days=i), "S", "B", units(i)) for i in range(n)], "date date, sku_id string, branch_id string, units double")


def test_daily_calendar(spark):
    days = spark.createDataFrame([(dt.date(2025, 1, 1),), (dt.date(2025, 1, 11),), (dt.date(2025, 1, 29),), (dt.date(2025, 1, 28),)], "date date")
    got = {r.date.day: r for r in daily.daily_time_features(days, tables.holiday_calendar(spark)).collect()}
    assert got[1].is_holiday == 1 and got[1].is_month_start == 1
    assert got[11].is_weekend == 1 and got[11].day_of_week == 5 and got[11].is_holiday == 0
    assert got[29].is_month_end == 1 and got[28].is_month_end == 0


def test_weekly_rollup_and_peak(spark):
    rows = daily.daily_to_weekly(daily.daily_time_features(_days(spark, 14, lambda i: [5.0, 9.0, 9.0, 1.0, 0.0, 0.0, 0.0][i % 7]))).orderBy("week").collect()
    assert len(rows) == 2 and rows[0].units == 24 and rows[0].peak_day == 1.0 and rows[0].peak_level == 9 / 24
    assert rows[0].weekend_ratio == pytest.approx(2 / 7)
    none = daily.daily_to_weekly(daily.daily_time_features(_days(spark, 7, lambda i: 0.0))).first()
    assert (none.peak_day, none.peak_level) == (0.0, 0.0)


def test_daily_windows_wait_until_they_are_full(spark):
    rows = daily.daily_features(_days(spark, 40)).orderBy("date").collect()
    assert rows[27].roll_28d_mean is None and rows[28].roll_28d_mean == 14.5
    assert all(rows[i].roll_7d_std is not None for i in range(28, 40))
    last = daily.last_of_week(daily.daily_features(_days(spark, 21))).orderBy("week").collect()
    assert len(last) == 3 and last[0].lag_1d_last == 6


def test_growth_and_bins(spark):
    df = weeks(spark, [10, 15, 20, 25, 30, 35], category="C1", sub_category="S1")
    rows = growth.growth_features(df).orderBy("week").collect()
    assert rows[1].qty_growth_1w == pytest.approx(0.5, abs=1e-6) and rows[1].category_growth_1w == pytest.approx(0.5, abs=1e-6)
    assert all(0 <= r.qty_growth_1w_bin <= 4 for r in rows)
    zero = growth.series_growth(weeks(spark, [0, 5])).orderBy("week").collect()
    assert math.isfinite(zero[1].qty_growth_1w)


def _promos(spark):
    kinds = ["no_promo"] * 4 + ["direct_discount"] * 2 + ["buy_x_get_y"] * 2
    depth = [0.0] * 4 + [0.3, 0.3, 0.2, 0.2]
    a = weeks(spark, [10] * 4 + [20, 20, 15, 15], branch="BR1", promo_flag=[0] * 4 + [1] * 4, promo_type=kinds, brand_type="X", promo_depth=depth)
    return a.union(weeks(spark, [5] * 4 + [10, 10, 8, 8], sku="B", branch="BR1", promo_flag=[0] * 4 + [1] * 4, promo_type=kinds, brand_type="X", promo_depth=depth))


def test_promo_effects(spark):
    df = _promos(spark)
    impact = promo.promo_type_impact(df).collect()
    assert sum(r.sample_size for r in impact) == 8
    assert {(r.promo_type, r.sku_id): round(r.uplift_pct) for r in impact}["direct_discount", "A"] == 100
    curve = promo.promo_depth_curve(df).collect()
    assert len(curve) == 5 and sum(r.sample_size for r in curve) == 8
    assert {r.depth_range: r.sample_size for r in curve} == {"0.00-0.20": 4, "0.20-0.40": 4, "0.40-0.60": 0, "0.60-0.80": 0, "0.80-1.00": 0}
    assert promo.promo_depth_curve(df, group="sku_id").count() == 10
    assert promo.promo_impact_summary(df).agg(F.sum("sample_size")).first()[0] == 8
    assert promo.promo_type_impact(df.drop("promo_type")).count() == 0
    assert promo.promo_impact_summary(df.where("promo_flag = 0")).count() == 0


def test_right_closed_bins(spark):
    rows = spark.createDataFrame([(x,) for x in (-0.1, 0.0, 0.2, 0.21, 1.0, 1.1)], "d double").select(right_closed_bin(F.col("d"), promo.depth_edges(5)).alias("b")).collect()
    assert [r.b for r in rows] == [None, 0, 0, 1, 4, None]


def test_metrics(spark):
    df = spark.createDataFrame([(10.0, 8.0), (10.0, 12.0)], "y double, p double")
    got = [*df.agg(*(f(F.col("y"), F.col("p")) for f in (wape, mae, mape))).first(), mdape(df, F.col("y"), F.col("p"))]
    assert got == pytest.approx((0.2, 2.0, 0.2, 0.2), abs=1e-6)
    zero = spark.createDataFrame([(0.0, 1.0)], "y double, p double").agg(wape(F.col("y"), F.col("p"))).first()[0]
    assert math.isfinite(zero)


def test_reorder(spark):
    df = spark.createDataFrame([("A", "B", 2, f, f"w{i}", 15) for i, f in enumerate([10.0, 12.0, 11.0, 13.0])] + [("C", "B", 1, 5.0, "w0", 100)], "sku_id string, branch_id string, lead_time_weeks int, forecast_units double, week string, on_hand int")
    got = {r.sku_id: r for r in decisions.reorder_plan(df).collect()}
    assert got["A"].demand_lt == 46 and got["A"].order_qty == pytest.approx(46 + 1.65 * math.sqrt(5 / 3) * math.sqrt(2) - 15)
    assert got["C"].order_qty == 0


def test_self_learning(spark):
    state = spark.createDataFrame([(1, 1.0), (3, 2.0)], "k int, value double")
    seen = spark.createDataFrame([(1, 12.0, 10.0), (2, 14.0, 10.0)], "k int, units double, prediction double")
    got = {r.k: r.value for r in decisions.index_update(state, seen, "k").collect()}
    assert got == pytest.approx({1: 1.04, 2: 1.08, 3: 2.0})
    rows = weeks(spark, [1, -2, 3, -1, 2, -3, 1, 0]).withColumnRenamed("units", "residual")
    assert decisions.safety_sigma(rows, window=4).first().safety_sigma == pytest.approx(pd.Series([2, -3, 1, 0]).std())
    assert decisions.safety_sigma(rows.limit(1)).first().safety_sigma == 0


def test_naive_baseline(spark):
    val = weeks(spark, [0]).union(weeks(spark, [0], sku="?"))
    got = {r.sku_id: r.prediction for r in decisions.seasonal_naive(weeks(spark, [10, 12, 24, None]), val).collect()}
    assert got == {"A": 24.0, "?": 0.0}


def test_kalman(spark, tmp_path):
    cfg = factors.FilterConfig()

    def after(*z):
        return spark.range(1).select(factors.fold(F.array(*(F.lit(v).cast("double") for v in z)), cfg).alias("s")).select("s.*").first()

    assert 1.0 < after(1.2).x < 1.2
    for bad in (float("nan"), -1.0, 0.0, float("inf"), None):
        got = after(bad)
        assert got.x == 1.0 and got.p > cfg.initial_p
    assert after(10.0).x <= 2.0
    assert abs(after(*[1.3] * 20).x - 1.3) < 0.1
    seen = spark.createDataFrame([("woy_1", 1.2)], "key string, z double")
    states = factors.update(factors.empty_states(spark), seen)
    factors.save_states(states, tmp_path / "s.json")
    back, _ = factors.load_states(spark, tmp_path / "s.json")
    assert back.first().x == states.first().x and factors.factor(back, "?") == 1.0
    moved = factors.update(back, spark.createDataFrame([], "key string, z double"))
    assert moved.collect() == back.collect()
    df = weeks(spark, [100, 50], promo_type=["a", None], pred_base=[50.0, 100.0])
    assert {r.key for r in factors.observe_promo(df).collect()} == {"promo_a", "promo_no_promo"}
    applied = factors.apply_promo(factors.apply_seasonal(df, states), factors.empty_states(spark))
    assert {r.promo_factor for r in applied.collect()} == {1.0} and applied.count() == 2
    assert factors.adjust_predictions(applied.withColumn("prediction", F.lit(2.0))).count() == 2


def test_rollout(spark):
    both = weeks(spark, range(10, 20)).union(weeks(spark, range(10, 20), sku="Z")).union(weeks(spark, [1], sku="old"))
    got = rollout(both, rule_model).collect()
    assert {(r.sku_id, r.horizon): r.forecast_units for r in got} == {(s, h): 19.0 + h for s in "AZ" for h in (1, 2, 4)}
    assert all(r.week == MONDAY + dt.timedelta(weeks=9 + r.horizon) for r in got)
    negative = rollout(both, lambda df: df.withColumn("prediction", F.lit(-5.0)), (1, 2))
    assert {r.forecast_units for r in negative.collect()} == {0.0} and negative.count() == 4
    assert rollout(both.where("sku_id = 'none'"), rule_model).columns == ["sku_id", "branch_id", "week", "horizon", "forecast_units"]
    assert rollout(both.where("sku_id = 'none'"), rule_model).count() == 0


def test_stores(spark):
    df = spark.createDataFrame([("s1", "A", "b1", 10.0, 12.0), ("s1", "A", "b2", 20.0, 18.0), ("s2", "B", "b3", 5.0, 6.0)], "sku_id string, store_type string, branch_id string, forecast_units double, units double")
    got = {r.sku_id: r for r in stores.store_type_rollup(df).collect()}
    assert got["s1"].branch_count == 2 and got["s1"].avg_forecast_per_branch == 15
    with pytest.raises(ValueError, match="Missing required columns"):
        stores.store_type_rollup(df.drop("branch_id"))
    rows = spark.createDataFrame([("b1", 10.0, 0, "2024-01-01", "X"), ("b1", 20.0, 1, "2024-01-08", "Y"), ("b2", 5.0, 0, "2024-01-01", None), ("b2", 7.0, 0, "2024-01-08", None)], "branch_id string, units double, promo int, week string, store_type string")
    p = {r.branch_id: r for r in stores.store_profiles(rows).collect()}
    assert p["b1"].promo_lift == pytest.approx(2.0) and p["b1"].store_type == "X" and p["b1"].seasonality_strength == pytest.approx(2.0)
    assert p["b2"].promo_lift == 1.0 and p["b2"].store_type == "unknown"


def test_clusters(spark):
    rows = [(f"b{i}", float(i // 5 * 100 + i), 0.1, 1.0, 0.0, 1.0, "T", "D", "S", "C") for i in range(10)]
    df = spark.createDataFrame(rows, "branch_id string, avg_weekly_sales double, volatility double, promo_lift double, stockout_rate double, seasonality_strength double, store_type string, display_capacity_type string, service_scale string, channel string")
    assert stores.cluster_stores(df, 2, 2).select("cluster").distinct().count() <= 2
    assert stores.cluster_stores(df.limit(6), 3, 4).select("cluster").distinct().count() == 1
    assert stores.cluster_stores(df.limit(0)).columns[-1] == "cluster"


def test_models_and_explanations(spark):
    df = weeks(spark, [float(10 + 3 * (i % 5)) for i in range(40)], price=100.0, promo_flag=0).transform(weekly.weekly_features).transform(prep.drop_warm_up)
    columns = ["sku_id", "lag_1", "roll_4_mean", "sin_woy"]
    for fitted in (models.poisson_glm(df, columns, reg=0.1), models.boosted_trees(df, columns, params={"rounds": 3})):
        got = fitted.predict(df)
        assert got.where("prediction < 0").isEmpty() and got.count() == df.count()
        assert dict(got.dtypes)["sku_id"] == "string"
    table = models.feature_importances(fitted, df)
    assert table.count() == 4
    perm = models.permutation_importance(fitted.predict, df, ["lag_1", "roll_4_mean"], repeats=1)
    assert {r.feature for r in perm.collect()} == {"lag_1", "roll_4_mean"}
    assert models.select_top_features(perm, 1e9).isEmpty()
    assert models.partial_dependence(fitted.predict, df, "lag_1", [1.0, 2.0]).count() == 2
    assert models.partial_dependence(fitted.predict, df, "lag_1", [1.0, 2.0], individual=True).count() == 2 * df.count()
    folds = models.time_folds(df, 3)
    assert folds.select("week").distinct().count() == folds.select("week", "fold").distinct().count()


def test_feature_registry():
    assert len(models.ALL_FEATURES) == 55 and len(models.CATEGORICAL) == 9 and len(set(models.ALL_FEATURES)) == 55


def test_holidays(spark, tmp_path):
    assert {dt.date(2025, 1, 1), dt.date(2025, 1, 27)} <= {r.date for r in tables.holiday_calendar(spark, years=[2025]).collect()}
    assert tables.default_holidays(spark, [2030]).count() == 4
    path = tmp_path / "h.csv"
    path.write_text("date,name\n2025-03-01,One\n2025-03-02,Two\n")
    assert tables.holiday_calendar(spark, str(path)).count() == 2
