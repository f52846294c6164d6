"""Every named query over the test tables, with independent SQL that checks it.

Doubles are rounded on both sides; weeks and days are strings. Each SQL text is written from the
operator's meaning, not from its plan.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.functions.expr import mae, mape, mdape, wape
from weftline.operators import boosting
from weftline.operators import daily as d
from weftline.operators import decisions, factors, growth, models, prep, promo, stores
from weftline.operators import weekly as w
from weftline.operators.rollout import rollout, rule_model
from weftline.plans import panel
from weftline.sources import files, model_store, tables

FLAGSHIP = "weekly_lag_features"
KEYS = ["sku_id", "branch_id"]
_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        _QUERIES[f.__name__] = f
        if sql is not None:
            _ORACLES[f.__name__] = sql
        return f

    return add


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLES)


def shown(df: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    """The named columns, with dates as strings and doubles rounded (negative zero as zero).

    Exact halves round differently in the two engines; both sides are moved off them by the same amount.
    """
    kinds = dict(df.dtypes)
    pick = lambda c: F.date_format(c, "yyyy-MM-dd") if kinds[c] in ("date", "timestamp", "timestamp_ntz") else F.round(F.col(c) + 1e-9, digits) + 0.0 if kinds[c] == "double" else F.col(c)
    return df.select(*(pick(c).alias(c) for c in names))


def R(expr: str, name: str | None = None) -> str:  # noqa: N802
    return f"round({expr} + 1e-9::DOUBLE, 6) + 0.0 AS {name or expr}"


WEEK = "strftime(week, '%Y-%m-%d') AS week"
S = "(PARTITION BY sku_id, branch_id ORDER BY week)"


def over(rows: str, order: str = "week") -> str:
    return f"OVER (PARTITION BY sku_id, branch_id ORDER BY {order} ROWS BETWEEN {rows})"


def ema(alpha: str, order: str = "week", value: str = "units") -> str:
    """Fold of all earlier values of the series, in order."""
    return f"list_reduce(list({value}) {over('UNBOUNDED PRECEDING AND 1 PRECEDING', order)}, lambda a, x: (1 - {alpha}) * a + {alpha} * x)"


def with_depth(spark, sf):
    return prep.promo_depth(panel.weekly(spark, sf))


@query(f"WITH {panel.WEEKLY}{panel.DEPTH} SELECT {WEEK}, sku_id, branch_id, promo_type, {R('promo_depth')} FROM depth")
def promo_depth(spark, sf):
    return shown(with_depth(spark, sf), "week", *KEYS, "promo_type", "promo_depth")


@query(f"""WITH {panel.WEEKLY} SELECT {WEEK}, sku_id, branch_id, CAST(weekofyear(week) AS INTEGER) AS week_of_year, CAST(month(week) AS INTEGER) AS month,
  {R('sin(2 * pi() * weekofyear(week) / 52)', 'sin_woy')}, {R('cos(2 * pi() * weekofyear(week) / 52)', 'cos_woy')} FROM panel""")
def weekly_time_features(spark, sf):
    return shown(w.time_features(panel.weekly(spark, sf)), "week", *KEYS, "week_of_year", "month", "sin_woy", "cos_woy")


@query(f"""WITH {panel.WEEKLY} SELECT {WEEK}, sku_id, branch_id, units, lag(units, 1) OVER {S} AS lag_1, lag(units, 2) OVER {S} AS lag_2, lag(units, 4) OVER {S} AS lag_4,
  {R('avg(units) ' + over('4 PRECEDING AND 1 PRECEDING'), 'roll_4_mean')}, {R(ema('0.4::DOUBLE'), 'ema_4')} FROM panel""")
def weekly_lag_features(spark, sf):
    return shown(w.lag_features(panel.weekly(spark, sf)), "week", *KEYS, "units", "lag_1", "lag_2", "lag_4", "roll_4_mean", "ema_4")


EMA8 = ema("(2.0::DOUBLE / 9)")


@query(f"WITH {panel.WEEKLY} SELECT {WEEK}, sku_id, branch_id, {R(EMA8, 'ema_sales_8w')} FROM panel")
def ema_sales_8w(spark, sf):
    return shown(w.ema_sales(panel.weekly(spark, sf)), "week", *KEYS, "ema_sales_8w")


GAPPED = "CASE WHEN (month(week) + length(sku_id)) % 3 <> 0 THEN units END"


@query(f"""WITH {panel.WEEKLY}, g AS (SELECT week, sku_id, branch_id, {GAPPED} AS u, row_number() OVER {S} AS n FROM panel),
f AS (SELECT *, list_reduce(list(struct_pack(y := u::DOUBLE, n := n)) FILTER (WHERE u IS NOT NULL) {over('UNBOUNDED PRECEDING AND 1 PRECEDING')},
  lambda a, x: struct_pack(y := (pow(0.6::DOUBLE, x.n - a.n) * a.y + 0.4::DOUBLE * x.y) / (pow(0.6::DOUBLE, x.n - a.n) + 0.4::DOUBLE), n := x.n)) AS e FROM g)
SELECT {WEEK}, sku_id, branch_id, {R('e.y', 'ema_4')} FROM f""")
def ema_over_gaps(spark, sf):
    """Months without values: the average is carried on and the next value weighs more."""
    rows = panel.weekly(spark, sf).withColumn("units", F.expr(GAPPED))
    return shown(w.with_ema_prior(rows, {"ema_4": ("units", 4)}), "week", *KEYS, "ema_4")


LEAD = f""",
lead AS (
  SELECT *, CASE WHEN cover <= 1 THEN 1 WHEN cover <= 2 THEN 2 ELSE 4 END AS lead_time_weeks
  FROM (SELECT *, display_units / ({EMA8} + 1e-9::DOUBLE) AS cover FROM panel)
)"""


@query(f"WITH {panel.WEEKLY}{LEAD} SELECT {WEEK}, sku_id, branch_id, {R('cover', 'weeks_of_cover')}, CAST(lead_time_weeks AS INTEGER) AS lead_time_weeks FROM lead")
def lead_time(spark, sf):
    return shown(prep.lead_time(w.ema_sales(panel.weekly(spark, sf))), "week", *KEYS, "weeks_of_cover", "lead_time_weeks")


@query(f"""WITH {panel.WEEKLY}, first AS (
  SELECT *, CASE WHEN stockout_flag = 1 THEN median(units) {over('4 PRECEDING AND 1 PRECEDING')} ELSE units END AS u FROM panel)
SELECT {WEEK}, sku_id, branch_id, stockout_flag, {R('CASE WHEN stockout_flag = 1 THEN coalesce(u, median(u) OVER (PARTITION BY sku_id, branch_id)) ELSE u END', 'units')} FROM first""")
def stockout_impute(spark, sf):
    return shown(prep.impute_stockouts(panel.weekly(spark, sf)), "week", *KEYS, "stockout_flag", "units")


@query(f"""WITH {panel.WEEKLY}, m AS (SELECT max(week) AS t FROM panel)
SELECT {WEEK}, sku_id, branch_id, CASE WHEN week >= t - INTERVAL 28 DAY THEN 'test' WHEN week >= t - INTERVAL 56 DAY THEN 'val' ELSE 'train' END AS split FROM panel, m""")
def time_split(spark, sf):
    return shown(prep.time_split(panel.weekly(spark, sf)), "week", *KEYS, "split")


@query(f"""WITH {panel.WEEKLY} SELECT {WEEK}, sku_id, branch_id, 'A' AS scenario, 0 AS promo_flag, {R('price')} FROM panel
UNION ALL SELECT {WEEK}, sku_id, branch_id, 'B', 1, round(price * 0.5 + 1e-9::DOUBLE, 6) + 0.0 FROM panel""")
def scenarios(spark, sf):
    return shown(prep.scenarios(panel.weekly(spark, sf)), "week", *KEYS, "scenario", "promo_flag", "price")


@query(f"WITH {panel.WEEKLY} SELECT {WEEK}, sku_id, branch_id, 'B' AS scenario, {R('price * 0.5', 'price')} FROM panel")
def scenario_selection(spark, sf):
    return shown(prep.scenarios(panel.weekly(spark, sf), keep=["B", "unknown"]), "week", *KEYS, "scenario", "price")


@query(f"WITH {panel.WEEKLY}, l AS (SELECT *, lag(units) OVER {S} AS lag_1 FROM panel) SELECT {WEEK}, sku_id, branch_id, lag_1 FROM l WHERE lag_1 IS NOT NULL")
def warm_up_dropped(spark, sf):
    return shown(prep.drop_warm_up(w.lag_features(panel.weekly(spark, sf))), "week", *KEYS, "lag_1")


HOLIDAYS = """
holidays AS (
  SELECT make_date(y, m, dd) AS date FROM (VALUES (2023), (2024), (2025), (2026)) a(y), (VALUES (1, 1), (4, 30), (5, 1), (9, 2)) b(m, dd)
  UNION SELECT CAST(s + to_days(CAST(i AS INTEGER)) AS DATE) FROM (VALUES (DATE '2023-01-20'), (DATE '2024-02-08'), (DATE '2025-01-25'), (DATE '2026-02-14')) t(s), range(7) r(i)
)"""


@query(f"WITH {HOLIDAYS} SELECT strftime(date, '%Y-%m-%d') AS date FROM holidays")
def holiday_calendar(spark, sf):
    return shown(tables.holiday_calendar(spark), "date")


DAYS = f"""{panel.DAILY}, {HOLIDAYS},
days AS (
  SELECT daily.*, isodow(daily.date) - 1 AS day_of_week, CAST(isodow(daily.date) >= 6 AS INTEGER) AS is_weekend, CAST(h.date IS NOT NULL AS INTEGER) AS is_holiday,
    CAST(day(daily.date) <= 3 AS INTEGER) AS is_month_start, CAST(month(daily.date + INTERVAL 3 DAY) <> month(daily.date) AS INTEGER) AS is_month_end
  FROM daily LEFT JOIN holidays h ON daily.date = h.date
)"""
DAY = "strftime(date, '%Y-%m-%d') AS date"


def with_days(spark, sf):
    return d.daily_time_features(panel.daily(spark, sf), tables.holiday_calendar(spark))


@query(f"WITH {DAYS} SELECT {DAY}, sku_id, branch_id, CAST(day_of_week AS INTEGER) AS day_of_week, is_weekend, is_holiday, is_month_start, is_month_end FROM days")
def daily_time_features(spark, sf):
    return shown(with_days(spark, sf), "date", *KEYS, "day_of_week", "is_weekend", "is_holiday", "is_month_start", "is_month_end")


@query(f"""WITH {DAYS} SELECT strftime(date_trunc('week', date), '%Y-%m-%d') AS week, sku_id, branch_id, sum(units) AS units, {R('avg(is_weekend)', 'weekend_ratio')}, max(is_holiday) AS holiday_flag,
  {R('avg(is_holiday)', 'holiday_ratio')}, max(is_month_start) AS month_start_flag, max(is_month_end) AS month_end_flag,
  CAST(arg_max(day_of_week, units * 100 - day_of_week) AS DOUBLE) AS peak_day, {R('max(units) / sum(units)', 'peak_level')} FROM days GROUP BY 1, 2, 3""")
def daily_to_weekly(spark, sf):
    return shown(d.daily_to_weekly(with_days(spark, sf)), "week", *KEYS, "units", *d.TIME_COLUMNS)


def _full(k: int, f: str) -> str:
    o = over(f"{k} PRECEDING AND 1 PRECEDING", "date")
    return f"CASE WHEN count(units) {o} = {k} THEN {f}(units) {o} END"


ROLLED = f"""{panel.DAILY}, rolled AS (SELECT date, sku_id, branch_id,
  {', '.join(f'lag(units, {k}) OVER (PARTITION BY sku_id, branch_id ORDER BY date) AS lag_{k}d' for k in d.DAILY_LAGS)},
  {', '.join(f'{_full(k, "avg")} AS roll_{k}d_mean' for k in d.MEANS)}, {', '.join(f'{_full(k, "stddev_samp")} AS roll_{k}d_std' for k in d.STDS)},
  {', '.join(f'{ema(f"(2.0::DOUBLE / {k + 1})", "date")} AS ema_{k}d' for k in d.EMAS)} FROM daily)"""


@query(f"WITH {ROLLED} SELECT {DAY}, sku_id, branch_id, {', '.join(R(c) for c in d.DAILY_COLUMNS)} FROM rolled")
def daily_lag_rolling(spark, sf):
    return shown(d.daily_features(panel.daily(spark, sf)), "date", *KEYS, *d.DAILY_COLUMNS)


@query(f"""WITH {ROLLED} SELECT strftime(date_trunc('week', date), '%Y-%m-%d') AS week, sku_id, branch_id,
  {', '.join(R(f'arg_max({c}, date) FILTER ({c} IS NOT NULL)', f'{c}_last') for c in d.DAILY_COLUMNS)} FROM rolled GROUP BY 1, 2, 3""")
def daily_last_of_week(spark, sf):
    return shown(d.last_of_week(d.daily_features(panel.daily(spark, sf))), "week", *KEYS, *d.LAST_COLUMNS)


@query(f"""WITH {DAYS}, wk AS (SELECT CAST(date_trunc('week', date) AS DATE) AS week, sku_id, branch_id, sum(units) AS units, avg(is_weekend) AS weekend_ratio FROM days GROUP BY 1, 2, 3),
l AS (SELECT *, lag(units, 1) OVER (PARTITION BY sku_id, branch_id ORDER BY date) AS lag_1d FROM daily),
last AS (SELECT CAST(date_trunc('week', date) AS DATE) AS week, sku_id, branch_id, arg_max(lag_1d, date) FILTER (lag_1d IS NOT NULL) AS lag_1d_last FROM l GROUP BY 1, 2, 3)
SELECT strftime(wk.week, '%Y-%m-%d') AS week, wk.sku_id, wk.branch_id, units, units AS units_daily, {R('weekend_ratio')}, lag_1d_last FROM wk LEFT JOIN last USING (week, sku_id, branch_id)""")
def weekly_daily_join(spark, sf):
    rows = panel.daily(spark, sf)
    weekly = rows.groupBy(*KEYS, d.monday()).agg(F.sum("units").alias("units"))
    return shown(d.join_daily(weekly, rows, tables.holiday_calendar(spark)), "week", *KEYS, "units", "units_daily", "weekend_ratio", "lag_1d_last")


def _grown(x: str, k: int, part: str) -> str:
    before = f"lag({x}, {k}) OVER (PARTITION BY {part} ORDER BY week)"
    return f"({x} - {before}) / ({before} + 1e-6::DOUBLE)"


@query(f"WITH {panel.WEEKLY} SELECT {WEEK}, sku_id, branch_id, {R(_grown('units', 1, 'sku_id, branch_id'), 'qty_growth_1w')}, {R(_grown('units', 4, 'sku_id, branch_id'), 'qty_growth_4w')} FROM panel")
def sku_growth(spark, sf):
    return shown(growth.series_growth(panel.weekly(spark, sf)), "week", *KEYS, "qty_growth_1w", "qty_growth_4w")


@query(f"""WITH {panel.WEEKLY}, c AS (SELECT category, week, sum(units) AS u FROM panel GROUP BY ALL), s AS (SELECT sub_category, week, sum(units) AS u FROM panel GROUP BY ALL),
cg AS (SELECT category, week, {_grown('u', 1, 'category')} AS c1, {_grown('u', 4, 'category')} AS c4 FROM c), sg AS (SELECT sub_category, week, {_grown('u', 1, 'sub_category')} AS s1, {_grown('u', 4, 'sub_category')} AS s4 FROM s)
SELECT {WEEK}, sku_id, branch_id, {R('c1', 'category_growth_1w')}, {R('c4', 'category_growth_4w')}, {R('s1', 'subcat_growth_1w')}, {R('s4', 'subcat_growth_4w')} FROM panel LEFT JOIN cg USING (category, week) LEFT JOIN sg USING (sub_category, week)""")
def category_growth(spark, sf):
    out = panel.weekly(spark, sf).transform(growth.group_growth, "category", "category").transform(growth.group_growth, "sub_category", "subcat")
    return shown(out, "week", *KEYS, "category_growth_1w", "category_growth_4w", "subcat_growth_1w", "subcat_growth_4w")


# Exact in both engines: growth as a ratio of whole numbers to six digits, then its quantiles.
@query(f"""WITH {panel.WEEKLY}, g AS (SELECT week, sku_id, branch_id, coalesce(round({_grown('units', 1, 'sku_id, branch_id')}, 6), 0) AS x FROM panel),
e AS (SELECT list_distinct(quantile_cont(x, [0, 0.2, 0.4, 0.6, 0.8, 1])) AS q FROM g), i AS (SELECT list_sort(q)[2:len(q) - 1] AS inner_edges FROM e)
SELECT {WEEK}, sku_id, branch_id, CAST(len(list_filter(inner_edges, lambda y: y <= x)) AS INTEGER) AS qty_growth_1w_bin FROM g, i""")
def growth_bins(spark, sf):
    rows = growth.series_growth(panel.weekly(spark, sf)).withColumn("qty_growth_1w", F.round("qty_growth_1w", 6))
    return shown(growth.growth_bins(rows, ["qty_growth_1w"]), "week", *KEYS, "qty_growth_1w_bin")


BASELINE = panel.DEPTH + """,
matched AS (
  SELECT *, coalesce(avg(CASE WHEN promo_flag = 0 THEN units END) OVER (PARTITION BY sku_id, branch_id), (SELECT avg(units) FROM depth WHERE promo_flag = 0), 0) AS baseline FROM depth
)"""
EFFECT = f"{R('avg(units)', 'promo_mean')}, {R('avg(baseline)', 'base_mean')}, count(*) AS sample_size, {R('(avg(units) - avg(baseline)) / (avg(baseline) + 1e-6::DOUBLE) * 100', 'uplift_pct')}"
EFFECTS = ["promo_mean", "base_mean", "sample_size", "uplift_pct"]


@query(f"WITH {panel.WEEKLY}{BASELINE} SELECT {WEEK}, sku_id, branch_id, {R('baseline')} FROM matched")
def matched_baseline(spark, sf):
    return shown(promo.matched_baseline(panel.weekly(spark, sf)), "week", *KEYS, "baseline")


@query(f"WITH {panel.WEEKLY}{BASELINE} SELECT promo_type, sku_id, {EFFECT} FROM matched WHERE promo_flag = 1 GROUP BY 1, 2")
def promo_type_impact(spark, sf):
    return shown(promo.promo_type_impact(panel.weekly(spark, sf)), "promo_type", "sku_id", *EFFECTS)


CURVE = ", ".join(f"({i}, '{i / 5:.2f}-{(i + 1) / 5:.2f}', {i} * (1.0::DOUBLE / 5), {1.0 if i == 4 else f'{i + 1} * (1.0::DOUBLE / 5)'})" for i in range(5))


@query(f"""WITH {panel.WEEKLY}{BASELINE}, bins(i, depth_range, a, b) AS (VALUES {CURVE}), p AS (SELECT * FROM matched WHERE promo_flag = 1)
SELECT depth_range, {R('avg(promo_depth)', 'avg_depth')}, {R('avg(units)', 'promo_mean')}, {R('avg(baseline)', 'base_mean')}, count(units) AS sample_size,
  {R('(avg(units) - avg(baseline)) / (avg(baseline) + 1e-6::DOUBLE) * 100', 'uplift_pct')}
FROM bins LEFT JOIN p ON promo_depth <= b AND (promo_depth > a OR (i = 0 AND promo_depth >= a)) GROUP BY depth_range""")
def promo_depth_curve(spark, sf):
    return shown(promo.promo_depth_curve(with_depth(spark, sf)), "depth_range", "avg_depth", *EFFECTS)


@query(f"WITH {panel.WEEKLY}{BASELINE} SELECT promo_type, brand_type, {EFFECT} FROM matched WHERE promo_flag = 1 GROUP BY 1, 2")
def promo_impact_summary(spark, sf):
    return shown(promo.promo_impact_summary(panel.weekly(spark, sf)), "promo_type", "brand_type", *EFFECTS)


# The mean of the last four weeks stands in for a forecast, so that no model's chance enters an oracle.
PRED = f""",
pred AS (SELECT *, avg(units) {over('4 PRECEDING AND 1 PRECEDING')} AS prediction FROM lead QUALIFY prediction IS NOT NULL)"""


def predicted(spark, sf):
    rows = prep.lead_time(w.ema_sales(panel.weekly(spark, sf)))
    return rows.withColumn("prediction", F.avg("units").over(w.series_window().rowsBetween(-4, -1))).where("prediction IS NOT NULL")


@query(f"""WITH {panel.WEEKLY}{LEAD}{PRED} SELECT sku_id, store_type, {R('sum(prediction)', 'forecast_units')}, sum(units) AS units, count(DISTINCT branch_id) AS branch_count,
  {R('sum(prediction) / count(DISTINCT branch_id)', 'avg_forecast_per_branch')} FROM pred GROUP BY 1, 2""")
def store_type_rollup(spark, sf):
    return shown(stores.store_type_rollup(predicted(spark, sf).withColumnRenamed("prediction", "forecast_units")), "sku_id", "store_type", "forecast_units", "units", "branch_count", "avg_forecast_per_branch")


def _mode(c: str) -> str:
    return f"(SELECT {c} FROM panel q WHERE q.branch_id = p.branch_id GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) AS {c}"


@query(f"""WITH {panel.WEEKLY}, m AS (SELECT branch_id, weekofyear(week) AS k, avg(units) AS m FROM panel GROUP BY ALL), s AS (SELECT branch_id, CASE WHEN min(m) > 0 THEN max(m) / (min(m) + 1e-9::DOUBLE) ELSE 1 END AS ss FROM m GROUP BY 1),
p AS (SELECT branch_id, avg(units) AS a, stddev_pop(units) / (avg(units) + 1e-9::DOUBLE) AS v, coalesce(avg(units) FILTER (promo_flag = 1) / (avg(units) FILTER (promo_flag = 0) + 1e-9::DOUBLE), 1) AS l, avg(stockout_flag) AS r FROM panel GROUP BY 1)
SELECT branch_id, {R('a', 'avg_weekly_sales')}, {R('v', 'volatility')}, {R('l', 'promo_lift')}, {R('r', 'stockout_rate')}, {R('ss', 'seasonality_strength')}, {', '.join(map(_mode, stores.KINDS))} FROM p JOIN s USING (branch_id)""")
def store_profiles(spark, sf):
    return shown(stores.store_profiles(panel.weekly(spark, sf).withColumnRenamed("promo_flag", "promo")), "branch_id", *stores.NUMERIC, *stores.KINDS)


@query(f"""WITH {panel.WEEKLY}, m AS (SELECT max(week) AS t FROM panel), last AS (SELECT sku_id, branch_id, arg_max(units, week) AS u FROM panel, m WHERE week < t - INTERVAL 56 DAY GROUP BY 1, 2)
SELECT {WEEK}, sku_id, branch_id, coalesce(u, 0.0) AS prediction FROM panel LEFT JOIN last USING (sku_id, branch_id), m WHERE week >= t - INTERVAL 56 DAY AND week < t - INTERVAL 28 DAY""")
def seasonal_naive(spark, sf):
    rows = prep.time_split(panel.weekly(spark, sf))
    return shown(decisions.seasonal_naive(rows.where("split = 'train'"), rows.where("split = 'val'")), "week", *KEYS, "prediction")


@query(f"""WITH {panel.WEEKLY}{LEAD}{PRED} SELECT {R('sum(abs(units - prediction)) / (sum(abs(units)) + 1e-6::DOUBLE)', 'wape')}, {R('avg(abs(units - prediction))', 'mae')},
  {R('avg(abs(units - prediction) / greatest(abs(units), 1e-6::DOUBLE))', 'mape')}, {R('median(abs(units - prediction) / greatest(abs(units), 1e-6::DOUBLE))', 'mdape')} FROM pred""")
def forecast_metrics(spark, sf):
    y, p = F.col("units"), F.col("prediction")
    rows = predicted(spark, sf)
    return shown(rows.agg(wape(y, p).alias("wape"), mae(y, p).alias("mae"), mape(y, p).alias("mape"), F.lit(mdape(rows, y, p)).alias("mdape")), "wape", "mae", "mape", "mdape")


@query(f"""WITH {panel.WEEKLY}{LEAD}{PRED}, g AS (SELECT sku_id, branch_id, lead_time_weeks, sum(prediction) AS demand_lt, coalesce(stddev_samp(prediction), 0) AS sigma, arg_min(on_hand, week) AS on_hand FROM pred GROUP BY 1, 2, 3),
r AS (SELECT *, demand_lt + 1.65::DOUBLE * sigma * sqrt(lead_time_weeks) AS rop FROM g)
SELECT sku_id, branch_id, CAST(lead_time_weeks AS INTEGER) AS lead_time_weeks, {R('demand_lt')}, {R('sigma')}, on_hand, {R('rop', 'reorder_point')}, {R('greatest(rop - on_hand, 0)', 'order_qty')} FROM r""")
def reorder_plan(spark, sf):
    rows = predicted(spark, sf).withColumnRenamed("prediction", "forecast_units")
    return shown(decisions.reorder_plan(rows), *KEYS, "lead_time_weeks", "demand_lt", "sigma", "on_hand", "reorder_point", "order_qty")


def _start(spark, kind: str, keys: str) -> DataFrame:
    return spark.sql(f"SELECT CAST(k AS {kind}) AS k, 1.1D AS value FROM VALUES {keys} AS t(k)")


def _index(key: str, keys: str) -> str:
    return f"""WITH {panel.WEEKLY}{LEAD}{PRED}, seen AS (SELECT {key} AS k, avg(units / (prediction + 1e-9::DOUBLE)) AS r FROM pred GROUP BY 1), old AS (SELECT k, 1.1::DOUBLE AS v FROM (VALUES {keys}) t(k))
SELECT coalesce(seen.k, old.k) AS k, round(CASE WHEN r IS NULL THEN v ELSE 0.8::DOUBLE * coalesce(v, 1) + 0.2::DOUBLE * r END + 1e-9::DOUBLE, 6) + 0.0 AS value FROM seen FULL JOIN old ON seen.k = old.k"""


@query(_index("CAST(weekofyear(week) AS INTEGER)", "(1), (2), (99)"))
def seasonal_index(spark, sf):
    rows = predicted(spark, sf).withColumn("k", F.weekofyear("week"))
    return shown(decisions.index_update(_start(spark, "int", "(1), (2), (99)"), rows, "k"), "k", "value")


@query(_index("branch_type", "('ASIA'), ('MOON')"))
def branch_adjustment(spark, sf):
    rows = predicted(spark, sf).withColumn("k", F.col("branch_type"))
    return shown(decisions.index_update(_start(spark, "string", "('ASIA'), ('MOON')"), rows, "k"), "k", "value")


@query(f"""WITH {panel.WEEKLY}{LEAD}{PRED}, l AS (SELECT *, row_number() OVER (PARTITION BY sku_id, branch_id ORDER BY week DESC) AS n FROM pred)
SELECT sku_id, branch_id, {R('coalesce(stddev_samp(units - prediction), 0)', 'safety_sigma')} FROM l WHERE n <= 8 GROUP BY 1, 2""")
def safety_sigma(spark, sf):
    rows = predicted(spark, sf).withColumn("residual", F.col("units") - F.col("prediction"))
    return shown(decisions.safety_sigma(rows), *KEYS, "safety_sigma")


def _one_update(key: str) -> str:
    """From the initial state, one observation a key: gain 0.1 / 0.15, P' = (1 - K) P + Q."""
    return f"""SELECT {key} AS key, round(least(greatest(1 + 0.1::DOUBLE / 0.15::DOUBLE * (sum(units) / sum(prediction) - 1), 0.5), 2.0) + 1e-9::DOUBLE, 6) + 0.0 AS x, round((1 - 0.1::DOUBLE / 0.15::DOUBLE) * 0.1::DOUBLE + 0.01::DOUBLE + 1e-9::DOUBLE, 6) AS p
FROM pred GROUP BY 1 HAVING sum(prediction) > 0"""


WOY, PROMO = "'woy_' || weekofyear(week)", "'promo_' || coalesce(promo_type, 'no_promo')"


@query(f"WITH {panel.WEEKLY}{LEAD}{PRED} {_one_update(WOY)}")
def kalman_seasonal(spark, sf):
    return shown(factors.update(factors.empty_states(spark), factors.observe_seasonal(predicted(spark, sf), pred="prediction")), "key", "x", "p")


@query(f"WITH {panel.WEEKLY}{LEAD}{PRED} {_one_update(PROMO)}")
def kalman_promo(spark, sf):
    return shown(factors.update(factors.empty_states(spark), factors.observe_promo(predicted(spark, sf), pred="prediction")), "key", "x", "p")


@query(f"""WITH {panel.WEEKLY}{LEAD}{PRED}, sf AS ({_one_update(WOY)}), pf AS ({_one_update(PROMO)})
SELECT {WEEK}, sku_id, branch_id, round(coalesce(sf.x, 1.0) + 1e-9::DOUBLE, 6) + 0.0 AS seasonal_factor, round(coalesce(pf.x, 1.0) + 1e-9::DOUBLE, 6) + 0.0 AS promo_factor FROM panel LEFT JOIN sf ON sf.key = {WOY} LEFT JOIN pf ON pf.key = {PROMO}""")
def kalman_apply(spark, sf):
    seasonal, kinds = kalman_seasonal(spark, sf), kalman_promo(spark, sf)
    return shown(factors.apply_promo(factors.apply_seasonal(panel.weekly(spark, sf), seasonal), kinds), "week", *KEYS, "seasonal_factor", "promo_factor")


@query(f"""WITH RECURSIVE {panel.WEEKLY}, z AS (SELECT sku_id, week, row_number() OVER (PARTITION BY sku_id ORDER BY week) AS n, sum(units) / (100 + sum(display_units)) AS z FROM panel GROUP BY sku_id, week),
f AS (SELECT sku_id, 0::BIGINT AS n, 1.0::DOUBLE AS x, 0.1::DOUBLE AS p FROM (SELECT DISTINCT sku_id FROM z)
  UNION ALL SELECT f.sku_id, z.n, least(greatest(x + p / (p + 0.05::DOUBLE) * (z - x), 0.5), 2.0), (1 - p / (p + 0.05::DOUBLE)) * p + 0.01::DOUBLE FROM f JOIN z ON z.sku_id = f.sku_id AND z.n = f.n + 1)
SELECT sku_id AS key, {R('arg_max(x, n)', 'x')}, {R('arg_max(p, n)', 'p')} FROM f GROUP BY 1""")
def kalman_fold(spark, sf):
    z = panel.weekly(spark, sf).groupBy("sku_id", "week").agg((F.sum("units") / (100 + F.sum("display_units"))).alias("z"))
    # One measurement a week: a series is as long as the calendar.
    series = z.groupBy(F.col("sku_id").alias("key")).agg(F.sort_array(F.collect_list(F.struct("week", "z"))).alias("m"))
    state = series.select("key", factors.fold(F.col("m.z"), factors.FilterConfig()).alias("s"))
    return shown(state.select("key", "s.x", "s.p"), "key", "x", "p")


@query(f"""WITH {panel.WEEKLY}, m AS (SELECT max(week) AS t FROM panel)
SELECT strftime(week + to_days(CAST(7 * h AS INTEGER)), '%Y-%m-%d') AS week, sku_id, branch_id, CAST(h AS INTEGER) AS horizon, units + h AS forecast_units FROM panel, m, (VALUES (1), (2), (4)) v(h) WHERE week = t""")
def rollout_rule_model(spark, sf):
    return shown(rollout(panel.weekly(spark, sf), rule_model), "week", *KEYS, "horizon", "forecast_units")


@query(f"""WITH {panel.WEEKLY}, m AS (SELECT max(week) AS t FROM panel), e AS (SELECT sku_id, branch_id, week, units, list(units) {over('3 PRECEDING AND CURRENT ROW')} AS l,
  list_reduce(list(units) {over('UNBOUNDED PRECEDING AND CURRENT ROW')}, lambda a, x: 0.6::DOUBLE * a + 0.4::DOUBLE * x) AS y FROM panel),
one AS (SELECT sku_id, branch_id, week, l, y, 0.5::DOUBLE * list_avg(l) + 0.5::DOUBLE * y AS f1 FROM e, m WHERE week = t),
two AS (SELECT *, 0.5::DOUBLE * list_avg(list_append(l, f1)[-4:]) + 0.5::DOUBLE * (0.6::DOUBLE * y + 0.4::DOUBLE * f1) AS f2 FROM one)
SELECT strftime(week + to_days(7), '%Y-%m-%d') AS week, sku_id, branch_id, 1 AS horizon, {R('f1', 'forecast_units')} FROM two UNION ALL SELECT strftime(week + to_days(14), '%Y-%m-%d'), sku_id, branch_id, 2, round(f2 + 1e-9::DOUBLE, 6) + 0.0 FROM two""")
def rollout_blend_model(spark, sf):
    blend = lambda df: df.withColumn("prediction", 0.5 * F.col("roll_4_mean") + 0.5 * F.col("ema_4"))
    return shown(rollout(panel.weekly(spark, sf), blend, (1, 2)), "week", *KEYS, "horizon", "forecast_units")


MODEL_FEATURES = ["branch_type", "store_type", "price", "promo_flag", "sin_woy", "cos_woy", "lag_1", "lag_2", "lag_4", "roll_4_mean", "ema_4"]


def training_frame(spark, sf):
    return prep.time_split(prep.drop_warm_up(w.weekly_features(prep.impute_stockouts(panel.weekly(spark, sf)))))


@query()
def poisson_glm(spark, sf):
    rows = training_frame(spark, sf)
    return shown(models.poisson_glm(rows.where("split = 'train'"), MODEL_FEATURES, reg=0.01).predict(rows.where("split <> 'train'")), "week", *KEYS, "units", "prediction")


@query()
def gbt_forecast(spark, sf):
    rows = training_frame(spark, sf)
    known = rows.where("split <> 'test'").withColumn("_stop", F.col("split") == "val")
    fitted = models.boosted_trees(known, MODEL_FEATURES, validation="_stop")
    return shown(rollout(w.time_features(panel.weekly(spark, sf)), fitted.predict), "week", *KEYS, "horizon", "forecast_units")


@query()
def shap_summary(spark, sf):
    rows = training_frame(spark, sf)
    fitted = models.boosted_trees(rows.where("split = 'train'"), MODEL_FEATURES, params={"rounds": 60})
    return shown(fitted.shap_summary(rows.where("split = 'val'")), "feature", "mean_abs_shap", "mean_shap")


@query(f"""WITH {panel.WEEKLY}, f AS (SELECT week, ntile(4) OVER (ORDER BY week) - 1 AS fold FROM (SELECT DISTINCT week FROM panel))
SELECT {WEEK}, sku_id, branch_id, CAST(fold AS INTEGER) AS fold FROM panel JOIN f USING (week)""")
def time_folds(spark, sf):
    return shown(models.time_folds(panel.weekly(spark, sf)), "week", *KEYS, "fold")


@query(f"""WITH {panel.WEEKLY}, f AS (SELECT avg(units) {over('4 PRECEDING AND 1 PRECEDING')} AS r, lag(units, 1) OVER {S} AS l FROM panel)
SELECT g AS grid, {R('avg(0.5::DOUBLE * g + 0.25::DOUBLE * coalesce(r, 0))', 'prediction')} FROM f, (SELECT unnest([25.0, 50.0, 100.0]::DOUBLE[]) AS g) GROUP BY g""")
def pdp_rule_model(spark, sf):
    """Partial dependence of a model that is a formula."""
    rows = w.lag_features(panel.weekly(spark, sf))
    rule = lambda df: df.withColumn("prediction", 0.5 * F.col("lag_1") + 0.25 * F.coalesce("roll_4_mean", F.lit(0.0)))
    return shown(models.partial_dependence(rule, rows, "lag_1", [25.0, 50.0, 100.0]), "grid", "prediction")


@query()
def store_clusters(spark, sf):
    profiles = stores.store_profiles(panel.weekly(spark, sf).withColumnRenamed("promo_flag", "promo"))
    return shown(stores.cluster_stores(profiles), "branch_id", "cluster")


@query()
def permutation_importance(spark, sf):
    rows = training_frame(spark, sf)
    fitted = models.poisson_glm(rows.where("split = 'train'"), MODEL_FEATURES, reg=0.01)
    return shown(models.permutation_importance(fitted.predict, rows.where("split = 'val'").select(*KEYS, "week", "units", *MODEL_FEATURES), MODEL_FEATURES), "feature", "importance", "deviation")


@query()
def pdp_table(spark, sf):
    rows = training_frame(spark, sf)
    fitted = models.poisson_glm(rows.where("split = 'train'"), MODEL_FEATURES, reg=0.01)
    return shown(models.partial_dependence(fitted.predict, rows.where("split = 'val'"), "roll_4_mean", [25.0, 50.0, 100.0, 200.0]), "grid", "prediction")


@query()
def param_search(spark, sf):
    rows = training_frame(spark, sf).where("split = 'train'")
    found = models.param_search(rows, MODEL_FEATURES, trials=50)
    return spark.createDataFrame([(i + 1, s, str(p)) for i, (s, p) in enumerate(found)], "place int, wape double, params string")


@query(f"""WITH {panel.WEEKLY}{panel.DEPTH} SELECT {WEEK}, sku_id, branch_id, units, {R('price')}, promo_flag, brand_type, branch_type, stockout_flag, CAST(display_units AS INTEGER) AS display_units, {R('promo_depth')} FROM depth""")
def validated_panel(spark, sf):
    """The required columns of a panel that has them all."""
    return shown(prep.validate_columns(with_depth(spark, sf)), *prep.REQUIRED)


@query(f"""WITH {panel.WEEKLY} SELECT {WEEK}, sku_id, branch_id, brand_type, branch_type, channel, store_type, display_capacity_type, service_scale, {R('price')}, promo_flag,
  {R('sin(2 * pi() * weekofyear(week) / 52)', 'sin_woy')}, {R('cos(2 * pi() * weekofyear(week) / 52)', 'cos_woy')}, lag(units, 1) OVER {S} AS lag_1, lag(units, 2) OVER {S} AS lag_2, lag(units, 4) OVER {S} AS lag_4,
  {R('avg(units) ' + over('4 PRECEDING AND 1 PRECEDING'), 'roll_4_mean')}, {R(ema('0.4::DOUBLE'), 'ema_4')} FROM panel""")
def feature_projection(spark, sf):
    """The registry's features that the weekly frame has, in its order."""
    rows = models.project_features(w.weekly_features(panel.weekly(spark, sf)), ["week"])
    return shown(rows, *rows.columns)


def _z(c: str) -> str:
    return f"CASE WHEN stddev_pop({c}) OVER () > 0 THEN ({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER () ELSE 0 END"


@query(f"WITH s AS ({_ORACLES['store_profiles']}) SELECT branch_id, {', '.join(R(_z(c), 'z_' + c) for c in stores.NUMERIC)} FROM s")
def profile_z_scores(spark, sf):
    """The numeric part of what stores are clustered by."""
    rows = stores.profile_features(store_profiles(spark, sf)).withColumn("z", vector_to_array("features"))
    rows = rows.select("branch_id", *(F.col("z")[i].alias(f"z_{c}") for i, c in enumerate(stores.NUMERIC)))
    return shown(rows, *rows.columns)


@query(_ORACLES["holiday_calendar"])
def holiday_file(spark, sf):
    """A calendar read from a file with a header; repeated days are one."""
    path = files.scratch(spark, "holidays")
    days = tables.default_holidays(spark).select(F.col("date").cast("string").alias("date"), F.lit("day off").alias("name"))
    days.union(days).write.option("header", True).csv(path)
    return shown(tables.holiday_calendar(spark, path), "date")


@query(_ORACLES["rollout_rule_model"])
def forecast_sink(spark, sf):
    """A forecast, written and read again."""
    path = files.scratch(spark, "forecast")
    tables.write_forecast(rollout(panel.weekly(spark, sf), rule_model), path)
    return shown(tables.weekly_panel(spark, path), "week", *KEYS, "horizon", "forecast_units")


@query(_ORACLES["kalman_seasonal"])
def factor_store(spark, sf):
    """Factor states, saved as JSON and loaded again."""
    path = f"{files.scratch(spark, 'factors')}/seasonal.json"
    factors.save_states(factors.update(factors.empty_states(spark), factors.observe_seasonal(predicted(spark, sf), pred="prediction")), path)
    return shown(factors.load_states(spark, path)[0], "key", "x", "p")


@query("SELECT 'v' || lpad(i::VARCHAR, 2, '0') AS version, i = 9 AS latest, CASE WHEN i = 9 THEN 9.0::DOUBLE END AS base, CASE WHEN i = 9 THEN 9::BIGINT END AS n FROM range(2, 10) t(i)")
def model_versions(spark, sf):
    """Ten versions saved, the eight newest kept, the latest loaded again with its metadata."""
    base = files.scratch(spark, "models")
    for i in range(10):
        model_store.save_model(boosting.Trees(boosting.Coding(["a"], [], [[0.5]], {}), float(i), 1), {"n": i}, base, f"v{i:02d}")
    model_store.rotate(base)
    last, held, loaded = model_store.latest(base).rsplit("/", 1)[-1], model_store.load_metadata(base), model_store.load_latest(base)
    rows = [(v, v == last, loaded.base if v == last else None, held["n"] if v == last else None) for v in files.folders(base)]
    return spark.createDataFrame(rows, "version string, latest boolean, base double, n bigint")
