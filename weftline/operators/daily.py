"""Daily series: calendar flags, the weekly rollup, lag and rolling features and their week-end values."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weftline.operators.prep import SERIES
from weftline.operators.weekly import with_ema_prior

DAILY_LAGS = (1, 3, 7, 14, 28)
MEANS = (3, 7, 14, 28)
STDS = (7, 14, 28)
EMAS = (14, 30)
DAILY_COLUMNS = [*(f"lag_{k}d" for k in DAILY_LAGS), *(f"roll_{k}d_mean" for k in MEANS), *(f"roll_{k}d_std" for k in STDS), *(f"ema_{k}d" for k in EMAS)]
LAST_COLUMNS = [f"{c}_last" for c in DAILY_COLUMNS]
TIME_COLUMNS = ["weekend_ratio", "holiday_flag", "holiday_ratio", "month_start_flag", "month_end_flag", "peak_day", "peak_level"]


def daily_time_features(df: DataFrame, holidays: DataFrame | None = None, date_col: str = "date") -> DataFrame:
    """day_of_week (Monday 0), is_weekend, is_holiday, is_month_start and is_month_end (first and last three days)."""
    day = F.to_date(date_col)
    out = df.withColumns(
        {
            "day_of_week": F.weekday(day),
            "is_weekend": (F.weekday(day) >= 5).cast("int"),
            "is_month_start": (F.dayofmonth(day) <= 3).cast("int"),
            "is_month_end": (F.month(F.date_add(day, 3)) != F.month(day)).cast("int"),
        }
    )
    if holidays is None:
        return out.withColumn("is_holiday", F.lit(0))
    # A calendar: a few rows a year.
    known = holidays.select(F.to_date("date").alias("_day"), F.lit(1).alias("_is")).where("_day IS NOT NULL").distinct()
    return out.withColumn("_on", day).join(F.broadcast(known), F.col("_on") == F.col("_day"), "left").withColumn("is_holiday", F.coalesce("_is", F.lit(0))).drop("_on", "_day", "_is")


def monday(date_col: str = "date"):
    return F.to_date(F.date_trunc("week", F.col(date_col))).alias("week")


def daily_to_weekly(df: DataFrame, target: str = "units", keys: Iterable[str] = SERIES, date_col: str = "date") -> DataFrame:
    """Weekly sums, ratios and flags, and the day and share of the week's peak: one aggregate."""
    u = F.coalesce(F.col(target).cast("double"), F.lit(0.0))
    total = F.sum(u)
    first = F.max_by("day_of_week", F.struct(F.col(target).cast("double"), -F.unix_date(F.to_date(date_col))))
    return df.groupBy(*keys, monday(date_col)).agg(
        total.alias(target),
        F.avg("is_weekend").alias("weekend_ratio"),
        F.max("is_holiday").alias("holiday_flag"),
        F.avg("is_holiday").alias("holiday_ratio"),
        F.max("is_month_start").alias("month_start_flag"),
        F.max("is_month_end").alias("month_end_flag"),
        F.when(total == 0, 0.0).otherwise(first.cast("double")).alias("peak_day"),
        F.when(total > 0, F.max(F.col(target).cast("double")) / total).otherwise(0.0).alias("peak_level"),
    )


def daily_features(df: DataFrame, target: str = "units", keys: Iterable[str] = SERIES, date_col: str = "date") -> DataFrame:
    """Lags, full-window means and standard deviations, and exponential averages of earlier days."""
    s = Window.partitionBy(*keys).orderBy(date_col)
    columns = {f"lag_{k}d": F.lag(target, k).over(s) for k in DAILY_LAGS}
    for name, sizes, f in (("mean", MEANS, F.avg), ("std", STDS, F.stddev_samp)):
        for k in sizes:
            w = s.rowsBetween(-k, -1)
            columns[f"roll_{k}d_{name}"] = F.when(F.count(target).over(w) == k, f(target).over(w))
    return with_ema_prior(df.withColumns(columns), {f"ema_{k}d": (target, k) for k in EMAS}, keys, date_col)


def last_of_week(df: DataFrame, columns: Iterable[str] = DAILY_COLUMNS, keys: Iterable[str] = SERIES, date_col: str = "date") -> DataFrame:
    """The last known value of each column in the week; different columns may come from different days."""
    return df.groupBy(*keys, monday(date_col)).agg(*(F.max_by(c, F.when(F.col(c).isNotNull(), F.col(date_col))).alias(f"{c}_last") for c in columns))


def join_daily(weekly: DataFrame, daily: DataFrame, holidays: DataFrame | None = None, target: str = "units", keys: Iterable[str] = SERIES) -> DataFrame:
    """The weekly panel with all daily features: both rollups share one aggregate over one window pass, and one join."""
    keys = list(keys)
    rows = daily_features(daily_time_features(daily, holidays), target, keys)
    rolled = daily_to_weekly(rows, target, keys).withColumnRenamed(target, f"{target}_daily")
    last = last_of_week(rows, DAILY_COLUMNS, keys)
    features = rolled.join(last, [*keys, "week"])
    return weekly.withColumn("week", F.to_date("week")).join(features, [*keys, "week"], "left")
