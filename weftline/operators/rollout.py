"""Recursive multi-step forecasts.

Only the series with a row in the latest week are forecast. Each keeps its last four values and its
exponential average; a step is a projection on that state and the model's own transform, with no
shuffle after the state has been made. All calendar, price and daily columns stay as last observed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.operators.prep import SERIES
from weftline.operators.weekly import series_window, with_ema_prior

COLUMNS = ["sku_id", "branch_id", "week", "horizon", "forecast_units"]
ALPHA = 2.0 / 5


def rule_model(df: DataFrame) -> DataFrame:
    """A deterministic stand-in for a model: the last value and one."""
    return df.withColumn("prediction", F.col("lag_1") + 1.0)


def rollout(history: DataFrame, predict: Callable[[DataFrame], DataFrame], horizons: Iterable[int] = (1, 2, 4), target: str = "units", keys: Iterable[str] = SERIES) -> DataFrame:
    """keys, week, horizon and forecast_units for each requested step after the latest week; predictions are cut at 0."""
    keys, wanted = list(keys), sorted(set(horizons))
    s = series_window(keys)
    last = history.agg(F.max("week").alias("_last"))
    value = F.col(target).cast("double")
    state = (
        with_ema_prior(history, {"_prior": (target, 4)}, keys)
        .withColumn("_past", F.collect_list(F.struct(value.alias("x"))).over(s.rowsBetween(-3, 0)))
        .join(F.broadcast(last))
        .where(F.col("week") == F.col("_last"))
        .withColumn("_ema", F.when(F.col("_prior").isNull(), value).otherwise((1 - ALPHA) * F.col("_prior") + ALPHA * value))
        .withColumn("_past", F.reverse(F.col("_past.x")))
        .drop("_prior", "_last")
    )
    if not wanted:
        return history.select(*keys, "week").withColumn("horizon", F.lit(0)).withColumn("forecast_units", F.lit(0.0)).where(F.lit(False))
    state = state.withColumn("_steps", F.array().cast("array<struct<week:date,horizon:int,forecast_units:double>>"))
    for h in range(1, max(wanted) + 1):
        known = F.filter("_past", lambda x: x.isNotNull())
        mean = F.try_divide(F.aggregate(known, F.lit(0.0), lambda a, x: a + x), F.size(known))
        lags = {f"lag_{k}": F.try_element_at("_past", F.lit(k)) for k in (1, 2, 4)}
        rows = state.withColumns({**lags, "roll_4_mean": mean, "ema_4": F.col("_ema"), target: F.lit(0.0)})
        done = predict(rows).withColumn("_new", F.greatest(F.col("prediction").cast("double"), F.lit(0.0)))
        step = F.array(F.struct(F.date_add(F.to_date("week"), 7 * h).alias("week"), F.lit(h).alias("horizon"), F.col("_new").alias("forecast_units")))
        moved = {"_past": F.slice(F.concat(F.array("_new"), "_past"), 1, 4), "_ema": (1 - ALPHA) * F.col("_ema") + ALPHA * F.col("_new")}
        state = done.withColumns(moved | ({"_steps": F.concat("_steps", step)} if h in wanted else {})).select(*state.columns)
    # The steps ride along in the row, so every step is computed once.
    return state.select(*keys, F.inline("_steps"))
