"""Reorder plans, self-learning indices and forecast baselines."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weftline.operators.prep import SERIES

Z95 = 1.65
EPS = 1e-9


def reorder_plan(df: DataFrame, z: float = Z95, forecast: str = "forecast_units", lead: str = "lead_time_weeks", on_hand: str = "on_hand", order_by: str = "week") -> DataFrame:
    """Demand, spread, reorder point and order quantity by series and lead time; stock is that of the first week."""
    out = df.groupBy(*SERIES, lead).agg(
        F.coalesce(F.sum(forecast), F.lit(0.0)).alias("demand_lt"),
        F.coalesce(F.stddev_samp(forecast), F.lit(0.0)).alias("sigma"),
        F.min_by(on_hand, order_by).alias(on_hand),
    )
    point = F.col("demand_lt") + z * F.col("sigma") * F.sqrt(F.col(lead))
    return out.withColumn("reorder_point", point).withColumn("order_qty", F.coalesce(F.greatest(F.col("reorder_point") - F.col(on_hand), F.when(F.col(on_hand).isNotNull(), 0.0)), F.lit(0.0)))


def index_update(current: DataFrame, observed: DataFrame, key: str, actual: str = "units", pred: str = "prediction", alpha: float = 0.2) -> DataFrame:
    """(key, value): the state moved toward the mean ratio of actual to predicted; unseen keys stay, new ones start at 1."""
    ratio = observed.where(F.col(key).isNotNull()).groupBy(key).agg(F.avg(F.col(actual) / (F.col(pred) + EPS)).alias("_seen"))
    old = F.coalesce("value", F.lit(1.0))
    return current.join(ratio, key, "full").select(key, F.when(F.col("_seen").isNull(), F.col("value")).otherwise((1 - alpha) * old + alpha * F.col("_seen")).alias("value"))


def safety_sigma(df: DataFrame, residual: str = "residual", window: int = 8, keys: Iterable[str] = SERIES, order_by: str = "week") -> DataFrame:
    """Sample deviation of each series' last residuals; 0 with fewer than two."""
    keys = list(keys)
    last = Window.partitionBy(*keys).orderBy(F.desc(order_by))
    return df.withColumn("_n", F.row_number().over(last)).where(F.col("_n") <= window).groupBy(*keys).agg(F.coalesce(F.stddev_samp(residual), F.lit(0.0)).alias("safety_sigma"))


def seasonal_naive(train: DataFrame, val: DataFrame, target: str = "units", keys: Iterable[str] = SERIES) -> DataFrame:
    """``val`` with prediction: the series' last known training value, 0 for an unknown series, never negative."""
    keys = list(keys)
    last = train.dropna(subset=keys).groupBy(*keys).agg(F.max_by(target, F.when(F.col(target).isNotNull(), F.col("week"))).alias("_last"))
    return val.join(last, keys, "left").withColumn("prediction", F.greatest(F.coalesce(F.col("_last").cast("double"), F.lit(0.0)), F.lit(0.0))).drop("_last")
