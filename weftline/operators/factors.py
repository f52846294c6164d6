"""Kalman-filtered adjustment factors: observe, fold, apply, keep."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.sources import files

SCHEMA = "key string, x double, p double"


@dataclass(frozen=True)
class FilterConfig:
    """Process and measurement noise, and where an unseen factor starts."""

    process_noise: float = 0.01
    measurement_noise: float = 0.05
    initial_x: float = 1.0
    initial_p: float = 0.1
    low: float = 0.5
    high: float = 2.0


def step(x: Column, p: Column, z: Column, cfg: FilterConfig) -> tuple[Column, Column]:
    """One update; a measurement that is missing, not finite or not positive only adds uncertainty."""
    ok = z.isNotNull() & ~F.isnan(z) & (z > 0) & (z < float("inf"))
    gain = p / (p + cfg.measurement_noise)
    moved = F.least(F.greatest(x + gain * (z - x), F.lit(cfg.low)), F.lit(cfg.high))
    return F.when(ok, moved).otherwise(x), F.when(ok, (1 - gain) * p + cfg.process_noise).otherwise(p + cfg.process_noise)


def fold(measurements: Column, cfg: FilterConfig, x: Column | None = None, p: Column | None = None) -> Column:
    """The state struct (x, p) after an array of measurements in order."""
    start = F.struct((x if x is not None else F.lit(cfg.initial_x)).cast("double").alias("x"), (p if p is not None else F.lit(cfg.initial_p)).cast("double").alias("p"))

    def move(acc: Column, z: Column) -> Column:
        nx, np = step(acc["x"], acc["p"], z, cfg)
        return F.struct(nx.alias("x"), np.alias("p"))

    return F.aggregate(measurements, start, move)


def _observe(df: DataFrame, key: Column, actual: str, pred: str) -> DataFrame:
    """(key, z): total actual over total predicted; a key without positive prediction isn't observed."""
    sums = df.where(key.isNotNull()).groupBy(key.alias("key")).agg(F.coalesce(F.sum(actual), F.lit(0.0)).alias("_a"), F.coalesce(F.sum(pred), F.lit(0.0)).alias("_p"))
    return sums.where("_p > 0").select("key", (F.col("_a") / F.col("_p")).alias("z"))


def seasonal_key(week: str = "week") -> Column:
    return F.concat(F.lit("woy_"), F.weekofyear(week).cast("string"))


def promo_key(kind: str = "promo_type") -> Column:
    return F.concat(F.lit("promo_"), F.coalesce(F.col(kind), F.lit("no_promo")))


def observe_seasonal(df: DataFrame, actual: str = "units", pred: str = "pred_base", week: str = "week") -> DataFrame:
    return _observe(df, seasonal_key(week), actual, pred)


def observe_promo(df: DataFrame, actual: str = "units", pred: str = "pred_base", kind: str = "promo_type") -> DataFrame:
    return _observe(df, promo_key(kind), actual, pred)


def update(states: DataFrame, observed: DataFrame, cfg: FilterConfig = FilterConfig()) -> DataFrame:
    """The state table after one observation a key; states that weren't observed stay as they are."""
    x, p = F.coalesce("x", F.lit(cfg.initial_x)), F.coalesce("p", F.lit(cfg.initial_p))
    nx, np = step(x, p, F.col("z"), cfg)
    both = states.join(observed.withColumn("_seen", F.lit(True)), "key", "full")
    return both.select("key", F.when(F.col("_seen"), nx).otherwise(F.col("x")).alias("x"), F.when(F.col("_seen"), np).otherwise(F.col("p")).alias("p"))


def empty_states(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)


def _apply(df: DataFrame, key: Column, states: DataFrame, name: str, cfg: FilterConfig) -> DataFrame:
    factor = states.select(F.col("key").alias("_key"), F.col("x").alias("_x"))
    return df.withColumn("_k", key).join(factor, F.col("_k") == F.col("_key"), "left").withColumn(name, F.coalesce("_x", F.lit(cfg.initial_x))).drop("_k", "_key", "_x")


def apply_seasonal(df: DataFrame, states: DataFrame, cfg: FilterConfig = FilterConfig(), week: str = "week") -> DataFrame:
    return _apply(df, seasonal_key(week), states, "seasonal_factor", cfg)


def apply_promo(df: DataFrame, states: DataFrame, cfg: FilterConfig = FilterConfig(), kind: str = "promo_type") -> DataFrame:
    return _apply(df, promo_key(kind), states, "promo_factor", cfg) if kind in df.columns else df.withColumn("promo_factor", F.lit(1.0))


def adjust_predictions(df: DataFrame, pred: str = "prediction") -> DataFrame:
    """``pred`` times the factors that are there."""
    out = F.col(pred)
    for c in ("seasonal_factor", "promo_factor"):
        out = out * F.col(c) if c in df.columns else out
    return df.withColumn(pred, out)


def save_states(states: DataFrame, path: str, cfg: FilterConfig = FilterConfig()) -> None:
    """JSON of a state table; it has a key for each week of the year or kind of promotion."""
    rows = states.orderBy("key").collect()
    files.write_text(str(path), json.dumps({"config": asdict(cfg), "states": {r.key: {"x": r.x, "P": r.p} for r in rows}}, indent=2))


def load_states(spark: SparkSession, path: str) -> tuple[DataFrame, FilterConfig]:
    held = json.loads(files.read_text(str(path)))
    return spark.createDataFrame([(k, float(s["x"]), float(s["P"])) for k, s in held["states"].items()], SCHEMA), FilterConfig(**held["config"])


def factor(states: DataFrame, key: str, cfg: FilterConfig = FilterConfig()) -> float:
    """One factor; an unknown key has the initial one."""
    row = states.where(F.col("key") == key).select("x").first()
    return row.x if row is not None else cfg.initial_x
