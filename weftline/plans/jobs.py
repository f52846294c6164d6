"""The weekly training and forecasting jobs."""

from __future__ import annotations

import logging
import uuid
from dataclasses import asdict, dataclass, field
from datetime import datetime, timezone

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.functions.expr import mae, wape
from weftline.operators import daily, decisions, factors, growth, models, prep, weekly
from weftline.operators.rollout import rollout
from weftline.sources import files, model_store, tables

log = logging.getLogger(__name__)


@dataclass
class TrainConfig:
    data_path: str = "data/weekly.parquet"
    daily_path: str | None = None
    model_dir: str = "models/weekly"
    factor_dir: str = "models/factors"
    val_weeks: int = 4
    test_weeks: int = 4
    use_search: bool = True
    trials: int = 50
    folds: int = 3
    use_daily: bool = False
    use_growth: bool = True
    use_factors: bool = False
    holiday_csv: str | None = None
    keep_versions: int = model_store.KEEP
    params: dict = field(default_factory=dict)


@dataclass
class ForecastConfig:
    data_path: str = "data/weekly.parquet"
    daily_path: str | None = None
    model_dir: str = "models/weekly"
    factor_dir: str = "models/factors"
    output_path: str = "output/forecast"
    horizons: tuple[int, ...] = (1, 2, 4)
    scenarios: tuple[str, ...] = ("A", "B")
    use_daily: bool = False
    use_growth: bool = True
    use_factors: bool = False
    holiday_csv: str | None = None
    #: Training imputes stockouts; forecasting does so only on request.
    impute_stockouts: bool = False


def prepared(spark: SparkSession, path: str) -> DataFrame:
    df = prep.nan_to_null(tables.weekly_panel(spark, path)).transform(prep.promo_depth)
    return prep.validate_columns(df).withColumn("week", F.to_date("week"))


def features(df: DataFrame, spark: SparkSession, cfg: TrainConfig | ForecastConfig) -> DataFrame:
    """All features of a weekly panel, keyed also by scenario where it has one."""
    keys = [*prep.SERIES, *(["scenario"] if "scenario" in df.columns else [])]
    out = df.transform(weekly.ema_sales, "units", keys).transform(prep.lead_time).transform(weekly.weekly_features, "units", keys)
    if cfg.use_daily and (days := tables.daily_panel(spark, cfg.daily_path)) is not None:
        out = daily.join_daily(out, days, tables.holiday_calendar(spark, cfg.holiday_csv))
    if cfg.use_growth:
        out = growth.growth_features(out, "units", keys)
    return prep.drop_warm_up(out)


def _states(spark: SparkSession, folder: str, name: str) -> tuple[DataFrame, factors.FilterConfig]:
    path = f"{folder}/{name}.json"
    return factors.load_states(spark, path) if files.exists(path) else (factors.empty_states(spark), factors.FilterConfig())


def with_factors(df: DataFrame, spark: SparkSession, folder: str) -> DataFrame:
    seasonal, kinds = _states(spark, folder, "seasonal"), _states(spark, folder, "promo")
    return factors.apply_promo(factors.apply_seasonal(df, *seasonal), *kinds)


def update_factors(scored: DataFrame, spark: SparkSession, folder: str) -> None:
    """One observation a factor from actual and predicted units; the states are read, moved and written."""
    observers = [("seasonal", factors.observe_seasonal)] + ([("promo", factors.observe_promo)] if "promo_type" in scored.columns else [])
    for name, observe in observers:
        states, cfg = _states(spark, folder, name)
        factors.save_states(factors.update(states, observe(scored, pred="prediction"), cfg), f"{folder}/{name}.json", cfg)


def run_train(spark: SparkSession, cfg: TrainConfig) -> dict:
    """Trains, scores against the naive baseline and saves a version; returns its metadata."""
    df = features(prep.impute_stockouts(prepared(spark, cfg.data_path)), spark, cfg)
    if cfg.use_factors:
        df = with_factors(df, spark, cfg.factor_dir)
    rows = prep.time_split(df, cfg.val_weeks, cfg.test_weeks).persist()
    train, val = rows.where("split = 'train'"), rows.where("split = 'val'")
    columns = models.available_features(df)
    y, p = F.col("units"), F.col("prediction")
    baseline = decisions.seasonal_naive(train, val).agg(wape(y, p)).first()[0]
    params = dict(cfg.params)
    if cfg.use_search:
        params |= models.param_search(train, columns, trials=cfg.trials, folds=cfg.folds)[0][1]
    both = rows.where("split <> 'test'").withColumn("_stop", F.col("split") == "val")
    fitted = models.boosted_trees(both, columns, params=params, validation="_stop")
    scored = fitted.predict(val).persist()
    found = scored.agg(wape(y, p).alias("w"), mae(y, p).alias("m")).first()
    if cfg.use_factors:
        update_factors(scored, spark, cfg.factor_dir)
    version = f"v{datetime.now(timezone.utc):%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:6]}"
    metadata = {"version": version, "baseline_wape": baseline, "model_wape": found.w, "model_mae": found.m, "best_params": params, "feature_cols": columns, "n_train": train.count(), "n_val": val.count(), "config": asdict(cfg)}
    model_store.save_model(fitted, metadata, cfg.model_dir, version)
    model_store.rotate(cfg.model_dir, cfg.keep_versions)
    scored.unpersist()
    rows.unpersist()
    return metadata


def run_forecast(spark: SparkSession, cfg: ForecastConfig) -> DataFrame:
    """Forecasts every scenario and writes the result."""
    meta = model_store.load_metadata(cfg.model_dir)
    held = model_store.load_latest(cfg.model_dir)
    fitted = models.Fitted(held, meta["feature_cols"]) if isinstance(held, PipelineModel) else held
    df = prepared(spark, cfg.data_path)
    if cfg.impute_stockouts:
        df = prep.impute_stockouts(df)
    rows = features(prep.scenarios(df, keep=cfg.scenarios), spark, cfg)
    if cfg.use_factors:
        rows = with_factors(rows, spark, cfg.factor_dir)
    # All scenarios in one pass: the scenario is one more key of a series.
    out = rollout(rows, fitted.predict, cfg.horizons, keys=[*prep.SERIES, "scenario"]).select("sku_id", "branch_id", "week", "horizon", "forecast_units", "scenario")
    tables.write_forecast(out, cfg.output_path)
    return spark.read.parquet(cfg.output_path)
