"""Promotion effects against a matched baseline."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weftline.functions.expr import right_closed_bin
from weftline.operators.prep import SERIES

EPS = 1e-6


def matched_baseline(df: DataFrame, units: str = "units", keys: Iterable[str] = SERIES) -> DataFrame:
    """Adds baseline: mean unpromoted units of the row's series, else of all rows, else 0."""
    plain = F.when(F.col("promo_flag") == 0, F.col(units).cast("double"))
    overall = df.agg(F.avg(plain).alias("_all"))
    keys = list(keys)
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    own = F.when(known, F.avg(plain).over(Window.partitionBy(*keys)))
    return df.withColumn("_own", own).join(F.broadcast(overall)).withColumn("baseline", F.coalesce("_own", "_all", F.lit(0.0))).drop("_own", "_all")


def _promoted(df: DataFrame, units: str) -> DataFrame:
    return matched_baseline(df, units).where(F.col("promo_flag") == 1)


def _uplift(promo: str, base: str):
    return (F.col(promo) - F.col(base)) / (F.col(base) + EPS) * 100


def _effects(rows: DataFrame, keys: list[str], units: str) -> DataFrame:
    """Null keys form no group."""
    out = rows.dropna(subset=keys).groupBy(*keys).agg(F.avg(units).alias("promo_mean"), F.avg("baseline").alias("base_mean"), F.count(F.lit(1)).alias("sample_size"))
    return out.withColumn("uplift_pct", _uplift("promo_mean", "base_mean"))


def _empty(df: DataFrame, schema: str) -> DataFrame:
    return df.sparkSession.createDataFrame([], schema)


def promo_type_impact(df: DataFrame, type_col: str = "promo_type", units: str = "units", group: str | None = "sku_id") -> DataFrame:
    if type_col not in df.columns:
        return _empty(df, f"{type_col} string, promo_mean double, base_mean double, sample_size bigint, uplift_pct double")
    keys = [type_col, group] if group is not None and group in df.columns else [type_col]
    return _effects(_promoted(df, units), keys, units)


def depth_edges(bins: int) -> list[float]:
    return [i * (1 / bins) for i in range(bins)] + [1.0]


def promo_depth_curve(df: DataFrame, depth_col: str = "promo_depth", units: str = "units", bins: int = 5, group: str | None = None) -> DataFrame:
    """Uplift for each of ``bins`` equal depth ranges, right-closed; empty ranges have a row."""
    if depth_col not in df.columns:
        return _empty(df, "depth_range string, avg_depth double, promo_mean double, base_mean double, sample_size bigint, uplift_pct double")
    edges = depth_edges(bins)
    keys = [group] if group is not None and group in df.columns else []
    rows = _promoted(df, units).withColumn("_bin", right_closed_bin(F.col(depth_col).cast("double"), edges)).dropna(subset=["_bin", *keys])
    found = rows.groupBy("_bin", *keys).agg(F.avg(depth_col).alias("avg_depth"), F.avg(units).alias("promo_mean"), F.avg("baseline").alias("base_mean"), F.count(F.lit(1)).alias("sample_size"))
    labels = df.sparkSession.createDataFrame([(i, f"{a:.2f}-{b:.2f}") for i, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True))], "_bin int, depth_range string")
    # The ranges are a fixed handful; every observed group meets each of them once.
    spine = rows.select(*keys).distinct().withColumn("_bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1)))).join(F.broadcast(labels), "_bin") if keys else labels
    out = spine.join(found, ["_bin", *keys], "left").withColumn("sample_size", F.coalesce("sample_size", F.lit(0))).withColumn("uplift_pct", _uplift("promo_mean", "base_mean"))
    return out.select(*keys, "depth_range", "avg_depth", "promo_mean", "base_mean", "sample_size", "uplift_pct")


def promo_impact_summary(df: DataFrame, groups: Iterable[str] = ("promo_type", "brand_type"), units: str = "units") -> DataFrame:
    """Effects by the groups that are there; with none, an empty frame."""
    keys = [g for g in groups if g in df.columns]
    if not keys:
        return _empty(df, ", ".join(f"{g} string" for g in groups) + ", promo_mean double, base_mean double, sample_size bigint, uplift_pct double")
    return _effects(_promoted(df, units), keys, units)
