"""Store rollups, profiles and clusters."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.ml import Pipeline
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

EPS = 1e-9
NUMERIC = ("avg_weekly_sales", "volatility", "promo_lift", "stockout_rate", "seasonality_strength")
KINDS = ("store_type", "display_capacity_type", "service_scale", "channel")


def store_type_rollup(df: DataFrame, groups: Iterable[str] = ("sku_id", "store_type"), forecast: str = "forecast_units", units: str = "units", branch: str = "branch_id") -> DataFrame:
    """Sums, number of branches and forecast per branch; null groups are kept."""
    groups = list(groups)
    if missing := sorted({*groups, branch, forecast} - set(df.columns)):
        raise ValueError(f"Missing required columns: {missing}")
    sums = [F.coalesce(F.sum(c), F.lit(0.0)).alias(c) for c in (forecast, units) if c in df.columns]
    out = df.groupBy(*groups).agg(*sums, F.countDistinct(branch).alias("branch_count"))
    return out.withColumn("avg_forecast_per_branch", F.try_divide(F.col(forecast), F.col("branch_count")))


def mode_or_default(column: str, default: str = "unknown"):
    """The commonest value, the least of tied ones, as a string."""
    return F.coalesce(F.mode(F.col(column).cast("string"), True), F.lit(default))


def store_profiles(df: DataFrame, branch: str = "branch_id", units: str = "units") -> DataFrame:
    """One row a branch: level, volatility, promotion lift, stockout rate, seasonality and its kinds. Two aggregates, one key."""
    if missing := sorted({branch, units} - set(df.columns)):
        raise ValueError(f"Missing columns: {missing}")
    time = "week" if "week" in df.columns else "date" if "date" in df.columns else None
    df = df.withColumns({c: F.lit(v) for c, v in {"promo": 0, "stockout_flag": 0, **dict.fromkeys(KINDS, "unknown")}.items() if c not in df.columns})
    u = F.col(units).cast("double")
    mean = F.avg(u)
    lift = F.avg(F.when(F.col("promo") == 1, u)) / (F.avg(F.when(F.col("promo") == 0, u)) + EPS)
    out = df.groupBy(branch).agg(
        mean.alias("avg_weekly_sales"),
        (F.stddev_pop(u) / (mean + EPS)).alias("volatility"),
        F.coalesce(lift, F.lit(1.0)).alias("promo_lift"),
        F.avg("stockout_flag").alias("stockout_rate"),
        *(mode_or_default(c).alias(c) for c in KINDS),
    )
    if time is None:
        return out.withColumn("seasonality_strength", F.lit(1.0))
    weekly = df.groupBy(branch, F.weekofyear(F.to_date(time)).alias("_w")).agg(F.avg(u).alias("_m")).where("_w IS NOT NULL")
    season = weekly.groupBy(F.col(branch).alias("_b")).agg(F.when(F.min("_m") > 0, F.max("_m") / (F.min("_m") + EPS)).alias("_s"))
    return out.join(season, F.col(branch).eqNullSafe(F.col("_b")), "left").withColumn("seasonality_strength", F.coalesce("_s", F.lit(1.0))).drop("_b", "_s")


def profile_features(profiles: DataFrame) -> DataFrame:
    """Adds features: z-scores with the population deviation, and every kind one-hot."""
    n = profiles.count()
    numeric = [c for c in NUMERIC if c in profiles.columns]
    kinds = [c for c in KINDS if c in profiles.columns]
    filled = profiles.fillna(0.0, numeric).fillna("unknown", kinds)
    stages = [VectorAssembler(inputCols=numeric, outputCol="_raw"), StandardScaler(inputCol="_raw", outputCol="_z", withMean=True, withStd=True)]
    if kinds:
        stages += [StringIndexer(inputCols=kinds, outputCols=[f"_i_{c}" for c in kinds], handleInvalid="keep"), OneHotEncoder(inputCols=[f"_i_{c}" for c in kinds], outputCols=[f"_o_{c}" for c in kinds], dropLast=False)]
    out = Pipeline(stages=stages).fit(filled).transform(filled)
    # The scaler divides by the sample deviation.
    scale = (n / (n - 1)) ** 0.5 if n > 1 else 1.0
    out = out.withColumn("_z", array_to_vector(F.transform(vector_to_array("_z"), lambda v: v * scale)))
    return VectorAssembler(inputCols=["_z", *(f"_o_{c}" for c in kinds)], outputCol="features").transform(out).select(*profiles.columns, "features")


def cluster_stores(profiles: DataFrame, clusters: int = 5, min_stores: int = 5, seed: int = 42) -> DataFrame:
    """Adds cluster by k-means; clusters under ``min_stores`` join the nearest large one's centre."""
    n = profiles.count()
    if n == 0:
        return profiles.withColumn("cluster", F.lit(None).cast("int"))
    k = max(1, min(clusters, max(1, n // max(min_stores, 1))))
    rows = profile_features(profiles)
    if k == 1:
        return rows.drop("features").withColumn("cluster", F.lit(0))
    model = KMeans(k=k, seed=seed, featuresCol="features", predictionCol="cluster").fit(rows)
    return merge_small_clusters(model.transform(rows), model.clusterCenters(), min_stores).drop("features")


def merge_small_clusters(rows: DataFrame, centers: list, min_stores: int) -> DataFrame:
    """Rows of small clusters go to the nearest centre of a large one; with no large one nothing moves. Centres are k rows."""
    sizes = {r.cluster: r.n for r in rows.groupBy("cluster").agg(F.count(F.lit(1)).alias("n")).collect()}
    large = [c for c, n in sizes.items() if n >= min_stores]
    moves = {c: min(large, key=lambda g: (float(((centers[c] - centers[g]) ** 2).sum()), g)) for c, n in sizes.items() if n < min_stores} if large else {}
    if not moves:
        return rows
    target = F.create_map(*(F.lit(int(x)) for pair in moves.items() for x in pair))
    return rows.withColumn("cluster", F.coalesce(F.try_element_at(target, F.col("cluster")), F.col("cluster")))
