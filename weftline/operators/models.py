"""Forecast models, search, explanation tables; features and their registry."""

from __future__ import annotations

from collections.abc import Callable, Iterable

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.regression import GeneralizedLinearRegression
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weftline.functions.expr import wape
from weftline.operators import boosting
from weftline.operators.daily import LAST_COLUMNS, TIME_COLUMNS
from weftline.operators.growth import CONTEMPORANEOUS

#: The names of the columns that are features, in the registry's order.
CATEGORICAL = ["sku_id", "branch_id", "brand_type", "branch_type", "channel", "store_type", "display_capacity_type", "service_scale", "promo_type_major"]
CORE = ["price", "promo_flag", "sin_woy", "cos_woy", "lag_1", "lag_2", "lag_4", "roll_4_mean", "ema_4"]
GROWTH = ["qty_growth_1w", "qty_growth_4w", "category_growth_1w", "category_growth_4w", "subcat_growth_1w", "subcat_growth_4w", "qty_growth_1w_bin", "qty_growth_4w_bin"]
PROMO = ["promo_ratio", "promo_depth_avg"]
WEATHER = ["rainy_ratio", "temp_avg", "temp_max", "temp_min"]
FACTORS = ["seasonal_factor", "promo_factor"]
NUMERIC = CORE + TIME_COLUMNS + LAST_COLUMNS + GROWTH + PROMO + WEATHER + FACTORS
ALL_FEATURES = CATEGORICAL + NUMERIC


def available_features(df: DataFrame, contemporaneous: bool = False) -> list[str]:
    """The registry's features that ``df`` has, in order; those that look at the week's own units only on request."""
    return [c for c in ALL_FEATURES if c in df.columns and (contemporaneous or c not in CONTEMPORANEOUS)]


def project_features(df: DataFrame, keep: Iterable[str] = ()) -> DataFrame:
    return df.select(*dict.fromkeys([*keep, *available_features(df, True)]))


def _encoder(features: list[str]) -> list:
    kinds, numbers = [c for c in features if c in CATEGORICAL], [c for c in features if c not in CATEGORICAL]
    stages = [StringIndexer(inputCols=kinds, outputCols=[f"{c}__i" for c in kinds], handleInvalid="keep")] if kinds else []
    return [*stages, VectorAssembler(inputCols=[*(f"{c}__i" for c in kinds), *numbers], outputCol="features", handleInvalid="keep")]


def _filled(df: DataFrame, features: list[str]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit("unknown")) if c in CATEGORICAL else F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(None)), F.lit(0.0)) for c in features})


class Fitted:
    """A fitted pipeline with the features it takes; ``predict`` adds a non-negative prediction."""

    def __init__(self, model: PipelineModel, features: list[str]):
        self.model, self.features = model, features

    def predict(self, df: DataFrame, name: str = "prediction") -> DataFrame:
        kept = df.drop("features", "prediction").withColumns({f"_raw_{c}": F.col(c) for c in self.features})
        out = self.model.transform(_filled(kept, self.features))
        own = [F.col(f"_raw_{c}").alias(c) if c in self.features else F.col(c) for c in df.columns if c not in ("features", "prediction")]
        return out.select(*own, F.greatest(F.col("prediction"), F.lit(0.0)).alias(name))


def poisson_glm(train: DataFrame, features: list[str], target: str = "units", reg: float = 1.0, max_iter: int = 100) -> Fitted:
    glm = GeneralizedLinearRegression(family="poisson", link="log", labelCol=target, featuresCol="features", regParam=reg, maxIter=max_iter)
    return Fitted(Pipeline(stages=[*_encoder(features), glm]).fit(_filled(train, features)), features)


def boosted_trees(train: DataFrame, features: list[str], target: str = "units", params: dict | None = None, validation: str | None = None, seed: int = 42) -> boosting.Trees:
    """Poisson trees; ``validation`` names a boolean column of rows that stop the rounds early."""
    return boosting.fit(train, features, [c for c in features if c in CATEGORICAL], target, params, validation, seed)


def time_folds(df: DataFrame, folds: int = 3, time_col: str = "week") -> DataFrame:
    """Adds fold: 0 for the first stretch of weeks, then 1 .. folds; whole weeks, in order. One row a week is ranked."""
    weeks = df.select(time_col).distinct()
    place = weeks.withColumn("fold", F.ntile(folds + 1).over(Window.orderBy(time_col)) - 1)
    return df.join(F.broadcast(place), time_col)


#: Rows that a search is run on, chosen by hash; a trial's work is bounded, and trials run side by side.
SEARCH_ROWS = 10_000
SEARCH_ROUNDS = {"rounds": 200, "stop": 20}


def drawn_params(rng: np.random.Generator) -> dict:
    """One point of the search space: the eight parameters, in their ranges."""
    log = lambda low, high: float(np.exp(rng.uniform(np.log(low), np.log(high))))
    return {
        "max_depth": int(rng.integers(4, 11)),
        "eta": log(0.01, 0.3),
        "subsample": float(rng.uniform(0.6, 1.0)),
        "colsample_bytree": float(rng.uniform(0.6, 1.0)),
        "min_child_weight": float(rng.uniform(1, 10)),
        "max_delta_step": int(rng.integers(0, 11)),
        "reg_alpha": log(1e-3, 10.0),
        "reg_lambda": log(1e-3, 10.0),
    }


def param_search(df: DataFrame, features: list[str], target: str = "units", trials: int = 50, folds: int = 3, seed: int = 42, rows: int = SEARCH_ROWS) -> list[tuple[float, dict]]:
    """(mean WAPE, parameters) of random trials over expanding folds of whole weeks, the best first.

    Every trial is a task of its own on the same coded sample of at most about ``rows`` rows, which is broadcast.
    """
    spark, rng = df.sparkSession, np.random.default_rng(seed)
    points = [drawn_params(rng) for _ in range(trials)]
    dealt = time_folds(df.where(F.col(target).isNotNull()), folds)
    share = rows / max(dealt.count(), 1)
    if share < 1:
        dealt = dealt.where(F.pmod(F.xxhash64(*df.columns, F.lit(seed)), F.lit(1 << 30)) < int(share * (1 << 30)))
    how = boosting.coding(dealt, features, [c for c in features if c in CATEGORICAL], target)
    # The fold takes the place of the stop mark.
    held = [boosting.gathered(boosting.coded(dealt.withColumn("_in", F.col("fold") == f), how, target, "_in"), len(features)) for f in range(1, folds + 1)]
    fold = np.zeros(len(held[0][1]) if held else 0, np.int64)
    for f, (_, _, _, mine) in enumerate(held, 1):
        fold[mine] = f
    codes, y, keys, _ = held[0]
    shared = spark.sparkContext.broadcast((how, codes, y, keys, fold, points))

    def run(batches):
        import pyarrow as pa

        how, codes, y, keys, fold, points = shared.value
        for batch in batches:
            scores = []
            for i in batch.column(0).to_pylist():
                found = []
                for f in range(1, folds + 1):
                    at, val = fold <= f, fold == f
                    if not val.any() or not (fold < f).any():
                        continue
                    base = float(np.log(max(y[fold < f].mean(), 1e-6)))
                    model = boosting.boost(boosting.LocalRows(codes[at], y[at], keys[at], val[at], base), how, base, SEARCH_ROUNDS | points[i], seed)
                    found.append(np.abs(y[val] - np.exp(model.margin(codes[val]))).sum() / (np.abs(y[val]).sum() + 1e-6))
                scores.append(float(np.mean(found)) if found else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], ["trial", "wape"])

    done = spark.range(trials).repartition(trials, "id").mapInArrow(run, "trial bigint, wape double").collect()
    return sorted(((r.wape, points[r.trial]) for r in done if r.wape is not None), key=lambda x: x[0])


def permutation_importance(predict: Callable[[DataFrame], DataFrame], df: DataFrame, features: list[str], target: str = "units", repeats: int = 5, seed: int = 42) -> DataFrame:
    """(feature, importance, deviation): how much WAPE rises when a feature's values change places.

    Values move between rows by joining two random orders within buckets of rows, so no task sorts them all: one
    join a repeat serves all features. Every moved feature of every repeat is then scored in one job.
    """
    spark, columns = df.sparkSession, df.columns
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions")) * 4
    base = predict(df).agg(wape(F.col(target), F.col("prediction"))).first()[0]
    rank = lambda salt: F.row_number().over(Window.partitionBy("_b").orderBy(F.xxhash64(*columns, F.lit(salt))))
    moved = None
    for r in range(repeats):
        dealt = df.withColumn("_b", F.pmod(F.xxhash64(*columns, F.lit(seed + r)), F.lit(buckets)))
        right = dealt.withColumn("_n", rank(-seed - r - 1)).select("_b", "_n", F.struct(*features).alias("_v"))
        both = dealt.withColumn("_n", rank(seed + r)).join(right, ["_b", "_n"]).withColumn("_r", F.lit(r))
        moved = both if moved is None else moved.union(both)
    moved = moved.withColumn("_f", F.explode(F.array(*(F.lit(f) for f in features))))
    moved = moved.withColumns({f: F.when(F.col("_f") == f, F.col("_v")[f]).otherwise(F.col(f)) for f in features}).drop("_b", "_n", "_v")
    rises = predict(moved).groupBy("_f", "_r").agg((wape(F.col(target), F.col("prediction")) - F.lit(base)).alias("rise"))
    return rises.groupBy(F.col("_f").alias("feature")).agg(F.avg("rise").alias("importance"), F.stddev_pop("rise").alias("deviation"))


def select_top_features(importances: DataFrame, threshold: float = 0.0) -> DataFrame:
    return importances.where(F.col("importance") > threshold)


def feature_importances(fitted: boosting.Trees, df: DataFrame) -> DataFrame:
    """(feature, importance): each feature's share of the trees' gains."""
    return df.sparkSession.createDataFrame(fitted.importances(), "feature string, importance double")


def partial_dependence(predict: Callable[[DataFrame], DataFrame], df: DataFrame, feature: str, grid: Iterable[float], individual: bool = False, keys: Iterable[str] = ()) -> DataFrame:
    """(grid, prediction): the mean prediction with the feature set to each grid value; ``individual``: of each row."""
    set_to = df.withColumn("grid", F.explode(F.array(*(F.lit(float(g)) for g in grid)))).withColumn(feature, F.col("grid"))
    out = predict(set_to)
    return out.select(*keys, "grid", "prediction") if individual else out.groupBy("grid").agg(F.avg("prediction").alias("prediction"))
