"""Schema checks, promotion depth, lead time, scenarios, stockout imputation and the time split."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weftline.functions.expr import clip, num

SERIES = ("sku_id", "branch_id")
REQUIRED = ["week", "sku_id", "branch_id", "units", "price", "promo_flag", "brand_type", "branch_type", "stockout_flag", "display_units", "promo_depth"]
PROMO_INPUTS = {"promo_type": "no_promo", "promo_discount": 0.0, "promo_x_qty": 0, "promo_y_qty": 0, "gift_value": 0.0, "price": 0.0}
EPS = 1e-6


def validate_columns(df: DataFrame, required: Iterable[str] = REQUIRED) -> DataFrame:
    """``df`` itself, or ``ValueError`` naming what is missing; no job runs."""
    if missing := [c for c in required if c not in df.columns]:
        raise ValueError(f"Missing columns: {missing}")
    return df


def nan_to_null(df: DataFrame) -> DataFrame:
    """Not-a-number as null in every floating column."""
    return df.select(*(F.nanvl(F.col(c), F.lit(None)).alias(c) if kind in ("double", "float") else F.col(c) for c, kind in df.dtypes))


def with_defaults(df: DataFrame, defaults: dict) -> DataFrame:
    return df.withColumns({c: F.lit(v) for c, v in defaults.items() if c not in df.columns})


def promo_depth(df: DataFrame) -> DataFrame:
    """Adds promo_depth in [0, 1] by the kind of promotion; a frame that has the column comes back as it is."""
    if "promo_depth" in df.columns:
        return df
    df = with_defaults(df, PROMO_INPUTS)
    kind = F.trim(F.lower(F.coalesce(F.col("promo_type").cast("string"), F.lit("no_promo"))))
    x, y = num("promo_x_qty"), num("promo_y_qty")
    depth = (
        F.when(kind.isin("direct_discount", "discount_bundle"), clip(num("promo_discount"), 0.0, 1.0))
        .when(kind == "buy_x_get_y", F.try_divide(y, x + y + EPS))
        .when(kind == "buy_gift", F.try_divide(num("gift_value"), num("price") * F.greatest(x, F.lit(1.0)) + EPS))
        .otherwise(0.0)
    )
    return df.withColumn("promo_depth", F.coalesce(clip(depth, 0.0, 1.0), F.lit(0.0)))


def lead_time(df: DataFrame, display_col: str = "display_units", velocity_col: str = "ema_sales_8w") -> DataFrame:
    """Weeks of cover on display, and a lead time of 1, 2 or 4 weeks from it (4 where it isn't known)."""
    cover = F.try_divide(F.col(display_col).cast("double"), F.col(velocity_col) + 1e-9)
    return df.withColumn("weeks_of_cover", cover).withColumn("lead_time_weeks", F.when(F.col("weeks_of_cover") <= 1, 1).when(F.col("weeks_of_cover") <= 2, 2).otherwise(4))


def scenarios(df: DataFrame, discount: float = 0.5, keep: Iterable[str] | None = None) -> DataFrame:
    """Every row once for each scenario: A without promotion, B promoted at a discount. One pass, no self-union."""
    choices = [("A", 0, F.col("price").cast("double")), ("B", 1, F.col("price") * (1 - discount))]
    made = F.explode(F.array(*(F.struct(F.lit(n).alias("scenario"), F.lit(f).alias("flag"), p.alias("at")) for n, f, p in choices if keep is None or n in set(keep)))) if keep is None or set(keep) & {"A", "B"} else None
    if made is None:
        return df.withColumn("scenario", F.lit(None).cast("string")).where(F.lit(False))
    rest = [c for c in df.columns if c not in ("price", "promo_flag", "scenario")]
    out = df.withColumn("_made", made).select(*rest, F.col("_made.flag").alias("promo_flag"), F.col("_made.at").alias("price"), F.col("_made.scenario").alias("scenario"))
    return out.select(*(c for c in df.columns if c != "scenario"), "scenario")


def impute_stockouts(df: DataFrame, target: str = "units", flag: str = "stockout_flag", window: int = 4, keys: Iterable[str] = SERIES, exclude_stockout: bool = False) -> DataFrame:
    """Units of stockout rows from the median of the series' last rows; where there are none, from the series' median.

    ``exclude_stockout`` leaves stockout rows out of the windows. Both windows share one exchange and sort.
    """
    keys = list(keys)
    raw, out = F.col(target).cast("double"), F.coalesce(F.col(flag) == 1, F.lit(False))
    source = F.when(~out, raw) if exclude_stockout else raw
    before = F.percentile(source, F.lit(0.5)).over(Window.partitionBy(*keys).orderBy("week").rowsBetween(-window, -1))
    first = df.withColumn("_out", out).withColumn(target, F.when(out, before).otherwise(raw))
    whole = F.median(F.col(target)).over(Window.partitionBy(*keys))
    return first.withColumn(target, F.when(F.col("_out"), F.coalesce(F.col(target), whole)).otherwise(F.col(target))).drop("_out")


def time_split(df: DataFrame, val_weeks: int = 4, test_weeks: int = 4, time_col: str = "week") -> DataFrame:
    """Adds split: test from the last ``test_weeks`` before the latest week on, val before that, else train."""
    last = df.agg(F.max(time_col).alias("_last"))
    test = F.col("_last") - F.expr(f"INTERVAL {7 * test_weeks} DAYS")
    val = F.col("_last") - F.expr(f"INTERVAL {7 * (test_weeks + val_weeks)} DAYS")
    label = F.when(F.col(time_col) >= test, "test").when(F.col(time_col) >= val, "val").when(F.col(time_col) < val, "train")
    # One row on the other side.
    return df.join(F.broadcast(last)).withColumn("split", label).drop("_last")


def drop_warm_up(df: DataFrame, column: str = "lag_1") -> DataFrame:
    return df.dropna(subset=[column])
