"""Growth against earlier weeks, at three levels, and quantile bins."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weftline.functions.expr import finite_or_zero
from weftline.functions.quantiles import exact_quantiles
from weftline.operators.prep import SERIES
from weftline.operators.weekly import series_window

EPS = 1e-6
STEPS = (1, 4)
#: Columns that look at the week's own units: values as asked for, but kept out of a model's default features.
CONTEMPORANEOUS = ("qty_growth_1w", "qty_growth_4w", "category_growth_1w", "category_growth_4w", "subcat_growth_1w", "subcat_growth_4w", "qty_growth_1w_bin", "qty_growth_4w_bin", "peak_day", "peak_level")


def _growth(now, before):
    return F.try_divide(now - before, before + EPS)


def series_growth(df: DataFrame, target: str = "units", keys: Iterable[str] = SERIES) -> DataFrame:
    """qty_growth_1w and _4w; lag columns that are there are used."""
    s = series_window(keys)
    return df.withColumns({f"qty_growth_{k}w": _growth(F.col(target), F.col(f"lag_{k}") if f"lag_{k}" in df.columns else F.lag(target, k).over(s)) for k in STEPS})


def group_growth(df: DataFrame, column: str, prefix: str, target: str = "units") -> DataFrame:
    """Growth of a group's weekly total, joined back; rows without a group get none."""
    if column not in df.columns:
        return df
    totals = df.where(F.col(column).isNotNull()).groupBy(column, "week").agg(F.coalesce(F.sum(target), F.lit(0.0)).alias("_total"))
    s = Window.partitionBy(column).orderBy("week")
    grown = totals.select(column, "week", *(_growth(F.col("_total"), F.lag("_total", k).over(s)).alias(f"{prefix}_growth_{k}w") for k in STEPS))
    return df.join(grown, [column, "week"], "left")


def growth_features(df: DataFrame, target: str = "units", keys: Iterable[str] = SERIES) -> DataFrame:
    out = series_growth(df, target, keys).transform(group_growth, "category", "category", target).transform(group_growth, "sub_category", "subcat", target)
    return out.transform(growth_bins)


def growth_bins(df: DataFrame, columns: Iterable[str] = ("qty_growth_1w", "qty_growth_4w"), bins: int = 5) -> DataFrame:
    """Bins between the exact quantiles (missing as 0), which are found first; repeated edges fall together."""
    columns = [c for c in columns if c in df.columns]
    if not columns:
        return df
    found = exact_quantiles(df, {c: finite_or_zero(F.col(c)) for c in columns}, [i / bins for i in range(bins + 1)])
    inner = {c: sorted({x for x in edges if x is not None})[1:-1] for c, edges in found.items()}
    return df.withColumns({f"{c}_bin": sum(((finite_or_zero(F.col(c)) >= x).cast("int") for x in inner[c]), F.lit(0)) for c in columns})
