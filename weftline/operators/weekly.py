"""Calendar, lag, rolling and exponential features of weekly series."""

from __future__ import annotations

import math
from collections.abc import Iterable

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from weftline.operators.prep import SERIES

LAGS = (1, 2, 4)


def series_window(keys: Iterable[str] = SERIES, time_col: str = "week") -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(time_col)


def time_features(df: DataFrame, time_col: str = "week") -> DataFrame:
    woy = F.weekofyear(time_col)
    angle = woy * F.lit(2 * math.pi / 52)
    return df.withColumns({"week_of_year": woy, "month": F.month(time_col), "sin_woy": F.sin(angle), "cos_woy": F.cos(angle)})


#: Decay, as a power of e, of a stretch of a series; what came before the last stretch weighs less than a double can tell.
STRETCH = 300.0
#: One value's decay at most: beyond it, nothing of the past is left.
FORGOTTEN = 40.0


def with_ema_prior(df: DataFrame, columns: dict[str, tuple[str, int]], keys: Iterable[str] = SERIES, time_col: str = "week") -> DataFrame:
    """Adds, for each name: (value, span), the exponential average of the rows before, seeded by the first, with alpha 2 / (span + 1).

    A missing value (null or not a number) carries the average on, however long, and lets the next one weigh
    more, by the rows since. So each value x that is g rows after the last makes y into a * y + b * x with
    k = (1 - alpha)^g, a = k / (k + alpha), b = alpha / (k + alpha). This is summed, not folded: with L the
    running sum of log a, y is the sum of b * x * exp(L - L at x). Sums are taken in stretches of L, so that
    no weight overflows, and a stretch adds what the one before it ended with. All windows share one exchange.
    """
    keys = list(keys)
    s = Window.partitionBy(*keys).orderBy(time_col)
    so_far, before = s.rowsBetween(Window.unboundedPreceding, 0), s.rowsBetween(Window.unboundedPreceding, -1)
    at = lambda what, i: f"_{what}{i}"
    col = lambda what, i: F.col(at(what, i))
    spans = list(enumerate(columns.items()))
    values = {at("x", i): F.when(~F.isnan(F.col(v).cast("double")), F.col(v).cast("double")) for i, (_, (v, _)) in spans}
    df = df.withColumns(values).withColumn("_row", F.row_number().over(s))
    df = df.withColumns({at("gap", i): F.col("_row") - F.max(F.when(col("x", i).isNotNull(), F.col("_row"))).over(before) for i, _ in spans})
    steps = {}
    for i, (_, (_, span)) in spans:
        alpha = 2.0 / (span + 1)
        kept = F.pow(F.lit(1 - alpha), col("gap", i))
        first = col("gap", i).isNull()
        steps[at("log", i)] = F.when(col("x", i).isNull() | first, 0.0).otherwise(F.greatest(F.log(kept / (kept + alpha)), F.lit(-FORGOTTEN)) if alpha < 1 else F.lit(-FORGOTTEN))
        steps[at("add", i)] = F.when(col("x", i).isNull(), 0.0).when(first, col("x", i)).otherwise(alpha * col("x", i) / (kept + alpha))
    df = df.withColumns(steps).withColumns({at("sum", i): F.sum(col("log", i)).over(so_far) for i, _ in spans} | {at("any", i): F.count(col("x", i)).over(so_far) for i, _ in spans})
    df = df.withColumns({at("part", i): F.floor(-col("sum", i) / STRETCH) for i, _ in spans})
    for i, _ in spans:
        local = -col("sum", i) - STRETCH * col("part", i)
        within = Window.partitionBy(*keys, at("part", i)).orderBy(time_col, "_row").rowsBetween(Window.unboundedPreceding, 0)
        df = df.withColumn(at("here", i), F.exp(-local) * F.sum(F.exp(local) * col("add", i)).over(within))
        ended = F.max_by(F.struct(col("here", i).alias("y"), col("sum", i).alias("sum")), F.col("_row")).over(Window.partitionBy(*keys).orderBy(at("part", i)).rangeBetween(-1, -1))
        df = df.withColumn(at("end", i), ended)
        carried = F.coalesce(F.exp(col("sum", i) - col("end", i)["sum"]) * col("end", i)["y"], F.lit(0.0))
        df = df.withColumn(at("now", i), F.when(col("any", i) > 0, col("here", i) + carried))
    last = Window.partitionBy(*keys).orderBy(time_col, "_row")
    df = df.withColumns({name: F.lag(at("now", i)).over(last) for i, (name, _) in spans})
    return df.drop("_row", *(at(w, i) for w in ("x", "gap", "log", "add", "sum", "any", "part", "here", "end", "now") for i, _ in spans))


def lag_features(df: DataFrame, target: str = "units", lags: Iterable[int] = LAGS, keys: Iterable[str] = SERIES) -> DataFrame:
    """lag_k, roll_4_mean and ema_4 from earlier rows of the same series: one exchange."""
    s = series_window(keys)
    columns = {f"lag_{k}": F.lag(target, k).over(s) for k in lags}
    columns["roll_4_mean"] = F.avg(target).over(s.rowsBetween(-4, -1))
    return with_ema_prior(df.withColumns(columns), {"ema_4": (target, 4)}, keys)


def ema_sales(df: DataFrame, target: str = "units", keys: Iterable[str] = SERIES, name: str = "ema_sales_8w", span: int = 8) -> DataFrame:
    return df if name in df.columns else with_ema_prior(df, {name: (target, span)}, keys)


def weekly_features(df: DataFrame, target: str = "units", keys: Iterable[str] = SERIES) -> DataFrame:
    return df.transform(time_features).transform(lag_features, target, LAGS, keys)
