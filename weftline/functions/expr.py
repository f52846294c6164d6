"""Column expressions the operators share. All stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from weftline.functions.quantiles import exact_quantiles


def num(c: Column | str) -> Column:
    """As double, with bad and missing values as 0."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(c.try_cast("double"), F.lit(0.0))


def finite_or_zero(c: Column) -> Column:
    return F.when(c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")), 0.0).otherwise(c)


def clip(c: Column, low: float, high: float) -> Column:
    """Bounded value; null stays null."""
    return F.when(c.isNotNull(), F.least(F.greatest(c, F.lit(low)), F.lit(high)))


def right_closed_bin(value: Column, edges: list[float]) -> Column:
    """Index of the bin (edge, edge]; the first bin holds its lower edge; outside or null: null."""
    inner = [(value > F.lit(e)).cast("int") for e in edges[1:-1]]
    index = sum(inner[1:], inner[0]) if inner else F.lit(0)
    return F.when((value >= edges[0]) & (value <= edges[-1]), index)


def wape(y: Column, p: Column, eps: float = 1e-6) -> Column:
    return F.sum(F.abs(y - p)) / (F.sum(F.abs(y)) + eps)


def mae(y: Column, p: Column) -> Column:
    return F.avg(F.abs(y - p))


def _relative(y: Column, p: Column, eps: float) -> Column:
    return F.abs(y - p) / F.greatest(F.abs(y), F.lit(eps))


def mape(y: Column, p: Column, eps: float = 1e-6) -> Column:
    return F.avg(_relative(y, p, eps))


def mdape(df, y: Column, p: Column, eps: float = 1e-6) -> float | None:
    """The median of a whole table, exact, so not one aggregate beside others."""
    return exact_quantiles(df, {"e": _relative(y, p, eps)}, [0.5])["e"][0]
