"""Sources and sinks: Parquet panels, holiday calendars, forecasts."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Public holidays on the same day every year, as (month, day).
FIXED_DAYS = [(1, 1), (4, 30), (5, 1), (9, 2)]
#: The first of the seven days of the lunar new year, by year.
LUNAR_START = {2023: "2023-01-20", 2024: "2024-02-08", 2025: "2025-01-25", 2026: "2026-02-14"}
LUNAR_DAYS = 7


def weekly_panel(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def daily_panel(spark: SparkSession, path: str | None, enabled: bool = True) -> DataFrame | None:
    return spark.read.parquet(path) if enabled and path else None


def holidays_from_csv(spark: SparkSession, path: str) -> DataFrame:
    """(date): from a file with the header date,name."""
    return spark.read.schema("date string, name string").csv(path, header=True).select(F.to_date("date").alias("date"))


def default_holidays(spark: SparkSession, years: Iterable[int] = range(2023, 2027)) -> DataFrame:
    """(date): the fixed days of each year, and the lunar new year where it is known."""
    years = list(years)
    fixed = [f"SELECT make_date({y}, {m}, {d}) AS date" for y in years for m, d in FIXED_DAYS]
    lunar = [f"SELECT date_add(DATE'{LUNAR_START[y]}', {i}) AS date" for y in years if y in LUNAR_START for i in range(LUNAR_DAYS)]
    return spark.sql(" UNION ALL ".join(fixed + lunar)) if years else spark.createDataFrame([], "date date")


def holiday_calendar(spark: SparkSession, csv_path: str | None = None, years: Iterable[int] | None = None) -> DataFrame:
    """Distinct holidays; a file takes the place of the years."""
    found = holidays_from_csv(spark, csv_path) if csv_path is not None else default_holidays(spark, *([years] if years is not None else []))
    return found.where("date IS NOT NULL").distinct()


def write_forecast(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)
