"""The weekly and daily panels over the test tables: as DataFrames, and as SQL for the oracles.

All ratios come from integer sums, so both engines make the same doubles whatever the order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PROMO_KINDS = ["no_promo", "direct_discount", "buy_x_get_y", "buy_gift", "discount_bundle"]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def weekly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each brand, nation and week with sales."""
    lines = _table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_returnflag", "l_shipdate")
    part = _table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size")
    supplier = _table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nation = _table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = _table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    rows = lines.join(part, F.col("l_partkey") == F.col("p_partkey")).join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    # Brand, nation and week are all that the rest depends on: aggregate before the small dimensions join.
    sums = rows.groupBy(F.col("p_brand").alias("sku_id"), "s_nationkey", F.to_date(F.date_trunc("week", "l_shipdate")).alias("week")).agg(
        F.sum(F.round("l_quantity").cast("bigint")).alias("qty"),
        F.sum(F.round(F.col("l_extendedprice") * 100).cast("bigint")).alias("cents"),
        F.sum(F.round(F.col("l_discount") * 100).cast("bigint")).alias("points"),
        F.sum((F.col("l_returnflag") == "R").cast("int")).alias("returned"),
        F.count(F.lit(1)).alias("n"),
        F.max("p_size").alias("display_units"),
    )
    named = sums.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    brand = F.regexp_extract("sku_id", "([0-9]+)", 1).cast("int")
    woy = F.weekofyear("week")
    kind = F.element_at(F.array(*map(F.lit, PROMO_KINDS)), woy % 5 + 1)
    return named.select(
        "week",
        "sku_id",
        F.col("s_nationkey").cast("string").alias("branch_id"),
        F.col("qty").cast("double").alias("units"),
        (F.col("cents") / F.lit(100.0) / F.col("qty")).alias("price"),
        (F.col("points") >= 5 * F.col("n")).cast("int").alias("promo_flag"),
        kind.alias("promo_type"),
        (F.col("points") / F.lit(100.0) / F.col("n")).alias("promo_discount"),
        (woy % 3 + 1).alias("promo_x_qty"),
        (woy % 2).alias("promo_y_qty"),
        (F.col("display_units") * 10.0).alias("gift_value"),
        (F.col("returned") * 2 > F.col("n")).cast("int").alias("stockout_flag"),
        F.col("display_units").cast("int").alias("display_units"),
        F.concat(F.lit("B"), (brand % 3).cast("string")).alias("brand_type"),
        F.concat(F.lit("C"), (brand % 5).cast("string")).alias("category"),
        F.concat(F.lit("S"), (brand % 10).cast("string")).alias("sub_category"),
        F.col("r_name").alias("branch_type"),
        F.concat(F.lit("T"), (F.col("s_nationkey") % 4).cast("string")).alias("store_type"),
        F.when(F.col("s_nationkey") % 2 == 0, "MT").otherwise("GT").alias("channel"),
        F.concat(F.lit("D"), (F.col("s_nationkey") % 3).cast("string")).alias("display_capacity_type"),
        F.substring("n_name", 1, 1).alias("service_scale"),
        (F.col("display_units") * 3.0).alias("on_hand"),
    )


WEEKLY = """
base AS (
  SELECT p_brand AS sku_id, s_nationkey, CAST(date_trunc('week', l_shipdate) AS DATE) AS week,
    CAST(sum(CAST(round(l_quantity) AS BIGINT)) AS BIGINT) AS qty, CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS cents,
    CAST(sum(CAST(round(l_discount * 100) AS BIGINT)) AS BIGINT) AS points, count(*) FILTER (l_returnflag = 'R') AS returned, count(*) AS n, max(p_size) AS display_units
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey GROUP BY ALL
), panel AS (
  SELECT week, sku_id, CAST(s_nationkey AS VARCHAR) AS branch_id, CAST(qty AS DOUBLE) AS units, CAST(cents AS DOUBLE) / 100.0::DOUBLE / qty AS price,
    CAST(points >= 5 * n AS INTEGER) AS promo_flag,
    (['no_promo', 'direct_discount', 'buy_x_get_y', 'buy_gift', 'discount_bundle'])[CAST(weekofyear(week) % 5 + 1 AS INTEGER)] AS promo_type,
    CAST(points AS DOUBLE) / 100.0::DOUBLE / n AS promo_discount, weekofyear(week) % 3 + 1 AS promo_x_qty, weekofyear(week) % 2 AS promo_y_qty, display_units * 10.0::DOUBLE AS gift_value,
    CAST(returned * 2 > n AS INTEGER) AS stockout_flag, display_units,
    'B' || (CAST(regexp_extract(sku_id, '([0-9]+)', 1) AS INTEGER) % 3) AS brand_type, 'C' || (CAST(regexp_extract(sku_id, '([0-9]+)', 1) AS INTEGER) % 5) AS category,
    'S' || (CAST(regexp_extract(sku_id, '([0-9]+)', 1) AS INTEGER) % 10) AS sub_category, r_name AS branch_type, 'T' || (s_nationkey % 4) AS store_type,
    CASE WHEN s_nationkey % 2 = 0 THEN 'MT' ELSE 'GT' END AS channel, 'D' || (s_nationkey % 3) AS display_capacity_type, substr(n_name, 1, 1) AS service_scale, display_units * 3.0::DOUBLE AS on_hand
  FROM base JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
)"""

DEPTH = """,
depth AS (
  SELECT *, greatest(0.0, least(1.0, CASE
      WHEN promo_type IN ('direct_discount', 'discount_bundle') THEN greatest(0.0, least(1.0, promo_discount))
      WHEN promo_type = 'buy_x_get_y' THEN promo_y_qty / (promo_x_qty + promo_y_qty + 1e-6::DOUBLE)
      WHEN promo_type = 'buy_gift' THEN gift_value / (price * greatest(promo_x_qty, 1) + 1e-6::DOUBLE)
      ELSE 0.0 END)) AS promo_depth
  FROM panel
)"""


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each event type, user group and day with events; units are their number."""
    events = _table(spark, sf_dir, "events").select("event_type", "user_id", "ts")
    return events.groupBy(F.col("event_type").alias("sku_id"), F.concat(F.lit("b"), (F.col("user_id") % 8).cast("string")).alias("branch_id"), F.to_date("ts").alias("date")).agg(F.count(F.lit(1)).cast("double").alias("units"))


DAILY = """
daily AS (
  SELECT event_type AS sku_id, 'b' || (user_id % 8) AS branch_id, CAST(ts AS DATE) AS date, CAST(count(*) AS DOUBLE) AS units FROM events GROUP BY ALL
)"""
