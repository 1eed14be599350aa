"""One-minute KPIs of the web and purchase feeds.

The same functions serve batch DataFrames and streaming DataFrames (with a
watermark), so the live KPI and its batch replay share one definition.

Exact distinct users per window is computed in two levels: (window, user)
then window.  This is exact, it is allowed on streams in append mode (a
``count_distinct`` is not), its state is one small row per (window, user)
spread by hash over all tasks, and a minute holding a third of all events is
pre-aggregated on the map side of both shuffles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from funnelspark.functions.columns import array_product_count
from funnelspark.schemas import KPI_WINDOW, MONEY_SUM


def _flag(cond: Column) -> Column:
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def web_kpi(events: DataFrame, ts_col: str = "event_timestamp",
            window: str = KPI_WINDOW) -> DataFrame:
    """Per window: events, distinct users, rows with a page (page views in the
    KPI sense, T25), rows with a product (product clicks)."""
    per_user = events.groupBy(F.window(ts_col, window).alias("window"), "user_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(_flag(F.col("page_url").isNotNull())).alias("pages"),
        F.sum(_flag(F.col("product_id").isNotNull())).alias("products"),
    )
    per_window = per_user.groupBy("window").agg(
        F.sum("n").cast("bigint").alias("total_events"),
        F.count("user_id").alias("unique_users"),
        F.sum("pages").cast("bigint").alias("total_page_views"),
        F.sum("products").cast("bigint").alias("total_product_clicks"),
    )
    return per_window.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
        "total_events", "unique_users", "total_page_views", "total_product_clicks")


def purchase_kpi(purchases: DataFrame, ts_col: str = "purchase_time",
                 window: str = KPI_WINDOW) -> DataFrame:
    """Per window: orders, amount, average amount (decimal(20,2)), products
    (sum of array sizes: an empty list counts 0, a NULL list is skipped, T16)."""
    amount = F.col("total_amount")
    agg = purchases.groupBy(F.window(ts_col, window).alias("window")).agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.sum(amount).cast(MONEY_SUM).alias("total_amount"),
        F.avg(amount).cast(MONEY_SUM).alias("avg_amount"),
        F.sum(array_product_count(F.col("product_ids"))).cast("bigint").alias("total_products"),
    )
    return agg.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
        "total_orders", "total_amount", "avg_amount", "total_products")


def latest_per_window(kpi_rows: DataFrame, stamp_col: str = "updated_at") -> DataFrame:
    """One row per window, the latest by ``updated_at`` (X11, R5): KPI sinks
    without a key receive the same window again after every restart."""
    w = Window.partitionBy("window_start", "window_end").orderBy(F.col(stamp_col).desc())
    return (kpi_rows.withColumn("_rn", F.row_number().over(w))
            .filter(F.col("_rn") == 1).drop("_rn"))
