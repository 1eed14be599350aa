"""Per-customer aggregates of staged web events and purchases.

Both are one ``groupBy(customer_id)``: Spark aggregates partially on the map
side, so a customer holding a third of all rows is reduced per partition
before the shuffle.  The one exact distinct count (pages) is planned as a
two-step aggregate keyed by (customer, page) first, which also spreads a hot
customer over many tasks.  Values relative to "now" take an explicit ``as_of``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from funnelspark.functions.columns import (as_timestamp, count_when, days_between,
                                           listed_product_count, sum_when)
from funnelspark.schemas import MONEY_SUM, ORDER_STATUSES, RECENT_DAYS, WEB_EVENT_COUNTS


def web_lifetime(stg_web: DataFrame) -> DataFrame:
    """The part of ``web_activity`` that doesn't depend on the time of the run."""
    t = F.col("event_type")
    return stg_web.groupBy("customer_id").agg(
        F.count("event_id").alias("total_web_events"),
        F.count_distinct("page_url").alias("unique_pages_visited"),   # NULL url not a page (T18)
        F.count("session_id").alias("sessions"),   # rows with a session, as the reference counts (T11)
        F.min("event_timestamp_utc").alias("first_web_activity_timestamp"),
        F.max("event_timestamp_utc").alias("last_web_activity_timestamp"),
        *[count_when(t == kind).alias(name) for name, kind in WEB_EVENT_COUNTS],
    )


def web_at(lifetime: DataFrame, as_of) -> DataFrame:
    """``int_customer_web_activity`` at a time: 13 columns per customer."""
    now = as_timestamp(as_of)
    last = F.col("last_web_activity_timestamp")
    counts = [name for name, _ in WEB_EVENT_COUNTS]
    return lifetime.select(
        "customer_id", "total_web_events", "unique_pages_visited", "sessions",
        "first_web_activity_timestamp", "last_web_activity_timestamp",
        days_between(last, now).alias("days_since_last_web_activity"), *counts,
        now.alias("dbt_loaded_at"))


def web_activity(stg_web: DataFrame, as_of) -> DataFrame:
    """``int_customer_web_activity``: 13 columns per customer."""
    return web_at(web_lifetime(stg_web), as_of)


def distinct_sessions(stg_web: DataFrame) -> DataFrame:
    """customer_id, unique_sessions: exact distinct sessions (T11), counted in two levels
    so that a hot customer's sessions are spread and no row is expanded."""
    return stg_web.where("session_id is not null").select("customer_id", "session_id").distinct() \
        .groupBy("customer_id").agg(F.count("*").alias("unique_sessions"))


def _lifetime_purchases() -> list:
    ts, amount = F.col("order_purchase_timestamp_utc"), F.col("order_total_amount_usd")
    status = F.col("order_status")
    return [
        F.count("order_id").alias("total_orders"),
        F.sum(amount).cast(MONEY_SUM).alias("total_spend_usd"),
        F.avg(amount).cast("double").alias("avg_order_value_usd"),
        F.min(ts).alias("first_purchase_timestamp"),
        F.max(ts).alias("last_purchase_timestamp"),
        *[count_when(status == s).alias(f"{s}_orders") for s in ORDER_STATUSES],
        F.sum(listed_product_count(F.col("order_product_ids_json"))).cast("bigint")
        .alias("num_products"),
    ]


def _recent_purchases(as_of) -> list:
    recent, amount = _is_recent(as_of), F.col("order_total_amount_usd")
    return [count_when(recent).alias("orders_last_30_days"),
            sum_when(recent, amount, F.lit(0).cast(MONEY_SUM)).cast(MONEY_SUM)
            .alias("spend_last_30_days_usd")]


def _is_recent(as_of) -> Column:
    return F.col("order_purchase_timestamp_utc") >= as_timestamp(as_of) - F.expr(
        f"INTERVAL {RECENT_DAYS} DAYS")


def purchase_lifetime(stg_purchases: DataFrame) -> DataFrame:
    """The part of ``purchase_activity`` that doesn't depend on the time of the run."""
    return stg_purchases.groupBy("customer_id").agg(*_lifetime_purchases())


def recent_purchases(stg_purchases: DataFrame, as_of) -> DataFrame:
    """Trailing 30-day counts at a time (A9), from the purchases of those days alone."""
    return stg_purchases.where(_is_recent(as_of)).groupBy("customer_id").agg(*_recent_purchases(as_of))


def _purchase_columns(rows: DataFrame, as_of) -> DataFrame:
    now = as_timestamp(as_of)
    return rows.select(
        "customer_id", "total_orders", "total_spend_usd", "avg_order_value_usd",
        "first_purchase_timestamp", "last_purchase_timestamp",
        days_between(F.col("last_purchase_timestamp"), now).alias("days_since_last_purchase"),
        "orders_last_30_days", "spend_last_30_days_usd",
        *[f"{s}_orders" for s in ORDER_STATUSES], "num_products", now.alias("dbt_processed_at"))


def purchases_at(lifetime: DataFrame, recent: DataFrame, as_of) -> DataFrame:
    """``int_customer_purchases`` at a time from the two parts.  The customers of the trailing
    days are merged: their number grows with all customers, and the driver would hold them."""
    r = recent.withColumnRenamed("customer_id", "r_customer_id").hint("merge")
    j = lifetime.join(r, lifetime.customer_id.eqNullSafe(r.r_customer_id), "left")
    return _purchase_columns(j.withColumn("orders_last_30_days", F.coalesce("orders_last_30_days", F.lit(0)))
                             .withColumn("spend_last_30_days_usd", F.coalesce(
                                 "spend_last_30_days_usd", F.lit(0).cast(MONEY_SUM))), as_of)


def purchase_activity(stg_purchases: DataFrame, as_of) -> DataFrame:
    """``int_customer_purchases``: 17 columns per customer, in one aggregate.

    ``avg_order_value_usd`` is a double (warehouse ``avg``), computed from the
    exact decimal average rounded to 6 places; sums stay decimal(20,2).
    """
    return _purchase_columns(stg_purchases.groupBy("customer_id").agg(
        *_lifetime_purchases(), *_recent_purchases(as_of)), as_of)
