"""Marts: marketing funnel (J1), ML profile table (J2), country and monthly
summaries (A14, A15) and the latest snapshot of an append-only mart (M6).

The two activity inputs of the funnel are each aggregated by ``customer_id``,
so both sides of the full outer join already hash-partition on the key and the
join adds no shuffle.  A full outer join has no known partitioning afterwards;
the profile mart therefore left-joins the customers with the two aggregates
directly (``profiles_from_activity``), which moves only the customers.  Every
side has one row per customer: no skew is possible.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from funnelspark.functions.columns import as_timestamp, days_between, sentinel_time
from funnelspark.schemas import (FUNNEL_COLUMNS, MONEY_COLUMNS, MONEY_SUM, PURCHASE_COUNTS, TIME_COLUMNS,
                                 WEB_COUNTS)


def _zero_filled(name: str) -> F.Column:
    c = F.col(name)
    if name in MONEY_COLUMNS:
        return F.coalesce(c, F.lit(0).cast(MONEY_SUM)).alias(name)
    if name == "avg_order_value_usd":
        return F.coalesce(c, F.lit(0.0)).alias(name)
    if name in TIME_COLUMNS:
        return F.coalesce(c, sentinel_time()).alias(name)
    if name in WEB_COUNTS or name in PURCHASE_COUNTS:
        return F.coalesce(c, F.lit(0).cast("bigint")).alias(name)
    return c.alias(name)   # recency stays NULL


def marketing_funnel(web: DataFrame, purchases: DataFrame, as_of) -> DataFrame:
    """Full outer join of web activity and purchases; absent sides become 0 or the
    1900 sentinel, recency stays NULL (J1, C10, C11)."""
    w = web.drop("dbt_loaded_at").withColumnRenamed("customer_id", "w_customer_id")
    p = purchases.drop("dbt_processed_at").withColumnRenamed("customer_id", "p_customer_id")
    j = w.join(p, w.w_customer_id == p.p_customer_id, "full_outer")
    j = j.withColumn("customer_id", F.coalesce("w_customer_id", "p_customer_id"))
    return j.select(*[_zero_filled(c) if c != "customer_id" else F.col(c)
                      for c in FUNNEL_COLUMNS],
                    as_timestamp(as_of).alias("dbt_loaded_at"))


def profiles_ml(customers: DataFrame, funnel: DataFrame, as_of) -> DataFrame:
    """Customer profile x funnel, 33 columns.

    Unmatched customers get 0 counts and money, the 1900 sentinel times and
    NULL recency (T9).
    """
    m = funnel.drop("dbt_loaded_at").withColumnRenamed("customer_id", "m_customer_id")
    return _profile_columns(customers.join(m, customers.customer_id == m.m_customer_id, "left"), as_of)


def profiles_from_activity(customers: DataFrame, web: DataFrame, purchases: DataFrame,
                           as_of) -> DataFrame:
    """``profiles_ml`` straight from the two activity tables: the same rows without the
    exchange that follows a full outer join."""
    w = web.drop("dbt_loaded_at").withColumnRenamed("customer_id", "w_customer_id")
    p = purchases.drop("dbt_processed_at").withColumnRenamed("customer_id", "p_customer_id")
    j = customers.join(w, customers.customer_id == w.w_customer_id, "left") \
        .join(p, customers.customer_id == p.p_customer_id, "left")
    return _profile_columns(j, as_of)


def _profile_columns(j: DataFrame, as_of) -> DataFrame:
    return j.select(
        "customer_id", "customer_registration_date", "customer_subscription_tier",
        "customer_acquisition_channel", "customer_email", "customer_country",
        days_between(F.col("customer_registration_date"), as_timestamp(as_of))
        .alias("days_since_registration"),
        *[_zero_filled(c) for c in FUNNEL_COLUMNS[1:]],
        F.col("loaded_at"),
        as_timestamp(as_of).alias("processed_at"),
    )


def country_summary(profiles: DataFrame, as_of) -> DataFrame:
    """Per (country, tier, channel) totals and averages."""
    return profiles.groupBy("customer_country", "customer_subscription_tier",
                            "customer_acquisition_channel").agg(
        F.count_distinct("customer_id").alias("num_customers"),
        F.sum("total_orders").cast("bigint").alias("total_orders"),
        F.sum("total_spend_usd").cast(MONEY_SUM).alias("total_spend_usd"),
        F.sum("orders_last_30_days").cast("bigint").alias("orders_last_30_days"),
        F.sum("spend_last_30_days_usd").cast(MONEY_SUM).alias("spend_last_30_days_usd"),
        F.sum("total_web_events").cast("bigint").alias("total_web_events"),
        F.sum("sessions").cast("bigint").alias("unique_sessions"),
        F.avg("days_since_last_purchase").alias("avg_days_since_last_order"),
        F.avg("days_since_last_web_activity").alias("avg_days_since_last_web_activity"),
        F.avg("days_since_registration").alias("avg_days_since_registration"),
        as_timestamp(as_of).alias("mart_loaded_at"),
    )


def monthly_summary(profiles: DataFrame, as_of) -> DataFrame:
    """Per registration month totals."""
    return profiles.groupBy(
        F.trunc("customer_registration_date", "month").alias("registration_month")).agg(
        F.count_distinct("customer_id").alias("new_customers"),
        F.sum("total_spend_usd").cast(MONEY_SUM).alias("total_spend_usd"),
        F.sum("total_orders").cast("bigint").alias("total_orders"),
        F.sum("orders_last_30_days").cast("bigint").alias("orders_last_30_days"),
        F.sum("spend_last_30_days_usd").cast(MONEY_SUM).alias("spend_last_30_days_usd"),
        F.sum("total_web_events").cast("bigint").alias("total_web_events"),
        F.sum("sessions").cast("bigint").alias("unique_sessions"),
        as_timestamp(as_of).alias("mart_loaded_at"),
    )


def append_snapshot(history: DataFrame | None, snapshot: DataFrame) -> DataFrame:
    """Append a full snapshot to an append-only mart."""
    return snapshot if history is None else history.unionByName(snapshot)


def latest_snapshot(history: DataFrame, load_col: str = "mart_loaded_at") -> DataFrame:
    """Rows of the newest load of an append-only mart (M6, R6: how the country
    and monthly reports are read).

    The newest load time is one scalar; it is applied as a literal filter so
    that a Parquet table partitioned or sorted by load time is pruned.
    """
    newest = history.agg(
        F.date_format(F.max(load_col), "yyyy-MM-dd HH:mm:ss.SSSSSS")).first()[0]
    if newest is None:
        return history.filter(F.lit(False))
    return history.filter(F.col(load_col) == F.lit(newest).cast("timestamp"))
