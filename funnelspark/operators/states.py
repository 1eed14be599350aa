"""Mergeable per-customer states.

A state holds what can be added up: counts and sums, with first and last times, of one customer on
one day.  A run makes the states of its batch's days anew from those days of staging and adds the
difference to the customers' totals, so it reads no other staging.  Counts and sums are added with
their sign; a time that was a customer's first or last and is gone makes that customer's times be
looked up again in the states (a resent order may move; an event's key holds its time, so it
can't).  Distinct pages are counted by the number of days on which a customer saw a page.

Scale: ``groupBy(customer, day)`` is aggregated partially before the shuffle; the difference holds
the touched customers' rows of the touched days only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from funnelspark.functions.columns import as_timestamp, count_when, listed_product_count
from funnelspark.schemas import MONEY_SUM, ORDER_STATUSES, RECENT_DAYS, WEB_EVENT_COUNTS

WEB_TOTALS = ("total_web_events", "sessions", *[name for name, _ in WEB_EVENT_COUNTS])
WEB_TIMES = ("first_web_activity_timestamp", "last_web_activity_timestamp")
PURCHASE_TOTALS = ("total_orders", "spend", "n_amounts", "products", "n_listed",
                   *[f"{s}_orders" for s in ORDER_STATUSES])
PURCHASE_TIMES = ("first_purchase_timestamp", "last_purchase_timestamp")
#: Sums of money in a state.
_SUM = "decimal(28,2)"


def web_states(stg_web: DataFrame) -> DataFrame:
    """A row for each customer and day."""
    kind, t = F.col("event_type"), F.col("event_timestamp_utc")
    return stg_web.groupBy("customer_id", F.to_date(t).alias("day")).agg(
        F.count("event_id").alias("total_web_events"), F.count("session_id").alias("sessions"),
        *[count_when(kind == k).alias(name) for name, k in WEB_EVENT_COUNTS],
        F.min(t).alias(WEB_TIMES[0]), F.max(t).alias(WEB_TIMES[1]))


def page_states(stg_web: DataFrame) -> DataFrame:
    """A row for each customer, day and page seen (T18: a NULL url is no page)."""
    return stg_web.where("page_url is not null") \
        .select("customer_id", F.to_date("event_timestamp_utc").alias("day"), "page_url").distinct()


def purchase_states(stg_purchases: DataFrame) -> DataFrame:
    """A row for each customer and day."""
    t, amount, status = (F.col(c) for c in ("order_purchase_timestamp_utc", "order_total_amount_usd",
                                            "order_status"))
    listed = listed_product_count(F.col("order_product_ids_json"))
    return stg_purchases.groupBy("customer_id", F.to_date(t).alias("day")).agg(
        F.count("order_id").alias("total_orders"),
        F.coalesce(F.sum(amount), F.lit(0)).cast(_SUM).alias("spend"), F.count(amount).alias("n_amounts"),
        F.coalesce(F.sum(listed), F.lit(0)).cast("bigint").alias("products"), F.count(listed).alias("n_listed"),
        *[count_when(status == s).alias(f"{s}_orders") for s in ORDER_STATUSES],
        F.min(t).alias(PURCHASE_TIMES[0]), F.max(t).alias(PURCHASE_TIMES[1]))


def _totals(totals) -> list:
    return [F.sum(c).cast(_SUM if c == "spend" else "bigint").alias(c) for c in totals]


def totals_of(states: DataFrame, totals, times) -> DataFrame:
    """The customers' totals from all their states."""
    first, last = times
    return states.groupBy("customer_id").agg(*_totals(totals), F.min(first).alias(first),
                                             F.max(last).alias(last))


def difference(before: DataFrame, after: DataFrame, totals, times) -> DataFrame:
    """Per customer: what the totals grow by, and the first and last times before
    (``was_``) and after in the states that were made anew."""
    first, last = times
    both = after.withColumn("_sign", F.lit(1)).unionByName(before.withColumn("_sign", F.lit(-1)))
    new, old = F.col("_sign") == 1, F.col("_sign") == -1
    signed = [F.sum(F.col("_sign") * F.col(c)).cast(_SUM if c == "spend" else "bigint").alias(c) for c in totals]
    return both.groupBy("customer_id").agg(
        *signed, F.min(F.when(new, F.col(first))).alias(first), F.max(F.when(new, F.col(last))).alias(last),
        F.min(F.when(old, F.col(first))).alias("was_" + first),
        F.max(F.when(old, F.col(last))).alias("was_" + last))


def add(found: DataFrame, totals, times, keep=()) -> DataFrame:
    """New totals from a difference joined with the stored totals (``old_`` columns); ``lost``
    marks customers whose first or last time may be gone; columns ``keep`` stay."""
    first, last = times
    zero = lambda c: F.coalesce(F.col("old_" + c), F.lit(0))
    gone_first = (F.col("was_" + first) <= F.col("old_" + first)) & (
        F.col(first).isNull() | (F.col(first) > F.col("was_" + first)))
    gone_last = (F.col("was_" + last) >= F.col("old_" + last)) & (
        F.col(last).isNull() | (F.col(last) < F.col("was_" + last)))
    return found.select(
        "customer_id", *[(zero(c) + F.col(c)).cast(_SUM if c == "spend" else "bigint").alias(c) for c in totals],
        F.least(F.col("old_" + first), F.col(first)).alias(first),
        F.greatest(F.col("old_" + last), F.col(last)).alias(last),
        F.coalesce(gone_first | gone_last, F.lit(False)).alias("lost"), *keep)


def page_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """(customer_id, page_url, days): on how many more days a customer saw a page."""
    both = after.withColumn("days", F.lit(1)).unionByName(before.withColumn("days", F.lit(-1)))
    return both.groupBy("customer_id", "page_url").agg(F.sum("days").alias("days")).where("days <> 0")


def purchase_values(totals: DataFrame) -> DataFrame:
    """The absolute columns of ``purchase_lifetime`` from totals.  The average is the exact
    quotient rounded to 6 places, as the engine's decimal average is."""
    n = F.col("n_amounts")
    average = F.col("spend").cast(MONEY_SUM) / n.cast("decimal(15,0)")
    return totals.select(
        "customer_id", "total_orders", F.when(n > 0, F.col("spend").cast(MONEY_SUM)).alias("total_spend_usd"),
        F.when(n > 0, average.cast("decimal(24,6)")).cast("double").alias("avg_order_value_usd"),
        *PURCHASE_TIMES, *[f"{s}_orders" for s in ORDER_STATUSES],
        F.when(F.col("n_listed") > 0, F.col("products")).alias("num_products"))


def recent_from_states(states: DataFrame, edge_orders: DataFrame | None, as_of) -> DataFrame:
    """Trailing 30-day counts at a time (A9): whole days from their states, the day that the
    window begins in from its orders (``None`` if the window begins at midnight)."""
    start = as_timestamp(as_of) - F.expr(f"INTERVAL {RECENT_DAYS} DAYS")
    whole = F.col("day") >= F.to_date(start) if edge_orders is None else F.col("day") > F.to_date(start)
    rows = states.where(whole).select("customer_id", "total_orders", "spend")
    if edge_orders is not None:
        t = F.col("order_purchase_timestamp_utc")
        edge = edge_orders.where((t >= start) & (F.to_date(t) == F.to_date(start)))
        rows = rows.unionByName(edge.select(
            "customer_id", F.when(F.col("order_id").isNotNull(), 1).otherwise(0).cast("bigint").alias("total_orders"),
            F.coalesce("order_total_amount_usd", F.lit(0)).cast(_SUM).alias("spend")))
    return rows.groupBy("customer_id").agg(
        F.sum("total_orders").cast("bigint").alias("orders_last_30_days"),
        F.sum("spend").cast(MONEY_SUM).alias("spend_last_30_days_usd"))
