"""Feeds and model chains shared by the named queries (M11 order).

raw feeds -> staging (dedup) -> per-customer aggregates -> funnel -> profiles
-> summaries.  Each step is a DataFrame function; nothing is materialized
between them unless reused by several consumers.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from funnelspark.functions.columns import as_timestamp
from funnelspark.operators import activity, marts, staging
from funnelspark.schemas import PURCHASE_EVENT_JSON, WEB_EVENT_JSON
from funnelspark.session import materialize
from funnelspark.sources import json_feed, tables

# Fixed run time of every batch query (the reference uses now()).
AS_OF = dt.datetime(2024, 2, 1, 0, 0, 0)


def raw_web(spark: SparkSession, sf_dir: str, redelivered: bool = True, landed: bool = False) -> DataFrame:
    """``landed``: for several runs over one feed, which is parsed and written once (before
    the second delivery, so half of its rows are stored)."""
    raw = tables.web_events(spark, sf_dir)
    if landed:
        raw = materialize(raw, "landed-web")
    return tables.redelivered_web_events(raw) if redelivered else raw


def raw_purchases(spark: SparkSession, sf_dir: str, redelivered: bool = True, landed: bool = False) -> DataFrame:
    """``landed``: as in ``raw_web``; the orders are joined with their lines once."""
    raw = tables.purchase_events(spark, sf_dir)
    if landed:
        raw = materialize(raw, "landed-purchases")
    return tables.redelivered_purchases(raw) if redelivered else raw


def processed_until(df: DataFrame, as_of, col: str = "_processed_at") -> DataFrame:
    """Rows that had landed by ``as_of`` (what a run at that time could see)."""
    return df.filter(F.col(col) <= as_timestamp(as_of))


def stg_web(spark, sf_dir, as_of=AS_OF, cutoff=None) -> DataFrame:
    raw = raw_web(spark, sf_dir)
    if cutoff is not None:
        raw = processed_until(raw, cutoff)
    return staging.stg_website_events(raw, as_of)


def stg_purchases(spark, sf_dir, as_of=AS_OF, cutoff=None) -> DataFrame:
    raw = raw_purchases(spark, sf_dir)
    if cutoff is not None:
        raw = processed_until(raw, cutoff)
    return staging.stg_purchase_events(raw, as_of)


def stg_customers(spark, sf_dir, as_of=AS_OF) -> DataFrame:
    return staging.stg_customers(tables.customer_profiles(spark, sf_dir), as_of)


def funnel(spark, sf_dir, as_of=AS_OF, cutoff=None) -> DataFrame:
    w = activity.web_activity(stg_web(spark, sf_dir, as_of, cutoff), as_of)
    p = activity.purchase_activity(stg_purchases(spark, sf_dir, as_of, cutoff), as_of)
    return marts.marketing_funnel(w, p, as_of)


def profiles(spark, sf_dir, as_of=AS_OF, cutoff=None) -> DataFrame:
    w = activity.web_activity(stg_web(spark, sf_dir, as_of, cutoff), as_of)
    p = activity.purchase_activity(stg_purchases(spark, sf_dir, as_of, cutoff), as_of)
    return marts.profiles_from_activity(stg_customers(spark, sf_dir, as_of), w, p, as_of)


# ---------------------------------------------------------------- JSON feeds
# Orders with this priority are sent as guest checkouts: no customer id.
GUEST_PRIORITY = "5-LOW"


def web_json(spark, sf_dir) -> DataFrame:
    """The web feed as the producer sends it: one JSON text per event."""
    return json_feed.to_json_records(tables.web_events(spark, sf_dir),
                                     WEB_EVENT_JSON.fieldNames())


def purchase_records(spark, sf_dir, with_guests: bool = False) -> DataFrame:
    rec = tables.purchase_events(spark, sf_dir, as_stream_record=True)
    if with_guests:
        rec = rec.withColumn("user_id", F.when(F.col("payment_method") != GUEST_PRIORITY,
                                               F.col("user_id")))
    return rec


def purchase_json(spark, sf_dir, with_guests: bool = False) -> DataFrame:
    return json_feed.to_json_records(purchase_records(spark, sf_dir, with_guests),
                                     PURCHASE_EVENT_JSON.fieldNames())
