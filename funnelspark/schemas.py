"""Declared schemas of the event streams, landing tables and outputs.

Streams are read with these schemas (never inferred), so a bad field becomes
NULL and the rest of the record is kept.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Money is decimal(20,2), as landed; an amount beyond that is rejected, never dropped.
MONEY = T.DecimalType(20, 2)
MONEY_SUM = T.DecimalType(20, 2)

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for identical results.
# ---------------------------------------------------------------------------
# Sentinel time for "no activity" in the funnel and profile marts.
SENTINEL_TIME = "1900-01-01 00:00:00"
# Empty high-water mark (an empty target admits everything).
EPOCH_TIME = "1970-01-01 00:00:00"
# Placeholder for a NULL part of the surrogate event key (md5 over '-'-joined parts).
SURROGATE_NULL_TOKEN = "_dbt_utils_surrogate_key_null_"
SURROGATE_SEPARATOR = "-"
# Web-event types counted per customer: (output column, event type).
WEB_EVENT_COUNTS = (
    ("total_page_views", "page_view"),
    ("total_add_to_carts", "add_to_cart"),
    ("total_searches", "search"),
    ("total_product_views", "product_view"),
)
# Order statuses counted per customer.
ORDER_STATUSES = ("processing", "shipped", "cancelled", "returned", "completed")
# Window, watermark and recency parameters.
KPI_WINDOW = "1 minute"
KPI_WINDOW_SECONDS = 60
WATERMARK_DELAY = "5 seconds"
RECENT_DAYS = 30
# Change-feed operations that carry a new row (create, update, snapshot read).
CDC_ROW_OPS = ("c", "u", "r")
# Segmentation: k, seed, components, model age limit.
KMEANS_K = 3
KMEANS_SEED = 42
PCA_COMPONENTS = 3
MODEL_MAX_AGE_DAYS = 7
# Feature list requested by the clustering job, in its order.  Three of these
# names do not exist in the profile mart and are dropped (logged) at run time.
REQUESTED_FEATURES = (
    "days_since_registration", "total_orders", "total_spend_usd", "avg_order_value_usd",
    "days_since_last_purchase", "orders_last_30_days", "spend_last_30_days_usd",
    "processing_orders", "shipped_orders", "delivered_orders", "returned_orders",
    "canceled_orders", "num_products", "total_web_events", "unique_pages_visited",
    "unique_sessions", "days_since_last_web_activity", "total_add_to_carts",
    "total_searches", "total_page_views", "total_product_views",
)
# Feature list averaged per cluster by the cluster profile, in its order.
PROFILE_FEATURES = (
    "days_since_registration", "total_orders", "total_spend_usd", "avg_order_value_usd",
    "days_since_last_purchase", "orders_last_30_days", "spend_last_30_days_usd",
    "processing_orders", "shipped_orders", "completed_orders", "returned_orders",
    "cancelled_orders", "num_products", "total_web_events", "unique_pages_visited",
    "days_since_last_web_activity", "total_add_to_carts", "total_searches",
    "total_page_views", "total_product_views",
)
# Columns of the marketing funnel, in order.
FUNNEL_COLUMNS = (
    "customer_id", "total_web_events", "unique_pages_visited", "sessions",
    "first_web_activity_timestamp", "last_web_activity_timestamp",
    "days_since_last_web_activity", "total_page_views", "total_add_to_carts", "total_searches",
    "total_product_views", "total_orders", "total_spend_usd", "avg_order_value_usd",
    "first_purchase_timestamp", "last_purchase_timestamp", "days_since_last_purchase",
    "orders_last_30_days", "spend_last_30_days_usd", "processing_orders", "shipped_orders",
    "cancelled_orders", "returned_orders", "completed_orders", "num_products",
)
# Columns of the funnel by kind (what an absent side becomes).
WEB_COUNTS = ("total_web_events", "unique_pages_visited", "sessions", "total_page_views",
              "total_add_to_carts", "total_searches", "total_product_views")
PURCHASE_COUNTS = ("total_orders", "orders_last_30_days", "processing_orders", "shipped_orders",
                   "cancelled_orders", "returned_orders", "completed_orders", "num_products")
MONEY_COLUMNS = ("total_spend_usd", "spend_last_30_days_usd")
TIME_COLUMNS = ("first_web_activity_timestamp", "last_web_activity_timestamp",
                "first_purchase_timestamp", "last_purchase_timestamp")
# Steps the monitor reads from the run log.
METRIC_STEPS = ("scaler_params", "pca_params", "kmeans_metrics")

# ---------------------------------------------------------------------------
# Stream records (JSON).  Fixed values: field names of the streams, landing
# tables, row images and logs below.
# ---------------------------------------------------------------------------
WEB_EVENT_JSON = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("event_timestamp", T.TimestampType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("page_url", T.StringType()),
    T.StructField("product_id", T.StringType()),
    T.StructField("session_id", T.StringType()),
    T.StructField("device_type", T.StringType()),
    T.StructField("search_query", T.StringType()),
])

PURCHASE_EVENT_JSON = T.StructType([
    T.StructField("order_id", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("purchase_time", T.TimestampType()),
    T.StructField("total_amount", MONEY),
    T.StructField("product_ids", T.ArrayType(T.StringType())),
    T.StructField("payment_method", T.StringType()),
    T.StructField("shipping_address", T.StringType()),
    T.StructField("order_status", T.StringType()),
    T.StructField("currency", T.StringType()),
])

# ---------------------------------------------------------------------------
# Landing (raw) tables
# ---------------------------------------------------------------------------
RAW_WEB_NOT_NULL = ("user_id", "event_timestamp", "event_type", "session_id",
                    "device_type", "_processed_at")

RAW_PURCHASE_NOT_NULL = ("order_id", "user_id", "purchase_time", "_processed_at")

# Change-data envelope: row images carry times as epoch integers.
WEB_ROW_IMAGE = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("event_timestamp", T.LongType()),   # epoch microseconds
    T.StructField("event_type", T.StringType()),
    T.StructField("page_url", T.StringType()),
    T.StructField("product_id", T.StringType()),
    T.StructField("session_id", T.StringType()),
    T.StructField("device_type", T.StringType()),
    T.StructField("search_query", T.StringType()),
    T.StructField("_processed_at", T.LongType()),     # epoch microseconds
])

PURCHASE_ROW_IMAGE = T.StructType([
    T.StructField("order_id", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("purchase_time", T.LongType()),     # epoch milliseconds
    T.StructField("total_amount", MONEY),
    T.StructField("product_ids", T.StringType()),
    T.StructField("payment_method", T.StringType()),
    T.StructField("shipping_address", T.StringType()),
    T.StructField("order_status", T.StringType()),
    T.StructField("currency", T.StringType()),
    T.StructField("_processed_at", T.LongType()),     # epoch milliseconds
])


def envelope_schema(row_image: T.StructType) -> T.StructType:
    return T.StructType([
        T.StructField("before", row_image),
        T.StructField("after", row_image),
        T.StructField("op", T.StringType()),
        T.StructField("ts_ms", T.LongType()),
        T.StructField("source", T.StructType([T.StructField("lsn", T.LongType())])),
    ])


# ---------------------------------------------------------------------------
# Segmentation outputs
# ---------------------------------------------------------------------------
RUN_LOG = T.StructType([
    T.StructField("run_date", T.TimestampType()),
    T.StructField("step", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("message", T.StringType()),
])
