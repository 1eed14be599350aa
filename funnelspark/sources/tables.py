"""Readers for the driver's Parquet tables and the adapters that shape them
into the pipeline's landed feeds (web events, purchases, customer profiles).

The adapters are pure projections and one per-order aggregate; every row of
every input table is kept.  Timestamps in the files are ``timestamp_ntz`` and
are cast to session-UTC ``timestamp``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from funnelspark.functions.columns import array_as_text
from funnelspark.schemas import MONEY

# ---------------------------------------------------------------------------
# Fixed values of the adapters (see FIXTURES.md §2).
# ---------------------------------------------------------------------------
# Driver event type -> web event type.
EVENT_TYPE_MAP = (
    ("view", "page_view"),
    ("click", "product_view"),
    ("purchase", "add_to_cart"),
    ("signup", "search"),
)
OTHER_EVENT_TYPE = "login"
DEVICE_TYPES = ("mobile", "desktop", "tablet")
# Orders are dated 1995-2001; this shift puts the last order on 2024-01-31.
ORDER_DATE_SHIFT_DAYS = 8218
REGISTRATION_START = "2022-02-01"
REGISTRATION_SPAN_DAYS = 730
TIER_BY_KEY_MOD3 = ("Free", "BASIC", "Premium")
# Redelivery offsets (a feed replayed after a restart).
REDELIVERY_DELAY = "INTERVAL 1 HOUR"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _mapped(col: Column, pairs, default) -> Column:
    expr = None
    for src, dst in pairs:
        expr = (F.when(col == src, dst) if expr is None else expr.when(col == src, dst))
    return expr.otherwise(default)


def web_events(spark: SparkSession, sf_dir: str, with_source_seq: bool = False) -> DataFrame:
    """Landed web events (9 columns) from the driver's ``events`` table;
    ``with_source_seq`` adds the source's event number as ``source_seq``."""
    e = read_table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type",
                                                   "props")
    k = F.get_json_object("props", "$.k").cast("int")
    e = e.select(F.col("event_id").alias("source_seq"),
                 F.col("user_id").cast("string").alias("user_id"),
                 F.col("ts").cast("timestamp").alias("ts"),
                 F.col("event_type").alias("src_type"), k.alias("k"))
    t = F.col("src_type")
    extra = [F.col("source_seq")] if with_source_seq else []
    return e.select(
        "user_id",
        F.col("ts").alias("event_timestamp"),
        _mapped(t, EVENT_TYPE_MAP, OTHER_EVENT_TYPE).alias("event_type"),
        F.when(t.isin("view", "click"), F.concat(F.lit("/p/"), F.col("k").cast("string")))
        .alias("page_url"),
        F.when(t.isin("click", "purchase"),
               F.concat(F.lit("sku-"), (F.col("k") % 20).cast("string"))).alias("product_id"),
        F.concat_ws("-", "user_id", F.to_date("ts").cast("string")).alias("session_id"),
        F.element_at(F.array(*[F.lit(d) for d in DEVICE_TYPES]),
                     (F.col("k") % 3 + 1).cast("int")).alias("device_type"),
        F.when(t == "signup", F.concat(F.lit("q"), F.col("k").cast("string")))
        .alias("search_query"),
        (F.col("ts") + F.make_interval(secs=F.col("k").cast("decimal(18,6)")))
        .alias("_processed_at"),
        *extra,
    )


def order_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sorted product ids of each order, one row per order.

    The list is one field of one order record; its length is the order's line
    count, which the order-line key (order, line number) bounds, so the
    per-order ``collect_list`` cannot grow with the data.  Lines are moved as
    they are: lists of one or two of them, made before, would be no smaller."""
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey").repartition("l_orderkey")
    return li.groupBy("l_orderkey").agg(
        F.sort_array(F.collect_list(F.col("l_partkey").cast("string"))).alias("product_id_list"))


def purchase_events(spark: SparkSession, sf_dir: str, as_stream_record: bool = False) -> DataFrame:
    """Purchases from ``orders`` and ``lineitem``.

    ``as_stream_record=False`` gives the landed table (product ids as ``[a, b]``
    text, 10 columns); ``True`` gives the stream record (product ids as an
    array, no processing time).
    """
    o = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
        "o_orderpriority")
    p = order_products(spark, sf_dir)
    j = o.join(p, o.o_orderkey == p.l_orderkey, "left")
    purchase_time = (F.col("o_orderdate").cast("timestamp")
                     + F.expr(f"INTERVAL {ORDER_DATE_SHIFT_DAYS} DAYS"))
    key = F.col("o_orderkey")
    status = (F.when(key % 10 == 0, "cancelled").when(key % 10 == 1, "returned")
              .when(F.col("o_orderstatus") == "F", "completed")
              .when(F.col("o_orderstatus") == "O", "processing").otherwise("shipped"))
    ids = F.coalesce(F.col("product_id_list"), F.array().cast("array<string>"))
    cols = [
        key.cast("string").alias("order_id"),
        F.col("o_custkey").cast("string").alias("user_id"),
        purchase_time.alias("purchase_time"),
        F.col("o_totalprice").cast(MONEY).alias("total_amount"),
        (ids if as_stream_record else array_as_text(ids)).alias("product_ids"),
        F.col("o_orderpriority").alias("payment_method"),
        F.concat(key.cast("string"), F.lit(" Market Street, Springfield, US"))
        .alias("shipping_address"),
        status.alias("order_status"),
        F.lit("USD").alias("currency"),
    ]
    if not as_stream_record:
        cols.append((purchase_time + F.make_interval(secs=(key % 60).cast("decimal(18,6)")))
                    .alias("_processed_at"))
    return j.select(*cols)


def customer_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw customer profile file (user_id, registration_date, tier, channel, email, country)."""
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    key = F.col("c_custkey")
    return c.join(n, c.c_nationkey == n.n_nationkey, "inner").select(
        key.cast("string").alias("user_id"),
        F.date_add(F.lit(REGISTRATION_START).cast("date"),
                   (key % REGISTRATION_SPAN_DAYS).cast("int")).alias("registration_date"),
        F.element_at(F.array(*[F.lit(t) for t in TIER_BY_KEY_MOD3]),
                     (key % 3 + 1).cast("int")).alias("subscription_tier"),
        F.col("c_mktsegment").alias("acquisition_channel"),
        F.concat(key.cast("string"), F.lit("@example.com")).alias("email"),
        F.col("n_name").alias("country"),
    )


def _delivered_twice(raw: DataFrame, changed: dict[str, Column]) -> DataFrame:
    """Every row plus a second delivery with ``changed`` columns, from one scan
    of the source (a two-element ``explode``, not a union that reads twice)."""
    again = F.explode(F.array(F.lit(False), F.lit(True))).alias("_again")
    rows = raw.select("*", again)
    return rows.select(*[F.when(F.col("_again"), changed[c]).otherwise(F.col(c)).alias(c)
                         if c in changed else F.col(c) for c in raw.columns])


def redelivered_web_events(raw: DataFrame) -> DataFrame:
    """The whole feed delivered twice: the second copy arrives an hour later
    with another device type (a restart replaying from the earliest offset)."""
    rotate = _mapped(F.col("device_type"),
                     tuple(zip(DEVICE_TYPES, DEVICE_TYPES[1:] + DEVICE_TYPES[:1])),
                     F.col("device_type"))
    return _delivered_twice(raw, {
        "device_type": rotate,
        "_processed_at": F.col("_processed_at") + F.expr(REDELIVERY_DELAY)})


def redelivered_purchases(raw: DataFrame) -> DataFrame:
    """The whole feed delivered twice: the second copy is a status update an
    hour later (processing -> shipped -> completed), same purchase time."""
    advance = (F.when(F.col("order_status") == "processing", "shipped")
               .when(F.col("order_status") == "shipped", "completed")
               .otherwise(F.col("order_status")))
    return _delivered_twice(raw, {
        "order_status": advance,
        "_processed_at": F.col("_processed_at") + F.expr(REDELIVERY_DELAY)})
