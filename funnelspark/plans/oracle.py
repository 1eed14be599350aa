"""DuckDB SQL equivalents of the named queries (the correctness oracle).

Each query is written independently in plain SQL over the driver's tables
(views ``events orders lineitem customer nation``), as a chain of CTEs that
mirrors the warehouse models: adapters -> staging -> aggregates -> marts.
"""

from __future__ import annotations

from funnelspark.schemas import SURROGATE_NULL_TOKEN

AS_OF = "2024-02-01 00:00:00"
TOKEN = f"'{SURROGATE_NULL_TOKEN}'"


def ts(value: str) -> str:
    return f"TIMESTAMP '{value}'"


def with_ctes(ctes: list[tuple[str, str]], final: str) -> str:
    body = ",\n".join(f"{name} AS (\n{sql}\n)" for name, sql in ctes)
    return f"WITH {body}\n{final}"


# ---------------------------------------------------------------- adapters
RAW_WEB_TEMPLATE = """
SELECT {seq}user_id, ts AS event_timestamp,
  CASE src_type WHEN 'view' THEN 'page_view' WHEN 'click' THEN 'product_view'
    WHEN 'purchase' THEN 'add_to_cart' WHEN 'signup' THEN 'search' ELSE 'login' END AS event_type,
  CASE WHEN src_type IN ('view','click') THEN '/p/' || cast(k AS varchar) END AS page_url,
  CASE WHEN src_type IN ('click','purchase') THEN 'sku-' || cast(k % 20 AS varchar) END AS product_id,
  user_id || '-' || cast(cast(ts AS date) AS varchar) AS session_id,
  CASE k % 3 WHEN 0 THEN 'mobile' WHEN 1 THEN 'desktop' ELSE 'tablet' END AS device_type,
  CASE WHEN src_type = 'signup' THEN 'q' || cast(k AS varchar) END AS search_query,
  ts + to_seconds(k) AS _processed_at
FROM (SELECT event_id AS source_seq, cast(user_id AS varchar) AS user_id,
             cast(ts AS timestamp) AS ts, event_type AS src_type,
             cast(json_extract_string(props, '$.k') AS integer) AS k
      FROM events) e"""
RAW_WEB0 = RAW_WEB_TEMPLATE.format(seq="")
RAW_WEB_WITH_SEQ = RAW_WEB_TEMPLATE.format(seq="source_seq, ")

RAW_WEB_REDELIVERED = """
SELECT * FROM raw_web0
UNION ALL
SELECT user_id, event_timestamp, event_type, page_url, product_id, session_id,
  CASE device_type WHEN 'mobile' THEN 'desktop' WHEN 'desktop' THEN 'tablet'
    WHEN 'tablet' THEN 'mobile' ELSE device_type END AS device_type,
  search_query, _processed_at + INTERVAL 1 HOUR AS _processed_at
FROM raw_web0"""

PRODUCTS = """
SELECT l_orderkey, list_sort(list(cast(l_partkey AS varchar))) AS ids
FROM lineitem GROUP BY l_orderkey"""

RAW_PURCHASES0 = """
SELECT cast(o_orderkey AS varchar) AS order_id, cast(o_custkey AS varchar) AS user_id,
  cast(o_orderdate AS timestamp) + INTERVAL 8218 DAY AS purchase_time,
  cast(o_totalprice AS decimal(10,2)) AS total_amount,
  '[' || coalesce(array_to_string(ids, ', '), '') || ']' AS product_ids,
  coalesce(ids, []::varchar[]) AS product_id_list,
  o_orderpriority AS payment_method,
  cast(o_orderkey AS varchar) || ' Market Street, Springfield, US' AS shipping_address,
  CASE WHEN o_orderkey % 10 = 0 THEN 'cancelled' WHEN o_orderkey % 10 = 1 THEN 'returned'
    WHEN o_orderstatus = 'F' THEN 'completed' WHEN o_orderstatus = 'O' THEN 'processing'
    ELSE 'shipped' END AS order_status,
  'USD' AS currency,
  cast(o_orderdate AS timestamp) + INTERVAL 8218 DAY + to_seconds(o_orderkey % 60) AS _processed_at
FROM orders LEFT JOIN products ON l_orderkey = o_orderkey"""

RAW_PURCHASES_REDELIVERED = """
SELECT * FROM raw_purchases0
UNION ALL
SELECT order_id, user_id, purchase_time, total_amount, product_ids, product_id_list,
  payment_method, shipping_address,
  CASE order_status WHEN 'processing' THEN 'shipped' WHEN 'shipped' THEN 'completed'
    ELSE order_status END AS order_status,
  currency, _processed_at + INTERVAL 1 HOUR AS _processed_at
FROM raw_purchases0"""

RAW_CUSTOMERS = """
SELECT cast(c_custkey AS varchar) AS user_id,
  DATE '2022-02-01' + cast(c_custkey % 730 AS integer) AS registration_date,
  CASE c_custkey % 3 WHEN 0 THEN 'Free' WHEN 1 THEN 'BASIC' ELSE 'Premium' END AS subscription_tier,
  c_mktsegment AS acquisition_channel,
  cast(c_custkey AS varchar) || '@example.com' AS email,
  n_name AS country
FROM customer JOIN nation ON c_nationkey = n_nationkey"""


def web_feed(redelivered: bool = True, cutoff: str | None = None) -> list[tuple[str, str]]:
    ctes = [("raw_web0", RAW_WEB0)]
    src = "raw_web0"
    if redelivered:
        ctes.append(("raw_web1", RAW_WEB_REDELIVERED))
        src = "raw_web1"
    where = f" WHERE _processed_at <= {ts(cutoff)}" if cutoff else ""
    ctes.append(("raw_web", f"SELECT * FROM {src}{where}"))
    return ctes


def purchase_feed(redelivered: bool = True, cutoff: str | None = None) -> list[tuple[str, str]]:
    ctes = [("products", PRODUCTS), ("raw_purchases0", RAW_PURCHASES0)]
    src = "raw_purchases0"
    if redelivered:
        ctes.append(("raw_purchases1", RAW_PURCHASES_REDELIVERED))
        src = "raw_purchases1"
    where = f" WHERE _processed_at <= {ts(cutoff)}" if cutoff else ""
    ctes.append(("raw_purchases", f"SELECT * FROM {src}{where}"))
    return ctes


# ---------------------------------------------------------------- staging
def stg_web_sql(as_of: str = AS_OF, src: str = "raw_web") -> str:
    sec = "date_trunc('second', event_timestamp)"
    return f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY event_id
           ORDER BY event_timestamp_utc DESC, stream_processed_at_utc DESC) AS rn
  FROM (
    SELECT user_id AS customer_id, {sec} AS event_timestamp_utc, event_type, page_url,
      product_id, session_id, device_type, search_query,
      date_trunc('second', _processed_at) AS stream_processed_at_utc,
      md5(concat_ws('-', coalesce(user_id, {TOKEN}), coalesce(cast({sec} AS varchar), {TOKEN}),
                    coalesce(session_id, {TOKEN}))) AS event_id,
      {ts(as_of)} AS dbt_loaded_at
    FROM {src}) b) d
WHERE rn = 1"""


def stg_purchases_sql(as_of: str = AS_OF, src: str = "raw_purchases") -> str:
    return f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY order_id
           ORDER BY order_purchase_timestamp_utc DESC, stream_processed_at_utc DESC) AS rn
  FROM (
    SELECT order_id, user_id AS customer_id,
      date_trunc('second', purchase_time) AS order_purchase_timestamp_utc,
      cast(total_amount AS decimal(10,2)) AS order_total_amount_usd,
      product_ids AS order_product_ids_json, payment_method AS order_payment_method,
      shipping_address AS order_shipping_address, order_status, currency AS order_currency,
      date_trunc('second', _processed_at) AS stream_processed_at_utc,
      {ts(as_of)} AS dbt_loaded_at
    FROM {src}) b) d
WHERE rn = 1"""


def stg_customers_sql(as_of: str = AS_OF) -> str:
    return f"""
SELECT user_id AS customer_id, cast(registration_date AS date) AS customer_registration_date,
  lower(subscription_tier) AS customer_subscription_tier,
  lower(acquisition_channel) AS customer_acquisition_channel,
  email AS customer_email, country AS customer_country, {ts(as_of)} AS loaded_at
FROM raw_customers"""


# ---------------------------------------------------------------- aggregates
def _count_if(cond: str) -> str:
    return f"cast(sum(CASE WHEN {cond} THEN 1 ELSE 0 END) AS bigint)"


def web_activity_sql(as_of: str = AS_OF, src: str = "stg_web") -> str:
    return f"""
SELECT customer_id,
  count(event_id) AS total_web_events,
  count(DISTINCT page_url) AS unique_pages_visited,
  count(session_id) AS sessions,
  min(event_timestamp_utc) AS first_web_activity_timestamp,
  max(event_timestamp_utc) AS last_web_activity_timestamp,
  cast(date_diff('day', cast(max(event_timestamp_utc) AS date), cast({ts(as_of)} AS date)) AS integer)
    AS days_since_last_web_activity,
  {_count_if("event_type = 'page_view'")} AS total_page_views,
  {_count_if("event_type = 'add_to_cart'")} AS total_add_to_carts,
  {_count_if("event_type = 'search'")} AS total_searches,
  {_count_if("event_type = 'product_view'")} AS total_product_views,
  {ts(as_of)} AS dbt_loaded_at
FROM {src} GROUP BY customer_id"""


def purchase_activity_sql(as_of: str = AS_OF, src: str = "stg_purchases") -> str:
    recent = f"order_purchase_timestamp_utc >= {ts(as_of)} - INTERVAL 30 DAY"
    n_products = ("len(string_split(replace(replace(order_product_ids_json, '[', ''), ']', ''), ','))")
    return f"""
SELECT customer_id,
  count(order_id) AS total_orders,
  cast(sum(order_total_amount_usd) AS decimal(20,2)) AS total_spend_usd,
  cast(round(cast(sum(order_total_amount_usd) AS decimal(38,6)) / count(order_total_amount_usd), 6) AS double)
    AS avg_order_value_usd,
  min(order_purchase_timestamp_utc) AS first_purchase_timestamp,
  max(order_purchase_timestamp_utc) AS last_purchase_timestamp,
  cast(date_diff('day', cast(max(order_purchase_timestamp_utc) AS date), cast({ts(as_of)} AS date)) AS integer)
    AS days_since_last_purchase,
  {_count_if(recent)} AS orders_last_30_days,
  cast(sum(CASE WHEN {recent} THEN order_total_amount_usd ELSE 0 END) AS decimal(20,2))
    AS spend_last_30_days_usd,
  {_count_if("order_status = 'processing'")} AS processing_orders,
  {_count_if("order_status = 'shipped'")} AS shipped_orders,
  {_count_if("order_status = 'cancelled'")} AS cancelled_orders,
  {_count_if("order_status = 'returned'")} AS returned_orders,
  {_count_if("order_status = 'completed'")} AS completed_orders,
  cast(sum({n_products}) AS bigint) AS num_products,
  {ts(as_of)} AS dbt_processed_at
FROM {src} GROUP BY customer_id"""


SENTINEL = "TIMESTAMP '1900-01-01 00:00:00'"


def funnel_sql(as_of: str = AS_OF, web: str = "web_act", pur: str = "pur_act") -> str:
    z = "cast(0 AS bigint)"
    return f"""
SELECT coalesce(w.customer_id, p.customer_id) AS customer_id,
  coalesce(w.total_web_events, {z}) AS total_web_events,
  coalesce(w.unique_pages_visited, {z}) AS unique_pages_visited,
  coalesce(w.sessions, {z}) AS sessions,
  coalesce(w.first_web_activity_timestamp, {SENTINEL}) AS first_web_activity_timestamp,
  coalesce(w.last_web_activity_timestamp, {SENTINEL}) AS last_web_activity_timestamp,
  w.days_since_last_web_activity,
  coalesce(w.total_page_views, {z}) AS total_page_views,
  coalesce(w.total_add_to_carts, {z}) AS total_add_to_carts,
  coalesce(w.total_searches, {z}) AS total_searches,
  coalesce(w.total_product_views, {z}) AS total_product_views,
  coalesce(p.total_orders, {z}) AS total_orders,
  coalesce(p.total_spend_usd, cast(0 AS decimal(20,2))) AS total_spend_usd,
  coalesce(p.avg_order_value_usd, 0.0) AS avg_order_value_usd,
  coalesce(p.first_purchase_timestamp, {SENTINEL}) AS first_purchase_timestamp,
  coalesce(p.last_purchase_timestamp, {SENTINEL}) AS last_purchase_timestamp,
  p.days_since_last_purchase,
  coalesce(p.orders_last_30_days, {z}) AS orders_last_30_days,
  coalesce(p.spend_last_30_days_usd, cast(0 AS decimal(20,2))) AS spend_last_30_days_usd,
  coalesce(p.processing_orders, {z}) AS processing_orders,
  coalesce(p.shipped_orders, {z}) AS shipped_orders,
  coalesce(p.cancelled_orders, {z}) AS cancelled_orders,
  coalesce(p.returned_orders, {z}) AS returned_orders,
  coalesce(p.completed_orders, {z}) AS completed_orders,
  coalesce(p.num_products, {z}) AS num_products,
  {ts(as_of)} AS dbt_loaded_at
FROM {web} w FULL OUTER JOIN {pur} p ON w.customer_id = p.customer_id"""


FUNNEL_METRICS = (
    "total_web_events", "unique_pages_visited", "sessions", "first_web_activity_timestamp",
    "last_web_activity_timestamp", "days_since_last_web_activity", "total_page_views",
    "total_add_to_carts", "total_searches", "total_product_views", "total_orders",
    "total_spend_usd", "avg_order_value_usd", "first_purchase_timestamp",
    "last_purchase_timestamp", "days_since_last_purchase", "orders_last_30_days",
    "spend_last_30_days_usd", "processing_orders", "shipped_orders", "cancelled_orders",
    "returned_orders", "completed_orders", "num_products",
)


def _profile_fill(name: str) -> str:
    if name.startswith("days_since"):
        return f"m.{name}"
    if name.endswith("_timestamp"):
        return f"coalesce(m.{name}, {SENTINEL}) AS {name}"
    if name in ("total_spend_usd", "spend_last_30_days_usd"):
        return f"coalesce(m.{name}, cast(0 AS decimal(20,2))) AS {name}"
    if name == "avg_order_value_usd":
        return f"coalesce(m.{name}, 0.0) AS {name}"
    return f"coalesce(m.{name}, cast(0 AS bigint)) AS {name}"


def profiles_sql(as_of: str = AS_OF, cust: str = "stg_customers", fun: str = "funnel") -> str:
    fills = ",\n  ".join(_profile_fill(n) for n in FUNNEL_METRICS)
    return f"""
SELECT c.customer_id, c.customer_registration_date, c.customer_subscription_tier,
  c.customer_acquisition_channel, c.customer_email, c.customer_country,
  cast(date_diff('day', c.customer_registration_date, cast({ts(as_of)} AS date)) AS integer)
    AS days_since_registration,
  {fills},
  c.loaded_at, {ts(as_of)} AS processed_at
FROM {cust} c LEFT JOIN {fun} m ON c.customer_id = m.customer_id"""


def country_summary_sql(as_of: str = AS_OF, src: str = "profiles") -> str:
    return f"""
SELECT customer_country, customer_subscription_tier, customer_acquisition_channel,
  count(DISTINCT customer_id) AS num_customers,
  cast(sum(total_orders) AS bigint) AS total_orders,
  cast(sum(total_spend_usd) AS decimal(20,2)) AS total_spend_usd,
  cast(sum(orders_last_30_days) AS bigint) AS orders_last_30_days,
  cast(sum(spend_last_30_days_usd) AS decimal(20,2)) AS spend_last_30_days_usd,
  cast(sum(total_web_events) AS bigint) AS total_web_events,
  cast(sum(sessions) AS bigint) AS unique_sessions,
  avg(days_since_last_purchase) AS avg_days_since_last_order,
  avg(days_since_last_web_activity) AS avg_days_since_last_web_activity,
  avg(days_since_registration) AS avg_days_since_registration,
  {ts(as_of)} AS mart_loaded_at
FROM {src}
GROUP BY customer_country, customer_subscription_tier, customer_acquisition_channel"""


def monthly_summary_sql(as_of: str = AS_OF, src: str = "profiles") -> str:
    return f"""
SELECT cast(date_trunc('month', customer_registration_date) AS date) AS registration_month,
  count(DISTINCT customer_id) AS new_customers,
  cast(sum(total_spend_usd) AS decimal(20,2)) AS total_spend_usd,
  cast(sum(total_orders) AS bigint) AS total_orders,
  cast(sum(orders_last_30_days) AS bigint) AS orders_last_30_days,
  cast(sum(spend_last_30_days_usd) AS decimal(20,2)) AS spend_last_30_days_usd,
  cast(sum(total_web_events) AS bigint) AS total_web_events,
  cast(sum(sessions) AS bigint) AS unique_sessions,
  {ts(as_of)} AS mart_loaded_at
FROM {src} GROUP BY 1"""


# ---------------------------------------------------------------- chains
def chain_to_profiles(as_of: str = AS_OF, cutoff: str | None = None,
                      suffix: str = "") -> list[tuple[str, str]]:
    """CTEs from the raw tables to ``profiles{suffix}`` for a run at ``as_of``."""
    s = suffix
    ctes = []
    for name, sql in web_feed(cutoff=cutoff) + purchase_feed(cutoff=cutoff):
        if s:
            for base in ("raw_web0", "raw_web1", "raw_web", "products", "raw_purchases0",
                         "raw_purchases1", "raw_purchases"):
                sql = _rename(sql, base, base + s)
        ctes.append((name + s, sql))
    ctes += [
        ("raw_customers" + s, RAW_CUSTOMERS),
        ("stg_web" + s, stg_web_sql(as_of, "raw_web" + s)),
        ("stg_purchases" + s, stg_purchases_sql(as_of, "raw_purchases" + s)),
        ("stg_customers" + s, stg_customers_sql(as_of).replace("raw_customers",
                                                              "raw_customers" + s)),
        ("web_act" + s, web_activity_sql(as_of, "stg_web" + s)),
        ("pur_act" + s, purchase_activity_sql(as_of, "stg_purchases" + s)),
        ("funnel" + s, funnel_sql(as_of, "web_act" + s, "pur_act" + s)),
        ("profiles" + s, profiles_sql(as_of, "stg_customers" + s, "funnel" + s)),
    ]
    return ctes


def _rename(sql: str, name: str, new: str) -> str:
    import re
    return re.sub(rf"\b{name}\b", new, sql)


# ---------------------------------------------------------------- minute KPIs
def web_kpi_sql(src: str = "raw_web0", ts_expr: str = "event_timestamp",
                closed_only: bool = False) -> str:
    """Minute web KPIs; ``closed_only`` keeps windows the 5 s watermark has closed."""
    flag = "cast(sum(CASE WHEN {c} IS NOT NULL THEN 1 ELSE 0 END) AS bigint)"
    where = (f"\nWHERE window_end <= (SELECT max({ts_expr}) FROM {src}) - INTERVAL 5 SECOND"
             if closed_only else "")
    return f"""
SELECT * FROM (
  SELECT date_trunc('minute', {ts_expr}) AS window_start,
    date_trunc('minute', {ts_expr}) + INTERVAL 1 MINUTE AS window_end,
    count(*) AS total_events, count(DISTINCT user_id) AS unique_users,
    {flag.format(c="page_url")} AS total_page_views,
    {flag.format(c="product_id")} AS total_product_clicks
  FROM {src} GROUP BY 1, 2) k{where}"""


def purchase_kpi_sql(src: str = "raw_purchases0", ts_expr: str = "purchase_time",
                     closed_only: bool = False) -> str:
    where = (f"\nWHERE window_end <= (SELECT max({ts_expr}) FROM {src}) - INTERVAL 5 SECOND"
             if closed_only else "")
    return f"""
SELECT * FROM (
  SELECT date_trunc('minute', {ts_expr}) AS window_start,
    date_trunc('minute', {ts_expr}) + INTERVAL 1 MINUTE AS window_end,
    count(*) AS total_orders,
    cast(sum(total_amount) AS decimal(20,2)) AS total_amount,
    cast(cast(round(cast(sum(total_amount) AS decimal(38,6)) / count(total_amount), 6)
              AS decimal(20,6)) AS decimal(20,2)) AS avg_amount,
    cast(sum(len(product_id_list)) AS bigint) AS total_products
  FROM {src} GROUP BY 1, 2) k{where}"""


# ---------------------------------------------------------------- segmentation
def features_sql(features, src: str = "profiles") -> str:
    cols = ",\n  ".join(f"coalesce(cast({f} AS double), 0.0) AS {f}" for f in features)
    return f"SELECT customer_id,\n  {cols}\nFROM {src}"


def scaled_sql(features, src: str = "features") -> str:
    cols = ",\n  ".join(
        f"round(CASE WHEN stddev_samp({f}) OVER () = 0 THEN 0.0 ELSE "
        f"({f} - avg({f}) OVER ()) / stddev_samp({f}) OVER () END, 6) AS {f}" for f in features)
    return f"SELECT customer_id,\n  {cols}\nFROM {src}"


def exact_avg_sql(col: str) -> str:
    return (f"cast(round(cast(sum(cast({col} AS decimal(38,6))) AS decimal(38,6)) / "
            f"count({col}), 6) AS double)")


def rule_clusters_sql(src: str = "profiles") -> str:
    """The fixed assignment rule standing in for the model: key modulo 3."""
    return f"SELECT customer_id, cast(cast(customer_id AS bigint) % 3 AS integer) AS cluster FROM {src}"


def cluster_profile_sql(features, analysis_time: str, profiles: str = "profiles",
                        clusters: str = "clusters") -> str:
    avgs = ",\n  ".join(f"{exact_avg_sql('p.' + f)} AS avg_{f}" for f in features)
    return f"""
SELECT c.cluster,
  {avgs},
  count(*) AS rows_in_cluster,
  {ts(analysis_time)} AS analysis_timestamp
FROM {profiles} p JOIN {clusters} c ON p.customer_id = c.customer_id
GROUP BY c.cluster"""


def history_ctes(features, run_times) -> list[tuple[str, str]]:
    """Cluster profiles of the rule clusters at each run time, appended."""
    ctes: list[tuple[str, str]] = []
    parts = []
    for i, t in enumerate(run_times):
        s = f"_r{i}"
        ctes += chain_to_profiles(as_of=t, cutoff=t, suffix=s)
        ctes.append((f"clusters{s}", rule_clusters_sql(f"profiles{s}")))
        ctes.append((f"cprof{s}", cluster_profile_sql(features, t, f"profiles{s}",
                                                      f"clusters{s}")))
        parts.append(f"SELECT * FROM cprof{s}")
    ctes.append(("history", "\nUNION ALL\n".join(parts)))
    return ctes


def diffs_sql(metrics, src: str = "history") -> str:
    cols = []
    for m in metrics:
        if m == "rows_in_cluster":
            cols.append(f"{m} - lag({m}) OVER w AS {m}")
        else:
            cols.append(f"cast(cast({m} AS decimal(38,6)) - lag(cast({m} AS decimal(38,6))) "
                        f"OVER w AS decimal(38,6)) AS {m}")
    body = ",\n  ".join(cols)
    return f"""
SELECT cluster, analysis_timestamp,
  {body}
FROM {src}
WINDOW w AS (PARTITION BY cluster ORDER BY analysis_timestamp)
QUALIFY row_number() OVER w > 1"""


def trends_ctes(metrics, history: str = "history", diffs: str = "diffs") -> list[tuple[str, str]]:
    vals = ", ".join(f"cast({m} AS double) AS {m}" for m in metrics)
    chg = ", ".join(f"cast({m} AS decimal(38,6)) AS {m}" for m in metrics)
    on = ", ".join(metrics)
    return [
        ("hv", f"SELECT cluster, analysis_timestamp, {vals} FROM {history}"),
        ("dv", f"SELECT cluster, analysis_timestamp, {chg} FROM {diffs}"),
        ("hl", f"SELECT * FROM hv UNPIVOT INCLUDE NULLS (value FOR metric IN ({on}))"),
        ("dl", f"SELECT * FROM dv UNPIVOT INCLUDE NULLS (diff FOR metric IN ({on}))"),
    ]


TRENDS_FINAL = """
SELECT v.cluster, v.analysis_timestamp, v.metric, v.value, d.diff,
  CASE WHEN d.diff < 0 THEN 'down' WHEN d.diff IS NOT NULL THEN 'not_down' END AS direction
FROM hl v LEFT JOIN dl d
  ON v.cluster = d.cluster AND v.analysis_timestamp = d.analysis_timestamp
 AND v.metric = d.metric"""


def insights_sql(src: str = "diffs") -> str:
    def f5(x):
        return f"cast(round(cast({x} AS decimal(38,6)), 5) AS varchar)"
    c = "cast(cluster AS varchar)"
    n = "rows_in_cluster"
    s, a = "avg_total_spend_usd", "avg_avg_order_value_usd"
    r, w = "avg_days_since_last_purchase", "avg_days_since_last_web_activity"
    return f"""
SELECT cluster, analysis_timestamp, population_text, spend_text, recency_text, web_text,
  concat_ws(chr(10), '📊 **Cluster ' || cast(cluster AS varchar) || ' Insights**',
            '- ' || population_text, '- ' || spend_text, '- ' || recency_text,
            '- ' || web_text) AS insight
FROM (
  SELECT cluster, analysis_timestamp,
    CASE WHEN {n} > 0 THEN 'Cluster ' || {c} || ' grew by ' || format('{{:,}}', abs({n})) || ' members.'
         WHEN {n} < 0 THEN 'Cluster ' || {c} || ' shrank by ' || format('{{:,}}', abs({n})) || ' members.'
         ELSE 'Cluster ' || {c} || ' population remained stable.' END AS population_text,
    CASE WHEN {s} > 0 THEN 'Average spend increased by $' || {f5(s)} || ' (AOV change: $' || {f5(a)} || ').'
         WHEN {s} < 0 THEN 'Average spend decreased by $' || {f5('abs(' + s + ')')} || ' (AOV change: $' || {f5(a)} || ').'
         ELSE 'Average spend remained unchanged.' END AS spend_text,
    CASE WHEN {r} < 0 THEN 'Customers purchased more recently (' || {f5(r)} || ' days sooner).'
         WHEN {r} > 0 THEN 'Customers purchased less recently (' || {f5(r)} || ' days later).'
         ELSE 'Purchase recency unchanged.' END AS recency_text,
    CASE WHEN {w} < 0 THEN 'Web activity improved (' || {f5(w)} || ' days sooner).'
         WHEN {w} > 0 THEN 'Web activity declined (' || {f5(w)} || ' days later).'
         ELSE 'Web activity unchanged.' END AS web_text
  FROM {src}) t"""


ORACLE_CDC_WEB = with_ctes([("raw_web0", RAW_WEB_WITH_SEQ)], """
SELECT user_id, date_trunc('second', event_timestamp) AS event_timestamp, event_type,
  page_url, product_id, session_id, device_type, search_query,
  date_trunc('second', _processed_at) AS _processed_at,
  date_trunc('second', _processed_at) AS kafka_time, source_seq AS kafka_offset
FROM raw_web0""")


def scaler_sql(features, src: str = "features") -> str:
    """Mean and sample deviation of every feature as rows."""
    rows = [f"SELECT {ts(AS_OF)} AS run_date, '{f}' AS feature, round(avg({f}), 4) AS mean, "
            f"round(stddev_samp({f}), 4) AS deviation FROM {src}" for f in features]
    return "\nUNION ALL\n".join(rows)


def replace_batch_ctes(split: str) -> list[tuple[str, str]]:
    """Two runs (at ``split`` and AS_OF) of the reference's incremental models: aggregates
    replaced by those of the rows past the event-time mark, marts by the rows past the
    greatest activity time; every tenth customer is new in the second run."""
    greatest = (f"greatest(coalesce({{0}}last_web_activity_timestamp{{1}}, {SENTINEL}), "
                f"coalesce({{0}}last_purchase_timestamp{{1}}, {SENTINEL}))")
    row, whole = greatest.format("", ""), greatest.format("max(", ")")

    def after(name, target, fresh):
        return (name, f"SELECT * FROM {target} WHERE customer_id NOT IN (SELECT customer_id FROM {fresh})\n"
                      f"UNION ALL SELECT * FROM {fresh}")

    def past_time(name, stg, time, target, last):
        return (name, f"SELECT * FROM {stg} WHERE {time} > (SELECT coalesce(max({last}), "
                      f"TIMESTAMP '1970-01-01 00:00:00') FROM {target})")

    def past_activity(name, rows, target):
        return (name, f"SELECT * FROM {rows} WHERE {row} > (SELECT {whole} FROM {target})")
    return web_feed() + purchase_feed() + [
        ("raw_customers", RAW_CUSTOMERS),
        ("stg_web", stg_web_sql()), ("stg_purchases", stg_purchases_sql()),
        ("stg_customers", stg_customers_sql()),
        ("web_r1", f"SELECT * FROM raw_web WHERE _processed_at <= {ts(split)}"),
        ("pur_r1", f"SELECT * FROM raw_purchases WHERE _processed_at <= {ts(split)}"),
        ("stg_web1", stg_web_sql(split, "web_r1")), ("stg_pur1", stg_purchases_sql(split, "pur_r1")),
        ("cust1", f"SELECT * FROM ({stg_customers_sql(split)}) c WHERE cast(customer_id AS bigint) % 10 <> 0"),
        ("web1", web_activity_sql(split, "stg_web1")), ("pur1", purchase_activity_sql(split, "stg_pur1")),
        ("funnel1", funnel_sql(split, "web1", "pur1")),
        ("profiles1", profiles_sql(split, "cust1", "funnel1")),
        past_time("web_batch", "stg_web", "event_timestamp_utc", "web1", "last_web_activity_timestamp"),
        past_time("pur_batch", "stg_purchases", "order_purchase_timestamp_utc", "pur1",
                  "last_purchase_timestamp"),
        ("web2", web_activity_sql(AS_OF, "web_batch")), ("pur2", purchase_activity_sql(AS_OF, "pur_batch")),
        after("web_after", "web1", "web2"), after("pur_after", "pur1", "pur2"),
        ("funnel2", funnel_sql(AS_OF, "web_after", "pur_after")),
        past_activity("funnel_fresh", "funnel2", "funnel1"),
        after("funnel_after", "funnel1", "funnel_fresh"),
        ("profiles2", profiles_sql(AS_OF, "stg_customers", "funnel_after")),
        past_activity("profiles_fresh", "profiles2", "profiles1"),
        after("profiles_after", "profiles1", "profiles_fresh"),
    ]
