"""Named queries: each takes (spark, sf_dir) and returns a DataFrame over the
whole driver tables.  ``ORACLES`` holds the DuckDB SQL of each query that has
one (see ``oracle.py``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import Pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from funnelspark.functions.columns import as_timestamp
from funnelspark.operators import activity, kpi, marts, reports, segments
from funnelspark.plans import feeds, model_runs, segment_job
from funnelspark.plans import oracle as O
from funnelspark.session import ensure_session_defaults, materialize, scratch_path
from funnelspark.schemas import (PROFILE_FEATURES, PURCHASE_EVENT_JSON, REQUESTED_FEATURES,
                                WEB_EVENT_JSON)
from funnelspark.sources import cdc, json_feed, lake, snapshots, tables
from funnelspark.streaming import kpi_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ensure_session_defaults(spark)
            return fn(spark, sf_dir)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run
    return deco


_FULL = O.chain_to_profiles()
# Landed rows before this time reach the change feed as the initial snapshot.
CDC_SNAPSHOT_BEFORE = "2024-01-15 00:00:00"
# The KPI job was first stopped here and later restarted from the earliest offset.
KPI_RESTART_AT = "2024-01-16 00:00:00"


def _upto(name: str) -> list[tuple[str, str]]:
    names = [n for n, _ in _FULL]
    return _FULL[: names.index(name) + 1]


# ---------------------------------------------------------------- staging
@register("q_stg_customers", O.with_ctes(_upto("stg_customers"), "SELECT * FROM stg_customers"))
def q_stg_customers(spark, sf_dir):
    """Profile file as loaded."""
    return feeds.stg_customers(spark, sf_dir)


@register("q_stg_website_events", O.with_ctes(_upto("stg_web"), "SELECT * FROM stg_web"))
def q_stg_website_events(spark, sf_dir):
    """Web events delivered twice, one row per event key."""
    return feeds.stg_web(spark, sf_dir)


@register("q_stg_purchase_events",
          O.with_ctes(_upto("stg_purchases"), "SELECT * FROM stg_purchases"))
def q_stg_purchase_events(spark, sf_dir):
    """Purchases delivered twice (status update), one row per order."""
    return feeds.stg_purchases(spark, sf_dir)


# ---------------------------------------------------------------- aggregates
@register("q_web_activity", O.with_ctes(_upto("web_act"), "SELECT * FROM web_act"))
def q_web_activity(spark, sf_dir):
    """Per-customer web activity."""
    return activity.web_activity(feeds.stg_web(spark, sf_dir), feeds.AS_OF)


@register("q_purchases", O.with_ctes(_upto("pur_act"), "SELECT * FROM pur_act"))
def q_purchases(spark, sf_dir):
    """Per-customer purchases."""
    return activity.purchase_activity(feeds.stg_purchases(spark, sf_dir), feeds.AS_OF)


@register("q_marketing_funnel", O.with_ctes(_upto("funnel"), "SELECT * FROM funnel"))
def q_marketing_funnel(spark, sf_dir):
    """The flagship funnel mart."""
    return feeds.funnel(spark, sf_dir)


@register("q_profiles_ml", O.with_ctes(_FULL, "SELECT * FROM profiles"))
def q_profiles_ml(spark, sf_dir):
    """The 33-column profile mart."""
    return feeds.profiles(spark, sf_dir)


@register("q_country_summary",
          O.with_ctes(_FULL + [("summary", O.country_summary_sql())], "SELECT * FROM summary"))
def q_country_summary(spark, sf_dir):
    """Per country, tier and channel."""
    return marts.country_summary(feeds.profiles(spark, sf_dir), feeds.AS_OF)


@register("q_monthly_summary",
          O.with_ctes(_FULL + [("summary", O.monthly_summary_sql())], "SELECT * FROM summary"))
def q_monthly_summary(spark, sf_dir):
    """Per registration month."""
    return marts.monthly_summary(feeds.profiles(spark, sf_dir), feeds.AS_OF)


# ---------------------------------------------------------------- sources
_AS_OF_LIT = O.ts(O.AS_OF)


@register("q_parse_web_json", O.with_ctes([("raw_web0", O.RAW_WEB0)], f"""
SELECT user_id, date_trunc('millisecond', event_timestamp) AS event_timestamp, event_type,
  page_url, product_id, session_id, device_type, search_query, {_AS_OF_LIT} AS _processed_at
FROM raw_web0"""))
def q_parse_web_json(spark, sf_dir):
    """Web JSON records parsed with the declared schema."""
    parsed = json_feed.parse_web_events(feeds.web_json(spark, sf_dir),
                                        processed_at=as_timestamp(feeds.AS_OF))
    accepted, _ = json_feed.split_web(parsed)
    return accepted


_PURCHASE_LANDED = f"""
SELECT order_id, {{user}} AS user_id, purchase_time, total_amount, product_ids, payment_method,
  shipping_address, order_status, currency, {_AS_OF_LIT} AS _processed_at{{extra}}
FROM raw_purchases0 WHERE payment_method {{op}} '{feeds.GUEST_PRIORITY}'"""


@register("q_parse_purchase_json", O.with_ctes(
    [("products", O.PRODUCTS), ("raw_purchases0", O.RAW_PURCHASES0)],
    _PURCHASE_LANDED.format(user="user_id", extra="", op="<>")))
def q_parse_purchase_json(spark, sf_dir):
    """Purchase JSON (guest checkouts carry no customer)
    parsed and landed; rows with a NULL key are not accepted."""
    recs = json_feed.parse_purchase_records(feeds.purchase_json(spark, sf_dir, with_guests=True))
    accepted, _ = json_feed.split_purchases(
        json_feed.land_purchases(recs, processed_at=as_timestamp(feeds.AS_OF)))
    return accepted


@register("q_rejects", O.with_ctes(
    [("products", O.PRODUCTS), ("raw_purchases0", O.RAW_PURCHASES0)],
    _PURCHASE_LANDED.format(user="cast(NULL AS varchar)",
                            extra=", 'user_id is null' AS reject_reason", op="=")))
def q_rejects(spark, sf_dir):
    """The reject output of purchase landing (NULL customer id)."""
    recs = json_feed.parse_purchase_records(feeds.purchase_json(spark, sf_dir, with_guests=True))
    _, rejected = json_feed.split_purchases(
        json_feed.land_purchases(recs, processed_at=as_timestamp(feeds.AS_OF)))
    return rejected


@register("q_cdc_flatten_web", O.ORACLE_CDC_WEB)
def q_cdc_flatten_web(spark, sf_dir):
    """Web change envelopes (epoch micros) flattened and typed."""
    raw = tables.web_events(spark, sf_dir, with_source_seq=True)
    env = cdc.web_envelopes(raw, CDC_SNAPSHOT_BEFORE, "source_seq")
    return cdc.flatten_web_changes(env)


@register("q_cdc_flatten_purchase", O.with_ctes(
    [("products", O.PRODUCTS), ("raw_purchases0", O.RAW_PURCHASES0)], """
SELECT order_id, user_id, purchase_time, total_amount, product_ids, payment_method,
  shipping_address, order_status, currency, _processed_at,
  date_trunc('second', _processed_at) AS kafka_time, cast(order_id AS bigint) AS kafka_offset
FROM raw_purchases0"""))
def q_cdc_flatten_purchase(spark, sf_dir):
    """Purchase change envelopes (epoch millis) flattened."""
    raw = tables.purchase_events(spark, sf_dir)
    env = cdc.purchase_envelopes(raw.withColumn("source_seq", F.col("order_id").cast("bigint")),
                                 CDC_SNAPSHOT_BEFORE, "source_seq")
    return cdc.flatten_purchase_changes(env)


# ---------------------------------------------------------------- minute KPIs
@register("q_web_kpi_minute", O.with_ctes([("raw_web0", O.RAW_WEB0)], O.web_kpi_sql()))
def q_web_kpi_minute(spark, sf_dir):
    """X2, X3, A1, A3, A8, C23 (batch): web KPIs per minute."""
    return kpi.web_kpi(tables.web_events(spark, sf_dir))


@register("q_purchase_kpi_minute", O.with_ctes(
    [("products", O.PRODUCTS), ("raw_purchases0", O.RAW_PURCHASES0)], O.purchase_kpi_sql()))
def q_purchase_kpi_minute(spark, sf_dir):
    """X2, X4, A1, A5, A6, A10, C17, C23 (batch): purchase KPIs per minute."""
    return kpi.purchase_kpi(feeds.purchase_records(spark, sf_dir))


@register("q_latest_window", O.with_ctes([("raw_web0", O.RAW_WEB0)],
                                         f"SELECT *, {_AS_OF_LIT} AS updated_at FROM ("
                                         f"{O.web_kpi_sql()}) x"))
def q_latest_window(spark, sf_dir):
    """KPI sink rows after a restart (an early partial run and a full
    rerun append the same windows); the latest row per window is read."""
    raw = tables.web_events(spark, sf_dir)
    early = kpi.web_kpi(feeds.processed_until(raw, KPI_RESTART_AT)).withColumn(
        "updated_at", as_timestamp(KPI_RESTART_AT))
    full = kpi.web_kpi(raw).withColumn("updated_at", as_timestamp(feeds.AS_OF))
    return kpi.latest_per_window(early.unionByName(full))


# ---------------------------------------------------------------- streams
@register("q_stream_web_kpi", O.with_ctes(
    [("raw_web0", O.RAW_WEB0),
     ("ev", "SELECT date_trunc('millisecond', event_timestamp) AS t, user_id, page_url, "
            "product_id FROM raw_web0")],
    O.web_kpi_sql("ev", "t", closed_only=True)))
def q_stream_web_kpi(spark, sf_dir):
    """The web feed written as JSON files and
    replayed through the live KPI job (availableNow); windows still open at
    the end of input are not emitted."""
    feed = scratch_path(spark, "web-feed")
    feeds.web_json(spark, sf_dir).write.text(feed)
    sink, ckpt = scratch_path(spark, "web-kpi"), scratch_path(spark, "web-kpi-ckpt")
    kpi_stream.run_to_files(kpi_stream.with_update_time(
        kpi_stream.web_kpi_stream(kpi_stream.read_records(spark, feed))), sink, ckpt)
    # The sink rows carry their processing time (updated_at); read the KPIs.
    return spark.read.parquet(sink).drop("updated_at")


@register("q_stream_purchase_kpi", O.with_ctes(
    [("products", O.PRODUCTS), ("raw_purchases0", O.RAW_PURCHASES0)],
    O.purchase_kpi_sql(closed_only=True)))
def q_stream_purchase_kpi(spark, sf_dir):
    """Purchase feed replayed through the live KPI job."""
    feed = scratch_path(spark, "purchase-feed")
    feeds.purchase_json(spark, sf_dir).write.text(feed)
    sink, ckpt = scratch_path(spark, "purchase-kpi"), scratch_path(spark, "purchase-kpi-ckpt")
    kpi_stream.run_to_files(kpi_stream.with_update_time(
        kpi_stream.purchase_kpi_stream(kpi_stream.read_records(spark, feed))), sink, ckpt)
    return spark.read.parquet(sink).drop("updated_at")


# ---------------------------------------------------------------- incremental
# The history is applied in two runs: what had landed by SPLIT, then the rest.
SPLIT = "2024-01-16 00:00:00"


def _two_staging_runs(spark, first_raw, raw, kind):
    store = model_runs.Store(spark)
    first, _, mark = model_runs.stage_increment(None, first_raw, feeds.AS_OF, kind=kind, store=store)
    second, _, _ = model_runs.stage_increment(first, raw, feeds.AS_OF, kind=kind, store=store, mark=mark)
    return second.read()


@register("q_upsert_events", O.with_ctes(_upto("stg_web"), "SELECT * FROM stg_web"))
def q_upsert_events(spark, sf_dir):
    """Staged web events built in two incremental runs
    (mark on ingestion time, only the days of the batch's keys rewritten)
    equal one full run."""
    raw = feeds.raw_web(spark, sf_dir, landed=True)
    return _two_staging_runs(spark, feeds.processed_until(raw, SPLIT), raw, "web")


@register("q_upsert_orders", O.with_ctes(_upto("stg_purchases"), "SELECT * FROM stg_purchases"))
def q_upsert_orders(spark, sf_dir):
    """Staged purchases in two incremental runs."""
    raw = feeds.raw_purchases(spark, sf_dir, landed=True)
    return _two_staging_runs(spark, feeds.processed_until(raw, SPLIT), raw, "purchases")


@register("q_upsert_resent_orders", O.with_ctes(
    O.purchase_feed() + [("with_resent", f"""
SELECT * FROM raw_purchases UNION ALL
SELECT * REPLACE (purchase_time - INTERVAL 1 DAY AS purchase_time, 'processing' AS order_status,
  {O.ts(O.AS_OF)} + INTERVAL 1 DAY AS _processed_at)
FROM raw_purchases0 WHERE cast(order_id AS bigint) % 7 = 0"""),
                         ("stg", O.stg_purchases_sql(O.AS_OF, "with_resent"))], "SELECT * FROM stg"))
def q_upsert_resent_orders(spark, sf_dir):
    """Orders that are sent again in a later run with an older purchase time
    don't replace the newer row that is stored."""
    raw = feeds.raw_purchases(spark, sf_dir)
    resent = feeds.raw_purchases(spark, sf_dir, redelivered=False) \
        .where(F.col("order_id").cast("bigint") % 7 == 0) \
        .withColumn("purchase_time", F.col("purchase_time") - F.expr("INTERVAL 1 DAY")) \
        .withColumn("order_status", F.lit("processing")) \
        .withColumn("_processed_at", as_timestamp(feeds.AS_OF) + F.expr("INTERVAL 1 DAY"))
    return _two_staging_runs(spark, raw, raw.unionByName(resent), "purchases")


def _two_model_runs(spark, sf_dir, mode="touched"):
    """What had landed by SPLIT in a run at that time, the rest in a run at AS_OF; every
    tenth customer joins the profile file only before the second run (T10)."""
    raw_w, raw_p = model_runs.at_once(lambda: feeds.raw_web(spark, sf_dir, landed=True),
                                      lambda: feeds.raw_purchases(spark, sf_dir, landed=True))
    prof = tables.customer_profiles(spark, sf_dir)
    early = prof.where(F.col("user_id").cast("bigint") % 10 != 0)
    first = model_runs.run_models(None, feeds.processed_until(raw_w, SPLIT),
                                  feeds.processed_until(raw_p, SPLIT), early, SPLIT, mode=mode)
    return model_runs.run_models(first, raw_w, raw_p, prof, feeds.AS_OF, mode=mode)


def _two_activity_runs(spark, raw, kind, mode="touched"):
    """One kind's staging and aggregate in runs at SPLIT and at AS_OF."""
    store = model_runs.Store(spark)
    early = feeds.processed_until(raw, SPLIT)
    if mode == "replace_batch":
        s1, _, mark = model_runs.stage_increment(None, early, SPLIT, kind=kind, store=store)
        first = store.save(model_runs.replace_batch(None, s1.read(), SPLIT, kind=kind), "first")
        s2, _, _ = model_runs.stage_increment(s1, raw, feeds.AS_OF, kind=kind, store=store, mark=mark,
                                              replace_only=True)
        return model_runs.replace_batch(first, s2.read(), feeds.AS_OF, kind=kind)
    first = model_runs.kind_increment(None, early, SPLIT, kind=kind, store=store)
    second = model_runs.kind_increment(first, raw, feeds.AS_OF, kind=kind, store=store)
    of_run = model_runs.web_of_run if kind == "web" else model_runs.purchases_of_run
    return of_run(second, feeds.AS_OF)


@register("q_incremental_activity", O.with_ctes(_upto("web_act"), "SELECT * FROM web_act"))
def q_incremental_activity(spark, sf_dir):
    """M3, M8, M10, A12, A13 (default mode): the states of the batch's days made anew and
    their difference added to the totals; runs at two times equal one full run at the second."""
    return _two_activity_runs(spark, feeds.raw_web(spark, sf_dir, landed=True), "web")


@register("q_incremental_purchases", O.with_ctes(_upto("pur_act"), "SELECT * FROM pur_act"))
def q_incremental_purchases(spark, sf_dir):
    """Purchases per customer after runs at two times, with the trailing
    30 days of the second."""
    return _two_activity_runs(spark, feeds.raw_purchases(spark, sf_dir, landed=True), "purchases")


@register("q_incremental_funnel", O.with_ctes(_upto("funnel"), "SELECT * FROM funnel"))
def q_incremental_funnel(spark, sf_dir):
    """The whole model chain run at two times; the funnel."""
    return _two_model_runs(spark, sf_dir).funnel


@register("q_incremental_profiles", O.with_ctes(_FULL, "SELECT * FROM profiles"))
def q_incremental_profiles(spark, sf_dir):
    """The profile mart after runs at two times; customers new in the
    second are in it."""
    return _two_model_runs(spark, sf_dir).profiles


# The reference's runs: only what is past the target's marks replaces rows.
_REPLACED = O.replace_batch_ctes(SPLIT)


@register("q_incremental_activity_replace", O.with_ctes(_REPLACED, "SELECT * FROM web_after"))
def q_incremental_activity_replace(spark, sf_dir):
    """M3, M8, T5, T6 (compat mode): the second run aggregates only events past
    the global event-time mark and replaces those customers' rows."""
    return _two_activity_runs(spark, feeds.raw_web(spark, sf_dir, landed=True), "web", "replace_batch")


@register("q_incremental_funnel_replace", O.with_ctes(_REPLACED, "SELECT * FROM funnel_after"))
def q_incremental_funnel_replace(spark, sf_dir):
    """M4, M9, P10, C12 (compat mode): funnel rows past the greatest activity time."""
    return _two_model_runs(spark, sf_dir, "replace_batch").funnel


@register("q_incremental_profiles_replace", O.with_ctes(_REPLACED, "SELECT * FROM profiles_after"))
def q_incremental_profiles_replace(spark, sf_dir):
    """M4, M9, P10, C12 (compat mode): profile rows past the greatest activity time."""
    return _two_model_runs(spark, sf_dir, "replace_batch").profiles


@register("q_distinct_sessions", O.with_ctes(
    _upto("stg_web"), "SELECT customer_id, count(DISTINCT session_id) AS unique_sessions "
    "FROM stg_web WHERE session_id IS NOT NULL GROUP BY customer_id"))
def q_distinct_sessions(spark, sf_dir):
    """Exact distinct sessions per customer, beside the counted rows."""
    return activity.distinct_sessions(feeds.stg_web(spark, sf_dir))


# An earlier full snapshot of the append-only summary.
EARLIER_SNAPSHOT = "2024-01-16 00:00:00"


@register("q_latest_snapshot",
          O.with_ctes(_FULL + [("summary", O.country_summary_sql())], "SELECT * FROM summary"))
def q_latest_snapshot(spark, sf_dir):
    """Two full snapshots appended to the stored country summary; the newest load
    is found by its name, and only its files are read."""
    early = marts.country_summary(
        feeds.profiles(spark, sf_dir, as_of=EARLIER_SNAPSHOT, cutoff=EARLIER_SNAPSHOT),
        EARLIER_SNAPSHOT)
    late = marts.country_summary(feeds.profiles(spark, sf_dir), feeds.AS_OF)
    path = scratch_path(spark, "country-summary")
    snapshots.append(spark, path, early, EARLIER_SNAPSHOT)
    snapshots.append(spark, path, late, feeds.AS_OF)
    return snapshots.latest(spark, path, late.schema)


# ---------------------------------------------------------------- segmentation
_PROFILE_COLS = tuple(c for c in O.FUNNEL_METRICS) + ("days_since_registration",)
_FEATURES = [c for c in REQUESTED_FEATURES if c in _PROFILE_COLS]


@register("q_features", O.with_ctes(_FULL, O.features_sql(_FEATURES)))
def q_features(spark, sf_dir):
    """Id + the 18 existing features as doubles, NULL -> 0."""
    prof = feeds.profiles(spark, sf_dir)
    features, _ = segments.feature_columns(prof)
    return segments.feature_frame(prof, features)


@register("q_scaled", O.with_ctes(_FULL + [("features", O.features_sql(_FEATURES))],
                                  O.scaled_sql(_FEATURES)))
def q_scaled(spark, sf_dir):
    """K2: features standardized with mean and sample deviation (fitted scaler),
    rounded to 6 places."""
    prof = feeds.profiles(spark, sf_dir)
    features, _ = segments.feature_columns(prof)
    frame = segments.feature_frame(prof, features)
    model = Pipeline(stages=segments.segmentation_pipeline(features).getStages()[:2]).fit(frame)
    out = segments.scaled_columns(model, frame, features)
    return out.select("customer_id", *[F.round(F.col(f), 6).alias(f) for f in features])


def _segment_tables(spark) -> segment_job.SegmentTables:
    return segment_job.SegmentTables(
        profiles=scratch_path(spark, "lake-profiles"), clusters=scratch_path(spark, "clusters"),
        log=scratch_path(spark, "clusters-log"), history=scratch_path(spark, "clusters-history"),
        model=scratch_path(spark, "segment-model"))


def _clustering(spark, sf_dir) -> segment_job.SegmentTables:
    t = _segment_tables(spark)
    segment_job.run_segmentation_job(spark, feeds.profiles(spark, sf_dir), t, feeds.AS_OF)
    return t


@register("q_clusters", O.with_ctes(_FULL, f"""SELECT customer_id, {O.ts(O.AS_OF)} AS run_date,
  true AS nearest_centroid, true AS labelled_by_spend FROM profiles"""))
def q_clusters(spark, sf_dir):
    """The job's assignment table.  For every customer:
    whether the stored cluster is the one whose centroid is nearest to the customer's
    point (scaled and projected here from the saved model's numbers), and whether the
    labels go by mean spend."""
    t = _clustering(spark, sf_dir)
    model = segments.load_model(spark, t.model)
    scaler, pca, km = (model.pipeline.stages[i] for i in (1, 2, 3))
    profiles = lake.read_table(spark, t.profiles)
    frame = segments.feature_frame(profiles, list(model.features))
    scaled = [(F.col(f) - F.lit(float(m))) / F.lit(float(d)) if d else F.lit(0.0)
              for f, m, d in zip(model.features, scaler.mean.toArray(), scaler.std.toArray())]
    axes = pca.pc.toArray()
    point = [sum((c * F.lit(float(w)) for c, w in zip(scaled, axes[:, j])), F.lit(0.0))
             for j in range(axes.shape[1])]
    distance = [sum(((p - F.lit(float(x))) * (p - F.lit(float(x))) for p, x in zip(point, centre)), F.lit(0.0))
                for centre in km.clusterCenters()]
    own = F.element_at(F.array(*[distance[model.labels.index(c)] for c in range(len(distance))]),
                       F.col("cluster") + 1)
    clusters = lake.read_table(spark, t.clusters)
    means = profiles.join(clusters, "customer_id").groupBy("cluster") \
        .agg(F.avg(F.col("total_spend_usd").cast("double")).alias("m")).orderBy("cluster").collect()
    ordered = all(x.m <= y.m for x, y in zip(means, means[1:]))
    return clusters.join(frame, "customer_id").select(
        "customer_id", "run_date", (own <= F.least(*distance) + 1e-9).alias("nearest_centroid"),
        F.lit(ordered).alias("labelled_by_spend"))


@register("q_cluster_monitor", O.with_ctes(
    _FULL + [("features", O.features_sql(_FEATURES))], O.scaler_sql(_FEATURES)))
def q_cluster_monitor(spark, sf_dir):
    """The scaler parameters that the monitor reads from
    the run log which the job has written, as rows."""
    log = segments.monitor(segment_job.read_log(spark, _clustering(spark, sf_dir)))
    return segments.scaler_entries(log).select(
        "run_date", "feature", F.round("mean", 4).alias("mean"), F.round("deviation", 4).alias("deviation"))


@register("q_cluster_sizes", O.with_ctes(_FULL, "SELECT count(*) AS customers, true AS sizes_agree, "
                                         "true AS variance_falls FROM profiles"))
def q_cluster_sizes(spark, sf_dir):
    """The logged k-means sizes and PCA variances against the stored
    assignment: sizes as counted there, variance falling and at most one in all."""
    t = _clustering(spark, sf_dir)
    metrics = {r.step: r.message for r in segments.monitor(segment_job.read_log(spark, t)).collect()}
    sizes = sorted(int(x) for x in metrics["kmeans_metrics"].split("sizes: ")[1].split(", "))
    variance = [float(x) for x in metrics["pca_params"].split("explained_variance: ")[1].split(", ")]
    falls = variance == sorted(variance, reverse=True) and sum(variance) <= 1.000001
    counts = lake.read_table(spark, t.clusters).groupBy("cluster").count()
    return counts.agg(
        F.sum("count").cast("bigint").alias("customers"),
        (F.sort_array(F.collect_list("count")) == F.array(*[F.lit(x).cast("bigint") for x in sizes]))
        .alias("sizes_agree")).withColumn("variance_falls", F.lit(falls))


@register("q_cluster_profile", O.with_ctes(
    _FULL + [("clusters", O.rule_clusters_sql()),
             ("cprof", O.cluster_profile_sql(PROFILE_FEATURES, O.AS_OF))],
    "SELECT * FROM cprof"))
def q_cluster_profile(spark, sf_dir):
    """Per-cluster means of 20 features and sizes.  A fixed
    assignment rule (key modulo 3) stands in for the model so the profile is
    checkable by SQL."""
    prof = feeds.profiles(spark, sf_dir)
    return segments.cluster_profile(prof, rule_clusters(feeds.stg_customers(spark, sf_dir)),
                                    feeds.AS_OF)


# ---------------------------------------------------------------- reports
# Analysis runs of the cluster history.
RUN_TIMES = ("2024-01-11 00:00:00", "2024-01-21 00:00:00", O.AS_OF)
_HISTORY = O.history_ctes(PROFILE_FEATURES, RUN_TIMES)
_METRICS = [f"avg_{c}" for c in PROFILE_FEATURES] + ["rows_in_cluster"]


def rule_clusters(customers):
    """Fixed stand-in assignment (customer key modulo 3), from the customer
    table alone so the profile chain is not computed a second time."""
    return customers.select("customer_id",
                            (F.col("customer_id").cast("bigint") % 3).cast("int").alias("cluster"))


def cluster_history(spark, sf_dir):
    """Cluster profiles appended at each analysis run to the history table, the last run
    twice (a retry replaces its rows), and read back from it (S19, S20)."""
    table = scratch_path(spark, "cluster-history")
    for t in RUN_TIMES:
        prof = feeds.profiles(spark, sf_dir, as_of=t, cutoff=t)
        clusters = rule_clusters(feeds.stg_customers(spark, sf_dir, as_of=t))
        stats = materialize(segments.cluster_profile(prof, clusters, t), "cluster-stats")  # k rows
        lake.replace_run(spark, stats, table, "analysis_timestamp")
    lake.replace_run(spark, stats, table, "analysis_timestamp")
    return lake.read_table(spark, table)


@register("q_cluster_diffs", O.with_ctes(_HISTORY, O.diffs_sql(_METRICS)))
def q_cluster_diffs(spark, sf_dir):
    """Change of every cluster metric between consecutive runs."""
    return reports.cluster_diffs(cluster_history(spark, sf_dir))


@register("q_cluster_trends", O.with_ctes(
    _HISTORY + [("diffs", O.diffs_sql(_METRICS))] + O.trends_ctes(_METRICS), O.TRENDS_FINAL))
def q_cluster_trends(spark, sf_dir):
    """Long-form trend data (value, change, direction)."""
    return reports.cluster_trends(cluster_history(spark, sf_dir))


@register("q_cluster_insights", O.with_ctes(_HISTORY + [("diffs", O.diffs_sql(_METRICS))],
                                            O.insights_sql()))
def q_cluster_insights(spark, sf_dir):
    """One sentence block per cluster change."""
    return reports.cluster_insights(reports.cluster_diffs(cluster_history(spark, sf_dir)))


# ---------------------------------------------------------------- lake
@register("q_export_reload", O.with_ctes(_FULL, "SELECT * FROM profiles"))
def q_export_reload(spark, sf_dir):
    """Profile mart exported in key order,
    loaded into the lake table, counted, read back."""
    export = scratch_path(spark, "profiles-export")
    lake.export_parquet(feeds.profiles(spark, sf_dir), export, keys=["customer_id"])
    table, n = lake.load_and_count(spark, export, scratch_path(spark, "lake-profiles"))
    if n != spark.read.parquet(export).count():
        raise RuntimeError("lake table row count differs from the export")
    return table


@register("q_lake_preview", O.with_ctes(_FULL, "SELECT * FROM profiles ORDER BY customer_id LIMIT 5"))
def q_lake_preview(spark, sf_dir):
    """A look at the first rows of the lake table (a top-5 report)."""
    table = lake.create_or_replace(spark, feeds.profiles(spark, sf_dir),
                                   scratch_path(spark, "lake-profiles"), ["customer_id"])
    return lake.preview(table, ["customer_id"])


@register("q_stream_ingest_purchases", O.with_ctes(
    [("products", O.PRODUCTS), ("raw_purchases0", O.RAW_PURCHASES0)], f"""
SELECT order_id, user_id, purchase_time, total_amount, product_ids, payment_method,
  shipping_address, order_status, currency
FROM raw_purchases0 WHERE payment_method <> '{feeds.GUEST_PRIORITY}'"""))
def q_stream_ingest_purchases(spark, sf_dir):
    """The purchase JSON feed (with guest checkouts)
    through the stateless streaming ingest; rows with a NULL key go to the
    reject table.  The landed table is read back without its processing-time
    and micro-batch columns."""
    feed = scratch_path(spark, "purchase-ingest-feed")
    feeds.purchase_json(spark, sf_dir, with_guests=True).write.text(feed)
    landed, rejects = scratch_path(spark, "raw-purchases"), scratch_path(spark, "rejects")

    kpi_stream.run_ingest(kpi_stream.read_records(spark, feed), json_feed.parse_landed_purchases,
                          json_feed.split_purchases, landed, rejects,
                          scratch_path(spark, "ingest-ckpt"))
    return spark.read.parquet(landed).drop("_processed_at", "processed_date", "batch_id")


@register("q_stream_ingest_web", O.with_ctes([("raw_web0", O.RAW_WEB0)], """
SELECT user_id, date_trunc('millisecond', event_timestamp) AS event_timestamp, event_type, page_url,
  product_id, session_id, device_type, search_query FROM raw_web0"""))
def q_stream_ingest_web(spark, sf_dir):
    """The web JSON feed through the stateless streaming ingest."""
    feed, landed = scratch_path(spark, "web-ingest-feed"), scratch_path(spark, "raw-web")
    feeds.web_json(spark, sf_dir).write.text(feed)
    kpi_stream.run_ingest(kpi_stream.read_records(spark, feed), json_feed.parse_web_events,
                          json_feed.split_web, landed, scratch_path(spark, "rejects"),
                          scratch_path(spark, "ingest-ckpt"))
    return spark.read.parquet(landed).drop("_processed_at", "processed_date", "batch_id")


@register("q_amount_rejects", O.with_ctes(
    [("products", O.PRODUCTS), ("raw_purchases0", O.RAW_PURCHASES0)], f"""
SELECT order_id, user_id, purchase_time, 'total_amount is unreadable' AS reject_reason
FROM raw_purchases0 WHERE payment_method = '{feeds.GUEST_PRIORITY}'"""))
def q_amount_rejects(spark, sf_dir):
    """Purchases whose amount is beyond the landing type are rejected with a
    reason; none lands with a NULL amount."""
    huge = F.concat(F.lit("1" + "0" * 20), F.col("total_amount").cast("string"))
    records = feeds.purchase_records(spark, sf_dir).withColumn("total_amount", F.when(
        F.col("payment_method") == feeds.GUEST_PRIORITY, huge)
        .otherwise(F.col("total_amount").cast("string")))
    # amounts as JSON numbers
    values = json_feed.to_json_records(records, PURCHASE_EVENT_JSON.fieldNames()).withColumn(
        "value", F.regexp_replace("value", '"total_amount":"([0-9.]+)"', '"total_amount":$1'))
    _, rejects = json_feed.split_purchases(
        json_feed.parse_landed_purchases(values, as_timestamp(feeds.AS_OF)))
    return rejects.select("order_id", "user_id", "purchase_time", "reject_reason")


_BAD_AMOUNTS = f"""SELECT order_id, {{route}} AS route, 'total_amount is unreadable' AS reject_reason
FROM raw_purchases0 WHERE payment_method = '{feeds.GUEST_PRIORITY}'"""


@register("q_amount_rejects_all_routes", O.with_ctes(
    [("products", O.PRODUCTS), ("raw_purchases0", O.RAW_PURCHASES0)],
    " UNION ALL ".join(_BAD_AMOUNTS.format(route=f"'{r}'") for r in ("landing", "kpi", "change feed"))))
def q_amount_rejects_all_routes(spark, sf_dir):
    """Amounts beyond the type (1e19) and with a comma ("12,50") in the
    landing, KPI and change-feed routes; each record is rejected with a reason, none is taken as
    NULL or as another number."""
    def spoil(values):
        bad = F.when(F.get_json_object("value", "$.n").cast("bigint") % 2 == 0, F.lit('"total_amount":1e19')) \
            .otherwise(F.lit('"total_amount":"12,50"'))
        wrong = F.regexp_replace("value", F.lit('"total_amount":[0-9.]+'), bad)
        guest = F.col("value").contains(f'"payment_method":"{feeds.GUEST_PRIORITY}"')
        return values.withColumn("value", F.when(guest, wrong).otherwise(F.col("value"))).select("value")
    order = F.col("order_id").cast("bigint")
    records = feeds.purchase_records(spark, sf_dir).withColumn("n", order)
    values = spoil(json_feed.to_json_records(records, [*PURCHASE_EVENT_JSON.fieldNames(), "n"]))
    _, landed = json_feed.split_purchases(json_feed.parse_landed_purchases(values, as_timestamp(feeds.AS_OF)))
    envelopes = spoil(cdc.purchase_envelopes(
        tables.purchase_events(spark, sf_dir).withColumn("source_seq", order), CDC_SNAPSHOT_BEFORE, "source_seq"))
    changes = cdc.rejected_changes(envelopes).withColumn("order_id", F.get_json_object("value", "$.after.order_id"))
    routes = {"landing": landed, "kpi": kpi_stream.purchase_kpi_rejects(values), "change feed": changes}
    parts = [df.select("order_id", F.lit(r).alias("route"), "reject_reason") for r, df in routes.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# Three deliveries of the web feed: up to the first time, up to the second, and the rest with a
# tenth of the customers' events of the first, which come late.
_DELIVERIES = ("2024-01-10 00:00:00", "2024-01-20 00:00:00")


def _deliveries(spark, sf_dir):
    raw = tables.web_events(spark, sf_dir)
    first, second = (as_timestamp(t) for t in _DELIVERIES)
    t = F.col("event_timestamp")
    number = F.when((F.col("user_id").cast("bigint") % 10 == 0) & (t < first), 2) \
        .when(t < first, 0).when(t < second, 1).otherwise(2)
    return [json_feed.to_json_records(raw.where(number == i), WEB_EVENT_JSON.fieldNames()) for i in range(3)]


@register("q_stream_late_rows", O.with_ctes([("raw_web0", O.RAW_WEB0), ("d", f"""
SELECT date_trunc('millisecond', event_timestamp) AS t,
  CASE WHEN cast(user_id AS bigint) % 10 = 0 AND event_timestamp < {O.ts(_DELIVERIES[0])} THEN 2
    WHEN event_timestamp < {O.ts(_DELIVERIES[0])} THEN 0 WHEN event_timestamp < {O.ts(_DELIVERIES[1])} THEN 1
    ELSE 2 END AS batch_id FROM raw_web0"""), ("m", """
SELECT batch_id, max(max(t)) OVER (ORDER BY batch_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
  - INTERVAL 5 SECOND AS watermark FROM d GROUP BY batch_id""")], """
SELECT cast(d.batch_id AS bigint) AS batch_id, m.watermark, count(*) AS rows,
  count(*) FILTER (WHERE date_trunc('minute', t) + INTERVAL 1 MINUTE <= m.watermark) AS late_rows
FROM d JOIN m USING (batch_id) GROUP BY d.batch_id, m.watermark"""))
def q_stream_late_rows(spark, sf_dir):
    """Three deliveries of the web feed through the raw ingest, one micro-batch each;
    how many rows of each the live KPIs leave out as late, while the landed table keeps them."""
    feed, landed = scratch_path(spark, "late-feed"), scratch_path(spark, "late-landed")
    rejects, ckpt = scratch_path(spark, "late-rejects"), scratch_path(spark, "late-ckpt")
    for part in _deliveries(spark, sf_dir):
        part.write.mode("append").text(feed)
        kpi_stream.run_ingest(kpi_stream.read_records(spark, feed), json_feed.parse_web_events,
                              json_feed.split_web, landed, rejects, ckpt)
    rows = spark.read.parquet(landed).withColumn("batch_id", F.col("batch_id").cast("bigint"))
    return kpi_stream.late_rows(rows, "event_timestamp")


@register("q_stream_kpi_windows", O.with_ctes(
    [("raw_web0", O.RAW_WEB0),
     ("ev", "SELECT date_trunc('millisecond', event_timestamp) AS t, user_id, page_url, "
            "product_id FROM raw_web0")],
    O.web_kpi_sql("ev", "t", closed_only=True)))
def q_stream_kpi_windows(spark, sf_dir):
    """The live KPI job into the sink with one row for each window, then again from
    the start with a new checkpoint: no window is there twice."""
    feed, sink = scratch_path(spark, "web-feed"), scratch_path(spark, "kpi-windows")
    feeds.web_json(spark, sf_dir).write.text(feed)
    for _ in range(2):
        rows = kpi_stream.web_kpi_stream(kpi_stream.read_records(spark, feed))
        kpi_stream.run_to_windows(rows, sink, scratch_path(spark, "kpi-windows-ckpt"))
    return kpi_stream.read_windows(spark, sink, rows.schema)


@register("q_stream_cdc_web", O.ORACLE_CDC_WEB)
def q_stream_cdc_web(spark, sf_dir):
    """Web change envelopes consumed as a stream (file
    source, availableNow) and flattened into the warehouse copy."""
    feed = scratch_path(spark, "web-cdc-feed")
    raw = tables.web_events(spark, sf_dir, with_source_seq=True)
    cdc.web_envelopes(raw, CDC_SNAPSHOT_BEFORE, "source_seq").write.text(feed)
    sink = scratch_path(spark, "web-warehouse-copy")
    kpi_stream.run_to_files(cdc.flatten_web_changes(kpi_stream.read_records(spark, feed)),
                            sink, scratch_path(spark, "web-cdc-ckpt"))
    return spark.read.parquet(sink)


@register("q_latest_monthly_snapshot",
          O.with_ctes(_FULL + [("summary", O.monthly_summary_sql())], "SELECT * FROM summary"))
def q_latest_monthly_snapshot(spark, sf_dir):
    """The monthly report read: newest of two appended snapshots."""
    early = marts.monthly_summary(
        feeds.profiles(spark, sf_dir, as_of=EARLIER_SNAPSHOT, cutoff=EARLIER_SNAPSHOT),
        EARLIER_SNAPSHOT)
    late = marts.monthly_summary(feeds.profiles(spark, sf_dir), feeds.AS_OF)
    return marts.latest_snapshot(marts.append_snapshot(marts.append_snapshot(None, early), late))
