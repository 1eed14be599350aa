
import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from funnelspark.operators import incremental as inc
from funnelspark.plans import feeds, model_runs
from funnelspark.sources import tables

from .conftest import SF_SMALL

AS_OF = feeds.AS_OF


def _rows(df, key):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: str(r[df.columns.index(key)]))


def _store(spark):
    return model_runs.Store(spark)


def test_first_run_on_empty_target_loads_everything(spark):
    raw = feeds.raw_web(spark, SF_SMALL)
    table, touched, mark = model_runs.stage_increment(None, raw, AS_OF, kind="web", store=_store(spark))
    rows = table.read()
    assert rows.count() == raw.select("user_id", "event_timestamp").distinct().count()
    assert touched.count() == rows.select("customer_id").distinct().count()
    assert mark == inc.high_water_mark(rows, "stream_processed_at_utc")
    assert inc.high_water_mark(rows.limit(0), "stream_processed_at_utc") == "1970-01-01 00:00:00"


def test_upsert_replaces_keys_and_keeps_the_rest(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    batch = spark.createDataFrame([(2, "B"), (3, "C")], "k int, v string")
    assert sorted(inc.upsert(target, batch, ["k"]).collect()) == [(1, "a"), (2, "B"), (3, "C")]
    gone = spark.createDataFrame([(1,)], "k int")
    assert sorted(inc.upsert(target, batch, ["k"], delete_keys=gone).collect()) == [
        (2, "B"), (3, "C")]


def test_new_batch_for_known_customer_history_vs_replace(spark):
    raw = spark.createDataFrame([
        ("u1", dt.datetime(2024, 1, 1, 9), "page_view", "/a", None, "s", "m", None,
         dt.datetime(2024, 1, 1, 9)),
        ("u1", dt.datetime(2024, 1, 2, 9), "page_view", "/b", None, "s", "m", None,
         dt.datetime(2024, 1, 2, 9)),
        ("u1", dt.datetime(2024, 1, 20, 9), "search", None, None, "s", "m", "q",
         dt.datetime(2024, 1, 20, 9)),
    ], "user_id string, event_timestamp timestamp, event_type string, page_url string, "
       "product_id string, session_id string, device_type string, search_query string, "
       "_processed_at timestamp")
    first = feeds.processed_until(raw, "2024-01-10 00:00:00")
    store = _store(spark)
    one = model_runs.kind_increment(None, first, AS_OF, kind="web", store=store)
    whole = store.save(model_runs.replace_batch(None, one.stg.read(), AS_OF, kind="web"), "whole")
    two = model_runs.kind_increment(one, raw, AS_OF, kind="web", store=store)
    kept = model_runs.web_of_run(two, AS_OF).collect()
    replaced = model_runs.replace_batch(whole, two.stg.read(), AS_OF, kind="web").collect()
    assert kept[0]["total_web_events"] == 3 and kept[0]["unique_pages_visited"] == 2
    assert replaced[0]["total_web_events"] == 1 and replaced[0]["total_searches"] == 1


PURCHASES = ("order_id string, user_id string, purchase_time timestamp, total_amount decimal(20,2), "
             "product_ids string, payment_method string, shipping_address string, order_status string, "
             "currency string, _processed_at timestamp")


def _order(order, user, day, status, landed, amount="10.00"):
    from decimal import Decimal
    return (order, user, dt.datetime(2024, 1, day), Decimal(amount), "[a]", "card", "x", status, "USD",
            dt.datetime(2024, 1, landed))


def test_an_older_resend_does_not_replace_a_newer_row(spark):
    early = spark.createDataFrame([_order("o1", "u", 2, "completed", 3)], PURCHASES)
    late = early.unionByName(spark.createDataFrame([_order("o1", "u", 1, "processing", 5)], PURCHASES))
    got = {}
    for replace_only in (False, True):
        store = _store(spark)
        s1, _, mark = model_runs.stage_increment(None, early, AS_OF, kind="purchases", store=store)
        s2, _, _ = model_runs.stage_increment(s1, late, AS_OF, kind="purchases", store=store, mark=mark,
                                              replace_only=replace_only)
        got[replace_only] = [r.order_status for r in s2.read().collect()]
    assert got == {False: ["completed"], True: ["processing"]}


def test_only_the_parts_of_the_batch_are_read_and_written(spark):
    rows = [_order(f"o{m}", "u", 1, "completed", 2) for m in range(3)]
    rows = [(r[0], r[1], dt.datetime(2023, 1 + i, 5), *r[3:]) for i, r in enumerate(rows)]
    early = spark.createDataFrame(rows, PURCHASES)
    store = _store(spark)
    s1, _, mark = model_runs.stage_increment(None, early, AS_OF, kind="purchases", store=store)
    batch = spark.createDataFrame([("o1", "u", dt.datetime(2023, 2, 6), *_order("o1", "u", 1, "shipped", 9)[3:])],
                                  PURCHASES)
    s2, _, _ = model_runs.stage_increment(s1, early.unionByName(batch), AS_OF, kind="purchases", store=store,
                                          mark=mark)
    assert sorted(s1.parts) == sorted(s2.parts) == ["2023-01", "2023-02", "2023-03"]
    assert {p for p in s1.parts if s1.parts[p] != s2.parts[p]} == {"2023-02"}
    files = s1.read({"2023-02"}).inputFiles()
    assert files and all("_part=2023-02" in f for f in files)
    assert sorted((r.order_id, r.order_status) for r in s2.read().collect()) == [
        ("o0", "completed"), ("o1", "shipped"), ("o2", "completed")]


def test_a_hot_customer_is_aggregated_in_many_tasks_first(spark):
    rows = spark.range(2000).selectExpr("if(id < 2000, 'hot', string(id)) as customer_id",
                                        "string(id) as event_id")
    touched = spark.createDataFrame([("hot",), (None,)], "customer_id string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        some = inc.restrict_to(rows, touched, "event_id")
        tasks = some.select(F.spark_partition_id().alias("p")).distinct().count()
        plan = some.groupBy("customer_id").count()._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert tasks > 3
    # the customer's rows meet only after the partial aggregate: exchange above the join
    assert plan.index("Exchange hashpartitioning(customer_id") < plan.index("partial_count") < plan.index("Join")


def test_customers_without_an_id_stay_a_group(spark):
    raw = spark.createDataFrame([_order("o1", None, 2, "completed", 3)], PURCHASES)
    more = raw.unionByName(spark.createDataFrame([_order("o2", None, 4, "completed", 5)], PURCHASES))
    store = _store(spark)
    one = model_runs.kind_increment(None, raw, AS_OF, kind="purchases", store=store)
    two = model_runs.kind_increment(one, more, AS_OF, kind="purchases", store=store)
    out = model_runs.purchases_of_run(two, AS_OF)
    assert [(r.customer_id, r.total_orders, r.orders_last_30_days) for r in out.collect()] == [(None, 2, 2)]


SPLITS = st.lists(st.integers(min_value=2, max_value=29), min_size=1, max_size=2, unique=True)


@settings(max_examples=2, deadline=None, suppress_health_check=list(HealthCheck))
@given(days=SPLITS)
def test_incremental_runs_equal_full_run(spark, days):
    """Every run at its own time, with a growing and changing profile file."""
    raw_w, raw_p = feeds.raw_web(spark, SF_SMALL), feeds.raw_purchases(spark, SF_SMALL)
    prof = tables.customer_profiles(spark, SF_SMALL)
    models = None
    for day in sorted(days):
        cut = f"2024-01-{day:02d} 12:00:00"
        early = prof.where(F.col("user_id").cast("int") % 9 != 0).withColumn("country", F.lit("moved"))
        models = model_runs.run_models(models, feeds.processed_until(raw_w, cut),
                                       feeds.processed_until(raw_p, cut), early, cut)
    models = model_runs.run_models(models, raw_w, raw_p, prof, AS_OF)
    full = feeds.profiles(spark, SF_SMALL)
    assert _rows(models.profiles, "customer_id") == _rows(full.select(*models.profiles.columns),
                                                         "customer_id")
    fun = feeds.funnel(spark, SF_SMALL)
    assert _rows(models.funnel, "customer_id") == _rows(fun.select(*models.funnel.columns), "customer_id")
    assert models.country_history.select("mart_loaded_at").distinct().count() == len(days) + 1


def test_reference_mode_leaves_customers_without_new_activity(spark):
    """A customer without activity past the mark keeps the row of the earlier run."""
    raw_w, raw_p = feeds.raw_web(spark, SF_SMALL), feeds.raw_purchases(spark, SF_SMALL)
    prof = tables.customer_profiles(spark, SF_SMALL)
    cut = "2024-01-16 00:00:00"
    first = model_runs.run_models(None, feeds.processed_until(raw_w, cut),
                                  feeds.processed_until(raw_p, cut), prof, cut, mode="replace_batch")
    second = model_runs.run_models(first, raw_w, raw_p, prof, AS_OF, mode="replace_batch")
    before = {r.customer_id: r for r in first.profiles.collect()}
    after = {r.customer_id: r for r in second.profiles.collect()}
    assert before.keys() == after.keys()
    kept = [c for c in after if after[c] == before[c]]
    assert kept and len(kept) < len(after)
    assert all(after[c].processed_at == dt.datetime(2024, 1, 16) for c in kept)
    assert all(after[c].processed_at == AS_OF for c in after if c not in kept)
