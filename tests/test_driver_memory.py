"""What grows with a batch or with all customers isn't broadcast.  The planner compares the files'
compressed size with its threshold (the default one here), so these tables would be small to it."""

import pytest
from pyspark.sql import functions as F

from funnelspark.operators import incremental as inc
from funnelspark.plans import key_index, model_runs
from funnelspark.plans.keyed_table import KeyedTable

from .test_batch_cost import PURCHASES, WEB, event, order


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def saved(spark, tmp_dir):
    def save(df, name):
        df.write.parquet(f"{tmp_dir}/{name}")
        return spark.read.parquet(f"{tmp_dir}/{name}")
    return save


def test_touched_customers_are_not_broadcast_sixteen_times(spark, saved):
    rows = saved(spark.range(300).selectExpr("if(id % 50 = 0, null, string(id % 100)) as customer_id",
                                             "string(id) as event_id"), "rows")
    touched = saved(spark.range(40).selectExpr("if(id = 7, null, string(id)) as customer_id"), "touched")
    some = inc.restrict_to(rows, touched, "event_id")
    assert "Broadcast" not in plan(some)
    held = {str(i) for i in range(40)} - {"7"} | {None}
    assert sorted(r.event_id for r in some.collect()) == sorted(
        r.event_id for r in rows.collect() if r.customer_id in held)


def test_a_batch_s_keys_are_not_broadcast(spark, saved):
    stored = saved(spark.range(100).selectExpr("if(id = 3, null, string(id)) as k", "'old' as v"), "stored")
    batch = saved(spark.range(90, 120).selectExpr("if(id = 99, null, string(id)) as k", "'new' as v"), "batch")
    replaced, merged = inc.replaced_rows(stored, batch, ["k"]), inc.upsert(stored, batch, ["k"])
    assert "Broadcast" not in plan(replaced) and "Broadcast" not in plan(merged)
    gone = {str(i) for i in range(90, 99)} | {None}
    assert {r.k for r in replaced.collect()} == gone and replaced.count() == 10
    assert merged.where("v = 'old'").count() == 90 and merged.where("v = 'new'").count() == 30


def test_levels_are_not_broadcast(spark):
    store = model_runs.Store(spark)
    wide = spark.range(500).select(F.col("id").cast("string").alias("k"), F.col("id").alias("v"))
    table = KeyedTable.new(wide, ("k",), 4).apply(store, "t", wide)
    table = table.apply(store, "t", wide.where("v < 20").withColumn("v", -F.col("v")))
    asked = table.look_up(wide.where("v > 7").select("k"), ["v"])
    assert len(table.levels) == 2 and "Broadcast" not in plan(table.keyed()) and "Broadcast" not in plan(asked)
    assert asked.where("old_v < 0").count() == 12 and asked.count() == 492


def test_keys_asked_of_the_filters_are_not_broadcast(spark, tmp_dir, monkeypatch):
    rows = spark.range(400).selectExpr("string(id) as k", "if(id < 200, 'a', 'b') as p")
    filters = key_index.build(rows, "k", "p", f"{tmp_dir}/index")
    keys = spark.createDataFrame([("205",), ("390",), (None,)], "k string")
    plans, collect = [], type(rows).collect
    monkeypatch.setattr(type(rows), "collect", lambda df: plans.append(plan(df)) or collect(df))
    assert key_index.answering(spark, filters, keys, "k") == {"b"}
    assert "SortMergeJoin" in plans[-1] and "Broadcast" not in plans[-1]


def test_the_chain_broadcasts_no_customers_of_the_trailing_days(spark):
    web = [event(f"c{i}", f"2024-01-{1 + i % 9:02d} 09:00:00", page=f"/{i}") for i in range(30)]
    buy = [order(f"o{i}", f"c{i}", f"2024-01-{1 + i % 9:02d} 09:00:00", "2024-01-10") for i in range(30)]
    frame = lambda x, schema: spark.createDataFrame(x, schema)
    store = model_runs.Store(spark, buckets=2)
    web_run = model_runs.kind_increment(None, frame(web, WEB), "2024-01-12", kind="web", store=store)
    orders = model_runs.kind_increment(None, frame(buy, PURCHASES), "2024-01-12", kind="purchases", store=store)
    mart = model_runs.purchases_of_run(orders, "2024-01-12")
    assert "Broadcast" not in plan(mart)
    assert {r.orders_last_30_days for r in mart.collect()} == {1} and mart.count() == 30
    assert "Broadcast" not in plan(model_runs.web_of_run(web_run, "2024-01-12"))
