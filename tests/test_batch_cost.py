"""The cost of an incremental run follows its batch: states by day, key filters, keyed tables
of changed rows, marts derived when they are read."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from funnelspark.operators import activity
from funnelspark.plans import feeds, key_index, model_runs, warehouse
from funnelspark.plans.keyed_table import GONE, KeyedTable, key_of
from funnelspark.session import list_names

from .conftest import SF_SMALL

AS_OF = feeds.AS_OF
WEB = ("user_id string, event_timestamp timestamp, event_type string, page_url string, product_id string, "
       "session_id string, device_type string, search_query string, _processed_at timestamp")
PURCHASES = ("order_id string, user_id string, purchase_time timestamp, total_amount decimal(20,2), "
             "product_ids string, payment_method string, shipping_address string, order_status string, "
             "currency string, _processed_at timestamp")


def event(user, when, kind="page_view", page="/a", landed=None, session="s"):
    when = dt.datetime.fromisoformat(when)
    return (user, when, kind, page, None, session, "m", None, dt.datetime.fromisoformat(landed) if landed else when)


def order(number, user, when, landed, amount="10.00", status="completed", products="[a, b]"):
    return (number, user, dt.datetime.fromisoformat(when), amount and Decimal(amount), products, "card", "x",
            status, "USD", dt.datetime.fromisoformat(landed))


class Opened:
    """Records which parts of which tables are read."""

    def __init__(self, monkeypatch):
        self.parts: list[tuple[str, set[str]]] = []
        read = model_runs.PartTable.read

        def recorded(table, parts=None):
            asked = set(table.parts) & (set(table.parts) if parts is None else set(parts))
            column = "states" if "`day`" in table.schema else "staging"
            self.parts.append((column, asked))
            return read(table, parts)
        monkeypatch.setattr(model_runs.PartTable, "read", recorded)

    def of(self, kind):
        return set().union(*[parts for k, parts in self.parts if k == kind])


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


# ----------------------------------------------------------------- states by day
def test_a_web_run_reads_only_the_days_of_its_batch(spark, monkeypatch):
    early = [event("u", f"2024-01-{d:02d} 09:00:00", page=f"/{d % 3}") for d in range(1, 11)] + \
        [event("v", "2024-01-02 10:00:00")]
    late = [event("u", "2024-01-09 10:00:00", "search", None, "2024-01-20 00:00:00"),
            event("u", "2024-01-09 09:00:00", "search", None, "2024-01-20 00:00:00"),   # replaces one
            event("w", "2024-01-20 10:00:00", page="/new")]
    first, both = spark.createDataFrame(early, WEB), spark.createDataFrame(early + late, WEB)
    store = model_runs.Store(spark, buckets=4)
    one = model_runs.kind_increment(None, first, AS_OF, kind="web", store=store)
    opened = Opened(monkeypatch)
    two = model_runs.kind_increment(one, both, AS_OF, kind="web", store=store)
    assert opened.of("staging") == opened.of("states") == {"2024-01-09", "2024-01-20"}
    want = activity.web_activity(two.stg.read(), AS_OF)
    got = model_runs.web_of_run(two, AS_OF)
    assert rows(got) == rows(want.select(*got.columns))
    assert {r.customer_id: r.unique_pages_visited for r in got.collect()} == {"u": 3, "v": 1, "w": 1}
    assert sum(n for _, n in two.totals.levels) <= 4


def test_a_page_that_is_replaced_everywhere_is_no_longer_counted(spark):
    early = [event("u", "2024-01-01 09:00:00", page="/a"), event("u", "2024-01-02 09:00:00", page="/a"),
             event("u", "2024-01-02 10:00:00", page="/b")]
    changed = [event("u", "2024-01-01 09:00:00", page="/b", landed="2024-01-05 00:00:00"),
               event("u", "2024-01-02 09:00:00", "search", None, "2024-01-05 00:00:00")]
    store = model_runs.Store(spark, buckets=2)
    one = model_runs.kind_increment(None, spark.createDataFrame(early, WEB), AS_OF, kind="web", store=store)
    assert model_runs.web_of_run(one, AS_OF).first().unique_pages_visited == 2
    two = model_runs.kind_increment(one, spark.createDataFrame(early + changed, WEB), AS_OF, kind="web",
                                    store=store)
    got = model_runs.web_of_run(two, AS_OF)
    assert rows(got) == rows(activity.web_activity(two.stg.read(), AS_OF).select(*got.columns))
    assert got.first().unique_pages_visited == 1
    assert [r.page_url for r in two.pages.read().collect()] == ["/b"]


def test_orders_that_move_change_first_times_customers_and_amounts(spark):
    """An order sent again with another time, customer or amount; a customer left without any."""
    early = [order("o1", "u", "2023-11-05 01:00:00", "2023-11-05"), order("o2", "u", "2023-12-07 01:00:00", "2023-12-07", None),
             order("o3", "v", "2023-12-08 01:00:00", "2023-12-08", products=None),
             order("o4", None, "2023-12-09 01:00:00", "2023-12-09"), order("o5", "w", "2024-01-02 12:30:00", "2024-01-02")]
    late = [order("o1", "u", "2024-01-20 01:00:00", "2024-01-21", "7.77", "returned"),
            order("o3", "w", "2023-12-20 01:00:00", "2024-01-21", "0.01"),
            order("o6", "w", "2024-01-02 11:00:00", "2024-01-21")]
    store = model_runs.Store(spark, buckets=2)
    one = model_runs.kind_increment(None, spark.createDataFrame(early, PURCHASES), AS_OF, kind="purchases",
                                    store=store)
    two = model_runs.kind_increment(one, spark.createDataFrame(early + late, PURCHASES), AS_OF,
                                    kind="purchases", store=store)
    for as_of in (AS_OF, "2024-02-01 12:00:00", "2024-01-31 00:00:01", "2024-06-01 00:00:00"):
        got = model_runs.purchases_of_run(two, as_of)
        want = activity.purchase_activity(two.stg.read(), as_of)
        assert rows(got) == rows(want.select(*got.columns)), as_of
    assert {r.customer_id for r in got.collect()} == {"u", "w", None}
    first = {r.customer_id: r.first_purchase_timestamp for r in got.collect()}
    assert first["u"] == dt.datetime(2023, 12, 7, 1)


def test_averages_equal_the_engines(spark):
    rng = random.Random(3)
    orders = [order(f"o{i}", f"c{rng.randrange(40)}", "2024-01-05 00:00:00", "2024-01-05",
                    f"{rng.choice([-1, 1]) * rng.randrange(10**rng.randrange(1, 9)) / 100:.2f}") for i in range(900)]
    run = model_runs.kind_increment(None, spark.createDataFrame(orders, PURCHASES), AS_OF, kind="purchases",
                                    store=model_runs.Store(spark, buckets=2))
    got = model_runs.purchases_of_run(run, AS_OF)
    assert rows(got) == rows(activity.purchase_activity(run.stg.read(), AS_OF).select(*got.columns))


# ----------------------------------------------------------------- key filters
def test_only_parts_whose_filter_answers_are_opened(spark, monkeypatch):
    early = [order(f"{m:02d}-{i}", f"u{i % 9}", f"2023-{m:02d}-05 00:00:00", f"2023-{m:02d}-06")
             for m in range(1, 13) for i in range(60)]
    late = [order("03-7", "u1", "2024-01-15 00:00:00", "2024-01-16", status="shipped"),
            order("99-new", "u1", "2024-01-15 00:00:00", "2024-01-16"),
            order("00-new", "u1", "2024-01-15 00:00:00", "2024-01-16")]
    store = model_runs.Store(spark, buckets=2)
    one, _, mark = model_runs.stage_increment(None, spark.createDataFrame(early, PURCHASES), AS_OF,
                                              kind="purchases", store=store)
    assert set(one.index) == set(one.parts) and len(one.parts) == 12
    opened = Opened(monkeypatch)
    two, touched, _ = model_runs.stage_increment(one, spark.createDataFrame(early + late, PURCHASES), AS_OF,
                                                 kind="purchases", store=store, mark=mark)
    assert opened.of("staging") == {"2023-03", "2024-01"}   # the resent order's, and the new part
    assert {p for p in two.parts if two.parts[p] != one.parts.get(p)} == {"2023-03", "2024-01"}
    got = {r.order_id: r.order_status for r in two.read().collect()}
    assert len(got) == 722 and got["03-7"] == "shipped"
    assert two.index["2023-05"] == one.index["2023-05"] and two.index["2023-03"] != one.index["2023-03"]


def test_filters_answer_to_all_their_keys_and_few_others(spark, tmp_dir):
    held = spark.range(30_000).select(F.concat(F.lit("k"), "id").alias("k"), (F.col("id") % 2).cast("string").alias("p"))
    filters = key_index.build(held, "k", "p", f"{tmp_dir}/filters")
    assert {p: f.buckets for p, f in filters.items()} == {"0": 4, "1": 4}
    only = {"0": filters["0"]}
    ask = lambda ids: key_index.answering(spark, only, ids, "k")
    assert ask(held.where("p = '0'").limit(5)) == {"0"}
    assert all(ask(held.where(F.col("k") == f"k{i}")) == {"0"} for i in (0, 2, 15_000, 29_998))
    assert sum(bool(ask(held.where(F.col("k") == f"k{i}"))) for i in (1, 3, 15_001, 29_999)) == 0
    assert ask(spark.createDataFrame([("a",), (None,)], "k string")) == set()      # outside the range
    assert key_index.answering(spark, filters, held.limit(0), "k") == set()


def test_an_order_without_an_id_is_found(spark):
    early = [order(None, "u", "2023-11-05 01:00:00", "2023-11-05"), order("o2", "u", "2023-12-05 01:00:00", "2023-12-05")]
    late = [order(None, "u", "2024-01-05 01:00:00", "2024-01-06", status="shipped")]
    store = model_runs.Store(spark)
    one, _, mark = model_runs.stage_increment(None, spark.createDataFrame(early, PURCHASES), AS_OF,
                                              kind="purchases", store=store)
    two, _, _ = model_runs.stage_increment(one, spark.createDataFrame(early + late, PURCHASES), AS_OF,
                                           kind="purchases", store=store, mark=mark)
    assert sorted((str(r.order_id), r.order_status) for r in two.read().collect()) == [
        ("None", "shipped"), ("o2", "completed")]


# ----------------------------------------------------------------- keyed tables
def test_keyed_table_equals_a_dictionary(spark):
    rng, want = random.Random(9), {}
    store = model_runs.Store(spark)
    table = KeyedTable.new(spark.createDataFrame([], "a string, b int, v int"), ("a", "b"), 3)
    keys = [(a, b) for a in ("x", "1:x", "", None) for b in (None, 0, 11)]
    written = []
    for step in range(12):
        some = rng.sample(keys, rng.choice([0, 1, 2, 7]))
        batch = [(a, b, rng.randrange(99), rng.random() < 0.3) for a, b in some]
        for a, b, v, gone in batch:
            want.pop((a, b), None)
            if not gone:
                want[a, b] = v
        table = table.apply(store, "t", spark.createDataFrame(batch, f"a string, b int, v int, {GONE} boolean"),
                            F.col(GONE))
        written.append(table.paths)
        assert {(r.a, r.b): r.v for r in table.read().collect()} == want
        sizes = [n for _, n in table.levels]
        assert all(2 * y < x for x, y in zip(sizes, sizes[1:]))
    held = KeyedTable.from_manifest(spark, table.manifest())
    found = held.look_up(spark.createDataFrame([("x", 0), ("x", 5)], "a string, b int"), ["v"]).collect()
    assert {(r.a, r.b): r.old_v for r in found} == {("x", 0): want.get(("x", 0)), ("x", 5): None}
    assert len(set(map(tuple, written))) > 4


def test_keys_of_several_columns_are_not_mixed_up(spark):
    pairs = [("a", "b"), ("a:", "b"), ("", "ab"), (None, "ab"), ("-", "x"), (None, "1:x"), ("1", ":a"), ("1:a", None)]
    keys = spark.createDataFrame(pairs, "x string, y string").select(key_of(["x", "y"])).distinct()
    assert keys.count() == len(pairs)


def test_levels_are_merged_and_looked_up_without_an_exchange_of_the_table(spark):
    store = model_runs.Store(spark)
    wide = spark.range(500).select(F.col("id").cast("string").alias("k"), F.col("id").alias("v"))
    table = KeyedTable.new(wide, ("k",), 4).apply(store, "t", wide)
    table = table.apply(store, "t", wide.where("v < 20").withColumn("v", -F.col("v")))
    assert [n for _, n in table.levels] == [500, 20]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = table.keyed()._jdf.queryExecution().executedPlan().toString()
        one = KeyedTable(spark, table.key, table.schema, 4, table.levels[:1])
        asked = one.look_up(wide.where("v > 7").select("k"), ["v"])
        looked_up = asked._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in merged and "Exchange" not in merged and merged.count("Bucketed: true") >= 2
    join = looked_up[looked_up.index("SortMergeJoin"):]
    assert join.count("Exchange") == 1 and "Bucketed: true" in join      # the rows that ask
    assert table.read().where("v < 0").count() == 19 and asked.count() == 492
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("level_")]


# ----------------------------------------------------------------- marts as views
def _written(spark, base):
    """Rows of the Parquet tables that a run wrote, key filters apart."""
    from funnelspark.session import list_names
    return {n: spark.read.schema("_any int").parquet(f"{base}/{n}").count() for n in list_names(spark, base)
            if not n.startswith("key-index")}


@pytest.mark.parametrize("customers", [40, 400])
def test_a_run_with_one_touched_customer_writes_few_rows(spark, customers):
    people = [(f"c{i}", dt.date(2023, 1, 1 + i % 28), "Free", "ads", f"{i}@x", "DE") for i in range(customers)]
    profile = spark.createDataFrame(people, "user_id string, registration_date date, subscription_tier string, "
                                            "acquisition_channel string, email string, country string")
    web = [event(f"c{i}", f"2024-01-{1 + i % 9:02d} 09:00:00", page=f"/{i}") for i in range(customers)]
    buy = [order(f"o{i}", f"c{i}", f"2024-01-{1 + i % 9:02d} 09:00:00", "2024-01-10") for i in range(customers)]
    more_web, more_buy = [event("c7", "2024-01-15 10:00:00", page="/x")], [order("n", "c7", "2024-02-15 10:00:00", "2024-02-16")]
    frame = lambda x, schema: spark.createDataFrame(x, schema)
    first = model_runs.run_models(None, frame(web, WEB), frame(buy, PURCHASES), profile, "2024-01-12",
                                  store=model_runs.Store(spark, buckets=4))
    store = model_runs.Store(spark, buckets=4)
    second = model_runs.run_models(first, frame(web + more_web, WEB), frame(buy + more_buy, PURCHASES), profile,
                                   "2024-02-20", store=store)
    written = _written(spark, store.base)
    summaries = sum(n for name, n in written.items() if "snapshot" in name)
    assert sum(written.values()) - summaries <= 20 and summaries <= 40, written
    got = {r.customer_id: r for r in second.profiles.collect()}
    assert len(got) == customers
    assert got["c7"].total_web_events == 2 and got["c7"].days_since_last_purchase == 5
    assert got["c8"].days_since_last_web_activity == 42 and got["c8"].processed_at == dt.datetime(2024, 2, 20)


def test_profiles_that_change_leave_or_join(spark):
    schema = ("user_id string, registration_date date, subscription_tier string, acquisition_channel string, "
              "email string, country string")
    day = dt.date(2023, 1, 1)
    store = model_runs.Store(spark, buckets=2)
    one = [(f"c{i}", day, "Free", "ads", None, "DE") for i in range(20)] + [(None, day, "Free", "ads", "n", "DE")]
    table = model_runs.customers_increment(None, spark.createDataFrame(one, schema), AS_OF, store)
    two = one[2:] + [("c0", day, "BASIC", "ads", None, "DE"), ("new", day, "Free", None, None, None), one[5]]
    table = model_runs.customers_increment(table, spark.createDataFrame(two, schema), AS_OF, store)
    assert [n for _, n in table.levels] == [21, 3]          # c0 changed, c1 gone, one new
    got = {r.customer_id: r.customer_subscription_tier for r in table.read().collect()}
    assert len(got) == 21 and got["c0"] == "basic" and "c1" not in got and None in got
    again = model_runs.customers_increment(table, spark.createDataFrame(two, schema), AS_OF, store)
    assert again.levels == table.levels


def test_marts_are_read_at_the_time_of_the_committed_run(spark, tmp_dir):
    from funnelspark.plans import jobs
    from funnelspark.sources import tables
    paths = [f"{tmp_dir}/{n}" for n in ("web", "purchases", "profiles")]
    feeds.raw_web(spark, SF_SMALL).write.parquet(paths[0])
    feeds.raw_purchases(spark, SF_SMALL).write.parquet(paths[1])
    tables.customer_profiles(spark, SF_SMALL).write.parquet(paths[2])
    root = f"{tmp_dir}/wh"
    for as_of in (AS_OF, "2024-02-10 00:00:00"):   # the second run has an empty batch
        jobs.batch_job(spark, *paths, root, as_of)
        got = warehouse.load_models(spark, root).profiles
        want = feeds.profiles(spark, SF_SMALL, as_of=as_of)
        assert rows(got) == rows(want.select(*got.columns))


# ----------------------------------------------------------------- work done once
def test_a_feed_of_several_runs_is_made_once(spark):
    """The second run reads the landed orders; it doesn't join them with their lines again."""
    landed, made = feeds.raw_purchases(spark, SF_SMALL, landed=True), feeds.raw_purchases(spark, SF_SMALL)
    plan = landed._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Aggregate" not in plan
    assert landed.schema.simpleString() == made.schema.simpleString() and rows(landed) == rows(made)
    web, parsed = feeds.raw_web(spark, SF_SMALL, landed=True), feeds.raw_web(spark, SF_SMALL)
    assert "get_json_object" not in web._jdf.queryExecution().optimizedPlan().toString()
    assert web.schema.simpleString() == parsed.schema.simpleString() and rows(web) == rows(parsed)


def test_parts_are_written_from_one_computation(spark):
    """No sample is taken of what is saved, and a first run doesn't store its batch apart."""
    computed = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            computed.add(batch.num_rows)
            yield batch
    store = model_runs.Store(spark, buckets=2)
    df = spark.range(500).select(F.concat(F.lit("k"), F.col("id") % 40).alias("k"), "id")
    parts = store.save_parts(df.mapInArrow(counted, df.schema), F.col("k"), ("id",), "counted")
    assert computed.value == 500 and len(parts) == 40
    assert rows(spark.read.parquet(*parts.values()).select("id")) == rows(df.select("id"))
    held = [r.id for r in spark.read.parquet(parts["k7"]).collect()]
    assert held == sorted(held)
    first = spark.createDataFrame([event("u", "2024-01-01 09:00:00"), event("u", "2024-01-01 09:00:00")], WEB)
    table, touched, mark = model_runs.stage_increment(None, first, AS_OF, kind="web", store=store)
    assert not store.paths and table.read().count() == 1
    assert rows(touched) == [("u",)] and mark.startswith("2024-01-01 09:00:00")


def test_a_parts_filter_is_one_file(spark, tmp_dir):
    held = spark.range(60_000).select(F.concat(F.lit("k"), "id").alias("k"), (F.col("id") % 3).cast("string").alias("p"))
    for p, f in key_index.build(held, "k", "p", f"{tmp_dir}/filters").items():
        assert len([n for n in list_names(spark, f.path) if n.endswith(".parquet")]) == 1
        stored = spark.read.parquet(f.path)
        assert stored.count() == f.buckets == 8
        assert stored.where(F.size("bits") != key_index.WORDS).count() == 0


def test_the_references_run_stages_both_feeds_at_once(spark, monkeypatch):
    steps, at_once = [], model_runs.at_once
    monkeypatch.setattr(model_runs, "at_once", lambda *s: steps.append(len(s)) or at_once(*s))
    web = spark.createDataFrame([event("u", "2024-01-01 09:00:00")], WEB)
    orders = spark.createDataFrame([order("o", "u", "2024-01-01 09:00:00", "2024-01-01")], PURCHASES)
    people = spark.createDataFrame([("u", dt.date(2023, 1, 1), "Free", "ads", "u@x", "DE")],
                                   "user_id string, registration_date date, subscription_tier string, "
                                   "acquisition_channel string, email string, country string")
    got = model_runs.run_models(None, web, orders, people, AS_OF, mode="replace_batch")
    assert steps == [2, 2]
    assert [(r.customer_id, r.total_web_events, r.total_orders) for r in got.profiles.collect()] == [("u", 1, 1)]
