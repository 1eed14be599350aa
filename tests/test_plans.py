"""Physical-plan properties the scale design relies on (checked on the small tables)."""

import datetime as dt
import re

from funnelspark.operators import kpi
from funnelspark.plans import feeds
from funnelspark.sources import cdc, json_feed, tables

from .conftest import SF_SMALL


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_event_scan_reads_only_needed_columns(spark):
    p = plan(kpi.web_kpi(tables.web_events(spark, SF_SMALL)))
    schemas = re.findall(r"ReadSchema: (struct<[^>]*>)", p)
    assert schemas and all("value" not in s and "event_id" not in s for s in schemas)


def test_dedup_cuts_keys_before_the_shuffle(spark):
    p = plan(feeds.stg_web(spark, SF_SMALL))
    assert "WindowGroupLimit" in p and "Partial" in p
    # the partial limit sits below (before) the exchange on the key
    partial_at = p.index("Partial")
    exchange_at = p.index("Exchange hashpartitioning(event_id")
    assert partial_at > exchange_at          # deeper in the printed tree = earlier in the job


def test_funnel_join_adds_no_exchange_of_its_own(spark):
    df = feeds.funnel(spark, SF_SMALL)
    p = plan(df)
    join = p.index("SortMergeJoin") if "SortMergeJoin" in p else None
    if join is not None:
        # under the join: a sort and a projection of the final aggregate, no exchange between
        below = p[join:].splitlines()[1:4]
        assert "Sort" in below[0] and "Project" in below[1] and "HashAggregate" in below[2], below


def test_exact_distincts_are_two_level_without_expand(spark):
    for df in (kpi.web_kpi(tables.web_events(spark, SF_SMALL)),
               feeds.stg_web(spark, SF_SMALL).groupBy("customer_id").count()):
        assert "Expand" not in plan(df)
    p = plan(kpi.web_kpi(tables.web_events(spark, SF_SMALL)))
    assert p.count("HashAggregate") >= 4     # partial + final at both levels


def test_json_is_parsed_once_per_record(spark):
    values = json_feed.to_json_records(tables.purchase_events(spark, SF_SMALL),
                                       ["order_id", "user_id"])
    p = plan(json_feed.parse_purchase_records(values))
    assert p.count("from_json(") == 1
    env = cdc.purchase_envelopes(
        tables.purchase_events(spark, SF_SMALL).withColumn("seq", tables.F.lit(1)), "2024-01-15",
        "seq")
    assert plan(cdc.flatten_purchase_changes(env)).count("from_json(") == 1


def test_no_cross_join_or_cartesian_product_anywhere(spark):
    from __spark_entry__ import queries
    for name in ("q_marketing_funnel", "q_profiles_ml", "q_country_summary", "q_cluster_profile",
                 "q_latest_window", "q_web_kpi_minute"):
        p = plan(queries()[name](spark, SF_SMALL))
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name


def test_profile_mart_moves_no_activity_a_second_time(spark):
    """With broadcast off: the customers and the two aggregates are shuffled once each."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = plan(feeds.profiles(spark, SF_SMALL))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "coalesce(w_customer_id" not in p and p.count("LeftOuter") == 3   # two joins, one in the feed
    assert "FullOuter" not in p


def test_trends_read_the_history_once_without_a_join(spark):
    from funnelspark.operators import reports
    hist = spark.createDataFrame([(0, 1.0, 2, dt.datetime(2024, 1, 1))],
                                 "cluster int, avg_x double, rows_in_cluster bigint, analysis_timestamp timestamp")
    p = plan(reports.cluster_trends(hist))
    assert "Join" not in p and p.count("Window ") == 1
