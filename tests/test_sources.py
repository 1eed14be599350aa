"""Change feed, bounded stream runs and dedup against brute force."""

import datetime as dt
import json
import os
import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from funnelspark.operators import staging
from funnelspark.sources import cdc, json_feed
from funnelspark.streaming import kpi_stream


def _env(op, after, ts_ms=1704067200000, lsn=1):
    return json.dumps({"before": None, "after": after, "op": op, "ts_ms": ts_ms,
                       "source": {"lsn": lsn}})


def test_change_feed_keeps_new_images_of_create_update_read_only(spark):
    img = {"order_id": "o1", "user_id": "u1", "purchase_time": 1704067200123,
           "total_amount": 12.5, "product_ids": "[a]", "_processed_at": 1704067201000}
    values = spark.createDataFrame([
        (_env("r", img, lsn=1),), (_env("c", dict(img, order_id="o2"), lsn=2),),
        (_env("u", dict(img, order_status="shipped"), lsn=3),),
        (_env("d", None, lsn=4),), ("garbage",)], ["value"])
    rows = cdc.flatten_purchase_changes(values).orderBy("kafka_offset").collect()
    assert [r["kafka_offset"] for r in rows] == [1, 2, 3]
    assert rows[0]["purchase_time"] == dt.datetime(2024, 1, 1, 0, 0, 0, 123000)
    assert rows[2]["order_status"] == "shipped"
    assert rows[0]["kafka_time"] == dt.datetime(2024, 1, 1)


def test_change_feed_uses_broker_metadata_when_present(spark):
    img = {"user_id": "u1", "event_timestamp": 1704067200999999, "_processed_at": 1704067201000000}
    values = spark.createDataFrame(
        [(_env("c", img), dt.datetime(2024, 1, 2, 3, 4, 5, 600000), 77)],
        "value string, timestamp timestamp, offset long")
    r = cdc.flatten_web_changes(values).collect()[0]
    assert r["event_timestamp"] == dt.datetime(2024, 1, 1, 0, 0, 0)     # whole seconds
    assert (r["kafka_time"], r["kafka_offset"]) == (dt.datetime(2024, 1, 2, 3, 4, 5), 77)


def test_bounded_run_with_timeout_stops_cleanly(spark, tmp_dir):
    feed = os.path.join(tmp_dir, "feed")
    os.makedirs(feed)
    with open(os.path.join(feed, "a.json"), "w") as f:
        f.write(json.dumps({"user_id": "u", "event_timestamp": "2024-01-01T00:00:01Z"}) + "\n")
    sink, ckpt = os.path.join(tmp_dir, "sink"), os.path.join(tmp_dir, "ckpt")
    stream = kpi_stream.read_records(spark, feed).select("value")
    kpi_stream.run_to_files(stream, sink, ckpt, available_now=False,
                            processing_time="1 second", timeout_s=8, fmt="text")
    assert [r["value"] for r in spark.read.text(sink).collect()][0].startswith('{"user_id"')
    assert not any(q.isActive for q in spark.streams.active)


def test_web_rejects_rows_without_key_columns(spark):
    values = spark.createDataFrame([
        ('{"user_id": "u", "event_timestamp": "2024-01-01T00:00:01Z", "event_type": "login", '
         '"session_id": "s", "device_type": "mobile"}',),
        ('{"event_timestamp": "2024-01-01T00:00:01Z", "event_type": "login", '
         '"session_id": "s", "device_type": "mobile"}',)], ["value"])
    ok, bad = json_feed.split_web(json_feed.parse_web_events(values))
    assert ok.count() == 1
    assert [r["reject_reason"] for r in bad.collect()] == ["user_id is null"]


ROW = st.tuples(st.sampled_from(["o1", "o2", "o3"]), st.integers(0, 3), st.integers(0, 3),
                st.sampled_from(["processing", "shipped", "completed"]))


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=st.lists(ROW, min_size=1, max_size=12))
def test_dedup_matches_brute_force(spark, rows):
    base = dt.datetime(2024, 1, 1)
    data = [(o, "u", base + dt.timedelta(hours=p), "1.00", "[a]", "card", "x", s, "USD",
             base + dt.timedelta(minutes=q)) for o, p, q, s in rows]
    df = spark.createDataFrame(
        data, "order_id string, user_id string, purchase_time timestamp, total_amount string, "
              "product_ids string, payment_method string, shipping_address string, "
              "order_status string, currency string, _processed_at timestamp")
    shuffled = df.repartition(random.randint(1, 4))
    got = {r["order_id"]: (r["order_purchase_timestamp_utc"], r["stream_processed_at_utc"])
           for r in staging.stg_purchase_events(shuffled, "2024-02-01 00:00:00").collect()}
    want = {}
    for o, p, q, _ in rows:
        key = (base + dt.timedelta(hours=p), base + dt.timedelta(minutes=q))
        want[o] = max(want.get(o, key), key)
    assert got == want
