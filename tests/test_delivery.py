"""Exactly-once landing across a date change, KPI windows that replace themselves, late rows,
amounts that are rejected on every route, snapshots found by name."""

import datetime as dt
import json
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from funnelspark.operators import kpi
from funnelspark.schemas import WEB_ROW_IMAGE
from funnelspark.session import list_names
from funnelspark.sources import cdc, json_feed, snapshots
from funnelspark.streaming import kpi_stream

KPI = "window_start timestamp, window_end timestamp, total_events long"


def write_lines(path, name, records):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as f:
        for r in records:
            f.write((r if isinstance(r, str) else json.dumps(r)) + "\n")


def web(user, ts):
    return {"user_id": user, "event_timestamp": ts, "event_type": "page_view", "session_id": "s",
            "device_type": "mobile"}


def order(number, amount, **more):
    return {"order_id": number, "user_id": "u", "purchase_time": "2024-01-01T00:00:01Z", "total_amount": amount,
            "product_ids": ["a"], **more}


# ----------------------------------------------------------------- ledger
def test_a_retry_on_the_next_day_replaces_what_the_first_attempt_wrote(spark, tmp_dir):
    feed, landed, rejects, ckpt = (f"{tmp_dir}/{n}" for n in ("feed", "landed", "rejects", "ckpt"))
    write_lines(feed, "a.json", [order("1", 5), {**order("2", 6), "purchase_time": None}, order("3", "7,5")])
    days = iter([dt.datetime(2024, 1, 31, 23, 59, 58, tzinfo=dt.timezone.utc),
                 dt.datetime(2024, 2, 1, 0, 0, 3, tzinfo=dt.timezone.utc),
                 dt.datetime(2024, 2, 1, 9, 0, 0, tzinfo=dt.timezone.utc)])

    def failing(df):
        ok, bad = json_feed.split_purchases(df)
        return ok, bad.withColumn("reject_reason", F.raise_error(F.lit("executor lost")))

    def run(split):
        kpi_stream.run_ingest(kpi_stream.read_records(spark, feed), json_feed.parse_landed_purchases, split, landed,
                              rejects, ckpt, now=lambda: next(days))
    with pytest.raises(Exception, match="executor lost"):
        run(failing)                       # the landing table is written, the rejects are not
    assert spark.read.parquet(landed).count() == 2
    run(json_feed.split_purchases)         # after midnight
    write_lines(feed, "b.json", [order("4", 8)])
    run(json_feed.split_purchases)
    got = {r.order_id: r for r in spark.read.parquet(landed).collect()}
    assert spark.read.parquet(landed).count() == len(got) == 3
    first = dt.datetime(2024, 1, 31, 23, 59, 58)
    assert [got[i]._processed_at for i in "12"] == [first, first] and got["2"].purchase_time == first
    assert {str(r.processed_date) for r in got.values()} == {"2024-01-31", "2024-02-01"}
    assert [(r.order_id, r.reject_reason) for r in spark.read.parquet(rejects).collect()] == [
        ("3", "total_amount is unreadable")]


# ----------------------------------------------------------------- KPI windows
def windows(spark, rows):
    return spark.createDataFrame([(dt.datetime(2024, 1, d, 0, m), dt.datetime(2024, 1, d, 0, m + 1), n)
                                  for d, m, n in rows], KPI)


def held(spark, sink, since=None):
    return sorted((r.window_start.day, r.window_start.minute, r.total_events)
                  for r in kpi_stream.read_windows(spark, sink, KPI, since).collect())


def test_windows_that_come_again_replace_themselves(spark, tmp_dir, monkeypatch):
    sink = f"{tmp_dir}/sink"
    assert held(spark, sink) == []
    kpi_stream.upsert_windows(spark, windows(spark, [(1, 0, 5), (1, 1, 6), (2, 0, 7)]), sink)
    before = kpi_stream._version(spark, sink)[1]
    kpi_stream.upsert_windows(spark, windows(spark, [(1, 1, 9), (1, 3, 1)]), sink)
    assert held(spark, sink) == [(1, 0, 5), (1, 1, 9), (1, 3, 1), (2, 0, 7)]
    assert held(spark, sink, "2024-01-02") == [(2, 0, 7)]
    after = kpi_stream._version(spark, sink)[1]
    assert before["2024-01-02"] == after["2024-01-02"] and before["2024-01-01"] != after["2024-01-01"]
    kpi_stream.upsert_windows(spark, windows(spark, []), sink)
    publish = kpi_stream.publish_text

    def lost(*args):
        raise RuntimeError("driver lost")
    monkeypatch.setattr(kpi_stream, "publish_text", lost)
    with pytest.raises(RuntimeError):
        kpi_stream.upsert_windows(spark, windows(spark, [(1, 0, 0), (3, 0, 1)]), sink)
    assert held(spark, sink) == [(1, 0, 5), (1, 1, 9), (1, 3, 1), (2, 0, 7)]
    monkeypatch.setattr(kpi_stream, "publish_text", publish)
    for n in range(4):
        kpi_stream.upsert_windows(spark, windows(spark, [(1, 0, n)]), sink)
    assert held(spark, sink)[0] == (1, 0, 3) and held(spark, sink)[-1] == (2, 0, 7)
    assert len(list_names(spark, f"{sink}/{kpi_stream.VERSIONS}")) <= 4   # data and checksum of two versions


def test_a_lost_checkpoint_adds_no_window_twice(spark, tmp_dir):
    feed, sink = f"{tmp_dir}/feed", f"{tmp_dir}/sink"
    write_lines(feed, "a.json", [web(f"u{i}", f"2024-01-01T00:{i:02d}:30Z") for i in range(12)])
    for name in ("one", "one", "two"):     # stopped, restarted, and started anew without its checkpoint
        rows = kpi_stream.web_kpi_stream(kpi_stream.read_records(spark, feed))
        kpi_stream.run_to_windows(rows, sink, f"{tmp_dir}/ckpt-{name}")
    got = kpi_stream.read_windows(spark, sink, rows.schema)
    want = kpi.web_kpi(json_feed.parse_records(spark.read.text(feed), json_feed.WEB_EVENT_JSON)) \
        .where("window_start < '2024-01-01 00:11:00'")
    assert sorted(got.collect()) == sorted(want.collect()) and got.count() == 11


# ----------------------------------------------------------------- late rows
def test_late_rows_of_each_batch(spark):
    at = lambda m, s=0: dt.datetime(2024, 1, 1, 0, m, s)
    rows = [(0, at(0, 10)), (0, at(2, 4)), (1, at(0, 59)), (1, at(1, 30)), (1, at(9)), (2, at(8, 54)), (2, at(7, 59)),
            (2, None)]
    got = kpi_stream.late_rows(spark.createDataFrame(rows, "batch_id long, t timestamp"), "t").collect()
    assert {r.batch_id: (r.rows, r.late_rows, r.watermark) for r in got} == {
        0: (2, 0, None), 1: (3, 1, at(1, 59)), 2: (3, 1, at(8, 55))}


# ----------------------------------------------------------------- amounts
AMOUNTS = [("5", "5.00"), ("5.005", "5.01"), ('" 7.5 "', "7.50"), ("-1e2", "-100.00"), ("null", None),
           ("1e19", 0), ('"12,50"', 0), ('"1.2.3"', 0), ('"abc"', 0), ('""', 0), ("true", 0), ("[1]", 0), ('"NaN"', 0)]


def test_amounts_are_read_strictly_on_all_routes(spark):
    values = spark.createDataFrame(
        [(f'{{"order_id":"{i}","user_id":"u","purchase_time":"2024-01-01T00:00:01Z","total_amount":{a}}}',)
         for i, (a, _) in enumerate(AMOUNTS)], "value string")
    good = {str(i): want and Decimal(want) for i, (_, want) in enumerate(AMOUNTS) if want != 0}
    bad = {str(i) for i, (_, want) in enumerate(AMOUNTS) if want == 0}
    ok, rejected = json_feed.split_purchases(json_feed.parse_landed_purchases(values))
    assert {r.order_id: r.total_amount for r in ok.collect()} == good
    assert {r.order_id for r in rejected.where("reject_reason = 'total_amount is unreadable'").collect()} == bad
    assert {r.order_id for r in kpi_stream.purchase_kpi_rejects(values).collect()} == bad

    images = values.select(F.concat(
        F.lit('{"before":null,"op":"c","ts_ms":1,"source":{"lsn":1},"after":'),
        F.regexp_replace("value", '"purchase_time":"[^"]*"', '"purchase_time":1704067201000'), F.lit("}")).alias("value"))
    assert {r.order_id: r.total_amount for r in cdc.flatten_purchase_changes(images).collect()} == good
    assert {json.loads(r.value)["after"]["order_id"] for r in cdc.rejected_changes(images).collect()} == bad


def test_kpis_count_the_records_whose_amounts_they_add(spark, tmp_dir):
    feed = f"{tmp_dir}/feed"
    write_lines(feed, "a.json", [order("1", 10), order("2", 1e19), order("3", "12,50"), order("4", None),
                                 order("5", 1, purchase_time="2024-01-01T00:05:00Z")])
    kpi_stream.run_to_files(kpi_stream.purchase_kpi_stream(kpi_stream.read_records(spark, feed)),
                            f"{tmp_dir}/sink", f"{tmp_dir}/ckpt")
    row, = spark.read.parquet(f"{tmp_dir}/sink").collect()
    assert (row.total_orders, str(row.total_amount), str(row.avg_amount)) == (2, "10.00", "10.00")


def test_broken_envelopes_are_rejected_and_deletes_are_not(spark):
    good = ('{"before":null,"after":{"user_id":"u","event_timestamp":1704067201000000},"op":"c","ts_ms":5,'
            '"source":{"lsn":7}}')
    values = spark.createDataFrame(
        [(good,), (None,), ("not json",), ('{"op":"c","ts_ms":1}',), ('{"op":"d","before":{"user_id":"u"},"after":null}',),
         ('{"op":"u","after":"text"}',), (good[:-20],)], "value string")
    got = cdc.rejected_changes(values, WEB_ROW_IMAGE).collect()
    assert sorted((r.reject_reason, r.value) for r in got) == sorted([
        ("envelope is unreadable", "not json"), ("row image is missing or unreadable", '{"op":"c","ts_ms":1}'),
        ("row image is missing or unreadable", '{"op":"u","after":"text"}')] + [
        (r.reject_reason, r.value) for r in got if r.value == good[:-20]])
    assert [(r.user_id, r.kafka_offset) for r in cdc.flatten_web_changes(values.limit(6)).collect()] == [("u", 7)]


# ----------------------------------------------------------------- snapshots
def test_only_the_newest_load_is_opened(spark, tmp_dir):
    path, schema = f"{tmp_dir}/mart", "n int"
    frame = lambda n: spark.createDataFrame([(n,)], schema)
    assert snapshots.latest(spark, path, schema).collect() == []
    for n, at in ((1, "2024-01-01"), (3, "2024-02-01 10:00:00"), (2, dt.datetime(2024, 1, 15)), (4, "2024-02-01 10:00:00")):
        snapshots.append(spark, path, frame(n), at)
    frame(9).write.parquet(f"{path}/_load=2024-03-01T000000.000000/data-crashed")   # its pointer was never published
    newest = snapshots.latest(spark, path, schema)
    assert [r.n for r in newest.collect()] == [4]
    assert len({f.split("/_load=")[1].split("/")[0] for f in newest.inputFiles()}) == 1
    assert sorted(r.n for r in snapshots.history(spark, path, schema).collect()) == [1, 2, 4]
