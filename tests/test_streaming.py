
import datetime as dt
import json
import os

from funnelspark.operators import kpi
from funnelspark.sources import json_feed
from funnelspark.streaming import kpi_stream


def _write_lines(path, name, records):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as f:
        for r in records:
            f.write((r if isinstance(r, str) else json.dumps(r)) + "\n")


def _event(user, ts, page=None, product=None):
    rec = {"user_id": user, "event_timestamp": ts, "event_type": "page_view",
           "session_id": "s", "device_type": "mobile"}
    if page:
        rec["page_url"] = page
    if product:
        rec["product_id"] = product
    return rec


def test_late_event_dropped_by_kpi_but_kept_by_raw_ingest(spark, tmp_dir):
    feed, sink, ckpt = (os.path.join(tmp_dir, x) for x in ("feed", "sink", "ckpt"))
    raw, rej, ickpt = (os.path.join(tmp_dir, x) for x in ("raw", "rej", "ickpt"))
    _write_lines(feed, "a.json", [
        _event("u1", "2024-01-01T00:00:10Z", page="/a"),
        _event("u2", "2024-01-01T00:00:20Z", product="p"),
        _event("u1", "2024-01-01T00:00:50Z", page="/b"),
        _event("u3", "2024-01-01T00:01:30Z"),
        _event("u3", "2024-01-01T00:02:30Z"),        # advances the watermark to 00:02:25
    ])
    stream = kpi_stream.web_kpi_stream(kpi_stream.read_records(spark, feed))
    kpi_stream.run_to_files(stream, sink, ckpt)
    first = {r["window_start"]: r for r in spark.read.parquet(sink).collect()}
    assert sorted(first) == [dt.datetime(2024, 1, 1, 0, 0), dt.datetime(2024, 1, 1, 0, 1)]
    w0 = first[dt.datetime(2024, 1, 1, 0, 0)]
    assert (w0["total_events"], w0["unique_users"], w0["total_page_views"],
            w0["total_product_clicks"]) == (3, 2, 2, 1)

    # A late event for the closed first minute, plus one more in the open window.
    _write_lines(feed, "b.json", [_event("u9", "2024-01-01T00:00:30Z"),
                                  _event("u4", "2024-01-01T00:02:40Z"),
                                  _event("u4", "2024-01-01T00:04:00Z"),
                                  "not json at all"])
    kpi_stream.run_to_files(kpi_stream.web_kpi_stream(kpi_stream.read_records(spark, feed)),
                            sink, ckpt)
    after = {r["window_start"]: r for r in spark.read.parquet(sink).collect()}
    assert after[dt.datetime(2024, 1, 1, 0, 0)]["total_events"] == 3     # late row dropped
    assert after[dt.datetime(2024, 1, 1, 0, 2)]["unique_users"] == 2     # u3 and u4
    assert len(spark.read.parquet(sink).collect()) == 3                 # one copy per window

    # The raw ingest keeps the late row and skips the garbage line.
    kpi_stream.run_ingest(kpi_stream.read_records(spark, feed), json_feed.parse_web_events,
                          json_feed.split_web, raw, rej, ickpt)
    landed = spark.read.parquet(raw)
    assert landed.count() == 8
    assert landed.filter("user_id = 'u9'").count() == 1


def test_stream_kpi_equals_batch_on_closed_windows(spark, tmp_dir):
    feed, sink, ckpt = (os.path.join(tmp_dir, x) for x in ("feed", "sink", "ckpt"))
    recs = []
    for i in range(300):
        minute, sec = divmod(i * 7, 60)
        recs.append(_event(f"u{i % 13}", f"2024-01-01T00:{minute:02d}:{sec:02d}Z",
                           page="/p" if i % 2 else None, product="x" if i % 3 == 0 else None))
    _write_lines(feed, "a.json", recs)
    kpi_stream.run_to_files(kpi_stream.web_kpi_stream(kpi_stream.read_records(spark, feed)),
                            sink, ckpt)
    streamed = {tuple(r) for r in spark.read.parquet(sink).collect()}
    batch_events = json_feed.parse_records(spark.read.text(feed), json_feed.WEB_EVENT_JSON)
    batch = {tuple(r) for r in kpi.web_kpi(batch_events).collect()}
    last_start = max(r[0] for r in batch)
    assert streamed == {r for r in batch if r[0] != last_start}


def test_purchase_stream_counts_empty_list_as_zero(spark, tmp_dir):
    feed, sink, ckpt = (os.path.join(tmp_dir, x) for x in ("feed", "sink", "ckpt"))
    _write_lines(feed, "a.json", [
        {"order_id": "1", "user_id": "u", "purchase_time": "2024-01-01T00:00:01Z",
         "total_amount": 10.005, "product_ids": []},
        {"order_id": "2", "user_id": "u", "purchase_time": "2024-01-01T00:00:02Z",
         "total_amount": 5.10, "product_ids": ["a", "b"]},
        {"order_id": "3", "user_id": "u", "purchase_time": "2024-01-01T00:05:00Z",
         "total_amount": 1, "product_ids": ["a"]},
    ])
    kpi_stream.run_to_files(kpi_stream.purchase_kpi_stream(kpi_stream.read_records(spark, feed)),
                            sink, ckpt)
    rows = spark.read.parquet(sink).collect()
    assert len(rows) == 1
    r = rows[0]
    assert r["total_orders"] == 2 and r["total_products"] == 2
    assert str(r["total_amount"]) == "15.11" and str(r["avg_amount"]) == "7.56"


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

EVENTS = st.lists(st.tuples(st.sampled_from(["a", "b", "c", None]), st.integers(0, 299),
                            st.booleans(), st.booleans()), min_size=1, max_size=40)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=EVENTS)
def test_minute_kpi_matches_brute_force(spark, rows):
    import pandas as pd
    base = dt.datetime(2024, 1, 1)
    data = [(u, base + dt.timedelta(seconds=s), "/p" if pg else None, "x" if pr else None)
            for u, s, pg, pr in rows]
    df = spark.createDataFrame(data, "user_id string, event_timestamp timestamp, "
                                     "page_url string, product_id string")
    got = {r["window_start"]: (r["total_events"], r["unique_users"], r["total_page_views"],
                               r["total_product_clicks"]) for r in kpi.web_kpi(df).collect()}
    pdf = pd.DataFrame(data, columns=["u", "t", "p", "x"])
    pdf["w"] = pdf["t"].dt.floor("min")
    want = {w.to_pydatetime(): (len(g), g["u"].dropna().nunique(), int(g["p"].notna().sum()),
                                int(g["x"].notna().sum())) for w, g in pdf.groupby("w")}
    assert got == want
