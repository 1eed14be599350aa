"""Structured Streaming jobs: live minute KPIs and raw ingest.

Sources are text files of JSON records (one record per line) or, where the
Kafka connector is on the class path, a Kafka topic read from the earliest
offset.  Each job has its own checkpoint, so a restart continues where it
stopped instead of appending every window again (T2); ``run_to_windows`` keeps
one row for each window even when the checkpoint is lost.

Bounded runs (X7) use ``availableNow``: all data present at start is
processed, windows closed by the watermark are emitted, and the query stops.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from funnelspark.operators import kpi
from funnelspark.schemas import KPI_WINDOW_SECONDS, WATERMARK_DELAY
from funnelspark.session import delete_path, list_names, path_exists, publish_text, read_text
from funnelspark.sources import json_feed


def read_records(spark: SparkSession, path: str | None = None, *, kafka_servers: str | None = None,
                 topic: str | None = None, max_files_per_trigger: int | None = None,
                 max_offsets_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame with a ``value`` text column (+ broker metadata for Kafka).
    The ``max_`` options bound a micro-batch, so a backlog is not taken at once."""
    if kafka_servers:
        kafka = spark.readStream.format("kafka").option("kafka.bootstrap.servers", kafka_servers)
        if max_offsets_per_trigger:
            kafka = kafka.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
        return (kafka.option("subscribe", topic).option("startingOffsets", "earliest").load()
                .select(F.col("value").cast("string").alias("value"), "timestamp", "offset"))
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)


def web_kpi_stream(values: DataFrame, delay: str = WATERMARK_DELAY) -> DataFrame:
    """Live web KPIs (X3): parse, watermark on event time, two-level window aggregate."""
    events = json_feed.parse_records(values, json_feed.WEB_EVENT_JSON)
    return kpi.web_kpi(events.withWatermark("event_timestamp", delay))


def purchase_kpi_stream(values: DataFrame, delay: str = WATERMARK_DELAY) -> DataFrame:
    """Live purchase KPIs (X4): a NULL purchase time takes the processing time
    before the watermark sees it (T24).  Records whose amount can't be read are left out whole, so
    that orders and amounts count the same records; ``purchase_kpi_rejects`` has them."""
    recs = json_feed.parse_purchase_records(values, unread=True) \
        .where(F.col(json_feed.UNREAD_AMOUNT).isNull()).drop(json_feed.UNREAD_AMOUNT) \
        .withColumn("purchase_time", F.coalesce(F.col("purchase_time"), F.current_timestamp()))
    return kpi.purchase_kpi(recs.withWatermark("purchase_time", delay))


def purchase_kpi_rejects(values: DataFrame) -> DataFrame:
    """The records that the purchase KPIs leave out: order_id, purchase_time, the amount's text."""
    return json_feed.parse_purchase_records(values, unread=True) \
        .where(F.col(json_feed.UNREAD_AMOUNT).isNotNull()) \
        .select("order_id", "purchase_time", F.col(json_feed.UNREAD_AMOUNT).alias("total_amount"),
                F.lit("total_amount is unreadable").alias("reject_reason"))


def with_update_time(kpi_rows: DataFrame) -> DataFrame:
    """Stamp KPI rows with their processing time, as the KPI sinks store them
    (S7, S8); ``latest_per_window`` reads repeated windows by this stamp (X11)."""
    return kpi_rows.withColumn("updated_at", F.current_timestamp())


def run_to_files(stream: DataFrame, sink_path: str, checkpoint: str, *,
                 output_mode: str = "append", available_now: bool = True,
                 processing_time: str | None = None, timeout_s: float | None = None,
                 fmt: str = "parquet") -> None:
    """Append a stream to a file sink (S5-S8) and wait for it.

    ``available_now`` runs to the end of the input and stops (X7); otherwise
    the query runs on ``processing_time`` triggers until ``timeout_s``, then
    stops cleanly.
    """
    writer = (stream.writeStream.format(fmt).option("path", sink_path)
              .option("checkpointLocation", checkpoint).outputMode(output_mode))
    if processing_time and not available_now:
        writer = writer.trigger(processingTime=processing_time)
    _await(writer, available_now, timeout_s)


def _await(writer, available_now: bool, timeout_s: float | None) -> None:
    """Start a stream, wait for its end (or until ``timeout_s``) and raise its failure."""
    q = (writer.trigger(availableNow=True) if available_now else writer).start()
    try:
        q.awaitTermination(timeout_s) if timeout_s else q.awaitTermination()
    finally:
        if q.isActive:
            q.stop()
    if q.exception() is not None:
        raise q.exception()


def batch_entry(spark: SparkSession, ledger: str, batch_id: int, values: dict) -> dict:
    """The ledger's entry of a micro-batch: the values of its first attempt.  An entry is published
    once, by an atomic rename, before anything is written for the batch; a retry, on whatever
    day, reads what the first attempt fixed."""
    path = f"{ledger}/{batch_id:012d}.json"
    if not path_exists(spark, path):
        try:
            publish_text(spark, path, json.dumps(values))
        except FileExistsError:   # another attempt was faster
            pass
    return json.loads(read_text(spark, path))


def run_ingest(values: DataFrame, parse, split, sink_path: str, reject_path: str,
               checkpoint: str, *, available_now: bool = True, timeout_s: float | None = None,
               now=lambda: dt.datetime.now(dt.timezone.utc)) -> None:
    """Stateless raw ingest (X5, S5, S6, P17): parsed rows go to the landing
    table, rows with a NULL key or an unreadable amount to the reject table.

    One query writes both outputs in ``foreachBatch``, partitioned by processed
    date, then micro-batch.  The processing time of a batch is fixed once, in a
    ledger beside the checkpoint, by its first attempt; each micro-batch
    overwrites only its own partition, so a retry, also one after midnight,
    replaces what the failed attempt wrote (exactly-once files).  ``compact_day``
    merges the micro-batches of a finished day.
    """
    spark, ledger = values.sparkSession, f"{checkpoint.rstrip('/')}-ledger"

    def write_batch(df: DataFrame, batch_id: int) -> None:
        entry = batch_entry(spark, ledger, batch_id, {
            "processed_at": now().astimezone(dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f")})
        at = entry["processed_at"]
        rows = parse(df, F.lit(at).cast("timestamp")).persist()   # read by both writes
        try:
            for out, path in zip(split(rows), (sink_path, reject_path)):
                out.write.mode("overwrite").parquet(f"{path}/processed_date={at[:10]}/batch_id={batch_id}")
        finally:
            rows.unpersist()

    _await(values.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint),
           available_now, timeout_s)


# ---------------------------------------------------------------- KPI sink by window
VERSIONS = "_versions"


def _version(spark: SparkSession, sink_path: str) -> tuple[int, dict[str, str]]:
    """The sink's newest version: its number and the folder of each day of window starts."""
    numbers = [int(n[:-5]) for n in list_names(spark, f"{sink_path}/{VERSIONS}") if n.endswith(".json")]
    if not numbers:
        return 0, {}
    return max(numbers), json.loads(read_text(spark, f"{sink_path}/{VERSIONS}/{max(numbers):09d}.json"))


def upsert_windows(spark: SparkSession, rows: DataFrame, sink_path: str) -> None:
    """Put KPI rows into the sink, one row for each window.

    A version of the sink is one small file, published by an atomic rename, that names the folder
    of each day.  The days that the rows fall in are written anew, from their stored windows and
    the rows; windows that come again (a lost checkpoint, a retried batch) replace themselves.
    Other days are neither read nor written.
    """
    rows = rows.withColumn("_day", F.date_format("window_start", "yyyy-MM-dd")).persist()
    try:
        days = {r._day for r in rows.select("_day").distinct().collect()}
        if not days:
            return
        number, held = _version(spark, sink_path)
        stored = [held[d] for d in sorted(days & held.keys())]
        fresh = rows
        if stored:
            old = spark.read.schema(rows.drop("_day").schema).parquet(*stored) \
                .withColumn("_day", F.date_format("window_start", "yyyy-MM-dd"))
            fresh = old.join(rows.select("window_start"), "window_start", "left_anti") \
                .select(*rows.columns).unionByName(rows)
        written = f"{sink_path}/write-{uuid.uuid4().hex}"
        fresh.repartition("_day").write.partitionBy("_day").parquet(written)
        now = held | {d: f"{written}/_day={d}" for d in days}
        publish_text(spark, f"{sink_path}/{VERSIONS}/{number + 1:09d}.json", json.dumps(now))
        _drop_old(spark, sink_path, number - 1)
    finally:
        rows.unpersist()


def _drop_old(spark: SparkSession, sink_path: str, last: int) -> None:
    """Delete versions up to ``last`` and the folders that only they name (a reader may still
    hold the version before the newest)."""
    paths = {n: json.loads(read_text(spark, f"{sink_path}/{VERSIONS}/{n}"))
             for n in list_names(spark, f"{sink_path}/{VERSIONS}") if n.endswith(".json")}
    used = {p for n, held in paths.items() if int(n[:-5]) > last for p in held.values()}
    for n, held in paths.items():
        if int(n[:-5]) <= last:
            for p in set(held.values()) - used:
                delete_path(spark, p)
            delete_path(spark, f"{sink_path}/{VERSIONS}/{n}")


def read_windows(spark: SparkSession, sink_path: str, schema, since: str | None = None) -> DataFrame:
    """The sink's windows, of the days from ``since`` (yyyy-MM-dd) on: one row for each window."""
    _, held = _version(spark, sink_path)
    paths = [p for d, p in sorted(held.items()) if since is None or d >= since]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def run_to_windows(kpi_rows: DataFrame, sink_path: str, checkpoint: str, *, available_now: bool = True,
                   timeout_s: float | None = None) -> None:
    """A KPI stream into a sink with one row for each window (S7, S8, X11): idempotent for a
    retried batch and for a replay with a new checkpoint."""
    spark = kpi_rows.sparkSession

    def write_batch(df: DataFrame, batch_id: int) -> None:
        upsert_windows(spark, df, sink_path)
    _await(kpi_rows.writeStream.foreachBatch(write_batch).outputMode("append")
           .option("checkpointLocation", checkpoint), available_now, timeout_s)


# ---------------------------------------------------------------- late rows
def late_rows(landed: DataFrame, time_col: str, delay: str = WATERMARK_DELAY,
              window_seconds: int = KPI_WINDOW_SECONDS) -> DataFrame:
    """batch_id, rows, late_rows, watermark of every micro-batch of a landed table: the rows whose
    window the watermark had closed when the batch began, which the live KPIs leave out and the
    landed table keeps (X6, T1).

    The watermark of a batch is the largest event time of the batches before it, less the
    delay, as the stream's own is.  The batches' maxima are one row each; rows are aggregated in place.
    """
    tops = landed.groupBy("batch_id").agg(F.max(time_col).alias("top"))
    before = Window.orderBy("batch_id").rowsBetween(Window.unboundedPreceding, -1)   # a row for each batch
    marks = tops.select("batch_id", (F.max("top").over(before) - F.expr(f"INTERVAL {delay}")).alias("watermark"))
    start = F.floor(F.unix_seconds(time_col) / window_seconds) * window_seconds
    closed = F.timestamp_seconds(start + window_seconds) <= F.col("watermark")
    return landed.join(marks, "batch_id").groupBy("batch_id", "watermark").agg(
        F.count("*").alias("rows"), F.count_if(F.coalesce(closed, F.lit(False))).alias("late_rows"))


def compact_day(spark: SparkSession, sink_path: str, day: str, target: str) -> DataFrame:
    """All micro-batches of a landed day written as one table to ``target`` (a new place)."""
    rows = spark.read.parquet(sink_path).where(F.col("processed_date") == F.lit(day).cast("date"))
    rows.drop("batch_id", "processed_date").repartitionByRange("user_id", "_processed_at") \
        .sortWithinPartitions("user_id", "_processed_at").write.parquet(target)
    return spark.read.parquet(target)
