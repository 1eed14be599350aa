"""Change-data capture of the landing tables.

The capture emits one JSON envelope per change (``before``, ``after``, ``op``,
``ts_ms``, ``source.lsn``); the consumer keeps the new row image of creates,
updates and snapshot reads, and types its epoch-integer times.  The functions
take any DataFrame with a ``value`` text column, batch or streaming; broker
metadata (Kafka ``timestamp`` and ``offset``) is used when present, else the
envelope's commit time and log position stand in for it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from funnelspark.schemas import (CDC_ROW_OPS, PURCHASE_ROW_IMAGE, WEB_ROW_IMAGE,
                                 envelope_schema)
from funnelspark.sources.json_feed import (CORRUPT, parse_once, read_amount, unread_amount,
                                           with_text_amount)


def _image(df: DataFrame, time_unit: str, time_cols: tuple[str, ...]) -> DataFrame:
    """Row image with times as epoch integers (micros for web, millis for purchases, T17)."""
    out = df
    for c in time_cols:
        micros = F.unix_micros(F.col(c))
        out = out.withColumn(c, micros if time_unit == "micros" else F.floor(micros / 1000))
    return out


def web_envelopes(raw_web: DataFrame, snapshot_before, lsn_col: str) -> DataFrame:
    """Envelopes of the landed web rows: rows landed before ``snapshot_before``
    come from the initial snapshot (op 'r'), later ones as inserts (op 'c')."""
    img = _image(raw_web, "micros", ("event_timestamp", "_processed_at"))
    after = F.struct(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in WEB_ROW_IMAGE.fields])
    return _envelope(img, after, snapshot_before, "_processed_at", lsn_col)


def purchase_envelopes(raw_purchases: DataFrame, snapshot_before, lsn_col: str) -> DataFrame:
    img = _image(raw_purchases, "millis", ("purchase_time", "_processed_at"))
    after = F.struct(*[F.col(f.name).cast(f.dataType).alias(f.name)
                       for f in PURCHASE_ROW_IMAGE.fields])
    return _envelope(img, after, snapshot_before, "_processed_at", lsn_col,
                     processed_unit="millis")


def _envelope(img, after, snapshot_before, processed_col, lsn_col, processed_unit="micros"):
    processed = F.col(processed_col)
    ts_ms = processed if processed_unit == "millis" else F.floor(processed / 1000)
    cutoff_us = F.unix_micros(F.lit(str(snapshot_before)).cast("timestamp"))
    cutoff = cutoff_us if processed_unit == "micros" else F.floor(cutoff_us / 1000)
    op = F.when(processed < cutoff, F.lit("r")).otherwise(F.lit("c"))
    env = F.struct(F.lit(None).alias("before"),   # inserts carry no old image
                   after.alias("after"), op.alias("op"), ts_ms.cast("bigint").alias("ts_ms"),
                   F.struct(F.col(lsn_col).cast("bigint").alias("lsn")).alias("source"))
    return img.select(F.to_json(env).alias("value"))


def read_envelopes(values: DataFrame, image) -> DataFrame:
    """Every envelope: ``e`` (its fields, the amount as text), ``reject_reason`` (NULL if it can be
    applied or carries no new row) and the record itself with its broker metadata."""
    schema = envelope_schema(with_text_amount(image))
    schema = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
    env = F.from_json(F.col("value"), schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    meta = []
    if "timestamp" in values.columns:
        meta.append(F.col("timestamp").alias("_broker_time"))
    if "offset" in values.columns:
        meta.append(F.col("offset").alias("_broker_offset"))
    rows = values.select(parse_once(env).alias("e"), "value", *meta)
    carries = F.coalesce(F.col("e.op").isin(*CDC_ROW_OPS), F.lit(False))
    # Deletes and tombstones (a NULL value) carry no new row.
    reason = F.when(F.col("value").isNotNull() & F.col("e.op").isNull(), "envelope is unreadable") \
        .when(carries & F.col("e.after").isNull(), "row image is missing or unreadable")
    if "total_amount" in image.fieldNames():
        reason = reason.when(carries & unread_amount(F.col("e.after.total_amount")).isNotNull(),
                             "total_amount is unreadable")
    return rows.withColumn("reject_reason", reason)


def rejected_changes(values: DataFrame, image=None) -> DataFrame:
    """(value, reject_reason) of the records that can't be applied: broken envelopes, missing row
    images, amounts that aren't numbers or don't fit (S9, C4)."""
    return read_envelopes(values, image or PURCHASE_ROW_IMAGE).where("reject_reason is not null") \
        .select("value", "reject_reason")


def _flatten(values: DataFrame, image) -> DataFrame:
    rows = read_envelopes(values, image).where(
        F.col("e.op").isin(*CDC_ROW_OPS) & F.col("reject_reason").isNull())
    broker_time = (F.col("_broker_time") if "timestamp" in values.columns
                   else F.timestamp_millis(F.col("e.ts_ms")))
    broker_offset = (F.col("_broker_offset") if "offset" in values.columns
                     else F.col("e.source.lsn"))
    columns = [read_amount(F.col("e.after.total_amount")).alias(c) if c == "total_amount"
               else F.col(f"e.after.{c}") for c in image.fieldNames()]
    return rows.select(*columns, F.date_trunc("second", broker_time).alias("kafka_time"),
                       broker_offset.cast("bigint").alias("kafka_offset"))


# Epoch unit of each time column of the row images (T17: it follows the
# landing column's precision, micros for web, millis for purchases).
WEB_TIME_UNITS = {"event_timestamp": "micros", "_processed_at": "micros"}
PURCHASE_TIME_UNITS = {"purchase_time": "millis", "_processed_at": "millis"}


def epoch_to_time(c, unit: str, precision: str):
    """Epoch integer -> timestamp at the warehouse column's precision."""
    ts = {"micros": F.timestamp_micros, "millis": F.timestamp_millis,
          "seconds": F.timestamp_seconds}[unit](c)
    return F.date_trunc("second", ts) if precision == "second" else ts


def _typed(rows: DataFrame, columns, units: dict, precision: str) -> DataFrame:
    return rows.select(*[epoch_to_time(F.col(c), units[c], precision).alias(c) if c in units
                         else F.col(c) for c in columns], "kafka_time", "kafka_offset")


def flatten_web_changes(values: DataFrame, units: dict = WEB_TIME_UNITS) -> DataFrame:
    """Web envelopes → typed warehouse rows, whole-second times."""
    return _typed(_flatten(values, WEB_ROW_IMAGE), WEB_ROW_IMAGE.fieldNames(), units, "second")


def flatten_purchase_changes(values: DataFrame, units: dict = PURCHASE_TIME_UNITS) -> DataFrame:
    """Purchase envelopes → typed warehouse rows, millisecond times."""
    return _typed(_flatten(values, PURCHASE_ROW_IMAGE), PURCHASE_ROW_IMAGE.fieldNames(), units,
                  "milli")
