"""JSON event records: serialisation (what the producers send) and tolerant
parsing (S1, S2, C19, P1, P2, P17, T24).

Parsing follows the stream source's rules: declared schema, ISO-8601 times,
unparsable records skipped, a field of the wrong type set to NULL while the
rest of the record is kept, missing fields NULL.  Rows then meet the landing
table's NOT NULL columns: those with a NULL key go to a reject output instead
of failing the job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from funnelspark.functions.columns import array_as_text
from funnelspark.schemas import (MONEY, PURCHASE_EVENT_JSON, RAW_PURCHASE_NOT_NULL, RAW_WEB_NOT_NULL,
                                 WEB_EVENT_JSON)

ISO_TIME_OUT = "yyyy-MM-dd'T'HH:mm:ss.SSSXXX"
CORRUPT = "_corrupt_record"


def to_json_records(df: DataFrame, columns: list[str]) -> DataFrame:
    """One JSON text per row in ``value`` (NULL fields are omitted, as producers do)."""
    return df.select(F.to_json(F.struct(*columns), {"timestampFormat": ISO_TIME_OUT})
                     .alias("value"))


def parse_once(parsed: Column) -> Column:
    """Evaluate a ``from_json`` once per record.

    Filters on parsed fields would otherwise be pushed below the projection
    and re-parse the text for every predicate; a one-element ``explode`` is a
    barrier the optimizer does not push through, so each record is parsed once.
    """
    return F.explode(F.array(parsed))


#: An amount as JSON number or text; signs, digits, one point, an exponent.
AMOUNT = r"^\s*[+-]?(?:[0-9]+(?:\.[0-9]*)?|\.[0-9]+)(?:[eE][+-]?[0-9]+)?\s*$"
#: Why an amount isn't read, and its text (NULL for an amount that is read).
UNREAD_AMOUNT = "unread_total_amount"


def read_amount(text: Column) -> Column:
    """An amount from its text, NULL unless the whole text is a number that fits; the
    JSON parser would take ``12,50`` for 1250."""
    return F.when(text.rlike(AMOUNT), F.trim(text).try_cast(MONEY))


def unread_amount(text: Column) -> Column:
    """The text of an amount that isn't NULL and isn't read."""
    return F.when(text.isNotNull() & read_amount(text).isNull(), text)


def with_text_amount(schema: T.StructType) -> T.StructType:
    """The schema with ``total_amount`` as text, to be read by ``read_amount``."""
    return T.StructType([T.StructField(f.name, T.StringType()) if f.name == "total_amount" else f
                         for f in schema.fields])


def parse_records(values: DataFrame, schema: T.StructType, keep: list[str] | None = None,
                  unread: bool = False) -> DataFrame:
    """Parse ``value`` with ``schema``; drop unparsable records; keep other columns listed.
    ``total_amount`` is read strictly; with ``unread`` the column ``unread_total_amount`` holds the
    text of an amount that couldn't be read."""
    with_corrupt = T.StructType(with_text_amount(schema).fields + [T.StructField(CORRUPT, T.StringType())])
    # No explicit time format: the default parser reads any ISO-8601 time.
    parsed = F.from_json(F.col("value"), with_corrupt,
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    rows = values.select(parse_once(parsed).alias("r"), *(keep or []))
    all_null = None
    for f in schema.fields:
        cond = F.col(f"r.{f.name}").isNull()
        all_null = cond if all_null is None else (all_null & cond)
    garbage = F.col(f"r.{CORRUPT}").isNotNull() & all_null
    amount = F.col("r.total_amount") if "total_amount" in schema.fieldNames() else None
    extra = [unread_amount(amount).alias(UNREAD_AMOUNT)] if unread else []
    return rows.filter(~garbage).select(
        *[read_amount(amount).alias(f.name) if f.name == "total_amount" else F.col(f"r.{f.name}")
          for f in schema.fields], *extra, *(keep or []))


def parse_web_events(values: DataFrame, processed_at: Column | None = None) -> DataFrame:
    """Web JSON → 8 declared columns + processing time."""
    rows = parse_records(values, WEB_EVENT_JSON)
    return rows.withColumn("_processed_at",
                           processed_at if processed_at is not None else F.current_timestamp())


def parse_purchase_records(values: DataFrame, unread: bool = False) -> DataFrame:
    """Purchase JSON → the stream record (array product ids), missing fields tolerated."""
    return parse_records(values, PURCHASE_EVENT_JSON, unread=unread)


def parse_landed_purchases(values: DataFrame, processed_at: Column | None = None) -> DataFrame:
    """Purchase JSON → landed rows that still show an amount that couldn't be read, so
    that ``split_purchases`` rejects it instead of landing a NULL amount."""
    return land_purchases(parse_records(values, PURCHASE_EVENT_JSON, unread=True), processed_at)


def land_purchases(records: DataFrame, processed_at: Column | None = None) -> DataFrame:
    """Stream record → landed row: default purchase time, list as text,
    processing time (P2, T24: the default is applied before any watermark)."""
    now = processed_at if processed_at is not None else F.current_timestamp()
    return records.select(
        "order_id", "user_id",
        F.coalesce(F.col("purchase_time"), now).alias("purchase_time"),
        "total_amount",
        array_as_text(F.col("product_ids")).alias("product_ids"),
        "payment_method", "shipping_address", "order_status", "currency",
        now.alias("_processed_at"),
        *([F.col(UNREAD_AMOUNT)] if UNREAD_AMOUNT in records.columns else []),
    )


def split_not_null(df: DataFrame, not_null: tuple[str, ...]) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) by the landing table's NOT NULL columns."""
    ok = None
    for c in not_null:
        cond = F.col(c).isNotNull()
        ok = cond if ok is None else (ok & cond)
    return df.filter(ok), df.filter(~ok).withColumn(
        "reject_reason", F.concat_ws(",", *[F.when(F.col(c).isNull(), F.lit(f"{c} is null"))
                                            for c in not_null]))


def split_web(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    return split_not_null(df, RAW_WEB_NOT_NULL)


def split_purchases(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """As ``split_not_null``; an unread amount is a reason to reject as well."""
    if UNREAD_AMOUNT not in df.columns:
        return split_not_null(df, RAW_PURCHASE_NOT_NULL)
    ok, bad = split_not_null(df.where(F.col(UNREAD_AMOUNT).isNull()).drop(UNREAD_AMOUNT),
                             RAW_PURCHASE_NOT_NULL)
    unread = df.where(F.col(UNREAD_AMOUNT).isNotNull()).drop(UNREAD_AMOUNT)
    return ok, bad.unionByName(unread.withColumn("reject_reason", F.lit("total_amount is unreadable")))
