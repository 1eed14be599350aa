"""The batch model chain with incremental runs.

``run_models`` applies one batch run in the dependency order of the warehouse
(staging -> customer states -> totals -> marts -> summaries) to the previous
run's tables and returns the new ones.  Each new table is saved before the next
step reads it, so a lost executor recomputes one step at most.  Steps fail
fast: an exception stops the chain (T23).

The cost of a run follows its batch:

* Staging tables are kept by event time (``PartTable``): web events by day,
  orders by month.  A run rewrites only the parts that its batch's keys fall in.
  A resent order may be in another part; the parts' key ranges and Bloom filters
  (``key_index``) tell which, so the keys of all history aren't read.
* Customer states by day (``operators.states``) are made anew for those parts
  only, and the difference is added to the customers' totals.
* Totals, distinct pages and customer profiles are ``KeyedTable``: a run writes
  the rows it changes.
* The marts are views: what is relative to the run (recency, trailing 30 days,
  load times) is derived from the totals when they are read, at the run's time.
  So runs at different times equal one full run, and a run with one touched
  customer writes one customer's rows.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from funnelspark.functions.columns import as_timestamp
from funnelspark.operators import activity, marts, staging, states
from funnelspark.operators import incremental as inc
from funnelspark.plans import key_index
from funnelspark.plans.key_index import PartFilter
from funnelspark.plans.keyed_table import GONE, KEY, KeyedTable, ddl_of, key_of
from funnelspark.schemas import EPOCH_TIME, RECENT_DAYS
from funnelspark.session import list_names, scratch_path

ACTIVITY_TIMES = ("last_web_activity_timestamp", "last_purchase_timestamp")
#: Part of rows without an event time.
NO_PART = "none"


@dataclass(frozen=True)
class StagedKind:
    """What differs between the two kinds of events."""
    key: str
    time: str
    part_format: str
    sort_by: tuple[str, ...]
    stage: Callable
    states: Callable
    totals: tuple[str, ...]
    times: tuple[str, str]
    #: A key's rows always fall in one part (the event key holds the event time).
    part_fixed_by_key: bool

    def part(self, time: str | None = None):
        return F.coalesce(F.date_format(time or self.time, self.part_format), F.lit(NO_PART)).alias("_part")


KINDS = {
    "web": StagedKind("event_id", "event_timestamp_utc", "yyyy-MM-dd",
                      ("customer_id", "event_timestamp_utc"), staging.stg_website_events,
                      states.web_states, states.WEB_TOTALS, states.WEB_TIMES, True),
    "purchases": StagedKind("order_id", "order_purchase_timestamp_utc", "yyyy-MM", ("order_id",),
                            staging.stg_purchase_events, states.purchase_states,
                            states.PURCHASE_TOTALS, states.PURCHASE_TIMES, False),
}


@dataclass(frozen=True)
class PartTable:
    """A table as one folder for each part (part -> path), with filters of the parts' keys
    where keys are looked up."""
    spark: SparkSession
    schema: str
    parts: dict[str, str] = field(default_factory=dict)
    index: dict[str, PartFilter] = field(default_factory=dict)

    def read(self, parts=None) -> DataFrame:
        """The rows of all or some parts; the folders of others are not opened."""
        paths = [p for d, p in sorted(self.parts.items()) if parts is None or d in parts]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def since(self, day: str) -> DataFrame:
        """The parts that can hold rows of ``day`` (yyyy-MM-dd) or later."""
        return self.read({p for p in self.parts if p != NO_PART and p >= day[:len(p)]})

    def with_parts(self, new: dict[str, str], changed: set[str], index=None) -> PartTable:
        """The table with the parts ``changed`` replaced by ``new``."""
        keep = lambda held, fresh: {p: x for p, x in held.items() if p not in changed} | fresh
        return replace(self, parts=keep(self.parts, new), index=keep(self.index, index or {}))

    def changed_since(self, before: PartTable | None) -> set[str]:
        """Parts whose rows are not those of ``before``."""
        old = before.parts if before else {}
        return {p for p in self.parts.keys() | old.keys() if self.parts.get(p) != old.get(p)}


class Store:
    """Writes the tables of one run, each to a new place under ``base``."""

    def __init__(self, spark: SparkSession, base: str | None = None, buckets: int | None = None):
        """``buckets``: of keyed tables made by this run (by default the shuffle partitions)."""
        self.spark = spark
        self.buckets = buckets
        self.base = base or scratch_path(spark, "model-run")
        self.paths: dict[str, str] = {}

    def new_path(self, name: str) -> str:
        return f"{self.base}/{name}-{uuid.uuid4().hex[:8]}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        path = self.new_path(name)
        df.write.parquet(path)
        self.paths[name] = path
        return self.spark.read.schema(df.schema).parquet(path)

    def save_parts(self, df: DataFrame, part, sort_by, name: str) -> dict[str, str]:
        """One folder for each part, its files in the order of the table's key (S21).  Rows are
        moved by part, and AQE splits large parts into several files and joins small ones in a
        task, by measured size: ``df`` is computed once, not also for a sample."""
        path = self.new_path(name)
        df.withColumn("_part", part).hint("rebalance", "_part") \
            .sortWithinPartitions("_part", *sort_by).write.partitionBy("_part").parquet(path)
        return {n[6:]: f"{path}/{n}" for n in list_names(self.spark, path) if n.startswith("_part=")}


@dataclass(frozen=True)
class KindRun:
    """One kind's tables after a run: staging, states by day, and the customers' totals; for web
    events also the pages seen by day and on how many days each was.  The reference's runs have
    staging only."""
    stg: PartTable
    mark: str
    states: PartTable | None = None
    totals: KeyedTable | None = None
    page_states: PartTable | None = None
    pages: KeyedTable | None = None


@dataclass(frozen=True)
class Models:
    """The tables of a run; the marts hold values at the run's time."""
    web: KindRun | None = None
    orders: KindRun | None = None
    customers: KeyedTable | None = None
    web_activity: DataFrame | None = None
    purchases: DataFrame | None = None
    funnel: DataFrame | None = None
    profiles: DataFrame | None = None
    country_history: DataFrame | None = None
    monthly_history: DataFrame | None = None

    @property
    def stg_web(self) -> PartTable | None:
        return self.web and self.web.stg

    @property
    def stg_purchases(self) -> PartTable | None:
        return self.orders and self.orders.stg


# ---------------------------------------------------------------- staging
def _indexed(store: Store, k: StagedKind, parts: dict[str, str], schema: str) -> dict[str, PartFilter]:
    if k.part_fixed_by_key or not parts:
        return {}
    rows = PartTable(store.spark, schema, parts).read().select(k.key, k.part(k.time))
    return key_index.build(rows, k.key, "_part", store.new_path("key-index"))


def parts_of_keys(table: PartTable, keys: DataFrame, k: StagedKind, known: set[str]) -> set[str]:
    """The parts outside ``known`` that hold one of ``keys`` (column ``k.key``)."""
    others = {p: f for p, f in table.index.items() if p not in known}
    asked = key_index.answering(table.spark, others, keys, k.key)
    asked |= table.parts.keys() - table.index.keys() - known
    if keys.where(F.col(k.key).isNull()).limit(1).count():   # NULL keys are in no filter
        asked = table.parts.keys() - known
    if not asked:
        return set()
    where = table.read(asked).select(k.key, k.time)
    return {r._part for r in inc.replaced_rows(where, keys, [k.key]).select(k.part()).distinct().collect()}


def stage_increment(prev: PartTable | None, raw: DataFrame, as_of, *, kind: str, store: Store,
                    mark: str | None = None, replace_only: bool = False
                    ) -> tuple[PartTable, DataFrame, str]:
    """One staging run (M1/M2, M7, M10): returns (table, touched customers, new mark).

    The batch is the raw rows landed after the ingestion-time mark (all rows on
    the first run).  The stored rows with the batch's keys and the batch are
    deduplicated together, so an older resend doesn't replace a newer row;
    ``replace_only`` lets the batch replace them as the reference does.
    """
    k = KINDS[kind]
    if prev is not None:
        raw = inc.after_mark(raw, "_processed_at", mark or EPOCH_TIME)
    staged = k.stage(raw, as_of)
    new_mark = lambda rows: max(mark or EPOCH_TIME, inc.high_water_mark(
        rows, "stream_processed_at_utc", mark or EPOCH_TIME))
    if prev is None:   # the batch is the table
        parts = store.save_parts(staged, k.part(), k.sort_by, f"stg-{kind}")
        table = PartTable(store.spark, ddl_of(staged), parts)
        rows = table.read()
        return (replace(table, index=_indexed(store, k, parts, table.schema)),
                rows.select("customer_id").distinct(), new_mark(rows))

    batch = store.save(staged, f"{kind}-batch")
    mark = new_mark(batch)
    keys = batch.select(k.key).distinct()
    changed = {r._part for r in batch.select(k.part()).distinct().collect()}
    if not k.part_fixed_by_key:  # a resent order may be in another part
        changed |= parts_of_keys(prev, keys, k, changed)
    old = prev.read(changed)
    touched = store.save(inc.touched_customers(batch, inc.replaced_rows(old, keys, [k.key])),
                         f"{kind}-touched")
    if replace_only:
        merged = inc.upsert(old, batch, [k.key])
    else:
        merged = staging.latest_per_key(old.unionByName(batch.select(*old.columns)), [k.key],
                                        [k.time, "stream_processed_at_utc"])
    new = store.save_parts(merged, k.part(), k.sort_by, f"stg-{kind}")
    return prev.with_parts(new, changed, _indexed(store, k, new, prev.schema)), touched, mark


# ---------------------------------------------------------------- states, totals
def _state_table(store: Store, prev: PartTable | None, made: DataFrame, k: StagedKind,
                 changed: set[str], name: str) -> PartTable:
    """The states of the changed parts, beside those of the others as they were."""
    prev = prev or PartTable(store.spark, ddl_of(made))
    new = store.save_parts(made, k.part("day"), ("customer_id", "day"), name)
    return prev.with_parts(new, changed)


def _of(df: DataFrame, customers: DataFrame, spread_by: str = "day") -> DataFrame:
    return inc.restrict_to(df, customers, spread_by)


def _page_counts(prev: KindRun | None, pages_by_day: PartTable, changed: set[str], touched: DataFrame,
                 store: Store) -> tuple[KeyedTable, DataFrame]:
    """The pages table with the changes of a run, and by how many pages each customer's
    distinct pages grow."""
    now = _of(pages_by_day.read(changed), touched, "page_url") if prev else pages_by_day.read()
    before = _of(prev.page_states.read(changed), touched, "page_url") if prev else now.limit(0)
    changes = states.page_changes(before, now)
    table = prev.pages if prev else KeyedTable.new(
        changes.select("customer_id", "page_url", "days"), ("customer_id", "page_url"), store.buckets)
    rows = store.save(table.look_up(changes, ["days"]).select(
        "customer_id", "page_url", F.coalesce("old_days", F.lit(0)).alias("was"),
        (F.coalesce("old_days", F.lit(0)) + F.col("days")).alias("days")), "page-changes")
    seen = lambda c: F.when(F.col(c) > 0, 1).otherwise(0)
    grown = rows.groupBy("customer_id").agg(F.sum(seen("days") - seen("was")).cast("bigint").alias("pages"))
    return table.apply(store, "pages", rows.drop("was"), F.col("days") <= 0), grown


def totals_increment(prev: KindRun | None, now: PartTable, changed: set[str], touched: DataFrame, *,
                     kind: str, store: Store, pages: DataFrame | None = None) -> KeyedTable:
    """Customers' totals (M3) after a run: the difference of the touched customers' states in
    the changed parts (``now``: all states) is added to the stored totals."""
    k = KINDS[kind]
    after = _of(now.read(changed), touched) if prev else now.read()
    before = _of(prev.states.read(changed), touched) if prev else after.limit(0)
    found = states.difference(before, after, k.totals, k.times)
    columns = [*k.totals, *k.times]
    if pages is not None:
        grown = pages.select(F.col("customer_id").alias("_c"), "pages")
        found = found.join(grown, F.col("customer_id").eqNullSafe(F.col("_c")), "left").drop("_c")
        columns.append("unique_pages_visited")
    if prev:
        found = prev.totals.look_up(found, columns)
    else:
        found = found.select("*", *[F.lit(None).cast(found.schema[c].dataType if c in found.columns else "bigint")
                                    .alias("old_" + c) for c in columns])
    if pages is not None:
        found = found.withColumn("new_pages", F.coalesce("old_unique_pages_visited", F.lit(0))
                                 + F.coalesce("pages", F.lit(0)))
    added = states.add(found, k.totals, k.times, ["new_pages"] if pages is not None else [])
    if pages is not None:
        added = added.withColumnRenamed("new_pages", "unique_pages_visited")
    added = store.save(added, f"{kind}-changed")
    lost = added.where("lost").select("customer_id")
    if prev and lost.limit(1).count():   # first and last times of these from all their states
        whole = states.totals_of(_of(now.read(), lost), (), k.times).select(
            F.col("customer_id").alias("_c"), *[F.col(c).alias("all_" + c) for c in k.times])
        added = added.join(whole, F.col("customer_id").eqNullSafe(F.col("_c")), "left").withColumns(
            {c: F.when(F.col("lost"), F.col("all_" + c)).otherwise(F.col(c)) for c in k.times})
    rows = added.select("customer_id", *columns)
    table = prev.totals if prev else KeyedTable.new(rows, ("customer_id",), store.buckets)
    return table.apply(store, f"{kind}-totals", rows, F.col(k.totals[0]) <= 0)


def kind_increment(prev: KindRun | None, raw: DataFrame, as_of, *, kind: str, store: Store) -> KindRun:
    """One kind's run: staging, the states of its changed parts, the totals."""
    k = KINDS[kind]
    stg, touched, mark = stage_increment(prev and prev.stg, raw, as_of, kind=kind, store=store,
                                         mark=prev and prev.mark)
    changed = stg.changed_since(prev and prev.stg)
    by_day = _state_table(store, prev and prev.states, k.states(stg.read(changed)), k, changed,
                          f"{kind}-states")
    page_states = pages = grown = None
    if kind == "web":
        page_states = _state_table(store, prev and prev.page_states, states.page_states(stg.read(changed)),
                                   k, changed, "page-states")
        pages, grown = _page_counts(prev, page_states, changed, touched, store)
    totals = totals_increment(prev, by_day, changed, touched, kind=kind, store=store, pages=grown)
    return KindRun(stg, mark, by_day, totals, page_states, pages)


def customers_increment(prev: KeyedTable | None, profile_file: DataFrame, as_of, store: Store) -> KeyedTable:
    """The profiles of the file (S12), of which only new, changed and missing ones are written.  A
    customer that the file has several times counts once, with the greatest row."""
    file = staging.stg_customers(profile_file, as_of).drop("loaded_at")
    columns = file.columns
    one = file.groupBy(key_of(["customer_id"]).alias(KEY)).agg(F.max(F.struct(*columns)).alias("now"))
    table = prev or KeyedTable.new(file, ("customer_id",), store.buckets)
    held = table.keyed().select(KEY, F.struct(*columns).alias("was"))
    differs = one.join(held, KEY, "full_outer").where(~F.col("now").eqNullSafe(F.col("was")))
    changes = differs.select(F.coalesce("now", "was").alias("x"), F.col("now").isNull().alias(GONE)) \
        .select("x.*", GONE)
    return table.apply(store, "customers", changes, F.col(GONE))


# ---------------------------------------------------------------- values at a time
def _window_start(as_of) -> dt.datetime:
    now = as_of if isinstance(as_of, dt.datetime) else dt.datetime.fromisoformat(str(as_of))
    return now - dt.timedelta(days=RECENT_DAYS)


def web_of_run(run: KindRun, as_of) -> DataFrame:
    return activity.web_at(run.totals.read(), as_of)


def purchases_of_run(run: KindRun, as_of) -> DataFrame:
    """Purchases per customer at ``as_of``; the trailing window is read from the states of its
    days, and from staging only for the day that it begins in."""
    start = _window_start(as_of)
    first = start.strftime("%Y-%m-%d")
    edge = None if start.time() == dt.time() else run.stg.read({first[:7]})
    recent = states.recent_from_states(run.states.since(first), edge, as_of)
    return activity.purchases_at(states.purchase_values(run.totals.read()), recent, as_of)


def with_marts(models: Models, as_of) -> Models:
    """The marts as views of the totals at a time (M4, A12, C7): nothing is stored."""
    web, purchases = web_of_run(models.web, as_of), purchases_of_run(models.orders, as_of)
    customers = models.customers.read().withColumn("loaded_at", as_timestamp(as_of))
    return replace(models, web_activity=web, purchases=purchases,
                   funnel=marts.marketing_funnel(web, purchases, as_of),
                   profiles=marts.profiles_from_activity(customers, web, purchases, as_of))


# ---------------------------------------------------------------- the reference's runs
def replace_batch(prev: DataFrame | None, stg: DataFrame, as_of, *, kind: str) -> DataFrame:
    """The reference's aggregate run (M3, M8, T5, T6): rows past the global event-time
    mark are aggregated alone and replace the customer's row."""
    agg, last = ((activity.web_activity, ACTIVITY_TIMES[0]) if kind == "web" else
                 (activity.purchase_activity, ACTIVITY_TIMES[1]))
    if prev is None:
        return agg(stg, as_of)
    fresh = inc.after_mark(stg, KINDS[kind].time, inc.high_water_mark(prev, last))
    return inc.upsert(prev, agg(fresh, as_of), ["customer_id"])


def past_mark(prev: DataFrame | None, fresh: DataFrame) -> DataFrame:
    """The reference's mart run (M4, M9, P10): rows whose greatest activity is past that
    of the whole target replace the target's."""
    if prev is None:
        return fresh
    mark = inc.greatest_activity_mark(prev, ACTIVITY_TIMES)
    return inc.upsert(prev, inc.past_activity_mark(fresh, ACTIVITY_TIMES, mark), ["customer_id"])


def _replaced_marts(prev: Models, web: KindRun, orders: KindRun, profile_file: DataFrame, as_of,
                    store: Store) -> Models:
    web_rows, rows = at_once(
        lambda: store.save(replace_batch(prev.web_activity, web.stg.read(), as_of, kind="web"), "web_activity"),
        lambda: store.save(replace_batch(prev.purchases, orders.stg.read(), as_of, kind="purchases"), "purchases"))
    funnel = store.save(past_mark(prev.funnel, marts.marketing_funnel(web_rows, rows, as_of)), "funnel")
    customers = staging.stg_customers(profile_file, as_of)
    profiles = store.save(past_mark(prev.profiles, marts.profiles_ml(customers, funnel, as_of)), "profiles")
    return replace(prev, web=web, orders=orders, web_activity=web_rows, purchases=rows, funnel=funnel,
                   profiles=profiles)


def at_once(*steps: Callable) -> list:
    """The results of steps that don't depend on each other, whose jobs share the cluster; the
    first failure is raised when all have ended."""
    with ThreadPoolExecutor(len(steps)) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(step)) for step in steps]]


def run_models(prev: Models | None, raw_web: DataFrame, raw_purchases: DataFrame,
               profile_file: DataFrame, as_of, *, mode: str = "touched",
               store: Store | None = None) -> Models:
    """One scheduled batch run over all models in dependency order."""
    if mode not in ("touched", "replace_batch"):
        raise ValueError(f"unknown mode {mode!r}")
    prev = prev or Models()
    store = store or Store(raw_web.sparkSession)
    if mode == "replace_batch":
        def staged(kind: str, raw: DataFrame, before: KindRun | None) -> KindRun:
            stg, _, mark = stage_increment(before and before.stg, raw, as_of, kind=kind, store=store,
                                           mark=before and before.mark, replace_only=True)
            return KindRun(stg, mark)

        web, orders = at_once(lambda: staged("web", raw_web, prev.web),
                              lambda: staged("purchases", raw_purchases, prev.orders))
        models = _replaced_marts(prev, web, orders, profile_file, as_of, store)
    else:
        web, orders, customers = at_once(
            lambda: kind_increment(prev.web, raw_web, as_of, kind="web", store=store),
            lambda: kind_increment(prev.orders, raw_purchases, as_of, kind="purchases", store=store),
            lambda: customers_increment(prev.customers, profile_file, as_of, store))
        models = with_marts(replace(prev, web=web, orders=orders, customers=customers), as_of)
    # Both summaries read the profiles, which the reference's runs have stored; the snapshots
    # are small and appended as they are.
    profiles = models.profiles if mode == "replace_batch" else models.profiles.persist()
    try:
        country = store.save(marts.country_summary(profiles, as_of), "country_snapshot")
        monthly = store.save(marts.monthly_summary(profiles, as_of), "monthly_snapshot")
    finally:
        if profiles.is_cached:
            profiles.unpersist()
    return replace(models, country_history=marts.append_snapshot(prev.country_history, country),
                   monthly_history=marts.append_snapshot(prev.monthly_history, monthly))
