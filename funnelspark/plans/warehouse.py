"""Model tables kept between scheduled runs (M10, M11 across processes).

An attempt of a run writes its tables under ``<root>/run=<id>/<attempt>`` (new
folders; nothing is ever overwritten) and publishes one manifest file in
``<root>/_committed`` last, by an atomic rename.  The manifest names every
table, part folder, level, key filter and high-water mark.  Readers take the newest manifest, so a
run that failed half-way is invisible.

A run at the time of the newest committed run replaces it: it starts from the
run before and its manifest supersedes the old one when it is published, not
earlier.  A run at an older time is refused.  ``expire`` deletes the tables
that the newest manifests don't name.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from dataclasses import replace

from pyspark.sql import SparkSession

from funnelspark.plans.key_index import PartFilter
from funnelspark.plans.keyed_table import KeyedTable
from funnelspark.plans.model_runs import KindRun, Models, PartTable, Store, with_marts
from funnelspark.session import delete_path, list_names, publish_text, read_text

#: Marts that the reference's runs store; other runs derive them.
TABLES = ("web_activity", "purchases", "funnel", "profiles")
KIND_FIELDS = ("web", "orders")
PART_TABLES, KEYED_TABLES = ("stg", "states", "page_states"), ("totals", "pages")
SNAPSHOTS = {"country_history": "country_snapshot", "monthly_history": "monthly_snapshot"}
COMMITTED = "_committed"


def run_id(as_of) -> str:
    t = as_of if isinstance(as_of, dt.datetime) else dt.datetime.fromisoformat(str(as_of))
    return t.strftime("%Y%m%dT%H%M%S")


def _manifests(spark: SparkSession, root: str) -> list[tuple[str, int]]:
    """(run, attempt number) of every published manifest, oldest first."""
    names = [n[:-5] for n in list_names(spark, f"{root}/{COMMITTED}") if n.endswith(".json")]
    return sorted((n.rsplit("-", 1)[0], int(n.rsplit("-", 1)[1])) for n in names)


def _manifest(spark: SparkSession, root: str, run: str, attempt: int) -> dict:
    return json.loads(read_text(spark, f"{root}/{COMMITTED}/{run}-{attempt:06d}.json"))


def committed_runs(spark: SparkSession, root: str) -> list[str]:
    """Ids of the committed runs, oldest first."""
    return sorted({r for r, _ in _manifests(spark, root)})


def _current(spark: SparkSession, root: str, before: str | None) -> list[dict]:
    """The valid manifest of each run (its last attempt), oldest first."""
    last = {r: a for r, a in _manifests(spark, root) if before is None or r < before}
    return [_manifest(spark, root, r, a) for r, a in sorted(last.items())]


def load_models(spark: SparkSession, root: str, before=None) -> Models | None:
    """Tables of the newest committed run (``None`` before the first run), or of the
    newest one older than the time ``before``."""
    runs = _current(spark, root, run_id(before) if before is not None else None)
    if not runs:
        return None
    newest = runs[-1]
    tables = {n: spark.read.parquet(p) for n, p in newest["tables"].items() if n in TABLES}
    kinds = {n: _kind_run(spark, newest["kinds"][n]) for n in KIND_FIELDS}
    history = {k: spark.read.parquet(*[m["tables"][v] for m in runs]) for k, v in SNAPSHOTS.items()}
    models = Models(**tables, **kinds, **history)
    if newest["customers"] is None:
        return models
    customers = KeyedTable.from_manifest(spark, newest["customers"])
    return with_marts(replace(models, customers=customers), newest["as_of"])


def _kind_manifest(run: KindRun) -> dict:
    parts = {n: getattr(run, n) for n in PART_TABLES}
    keyed = {n: getattr(run, n) for n in KEYED_TABLES}
    return {"mark": run.mark,
            "parts": {n: {"schema": t.schema, "parts": t.parts,
                          "index": {p: f.manifest() for p, f in t.index.items()}}
                      for n, t in parts.items() if t is not None},
            "keyed": {n: t.manifest() for n, t in keyed.items() if t is not None}}


def _kind_run(spark: SparkSession, held: dict) -> KindRun:
    parts = {n: PartTable(spark, t["schema"], t["parts"], {p: PartFilter(**f) for p, f in t["index"].items()})
             for n, t in held["parts"].items()}
    keyed = {n: KeyedTable.from_manifest(spark, t) for n, t in held["keyed"].items()}
    return KindRun(mark=held["mark"], **parts, **keyed)


def _paths(manifest: dict) -> set[str]:
    """Every path that a manifest names."""
    out = set(manifest["tables"].values())
    keyed = [manifest["customers"]] if manifest["customers"] else []
    for kind in manifest["kinds"].values():
        for t in kind["parts"].values():
            out |= set(t["parts"].values()) | {f["path"] for f in t["index"].values()}
        keyed += kind["keyed"].values()
    return out | {path for t in keyed for path, _ in t["levels"]}


def new_store(spark: SparkSession, root: str, as_of) -> Store:
    """A store for one attempt of a run."""
    return Store(spark, f"{root}/run={run_id(as_of)}/{uuid.uuid4().hex}")


def check_time(spark: SparkSession, root: str, as_of) -> None:
    runs = committed_runs(spark, root)
    if runs and run_id(as_of) < runs[-1]:
        raise ValueError(f"run {runs[-1]} is committed; an older run ({run_id(as_of)}) is refused")


def commit_models(spark: SparkSession, models: Models, root: str, as_of, store: Store) -> str:
    """Publish the manifest of an attempt whose tables ``store`` has written."""
    run = run_id(as_of)
    manifest = {
        "run": run, "as_of": str(as_of),
        "tables": {n: store.paths[n] for n in (*TABLES, *SNAPSHOTS.values()) if n in store.paths},
        "kinds": {n: _kind_manifest(getattr(models, n)) for n in KIND_FIELDS},
        "customers": models.customers.manifest() if models.customers else None}
    attempt = 1 + max((a for r, a in _manifests(spark, root) if r == run), default=0)
    publish_text(spark, f"{root}/{COMMITTED}/{run}-{attempt:06d}.json", json.dumps(manifest))
    return run


def expire(spark: SparkSession, root: str, keep: int = 3) -> list[str]:
    """Delete the folders of attempts that none of the newest ``keep`` runs reads
    (snapshots of all runs stay); returns what was deleted.  Not to be called while a
    run is being written."""
    runs = _current(spark, root, None)
    used = {m["tables"][v] for m in runs for v in SNAPSHOTS.values()}
    for m in runs[-keep:]:
        used |= _paths(m)
    gone = []
    for run in list_names(spark, root):
        for attempt in list_names(spark, f"{root}/{run}") if run.startswith("run=") else ():
            for table in list_names(spark, f"{root}/{run}/{attempt}"):
                path = f"{root}/{run}/{attempt}/{table}"
                if path not in used and not any(u.startswith(path + "/") for u in used):
                    delete_path(spark, path)
                    gone.append(path)
    return gone
