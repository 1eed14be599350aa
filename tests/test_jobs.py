"""Scheduled runs through the run store: incremental runs across 'processes'
equal one full run; an uncommitted run is ignored."""

import pytest
from pyspark.sql import functions as F

from funnelspark.plans import feeds, jobs, model_runs, warehouse
from funnelspark.sources import tables

from .conftest import SF_SMALL


def _landed(spark, tmp_dir, cutoff=None):
    raw_w, raw_p = feeds.raw_web(spark, SF_SMALL), feeds.raw_purchases(spark, SF_SMALL)
    if cutoff:
        raw_w, raw_p = feeds.processed_until(raw_w, cutoff), feeds.processed_until(raw_p, cutoff)
    tag = cutoff.replace(" ", "_").replace(":", "") if cutoff else "all"
    paths = [f"{tmp_dir}/{n}-{tag}" for n in ("web", "purchases", "profiles")]
    raw_w.write.parquet(paths[0])
    raw_p.write.parquet(paths[1])
    tables.customer_profiles(spark, SF_SMALL).write.mode("overwrite").parquet(paths[2])
    return paths


def _same(got, want, key="customer_id"):
    want = want.select(*got.columns)
    assert got.count() == want.count() and got.exceptAll(want).count() == 0


def test_runs_through_the_store_equal_a_full_run(spark, tmp_dir):
    root = f"{tmp_dir}/warehouse"
    jobs.batch_job(spark, *_landed(spark, tmp_dir, "2024-01-16 00:00:00"), root,
                   "2024-01-16 00:00:00")
    # a later run that crashed after writing some tables but before its manifest
    spark.range(1).write.parquet(f"{root}/run=20240120T000000/attempt/web-batch-1")
    landed = _landed(spark, tmp_dir)
    jobs.batch_job(spark, *landed, root, feeds.AS_OF)
    assert warehouse.committed_runs(spark, root) == ["20240116T000000", "20240201T000000"]
    _same(warehouse.load_models(spark, root).funnel, feeds.funnel(spark, SF_SMALL))
    # the same run again (a retry after its commit): nothing is lost or doubled
    jobs.batch_job(spark, *landed, root, feeds.AS_OF)
    models = warehouse.load_models(spark, root)
    assert warehouse.committed_runs(spark, root) == ["20240116T000000", "20240201T000000"]
    _same(models.funnel, feeds.funnel(spark, SF_SMALL))
    _same(models.stg_web.read(), feeds.stg_web(spark, SF_SMALL).drop("dbt_loaded_at")
          .join(models.stg_web.read().select("event_id", "dbt_loaded_at"), "event_id"))
    assert models.country_history.select("mart_loaded_at").distinct().count() == 2
    assert models.country_history.where(F.col("mart_loaded_at") == F.lit(feeds.AS_OF)).count() == \
        feeds.profiles(spark, SF_SMALL).select("customer_country", "customer_subscription_tier",
                                               "customer_acquisition_channel").distinct().count()
    # tables that no manifest names go, the others stay readable
    gone = warehouse.expire(spark, root, keep=1)
    assert any("attempt/web-batch-1" in p for p in gone)
    _same(warehouse.load_models(spark, root).funnel, feeds.funnel(spark, SF_SMALL))
    with pytest.raises(ValueError, match="older run"):
        jobs.batch_job(spark, *landed, root, "2024-01-20 00:00:00")
    t = jobs.segment_tables(f"{tmp_dir}/lake")
    jobs.segment_job_run(spark, root, f"{tmp_dir}/lake", feeds.AS_OF)
    assert spark.read.parquet(t.history).count() == 3


@pytest.mark.parametrize("step", ["stg-purchases", "web-changed", "country_snapshot"])
def test_a_crash_after_any_step_leaves_the_committed_tables(spark, tmp_dir, monkeypatch, step):
    root, early = f"{tmp_dir}/warehouse", "2024-01-16 00:00:00"
    jobs.batch_job(spark, *_landed(spark, tmp_dir, early), root, early)
    want = sorted(map(str, warehouse.load_models(spark, root).profiles.collect()))
    landed = _landed(spark, tmp_dir)
    for method in ("save", "save_parts"):
        whole = getattr(model_runs.Store, method)

        def failing(self, df, *args, whole=whole):
            out = whole(self, df, *args)
            if args[-1] == step:
                raise RuntimeError("executor lost")
            return out
        monkeypatch.setattr(model_runs.Store, method, failing)
    for as_of in (early, feeds.AS_OF):
        with pytest.raises(RuntimeError, match="executor lost"):
            jobs.batch_job(spark, *landed, root, as_of)
        assert sorted(map(str, warehouse.load_models(spark, root).profiles.collect())) == want
    monkeypatch.undo()
    jobs.batch_job(spark, *landed, root, feeds.AS_OF)
    _same(warehouse.load_models(spark, root).profiles, feeds.profiles(spark, SF_SMALL))


def test_a_file_is_published_once_and_whole(spark, tmp_dir):
    from funnelspark.session import list_names, publish_text, read_text
    publish_text(spark, f"{tmp_dir}/m/a.json", "one\ntwo")
    with pytest.raises(FileExistsError):
        publish_text(spark, f"{tmp_dir}/m/a.json", "three")
    assert read_text(spark, f"{tmp_dir}/m/a.json") == "one\ntwo"
    assert [n for n in list_names(spark, f"{tmp_dir}/m") if not n.startswith(".")] == ["a.json"]


def test_command_line_batch_and_segment(spark, tmp_dir):
    web, purchases, profiles = _landed(spark, tmp_dir, "2024-01-20 00:00:00")
    root, lake = f"{tmp_dir}/wh", f"{tmp_dir}/lake"
    jobs.main(["batch", "--web", web, "--purchases", purchases, "--profiles", profiles,
               "--root", root, "--as-of", "2024-01-20 00:00:00", "--keep", "1"])
    assert warehouse.committed_runs(spark, root) == ["20240120T000000"]
    jobs.main(["segment", "--root", root, "--tables", lake, "--as-of", "2024-01-20 00:00:00"])
    from funnelspark.sources import lake as tables_of
    assert tables_of.read_table(spark, jobs.segment_tables(lake).clusters).count() == \
        warehouse.load_models(spark, root).profiles.count()
