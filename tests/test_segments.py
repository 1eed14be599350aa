
import datetime as dt

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from funnelspark.operators import reports, segments
from funnelspark.plans import feeds
from funnelspark.session import materialize
from funnelspark.sources import lake

from .conftest import SF_SMALL


def test_feature_list_drops_missing_names(spark):
    prof = feeds.profiles(spark, SF_SMALL)
    present, dropped = segments.feature_columns(prof)
    assert dropped == ["delivered_orders", "canceled_orders", "unique_sessions"]
    assert len(present) == 18


def _cluster(spark, prof, when="2024-02-01 00:00:00", **options):
    """(assignments, log rows) of one clustering."""
    rows = []
    got = segments.cluster_customers(spark, prof, when, lambda *r: rows.append(r), **options)
    return got, rows


def test_clusters_invariants_and_same_seed_same_result(spark, tmp_dir):
    prof = materialize(feeds.profiles(spark, SF_SMALL))
    a1, log = _cluster(spark, prof)
    a2, _ = _cluster(spark, prof)
    r1 = {r["customer_id"]: r["cluster"] for r in a1.collect()}
    r2 = {r["customer_id"]: r["cluster"] for r in a2.collect()}
    assert len(r1) == prof.count() == a1.count()                 # each customer once
    assert set(r1.values()) == {0, 1, 2}                          # k labels
    assert r1 == r2                                               # same seed, same result
    spend = (a1.join(prof, "customer_id").groupBy("cluster")
             .agg(F.avg("total_spend_usd").alias("m")).orderBy("cluster").collect())
    assert [r["m"] for r in spend] == sorted(r["m"] for r in spend)   # labels ordered by spend
    steps = {r["step"] for r in segments.monitor(segments.log_rows(spark, "2024-02-01 00:00:00", log)).collect()}
    assert steps == {"scaler_params", "pca_params", "kmeans_metrics"}


def test_each_customer_is_in_its_nearest_centroid(spark):
    prof = feeds.profiles(spark, SF_SMALL)
    features, _ = segments.feature_columns(prof)
    frame = segments.feature_frame(prof, features)
    model = segments.segmentation_pipeline(features).fit(frame)
    centers = np.array(model.stages[3].clusterCenters())
    pts = model.transform(frame).select(vector_to_array("pca2").alias("p"), "raw_cluster").collect()
    for r in pts:
        d = ((centers - np.array(r["p"])) ** 2).sum(axis=1)
        assert int(np.argmin(d)) == r["raw_cluster"]


def test_scaler_is_mean_and_sample_deviation(spark):
    prof = feeds.profiles(spark, SF_SMALL)
    features, _ = segments.feature_columns(prof)
    frame = segments.feature_frame(prof, features)
    model = segments.segmentation_pipeline(features).fit(frame)
    pdf = frame.toPandas()
    scaler = model.stages[1]
    assert np.allclose(scaler.mean.toArray(), pdf[features].mean().to_numpy())
    assert np.allclose(scaler.std.toArray(), pdf[features].std(ddof=1).to_numpy())


def test_model_rule_load_versus_retrain(spark, tmp_dir):
    prof = materialize(feeds.profiles(spark, SF_SMALL))
    path, day = f"{tmp_dir}/model", 86400
    steps = lambda **o: {s: m for s, _, m in _cluster(spark, prof, model_path=path, **o)[1]}
    assert steps(now_s=0)["model_train"].startswith("model_missing")
    assert "model_load" in steps(now_s=6.9 * day)
    assert steps(now_s=7.1 * day)["model_train"].startswith("model_stale")
    assert steps(now_s=8 * day, requested=("total_orders", "sessions", "total_spend_usd"))["model_train"] \
        .startswith("model_features_changed")
    newest = [n for n in segments.list_names(spark, path) if n.startswith("current-")][-1]
    with open(f"{path}/{newest}", "w") as f:
        f.write("{broken")
    assert steps(now_s=8 * day)["model_train"].startswith("model_broken")


def test_labels_stay_until_the_next_fit(spark, tmp_dir):
    prof = materialize(feeds.profiles(spark, SF_SMALL))
    path = f"{tmp_dir}/model"
    first = {r.customer_id: r.cluster for r in _cluster(spark, prof, model_path=path, now_s=0)[0].collect()}
    # means of the run's own data no longer follow the labels
    turned = prof.withColumn("total_spend_usd", F.lit(0).cast("decimal(20,2)"))
    again = {r.customer_id: r.cluster for r in _cluster(spark, prof, model_path=path, now_s=1)[0].collect()}
    assert first == again
    model = segments.load_model(spark, path)
    assert sorted(model.labels) == [0, 1, 2] and model.fitted_s == 0
    _cluster(spark, turned, model_path=path, now_s=2)
    assert segments.load_model(spark, path).labels == model.labels


def test_a_failing_step_leaves_an_error_row_and_the_old_tables(spark, tmp_dir):
    from funnelspark.plans import segment_job
    t = segment_job.SegmentTables(*(f"{tmp_dir}/{n}" for n in
                                    ("profiles", "clusters", "log", "history", "model")))
    prof = materialize(feeds.profiles(spark, SF_SMALL))
    segment_job.run_segmentation_job(spark, prof, t, "2024-01-20 00:00:00")
    before = sorted(map(tuple, lake.read_table(spark, t.clusters).collect()))
    broken = prof.withColumn("total_orders", F.expr("raise_error('lost')").cast("bigint"))
    try:
        segment_job.run_segmentation_job(spark, broken, t, "2024-02-01 00:00:00")
        raise AssertionError("the job should fail")
    except Exception as e:  # noqa: BLE001
        assert "lost" in str(e)
    log = segment_job.read_log(spark, t)
    assert [r.step for r in log.where("status = 'ERROR'").collect()] == ["publish_profiles"]
    assert sorted(map(tuple, lake.read_table(spark, t.clusters).collect())) == before
    # a retry of the same run date replaces its history rows
    segment_job.run_segmentation_job(spark, prof, t, "2024-02-01 00:00:00")
    segment_job.run_segmentation_job(spark, prof, t, "2024-02-01 00:00:00")
    hist = segment_job.read_history(spark, t)
    assert hist.count() == 6 and hist.select("cluster", "analysis_timestamp").distinct().count() == 6


def test_cluster_history_diffs_and_text(spark):
    T = dt.datetime
    rows = [  # 2 clusters x 3 runs; cluster 1 misses the middle run; one metric unchanged
        (0, 10.0, 100.0, 5.0, 3.0, 50, T(2024, 1, 1)),
        (0, 12.5, 100.0, 4.0, 3.0, 1250, T(2024, 1, 2)),
        (0, 12.0, 90.0, 4.5, 3.0, 1200, T(2024, 1, 3)),
        (1, 1.0, 10.0, 1.0, 2.0, 7, T(2024, 1, 1)),
        (1, 1.0, 10.0, 1.0, 2.0, 7, T(2024, 1, 3)),
    ]
    hist = spark.createDataFrame(rows, "cluster int, avg_total_spend_usd double, "
                                 "avg_avg_order_value_usd double, avg_days_since_last_purchase "
                                 "double, avg_days_since_last_web_activity double, "
                                 "rows_in_cluster bigint, analysis_timestamp timestamp")
    diffs = {(r["cluster"], r["analysis_timestamp"].day): r
             for r in reports.cluster_diffs(hist).collect()}
    assert sorted(diffs) == [(0, 2), (0, 3), (1, 3)]
    assert diffs[(0, 2)]["rows_in_cluster"] == 1200
    assert float(diffs[(0, 3)]["avg_total_spend_usd"]) == -0.5
    text = {(r["cluster"], r["analysis_timestamp"].day): r
            for r in reports.cluster_insights(reports.cluster_diffs(hist)).collect()}
    assert text[(0, 2)]["population_text"] == "Cluster 0 grew by 1,200 members."
    assert text[(0, 2)]["spend_text"] == ("Average spend increased by $2.50000 "
                                          "(AOV change: $0.00000).")
    assert text[(0, 2)]["recency_text"] == ("Customers purchased more recently "
                                            "(-1.00000 days sooner).")
    assert text[(0, 3)]["population_text"] == "Cluster 0 shrank by 50 members."
    assert text[(1, 3)]["population_text"] == "Cluster 1 population remained stable."
    assert text[(1, 3)]["web_text"] == "Web activity unchanged."
    assert text[(0, 2)]["insight"].startswith("📊 **Cluster 0 Insights**\n- Cluster 0 grew")
    trends = reports.cluster_trends(hist)
    assert trends.count() == 5 * 5
    first = trends.filter("cluster = 0 and day(analysis_timestamp) = 1").collect()
    assert all(r["diff"] is None and r["direction"] is None for r in first)
    down = trends.filter("cluster = 0 and day(analysis_timestamp) = 3 and "
                         "metric = 'avg_total_spend_usd'").collect()[0]
    assert down["direction"] == "down"


def test_segmentation_job_tables(spark, tmp_dir):
    from funnelspark.plans import segment_job
    t = segment_job.SegmentTables(*(f"{tmp_dir}/{n}" for n in
                                    ("profiles", "clusters", "log", "history", "model")))
    prof = feeds.profiles(spark, SF_SMALL)
    segment_job.run_segmentation_job(spark, prof, t, "2024-01-20 00:00:00")
    segment_job.run_segmentation_job(spark, prof, t, "2024-02-01 00:00:00")
    hist = segment_job.read_history(spark, t)
    assert hist.count() == 6 and hist.select("analysis_timestamp").distinct().count() == 2
    clusters = lake.read_table(spark, t.clusters)
    assert clusters.count() == prof.count()
    assert clusters.select("run_date").distinct().collect()[0][0] == dt.datetime(2024, 2, 1)
    log = segment_job.read_log(spark, t)
    steps = [r["step"] for r in log.collect()]
    assert steps.count("model_train") == 1 and steps.count("model_load") == 1
    newest = segments.monitor(log).collect()
    assert len(newest) == 3 and newest[0]["run_date"] == dt.datetime(2024, 1, 20)
