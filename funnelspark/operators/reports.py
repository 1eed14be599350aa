"""Reports over the cluster-profile history.

The history holds one row per (cluster, analysis run).  Differences between
consecutive runs are a ``lag`` over a window per cluster ordered by run time;
the long-form trend data is an ``unpivot``; the insight sentences are built
with ``when`` and string formatting, all on executors.

Differences are exact: metrics are taken as decimal(38,6) (the profile means
are rounded to 6 places) before subtracting, and sentences show them rounded
half-up to 5 places.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEYS = ("cluster", "analysis_timestamp")
DIFF_TYPE = "decimal(38,6)"

# ---------------------------------------------------------------------------
# The insight sentence templates (must read as the reference's).
# ---------------------------------------------------------------------------
HEADER = "📊 **Cluster {c} Insights**"
GREW = "Cluster {c} grew by {n} members."
SHRANK = "Cluster {c} shrank by {n} members."
STABLE = "Cluster {c} population remained stable."
SPEND_UP = "Average spend increased by ${s} (AOV change: ${a})."
SPEND_DOWN = "Average spend decreased by ${s} (AOV change: ${a})."
SPEND_SAME = "Average spend remained unchanged."
RECENCY_SOONER = "Customers purchased more recently ({r} days sooner)."
RECENCY_LATER = "Customers purchased less recently ({r} days later)."
RECENCY_SAME = "Purchase recency unchanged."
WEB_SOONER = "Web activity improved ({w} days sooner)."
WEB_LATER = "Web activity declined ({w} days later)."
WEB_SAME = "Web activity unchanged."


def metric_columns(history: DataFrame) -> list[str]:
    """All columns but the keys."""
    return [c for c in history.columns if c not in KEYS]


def cluster_diffs(history: DataFrame) -> DataFrame:
    """Change of every metric since the cluster's previous run; the first run of
    each cluster has no row (R1, W3, C20).  The window per cluster (A18) ordered
    by run time (O3) replaces a loop over the distinct cluster ids."""
    w = Window.partitionBy("cluster").orderBy("analysis_timestamp")
    metrics = metric_columns(history)
    diffs = [(F.col(m) - F.lag(m).over(w)).alias(m) if m == "rows_in_cluster" else
             (F.col(m).cast(DIFF_TYPE) - F.lag(F.col(m).cast(DIFF_TYPE)).over(w))
             .cast(DIFF_TYPE).alias(m) for m in metrics]
    return (history.select(*KEYS, *diffs, F.row_number().over(w).alias("_run"))
            .filter(F.col("_run") > 1).drop("_run"))


def cluster_trends(history: DataFrame) -> DataFrame:
    """Long form behind the trend charts (R2, R4, P14): one row per (cluster,
    run, metric) with the value, the change since the previous run (NULL on
    a cluster's first run) and whether it went down (the chart colour).  Value
    and change are unpivoted together, as one struct."""
    w = Window.partitionBy("cluster").orderBy("analysis_timestamp")
    metrics = metric_columns(history)

    def pair(m):
        exact = F.col(m).cast(DIFF_TYPE)
        return F.struct(F.col(m).cast("double").alias("value"),
                        (exact - F.lag(exact).over(w)).cast(DIFF_TYPE).alias("diff")).alias(m)
    out = history.select(*KEYS, *[pair(m) for m in metrics]) \
        .unpivot(list(KEYS), metrics, "metric", "x").select(*KEYS, "metric", "x.value", "x.diff")
    return out.withColumn("direction", F.when(F.col("diff") < 0, "down")
                          .when(F.col("diff").isNotNull(), "not_down"))


def _fmt5(c: Column) -> Column:
    return F.round(c.cast(DIFF_TYPE), 5).cast("string")


def _template(t: str, **parts: Column) -> Column:
    """Fill ``{name}`` slots of a fixed template with column values."""
    pieces: list[Column] = []
    rest = t
    while "{" in rest:
        head, tail = rest.split("{", 1)
        name, rest = tail.split("}", 1)
        if head:
            pieces.append(F.lit(head))
        pieces.append(parts[name])
    if rest:
        pieces.append(F.lit(rest))
    return F.concat(*pieces)


def cluster_insights(diffs: DataFrame) -> DataFrame:
    """One text per (cluster, run) describing the change since the previous run."""
    c = F.col("cluster").cast("string")
    n = F.col("rows_in_cluster")
    s, a = F.col("avg_total_spend_usd"), F.col("avg_avg_order_value_usd")
    r, w = F.col("avg_days_since_last_purchase"), F.col("avg_days_since_last_web_activity")
    count = F.format_number(F.abs(n), 0)
    pop = (F.when(n > 0, _template(GREW, c=c, n=count))
           .when(n < 0, _template(SHRANK, c=c, n=count))
           .otherwise(_template(STABLE, c=c)))
    spend = (F.when(s > 0, _template(SPEND_UP, s=_fmt5(s), a=_fmt5(a)))
             .when(s < 0, _template(SPEND_DOWN, s=_fmt5(F.abs(s)), a=_fmt5(a)))
             .otherwise(F.lit(SPEND_SAME)))
    recency = (F.when(r < 0, _template(RECENCY_SOONER, r=_fmt5(r)))
               .when(r > 0, _template(RECENCY_LATER, r=_fmt5(r)))
               .otherwise(F.lit(RECENCY_SAME)))
    web = (F.when(w < 0, _template(WEB_SOONER, w=_fmt5(w)))
           .when(w > 0, _template(WEB_LATER, w=_fmt5(w)))
           .otherwise(F.lit(WEB_SAME)))
    out = diffs.select(*KEYS, pop.alias("population_text"), spend.alias("spend_text"),
                       recency.alias("recency_text"), web.alias("web_text"))
    bullet = [F.concat(F.lit("- "), F.col(x)) for x in
              ("population_text", "spend_text", "recency_text", "web_text")]
    return out.withColumn("insight", F.concat_ws("\n", _template(HEADER, c=c), *bullet))
