"""Series statistics and anomaly alerts (z, modified z, IQR, % change).

The statistics are the reference's own, kept literally (D12):
population stddev; "median" is the upper median ``sorted[n // 2]``;
"mad" is the *mean* absolute deviation from that median; quartiles are
``sorted[n // 4]`` and ``sorted[min(n - 1, 3n // 4)]``.

A series may be of any length: medians and quartiles come from
:mod:`adcredit.operators.order_stats`, the other statistics are partial sums, no task holds a
series. The statistics (one row a series) join its points; "previous" is found month by month.

``daily=True`` declares series of one point a day, like those of :func:`metrics.metric_series`. They are bounded
by the calendar, so windows over the series give the same in one pass over the input and without joins; more
than ``MAX_DAYS`` points (273 years) show that the declaration is wrong, and raise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adcredit.operators.order_stats import at_ranks, counted, previous, renamed, same

# Thresholds of the alert rules.
MODIFIED_Z_FACTOR = 0.6745
IQR_FACTOR = 1.5
HIGH_Z = 3
MEDIUM_Z = 2
HIGH_PCT = 0.25
MEDIUM_PCT = 0.15

# Points that a series declared daily may have.
MAX_DAYS = 100_000

STATS = ["n", "mean", "stddev", "median", "mad", "q1", "q3"]


def _stats(series: DataFrame, metric: str, keys: list[str]) -> DataFrame:
    """(keys, STATS); series of fewer than two points are left out."""
    values = counted(series, keys, metric)
    keys = keys or ["_group"]
    ranks = {"median": lambda n: F.floor(n / 2), "q1": lambda n: F.floor(n / 4),
             "q3": lambda n: F.least(n - 1, F.floor(3 * n / 4))}
    at = at_ranks(values, keys, ranks).filter("n >= 2")
    known = renamed(at, keys, "_s")
    v, c, mean = F.col("v"), F.col("c"), F.col("mean")
    # equal values are one row of weight c: moments about the median, which the mean is shifted by
    d = v - F.col("median")
    out = values.join(known, same(keys, values, known, "_s")).groupBy(*keys).agg(
        *(F.max(x).alias(x) for x in ("n", "median", "q1", "q3")),
        (F.sum(c * d) / F.max("n")).alias("shift"), (F.sum(c * d * d) / F.max("n")).alias("square"),
        (F.sum(c * F.abs(d)) / F.max("n")).alias("mad"), (F.sum(c * v) / F.max("n")).alias("mean"),
        (F.min(v) == F.max(v)).alias("flat"))
    spread = F.sqrt(F.greatest(F.lit(0.0), F.col("square") - F.col("shift") * F.col("shift")))
    return out.select(*keys, F.col("n").cast("bigint").alias("n"),
                      F.when(F.col("flat"), F.col("median")).otherwise(mean).alias("mean"),
                      F.when(F.col("flat"), 0.0).otherwise(spread).alias("stddev"), *STATS[3:])


def _daily_points(series: DataFrame, metric: str, order_col: str,
                  series_cols: tuple[str, ...]) -> DataFrame:
    """The points of daily series with their statistics and the value before."""
    whole = Window.partitionBy(*series_cols)
    by_value = Window.partitionBy(*series_cols).orderBy("value")
    pts = (series.filter(F.col(metric).isNotNull())
           .select(*series_cols, order_col, F.col(metric).cast("double").alias("value")))
    v = F.col("value")
    count = F.count(F.lit(1)).over(whole)
    too_long = F.raise_error(F.lit(f"a daily series has more than {MAX_DAYS} points")).cast("bigint")
    ranked = pts.select("*", F.when(count <= MAX_DAYS, count).otherwise(too_long).alias("n"),
                        (F.row_number().over(by_value) - 1).alias("idx"),
                        F.avg(v).over(whole).alias("mean"),
                        F.stddev_pop(v).over(whole).alias("stddev"))

    def nth(idx):
        return F.max(F.when(F.col("idx") == idx, v)).over(whole)

    ordered = ranked.filter(F.col("n") >= 2).select(
        "*", nth(F.expr("n div 2")).alias("median"), nth(F.expr("n div 4")).alias("q1"),
        nth(F.least(F.col("n") - 1, F.expr("(3 * n) div 4"))).alias("q3"))
    before = F.lag("value").over(Window.partitionBy(*series_cols).orderBy(order_col))
    return ordered.select("*", F.avg(F.abs(v - F.col("median"))).over(whole).alias("mad"),
                          before.alias("prev"))


def _points(series: DataFrame, metric: str, order_col: str, keys: list[str]) -> DataFrame:
    """The points of series of any length with their statistics and the value before."""
    points = series.filter(F.col(metric).isNotNull()).select(
        *keys, order_col, F.col(metric).cast("double").alias("value"))
    stats = _stats(series, metric, keys)
    if not keys:                                        # one series
        keys, points = ["_group"], points.withColumn("_group", F.pmod(F.xxhash64("value"), F.lit(1)))
    points = previous(points, keys, order_col, "value", "prev")
    stats = renamed(stats, keys, "_s")
    return points.join(stats, same(keys, points, stats, "_s"))


def series_stats(series: DataFrame, metric: str, order_col: str = "date",
                 series_cols: tuple[str, ...] = (), daily: bool = False) -> DataFrame:
    """One row of statistics per series (series of < 2 points omitted)."""
    if daily:
        s = _daily_points(series, metric, order_col, tuple(series_cols))
        return s.groupBy(*series_cols).agg(*[F.max(c).alias(c) for c in STATS]) \
            .select(*series_cols, F.col("n").cast("bigint").alias("n"), *STATS[1:])
    return _stats(series, metric, list(series_cols)).select(*series_cols, *STATS)


def detect_anomalies(series: DataFrame, metric: str, order_col: str = "date",
                     series_cols: tuple[str, ...] = (), daily: bool = False) -> DataFrame:
    """One alert per non-NULL point, low severity included.

    NULL points are dropped first and "previous" means the previous
    non-NULL point (D11); fewer than two points give no alerts.
    """
    series_cols = tuple(series_cols)
    s = _daily_points(series, metric, order_col, series_cols) if daily else \
        _points(series, metric, order_col, list(series_cols))
    v = F.col("value")
    p = F.col("prev")
    z = F.when(F.col("stddev") != 0, (v - F.col("mean")) / F.col("stddev")).otherwise(F.lit(0.0))
    mz = F.when(F.col("mad") == 0, F.lit(0.0)).otherwise(
        MODIFIED_Z_FACTOR * (v - F.col("median")) / F.col("mad"))
    iqr = F.col("q3") - F.col("q1")
    outlier = (v < F.col("q1") - IQR_FACTOR * iqr) | (v > F.col("q3") + IQR_FACTOR * iqr)
    pct = F.when(p.isNotNull() & (p != 0), (v - p) / p).otherwise(F.lit(0.0))
    scored = (s
              .select(*series_cols, order_col, "value", z.alias("z_score"),
                      mz.alias("modified_z_score"), outlier.alias("iqr_outlier"),
                      pct.alias("percent_change")))
    az, amz, ap = (F.abs(F.col(c)) for c in ("z_score", "modified_z_score", "percent_change"))
    severity = (F.when((az >= HIGH_Z) | (amz >= HIGH_Z) | F.col("iqr_outlier") | (ap >= HIGH_PCT),
                       F.lit("high"))
                .when((az >= MEDIUM_Z) | (amz >= MEDIUM_Z) | (ap >= MEDIUM_PCT), F.lit("medium"))
                .otherwise(F.lit("low")))
    return scored.select(*series_cols, F.col(order_col).alias(order_col),
                         F.lit(metric).alias("metric"), "value", "z_score", "modified_z_score",
                         "iqr_outlier", "percent_change", severity.alias("severity"))


def recent_alerts(alerts: DataFrame, n: int = 5, order_col: str = "date") -> DataFrame:
    """The last ``n`` alerts, shown oldest first (a top-k report)."""
    return (alerts.orderBy(F.col(order_col).desc()).limit(n)
            .orderBy(F.col(order_col).asc()))
