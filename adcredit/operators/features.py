"""Rolling features, next-day target and the training / serving frames.

Windows run per campaign over the campaign-day metrics table, whose rows
per campaign are bounded by the number of days (not by event volume).
The four rolling aggregates share one window spec, so Spark evaluates
them in a single Window node; the next-day target is a ``lead`` guarded
by the calendar (equal to the reference's date-shift self-join on unique
keys, without a second shuffle).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adcredit.operators.metrics import daily_event_counts
from adcredit.operators.order_stats import at_ranks, counted
from adcredit.schemas import FEATURE_ORDER, TARGET

ROLLING = ["rolling_7d_roas", "rolling_7d_spend", "rolling_7d_conversions",
           "rolling_7d_volatility"]


def _rolling_cols(date_col: str, window_rows: int):
    frame = (Window.partitionBy("campaign_id").orderBy(date_col)
             .rowsBetween(-(window_rows - 1), Window.currentRow))
    return [F.avg("roas").over(frame).alias("rolling_7d_roas"),
            F.avg("spend").over(frame).alias("rolling_7d_spend"),
            F.avg("conversions").over(frame).alias("rolling_7d_conversions"),
            F.stddev_samp("roas").over(frame).alias("rolling_7d_volatility")]


def features_with_target(metrics: DataFrame, window_rows: int = 7) -> DataFrame:
    """W10 (+ J3, J4): the feature table with ``next_day_roas``.

    Rolling frames count rows, the target uses the calendar next day: a gap
    gives NULL (D6).
    """
    base = metrics.select("campaign_id", "metric_date", "spend", "attributed_revenue",
                          "conversions", "cac", "roas")
    by_day = Window.partitionBy("campaign_id").orderBy("metric_date")
    nxt_date = F.lead("metric_date").over(by_day)
    nxt = F.when(nxt_date == F.date_add(F.col("metric_date"), 1), F.lead("roas").over(by_day))
    return base.select(*base.columns, *_rolling_cols("metric_date", window_rows),
                       nxt.alias(TARGET))


def features_with_events(metrics: DataFrame, events: DataFrame, window_rows: int = 7) -> DataFrame:
    """W11 (+ A3, J5): daily features with the campaign's event count, no target."""
    base = metrics.select(F.col("metric_date").alias("date"), "campaign_id", "spend",
                          "attributed_revenue", "conversions", "cac", "roas")
    joined = with_event_counts(base, events)
    return joined.select(*joined.columns, *_rolling_cols("date", window_rows))


def with_event_counts(rows: DataFrame, events: DataFrame) -> DataFrame:
    """Rows (date, campaign_id, ...) with ``events_count`` of their day, 0 where there are none."""
    counts = daily_event_counts(events).filter(F.col("campaign_id").isNotNull())
    return rows.join(counts, ["date", "campaign_id"], "left") \
        .select(*rows.columns, F.coalesce(F.col("events_count"), F.lit(0)).cast("bigint").alias("events_count"))


def differing(now: DataFrame, before: DataFrame) -> DataFrame:
    """Rows that only one of two tables has (equal NULLs and NaNs are equal)."""
    return now.exceptAll(before).unionByName(before.exceptAll(now))


def features_since(metrics: DataFrame, firsts: DataFrame, window_rows: int = 7) -> DataFrame:
    """W10 for the campaigns of ``firsts`` (campaign_id, first), from the day before ``first`` on.

    A changed day moves the frames of the campaign's next rows and the target of the day before. The state that
    is carried into the first frame is the campaign's last ``window_rows - 1`` older rows, taken by a limited window
    (each task passes on that many rows a campaign), so history is scanned but neither shuffled nor recomputed.
    """
    mine = metrics.join(firsts, "campaign_id")
    start = F.date_sub(F.col("first"), 1)
    latest = Window.partitionBy("campaign_id").orderBy(F.col("metric_date").desc())
    carried = mine.filter(F.col("metric_date") < start).withColumn("_n", F.row_number().over(latest)) \
        .filter(F.col("_n") < window_rows).drop("_n")
    rows = carried.unionByName(mine.filter(F.col("metric_date") >= start))
    out = features_with_target(rows, window_rows)
    return out.join(firsts, "campaign_id").filter(F.col("metric_date") >= start).select(*out.columns)


_TRAIN_COLS = ["spend", "attributed_revenue", "conversions", "cac", "roas", *ROLLING]


def training_frame(features: DataFrame, fill: float | None = 0.0,
                   keys: tuple[str, ...] = ()) -> DataFrame:
    """M1 / M2: rows with a known target; features NULL-filled (D16), ``keys`` in front.

    ``fill=None`` keeps NULL features (the extract used by the reference's
    trainer); ``fill=0`` is the loader's IFNULL form. The target column is
    renamed ``target_next_day_roas``.
    """
    cols = [F.col(k) for k in keys] + [F.col("metric_date")]
    for c in _TRAIN_COLS:
        v = F.col(c).cast("double")
        cols.append((v if fill is None else F.coalesce(v, F.lit(float(fill)))).alias(c))
    return (features.filter(F.col(TARGET).isNotNull())
            .select(*cols, F.col(TARGET).cast("double").alias("target_next_day_roas")))


def latest_feature_row(features: DataFrame, require_target: bool = False,
                       per_campaign: bool = False) -> DataFrame:
    """Newest feature row (ties: lowest campaign_id, D15), NULLs as 0.

    ``per_campaign`` gives each campaign's newest row instead of one row.
    Global top-1 is a per-task top-1 plus a merge of one row per task.
    """
    df = features.filter(F.col(TARGET).isNotNull()) if require_target else features
    cols = [F.col("campaign_id"), F.col("metric_date")] + [
        F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in FEATURE_ORDER]
    if require_target:
        cols.append(F.col(TARGET).cast("double").alias("target_next_day_roas"))
    if per_campaign:
        payload = [c for c in df.columns if c not in ("campaign_id",)]
        best = (df.groupBy("campaign_id")
                .agg(F.max(F.struct("metric_date", *[c for c in payload if c != "metric_date"]))
                     .alias("m"))
                .select("campaign_id", "m.*"))
        return best.select(*cols)
    return df.orderBy(F.col("metric_date").desc(), F.col("campaign_id").asc()).limit(1).select(*cols)


def profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """A10 / M9: count, mean, sample deviation, minimum, quartiles and maximum per column.

    The mean is an exact decimal sum over the count. Quartiles are exact, linear between the two nearest values,
    and found by counting (:mod:`adcredit.operators.order_stats`): no task holds a column.
    """
    values = df.unpivot([], columns, "feature", "v").withColumn("v", F.col("v").cast("double"))
    mean = F.sum(F.col("v").cast("decimal(38,8)")).cast("double") / F.count("v")
    basic = values.groupBy("feature").agg(
        F.count("v").alias("count"), mean.alias("mean"), F.stddev_samp("v").alias("stddev"),
        F.min("v").alias("min"), F.max("v").alias("max"))
    quartiles = (25, 50, 75)

    def rank(p, upper):
        return lambda n: F.floor(((n - 1) * p + (99 if upper else 0)) / 100)
    near = at_ranks(counted(values, ["feature"], "v"), ["feature"], {
        f"{side}{p}": rank(p, side == "high") for p in quartiles for side in ("low", "high")})

    def between(p):
        at = (F.col("n") - 1) * (p / 100)
        low, high = F.col(f"low{p}"), F.col(f"high{p}")
        share = at - F.floor(at)
        return F.when(low == high, low).otherwise((1 - share) * low + share * high).alias(f"p{p}")
    return basic.join(near, "feature", "left").select(
        "feature", "count", "mean", "stddev", "min", *map(between, quartiles), "max")


def unique_key_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys occurring more than once (J3/J4 would fan out on them, D5)."""
    return df.groupBy(*keys).count().filter(F.col("count") > 1)
