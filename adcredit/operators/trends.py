"""Moving least-squares trend of a campaign's daily measure.

One window pass over campaign-day rows (partitioned by campaign, bounded by the calendar): the slope comes from
moving sums of x, y, xy and x^2, exact integers of days and of 10^-6 units, so it depends on no order of addition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adcredit.functions.scalar import finite
from adcredit.operators.metrics import dedup_metrics


def moving_trend(metrics: DataFrame, measure: str = "roas", days: int = 14, least: int = 3,
                 tolerance: float = 0.1) -> DataFrame:
    """(campaign_id, metric_date, points, level, slope, label) over the ``days`` calendar days up to each day.

    ``level`` is the mean and ``slope`` the change a day of the least-squares line, of values rounded to 10^-6
    (below 10^12). ``label``: ``rising`` / ``falling`` where the line moves by more than ``tolerance`` of the level
    over the frame, else ``stable``; NULL below ``least`` points. Days without a row, NULL and not finite values
    are no points; the slope of fewer than two points is NULL.
    """
    if days < 2 or least < 2 or tolerance < 0:
        raise ValueError("days and least must be 2 or more, tolerance not negative")
    value = F.col(measure).cast("double")
    micros = F.when(finite(value), (value.cast("decimal(18,6)") * F.lit(1_000_000)).cast("decimal(20,0)"))
    rows = dedup_metrics(metrics).select(
        "campaign_id", "metric_date", F.unix_date("metric_date").alias("day"), micros.alias("y")) \
        .withColumn("x", F.when(F.col("y").isNotNull(), F.col("day")).cast("decimal(10,0)"))
    frame = Window.partitionBy("campaign_id").orderBy("day").rangeBetween(1 - days, 0)

    def total(column):
        return F.sum(column).over(frame).cast("decimal(38,0)")
    n = F.col("points").cast("decimal(38,0)")
    sums = rows.select("campaign_id", "metric_date", F.count("y").over(frame).alias("points"),
                       total("x").alias("sx"), total("y").alias("sy"),
                       total(F.col("x") * F.col("y")).alias("sxy"), total(F.col("x") * F.col("x")).alias("sxx"))
    spread = (n * F.col("sxx") - F.col("sx") * F.col("sx")).cast("double")
    joint = (n * F.col("sxy") - F.col("sx") * F.col("sy")).cast("double")
    fitted = sums.select(
        "campaign_id", "metric_date", "points",
        F.when(F.col("points") > 0, F.col("sy").cast("double") / F.col("points") / 1e6).alias("level"),
        F.when(F.col("points") > 1, joint / spread / 1e6).alias("slope"))
    moved, bound = F.col("slope") * (days - 1), F.abs("level") * tolerance
    label = F.when(F.col("points") < least, None).when(moved > bound, "rising") \
        .when(moved < -bound, "falling").otherwise("stable")
    return fitted.withColumn("label", label)
