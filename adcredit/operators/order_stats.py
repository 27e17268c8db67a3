"""Exact order statistics of groups of any size: selection by counts, no group in one task.

Every double has a 64-bit code that grows with it. The value of a rank is found digit by digit: equal values are
counted once (combined before the shuffle, so a value that fills a third of a group costs one row), the counts
of the codes' leading 20 bits are summed up in order, and each rank falls into one digit; then the same among the codes
with that digit, 22 bits at a time, twice. A running sum goes over the distinct digits of one level only: at most 2^22
rows, whatever the size of a group.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_MANTISSA = 1 << 52
_LOWEST_NORMAL = 2.0 ** -1022
#: Right shift and mask of each level's digit.
_DIGITS = ((44, None), (22, (1 << 22) - 1), (0, (1 << 22) - 1))


def code(value: Column) -> Column:
    """A long that orders like the double ``value``; -0.0 is 0.0, NaN comes last."""
    v = value.cast("double") + F.lit(0.0)
    a = F.abs(v)
    guess = F.floor(F.log2(a))
    power = F.pow(F.lit(2.0), guess)
    exponent = guess + F.when(a >= 2 * power, 1).when(a < power, -1).otherwise(0)
    normal = (exponent + 1023) * F.lit(_MANTISSA) \
        + ((a / F.pow(F.lit(2.0), exponent) - 1) * float(_MANTISSA)).cast("long")
    size = F.when(a == float("inf"), F.lit(2047 * _MANTISSA)) \
        .when(a < _LOWEST_NORMAL, (a * 2.0 ** 537 * 2.0 ** 537).cast("long")).otherwise(normal)
    ordered = F.when(F.isnan(v), F.lit(2047 * _MANTISSA + 1)).when(v < 0, -size).otherwise(size)
    return F.coalesce(ordered, F.lit(0).cast("long"))


def _digit(level: int) -> Column:
    shift, mask = _DIGITS[level]
    d = F.shiftright("code", shift)
    return F.coalesce(d if mask is None else d.bitwiseAND(mask), F.lit(0).cast("long"))


def same(keys: list[str], left: DataFrame, right: DataFrame, suffix: str) -> Column:
    """Equality of ``keys``, NULL being equal to NULL; the right side's are renamed with ``suffix``."""
    out = F.lit(True)
    for k in keys:
        out = out & left[k].eqNullSafe(right[k + suffix])
    return out


def renamed(df: DataFrame, keys: list[str], suffix: str) -> DataFrame:
    return df.withColumnsRenamed({k: k + suffix for k in keys})


def counted(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """(keys, v, code, c): each distinct value of a group once. A table without keys is one group ``_group``."""
    v = F.col(value).cast("double") + F.lit(0.0)
    group = [F.col(k) for k in keys] or [F.pmod(code(v), F.lit(1)).alias("_group")]
    return rows.filter(F.col(value).isNotNull()).select(*group, v.alias("v"), code(v).alias("code")) \
        .groupBy(*(keys or ["_group"]), "v", "code").agg(F.count(F.lit(1)).alias("c"))


def at_ranks(values: DataFrame, keys: list[str], ranks: dict[str, Callable[[Column], Column]]) -> DataFrame:
    """(keys, n, a column a rank) of :func:`counted` values.

    ``ranks``: name -> function from a group's size to the rank wanted (0 is the least value).
    """
    keys = keys or ["_group"]
    names = list(ranks)
    chosen, digits = None, []
    for level in range(3):
        digit = f"d{level}"
        rows = values.withColumn(digit, _digit(level))
        if chosen is None:
            sums = rows.groupBy(*keys, digit).agg(F.sum("c").alias("c"), F.max("v").alias("v"))
        else:
            for i, d in enumerate(digits):
                rows = rows.withColumn(d, _digit(i))
            on = keys + digits
            known = renamed(chosen, on, "_r")
            sums = rows.join(known, same(on, rows, known, "_r")).drop(*(k + "_r" for k in on)) \
                .groupBy(*on, digit).agg(F.sum("c").alias("c"), F.max("v").alias("v"),
                                         F.first("n").alias("n"), F.first("wanted").alias("wanted"))
        whole = Window.partitionBy(*keys, *digits)
        sums = sums.withColumn("past", F.sum("c").over(whole.orderBy(digit)) - F.col("c"))
        if chosen is None:
            sums = sums.withColumn("n", F.sum("c").over(whole))
            wanted = F.array(*(F.struct(F.lit(i).alias("name"), ranks[k](F.col("n")).cast("long").alias("rank"))
                               for i, k in enumerate(names)))
            sums = sums.withColumn("wanted", wanted)
        here = F.transform(
            F.filter("wanted", lambda w: (w["rank"] >= F.col("past")) & (w["rank"] < F.col("past") + F.col("c"))),
            lambda w: F.struct(w["name"].alias("name"), (w["rank"] - F.col("past")).alias("rank")))
        digits.append(digit)
        chosen = sums.withColumn("wanted", here).filter(F.size("wanted") > 0) \
            .select(*keys, *digits, "n", "wanted", "v")
        if level < 2:
            chosen = chosen.drop("v")
    each = chosen.select(*keys, "n", "v", F.explode("wanted").alias("w"))
    return each.groupBy(*keys).agg(F.max("n").alias("n"), *(
        F.max(F.when(F.col("w.name") == i, F.col("v"))).alias(k) for i, k in enumerate(names)))


def previous(rows: DataFrame, keys: list[str], order: str, value: str, name: str) -> DataFrame:
    """``rows`` with ``name``: the value of the row before, by ``order`` (dates, instants or their ISO text).

    Inside a month from a window of the month, for its first row from the months' last values: no task
    gets more than a group's month, or one row a month of a group.
    """
    month = F.substring(F.col(order).cast("string"), 1, 7)
    keys = keys or ["_group"]
    rows = rows.withColumn("_month", F.coalesce(month, F.lit("")))
    ends = rows.groupBy(*keys, "_month").agg(F.max_by(value, order).alias("_last"))
    ends = ends.withColumn("_before", F.lag("_last").over(Window.partitionBy(*keys).orderBy("_month"))).drop("_last")
    on = [*keys, "_month"]
    ends = renamed(ends, on, "_e")
    first = F.row_number().over(Window.partitionBy(*on).orderBy(order)) == 1
    inside = F.lag(value).over(Window.partitionBy(*on).orderBy(order))
    return rows.withColumn("_first", first).withColumn("_inside", inside) \
        .join(ends, same(on, rows, ends, "_e"), "left").drop(*(k + "_e" for k in on)) \
        .withColumn(name, F.when(F.col("_first"), F.col("_before")).otherwise(F.col("_inside"))) \
        .drop("_first", "_inside", "_before", "_month")
