"""Scalar expressions: safe arithmetic, ISO formatting, top-1 structs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# Money is summed as an exact decimal: the result does not depend on the
# order of the additions (double sums do, across partitionings and runs).
MONEY = "decimal(38,6)"


def finite(col) -> Column:
    """Neither NaN nor infinite (NULL stays NULL)."""
    c = _c(col).cast("double")
    return ~(F.isnan(c) | (F.abs(c) == float("inf")))


def exact_sum(col) -> Column:
    """Exact decimal sum of the finite amounts (see :func:`money_sum` for the others)."""
    c = _c(col)
    return F.sum(F.when(finite(c), c).cast(MONEY))


def money_sum(col) -> Column:
    """Exact, order-independent sum of an amount, returned as double.

    An amount that is NaN or infinite makes the sum NaN; it never drops out unseen. Ingest
    quarantines such amounts, and those finer than the scale of ``MONEY``.
    """
    return F.when(F.coalesce(F.max(~finite(col)), F.lit(False)), F.lit(float("nan"))) \
        .otherwise(exact_sum(col).cast("double"))


def safe_divide(num, den) -> Column:
    """NULL when the denominator is 0 or NULL (plain ``/`` raises under ANSI)."""
    return F.try_divide(_c(num), _c(den))


def ratio_or_zero(num, den) -> Column:
    """``a / b if b else 0``."""
    return F.coalesce(F.try_divide(_c(num), _c(den)), F.lit(0.0))


def fixed_decimals(col, places: int = 2) -> Column:
    """display text with a fixed number of decimals, halves away from zero.

    No thousands separators; NULL stays NULL.
    """
    c = _c(col).cast("double")
    return F.when(c.isNotNull(), F.format_string(f"%.{int(places)}f", F.round(c, int(places))))


def iso_date(col) -> Column:
    return F.date_format(_c(col), "yyyy-MM-dd")


def iso_timestamp(col) -> Column:
    """Python ``datetime.isoformat()`` of a UTC instant.

    ``YYYY-MM-DDTHH:MM:SS[.ffffff]+00:00``; the fraction is omitted when it
    is zero, exactly as Python does.
    """
    c = _c(col)
    frac = F.date_format(c, "SSSSSS")
    return F.when(c.isNull(), F.lit(None).cast("string")).otherwise(F.concat(
        F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss"),
        F.when(frac == "000000", F.lit("")).otherwise(F.concat(F.lit("."), frac)),
        F.lit("+00:00")))


def latest_struct(*order_and_payload: str | Column) -> Column:
    """``max(struct(order keys..., payload...))``: top-1 per group that
    partially aggregates before the shuffle (hot keys collapse map-side).
    NULL order keys sort lowest, i.e. ``DESC NULLS LAST``."""
    return F.max(F.struct(*[_c(c) for c in order_and_payload]))


def to_naive(df: DataFrame) -> DataFrame:
    """Present instants as UTC wall-clock ``TIMESTAMP_NTZ`` at the edge."""
    cols = [F.col(f.name).cast("timestamp_ntz").alias(f.name)
            if isinstance(f.dataType, T.TimestampType) else F.col(f.name)
            for f in df.schema.fields]
    return df.select(*cols)


def round_doubles(df: DataFrame, places: int = 6, only: tuple[str, ...] | None = None) -> DataFrame:
    """Round double columns (all, or ``only`` these) half away from zero."""
    cols = [F.round(F.col(f.name), places).alias(f.name)
            if isinstance(f.dataType, T.DoubleType) and (only is None or f.name in only)
            else F.col(f.name)
            for f in df.schema.fields]
    return df.select(*cols)
