"""Optional-parameter predicates: a filter is added only when a value is given."""

from __future__ import annotations

import datetime as _dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _blank(v) -> bool:
    return v is None or v == ""


def optional_eq(col: str, value) -> Column | None:
    """``(@p IS NULL OR col = @p)`` folded on the driver: no predicate when absent."""
    return None if _blank(value) else (F.col(col) == F.lit(str(value)))


def equal_filters(filters: dict) -> list[Column]:
    return [p for p in (optional_eq(k, v) for k, v in (filters or {}).items()) if p is not None]


def _as_date(v) -> _dt.date:
    if isinstance(v, _dt.datetime):
        return v.date()
    if isinstance(v, _dt.date):
        return v
    return _dt.date.fromisoformat(str(v))


def date_range(col: str | Column, date_from=None, date_to=None) -> list[Column]:
    """Inclusive range on a DATE column; literal bounds so Parquet partitions prune."""
    c = F.col(col) if isinstance(col, str) else col
    out = []
    if not _blank(date_from):
        out.append(c >= F.lit(_as_date(date_from)))
    if not _blank(date_to):
        out.append(c <= F.lit(_as_date(date_to)))
    return out


def all_of(preds: list[Column]) -> Column | None:
    return reduce(lambda a, b: a & b, preds) if preds else None


def apply_filters(df: DataFrame, preds: list[Column]) -> DataFrame:
    cond = all_of(preds)
    return df if cond is None else df.filter(cond)
