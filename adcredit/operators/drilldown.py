"""Filtered, paginated raw-table reads (the drill-down pages).

``page`` returns the page rows and the total count of the filtered rows
as two lazy DataFrames over one filtered plan. Sorting is always
descending with a tie-break on the table key (D13), so pages are stable.
A page is a global top-(offset+limit): each task keeps its own top rows
and one small merge picks the page; deep offsets cost proportionally,
``keyset_page`` avoids that, and so does ``stored_page`` on a written table with an index.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adcredit.functions.predicates import apply_filters, date_range, equal_filters
from adcredit.schemas import FACTS
from adcredit.sources import files, index, manifest
from adcredit.sources.sinks import read_fact, read_files, stream_folder

MAX_LIMIT = 200
DEFAULT_LIMIT = 25


@dataclass(frozen=True)
class PageSpec:
    columns: tuple[str, ...]
    filters: tuple[str, ...]
    date_col: str
    sort_fields: tuple[str, ...]
    default_sort: str
    key: tuple[str, ...]


# Per-table page contracts (columns, filters, sortable fields).
PAGES = {
    "fact_ad_spend": PageSpec(
        ("campaign_id", "date", "spend", "impressions", "clicks", "source", "inserted_at"),
        ("campaign_id",), "date", ("date", "spend"), "date", ("campaign_id", "date")),
    "fact_orders": PageSpec(
        ("order_id", "customer_id", "order_ts", "order_date", "revenue", "currency",
         "inserted_at"),
        ("customer_id",), "order_date", ("order_ts", "revenue", "order_date"), "order_date",
        ("order_id",)),
    "fact_events": PageSpec(
        ("event_id", "customer_id", "event_ts", "event_date", "event_type", "campaign_id",
         "source", "inserted_at"),
        ("campaign_id", "customer_id"), "event_date", ("event_ts", "event_date"), "event_ts",
        ("event_id",)),
    "fact_attribution": PageSpec(
        ("order_id", "customer_id", "campaign_id", "touch_ts", "revenue", "inserted_at"),
        ("campaign_id",), "touch_date", ("touch_ts", "revenue"), "touch_ts", ("order_id",)),
}


def validate_page_args(table: str, order_by: str | None, limit: int, offset: int) -> PageSpec:
    if table not in PAGES:
        raise ValueError(f"unknown table: {table}")
    spec = PAGES[table]
    if order_by is not None and order_by not in spec.sort_fields:
        raise ValueError(f"{table} pages cannot be sorted by {order_by}")
    if not 1 <= int(limit) <= MAX_LIMIT:
        raise ValueError(f"limit must be within 1..{MAX_LIMIT}")
    if int(offset) < 0:
        raise ValueError("offset must be >= 0")
    return spec


def filtered(df: DataFrame, table: str, filters: dict | None = None, date_from=None,
             date_to=None) -> DataFrame:
    spec = PAGES[table]
    unknown = set(filters or {}) - set(spec.filters)
    if unknown:
        raise ValueError(f"unsupported filters for {table}: {sorted(unknown)}")
    preds = equal_filters(filters or {}) + date_range(spec.date_col, date_from, date_to)
    return apply_filters(df, preds)


def page(df: DataFrame, table: str, filters: dict | None = None, date_from=None, date_to=None,
         order_by: str | None = None, limit: int = DEFAULT_LIMIT,
         offset: int = 0) -> tuple[DataFrame, DataFrame]:
    """O4 + A6 + P8-P11: ``(rows, count)`` of one page."""
    spec = validate_page_args(table, order_by, limit, offset)
    f = filtered(df, table, filters, date_from, date_to)
    sort = order_by or spec.default_sort
    keys = [F.col(sort).desc_nulls_last()] + [F.col(k).desc_nulls_last()
                                              for k in spec.key if k != sort]
    rows = f.select(*spec.columns, *[k for k in spec.key if k not in spec.columns]) \
        .orderBy(*keys).offset(int(offset)).limit(int(limit)).select(*spec.columns)
    count = f.agg(F.count(F.lit(1)).alias("total_count"))
    return rows, count


#: Sort columns whose order is the order of the dates that the rows are stored under.
BY_DATE = {"fact_ad_spend": ("date",), "fact_orders": ("order_ts", "order_date"),
           "fact_events": ("event_ts", "event_date"), "fact_attribution": ("touch_ts",)}


def stored_page(spark: SparkSession, table: str, path: str, filters: dict | None = None, date_from=None,
                date_to=None, order_by: str | None = None, limit: int = DEFAULT_LIMIT,
                offset: int = 0) -> tuple[DataFrame, DataFrame]:
    """O4 + A6 on a written table: the same ``(rows, count)`` as :func:`page` of all its rows.

    A filter by a look-up column opens only the files that hold the value. Without filters the
    total comes from the stored row counts, and a page sorted by time or date reads only the dates it
    lies in, however deep it is. Other pages, and tables that a stream feeds, take the plain way.
    """
    spec = validate_page_args(table, order_by, limit, offset)
    filters = {k: v for k, v in (filters or {}).items() if v not in (None, "")}
    known = [c for c in FACTS[table].lookup_cols if c in filters]
    if known:
        rows = index.lookup(spark, table, path, known[0], [str(filters[known[0]])], date_from, date_to)
        return page(rows, table, filters, date_from, date_to, order_by, limit, offset)
    if filters or files.exists(spark, stream_folder(path)):
        return page(read_fact(spark, table, path), table, filters, date_from, date_to, order_by, limit, offset)
    snapshot = manifest.latest(spark, path)
    if not snapshot.version:
        raise FileNotFoundError(f"no table at {path}")
    counts = index.row_counts(spark, table, path, date_from, date_to, snapshot)
    total = spark.range(1).select(F.lit(sum(counts.values())).cast("bigint").alias("total_count"))
    parts, skipped = index.parts_between(FACTS[table], snapshot, date_from, date_to), 0
    if (order_by or spec.default_sort) in BY_DATE[table]:
        days, skipped = index.dates_of_page(counts, int(limit), int(offset))
        parts = [p for p in parts if p.partition in set(days)]
    rows, _ = page(read_files(spark, FACTS[table], path, [p.path for p in parts]), table, None, None, None,
                   order_by, limit, int(offset) - skipped)
    return rows, total


def page_info(count: DataFrame, page_index: int, size: int = DEFAULT_LIMIT) -> DataFrame:
    """Page index -> offset, and whether a next page exists."""
    off = int(page_index) * int(size)
    return count.select("total_count", F.lit(off).cast("bigint").alias("offset"),
                        (F.col("total_count") > off + int(size)).alias("has_next"))


def _below(cols: list[str], values: list) -> Column:
    """Key columns strictly below ``values``, compared in order."""
    out = F.lit(False)
    for c, v in reversed(list(zip(cols, values))):
        out = (F.col(c) < F.lit(v)) | ((F.col(c) == F.lit(v)) & out)
    return out


def keyset_page(df: DataFrame, table: str, after: tuple | None, order_by: str | None = None,
                limit: int = DEFAULT_LIMIT, filters: dict | None = None, date_from=None,
                date_to=None) -> DataFrame:
    """Next page strictly after the last (sort value, key...) seen.

    ``sort <= last AND (sort < last OR key...)``: the first conjunct alone is a plain
    comparison, so it prunes date partitions and is pushed into the scan. NULL sort values come
    last, after every bound; a page that ended inside them continues by key.
    """
    spec = validate_page_args(table, order_by, limit, 0)
    sort = order_by or spec.default_sort
    f = filtered(df, table, filters, date_from, date_to)
    cols = [sort] + [k for k in spec.key if k != sort]
    if after is not None:
        by_key = _below(cols[1:], list(after[1:]))
        value = after[0]
        if value is None:
            f = f.filter(F.col(sort).isNull() & by_key)
        else:
            less = (F.col(sort) < F.lit(value)) | ((F.col(sort) == F.lit(value)) & by_key)
            bounded = f.filter((F.col(sort) <= F.lit(value)) & less)
            f = bounded.unionByName(f.filter(F.col(sort).isNull()))
    return f.orderBy(*[F.col(c).desc_nulls_last() for c in cols]).limit(int(limit))
