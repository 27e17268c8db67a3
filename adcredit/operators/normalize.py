"""Normalisers from raw text rows to the fact schemas, and quarantine.

``mode="tolerant"`` is the SQL form: unparseable numbers / instants become
NULL (SAFE_CAST) and are caught by ``quarantine``. ``mode="strict"`` is
the Python form: the first bad value raises, and a missing
``source`` becomes ``"unknown"`` (D8). Both accept the same text shapes, checked
before the cast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adcredit.functions.scalar import finite
from adcredit.schemas import CORRUPT, FACT_AD_SPEND, FACT_EVENTS, FACT_ORDERS, FactSpec

# Defaults of the normalisers.
DEFAULT_CURRENCY = "USD"
UNKNOWN_SOURCE = "unknown"


# Accepted shapes of text values (fixed values). A cast alone would also take "7d", "1f",
# "Infinity", "2024" (1 January) and "12:30" (today).
_FLOAT = r"^\s*[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
_INTEGER = r"^\s*[+-]?[0-9]+\s*$"
_DAY = r"^\s*[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}\s*$"
_INSTANT = (r"^\s*[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}"
            r"([T ][0-9]{1,2}:[0-9]{1,2}(:[0-9]{1,2}(\.[0-9]{1,9})?)?"
            r"\s*(Z|UTC|[+-][0-9]{1,2}:[0-9]{2})?)?\s*$")
_SHAPES = {"double": _FLOAT, "bigint": _INTEGER, "date": _DAY, "timestamp": _INSTANT}


def _parsed(col: str, type_: str, mode: str) -> Column:
    """Text of the accepted shape, cast. Otherwise NULL (tolerant) or an error (strict)."""
    c = F.col(col)
    shaped = c.cast("string").rlike(_SHAPES[type_])
    if mode == "strict":
        bad = F.raise_error(F.concat(F.lit(f"{col}: not a {type_}: "), c.cast("string")))
        return F.when(shaped | c.isNull(), c.cast(type_)).otherwise(bad.cast(type_))
    return F.when(shaped, F.expr(f"try_cast(`{col}` AS {type_})"))


def _num(col: str, type_: str, mode: str) -> Column:
    return _parsed(col, type_, mode)


def _ts(col: str, mode: str) -> Column:
    return _parsed(col, "timestamp", mode)


def _date(col: str, mode: str) -> Column:
    return _parsed(col, "date", mode)


def _inserted(as_of) -> Column:
    return F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")


def _check_mode(mode: str) -> None:
    if mode not in ("tolerant", "strict"):
        raise ValueError("mode must be 'tolerant' or 'strict'")


def _source(mode: str) -> Column:
    return F.col("source") if mode == "tolerant" else F.coalesce(F.col("source"),
                                                                F.lit(UNKNOWN_SOURCE))


def _ad_cols(mode: str, as_of) -> list[Column]:
    return [F.col("campaign_id").cast("string").alias("campaign_id"),
            _date("date", mode).alias("date"),
            _num("spend", "double", mode).alias("spend"),
            _num("impressions", "bigint", mode).alias("impressions"),
            _num("clicks", "bigint", mode).alias("clicks"),
            _source(mode).alias("source"), _inserted(as_of).alias("inserted_at")]


def _order_cols(mode: str, as_of) -> list[Column]:
    ts = _ts("order_ts", mode)
    return [F.col("order_id").cast("string").alias("order_id"),
            F.col("customer_id").cast("string").alias("customer_id"),
            ts.alias("order_ts"), F.to_date(ts).alias("order_date"),
            _num("revenue", "double", mode).alias("revenue"),
            F.coalesce(F.col("currency"), F.lit(DEFAULT_CURRENCY)).alias("currency"),
            _inserted(as_of).alias("inserted_at")]


def _event_cols(mode: str, as_of) -> list[Column]:
    ts = _ts("event_ts", mode)
    return [F.col("event_id").cast("string").alias("event_id"),
            F.col("customer_id").cast("string").alias("customer_id"),
            ts.alias("event_ts"), F.to_date(ts).alias("event_date"),
            F.col("event_type").cast("string").alias("event_type"),
            F.col("campaign_id").cast("string").alias("campaign_id"),
            _source(mode).alias("source"), _inserted(as_of).alias("inserted_at")]


KINDS = {"ads": (_ad_cols, FACT_AD_SPEND), "orders": (_order_cols, FACT_ORDERS),
         "events": (_event_cols, FACT_EVENTS)}


def normalize_ads(raw: DataFrame, mode: str = "tolerant", as_of=None) -> DataFrame:
    """P1 / P2 -> fact_ad_spend columns."""
    _check_mode(mode)
    return raw.select(*_ad_cols(mode, as_of))


def normalize_orders(raw: DataFrame, mode: str = "tolerant", as_of=None) -> DataFrame:
    """P3 / P4 -> fact_orders columns; missing currency is USD."""
    _check_mode(mode)
    return raw.select(*_order_cols(mode, as_of))


def normalize_events(raw: DataFrame, mode: str = "tolerant", as_of=None,
                     distinct: bool = True) -> DataFrame:
    """P5: normalised events, exact duplicate rows removed (SELECT DISTINCT).

    ``inserted_at`` is one value per run, so it never splits duplicates.
    Streams pass ``distinct=False`` and de-duplicate within a watermark
    instead (an unbounded streaming DISTINCT would keep state forever).
    """
    _check_mode(mode)
    out = raw.select(*_event_cols(mode, as_of))
    return out.distinct() if distinct else out


def dedup_events(raw: DataFrame, key: str = "event_id", arrival: str = "ingest_seq",
                 mode: str = "strict", as_of=None) -> DataFrame:
    """One row per ``key``, the last arrival wins (``max_by`` on the
    arrival order; partial aggregation collapses repeated deliveries
    map-side)."""
    _check_mode(mode)
    return last_arrivals(raw.select(*_event_cols(mode, as_of), F.col(arrival).alias("_arrival")),
                         key)


def last_arrivals(events: DataFrame, key: str = "event_id",
                  arrival: str = "_arrival") -> DataFrame:
    """One row per ``key`` of normalised events, the last arrival."""
    names = [c for c in FACT_EVENTS.columns if c != key]
    picked = events.groupBy(key).agg(
        F.max_by(F.struct(*[F.col(n) for n in names]), F.col(arrival)).alias("m"))
    return picked.select(key, *[F.col(f"m.{n}").alias(n) for n in names]) \
        .select(*FACT_EVENTS.columns)


# Amounts are summed at this scale (``functions.scalar.MONEY``).
MONEY_PLACES = 6
_AMOUNTS = ("spend", "revenue", "attributed_revenue")


def quarantine(df: DataFrame, spec: FactSpec) -> tuple[DataFrame, DataFrame]:
    """Split rows violating NOT NULL / finite / scale / non-negative rules.

    Returns ``(good, bad)``; ``bad`` carries a ``violations`` array naming
    the failed rules. Both are lazy filters over one input. Amounts finer than the money
    scale are rejected: a sum would round them away.
    """
    checks = [F.when(F.col(c).isNull(), F.lit(f"{c} is null")) for c in spec.required]
    if CORRUPT in df.columns:
        checks.append(F.when(F.col(CORRUPT).isNotNull(), F.lit("row is unreadable")))
    for c in _AMOUNTS:
        if c in df.columns:
            v = F.col(c)
            checks.append(F.when(~finite(v), F.lit(f"{c} is not finite")))
            checks.append(F.when(finite(v) & (v != F.round(v, MONEY_PLACES)),
                                 F.lit(f"{c} is finer than {MONEY_PLACES} decimals")))
    for c in ("spend", "revenue", "impressions", "clicks", "attributed_revenue", "conversions"):
        if c in df.columns:
            checks.append(F.when(F.col(c) < 0, F.lit(f"{c} is negative")))
    flagged = df.withColumn("violations", F.filter(F.array(*checks), lambda x: x.isNotNull()))
    good = flagged.filter(F.size("violations") == 0).drop("violations")
    bad = flagged.filter(F.size("violations") > 0)
    return good, bad


def accept(raw: DataFrame, kind: str, mode: str = "tolerant", as_of=None,
           keep: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """Normalise and split one raw batch or stream: ``(good, rejected)``.

    Every raw row is in exactly one of the two. ``good`` has the fact columns (and the raw
    columns ``keep``), ``rejected`` the columns of the quarantine table with the raw row as JSON.
    """
    _check_mode(mode)
    if kind not in KINDS:
        raise ValueError(f"unsupported kind: {kind}")
    columns, spec = KINDS[kind]
    extra = [F.col(c) for c in (*keep, CORRUPT) if c in raw.columns]
    rows = raw.select(*columns(mode, as_of), *extra,
                      F.to_json(F.struct(*raw.columns)).alias("_raw"))
    good, bad = quarantine(rows, spec)
    return (good.drop("_raw", CORRUPT),
            bad.select(F.lit(spec.name).alias("table"), F.col("_raw").alias("raw"), "violations",
                       "inserted_at"))
