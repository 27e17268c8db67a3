"""Fact tables: append / replace, compaction, partitioned layout, retention and reads.

A table folder holds ``data/`` (date-partitioned, cluster-sorted Parquet, a folder a job and date) and
the commit log that says which of it is live (:mod:`adcredit.sources.manifest`): every append, replacement
(of the table or of any number of dates) and compaction is one commit. A failed or killed job
leaves the table as it was, and readers never see half of a change. ``stream/`` is the file sink of one
streaming query (its own commit log); batch rows never go there, since a reader of that folder
follows its log alone.

:func:`read_fact` unions the live parts and the stream folder. Rows are
rebalanced by the partition column before a write: AQE splits an oversized date (a hot
day) over several tasks and merges tiny ones.
"""

from __future__ import annotations

import datetime as _dt
from collections import defaultdict

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adcredit.schemas import FACTS, FactSpec
from adcredit.sources import files, manifest
from adcredit.sources.manifest import Snapshot

RETENTION_DAYS = 180
STREAM = "stream"
#: Size that compaction gives to files.
TARGET_BYTES = 128 << 20


def _required(spec: FactSpec, name: str, value: Column) -> Column:
    problem = F.raise_error(F.lit(f"{spec.name}.{name} is NULL"))
    return F.when(value.isNull(), problem.cast(spec.schema[name].dataType)).otherwise(value)


def conform(df: DataFrame, spec: FactSpec) -> DataFrame:
    """Select and cast to the fact schema, in schema order.

    A NULL in a NOT NULL column raises: Parquet would store it, and a typed reader
    could show it as a default such as 1970-01-01.
    """
    cols = []
    for f in spec.schema.fields:
        value = (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType)
        cols.append((value if f.nullable else _required(spec, f.name, value)).alias(f.name))
    return df.select(*cols)


def current(spark: SparkSession, path: str) -> str | None:
    """Folder of the committed data, None where nothing was ever written."""
    path = path.rstrip("/")
    return f"{path}/{manifest.DATA}" if manifest.latest(spark, path).version else None


def _write_parts(out: DataFrame, spec: FactSpec, path: str) -> list[manifest.Part]:
    """Write rows that are already distributed, sorted by the cluster columns, as parts to commit."""
    writer = manifest.new_id()
    lead = [spec.partition_col] if spec.partition_col else []
    w = out.sortWithinPartitions(*lead, *spec.cluster_cols).write
    (w.partitionBy(*lead) if lead else w).parquet(manifest.staging(path, writer))
    return manifest.place(out.sparkSession, path, writer, spec.partition_col)


def write_fact(df: DataFrame, table: str, path: str, mode: str = "append",
               probe: DataFrame | None = None, base: Snapshot | None = None) -> bool:
    """S5-S7, S9, S10. Returns False when an empty append was skipped.

    ``append``: an empty batch is a no-op, found by one ``isEmpty()`` (a LIMIT 1
    job) on ``probe``, the raw input, where ``df`` is costly (a shuffle would run
    twice). ``overwrite``: one commit replaces all rows of the table (an empty batch
    empties it); the version before it is kept for readers at work. It raises
    :class:`~adcredit.sources.manifest.Conflict` where another writer committed since ``base``
    (else: since this call began).
    """
    if mode not in ("append", "overwrite"):
        raise ValueError("mode must be 'append' or 'overwrite'")
    spark, spec = df.sparkSession, FACTS[table]
    out = conform(df, spec)
    if mode == "append" and (out if probe is None else probe).isEmpty():
        return False
    if mode == "overwrite":
        if files.exists(spark, stream_folder(path)):
            raise ValueError(f"{path} is fed by a stream and cannot be replaced")
        base = base or manifest.latest(spark, path)
    if spec.partition_col:
        out = out.hint("rebalance", spec.partition_col)
    parts = _write_parts(out, spec, path)
    if mode == "append":
        manifest.commit(spark, path, parts)
    else:
        manifest.commit(spark, path, parts, [p.path for p in base.parts], base)
    return True


def replace_partitions(df: DataFrame, table: str, path: str, affected: list,
                       base: Snapshot | None = None) -> None:
    """Replace the partitions ``affected`` (dates, or None), any number of them, in one commit.

    ``df`` holds all their new rows; those left without rows become empty, all other partitions keep
    their files. ``base`` is the version that ``df`` was computed from: if another writer has changed an affected
    date since, nothing is replaced and :class:`~adcredit.sources.manifest.Conflict` is raised.
    """
    spark, spec = df.sparkSession, FACTS[table]
    base = base or manifest.latest(spark, path)
    if not base.version or spec.partition_col is None:
        raise ValueError(f"{path} has no partitions to replace")
    parts = _write_parts(conform(df, spec).hint("rebalance", spec.partition_col), spec, path)
    dates = {partition_folder(spec, v) for v in affected}
    if strays := {p.partition for p in parts} - dates:
        raise ValueError(f"rows of partitions that are not replaced: {sorted(strays)}")
    manifest.commit(spark, path, parts, [p.path for p in base.of(dates)], base, dates)


def upsert_batch(rows: DataFrame, table: str, path: str, replaces: str, batch: tuple[str, int],
                 attempts: int = 5) -> bool:
    """One batch of a stream of upserts, in one commit. False where it was committed before.

    ``rows`` (read several times: a written table) has each key once; its column ``replaces`` is the partition value
    that the key's row is live in so far, NULL for a new key. New rows are appended; of the named partitions only
    the parts that hold a replaced key are rewritten. Where another writer has changed one of these meanwhile
    (a compaction), the batch is worked out again on the newer version.
    """
    spark, spec = rows.sparkSession, FACTS[table]
    if spec.partition_col is None or not spec.key_cols:
        raise ValueError(f"{table} has no partitions or no key")
    old = rows.filter(F.col(replaces).isNotNull())
    dates = {partition_folder(spec, r[0]) for r in old.select(replaces).distinct().collect()}
    keys = old.select(*spec.key_cols)
    for attempt in range(attempts):
        snapshot = manifest.latest(spark, path)
        if snapshot.applied.get(batch[0], -1) >= batch[1]:
            return False
        out, hit = conform(rows, spec), ()
        if candidates := snapshot.of(dates):
            live = _read_parts(spark, spec, path, candidates, "_metadata.file_path")
            folder = F.regexp_extract("file_path", rf"{manifest.DATA}/[^/]+/c-[^/]+", 0)
            found = live.join(keys, list(spec.key_cols), "left_semi").select(folder).distinct()
            folders = {r[0] for r in found.collect()}               # at most the parts of these dates
            hit = tuple(p for p in candidates if p.path in folders)
        if hit:
            kept = _read_parts(spark, spec, path, hit).join(keys, list(spec.key_cols), "left_anti")
            out = out.unionByName(kept.select(*spec.columns))
        parts = _write_parts(out.hint("rebalance", spec.partition_col), spec, path)
        try:
            manifest.commit(spark, path, parts, [p.path for p in hit], batch=batch)
            return True
        except manifest.Conflict:
            if attempt == attempts - 1:
                raise
    return False


def _small(snapshot: Snapshot, target_bytes: int) -> dict[str, list[manifest.Part]]:
    """By partition, the parts of small files whose merging saves files."""
    by_partition = defaultdict(list)
    for p in snapshot.parts:
        if p.bytes < p.files * target_bytes / 2:
            by_partition[p.partition].append(p)
    return {k: parts for k, parts in by_partition.items()
            if sum(p.files for p in parts) > _bins(parts, target_bytes)}


def _bins(parts: list[manifest.Part], target_bytes: int) -> int:
    return max(1, -(-sum(p.bytes for p in parts) // target_bytes))


def compact(spark: SparkSession, table: str, path: str, target_bytes: int = TARGET_BYTES) -> int:
    """Merge small files, date by date, into files of about ``target_bytes``, in one commit.

    Returns the number of files saved. Only parts of small files are read and replaced; appends that are committed
    meanwhile stay as they are (two compactions of the same parts conflict). Rows are dealt by a hash of
    their key, so no file grows with a hot campaign or customer, and sorted by the cluster columns in each.
    """
    spec, snapshot = FACTS[table], manifest.latest(spark, path)
    todo = _small(snapshot, target_bytes)
    if not todo:
        return 0
    parts = [p for group in todo.values() for p in group]
    rows = _read_parts(spark, spec, path, parts)
    bins = {k: _bins(group, target_bytes) for k, group in todo.items()}
    spread = F.xxhash64(*(spec.key_cols or spec.columns))
    if spec.partition_col:
        count = F.lit(1)
        for n in sorted(set(bins.values()) - {1}):                  # dates of as many files each
            days = [k.split("=", 1)[1] for k, m in bins.items() if m == n]
            count = F.when(F.col(spec.partition_col).cast("string").isin(days), n).otherwise(count)
        rows = rows.withColumn("_bin", F.pmod(spread, count)) \
            .repartition(sum(bins.values()), spec.partition_col, "_bin").drop("_bin")
    else:
        rows = rows.repartition(bins[""], spread)
    new = _write_parts(rows, spec, path)
    manifest.commit(spark, path, new, [p.path for p in parts])
    return sum(p.files for p in parts) - sum(p.files for p in new)


def partition_folder(spec: FactSpec, value) -> str:
    return f"{spec.partition_col}={'__HIVE_DEFAULT_PARTITION__' if value is None else value}"


def stream_folder(path: str) -> str:
    return f"{path.rstrip('/')}/{STREAM}"


def read_files(spark: SparkSession, spec: FactSpec, path: str, paths: list[str], *more: str) -> DataFrame:
    """Rows of folders or files of the table (paths below its folder)."""
    if not paths:
        return spark.createDataFrame([], spec.schema)
    base = path.rstrip("/")
    return spark.read.schema(spec.schema).option("basePath", f"{base}/{manifest.DATA}") \
        .parquet(*(f"{base}/{p}" for p in paths)).select(*spec.columns, *more)


def _read_parts(spark: SparkSession, spec: FactSpec, path: str, parts, *more: str) -> DataFrame:
    return read_files(spark, spec, path, [p.path for p in parts], *more)


def read_fact(spark: SparkSession, table: str, path: str, missing: str = "error",
              snapshot: Snapshot | None = None) -> DataFrame:
    """Read with the fixed schema (no inference): the newest version's parts and streamed rows.

    ``snapshot``: read that version instead, for a job that replaces what it read. A table
    that was never written raises, unless ``missing="empty"``.
    """
    if missing not in ("error", "empty"):
        raise ValueError("missing must be 'error' or 'empty'")
    spec = FACTS[table]
    snapshot = snapshot or manifest.latest(spark, path)
    streamed = files.exists(spark, stream_folder(path))
    if not snapshot.version and not streamed and missing == "error":
        raise FileNotFoundError(f"no table at {path}")
    if not streamed:
        return _read_parts(spark, spec, path, snapshot.parts)
    stream = spark.read.schema(spec.schema).option("ignoreMissingFiles", "true") \
        .parquet(stream_folder(path)).select(*spec.columns)         # retention may have dropped files
    return _read_parts(spark, spec, path, snapshot.parts).unionByName(stream) if snapshot.parts else stream


def _cutoff(as_of, days: int) -> _dt.date:
    if isinstance(as_of, _dt.datetime):
        as_of = as_of.date()
    elif not isinstance(as_of, _dt.date):
        as_of = _dt.date.fromisoformat(str(as_of))
    return as_of - _dt.timedelta(days=int(days))


def apply_retention(df: DataFrame, date_col: str, as_of, days: int = RETENTION_DAYS) -> DataFrame:
    """Keep rows whose partition date is within ``days`` of ``as_of``.

    A literal bound on the partition column, so Parquet partitions prune.
    NULL dates are kept (D20).
    """
    return df.filter(F.col(date_col).isNull() | (F.col(date_col) >= F.lit(_cutoff(as_of, days))))


def expire_partitions(spark: SparkSession, table: str, path: str, as_of) -> list[str]:
    """S11 on a stored table: drop the partitions older than its retention, in one commit, and
    delete their folders at once (readers of an older version lose them, as retention asks).

    Returns the expired partition names. Tables without retention or partitions
    (``data_health``) are left alone, and so are NULL dates (D20).
    """
    spec, base = FACTS[table], path.rstrip("/")
    if spec.retention_days is None or spec.partition_col is None:
        return []
    limit, prefix = _cutoff(as_of, spec.retention_days).isoformat(), f"{spec.partition_col}="

    def old(name: str) -> bool:
        day = name.removeprefix(prefix)
        return name.startswith(prefix) and not day.startswith("__") and day < limit

    expired = [p for p in manifest.latest(spark, base).parts if old(p.partition)]
    if expired:
        manifest.commit(spark, base, remove=[p.path for p in expired])
    gone = {p.partition for p in expired}
    for name in gone:
        files.delete(spark, f"{base}/{manifest.DATA}/{name}")
    for name in filter(old, files.folders(spark, stream_folder(path))):
        files.delete(spark, f"{stream_folder(path)}/{name}")
        gone.add(name)
    return sorted(gone)
