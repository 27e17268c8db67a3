"""Key index and row counts of a fact table's parts: look-ups and deep pages that open few files.

:func:`build` indexes the live parts that have no index yet, in one Spark job and one commit: the number of rows of
each part, and for every look-up column of the table the distinct 64-bit hashes of its values with the
file that holds them, sorted by hash, in a folder a part (``_index/<run>/<partition>/writer=<id>``). A look-up
reads the row groups of its hash in the folders of the dates asked for, and then opens only the files named there;
two values of one hash cost a file too many, never a row. Parts without an index, appended since the last
run, are read whole, as are rows that a stream wrote. An index never changes: it lives and dies with its part.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adcredit.functions.predicates import apply_filters, date_range
from adcredit.schemas import FACTS, FactSpec
from adcredit.sources import files, manifest
from adcredit.sources.manifest import Facts, Part, Snapshot
from adcredit.sources.sinks import read_fact, read_files, stream_folder

ENTRY = "column string, code long, file string"
#: Path of a data file below the table folder; partition values are dates, so nothing is escaped.
_FILE = rf"{manifest.DATA}/(?:[^/]+/)?c-[^/]+/[^/]+$"


def _code(value: Column) -> Column:
    return F.xxhash64(value.cast("string"))


def build(spark: SparkSession, table: str, path: str) -> int:
    """Index the live parts that are not indexed yet; returns their number.

    Keys are distinct per file before the shuffle, so a hot customer is one row a file. Parts that another
    writer removes meanwhile are left out of the commit.
    """
    spec, base, snapshot = FACTS[table], path.rstrip("/"), manifest.latest(spark, path)
    todo = [p for p in snapshot.parts if p.path not in snapshot.facts]
    if not todo:
        return 0
    run = f"{manifest.INDEX}/{manifest.new_id()}"
    rows = read_files(spark, spec, path, [p.path for p in todo], "_metadata.file_path") \
        .withColumn("file", F.regexp_extract("file_path", _FILE, 0))
    per_file = rows.groupBy("file").agg(F.count(F.lit(1)).alias("n"))
    folder = F.regexp_extract("file", r"^(.*)/[^/]+$", 1)
    counts = {r["part"]: r["n"] for r in per_file.groupBy(folder.alias("part"))
              .agg(F.sum("n").alias("n")).collect()}                    # a number a part
    held: set[str] = set()
    if spec.lookup_cols:
        entries = rows.select("file", F.explode(F.array(*[F.struct(
            F.lit(c).alias("column"), F.when(F.col(c).isNotNull(), _code(F.col(c))).alias("code"))
            for c in spec.lookup_cols])).alias("e")).select("file", "e.*").filter("code IS NOT NULL").distinct()
        lead = ["day", "writer"] if spec.partition_col else ["writer"]
        out = entries.withColumn("writer", F.regexp_extract("file", r"/(c-[^/]+)/[^/]+$", 1))
        if spec.partition_col:
            out = out.withColumn("day", F.regexp_extract("file", r"/[^/=]+=([^/]+)/", 1))
        out.hint("rebalance", *lead).sortWithinPartitions(*lead, "column", "code") \
            .write.partitionBy(*lead).parquet(f"{base}/{run}")
        if spec.partition_col:
            held = {f"{run}/{d}/{w}" for d in files.folders(spark, f"{base}/{run}")
                    for w in files.folders(spark, f"{base}/{run}/{d}")}
        else:
            held = {f"{run}/{w}" for w in files.folders(spark, f"{base}/{run}")}
    facts = {p.path: Facts(counts.get(p.path, 0), k if (k := _folder(spec, run, p)) in held else "")
             for p in todo}
    manifest.commit(spark, path, facts=facts)
    return len(todo)


def _folder(spec: FactSpec, run: str, part: Part) -> str:
    writer = part.path.rsplit("/", 1)[1]
    return f"{run}/day={part.partition.split('=', 1)[1]}/writer={writer}" if spec.partition_col \
        else f"{run}/writer={writer}"


def _iso(day) -> str | None:
    if day is None or str(day) == "":
        return None
    return (day.date() if isinstance(day, _dt.datetime) else day).isoformat() \
        if isinstance(day, _dt.date) else _dt.date.fromisoformat(str(day)).isoformat()


def parts_between(spec: FactSpec, snapshot: Snapshot, date_from=None, date_to=None) -> list[Part]:
    """The parts whose date lies in the range, both ends included; rows without a date lie in no range."""
    a, b = _iso(date_from), _iso(date_to)
    if spec.partition_col is None or (a is None and b is None):
        return list(snapshot.parts)
    days = [(p, p.partition.split("=", 1)[1]) for p in snapshot.parts]
    return [p for p, d in days if not d.startswith("__") and (a is None or d >= a) and (b is None or d <= b)]


def files_with(spark: SparkSession, table: str, path: str, column: str, values: list, date_from=None,
               date_to=None, snapshot: Snapshot | None = None) -> list[str]:
    """Paths below the table folder to read for the rows that hold one of ``values``: files of indexed parts, and
    whole folders of the others. At most the files of the dates asked for."""
    spec, base = FACTS[table], path.rstrip("/")
    if column not in spec.lookup_cols:
        raise ValueError(f"{table} has no look-up by {column}")
    snapshot = snapshot or manifest.latest(spark, path)
    parts = parts_between(spec, snapshot, date_from, date_to)
    found = [p.path for p in parts if not (f := snapshot.facts.get(p.path)) or (not f.keys and f.rows)]
    folders = [f"{base}/{f.keys}" for p in parts if (f := snapshot.facts.get(p.path)) and f.keys]
    wanted = [v for v in values if v is not None]
    if folders and wanted:
        codes = [r[0] for r in spark.createDataFrame([(str(v),) for v in wanted], "v string")
                 .select(_code(F.col("v"))).distinct().collect()]       # as many as values
        hits = spark.read.schema(ENTRY).parquet(*folders) \
            .filter((F.col("column") == column) & F.col("code").isin(codes)).select("file").distinct()
        found += [r[0] for r in hits.collect()]
    return sorted(found)


def lookup(spark: SparkSession, table: str, path: str, column: str, values: list, date_from=None,
           date_to=None, snapshot: Snapshot | None = None) -> DataFrame:
    """The rows whose ``column`` is one of ``values``, in a range of dates where one is given.

    Equal to filtering :func:`~adcredit.sources.sinks.read_fact`; a NULL value finds nothing, as with ``=``.
    """
    spec = FACTS[table]
    snapshot = snapshot or manifest.latest(spark, path)
    streamed = files.exists(spark, stream_folder(path))
    if not snapshot.version and not streamed:
        raise FileNotFoundError(f"no table at {path}")
    found = files_with(spark, table, path, column, values, date_from, date_to, snapshot)
    rows = read_files(spark, spec, path, found)
    if streamed:
        rows = rows.unionByName(read_fact(spark, table, path, snapshot=Snapshot()))
    rows = rows.filter(F.col(column).isin([v for v in values if v is not None]))
    return apply_filters(rows, date_range(spec.partition_col, date_from, date_to)) if spec.partition_col else rows


def row_counts(spark: SparkSession, table: str, path: str, date_from=None, date_to=None,
               snapshot: Snapshot | None = None) -> dict[str, int]:
    """Rows by partition folder ("" where the table has none). Only parts without an index are scanned."""
    spec = FACTS[table]
    snapshot = snapshot or manifest.latest(spark, path)
    parts, out = parts_between(spec, snapshot, date_from, date_to), {}
    for p in parts:
        out[p.partition] = out.get(p.partition, 0) + (f.rows if (f := snapshot.facts.get(p.path)) else 0)
    new = [p for p in parts if p.path not in snapshot.facts]
    if new:
        at = F.regexp_extract("file_path", rf"{manifest.DATA}/(?:([^/]+)/)?c-[^/]+/[^/]+$", 1)
        for r in read_files(spark, spec, path, [p.path for p in new], "_metadata.file_path") \
                .groupBy(at.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect():    # a number a date
            out[r["p"]] += r["n"]
    return out


def dates_of_page(counts: dict[str, int], limit: int, offset: int) -> tuple[list[str], int]:
    """The dates, newest first, that rows ``offset`` to ``offset + limit`` lie in, and the rows of newer dates.

    Rows without a date come last, as in a descending sort.
    """
    order = sorted(counts, key=lambda p: (not p.endswith("=__HIVE_DEFAULT_PARTITION__"), p), reverse=True)
    hit, before, seen = [], 0, 0
    for p in order:
        n = counts[p]
        if seen + n <= offset:
            before = seen + n
        elif seen < offset + limit:
            hit.append(p)
        seen += n
    return hit, before
