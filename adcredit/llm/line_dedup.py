"""Line deduplication with levelled sorted runs (operator 10).

A :class:`LineRuns` holds line hashes as runs: tables bucketed and sorted by the hash, so that a
merge join reads them without a shuffle. A new batch is aggregated to (key, documents,
last document) and merge-anti-joined with the runs: keys that no run has are added as the
batch's own run; keys that a run has go into its run of repeats, which only holds counts to add. When
a level holds ``fanout`` runs they are compacted into one of the next level.

:func:`drop_lines` feeds it documents in batches by a hash of the id and then drops, from every
document but the last that holds it, each line whose key is long enough and lies in
enough documents. A key is the line stripped of blanks at both ends, A-Z in lower case.
Per key only counts and maxima are shuffled (after a map-side combine), so a line that a third of
all documents hold is one row a task.

Defined results: a NULL or empty text is one empty line; a line repeated in a document
counts once for it; rows that share an id are one document; rows without an id count together as one document,
which is never the last and keeps all its lines; when the last document holds a
line several times, all of these stay; an empty table gives an empty table; other columns
are ignored.
"""

from __future__ import annotations

import string
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adcredit.llm.common import discard, whole_text, written
from adcredit.session import shared_dir
from adcredit.sources import files

_BLANKS = " \t\n\x0b\f\r"


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(_BLANKS)), string.ascii_uppercase,
                       string.ascii_lowercase)


class LineRuns:
    """Levelled runs of (key, docs, last)."""

    def __init__(self, spark: SparkSession, buckets: int = 32, fanout: int = 3):
        if buckets < 1 or fanout < 2:
            raise ValueError("buckets must be positive, fanout at least 2")
        self.spark, self.buckets, self.fanout = spark, buckets, fanout
        self.levels: list[list[str]] = []        # runs of first occurrences
        self.repeats: list[list[str]] = []       # runs of later counts
        self.paths: dict[str, str] = {}

    def _write(self, rows: DataFrame) -> str:
        """A run from rows that are dealt to ``buckets`` partitions by key."""
        name = f"line_run_{uuid.uuid4().hex[:12]}"
        self.paths[name] = shared_dir(self.spark, name)
        (rows.select("key", "docs", "last")
         .write.bucketBy(self.buckets, "key").sortBy("key").format("parquet")
         .option("path", self.paths[name]).saveAsTable(name))
        return name

    def _sums(self, names: list[str]) -> DataFrame:
        """One row a key over several runs.

        Read as plain files: a union of bucketed tables is planned as if it kept
        their buckets, but does not, and the sums would come out in parts.
        """
        schema = "key binary, docs long, last long"
        runs = self.spark.read.schema(schema).parquet(*[self.paths[n] for n in names])
        return runs.repartition(self.buckets, "key").groupBy("key").agg(
            F.sum("docs").alias("docs"), F.max("last").alias("last"))

    def _push(self, levels: list[list[str]], name: str) -> None:
        """Add a run to level 0; merge a full level into one run of the next."""
        level = 0
        while True:
            if len(levels) == level:
                levels.append([])
            levels[level].append(name)
            if len(levels[level]) < self.fanout:
                return
            name = self._write(self._sums(levels[level]))
            self._forget(levels[level])
            levels[level] = []
            level += 1

    def add(self, batch: DataFrame) -> None:
        """``batch``: (key, docs, last), one row a key, of documents not added before."""
        if not any(self.levels):                 # the first batch is a run as it is
            self._push(self.levels, self._write(batch.repartition(self.buckets, "key")))
            return
        stored = written(batch, "line-batch")
        rows = stored.repartition(self.buckets, "key")
        fresh = rows
        for name in [n for level in self.levels for n in level]:      # merge-anti-join the runs
            fresh = self._without(fresh, name)
        name = self._write(fresh)
        self._push(self.repeats, self._write(self._without(rows, name)))     # keys that its own run lacks
        self._push(self.levels, name)
        discard(stored)

    def _without(self, rows: DataFrame, name: str) -> DataFrame:
        return rows.join(self.spark.table(name).select("key").hint("merge"), "key", "left_anti")

    def counts(self) -> DataFrame:
        """(key, docs, last) over all batches."""
        if not any(self.levels):
            return self.spark.createDataFrame([], "key binary, docs long, last long")
        return self._sums([n for levels in (self.levels, self.repeats) for lv in levels for n in lv])

    def _forget(self, names: list[str]) -> None:
        for name in names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
            files.delete(self.spark, self.paths.pop(name))

    def close(self) -> None:
        self._forget([n for levels in (self.levels, self.repeats) for lv in levels for n in lv])
        self.levels, self.repeats = [], []


def drop_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               least_chars: int = 40, least_docs: int = 5, batches: int = 4,
               buckets: int | None = None) -> DataFrame:
    """(id, n_lines, n_dropped, kept_text) of every row."""
    spark = docs.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), whole_text(text_col).alias("text")) \
        .select("id", "text", F.xxhash64("text").alias("row"))
    lines = rows.select("id", "row", F.posexplode(F.split("text", "\n")).alias("pos", "line")) \
        .select("id", "row", "pos", line_key(F.col("line")).alias("key")) \
        .filter(F.char_length("key") >= least_chars) \
        .select("id", "row", "pos", F.unhex(F.md5("key")).alias("key"),
                F.pmod(F.xxhash64("id"), F.lit(batches)).cast("int").alias("batch"))
    path = shared_dir(spark, "lines")
    lines.write.partitionBy("batch").parquet(path)
    stored = spark.read.schema(lines.schema).parquet(path)
    runs = LineRuns(spark, buckets)
    try:
        for k in range(batches):
            runs.add(stored.filter(F.col("batch") == k).groupBy("key", "id").agg(F.lit(1))
                     .groupBy("key").agg(F.count(F.lit(1)).alias("docs"), F.max("id").alias("last")))
        common = written(runs.counts().filter(F.col("docs") >= least_docs).select("key", "last"),
                         "common-lines")
    finally:
        runs.close()
    gone = stored.join(common, "key").filter("id <> last") \
        .groupBy("id", "row").agg(F.collect_set("pos").alias("gone"))   # one document's lines
    each = F.split("text", "\n")
    out = rows.join(gone, ["id", "row"], "left").select(
        "id", each.alias("lines"), F.coalesce("gone", F.array().cast("array<int>")).alias("gone"))
    kept = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone"))
    return out.select(
        F.col("id").alias(id_col), F.size("lines").cast("long").alias("n_lines"),
        F.size("gone").cast("long").alias("n_dropped"),
        F.array_join(F.transform(kept, lambda i: F.get(F.col("lines"), i)), "\n").alias("kept_text"))
