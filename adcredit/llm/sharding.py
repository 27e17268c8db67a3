"""Balanced label propagation over shards (operator 5), DataFrame functions only.

Documents with equal texts are linked. Copies of one text that start in the same shard move
together, so the graph that is iterated has at most ``shards`` cells a text, however many
copies there are; texts without copies have no links and stay out of it.

Every round, each text names one of its shards, and its documents elsewhere ask to move there. In even rounds
that is the fullest, in odd rounds the fullest among those with room for the whole text (if any has it), so that
texts refused by a full shard ask for another; ties go by a hash of text and round. The gain is the number of
links that a moved document mends. Quotas decide: a shard takes what fills it up to its target of linked
documents (documents without links make room: they can go anywhere) and as much again as the same round moves out
of it, so full shards exchange documents; requests are admitted by gain class
(powers of two), whole classes first, and the class at the edge in part, by a hash that is the same for
a text's documents in a shard, unless they are many. Rounds go on until six in a row
admit or move no document (ties fall anew each round, so one such round proves little); moves only ever merge a text's
cells or shift many copies towards more of them, so this ends. Only the sums per (shard, shard, gain class) go to the driver; no
round sorts or collects cells.

After the rounds the law ``rows`` is made exact: document counts differ by at most one. Each shard keeps
the documents up to its target, linked ones first; the surplus, mostly documents
without links, fills the free slots of the other shards. Ranks come from counts of
fine-grained buckets plus a rank inside each bucket; buckets split a text's copies by
a hash of the id, so no window sorts more than one bucket.

Defined results: a NULL text has size 1 and the checksum of the empty text, and NULL and
empty texts are equal; rows without an id are rows like others; repeated rows are separate rows with their own slots; an empty table
gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adcredit.llm.common import discard, whole_text, written

GAIN_CLASSES = 40
#: Rounds in a row that change nothing before the propagation ends.
PATIENCE = 6


def _asked(cells: DataFrame, loads: dict[int, int], targets: dict[int, int], shards: int,
           number: int, big: int) -> DataFrame:
    """The cells with the shard that their text names (``aim``), and the class of those that ask."""
    held = cells.groupBy("text_key", "shard").agg(F.sum("n").alias("here"))
    free = F.create_map(*[F.lit(x) for s in range(shards) for x in
                          (s, targets[s] - loads.get(s, 0))])
    each = F.collect_list(F.struct("here", "shard"))         # at most ``shards`` a text
    texts = held.groupBy("text_key").agg(F.sum("here").alias("copies"), each.alias("in")) \
        .filter(F.size("in") > 1)
    fits = (lambda c: free[c["shard"]] >= F.col("copies") - c["here"]) if number % 2 else \
        (lambda c: F.lit(True))
    best = texts.select("text_key", F.array_max(F.transform("in", lambda c: F.struct(
        fits(c).alias("fits"), c["here"].alias("here"),
        F.xxhash64("text_key", c["shard"], F.lit(number)).alias("tie"),
        c["shard"].alias("shard")))).alias("best")) \
        .select("text_key", F.col("best.shard").alias("aim"), F.col("best.here").alias("there"))
    wish = cells.join(held, ["text_key", "shard"]).join(best, "text_key", "left")
    # few documents move together and cut nothing; many may move in part, so only towards more
    asks = (F.col("aim") != F.col("shard")) & ((F.col("here") <= big) | (F.col("there") >= F.col("here")))
    return wish.withColumn("class", F.when(asks, F.least(
        F.lit(GAIN_CLASSES - 1), F.floor(F.log2(F.col("there") + 1)).cast("int"))))


def admitted(asked: np.ndarray, room: np.ndarray) -> np.ndarray:
    """Share of the requests that each shard admits, by gain class: (to, class).

    ``asked`` is (from, to, class), ``room`` what each shard may grow by. A shard's inflow is at most its room
    and its outflow, which the others' shares decide: quotas only fall from all that is asked
    until they hold together.
    """
    total = asked.sum(axis=0).astype(float)                   # (to, class)
    above = total[:, ::-1].cumsum(axis=1)[:, ::-1] - total    # asked in higher classes
    quota = total.sum(axis=1)
    while True:
        share = np.clip((quota[:, None] - above) / np.maximum(total, 1), 0, 1)
        out = (asked * share).sum(axis=(1, 2))
        new = np.minimum(quota, np.maximum(0, room + out))
        if (quota - new).max() < max(0.5, 1e-4 * total.sum() / len(total)):
            return share
        quota = new


def _round(cells: DataFrame, loads: dict[int, int], targets: dict[int, int], shards: int,
           number: int) -> DataFrame | None:
    """One round of requests and admissions; the cells with their new shard, None if none is admitted."""
    big = max(16, targets[0] // 64)
    wish = _asked(cells, loads, targets, shards, number, big)
    asked = np.zeros((shards, shards, GAIN_CLASSES))
    for r in wish.filter("class IS NOT NULL").groupBy("shard", "aim", "class") \
            .agg(F.sum("n").alias("n")).collect():           # a number a pair of shards and class
        asked[r["shard"], r["aim"], r["class"]] = r["n"]
    share = admitted(asked, np.array([targets[s] - loads.get(s, 0) for s in range(shards)]))
    if (asked * share).sum(axis=(0, 2)).max() < 1:
        return None
    mine = F.get(F.lit(share.ravel().tolist()), F.col("aim") * GAIN_CLASSES + F.col("class"))
    lot = F.pmod(F.xxhash64("text_key", "shard", F.lit(number), F.when(F.col("here") > big, F.col("home"))),
                 F.lit(1_000_000)) / 1_000_000.0
    goes = F.coalesce(lot < mine, F.lit(False))
    return wish.select("text_key", "home", "n", F.when(goes, F.col("aim")).otherwise(F.col("shard")).alias("shard"),
                       F.when(goes, F.col("n")).otherwise(F.lit(0)).alias("moved"))


def propagate(cells: DataFrame, loads: dict[int, int], targets: dict[int, int], shards: int,
              rounds: int | None = None) -> DataFrame:
    """(text_key, home, n, shard) after the last round that helps; ``loads``: linked documents.

    ``rounds`` stops earlier, with links left that more rounds would mend.
    """
    number = idle = 0
    while idle < PATIENCE and (rounds is None or number < rounds):
        moved = _round(cells, loads, targets, shards, number)
        number += 1
        if moved is None:
            idle += 1                                        # nothing was written
            continue
        moved = written(moved, "shard-cells")
        sums = moved.groupBy("shard").agg(F.sum("n").alias("n"), F.sum("moved").alias("m")) \
            .collect()                                       # two numbers a shard
        loads = {r["shard"]: r["n"] for r in sums}
        idle = 0 if any(r["m"] for r in sums) else idle + 1
        discard(cells)
        cells = moved.drop("moved")
        cells.scratch_path = moved.scratch_path
    return cells


def shard(docs: DataFrame, shards: int = 8, rounds: int | None = None, id_col: str = "doc_id",
          text_col: str = "text", spread: int = 64) -> DataFrame:
    """(id, size, text_crc32, shard, slot) of every row."""
    if shards < 1 or spread < 1 or (rounds is not None and rounds < 0):
        raise ValueError("shards and spread must be positive, rounds not negative")
    text = whole_text(text_col)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("t")).select(
        "id", (F.octet_length("t") + 1).cast("long").alias("size"),
        F.crc32("t").alias("text_crc32"), F.unhex(F.md5("t")).alias("text_key"),
        F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int").alias("home"))
    rows = written(rows, "shard-rows")
    total = rows.count()
    targets = {s: total // shards + (s < total % shards) for s in range(shards)}
    cells = rows.groupBy("text_key", "home").agg(F.count(F.lit(1)).alias("n"))
    linked = cells.groupBy("text_key").agg(F.sum("n").alias("copies")).filter("copies > 1")
    cells = written(cells.join(linked.select("text_key"), "text_key")
                    .select("text_key", "home", "n", F.col("home").alias("shard")), "shard-cells")
    loads = {r["home"]: r["n"] for r in
             cells.groupBy("home").agg(F.sum("n").alias("n")).collect()}     # a number a shard
    cells = propagate(cells, loads, targets, shards, rounds)
    # exact law: rank within the shard, linked documents first
    placed = rows.join(cells.select("text_key", "home", "shard"), ["text_key", "home"], "left") \
        .select("id", "size", "text_crc32", "text_key",
                F.coalesce("shard", "home").alias("shard"),
                F.col("shard").isNull().cast("int").alias("single"),
                F.pmod(F.xxhash64("text_key"), F.lit(spread)).cast("int").alias("part"),
                F.pmod(F.xxhash64("id", F.lit("slot")), F.lit(spread)).cast("int").alias("salt"))
    placed = written(placed, "shard-placed")
    bucket = ["shard", "single", "part", "salt"]
    # at most shards * 2 * spread * spread rows, a bound that the data do not move
    sizes = placed.groupBy(*bucket).agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy(*bucket[1:]) \
        .rowsBetween(Window.unboundedPreceding, -1)
    base = sizes.select(*bucket, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy(*bucket).orderBy("text_key", "id")
    ranked = placed.withColumn("own", F.row_number().over(inside) - 1).join(base, bucket) \
        .withColumn("rank", F.col("base") + F.col("own"))
    counts = {r["shard"]: r["n"] for r in
              placed.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect()}
    # surplus rows of all shards in one line, laid over the free slots of all shards
    surplus_at, seen, slots, free_at = {}, 0, [], 0
    for s in range(shards):
        over = counts.get(s, 0) - targets[s]
        surplus_at[s] = seen - targets[s]
        seen += max(0, over)
        if over < 0:
            slots.append((s, free_at, counts.get(s, 0)))
            free_at -= over
    line = F.create_map(*[F.lit(x) for s in range(shards) for x in (s, surplus_at[s])])
    limit = F.create_map(*[F.lit(x) for s in range(shards) for x in (s, targets[s])])
    at = F.col("rank") + line[F.col("shard")]
    to, slot = F.col("shard"), F.col("rank")
    for s, start, taken in slots:                            # at most ``shards`` intervals
        here = (F.col("rank") >= limit[F.col("shard")]) & (at >= start)
        to = F.when(here, F.lit(s)).otherwise(to)
        slot = F.when(here, at - start + taken).otherwise(slot)
    return ranked.select(F.col("id").alias(id_col), "size", "text_crc32",
                         to.cast("int").alias("shard"), slot.cast("long").alias("slot"))
