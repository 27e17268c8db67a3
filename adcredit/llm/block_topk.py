"""Exact top-k inner products by block-at-a-time pruning (operator 11).

Vectors get an order in which near ones are neighbours (signs about the mean of the components that
vary most, then a hash, then the id, so equal vectors follow each other by id). That order is cut into
document ranges, and each range into blocks. A block's forward index is its ids and integer
matrix; its summary is every component's (term's) least and greatest value. For a query, a block's
bound is the sum over the terms of the query's weight times the fitting extreme; no row of the block can
score more.

Three passes, each over (chunk of queries) x (document range):

1. bounds only: each query's most promising block of all;
2. these blocks are scored: the k-th best (score, id) there is the query's threshold;
3. every range: a query takes the blocks by falling bound, scores them through the forward
   index, raises its threshold, and stops when the next bound falls below it (or equals it and
   the block holds no smaller id). At most k rows a query and range go on, none below the threshold.

Queries are packed in chunks and sent to every range, a row a chunk and range, so neither side is ever
broadcast and no pair of rows exists outside a block's matrix product. Groups of equal vectors, however
large, lie in successive blocks whose bound is exact, and are skipped by their ids.

Defined results: every row is a candidate and every query row has its own result, also when ids
repeat; a query never meets rows of its own id; rows with a NULL id or an unusable vector (NULL,
NULL or non-finite components) take no part; missing last components (shorter and empty vectors)
count as 0; ties go to the smaller id; an empty table or no queries give no rows; other columns are
ignored. Scores are exact; components so large that one might not fit a long are an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adcredit.llm.common import discard, lean, written
from adcredit.llm.vectors import matrix, padded

RANGE = "slot int, part int, ids binary, vals binary, low binary, high binary, least binary"


def ranged(dims: int, block_rows: int, blocks: int):
    """``mapInArrow`` over (id, v) in document order: a row for each range of ``blocks`` blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slot, part, ids, vals = TaskContext.get().partitionId(), 0, [], []

        def row(i, x):
            at = np.arange(0, len(i), block_rows)
            order = np.lexsort((i, np.arange(len(i)) // block_rows))        # by id within a block
            i, x = i[order], x[order]
            cols = (i, x, np.minimum.reduceat(x, at, axis=0), np.maximum.reduceat(x, at, axis=0),
                    np.minimum.reduceat(i, at))
            return pa.RecordBatch.from_arrays(
                [pa.array([slot], pa.int32()), pa.array([part], pa.int32()),
                 *(pa.array([np.ascontiguousarray(c).tobytes()], pa.binary()) for c in cols)],
                ["slot", "part", "ids", "vals", "low", "high", "least"])

        size = block_rows * blocks
        for b in batches:
            ids.append(b.column(0).to_numpy(zero_copy_only=False))
            vals.append(matrix(b.column(1), dims))
            if sum(map(len, ids)) >= size:
                i, x = np.concatenate(ids), np.concatenate(vals)
                full = len(i) // size * size
                for at in range(0, full, size):
                    yield row(i[at:at + size], x[at:at + size])
                    part += 1
                ids, vals = [i[full:].copy()], [x[full:].copy()]
        if sum(map(len, ids)):
            yield row(np.concatenate(ids), np.concatenate(vals))

    return lean(run)


class Range:
    """The blocks of one range, as numbers that multiply exactly."""

    def __init__(self, row: dict, dims: int, block_rows: int, kind):
        self.kind, self.step = kind, block_rows
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.vals = np.frombuffer(row["vals"], np.int64).reshape(-1, dims)
        self.low, self.high = (np.frombuffer(row[c], np.int64).reshape(-1, dims).astype(kind)
                               for c in ("low", "high"))
        self.least = np.frombuffer(row["least"], np.int64)

    def bounds(self, q: np.ndarray) -> np.ndarray:
        """(queries, blocks): the sums of the term maxima."""
        return (np.maximum(q, 0) @ self.high.T + np.minimum(q, 0) @ self.low.T).astype(np.int64)

    def scores(self, q: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
        at = slice(block * self.step, (block + 1) * self.step)
        return (q @ self.vals[at].astype(self.kind).T).astype(np.int64), self.ids[at]


class Best:
    """The k best (score, id) of each query of a chunk, and its threshold."""

    def __init__(self, own: np.ndarray, k: int):
        self.own, self.k = own, k
        self.score = np.full(len(own), np.iinfo(np.int64).min)
        self.id = np.full(len(own), np.iinfo(np.int64).max)
        self.rows = [np.empty(0, np.int64)] * 3             # query, score, id

    def open(self, query: np.ndarray, bound: np.ndarray, least: np.ndarray) -> np.ndarray:
        """Whether a block of that bound and least id can still matter."""
        return (bound > self.score[query]) | ((bound == self.score[query]) & (least <= self.id[query]))

    def add(self, query: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        least, mine = self.score[query][:, None], self.id[query][:, None]
        keep = ((scores > least) | ((scores == least) & (ids <= mine))) & (ids != self.own[query][:, None])
        r, c = np.nonzero(keep)
        if not len(r):
            return
        touched = np.isin(self.rows[0], query)
        q, s, i = (np.concatenate([old[touched], new]) for old, new in
                   zip(self.rows, (query[r], scores[r, c], ids[c])))
        order = np.lexsort((i, ~s, q))
        q, s, i = q[order], s[order], i[order]
        first = np.flatnonzero(np.diff(q, prepend=-1))
        rank = np.arange(len(q)) - np.repeat(first, np.diff(np.append(first, len(q))))
        kth = rank == self.k - 1
        self.score[q[kth]], self.id[q[kth]] = s[kth], i[kth]
        best = rank < self.k
        self.rows = [np.concatenate([old[~touched], new[best]]) for old, new in zip(self.rows, (q, s, i))]


def _each(run, dims: int, block_rows: int, kind):
    """``mapInArrow``: ``run(row, queries, own ids, range)`` yields arrays, a batch each."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for n in range(b.num_rows):
                row = {c: b.column(j)[n].as_py() for j, c in enumerate(b.schema.names)}
                q = np.frombuffer(row["q"], np.int64).reshape(-1, dims).astype(kind)
                yield from run(row, q, np.frombuffer(row["own"], np.int64),
                               Range(row, dims, block_rows, kind))

    return lean(task)


def _batch(chunk: int, **cols) -> pa.RecordBatch:
    n = len(next(iter(cols.values())))
    return pa.RecordBatch.from_arrays([pa.array(np.full(n, chunk, np.int64)),
                                       *(pa.array(c) for c in cols.values())], ["chunk", *cols])


def _promising(row, q, own, r):
    """Each query's block of the greatest bound (then the least id) in this range."""
    bound = r.bounds(q)
    order = np.lexsort((np.broadcast_to(r.least, bound.shape), ~bound), axis=1)[:, 0]
    pos = np.arange(len(q))
    yield _batch(row["chunk"], pos=pos.astype(np.int32), bound=bound[pos, order], least=r.least[order],
                 block=order.astype(np.int32), slot=np.full(len(q), row["slot"], np.int32),
                 part=np.full(len(q), row["part"], np.int32))


def _thresholds(k: int):
    def run(row, q, own, r):
        best = Best(own, k)
        pos, block = (np.array([x[c] for x in row["seeds"]]) for c in ("pos", "block"))
        for b in np.unique(block):
            these = pos[block == b]
            best.add(these, *r.scores(q[these], b))
        full = pos[best.score[pos] > np.iinfo(np.int64).min]
        yield _batch(row["chunk"], pos=full.astype(np.int32), score=best.score[full], id=best.id[full])
    return run


def _search(k: int):
    def run(row, q, own, r):
        best = Best(own, k)
        for x in row["known"] or ():
            best.score[x["pos"]], best.id[x["pos"]] = x["score"], x["id"]
        bound = r.bounds(q)
        order = np.lexsort((np.broadcast_to(r.least, bound.shape), ~bound), axis=1)
        active = np.arange(len(q))
        for step in range(bound.shape[1]):
            block = order[active, step]
            more = best.open(active, bound[active, block], r.least[block])
            active, block = active[more], block[more]       # bounds only fall: the others are through
            if not len(active):
                break
            for b in np.unique(block):
                these = active[block == b]
                best.add(these, *r.scores(q[these], b))
        query, score, ids = best.rows
        yield _batch(row["chunk"], pos=query.astype(np.int32), query_id=own[query], vec_id=ids, score=score)
    return run


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id",
          vector_col: str = "v", block_rows: int = 256, range_blocks: int = 16,
          chunk_rows: int = 1024) -> DataFrame:
    """(query_id, rank, vec_id, score); ``vector_col`` holds array<long> in both tables."""
    if min(k, block_rows, range_blocks, chunk_rows) < 1:
        raise ValueError("k, block_rows, range_blocks and chunk_rows must be positive")
    spark = vectors.sparkSession

    def side(df):
        return df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v")) \
            .filter("id IS NOT NULL AND v IS NOT NULL AND forall(v, c -> c IS NOT NULL)")

    def measure(df):
        r = df.agg(F.count("*"), F.max(F.size("v")), F.min(F.array_min("v")), F.max(F.array_max("v"))).first()
        return r[0], r[1] or 0, max(-(r[2] or 0), r[3] or 0)

    rows, asked = side(vectors), side(queries)
    (n, d1, most), (n_queries, d2, most_asked) = measure(rows), measure(asked)
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    if not n or not n_queries:
        return empty
    dims = max(d1, d2, 1)
    largest = dims * max(most, 1) * max(most_asked, 1)
    if largest >= 2 ** 63:
        raise ValueError("components are too large: a score might not fit a long")
    kind = np.float64 if largest < 2 ** 53 else np.int64        # exact either way
    rows, asked = (t.withColumn("v", padded("v", dims)) for t in (rows, asked))

    spread = rows.select(Summarizer.metrics("mean", "variance").summary(array_to_vector("v")).alias("s")) \
        .select("s.*").first()
    widest = np.argsort(-spread["variance"].toArray(), kind="stable")[:16].tolist()
    code = sum((F.when(F.col("v")[d] > float(spread["mean"][d]), 1 << (15 - j)).otherwise(0)
                for j, d in enumerate(widest)), F.lit(0))

    def ranges(df, count, size, blocks, name):
        parts = max(1, -(-count // (size * blocks)))
        order = [code, F.xxhash64("v"), F.col("id")]
        return written(df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
                       .mapInArrow(ranged(dims, size, blocks), RANGE), name)

    blocks = ranges(rows, n, block_rows, range_blocks, "topk-blocks")
    chunks = ranges(asked, n_queries, chunk_rows, 1, "topk-queries")
    chunks_q = chunks.select((F.shiftleft(F.col("slot").cast("long"), 32) + F.col("part")).alias("chunk"),
                             F.col("ids").alias("own"), F.col("vals").alias("q"))
    slots = blocks.agg(F.max("slot")).first()[0] + 1

    def against_all(left):
        """Every chunk with every range: a copy of the chunk for each slot of ranges."""
        copies = left.withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(slots - 1))))
        return copies.repartition(slots, "slot").join(blocks.repartition(slots, "slot"), "slot")

    def apply(df, run, schema):
        return df.mapInArrow(_each(run, dims, block_rows, kind), "chunk long, " + schema)

    first = apply(against_all(chunks_q), _promising,
                  "pos int, bound long, least long, block int, slot int, part int")
    seeds = first.groupBy("chunk", "pos").agg(F.max_by(
        F.struct("slot", "part", "block"),
        F.struct("bound", F.bitwise_not("least").alias("least"))).alias("at")) \
        .select("chunk", "pos", "at.*") \
        .groupBy("chunk", "slot", "part").agg(F.collect_list(F.struct("pos", "block")).alias("seeds"))
    known = apply(seeds.join(chunks_q, "chunk").join(blocks, ["slot", "part"]), _thresholds(k),
                  "pos int, score long, id long") \
        .groupBy("chunk").agg(F.collect_list(F.struct("pos", "score", "id")).alias("known"))
    known = written(known, "topk-thresholds")
    found = apply(against_all(chunks_q.join(known, "chunk", "left")), _search(k),
                  "pos int, query_id long, vec_id long, score long")
    found = written(found, "topk-found")
    discard(known, blocks, chunks)
    best = Window.partitionBy("chunk", "pos").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")
