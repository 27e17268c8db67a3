"""Benchmark decontamination by size-partitioned MinHash containment (operator 7).

A document holds a benchmark item when it has at least ``percent`` % of the
item's distinct word shingles. MinHash estimates resemblance, which is tiny between a short
item and a long document, so both sides are partitioned by size: items by the power of
two of their shingle count, and for every such class the documents into
consecutive windows of twice that many shingles. An item in a document then
shares minima with the windows it lies in: over all windows, at least ``hashes`` / 4 matching
minima are expected wherever its shingles lie (a miss is below 1e-6 with 64).
One shared minimum makes a candidate, and every candidate is verified by exact containment
of the item's shingles in the whole document's.

The items are the stated query set. Every distinct text of an item is searched, and the item
is reported with the text that the document holds the largest share of (then the larger one). The texts are taken
in blocks of about ``block_items`` texts and ``block_bytes`` at most (a longer text is a block's one), each with its own
pass over the documents: a block is collected, broadcast, its findings are written, and it is destroyed before the
next. What the driver and a worker hold is one block, however many items there are and whatever their length.
Documents are never shuffled, but for those findings of several blocks that drop rows.

Defined results: items and documents without words match nothing; texts of fewer words than ``size`` are one
shingle (the whole sequence); items with a NULL text are left out; items with a NULL id cannot be
reported, but documents that hold them are dropped; repeated documents are
each reported, items with several texts once an id; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adcredit.llm.common import WordHashes, lean, shingle_hashes, words_of, written
from adcredit.llm.near_dedup import families


def minima(x: np.ndarray, at: np.ndarray, hashes: int) -> np.ndarray:
    """(windows, hashes) minima over the windows that start at ``at``."""
    mult, add = families(hashes)
    out = np.empty((len(at), hashes), np.uint32)
    buf = np.empty_like(x)
    for i in range(hashes):
        np.multiply(x, mult[i], out=buf)
        buf += add[i]
        out[:, i] = np.minimum.reduceat(buf, at) >> np.uint64(32)
    return out


def starts(sizes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of consecutive windows inside runs of ``sizes``, and the windows of each run."""
    counts = -(-sizes // width)
    first = np.cumsum(sizes) - sizes
    within = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    return np.repeat(first, counts) + within * width, counts


def width_of(n: int) -> int:
    """Window width for items of ``n`` shingles: twice their power of two, at least 4."""
    return max(4, 2 << (n.bit_length() - 1))


class ItemIndex:
    """Minima of a block of items, by size class."""

    def __init__(self, items: list[tuple[int, str]], size: int, hashes: int):
        memo = WordHashes()
        self.hashes, self.size = hashes, size
        self.ids, self.sets = [], []
        by_class = defaultdict(list)
        for item, text in items:
            s = np.unique(shingle_hashes(words_of(text), memo, size))
            if len(s):
                by_class[width_of(len(s))].append(len(self.ids))
                self.ids.append(item)
                self.sets.append(s)
        self.classes = []
        for width in sorted(by_class):
            members = np.array(by_class[width])
            sig = np.vstack([minima(self.sets[m], np.zeros(1, int), hashes) for m in members])
            bits = max(12, (64 * len(members)).bit_length())
            mask = np.uint32((1 << bits) - 1)
            hit = np.zeros((hashes, 1 << bits), bool)       # low bits that occur at all
            hit[np.arange(hashes), sig & mask] = True
            key = self._keys(np.arange(hashes), sig).ravel()
            order = np.argsort(key, kind="stable")
            self.classes.append((width, mask, hit, key[order], np.repeat(members, hashes)[order]))

    @staticmethod
    def _keys(function: np.ndarray, minimum: np.ndarray) -> np.ndarray:
        return function.astype(np.uint64) << np.uint64(32) | minimum.astype(np.uint64)

    def search(self, docs: list[np.ndarray]) -> list[list[tuple[int, int, int]]]:
        """(item, shingles of it, of these held) for each document's shingles in order."""
        out: list[list] = [[] for _ in docs]
        full = [d for d, x in enumerate(docs) if len(x)]
        at = 0
        while at < len(full) and self.classes:          # runs of about 64k shingles stay in cache
            stop, n = at, 0
            while stop < len(full) and (stop == at or n + len(docs[full[stop]]) <= 65_536):
                n += len(docs[full[stop]])
                stop += 1
            part = full[at:stop]
            for d, found in self._candidates([docs[d] for d in part]):
                out[part[d]] = self._verified(docs[part[d]], found)
            at = stop
        return out

    def _candidates(self, docs: list[np.ndarray]) -> list[tuple[int, set[int]]]:
        """Items that share a minimum with a window of the document."""
        found: dict[int, set[int]] = defaultdict(set)
        x, sizes = np.concatenate(docs), np.array([len(d) for d in docs])
        low, width, functions = None, 0, np.arange(self.hashes)
        for w, mask, hit, keys, members in self.classes:
            if low is None:
                at, sizes = starts(sizes, w)
                low = minima(x, at, self.hashes)
            else:                                       # widths are powers of two: merge windows
                at, sizes = starts(sizes, w // width)
                low = np.minimum.reduceat(low, at, axis=0)
            width = w
            row, i = np.nonzero(hit[functions, low & mask])
            owner = np.repeat(np.arange(len(docs)), sizes)
            key = self._keys(i, low[row, i])
            first, stop = np.searchsorted(keys, key), np.searchsorted(keys, key, "right")
            some = np.flatnonzero(stop > first)
            for d, x, y in zip(owner[row[some]].tolist(), first[some].tolist(), stop[some].tolist()):
                found[d].update(members[x:y].tolist())
        return list(found.items())

    def _verified(self, x: np.ndarray, candidates: set[int]) -> list[tuple[int, int, int]]:
        own, out = np.unique(x), []
        for m in sorted(candidates):
            s = self.sets[m]
            at = np.minimum(np.searchsorted(own, s), len(own) - 1)
            out.append((self.ids[m], len(s), int((own[at] == s).sum())))
        return out


def _found(texts: pa.Array, memo: WordHashes, index: ItemIndex) -> Iterator[list]:
    for i in range(0, len(texts), 300):
        yield from index.search([shingle_hashes(words_of(t.as_py()), memo, index.size)
                                 for t in texts[i:i + 300]])


def searcher(index, percent: int):
    """``mapInArrow`` over (id, text, digest); ``index`` is a broadcast ItemIndex."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, ix = WordHashes(), index.value
        for b in batches:
            docs, digests, items, sizes, held = [], [], [], [], []
            for doc, digest, found in zip(b.column(0).to_pylist(), b.column(2), _found(b.column(1), memo, ix)):
                best: dict[int, tuple[int, int]] = {}        # the text of each item held most
                for item, n, h in found:
                    if 100 * h >= percent * n:
                        m, k = best.get(item, (1, 0))
                        if (h * m, n) > (k * n, m):
                            best[item] = n, h
                for item, (n, h) in best.items():
                    docs.append(doc)
                    digests.append(digest.as_py())
                    items.append(item)
                    sizes.append(n)
                    held.append(h)
            yield pa.RecordBatch.from_arrays(
                [pa.array(docs, pa.int64()), pa.array(digests, pa.binary())]
                + [pa.array(c, pa.int64()) for c in (items, sizes, held)],
                ["doc_id", "digest", "item_id", "n_shingles", "n_held"])

    return lean(run)


def blocks_of(items: DataFrame, id_col: str, text_col: str, block_items: int, block_bytes: int,
              report: bool) -> list[DataFrame]:
    """The query set in bounded blocks by a hash of the text: distinct texts, without ids unless to ``report``."""
    rows = items.select((F.col(id_col) if report else F.lit(0)).cast("long").alias("item_id"),
                        F.col(text_col).cast("string").alias("text")) \
        .filter("item_id IS NOT NULL AND text IS NOT NULL").distinct()
    n, size = rows.agg(F.count("text"), F.sum(F.octet_length("text").cast("long"))).first()
    count = max(1, -(-n // block_items), -(-(size or 0) // block_bytes))
    if count == 1:
        return [rows]
    rows = written(rows, "benchmark-items")
    return [rows.filter(F.pmod(F.xxhash64("text"), F.lit(count)) == k) for k in range(count)]


def _index(spark: SparkSession, block: DataFrame, size: int, hashes: int):
    return spark.sparkContext.broadcast(
        ItemIndex([tuple(r) for r in block.orderBy("item_id", "text").collect()], size, hashes))


def _each(spark: SparkSession, blocks: list[DataFrame], size: int, hashes: int, search) -> DataFrame:
    """Findings of all blocks, with the number of the block, written block by block."""
    found = []
    for k, block in enumerate(blocks):
        index = _index(spark, block, size, hashes)
        found.append(written(search(index).withColumn("block", F.lit(k)), "benchmark-found"))
        index.destroy()
    return reduce(DataFrame.unionByName, found)


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id",
                 text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
                 size: int = 5, percent: int = 75, hashes: int = 64,
                 block_items: int = 5_000, block_bytes: int = 16 << 20) -> DataFrame:
    """(id, item, n_shingles, n_held): the items that each document holds."""
    _check(size, percent, hashes, block_items, block_bytes)
    spark = docs.sparkSession
    blocks = blocks_of(items, item_col, item_text_col, block_items, block_bytes, True)
    text = F.col(text_col).cast("string")
    # equal rows are told from other rows of an id only where several blocks are put together
    digest = F.unhex(F.md5(text)) if len(blocks) > 1 else F.lit(None).cast("binary")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), digest.alias("digest"))

    def search(index):
        return rows.mapInArrow(searcher(index, percent),
                               "doc_id long, digest binary, item_id long, n_shingles long, n_held long")
    if len(blocks) == 1:
        found = search(_index(spark, blocks[0], size, hashes))
    else:
        found = _best(_each(spark, blocks, size, hashes, search))
    return found.select(F.col("doc_id").alias(id_col), F.col("item_id").alias(item_col), "n_shingles", "n_held")


def _best(found: DataFrame) -> DataFrame:
    """The text held most of an item whose texts lie in several blocks, once for every row of the document."""
    key = ["doc_id", "digest", "item_id"]
    share = F.struct((F.col("n_held") / F.col("n_shingles")).alias("share"), "n_shingles", "n_held")
    by_block = found.groupBy(*key, "block").agg(F.max(share).alias("best"), F.count("block").alias("copies"))
    best = by_block.groupBy(*key).agg(F.max("best").alias("best"), F.max("copies").alias("copies"))
    return best.select(*key, F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))), "best.n_shingles",
                       "best.n_held")


def _check(size, percent, hashes, block_items, block_bytes) -> None:
    if min(size, hashes, block_items, block_bytes) < 1 or not 0 < percent <= 100:
        raise ValueError("size, hashes and the bounds of a block must be positive, percent in 1..100")


def _holders(index, percent: int, text_at: int, hold: bool):
    """``mapInArrow`` over whole rows: those that hold an item of the block, or those that hold none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, ix = WordHashes(), index.value
        for b in batches:
            keep = [any(100 * h >= percent * n for _, n, h in found) == hold
                    for found in _found(b.column(text_at), memo, ix)]
            yield b.filter(pa.array(keep, pa.bool_()))

    return lean(run)


def drop_contaminated(docs: DataFrame, items: DataFrame, text_col: str = "text",
                      item_col: str = "item_id", item_text_col: str = "text", size: int = 5,
                      percent: int = 75, hashes: int = 64,
                      block_items: int = 5_000, block_bytes: int = 16 << 20) -> DataFrame:
    """``docs``, every column, without the rows that hold an item."""
    _check(size, percent, hashes, block_items, block_bytes)
    spark = docs.sparkSession
    blocks = blocks_of(items, item_col, item_text_col, block_items, block_bytes, False)
    if len(blocks) == 1:
        index = _index(spark, blocks[0], size, hashes)
        return docs.mapInArrow(_holders(index, percent, docs.columns.index(text_col), False), docs.schema)
    text = F.col(text_col).cast("string")
    texts = docs.select(text.alias("text"))
    found = _each(spark, blocks, size, hashes, lambda index: texts.mapInArrow(
        _holders(index, percent, 0, True), "text string").select(F.unhex(F.md5("text")).alias("digest")))
    name = "_digest"
    while name in docs.columns:
        name += "_"
    return docs.withColumn(name, F.unhex(F.md5(F.coalesce(text, F.lit(""))))) \
        .join(found.select(F.col("digest").alias(name)).distinct(), name, "left_anti").select(*docs.columns)
