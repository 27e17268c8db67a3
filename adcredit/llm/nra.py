"""Ranked lexical search by NRA, no random access (operator 12).

Every term's list of (document, impact) is cut by falling impact into segments, one a tier: tier r holds the
postings that add (weight times impact) between 2^-r and 2^-(r+1) of the largest addition to a score, the last
one all the rest. Tiers are
partitions of the written index, so each round reads every list sequentially, one tier further than
the round before, and never looks a document up. Rare terms' lists are read to their end in the first tiers;
the longest lists, those of frequent terms, give little a posting and come last.

After a round a document has for an item a lower score (what its read postings give) and an upper
one (each term not yet seen in it might still give the list's frontier, the largest impact behind
what was read). Rounds go on until

* membership: no unseen document can reach the item's k-th lower score, that is the sum of the frontiers lies below
  it. Then only documents whose upper score reaches the k-th lower one stay candidates, and later
  tiers are read for them alone;
* ties and final scores: every candidate's lower score equals its upper one. The item leaves.

The last tiers hold everything, so the loop ends. Scores are sums of read postings, recomputed from
the tiers in each round: no state lives outside the written tables. Once all memberships are settled one round
reads the lists to their end, for the candidates only.

Only terms of items enter the index. Tasks leave out the others by a bit table of fixed size (``BITS``), and the join
with the items' terms themselves decides.

Defined results: every row of ``items`` and of ``docs`` counts for itself, also when ids repeat or texts are
equal; a NULL or empty text has no terms and ranks nothing; equal scores go to the smaller
doc_id (NULL last), then to the earlier row; documents of score 0 are not returned; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adcredit.llm.common import discard, lean, written
from adcredit.session import shared_dir

#: ASCII other than letters and digits separates terms; A-Z become a-z; all other bytes are kept.
_TABLE = bytes(c if c >= 0x80 else ord(chr(c).lower()) if chr(c).isalnum() else 0x20 for c in range(256))
BITS = 1 << 20
LAST_TIER = 12


def terms_of(text: bytes | None) -> list[bytes]:
    return text.translate(_TABLE).split() if text else []


def bit_of(term: bytes) -> int:
    return xxhash.xxh3_64_intdigest(term) % BITS


class Wanted(dict):
    """term -> whether its bit is set; remembers at most ``bound`` terms."""

    def __init__(self, bits: np.ndarray, bound: int = 200_000):
        super().__init__()
        self.bits, self.bound = bits, bound

    def __missing__(self, term: bytes) -> bool:
        if len(self) >= self.bound:
            self.clear()
        known = bool(self.bits[bit_of(term)])
        if len(term) <= 64:
            self[term] = known
        return known


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows, terms = [], []
        for row, text in zip(b.column(0).to_pylist(), b.column(1)):
            own = set(terms_of(text.as_py()))
            rows += [row] * len(own)
            terms += own
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows, pa.int64()), pa.array(terms, pa.binary()),
             pa.array([bit_of(t) for t in terms], pa.int32())], ["item", "term", "bit"])


def _postings(shared):
    """Documents' wanted terms; a row with a NULL term states each document's length."""
    schema = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("n", pa.int64()),
                        ("term", pa.binary()), ("tf", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = Wanted(shared.value)

        def flushed(rows, ids, lengths, held, terms, tfs):
            sizes = np.array(held, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows, pa.int64()), pa.array(ids, pa.int64()), pa.array(lengths, pa.int64()),
                 pa.nulls(len(rows), pa.binary()), pa.array(np.zeros(len(rows), np.int64))], schema=schema)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(np.array(rows, np.int64), sizes)), pa.nulls(len(terms), pa.int64()),
                 pa.array(np.repeat(np.array(lengths, np.int64), sizes)), pa.array(terms, pa.binary()),
                 pa.array(tfs, pa.int64())], schema=schema)

        for b in batches:
            rows, ids, lengths, held, terms, tfs = [], [], [], [], [], []
            for row, doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                words = terms_of(text.as_py())
                if not words:
                    continue
                counts = Counter(words)
                own = [t for t in counts if wanted[t]]
                rows.append(row)
                ids.append(doc)
                lengths.append(len(words))
                held.append(len(own))
                terms += own
                tfs += [counts[t] for t in own]
                if len(terms) > 200_000:
                    yield from flushed(rows, ids, lengths, held, terms, tfs)
                    rows, ids, lengths, held, terms, tfs = [], [], [], [], [], []
            if rows:
                yield from flushed(rows, ids, lengths, held, terms, tfs)

    return lean(run)


class Index:
    """The impact-sorted lists of the items' terms, in tiers, as written tables."""

    def __init__(self, docs: DataFrame, items: DataFrame, id_col: str, text_col: str, item_col: str,
                 item_text_col: str):
        spark = docs.sparkSession
        self.items = written(items.select(
            F.monotonically_increasing_id().alias("item"), F.col(item_col).cast("long").alias("item_id"),
            F.col(item_text_col).cast("string").cast("binary").alias("text")), "nra-items")
        terms = written(self.items.select("item", "text").mapInArrow(
            lean(_item_terms), "item long, term binary, bit int"), "nra-item-terms")
        bits = np.zeros(BITS, bool)
        bits[terms.select("bit").distinct().toPandas()["bit"].to_numpy()] = True    # BITS rows at most
        shared = spark.sparkContext.broadcast(bits)
        found = written(docs.select(
            F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"),
            F.col(text_col).cast("string").cast("binary").alias("text"))
            .mapInArrow(_postings(shared), "row long, doc_id long, n long, term binary, tf long"), "nra-found")
        shared.destroy()
        self.docs = found.filter("term IS NULL")
        n_docs, total = self.docs.agg(F.count("*"), F.sum("n")).first()
        self.n_docs, self.total = n_docs, total or 1

        size = F.expr(f"10 + (90 * n * {self.n_docs}L) DIV {self.total}L")
        lists = found.filter("term IS NOT NULL").withColumn("m", size) \
            .withColumn("impact", F.expr("(1000000000 * tf) DIV (1000 * tf + 8 * m)"))
        weight = F.floor(F.lit(1000.0) * F.log(F.lit(float(2 * self.n_docs + 2)) / (2 * F.col("df") + 1)))
        weights = lists.groupBy("term").agg(F.count("*").alias("df"), F.max("impact").alias("top")) \
            .join(terms.select("term").distinct(), "term") \
            .select("term", F.monotonically_increasing_id().alias("term_no"),
                    weight.cast("long").alias("w"), "top")
        weights = written(weights, "nra-weights")
        largest = weights.agg(F.max(F.col("w") * F.col("top"))).first()[0] or 1
        tier = F.when(F.col("gives") <= 0, LAST_TIER).otherwise(F.least(F.lit(LAST_TIER), F.floor(
            F.log2(F.lit(float(largest)) / F.col("gives"))))).cast("int")
        # a broadcast join (where the terms are few) leaves each document's postings in one file, in order
        self.postings = self._by_tier(lists.join(weights, "term")
                                      .select("term_no", "row", (F.col("w") * F.col("impact")).alias("gives"))
                                      .withColumn("tier", tier))
        self.terms = written(weights.join(terms, "term").select("item", "term_no"), "nra-terms")
        self.segments = written(self.postings.groupBy("term_no", "tier").agg(F.max("gives").alias("most")),
                                "nra-segments")
        self.tiers = sorted(r[0] for r in self.segments.select("tier").distinct().collect())
        self.found = found
        discard(terms, weights)

    @staticmethod
    def _by_tier(postings: DataFrame) -> DataFrame:
        spark = postings.sparkSession
        path = shared_dir(spark, "nra-lists")
        postings.write.partitionBy("tier").parquet(path)
        out = spark.read.schema(postings.schema).parquet(path)
        out.scratch_path = path
        return out

    def frontiers(self, tier: int) -> DataFrame:
        """(item, term_no, ahead): what a posting behind ``tier`` might still give at most."""
        ahead = self.segments.filter(F.col("tier") > tier).groupBy("term_no").agg(F.max("most").alias("most"))
        return self.terms.join(ahead, "term_no", "left").select(
            "item", "term_no", F.coalesce("most", F.lit(0)).alias("ahead"))


def search(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score), the k best documents of each item."""
    if k < 1:
        raise ValueError("k must be positive")
    spark = docs.sparkSession
    index = Index(docs, items, id_col, text_col, item_col, item_text_col)
    done: list[DataFrame] = []
    scratch = []
    floors = written(index.terms.select("item").distinct().withColumn("floor", F.lit(0).cast("long")),
                     "nra-open")            # open items, and the k-th lower score known so far
    near: DataFrame | None = None           # (item, row, floor): candidates of items with settled membership
    todo = list(index.tiers)                # none: no term of any item occurs
    while todo:
        tier = todo.pop(0)
        terms = written(index.frontiers(tier), "nra-frontiers")
        unseen = terms.groupBy("item").agg(F.sum("ahead").alias("unseen"))
        lists = index.postings.filter(F.col("tier") <= tier).select("term_no", "row", "gives")
        sums = [F.sum("gives").alias("low"), F.sum("ahead").alias("past")]
        read = lists.join(terms.join(floors, "item"), "term_no").groupBy("item", "row", "floor").agg(*sums) \
            .withColumn("member", F.lit(False))
        if near is not None:
            again = lists.join(near, "row").join(terms, ["item", "term_no"]) \
                .groupBy("item", "row", "floor").agg(*sums)
            read = read.unionByName(again.withColumn("member", F.lit(True)))
        # what cannot reach the k-th lower score of the round before is out
        read = written(read.join(unseen, "item")
                       .withColumn("high", F.col("low") + F.col("unseen") - F.col("past"))
                       .filter("high >= floor").select("item", "row", "low", "high", "unseen", "member"),
                       "nra-read")
        kth = read.withColumn("r", F.row_number().over(Window.partitionBy("item").orderBy(F.desc("low")))) \
            .filter(F.col("r") <= k).groupBy("item") \
            .agg(F.min("low").alias("kth"), F.count("*").alias("held")) \
            .select("item", F.when(F.col("held") >= k, F.col("kth")).otherwise(0).alias("floor"))
        bounded = read.join(kth, "item").filter("high >= floor") \
            .withColumn("member", F.expr("member OR unseen = 0 OR unseen < floor"))
        state = written(bounded.groupBy("item", "floor").agg(
            F.max("member").alias("member"), F.max(F.col("high") > F.col("low")).alias("loose")), "nra-state")
        kept = written(bounded.filter("member").join(state.select("item", "loose"), "item")
                       .select("item", "row", "low", "floor", "loose"), "nra-kept")
        done.append(kept.filter("NOT loose").select("item", "row", "low"))
        near = kept.filter("loose").select("item", "row", "floor")
        # open: not settled now or before; items of which nothing was read yet stay open too
        unsettled = written(floors.join(state, "item", "left").join(
            state.filter("member").select("item"), "item", "left_anti")
            .select("item", F.coalesce(state["floor"], floors["floor"]).alias("floor")), "nra-open")
        scratch.append(kept)
        discard(terms, read, state, floors)
        floors = unsettled
        if todo and not floors.take(1):
            todo = todo[-1:] if near.take(1) else []
    if not done:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    best = reduce(DataFrame.unionByName, done).filter("low > 0").join(index.docs.select("row", "doc_id"), "row")
    order = Window.partitionBy("item").orderBy(F.desc("low"), F.asc_nulls_last("doc_id"), "row")
    best = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    out = written(best.join(index.items.select("item", "item_id"), "item")
                  .select("item_id", "rank", "doc_id", F.col("low").alias("score")), "nra-best")
    discard(index.items, index.terms, index.segments, index.postings, index.found, floors, *scratch)
    return out
