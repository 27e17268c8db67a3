"""Near duplicates by MinHash, exactly confirmed (operator 8).

Two documents are linked when the Jaccard similarity of their sets of word
shingles is at least ``percent`` / 100. The steps:

1. every document gets ``hashes`` universal hash minima, banded into keys; equal shingle
   sets form one class, which its smallest id stands for, so copies cost nothing more;
2. every bucket (band key) names its smallest id as leader; each document is compared with the leader it
   shares most buckets with, first by signature, then on the full sets;
3. components of these links (:mod:`.components`);
4. buckets that still hold several components: their documents outside the bucket's largest
   component are compared with all its members of other components, block by block (at most
   about ``block`` x ``block`` documents a task group), by signature, and what passes on the full
   sets. The first two rounds compare each with one block only and confirm the nearest document there,
   which merges most of what is left of a large group of near copies; the last confirms every
   pair that is still open.
   Documents that are connected already are not compared again;
5. components of all links.

No candidate is dropped or capped: a pair is missed only if its minima share
no band (below 1e-5 at 75 % with 32 bands of 4) or its signature, which has ``checks`` more
minima than the bands, is off by ``margin`` (4.5 standard deviations).

Defined results: NULL, empty and blank texts have no shingles and are linked
with nothing; a text of fewer words than ``size`` has its whole sequence as one shingle;
rows that share an id count as one document for linking, and each keeps its row; rows with a NULL id
come after all ids, those of one text as one document, and a group of only such rows has a number
above all ids as its component; an empty table
gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adcredit.llm.common import (WordHashes, discard, known_ids, lean, shingle_hashes, words_of,
                                written)
from adcredit.llm.components import components

# Banded minima (32 bits, in bands of ROWS), and minima for verification only (8 bits).
HASHES, ROWS, CHECKS = 128, 4, 640


def families(hashes: int = HASHES) -> tuple[np.ndarray, np.ndarray]:
    """Odd multipliers and offsets of the multiply-add family (fixed seed)."""
    r = np.random.default_rng(20240531).integers(0, 2 ** 63, (hashes, 2), np.uint64)
    return r[:, 0] * np.uint64(2) + np.uint64(1), r[:, 1].copy()


def signatures(sets: list[np.ndarray], hashes: int = HASHES) -> np.ndarray:
    """Minima of every set under every function: (sets, hashes) of 32 bits."""
    mult, add = families(hashes)
    out = np.empty((len(sets), hashes), np.uint32)
    start = 0
    while start < len(sets):                    # runs of about 64k shingles stay in cache
        stop, n = start, 0
        while stop < len(sets) and (stop == start or n + len(sets[stop]) <= 65_536):
            n += len(sets[stop])
            stop += 1
        x = np.concatenate(sets[start:stop])
        at = np.concatenate(([0], np.cumsum([len(s) for s in sets[start:stop - 1]]))).astype(int)
        buf = np.empty_like(x)
        for i in range(hashes):
            np.multiply(x, mult[i], out=buf)
            buf += add[i]
            out[start:stop, i] = np.minimum.reduceat(buf, at) >> np.uint64(32)
        start = stop
    return out


def band_keys(sig: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One 64-bit key per band of ``rows`` minima, different for every band."""
    n, hashes = sig.shape
    part = sig.reshape(n, hashes // rows, rows).astype(np.uint64)
    key = np.broadcast_to(np.arange(1, hashes // rows + 1, dtype=np.uint64), part.shape[:2]).copy()
    for j in range(rows):
        key = (key ^ part[:, :, j]) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(31)
    return key.view(np.int64)


def _sets(texts: list[str | None], memo: WordHashes, size: int) -> list[np.ndarray]:
    return [np.unique(shingle_hashes(words_of(t), memo, size)) for t in texts]


def _parts(sets, most: int = 300) -> Iterator[slice]:
    for i in range(0, len(sets), most):
        yield slice(i, i + most)


def sketcher(size: int, hashes: int, rows: int):
    """``mapInArrow`` over (id, text): set size, set digest and band keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = WordHashes()
        for b in batches:
            for part in _parts(b.column(1)):
                texts = b.column(1)[part].to_pylist()
                sets = _sets(texts, memo, size)
                full = [s for s in sets if len(s)]
                keys = iter(band_keys(signatures(full, hashes), rows) if full else ())
                yield pa.RecordBatch.from_arrays([
                    b.column(0)[part],
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                    pa.array([next(keys) if len(s) else None for s in sets],
                             pa.list_(pa.int64()))], ["id", "n", "digest", "bands"])

    return lean(run)


def packed(sig: np.ndarray, hashes: int) -> list[bytes]:
    """Signatures as bytes: the banded minima whole, the low byte of the others."""
    return [a.tobytes() + b.tobytes() for a, b in
            zip(sig[:, :hashes], sig[:, hashes:].astype(np.uint8))]


def unpacked(sigs: list[bytes], hashes: int) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(b"".join(sigs), np.uint8).reshape(len(sigs), -1)
    return raw[:, :4 * hashes].copy().view(np.uint32), raw[:, 4 * hashes:]


def profiler(size: int, hashes: int, checks: int):
    """``mapInArrow`` over (id, leader, class, text): full set and signature.

    Rows whose text is not of the class that the id stands for are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = WordHashes()
        for b in batches:
            for part in _parts(b.column(0)):
                sets = _sets(b.column(3)[part].to_pylist(), memo, size)
                own = [len(s) > 0 and xxhash.xxh3_128_digest(s.tobytes()) == d
                       for s, d in zip(sets, b.column(2)[part].to_pylist())]
                sets = [s for s, o in zip(sets, own) if o]
                if sets:
                    keep = pa.array(own)
                    yield pa.RecordBatch.from_arrays([
                        b.column(0)[part].filter(keep), b.column(1)[part].filter(keep),
                        pa.array([s.tobytes() for s in sets], pa.binary()),
                        pa.array(packed(signatures(sets, hashes + checks), hashes), pa.binary())],
                        ["id", "leader", "shingles", "sig"])

    return lean(run)


def confirmer(percent: int, margin: float, hashes: int):
    """``mapInArrow`` over (a, b, sig_a, sig_b, set_a, set_b): the pairs that are linked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            keep = []
            for sa, sb, xa, xb in zip(*(t.column(i) for i in range(2, 6))):
                whole, low = unpacked([sa.as_py(), sb.as_py()], hashes)
                same = (whole[0] == whole[1]).sum() + (low[0] == low[1]).sum()
                if same < (percent / 100 - margin) * (whole.shape[1] + low.shape[1]):
                    keep.append(False)
                    continue
                x, y = np.frombuffer(xa.as_py(), np.uint64), np.frombuffer(xb.as_py(), np.uint64)
                if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
                    keep.append(False)
                    continue
                both = np.concatenate((x, y))
                both.sort()
                shared = int((both[1:] == both[:-1]).sum())
                keep.append(100 * shared >= percent * (len(both) - shared))
            keep = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([t.column(0).filter(keep), t.column(1).filter(keep)],
                                             ["a", "b"])

    return lean(run)


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[list[tuple]]:
    """Rows of sorted batches, one list per value of the first ``keys`` columns."""
    now, rows = None, []
    for b in batches:
        for row in zip(*(c.to_pylist() for c in b.columns)):
            if row[:keys] != now and rows:
                yield rows
                rows = []
            now = row[:keys]
            rows.append(row)
    if rows:
        yield rows


def near_pairs(percent: int, margin: float, hashes: int, rows: int, best: bool):
    """``mapInArrow`` over sorted (key, i, j, band, side, id, root, minor, sig): near signatures.

    A group is one block pair of a bucket. A pair is reported in its first common band only. With
    ``best`` each left document reports its nearest one only.
    """

    def near(group: list[tuple]) -> list[tuple[int, int]]:
        left = [r for r in group if r[4] == 0]
        right = [r for r in group if r[4] == 1]
        if not left or not right:
            return []
        whole, low = unpacked([r[8] for r in right], hashes)
        own_whole, own_low = unpacked([r[8] for r in left], hashes)
        ids = np.array([r[5] for r in right])
        roots = np.array([r[6] for r in right])
        minor = np.array([r[7] for r in right])
        out = []
        for k, (_, _, _, band, _, a, root, _, _) in enumerate(left):
            # two minor documents meet twice: keep one order
            open_ = np.flatnonzero((roots != root) & (~minor | (ids > a)))
            if not len(open_):
                continue
            same = whole[open_] == own_whole[k]
            share = (same.sum(axis=1) + (low[open_] == own_low[k]).sum(axis=1)) \
                / (whole.shape[1] + low.shape[1])
            shared_bands = same.reshape(len(open_), -1, rows).all(axis=2)
            good = (share >= percent / 100 - margin) & (shared_bands.argmax(axis=1) == band)
            if good.any():
                pick = [np.where(good, share, -1).argmax()] if best else np.flatnonzero(good)
                out += [(a, b) for b in ids[open_[pick]].tolist()]
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple[int, int]] = []
        for group in _groups(batches, 3):
            found += near(group)
            if len(found) >= 50_000:
                yield _pairs(found)
                found = []
        if found:
            yield _pairs(found)

    return lean(run)


def _pairs(found: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*found)
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def _mixed_pairs(stars: DataFrame, profiles: DataFrame, roots: DataFrame, block: int,
                 one: int | None) -> tuple[DataFrame, DataFrame]:
    """The documents of buckets that hold several components (written), and their blocks.

    A bucket's minor documents, those outside its largest component, are dealt to blocks,
    all its documents too, and every pair of blocks becomes a group. With ``one``, the number of
    a round, each minor document meets one block, chosen by a hash, instead of all.
    """
    member = stars.select("key", "band", "id").join(roots, "id", "left") \
        .select("key", "band", "id", F.coalesce("root", "id").alias("root"))
    share = member.groupBy("key", "root").agg(F.count(F.lit(1)).alias("n")).groupBy("key").agg(
        F.max(F.struct("n", "root")).alias("main"), F.sum("n").alias("n")) \
        .filter("main.n < n").select(
            "key", F.col("main.root").alias("main"),
            F.ceil(F.col("n") / block).cast("int").alias("blocks"),
            F.ceil((F.col("n") - F.col("main.n")) / block).cast("int").alias("minor_blocks"))
    mixed = written(member.join(share, "key").select(
        "*", (F.col("root") != F.col("main")).alias("minor")), "near-mixed")

    base = ["key", "band", "id", "root", "minor"]
    place = {c: F.pmod(F.xxhash64("id"), F.col(c)).cast("int") for c in ("blocks", "minor_blocks")}
    every = {c: F.explode(F.sequence(F.lit(0), F.col(c) - 1)) for c in place}
    chosen = every["blocks"] if one is None else \
        F.pmod(F.xxhash64("id", F.lit(one)), F.col("blocks")).cast("int")
    left = mixed.filter("minor").select(*base, F.lit(0).alias("side"), chosen.alias("i"),
                                        place["minor_blocks"].alias("j"))
    right = mixed.select(*base, F.lit(1).alias("side"), place["blocks"].alias("i"),
                         every["minor_blocks"].alias("j"))
    met = left.unionByName(right).join(profiles.select("id", "sig"), "id")
    return mixed, met.select("key", "i", "j", "band", "side", "id", "root", "minor", "sig") \
        .repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5,
                percent: int = 75, hashes: int = HASHES, rows: int = ROWS, checks: int = CHECKS,
                margin: float = 0.07, block: int = 256) -> DataFrame:
    """(id, n_shingles, component_id, kept) of every row."""
    number, last = known_ids(docs, id_col, text_col)
    out = _near_groups(docs.select(number.alias("id"), F.col(text_col).cast("string").alias("text")),
                       size, percent, hashes, rows, checks, margin, block)
    return out.withColumn("id", F.when(F.col("id") <= last, F.col("id"))) \
        .withColumnRenamed("id", id_col)


def _near_groups(texts: DataFrame, size: int = 5, percent: int = 75, hashes: int = HASHES,
                 rows: int = ROWS, checks: int = CHECKS, margin: float = 0.07,
                 block: int = 256) -> DataFrame:
    """(id, n_shingles, component_id, kept) of every row (id, text); no id is NULL."""
    if hashes % rows or not 0 < percent <= 100:
        raise ValueError("hashes must be a multiple of rows, percent in 1..100")
    sketches = written(texts.mapInArrow(
        sketcher(size, hashes, rows), "id long, n long, digest binary, bands array<long>"),
        "near-sketches")
    full = sketches.filter("n > 0")
    classes = written(full.groupBy("digest").agg(F.min("id").alias("rep")), "near-classes")
    # 2: buckets of class representatives
    keyed = full.join(classes, (full["digest"] == classes["digest"]) & (full["id"] == classes["rep"])) \
        .select(full["id"], F.posexplode("bands").alias("band", "key"))
    keyed = written(keyed, "near-keys")
    leaders = keyed.groupBy("key").agg(F.min("id").alias("leader"), F.max("id").alias("last")) \
        .filter("leader < last").select("key", "leader")
    stars = written(keyed.join(leaders, "key"), "near-stars")
    discard(keyed)
    best = stars.filter("id <> leader").groupBy("id", "leader").agg(F.count(F.lit(1)).alias("n")) \
        .groupBy("id").agg(F.max(F.struct("n", (-F.col("leader")).alias("l"))).alias("best")) \
        .select("id", (-F.col("best.l")).alias("leader"))
    active = stars.select("id").distinct().join(best, "id", "left") \
        .join(classes.select(F.col("rep").alias("id"), F.col("digest").alias("class")), "id")
    profiles = written(texts.join(active, "id").select("id", "leader", "class", "text").mapInArrow(
        profiler(size, hashes, checks), "id long, leader long, shingles binary, sig binary"),
        "near-profiles")

    def side(name: str) -> DataFrame:
        return profiles.select(F.col("id").alias(name), F.col("sig").alias(f"sig_{name}"),
                               F.col("shingles").alias(f"set_{name}"))

    def confirmed(pairs: DataFrame, name: str) -> DataFrame:
        found = pairs.select("a", "b", "sig_a", "sig_b", "set_a", "set_b") \
            .mapInArrow(confirmer(percent, margin, hashes), "a long, b long").distinct()
        return written(found, name)

    first = profiles.filter("leader IS NOT NULL").select(
        F.col("id").alias("a"), F.col("sig").alias("sig_a"), F.col("shingles").alias("set_a"),
        F.col("leader").alias("b"))
    led = profiles.join(stars.select(F.col("leader").alias("id")).distinct(), "id", "left_semi") \
        .select(F.col("id").alias("b"), F.col("sig").alias("sig_b"), F.col("shingles").alias("set_b"))
    links = confirmed(first.join(led, "b"), "near-links")
    # an id with several texts is one document: its classes hang together
    several = full.groupBy("id").agg(F.min("digest").alias("x"), F.max("digest").alias("y")) \
        .filter("x <> y").select("id")
    links = links.unionByName(full.join(several, "id", "left_semi").join(classes, "digest")
                              .select(F.col("id").alias("a"), F.col("rep").alias("b")))
    # 3, 4: buckets that still hold several components
    roots = written(components(links), "near-roots")
    for number, best in enumerate((True, True, False)):
        mixed, blocks = _mixed_pairs(stars, profiles, roots, block, number if best else None)
        if mixed.isEmpty():
            discard(mixed)
            break
        pairs = written(blocks.mapInArrow(near_pairs(percent, margin, hashes, rows, best),
                                          "a long, b long").distinct(), "near-pairs")
        discard(mixed)
        if pairs.isEmpty():                     # one block a document proves nothing for the others
            continue
        more = confirmed(pairs.join(side("a"), "a").join(side("b"), "b"), "near-links")
        if more.isEmpty():
            continue
        roots = written(components(more.unionByName(
            roots.select(F.col("id").alias("a"), F.col("root").alias("b")))), "near-roots")
    # 5
    found = classes.join(roots.withColumnRenamed("id", "rep"), "rep", "left") \
        .select("digest", F.coalesce("root", "rep").alias("component"))
    out = sketches.select("id", "n", F.when(F.col("n") > 0, F.col("digest")).alias("digest")) \
        .join(found, "digest", "left")
    component = F.coalesce("component", "id")
    return out.select("id", F.col("n").alias("n_shingles"),
                      component.alias("component_id"), (F.col("id") == component).alias("kept"))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     **options) -> DataFrame:
    """``docs`` with one document, that of the smallest id, of every group."""
    number = "".join(docs.columns) + "_id"              # a name that no column has
    own = docs.withColumn(number, known_ids(docs, id_col, text_col)[0])
    texts = own.select(F.col(number).alias("id"), F.col(text_col).cast("string").alias("text"))
    kept = _near_groups(texts, **options).filter("kept").select(F.col("id").alias(number)).distinct()
    return own.join(kept, number, "left_semi").select(*docs.columns)
