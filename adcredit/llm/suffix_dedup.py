"""Repeated passages by sparse distributed prefix doubling (operator 9).

Every byte covered by a ``length``-byte string that also starts in a document with a smaller id is
removed; overlaps count, matches never cross documents, and strings are judged on the input.

Prefix doubling names the strings at all positions by sorting pairs of the names of their halves, and
drops positions as soon as their name is unique. Sorting all positions of a
corpus several times moves many times its size, so positions are thinned first, exactly:

* level 0, inside tasks: names of ``prefix`` bytes by doubling (1, 2, 4, ... bytes); of every
  window of ``length`` bytes only the position with the smallest name (mixed to a random order) is an
  *anchor*. Equal windows choose the same anchor, so a repeated window has a repeated anchor.
* level 1: Spark sorts (name, document, position) of the anchors; names that occur in one document only
  are unique and drop out, with all windows around them;
* level 2, past the threshold: a surviving anchor's name is paired with the names of what stands before and
  behind it, one pair for every window that contains the anchor. Spark sorts the surviving anchors by name, and
  windows whose ``length``-byte name also occurs in a document with a smaller id are marked.

Names are 64-bit hashes (48 bits at level 1, which only widens what level 2 decides); level 2 compares
the bytes of windows with equal names, so what is removed is exact.
Exact copies of a text are settled before: the one with the smallest id stands for them,
and the others are removed whole. Within a task only one document of a name, or of
an anchor with equal surroundings, goes to the shuffle; the others are settled there, so a passage that
a third of all documents hold is one row a task.

Defined results: a NULL text is empty; texts shorter than ``length`` lose nothing; rows that share
an id are one document for "smaller id", each with its own row; repeated rows are equal results; rows with
a NULL id come after all ids in the order of a hash of their text, those of one text as one document; an empty
table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adcredit.llm.common import discard, known_ids, lean, mix, whole_text, written
from adcredit.session import shared_dir

LENGTH, PREFIX = 50, 20
_P = 0x9E3779B97F4A7C15 | 1
_POWER = [pow(_P, i, 2 ** 64) for i in range(256)]
CHUNK = 1_500_000            # anchors that a task sorts at a time


def names(b: np.ndarray, size: int) -> np.ndarray:
    """Names of the ``size``-byte strings at all positions, by doubling."""
    have, parts, at = b.astype(np.uint64) + np.uint64(1), [], 0
    width, out = 1, None
    while True:
        if size & width:                                  # this binary digit of ``size``
            n = len(b) - size + 1
            piece = have[at:at + n]
            out = piece.copy() if out is None else out * np.uint64(_POWER[width]) + piece
            at += width
        if width * 2 > size:
            return out
        have = have[:-width] * np.uint64(_POWER[width]) + have[width:]
        width *= 2


def names_at(b: np.ndarray, pos: np.ndarray, size: int) -> np.ndarray:
    """The same names, at few positions."""
    strings = np.lib.stride_tricks.sliding_window_view(b, size)[pos]
    out = np.zeros(len(pos), np.uint64)
    for column in strings.T:
        out = out * np.uint64(_P) + column + np.uint64(1)
    return out


def _sliding(x: np.ndarray, width: int, op) -> np.ndarray:
    have, out = 1, x
    while have * 2 <= width:
        out = op(out[:-have], out[have:])
        have *= 2
    rest = width - have
    return op(out[:len(out) - rest], out[rest:]) if rest else out


def _mixed(name: np.ndarray) -> np.ndarray:
    """Names in a random order, none of them 0."""
    return mix(name) | np.uint64(1)


def anchors(b: np.ndarray, length: int = LENGTH, prefix: int = PREFIX):
    """Positions of the anchors of a document and their names."""
    if len(b) < length:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    name = _mixed(names(b, prefix))
    width = length - prefix + 1
    low = _sliding(name, width, np.minimum)               # smallest name of every window
    edge = np.zeros(width - 1, np.uint64)
    # a position is chosen when it is the smallest of some window that holds it
    chosen = np.flatnonzero(_sliding(np.concatenate((edge, low, edge)), width, np.maximum) == name)
    return chosen, name[chosen]


def _planes(x: np.ndarray, size: int) -> bytes:
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :size].T).tobytes()


def _unplanes(raw: bytes, n: int, size: int) -> np.ndarray:
    out = np.zeros((n, 8), np.uint8)
    out[:, :size] = np.frombuffer(raw, np.uint8).reshape(size, n).T
    return out.view("<u8").ravel()


def _blob(name: np.ndarray, doc: np.ndarray, pos: np.ndarray) -> bytes:
    """Compressed columns: low 40 bits of the name, id, position."""
    raw = _planes(name, 5) + _planes(doc.view(np.uint64), 8) + _planes(pos.astype(np.uint64), 4)
    return zstandard.ZstdCompressor(level=1).compress(raw)


def _unblob(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    n = len(raw) // 17
    return (_unplanes(raw[:5 * n], n, 5), _unplanes(raw[5 * n:13 * n], n, 8).view(np.int64),
            _unplanes(raw[13 * n:], n, 4).astype(np.int64))


def _runs(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First index, and number of the run, of every run of equal sorted keys."""
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    return np.flatnonzero(new), np.cumsum(new) - 1


def namer(length: int, prefix: int, buckets: int):
    """``mapInArrow`` over (doc, text): anchors by name bucket.

    Per chunk and name, the positions of its smallest document go to the name's bucket for comparison;
    when another document of the chunk has the name too, all positions also go as settled, dealt by
    document: nothing is left to compare, so a frequent name is no bucket of its own.
    """

    def flush(parts):
        name, doc, pos = (np.concatenate(c) for c in zip(*parts))
        order = np.argsort(name)
        name, doc, pos = name[order], doc[order], pos[order]
        first, run = _runs(name)
        least = np.minimum.reduceat(doc, first)
        own = doc == least[run]
        shared = (np.maximum.reduceat(doc, first) != least)[run]
        by_name = (name >> np.uint64(40)) % np.uint64(buckets)
        by_doc = mix(doc.view(np.uint64)) % np.uint64(buckets)
        for settled, pick, place in ((False, own, by_name), (True, shared, by_doc)):
            n, d, p, b = name[pick], doc[pick], pos[pick], place[pick].astype(np.int64)
            by = np.argsort(b, kind="stable")
            n, d, p, b = n[by], d[by], p[by], b[by]
            starts = np.flatnonzero(np.diff(b, prepend=-1))
            blobs = [_blob(n[i:j], d[i:j], p[i:j])
                     for i, j in zip(starts, np.append(starts[1:], len(b)))]
            if blobs:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(b[starts], pa.int64()), pa.array([settled] * len(blobs)),
                     pa.array(blobs, pa.binary())], ["bucket", "settled", "blob"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                pos, name = anchors(np.frombuffer(text.as_buffer(), np.uint8), length, prefix)
                if len(pos):
                    parts.append((name, np.full(len(pos), doc, np.int64), pos))
                    held += len(pos)
                if held >= CHUNK:
                    yield from flush(parts)
                    parts, held = [], 0
        if parts:
            yield from flush(parts)

    return lean(run)


@lean
def sharer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``mapInArrow`` over sorted (bucket, settled, blob): anchors whose name two documents have."""

    def places(doc, pos):
        for i in range(0, len(doc), 100_000):
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc[i:i + 100_000], pa.int64()), pa.array(pos[i:i + 100_000], pa.int32())],
                ["doc", "pos"])

    def compared(fresh):
        name, doc, pos = (np.concatenate(c) for c in zip(*fresh))
        order = np.argsort(name)
        doc, pos = doc[order], pos[order]
        first, run = _runs(name[order])
        both = (np.maximum.reduceat(doc, first) != np.minimum.reduceat(doc, first))[run]
        return places(doc[both], pos[both])

    now, fresh = None, []
    for batch in batches:
        for bucket, settled, blob in zip(*(c.to_pylist() for c in batch.columns)):
            if settled:
                yield from places(*_unblob(blob)[1:])
                continue
            if bucket != now and fresh:
                yield from compared(fresh)
                fresh = []
            now = bucket
            fresh.append(_unblob(blob))
    if fresh:
        yield from compared(fresh)


def _fold(columns: np.ndarray) -> np.ndarray:
    """Names of growing prefixes: (rows, k) bytes -> (rows, k + 1) names."""
    out = np.zeros((len(columns), columns.shape[1] + 1), np.uint64)
    for i in range(columns.shape[1]):
        out[:, i + 1] = out[:, i] * np.uint64(_P) + columns[:, i] + np.uint64(1)
    return out


def _windows(before: np.ndarray, behind: np.ndarray, reach: int) -> np.ndarray:
    """Mask of the windows around each anchor that lie inside its document.

    Bit ``o`` is the window that starts ``o`` bytes before the anchor.
    """
    o = np.arange(reach + 1)
    fits = (before[:, None] >= o) & (behind[:, None] >= reach - o)
    return (fits * (np.int64(1) << o)).sum(axis=1)


def _fixed(rows: np.ndarray, present: np.ndarray) -> pa.Array:
    """A binary column of the byte rows (equally long), NULL where not ``present``, without objects."""
    ends = np.cumsum(np.where(present, rows.shape[1], 0))
    offsets = np.concatenate(([0], ends)).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(present), [
        pa.py_buffer(np.packbits(present, bitorder="little")), pa.py_buffer(offsets),
        pa.py_buffer(np.ascontiguousarray(rows[present]))])


def _byte_rows(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """(rows, width) bytes of the values of a binary column that are not NULL."""
    parts = [c.drop_null().cast(pa.binary(width)) for c in column.chunks]
    flat = [np.frombuffer(c.buffers()[1], np.uint8)[c.offset * width:(c.offset + len(c)) * width]
            for c in parts if len(c)]
    return np.concatenate(flat or [np.empty(0, np.uint8)]).reshape(-1, width)


def surrounder(length: int, prefix: int):
    """``mapInArrow`` over (doc, variant, several, text, places): surviving anchors and surroundings."""
    reach = length - prefix

    def flush(parts):
        name, doc, variant, pos, before, behind, around = (np.concatenate(c) for c in zip(*parts))
        beside = np.concatenate((around[:, :reach], around[:, reach + prefix:]), axis=1)
        same = mix(_fold(beside)[:, -1] ^ name ^ mix((before * 256 + behind).astype(np.uint64)))
        by = np.argsort(doc)
        rank = np.empty(len(doc), np.int64)
        rank[by] = np.arange(len(doc))
        order = np.argsort(same)
        first, run = _runs(same[order])
        lead = np.empty(len(doc), np.int64)         # a row of the smallest document with this hash
        lead[order] = by[np.minimum.reduceat(rank[order], first)[run]]
        # an equal anchor in a smaller document here, confirmed by its bytes
        later = doc != doc[lead]
        i = np.flatnonzero(later)
        later[i] = (before[i] == before[lead[i]]) & (behind[i] == behind[lead[i]]) \
            & (around[i] == around[lead[i]]).all(axis=1)
        mask = np.where(later, _windows(before, behind, reach), 0)
        # settled anchors only pass through: dealt by place, so a frequent name stays even
        dealt = np.where(later, mix(doc.view(np.uint64) ^ mix(pos.astype(np.uint64))), name)
        context = np.column_stack((before.astype(np.uint8), behind.astype(np.uint8), around))
        for i in range(0, len(doc), 50_000):
            s = slice(i, i + 50_000)
            yield pa.RecordBatch.from_arrays([
                pa.array(dealt[s].view(np.int64)), pa.array(doc[s]),
                pa.array(variant[s], pa.int32()), pa.array(pos[s], pa.int32()), pa.array(mask[s]),
                _fixed(context[s], ~later[s])], ["name", "doc", "variant", "pos", "mask", "around"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            for doc, variant, several, text, places in zip(
                    *(c.to_pylist() for c in batch.columns[:3]), batch.column(3), batch.column(4)):
                b = np.frombuffer(text.as_buffer(), np.uint8)
                if len(b) < length:
                    continue
                pos = np.unique(places.values.to_numpy(zero_copy_only=False).astype(np.int64))
                if several:         # texts that share an id share the list: a place must be an anchor here
                    own, name = anchors(b, length, prefix)
                    keep = np.isin(own, pos, assume_unique=True)
                    pos, name = own[keep], name[keep]
                else:
                    name = _mixed(names_at(b, pos, prefix))
                edge = np.zeros(reach, np.uint8)
                wide = np.concatenate((edge, b, edge))
                around = np.lib.stride_tricks.sliding_window_view(wide, 2 * reach + prefix)[pos]
                parts.append((name, np.full(len(pos), doc, np.int64), np.full(len(pos), variant), pos,
                              np.minimum(pos, reach), np.minimum(len(b) - prefix - pos, reach), around))
                held += len(pos)
                if held >= CHUNK // 6:
                    yield from flush(parts)
                    parts, held = [], 0
        if held:
            yield from flush(parts)

    return lean(run)


def repeated(key: np.ndarray, rows: np.ndarray, docs: np.ndarray, strings: np.ndarray) -> np.ndarray:
    """Those of ``rows`` (ascending) whose string a smaller document has too.

    ``key`` is a hash of their strings; ``docs``, ascending, and ``strings`` hold all rows. Rows of one key are
    compared by their bytes with the first of them; where hashes collide, those rows are grouped by
    the bytes themselves.
    """
    if not len(rows):
        return rows
    order = np.argsort(key)
    first, run = _runs(key[order])
    lead = rows[np.minimum.reduceat(order, first)][run]
    row = rows[order]
    later = docs[row] != docs[lead]
    differ = np.zeros(len(row), bool)
    differ[later] = (strings[row[later]] != strings[lead[later]]).any(axis=1)
    if not differ.any():
        return row[later]
    mixed = np.isin(run, run[differ])
    again = np.sort(row[mixed])
    whole = np.ascontiguousarray(strings[again]).view(f"V{strings.shape[1]}").ravel()
    exact = np.unique(whole, return_inverse=True)[1].ravel()
    return np.concatenate((row[later & ~mixed], repeated(exact, again, docs, strings)))


def marker(length: int, prefix: int, chunk: int = 200_000):
    """``mapInArrow`` over (name, doc, variant, pos, mask, around) by name: repeated windows."""
    reach = length - prefix

    def mark(t: pa.Table) -> pa.Table:
        doc, mask = t["doc"].to_numpy(), t["mask"].to_numpy().copy()
        index = np.flatnonzero(t["around"].is_valid().to_numpy())
        by = np.argsort(doc[index], kind="stable")          # smallest documents first
        index, around = index[by], _byte_rows(t["around"], 2 + 2 * reach + prefix)[by]
        name, docs = t["name"].to_numpy().view(np.uint64)[index], doc[index]
        before, behind = around[:, 0].astype(np.int64), around[:, 1].astype(np.int64)
        around = around[:, 2:]
        left = _fold(around[:, :reach][:, ::-1])            # outwards from the anchor
        right = _fold(around[:, reach + prefix:])
        for o in range(reach + 1):
            fits = np.flatnonzero((before >= o) & (behind >= reach - o))
            key = mix(mix(name[fits] ^ left[fits, o]) ^ right[fits, reach - o])
            found = repeated(key, fits, docs, around[:, reach - o:reach - o + length])
            mask[index[found]] |= np.int64(1) << o
        t = t.drop_columns(["name", "around", "mask"]).append_column("mask", pa.array(mask))
        return t.filter(pa.array(mask != 0)).combine_chunks()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, rows = [], 0
        for b in batches:
            kept.append(b)
            rows += len(b)
            if rows < chunk:
                continue
            t = pa.Table.from_batches(kept)
            last = t["name"][rows - 1].as_py()             # its rows may go on in the next batch
            stop = int(np.searchsorted(t["name"].to_numpy(), last))
            if stop:
                yield from mark(t.slice(0, stop)).to_batches()
                kept = t.slice(stop).to_batches()
                rows -= stop
        if rows:
            yield from mark(pa.Table.from_batches(kept)).to_batches()

    return lean(run)


def remover(length: int):
    """``mapInArrow`` over (doc, text, marks): removed spans and what is left."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, spans, left = [], [], []
            for text, marks in zip(batch.column(1), batch.column(2)):
                b = np.frombuffer(text.as_buffer(), np.uint8)
                sizes.append(len(b))
                found = marks.values
                if found is None or not len(found):
                    spans.append([])
                    left.append(b.tobytes())
                    continue
                pos = found.field("pos").to_numpy().astype(np.int64)
                mask = found.field("mask").to_numpy()
                starts = [pos[mask >> o & 1 == 1] - o for o in range(int(mask.max()).bit_length())]
                starts = np.unique(np.concatenate(starts))
                starts = starts[(starts >= 0) & (starts + length <= len(b))]
                step = np.zeros(len(b) + 1, np.int64)
                step[starts] += 1
                np.subtract.at(step, starts + length, 1)
                gone = np.cumsum(step[:-1]) > 0
                edges = np.flatnonzero(np.diff(gone, prepend=False, append=False))
                spans.append([{"start": int(i), "stop": int(j)}
                              for i, j in zip(edges[::2], edges[1::2])])
                left.append(b[~gone].tobytes())
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(sizes, pa.int64()), pa.array(spans, pa.list_(pa.struct(
                    [("start", pa.int64()), ("stop", pa.int64())]))), pa.array(left, pa.binary())],
                ["doc", "n", "spans", "kept"])

    return lean(run)


def drop_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 length: int = LENGTH, prefix: int = PREFIX,
                 bucket_bytes: int = 16 << 20) -> DataFrame:
    """(id, n_bytes, spans, kept) of every row; ``kept`` is what is left, as bytes.

    ``length`` - ``prefix`` must be below 62 (the windows around an anchor are a bit mask).
    """
    if not 1 <= prefix <= length or length - prefix > 61:
        raise ValueError("need 1 <= prefix <= length <= prefix + 61")
    spark = docs.sparkSession
    number, last = known_ids(docs, id_col, text_col)
    rows = docs.select(number.alias("doc"), whole_text(text_col).alias("text")) \
        .withColumn("key", F.unhex(F.md5("text")))
    ids = written(rows.select("doc", "key", F.octet_length("text").cast("long").alias("n"),
                              F.when(F.octet_length("text") < length, F.encode("text", "UTF-8"))
                              .alias("short")), "suffix-ids")
    total = ids.agg(F.sum("n")).first()[0] or 0
    buckets = max(8, -(-total // bucket_bytes))
    # one row for every text: copies of it in larger ids are repeated whole
    first = ids.filter(F.col("n") >= length).groupBy("key").agg(F.min("doc").alias("doc"))
    one = Window.partitionBy("doc")                         # texts of one id, as a rule one
    first = written(first.select("doc", "key", F.row_number().over(one.orderBy("key")).alias("variant"),
                                 (F.count("key").over(one) > 1).alias("several")), "suffix-first")
    store = f"suffix_texts_{uuid.uuid4().hex[:12]}"
    chosen = first.select("doc", F.col("key").alias("chosen"), "variant", "several") \
        .repartition(buckets, "doc")
    (rows.repartition(buckets, "doc").join(chosen, "doc").filter("key = chosen")
     .select("doc", "variant", "several", "text")
     .write.bucketBy(buckets, "doc").format("parquet").option("compression", "zstd")
     .option("path", shared_dir(spark, store)).saveAsTable(store))
    texts = spark.table(store)
    # level 1
    shared = texts.select("doc", "text").mapInArrow(
        namer(length, prefix, buckets), "bucket long, settled boolean, blob binary") \
        .repartition(buckets, "bucket").sortWithinPartitions("bucket") \
        .mapInArrow(sharer, "doc long, pos int")
    places = written(shared.groupBy("doc").agg(F.collect_list("pos").alias("places")),
                     "suffix-anchors")
    # level 2
    marks = texts.join(places, "doc").select("doc", "variant", "several", "text", "places").mapInArrow(
        surrounder(length, prefix),
        "name long, doc long, variant int, pos int, mask long, around binary") \
        .repartition(buckets, "name").sortWithinPartitions("name") \
        .mapInArrow(marker(length, prefix), "doc long, variant int, pos int, mask long")
    marks = written(marks.groupBy("doc", "variant").agg(
        F.collect_list(F.struct("pos", "mask")).alias("marks")), "suffix-marks")
    discard(places)
    done = texts.join(marks, ["doc", "variant"], "left").select("doc", "text", "marks").mapInArrow(
        remover(length), "doc long, n long, spans array<struct<start:long,stop:long>>, kept binary")
    whole = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n").alias("stop")))
    none = F.array().cast("array<struct<start:long,stop:long>>")
    rest = ids.join(first, ["doc", "key"], "left_anti").select(
        "doc", "n", F.when(F.col("n") >= length, whole).otherwise(none).alias("spans"),
        F.coalesce("short", F.lit(bytearray())).alias("kept"))
    known = F.when(F.col("doc") <= last, F.col("doc"))
    return done.unionByName(rest).select(known.alias(id_col), F.col("n").alias("n_bytes"),
                                         "spans", "kept")
