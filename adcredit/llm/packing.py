"""Bounded-space online packing (operator 4).

Every partition packs its documents in one pass with a fixed number of open
windows. A document is first cut into full sequences while it is longer than
one; the rest goes whole into the open window that it fills best. When no window
has room, the fullest is emitted: as it is if at most
``slack`` places are free, else after the document's head has filled it. At the end of the
partition the open windows are merged: their pieces are laid end to end,
full sequences are cut off, and the tail is cut into powers of two, which
need no padding. Memory is bounded by ``windows`` sequences and one batch of
texts, nothing is shuffled, and no partition waits for another.

Token ids come from the tokenizers library, one distinct blank-separated chunk at a
time (the pre-token pattern never reaches across blanks, and neither do NFC or
lower-casing), through a bounded memo. A lower-cased word of letters is one pre-token, so the tokenizer's own BPE
model gives the ids of a word that the memo misses, without the normaliser, the pattern and their offsets.

Defined results: a NULL or empty text is only its end token (one piece);
repeated rows are packed again, with their own pieces; an empty table gives
no pieces; columns beside ``id_col`` and ``text_col`` are ignored; a
document of any length is cut, never dropped. ``sequence_id`` is unique over
partitions (partition number * 2**32 + number there).
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adcredit.llm.common import lean

MEMO = 400_000
SLICE = 1280                 # texts that are split and encoded at a time
# A Latin word, perhaps with one mark after it: letters whose lower-casing is one to one and
# which NFC leaves as they are; the word and the mark are two pre-tokens.
_PLAIN = "^[A-Za-zÀ-ÖØ-öø-ÿßŒœŸ]+[.,]?$"


class ChunkIds(dict):
    """Lower-case word or odd chunk -> its token ids as little-endian 32-bit bytes."""

    def __init__(self, definition: str, bound: int = MEMO):
        super().__init__()
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel
        self.tok, self.bound = Tokenizer.from_str(definition), bound
        self.model = self.tok.model
        letters = sorted({chr(c).lower() for c in range(0x180) if re.match(_PLAIN, chr(c))})
        level = ByteLevel(add_prefix_space=False, use_regex=False)
        self.spelling = {ord(c): level.pre_tokenize_str(c)[0][0] for c in letters}
        probe = [*letters, "".join(letters), "".join(reversed(letters))]
        ids = self.tok.encode(" ".join(probe), add_special_tokens=False).ids
        if b"".join(map(self._word, probe)) != np.array(ids, "<u4").tobytes():
            raise ValueError("a plain word is not one byte-level pre-token of this tokenizer")

    def lookup(self, chunks: pa.Array) -> list[bytes]:
        """Ids of distinct blank-free chunks; unseen ones are encoded together."""
        if len(self) > self.bound:
            self.clear()
        plain = pc.match_substring_regex(chunks, _PLAIN)
        low = pc.utf8_lower(chunks.filter(plain))
        words = pc.dictionary_encode(pc.utf8_rtrim(low, ".,"))
        bodies = words.dictionary.to_pylist()
        ids = list(map(self.get, bodies))
        new = [w for w, v in zip(bodies, ids) if v is None]
        if new:
            self.update(zip(new, map(self._word, new)))
            ids = list(map(self.__getitem__, bodies))
        marks = _objects([b"", *self._odd([".", ","])])
        which = pc.ends_with(low, ".").to_numpy(zero_copy_only=False) \
            + 2 * pc.ends_with(low, ",").to_numpy(zero_copy_only=False)
        found = [ids[w] + m for w, m in
                 zip(words.indices.to_numpy().tolist(), marks[which].tolist())]
        odd = self._odd(chunks.filter(pc.invert(plain)).to_pylist())
        plain = plain.to_numpy(zero_copy_only=False)
        out = np.empty(len(chunks), object)
        out[plain], out[~plain] = _objects(found), _objects(odd)
        return out.tolist()

    def _odd(self, chunks: list[str]) -> list[bytes]:
        new = [c for c in chunks if c not in self]
        for c, e in zip(new, self.tok.encode_batch_fast(new, add_special_tokens=False)):
            self[c] = _packed(e.ids)
        return list(map(self.__getitem__, chunks))

    def _word(self, word: str) -> bytes:
        """Ids of a plain word: one pre-token, so the tokenizer's model alone gives them."""
        tokens = self.model.tokenize(word if word.isascii() else word.translate(self.spelling))
        return _packed([t.id for t in tokens])


def _packed(ids: list[int]) -> bytes:
    return struct.pack("<%dI" % len(ids), *ids)


def _objects(values: list[bytes]) -> np.ndarray:
    out = np.empty(len(values), object)
    out[:] = values
    return out


def encode(texts: pa.Array, memo: ChunkIds, end_id: int) -> list[bytes]:
    """Token ids of every text (NULL: empty) and the end token, as bytes."""
    chunks = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    coded = pc.dictionary_encode(chunks.flatten())
    ids = memo.lookup(coded.dictionary)
    codes = coded.indices.to_numpy(zero_copy_only=False)
    bounds = np.concatenate(([0], np.cumsum(pc.list_value_length(chunks).to_numpy(
        zero_copy_only=False)))).tolist()
    end = np.array([end_id], "<u4").tobytes()
    return [b"".join(map(ids.__getitem__, codes[a:b].tolist())) + end
            for a, b in zip(bounds, bounds[1:])]


class Packer:
    """Open windows of one partition. A window is a list of pieces and its length."""

    def __init__(self, size: int, windows: int, slack: int, first_id: int):
        self.size, self.windows, self.slack = size, windows, slack
        self.open: list[tuple[list, int]] = []
        self.next, self.rows = first_id, []

    def add(self, doc, ids: bytes) -> None:
        total, start = len(ids) // 4, 0
        while total - start >= self.size:
            self._emit([(doc, start, self.size, total, ids)])
            start += self.size
        while start < total:
            need = total - start
            best = None
            for i, (_, used) in enumerate(self.open):      # best fit: least room left over
                if used + need <= self.size and (best is None or used > self.open[best][1]):
                    best = i
            if best is not None:
                pieces, used = self.open[best]
                pieces.append((doc, start, need, total, ids))
                if used + need == self.size:
                    self._emit(self.open.pop(best)[0])
                else:
                    self.open[best] = (pieces, used + need)
                return
            if len(self.open) < self.windows:
                self.open.append(([(doc, start, need, total, ids)], need))
                return
            i = max(range(len(self.open)), key=lambda j: self.open[j][1])
            pieces, used = self.open.pop(i)
            if self.size - used > self.slack:
                take = self.size - used                     # less than the document's rest
                pieces.append((doc, start, take, total, ids))
                start += take
            self._emit(pieces)

    def close(self) -> None:
        """Merge the open windows, fullest first."""
        tail, used = [], 0
        for pieces, _ in sorted(self.open, key=lambda w: -w[1]):
            for doc, start, length, total, ids in pieces:
                while length:
                    take = min(length, self.size - used)
                    tail.append((doc, start, take, total, ids))
                    used, start, length = used + take, start + take, length - take
                    if used == self.size:
                        self._emit(tail)
                        tail, used = [], 0
        self.open = []
        while used:                                         # powers of two, largest first
            room = 1 << (used.bit_length() - 1)
            used -= room
            head = []
            while room:
                doc, start, length, total, ids = tail[0]
                take = min(length, room)
                head.append((doc, start, take, total, ids))
                room -= take
                tail[:1] = [(doc, start + take, length - take, total, ids)] if take < length else []
            self._emit(head)

    def _emit(self, pieces: list) -> None:
        offset = 0
        for doc, start, length, total, ids in pieces:
            self.rows.append((doc, start, length, total, self.next, offset,
                              ids[4 * start:4 * (start + length)]))
            offset += length
        self.next += 1


_OUT = ("doc_id long, start long, length long, doc_tokens long, "
        "sequence_id long, offset long, ids binary")
_ARROW = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
                    ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()),
                    ("offset", pa.int64()), ("ids", pa.binary())])


def packer_of(definition, size: int, windows: int, slack: int, end_id: int):
    """``mapInArrow`` function over (id, text) batches; ``definition`` is a broadcast."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = ChunkIds(definition.value)
        packer = Packer(size, windows, slack, TaskContext.get().partitionId() << 32)

        def rows():
            out = pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*packer.rows), _ARROW)], schema=_ARROW)
            packer.rows = []
            return out

        for b in batches:
            ids, texts = b.column(0).to_pylist(), b.column(1)
            for i in range(0, len(ids), SLICE):
                part = encode(texts.slice(i, SLICE), memo, end_id)
                for doc, tokens in zip(ids[i:i + SLICE], part):
                    packer.add(doc, tokens)
                if packer.rows:
                    yield rows()
        packer.close()
        if packer.rows:
            yield rows()

    return lean(run)


def pack(docs: DataFrame, tokenizer_path: str, size: int = 4096, windows: int = 16,
         slack: int = 8, end_id: int = 2, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """Pieces of packed sequences, with their token ids (little-endian 32 bit).

    Sequences hold ``size`` tokens, at most ``slack`` fewer, or a power of
    two at a partition's end. Results are consistent within one run; another
    partitioning of the input gives another, equally valid, packing.
    """
    if size < 1 or windows < 1 or not 0 <= slack < size:
        raise ValueError("size and windows must be positive, slack in [0, size)")
    with open(tokenizer_path, encoding="utf-8") as f:
        definition = docs.sparkSession.sparkContext.broadcast(f.read())
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(packer_of(definition, size, windows, slack, end_id), _OUT)
