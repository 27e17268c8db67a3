"""Shared helpers: inputs, shared-folder tables, words and their hashes."""

from __future__ import annotations

import ctypes
import gc

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adcredit.session import shared_dir
from adcredit.sources import files

#: Word separators of every operator here: space, tab, LF, VT, FF, CR.
BLANKS = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage: the files are on shared storage, so a lost executor
    costs no recomputation, and a later branch does not run the plan again.
    """
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete :func:`written` tables whose readers have been written themselves."""
    for t in tables:
        files.delete(t.sparkSession, t.scratch_path)


def lean(run):
    """Wrap an Arrow or pandas task function: give freed memory back when the task ends.

    Python workers outlive their tasks, and would keep the largest heap that any task of any
    operator needed beside the tasks of the next.
    """
    def task(batches):
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)      # glibc only
            if trim is not None:
                trim(0)
    return task


def whole_text(column: str = "text"):
    """The text with NULL as the empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def known_ids(docs: DataFrame, id_col: str, text_col: str):
    """The id as a column without NULLs, and the largest id that the table has (0 at least).

    A row without an id gets a number above all ids, from a hash of its text, that equal texts
    share: such rows come after all others, and those of one text are rows that share an id. Two
    texts get the same number with the probability of an equal 63-bit hash (less the ids' range).
    """
    have = F.col(id_col).cast("long")
    last = max(docs.agg(F.max(have)).first()[0] or 0, 0)
    room = 2 ** 63 - 1 - last
    spare = F.pmod(F.xxhash64(whole_text(text_col)), F.lit(room)) + F.lit(last + 1) \
        if room else F.raise_error(F.lit("no number is left above the largest id")).cast("long")
    return F.coalesce(have, spare), last


class WordHashes(dict):
    """word bytes -> 64-bit hash, remembered for at most ``bound`` words."""

    def __init__(self, bound: int = 200_000):
        super().__init__()
        self.bound = bound

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.bound:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z only) words between blanks, as UTF-8.

    ``bytes.lower`` and ``bytes.split`` treat exactly A-Z and the six ASCII
    blanks, which is the definition wanted.
    """
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


_MIX = np.uint64(0x9E3779B97F4A7C15)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (shift-multiply rounds)."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def shingle_hashes(words: list[bytes], hashes: WordHashes, size: int = 5) -> np.ndarray:
    """64-bit hashes of the word shingles in order; a shorter text is one shingle."""
    n = len(words)
    if n == 0:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(hashes.__getitem__, words), np.uint64, n)
    k = min(n, size)
    acc = np.full(n - k + 1, np.uint64(k))
    for j in range(k):
        acc = (acc ^ w[j:n - k + 1 + j]) * _MIX
        acc ^= acc >> np.uint64(29)
    return mix(acc)
