"""Toxicity by a weighted lexicon (operator 1).

Texts are folded (lower case, compatibility forms, look-alike letters of other
scripts, digits and signs used as letters; everything else becomes one blank) and searched
with one Aho-Corasick automaton that holds the lexicon and the exception phrases. A
hit inside an exception phrase does not count; of overlapping hits the heaviest
counts. The summed weight, alone and per word, goes through a logistic curve, so
long texts are not toxic for one stray hit.

:func:`fit` learns weights from labelled rows: character strings of 4 to 8
signs (blanks included, so an entry may be tied to a word's start or end) whose document
frequency among toxic rows is significantly above that among clean ones; words in
which entries occur among clean rows become exception phrases. It reads at most
``max_toxic`` and ``max_clean`` labelled rows, chosen by a hash of the id, whole texts;
half of them give the lexicon, the other half the curve. A base lexicon covers tables without
labels. Scoring reads every text whole and is one pass without a shuffle.

Defined results: NULL, empty and blank texts have no hits, and score as the curve says for none;
labels that are NULL are ignored, a row labelled more than once counts as toxic if any label
says so; repeated rows are scored alike; an empty table gives an empty table; other
columns of ``docs`` are ignored.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adcredit.llm.common import lean

# Letters of other scripts and signs that pass for Latin letters.
LOOKALIKES = {
    "а": "a", "в": "b", "с": "c", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k", "м": "m",
    "о": "o", "р": "p", "ѕ": "s", "т": "t", "у": "y", "х": "x", "ԁ": "d", "ԛ": "q", "ԝ": "w",
    "α": "a", "β": "b", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t",
    "υ": "u", "χ": "x", "ı": "i", "ɑ": "a", "ɡ": "g", "ℓ": "l",
    "0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s",
}

#: Entries that hold without any labels (an assumption; labels refine it).
BASE_LEXICON = dict.fromkeys(
    (f" {w} " for w in ("idiot", "moron", "scum", "stupid", "pathetic", "worthless")), 4.0)


# a sign repeated is decoration, not a letter
_RUNS = re.compile(r"([@$])\1+")


class Fold(dict):
    """Translation table that classes every code point the first time it occurs."""

    def __missing__(self, point: int) -> str:
        char = unicodedata.normalize("NFKC", chr(point)).lower()
        out = "".join(LOOKALIKES.get(c, c if c.isalpha() else " ") for c in char)
        self[point] = out = out if out.strip() else " "
        return out


def fold(text: str | None, table: Fold) -> str:
    """Words of letters, each with one blank before it and one behind the last."""
    if not text:
        return " "
    words = _RUNS.sub(" ", text.lower()).translate(table).split()
    return " " + " ".join(words) + " "


@dataclass
class Lexicon:
    """Weighted entries, exception phrases and the curve's coefficients."""

    entries: dict[str, float] = field(default_factory=lambda: dict(BASE_LEXICON))
    exceptions: frozenset[str] = frozenset()
    #: constant, log(1 + weight), weight a word, log(1 + words)
    curve: tuple[float, float, float, float] = (-3.0, 2.5, 2.0, -0.3)

    def automaton(self):
        import ahocorasick
        a = ahocorasick.Automaton()
        for e in self.exceptions:
            a.add_word(e, (len(e), 0.0))
        for e, w in self.entries.items():
            a.add_word(e, (len(e), w))
        if len(a):
            a.make_automaton()
        return a


def _uncovered(hits: list[tuple], spared: list[tuple]) -> list[tuple]:
    """Hits that lie in no exception, both in order of start: one sweep with the furthest end so far."""
    out, at, furthest = [], 0, -1
    for hit in hits:
        while at < len(spared) and spared[at][0] <= hit[0]:
            furthest = max(furthest, spared[at][1])
            at += 1
        if hit[1] > furthest:
            out.append(hit)
    return out


def weigh(folded: str, automaton) -> tuple[float, int]:
    """Summed weight of the counted hits, and their number."""
    if not len(automaton):
        return 0.0, 0
    hits, spared = [], []
    for end, (length, weight) in automaton.iter(folded):
        (hits if weight else spared).append((end - length + 1, end, weight))
    hits.sort()
    if spared:
        hits = _uncovered(hits, sorted(spared))
    total, number, reach, heaviest = 0.0, 0, -1, 0.0
    for start, end, weight in hits:
        if start > reach:                       # a new run of overlapping hits
            total, number, heaviest = total + weight, number + 1, weight
        elif weight > heaviest:
            total, heaviest = total + weight - heaviest, weight
        reach = max(reach, end - 1 if folded[end] == " " else end)
    return total, number


def features(weight: float, words: int) -> tuple[float, float, float, float]:
    return 1.0, math.log1p(weight), weight / max(words, 1), math.log1p(words)


def _sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


def scorer(shared, keep_weight: bool = False):
    """``mapInPandas`` function over (id, text, label); ``shared`` broadcasts a Lexicon."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lexicon, table = shared.value, Fold()
        automaton, curve = lexicon.automaton(), np.array(lexicon.curve)
        for df in frames:
            x, n = [], []
            for text in df["text"]:
                folded = fold(text, table)
                weight, hits = weigh(folded, automaton)
                x.append(features(weight, folded.count(" ") - 1))
                n.append(hits)
            x = np.array(x).reshape(-1, 4)
            out = df.drop(columns="text")
            out["score"], out["hits"] = _sigmoid(x @ curve), np.array(n, np.int64)
            if keep_weight:
                for i in (1, 2, 3):
                    out[f"x{i}"] = x[:, i]
            yield out

    return lean(run)


def grams(words: Iterable[str], sizes=(4, 5, 6, 7, 8)) -> set[str]:
    out: set[str] = set()
    for w in words:
        w = f" {w} "
        for k in sizes:
            out.update([w[i:i + k] for i in range(len(w) - k + 1)])
    return out


def _batches(seen: Counter, rows: int = 50_000) -> Iterator[pa.RecordBatch]:
    items = list(seen.items())
    for i in range(0, len(items), rows):
        entry, n = zip(*items[i:i + rows])
        yield pa.RecordBatch.from_arrays([pa.array(entry, pa.string()), pa.array(n, pa.int64())],
                                         ["entry", "n"])


@lean
def _gram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of this task that hold each string."""
    table, seen = Fold(), Counter()
    for b in batches:
        for text in b.column(0).to_pylist():
            seen.update(grams(set(fold(text, table).split())))
    yield from _batches(seen)


def _entry_counts(shared):
    """Documents of this task that hold each given string, and the words around them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ahocorasick
        a = ahocorasick.Automaton()
        for e in shared.value:
            a.add_word(e, e)
        a.make_automaton()
        table, seen = Fold(), Counter()
        for b in batches:
            for text in b.column(0).to_pylist():
                words = " ".join(set(fold(text, table).split()))
                seen.update({e for _, e in a.iter(f" {words} ".replace(" ", "  "))})
        yield from _batches(seen)

    return lean(run)


def _words_with(shared):
    """Per task: clean documents in which each word that holds an entry occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon, table, seen = shared.value, Fold(), Counter()
        automaton = lexicon.automaton()
        for b in batches:
            for text in b.column(0).to_pylist():
                seen.update(w for w in set(fold(text, table).split())
                            if any(True for _ in automaton.iter(f" {w} ")))
        yield from _batches(seen)

    return lean(run)


def choose(toxic: dict[str, int], clean: dict[str, int], n_toxic: int, n_clean: int,
           most: int = 4000) -> dict[str, float]:
    """Entries and weights from document counts (smoothed log odds).

    An entry must be at least 6 times as frequent among toxic documents, and by
    5 standard deviations; of nested strings with like counts one stays.
    """
    found = []
    for e, p in toxic.items():
        q = clean.get(e, 0)
        expected = (q + 0.5) / (n_clean + 1) * n_toxic
        if p - expected >= 5 * math.sqrt(expected + 0.1) and p >= 6 * expected:
            found.append((math.log((p + 0.5) / (n_toxic + 1) * (n_clean + 1) / (q + 0.5)), p, e))
    kept: dict[str, float] = {}
    counts: dict[str, int] = {}
    for weight, p, e in sorted(found, key=lambda f: (-f[0], -len(f[2]), f[2])):
        parts = {e[i:j] for i in range(len(e)) for j in range(i + 1, len(e) + 1)}
        if counts.get(e, 0) < 0.8 * p and len(kept) < most:
            kept[e] = weight
            for k in parts:
                counts[k] = max(p, counts.get(k, 0))
    return kept


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 40) -> np.ndarray:
    """Ridge logistic regression by Newton steps (the constant is not shrunk)."""
    b = np.zeros(x.shape[1])
    keep = ridge * np.eye(x.shape[1])
    keep[0, 0] = 1e-6
    for _ in range(rounds):
        p = _sigmoid(x @ b)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + keep,
                               x.T @ (y - p) - keep @ b)
        b += step
        if np.abs(step).max() < 1e-8:
            break
    return b


def fit(docs: DataFrame, labels: DataFrame, learn: Column | None = None,
        max_toxic: int = 3000, max_clean: int = 9000, id_col: str = "doc_id",
        text_col: str = "text", label_col: str = "toxic") -> Lexicon:
    """Learn a lexicon from at most ``max_toxic`` + ``max_clean`` labelled documents.

    ``learn`` is a condition on ``id_col``: only rows that meet it are used.
    What reaches the driver is bounded by these two parameters.
    """
    spark = docs.sparkSession
    known = labels.select(F.col(id_col).cast("long").alias("doc_id"),
                          F.col(label_col).cast("int").alias("y")).filter("y IS NOT NULL")
    if learn is not None:
        known = known.filter(learn)
    known = known.groupBy("doc_id").agg(F.max("y").alias("y"))
    order = F.xxhash64("doc_id")
    chosen = known.filter("y = 1").orderBy(order, "doc_id").limit(max_toxic).unionByName(
        known.filter("y = 0").orderBy(order, "doc_id").limit(max_clean))
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                        F.col(text_col).cast("string").alias("text"))
    # at most max_toxic + max_clean ids and labels: a bounded broadcast
    sample = texts.join(F.broadcast(chosen), "doc_id") \
        .withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit("half")), F.lit(2))) \
        .repartition(12, "doc_id").persist()
    try:
        size = {(r["y"], r["part"]): r["n"] for r in
                sample.groupBy("y", "part").agg(F.count(F.lit(1)).alias("n")).collect()}
        n_toxic, n_clean = size.get((1, 0), 0), size.get((0, 0), 0)
        if n_toxic < 4 or n_clean < 4 or not size.get((1, 1)) or not size.get((0, 1)):
            return Lexicon()
        half = sample.filter("part = 0")
        counts = "entry string, n long"
        least = max(3, n_toxic // 100)
        toxic = {r["entry"]: r["n"] for r in half.filter("y = 1").select("text")
                 .mapInArrow(_gram_counts, counts).groupBy("entry").agg(F.sum("n").alias("n"))
                 .filter(F.col("n") >= least).collect()}
        clean = {r["entry"]: r["n"] for r in half.filter("y = 0").select("text")
                 .mapInArrow(_entry_counts(spark.sparkContext.broadcast(sorted(toxic))), counts)
                 .groupBy("entry").agg(F.sum("n").alias("n")).collect()} if toxic else {}
        lexicon = Lexicon({**BASE_LEXICON, **choose(toxic, clean, n_toxic, n_clean)})
        shared = spark.sparkContext.broadcast(lexicon)
        around = {y: {r["entry"]: r["n"] for r in half.filter(F.col("y") == y).select("text")
                      .mapInArrow(_words_with(shared), counts)
                      .groupBy("entry").agg(F.sum("n").alias("n")).collect()} for y in (0, 1)}
        lexicon.exceptions = frozenset(
            f" {w} " for w, n in around[0].items()
            if n >= 2 and around[1].get(w, 0) * n_clean <= n * n_toxic)
        for e in lexicon.exceptions:
            lexicon.entries.pop(e, None)
        shared = spark.sparkContext.broadcast(lexicon)
        seen = sample.filter("part = 1").select("text", "y").mapInPandas(
            scorer(shared, True),
            "y int, score double, hits long, x1 double, x2 double, x3 double").toPandas()
        x = np.column_stack([np.ones(len(seen)), seen[["x1", "x2", "x3"]]])
        lexicon.curve = tuple(float(b) for b in logistic(x, seen["y"].to_numpy(float)))
        return lexicon
    finally:
        sample.unpersist()


def toxicity(docs: DataFrame, lexicon: Lexicon, threshold: float = 0.3,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score, hits, predicted) of every row, from its whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)
    out = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                      F.col(text_col).cast("string").alias("text")) \
        .mapInPandas(scorer(shared), "doc_id long, score double, hits long")
    return out.select(F.col("doc_id").alias(id_col), "score", "hits",
                      (F.col("score") >= threshold).cast("int").alias("predicted"))


def rejected(threshold: float, lexicon_shared, text_at: int):
    """``mapInArrow`` function that drops the rows whose text scores at least ``threshold``."""

    def run(batches):
        lexicon, table = lexicon_shared.value, Fold()
        automaton, curve = lexicon.automaton(), np.array(lexicon.curve)
        for b in batches:
            keep = []
            for text in b.column(text_at).to_pylist():
                folded = fold(text, table)
                weight, _ = weigh(folded, automaton)
                keep.append(_sigmoid(np.dot(features(weight, folded.count(" ") - 1), curve))
                            < threshold)
            yield b.filter(pa.array(keep, pa.bool_()))

    return lean(run)


def drop_toxic(docs: DataFrame, lexicon: Lexicon, threshold: float = 0.3,
               text_col: str = "text") -> DataFrame:
    """``docs``, every column, without the rows that score at least ``threshold``."""
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)
    return docs.mapInArrow(rejected(threshold, shared, docs.columns.index(text_col)), docs.schema)
