"""Token counts with a whole-token shortcut (operator 2).

A byte-level BPE tokenizer cuts a text into pre-tokens and merges each one
on its own. Offline, every vocabulary string is encoded alone once: those
that come back as exactly one token are *proved* whole tokens. A
pre-token that is such a string counts as one without any merging; only the
others go through the library's merges, once per distinct string and batch, and
are remembered in a bounded memo.

The split into pre-tokens is found in the same spirit. If every blank of a text is one
single space or newline, each space belongs to the word after it and every
newline stands alone, so words (with their space) are counted one by one.
Other texts go through the split pattern. Characters that the
pattern engine classes otherwise than the tokenizer's own splitter
(:func:`same_class` tests each character that occurs once) send the text to
the library whole.

Defined results: NULL and empty texts have 0 bytes and 0 tokens; repeated
rows are counted like any other; columns beside ``id_col`` and ``text_col``
are ignored, whatever they are called; an empty table gives an empty table.
Lone surrogates cannot occur in Spark strings.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adcredit.llm.common import lean

# The pre-token pattern of the byte-level vocabularies (fixed value).
PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+"
           r"| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
_PIECES = regex.compile(PATTERN)
MEMO = 600_000


def load(definition: str):
    from tokenizers import Tokenizer
    return Tokenizer.from_str(definition)


def whole_tokens(definition: str) -> frozenset[str]:
    """Vocabulary strings that the tokenizer encodes alone as one token."""
    tok = load(definition)
    special = set(special_strings(definition))
    ids = sorted(tok.get_vocab(with_added_tokens=False).values())
    texts = [t for t in tok.decode_batch([[i] for i in ids], skip_special_tokens=False)
             if t and "�" not in t and t not in special]
    found = tok.encode_batch_fast(texts, add_special_tokens=False)
    # a string must also be one pre-token, or it never meets the shortcut whole
    return frozenset(t for t, e in zip(texts, found)
                     if len(e.ids) == 1 and _PIECES.fullmatch(t))


def special_strings(definition: str) -> list[str]:
    return [t["content"] for t in json.loads(definition).get("added_tokens", [])]


def same_class(split: Callable, char: str) -> bool:
    """Do the library's splitter and the pattern cut this character alike?

    The probe sets it beside a letter, a digit, a blank, a mark and itself.
    """
    probe = f"a{char}1{char} {char}.{char}{char}\na"
    return [s for _, s in split(probe)] == [m.span() for m in _PIECES.finditer(probe)]


class Counter:
    """Counts the tokens of texts in one Python worker."""

    def __init__(self, definition: str, whole: frozenset[str], memo: int = MEMO):
        self.tok, self.whole, self.bound = load(definition), whole, memo
        self.split = self.tok.pre_tokenizer.pre_tokenize_str
        self.special = special_strings(definition)
        self.same: dict[str, bool] = {}      # character -> both splitters agree on it
        self.words: dict[str, int] = {}      # word after a space -> tokens
        self.piece: dict[str, int] = {}      # pre-token that needs merging -> tokens
        vocab = self.tok.get_vocab()
        self.spaced = np.zeros(max(vocab.values()) + 1, bool)
        for t, i in vocab.items():
            self.spaced[i] = t.startswith("Ġ")      # the byte alphabet's space

    def _agreed(self, text: str) -> bool:
        """No character of the text is classed differently (each is tested once)."""
        if text.isascii():
            return True
        chars = set(text)
        for c in chars.difference(self.same):
            self.same[c] = same_class(self.split, c)
        return all(map(self.same.__getitem__, chars))

    def _merge(self, pieces: set[str]) -> None:
        """Library merges for the pre-tokens that are no whole tokens."""
        new = [p for p in pieces.difference(self.whole) if p not in self.piece]
        line = [p for p in new if p[0] == " " and p[1:].isalpha()]
        for i in range(0, len(line), 5_000):        # a space starts each: cut the line there
            part = line[i:i + 5_000]
            ids = np.array(self.tok.encode("".join(part), add_special_tokens=False).ids)
            starts = np.flatnonzero(self.spaced[ids])
            if len(starts) == len(part):
                self.piece.update(zip(part, np.diff(starts, append=len(ids)).tolist()))
        rest = [p for p in new if p not in self.piece]
        for p, e in zip(rest, self.tok.encode_batch_fast(rest, add_special_tokens=False)):
            self.piece[p] = len(e.ids)

    def _counts(self, split: list[list[str]]) -> list[int]:
        """Tokens of every list of pre-tokens."""
        self._merge({p for ps in split for p in ps})
        whole, piece = self.whole, self.piece
        return [sum([1 if p in whole else piece[p] for p in ps]) for ps in split]

    def _word_counts(self, words: list[str]) -> np.ndarray:
        """Tokens of distinct words, each after a space."""
        if len(self.words) > self.bound or len(self.piece) > self.bound:
            self.words.clear()
            self.piece.clear()
        counts = list(map(self.words.get, words))
        missing = [i for i, n in enumerate(counts) if n is None]
        split = []
        for i in missing:
            w = words[i]
            if w.isalpha():
                split.append([" " + w])
            elif w[-1] in ".," and w[:-1].isalpha():
                split.append([" " + w[:-1], w[-1]])
            else:
                split.append(_PIECES.findall(" " + w))
        for i, n in zip(missing, self._counts(split)):
            counts[i] = self.words[words[i]] = n
        return np.array(counts, np.int64)

    def batch(self, texts: pa.Array) -> np.ndarray:
        """Token counts of the texts (NULL: empty)."""
        texts = pc.fill_null(texts, "")
        chunks = pc.split_pattern(texts, " ")
        sizes = pc.list_value_length(chunks).to_numpy(zero_copy_only=False).astype(np.int64)
        strings = texts.to_pylist()
        out = np.zeros(len(strings), np.int64)
        plain = np.zeros(len(strings), bool)
        first: list[list[str]] = []
        other: list[int] = []
        for i, text in enumerate(strings):
            if not text:
                continue
            if not self._agreed(text) or any(s in text for s in self.special):
                out[i] = self._pieced(text)
            elif " ".join(text.split()) == text.replace("\n", " "):
                # one blank, a space or newline, between words: no other blanks exist
                plain[i] = True
                first.append(_PIECES.findall(text.split(" ", 1)[0]))
            else:
                other.append(i)
        out[other] = self._counts([_PIECES.findall(strings[i]) for i in other])
        if plain.any():
            keep = np.repeat(plain, sizes)
            starts = np.cumsum(sizes) - sizes
            keep[starts[plain]] = False                 # the first word has no space
            coded = pc.dictionary_encode(chunks.flatten().filter(pa.array(keep)))
            words = coded.dictionary.to_pylist()
            each = np.concatenate((self._word_counts(words) if words else
                                   np.zeros(0, np.int64), [0]))
            codes = np.full(len(keep), len(words))
            codes[keep] = coded.indices.to_numpy(zero_copy_only=False)
            sums = np.concatenate(([0], np.cumsum(each[codes])))
            out[plain] = (sums[starts + sizes] - sums[starts])[plain] + self._counts(first)
        return out

    def _pieced(self, text: str) -> int:
        """Special strings count as one; what lies between them is counted alone."""
        if not any(s in text for s in self.special):
            return len(self.tok.encode(text, add_special_tokens=False).ids)
        parts = regex.split("(" + "|".join(map(regex.escape, self.special)) + ")", text)
        return sum(1 if p in self.special else int(self.batch(pa.array([p]))[0])
                   for p in parts if p)


def counter_of(definition, whole) -> Callable[[Iterator[pa.RecordBatch]], Iterator]:
    """``mapInArrow`` function over (id, text) batches; arguments are broadcasts."""

    def run(batches):
        c = Counter(definition.value, whole.value)
        for b in batches:
            texts = b.column(1)
            counts = [c.batch(texts.slice(i, 2048)) for i in range(0, len(texts), 2048)]
            size = pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), size, pa.array(np.concatenate([np.zeros(0, np.int64), *counts]))],
                ["doc_id", "n_bytes", "n_tokens"])

    return lean(run)


def token_counts(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens) of every row, as the library counts whole texts.

    The tokenizer file is read and its whole tokens are proved on the driver, then
    broadcast; both depend on the vocabulary only, never on the data.
    """
    with open(tokenizer_path, encoding="utf-8") as f:
        definition = f.read()
    sc = docs.sparkSession.sparkContext
    parts = (sc.broadcast(definition), sc.broadcast(whole_tokens(definition)))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(counter_of(*parts), "doc_id long, n_bytes long, n_tokens long") \
        .withColumnRenamed("doc_id", id_col)
