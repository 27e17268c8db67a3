"""The training-text operators: SQL parity, brute force, edge cases."""

import hashlib
import itertools
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry
from adcredit.llm import (chat_views, contamination, exact_dedup, line_dedup, near_dedup, packing,
                          queries, sharding, suffix_dedup, token_count, toxicity)
from adcredit.llm.components import components
from conftest import SF_SMALL
from oracle_compare import compare

from . import brute
from .conftest import EDGE_DOCS, PASSAGE

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
OPS = [q for q in entry.queries() if q.startswith("op")]


def docs_of(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet")


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("documents", "benchmark", "labels", "conversations", "embeddings"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    return c


def test_all_are_registered():
    assert sorted({int(q[2:].split("_")[0]) for q in OPS}) == list(range(1, 14))
    assert "pipeline" in entry.queries()


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_queries_match_sql(spark, con, name):
    assert compare(spark, con, name, queries.QUERIES[name], queries.SQL[name], SF_SMALL) == []


# -- 1 toxicity ------------------------------------------------------------

def test_toxicity_folds_and_spares():
    lexicon = toxicity.Lexicon({" idiot ": 5.0, "scum": 5.0}, frozenset({" scumble "}))
    a, table = lexicon.automaton(), toxicity.Fold()

    def hits(text):
        return toxicity.weigh(toxicity.fold(text, table), a)[1]
    assert hits("An IDIOT!") == 1 and hits("1d10t") == 1 and hits("іdіоt") == 1     # look-alikes
    assert hits("idiotic") == 0 and hits("scummy") == 1
    assert hits("to scumble paint") == 0 and hits("scumble scum") == 1
    assert hits("idiot$$$ ###") == 1 and hits("") == 0 and hits(None) == 0
    assert hits("idiot idiot") == 2


def brute_weight(folded, lexicon):
    """Every entry at every place against every exception; overlapping hits count once, the heaviest."""
    def places(entry):
        return [i for i in range(len(folded)) if folded.startswith(entry, i)]
    spared = [(i, i + len(e) - 1) for e in lexicon.exceptions for i in places(e)]
    hits = sorted((i, i + len(e) - 1, w) for e, w in lexicon.entries.items() for i in places(e)
                  if not any(s <= i and i + len(e) - 1 <= t for s, t in spared))
    runs, reach = [], -1
    for s, t, w in hits:
        if s > reach:
            runs.append([])
        runs[-1].append(w)
        reach = max(reach, t - (folded[t] == " "))
    return sum(map(max, runs)), len(runs)


def test_toxicity_weights_equal_brute_force_and_long_texts_are_linear():
    import random
    import time
    lexicon = toxicity.Lexicon({" ab ": 1.5, "ba": 2.0, "aab": 4.0, " c ": 1.0, "abba": 3.0},
                               frozenset({" abba ", "cab", " c c ", "aaab"}))
    automaton, rng = lexicon.automaton(), random.Random(2)
    for _ in range(300):
        folded = " " + " ".join("".join(rng.choices("aabc", k=rng.randint(1, 5))) for _ in range(12)) + " "
        weight, number = toxicity.weigh(folded, automaton)
        assert (pytest.approx(weight), number) == brute_weight(folded, lexicon)
    lexicon = toxicity.Lexicon({"scum": 5.0, "cunt": 5.0}, frozenset({"scunthorpe"}))
    automaton, text = lexicon.automaton(), "scunthorpe scum " * 65_536             # 1 MB
    began = time.process_time()
    assert toxicity.weigh(toxicity.fold(text, toxicity.Fold()), automaton) == (5.0 * 65_536, 65_536)
    assert time.process_time() - began < 5


def test_toxicity_learns_from_the_allowed_fold_only(spark, edge_docs, no_docs):
    d = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{d}/{t}.parquet") for t in ("documents", "labels"))
    lexicon = toxicity.fit(docs, labels, ~queries.held_out())
    spoiled = labels.withColumn("toxic", F.when(queries.held_out(), 1 - F.col("toxic"))
                                .otherwise(F.col("toxic")))
    again = toxicity.fit(docs, spoiled, ~queries.held_out())
    assert again.entries == lexicon.entries and np.allclose(again.curve, lexicon.curve)
    seen = toxicity.toxicity(docs, lexicon).join(labels, "doc_id").filter(queries.held_out())
    r = seen.groupBy("toxic").agg(F.avg("score").alias("s")).orderBy("toxic").collect()
    assert r[1]["s"] > 3 * r[0]["s"]
    out = toxicity.toxicity(edge_docs, lexicon)
    assert out.count() == len(EDGE_DOCS)
    assert out.filter("score < 0 OR score > 1 OR score IS NULL").count() == 0
    assert toxicity.toxicity(no_docs, lexicon).count() == 0
    assert toxicity.fit(no_docs, labels).entries == toxicity.BASE_LEXICON
    kept = toxicity.drop_toxic(edge_docs, lexicon)
    assert kept.columns == edge_docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {
        r["doc_id"] for r in out.filter("predicted = 0").collect()}
    assert out.filter("doc_id = 21 AND predicted = 1").count() == 1


# -- 2 token counts --------------------------------------------------------

@pytest.mark.parametrize("which", ["edge", "table", "odd"])
def test_token_counts_equal_the_library(spark, edge_docs, no_docs, which):
    odd = ["a  b", "\n\na", "a\n", "'s ''s don't\t x", " x 　y", "  ", "x͸y 1²2", "a b", "a\nb c\nd",
           "x\x1cy z", "a b\x85c", "<|endoftext|>", "a <|endoftext|><|endoftext|>b ", "½ ³ Ⅷ ٣"]
    docs = {"edge": edge_docs, "table": docs_of(spark), "odd": spark.createDataFrame(
        list(enumerate(odd)), "doc_id long, text string")}[which]
    got = sorted(tuple(r) for r in token_count.token_counts(docs, BYTE_BPE).collect())
    tok, rows = Tokenizer.from_file(BYTE_BPE), pairs(docs)
    want = [len(e.ids) for e in tok.encode_batch([t or "" for _, t in rows], add_special_tokens=False)]
    assert got == sorted((i, len((t or "").encode()), n) for (i, t), n in zip(rows, want))
    assert token_count.token_counts(no_docs, BYTE_BPE).count() == 0


def test_token_counts_of_blanks_that_cancel_out(spark):
    """Extra spaces and other blanks in equal number: as many words as single blanks would give."""
    odd = ["a  b\tc", "a b\tc", "a  b\u00a0c", "a \t b\tc", "a\n\nb\rc d", "a \nb\x0bc", "x  y\u2003z\n\n.\x0c,"]
    rows = list(enumerate(odd))
    got = token_count.token_counts(spark.createDataFrame(rows, "doc_id long, text string"), BYTE_BPE)
    tok = Tokenizer.from_file(BYTE_BPE)
    assert sorted((r["doc_id"], r["n_tokens"]) for r in got.collect()) == [
        (i, len(tok.encode(t, add_special_tokens=False).ids)) for i, t in rows]


# -- 3 chat views ----------------------------------------------------------

def test_chat_views_edge_cases(spark):
    rows = [(1, 2, "b", "later"), (1, 1, "a", "first"), (1, 1, "a", "first"), (1, None, None, None),
            (2, 0, "system", "only directions"), (None, 0, "a", "no id")] \
        + [(3, 0, f"p{i % 3}", "same turn " * (i % 50)) for i in range(3000)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string") \
        .withColumn("piece", F.lit(7)).withColumn("segment", F.lit("x"))
    out = chat_views.perspectives(turns, pieces=7).collect()
    views = defaultdict(list)
    for r in out:
        views[r["conv_id"], r["perspective"]].append(r)
    assert set(views) == {(1, "a"), (1, "b"), (1, "unknown"), (None, "a"),
                          (3, "p0"), (3, "p1"), (3, "p2")}
    for (conv, view), segs in views.items():
        segs.sort(key=lambda r: r["position"])
        assert [s["position"] for s in segs] == list(range(len(segs)))
        whole, at = "".join(s["segment"] for s in segs), 0
        for s in segs:
            assert s["start"] == at
            at += len(s["segment"])
            if s["speaker"] == view:
                assert s["segment"].startswith(chat_views.ASSISTANT)
                body = whole[s["mask_start"]:s["mask_end"]]
                assert chat_views.ASSISTANT + body == s["segment"]
            else:
                assert s["mask_start"] is None and f"name={s['speaker']}|" in s["segment"]
    assert [s["turn"] for s in sorted(views[1, "a"], key=lambda r: r["position"])] == [None, 1, 1, 2]
    assert chat_views.perspectives(turns.limit(0)).count() == 0


# -- 4 packing -------------------------------------------------------------

def check_packing(pieces, rows, size=4096):
    tok = Tokenizer.from_file(WORD_BPE)
    want = defaultdict(list)
    for (i, t), e in zip(rows, tok.encode_batch([t or "" for _, t in rows], add_special_tokens=False)):
        want[i].append(e.ids + [2])
    seqs, docs = defaultdict(list), defaultdict(list)
    for p in pieces:
        seqs[p["sequence_id"]].append(p)
        docs[p["doc_id"]].append(p)
    fill = []
    for ps in seqs.values():
        at = 0
        for p in sorted(ps, key=lambda p: p["offset"]):
            assert p["offset"] == at and p["length"] > 0
            at += p["length"]
        assert at <= size
        fill.append(at)
    for i, ps in docs.items():
        got = []
        ps = sorted(ps, key=lambda p: p["start"])
        copies = len(want[i])
        if copies == 1:
            got = np.concatenate([np.frombuffer(p["ids"], "<u4") for p in ps]).tolist()
            assert got == want[i][0] and all(p["doc_tokens"] == len(got) for p in ps)
        else:
            assert sum(p["length"] for p in ps) == sum(map(len, want[i]))
    assert set(docs) == set(want)
    waste = sum(size - f for f in fill if f & (f - 1))
    return waste / sum(fill)


def test_packing_is_whole_and_tight(spark, edge_docs, no_docs):
    assert check_packing(packing.pack(docs_of(spark), WORD_BPE).collect(), pairs(docs_of(spark))) < 0.004
    assert check_packing(packing.pack(edge_docs, WORD_BPE).collect(), pairs(edge_docs)) < 0.004
    assert check_packing(packing.pack(edge_docs, WORD_BPE, size=64, windows=2, slack=0).collect(),
                         pairs(edge_docs), 64) == 0
    assert packing.pack(no_docs, WORD_BPE).count() == 0
    odd = ["İstanbul ΣΑΣ ß ẞ ﬁ K Å don't I'LL x.y a.,", "Ünï ŒUVRE, É. é É", "x\x1cy z a b\x85c",
           "a<|endoftext|>b <|startoftext|>", "ÿ Ÿ., ... a.. ,", "12 3a a3 ½"]
    df = spark.createDataFrame(list(enumerate(odd)), "doc_id long, text string")
    check_packing(packing.pack(df, WORD_BPE).collect(), pairs(df))


def test_packing_encodes_unseen_words_by_the_model_alone():
    with open(WORD_BPE, encoding="utf-8") as f:
        memo, tok = packing.ChunkIds(f.read()), Tokenizer.from_file(WORD_BPE)
    memo.lookup(pa.array(["a.", "b,"]))

    class OddOnly:                                  # the whole tokenizer is only for odd chunks
        def encode_batch_fast(self, new, **options):
            assert not new
            return []

    memo.tok = OddOnly()
    words = ["unseen", "Zyxwvut.", "ŒUVRE,", "ÜBERGRÖSSE", "ÿŸß", "aéc.", "x" * 300]
    assert memo.lookup(pa.array(words)) == [
        np.array(tok.encode(w, add_special_tokens=False).ids, "<u4").tobytes() for w in words]
    definition = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")).to_str()
    with pytest.raises(ValueError):
        packing.ChunkIds(definition)


# -- 5 sharding ------------------------------------------------------------

def check_shards(out, rows, shards):
    by = defaultdict(list)
    for r in out:
        by[r["shard"]].append(r["slot"])
    sizes = [len(by.get(s, [])) for s in range(shards)]
    assert set(by) <= set(range(shards)) and max(sizes) - min(sizes) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    assert sorted(((r["doc_id"], r["size"], r["text_crc32"]) for r in out), key=str) == sorted((
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows), key=str)


def test_sharding_is_even_and_keeps_copies_together(spark, edge_docs, no_docs):
    for df, n in ((docs_of(spark), 8), (edge_docs, 8), (edge_docs, 1), (edge_docs, 5)):
        check_shards(sharding.shard(df, n).collect(), pairs(df), n)
    assert sharding.shard(no_docs).count() == 0
    # 60 groups of 5 copies among 700 single texts: nearly all groups end in one shard
    rows = [(i, f"copy {i % 60}" if i < 300 else f"single {i}") for i in range(1000)]
    out = sharding.shard(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    check_shards(out, rows, 8)
    where = defaultdict(set)
    for r in out:
        if r["doc_id"] < 300:
            where[r["doc_id"] % 60].add(r["shard"])
    assert sum(len(s) > 1 for s in where.values()) <= 3
    hot = [(i, "hot" if i % 3 == 0 else f"t{i}") for i in range(900)]
    check_shards(sharding.shard(spark.createDataFrame(hot, "doc_id long, text string")).collect(), hot, 8)


def test_sharding_exchanges_copies_where_all_shards_are_full(spark):
    """Every text occurs twice: no shard has room, so copies meet by exchange only."""
    rows = [(i, f"copy {i % 2000}") for i in range(4000)]
    out = sharding.shard(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    check_shards(out, rows, 8)
    where = defaultdict(set)
    for r in out:
        where[r["doc_id"] % 2000].add(r["shard"])
    cut = sum(len(s) > 1 for s in where.values())
    print("cut pairs", cut)
    assert cut < 20                 # under 1 %; the optimum is 0


def test_sharding_reaches_the_optimum_of_small_tables(spark):
    """All ways to place up to eight documents evenly on two shards, against the operator's cut."""
    for texts in ("aabbccdd", "aaabbbcd", "abcdefgh", "aaaabbcc", "aabbcdef"):
        rows = list(enumerate(texts))
        out = {r["doc_id"]: r["shard"] for r in
               sharding.shard(spark.createDataFrame(rows, "doc_id long, text string"), 2).collect()}

        def cut(where):
            return sum(a == b and where[i] != where[j] for i, a in rows for j, b in rows if i < j)
        best = min(cut(dict(enumerate(int(i in half) for i in range(8))))
                   for half in map(set, itertools.combinations(range(8), 4)))
        print(texts, cut(out), best)
        assert sorted(out.values()) == [0] * 4 + [1] * 4
        assert cut(out) == best


def test_rows_without_an_id(spark):
    line = "a line that is long enough to be a key of its own right"
    rows = [(None, "same"), (None, "same"), (7, "other"), (None, "other"), (None, None), (3, None)] + \
        [(i, f"{line}\n{i}") for i in (10, 11, 12, 13)] + [(None, f"{line}\nx"), (None, f"{line}\ny")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((str(r["doc_id"]), str(r["keep_id"]), r["group_size"], r["kept"]) for r in
                 exact_dedup.exact_groups(df).collect() if r["digest"] in {
                     hashlib.sha256(t.encode()).hexdigest() for t in ("same", "other", "")})
    assert got == [("3", "3", 2, True), ("7", "7", 2, True), ("None", "3", 2, False), ("None", "7", 2, False),
                   ("None", "None", 2, True), ("None", "None", 2, True)]
    check_shards(sharding.shard(df, 3).collect(), rows, 3)
    dropped = sorted((str(r["doc_id"]), r["n_lines"], r["n_dropped"]) for r in line_dedup.drop_lines(df).collect())
    assert dropped == sorted([(str(i), 1 if t is None else t.count("\n") + 1, int(i in (10, 11, 12)))
                              for i, t in rows])


def test_quotas_hold_together():
    asked = np.zeros((3, 3, 4))
    asked[0, 1, 2], asked[1, 0, 2], asked[2, 0, 1], asked[0, 2, 3] = 100, 60, 50, 0
    share = sharding.admitted(asked, np.array([10, 0, 5]))
    moved = (asked * share).sum(axis=2)
    assert (moved.sum(axis=0) <= np.array([10, 0, 5]) + moved.sum(axis=1) + 1).all()
    assert moved[1, 0] > 59 and moved[0, 1] > 59 and 9 < moved[2, 0] < 12


# -- 6 exact duplicates ----------------------------------------------------

def test_exact_groups_survive_digest_clashes(spark, edge_docs, no_docs):
    for df in (docs_of(spark), edge_docs):
        want = sorted(tuple(r)[:3] for r in exact_dedup.exact_groups(df).collect())
        short = exact_dedup.exact_groups(df, digest_chars=1, salts=3)
        assert sorted(tuple(r)[:3] for r in short.collect()) == want
    got = {(r["doc_id"], r["keep_id"], r["group_size"]) for r in
           exact_dedup.exact_groups(edge_docs).collect()}
    assert {(1, 1, 3), (2, 1, 3), (3, 1, 3), (4, 4, 2), (5, 4, 2), (6, 6, 1), (11, 11, 2)} <= got
    kept = exact_dedup.drop_copies(edge_docs)
    assert kept.columns == edge_docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(
        {k for _, k, _ in got})                     # one of the repeated rows 11
    assert exact_dedup.exact_groups(no_docs).count() == 0


# -- 7 contamination -------------------------------------------------------

def test_contamination_equals_brute_force(spark, edge_docs, no_docs):
    items = [(1, PASSAGE), (2, "one two"), (3, None), (4, ""), (5, " ".join(PASSAGE.split()[:9])),
             (6, "the quick brown fox jumps over a completely different ending of this phrase here"),
             (7, PASSAGE.upper()), (8, "nothing like this occurs in any of the documents at all")]
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(0))
    want = set()
    for i, t in EDGE_DOCS:
        held = brute.shingles(t)
        for j, u in items:
            s = brute.shingles(u)
            if s and 100 * len(s & held) >= 75 * len(s):
                want.add((i, j, len(s), len(s & held)))
    for block in (5_000, 2):
        got = contamination.contaminated(edge_docs, bench, block_items=block).collect()
        assert {tuple(r) for r in got} == want
    clean = contamination.drop_contaminated(edge_docs, bench, block_items=3)
    assert clean.columns == edge_docs.columns
    assert sorted(r["doc_id"] for r in clean.collect()) == sorted(
        i for i, _ in EDGE_DOCS if i not in {w[0] for w in want})
    assert contamination.contaminated(no_docs, bench).count() == 0
    assert contamination.contaminated(edge_docs, bench.limit(0)).count() == 0


def test_every_text_of_an_item_is_searched(spark):
    a, b, c, d = (" ".join(f"{p}{i}" for i in range(30)) for p in "abcd")
    docs = spark.createDataFrame([(1, a), (2, "x " + b + " y"), (3, c), (4, d), (5, a + " " + b + " z")],
                                 "doc_id long, text string")
    items = spark.createDataFrame([(1, a), (1, b), (1, b), (2, a), (None, c), (None, b), (3, b + " end")],
                                  "item_id long, text string")
    for block in (5_000, 1):
        got = contamination.contaminated(docs, items, block_items=block).collect()
        assert sorted(tuple(r) for r in got) == [
            (1, 1, 26, 26), (1, 2, 26, 26), (2, 1, 26, 26), (2, 3, 27, 26), (5, 1, 26, 26), (5, 2, 26, 26),
            (5, 3, 27, 26)]
        assert [r["doc_id"] for r in contamination.drop_contaminated(
            docs, items, block_items=block).collect()] == [4]


def test_blocks_of_items_are_bounded_by_bytes_and_put_together(spark):
    """One id has texts in many blocks: every row of a document reports the text that it holds most of."""
    texts = [" ".join(f"i{k}w{j}" for j in range(6 + k * 5)) for k in range(9)]
    items = spark.createDataFrame([(7, t) for t in texts] + [(8, texts[0]), (9, "not anywhere at all here")],
                                  "item_id long, text string")
    part = " ".join(texts[8].split()[:40])                      # 36 of 42 shingles
    docs = spark.createDataFrame(
        [(1, f"a {texts[3]} b {part} c"), (1, f"a {texts[3]} b {part} c"), (1, "x " + texts[0]), (2, None),
         (None, texts[5]), (3, "clean text of no item")], "doc_id long, text string")
    want = [(None, 7, 27, 27), (1, 7, 2, 2), (1, 7, 17, 17), (1, 7, 17, 17), (1, 8, 2, 2)]
    for limits in ({}, {"block_bytes": 300}, {"block_items": 1}):
        got = contamination.contaminated(docs, items, **limits).collect()
        assert sorted(map(tuple, got), key=lambda r: (r[0] or 0, *r[1:])) == want
        clean = contamination.drop_contaminated(docs, items, **limits)
        assert clean.columns == docs.columns
        assert sorted(r["doc_id"] for r in clean.collect()) == [2, 3]


def test_an_index_of_varied_items_stays_small():
    rng = np.random.default_rng(5)
    items = [(k, " ".join(map(str, rng.integers(0, 10 ** 6, int(n)))))
             for k, n in enumerate(6 * 2 ** rng.uniform(0, 8, 1_000))]
    index = contamination.ItemIndex(items, 5, 64)
    assert len(__import__("pickle").dumps(index)) < 20_000_000
    text = items[3][1] + " and more " + items[500][1]
    memo = contamination.WordHashes()
    found = index.search([contamination.shingle_hashes(contamination.words_of(text), memo)])[0]
    assert {m for m, n, h in found if n == h} == {3, 500}


# -- 8 near duplicates -----------------------------------------------------

def variants(n=160):
    """Near copies of one text, of one another, and of nothing."""
    r = np.random.default_rng(5)
    base = [f"w{i}" for i in range(120)]
    out = []
    for i in range(n):
        w = list(base)
        for at in r.choice(120, r.integers(0, 7), replace=False):
            w[at] = f"x{i}"
        out.append((i, " ".join(w)))
    out += [(n + i, " ".join(f"y{i}_{j}" for j in range(40))) for i in range(20)]
    return out + [(n + 1, out[n][1]), (n + 19, out[n + 5][1] + " z")]     # ids with two texts


@pytest.mark.parametrize("which", ["edge", "table", "variants"])
def test_near_groups_equal_brute_force(spark, edge_docs, no_docs, which):
    df = {"edge": edge_docs, "table": docs_of(spark), "variants": spark.createDataFrame(
        variants(), "doc_id long, text string")}[which]
    out = near_dedup.near_groups(df, block=16)
    got = sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in out.collect())
    assert got == brute.near_components(pairs(df))
    assert out.filter("kept <> (doc_id = component_id)").count() == 0
    assert near_dedup.near_groups(no_docs).count() == 0


SLID = 13         # neither round's hash leads document 1 to its block


def test_a_pair_that_both_one_block_rounds_miss_is_linked(spark):
    """Texts slide over one row of words: 1 is near to SLID only, and no bucket leads to it."""
    words = [f"e{i}" for i in range(80)]
    rows = [(0, " ".join(words[:60])), (1, " ".join(words[13:73]))]
    rows += [(i, " ".join(words[:i - 2] + [f"x{i}"] + words[i - 1:60])) for i in range(2, 12)]
    rows.append((SLID, " ".join(words[5:65])))
    out = near_dedup.near_groups(spark.createDataFrame(rows, "doc_id long, text string"), block=1)
    got = sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in out.collect())
    assert got == brute.near_components(rows) and {c for _, _, c in got} == {0}


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 140)] \
        + [(139, 200), (300, 300), (7, 7)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r["id"]: r["root"] for r in components(df).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 140)}, 200: 100}
    assert components(df.limit(0)).count() == 0


# -- 9 passages ------------------------------------------------------------

@pytest.mark.parametrize("which", ["edge", "table", "tight"])
def test_repeated_passages_equal_brute_force(spark, edge_docs, no_docs, which):
    length, prefix = (12, 5) if which == "tight" else (50, 20)
    df = docs_of(spark) if which == "table" else edge_docs
    out = suffix_dedup.drop_repeats(df, length=length, prefix=prefix, bucket_bytes=1 << 16)
    got = sorted((r["doc_id"], r["n_bytes"], sum(s["stop"] - s["start"] for s in r["spans"]),
                  len(r["spans"]), __import__("hashlib").sha256(r["kept"]).hexdigest())
                 for r in out.collect())
    assert got == brute.without_repeats(pairs(df), length)
    assert suffix_dedup.drop_repeats(no_docs).count() == 0


def test_rows_that_share_an_id_keep_their_own_passages(spark):
    a, b = "0123456789" * 3 + "shared passage of enough bytes", "other " * 9
    rows = [(1, a), (2, "xx" + a + "yy"), (2, b + a[:40]), (3, b + "!")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r["doc_id"], r["n_bytes"], sum(s["stop"] - s["start"] for s in r["spans"]))
                 for r in suffix_dedup.drop_repeats(df, length=20, prefix=8).collect())
    assert got == sorted(w[:3] for w in brute.without_repeats(rows, 20))


def test_a_frequent_string_with_differing_surroundings(spark):
    """A 20-byte string in a third of all documents: only windows that repeat whole are removed."""
    hot, long = "<div class='article'>"[:20], "a passage of well over fifty bytes that several documents hold"
    rows = [(i, f"{i * 7919:x} " * 6 + (hot if i % 3 == 0 else "")
             + (long if i % 10 == 3 else f" tail {i}")) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = sorted((r["doc_id"], r["n_bytes"], sum(s["stop"] - s["start"] for s in r["spans"]))
                 for r in suffix_dedup.drop_repeats(df, bucket_bytes=1 << 12).collect())
    assert got == sorted(w[:3] for w in brute.without_repeats(rows))


def test_equal_hashes_of_different_strings_are_told_apart():
    strings = np.frombuffer(b"aaaabbbbaaaaccccbbbbaaaa", np.uint8).reshape(-1, 4)
    docs, rows = np.array([1, 2, 3, 3, 4, 4]), np.arange(6)
    for key in (np.zeros(6, np.uint64), np.array([5, 5, 5, 6, 5, 5], np.uint64)):
        assert sorted(suffix_dedup.repeated(key, rows, docs, strings).tolist()) == [2, 4, 5]
    assert not len(suffix_dedup.repeated(np.arange(6), rows, docs, strings))
    text = np.frombuffer(bytes(range(200)), np.uint8)
    pos, name = suffix_dedup.anchors(text)
    assert (suffix_dedup._mixed(suffix_dedup.names_at(text, pos, 20)) == name).all()


# -- 10 lines --------------------------------------------------------------

@pytest.mark.parametrize("batches", [1, 3, 7])
def test_lines_equal_brute_force(spark, edge_docs, no_docs, batches):
    out = line_dedup.drop_lines(edge_docs, batches=batches, buckets=3) \
        .select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256))
    assert sorted(tuple(r) for r in out.collect()) == brute.without_lines(pairs(edge_docs))
    assert line_dedup.drop_lines(no_docs, batches=batches).count() == 0


def test_line_runs_are_compacted_and_whole(spark):
    runs = line_dedup.LineRuns(spark, buckets=2, fanout=2)
    try:
        for k in range(9):
            runs.add(spark.createDataFrame([(bytes([i]), 1, 100 * k + i) for i in range(k, k + 4)],
                                           "key binary, docs long, last long"))
        assert all(len(level) < 2 for level in runs.levels + runs.repeats)
        got = {r["key"][0]: (r["docs"], r["last"]) for r in runs.counts().collect()}
    finally:
        runs.close()
    want = {}
    for k in range(9):
        for i in range(k, k + 4):
            want[i] = (want.get(i, (0, 0))[0] + 1, 100 * k + i)
    assert got == want


# -- rows without an id ----------------------------------------------------

def test_rows_without_an_id_are_kept_and_compared(spark):
    """A unique text, a repeated one, a copy and a near copy of a text with an id."""
    lone, twice, near = (" ".join(f"{p}{i}" for i in range(40)) for p in "uvw")
    rows = [(1, PASSAGE), (2, near), (-3, "short"), (None, lone), (None, twice), (None, twice),
            (None, PASSAGE), (None, near + " z"), (None, None), (None, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")

    def texts(out):
        return sorted(r["text"] or "" for r in out.collect())
    assert texts(exact_dedup.drop_copies(df)) == sorted(
        ["", "short", PASSAGE, near, near + " z", lone, twice])
    assert texts(near_dedup.drop_near_copies(df)) == sorted(
        ["", "", "short", PASSAGE, near, lone, twice, twice])
    groups = near_dedup.near_groups(df)
    assert groups.count() == len(rows) and groups.filter("component_id IS NULL OR kept IS NULL").isEmpty()
    assert {(r["doc_id"], r["component_id"], r["kept"]) for r in
            groups.filter("component_id <= 2").collect()} == {
        (1, 1, True), (2, 2, True), (-3, -3, True), (None, 1, False), (None, 2, False)}
    assert groups.filter("doc_id IS NULL AND kept").select("component_id").distinct().count() == 3
    out = suffix_dedup.drop_repeats(df).collect()
    assert sorted((r["doc_id"] or 0, r["kept"].decode()) for r in out) == sorted(
        [(1, PASSAGE), (2, near), (-3, "short"), (0, lone), (0, twice), (0, twice), (0, ""),
         (0, " z"), (0, ""), (0, "")])


def test_the_first_batch_of_lines_is_a_run_without_a_copy(spark, monkeypatch):
    names, real = [], line_dedup.written
    monkeypatch.setattr(line_dedup, "written", lambda df, name: names.append(name) or real(df, name))
    line = "a line of more than forty characters, found everywhere"
    docs = spark.createDataFrame([(n, f"{line}\nown {n}") for n in range(12)], "doc_id long, text string")
    for batches in (1, 3):
        names.clear()
        got = {r.doc_id: r.kept_text for r in line_dedup.drop_lines(docs, batches=batches, buckets=2).collect()}
        assert got == {n: f"{line}\nown {n}" if n == 11 else f"own {n}" for n in range(12)}
        assert names.count("line-batch") == batches - 1
