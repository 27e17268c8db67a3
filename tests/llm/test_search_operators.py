"""Operators 11 to 13: brute force and edge cases (SQL parity of 11 and 12 is in the common test)."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from adcredit.llm import block_topk, feast, nra, queries, vectors
from conftest import SF_MID, SF_SMALL

from .conftest import EDGE_DOCS, LONG, PASSAGE

NAN, INF = float("nan"), float("inf")


# -- 11 top-k --------------------------------------------------------------

def brute_top(rows, asked, k):
    """Rows of (id, integer vector); missing last components are 0."""
    def dot(a, b):
        return sum(x * y for x, y in zip(a, b))
    return sorted((q, n + 1, i, s) for q, v in asked for n, (s, i) in enumerate(
        sorted(((dot(v, w), j) for j, w in rows if j != q), key=lambda x: (-x[0], x[1]))[:k]))


def frame(spark, rows):
    return spark.createDataFrame([(i, v, -1, "x") for i, v in rows],
                                 "vec_id long, v array<long>, id int, slot string")


@pytest.mark.parametrize("shape", [(256, 16, 1024), (9, 3, 4)])
def test_top_k_equals_brute_force(spark, shape):
    rng = np.random.default_rng(5)
    rows = [(int(i), v.tolist()) for i, v in zip(rng.permutation(240), rng.integers(-9, 9, (240, 5)))]
    rows += [(300 + i, [3, 3, 3, 3, 3]) for i in range(120)]                # one very common vector
    rows += [(500, []), (501, [4]), (502, [1, 2, 3]), (7, [5, 5]), (7, [5, 5]), (-50, [0] * 5)]
    asked = [r for r in rows if r[0] % 50 == 0 or r[0] == 7]
    got = block_topk.top_k(frame(spark, rows), frame(spark, asked), 5, "vec_id", "v", *shape)
    assert sorted(map(tuple, got.collect())) == brute_top(rows, asked, 5)


def test_top_k_prunes_blocks():
    """Blocks whose bound is below the threshold are not scored, equal ones only for smaller ids."""
    x = np.repeat(np.array([[5, 5], [-5, -5], [5, 5]]), 4, axis=0)
    ids = np.arange(12)
    row = {"ids": ids.tobytes(), "vals": x.tobytes(), "low": x[::4].copy().tobytes(),
           "high": x[::4].copy().tobytes(), "least": ids[::4].copy().tobytes()}
    r, scored = block_topk.Range(row, 2, 4, np.float64), []
    score = r.scores
    r.scores = lambda q, b: scored.append(int(b)) or score(q, b)
    out = list(block_topk._search(3)({"chunk": 0, "known": None}, np.array([[1.0, 1.0]]), np.array([99]), r))
    assert scored == [0] and out[0].column("vec_id").to_pylist() == [0, 1, 2]


def test_top_k_edge_cases(spark):
    rows = [(0, [1, 1]), (1, None), (None, [9, 9]), (50, [1, None]), (2, [2, 2]), (100, [0, 1])]
    df = frame(spark, rows)
    got = block_topk.top_k(df, df.filter("vec_id % 50 = 0"), 5)
    good = [(0, [1, 1]), (2, [2, 2]), (100, [0, 1])]
    assert sorted(map(tuple, got.collect())) == brute_top(good, [good[0], good[2]], 5)
    none = df.filter("false")
    assert block_topk.top_k(df, none).isEmpty() and block_topk.top_k(none, df).isEmpty()
    only = df.filter("vec_id = 0")
    assert block_topk.top_k(only, only).isEmpty()
    big = 2 ** 30
    far = frame(spark, [(0, [big, 1]), (1, [big, 3]), (2, [big, 4])])       # beyond a double's 53 bits
    assert [tuple(r) for r in block_topk.top_k(far, far.filter("vec_id = 0"), 1).collect()] == [
        (0, 1, 2, 2 ** 60 + 4)]
    with pytest.raises(ValueError, match="too large"):
        block_topk.top_k(frame(spark, [(0, [2 ** 40]), (1, [2 ** 40])]), far)


def test_vectors_that_take_part(spark):
    df = spark.createDataFrame(
        [(1, [0.5, -0.001]), (2, None), (3, [1.0, None]), (4, [NAN]), (5, [INF]), (6, [-INF, 1.0]), (7, [])],
        "vec_id long, embedding array<float>")
    got = df.filter(vectors.usable("embedding")).select("vec_id", vectors.scaled("embedding", 256).alias("v"))
    assert {r["vec_id"]: r["v"] for r in got.collect()} == {1: [128, -1], 7: []}


# -- 12 ranked search ------------------------------------------------------

def terms_of(text):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return [t.translate(lower) for t in
            re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "")]


def brute_search(docs, items, k=10):
    held = [(i, Counter(terms_of(t))) for i, t in docs]
    sizes = [sum(c.values()) for _, c in held]
    n_docs, total = sum(1 for s in sizes if s), max(sum(sizes), 1)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        scores = []
        for (doc, c), n in zip(held, sizes):
            m = 100 - 90 + (90 * n * n_docs) // total
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m)) for t in set(terms_of(text)) if c[t])
            if s > 0:
                scores.append((-s, doc is None, doc))
        out += [(item, r + 1, doc, -s) for r, (s, _, doc) in enumerate(sorted(
            scores, key=lambda x: (x[0], x[1], x[2] or 0))[:k])]
    return sorted(out, key=str)


ITEMS = [(1, PASSAGE), (2, "word1 FILLER3, quick!"), (3, None), (4, ""), (5, "?!"), (6, "nowhere"),
         (7, "line line LINE one"), (7, "漢字 ünïcode text"), (None, "brown fox"), (8, LONG), (9, "aaaa" * 50)]


def test_search_equals_brute_force_on_edge_cases(spark, edge_docs, no_docs):
    more = [(40 + i, PASSAGE) for i in range(15)] + [(None, PASSAGE), (None, "fox")]     # ties, NULL ids
    docs = edge_docs.select("doc_id", "text", "lang", F.lit(1).alias("row"), F.lit("t").alias("term")) \
        .unionByName(spark.createDataFrame([(i, t, "x", 2, "u") for i, t in more],
                                           "doc_id long, text string, lang string, row int, term string"))
    items = spark.createDataFrame([(i, t, 5) for i, t in ITEMS], "item_id long, text string, w int")
    got = sorted(map(tuple, nra.search(docs, items).collect()), key=str)
    assert got == brute_search(EDGE_DOCS + more, ITEMS)
    assert nra.search(no_docs, items).isEmpty()
    assert nra.search(docs, items.filter("false")).isEmpty()
    assert nra.search(docs, items.filter("item_id = 6")).isEmpty()


def test_search_settles_early_and_stays_exact(spark):
    """Every list of an item need not be read for all documents; k = 1 and 3 as well."""
    docs, items = (spark.read.parquet(f"{SF_SMALL}/{t}.parquet") for t in ("documents", "benchmark"))
    rows, asked = ([(r[0], r["text"]) for r in t.collect()] for t in (docs, items))
    for k in (1, 3):
        got = sorted(map(tuple, nra.search(docs, items, k).collect()), key=str)
        assert got == brute_search(rows, asked, k)


# -- 13 whitening ----------------------------------------------------------

def brute_white(x, k=8):
    n, s = len(x), x.sum(axis=0)
    c = x - s / n
    v = c.T @ c / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    return e, c @ u / np.sqrt(e), [int(sum((n * int(a) - int(b)) ** 2 for a, b in zip(r, s))) for r in x], np.trace(v)


def check_white(got, ids, x, k=8):
    e, w, deviation, trace = brute_white(x, k)
    by = {(r["vec_id"], r["component"]): r for r in got}
    assert len(by) == len(got) == len(x) * len(e)
    for j in range(len(e)):
        mine = np.array([by[i, j + 1]["whitened"] for i in ids])
        sign = np.sign(mine @ w[:, j])
        assert np.abs(mine * sign - w[:, j]).max() < 1e-8
        assert abs(by[ids[0], j + 1]["explained"] / (e[j] / trace) - 1) < 1e-9
    assert [by[i, 1]["deviation"] for i in ids] == deviation
    assert {r["n"] for r in got} == {len(x)}
    assert len({r["identity_error"] for r in got}) == 1 and got[0]["identity_error"] < 1e-9


def test_query_equals_dense_eigenvectors(spark):
    got = queries.QUERIES["op13_whitening"](spark, SF_MID).collect()
    table = spark.read.parquet(f"{SF_MID}/embeddings.parquet").collect()
    x = np.array([[math.floor(1024 * c) + 100000 for c in r["embedding"]] for r in table])
    check_white(got, [r["vec_id"] for r in table], x)


@pytest.mark.parametrize("dims", [3, 12])
def test_whitening_equals_dense_eigenvectors(spark, dims):
    rng = np.random.default_rng(dims)
    x = rng.integers(-1000, 1000, (400, dims)) * np.arange(1, dims + 1)
    df = spark.createDataFrame([(i, r.tolist(), 0, 0) for i, r in enumerate(x)],
                               "vec_id long, x array<long>, n int, component int").repartition(3)
    check_white(feast.whiten(df).collect(), list(range(400)), x)


def test_whitening_of_equal_eigenvalues(spark):
    """Every eigenvalue is the same; three of twelve are; a rank below k."""
    cube = [[s * 100 * (i == j) for j in range(12)] for i in range(12) for s in (1, -1)]
    for scale, rank in (([1] * 12, 12), ([3, 3, 3] + [1] * 9, 12), ([5, 4] + [0] * 10, 2)):
        x = np.array(cube) * np.array(scale)
        df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "vec_id long, x array<long>")
        got = feast.whiten(df).collect()
        k = min(8, rank)
        assert len(got) == k * len(x) and max(r["identity_error"] for r in got) < 1e-9
        values = np.sort(np.linalg.eigvalsh(np.cov(x.T, bias=True)))[::-1]
        explained = {r["component"]: r["explained"] for r in got}
        assert np.allclose([explained[j + 1] for j in range(k)], values[:k] / values.sum(), rtol=1e-9)


def test_whitening_edge_cases(spark):
    def run(rows):
        return feast.whiten(spark.createDataFrame(rows, "vec_id long, x array<long>"), fill=7).collect()
    assert run([]) == [] and run([(1, [1, 2])]) == [] and run([(1, [5, 5]), (2, [5, 5])]) == []
    assert run([(1, []), (2, [])]) == [] and run([(1, None)]) == []
    got = run([(1, [1, 2]), (1, [1, 2]), (None, [4, 9]), (2, [3]), (3, None)])     # [3] is [3, 7]
    x = np.array([[1, 2], [1, 2], [4, 9], [3, 7]])
    e, w, deviation, _ = brute_white(x)
    assert sorted((r["vec_id"] or 0, r["deviation"]) for r in got if r["component"] == 1) == sorted(
        zip([1, 1, 0, 2], deviation))
    assert len(got) == 4 * 2
    huge = run([(1, [2 ** 40, 0]), (2, [0, 3]), (3, [1, 1])])
    assert {r["deviation"] for r in huge} == {None}


def test_inertia_counts_positive_eigenvalues():
    rng = np.random.default_rng(1)
    for d in (1, 2, 5, 20):
        for _ in range(20):
            a = rng.standard_normal((d, d))
            a = a + a.T
            assert feast.inertia(a) == (np.linalg.eigvalsh(a) > 0).sum()
    assert feast.inertia(np.zeros((4, 4))) == 0
    assert feast.inertia(np.array([[0.0, 1.0], [1.0, 0.0]])) == 1
