"""Registered queries of the training-text operators and their DuckDB SQL.

Every query applies one operator, with production parameters, to its whole
table. SQL is given where it can express the result in reasonable time; the other queries
are compared with brute force in ``tests/llm``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adcredit.llm import (block_topk, chat_views, contamination, exact_dedup, feast, line_dedup,
                          near_dedup, nra, packing, sharding, suffix_dedup, token_count, vectors)
from adcredit.llm import toxicity as tox
from adcredit.llm.common import table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn
    return add


def held_out(id_col: str = "doc_id"):
    """The fold that no label may be learned from: crc32 of the id's text, mod 4, is 2."""
    return F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(4)) == 2


@query("op1_toxicity")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    lexicon = tox.fit(docs, table(spark, sf_dir, "labels"), ~held_out())
    return tox.toxicity(docs, lexicon).withColumn("held_out", held_out())


@query("op2_token_counts")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_count.token_counts(table(spark, sf_dir, "documents"),
                                      public_tokenizers.path("byte_bpe_50k.json"))
    return counts.withColumn("over_limit", F.col("n_tokens") > 1024)


@query("op3_chat_views", r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, 'unknown') AS speaker, coalesce(text, '') AS text,
           row_number() OVER () AS row
    FROM conversations),
people AS (SELECT DISTINCT conv_id, speaker AS perspective FROM turns WHERE speaker <> 'system'),
segments AS (
    SELECT t.conv_id, p.perspective, t.turn, t.speaker, t.text, t.row,
           CASE WHEN t.speaker = p.perspective THEN '<|assistant|>' || chr(10)
                WHEN t.speaker = 'system' THEN '<|system|>' || chr(10)
                ELSE '<|user name=' || t.speaker || '|>' || chr(10) END
           || t.text || '<|end|>' || chr(10) AS segment
    FROM turns t JOIN people p ON t.conv_id IS NOT DISTINCT FROM p.conv_id),
placed AS (
    SELECT *, row_number() OVER told - 1 AS position,
           coalesce(sum(length(segment)) OVER (told ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
           AS start
    FROM segments
    WINDOW told AS (PARTITION BY conv_id, perspective ORDER BY turn NULLS FIRST, speaker, text, row))
SELECT conv_id, perspective, position, turn, speaker, segment, CAST(start AS BIGINT) AS start,
       CASE WHEN speaker = perspective THEN CAST(start + 14 AS BIGINT) END AS mask_start,
       CASE WHEN speaker = perspective THEN CAST(start + length(segment) AS BIGINT) END AS mask_end
FROM placed
""")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_views.perspectives(table(spark, sf_dir, "conversations"))


@query("op4_packing")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"),
                          public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
                         "doc_tokens", "sequence_id", "offset")


@query("op5_sharding")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


@query("op6_exact_dedup", r"""
WITH d AS (
    SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t
    FROM documents)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id IS NOT DISTINCT FROM min(doc_id) OVER same AS kept, sha256(t) AS text_sha256
FROM d WINDOW same AS (PARTITION BY t)
""")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = exact_dedup.exact_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


@query("op7_contamination", r"""
WITH texts AS (
    SELECT 0 AS kind, doc_id AS id, text FROM documents
    UNION ALL SELECT 1, item_id, text FROM benchmark),
words AS (
    SELECT kind, id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ 	-
]+'),
        lambda w: w <> '') AS w
    FROM texts),
shingles AS (
    SELECT DISTINCT kind, id, array_to_string(w[i:i + 4], ' ') AS s
    FROM (SELECT kind, id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i
          FROM words WHERE len(w) > 0)),
sizes AS (SELECT id, count(*) AS n FROM shingles WHERE kind = 1 GROUP BY id)
SELECT d.id AS doc_id, b.id AS item_id, any_value(n) AS n_shingles, count(*) AS n_held
FROM shingles d JOIN shingles b ON d.s = b.s AND d.kind = 0 AND b.kind = 1
JOIN sizes ON sizes.id = b.id
GROUP BY d.id, b.id HAVING 100 * count(*) >= 75 * any_value(n)
""")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination.contaminated(table(spark, sf_dir, "documents"),
                                      table(spark, sf_dir, "benchmark"))


@query("op8_near_dedup")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_groups(table(spark, sf_dir, "documents"))


@query("op9_suffix_dedup")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffix_dedup.drop_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return cut.select("doc_id", "n_bytes", removed.alias("n_removed"),
                      F.size("spans").cast("long").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"))


@query("op10_line_dedup", r"""
WITH lines AS (
    SELECT doc_id, row, unnest(l) AS line, unnest(range(len(l))) AS pos
    FROM (SELECT doc_id, row_number() OVER () AS row,
                 string_split(coalesce(text, ''), chr(10)) AS l FROM documents)),
keyed AS (
    SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM lines),
common AS (
    SELECT key, max(doc_id) AS last FROM keyed WHERE length(key) >= 40
    GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
marked AS (
    SELECT k.*, common.key IS NOT NULL AND k.doc_id <> last AS gone
    FROM keyed k LEFT JOIN common ON k.key = common.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id, row
""")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.drop_lines(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


@query("op11_block_topk", """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda c: CAST(floor(256 * CAST(c AS DOUBLE)) AS BIGINT)) AS x
    FROM embeddings
    WHERE len(list_filter(embedding, lambda c: c IS NOT NULL AND isfinite(c))) = len(embedding)),
entries AS (SELECT vec_id, unnest(x) AS c, unnest(range(len(x))) AS d FROM v),
scores AS (
    SELECT q.vec_id AS query_id, r.vec_id, CAST(sum(q.c * r.c) AS BIGINT) AS score
    FROM entries q JOIN entries r ON q.d = r.d AND q.vec_id <> r.vec_id
    WHERE q.vec_id % 50 = 0 GROUP BY q.vec_id, r.vec_id)
SELECT query_id, CAST(rank AS INT) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scores)
WHERE rank <= 5
""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").filter(vectors.usable("embedding")) \
        .select("vec_id", vectors.scaled("embedding", 256).alias("v"))
    return block_topk.top_k(rows, rows.filter("vec_id % 50 = 0"))


@query("op12_ranked_search", r"""
WITH words AS (
    SELECT 0 AS kind, row_number() OVER () AS row, doc_id AS id,
           regexp_extract_all(coalesce(text, ''), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
    FROM documents
    UNION ALL
    SELECT 1, row_number() OVER (), item_id,
           regexp_extract_all(coalesce(text, ''), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')
    FROM benchmark),
counted AS (
    SELECT kind, row, id, len(w) AS n, translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term,
           count(*) AS tf
    FROM (SELECT kind, row, id, w, unnest(w) AS t FROM words) GROUP BY ALL),
sizes AS (SELECT count(*) AS nn, CAST(sum(len(w)) AS BIGINT) AS l FROM words WHERE kind = 0 AND len(w) > 0),
weights AS (
    SELECT term, CAST(floor(1000 * ln((2 * nn + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS wt
    FROM counted, sizes WHERE kind = 0 GROUP BY term, nn),
scores AS (
    SELECT i.row AS item, i.id AS item_id, d.row, d.id AS doc_id,
           CAST(sum(wt * ((1000000000 * d.tf) // (1000 * d.tf + 8 * (10 + (90 * d.n * nn) // l)))) AS BIGINT) AS score
    FROM counted d JOIN counted i ON d.term = i.term AND d.kind = 0 AND i.kind = 1
    JOIN weights ON weights.term = d.term, sizes
    GROUP BY ALL)
SELECT item_id, CAST(rank AS INT) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST, row) AS rank
      FROM scores WHERE score > 0)
WHERE rank <= 10
""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nra.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op13_whitening")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").filter(vectors.usable("embedding")) \
        .select("vec_id", vectors.scaled("embedding", 1024, 100_000).alias("x"))
    return feast.whiten(rows, fill=100_000)
