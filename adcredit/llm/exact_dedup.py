"""Exact duplicates with skew-safe combining (operator 6).

Texts are equal when they are identical after every run of blanks is replaced by one space.
Three combining steps, each grouping by the *full* normalised text (the digest in front only
places it):

1. locally: Spark's partial aggregation merges the copies that share a map task and a salt;
2. per (digest, salt): the salt, from the id, splits a digest's copies over tasks;
3. per digest: the salt winners, at most ``salts`` rows a text, meet globally.

Every row then finds its group by (digest, salt), so the rows of a hot group stay
spread. If two different texts ever share a digest, the rows of those digests are joined by
their full text instead; the test shrinks the digest to provoke that.

Defined results: NULL counts as the empty text, so NULL and empty texts form
one group; of equal texts the smallest id stays, and rows that repeat an id and a text
count in ``group_size`` and each get a row of the result (all of them kept, if that id is the
winner); NULL ids are no smallest id, so ``keep_id`` is NULL where only they hold a text, and
``kept`` compares as equal what is NULL on both sides: all rows of such a group are kept (no id tells them apart; in
:func:`drop_copies` one of them stays), and none where a row with an id has the text; an empty table gives an empty table; columns beside id and text are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adcredit.llm.common import BLANKS, known_ids, whole_text, written


def normalised(text_col: str = "text") -> Column:
    return F.regexp_replace(whole_text(text_col), BLANKS, " ")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 salts: int = 16, digest_chars: int = 64) -> DataFrame:
    """(id, keep_id, group_size, kept, digest) of every row.

    ``digest`` is the SHA-256 of the normalised text in hex (its first ``digest_chars``).
    """
    if salts < 1 or not 1 <= digest_chars <= 64:
        raise ValueError("salts must be positive, digest_chars in 1..64")
    text = normalised(text_col)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("norm")) \
        .select("id", "norm", F.substring(F.sha2("norm", 256), 1, digest_chars).alias("digest"),
                F.pmod(F.xxhash64("id"), F.lit(salts)).cast("int").alias("salt"))
    salted = rows.groupBy("digest", "salt", "norm").agg(
        F.min("id").alias("id"), F.count(F.lit(1)).alias("n"))
    # the winners of every text: ids and counts, with the salts that hold copies
    texts = salted.groupBy("digest", "norm").agg(
        F.min("id").alias("keep_id"), F.sum("n").alias("group_size"),
        F.collect_set("salt").alias("salts"))           # at most ``salts`` numbers
    groups = written(
        texts.select("digest", "keep_id", "group_size", "salts"), "exact-groups")
    clashes = groups.groupBy("digest").agg(F.count(F.lit(1)).alias("texts")) \
        .filter("texts > 1").select("digest")
    places = groups.select("digest", F.explode("salts").alias("salt"), "keep_id", "group_size")
    narrow = rows.select("id", "digest", "salt")
    if clashes.isEmpty():
        out = narrow.join(places, ["digest", "salt"])
    else:
        shared = written(clashes, "digest-clashes")
        clear = narrow.join(shared, "digest", "left_anti").join(places, ["digest", "salt"])
        winners = texts.join(shared, "digest", "left_semi") \
            .select("digest", "norm", F.explode("salts").alias("salt"), "keep_id", "group_size")
        unclear = rows.join(shared, "digest", "left_semi") \
            .join(winners, ["digest", "salt", "norm"]).select(*clear.columns)
        out = clear.unionByName(unclear)
    return out.select(F.col("id").alias(id_col), "keep_id", "group_size",
                      F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), "digest")


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs``, every column, with one row of every group of equal texts.

    The row with the smallest id stays; if that very row is repeated, one of its repetitions does.
    Rows with a NULL id come after all others: one stays where no row with an id has the text.
    """
    number = "".join(docs.columns) + "_id"              # a name that no column has
    own = docs.withColumn(number, known_ids(docs, id_col, text_col)[0])
    groups = exact_groups(own, number, text_col)
    keep = written(groups.filter(F.col(number) == F.col("keep_id")).select(number, "digest"),
                   "exact-keep")
    out = own.join(keep.select(number).distinct(), number, "left_semi").select(*docs.columns)
    if keep.groupBy(number).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").isEmpty():
        return out
    # several rows share a winning id: tell their texts apart
    digest = "".join(docs.columns) + "_digest"
    own = own.withColumn(digest, F.sha2(normalised(text_col), 256))
    winners = keep.distinct().withColumnRenamed("digest", digest)
    return own.join(winners, [number, digest], "left_semi") \
        .dropDuplicates([number, digest]).select(*docs.columns)
