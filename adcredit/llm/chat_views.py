"""Chat formatting by perspective rotation (operator 3).

Every participant of a conversation gets a rendering of the whole dialogue in which that
speaker is the assistant and all others are named users. A rendering is returned as
segments, one a turn, in order: header, text, end mark, its character offset in the
rendering, and the span that a loss mask covers (text and end mark of the
assistant's turns, nothing else). Laid end to end by ``position`` the segments are the
rendering; a conversation of any length is never gathered in one row or one task.

Order and offsets are prefix sums over range partitions: sorted pieces are summed, the few
sums per (conversation, perspective, piece) are accumulated, and each piece continues
from them.

Speakers in ``directions`` (system prompts) are rendered in every perspective and take none of
their own. Turns are ordered by turn number, then speaker, then text.

Defined results: a NULL speaker is the speaker "unknown", a NULL text is empty, a NULL turn
number comes first; repeated rows are repeated turns; a conversation of directions only has no
perspective; a NULL conversation id is an id like others; an empty table gives an
empty table; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adcredit.llm.common import written

ASSISTANT, USER, DIRECTION = "<|assistant|>\n", "<|user name={}|>\n", "<|{}|>\n"
END = "<|end|>\n"


def _header(speaker: Column, perspective: Column, directions: list[str]) -> Column:
    def named(form: str) -> Column:
        start, end = form.split("{}")
        return F.concat(F.lit(start), speaker, F.lit(end))
    return F.when(speaker == perspective, F.lit(ASSISTANT)) \
        .when(speaker.isin(directions), named(DIRECTION)).otherwise(named(USER))


def perspectives(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                 speaker_col: str = "role", text_col: str = "text",
                 directions: tuple[str, ...] = ("system",), pieces: int | None = None) -> DataFrame:
    """Segments: (conv, perspective, position, turn, speaker, segment, start, mask_start, mask_end)."""
    spark = turns.sparkSession
    pieces = pieces or max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    directions = list(directions)
    rows = turns.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"),
                        F.coalesce(F.col(speaker_col).cast("string"), F.lit("unknown")).alias("speaker"),
                        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    people = rows.filter(~F.col("speaker").isin(directions) if directions else F.lit(True)) \
        .select("conv", F.col("speaker").alias("perspective")).distinct()
    seen = rows.alias("r").join(people.alias("p"), F.col("r.conv").eqNullSafe(F.col("p.conv"))) \
        .select("r.*", "perspective")
    text = F.concat(_header(F.col("speaker"), F.col("perspective"), directions), "text", F.lit(END))
    order = ["turn", "speaker", "text"]
    # equal rows are told apart by their place in the input, so that they can be dealt to tasks
    dealt = seen.withColumn("segment", text).withColumn("row", F.monotonically_increasing_id()) \
        .repartitionByRange(pieces, "conv", "perspective", *order, "row") \
        .withColumn("piece", F.spark_partition_id())
    dealt = written(dealt, "chat-pieces")
    view = ["conv", "perspective"]
    sums = dealt.groupBy(*view, "piece").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.char_length("segment")).alias("chars"))
    before = Window.partitionBy(*view).orderBy("piece") \
        .rowsBetween(Window.unboundedPreceding, -1)     # at most ``pieces`` rows a view
    base = sums.select(*view, "piece", *[
        F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_before") for c in ("n", "chars")])
    own = Window.partitionBy(*view, "piece").orderBy(*order, "row")
    out = dealt.withColumn("nth", F.row_number().over(own)).withColumn("upto", F.sum(
        F.char_length("segment")).over(own.rowsBetween(Window.unboundedPreceding, 0)))
    out = out.alias("o").join(base.alias("b"), (F.col("o.piece") == F.col("b.piece")) & F.col(
        "o.conv").eqNullSafe(F.col("b.conv")) & (F.col("o.perspective") == F.col("b.perspective")))
    length = F.char_length("segment")
    start = (F.col("chars_before") + F.col("upto") - length).cast("long")
    trained = F.col("speaker") == F.col("o.perspective")
    return out.select(
        F.col("o.conv").alias(conv_col), F.col("o.perspective").alias("perspective"),
        (F.col("n_before") + F.col("nth") - 1).cast("long").alias("position"),
        F.col("turn").alias(turn_col), F.col("speaker"), F.col("segment"), start.alias("start"),
        F.when(trained, start + len(ASSISTANT)).cast("long").alias("mask_start"),
        F.when(trained, start + length).cast("long").alias("mask_end"))
