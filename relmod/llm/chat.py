"""Chat formatting by perspective rotation [native].

Every participant of a conversation gets a rendering of its own: that
speaker's turns are the assistant's, the others' are named users', and the
training mask covers the assistant's words alone. System turns are context in
every rendering and no participant's.

A rendering is a sequence of segments, one per turn, with offsets into the
whole text, so that no conversation, however long, has to fit in one row or
one task: the rendered text is the segments in order of ``position``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from relmod.llm.common import stored, tasks_for

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
#: Marks in the turns' own words are broken up so that no turn can end itself.
MARK, BROKEN_MARK = "<|im_", "< |im_"
SYSTEM = "system"
UNNAMED = "unknown"
#: What names cannot hold as it is: white space and the marks' characters, and the percent sign that stands for them.
ESCAPED = "% \t\n\x0b\f\r<|>"
_NAMED_UNNAMED = f"%{ord(UNNAMED[0]):02X}{UNNAMED[1:]}"
ROWS_PER_TASK = 50_000


def rotate(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per turn and perspective.

    Columns: conv_id, perspective (the participant who is the assistant),
    position (0-based place in the rendering), turn, speaker, role (system,
    user or assistant), segment (rendered text), start (its offset in code
    points), mask_start and mask_end (the offsets that the assistant learns:
    its words and the closing mark; null in other segments).

    Turns stand in order of turn, then speaker, then the text's md5; null
    turns come first. A null or empty role is the speaker 'unknown'; names are
    told apart one to one, characters that a rendering's head cannot hold being
    written as % and two hex digits, and a role named 'unknown' as '%75nknown'. A null
    text is empty, a null conv_id is a conversation. Repeated rows are
    repeated turns. A conversation in which only the system speaks has no
    participant and no rendering. An empty table gives an empty result; other
    columns are not read.

    The only list that is gathered is that of a conversation's speakers. Rows
    are range-partitioned in rendering order; offsets are sums within a
    partition plus the sums of the partitions before it.
    """
    spark = df.sparkSession
    name = F.col(role)
    for c in ESCAPED:
        name = F.replace(name, F.lit(c), F.lit(f"%{ord(c):02X}"))
    name = F.when(name == UNNAMED, F.lit(_NAMED_UNNAMED)).otherwise(F.coalesce(F.nullif(name, F.lit("")), F.lit(UNNAMED)))
    turns = df.select(
        F.col(conv).alias("conv_id"),
        F.col(turn).alias("turn"),
        name.alias("speaker"),
        F.replace(F.coalesce(F.col(text), F.lit("")), F.lit(MARK), F.lit(BROKEN_MARK)).alias("_words"),
    )
    cast = (
        turns.filter(F.col("speaker") != SYSTEM)
        .groupBy("conv_id")
        .agg(F.collect_set("speaker").alias("_cast"))
        .select(F.col("conv_id").alias("_conv"), "_cast")
    )
    seen = turns.join(cast, F.col("conv_id").eqNullSafe(F.col("_conv"))).select(
        "conv_id", F.explode("_cast").alias("perspective"), "turn", "speaker", "_words"
    )
    role_ = (
        F.when(F.col("speaker") == SYSTEM, F.lit(SYSTEM))
        .when(F.col("speaker") == F.col("perspective"), F.lit("assistant"))
        .otherwise(F.lit("user"))
    )
    head = F.concat(
        F.lit(OPEN),
        F.col("role"),
        F.when(F.col("role") == "user", F.concat(F.lit(" name="), F.col("speaker"))).otherwise(F.lit("")),
        F.lit("\n"),
    )
    drawn = (
        seen.withColumn("role", role_)
        .withColumn("_head", F.length(head))
        .select(
            "conv_id",
            "perspective",
            "turn",
            "speaker",
            "role",
            "_head",
            F.concat(head, F.col("_words"), F.lit(CLOSE + "\n")).alias("segment"),
            F.md5("_words").alias("_sum"),
            F.length("_words").alias("_size"),
        )
    )
    keys = ["conv_id", "perspective", "turn", "speaker", "_sum"]
    n = df.count()
    placed = stored(
        drawn.repartitionByRange(tasks_for(n, ROWS_PER_TASK, spark), *keys).withColumn("_part", F.spark_partition_id()),
        "turns",
    )
    size = F.length("segment").cast("long")
    group = Window.partitionBy("_part", "conv_id", "perspective")
    here = group.orderBy("turn", "speaker", "_sum").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    within = placed.select(
        "*", F.count(F.lit(1)).over(here).alias("_n"), F.sum(size).over(here).alias("_end"), size.alias("_long")
    )
    # one row for each rendering and partition that holds some of it
    before = Window.partitionBy("_c", "_p").orderBy("_q").rowsBetween(Window.unboundedPreceding, -1)
    parts = (
        placed.groupBy(F.col("_part").alias("_q"), F.col("conv_id").alias("_c"), F.col("perspective").alias("_p"))
        .agg(F.count(F.lit(1)).alias("_rows"), F.sum(size).alias("_chars"))
        .select(
            "_q",
            "_c",
            "_p",
            F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_rows_before"),
            F.coalesce(F.sum("_chars").over(before), F.lit(0)).alias("_chars_before"),
        )
    )
    start = F.col("_chars_before") + F.col("_end") - F.col("_long")
    mine = F.col("role") == "assistant"
    return within.join(
        parts,
        (F.col("_part") == F.col("_q")) & F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("perspective") == F.col("_p")),
    ).select(
        "conv_id",
        "perspective",
        (F.col("_rows_before") + F.col("_n") - 1).alias("position"),
        "turn",
        "speaker",
        "role",
        "segment",
        start.alias("start"),
        F.when(mine, start + F.col("_head")).alias("mask_start"),
        F.when(mine, start + F.col("_head") + F.col("_size") + len(CLOSE)).alias("mask_end"),
    )


def _name_sql(role: str) -> str:
    name = role
    for c in ESCAPED:
        name = f"replace({name}, chr({ord(c)}), '%{ord(c):02X}')"
    return f"CASE WHEN {name} = '{UNNAMED}' THEN '{_NAMED_UNNAMED}' ELSE coalesce(nullif({name}, ''), '{UNNAMED}') END"


ROTATE_SQL = f"""
    WITH t AS (
        SELECT conv_id, turn, {_name_sql("role")} AS speaker,
               replace(coalesce(text, ''), '{MARK}', '{BROKEN_MARK}') AS words FROM conversations),
    c AS (SELECT DISTINCT conv_id, speaker AS perspective FROM t WHERE speaker <> '{SYSTEM}'),
    r AS (
        SELECT t.conv_id, perspective, turn, speaker, words,
               CASE WHEN speaker = '{SYSTEM}' THEN '{SYSTEM}' WHEN speaker = perspective THEN 'assistant' ELSE 'user' END AS role
        FROM t JOIN c ON t.conv_id IS NOT DISTINCT FROM c.conv_id),
    h AS (SELECT *, '{OPEN}' || role || CASE role WHEN 'user' THEN ' name=' || speaker ELSE '' END || chr(10) AS head FROM r),
    s AS (SELECT *, head || words || '{CLOSE}' || chr(10) AS segment FROM h),
    o AS (
        SELECT *, row_number() OVER w - 1 AS position, (sum(length(segment)) OVER w)::BIGINT - length(segment) AS start
        FROM s WINDOW w AS (PARTITION BY conv_id, perspective ORDER BY turn NULLS FIRST, speaker, md5(words)
                            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
    SELECT conv_id, perspective, position, turn, speaker, role, segment, start,
           CASE role WHEN 'assistant' THEN start + length(head) END AS mask_start,
           CASE role WHEN 'assistant' THEN start + length(head) + length(words) + {len(CLOSE)} END AS mask_end
    FROM o
"""
