"""Chat formatting by perspective rotation, with DataFrame operations only.

Every participant of a dialogue is once the assistant: their messages become assistant turns whose
text is trained on, all others' become user turns that carry the speaker's name. System messages are
the same in every rendering and are nobody's perspective.

A rendering is one text. It is kept in rows of MESSAGES_PER_PART messages, so a dialogue of any length
never has to fit in one row or one task: the rows' texts in order of ``part`` are the rendering, ``start`` is
where a row's text begins in it, and masks count from the beginning of the dialogue. Messages are
numbered by their place in the order, not by their turn numbers; where a dialogue is longer than a part,
its messages are sorted by range, so not even the dialogue that holds a third of all rows is in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .shared import cut, numbered

START, END = "<|im_start|>", "<|im_end|>"
#: Messages in a row; parts whose lengths are added up together.
MESSAGES_PER_PART, PARTS_PER_BLOCK = 256, 4096


def _header(role: Column, me: Column) -> Column:
    who = F.when(role == "system", F.lit("system")).when(role == me, F.lit("assistant")).otherwise(F.concat(F.lit("user name="), role))
    return F.concat(F.lit(START), who, F.lit("\n"))


def rotate_perspectives(conversations: DataFrame, per_part: int = MESSAGES_PER_PART) -> DataFrame:
    """``conv_id, part, perspective, n_messages, start, text, mask array<struct<start, end>>``.

    Input columns ``conv_id, turn, role, text``; others are ignored. ``mask`` has the half-open
    character spans of the whole rendering that the perspective's own words and their end mark take.
    Messages are ordered by turn, then role, then text, so ties and repeated rows have one defined
    rendering and stay. A null role is the participant ``unknown``, a null text is empty, a null turn comes
    first, all rows without conv_id are one conversation. A dialogue with no speaker but the system gives
    no row. Marks that occur inside a message are left as they are; the spans, not the marks, are authoritative.
    """
    messages = conversations.select(F.col("conv_id").alias("conv"), "turn", F.coalesce("role", F.lit("unknown")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    parts = cut(numbered(messages, per_part))
    speakers = cut(messages.filter("role <> 'system'").groupBy("conv", F.col("role").alias("perspective")).agg(F.count(F.lit(1)).alias("messages")).withColumnRenamed("conv", "of"))
    seen = parts.join(speakers, parts["conv"].eqNullSafe(speakers["of"])).select("conv", "part", "perspective", "m")

    me = F.col("perspective")
    pieces = F.transform("m", lambda x: F.struct(_header(x["role"], me).alias("head"), F.concat(x["text"], F.lit(END)).alias("body"), (x["role"] == me).alias("mine")))
    # One pass from left to right: where the next message starts, and the spans so far.
    spans = F.aggregate(
        "pieces",
        F.expr("named_struct('at', 0L, 'spans', cast(array() as array<struct<start: bigint, end: bigint>>))"),
        lambda acc, x: F.struct(
            (acc["at"] + F.char_length(x["head"]) + F.char_length(x["body"]) + 1).cast("long").alias("at"),
            F.when(
                x["mine"],
                F.concat(
                    acc["spans"],
                    F.array(
                        F.struct(
                            (acc["at"] + F.char_length(x["head"])).cast("long").alias("start"),
                            (acc["at"] + F.char_length(x["head"]) + F.char_length(x["body"])).cast("long").alias("end"),
                        )
                    ),
                ),
            )
            .otherwise(acc["spans"])
            .alias("spans"),
        ),
    )
    drawn = seen.withColumn("pieces", pieces).withColumn("drawn", spans)
    text = F.array_join(F.transform("pieces", lambda x: F.concat(x["head"], x["body"], F.lit("\n"))), "")
    drawn = drawn.select("conv", "part", "perspective", F.size("pieces").cast("long").alias("n_messages"), text.alias("text"), F.col("drawn.at").alias("size"), F.col("drawn.spans").alias("spans"))
    mask = F.transform("spans", lambda x: F.struct((x["start"] + F.col("start")).alias("start"), (x["end"] + F.col("start")).alias("end")))
    final = ["part", "perspective", "n_messages", "start", "text"]
    if parts.filter("part > 0").isEmpty():
        return drawn.withColumn("start", F.lit(0).cast("long")).select(F.col("conv").alias("conv_id"), *final, mask.alias("mask"))
    # Parts after the first begin where the parts before them end: lengths by block of parts, then inside a block.
    one, more = drawn.filter("part = 0"), cut(drawn.filter("part > 0"))
    sizes = cut(one.join(more.select(F.col("conv").alias("c"), F.col("perspective").alias("p")).distinct(), F.col("conv").eqNullSafe(F.col("c")) & (F.col("perspective") == F.col("p")), "left_semi").select("conv", "perspective", "part", "size").unionByName(more.select("conv", "perspective", "part", "size")))
    block = F.floor(F.col("part") / F.lit(PARTS_PER_BLOCK))
    key, up_to = ["conv", "perspective"], lambda w: F.coalesce(F.sum("size").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = sizes.withColumn("block", block)
    blocks = sizes.groupBy(*key, "block").agg(F.sum("size").alias("size")).select(F.col("conv").alias("c"), F.col("perspective").alias("p"), F.col("block").alias("b"), up_to(Window.partitionBy(*key).orderBy("block")).alias("far"))
    inner = sizes.withColumn("near", up_to(Window.partitionBy(*key, "block").orderBy("part")))
    starts = inner.join(blocks, inner["conv"].eqNullSafe(F.col("c")) & (F.col("perspective") == F.col("p")) & (F.col("block") == F.col("b"))).select(F.col("conv").alias("of"), F.col("perspective").alias("by"), F.col("part").alias("k"), (F.col("near") + F.col("far")).alias("start"))
    placed = more.join(starts, more["conv"].eqNullSafe(F.col("of")) & (F.col("perspective") == F.col("by")) & (F.col("part") == F.col("k")))
    out = one.withColumn("start", F.lit(0).cast("long")).unionByName(placed.select(*one.columns, F.col("start").cast("long").alias("start")))
    return out.select(F.col("conv").alias("conv_id"), *final, mask.alias("mask"))


def with_digest(rendered: DataFrame) -> DataFrame:
    """The spans as text (``start-end,...``) and how many characters they cover."""
    covered = F.aggregate("mask", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"])
    return rendered.select(
        "conv_id", "part", "perspective", "n_messages", "start", "text",
        F.array_join(F.transform("mask", lambda x: F.concat_ws("-", x["start"].cast("string"), x["end"].cast("string"))), ",").alias("mask"),
        covered.alias("trained_chars"),
    )


ORACLE = f"""
WITH n AS (SELECT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text FROM conversations),
m AS (SELECT *, (row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1) AS k FROM n),
s AS (SELECT DISTINCT conv_id, role AS perspective FROM m WHERE role <> 'system'),
r AS (SELECT m.*, k // {MESSAGES_PER_PART} AS part, perspective, role = perspective AS mine,
        '{START}' || CASE WHEN role = 'system' THEN 'system' WHEN role = perspective THEN 'assistant' ELSE 'user name=' || role END || chr(10) AS head,
        text || '{END}' AS body
      FROM m JOIN s ON m.conv_id IS NOT DISTINCT FROM s.conv_id),
o AS (SELECT *, coalesce(sum(length(head) + length(body) + 1) OVER (PARTITION BY conv_id, perspective ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS at_ FROM r)
SELECT conv_id, part, perspective, count(*) AS n_messages, min(at_)::BIGINT AS start, string_agg(head || body || chr(10), '' ORDER BY k) AS text,
       coalesce(string_agg((at_ + length(head))::BIGINT::VARCHAR || '-' || (at_ + length(head) + length(body))::BIGINT::VARCHAR, ',' ORDER BY k) FILTER (mine), '') AS mask,
       coalesce(sum(length(body)) FILTER (mine), 0)::BIGINT AS trained_chars
FROM o GROUP BY conv_id, part, perspective
"""
