"""Chat formatting by perspective rotation: each participant in turn is the assistant of the whole dialogue."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import null_safe, ordered

OPEN, CLOSE = "<|turn|>", "<|end|>\n"


def rotate(
    turns: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    speaker: str = "role",
    text: str = "text",
    narrators: Sequence[str] = ("system",),
    segment_turns: int = 64,
) -> DataFrame:
    """One row per conversation, participant and segment of ``segment_turns`` consecutive turns.

    Participants are the speakers of a conversation but for ``narrators``. In a participant's rendering its own turns
    are headed ``assistant``, others' ``user name=<speaker>``, a narrator's ``<speaker>``. ``mask`` lists the character
    ranges ``start-end`` of the participant's words with their end mark, comma-joined: only these are trained on.
    Long dialogues come as several segments, all of them, so no group grows with the table.

    Turns stand in the order of ``turn``, then speaker, then text; nulls first; repeated rows are repeated turns.
    A null speaker is the participant ``unknown``; a null text is an empty turn; a null conversation is one
    conversation. One with narrators only gives no row. Other columns are left aside.
    """
    said = turns.select(
        F.col(conversation).alias("conv_id"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(speaker), F.lit("unknown")).alias("speaker"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    placed = ordered(said, ["conv_id"], ["turn", "speaker", "text"], "position")
    of = placed.filter(~F.col("speaker").isin(*narrators)).select(
        F.col("conv_id").alias("_conv"), F.col("speaker").alias("perspective")
    )
    views = placed.join(of.distinct(), null_safe(placed, of, [("conv_id", "_conv")])).drop("_conv")
    own = F.col("speaker") == F.col("perspective")
    head = (
        F.when(own, F.lit("assistant"))
        .when(F.col("speaker").isin(*narrators), F.col("speaker"))
        .otherwise(F.concat(F.lit("user name="), F.col("speaker")))
    )
    body = F.concat(F.col("text"), F.lit(CLOSE))
    opening = F.concat(F.lit(OPEN), head, F.lit("\n"))
    message = F.struct(
        "position",
        F.concat(opening, body).alias("shown"),
        F.when(own, F.char_length(opening)).otherwise(-1).alias("own_from"),
    )
    segment = F.floor(F.col("position") / F.lit(segment_turns)).cast("long")
    grouped = views.groupBy("conv_id", "perspective", segment.alias("segment")).agg(
        F.sort_array(F.collect_list(message)).alias("m")
    )
    ends = """aggregate(m, cast(array() as array<int>), (a, x) -> array_append(a, coalesce(try_element_at(a, -1), 0)
              + char_length(x.shown)))"""
    spans = """filter(transform(m, (x, i) -> if(x.own_from < 0, null,
               concat(ends[i] - char_length(x.shown) + x.own_from, '-', ends[i]))), x -> x is not null)"""
    return grouped.withColumn("ends", F.expr(ends)).select(
        "conv_id",
        "perspective",
        "segment",
        F.size("m").alias("n_turns"),
        F.expr("array_join(transform(m, x -> x.shown), '')").alias("text"),
        F.expr(f"array_join({spans}, ',')").alias("mask"),
    )


SQL = f"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, 'unknown') AS speaker, coalesce(text, '') AS text FROM conversations),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, speaker, text) - 1 AS position FROM said),
views AS (
  SELECT p.*, o.perspective FROM placed p JOIN (
    SELECT DISTINCT conv_id, speaker AS perspective FROM said WHERE speaker <> 'system') o
  ON p.conv_id IS NOT DISTINCT FROM o.conv_id),
shown AS (
  SELECT conv_id, perspective, position, position // 64 AS segment, speaker = perspective AS own,
    '{OPEN}' || CASE WHEN speaker = perspective THEN 'assistant' WHEN speaker = 'system' THEN speaker
      ELSE 'user name=' || speaker END || chr(10) AS opening, text || '<|end|>' || chr(10) AS body FROM views),
summed AS (
  SELECT *, sum(length(opening || body)) OVER (PARTITION BY conv_id, perspective, segment ORDER BY position) AS e FROM shown)
SELECT conv_id, perspective, segment, CAST(count(*) AS INTEGER) AS n_turns,
  string_agg(opening || body, '' ORDER BY position) AS text,
  coalesce(string_agg(CASE WHEN own THEN (e - length(body)) || '-' || e END, ',' ORDER BY position), '') AS mask
FROM summed GROUP BY ALL
"""
