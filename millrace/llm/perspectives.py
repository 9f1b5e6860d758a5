"""Multi-party chat formatting: a dialogue once for every participant, seen as the assistant.

For each speaker of a conversation the dialogue is rendered with that speaker's turns as the
assistant's, all others as named users, and the spans to learn from: the speaker's texts and
their end marks. System turns belong to nobody and stand in every rendering. Markers inside
texts and names are broken up, so a text cannot pose as a turn.

A conversation of more than `PART_TURNS` turns is rendered in parts, a row each, that follow
on each other: their texts joined are the whole rendering. So that a later part can be read
alone, its `opening` is the system turn last before it, to be put before the text and never
learned from; it is empty for a first part, a part that begins with a system turn, and where
no system turn came before. The turns are numbered by an operator that cuts hot keys, and the
rows meet by (conversation, part). So a conversation with a third of all rows is no single
task, and a usual one is one row per speaker.

Turns go by turn, role, text; nulls first, ties in that order, repeated rows are repeated
turns. A null role is the speaker 'unknown', a null text is empty, a null conv_id is one
conversation. A conversation of system turns only, or an empty table, gives no rows; further
columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.frames import written
from millrace.llm.pii import let, running_sums
from millrace.operators.ordered import last_value, row_number, running

PART_TURNS = 256
SYSTEM = "system"
SYSTEM_HEAD = "<|system|>\n"
END = "<|end|>\n"


def _safe(text: Column, null: str) -> Column:
    return F.replace(F.coalesce(text, F.lit(null)), F.lit("<|"), F.lit("< |"))


def perspectives(turns: DataFrame, part_turns: int = PART_TURNS) -> DataFrame:
    """conv_id, perspective, part, n_turns, text, mask (start:end by code point, joined by commas), mask_chars, opening."""
    clean = turns.select("conv_id", "turn", _safe(F.col("role"), "unknown").alias("role"), _safe(F.col("text"), "").alias("text"))
    order = ["turn", "role", "text"]
    ruled = clean.withColumn("rule", F.when(F.col("role") == SYSTEM, F.col("text")))
    nth = running(ruled, ["conv_id"], order, {"nth": row_number(), "in_force": last_value("rule", order)})
    opens = (F.col("nth") > 1) & ((F.col("nth") - 1) % part_turns == 0) & (F.col("role") != SYSTEM)
    opening = F.when(opens, F.concat(F.lit(SYSTEM_HEAD), "in_force", F.lit(END)))
    nth = written(nth.select("conv_id", "nth", "role", "text", opening.alias("opening"),
                             F.floor((F.col("nth") - 1) / part_turns).alias("part")), "turns")
    speakers = nth.where(F.col("role") != SYSTEM).select("conv_id", "role").distinct().alias("s")
    parts = nth.select("conv_id", "part").distinct().alias("p")
    seats = (parts.join(speakers, F.col("p.conv_id").eqNullSafe(F.col("s.conv_id")))
             .select("p.conv_id", "p.part", F.col("s.role").alias("perspective"))).alias("v")
    here = F.col("t.conv_id").eqNullSafe(F.col("v.conv_id")) & (F.col("t.part") == F.col("v.part"))
    own = F.col("role") == F.col("perspective")
    head = (F.when(F.col("role") == SYSTEM, SYSTEM_HEAD).when(own, "<|assistant|>\n")
            .otherwise(F.concat(F.lit("<|user name="), "role", F.lit("|>\n"))))
    seen = (nth.alias("t").join(seats, here)
            .select("v.*", "opening", F.struct("nth", head.alias("head"), F.concat("text", F.lit(END)).alias("body"), own.alias("own")).alias("turn"))
            .groupBy("conv_id", "perspective", "part").agg(F.sort_array(F.collect_list("turn")).alias("turns"), F.coalesce(F.max("opening"), F.lit("")).alias("opening")))
    lengths = F.transform("turns", lambda t: (F.length(t["head"]) + F.length(t["body"])).cast("bigint"))
    spans = let(running_sums(lengths), lambda ends: F.filter(F.transform("turns", lambda t, i: F.struct(
        t["own"].alias("own"), (ends[i] - F.length(t["body"])).alias("start"), ends[i].alias("end"))), lambda s: s["own"]))
    return (seen.withColumn("spans", spans)
            .select("conv_id", "perspective", "part", F.size("turns").cast("bigint").alias("n_turns"),
                    F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["body"])), "").alias("text"),
                    F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["start"], s["end"])), ",").alias("mask"),
                    F.aggregate("spans", F.lit(0).cast("bigint"), lambda a, s: a + s["end"] - s["start"]).alias("mask_chars"),
                    "opening"))


SQL = f"""
    WITH c AS (SELECT conv_id, turn, replace(coalesce(role, 'unknown'), '<|', '< |') AS role,
                 replace(coalesce(text, ''), '<|', '< |') AS text FROM conversations),
    r AS (SELECT *, row_number() OVER w AS nth, last_value(CASE WHEN role = '{SYSTEM}' THEN text END IGNORE NULLS) OVER w AS in_force
          FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text ROWS UNBOUNDED PRECEDING)),
    n AS (SELECT *, CASE WHEN nth > 1 AND (nth - 1) % {PART_TURNS} = 0 AND role <> '{SYSTEM}' AND in_force IS NOT NULL
                         THEN '<|system|>' || chr(10) || in_force || '<|end|>' || chr(10) END AS opening FROM r),
    s AS (SELECT DISTINCT conv_id, role AS perspective FROM n WHERE role <> '{SYSTEM}'),
    p AS (SELECT n.conv_id, perspective, (nth - 1) // {PART_TURNS} AS part, nth, role = perspective AS own,
            CASE WHEN role = '{SYSTEM}' THEN '<|system|>' || chr(10) WHEN role = perspective THEN '<|assistant|>' || chr(10)
                 ELSE '<|user name=' || role || '|>' || chr(10) END AS head, text || '<|end|>' || chr(10) AS body, opening
          FROM n JOIN s ON n.conv_id IS NOT DISTINCT FROM s.conv_id),
    e AS (SELECT *, CAST(sum(length(head) + length(body)) OVER (PARTITION BY conv_id, perspective, part ORDER BY nth) AS BIGINT) AS e FROM p)
    SELECT conv_id, perspective, part, count(*) AS n_turns, string_agg(head || body, '' ORDER BY nth) AS text,
      coalesce(string_agg((e - length(body))::VARCHAR || ':' || e::VARCHAR, ',' ORDER BY nth) FILTER (own), '') AS mask,
      CAST(coalesce(sum(length(body)) FILTER (own), 0) AS BIGINT) AS mask_chars,
      coalesce(max(opening), '') AS opening
    FROM e GROUP BY conv_id, perspective, part"""
