"""Preference formatting of conversation pairs (operator 2).

For a chosen and a rejected conversation, the longest common prefix of turns is
rendered once as the prompt; what follows in either one is rendered as its
completion, with a mask: the character spans (start:end, end exclusive,
comma-joined) of the completion on which a model is trained, that is, the
assistant turns' text and closing line. Everything is DataFrame functions.

``pairs_by_opening`` pairs conversations that begin with the same turn, in the
order of their ids; in a pair the conversation with more assistant characters
is the chosen one (ties: the smaller id). What is left over has no rejected
conversation: its row has an empty prompt and rejected side.

Defined results: turns are ordered by (turn, role, text), exact copies of a row
count once; a NULL role or text is empty; a NULL conv_id is a conversation of
its own; conversations that are equal share all turns and have empty
completions; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxstar.llm.common import land, prepare
from boxstar.operators.ordered import prefix_before

ASSISTANT = "assistant"


def conversation_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns): each conversation's turns (role, text) in order."""
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    packed = rows.groupBy("conv_id").agg(F.sort_array(F.collect_set(F.struct("turn", "role", "text"))).alias("t"))
    return packed.select("conv_id", F.transform("t", lambda x: F.struct(x.role.alias("role"), x.text.alias("text"))).alias("turns"))


def one_of_each(turns: DataFrame) -> DataFrame:
    """Conversations with equal turns as one row: the smallest conv_id (NULL only where no
    copy has an id), the turns, and copies, their number."""
    return turns.groupBy("turns").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("copies")).select("conv_id", "turns", "copies")


def copies_of_each(turns: DataFrame) -> DataFrame:
    """(conv_id, class_id): the conversation that stands for each one in ``one_of_each``."""
    ids = turns.select("conv_id", F.sha2(F.to_json("turns"), 256).alias("said"))
    return ids.join(ids.groupBy("said").agg(F.min("conv_id").alias("class_id")), "said").select("conv_id", "class_id")


def pairs_by_opening(turns: DataFrame) -> DataFrame:
    """(chosen_id, rejected_id) of conversations with equal first turns; a left-over
    conversation comes with a NULL rejected_id."""
    spoken = F.aggregate(
        F.filter("turns", lambda t: t.role == ASSISTANT), F.lit(0).cast("long"), lambda a, t: a + F.length(t.text)
    )
    heads = turns.select(
        "conv_id",
        F.sha2(F.concat_ws("\x1f", F.element_at("turns", 1).role, F.element_at("turns", 1).text), 256).alias("opening"),
        spoken.alias("spoken"),
    )
    # ranked over balanced ranges of (opening, id): a hot opening takes many tasks, whatever its ids
    ranked = prefix_before(heads, ["opening"], [F.col("conv_id").asc_nulls_first()], {"at": F.lit(1)})
    one = F.struct(F.col("spoken"), (-F.coalesce("conv_id", F.lit(-1))).alias("low"), F.col("conv_id"))
    grouped = ranked.groupBy("opening", F.floor(F.col("at") / 2).alias("pair")).agg(
        F.sort_array(F.collect_list(one), asc=False).alias("two")
    )
    return grouped.select(
        F.element_at("two", 1).conv_id.alias("chosen_id"),
        F.when(F.size("two") > 1, F.get("two", F.lit(1)).conv_id).alias("rejected_id"),
        (F.size("two") > 1).alias("paired"),
    )


def rendered_turn(turn: Column) -> Column:
    return F.concat(F.lit("<|"), turn.role, F.lit("|>\n"), turn.text, F.lit("\n"))


def rendered(turns: Column) -> Column:
    return F.array_join(F.transform(turns, rendered_turn), "")


def mask(turns: Column) -> Column:
    """Spans of the assistant turns' text and closing line in the rendered turns."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("spans"))

    def step(acc: Column, t: Column) -> Column:
        head = acc["at"] + F.length(t.role) + 5
        end = head + F.length(t.text) + 1
        span = F.concat(head.cast("string"), F.lit(":"), end.cast("string"))
        spans = F.when(t.role == ASSISTANT, F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"])
        return F.struct(end.alias("at"), spans.alias("spans"))

    return F.aggregate(turns, start, step, lambda a: F.array_join(a["spans"], ","))


def format_pairs(turns: DataFrame, pairs: DataFrame) -> DataFrame:
    """One row per pair: chosen_id, rejected_id, prompt_turns, prompt, chosen,
    rejected, chosen_mask, rejected_mask."""
    c = turns.select(F.col("conv_id").alias("chosen_id"), F.col("turns").alias("c"))
    r = turns.select(F.col("conv_id").alias("rejected_id"), F.col("turns").alias("r"))
    both = pairs.alias("p").join(c.alias("c"), F.expr("p.chosen_id <=> c.chosen_id")).select("p.*", "c")
    both = both.alias("p").join(r.alias("r"), F.expr("p.paired AND p.rejected_id <=> r.rejected_id"), "left").select(
        "chosen_id", F.col("p.rejected_id").alias("rejected_id"), "c",
        F.coalesce(F.col("r.r"), F.filter("c", lambda t: F.lit(False))).alias("r"),
    )
    same = F.zip_with("c", "r", lambda x, y: x.eqNullSafe(y))
    miss = F.array_position(same, False)
    both = both.withColumn("k", F.when(miss == 0, F.size(same)).otherwise(miss - 1).cast("int"))
    both = both.withColumns(
        {
            "head": F.slice("c", 1, F.col("k")),
            "c": F.slice("c", F.col("k") + 1, F.greatest(F.size("c"), F.lit(1))),
            "r": F.slice("r", F.col("k") + 1, F.greatest(F.size("r"), F.lit(1))),
        }
    )
    return both.select(
        "chosen_id",
        "rejected_id",
        F.col("k").cast("long").alias("prompt_turns"),
        rendered(F.col("head")).alias("prompt"),
        rendered(F.col("c")).alias("chosen"),
        rendered(F.col("r")).alias("rejected"),
        mask(F.col("c")).alias("chosen_mask"),
        mask(F.col("r")).alias("rejected_mask"),
    )


def preference_pairs(conversations: DataFrame, distinct: bool = False) -> DataFrame:
    """Pairs by opening, formatted: the whole table, each conversation in one row.

    With ``distinct`` conversations with equal turns are one (``copies_of_each`` names
    its members), so that a copy is never the rejected side of its own text."""
    prepare(conversations.sparkSession)
    turns = land(conversation_turns(conversations), "turns")
    if distinct:
        turns = land(one_of_each(turns).select("conv_id", "turns"), "distinct_turns")
    return format_pairs(turns, pairs_by_opening(turns))


ORACLE_SQL = """
WITH t AS (
  SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
), n AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS pos,
         '<|' || role || '|>' || chr(10) || text || chr(10) AS shown FROM t
), head AS (
  SELECT conv_id, max(CASE WHEN pos = 1 THEN role || chr(31) || text END) AS opening,
         coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0) AS spoken
  FROM n GROUP BY conv_id
), ranked AS (
  SELECT *, (row_number() OVER (PARTITION BY opening ORDER BY conv_id) - 1) // 2 AS pair FROM head
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY opening, pair ORDER BY spoken DESC, conv_id) AS place FROM ranked
), pairs AS (
  SELECT max(CASE WHEN place = 1 THEN conv_id END) AS chosen_id, max(CASE WHEN place = 2 THEN conv_id END) AS rejected_id
  FROM placed GROUP BY opening, pair
), differ AS (
  SELECT p.chosen_id, min(c.pos) AS pos FROM pairs p JOIN n c ON c.conv_id = p.chosen_id
  LEFT JOIN n r ON r.conv_id = p.rejected_id AND r.pos = c.pos AND r.role = c.role AND r.text = c.text
  WHERE r.pos IS NULL GROUP BY p.chosen_id
), lens AS (
  SELECT p.*, coalesce(d.pos - 1, (SELECT max(pos) FROM n WHERE n.conv_id = p.chosen_id)) AS k
  FROM pairs p LEFT JOIN differ d USING (chosen_id)
), sides AS (
  SELECT l.chosen_id, l.k, 'c' AS side, n.pos, n.role, n.text, n.shown FROM lens l JOIN n ON n.conv_id = l.chosen_id
  UNION ALL
  SELECT l.chosen_id, l.k, 'r', n.pos, n.role, n.text, n.shown FROM lens l JOIN n ON n.conv_id = l.rejected_id
), spans AS (
  SELECT *, coalesce(sum(length(shown)) FILTER (pos > k) OVER (PARTITION BY chosen_id, side ORDER BY pos
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + length(role) + 5 AS a FROM sides
), parts AS (
  SELECT chosen_id, side,
         coalesce(string_agg(shown, '' ORDER BY pos) FILTER (pos <= k), '') AS prompt,
         coalesce(string_agg(shown, '' ORDER BY pos) FILTER (pos > k), '') AS rest,
         coalesce(string_agg(CAST(a AS BIGINT) || ':' || CAST(a + length(text) + 1 AS BIGINT), ',' ORDER BY pos)
                  FILTER (pos > k AND role = 'assistant'), '') AS mask
  FROM spans GROUP BY chosen_id, side
)
SELECT l.chosen_id, l.rejected_id, l.k AS prompt_turns, c.prompt, c.rest AS chosen, coalesce(r.rest, '') AS rejected,
       c.mask AS chosen_mask, coalesce(r.mask, '') AS rejected_mask
FROM lens l JOIN parts c ON c.chosen_id = l.chosen_id AND c.side = 'c'
LEFT JOIN parts r ON r.chosen_id = l.chosen_id AND r.side = 'r'
"""
