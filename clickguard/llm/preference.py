"""Preference formatting: a chosen and a rejected conversation as one prompt and
two completions with loss masks.

The prompt is the longest run of leading turns that both have (same role and
text, position by position). It is rendered once; what follows on either side
is that side's completion, in which only the assistant's own words count for
the loss.

The result is long: one row per rendered turn, so neither a conversation nor a
popular one's copies ever meet in one row or task. Turns are matched by
(pair, turn, rank among rows that share both), keys that spread a conversation
over all tasks, in one exchange of both sides; the first difference is a map-side
combined minimum per pair, joined back to turns (the side of one row per pair is
the small one, and adaptive execution splits a pair with very many turns).
`assembled` joins the rows of a pair into texts for those who want them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickguard.llm.common import stored

PROMPT, CHOSEN, REJECTED = "prompt", "chosen", "rejected"
_LAST = (1 << 63) - 1


def _rendered() -> tuple[F.Column, F.Column, F.Column]:
    """(text, first, length) of a turn as it is rendered: its own words are
    `length` characters from `first`."""
    head = F.concat(F.lit("<|"), F.coalesce("role", F.lit("")), F.lit("|>\n"))
    body = F.coalesce("text", F.lit(""))
    return F.concat(head, body, F.lit("<|end|>\n")), F.length(head), F.length(body)


def _turns(turns: DataFrame, pair: str, side: int) -> DataFrame:
    """(pair, turn, role, text, side); a null turn comes last."""
    return turns.select(F.col(pair).alias("pair"), F.coalesce(F.col("turn").cast("long"), F.lit(_LAST))
                        .alias("turn"), F.col("role").cast("string").alias("role"),
                        F.col("text").cast("string").alias("text"), F.lit(side).alias("side"))


def _positions(chosen: DataFrame, rejected: DataFrame, pair: str) -> DataFrame:
    """(pair, turn, n, one, two) per position: what either side has there, null
    where it has nothing; n numbers the rows of a turn by role and text."""
    sides = _turns(chosen, pair, 1).unionByName(_turns(rejected, pair, 2))
    place = Window.partitionBy("pair", "turn", "side").orderBy("role", "text")
    # clustered by pair and turn, which serves the numbering and the grouping
    rows = sides.repartition("pair", "turn").withColumn("n", F.row_number().over(place))
    of = [F.max(F.when(F.col("side") == s, F.struct("role", "text"))).alias(c) for s, c in ((1, "one"), (2, "two"))]
    return rows.groupBy("pair", "turn", "n").agg(*of)


def format_preferences(chosen: DataFrame, rejected: DataFrame, pair: str = "pair_id",
                       assistant: str = "assistant") -> DataFrame:
    """(`pair`, part, turn, n, role, rendered, loss_start, loss_length) from the
    turns (`pair`, turn, role, text) of either side.

    part is prompt, chosen or rejected. loss_start and loss_length say which
    characters of `rendered` count (length 0: none, as in all of the prompt).
    A pair that one side lacks has no prompt, and that side no completion; two
    equal conversations are all prompt. Null roles and texts are compared as
    values and rendered empty; turns order by number, nulls last, rows that share
    a number by role and text; rows repeated in full are turns of their own. A null
    pair is a pair; empty tables give an empty result; other columns are not
    read.
    """
    rows = _positions(chosen, rejected, pair)
    first = (rows.where(~F.col("one").eqNullSafe(F.col("two"))).groupBy("pair")
             .agg(F.min(F.struct("turn", "n")).alias("first")).withColumnRenamed("pair", "pair1"))
    marked = rows.join(first, F.col("pair").eqNullSafe(F.col("pair1")), "left")
    shared = F.col("first").isNull() | (F.struct("turn", "n") < F.col("first"))
    sides = F.when(shared, F.array(F.struct(F.lit(PROMPT).alias("part"), F.col("one").alias("said")))).otherwise(
        F.array(F.struct(F.lit(CHOSEN).alias("part"), F.col("one").alias("said")),
                F.struct(F.lit(REJECTED).alias("part"), F.col("two").alias("said"))))
    parts = (marked.select("pair", "turn", "n", F.explode(sides).alias("s")).where("s.said IS NOT NULL")
             .select("pair", "turn", "n", "s.part", "s.said.role", "s.said.text"))
    text, start, length = _rendered()
    counts = (F.col("part") != PROMPT) & (F.coalesce("role", F.lit("")) == assistant)
    return parts.select(F.col("pair").alias(pair), "part", "turn", "n", "role",
                        text.alias("rendered"), start.alias("loss_start"),
                        F.when(counts, length).otherwise(0).alias("loss_length"))


def assembled(parts: DataFrame, pair: str = "pair_id") -> DataFrame:
    """One row per pair: prompt, chosen and rejected as texts, and of both
    completions the spans (start, length) that count for the loss. For pairs whose
    texts fit a row."""
    def of(part, what):
        return F.expr(f"transform(array_sort(filter(rows, r -> r.part = '{part}')), r -> r.{what})")

    rows = parts.groupBy(pair).agg(F.collect_list(
        F.struct("part", "turn", "n", "rendered", "loss_start", "loss_length")).alias("rows"))

    def mask(part):
        # running offsets of the rendered turns
        state = F.aggregate(
            F.expr(f"array_sort(filter(rows, r -> r.part = '{part}'))"),
            F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<struct<start:int,length:int>>)").alias("spans")),
            lambda s, r: F.struct(
                (s["at"] + F.length(r["rendered"])).alias("at"),
                F.when(r["loss_length"] > 0, F.concat(s["spans"], F.array(F.struct(
                    (s["at"] + r["loss_start"]).alias("start"), r["loss_length"].alias("length")))))
                .otherwise(s["spans"]).alias("spans")))
        return state["spans"]

    return rows.select(pair, *[F.array_join(of(p, "rendered"), "").alias(p) for p in (PROMPT, CHOSEN, REJECTED)],
                       mask(CHOSEN).alias("chosen_mask"), mask(REJECTED).alias("rejected_mask"))


def last_reply_pairs(turns: DataFrame, conv: str = "conv_id", assistant: str = "assistant"):
    """(chosen, rejected) from plain conversations: the chosen side is the
    conversation, the rejected one repeats the reply before in place of the last
    (an empty reply where there is none before). Every row of `turns` is on both
    sides. Replies of one turn number are all the last, or the one before, whose
    smallest text is taken; replies without a turn number are neither. A
    conversation without a reply has equal sides, so it is all prompt. A null
    conversation is one like others, an empty table gives empty sides, other
    columns are not read. The pairs are written once and read for either side."""
    rows = turns.select(F.col(conv).alias("pair_id"), F.col("turn"), F.col("role"), F.col("text"))
    replies = (rows.where((F.col("role") == assistant) & F.col("turn").isNotNull())
               .groupBy("pair_id", "turn").agg(F.min("text").alias("text")))
    latest = Window.partitionBy("pair_id").orderBy(F.desc("turn"))
    two = replies.withColumn("place", F.row_number().over(latest)).where("place <= 2")
    ends = (two.groupBy(F.col("pair_id").alias("p"))
            .agg(F.max("turn").alias("last"), F.max(F.when(F.col("place") == 2, F.col("text"))).alias("prior")))
    swap = (F.col("role") == assistant) & (F.col("turn") == F.col("last"))
    other = F.when(swap, F.coalesce("prior", F.lit(""))).otherwise(F.col("text"))
    both = stored(rows.join(ends, F.col("pair_id").eqNullSafe(F.col("p")), "left")
                  .select("pair_id", "turn", "role", "text", other.alias("other")), "preference-pairs")
    chosen = both.select("pair_id", "turn", "role", "text")
    return chosen, both.select("pair_id", "turn", "role", F.col("other").alias("text"))
