"""Preference pairs with a shared prompt, in built-in functions only.

Conversations with the same request, or for preference_pairs with the same first turn, answer the same:
the one with the longest assistant turns is chosen, each other one is rejected. A conversation that is alone with its request is chosen
against itself with its last answer replaced by the next conversation's (the next different one in request_pairs). The longest common prefix of
the two turn lists is rendered once as the prompt, and what follows in each is rendered as a completion
with the stretches that a loss is taken over: the assistant's turns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written
from .ordering import in_ranges, order_in_range

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def _head(turn: Column) -> Column:
    return F.concat(F.lit(OPEN), turn["role"], F.lit("\n"))


def _body(turn: Column) -> Column:
    return F.concat(turn["text"], F.lit(CLOSE + "\n"))


def render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(_head(t), _body(t))), "")


def loss_mask(turns: Column) -> Column:
    """[begin, end) in code points of the rendered turns, for the assistant's texts with their end marks."""
    start = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<struct<begin:int,end:int>>)").alias("spans"))

    def step(state: Column, turn: Column) -> Column:
        begin = state["at"] + F.length(_head(turn))
        end = begin + F.length(_body(turn))
        own = F.array(F.struct(begin.cast("int").alias("begin"), (end - 1).cast("int").alias("end")))
        spans = F.when(turn["role"] == "assistant", F.concat(state["spans"], own)).otherwise(state["spans"])
        return F.struct(end.cast("int").alias("at"), spans.alias("spans"))

    return F.aggregate(turns, start, step, lambda state: state["spans"])


def conversations_of(turns: DataFrame) -> DataFrame:
    """conv_id, turns (role, text) in order; one row per conversation."""
    row = F.struct(
        "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    ordered = F.sort_array(F.collect_list(row))
    plain = F.transform(ordered, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    return turns.filter("conv_id is not null").groupBy("conv_id").agg(plain.alias("turns"))


def format_pairs(pairs: DataFrame) -> DataFrame:
    """Pairs (chosen_id, rejected_id, chosen, rejected: turns) with their common prefix rendered once."""
    c, r = F.col("chosen"), F.col("rejected")
    differs = F.expr("filter(sequence(1, least(size(chosen), size(rejected))), i -> chosen[i - 1] <> rejected[i - 1])")
    shorter = F.least(F.size(c), F.size(r))
    common = F.when(shorter == 0, 0).when(F.size(differs) > 0, F.array_min(differs) - 1).otherwise(shorter)

    def rest(turns: Column) -> Column:
        return F.slice(turns, F.col("n_common") + 1, F.greatest(F.size(turns), F.lit(1)))

    return pairs.withColumn("n_common", common).select(
        "chosen_id",
        "rejected_id",
        F.col("n_common").cast("long").alias("n_common"),
        render(F.slice(c, F.lit(1), F.col("n_common"))).alias("prompt"),
        render(rest(c)).alias("chosen"),
        render(rest(r)).alias("rejected"),
        loss_mask(rest(c)).alias("chosen_mask"),
        loss_mask(rest(r)).alias("rejected_mask"),
    )


ANSWERS = "filter(turns, t -> t.role = 'assistant')"


def _weight() -> Column:
    """Characters of the assistant's turns."""
    return F.aggregate(F.expr(ANSWERS), F.lit(0).cast("long"), lambda n, t: n + F.length(t["text"]))


def _next(answered: DataFrame) -> DataFrame:
    """conv_id and other (conv_id, answer) of the next row by conv_id, if its answer differs."""
    rows = in_ranges(answered, "conv_id", "tie")
    other = F.lead(F.struct("conv_id", "answer")).over(order_in_range("conv_id", "tie"))
    return rows.withColumn("other", other).filter("not copy and answer <> other.answer").select("conv_id", "other")


def _next_different(answered: DataFrame) -> DataFrame:
    """conv_id and other (conv_id, answer) of the next row by conv_id that has a different answer; the last row is followed by the first.

    Rows with equal answers that follow one another are a run; the row after its end is what all of them
    look for. The end may lie in a later range: of each range only the number of its first end is collected, and
    the ends that other ranges look for are joined back.
    """
    rows = in_ranges(answered, "conv_id", "tie")
    after = F.lead(F.struct("conv_id", "answer")).over(order_in_range("conv_id", "tie"))
    rows = rows.withColumn("after", after).filter("not copy").select("conv_id", "range", F.expr("if(answer <> after.answer, after, null)").alias("after"))
    rows = written(rows, "answers")
    ends = rows.groupBy("range").agg(F.min(F.when(F.col("after").isNotNull(), F.col("conv_id"))).alias("end"))
    found = sorted((row["range"], row["end"]) for row in ends.collect())  # a row per range
    looked_for, later = [], next((end for _, end in found if end is not None), None)
    for number, end in reversed(found):
        looked_for.append((number, later))
        later = later if end is None else end
    wanted = rows.sparkSession.createDataFrame(looked_for, "range int, end long")
    carried = F.broadcast(wanted).join(rows.select(F.col("conv_id").alias("end"), F.col("after").alias("carried")), "end")
    # From the last row back, so that the frame only grows.
    back = Window.partitionBy("range").orderBy(F.desc("conv_id")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    here = rows.withColumn("here", F.last("after", ignorenulls=True).over(back))
    found = here.join(carried.select("range", "carried"), "range", "left")
    return found.select("conv_id", F.coalesce("here", "carried").alias("other")).filter("other is not null")


def _swapped(alone: DataFrame, following: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """chosen_id, rejected_id, chosen, rejected: against the same turns with a following conversation's last answer."""
    answered = alone.withColumn("answers", F.expr(ANSWERS)).filter("size(answers) > 0")
    answered = answered.select("conv_id", F.element_at("answers", -1).alias("answer"), F.lit(0).cast("long").alias("tie"))
    paired = alone.join(following(answered), "conv_id")
    last = F.array_max(F.expr("filter(sequence(1, size(turns)), i -> turns[i - 1].role = 'assistant')"))
    return paired.select(
        F.col("conv_id").alias("chosen_id"),
        F.col("other.conv_id").alias("rejected_id"),
        F.col("turns").alias("chosen"),
        F.concat(F.slice("turns", F.lit(1), last - 1), F.array("other.answer")).alias("rejected"),
    )


def _formatted(whole: DataFrame, several: DataFrame, swapped: DataFrame) -> DataFrame:
    """The pairs of several (chosen_id, rejected_id), and those of conversations that are alone with their request."""
    several = several.join(whole.select(F.col("conv_id").alias("chosen_id"), F.col("turns").alias("chosen")), "chosen_id").join(
        whole.select(F.col("conv_id").alias("rejected_id"), F.col("turns").alias("rejected")), "rejected_id"
    )
    return format_pairs(several.select("chosen_id", "rejected_id", "chosen", "rejected").unionByName(swapped))


def preference_pairs(turns: DataFrame) -> DataFrame:
    """chosen_id, rejected_id, n_common, prompt, chosen, rejected, chosen_mask, rejected_mask.

    turns has conv_id (long), turn, role and text. Turns are ordered by turn, role and text; a null role
    or text counts as empty, a null turn comes first, repeated rows are repeated turns, and rows without
    a conv_id belong to no conversation. Equal conversations count once, as the smallest conv_id.

    Of several conversations with one first turn, chosen is the one with the most assistant characters,
    then the smallest conv_id, and there is one row for each other one. A conversation that is the
    only one with its first turn makes a row if it has an answer (an assistant turn) that differs from
    the last answer of the next such conversation (by conv_id; the last is followed by the first);
    rejected_id is then that conversation. n_common is the number of leading turns that both share; a
    side that ends there has an empty completion. Other columns are ignored.

    Groups are never gathered: the chosen conversation is found by an aggregate and joined back.
    """
    whole = conversations_of(turns.withColumn("conv_id", F.col("conv_id").cast("long")))
    sized = whole.select(
        "conv_id",
        F.sha2(F.to_json(F.col("turns")), 256).alias("digest"),
        F.sha2(F.to_json(F.slice("turns", 1, 1)), 256).alias("request"),
        _weight().alias("weight"),
    )
    kept = sized.groupBy("request", "digest").agg(F.min("conv_id").alias("conv_id"), F.first("weight").alias("weight"))
    groups = kept.groupBy("request").agg(
        F.max(F.struct("weight", (-F.col("conv_id")).alias("last"))).alias("best"), F.count("*").alias("n")
    )
    groups = groups.select("request", (-F.col("best.last")).alias("chosen_id"), "n")
    placed = kept.join(groups, "request")
    several = placed.filter("n > 1 and conv_id <> chosen_id").select("chosen_id", F.col("conv_id").alias("rejected_id"))
    alone = whole.join(placed.filter("n = 1").select("conv_id"), "conv_id")
    return _formatted(whole, several, _swapped(alone, _next))


def _prefixes(conversations: DataFrame) -> DataFrame:
    """conv_id, weight, n_turns, prefix: a row for every request, that is, turns that an answer follows or that end there.

    A request has a turn that is neither the system's nor the assistant's. prefix is a running hash.
    """
    empty = F.expr("cast(array() as array<struct<n_turns:int,prefix:string>>)")
    start = F.struct(F.lit("").alias("hash"), F.lit(0).alias("n"), F.lit(False).alias("asked"), empty.alias("found"))

    def step(state: Column, turn: Column) -> Column:
        own = F.array(F.struct(state["n"].alias("n_turns"), state["hash"].alias("prefix")))
        ends = state["asked"] & (turn["role"] == "assistant")
        return F.struct(
            F.sha2(F.concat(state["hash"], F.to_json(F.struct(turn["role"], turn["text"]))), 256).alias("hash"),
            (state["n"] + 1).alias("n"),
            (state["asked"] | ~turn["role"].isin("system", "assistant")).alias("asked"),
            F.when(ends, F.concat(state["found"], own)).otherwise(state["found"]).alias("found"),
        )

    def finish(state: Column) -> Column:
        own = F.array(F.struct(state["n"].alias("n_turns"), state["hash"].alias("prefix")))
        return F.when(state["asked"], F.concat(state["found"], own)).otherwise(state["found"])

    found = conversations.select("conv_id", "weight", F.explode(F.aggregate("turns", start, step, finish)).alias("found"))
    return found.select("conv_id", "weight", "found.n_turns", "found.prefix")


def request_pairs(turns: DataFrame) -> DataFrame:
    """The columns of preference_pairs, for conversations that share a request, however many turns it has.

    turns is read, and equal conversations count once, as in preference_pairs. A request is the leading
    turns before an assistant's turn, or all turns, if one of them is neither the system's nor the
    assistant's; so a shared system prompt alone makes no pair. Of the conversations that begin with one
    request, the best has the most assistant characters, then the smallest conv_id. Each conversation is
    rejected once, against the best of the longest request of which it is not the best itself.

    A conversation that shares no request makes a row if it has an answer: rejected are its own turns with
    its last answer replaced by that of the next such conversation that has a different one (by conv_id;
    the last is followed by the first). Only where all have one and the same answer there is none.
    """
    whole = conversations_of(turns.withColumn("conv_id", F.col("conv_id").cast("long")))
    # What is used several times is written once: the conversations, and ids with weights of those that count.
    whole = written(whole.withColumns({"digest": F.sha2(F.to_json(F.col("turns")), 256), "weight": _weight()}), "conversations")
    firsts = whole.groupBy("digest").agg(F.min("conv_id").alias("conv_id")).select("conv_id")
    prefixes = written(_prefixes(whole.join(firsts, "conv_id", "left_semi")), "requests")
    best = F.max(F.struct("weight", (-F.col("conv_id")).alias("last"))).alias("best")
    groups = prefixes.groupBy("prefix").agg(best, F.count("*").alias("n")).filter("n > 1")
    placed = prefixes.join(groups.select("prefix", (-F.col("best.last")).alias("chosen_id")), "prefix")
    longest = F.max(F.when(F.col("conv_id") != F.col("chosen_id"), F.struct("n_turns", "chosen_id"))).alias("longest")
    shared = written(placed.groupBy("conv_id").agg(longest).select("conv_id", "longest.chosen_id"), "shared")
    several = shared.filter("chosen_id is not null").select("chosen_id", F.col("conv_id").alias("rejected_id"))
    alone = whole.join(firsts, "conv_id", "left_semi").join(shared.select("conv_id"), "conv_id", "left_anti")
    return _formatted(whole.select("conv_id", "turns"), several, _swapped(alone.select("conv_id", "turns"), _next_different))
