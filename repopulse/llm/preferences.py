"""Preference pairs for chat models, with DataFrame functions only.

The turns of the chosen and the rejected conversation are gathered by pair in one
shuffle. The longest common prefix of their turns is rendered once as the prompt; the
turns that follow are the two completions, each with the spans of characters that a loss
should see: what the assistant says.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ASSISTANT = "assistant"
OPEN, ROLE_END, CLOSE = "<|", "|>\n", "<|end|>\n"
SPANS = "array<struct<start:int,stop:int>>"


def _head(turn: Column) -> Column:
    return F.concat(F.lit(OPEN), turn["role"], F.lit(ROLE_END))


def render(turns: Column) -> Column:
    """All turns as one text; empty for none."""
    return F.array_join(F.transform(turns, lambda t: F.concat(_head(t), t["text"], F.lit(CLOSE))), "")


def common_prefix(one: Column, other: Column) -> Column:
    """Number of leading turns with equal role and text."""
    same = F.transform(F.arrays_zip(one.alias("a"), other.alias("b")), lambda z: z["a"].eqNullSafe(z["b"]))
    first = F.array_position(same, False)
    return F.when(first > 0, first - 1).otherwise(F.size(one)).cast("int")


def loss_spans(turns: Column) -> Column:
    """Spans of the rendered turns that the assistant says, with the mark that ends them.

    Character positions from 0, the stop excluded.
    """

    def add(so_far: Column, turn: Column) -> Column:
        start = so_far["at"] + F.char_length(_head(turn))
        stop = start + F.char_length(turn["text"]) + len(CLOSE)
        span = F.array(F.struct(start.alias("start"), stop.alias("stop")))
        spans = F.when(turn["role"] == ASSISTANT, F.concat(so_far["spans"], span)).otherwise(so_far["spans"])
        return F.struct(stop.alias("at"), spans.alias("spans"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast(SPANS).alias("spans"))
    return F.aggregate(turns, start, add, lambda done: done["spans"])


def format_preferences(
    chosen: DataFrame,
    rejected: DataFrame,
    pair_id: str = "pair_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """A row for each pair: ``prompt``, ``chosen``, ``rejected``, spans and turn counts.

    Both tables have a row for each turn. ``prompt`` renders the longest common prefix
    of turns (equal role and text), ``chosen`` and ``rejected`` what follows it;
    ``chosen_spans`` and ``rejected_spans`` are arrays of (start, stop) in them.

    Turns are ordered by number (null first), then role and text; a repeated row is one
    more turn. A null role is an empty one, a null text an empty one. Rows with a null
    pair are left out. A pair that only one table has gets an empty other completion,
    and so do equal conversations, which are all prompt. Empty tables give an empty one.
    Other columns aren't read, so their names can't clash.

    One shuffle by pair. A row of the result holds a conversation, so a conversation has
    to fit in memory; the number of pairs doesn't matter, and like texts are no hot key.
    """

    def side(df: DataFrame, is_chosen: bool) -> DataFrame:
        said = [F.coalesce(F.col(name).cast("string"), F.lit("")).alias(kind) for name, kind in ((role, "role"), (text, "text"))]
        one = F.struct(F.col(turn).cast("long").alias("turn"), *said)
        return df.select(F.col(pair_id).alias("pair_id"), F.lit(is_chosen).alias("is_chosen"), one.alias("one"))

    def gathered(wanted: Column) -> Column:
        turns = F.sort_array(F.collect_list(F.when(wanted, F.col("one"))))
        return F.transform(turns, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))

    both = side(chosen, True).unionByName(side(rejected, False)).where("pair_id is not null")
    pairs = both.groupBy("pair_id").agg(
        gathered(F.col("is_chosen")).alias("c"), gathered(~F.col("is_chosen")).alias("r")
    )
    pairs = pairs.withColumn("n_prompt_turns", common_prefix(F.col("c"), F.col("r")))

    def rest(name: str) -> Column:
        return F.slice(name, F.col("n_prompt_turns") + 1, F.size(name))

    pairs = pairs.select(
        "pair_id",
        "n_prompt_turns",
        F.slice("c", F.lit(1), F.col("n_prompt_turns")).alias("p"),
        rest("c").alias("c"),
        rest("r").alias("r"),
    )
    return pairs.select(
        "pair_id",
        "n_prompt_turns",
        F.size("c").alias("n_chosen_turns"),
        F.size("r").alias("n_rejected_turns"),
        render(F.col("p")).alias("prompt"),
        render(F.col("c")).alias("chosen"),
        render(F.col("r")).alias("rejected"),
        loss_spans(F.col("c")).alias("chosen_spans"),
        loss_spans(F.col("r")).alias("rejected_spans"),
    )
