"""Preference formatting: the common opening of two conversations as one prompt, and what follows as masked completions."""

from pyspark.sql import Column, DataFrame, functions as F

from tapekeeper.llm.shared import plain

# The marks around a turn, and how a mark's opening is written where it is part of a text.
OPEN, CLOSE, END = "<|", "|>\n", "<|end|>\n"
DEFUSED = "< |"

TRAINED_ROLE = "assistant"


def _head(turn: Column) -> Column:
    return F.concat(F.lit(OPEN), turn["role"], F.lit(CLOSE))


def _body(turn: Column) -> Column:
    return F.concat(turn["text"], F.lit(END))


def rendered(turns: Column) -> Column:
    """Turns as one text: each with its role's mark before and the end mark after."""
    return F.array_join(F.transform(turns, lambda t: F.concat(_head(t), _body(t))), "")


def loss_mask(turns: Column) -> Column:
    """The rendered turns as runs of characters (chars, trained): what the assistant says and its end mark are trained."""
    return F.flatten(F.transform(turns, lambda t: F.array(
        F.struct(F.length(_head(t)).alias("chars"), F.lit(False).alias("trained")),
        F.struct(F.length(_body(t)).alias("chars"), (t["role"] == TRAINED_ROLE).alias("trained")))))


def format_preferences(chosen: DataFrame, rejected: DataFrame, pair: str = "pair_id", turn: str = "turn",
                       role: str = "role", text: str = "text") -> DataFrame:
    """(pair_id, prefix_turns, prompt, chosen, chosen_mask, rejected, rejected_mask, differs), one row per pair.

    Both tables hold a row per turn. Turns are taken in the order of ``turn`` (null first; of equal
    numbers by role, then text); null roles and texts are empty. The longest run of opening turns equal in role
    and text is rendered once, as ``prompt``; the completions are the turns after it. A pair that one table lacks
    has an empty completion there; equal conversations are all prompt and ``differs`` is false. An
    opening mark inside a role or text is defused, so no text can forge a turn. Rows with a null
    pair belong to no pair and are left out: nothing gathers them. One shuffle on the pair; a row of the result is as long as its
    two conversations, which have to fit a task.
    """
    def side(rows: DataFrame, number: int) -> DataFrame:
        safe = lambda c: F.replace(F.coalesce(plain(c).cast("string"), F.lit("")), F.lit(OPEN), F.lit(DEFUSED))
        return rows.filter(plain(pair).isNotNull()).select(plain(pair).alias("pair_id"), F.lit(number).alias("side"),
                           F.struct(plain(turn).alias("turn"), safe(role).alias("role"), safe(text).alias("text")).alias("t"))

    both = side(chosen, 0).unionByName(side(rejected, 1))
    listed = lambda n: F.array_sort(F.collect_list(F.when(F.col("side") == n, F.col("t"))))
    pairs = both.groupBy("pair_id").agg(listed(0).alias("c"), listed(1).alias("r"))
    same = F.zip_with("c", "r", lambda a, b: a["role"].eqNullSafe(b["role"]) & a["text"].eqNullSafe(b["text"]))
    first = F.array_position(same, False)
    found = pairs.withColumn("prefix_turns", F.when(first > 0, first - 1).otherwise(F.size("c")).cast("int"))
    rest = lambda c: F.slice(c, F.col("prefix_turns") + 1, F.greatest(F.size(c), F.lit(0)))
    split = found.withColumns({"opening": F.slice("c", F.lit(1), F.col("prefix_turns")), "c": rest("c"), "r": rest("r")})
    return split.select(
        "pair_id", "prefix_turns", rendered(F.col("opening")).alias("prompt"),
        rendered(F.col("c")).alias("chosen"), loss_mask(F.col("c")).alias("chosen_mask"),
        rendered(F.col("r")).alias("rejected"), loss_mask(F.col("r")).alias("rejected_mask"),
        ((F.size("c") > 0) | (F.size("r") > 0)).alias("differs"))
