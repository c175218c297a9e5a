"""Chat formatting in budgeted windows.

Turns of a conversation are written with a template that marks each turn and
escapes control strings in texts. Prefix sums of turn tokens choose spans of
whole turns that fit a budget; each further window repeats the system turn and
a limited history, and the loss mask covers every assistant text once: repeated
turns are never a target again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortica.llm.common import WORD, let

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"

#: What a reader of the template, or of other common templates, could take for control, without the first character.
_TAILS = r"\|im_start\|>|\|im_end\|>|\|endoftext\|>|/?s>|/?INST\]|/?<?/?SYS>>"
_PLAIN = rf"([<\[])(\\*)({_TAILS})"
_ESCAPED = rf"([<\[])(\\*)\\({_TAILS})"

#: Tokens that the template itself adds to a turn.
TURN_TOKENS = 4


def escape(text: Column) -> Column:
    r"""A backslash goes between the first character of a control string and the rest; one that has n gets n + 1."""
    return F.regexp_replace(text, _PLAIN, r"$1$2\\$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, "$1$2$3")


def _escape_role(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def _unescape_role(role: Column) -> Column:
    parts = F.transform(F.split(unescape(role), r"\\\\"), lambda x: F.replace(x, F.lit("\\n"), F.lit("\n")))
    return F.array_join(parts, "\\")


def format_windows(rows: DataFrame, budget: int = 1024, history_budget: int = 256, history_turns: int = 4) -> DataFrame:
    """conv_id, window, formatted, repeated (turns that lead the window and were there before), loss (array of start, end).

    rows: conv_id, turn, role, text; one window or more for each conv_id, null
    too. Turns go by number (null first), then role, then text; rows with the
    same number are all kept, repeated rows too. Null roles and texts are empty.
    Tokens are counted as words plus TURN_TOKENS. A window takes whole new turns
    while they fit the budget beside what is repeated, and one at least, so a
    turn longer than the budget stands alone. Loss spans are code points of
    formatted. An empty table gives an empty one; other columns are not read.

    The prefix sums are window functions, so they are linear in a conversation's
    turns; then a conversation is one row, as its output is.
    """
    in_order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    so_far = in_order.rowsBetween(Window.unboundedPreceding, 0)
    clean = rows.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    shown_role = _escape_role(F.col("role"))
    turns = clean.select(
        "conv_id",
        F.row_number().over(in_order).alias("pos"),
        F.concat(F.lit(OPEN), shown_role, F.lit("\n"), escape(F.col("text")), F.lit(CLOSE + "\n")).alias("piece"),
        F.sum(F.regexp_count("text", F.lit(WORD)) + TURN_TOKENS).over(so_far).alias("cost_end"),
        (F.length(shown_role) + len(OPEN) + 1).alias("head"),
        (F.col("role") == "assistant").alias("target"),
        (F.col("role") == "system").alias("system"),
    )
    turns = turns.withColumn("char_end", F.sum(F.length("piece")).over(Window.partitionBy("conv_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)))
    whole = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("pos", "piece", "cost_end", "char_end", "head", "target", "system"))).alias("t"))
    first = F.get("t", F.lit(0))
    # the system turn that every later window repeats: the conversation's first, if it is one
    whole = whole.withColumn("kept", F.when(first["system"], 1).otherwise(0)).withColumn("system_cost", F.when(first["system"], first["cost_end"]).otherwise(0))

    def upto(name: str, i: Column) -> Column:
        """The prefix sum before turn i."""
        return F.coalesce(F.get("t", i - 1)[name], F.lit(0))

    def start_windows(acc: Column, i: Column) -> Column:
        over = upto("cost_end", i + 1) - acc["base"] > acc["room"]
        opened = F.struct(F.concat(acc["starts"], F.array(i)).alias("starts"), upto("cost_end", i).alias("base"), (F.lit(budget) - F.col("system_cost") - F.lit(history_budget)).cast("long").alias("room"))
        return F.when(over & (i > F.element_at(acc["starts"], -1)), opened).otherwise(acc)

    none = F.struct(F.array(F.lit(0)).alias("starts"), F.lit(0).cast("long").alias("base"), F.lit(budget).cast("long").alias("room"))
    starts = F.aggregate(F.sequence(F.lit(0), F.size("t") - 1), none, start_windows)["starts"]
    whole = whole.withColumn("starts", starts)
    kept, size = F.col("kept"), F.size("t")

    def window(start: Column, k: Column) -> Column:
        # the longest run of at most history_turns turns before the span whose tokens fit
        earlier = F.sequence(F.greatest(start - history_turns, F.least(kept, start)), start)
        fits = F.filter(earlier, lambda j: upto("cost_end", start) - upto("cost_end", j) <= history_budget)
        span = F.struct(start.alias("start"), F.coalesce(F.get("starts", k + 1), size).alias("end"), F.when(k == 0, 0).otherwise(F.array_min(fits)).alias("history"), F.when(k == 0, 0).otherwise(kept).alias("system"))
        return let(span, lambda s: written(s, k))

    def written(s: Column, k: Column) -> Column:
        shift = F.when(s["system"] == 1, F.get("t", F.lit(0))["char_end"]).otherwise(0) - upto("char_end", s["history"])
        targets = F.filter(F.sequence(s["start"], s["end"] - 1), lambda i: F.get("t", i)["target"])
        loss = F.transform(targets, lambda i: F.struct((shift + upto("char_end", i) + F.get("t", i)["head"]).cast("int").alias("start"), (shift + upto("char_end", i + 1) - (len(CLOSE) + 1)).cast("int").alias("end")))
        shown = F.concat(F.slice("t", F.lit(1), s["system"]), F.slice("t", s["history"] + 1, s["end"] - s["history"]))
        return F.struct(k.alias("window"), F.array_join(F.transform(shown, lambda x: x["piece"]), "").alias("formatted"), (s["system"] + s["start"] - s["history"]).alias("repeated"), loss.alias("loss"))

    return whole.select("conv_id", F.explode(F.transform("starts", window)).alias("w")).select("conv_id", "w.*")


def read_back(windows: DataFrame) -> DataFrame:
    """conv_id, turns (array of role, text), loss_text, formatted_chars, from the windows alone."""
    parts = F.split("formatted", r"<\|im_end\|>\n")
    new = F.slice(parts, F.col("repeated") + 1, F.size(parts) - 1 - F.col("repeated"))

    def turn(x: Column) -> Column:
        role = F.substring_index(x, "\n", 1)
        return F.struct(_unescape_role(F.substr(role, F.lit(len(OPEN) + 1))).alias("role"), unescape(F.substr(x, F.length(role) + 2)).alias("text"))

    read = windows.select(
        "conv_id",
        F.struct(
            "window",
            F.transform(new, turn).alias("turns"),
            F.array_join(F.transform("loss", lambda s: unescape(F.substr(F.col("formatted"), (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))), "").alias("loss"),
            F.length("formatted").cast("long").alias("chars"),
        ).alias("w"),
    )
    ordered = read.groupBy("conv_id").agg(F.sort_array(F.collect_list("w")).alias("w"))
    return ordered.select(
        "conv_id",
        F.flatten(F.transform("w", lambda x: x["turns"])).alias("turns"),
        F.array_join(F.transform("w", lambda x: x["loss"]), "").alias("loss_text"),
        F.aggregate("w", F.lit(0).cast("long"), lambda acc, x: acc + x["chars"]).alias("formatted_chars"),
    )
