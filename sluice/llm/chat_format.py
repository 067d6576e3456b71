"""Chat formatting by prefix-target expansion (DataFrame functions only).

Every assistant turn becomes one training example whose text is all the
preceding turns plus that reply, rendered by the template; only the reply
is trainable, given as a code point span ``[loss_start, loss_end)``.

Template (fixed values)::

    <|im_start|>ROLE\\nTEXT<|im_end|>\\n

Control strings inside texts (``<|``, ``<s>``, ``</s>``, ``[INST]``,
``[/INST]``) are broken by a backslash behind their first character, and one
that already has backslashes there gets one more, so escaping is reversible
and no text can forge a marker.  Backslash and line feed in a role are
written ``\\\\`` and ``\\n``.

Defined cases: a null text or role is the empty string; turns are ordered by
(turn, role, text), nulls first, so ties and repeated rows keep a defined
place; a null conversation id is a conversation of its own.  Turns behind
the last reply (or a conversation without one) form a last row with
``is_tail`` true and an empty loss span, so nothing is lost.  An empty table
gives no rows; extra columns are ignored.

A conversation is one training sequence and so one row; its examples are
generated from that row without another shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Markers of the template and the control strings it escapes.
TURN_START = "<|im_start|>"
TURN_END = "<|im_end|>\n"
TRAINED_ROLE = "assistant"
_CONTROL = r"(\||/?s>|/?INST\])"
ESCAPE_PATTERN = r"([<\[])(\\*)" + _CONTROL
UNESCAPE_PATTERN = r"([<\[])\\(\\*)" + _CONTROL


def escape(text: Column) -> Column:
    """Break every control string; inverse of ``unescape``."""
    return F.regexp_replace(text, ESCAPE_PATTERN, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, UNESCAPE_PATTERN, "$1$2$3")


def _escape_role(role: Column) -> Column:
    return F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n"))


def _unescape_role(role: Column) -> Column:
    """``\\n`` and ``\\\\`` back to what they stand for, left to right."""
    parts = F.split(role, r"\\\\", -1)  # between escaped backslashes only \n remains
    return F.array_join(F.transform(parts, lambda p: F.replace(p, F.lit("\\n"), F.lit("\n"))),
                        "\\")


def format_examples(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn",
                    role: str = "role", text: str = "text") -> DataFrame:
    """Examples of every conversation.

    Returns ``conv_id, example, target_turn, is_tail, text, loss_start,
    loss_end``: ``example`` counts a conversation's examples from 0 and
    ``target_turn`` is the 0-based place of the trained turn.
    """
    rows = turns.select(
        F.col(conv_id).alias("conv_id"),
        F.struct(F.col(turn).alias("turn"),
                 F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
                 F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")).alias("t"))
    convs = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    rendered = convs.select(
        "conv_id",
        F.transform("ts", lambda x: F.struct(
            (x["role"] == TRAINED_ROLE).alias("trained"),
            F.concat(F.lit(TURN_START), _escape_role(x["role"]), F.lit("\n")).alias("head"),
            escape(x["text"]).alias("body"))).alias("ts"))
    rendered = rendered.select(
        "conv_id", "ts",
        F.transform("ts", lambda x: F.concat(x["head"], x["body"], F.lit(TURN_END))).alias("segs"))
    n = F.size("ts")
    targets = F.filter(F.sequence(F.lit(0), n - 1),
                       lambda i: F.element_at("ts", i + 1)["trained"])
    # each target turn; behind them the last turn when it is not itself a target
    wanted = F.when(F.element_at("ts", -1)["trained"], targets).otherwise(
        F.concat(targets, F.array(n - 1)))
    ex = rendered.select("conv_id", "ts", "segs", F.posexplode(wanted).alias("example", "at"))
    mine = F.element_at("ts", F.col("at") + 1)
    ex = ex.select(
        "conv_id", "example", F.col("at").alias("target_turn"),
        (~mine["trained"]).alias("is_tail"), F.char_length(mine["head"]).alias("h"),
        F.char_length(mine["body"]).alias("b"),
        F.char_length(F.element_at("segs", F.col("at") + 1)).alias("last"),
        F.array_join(F.slice("segs", F.lit(1), F.col("at") + 1), "").alias("text"))
    start = F.char_length("text") - F.col("last") + F.col("h")
    return ex.select(
        "conv_id", "example", "target_turn", "is_tail", "text",
        F.when(F.col("is_tail"), F.char_length("text")).otherwise(start).cast("long")
        .alias("loss_start"),
        F.when(F.col("is_tail"), F.char_length("text")).otherwise(start + F.col("b"))
        .cast("long").alias("loss_end"))


def read_back(examples: DataFrame) -> DataFrame:
    """Turns and trained text of each conversation, from its examples alone.

    Returns ``conv_id, turns array<struct<role, text>>, loss_text,
    formatted_chars`` (code points of all examples of the conversation).
    """
    loss = unescape(F.substring(F.col("text"), F.col("loss_start") + 1,
                                F.col("loss_end") - F.col("loss_start")))
    per = examples.select("conv_id", "example", "text", loss.alias("loss"))
    conv = per.groupBy("conv_id").agg(
        F.max_by("text", "example").alias("full"),
        F.array_sort(F.collect_list(F.struct("example", "loss"))).alias("parts"),
        F.sum(F.char_length("text").cast("long")).alias("formatted_chars"))
    segs = F.slice(F.split("full", r"<\|im_end\|>\n", -1), F.lit(1),
                   F.size(F.split("full", r"<\|im_end\|>\n", -1)) - 1)
    conv = conv.select("conv_id", "parts", "formatted_chars", segs.alias("segs"))

    def turn(seg: Column) -> Column:
        rest = F.substr(seg, F.lit(len(TURN_START) + 1))
        cut = F.instr(rest, "\n")
        return F.struct(_unescape_role(F.substr(rest, F.lit(1), cut - 1)).alias("role"),
                        unescape(F.substr(rest, cut + 1)).alias("text"))

    return conv.select(
        "conv_id", F.transform("segs", turn).alias("turns"),
        F.array_join(F.transform("parts", lambda p: p["loss"]), "").alias("loss_text"),
        "formatted_chars")


def digest(turns_back: DataFrame) -> DataFrame:
    """Digest columns of ``read_back``'s rows."""
    flat = F.array_join(F.transform("turns", lambda t: F.concat(
        t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return turns_back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(flat.cast("binary"), 256).alias("turns_sha256"),
        F.char_length("loss_text").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss_text").cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars")
