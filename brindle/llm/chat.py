"""Chat formatting by prefix-target expansion, with DataFrame functions only.

Turns are marked ``<|im_start|>role`` newline text ``<|im_end|>`` newline.  In roles and texts ``&`` becomes ``&amp;`` and ``<`` before ``|`` becomes ``&lt;``
(a role's newlines become ``&#10;``), so no text can hold a marker, and ``unescape`` gives the text back.

``expand`` makes an example of each assistant turn: ``context`` is every turn before it and the header of the reply, ``target`` the reply
and its end marker.  Only the reply itself, without the marker, is trainable: ``loss_start`` and ``loss_end`` are its code points in context plus target.  Turns after the last assistant turn, or a
conversation without one, make one more example with an empty target, so that the examples hold all turns.
Examples are made row by row from the turns of one conversation, so a conversation is held once, not once an example.

Defined cases: a null text or role is empty; turns with equal numbers go by role, then text; repeated rows stay repeated; null turn numbers come first; a null conversation id is a conversation;
a very long text is formatted whole, once for each later example of its conversation; an empty table gives no rows; only the four named columns are read, so others may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
TRAINABLE = "assistant"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<|"), F.lit("&lt;|"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(F.replace(text, F.lit("&lt;"), F.lit("<")), F.lit("&#10;"), F.lit("\n")), F.lit("&amp;"), F.lit("&"))


def expand(turns: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id, example (from 1), n_examples, target_turn (position from 0; null without a target), context, target, loss_start, loss_end."""
    role = F.replace(escape(F.coalesce(F.col(role_col), F.lit(""))), F.lit("\n"), F.lit("&#10;"))
    rows = turns.select(F.col(conv_col).alias("conv_id"), F.struct(F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("raw"), escape(F.coalesce(F.col(text_col), F.lit(""))).alias("text"), role.alias("role")).alias("t"))
    convs = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("ts"))
    convs = convs.withColumn("at", F.filter(F.sequence(F.lit(0), F.size("ts") - 1), lambda k: F.col("ts")[k]["raw"] == TRAINABLE))
    # one target a reply, and -1 for turns that no reply follows
    open_end = (F.size("at") == 0) | (F.try_element_at("at", F.lit(-1)) < F.size("ts") - 1)
    tail = F.when(open_end, F.array(F.lit(-1))).otherwise(F.array_remove(F.array(F.lit(-1)), -1))
    convs = convs.withColumn("targets", F.concat("at", tail))
    each = convs.select("conv_id", "ts", F.size("targets").alias("n_examples"), F.posexplode("targets").alias("k", "target_turn"))
    before = F.when(F.col("target_turn") >= 0, F.slice("ts", F.lit(1), F.col("target_turn"))).otherwise(F.col("ts"))
    reply = F.col("ts")[F.greatest(F.col("target_turn"), F.lit(0))]
    has = F.col("target_turn") >= 0
    context = F.concat(F.array_join(F.transform(before, lambda t: F.concat(F.lit(START), t["role"], F.lit("\n"), t["text"], F.lit(END + "\n"))), ""), F.when(has, F.concat(F.lit(START), reply["role"], F.lit("\n"))).otherwise(F.lit("")))
    target = F.when(has, F.concat(reply["text"], F.lit(END + "\n"))).otherwise(F.lit(""))
    out = each.select("conv_id", (F.col("k") + 1).alias("example"), "n_examples", F.when(has, F.col("target_turn")).alias("target_turn"), context.alias("context"), target.alias("target"), F.when(has, F.char_length(reply["text"])).otherwise(F.lit(0)).alias("_n"))
    start = F.char_length("context")
    return out.withColumns({"loss_start": start, "loss_end": start + F.col("_n")}).drop("_n")


def loss_text(example: Column, loss_start: Column, loss_end: Column) -> Column:
    """The trainable text of an example, unescaped."""
    return unescape(F.substr(example, loss_start + 1, loss_end - loss_start))


def parse(example: Column) -> Column:
    """The turns of a formatted text as array<struct<role,text>>."""
    pieces = F.filter(F.split(example, r"<\|im_end\|>\n"), lambda p: p != "")
    body = lambda p: F.substr(p, F.lit(len(START) + 1))
    cut = lambda p: F.instr(body(p), "\n")
    return F.transform(pieces, lambda p: F.struct(unescape(F.substr(body(p), F.lit(1), cut(p) - 1)).alias("role"), unescape(F.substr(body(p), cut(p) + 1)).alias("text")))
