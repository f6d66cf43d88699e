"""Chat formatting with one training example per assistant turn.

A turn is written as `<turn:ROLE>` and a line end, its text, `</turn>` and a line
end. Inside roles and texts `\\` becomes `\\\\`, `<` becomes `\\l`, and in roles also
`>` becomes `\\g` and a line end `\\n`, so the only `<` in the output are those of
the marks and every text comes back unchanged.

Prefix-target expansion: every assistant turn is an example of its own. Its
context is the formatted conversation up to and including the turn's opening
mark, its target is the escaped text, and only the target is trainable.
`examples` writes every example out as one text with its loss span, so the
examples of a conversation of n turns take space in proportion to n squared, as
the method has it; one example is a row, and a task holds one context at a time.
`digests` reads the conversations back from the examples' texts: each is found
to begin with the example before it, and only what it adds is put together.

Defined results: null text and null role are empty; turns are ordered by turn
(null first), then role and text; repeated rows are turns of their own; a null
conv_id is a conversation. An empty table gives an empty result. Other columns
are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TRAINED = "assistant"
_END = "</turn>\n"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<"), F.lit("\\l"))


def escape_role(role: Column) -> Column:
    return F.replace(F.replace(escape(role), F.lit(">"), F.lit("\\g")), F.lit("\n"), F.lit("\\n"))


def unescape(text: Column) -> Column:
    """The text that `escape` or `escape_role` was given: pairs of backslashes part what lies between them."""

    def plain(part: Column) -> Column:
        for mark, character in (("\\l", "<"), ("\\g", ">"), ("\\n", "\n")):
            part = F.replace(part, F.lit(mark), F.lit(character))
        return part

    return F.array_join(F.transform(F.split(text, r"\\\\", -1), plain), "\\")


def format_turns(conversations: DataFrame) -> DataFrame:
    """The formatted turns: conv_id, place (0, 1, ...), start (characters before it), formatted, trained."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    formatted = F.concat(F.lit("<turn:"), escape_role(F.col("role")), F.lit(">\n"), escape(F.col("text")), F.lit("</turn>\n"))
    turns = turns.select("conv_id", "turn", "role", "text", formatted.alias("formatted"), F.length(formatted).cast("long").alias("chars"))
    return turns.select(
        "conv_id",
        (F.row_number().over(order) - 1).cast("long").alias("place"),
        (F.sum("chars").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("chars")).alias("start"),
        "formatted",
        (F.col("role") == TRAINED).alias("trained"),
    )


def example_texts(turns: DataFrame) -> DataFrame:
    """Every example written out: conv_id, place, context, target (escaped text), both as to be tokenised.

    ``since`` is where the conversation's example before it ended, 0 at the first one. The contexts of a
    conversation grow with the square of its turns.
    """
    before = Window.partitionBy("conv_id").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    prefix = F.array_join(F.collect_list("formatted").over(before), "")
    since = F.max(F.when(F.col("trained"), F.col("start") + F.length("formatted"))).over(before)
    head = F.length(F.substring_index("formatted", "\n", 1)) + 1
    whole = turns.withColumns({"prefix": F.coalesce(prefix, F.lit("")), "since": F.coalesce(since, F.lit(0)).cast("long")}).filter("trained")
    target = F.col("formatted").substr(head + 1, F.length("formatted") - head - len(_END))
    context = F.concat("prefix", F.col("formatted").substr(F.lit(1), head))
    return whole.select("conv_id", "place", context.alias("context"), target.alias("target"), "since")


def examples(turns: DataFrame) -> DataFrame:
    """One row per trained turn: conv_id, place, text (context, target, closing mark), loss_start, loss_end, since.

    The context is all of the text that stands before loss_start; the places are in characters.
    """
    start = F.length("context").cast("long")
    return example_texts(turns).select(
        "conv_id",
        "place",
        F.concat("context", "target", F.lit(_END)).alias("text"),
        start.alias("loss_start"),
        (start + F.length("target")).alias("loss_end"),
        "since",
    )


def digests(turns: DataFrame, made: DataFrame) -> DataFrame:
    """What the examples ``made`` hold per conversation, read from their texts and loss spans.

    Formatted turns are read only where no example follows. The job ends with an error if an example's text
    does not begin with the example before it.
    """
    text, since, long = F.col("text"), F.col("since").cast("int"), F.col("loss_end") - F.col("loss_start")
    added = made.select(
        "conv_id",
        "place",
        text.substr(since + 1, F.length(text)).alias("text"),
        unescape(text.substr((F.col("loss_start") + 1).cast("int"), long.cast("int"))).alias("loss"),
        F.sha2(F.left(text, since), 256).alias("head"),
        F.sha2(text, 256).alias("whole"),
    )
    last = made.groupBy(F.col("conv_id").alias("_conv")).agg(F.max("place").alias("_last"))
    rest = turns.join(last, turns["conv_id"].eqNullSafe(last["_conv"]) & (turns["place"] <= last["_last"]), "left_anti")
    none = F.lit(None).cast("string")
    pieces = added.unionByName(rest.select("conv_id", "place", F.col("formatted").alias("text"), *(none.alias(c) for c in ("loss", "head", "whole"))))
    grouped = pieces.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("place", "text", "loss", "head", "whole"))).alias("rows"))
    told = grouped.select("conv_id", F.array_join("rows.text", "").alias("text"), F.filter("rows", lambda r: r["head"].isNotNull()).alias("made"))
    ends = F.concat(F.array(F.sha2(F.lit(""), 256)), F.col("made.whole"))
    chained = F.slice(ends, F.lit(1), F.size("made")) == F.col("made.head")
    told = told.withColumn("text", F.when(chained, F.col("text")).otherwise(F.raise_error(F.lit("an example lacks its context"))))

    def said(turn: Column) -> Column:
        head = F.substring_index(turn, "\n", 1)
        role = head.substr(F.lit(len("<turn:") + 1), F.length(head) - len("<turn:>"))
        return F.concat(unescape(role), F.lit("\n"), unescape(turn.substr(F.length(head) + 2, F.length(turn))), F.lit("\n"))

    told = told.select("conv_id", "text", "made", F.split("text", _END, -1).alias("turns"))  # the last one is empty
    loss = F.array_join("made.loss", "")
    return told.select(
        "conv_id",
        (F.size("turns") - 1).cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform(F.slice("turns", F.lit(1), F.size("turns") - 1), said), ""), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.length("text").cast("long").alias("formatted_chars"),
        F.size("made").cast("long").alias("n_examples"),
    )
