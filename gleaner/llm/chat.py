"""Chat formatting by prefix-target expansion, with DataFrame functions only.

``turns(conv_id, turn, role, text)`` become training examples: each assistant turn is the target of one example,
with all earlier turns as context, and only the text of that reply is under the loss mask. A conversation that
does not end with an assistant turn has one more example without a target (``target_turn`` null, empty mask), so
that no turn is lost.

The template is ``<|im_start|>role\\ntext<|im_end|>\\n`` per turn. Control strings inside texts and roles are
escaped reversibly: ``\\`` is doubled and ``<|`` becomes ``<\\|``; a line feed in a role becomes ``<\\n``. In an
escaped text a ``<`` is followed by one single backslash only where this module put it, so it can be undone.

Defined results: null texts and roles are empty; turns are taken by ``turn`` (null first), equal numbers by role,
then text; repeated rows are turns of their own; an empty table gives no example; other columns are ignored. A
conversation is one row, as its last example holds it whole; its examples need the square of its turns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>\n"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("<\\n"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("<\\n"), F.lit("\n")))


def prefix_targets(turns: DataFrame, assistant: str = "assistant") -> DataFrame:
    """Examples(conv_id, example, target_turn, formatted, loss_start, loss_end); offsets in code points, end exclusive."""
    empty = F.lit("")
    row = F.struct(
        F.col("turn"), F.coalesce("role", empty).alias("role"), F.coalesce("text", empty).alias("text"),
    )
    grouped = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(row)).alias("turns"))
    head = lambda t: F.concat(F.lit(START), escape_role(t["role"]), F.lit("\n"))
    rendered = grouped.withColumn(
        "parts", F.transform("turns", lambda t: F.struct(
            t["turn"].alias("turn"), (t["role"] == assistant).alias("target"),
            head(t).alias("head"), escape(t["text"]).alias("body"),
        )),
    ).drop("turns")
    whole = rendered.withColumn(
        "whole", F.transform("parts", lambda p: F.concat(p["head"], p["body"], F.lit(END)))
    )
    count = F.size("parts")
    is_example = lambda p, i: p["target"] | (i == count - 1)
    numbered = F.filter(F.transform("parts", lambda p, i: F.struct(i.alias("i"), is_example(p, i).alias("ok"))),
                        lambda x: x["ok"])
    exploded = whole.select("conv_id", "parts", "whole", F.posexplode(numbered).alias("example", "at"))
    i = F.col("at.i")
    part = F.element_at("parts", i + 1)
    context = F.array_join(F.slice("whole", F.lit(1), i), "")
    target = part["target"]
    start = F.when(target, F.length("context") + F.length(part["head"])).otherwise(0)
    return exploded.withColumn("context", context).select(
        "conv_id", "example", F.when(target, part["turn"]).alias("target_turn"),
        F.concat("context", F.element_at("whole", i + 1)).alias("formatted"),
        start.alias("loss_start"),
        (start + F.when(target, F.length(part["body"])).otherwise(0)).alias("loss_end"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted text, unescaped, as an array of (role, text)."""
    pieces = F.split(formatted, "<\\|im_end\\|>\\n")
    body = lambda p: F.substring(p, F.lit(len(START) + 1), F.length(p))
    role = lambda p: F.substring_index(body(p), "\n", 1)
    return F.transform(
        F.slice(pieces, F.lit(1), F.size(pieces) - 1),
        lambda p: F.struct(
            unescape_role(role(p)).alias("role"),
            unescape(F.substring(body(p), F.length(role(p)) + 2, F.length(p))).alias("text"),
        ),
    )


def read_loss(formatted: Column, start: Column, end: Column) -> Column:
    """The text under the loss mask, unescaped."""
    return unescape(F.substring(formatted, start + 1, end - start))


def digest(examples: DataFrame) -> DataFrame:
    """Per conversation what its examples hold, read back from the formatted texts and masks.

    The examples of a conversation are already together, so no row moves.
    """
    loss = F.struct("example", read_loss(F.col("formatted"), F.col("loss_start"), F.col("loss_end")).alias("loss"))
    grouped = examples.groupBy("conv_id").agg(
        F.max(F.struct("example", "formatted"))["formatted"].alias("longest"),
        F.array_join(F.transform(F.array_sort(F.collect_list(loss)), lambda x: x["loss"]), "").alias("loss"),
        F.sum(F.length("formatted")).alias("formatted_chars"),
        F.count("target_turn").alias("n_targets"),
    )
    turns = read_turns(F.col("longest"))
    text = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return grouped.withColumn("turns", turns).select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(text, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.col("formatted_chars").cast("long").alias("formatted_chars"),
    )
