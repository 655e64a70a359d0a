"""Training examples from conversations, one for each assistant turn; DataFrame operations only.

An example holds a conversation up to one assistant turn. All turns before it are context; only the
text of that turn is under the loss mask. Turns after the last assistant turn make a last example
without a target, so the output holds every turn.

    <|im_start|>ROLE \\n TEXT <|im_end|> \\n

In roles and texts `&` becomes `&amp;` and `<|` becomes `&lt;|`, in roles a newline becomes
`&#10;`; so nothing inside a turn looks like a mark, and reading turns these back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<|"), F.lit("&lt;|"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&lt;|"), F.lit("<|")), F.lit("&amp;"), F.lit("&"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("&#10;"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("&#10;"), F.lit("\n")))


def expand(conversations: DataFrame) -> DataFrame:
    """Examples of all conversations: conv_id, example (from 0), formatted, mask_start, mask_length.

    The mask is a range of code points of formatted, counted from 0; both columns are null in an example
    without a target. Turns stand in the order of turn, then role, then text; null turns come first.
    A null text or role is empty. Rows without conv_id are one conversation. Repeated rows are turns of
    their own. A conversation is one row here, so its turns must fit in a task. Other columns are not read.
    """
    turn = F.struct(F.col("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    grouped = conversations.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    head = lambda t: F.concat(F.lit(OPEN), escape_role(t["role"]), F.lit("\n"))
    shown = grouped.select(
        "conv_id",
        F.transform("turns", lambda t: F.struct(head(t).alias("head"), escape(t["text"]).alias("body"), (t["role"] == "assistant").alias("target"))).alias("turns"),
    )
    count = F.size("turns")
    ends = F.filter(F.sequence(F.lit(1), count), lambda i: (i == count) | F.element_at("turns", i)["target"])
    placed = shown.select("conv_id", "turns", F.posexplode(ends).alias("example", "stop"))
    whole = lambda t: F.concat(t["head"], t["body"], F.lit(CLOSE + "\n"))
    last = F.element_at("turns", F.col("stop"))
    before = F.array_join(F.transform(F.slice("turns", F.lit(1), F.col("stop") - 1), whole), "")
    parts = placed.select("conv_id", "example", before.alias("before"), last.alias("last"))
    return parts.select(
        "conv_id",
        "example",
        F.concat("before", whole(F.col("last"))).alias("formatted"),
        F.when(F.col("last.target"), F.length("before") + F.length("last.head")).cast("long").alias("mask_start"),
        F.when(F.col("last.target"), F.length("last.body")).cast("long").alias("mask_length"),
    )


def read_turns(formatted: Column) -> Column:
    """Turns of an example, read back: an array of role and text."""
    closed = F.split(formatted, r"<\|im_end\|>\n")
    turns = F.slice(closed, F.lit(1), F.size(closed) - 1)
    body = lambda x: F.substring(x, len(OPEN) + 1, F.length(x))
    mark = lambda x: F.locate("\n", x)
    return F.transform(F.transform(turns, body), lambda x: F.struct(unescape_role(x.substr(F.lit(1), mark(x) - 1)).alias("role"), unescape(x.substr(mark(x) + 1, F.length(x))).alias("text")))


def read_target(formatted: Column, start: Column, length: Column) -> Column:
    """The text under the mask, read back; null without a target."""
    return unescape(formatted.substr((start + 1).cast("int"), length.cast("int")))


def digests(examples: DataFrame) -> DataFrame:
    """What examples hold of each conversation, read back from them.

    Returns conv_id, n_turns, turns_sha256, loss_chars, loss_sha256 and formatted_chars.
    """
    # Only the longest example of a conversation is read whole; of the others the target is enough.
    read = examples.select(
        "conv_id", "example", F.length("formatted").alias("chars"), read_target(F.col("formatted"), F.col("mask_start"), F.col("mask_length")).alias("target"), "formatted"
    )
    grouped = read.groupBy("conv_id").agg(
        F.max_by("formatted", "example").alias("longest"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("example", "target"))), lambda x: x["target"]), "").alias("loss"),
        F.sum("chars").alias("formatted_chars"),
    )
    turns = grouped.withColumn("turns", read_turns(F.col("longest")))
    spoken = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return turns.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(spoken, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.col("formatted_chars").cast("long").alias("formatted_chars"),
    )
