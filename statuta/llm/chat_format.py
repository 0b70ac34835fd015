"""Chat formatting with Spark expressions only.

A conversation's turns are collected as structs and sorted by (turn, role, text); adjacent turns of
one role become one block whose texts are joined by a separator mark, so every turn can be read
back. Control strings inside texts and roles are escaped: a backslash is doubled and a backslash is
put inside each `<|`; no mark can then occur in a text.

Null role or text counts as empty, a null turn sorts first, repeated rows are turns of their own,
rows of a null conv_id form one conversation, and a role other than the loss role is just shown.
Columns besides the four named are ignored. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BEGIN, NEXT, END = "<|im_start|>", "<|im_next|>", "<|im_end|>"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\"))


def _escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("<\\n|"))


def _unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("<\\n|"), F.lit("\n")))


def format_conversations(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row for each conversation: conv_id, n_turns and its formatted text."""
    said = F.struct(F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    turns = rows.groupBy(F.col(conv).alias("conv_id")).agg(F.sort_array(F.collect_list(said)).alias("turns"))
    turns = turns.withColumn("firsts", F.filter(F.sequence(F.lit(0), F.size("turns") - 1), lambda i: (i == 0) | (F.col("turns")[i]["role"] != F.get("turns", i - 1)["role"])))

    def block(first: Column, k: Column) -> Column:
        after = F.coalesce(F.get("firsts", k + 1), F.size("turns"))
        texts = F.transform(F.slice("turns", first + 1, after - first), lambda t: escape(t["text"]))
        return F.concat(F.lit(BEGIN), _escape_role(F.col("turns")[first]["role"]), F.lit("\n"), F.array_join(texts, NEXT), F.lit(END + "\n"))

    return turns.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.array_join(F.transform("firsts", block), "").alias("formatted"))


def read_back(formatted: Column) -> Column:
    """Array of the (role, text) turns that a formatted text shows."""
    blocks = F.filter(F.split(formatted, r"<\|im_end\|>\n"), lambda b: b != "")

    def turns(block: Column) -> Column:
        role = F.substring_index(block, "\n", 1)
        texts = F.split(F.substring(block, F.char_length(role) + 2, F.char_length(block)), r"<\|im_next\|>")
        shown = _unescape_role(F.substring(role, F.lit(len(BEGIN) + 1), F.char_length(role)))
        return F.transform(texts, lambda t: F.struct(shown.alias("role"), unescape(t).alias("text")))

    return F.flatten(F.transform(blocks, turns))


def digests(formatted: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """What can be read back from `formatted`: turn and loss counts and hashes."""
    read = formatted.select("conv_id", "formatted", read_back(F.col("formatted")).alias("turns"))
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join(F.transform(F.filter("turns", lambda t: t["role"] == loss_role), lambda t: t["text"]), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(lines.cast("binary"), 256).alias("turns_sha256"),
        F.char_length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )
