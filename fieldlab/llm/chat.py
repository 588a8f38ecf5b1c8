"""Chat formatting by prefix-target expansion: one example for every assistant turn, its reply alone trainable.

An example holds all turns before the reply as context, then the reply. Turns after the last reply, or a conversation
without one, make a last example with nothing trainable, so that no turn is lost.

A turn is written as ``<|turn|>role`` + line break + text + ``<|end|>``. Control strings inside texts and roles
(``<s> </s> [INST] [/INST] <|...|>``) get a backslash after their first character, those that have backslashes there get
one more; taking one away restores the text exactly. Line breaks and backslashes in roles are written as ``\\n``, ``\\\\``.

Null texts and roles are empty. Turns are in order of turn (null first), role, text; repeated rows are turns of their own.
Null is a conversation like any other. An empty table gives no examples. Other columns are ignored, whatever their names.

An example with its context is one row, so a conversation has to fit into one row; that, and the square of its turns,
is what the expansion asks for. Everything runs in the JVM, and turns are shuffled once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURN, END = "<|turn|>", "<|end|>"
#: What may follow the first character of a control string.
_REST = r"(/?s>|/?INST\]|\|[A-Za-z_]*\|>)"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])(\\*)" + _REST, r"$1\\$2$3")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])\\(\\*)" + _REST, r"$1$2$3")


def _role_out(role: Column) -> Column:
    return escaped(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def _role_in(role: Column) -> Column:
    parts = F.split(unescaped(role), r"\\\\", -1)
    return F.array_join(F.transform(parts, lambda p: F.replace(p, F.lit("\\n"), F.lit("\n"))), "\\")


def format_chat(turns: DataFrame) -> DataFrame:
    """Examples of ``turns`` (conv_id, turn, role, text).

    Columns: conv_id, example (from 0), n_turns (turns in it), formatted, loss_start and loss_chars (the trainable
    code points of ``formatted``; 0 chars if none), last (whether it is the conversation's last example, which holds all turns).
    """
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    talks = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", role.alias("role"), text.alias("text")))).alias("raw"))
    shown = talks.select(
        "conv_id",
        F.transform(
            "raw",
            lambda t: F.struct(
                (t["role"] == "assistant").alias("reply"),
                F.concat(F.lit(TURN), _role_out(t["role"]), F.lit("\n")).alias("head"),
                escaped(t["text"]).alias("body"),
            ),
        ).alias("turns"),
    )
    ends = shown.select(
        "conv_id",
        "turns",
        F.filter(
            F.sequence(F.lit(1), F.size("turns")),
            lambda i: F.element_at("turns", i)["reply"] | (i == F.size("turns")),
        ).alias("ends"),
    )
    each = ends.select("conv_id", "turns", F.posexplode("ends").alias("example", "n_turns"))
    target = F.element_at("turns", F.col("n_turns"))
    context = F.array_join(
        F.transform(
            F.slice("turns", F.lit(1), F.col("n_turns") - 1), lambda t: F.concat(t["head"], t["body"], F.lit(END))
        ),
        "",
    )
    prefix = F.concat(context, target["head"])
    return each.select(
        "conv_id", "example", "n_turns",
        F.concat(prefix, target["body"], F.lit(END)).alias("formatted"),
        F.char_length(prefix).alias("loss_start"),
        F.when(target["reply"], F.char_length(target["body"])).otherwise(0).alias("loss_chars"),
        target["reply"].alias("trainable"),
        (F.col("n_turns") == F.size("turns")).alias("last"),
    )


def read_turns(formatted: Column | str) -> Column:
    """The turns of an example as an array of (role, text), unescaped."""
    formatted = F.col(formatted) if isinstance(formatted, str) else formatted
    pieces = F.slice(F.split(formatted, r"<\|turn\|>", -1), F.lit(2), F.size(F.split(formatted, r"<\|turn\|>", -1)) - 1)

    def turn(piece: Column) -> Column:
        head = F.substring_index(piece, "\n", 1)
        length = F.char_length(piece) - F.char_length(head) - 1 - len(END)
        return F.struct(
            _role_in(head).alias("role"), unescaped(F.substr(piece, F.char_length(head) + 2, length)).alias("text")
        )

    return F.transform(pieces, turn)


def read_loss(examples: DataFrame) -> Column:
    """The unescaped text under an example's loss mask."""
    return unescaped(F.substr(F.col("formatted"), F.col("loss_start") + 1, F.col("loss_chars")))
