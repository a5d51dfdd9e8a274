"""Chat formatting by prefix-target expansion.

Every assistant turn becomes one example: all turns before it as context, its
own text as the only trainable span. Turns after the last assistant turn (or a
conversation without one) make a further example without a trainable span, so
the formatted rows always hold the whole conversation.

Template of a turn::

    ### role: text</turn>\\n

``escape`` is reversible and leaves neither ``###`` nor ``</turn>`` in a text,
whatever the text holds, so a formatted string can be cut at the marks again.

Defined results
    null text or role        the empty string
    null conv_id             a conversation of its own
    order of turns           turn (null first), then role, then text; repeated rows
                             stay, as turns of their own
    empty table              no rows
    other columns            kept out; conv_id, turn, role, text are read

An example is one string, so a conversation is brought together in one row. Its
examples are made one at a time from there and not gathered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

OPEN, ROLE_END, CLOSE = "### ", ": ", "</turn>\n"
TARGET_ROLE = "assistant"


def escape(text: Column) -> Column:
    r"""``\`` becomes ``\\``, ``###`` ``\h`` and ``</turn>`` ``\e``."""
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.replace(F.replace(text, F.lit("###"), F.lit("\\h")), F.lit("</turn>"), F.lit("\\e"))


def unescape(text: Column) -> Column:
    """Undo ``escape``: pairs of backslashes are read from the left, so what lies between them is free of them."""
    parts = F.split(text, r"\\\\", -1)
    plain = F.transform(parts, lambda p: F.replace(F.replace(p, F.lit("\\h"), F.lit("###")), F.lit("\\e"), F.lit("</turn>")))
    return F.array_join(plain, "\\")


def _role(role: Column) -> Column:
    return F.replace(escape(role), F.lit(":"), F.lit("\\c"))


def _plain_role(role: Column) -> Column:
    parts = F.transform(F.split(role, r"\\\\", -1), lambda p: F.replace(p, F.lit("\\c"), F.lit(":")))
    return unescape(F.array_join(parts, "\\\\"))


def format_examples(turns: DataFrame) -> DataFrame:
    """conv_id, example (from 0), formatted, loss_start, loss_end (code points, end exclusive; null without a target)."""
    text, role = F.coalesce("text", F.lit("")), F.coalesce("role", F.lit(""))
    own = F.struct(F.col("turn").alias("turn"), role.alias("role"), text.alias("text"))
    whole = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(own)).alias("t"))
    rendered = whole.select(
        "conv_id",
        F.transform("t", lambda x: F.concat(F.lit(OPEN), _role(x["role"]), F.lit(ROLE_END))).alias("head"),
        F.transform("t", lambda x: escape(x["text"])).alias("body"),
        F.transform("t", lambda x: x["role"] == TARGET_ROLE).alias("target"),
    )
    ends = F.filter(F.sequence(F.lit(1), F.size("target")), lambda i: F.element_at("target", i))
    ends = F.when(F.element_at("target", -1), ends).otherwise(F.concat(ends, F.array(F.size("target"))))
    # a generator over positions: one example at a time is built from the row
    at = rendered.select(
        "conv_id", "head", "body", "target",
        F.zip_with("head", "body", lambda h, t: F.concat(h, t, F.lit(CLOSE))).alias("turns"),
        F.posexplode(ends).alias("example", "k"),
    )
    k = F.col("k")
    before = F.concat(F.array_join(F.slice("turns", F.lit(1), k - 1), ""), F.element_at("head", k))
    reply, wanted = F.element_at("body", k), F.element_at("target", k)
    made = at.select("conv_id", "example", before.alias("before"), reply.alias("reply"), wanted.alias("wanted"))
    return made.select(
        "conv_id", "example",
        F.concat("before", "reply", F.lit(CLOSE)).alias("formatted"),
        F.when(F.col("wanted"), F.length("before")).alias("loss_start"),
        F.when(F.col("wanted"), F.length("before") + F.length("reply")).alias("loss_end"),
    )


def read_turns(formatted: Column) -> Column:
    """Array of (role, text): the turns of a formatted string."""
    pieces = F.split(formatted, r"</turn>\n", -1)
    pieces = F.slice(pieces, 1, F.size(pieces) - 1)
    head = F.lit(len(OPEN) + 1)

    def one(p):
        cut = F.instr(p, ROLE_END)
        role = F.substring(p, head, cut - head)
        return F.struct(_plain_role(role).alias("role"), unescape(F.substring(p, cut + len(ROLE_END), F.length(p))).alias("text"))

    return F.transform(pieces, one)


def read_loss(formatted: Column, start: Column, end: Column) -> Column:
    """Text under the loss mask, unescaped; '' without a mask."""
    return F.coalesce(unescape(F.substring(formatted, start + 1, end - start)), F.lit(""))
