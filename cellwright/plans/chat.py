"""Chat text with supervised spans, and the training-text job.

Turns come as rows (conv_id, turn, role, text) with roles ``user``,
``assistant`` and ``system``. Everything up to offsets works turn by turn, and
table texts are made in blocks of rows; only ``render_chat``, ``table_text`` and the texts of
``build_training_text`` are one string per group, which is what they are for.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.rows import let
from ..functions.text import render_number
from ..operators.cells import is_numeric
from ..operators.metadata import WHOLE_TYPES
from ..operators.positions import dense_position, number_rows, prefix_sum
from ..session import store

# ---- fixed values: system texts, role names, separators and markers ----
_CURIOUS = (
    "A chat between a curious user and an artificial intelligence assistant. "
    "The assistant gives helpful, detailed, and polite answers to the user's questions."
)
_HONEST = """You are a helpful, respectful and honest assistant. Always answer as helpfully as possible, while being safe.  Your answers should not include any harmful, unethical, racist, sexist, toxic, dangerous, or illegal content. Please ensure that your responses are socially unbiased and positive in nature.

If a question does not make any sense, or is not factually coherent, explain why instead of answering something not correct. If you don't know the answer to a question, please don't share false information."""
TABLE_MARK = "<table>"
TABLE_START = "<tb_start>"
TABLE_END = "<tb_end>"
IGNORE = -100

#: rows in one block of a table's text
TEXT_ROWS = 1 << 12


@dataclass(frozen=True)
class Style:
    kind: str
    system: str
    user: str
    assistant: str
    sep: str
    sep2: str | None = None


STYLES = {
    "single": Style("single", _CURIOUS, "Human", "Assistant", "\n"),
    "two": Style("two", _CURIOUS, "Human", "Assistant", "\n", "</s>"),
    "llama_2": Style("llama_2", _HONEST, "USER", "ASSISTANT", "<s>", "</s>"),
    "llama_3": Style("llama_3", _HONEST, "user", "assistant", "<|eot_id|>"),
}


def style(name: str) -> Style:
    if name not in STYLES:
        raise ValueError(f"unsupported chat style: {name}")
    return STYLES[name]


# ------------------------------------------------------------------ turns
def trim_turns(turns: DataFrame) -> DataFrame:
    """Drop one leading turn that is not the user's and one trailing turn that
    is not the assistant's. System turns are taken out first."""
    talk = turns.where(F.col("role") != "system")
    ends = talk.groupBy("conv_id").agg(
        F.min(F.struct("turn", "role")).alias("_first"), F.max(F.struct("turn", "role")).alias("_last")
    )
    drop_first = (F.col("turn") == F.col("_first.turn")) & (F.col("_first.role") != "user")
    drop_last = (F.col("turn") == F.col("_last.turn")) & (F.col("_last.role") != "assistant")
    return talk.join(ends, "conv_id").where(~drop_first & ~drop_last).drop("_first", "_last")


def number_turns(turns: DataFrame) -> DataFrame:
    """``i``: 0, 1, ... inside each conversation."""
    return dense_position(turns, "turn", ["conv_id"], out="i")


def alternation_report(turns: DataFrame) -> DataFrame:
    """conv_id, n_turns, alternates: does every turn have the role of its place?"""
    expected = F.when(F.col("i") % 2 == 0, F.lit("user")).otherwise(F.lit("assistant"))
    return number_turns(turns).groupBy("conv_id").agg(
        F.count(F.lit(1)).alias("n_turns"), F.bool_and(F.col("role") == expected).alias("alternates")
    )


def mark_table(turns: DataFrame) -> DataFrame:
    """Put the table mark before the first turn of each conversation."""
    firsts = turns.groupBy("conv_id").agg(F.min("turn").alias("_first"))
    marked = F.when(F.col("turn") == F.col("_first"), F.concat(F.lit(TABLE_MARK + "\n"), F.col("text"))).otherwise(F.col("text"))
    return turns.join(firsts, "conv_id").withColumn("text", marked).drop("_first")


def with_system(numbered: DataFrame, turns: DataFrame, s: Style) -> DataFrame:
    """``system``: the conversation's own system turn, else the style's text."""
    own = turns.where(F.col("role") == "system").groupBy("conv_id").agg(
        F.min(F.struct("turn", "text")).getField("text").alias("_own")
    )
    return numbered.join(own, "conv_id", "left").withColumn("system", F.coalesce("_own", F.lit(s.system))).drop("_own")


# ------------------------------------------------------------------ pieces
def _header(role: Column, text: Column, s: Style) -> Column:
    return F.concat(F.lit("<|start_header_id|>"), role, F.lit("<|end_header_id|>"), text, F.lit(s.sep))


def chat_pieces(numbered: DataFrame, s: Style) -> DataFrame:
    """Adds ``piece``, the turn's share of the rendered text (the first one
    carries the head), and ``lead``, the characters before the message in it."""
    i, text, system = F.col("i"), F.col("text"), F.col("system")
    first, user = i == 0, F.col("role") == "user"
    name = F.when(user, F.lit(s.user)).otherwise(F.lit(s.assistant))
    has_text = F.length(text) > 0
    if s.kind in ("single", "two"):
        head = F.when(first, F.concat(system, F.lit(s.sep))).otherwise(F.lit(""))
        end = F.lit(s.sep)
        if s.kind == "two":
            end = F.when(i % 2 == 0, F.lit(s.sep)).otherwise(F.lit(s.sep2))
        said = F.when(has_text, F.concat(name, F.lit(": "), text, end)).otherwise(F.concat(name, F.lit(":")))
        piece, lead = F.concat(head, said), F.length(head) + F.length(name) + 2
    elif s.kind == "llama_2":
        # the leading separator of the whole text is stripped, so the first turn has none
        sys_part = F.when(first & (F.length(system) > 0), F.concat(F.lit("<<SYS>>\n"), system, F.lit("\n<</SYS>>\n\n"))).otherwise(F.lit(""))
        before = F.concat(F.when(first, F.lit("")).otherwise(F.lit(s.sep)), F.lit("[INST] "), sys_part)
        asked = F.concat(before, text, F.lit(" [/INST]"))
        replied = F.concat(F.lit(" "), text, F.lit(" " + s.sep2))
        piece = F.when(~has_text, F.lit("")).when(i % 2 == 0, asked).otherwise(replied)
        lead = F.when(i % 2 == 0, F.length(before)).otherwise(F.lit(1))
    elif s.kind == "llama_3":
        head = F.when(first, F.concat(F.lit("<|begin_of_text|>"), _header(F.lit("system"), system, s))).otherwise(F.lit(""))
        piece = F.concat(head, _header(name, text, s))
        lead = F.length(head) + F.length(_header(name, F.lit(""), s)) - len(s.sep)
    else:
        raise ValueError(f"unsupported chat style: {s.kind}")
    return numbered.withColumns({"piece": piece, "lead": lead})


def rejected(turns: DataFrame) -> DataFrame:
    """conv_id, n_turns of the conversations that ``prepare`` leaves out: roles do not alternate."""
    return alternation_report(trim_turns(turns)).where("NOT alternates").select("conv_id", "n_turns")


def prepare(turns: DataFrame, s: Style) -> DataFrame:
    """Trimmed, numbered turns with their pieces; broken conversations are left out, ``rejected`` names them."""
    numbered = number_turns(trim_turns(turns))
    expected = F.when(F.col("i") % 2 == 0, F.lit("user")).otherwise(F.lit("assistant"))
    broken = numbered.where(F.col("role") != expected).select("conv_id").distinct()
    sound = numbered.join(broken, "conv_id", "left_anti")
    return chat_pieces(with_system(sound, turns, s), s)


def join_pieces(pieces: DataFrame, keep=()) -> DataFrame:
    """One text per conversation."""
    ordered = F.array_sort(F.collect_list(F.struct("i", "piece")))
    return pieces.groupBy("conv_id", *keep).agg(
        F.array_join(F.transform(ordered, lambda p: p["piece"]), "").alias("text")
    )


def render_chat(turns: DataFrame, style_name: str) -> DataFrame:
    return join_pieces(prepare(turns, style(style_name)))


def _marks(text: Column) -> Column:
    return ((F.length(text) - F.length(F.replace(text, F.lit(TABLE_MARK), F.lit("")))) / len(TABLE_MARK)).cast("bigint")


def spans_of(pieces: DataFrame, s: Style, sizes: DataFrame | None = None) -> DataFrame:
    """conv_id, i, start, end (exclusive) of the supervised characters.

    With ``sizes`` (table_id, n_chars, found_at: the length of a table's text and the place of the
    first separator in it) the spans are those of the text in which every table mark has been
    replaced; pieces then still hold the marks, and no table text is read.
    """
    text, before = F.col("text"), F.substring("piece", F.lit(1), F.col("lead"))
    stop_at = F.instr(text, s.sep)
    sized = pieces.select(
        "conv_id", "i", "role", *(["table_id"] if sizes is not None else []),
        F.length("piece").cast("bigint").alias("_len"), _marks(F.col("piece")).alias("_len_marks"),
        F.col("lead").cast("bigint").alias("_lead"), _marks(before).alias("_lead_marks"),
        F.length(text).cast("bigint").alias("_said"), _marks(text).alias("_said_marks"),
        F.when(stop_at > 0, stop_at - 1).cast("bigint").alias("_stop"),
        _marks(F.substring(text, F.lit(1), stop_at - 1)).alias("_stop_marks"),
        F.instr(text, TABLE_MARK).alias("_mark_at"),
    )
    if sizes is None:
        grow, found = F.lit(0), F.lit(None).cast("bigint")
    else:
        sized = sized.join(sizes.select("table_id", "n_chars", "found_at"), "table_id", "left")
        grow = F.coalesce(F.col("n_chars") + len(TABLE_START) + len(TABLE_END) - len(TABLE_MARK), F.lit(0))
        found = F.when(F.col("_mark_at") > 0, F.col("_mark_at") - 1 + len(TABLE_START) + F.col("found_at"))
    grown = {c: F.col(c) + F.col(c + "_marks") * grow for c in ("_len", "_lead", "_said", "_stop")}
    sized = sized.withColumns(grown | {"_found": found}).select("conv_id", "i", "role", *grown, "_found")
    placed = prefix_sum(sized, "i", "_len", ["conv_id"], out="_upto")
    start = F.col("_upto") - F.col("_len") + F.col("_lead")
    if s.kind == "llama_3":
        # up to the first separator, be it the message's own or one in a table
        end = start + F.coalesce(F.least("_stop", "_found"), "_said")
    elif s.kind == "single":
        # everything after "Assistant:" up to the next "\nHuman:"
        start = start - 1
        last = sized.groupBy("conv_id").agg(F.max("i").alias("_last"))
        placed = placed.join(last, "conv_id")
        end = F.when(F.col("i") == F.col("_last"), F.col("_upto")).otherwise(F.col("_upto") - len(s.sep))
    elif s.kind == "llama_2":
        end = start + F.col("_said")
    else:
        raise ValueError(f"no supervised spans for style: {s.kind}")
    return placed.where(F.col("role") == "assistant").select(
        "conv_id", "i", start.cast("bigint").alias("start"), end.cast("bigint").alias("end")
    )


def supervised_spans(turns: DataFrame, style_name: str) -> DataFrame:
    s = style(style_name)
    return spans_of(prepare(turns, s), s)


# ------------------------------------------------------------------ tables as text
def _text_blocks(df: DataFrame, columns, row_id, base: int, rows: int) -> DataFrame:
    """table_id, block, _text: the rows of each ``rows`` row ids of a table as text, without the block's end.

    Rows are shuffled once, as their cells' text. Their numbers follow from the rows in earlier
    blocks of the table and the place in the block.
    """
    types = [df.schema[c] for c in columns]
    all_numbers = all(is_numeric(f) for f in types)
    some_float = any(f.dataType.simpleString() not in WHOLE_TYPES for f in types)

    def shown(field):
        c = F.col(field.name)
        if is_numeric(field):
            # a row of numbers only is read as floating point
            whole = field.dataType.simpleString() in WHOLE_TYPES and not (all_numbers and some_float)
            return render_number(c.cast("double"), whole)
        return F.coalesce(c.cast("string"), F.lit("nan"))

    cells = [F.concat(F.lit(f"column {k + base}: "), shown(f)) for k, f in enumerate(types)]
    # the hash comes first, so rows are sorted by it and not by names that begin alike
    block = ["_group", "table_id", "block"]
    rows_of = df.where(F.col("table_id").isNotNull() & F.col(row_id).isNotNull()).select(
        F.xxhash64("table_id").alias("_group"), "table_id", F.floor(F.col(row_id) / rows).alias("block"),
        F.col(row_id).alias("_id"), F.concat_ws(", ", *cells).alias("_cells"),
    )
    earlier = Window.partitionBy("_group", "table_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = rows_of.groupBy(*block).agg(F.count(F.lit(1)).alias("_n")).select(
        *block, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before")
    )
    gathered = rows_of.groupBy(*block).agg(F.sort_array(F.collect_list(F.struct("_id", "_cells"))).alias("_rows"))

    def row_text(row, at):
        number = (F.col("_before") + at + base).cast("string")
        return F.concat(F.lit("Row "), number, F.lit(" - "), row["_cells"])

    # one row per block: small next to the texts, which stay where they are
    placed = gathered.join(before.hint("shuffle_hash"), block)
    return placed.select("table_id", "block", F.array_join(F.transform("_rows", row_text), ". ").alias("_text"))


def table_text_blocks(df: DataFrame, columns, row_id="row_id", base: int = 1, rows: int = TEXT_ROWS, find: str | None = None) -> DataFrame:
    """table_id, block, start, n_chars, found_at, text: the text of each table in blocks of ``rows`` row ids.

    ``Row 1 - column 1: v, column 2: v. Row 2 - ... .`` The blocks of a table, put together in
    order, are its text; ``start`` is a block's place in it, ``found_at`` that of the first ``find``
    in the block. A table of any size passes: what one task holds is a block. The blocks are
    stored, so their places and lengths are read without their texts.
    """
    place = F.instr("_text", find) if find else F.lit(0)
    blocks = store(
        _text_blocks(df, columns, row_id, base, rows).select(
            "table_id", "block", "_text", F.length("_text").alias("_n"), F.when(place > 0, place - 1).alias("_found")
        ), "table_text",
    )
    order = Window.partitionBy("table_id").orderBy("block")
    # stored: its true size then decides whether the texts have to move
    starts = store(
        blocks.select(
            "table_id", "block",
            F.coalesce(F.sum(F.col("_n").cast("bigint") + 2).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("start"),
            F.when(F.lead("block").over(order).isNull(), F.lit(".")).otherwise(F.lit(". ")).alias("_end"),
        ), "text_places",
    )
    return blocks.join(starts, ["table_id", "block"]).select(
        "table_id", "block", "start", (F.col("_n") + F.length("_end")).cast("bigint").alias("n_chars"),
        (F.col("start") + F.col("_found")).alias("found_at"), F.concat("_text", "_end").alias("text"),
    )


def text_sizes(blocks: DataFrame) -> DataFrame:
    """table_id, n_chars, found_at of whole tables; reads no text."""
    return blocks.groupBy("table_id").agg(F.sum("n_chars").alias("n_chars"), F.min("found_at").alias("found_at"))


def join_blocks(blocks: DataFrame, text: str = "text", between: str = "", end: str = "") -> DataFrame:
    """table_id, table_text: one string per table, which has to fit a row."""
    ordered = F.sort_array(F.collect_list(F.struct("block", text)))
    whole = F.concat(F.array_join(F.transform(ordered, lambda b: b[text]), between), F.lit(end))
    return blocks.groupBy("table_id").agg(whole.alias("table_text"))


def table_text(df: DataFrame, columns, row_id="row_id", base: int = 1) -> DataFrame:
    """table_id, table_text: ``Row 1 - column 1: v, column 2: v. Row 2 - ... .``

    One string per table; ``table_text_blocks`` gives the same text in blocks with their places, which this needs not.
    """
    return join_blocks(_text_blocks(df, columns, row_id, base, TEXT_ROWS), "_text", ". ", ".")


def inject_table(turns: DataFrame, texts: DataFrame, column: str = "text") -> DataFrame:
    """Replace every table mark by the text of the row's table.

    Only rows with a mark take part in the join.
    """
    marked = F.col(column).contains(TABLE_MARK)
    # rows without a mark match nothing and are spread by their text
    key = F.when(marked, F.col("table_id")).otherwise(F.xxhash64(column).cast("string"))
    wrapped = texts.select(
        F.col("table_id").alias("_table"),
        F.lit(True).alias("_marked"),
        F.concat(F.lit(TABLE_START), F.col("table_text"), F.lit(TABLE_END)).alias("_text"),
    )
    joined = turns.withColumns({"_table": key, "_marked": marked}).join(wrapped, ["_table", "_marked"], "left")
    filled = F.when(F.col("_text").isNotNull(), F.replace(F.col(column), F.lit(TABLE_MARK), F.col("_text")))
    return joined.withColumn(column, F.coalesce(filled, F.col(column))).drop("_table", "_marked", "_text")


def build_training_text(turns: DataFrame, tables: DataFrame, columns, style_name: str = "llama_3", base: int = 1):
    """(texts, spans): conversations with their tables written in, and the
    supervised spans of those texts. ``turns`` carries table_id."""
    s = style(style_name)
    # tables that no turn names are not written out
    named = store(turns.select("table_id").distinct(), "named_tables")
    blocks = table_text_blocks(tables.join(named, "table_id", "left_semi"), columns, base=base, find=s.sep)
    # turns keep their marks until the end: offsets follow from lengths and mark counts, and each table text is read once
    pieces = store(prepare(turns, s), "pieces")
    texts = inject_table(join_pieces(pieces, ["table_id"]), join_blocks(blocks))
    return texts.select("conv_id", "table_id", "text"), spans_of(pieces, s, text_sizes(blocks))


# ------------------------------------------------------------------ token arrays
def mask_labels(df: DataFrame, ids: str, lead: list[int], end: int) -> DataFrame:
    """``labels``: the ids inside spans that start after each occurrence of
    ``lead`` and stop before the next ``end`` id; -100 elsewhere.

    Span starts and ``end`` ids are events of an automaton with two states, sorted by place (a
    start before an end at the same place). Each event decides the ids up to the next one, so the array
    is cut into as many runs as there are events and put together once.
    """
    a, k = F.col(ids), len(lead)
    wanted = F.array(*[F.lit(x) for x in lead])
    none = F.array().cast("array<int>")
    size = F.size(a)
    begins = F.when(
        size >= k,
        # the first id is compared before a slice is cut
        F.filter(F.sequence(F.lit(0), size - k), lambda i: (F.get(a, i) == lead[0]) & (F.slice(a, i + 1, F.lit(k)) == wanted)),
    ).otherwise(none)
    ends = F.when(size > 0, F.filter(F.sequence(F.lit(0), size - 1), lambda i: F.get(a, i) == end)).otherwise(none)

    def event(place, kind):
        return F.struct(place.alias("at"), F.lit(kind).alias("kind"))

    events = F.array_sort(F.concat(F.transform(begins, lambda i: event(i + k, 0)), F.transform(ends, lambda i: event(i, 1))))

    def ignored(n):
        return F.array_repeat(F.lit(IGNORE), n)

    def runs(found):
        def run(e, j):
            n = F.coalesce(F.get(found, j + 1)["at"], size) - e["at"]
            return F.when(e["kind"] == 0, F.slice(a, e["at"] + 1, n)).otherwise(ignored(n))

        before = F.array(ignored(F.coalesce(F.get(found, F.lit(0))["at"], size)))
        return F.flatten(F.concat(before, F.transform(found, run)))

    return df.withColumn("labels", F.when(a.isNotNull(), let(events, runs)))


def collate(df: DataFrame, order_by, batch: int, pad: int, max_len: int, ids="input_ids") -> DataFrame:
    """Batches of ``batch`` examples in the given order, padded on the right to
    the longest of the batch, cut at ``max_len``, with attention mask."""
    numbered = number_rows(df, order_by, out="seq_no").withColumn("batch_id", F.floor(F.col("seq_no") / batch))
    longest = numbered.groupBy("batch_id").agg(F.max(F.size(ids)).alias("_width"))
    width = F.least(F.col("_width"), F.lit(max_len))

    def padded(c, filler):
        missing = F.greatest(F.col("_width") - F.size(c), F.lit(0))
        return F.slice(F.concat(F.col(c), F.array_repeat(F.lit(filler), missing)), F.lit(1), width)

    out = numbered.join(longest, "batch_id").withColumns({ids: padded(ids, pad), "labels": padded("labels", IGNORE)})
    return out.withColumn("attention_mask", F.transform(ids, lambda x: x != pad)).drop("_width")
