"""Chat formatting with Spark expressions only.

One row per turn goes in; one row per conversation comes out: ``formatted`` text, the merged
``messages`` it was made of, and ``loss_spans`` (start and length in code points of every assistant
text inside ``formatted``). Rows are collected per conversation, sorted, and adjacent rows of one
role become one message whose texts stand in a single block, kept apart by a seam marker::

    <|im_start|>ROLE\\nTEXT[<|im_more|>TEXT ...]<|im_end|>\\n

Control strings inside texts cannot be mistaken for marks: every backslash becomes two and every
``<|`` becomes ``<\\|`` (in roles, a line feed gets a backslash before it too). Unescaping drops
each backslash and keeps what follows it, so ``parse`` gives back every row exactly.

Defined results: null text or role counts as empty; rows sort by (turn, role, text), nulls first, so
ties and repeated rows have one fixed order and repeated rows all stay; a null conv_id is one
conversation of its own; an empty table gives no rows; other columns are ignored. A conversation is
one output value, so its rows meet in one task: its text, four bytes to a character, is bounded by what one value can hold.
Time is in proportion to a conversation's rows and text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END, MORE = "<|im_start|>", "<|im_end|>", "<|im_more|>"
#: Pieces whose lengths are summed, and spans appended, at a time.
BLOCK = 256


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\\n"))


def _runs(turns: Column) -> Column:
    """Indexes at which a message starts: the first row, and each row whose role differs from the one before."""
    return F.filter(
        F.transform(turns, lambda _, i: i),
        lambda i: (i == 0) | (F.get(turns, i)["role"] != F.get(turns, i - 1)["role"]),
    )


def format_conversations(
    rows: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    loss_role: str = "assistant",
) -> DataFrame:
    """(conv, messages, formatted, loss_spans) per conversation; see the module for the template."""
    empty = F.lit("")
    cells = F.struct(F.col(turn).alias("turn"), F.coalesce(F.col(role), empty).alias("role"), F.coalesce(F.col(text), empty).alias("text"))
    turns, starts = F.col("_turns"), F.col("_starts")
    grouped = rows.groupBy(F.col(conv).alias(conv)).agg(F.array_sort(F.collect_list(cells)).alias("_turns"))
    merged = grouped.withColumn("_starts", _runs(turns)).select(
        conv,
        F.transform(
            starts,
            lambda s, j: F.struct(
                F.get(turns, s)["role"].alias("role"),
                # By index: a slice inside a lambda would copy the whole array first.
                F.transform(F.sequence(s, F.coalesce(F.get(starts, j + 1), F.size(turns)) - 1), lambda i: F.get(turns, i)["text"]).alias("texts"),
            ),
        ).alias("messages"),
    )
    # One piece per row: what stands before its text, the text itself, and whether it is trained on.
    piece = lambda m, j: F.transform(
        m["texts"],
        lambda x, k: F.struct(
            F.when(k > 0, MORE)
            .otherwise(F.concat(F.when(j > 0, END + "\n").otherwise(""), F.lit(START), _escape_role(m["role"]), F.lit("\n")))
            .alias("mark"),
            escape(x).alias("body"),
            (m["role"] == loss_role).alias("loss"),
        ),
    )
    pieces = F.col("_pieces")
    cut = merged.withColumn("_pieces", F.flatten(F.transform(F.col("messages"), piece))).select(
        conv,
        "messages",
        F.concat(F.array_join(F.transform(pieces, lambda p: F.concat(p["mark"], p["body"])), ""), F.lit(END + "\n")).alias("formatted"),
        F.transform(pieces, lambda p: F.struct(F.length(p["mark"]).alias("mark"), F.length(p["body"]).alias("body"), p["loss"].alias("loss"))).alias("_sizes"),
    )
    return cut.withColumn("_before", _before(F.col("_sizes"))).select(conv, "messages", "formatted", _spans(F.col("_sizes"), F.col("_before")).alias("loss_spans"))


def _blocks(sizes: Column) -> Column:
    return F.sequence(F.lit(0), F.size(sizes) - 1, F.lit(BLOCK))


def _places(sizes: Column, block: Column) -> Column:
    return F.sequence(block, F.least(block + BLOCK, F.size(sizes)) - 1)


def _before(sizes: Column) -> Column:
    """Code points before each block of pieces: the prefix sums of the blocks' lengths."""
    length = lambda i: F.get(sizes, i)["mark"] + F.get(sizes, i)["body"]
    totals = F.transform(_blocks(sizes), lambda b: F.aggregate(_places(sizes, b), F.lit(0), lambda a, i: a + length(i)))
    none = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<int>)").alias("all"))
    return F.aggregate(totals, none, lambda a, n: F.struct((a["at"] + n).alias("at"), F.concat(a["all"], F.array(a["at"])).alias("all")))["all"]


def _spans(sizes: Column, before: Column) -> Column:
    """Start and length of every loss text: each block of pieces appends its own, from the block's prefix sum on."""

    def block(at: Column, k: Column) -> Column:
        none = F.struct((at + 1).alias("at"), F.expr("cast(array() as array<struct<start:int,length:int>>)").alias("spans"))

        def add(a: Column, i: Column) -> Column:
            size = F.get(sizes, i)
            own = F.array(F.struct((a["at"] + size["mark"]).alias("start"), size["body"].alias("length")))
            return F.struct((a["at"] + size["mark"] + size["body"]).alias("at"), F.when(size["loss"], F.concat(a["spans"], own)).otherwise(a["spans"]).alias("spans"))

        return F.aggregate(_places(sizes, k * BLOCK), none, add)["spans"]

    return F.flatten(F.transform(before, block))


def parse(formatted: Column) -> Column:
    """The rows of a formatted text: array of (role, text), read from the marks alone."""
    blocks = F.filter(F.split(formatted, r"<\|im_end\|>\n"), lambda b: b != "")

    def turns(block: Column) -> Column:
        # The role ends at the first line feed that is not the escaped one (backslash, line feed).
        head = F.regexp_extract(block, r"(?s)^<\|im_start\|>((?:\\.|[^\\\n])*)\n", 1)
        body = F.substr(block, F.length(head) + F.lit(len(START) + 2))
        return F.transform(F.split(body, r"<\|im_more\|>"), lambda t: F.struct(unescape(head).alias("role"), unescape(t).alias("text")))

    return F.flatten(F.transform(blocks, turns))


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped and end to end.

    It is cut from four-byte characters, since finding a place in UTF-8 text means reading all before it. Each cut begins one
    character early, at the end of a mark: a byte order mark at the head of what is decoded would get lost.
    """
    wide = F.array(F.encode(formatted, "UTF-32"))
    cut = lambda w, s: F.decode(F.substring(w, s["start"] * 4 - 7, (s["length"] + 1) * 4), "UTF-32")
    return F.get(F.transform(wide, lambda w: F.array_join(F.transform(spans, lambda s: unescape(F.substr(cut(w, s), F.lit(2)))), "")), F.lit(0))
