"""Conversations as marked-up text that a parser takes apart again exactly, built from DataFrame functions only.

A turn is rendered as ``<|im_start|>role``, a line break, the text, ``<|im_end|>`` and a line break. A rendered turn is parsed and compared with
its source. If they differ, its content holds control strings or what looks like an escape: it is escaped and rendered
again, after which they are identical. The whole conversation is parsed once more and everything reported is read from that.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

START, END = "<|im_start|>", "<|im_end|>\n"
#: What follows the first letter of a control string, and any number of backslashes, in a text.
_TAIL = r"(\|im_(?:start|end)\|>|/?s>|/?INST\]|/?SYS>>)"
_BARE, _CONTROL, _ESCAPED = rf"[<\[]{_TAIL}", rf"([<\[])(\\*){_TAIL}", rf"([<\[])\\(\\*){_TAIL}"
#: Characters of the pieces a formatted text is cut into when spans are read from it.
_PIECE = 512
#: A conversation whose texts are control strings themselves.
PROBE = "</s>[INST] ok [/INST]"


def escape(text: Column) -> Column:
    """One more backslash behind the first letter of every control string."""
    return F.regexp_replace(text, _CONTROL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, "$1$2$3")


def escape_role(role: Column) -> Column:
    """Line breaks and opening brackets as hexadecimal codes."""
    for c, code in (("%", "%25"), ("\n", "%0A"), ("<", "%3C"), ("[", "%5B")):
        role = F.replace(role, F.lit(c), F.lit(code))
    return role


def unescape_role(role: Column) -> Column:
    for c, code in (("[", "%5B"), ("<", "%3C"), ("\n", "%0A"), ("%", "%25")):
        role = F.replace(role, F.lit(code), F.lit(c))
    return role


def render(role: Column, text: Column) -> Column:
    return F.concat(F.lit(START), role, F.lit("\n"), text, F.lit(END))


def parse(formatted: Column) -> Column:
    """The turns of a formatted text as an array of (role, text).

    A part that opens no turn gives a null role, and a content that holds a control string without a backslash a null text.
    """

    def turn(part: Column) -> Column:
        head = F.substring_index(part, "\n", 1)
        role = F.when(F.startswith(part, F.lit(START)), F.substring(head, len(START) + 1, 1 << 30))
        body = F.substr(part, F.length(head) + 2)
        text = F.when(~F.rlike(body, F.lit(_BARE)), unescape(body))
        return F.struct(unescape_role(role).alias("role"), text.alias("text"))

    parts = F.split(formatted, r"<\|im_end\|>\n", -1)
    return F.transform(F.slice(parts, F.lit(1), F.size(parts) - 1), turn)


def _turn(role: Column, text: Column) -> Column:
    """A turn rendered so that parsing it gives its source."""
    source = F.array(F.struct(role.alias("role"), text.alias("text")))
    plain = render(role, text)
    return F.when(parse(plain) == source, plain).otherwise(render(escape_role(role), escape(text)))


def format_conversations(turns: DataFrame) -> DataFrame:
    """``conv_id, formatted, loss_spans, round_trip`` for every conversation of ``turns`` (conv_id, turn, role, text, any others).

    ``loss_spans`` are the places (start from 0, length) of the assistants' contents in ``formatted``. ``round_trip`` says that the parsed turns are
    those of the table. Rows come in the order of turn, role and text, so ties and repeated rows have one defined result; nulls of any of
    these count as empty and come first. Rows without a conversation id are one conversation.

    A conversation is one value and so at most 2 GB; it is gathered by one shuffle on its id. An empty table gives an empty result.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"))
    rows = rows.withColumn("shown", _turn(F.col("role"), F.col("text")))
    head = F.length(F.substring_index("shown", "\n", 1)) + 1
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    before = F.coalesce(F.sum(F.length("shown").cast("long")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long"))
    span = F.struct((before + head).alias("start"), (F.length("shown") - head - (len(END))).cast("long").alias("length"))
    rows = rows.withColumn("span", F.when(F.col("role") == "assistant", span))
    rows = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text", "shown", "span"))).alias("t"))
    formatted = F.array_join(F.col("t.shown"), "")
    source = F.transform("t", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    spans = F.filter(F.col("t.span"), lambda s: s.isNotNull())
    rows = rows.select("conv_id", formatted.alias("formatted"), source.alias("source"), spans.alias("loss_spans"))
    return rows.select("conv_id", "formatted", "loss_spans", (parse(F.col("formatted")) == F.col("source")).alias("round_trip"))


def masked(formatted: Column, spans: Column) -> Column:
    """The unescaped texts under the spans of a formatted text, joined.

    The text is cut into pieces once and each span is put together from the pieces it touches, so the cost follows the text and not the
    number of spans times its length.
    """

    def cut(pieces: Column) -> Column:
        def under(span: Column) -> Column:
            first, last = (F.floor(at / _PIECE).cast("int") for at in (span["start"], span["start"] + span["length"]))
            touched = F.array_join(F.slice(pieces, first + 1, last - first + 1), "")
            return unescape(F.substr(touched, (span["start"] - first * _PIECE + 1).cast("int"), span["length"].cast("int")))

        return F.array_join(F.transform(spans, under), "")

    pieces = F.regexp_extract_all(formatted, F.lit(r"(?s).{1,%d}" % _PIECE), F.lit(0))
    return F.transform(F.array(pieces), cut)[0]  # an array of one, so that the text is cut once


def digest(formatted: DataFrame) -> DataFrame:
    """``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, round_trip``, all read back from ``formatted``.

    The turns come from parsing it; what the loss is taken over is the text under ``loss_spans``, whatever the turns say.
    """

    def joined(turns: Column, part: Callable[[Column], Column]) -> Column:
        return F.array_join(F.transform(turns, part), "")

    lost = masked(F.col("formatted"), F.col("loss_spans"))
    rows = formatted.select("conv_id", "formatted", "round_trip", parse(F.col("formatted")).alias("turns"), lost.alias("lost"))
    rows = rows.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(joined(F.col("turns"), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), 256).alias("turns_sha256"),
        "lost",
        F.length("formatted").cast("long").alias("formatted_chars"),
        "round_trip",
    )
    return rows.select(
        "conv_id",
        "n_turns",
        "turns_sha256",
        F.length("lost").cast("long").alias("loss_chars"),
        F.sha2("lost", 256).alias("loss_sha256"),
        "formatted_chars",
        "round_trip",
    )


def formatted_conversations(turns: DataFrame) -> DataFrame:
    """The digest of all conversations and of number -1, whose user and assistant both say ``PROBE``."""
    spark = turns.sparkSession
    probe = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(PROBE).alias("text"),
    )
    return digest(format_conversations(turns.select("conv_id", "turn", "role", "text").unionByName(probe)))
