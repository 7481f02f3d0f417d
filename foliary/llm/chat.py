"""Chat formatting with typed content parts, in DataFrame operations only.

A turn is ``<turn:role>`` + body + ``</turn>`` + newline. Every control string begins with ``<``, and a
text holds none after escaping: ``\\\\`` becomes ``\\\\b`` and ``<`` becomes ``\\\\l`` (in a role also ``>`` becomes
``\\\\g``), which is undone in the reverse order. A part that is no text becomes a placeholder
``<kind:number>``, numbered in order through the conversation, and a row of the attachment list.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliary.llm.frames import column

PART = "struct<kind:string,text:string,ref:string,tokens:long>"
#: Tokens that a placeholder stands for where its part does not say.
DEFAULT_TOKENS = {"image": 256, "audio": 128, "document": 512}
CLOSE = "</turn>\n"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\b")), F.lit("<"), F.lit("\\l"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\l"), F.lit("<")), F.lit("\\b"), F.lit("\\"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit(">"), F.lit("\\g"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("\\g"), F.lit(">")))


def text_part(text: Column) -> Column:
    """A turn's parts when it is one text."""
    return F.array(F.struct(F.lit("text").alias("kind"), text.alias("text"), F.lit(None).cast("string").alias("ref"),
                            F.lit(None).cast("long").alias("tokens")))


def _is_attachment(part: Column) -> Column:
    return F.coalesce(part["kind"].isin(*DEFAULT_TOKENS), F.lit(False))


def _placeholder(part: Column, number: Column) -> Column:
    return F.concat(F.lit("<"), part["kind"], F.lit(":"), number.cast("string"), F.lit(">"))


def format_conversations(
    turns: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    parts: str | None = None, learned: str = "assistant",
) -> DataFrame:
    """``conv_id, formatted, loss, attachments, expanded_tokens``: one row per conversation.

    ``parts`` names a column of ``array<struct<kind, text, ref, tokens>>``; without it each row's ``text`` is
    its only part. Kinds image, audio and document are attachments; every other kind, null too, is text.
    ``loss`` lists the learned spans, one per text part of a learned role: the turn's number from 0, the
    start in its body, the start in ``formatted``, and the length, all in code points. ``attachments``
    lists number, turn, kind, ref and tokens (the part's, or the kind's default).

    Turns are in order of ``turn``, nulls first; equal ones by role and text. Null texts, refs and roles
    count as empty, null conversation ids as one conversation, null part lists as no parts. Offsets are
    running sums, so a conversation of many turns costs in proportion to its length. No rows, no result.
    """
    given = F.col("parts")
    own = turns.select(
        column(turns, conversation).alias("conv_id"), column(turns, turn).alias("turn"),
        F.coalesce(column(turns, role), F.lit("")).alias("role"),
        (text_part(column(turns, text)) if parts is None else F.coalesce(column(turns, parts), F.array())).cast(
            f"array<{PART}>").alias("parts"))
    order = Window.partitionBy("conv_id").orderBy(
        F.col("turn").asc_nulls_first(), "role", F.to_json(F.struct("parts")) if parts else F.col("parts")[0]["text"])
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    number = F.coalesce(F.sum(F.size(F.filter(given, _is_attachment))).over(before), F.lit(0))
    own = own.withColumns({"n": F.row_number().over(order) - 1, "numbered": number})

    def render(part: Column, i: Column) -> Column:
        earlier = F.size(F.filter(F.slice(given, F.lit(1), i + 1), _is_attachment))
        return F.when(_is_attachment(part), _placeholder(part, F.col("numbered") + earlier)).otherwise(
            escape(F.coalesce(part["text"], F.lit(""))))

    own = own.withColumn("pieces", F.transform(given, render))
    own = own.withColumn("opening", F.concat(F.lit("<turn:"), escape_role(F.col("role")), F.lit(">")))
    own = own.withColumn("segment", F.concat(F.col("opening"), F.array_join("pieces", ""), F.lit(CLOSE)))
    own = own.withColumn("at", F.coalesce(F.sum(F.length("segment").cast("long")).over(before), F.lit(0)))

    def span(piece: Column, i: Column) -> Column:
        start = F.length(F.array_join(F.slice("pieces", F.lit(1), i), ""))
        return F.struct(
            F.col("n").alias("turn"), start.alias("start"),
            (F.col("at") + F.length("opening") + start).alias("at"), F.length(piece).alias("length"),
            _is_attachment(F.element_at(given, i + 1)).alias("skip"))

    spans = F.filter(F.transform("pieces", span), lambda s: ~s["skip"])
    spans = F.transform(spans, lambda s: F.struct(s["turn"].alias("turn"), s["start"].alias("start"), s["at"].alias("at"), s["length"].alias("length")))

    def attachment(part: Column, i: Column) -> Column:
        default = F.lit(0)
        for kind, tokens in DEFAULT_TOKENS.items():
            default = F.when(part["kind"] == kind, tokens).otherwise(default)
        earlier = F.size(F.filter(F.slice(given, F.lit(1), i + 1), _is_attachment))
        return F.struct(
            (F.col("numbered") + earlier).cast("long").alias("number"), F.col("n").alias("turn"), part["kind"].alias("kind"),
            F.coalesce(part["ref"], F.lit("")).alias("ref"), F.coalesce(part["tokens"], default.cast("long")).alias("tokens"))

    files = F.filter(F.transform(given, attachment), lambda a: a["kind"].isin(*DEFAULT_TOKENS))
    own = own.select("conv_id", F.struct(
        "n", "segment", F.when(F.col("role") == learned, spans).otherwise(F.filter(spans, lambda s: F.lit(False))).alias("loss"),
        files.alias("files")).alias("turn"))
    whole = own.groupBy("conv_id").agg(F.array_sort(F.collect_list("turn")).alias("turns"))
    attachments = F.flatten(F.transform("turns", lambda t: t["files"]))
    return whole.select(
        "conv_id", F.array_join(F.transform("turns", lambda t: t["segment"]), "").alias("formatted"),
        F.flatten(F.transform("turns", lambda t: t["loss"])).alias("loss"), attachments.alias("attachments"),
        F.aggregate(F.transform(attachments, lambda a: a["tokens"]), F.lit(0).cast("long"), lambda n, x: n + x).alias("expanded_tokens"))


def segments_of(formatted: Column) -> Column:
    """The turns of a formatted conversation, still escaped: ``array<struct<role, body>>``."""
    pieces = F.split(formatted, CLOSE.replace("\n", "\\n"))
    whole = F.slice(pieces, F.lit(1), F.size(pieces) - 1)
    opening = F.lit(len("<turn:"))
    return F.transform(whole, lambda s: F.struct(
        F.substring(s, opening + 1, F.locate(">", s) - opening - 1).alias("role"),
        F.substring(s, F.locate(">", s) + 1, F.length(s)).alias("body")))


def read_turns(formatted: Column) -> Column:
    """``array<struct<role, text>>`` back from a formatted conversation, placeholders left in place."""
    return F.transform(segments_of(formatted), lambda s: F.struct(
        unescape_role(s["role"]).alias("role"), unescape(s["body"]).alias("text")))


def learned_text(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between the spans."""
    turns = segments_of(formatted)
    return F.array_join(F.transform(loss, lambda s: unescape(F.substring(
        F.element_at(turns, s["turn"] + 1)["body"], s["start"] + 1, s["length"]))), "")


def digests(formatted: DataFrame) -> DataFrame:
    """Digest columns of formatted conversations, all read back from the output."""
    read = formatted.select("conv_id", "formatted", "loss", segments_of(F.col("formatted")).alias("turns"))
    text = F.array_join(F.transform("turns", lambda t: F.concat(
        unescape_role(t["role"]), F.lit("\n"), unescape(t["body"]), F.lit("\n"))), "")
    bodies = F.array_join(F.transform("loss", lambda s: unescape(F.substring(
        F.element_at(F.col("turns"), s["turn"] + 1)["body"], s["start"] + 1, s["length"]))), "")
    read = read.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(text, 256).alias("turns_sha256"),
                       bodies.alias("bodies"), F.length("formatted").cast("long").alias("formatted_chars"))
    return read.select(
        "conv_id", "n_turns", "turns_sha256", F.length("bodies").cast("long").alias("loss_chars"),
        F.sha2("bodies", 256).alias("loss_sha256"), "formatted_chars")
