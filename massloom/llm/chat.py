"""Chat formatting with typed content parts, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PARTS = "array<struct<kind:string,text:string,ref:string,units:long>>"
#: Tokens that a placeholder stands for, by unit: tiles of an image, seconds of audio, pages of a document.
TOKENS_PER_UNIT = {"image": 256, "audio": 25, "document": 512}
OPEN, CLOSE = "<turn>", "</turn>\n"


def escape(text: Column) -> Column:
    r"""No control string can stand in the result: every marker begins with ``<``, written ``\l`` in texts."""
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\b")), F.lit("<"), F.lit("\\l"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\l"), F.lit("<")), F.lit("\\b"), F.lit("\\"))


def _escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def _unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("\\n"), F.lit("\n")))


def text_parts(text: Column) -> Column:
    """One text part."""
    return F.array(F.struct(F.lit("text").alias("kind"), text.alias("text"), F.lit(None).cast("string").alias("ref"), F.lit(None).cast("long").alias("units"))).cast(PARTS)


def _is_media(part: Column) -> Column:
    return F.coalesce(part["kind"].isin(*TOKENS_PER_UNIT), F.lit(False))


def _tokens(part: Column) -> Column:
    out = F.lit(0)
    for kind, per in TOKENS_PER_UNIT.items():
        out = F.when(part["kind"] == kind, per * F.greatest(F.coalesce(part["units"], F.lit(1)), F.lit(1))).otherwise(out)
    return out.cast("long")


def _visit(parts: Column, before: Column) -> Column:
    """Each part's output in order: a text escaped, anything attached as ``<kind:number>``."""
    def one(part: Column, at: Column) -> Column:
        number = before + F.size(F.filter(F.slice(parts, 1, at + 1), _is_media))
        return F.when(_is_media(part), F.concat(F.lit("<"), part["kind"], F.lit(":"), number.cast("string"), F.lit(">"))).otherwise(escape(F.coalesce(part["text"], F.lit(""))))

    return F.array_join(F.transform(parts, one), "")


def format_chat(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str | None = "text", parts: str | None = None, loss_role: str = "assistant") -> DataFrame:
    r"""One formatted conversation a row, with its loss mask and its attachments.

    A turn is written ``<turn>role``, newline, body, ``</turn>`` and newline. A visitor flattens the typed parts of a
    turn (column ``parts`` of type ``PARTS``, or ``text`` as one text part) in order: text is escaped, an image,
    audio clip or document becomes a numbered placeholder and is listed under ``attachments`` with its reference,
    its turn and the tokens that the placeholder expands to. ``loss`` lists for each turn of ``loss_role`` its
    number from 0 and the code points (start, end exclusive) of its body in the output.

    Result: conv_id, formatted, n_turns, turn_starts, loss, attachments, expanded_tokens.
    Turns go by ``turn``, nulls first; ties go by role, then by the parts, so repeated rows are turns of their own.
    Null role or text: empty. A part of an unknown or null kind counts as text. Null conv_id is a conversation of
    its own. Units below 1 or null count as 1. An empty table gives no rows.
    """
    content = F.coalesce(F.col(parts).cast(PARTS), F.array().cast(PARTS)) if parts else text_parts(F.coalesce(F.col(text).cast("string"), F.lit("")))
    flat = rows.select(F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"), content.alias("parts"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "parts")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    media = F.filter("parts", _is_media)
    flat = flat.withColumn("media", media).select("*", (F.row_number().over(order) - 1).alias("at"), F.coalesce(F.sum(F.size("media")).over(earlier), F.lit(0)).alias("before"))
    flat = flat.withColumn("body", _visit(F.col("parts"), F.col("before"))).withColumn("head", F.concat(F.lit(OPEN), _escape_role(F.col("role")), F.lit("\n")))
    flat = flat.withColumn("chars", F.char_length("head") + F.char_length("body") + len(CLOSE))
    flat = flat.withColumn("start", F.coalesce(F.sum("chars").over(earlier), F.lit(0)).cast("long"))
    body_at = F.col("start") + F.char_length("head")
    loss = F.when(F.col("role") == loss_role, F.struct(F.col("at").cast("long").alias("turn"), body_at.alias("start"), (body_at + F.char_length("body")).alias("end")))
    listed = F.transform("media", lambda m, k: F.struct((F.col("before") + k + 1).cast("long").alias("number"), m["kind"].alias("kind"), m["ref"].alias("ref"), F.col("at").cast("long").alias("turn"), _tokens(m).alias("tokens")))
    flat = flat.select("conv_id", "at", "start", F.concat("head", "body", F.lit(CLOSE)).alias("out"), loss.alias("loss"), listed.alias("listed"))
    whole = flat.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("at", "start", "out", "loss", "listed"))).alias("turns"))
    attached = F.flatten(F.transform("turns", lambda t: t["listed"]))
    return whole.select(
        "conv_id", F.array_join(F.transform("turns", lambda t: t["out"]), "").alias("formatted"), F.size("turns").cast("long").alias("n_turns"), F.transform("turns", lambda t: t["start"]).alias("turn_starts"),
        F.filter(F.transform("turns", lambda t: t["loss"]), lambda s: s.isNotNull()).alias("loss"), attached.alias("attachments"),
        F.aggregate(attached, F.lit(0).cast("long"), lambda n, a: n + a["tokens"]).alias("expanded_tokens"))


def read_back(formatted: DataFrame) -> DataFrame:
    """The conversations of a ``format_chat`` table, from its text: turns (role, text) in order, and loss_text.

    The text is cut at the turn ends, which no escaped text contains. A loss span is read inside its own turn, so
    a conversation of many turns is read in one pass.
    """
    pieces = F.split("formatted", F.lit(CLOSE), -1)
    cut = formatted.withColumn("pieces", F.slice(pieces, 1, F.size(pieces) - 1))

    def parsed(piece: Column) -> Column:
        head = F.substring_index(piece, "\n", 1)
        return F.struct(_unescape_role(F.substr(head, F.lit(len(OPEN) + 1))).alias("role"), unescape(F.substr(piece, F.char_length(head) + 2)).alias("text"))

    def under(span: Column) -> Column:
        piece, start = F.get("pieces", span["turn"].cast("int")), F.get("turn_starts", span["turn"].cast("int"))
        return unescape(F.substr(piece, (span["start"] - start + 1).cast("int"), (span["end"] - span["start"]).cast("int")))

    return cut.select("conv_id", F.transform("pieces", parsed).alias("turns"), F.array_join(F.transform("loss", under), "").alias("loss_text"), F.char_length("formatted").cast("long").alias("formatted_chars"))
