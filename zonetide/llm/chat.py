"""Chat formatting over typed content parts.

A message's content is an array of parts: text, image, audio or document.  A visitor
flattens each message to one body in which every other part has become a placeholder,
and records the attachments behind the placeholders in order, with the number of tokens
that each placeholder expands to.  The template marks turns with control strings; in texts
and roles the characters that control strings start with are written as escapes, so that no
control string can come from a text, and ``unescape`` gives back the text exactly.

    <s>ROLE[TEXT]BODY</s>

A conversation comes out as ``pieces`` (text, loss) in order: the formatted conversation is
their concatenation, and the loss mask covers the pieces with ``loss``, which are the bodies
of assistant turns.  ``loss_spans`` holds the same mask as character offsets.

Turns are put in order in one shuffle by conversation.  A conversation is one output text,
so its turns do meet in one row; nothing larger does.

Defined results: rows by turn, null first, equal turns by role and text; null texts, roles
and parts are empty; null ids make one conversation; repeated rows stay, as turns of their
own; an empty table gives no conversation; other columns are ignored.

Only DataFrame functions run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

#: Fixed values of the template.
TURN, BODY, END = "<s>", "[TEXT]", "</s>"
#: Written for \, < and [ inside texts: a backslash is always followed by its digit.
ESCAPES = (("\\", "\\0"), ("<", "\\1"), ("[", "\\2"))
PLACEHOLDERS = {"image": "<image>", "audio": "<audio>", "document": "<document>"}
PATCH, PATCHES_MAX = 14, 4096
AUDIO_TOKENS_PER_SECOND = 25
DOCUMENT_TOKENS_PER_PAGE = 256

PART = "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"


def escape(text: Column) -> Column:
    for raw, written in ESCAPES:
        text = F.replace(text, F.lit(raw), F.lit(written))
    return text


def unescape(text: Column) -> Column:
    for raw, written in reversed(ESCAPES):
        text = F.replace(text, F.lit(written), F.lit(raw))
    return text


def text_part(text: Column) -> Column:
    """A message that is a plain text, as typed content."""
    return F.array(F.struct(F.lit("text").alias("type"), text.alias("text"))).cast("array<struct<type:string,text:string>>")


def _field(part: Column, fields: set[str], name: str, kind: str) -> Column:
    return part.getField(name).cast(kind) if name in fields else F.lit(None).cast(kind)


def part_text(part: Column, fields: set[str]) -> Column:
    """What a part leaves in the body; unknown kinds are visited as text."""
    shown = escape(F.coalesce(_field(part, fields, "text", "string"), F.lit("")))
    for kind, mark in PLACEHOLDERS.items():
        shown = F.when(part.getField("type") == kind, F.lit(mark)).otherwise(shown)
    return F.coalesce(shown, F.lit(""))


def part_tokens(part: Column, fields: set[str]) -> Column:
    """Tokens a placeholder expands to: image patches, audio frames, document pages."""
    side = lambda n: F.ceil(F.greatest(F.coalesce(_field(part, fields, n, "int"), F.lit(PATCH)), F.lit(1)) / PATCH)
    image = F.least(side("width") * side("height"), F.lit(PATCHES_MAX).cast("long"))
    audio = F.ceil(F.coalesce(_field(part, fields, "seconds", "double"), F.lit(0.0)) * AUDIO_TOKENS_PER_SECOND)
    pages = F.coalesce(_field(part, fields, "pages", "int"), F.lit(1)) * DOCUMENT_TOKENS_PER_PAGE
    kind = part.getField("type")
    return F.when(kind == "image", image).when(kind == "audio", audio).when(kind == "document", pages.cast("long"))


def visited(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, role, content) flattened: escaped role, body, attachments."""
    fields = set(messages.schema["content"].dataType.elementType.names)
    parts = F.coalesce(F.col("content"), F.array().cast(messages.schema["content"].dataType))
    body = F.array_join(F.transform(parts, lambda p: part_text(p, fields)), "")
    marked = F.filter(parts, lambda p: p.getField("type").isin(*PLACEHOLDERS))
    attached = F.transform(
        marked,
        lambda p: F.struct(
            p.getField("type").alias("type"),
            _field(p, fields, "ref", "string").alias("ref"),
            part_tokens(p, fields).alias("tokens"),
        ),
    )
    role = F.coalesce(F.col("role"), F.lit(""))
    return messages.select("conv_id", "turn", role.alias("role"), body.alias("body"), attached.alias("attachments"))


def format_chats(messages: DataFrame) -> DataFrame:
    """One row per conversation: formatted, pieces, loss_spans, attachments, extra_tokens."""
    turns = visited(messages)
    loss = F.col("role") == "assistant"
    head = F.concat(F.lit(TURN), escape(F.col("role")), F.lit(BODY))
    turns = turns.select("conv_id", "turn", "role", "body", "attachments", loss.alias("loss"), head.alias("head"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "body", "attachments")
    long = F.length("head") + F.length("body") + F.lit(len(END))
    turns = turns.withColumns(
        {
            "n": F.row_number().over(order),
            "start": F.sum(long.cast("long")).over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.length("body") - len(END),
        }
    )
    one = F.struct("n", "head", "body", "loss", "start", "attachments")
    chats = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(one)).alias("t"))
    piece = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
    pieces = F.flatten(
        F.transform("t", lambda t: F.array(piece(t.head, F.lit(False)), piece(t.body, t.loss), piece(F.lit(END), F.lit(False))))
    )
    spans = F.transform(
        F.filter("t", lambda t: t.loss),
        lambda t: F.struct(t.start.alias("start"), (t.start + F.length(t.body)).alias("end")),
    )
    attached = F.flatten(F.transform("t", lambda t: t.attachments))
    chats = chats.select("conv_id", pieces.alias("pieces"), spans.alias("loss_spans"), attached.alias("attachments"))
    tokens = F.aggregate(
        F.col("attachments"), F.lit(0).cast("long"), lambda s, a: s + F.coalesce(a.tokens - 1, F.lit(0)).cast("long")
    )
    formatted = F.array_join(F.transform("pieces", lambda p: p.text), "")
    return chats.select("conv_id", formatted.alias("formatted"), "pieces", "loss_spans", "attachments", tokens.alias("extra_tokens"))


def read_turns(formatted: Column) -> Column:
    """The turns (role, text) of a formatted text, unescaped."""
    raw = F.filter(F.split(formatted, TURN), lambda _, i: i > 0)
    return F.transform(
        raw,
        lambda t: F.struct(
            unescape(F.substring_index(t, BODY, 1)).alias("role"),
            unescape(F.regexp_extract(t, r"(?s)^[^\[]*\[TEXT\](.*)</s>$", 1)).alias("text"),
        ),
    )


def op4_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    rows = common.table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(said).alias("text"),
    )
    rows = rows.unionByName(extra)
    chats = format_chats(rows.select("conv_id", "turn", "role", text_part(F.col("text")).alias("content")))
    turns = read_turns(F.col("formatted"))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), "")
    learned = unescape(F.array_join(F.transform(F.filter("pieces", lambda p: p.loss), lambda p: p.text), ""))
    chats = chats.select("conv_id", "formatted", turns.alias("turns"), learned.alias("learned"))
    return chats.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(told, 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
