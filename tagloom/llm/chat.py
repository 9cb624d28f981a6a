"""Chat formatting with typed content parts.

A conversation is a set of turns, a turn a role and an ordered array of parts.
Every part is visited once: text is escaped, an image, audio or document part
becomes one placeholder, whose reference and token count go to the attachments.

Escaping puts a backslash behind every ``<`` of a text. Only markers then hold
``<|``, also where one text ends with ``<`` and the next begins with ``|``, and
taking the backslash away gives the text back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
PART = "type string, text string, ref string, width int, height int, seconds double, pages int"


def escape(text: Column) -> Column:
    return F.replace(text, F.lit("<"), F.lit("<\\"))


def unescape(text: Column) -> Column:
    return F.replace(text, F.lit("<\\"), F.lit("<"))


def escape_role(role: Column) -> Column:
    """Roles stand on one line, so their line ends are written out too."""
    for plain, coded in (("%", "%25"), ("\n", "%0A"), ("<", "%3C")):
        role = F.replace(role, F.lit(plain), F.lit(coded))
    return role


def unescape_role(role: Column) -> Column:
    for plain, coded in (("<", "%3C"), ("\n", "%0A"), ("%", "%25")):
        role = F.replace(role, F.lit(coded), F.lit(plain))
    return role


def text_parts(text: Column) -> Column:
    """A plain text as the parts of its turn."""
    fields = {"type": F.lit("text"), "text": F.coalesce(text, F.lit(""))}
    kinds = dict(f.strip().split(" ") for f in PART.split(","))
    return F.array(F.struct(*[fields.get(n, F.lit(None)).cast(k).alias(n) for n, k in kinds.items()]))


def _visit(part: Column, patch: int, audio_rate: float, page_tokens: int) -> Column:
    kind = F.coalesce(part["type"], F.lit("unknown"))
    tiles = F.ceil(part["width"] / patch) * F.ceil(part["height"] / patch)
    tokens = (
        F.when(kind == "image", tiles)
        .when(kind == "audio", F.ceil(part["seconds"] * audio_rate))
        .when(kind == "document", part["pages"].cast("long") * page_tokens)
    )
    known = F.when(kind.isin("image", "audio", "document"), kind).otherwise("unknown")
    return F.struct(
        F.when(kind == "text", escape(F.coalesce(part["text"], F.lit(""))))
        .otherwise(F.concat(F.lit("<|"), known, F.lit("|>")))
        .alias("shown"),
        (kind != "text").alias("attached"),
        known.alias("type"),
        part["ref"].alias("ref"),
        F.greatest(F.coalesce(tokens, F.lit(0)), F.lit(0)).cast("long").alias("tokens"),
    )


def format_chats(
    turns: DataFrame,
    *,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    parts: str = "parts",
    loss_role: str = "assistant",
    patch: int = 14,
    audio_rate: float = 25.0,
    page_tokens: int = 512,
) -> DataFrame:
    """One row per conversation: conv, n_turns, formatted, segments, attachments, media_tokens.

    ``segments`` cut ``formatted`` into template and texts; ``loss`` marks those a model
    learns from. ``attachments`` keep the order of the placeholders; ``tokens`` is what
    a placeholder expands to: tiles of ``patch`` pixels, ``audio_rate`` tokens a second,
    ``page_tokens`` a page, 0 where the size is unknown.

    Null roles, texts and part lists count as empty, an unknown type as ``<|unknown|>``.
    Rows without a conversation form one of their own. Repeated rows are repeated turns;
    equal turn numbers order by role, then by content. Other columns are ignored. A turn
    costs one row in one group: the result is one row per conversation by definition.
    """
    visited = F.transform(F.coalesce(F.col(parts), F.array()), lambda p: _visit(p, patch, audio_rate, page_tokens))
    rows = turns.select(
        F.col(conv).alias("_conv"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        visited.alias("visited"),
    ).select(
        "_conv",
        F.struct(
            "turn",
            "role",
            F.array_join(F.transform("visited", lambda v: v["shown"]), "").alias("body"),
            F.transform(
                F.filter("visited", lambda v: v["attached"]), lambda v: v.dropFields("shown", "attached")
            ).alias("media"),
        ).alias("t"),
    )
    whole = rows.groupBy("_conv").agg(F.sort_array(F.collect_list("t")).alias("turns"))

    def pieces(t: Column) -> Column:
        head = F.concat(F.lit(START), escape_role(t["role"]), F.lit("\n"))
        cut = ((head, F.lit(False)), (t["body"], t["role"] == loss_role), (F.lit(END + "\n"), F.lit(False)))
        return F.array(*[F.struct(text.alias("text"), loss.alias("loss")) for text, loss in cut])

    attachments = F.flatten(
        F.transform("turns", lambda t, i: F.transform(t["media"], lambda m: m.withField("turn", i)))
    )
    return (
        whole.select(
            F.col("_conv").alias(conv),
            F.size("turns").cast("long").alias("n_turns"),
            F.flatten(F.transform("turns", pieces)).alias("segments"),
            attachments.alias("attachments"),
        )
        .withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), ""))
        .withColumn("media_tokens", F.aggregate("attachments", F.lit(0).cast("long"), lambda n, a: n + a["tokens"]))
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation: array of (role, text), unescaped."""
    tail = len(END) + 1

    def turn(piece: Column) -> Column:
        head = F.substring_index(piece, "\n", 1)
        text = F.substring(piece, F.length(head) + 2, F.length(piece) - F.length(head) - 1 - tail)
        return F.struct(unescape_role(head).alias("role"), unescape(text).alias("text"))

    pieces = F.split(formatted, START.replace("|", "\\|"))
    return F.transform(F.slice(pieces, F.lit(2), F.size(pieces) - 1), turn)


def read_loss(segments: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")
