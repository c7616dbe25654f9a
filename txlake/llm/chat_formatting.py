"""Chat formatting with typed content parts, in DataFrame functions alone.

A message is a list of parts: text, image, audio or document. A visitor flattens them in
order: text is escaped and written out, any other part becomes a numbered placeholder and
is recorded as an attachment with its reference and the tokens it expands to. The template
marks turns; a mask of character spans says which text the loss covers.

Template of a turn, where ``{...}`` is escaped::

    <turn>{role}
    {content}</turn>

In a text, a backslash is written ``\\b`` and ``<`` is written ``\\l``; in a role, a line
feed is also written ``\\n``. So ``<`` only stands in control strings, none of which can come
from a text or a role, and plain replacements give back what was escaped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TURN, END, HEAD_END = "<turn>", "</turn>\n", "\n"
TRAINED_ROLE = "assistant"

#: What parts expand to. Images are cut into tiles of this many pixels a
#: side, audio into frames of this many milliseconds, documents count tokens for each page.
TILE_PIXELS, FRAME_MILLIS, PAGE_TOKENS = 28, 40, 512

#: Characters of a piece in which spans are looked up.
PIECE_CHARS = 1024

PART_TYPE = (
    "struct<type:string, text:string, ref:string, width:int, height:int, "
    "millis:bigint, pages:int>"
)


def text_part(text: Column) -> Column:
    """A text part; the other fields are null."""
    return F.struct(
        F.lit("text").alias("type"),
        text.cast("string").alias("text"),
        F.lit(None).cast("string").alias("ref"),
        F.lit(None).cast("int").alias("width"),
        F.lit(None).cast("int").alias("height"),
        F.lit(None).cast("bigint").alias("millis"),
        F.lit(None).cast("int").alias("pages"),
    )


def escape(text: Column) -> Column:
    known = F.coalesce(text, F.lit(""))
    return F.replace(F.replace(known, F.lit("\\"), F.lit("\\b")), F.lit("<"), F.lit("\\l"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\l"), F.lit("<")), F.lit("\\b"), F.lit("\\"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("\\n"), F.lit("\n")))


def expanded_tokens(part: Column) -> Column:
    """Tokens that the placeholder of a part stands for; a missing size counts as zero."""
    width, height = (F.coalesce(part[c], F.lit(0)) for c in ("width", "height"))
    tiles = F.ceil(width / TILE_PIXELS) * F.ceil(height / TILE_PIXELS)
    frames = F.ceil(F.coalesce(part["millis"], F.lit(0)) / FRAME_MILLIS)
    pages = F.coalesce(part["pages"], F.lit(0)).cast("bigint") * PAGE_TOKENS
    return (
        F.when(part["type"] == "image", tiles)
        .when(part["type"] == "audio", frames)
        .when(part["type"] == "document", pages)
        .otherwise(0)
        .cast("bigint")
    )


def is_text(part: Column) -> Column:
    """A part without a type is text, and so is one of a type that is not known."""
    known = F.coalesce(part["type"].isin("image", "audio", "document"), F.lit(False))
    return ~known


def format_conversations(
    messages: DataFrame, parts: str | None = None, trained_role: str = TRAINED_ROLE
) -> DataFrame:
    """One row for each ``conv_id`` of messages (``conv_id``, ``turn``, ``role``, ``text``).

    ``parts`` names a column of typed parts (``array<PART_TYPE>``) that takes the place of
    ``text``. Turns come by ``turn``, nulls first; of equal turns the order is that of role
    and content, and repeated rows are turns of their own. Null texts, roles and lists of
    parts count as empty. Messages without ``conv_id`` form one conversation without id.
    Other columns are ignored. A conversation is one value and so is gathered in one task.

    Columns: ``conv_id``, ``n_turns``, ``formatted``, ``loss_spans`` (start and length in
    characters of the trained content as it stands in ``formatted``), ``attachments``
    (number, type, ref, turn position, tokens) and ``expanded_tokens``, their sum.
    """
    content = F.array(text_part(F.col("text"))) if parts is None else F.col(parts)
    rows = messages.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(content, F.array().cast(f"array<{PART_TYPE}>")).alias("parts"),
    )
    # What came before a turn is counted over the sorted rows, before a conversation is one
    # value; so a turn costs its own length, however many there are.
    in_order = Window.partitionBy("conv_id").orderBy("turn", "role", "parts")
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    found = F.transform(
        F.filter("parts", lambda p: ~is_text(p)),
        lambda p: F.struct(
            p["type"].alias("type"), p["ref"].alias("ref"), expanded_tokens(p).alias("tokens")
        ),
    )
    visited = (
        rows.withColumn("found", found)
        .withColumns(
            {
                "position": (F.row_number().over(in_order) - 1).cast("bigint"),
                "seen": F.coalesce(F.sum(F.size("found")).over(before), F.lit(0)).cast("bigint"),
            }
        )
        .select(
            "conv_id",
            "position",
            "seen",
            "found",
            F.concat(F.lit(TURN), escape_role(F.col("role")), F.lit(HEAD_END)).alias("head"),
            _written(F.col("parts"), F.col("seen")).alias("body"),
            (F.col("role") == trained_role).alias("trained"),
        )
    )
    chars = F.length("head") + F.length("body") + len(END)
    by_position = Window.partitionBy("conv_id").orderBy("position")
    earlier = by_position.rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(chars).over(earlier), F.lit(0)) + F.length("head")
    talks = (
        visited.withColumn("start", start)
        .groupBy("conv_id")
        .agg(
            F.sort_array(
                F.collect_list(
                    F.struct("position", "seen", "found", "head", "body", "trained", "start")
                )
            ).alias("turns")
        )
    )
    attachments = F.flatten(
        F.transform(
            "turns",
            lambda t: F.transform(
                t["found"],
                lambda a, k: F.struct(
                    (t["seen"] + k + 1).cast("bigint").alias("number"),
                    t["position"].alias("turn"),
                    a["type"].alias("type"),
                    a["ref"].alias("ref"),
                    a["tokens"].alias("tokens"),
                ),
            ),
        )
    )
    return talks.withColumn("attachments", attachments).select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.array_join(
            F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(END))), ""
        ).alias("formatted"),
        F.transform(
            F.filter("turns", lambda t: t["trained"]),
            lambda t: F.struct(
                t["start"].cast("bigint").alias("start"),
                F.length(t["body"]).cast("bigint").alias("length"),
            ),
        ).alias("loss_spans"),
        "attachments",
        F.aggregate(
            "attachments", F.lit(0).cast("bigint"), lambda total, a: total + a["tokens"]
        ).alias("expanded_tokens"),
    )


def _written(parts: Column, seen: Column) -> Column:
    """The visitor: a turn's parts in order, of which ``seen`` attachments came earlier."""

    def placeholder(part: Column, number: Column) -> Column:
        return F.concat(F.lit("<"), part["type"], F.lit(":"), number.cast("string"), F.lit(">"))

    return F.aggregate(
        parts,
        F.struct(F.lit("").alias("out"), seen.alias("seen")),
        lambda state, part: F.when(
            is_text(part),
            F.struct(
                F.concat(state["out"], escape(part["text"])).alias("out"),
                state["seen"].alias("seen"),
            ),
        ).otherwise(
            F.struct(
                F.concat(state["out"], placeholder(part, state["seen"] + 1)).alias("out"),
                (state["seen"] + 1).alias("seen"),
            )
        ),
        lambda state: state["out"],
    )


def parse_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation: array of (role, content), unescaped.

    Placeholders stay in the content as they are written.
    """
    turns = F.split(formatted, END)  # END has no special characters
    turns = F.slice(turns, F.lit(1), F.size(turns) - 1)
    return F.transform(
        turns,
        lambda t: F.struct(
            unescape_role(
                F.substring(
                    F.substring_index(t, HEAD_END, 1), F.lit(len(TURN) + 1), F.length(t)
                )
            ).alias("role"),
            unescape(F.substring(t, F.instr(t, HEAD_END) + 1, F.length(t))).alias("content"),
        ),
    )


def masked_text(formatted: Column, loss_spans: Column) -> Column:
    """All text under the loss mask, unescaped, with nothing between the spans.

    The text is cut once into pieces of equal numbers of characters, and a span is read from
    the pieces it lies in; to count characters from the front for each span would take the
    square of a long conversation.
    """
    pieces = F.regexp_extract_all(formatted, F.lit(f"(?s).{{1,{PIECE_CHARS}}}"), F.lit(0))

    def read(held: Column, span: Column) -> Column:
        first = F.floor(span["start"] / PIECE_CHARS).cast("int")
        last = F.floor((span["start"] + span["length"]) / PIECE_CHARS).cast("int")
        near = F.array_join(F.slice(held, first + 1, last - first + 1), "")
        at = (span["start"] - first * PIECE_CHARS + 1).cast("int")
        return unescape(F.substring(near, at, span["length"].cast("int")))

    # As the element of an array the pieces are made once, not for each span.
    read_all = F.transform(
        F.array(pieces),
        lambda held: F.array_join(F.transform(loss_spans, lambda s: read(held, s)), ""),
    )
    return F.get(read_all, F.lit(0))


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of formatted conversations, from nothing but what was written."""
    turns = parse_turns(F.col("formatted"))
    loss = masked_text(F.col("formatted"), F.col("loss_spans"))
    said = F.array_join(
        F.transform(
            turns,
            lambda t: F.concat(t["role"], F.lit("\n"), t["content"], F.lit("\n")),
        ),
        "",
    )
    return formatted.select(
        "conv_id",
        F.size(turns).cast("bigint").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length(loss).cast("bigint").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )
