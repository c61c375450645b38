"""Chat formatting: turns to one training string per conversation, and back, in native expressions.

A conversation is written as blocks, one per run of turns of the same role::

    [INST]role[/INST]text</s>text</s>[INST]role[/INST]text</s>

Adjacent turns of one role share a header; every turn keeps its own end mark, so that the
original turns can be read back.  A control string inside a text or a role gets a backslash
behind its first character (``<\\/s>``); one that already has backslashes there gets one more,
so nothing is lost and no text holds a bare control string.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skybasin.llm.common import text_of

HEAD, HEAD_END, TURN_END = "[INST]", "[/INST]", "</s>"
#: Turns whose places are added up at once.
CHUNK = 256
#: A control string with any number of backslashes behind its first character.
_ESCAPE = r"([<\[])(\\*/?(?:s>|INST\]))"
_UNESCAPE = r"([<\[])\\(\\*/?(?:s>|INST\]))"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPE, r"$1\\$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _UNESCAPE, "$1$2")


def format_conversations(
    turns: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    learn_from: str = "assistant",
) -> DataFrame:
    """One row per conversation: ``conv_id, formatted, loss_spans``.

    ``loss_spans`` are the byte ranges (start, length in the UTF-8 form of ``formatted``) of the
    texts of role ``learn_from``, one per turn, in order.  Rows are ordered by turn, then role,
    then text, so ties and repeated rows have one order and all stay.  A null turn comes first,
    a null role or text is empty, rows with a null conversation form one conversation.  An empty
    table gives no rows.  Other columns are not read, whatever their names.
    """
    rows = turns.select(
        F.col(conversation).alias("conv_id"),
        F.struct(
            F.col(turn).alias("turn"),
            F.coalesce(F.col(role), F.lit("")).alias("role"),
            text_of(text).alias("text"),
        ).alias("turn"),
    )
    sorted_turns = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("turn")).alias("turns"))

    # A block starts where the role differs from that of the turn before.
    marked = sorted_turns.select(
        "conv_id",
        F.transform(
            F.arrays_zip(
                F.col("turns").alias("now"),
                F.concat(F.array(F.lit(None).cast("string")), F.col("turns.role")).alias("before"),
            ),
            lambda x: F.struct(
                (x["now"]["role"] == F.lit(learn_from)).alias("learnt"),
                F.when(
                    x["before"].isNull() | (x["before"] != x["now"]["role"]),
                    F.concat(F.lit(HEAD), escape(x["now"]["role"]), F.lit(HEAD_END)),
                )
                .otherwise(F.lit(""))
                .alias("head"),
                escape(x["now"]["text"]).alias("body"),
                x["now"].isNotNull().alias("real"),
            ),
        ).alias("parts"),
    ).select("conv_id", F.filter("parts", lambda x: x["real"]).alias("parts"))

    nothing = F.struct(
        F.lit(0).cast("bigint").alias("at"),
        F.array().cast("array<struct<start:bigint,length:bigint>>").alias("spans"),
    )

    def step(done: Column, part: Column) -> Column:
        start = done["at"] + F.octet_length(part["head"])
        length = F.octet_length(part["body"]).cast("bigint")
        span = F.struct(start.alias("start"), length.alias("length"))
        return F.struct(
            (start + length + F.lit(len(TURN_END))).alias("at"),
            F.when(part["learnt"], F.concat(done["spans"], F.array(span)))
            .otherwise(done["spans"])
            .alias("spans"),
        )

    # Spans of CHUNK turns from the chunk's start, then the starts of the chunks: a list that grows is copied
    # for every turn, so no list gets longer than a chunk or than there are chunks.
    count = F.ceil(F.size("parts") / CHUNK).cast("int")
    chunks = F.transform(
        F.sequence(F.lit(0), count - 1),
        lambda k: F.aggregate(F.slice("parts", k * CHUNK + 1, F.lit(CHUNK)), nothing, step),
    )
    placed = marked.select("conv_id", "parts", chunks.alias("chunks")).select(
        "conv_id",
        "parts",
        "chunks",
        F.aggregate(
            "chunks",
            F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<bigint>").alias("starts")),
            lambda done, chunk: F.struct(
                (done["at"] + chunk["at"]).alias("at"), F.concat(done["starts"], F.array(done["at"])).alias("starts")
            ),
            lambda done: done["starts"],
        ).alias("starts"),
    )
    spans = F.transform(
        F.arrays_zip("chunks", "starts"),
        lambda x: F.transform(
            x["chunks"]["spans"],
            lambda span: F.struct((span["start"] + x["starts"]).alias("start"), span["length"].alias("length")),
        ),
    )
    return placed.select(
        "conv_id",
        F.array_join(
            F.transform("parts", lambda x: F.concat(x["head"], x["body"], F.lit(TURN_END))), ""
        ).alias("formatted"),
        F.flatten(spans).alias("loss_spans"),
    )


def read_turns(formatted: str | Column) -> Column:
    """The turns of a formatted conversation: array of (role, text), unescaped, in order."""
    column = F.col(formatted) if isinstance(formatted, str) else formatted

    def turns_of(block: Column) -> Column:
        role = unescape(F.substring_index(block, HEAD_END, 1))
        texts = F.split(F.substr(block, F.instr(block, HEAD_END) + F.lit(len(HEAD_END))), TURN_END, -1)
        return F.transform(
            F.slice(texts, F.lit(1), F.size(texts) - 1),
            lambda x: F.struct(role.alias("role"), unescape(x).alias("text")),
        )

    blocks = F.split(column, r"\[INST\]", -1)
    return F.flatten(F.transform(F.slice(blocks, F.lit(2), F.size(blocks)), turns_of))


def read_learnt(formatted: str, spans: str) -> Column:
    """All text under the loss mask, unescaped, with nothing between."""
    # One element, so that the bytes are made once and not for every span.
    return F.transform(
        F.array(F.col(formatted).cast("binary")),
        lambda raw: F.array_join(
            F.transform(
                spans,
                lambda x: unescape(
                    F.substr(raw, (x["start"] + 1).cast("int"), x["length"].cast("int")).cast("string")
                ),
            ),
            "",
        ),
    )[0]


def chat_digest(formatted: DataFrame) -> DataFrame:
    """What is read back from the formatted strings, as counts and digests."""
    read = formatted.select(
        "conv_id",
        "formatted",
        read_turns("formatted").alias("turns"),
        read_learnt("formatted", "loss_spans").alias("learnt"),
    )
    lines = F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.char_length("learnt").cast("bigint").alias("loss_chars"),
        F.sha2("learnt", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("bigint").alias("formatted_chars"),
    )
