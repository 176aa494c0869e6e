"""Chat logs as event sources: fold the events, render a template, read it back.
DataFrame functions only.

Events are (conv_id, seq, message, kind, role, text).  Within a message, in the
order of seq, ``message`` and ``edit`` replace the text so far, ``regenerate``
drops it and starts with its own, ``delta`` adds to it; a null kind is a whole
``message``, any other kind is none of the text's business and is passed over.
The last role given holds.  Events before a message's last replacement are left
out before anything is gathered, so a message collects only its final text.

Template: ``<|im_start|>role`` LF text ``<|im_end|>`` LF for each message.  Inside
roles and texts ``\\`` becomes ``\\s`` and ``<|`` becomes ``<\\p`` (in roles LF
becomes ``\\l``), so that no control string can be written there, and replacing
them back gives the same text.  The loss mask lists, for each assistant message,
its number in the conversation, and where in it the text starts and its length.

Defined results: null texts and roles are empty.  A null conv_id is a conversation
of its own; null seq comes first; ties follow role, then text.  Repeated rows are
turns of their own in a table of turns.  Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>\n"
#: What replaces what, in order; reading back goes the other way round.
TEXT_ESCAPES = (("\\", "\\s"), ("<|", "<\\p"))
ROLE_ESCAPES = (*TEXT_ESCAPES, ("\n", "\\l"))
LOSS_ROLE = "assistant"


def escape(text: Column, pairs=TEXT_ESCAPES) -> Column:
    for a, b in pairs:
        text = F.replace(text, F.lit(a), F.lit(b))
    return text


def unescape(text: Column, pairs=TEXT_ESCAPES) -> Column:
    for a, b in reversed(pairs):
        text = F.replace(text, F.lit(b), F.lit(a))
    return text


def turn_events(turns: DataFrame) -> DataFrame:
    """A table of whole turns as events: one message each, in the order of turn."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    return turns.select(
        "conv_id", F.row_number().over(order).cast("long").alias("seq"),
        F.lit("message").alias("kind"), "role", "text").withColumn("message", F.col("seq"))


def fold(events: DataFrame) -> DataFrame:
    """Events -> (conv_id, message, role, text) as they stand after the last event."""
    kind = F.coalesce("kind", F.lit("message"))
    replaces = kind.isin("message", "edit", "regenerate")
    message = Window.partitionBy("conv_id", "message")
    place = F.struct(F.col("seq"), F.coalesce("role", F.lit("")).alias("role"),
                     F.coalesce("text", F.lit("")).alias("text"))
    standing = (
        events.where(replaces | (kind == "delta"))
        .select("conv_id", "message", "role", place.alias("place"), replaces.alias("replaces"))
        .withColumn("reset", F.max(F.when(F.col("replaces"), F.col("place"))).over(message))
        .withColumn("role", F.when(F.col("role").isNotNull(), F.col("place")))
        .withColumn("role", F.max("role").over(message))
        .where(F.col("reset").isNull() | (F.col("place") >= F.col("reset")))
    )
    return standing.groupBy("conv_id", "message").agg(
        F.coalesce(F.first("role")["role"], F.lit("")).alias("role"),
        F.array_join(F.transform(F.sort_array(F.collect_list("place")), lambda p: p["text"]), "").alias("text"))


def render(messages: DataFrame) -> DataFrame:
    """(conv_id, message, role, text) -> (conv_id, formatted, loss)."""
    head = F.concat(F.lit(START), escape(F.col("role"), ROLE_ESCAPES), F.lit("\n"))
    parts = messages.select(
        "conv_id", F.struct(
            "message", (F.col("role") == LOSS_ROLE).alias("learned"), F.length(head).alias("head"),
            F.length(escape(F.col("text"))).alias("chars"),
            F.concat(head, escape(F.col("text")), F.lit(END)).alias("part")).alias("m"))
    whole = parts.groupBy("conv_id").agg(F.sort_array(F.collect_list("m")).alias("m"))
    spans = F.transform("m", lambda m, i: F.struct(
        i.alias("turn"), m["head"].alias("start"), m["chars"].alias("chars"), m["learned"].alias("learned")))
    return whole.select(
        "conv_id", F.array_join(F.transform("m", lambda m: m["part"]), "").alias("formatted"),
        F.transform(F.filter(spans, lambda s: s["learned"]),
                    lambda s: F.struct(s["turn"], s["start"], s["chars"])).alias("loss"))


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss) -> turns (role, text) and the texts to learn."""
    parts = formatted.withColumn("parts", F.split("formatted", r"<\|im_end\|>\n"))
    end = F.length(F.lit(START)) + 1

    def turn(p: Column) -> Column:
        body = F.substring(p, end, F.length(p))
        at = F.instr(body, "\n")
        return F.struct(
            unescape(F.substring(body, F.lit(1), at - 1), ROLE_ESCAPES).alias("role"),
            unescape(F.substring(body, at + 1, F.length(body))).alias("text"))

    return parts.select(
        "conv_id", "formatted",
        F.transform(F.slice("parts", F.lit(1), F.size("parts") - 1), turn).alias("turns"),
        F.transform("loss", lambda s: unescape(
            F.substring(F.get("parts", s["turn"]), s["start"] + 1, s["chars"]))).alias("learned"))


def digests(formatted: DataFrame) -> DataFrame:
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learned = F.array_join("learned", "")
    return read_back(formatted).select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"),
        F.char_length(learned).cast("long").alias("loss_chars"), F.sha2(learned, 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"))


def format_chats(events: DataFrame) -> DataFrame:
    return render(fold(events))
