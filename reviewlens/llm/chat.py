"""Chat formatting from event logs, in DataFrame functions only.

A log holds events of messages: ``start`` opens a message, ``delta`` appends streamed text, ``edit`` replaces what is there,
``regenerate`` empties a message and takes back the messages that followed it, ``delete`` removes it. Logs are partitioned
by conversation, sorted by sequence and folded into final messages; those are rendered with a template.

A turn is rendered as ``<s>[INST]role[/INST]text</s>``. The four control strings inside roles and texts are broken with a
backslash, and backslashes are doubled, so the output can be read back exactly. The loss mask is a list of spans
(start, length, in code points of the output) that cover the assistant texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

#: Control strings of the template, and how they read inside a text. The backslash comes first.
ESCAPES = [("\\", "\\\\"), ("<s>", "<\\s>"), ("</s>", "<\\/s>"), ("[INST]", "[\\INST]"), ("[/INST]", "[\\/INST]")]
TURN_START, ROLE_END, TURN_END = "<s>[INST]", "[/INST]", "</s>"


def escape(text: Column) -> Column:
    for plain, safe in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(safe))
    return text


def unescape(text: Column) -> Column:
    """A backslash stands for the character after it."""
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def fold(events: DataFrame) -> DataFrame:
    """Final messages: (conv_id, msg, role, text) from events (conv_id, seq, event, msg, role, text).

    Events are applied in the order of (seq, event, text), nulls first; null texts count as empty. A message without a
    ``start`` exists from its first event on, with the first role that is given. ``regenerate`` takes back the messages with
    a larger number whose first event came before it. Unknown events change nothing. Null conversation ids form one
    conversation.
    """
    part = events.select(
        "conv_id", "msg", "seq", F.coalesce("event", F.lit("")).alias("event"), "role", F.coalesce("text", F.lit("")).alias("text")
    ).repartition("conv_id")  # one shuffle serves both groupings
    log = F.sort_array(F.collect_list(F.struct("seq", "event", "text", "role")))
    by_message = part.groupBy("conv_id", "msg").agg(log.alias("log"))
    resets = F.transform("log", lambda e, i: F.when(e["event"].isin("edit", "regenerate"), i))
    by_message = by_message.withColumn("__from", F.coalesce(F.array_max(resets), F.lit(0)))
    tail = F.filter("log", lambda e, i: (i >= F.col("__from")) & e["event"].isin("start", "delta", "edit"))
    regens = F.filter("log", lambda e: e["event"] == "regenerate")
    message = F.struct(
        F.col("msg"),
        F.get("log", F.lit(0))["seq"].alias("first"),
        F.array_max(F.transform(regens, lambda e: e["seq"])).alias("regenerated"),
        F.exists("log", lambda e: e["event"] == "delete").alias("deleted"),
        F.get(F.filter("log", lambda e: e["role"].isNotNull()), F.lit(0))["role"].alias("role"),
        F.array_join(F.transform(tail, lambda e: e["text"]), "").alias("text"),
    )
    by_conv = by_message.select("conv_id", message.alias("m")).groupBy("conv_id").agg(F.sort_array(F.collect_list("m")).alias("ms"))
    undone = F.filter("ms", lambda m: m["regenerated"].isNotNull())
    left = F.filter(
        "ms", lambda m: ~m["deleted"] & ~F.exists("__undone", lambda r: (r["msg"] < m["msg"]) & (m["first"] < r["regenerated"]))
    )
    return by_conv.withColumn("__undone", undone).select(
        "conv_id", F.transform(left, lambda m: F.struct(m["msg"].alias("msg"), m["role"].alias("role"), m["text"].alias("text"))).alias("messages")
    )


def render(conversations: DataFrame, learn: str = "assistant") -> DataFrame:
    """(conv_id, formatted, loss_spans) from (conv_id, messages). Null roles are empty; no message gives an empty string."""
    head = lambda m: F.concat(F.lit(TURN_START), escape(F.coalesce(m["role"], F.lit(""))), F.lit(ROLE_END))
    pieces = F.transform(
        "messages",
        lambda m: F.struct(head(m).alias("head"), escape(m["text"]).alias("body"), F.coalesce(m["role"] == learn, F.lit(False)).alias("learn")),
    )
    # Only lengths go through the running sum; the text itself is joined once.
    measured = F.transform("pieces", lambda p: F.struct(F.char_length(p["head"]).alias("h"), F.char_length(p["body"]).alias("b"), p["learn"].alias("learn")))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))

    def step(acc: Column, p: Column) -> Column:
        start = acc["at"] + p["h"]
        span = F.array(F.struct(start.alias("start"), p["b"].alias("length")))
        spans = F.when(p["learn"], F.concat(acc["spans"], span)).otherwise(acc["spans"])
        return F.struct((start + p["b"] + F.lit(len(TURN_END))).alias("at"), spans.alias("spans"))

    return (
        conversations.withColumn("pieces", pieces)
        .withColumn("sizes", measured)
        .select(
            "conv_id",
            F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["body"], F.lit(TURN_END))), "").alias("formatted"),
            F.aggregate("sizes", zero, step)["spans"].alias("loss_spans"),
        )
    )


def parse(formatted: Column) -> Column:
    """Turns (role, text) read back from a rendered conversation."""
    parts = F.filter(F.split(formatted, TURN_END), lambda p: p != "")

    def turn(p: Column) -> Column:
        cut = F.locate(ROLE_END, p)
        role = F.substr(p, F.lit(len(TURN_START) + 1), cut - F.lit(len(TURN_START) + 1))
        text = F.substr(p, cut + F.lit(len(ROLE_END)))
        return F.struct(unescape(role).alias("role"), unescape(text).alias("text"))

    return F.transform(parts, turn)


def masked_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, read back from the output."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substr(formatted, s["start"] + 1, s["length"]))), "")


def events_of(turns: DataFrame) -> DataFrame:
    """The log that a table of turns (conv_id, turn, role, text) stands for: each turn is opened, then its text is streamed in
    two halves. Turns are numbered in the order of (turn, role, text), nulls first, so repeated rows stay turns of their own."""
    text = F.coalesce("text", F.lit(""))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    half = F.floor(F.char_length(text) / 2).cast("int")
    numbered = turns.withColumn("__msg", F.row_number().over(order).cast("long"))
    empty = F.lit(None).cast("string")
    log = F.array(
        F.struct(F.lit(0).alias("k"), F.lit("start").alias("event"), F.col("role").alias("role"), empty.alias("text")),
        F.struct(F.lit(1).alias("k"), F.lit("delta").alias("event"), empty.alias("role"), F.substr(text, F.lit(1), half).alias("text")),
        F.struct(F.lit(2).alias("k"), F.lit("delta").alias("event"), empty.alias("role"), F.substr(text, half + 1).alias("text")),
    )
    return (
        numbered.select("conv_id", F.col("__msg").alias("msg"), log.alias("log"))
        .withColumn("e", F.explode("log"))
        .select("conv_id", (F.col("msg") * 3 + F.col("e.k")).alias("seq"), "e.event", "msg", "e.role", "e.text")
    )


def format_conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss_spans) of all conversations of a table of turns; other columns are ignored."""
    return render(fold(events_of(turns.select("conv_id", "turn", "role", "text"))))


def digest(formatted: DataFrame) -> DataFrame:
    """Counts and digests, read back from the rendered output."""
    turns = F.transform("__turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return (
        formatted.withColumn("__turns", parse(F.col("formatted")))
        .withColumn("__loss", masked_text(F.col("formatted"), F.col("loss_spans")))
        .select(
            "conv_id",
            F.size("__turns").cast("long").alias("n_turns"),
            F.sha2(F.array_join(turns, ""), 256).alias("turns_sha256"),
            F.char_length("__loss").cast("long").alias("loss_chars"),
            F.sha2(F.col("__loss"), 256).alias("loss_sha256"),
            F.char_length("formatted").cast("long").alias("formatted_chars"),
        )
    )
