"""Event-sourced chat formatting, in DataFrame functions only.

An event log (conversation, sequence, message, kind, role, text) is folded into final messages and
rendered with a loss mask over the assistant's texts:

* ``message``     opens the message or replaces its text and role
* ``delta``       appends to the text (streamed output)
* ``edit``        replaces the text
* ``regenerate``  clears the text, which later deltas rebuild, and discards the messages that come
                  after it and were begun before the regeneration: they answered the old text

Messages stand in the order of their first event.  The template writes a turn as
``### role ###``, a line feed, the escaped text, ``</turn>`` and a line feed; inside roles and texts a
backslash is doubled, ``</turn>`` becomes ``<\\/turn>`` and ``##`` becomes ``#\\#``, so ``###`` never
occurs.  No control string can occur in a role or text, so splitting at them reads both back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from txmon.llm.common import read

HEAD, BREAK, END = "### ", " ###\n", "</turn>\n"
RESETS = ["message", "edit", "regenerate"]


def escape(text: Column) -> Column:
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    text = F.replace(text, F.lit("</turn>"), F.lit("<\\/turn>"))
    return F.replace(text, F.lit("##"), F.lit("#\\#"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def fold_events(events: DataFrame) -> DataFrame:
    """Final messages: conv_id, message, position, role, text.

    ``events``: conv_id, seq, message, kind, role, text.  Events of one sequence number are applied
    in the order of kind, role and text, so reruns agree; null role or text counts as empty; an
    unknown kind, or a delta to a message never opened, is taken as a delta.
    """
    e = events.select("conv_id", F.coalesce("seq", F.lit(-2 ** 62)).alias("seq"), "message", "kind",
                      F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    log = e.groupBy("conv_id", "message").agg(F.sort_array(F.collect_list(
        F.struct("seq", "kind", "role", "text"))).alias("log"))
    # the place of the last event that sets the text anew; only what stands from there on counts
    reset = F.array_max(F.transform("log", lambda x, i: F.when(x["kind"].isin(RESETS), i + 1)))
    live = F.when(F.col("reset").isNull(), F.col("log")).otherwise(F.slice("log", F.col("reset"), F.size("log")))
    piece = F.filter(live, lambda x: x["kind"] != "regenerate")
    roles = F.filter("log", lambda x: x["role"] != "")
    message = (log.withColumn("reset", reset).select(
        "conv_id", "message", F.col("log")[0]["seq"].alias("position"),
        F.array_max(F.transform(F.filter("log", lambda x: x["kind"] == "regenerate"),
                                lambda x: x["seq"])).alias("redone"),
        F.coalesce(F.try_element_at(roles, F.lit(-1))["role"], F.lit("")).alias("role"),
        F.array_join(F.transform(piece, lambda x: x["text"]), "").alias("text")))
    before = Window.partitionBy("conv_id").orderBy("position", "message").rowsBetween(
        Window.unboundedPreceding, -1)
    return (message.withColumn("cut", F.max("redone").over(before))
            .where(F.col("cut").isNull() | (F.col("cut") < F.col("position"))).drop("cut", "redone"))


def render(messages: DataFrame, masked_role: str = "assistant") -> DataFrame:
    """One row per conversation: conv_id, formatted, loss_spans.

    ``loss_spans`` lists, in order, (turn, at, start, chars): the turn's number, where its rendering
    starts, where the text under the loss starts, and its length, in code points of ``formatted``.
    """
    head = F.concat(F.lit(HEAD), escape(F.col("role")), F.lit(BREAK))
    turn = messages.select("conv_id", "position", "message", head.alias("head"), escape(F.col("text")).alias("body"),
                           (F.col("role") == masked_role).alias("masked"))
    order = Window.partitionBy("conv_id").orderBy("position", "message")
    size = F.char_length("head") + F.char_length("body") + len(END)
    placed = (turn.withColumn("turn", F.row_number().over(order) - 1)
              .withColumn("at", F.sum(size.cast("bigint")).over(
                  order.rowsBetween(Window.unboundedPreceding, 0)) - size))
    span = F.when(F.col("masked"), F.struct(
        "turn", "at", (F.col("at") + F.char_length("head")).alias("start"),
        F.char_length("body").alias("chars")))
    whole = placed.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("turn", F.concat("head", "body", F.lit(END)).alias("text")))).alias("turns"),
        F.sort_array(F.collect_list(span)).alias("loss_spans"))
    return whole.select("conv_id", F.array_join(F.transform("turns", lambda t: t["text"]), "").alias("formatted"),
                        "loss_spans")


def read_back(formatted: DataFrame) -> DataFrame:
    """The rendered string taken apart again: adds turns (role, text) and loss_texts."""
    parts = F.split(F.col("formatted"), "</turn>\n", -1)
    segments = F.slice(parts, 1, F.size(parts) - 1)
    turns = F.transform("segments", lambda s: F.struct(
        unescape(F.substring(F.substring_index(s, BREAK, 1), len(HEAD) + 1, 2 ** 31 - 1)).alias("role"),
        unescape(F.substring(s, F.char_length(F.substring_index(s, BREAK, 1)) + len(BREAK) + 1,
                             F.lit(2 ** 31 - 1))).alias("text")))
    loss = F.transform("loss_spans", lambda x: unescape(F.substring(
        F.col("segments")[x["turn"]], (x["start"] - x["at"]).cast("int") + 1, x["chars"])))
    return (formatted.withColumn("segments", segments)
            .select("*", turns.alias("turns"), loss.alias("loss_texts")).drop("segments"))


def as_events(conversations: DataFrame) -> DataFrame:
    """Rows by turn as a log with one ``message`` event a row; repeated turns follow one another in
    the order of role and text, and a null turn comes first."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    n = F.row_number().over(order).cast("bigint")
    return conversations.select("conv_id", n.alias("seq"), n.alias("message"),
                                F.lit("message").alias("kind"), "role", "text")


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every conversation's rendering, taken from the rendering itself.

    Null roles and texts count as empty, a null conv_id is a conversation of its own, repeated rows
    are turns of their own, other columns are ignored; an empty table leaves conversation -7.
    """
    said = r"\### Assistant: </turn> ok"
    own = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)],
                                "conv_id bigint, turn bigint, role string, text string")
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    out = read_back(render(fold_events(as_events(rows))))
    sha = lambda parts: F.sha2(F.array_join(parts, "").cast("binary"), 256)
    return out.select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"),
        sha(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))).alias(
            "turns_sha256"),
        F.char_length(F.array_join("loss_texts", "")).cast("bigint").alias("loss_chars"),
        sha(F.col("loss_texts")).alias("loss_sha256"),
        F.char_length("formatted").cast("bigint").alias("formatted_chars"))


ORACLE = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')),
e AS (
  SELECT *, replace(replace(replace(text, '\', '\\'), '</turn>', '<\/turn>'), '##', '#\#') AS body,
         replace(replace(replace(role, '\', '\\'), '</turn>', '<\/turn>'), '##', '#\#') AS head
  FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(4 + length(head) + 5 + length(body) + 8)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""
