"""Chat formatting from event logs, by SQL functions only.

A log has one row per event: ``conv_id, seq, message, kind, role, text``. ``message`` orders the
messages of a conversation, ``seq`` its events. Kinds:

* ``message``: a whole message, a turn of its own
* ``delta``: text added to the end of the message; its deltas are one turn
* ``edit``: the message's text becomes this one; what came before is gone
* ``regenerate``: as ``edit``, mostly with an empty text that deltas follow; every later message
  that was there by then is gone as well, as it answered the old one

Folding partitions the log by conversation and message, drops what a later edit or regeneration has
replaced, and adds up the rest in order of ``seq``. Only whole messages meet in a conversation's row,
which is as large as its formatted text.

Nulls: text and role count as empty, ``seq`` and ``message`` sort first; a null ``conv_id`` is a
conversation. Events with equal ``seq`` are ordered by kind, role and text, so repeated rows are all
kept and give the same result in any order. An unknown kind raises. No rows give no rows.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What marks turns in the output.
TURN, END = "<|turn|>", "<|end|>"

# First characters and continuations of control strings of common templates.
_CONTROL = "<(?=\\||/?s>|/?SYS)|\\[(?=/?INST\\])"


def escape(text: Column) -> Column:
    """``text`` without control strings: a backslash after their first character, itself doubled."""
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit(_CONTROL), F.lit("$0\\\\"))


def unescape(text: Column) -> Column:
    """Inverse of ``escape``, also for several escaped texts one after the other."""
    return F.regexp_replace(text, F.lit("\\\\(\\\\?)"), F.lit("$1"))


def _escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def _unescape_role(role: Column) -> Column:
    parts = F.split(role, "\\\\\\\\")
    plain = F.transform(parts, lambda p: F.replace(F.replace(p, F.lit("\\n"), F.lit("\n")), F.lit("\\"), F.lit("")))
    return F.array_join(plain, "\\")


def messages_as_events(rows: DataFrame, conversation: str, turn: str, role: str, text: str) -> DataFrame:
    """Log of a table that has a whole message in each row."""
    columns = [F.col(conversation).alias("conv_id"), F.col(turn).alias("seq"), F.col(turn).alias("message")]
    return rows.select(*columns, F.lit("message").alias("kind"), F.col(role).alias("role"), F.col(text).alias("text"))


def fold(events: DataFrame) -> DataFrame:
    """``conv_id, message, seq, role, text`` of the final messages; ``seq`` is that of its first event.

    Shuffles by conversation and message, so a long log is folded by many tasks.
    """
    empty = F.lit("")
    wrong = F.raise_error(F.concat(F.lit("unknown kind: "), F.coalesce("kind", F.lit("null"))))
    kind = F.when(F.col("kind").isin("message", "delta", "edit", "regenerate"), F.col("kind")).otherwise(wrong)
    log = events.select("conv_id", "message", "seq", kind.alias("kind"), F.coalesce("role", empty).alias("role"), F.coalesce("text", empty).alias("text"))

    # The last edit or regeneration of a message, where it begins.
    event = "struct(seq, kind, role, text)"
    log = log.withColumn("begin", F.expr(f"max(CASE WHEN kind IN ('edit', 'regenerate') THEN {event} END) OVER (PARTITION BY conv_id, message)"))
    current = log.where(f"begin IS NULL OR {event} >= begin")
    # What a later regeneration of an earlier message has ended: its place, as a running maximum.
    # Null messages come before all others and end nothing.
    ends = log.groupBy("conv_id", "message").agg(F.expr("max(CASE WHEN kind = 'regenerate' AND message IS NOT NULL THEN seq END) AS at"))
    before = "(PARTITION BY conv_id ORDER BY message ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    ends = ends.selectExpr("conv_id AS of", "message AS ended", f"max(at) OVER {before} AS at").where("at IS NOT NULL")
    current = current.join(ends, F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("message") == F.col("ended")), "left")
    current = current.where("NOT coalesce(at > seq, false)")

    columns = ["conv_id", "message", "seq", "role", "text"]
    whole = current.where("kind = 'message'").select(*columns)
    parts = current.where("kind <> 'message'").groupBy("conv_id", "message").agg(F.sort_array(F.collect_list(F.struct("seq", "kind", "role", "text"))).alias("parts"))
    joined = parts.select("conv_id", "message", F.expr("parts[0].seq AS seq"), F.expr("parts[0].role AS role"), F.array_join("parts.text", "").alias("text"))
    return whole.unionByName(joined)


def render(messages: DataFrame, trained_role: str = "assistant") -> DataFrame:
    """``conv_id, n_turns, formatted, segments`` of folded messages.

    ``segments`` are consecutive parts of ``formatted`` with the loss mask: ``loss`` is true for the
    texts of ``trained_role`` only. A turn is marked, its role ends with the line.
    """
    def segment(text: Column, loss: Column) -> Column:
        return F.struct(text.alias("text"), loss.alias("loss"))

    turns = F.sort_array(F.collect_list(F.struct("message", "seq", "role", "text")))
    grouped = messages.groupBy("conv_id").agg(turns.alias("turns"))
    no = F.lit(False)
    parts = F.transform("turns", lambda t: F.array(
        segment(F.concat(F.lit(TURN), _escape_role(t["role"]), F.lit("\n")), no),
        segment(escape(t["text"]), t["role"] == trained_role),
        segment(F.lit(END + "\n"), no),
    ))
    made = grouped.select("conv_id", F.size("turns").alias("n_turns"), F.flatten(parts).alias("segments"))
    return made.select("conv_id", "n_turns", F.array_join("segments.text", "").alias("formatted"), "segments")


def parse(formatted: Column) -> Column:
    """Turns of a formatted conversation as an array of ``role, text``."""
    parts = F.split(formatted, "<\\|turn\\|>")

    def turn(part: Column) -> Column:
        role = F.substring_index(part, "\n", 1)
        n = F.char_length(role)
        text = F.substring(part, n + 2, F.char_length(part) - n - 2 - len(END))
        return F.struct(_unescape_role(role).alias("role"), unescape(text).alias("text"))

    return F.transform(F.slice(parts, F.lit(2), F.size(parts)), turn)


def loss_text(segments: Column) -> Column:
    """All text under the loss mask."""
    under = F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: s["text"])
    return unescape(F.array_join(under, ""))
