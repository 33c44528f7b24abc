"""Chat texts from event logs: folds streamed deltas, edits and regenerations into messages, then renders them.

An event has conv_id, message (an id that is unique over all conversations), position (orders the messages of a
conversation), seq (orders the events of a message), kind, role and text. Kinds, fixed values:

    open        starts the message and names its role; its text, if any, is the start of the text
    delta       appends its text
    edit        replaces the text so far by its text
    regenerate  throws the text so far away

The template is `<|im_start|>role\\ntext<|im_end|>\\n` for every message. Inside roles and texts a backslash is doubled
and `<|` becomes `<\\|`, so no marker can occur there and reading back gives the exact text. A line break inside a role
becomes `<\\/`.

Scale: events meet by message, so the events of a hot conversation spread over many tasks, and what an edit or a
regeneration threw away is dropped there. Only the final messages of a conversation meet, as its text is one row; that row
holds one conversation, however many rows there are in all.

Edge cases. Null conv_id is a conversation of its own. Null roles and texts are empty. Messages with equal positions
are ordered by role, then text; null positions come first. Repeated conversation rows are messages of their own. An
event of another kind is an error. An empty log gives no rows. Extra columns are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed values of the template.
START, END = "<|im_start|>", "<|im_end|>"
TRAINED = "assistant"
# Documented parameter of the log made from plain conversations: code points of a streamed delta.
DELTA = 200


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    """Inverse of `escape`: a lone backslash stands only between `<` and `|`, all others are doubled."""
    return F.replace(F.replace(text, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("<\\/"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("<\\/"), F.lit("\n")))


def log_of(turns: DataFrame, delta: int = DELTA) -> DataFrame:
    """The event log that would have led to these turns (conv_id, turn, role, text).

    Assistant turns are streamed, regenerated and streamed again; user turns are streamed in part, then edited; others
    are streamed.
    """
    rows = turns.select(
        "conv_id", F.monotonically_increasing_id().alias("message"), F.col("turn").alias("position"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("body"),
    ).withColumn("pieces", F.regexp_extract_all(F.col("body"), F.lit("(?s).{1,%d}" % delta), 0))

    def event(kind: str, text: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), text.alias("text"))

    nothing = F.lit(None).cast("string")
    deltas = F.transform("pieces", lambda x: event("delta", x))
    draft = F.slice(deltas, 1, 1)
    events = F.concat(
        F.array(event("open", nothing)),
        F.when(F.col("role") == TRAINED, F.concat(draft, F.array(event("regenerate", nothing)), deltas))
        .when(F.col("role") == "user", F.concat(draft, F.array(event("edit", F.col("body")))))
        .otherwise(deltas),
    )
    rows = rows.select("conv_id", "message", "position", "role", F.posexplode(events).alias("seq", "event"))
    role = F.when(F.col("event.kind") == "open", F.col("role"))
    return rows.select("conv_id", "message", "position", "seq", "event.kind", role.alias("role"), "event.text")


def fold_events(events: DataFrame) -> DataFrame:
    """Final messages: conv_id, message, position, role, text."""
    known = F.col("kind").isin("open", "delta", "edit", "regenerate")
    bad = F.raise_error(F.concat(F.lit("unknown kind of event: "), F.coalesce(F.col("kind"), F.lit("null"))))
    resets = F.when(F.when(known, F.col("kind") != "delta").otherwise(bad), F.col("seq"))
    of_message = Window.partitionBy("conv_id", "message")
    rows = events.select("*", F.max(resets).over(of_message).alias("_reset"), F.max("role").over(of_message).alias("_role"))
    rows = rows.where(F.col("_reset").isNull() | (F.col("seq") >= F.col("_reset")))
    pieces = F.sort_array(F.collect_list(F.struct("seq", F.coalesce("text", F.lit("")).alias("text"))))
    return rows.groupBy("conv_id", "message").agg(
        F.min("position").alias("position"), F.coalesce(F.max("_role"), F.lit("")).alias("role"),
        F.array_join(pieces["text"], "").alias("text"),
    )


def render(messages: DataFrame) -> DataFrame:
    """One row per conversation: segments of (text, loss), which joined are the formatted text, and that text.

    The loss mask covers the texts of assistant messages, without markers.
    """
    listed = F.sort_array(F.collect_list(F.struct("position", "role", "text", "message")))
    rows = messages.groupBy("conv_id").agg(listed.alias("messages"))

    def segment(text: Column, loss: Column) -> Column:
        return F.struct(text.alias("text"), loss.alias("loss"))

    def three(m: Column) -> Column:
        return F.array(
            segment(F.concat(F.lit(START), escape_role(m["role"]), F.lit("\n")), F.lit(False)),
            segment(escape(m["text"]), m["role"] == TRAINED),
            segment(F.lit(END + "\n"), F.lit(False)),
        )

    rows = rows.select("conv_id", F.flatten(F.transform("messages", three)).alias("segments"))
    return rows.withColumn("formatted", F.array_join(F.col("segments")["text"], ""))


def read_turns(formatted: Column) -> Column:
    """The (role, text) pairs of a formatted text."""
    pieces = F.split(formatted, r"<\|im_end\|>\n")
    pieces = F.slice(pieces, 1, F.size(pieces) - 1)

    def turn(piece: Column) -> Column:
        head = F.substring_index(piece, "\n", 1)
        role = F.substring(head, F.lit(len(START) + 1), F.length(head))
        text = F.substring(piece, F.length(head) + 2, F.length(piece))
        return F.struct(unescape_role(role).alias("role"), unescape(text).alias("text"))

    return F.transform(pieces, turn)


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")


def format_chats(events: DataFrame) -> DataFrame:
    """Event log to conv_id, segments, formatted."""
    return render(fold_events(events))
