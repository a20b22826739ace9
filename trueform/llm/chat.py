"""Chat formatting: event-sourced reconstruction with DataFrame functions only.

A log holds events of conversations. ``fold_events`` partitions it by message,
folds the events of each in sequence order into final messages; ``render`` sorts
the messages of a conversation and writes one training text with its loss spans;
``read_back`` parses such a text into messages again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

START, END = "<|im_start|>", "<|im_end|>\n"
#: text -> escaped, undone in reverse order; after it no control string can occur
ESCAPES = (("&", "&amp;"), ("<", "&lt;"), ("[", "&#91;"))


def escape(text: Column) -> Column:
    for plain, code in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescape(text: Column) -> Column:
    for plain, code in reversed(ESCAPES):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("&#10;"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("&#10;"), F.lit("\n")))


def fold_events(events: DataFrame) -> DataFrame:
    """Final messages (conv_id, position, role, text) of a log.

    Event columns: conv_id, seq (order in the conversation), message (its id in
    the conversation), kind, role, text. Kinds: ``message`` and ``regenerate``
    start a message's text anew, ``edit`` replaces it, ``delta`` appends to it,
    ``delete`` removes the message. Only events from a message's last start,
    edit or deletion onwards count, so these are found by a map-side aggregate
    and the rest of the log is dropped before any list is built.

    Null text is empty, null role is the role known before or else empty, null
    seq sorts first, an unknown or null kind counts as ``message``. Events of
    equal seq are applied by kind, then text; repeated deltas append twice. A
    message keeps the place of its first event. Other columns are ignored; an
    empty log gives no rows.
    """
    kind = F.when(F.col("kind").isin("regenerate", "edit", "delta", "delete"), F.col("kind")).otherwise("message")
    seq = F.coalesce(F.col("seq").cast("long"), F.lit(-(1 << 62)))
    log = events.select("conv_id", F.col("message").alias("message"), seq.alias("seq"), kind.alias("kind"),
                        F.col("role"), F.coalesce("text", F.lit("")).alias("text"))
    resets = F.when(F.col("kind") != "delta", F.col("seq"))
    place = log.groupBy("conv_id", "message").agg(
        F.min("seq").alias("position"), F.max(resets).alias("last_reset"),
        F.max_by("role", F.when(F.col("role").isNotNull(), F.struct("seq", "role"))).alias("role"))
    live = (log.drop("role").alias("e")
            .join(place.alias("p"), F.col("e.conv_id").eqNullSafe(F.col("p.conv_id"))
                  & F.col("e.message").eqNullSafe(F.col("p.message")))
            .filter(F.col("p.last_reset").isNull() | (F.col("e.seq") >= F.col("p.last_reset")))
            .select("p.conv_id", "p.message", "p.position", "p.role", "e.seq", "e.kind", "e.text",
                    F.when(F.col("e.kind") == "delta", 1).otherwise(0).alias("step")))
    folded = live.groupBy("conv_id", "message", "position", "role").agg(
        F.sort_array(F.collect_list(F.struct("seq", "step", "kind", "text"))).alias("log"))
    # of several resets at one seq the last in this order wins
    last = F.expr("array_max(transform(log, (e, i) -> if(e.kind <> 'delta', i, -1)))")
    return (folded.withColumn("last", last)
            .filter(F.expr("last < 0 or log[last].kind <> 'delete'"))
            .select("conv_id", "position", "message", F.coalesce("role", F.lit("")).alias("role"),
                    F.expr("array_join(transform(filter(log, (e, i) -> i >= last), e -> e.text), '')").alias("text")))


def render(messages: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, n_turns, formatted, loss_spans.

    A turn is ``<|im_start|>role``, a newline, the text, ``<|im_end|>``, a
    newline. ``loss_spans`` lists (start, length) in characters of each assistant
    text inside ``formatted``. Running offsets come from a window over the
    conversation, which spills; only the finished text is held whole.
    """
    head = F.concat(F.lit(START), escape_role(F.coalesce("role", F.lit(""))), F.lit("\n"))
    parts = messages.select("conv_id", "position", "message", F.coalesce("role", F.lit("")).alias("role"),
                            head.alias("head"), escape(F.coalesce("text", F.lit(""))).alias("body"))
    size = F.length("head") + F.length("body") + F.lit(len(END))
    order = Window.partitionBy("conv_id").orderBy("position", "message")
    placed = parts.withColumn("no", F.row_number().over(order)).withColumn(
        "start", F.coalesce(F.sum(size).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    span = F.when(F.col("role") == "assistant",
                  F.struct((F.col("start") + F.length("head")).alias("start"), F.length("body").alias("length")))
    turns = placed.groupBy("conv_id").agg(
        F.count("*").alias("n_turns"),
        F.sort_array(F.collect_list(F.struct("no", F.concat("head", "body", F.lit(END)).alias("turn"),
                                             span.alias("span")))).alias("turns"))
    return turns.select(
        "conv_id", "n_turns",
        F.expr("array_join(transform(turns, t -> t.turn), '')").alias("formatted"),
        F.expr("transform(filter(turns, t -> t.span is not null), t -> t.span)").alias("loss_spans"))


def read_back(rendered: DataFrame) -> DataFrame:
    """Adds ``turns`` (role, text in order) and ``loss_texts``, both read from ``formatted``."""
    pieces = F.expr("filter(split(formatted, '<[|]im_start[|]>'), (x, i) -> i > 0)")
    head = lambda p: F.substring_index(p, "\n", 1)
    turn = lambda p: F.struct(
        unescape_role(head(p)).alias("role"),
        unescape(F.substring(p, F.length(head(p)) + 2, F.length(p) - F.length(head(p)) - 1 - len(END))).alias("text"))
    loss = F.transform("loss_spans", lambda s: unescape(
        F.substring(F.col("formatted"), (s["start"] + 1).cast("int"), s["length"].cast("int"))))
    return rendered.withColumn("turns", F.transform(pieces, turn)).withColumn("loss_texts", loss)


def conversation_log(conversations: DataFrame) -> DataFrame:
    """Rows by turn as a log: each row is one ``message`` event of its own.

    Rows that share a turn, repeated rows included, are separate messages in the
    order of role and text.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    return conversations.select(
        "conv_id", F.row_number().over(order).cast("long").alias("seq"),
        F.row_number().over(order).cast("long").alias("message"), F.lit("message").alias("kind"), "role", "text")


def format_conversations(conversations: DataFrame) -> DataFrame:
    return render(fold_events(conversation_log(conversations)))


def digests(rendered: DataFrame) -> DataFrame:
    """Figures of each formatted conversation, all taken from ``formatted`` and its spans."""
    read = read_back(rendered)
    plain = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("loss_texts", "")
    return read.select(
        "conv_id", F.col("n_turns").cast("long").alias("n_turns"), F.sha2(plain, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))
