"""Chat formatting from event logs: fold deltas, edits and regenerations into messages, then render with a loss mask."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

# The template's marks.
TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
# Control strings that a text must not be able to forge: the marks above and the usual ones of other templates.
CONTROL = r"(/?INST\]|/?s>|\|[a-z_]+\|>)"
SPLIT_TURN, SPLIT_PART = r"<\|turn\|>", r"<\|text\|>|<\|end\|>"


def escape(text: Column) -> Column:
    """Put one more backslash after the bracket that opens a control string, whether or not it has some already."""
    return F.regexp_replace(text, r"([<\[])(\\*)" + CONTROL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    """Take one backslash away where `escape` added one."""
    return F.regexp_replace(text, r"([<\[])\\(\\*)" + CONTROL, "$1$2$3")


def fold(events: DataFrame) -> DataFrame:
    """Final messages of every conversation: conv_id, message, role, text.

    `events`: conv_id, seq, message (number of the message in its conversation), kind, role, text.
    - `delta` appends its text to the message;
    - `edit` replaces what the message holds;
    - `regenerate` empties the message, starts it with its own text, and withdraws all later messages written so far.
    Events apply in the order of seq, ties by kind and text. An event logged twice applies twice. A null text is empty; the
    role is the last one given, by a replaced event too, else empty; a message all of whose events are withdrawn is gone; another kind
    counts as `delta`. Events without a conv_id form one conversation. The log is shuffled once, by conversation.
    """
    kind = F.coalesce("kind", F.lit("delta"))
    reset = kind.isin("edit", "regenerate")
    before = W.partitionBy("conv_id").orderBy("message").rangeBetween(W.unboundedPreceding, -1)
    own = W.partitionBy("conv_id", "message").orderBy("seq", kind, "text")
    numbered = events.select("conv_id", F.col("message").cast("long").alias("message"), "seq", kind.alias("kind"), "role", F.coalesce("text", F.lit("")).alias("text"))
    numbered = numbered.withColumn("_at", F.row_number().over(own)).withColumn("_void", F.max(F.when(F.col("kind") == "regenerate", F.col("seq"))).over(before))
    numbered = numbered.withColumn("_from", F.max(F.when(reset, F.col("_at"))).over(W.partitionBy("conv_id", "message")))
    standing = numbered.where("_void is null or seq > _void")
    role = F.max_by("role", F.when(F.col("role").isNotNull(), F.col("_at"))).over(W.partitionBy("conv_id", "message"))
    live = standing.withColumn("_role", role).where("_from is null or _at >= _from")
    parts = F.sort_array(F.collect_list(F.struct("_at", "text")))
    return live.groupBy("conv_id", "message").agg(
        F.array_join(F.transform(parts, lambda p: p["text"]), "").alias("text"),
        F.coalesce(F.max("_role"), F.lit("")).alias("role"),
    )


def render(messages: DataFrame, learn: str = "assistant") -> DataFrame:
    """One row per conversation: conv_id, formatted, loss (spans of code points that carry the loss), n_turns.

    Every message is mark, role, mark, text, mark; roles and texts are escaped. `loss` has start and end of the text of
    each message whose role is `learn`, in order. A conversation is one row by its nature: it is collected whole.
    """
    piece = F.concat(F.lit(TURN), "_role", F.lit(TEXT), "_text", F.lit(END))
    order = W.partitionBy("conv_id").orderBy("message").rowsBetween(W.unboundedPreceding, 0)
    cut = messages.select("conv_id", "message", "role", escape(F.col("role")).alias("_role"), escape(F.col("text")).alias("_text")).withColumn("_piece", piece)
    end = F.sum(F.length("_piece")).over(order) - len(END)
    placed = cut.withColumn("_end", end).withColumn("_start", F.col("_end") - F.length("_text"))
    turn = F.struct("message", "_piece", F.struct(F.col("_start").alias("start"), F.col("_end").alias("end")).alias("span"), (F.col("role") == learn).alias("learn"))
    joined = placed.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("_turns"))
    return joined.select(
        "conv_id",
        F.array_join(F.transform("_turns", lambda t: t["_piece"]), "").alias("formatted"),
        F.transform(F.filter("_turns", lambda t: t["learn"]), lambda t: t["span"]).alias("loss"),
        F.size("_turns").cast("long").alias("n_turns"),
    )


def parse(formatted: Column) -> Column:
    """Turns of a formatted conversation, as an array of role and text."""
    pieces = F.filter(F.split(formatted, SPLIT_TURN), lambda p: p != "")
    parts = F.transform(pieces, lambda p: F.split(p, SPLIT_PART))
    return F.transform(parts, lambda p: F.struct(unescape(F.get(p, 0)).alias("role"), unescape(F.get(p, 1)).alias("text")))


def learned(formatted: Column, loss: Column) -> Column:
    """The text under the loss mask, unescaped, span after span."""
    return F.array_join(F.transform(loss, lambda s: unescape(F.substring(formatted, s["start"] + 1, s["end"] - s["start"]))), "")


def chat(events: DataFrame, learn: str = "assistant") -> DataFrame:
    """Fold an event log and render its conversations; see `fold` and `render`."""
    return render(fold(events), learn)


def turns_as_events(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """A table of whole turns as an event log: each row is a message of one delta, in the order of turn, role and text."""
    picked = rows.select(F.col(conv).alias("conv_id"), F.col(turn).alias("_turn"), F.col(role).cast("string").alias("role"), F.col(text).cast("string").alias("text"))
    place = F.row_number().over(W.partitionBy("conv_id").orderBy("_turn", "role", "text")).cast("long")
    return picked.withColumn("message", place).select("conv_id", F.col("message").alias("seq"), "message", F.lit("delta").alias("kind"), "role", "text")


def turns_as_log(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """A table of whole turns as the log of a service that streams, edits and regenerates; it folds to the same messages.

    The CRC of conversation and message number, which a lost task computes again, decides what a message goes through:
    - two halves, streamed;
    - a draft, an edit that replaces it by the first half, and the second half;
    - a draft, a reply to it under the next number, a regeneration with the first half, and the second half.
    """
    whole = turns_as_events(rows, conv, turn, role, text).withColumn("text", F.coalesce("text", F.lit("")))
    half = F.floor(F.length("text") / 2).cast("int")
    first, second = F.substr("text", F.lit(1), half), F.substr("text", half + 1)
    way = F.pmod(F.crc32(F.concat_ws(":", F.col("conv_id").cast("string"), F.col("message").cast("string")).cast("binary")), F.lit(3))

    def event(step: int, kind: str, words: Column, ahead: int = 0) -> Column:
        return F.struct(
            (F.col("seq") * 4 + step).alias("seq"), (F.col("message") + ahead).alias("message"), F.lit(kind).alias("kind"), "role", words.alias("text"),
        )

    draft = event(0, "delta", F.reverse(first))
    streamed = F.array(event(0, "delta", first), event(1, "delta", second))
    edited = F.array(draft, event(1, "edit", first), event(2, "delta", second))
    regenerated = F.array(draft, event(1, "delta", F.lit("a reply to the draft"), 1), event(2, "regenerate", first), event(3, "delta", second))
    steps = F.when(way == 0, streamed).when(way == 1, edited).otherwise(regenerated)
    return whole.select("conv_id", F.explode(steps).alias("_event")).select("conv_id", "_event.*")
