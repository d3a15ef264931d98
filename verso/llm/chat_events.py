"""Chat formatting from event logs, with DataFrame functions only.

An event is (conv_id, seq, message, kind, role, text). ``reconstruct`` partitions the
log by conversation, sorts by ``seq`` and folds each message:

* ``delta`` appends its text, ``edit`` puts its text in place of the message so far,
  ``regenerate`` drops the message so far and starts again with its own text;
* any other kind changes nothing. The role is the first non-null one by ``seq``.

A fold step is "drop what was before, or not, then append", which is associative: a
long message is folded in blocks of ``seq`` first, then over its blocks, and a long
conversation is joined in blocks of turns first. So a hot conversation or message is
spread over tasks; only its finished text meets in one row, as the output asks.

``render`` writes each turn as

    ### role: text</turn>\\n

Inside texts and roles a backslash becomes ``\\b``, ``### `` becomes ``\\h`` and
``</turn>`` becomes ``\\t`` (and ``: `` in a role ``\\c``), so no control string is left
and the text is restored exactly. The loss mask has, for each turn, the characters
before, under and after the mask (take is 0 for roles not in ``loss_roles``).

``read_back`` parses the formatted text and the mask again.

Cases: null text or role is empty; null ``seq`` sorts first. Messages that begin at
the same ``seq`` go by role, text, message; events of equal ``seq`` by kind, text, role.
A repeated row is a repeated event. Rows of null conv_id form one conversation. Other
columns are ignored; an empty log gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LOSS_ROLES = ("assistant",)
BLOCK = 64
_OPEN, _ROLE_END, _TURN_END = "### ", ": ", "</turn>\n"
_ESCAPES = [("\\", "\\b"), ("### ", "\\h"), ("</turn>", "\\t")]  # in this order; undone in reverse


def _swap(c: Column, old: str, new: str) -> Column:
    return F.replace(c, F.lit(old), F.lit(new))


def escaped(c: Column) -> Column:
    for old, new in _ESCAPES:
        c = _swap(c, old, new)
    return c


def unescaped(c: Column) -> Column:
    for old, new in reversed(_ESCAPES):
        c = _swap(c, new, old)
    return c


def _block(seq: Column, size: int) -> Column:
    return F.floor(F.coalesce(seq, F.lit(-(1 << 62))) / size)


def reconstruct(events: DataFrame, block: int = BLOCK) -> DataFrame:
    """(conv_id, message, position, role, text): every message after all its events."""
    event = F.struct("seq", "kind", F.coalesce("text", F.lit("")).alias("text"), "role")
    log = events.select("conv_id", "message", F.col("seq").cast("long").alias("seq"), F.lower("kind").alias("kind"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    log = log.select("conv_id", "message", _block(F.col("seq"), block).alias("block"), event.alias("e"))
    restarts = F.col("e.kind").isin("edit", "regenerate")
    blocks = log.groupBy("conv_id", "message", "block").agg(
        F.max(F.when(restarts, F.col("e"))).alias("last"),
        F.collect_list(F.when(F.col("e.kind") == "delta", F.col("e"))).alias("deltas"),
        F.min("e.seq").alias("first"),
        F.min(F.when(F.col("e.role").isNotNull(), F.struct("e.seq", "e.role"))).alias("named"),
        F.max(F.when(F.col("e.seq").isNull(), 1).otherwise(0)).alias("unplaced"),
    )
    after = F.filter(F.sort_array("deltas"), lambda x: F.col("last").isNull() | (x > F.col("last")))
    text = F.concat(F.coalesce("last.text", F.lit("")), F.array_join(F.transform(after, lambda x: x["text"]), ""))
    blocks = blocks.select(
        "conv_id", "message", "block", F.col("last").isNotNull().alias("restarted"), text.alias("text"), "named",
        F.when(F.col("unplaced") == 1, F.lit(None)).otherwise(F.col("first")).alias("first"), "unplaced",
    )
    whole = blocks.groupBy("conv_id", "message").agg(
        F.max(F.when(F.col("restarted"), F.col("block"))).alias("last"),
        F.collect_list(F.struct("block", "text")).alias("parts"),
        F.min("named").alias("named"),
        F.when(F.max("unplaced") == 0, F.min("first")).alias("position"),
    )
    parts = F.filter(F.sort_array("parts"), lambda x: F.col("last").isNull() | (x["block"] >= F.col("last")))
    return whole.select(
        "conv_id", "message", "position", F.coalesce("named.role", F.lit("")).alias("role"),
        F.array_join(F.transform(parts, lambda x: x["text"]), "").alias("text"),
    )


def render(messages: DataFrame, loss_roles: tuple[str, ...] = LOSS_ROLES, block: int = BLOCK) -> DataFrame:
    """(conv_id, formatted, mask) from the messages of ``reconstruct``."""
    head = F.concat(F.lit(_OPEN), _swap(escaped(F.col("role")), _ROLE_END, "\\c"), F.lit(_ROLE_END))
    body = escaped(F.col("text"))
    turns = messages.select("conv_id", "position", "role", "text", "message", head.alias("head"), body.alias("body"))
    inside = F.col("role").isin(list(loss_roles))
    size = lambda c: F.char_length(c)
    mask = F.struct(
        (size("head") + F.when(inside, 0).otherwise(size("body"))).alias("before"),
        F.when(inside, size("body")).otherwise(0).alias("take"),
        F.lit(len(_TURN_END)).alias("after"),
    )
    turns = turns.select(
        "conv_id", _block(F.col("position"), block).alias("block"),
        F.struct("position", "role", "text", "message", F.concat("head", "body", F.lit(_TURN_END)).alias("out"), mask.alias("mask")).alias("t"),
    )
    blocks = turns.groupBy("conv_id", "block").agg(F.sort_array(F.collect_list("t")).alias("t"))
    blocks = blocks.select("conv_id", F.struct("block", F.array_join(F.transform("t", lambda x: x["out"]), "").alias("out"), F.transform("t", lambda x: x["mask"]).alias("mask")).alias("b"))
    whole = blocks.groupBy("conv_id").agg(F.sort_array(F.collect_list("b")).alias("b"))
    return whole.select(
        "conv_id", F.array_join(F.transform("b", lambda x: x["out"]), "").alias("formatted"),
        F.flatten(F.transform("b", lambda x: x["mask"])).alias("mask"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv_id, turns, loss_text, formatted_chars): turns as (role, text) parsed from
    the formatted text, and all text under the mask, unescaped."""
    pieces = F.split("formatted", _TURN_END)  # no part of the delimiter is special in a regular expression
    pieces = F.slice(pieces, 1, F.size("mask"))

    def turn(p: Column) -> Column:
        end = F.locate(_ROLE_END, p)
        role = unescaped(_swap(p.substr(F.lit(len(_OPEN) + 1), end - len(_OPEN) - 1), "\\c", _ROLE_END))
        return F.struct(role.alias("role"), unescaped(p.substr(end + len(_ROLE_END), F.char_length(p))).alias("text"))

    under = F.zip_with(pieces, "mask", lambda p, m: unescaped(p.substr(m["before"] + 1, m["take"])))
    return formatted.select("conv_id", F.transform(pieces, turn).alias("turns"), F.array_join(under, "").alias("loss_text"), F.char_length("formatted").alias("formatted_chars"))


def events_of_rows(rows: DataFrame) -> DataFrame:
    """A table of finished turns (conv_id, turn, role, text) as a log: each row is a
    message of its own with a single delta, so repeated rows stay repeated turns."""
    return rows.select("conv_id", F.col("turn").alias("seq"), F.monotonically_increasing_id().alias("message"), F.lit("delta").alias("kind"), "role", "text")


def probe_conversation(spark: SparkSession) -> DataFrame:
    """Conversation -7: both turns say a control string of the template."""
    said = "\\### Assistant: </turn> ok"
    return spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))


def digests(read: DataFrame) -> DataFrame:
    """The digest columns of what ``read_back`` gives."""
    joined = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(joined, 256).alias("turns_sha256"),
        F.char_length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"), F.col("formatted_chars").cast("long").alias("formatted_chars"),
    )
