"""Chat formatting: conversations as budgeted windows of whole turns, with repeated history and a loss mask."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Tokens of a window, and of the turns that are repeated from before it.
BUDGET, HISTORY = 2048, 256
#: Marks of the template: before the role, between role and text, after the text.
OPEN, SAYS, CLOSE = "<turn>", "<says>", "</turn>"
#: Roles whose texts are learned, and the role that every window starts with.
TARGET, SYSTEM = "assistant", "system"
#: Turn numbers of one part are a power of two: a conversation is cut into parts of so many, and a part sees so many turns of
#: the one before it as history.
PART_BITS, PAST = 8, 16


def escaped(text: Column) -> Column:
    """Text in which no mark of the template occurs: a mark, and one with backslashes behind its ``<``, gets one more of them."""
    return F.regexp_replace(text, r"<(\\*(?:turn>|says>|/turn>))", r"<\\$1")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*(?:turn>|says>|/turn>))", "<$1")


def byte_tokens(text: Column) -> Column:
    """Tokens of a turn by rule of thumb: four for its marks, and one for each four bytes begun."""
    return (4 + F.ceil(F.octet_length(text) / 4)).cast("int")


def _rows(conversations: DataFrame, tokens: Callable[[Column], Column]) -> DataFrame:
    """The turns of every part (kind 2), with the turns before it (kind 1) and what all parts but the first start with (kind 0)."""
    number = F.coalesce(F.col("turn").cast("long"), F.lit(-(1 << 63)))
    turns = conversations.select("conv_id", number.alias("t"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    turns = turns.withColumn("part", F.shiftright("t", PART_BITS))
    long_ = turns.groupBy("conv_id").agg(F.min("t").alias("first_t"), F.max("t").alias("last_t"))
    long_ = long_.where(F.shiftright("first_t", PART_BITS) < F.shiftright("last_t", PART_BITS)).select(F.col("conv_id").alias("long_id"), "first_t")
    of_long = F.col("conv_id").eqNullSafe(F.col("long_id"))
    later = turns.select("conv_id", "part").distinct().join(long_, of_long).where(F.col("part") > F.shiftright("first_t", PART_BITS))
    systems = turns.where(F.col("role") == SYSTEM).join(long_, of_long & (F.col("t") == F.col("first_t")))
    systems = systems.groupBy("long_id").agg(F.min("text").alias("text"))
    later = later.select("conv_id", "part").join(systems, of_long, "left")
    past = turns.where(F.col("t").bitwiseAND((1 << PART_BITS) - 1) >= (1 << PART_BITS) - PAST).withColumn("part", F.col("part") + 1)
    sized = tokens("text").alias("tokens")
    rank = (F.col("role") != SYSTEM).alias("later")
    own = turns.select("conv_id", "part", F.lit(2).alias("kind"), "t", rank, "role", "text", sized)
    past = past.select("conv_id", "part", F.lit(1).alias("kind"), "t", rank, "role", "text", sized)
    heads = later.select("conv_id", "part", F.lit(0).alias("kind"), F.lit(0).cast("long").alias("t"), F.lit(False).alias("later"), F.lit(SYSTEM).alias("role"), "text", sized)
    return own.union(past).union(heads)


def _spans(budget: int, history: int) -> Column:
    """(past, first, end) of every window over the turns of ``sums``: turns first to end are its own, from ``past`` on repeated ones.

    ``sums`` are prefix sums of tokens, from 0 on.  A window takes turns as long as they fit; the next one repeats whole
    turns before it within ``history`` tokens, none if its first turn would not fit behind them.
    """
    sums, free = F.col("sums"), budget - F.col("system_tokens")

    def at(i: Column) -> Column:
        return F.get("sums", i)

    def opened(i: Column, done: Column) -> Column:
        past = F.size(F.filter(sums, lambda s: at(i) - s > history))
        past = F.when(at(i + 1) - at(past) > free, i).otherwise(past)
        return F.struct(past.alias("past"), i.alias("first"), done.alias("done"))

    def step(state: Column, i: Column) -> Column:
        full = (at(i + 1) - at(state.past) > free) & (i > state.first)
        ended = F.concat(state.done, F.array(F.struct(state.past.alias("past"), state.first.alias("first"), i.alias("end"))))
        return F.when(full, opened(i, ended)).otherwise(state)

    begin = opened(F.col("n_past"), F.lit(None).cast("array<struct<past:int,first:int,end:int>>"))
    begin = begin.withField("done", F.array().cast("array<struct<past:int,first:int,end:int>>"))
    last = F.size("turns")
    walk = F.when(F.col("n_past") < last, F.sequence(F.col("n_past"), last - 1)).otherwise(F.array().cast("array<int>"))
    end = lambda s: F.concat(s.done, F.array(F.struct(s.past.alias("past"), s.first.alias("first"), last.alias("end"))))
    return F.aggregate(walk, begin, step, end)


def windows(
    conversations: DataFrame,
    budget: int = BUDGET,
    history: int = HISTORY,
    tokens: Callable[[Column], Column] = lambda name: byte_tokens(F.col(name)),
) -> DataFrame:
    """(conv_id, part, number, text, loss, n_turns, n_repeated, n_tokens): conversations as training windows.

    A window holds the system turn a conversation starts with, whole turns of the window before it within ``history`` tokens,
    and then whole turns of its own, as many as fit ``budget`` tokens; a turn that is longer stands alone with the
    system turn and is not cut.  ``text`` is ``<turn>role<says>text</turn>`` and a line feed per turn; marks inside texts and roles get a
    backslash, which :func:`unescaped` takes off.  ``loss`` are (start, length) in code points of the assistant texts, of
    each in one window only: the first ``n_repeated`` turns of a window occur before and are masked, ``n_turns`` are new.

    Turns are ordered by number, ties by system first, role and text; turns without number come first.  Null roles and
    texts are empty, rows without conv_id are one conversation, rows that repeat a turn are turns of their own, a
    conversation of nothing but a system turn is one window, an empty table gives an empty one, other columns are ignored.

    A conversation of any length is cut into parts of 256 turn numbers, so a task holds a part, not a conversation; a part is given
    the system turn and the last 16 turns of the one before.  Only rows that repeat one turn number without end would meet in one task.
    """
    turn = F.struct("kind", "t", "later", "role", "text", "tokens")
    parts = _rows(conversations, tokens).groupBy("conv_id", "part").agg(F.sort_array(F.collect_list(turn)).alias("all"))
    parts = parts.where(F.exists("all", lambda x: x.kind == 2))
    first = F.get("all", F.lit(0))
    leads = (first.kind == 0) | ((first.kind == 2) & (first.role == SYSTEM))
    system = F.when(leads & first.text.isNotNull(), first)
    parts = parts.select("conv_id", "part", system.alias("system"), F.when(leads, F.slice("all", F.lit(2), F.size("all"))).otherwise(F.col("all")).alias("turns"))
    grown = F.aggregate("turns", F.array(F.lit(0).cast("long")), lambda s, x: F.concat(s, F.array(F.element_at(s, -1) + x.tokens)))
    past = F.size(F.filter("turns", lambda x: x.kind == 1))
    parts = parts.select("*", grown.alias("sums"), past.alias("n_past"), F.coalesce("system.tokens", F.lit(0)).alias("system_tokens"))
    spans = parts.select("*", F.posexplode(_spans(budget, history)).alias("number", "span"))
    spans = spans.withColumn("own_system", (F.col("system.kind") == 2) & (F.col("number") == 0))
    held = F.slice("turns", F.col("span.past") + 1, F.col("span.end") - F.col("span.past"))
    held = F.concat(F.when(F.col("system").isNull(), F.slice("turns", 1, 0)).otherwise(F.array("system")), held)
    n_system = F.when(F.col("system").isNull(), 0).otherwise(1)
    repeated = F.col("span.first") - F.col("span.past") + n_system - F.coalesce(F.col("own_system").cast("int"), F.lit(0))
    spans = spans.select("conv_id", "part", "number", held.alias("held"), repeated.alias("n_repeated"))
    shown = F.transform("held", lambda x: F.struct((x.role == TARGET).alias("target"), escaped(x.role).alias("role"), escaped(x.text).alias("text"), x.tokens.alias("tokens")))
    spans = spans.select("conv_id", "part", "number", shown.alias("shown"), "n_repeated")

    def placed(state: Column, x: Column) -> Column:
        start = state.at + len(OPEN) + len(SAYS) + F.char_length(x.role)
        learned = x.target & (state.turn >= F.col("n_repeated"))
        span = F.array(F.struct(start.alias("start"), F.char_length(x.text).alias("length")))
        after = start + F.char_length(x.text) + len(CLOSE) + 1
        return F.struct(after.alias("at"), (state.turn + 1).alias("turn"), F.when(learned, F.concat(state.loss, span)).otherwise(state.loss).alias("loss"))

    nothing = F.struct(F.lit(0).alias("at"), F.lit(0).alias("turn"), F.array().cast("array<struct<start:int,length:int>>").alias("loss"))
    return spans.select(
        "conv_id",
        "part",
        "number",
        F.array_join(F.transform("shown", lambda x: F.concat(F.lit(OPEN), x.role, F.lit(SAYS), x.text, F.lit(CLOSE + "\n"))), "").alias("text"),
        F.aggregate("shown", nothing, placed, lambda s: s.loss).alias("loss"),
        (F.size("shown") - F.col("n_repeated")).alias("n_turns"),
        "n_repeated",
        F.aggregate("shown", F.lit(0).cast("long"), lambda s, x: s + x.tokens).alias("n_tokens"),
    )


def turns_of(text: Column) -> Column:
    """(role, text) of every turn of a window's text, read back."""
    parts = F.split(text, CLOSE + "\n", -1)
    parts = F.slice(parts, F.lit(1), F.size(parts) - 1)

    def read(part: Column) -> Column:
        both = F.split(F.substr(part, F.lit(len(OPEN) + 1)), SAYS, 2)
        return F.struct(unescaped(F.get(both, F.lit(0))).alias("role"), unescaped(F.get(both, F.lit(1))).alias("text"))

    return F.transform(parts, read)


def learned_texts(text: Column, loss: Column) -> Column:
    """The texts under a window's loss mask, read back."""
    return F.transform(loss, lambda s: unescaped(F.substr(text, s.start + 1, s.length)))


def digest(found: DataFrame) -> DataFrame:
    """What :func:`windows` hold, per conversation: their new turns and learned texts, read back from their texts and masks.

    The checksum of a conversation takes its text as a whole, so one row holds it.
    """
    read = F.slice(turns_of(F.col("text")), F.col("n_repeated") + 1, F.greatest("n_turns", F.lit(0)))
    lines = F.array_join(F.transform(read, lambda x: F.concat(x.role, F.lit("\n"), x.text, F.lit("\n"))), "")
    window = F.struct("part", "number", lines.alias("turns"), F.array_join(learned_texts(F.col("text"), F.col("loss")), "").alias("learned"))
    per = found.groupBy("conv_id").agg(
        F.sum("n_turns").cast("long").alias("n_turns"),
        F.sum(F.char_length("text")).cast("long").alias("formatted_chars"),
        F.sort_array(F.collect_list(window)).alias("windows"),
    )
    learned = F.array_join("windows.learned", "")
    return per.select(
        "conv_id",
        "n_turns",
        F.sha2(F.array_join("windows.turns", ""), 256).alias("turns_sha256"),
        F.char_length(learned).cast("long").alias("loss_chars"),
        F.sha2(learned, 256).alias("loss_sha256"),
        "formatted_chars",
    )


def with_marks(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) of the table, and conversation -7, whose texts hold the template's own marks."""
    said = r"\### Assistant: </turn> ok"
    role = F.when(F.col("id") == 0, "user").otherwise(TARGET)
    rows = conversations.sparkSession.range(2).select(F.lit(-7).cast("long"), "id", role, F.lit(said))
    return conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text").union(rows)
