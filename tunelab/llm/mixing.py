"""Mixing sources to target weights, by hash-random order and distributed prefix sums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tunelab.llm.common import WORD, prefix_sums, stored, text_key

WEIGHTS = (5, 2, 1)
MOST_EPOCHS = 3
SEED = "mix"
#: Sources up to which the plan, a row per source, is broadcast.
PLAN_ROWS = 10_000


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_EPOCHS) -> DataFrame:
    """(no_source, source_key, source_size, target) of every source.

    Sources by code point, null last, take ``weights`` in turn and share all words; a target stops at ``most`` times its
    source's words.  Filling stops the sources with the least room per weight first, so after sorting by room per
    weight one pass of running sums finds the level at which the rest is shared.  The table has
    a row per source, not per document.
    """
    cycle = F.array(*map(F.lit, weights))
    per = sizes.groupBy("no_source", "source_key").agg(F.sum("size").alias("source_size"))
    turn = F.row_number().over(Window.orderBy("no_source", "source_key"))
    per = per.withColumn("weight", F.get(cycle, (turn - 1) % len(weights)).cast("long"))
    per = per.withColumn("cap", F.col("source_size") * most)
    per = per.withColumn("room", F.col("cap") / F.col("weight"))
    up = Window.orderBy("room", "no_source", "source_key").rowsBetween(Window.unboundedPreceding, -1)
    everywhere = Window.orderBy("room", "no_source", "source_key").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(everywhere) - F.coalesce(F.sum("cap").over(up), F.lit(0))
    shares = F.sum("weight").over(everywhere) - F.coalesce(F.sum("weight").over(up), F.lit(0))
    per = per.withColumn("level", left / shares)
    per = per.withColumn("level", F.max(F.when(F.col("room") > F.col("level"), F.col("level"))).over(everywhere))
    full = F.col("level").isNull() | (F.col("room") <= F.col("level"))
    target = F.when(full, F.col("cap").cast("double")).otherwise(F.col("level") * F.col("weight"))
    return per.select("no_source", "source_key", "source_size", target.alias("target"))


def _sized(docs: DataFrame, seed: str) -> list[Column]:
    of = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return [
        F.isnull("source").alias("no_source"),
        F.coalesce("source", F.lit("")).alias("source_key"),
        words(F.col("text")).alias("size"),
        text_key(F.lit(seed), of, F.lit("|"), F.coalesce("text", F.lit(""))).alias("key"),
    ]


def mix_plan(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_EPOCHS) -> DataFrame:
    """A row per source: its words, target, whole epochs, and the document at which the broken epoch ends.

    Equal documents are one entry of the prefix sums, so a text that repeats without end is one row.  At the cut each of
    them gives the same number of words.
    """
    targets = source_targets(sizes, weights, most)
    by = ["no_source", "source_key"]
    entries = sizes.groupBy(*by, "key", "doc_id", "size").agg(F.count("*").alias("copies"))
    entries = stored(entries.withColumn("all_words", F.col("size") * F.col("copies")), "entries")
    budget = F.round("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("long")
    targets = targets.withColumn("epochs", epochs).withColumn("rest", budget - F.col("epochs") * F.col("source_size"))
    placed = prefix_sums(entries, by, "key", ["doc_id"], "all_words", entries.count()).join(targets, by)
    across = placed.where(F.col("before") + F.col("all_words") > F.col("rest"))
    each = F.greatest(F.lit(0), F.floor((F.col("rest") - F.col("before")) / F.col("copies"))).cast("long").alias("cut_words")
    first = across.groupBy(*by).agg(F.min(F.struct("key", "doc_id", each)).alias("cut"))
    return stored(targets.join(first, by, "left").drop("rest"), "mix-plan")


def with_taken(sized: DataFrame, plan: DataFrame) -> DataFrame:
    """Add the plan of its source and ``taken`` to every row that has no_source, source_key, size, key and doc_id.

    The plan has a row per source; it is broadcast only if it has few.
    """
    if plan.count() <= PLAN_ROWS:
        plan = F.broadcast(plan)
    joined = sized.join(plan, ["no_source", "source_key"])
    here, cut = F.struct("key", "doc_id"), F.struct("cut.key", "cut.doc_id")
    part = F.when(here < cut, F.col("size")).when(here == cut, F.col("cut.cut_words")).otherwise(0)
    return joined.withColumn("taken", (F.col("epochs") * F.col("size") + part).cast("long")).drop("epochs", "cut")


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_EPOCHS, seed: str = SEED) -> DataFrame:
    """(doc_id, size, source_size, target, taken): how many words of each document the mix takes.

    Documents of a source are ordered by a random key that depends on ``seed``, doc_id and text alone, so
    reruns agree.  A source's budget is its target rounded to words.  Whole epochs are taken as often as
    they fit; in the last, broken one documents are taken in key order up to the exact budget, and the one that
    lies across it gives its first words only.  ``taken`` counts repeats and never exceeds ``most`` times the size.

    Null texts have size 0; a null source is a source of its own, the last.  Rows that repeat a doc_id are documents of
    their own; equal rows at the cut give equally many words.  An empty table gives an empty one; other
    columns are ignored.
    """
    sizes = stored(docs.select("doc_id", *_sized(docs, seed)), "sizes")
    taken = with_taken(sizes, mix_plan(sizes, weights, most))
    return taken.select("doc_id", "size", "source_size", "target", "taken")


def mixed_documents(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_EPOCHS, seed: str = SEED) -> DataFrame:
    """The mix itself: a row per time a document is taken, whole but for the one at a source's budget, which is cut.

    Columns are those of ``docs``; ``n_chars`` is the length of the text that is there.  Documents of which the mix takes
    no word are not returned, those without words among them.  Texts are not shuffled: the plan of the sources comes to them.
    """
    sizes = stored(docs.select("doc_id", *_sized(docs, seed)), "sizes")
    plan = mix_plan(sizes, weights, most)
    row = F.struct(*[F.col(c) for c in docs.columns]).alias("row")
    taken = with_taken(docs.select(row, "doc_id", *_sized(docs, seed)), plan).where("taken > 0")
    whole, rest = F.floor(F.col("taken") / F.col("size")).cast("int"), F.col("taken") % F.col("size")
    shares = F.concat(F.array_repeat("size", whole), F.array_repeat(rest, F.when(rest > 0, 1).otherwise(0)))
    taken = taken.withColumn("share", F.explode(shares))
    pieces = F.split("row.text", r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])", -1)
    head = F.array_join(F.slice(pieces, 1, F.col("share").cast("int")), "")
    text = F.when(F.col("share") < F.col("size"), head).otherwise(F.col("row.text"))
    taken = taken.withColumn("cut_text", text)
    new = {"text": F.col("cut_text"), "n_chars": F.char_length("cut_text").cast("long")}
    return taken.select(*[(new.get(c, F.col(f"row.{c}"))).alias(c) for c in docs.columns])
