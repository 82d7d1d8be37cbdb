"""Line dedup: lines that several documents share stay in one of them only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunelab.llm.common import LOWER, SPACES, UPPER, stored

MIN_CHARS = 20
MIN_DOCS = 3


def line_dedup(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """(doc_id, n_lines, n_dropped, text): the text without lines that ``min_docs`` or more documents share.

    Lines end at ``\\n``.  The key of a line is the line without outer white space, A-Z lower-cased.  Keys of
    ``min_chars`` code points or more that occur in ``min_docs`` documents or more lose all their lines, except in the
    largest doc_id that holds them, where all stay.

    Null and empty texts are one empty line.  A document is a doc_id: rows that repeat one are one document when
    documents are counted, and each is returned.  Rows without doc_id count as one document, smaller
    than all others.  An empty table gives an empty one; other columns are ignored.

    Keys are 16-byte hashes, worked out once and written.  Documents are counted by (key, document) first, so a line
    that a third of all documents share is spread over all tasks; the keys to drop are written, and the join against
    them is split where it is skewed.  Texts move once, to meet the positions they lose.
    """
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return _without_lines(texts, min_chars, min_docs)


def deduplicated(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``docs`` with the texts of :func:`line_dedup`, and ``n_chars``, where there is one, their new length."""
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.struct(*others or ["doc_id"]).alias("others"))
    found = _without_lines(texts, min_chars, min_docs)
    new = {"doc_id": F.col("doc_id"), "text": F.col("text"), "n_chars": F.char_length("text").cast("long")}
    return found.select(*[new.get(c, F.col("others").getField(c)).alias(c) for c in docs.columns])


def _without_lines(texts: DataFrame, min_chars: int, min_docs: int) -> DataFrame:
    others = [c for c in texts.columns if c not in ("doc_id", "text")]
    texts = texts.withColumn("same", F.xxhash64("text"))
    lines = texts.select("doc_id", "same", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    lines = lines.withColumn("key", F.translate(F.btrim("line", F.lit(SPACES)), UPPER, LOWER))
    lines = lines.where(F.char_length("key") >= min_chars).withColumn("key", F.unhex(F.md5("key")))
    lines = stored(lines.select("doc_id", "same", "pos", "key"), "lines")
    holders = lines.groupBy("key", "doc_id").agg(F.lit(1).alias("one"))
    shared = holders.groupBy("key").agg(F.count("*").alias("n"), F.max("doc_id").alias("last"))
    shared = stored(shared.where(F.col("n") >= min_docs).select("key", "last"), "shared-lines")
    lost = lines.join(shared, "key").where(~F.col("doc_id").eqNullSafe(F.col("last")))
    lost = lost.groupBy("doc_id", "same").agg(F.collect_set("pos").alias("gone"))
    lost = lost.select(F.col("doc_id").alias("lost_id"), F.col("same").alias("lost_same"), "gone")
    joined = texts.join(lost, F.col("doc_id").eqNullSafe(F.col("lost_id")) & (F.col("same") == F.col("lost_same")), "left")
    joined = joined.withColumn("parts", F.split("text", "\n", -1))
    stay = F.array_except(F.sequence(F.lit(0), F.size("parts") - 1), F.col("gone"))
    kept = F.array_join(F.transform(stay, lambda i: F.get("parts", i)), "\n")
    return joined.select(
        "doc_id",
        F.size("parts").cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("gone").isNull(), F.col("text")).otherwise(kept).alias("text"),
        *others,
    )
