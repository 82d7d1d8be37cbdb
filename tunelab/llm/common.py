"""Helpers that the operators share: stored tables, hash keys, prefix sums, linked components."""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

#: White space of the contracts, for a trim and inside a character class.
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Bytes of one Arrow batch: bounds what a Python worker holds, however long the texts are.
BATCH_BYTES = 8 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share (``spark.checkpoint.dir``); one of our own only where it is unset, as in tests."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="llm-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table below the shared folder and read it back: lineage ends here, and a lost executor loses nothing."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm/{name}-{uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bounded_batches(spark: SparkSession) -> None:
    """Cut Arrow batches by size, so that a batch of very long texts stays as small as one of short texts."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def text_key(*parts: Column) -> Column:
    """A 60-bit key, the same in every run and engine: the first 15 hex digits of an MD5."""
    return F.conv(F.substring(F.md5(F.concat(*parts)), 1, 15), 16, 10).cast("long")


KEY_BITS = 60


def prefix_sums(df: DataFrame, by: list[str], key: str, ties: list[str], value: str, rows: int, levels: int = 2) -> DataFrame:
    """Add ``before``: the sum of ``value`` over the earlier rows of the same ``by``, in the order of ``key``, ``ties``.

    ``key`` holds uniform 60-bit numbers.  Its leading bits cut every group into ranges of a few hundred
    rows, however large the group is; only a range is sorted in one task.  Sums of the ranges are summed up the same
    way with fewer bits, so no level sorts many rows in one task.  ``by`` must not hold nulls.
    """
    bits = max(0, min(40, (max(rows, 1) // 256).bit_length()))
    return _prefix(df, by, key, KEY_BITS, ties, value, bits, levels).withColumn("before", F.coalesce("before", F.lit(0)))


def _prefix(df: DataFrame, by: list[str], key: str, width: int, ties: list[str], value: str, bits: int, levels: int) -> DataFrame:
    if bits == 0 or levels == 0:
        sums = Window.partitionBy(*by).orderBy(key, *ties).rowsBetween(Window.unboundedPreceding, -1)
        return df.withColumn("before", F.coalesce(F.sum(value).over(sums), F.lit(0)))
    cut = f"range{levels}"
    ranged = df.withColumn(cut, F.shiftright(key, width - bits))
    totals = ranged.groupBy(*by, cut).agg(F.sum(value).alias("range_sum"))
    totals = _prefix(totals, by, cut, bits, [], "range_sum", bits // 2, levels - 1)
    totals = totals.select(*by, cut, F.col("before").alias("range_before"))
    inner = Window.partitionBy(*by, cut).orderBy(key, *ties).rowsBetween(Window.unboundedPreceding, -1)
    joined = ranged.join(totals, [*by, cut])
    joined = joined.withColumn("before", F.coalesce(F.sum(value).over(inner), F.lit(0)) + F.col("range_before"))
    return joined.drop(cut, "range_before")


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Connected components of a link table: (``node``, ``root``), root being the smallest node; linked nodes only.

    Alternates large-star and small-star steps.  A step is a map-side combined minimum per node and a join back; the
    minima are written first, so both sides of the join are plain shuffles and a hub is split by the
    skew join.  Links of every step are written below the shared folder; only their count and
    checksum, observed while they are written, reach the driver.
    """
    pairs = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u != v")
    pairs = stored(pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    seen = None
    while True:
        both = pairs.union(pairs.select("v", "u"))
        lowest = stored(both.groupBy("u").agg(F.min("v").alias("m")), "lowest")
        larger = both.join(lowest, "u").where("v > u").select(F.col("v").alias("u"), F.least("m", "u").alias("v"))
        pairs = stored(larger.where("u != v"), "links")
        lowest = stored(pairs.groupBy("u").agg(F.min("v").alias("m")), "lowest")
        smaller = pairs.join(lowest, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        kept = Observation()
        checksum = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("checksum")
        pairs = smaller.where("u != v").distinct().observe(kept, F.count(F.lit(1)).alias("n"), checksum)
        pairs = stored(pairs, "links")
        if kept.get == seen:
            return pairs.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = kept.get
