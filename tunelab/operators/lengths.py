"""Prompt lengths: statistics and histogram per subset."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DIGITS = 6
BINS = 50


def length_stats(df: DataFrame, keys: Sequence[str], length: str = "length") -> DataFrame:
    """min, max, mean, median, population deviation, p95, p99 and count.

    ``percentile`` is exact; its state is one counter per distinct length and
    is combined on the map side, so it is bounded by the longest text, not by
    the rows of a subset.
    """
    at = F.percentile(length, F.array(F.lit(0.5), F.lit(0.95), F.lit(0.99)))
    return df.groupBy(*keys).agg(
        F.min(length).alias("min"),
        F.max(length).alias("max"),
        F.round(F.avg(length), DIGITS).alias("mean"),
        F.round(at[0], DIGITS).alias("median"),
        F.round(F.stddev_pop(length), DIGITS).alias("std"),
        F.round(at[1], DIGITS).alias("p95"),
        F.round(at[2], DIGITS).alias("p99"),
        F.count(length).alias("count"),
    )


def length_histogram(df: DataFrame, keys: Sequence[str], length: str = "length", bins: int = BINS) -> DataFrame:
    """Equal-width bins from the shortest to the longest, the last one closed.

    The rows are first counted per distinct length; limits and bins are then
    worked out on that small table.  All bins are listed, empty ones too.  With
    one distinct length the range is half a unit to either side.
    """
    counted = df.groupBy(*keys, length).agg(F.count(F.lit(1)).alias("n"))
    counted = counted.select(*keys, F.col(length).cast("double").alias("x"), "n")
    group = Window.partitionBy(*keys)
    limits = counted.withColumns({"lo": F.min("x").over(group), "hi": F.max("x").over(group)}).where("x is not null")
    flat = F.col("lo") == F.col("hi")
    limits = limits.withColumns(
        {
            "lo": F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")),
            "hi": F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi")),
        }
    ).withColumn("width", (F.col("hi") - F.col("lo")) / bins)

    # Rounding can put a value on an edge into the bin next to it; compare with
    # the edges themselves and step over.
    guess = F.least(F.floor((F.col("x") - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins), F.lit(bins - 1))
    left = F.col("lo") + F.col("guess") * F.col("width")
    right = F.col("lo") + (F.col("guess") + 1) * F.col("width")
    placed = limits.withColumn("guess", guess).withColumn(
        "bin",
        F.when(F.col("x") < left, F.col("guess") - 1)
        .when((F.col("guess") < bins - 1) & (F.col("x") >= right), F.col("guess") + 1)
        .otherwise(F.col("guess"))
        .cast("int"),
    )
    filled = placed.groupBy(*keys, "lo", "width", "bin").agg(F.sum("n").alias("n"))
    tables = filled.groupBy(*keys, "lo", "width").agg(
        F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("table")
    )
    every = tables.select(*keys, "lo", "width", "table", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return every.select(
        *keys,
        "bin",
        F.round(F.col("lo") + F.col("bin") * F.col("width"), DIGITS).alias("bin_start"),
        F.coalesce(F.try_element_at("table", "bin"), F.lit(0).cast("long")).alias("n"),
    )
