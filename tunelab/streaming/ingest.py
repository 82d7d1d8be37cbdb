"""Skip-existing ingest of history files.

The file source of Structured Streaming remembers in its checkpoint which
files it has read, so a second run takes up only new files, and a run that was
cut short is taken up where it stopped, without reading or writing twice.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tunelab.schemas import LOSS_COLUMNS, STEP_COLUMN, nan_to_null, quoted
from tunelab.sources.readers import csv_cells, decoded, exists


def history_stream(spark: SparkSession, folder: str, losses: Sequence[str] = LOSS_COLUMNS[:1]) -> DataFrame:
    """New ``{run}.csv`` files with the columns ``_step`` and the losses, in this order.

    A file with another header stops the ingest; it is never read by position.
    """
    schema = ", ".join([f"`{STEP_COLUMN}` long", *[f"`{c}` double" for c in losses]])
    files = spark.readStream.schema(schema).option("header", True).option("enforceSchema", False).option("pathGlobFilter", "*.csv").csv(folder)
    run = F.regexp_replace(decoded(F.col("_metadata.file_name")), "\\.csv$", "")
    return nan_to_null(files.withColumn("name", run).select("name", quoted(STEP_COLUMN), *map(quoted, losses)))


def ingest_histories(stream: DataFrame, table: str, checkpoint: str) -> None:
    """Append all histories that have come in since the last call, then stop."""
    query = (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start(table)
    )
    query.awaitTermination()


def file_stem(path: Column) -> Column:
    """Name of a file without ``.csv``."""
    return F.regexp_replace(decoded(F.element_at(F.split(path, "/"), -1)), "\\.csv$", "")


def line_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of new CSV files below a folder with the ``path`` of their file, whatever the files hold."""
    files = spark.readStream.option("pathGlobFilter", "*.csv").option("recursiveFileLookup", True).text(folder)
    return files.select("value", F.col("_metadata.file_path").alias("path"))


def sort_out(lines: DataFrame, losses: Sequence[str] = LOSS_COLUMNS, name: Callable[[Column], Column] = file_stem) -> tuple[DataFrame, DataFrame]:
    """Points of the readable files among ``lines`` (value, path), and the files that are not, with the reason.

    The header of a file is its line with a ``_step`` cell; cells are picked by their column's name, so files may differ in
    columns and their order.  A file is quarantined as a whole: without a header, without any of the losses, or with a row
    of another number of cells, a step or a loss that is no number.
    """
    cut = lines.where(F.btrim("value") != "").select("path", csv_cells(F.col("value")).alias("cells"))
    is_header = F.array_contains("cells", STEP_COLUMN)
    headers = cut.where(is_header).groupBy("path").agg(F.min("cells").alias("columns"))
    rows = cut.where(~is_header).join(headers, "path", "left")

    def cell(column: str) -> Column:
        return F.get("cells", F.array_position("columns", F.lit(column)).cast("int") - 1)

    def number(column: str) -> tuple[Column, Column]:
        text = F.nullif(F.btrim(cell(column)), F.lit(""))
        return text, text.try_cast("double")

    values = {c: number(c) for c in (STEP_COLUMN, *losses)}
    wrong = [F.when(text.isNotNull() & value.isNull(), f"{c} is no number") for c, (text, value) in values.items()]
    reason = F.coalesce(
        F.when(F.col("columns").isNull(), "no header"),
        F.when(~F.arrays_overlap("columns", F.array(*map(F.lit, losses))), "no loss column"),
        F.when(F.size("cells") != F.size("columns"), "a row of another length"),
        *wrong,
    )
    checked = rows.select(name(F.col("path")).alias("name"), "path", reason.alias("reason"), *[v.alias(c) for c, (_, v) in values.items()])
    bad = checked.groupBy("name", "path").agg(F.min("reason").alias("reason"), F.count("reason").alias("bad_rows")).where("bad_rows > 0")
    good = checked.join(bad.select("path"), "path", "left_anti")
    points = good.select("name", quoted(STEP_COLUMN).cast("long").alias(STEP_COLUMN), *map(quoted, losses))
    return nan_to_null(points), bad


def ingest_files(
    stream: DataFrame,
    table: str,
    quarantine: str,
    checkpoint: str,
    losses: Sequence[str] = LOSS_COLUMNS,
    name: Callable[[Column], Column] = file_stem,
) -> None:
    """Append the points of all files that have come in since the last call, then stop; unreadable files go to ``quarantine``.

    One bad file stops nothing.  A micro-batch writes its own partition of both tables, so one that is
    taken up again after a failure writes it again instead of adding to it, and a call without new files adds nothing.
    """

    def take(lines: DataFrame, batch: int) -> None:
        lines = lines.persist()
        points, bad = sort_out(lines, losses, name)
        points.write.mode("overwrite").parquet(f"{table.rstrip('/')}/batch={batch}")
        bad.write.mode("overwrite").parquet(f"{quarantine.rstrip('/')}/batch={batch}")
        lines.unpersist()

    query = stream.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def ingested_files(spark: SparkSession, table: str, quarantine: str) -> DataFrame:
    """(name, status, reason) of every ingested run: ``downloaded``, or ``failed`` and why; feeds ``runs.ingest_stats``."""
    schema = "name string, status string, reason string"
    if not exists(spark, f"{table.rstrip('/')}/batch=*"):
        return spark.createDataFrame([], schema)
    stored = spark.read.parquet(table).select("name").distinct()
    failed = spark.read.parquet(quarantine).groupBy("name").agg(F.min("reason").alias("reason"))
    both = stored.withColumn("stored", F.lit(True)).join(failed, "name", "full")
    status = F.when(F.col("stored"), "downloaded").otherwise("failed")
    return both.select("name", status.alias("status"), "reason")
