"""Writers.  Each writes one table; none gathers rows on the driver."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunelab.operators import runs as run_ops
from tunelab.operators.checkpoints import CHECKPOINT
from tunelab.schemas import GRID_RESULT_COLUMNS, quoted


def write_dataset(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).parquet(path)


def write_by(df: DataFrame, columns: Sequence[str], path: str, mode: str = "errorifexists") -> None:
    """Write one folder per key.

    ``REBALANCE`` groups rows of a key into few files and splits a key that
    holds too many rows for one task.
    """
    df.hint("rebalance", *columns).write.mode(mode).partitionBy(*columns).parquet(path)


def _write_report(df: DataFrame, path: str, order: Sequence[str]) -> None:
    df.orderBy(*map(quoted, order)).write.mode("overwrite").option("header", True).csv(path)


def grid_results_path(grid_dir: str, checkpoint: str = CHECKPOINT) -> str:
    return f"{grid_dir.rstrip('/')}/eval_results_{checkpoint}.csv"


def write_grid_results(results: DataFrame, path: str) -> None:
    """Grid results in their fixed column order."""
    _write_report(results.select(*GRID_RESULT_COLUMNS), path, ["model_folder", "subset"])


def write_overview(raw_runs: DataFrame, path: str) -> None:
    """Run overview with config and summary as text."""
    _write_report(run_ops.overview(raw_runs), path, ["created_at", "id"])


def write_parsed_runs(raw_runs: DataFrame, path: str) -> None:
    """Parsed run table; the final loss is filled in after the histories are read."""
    parsed = run_ops.parse_names(raw_runs.select("name", "id", "state", "created_at"))
    _write_report(parsed.withColumn("final_loss", F.lit(None).cast("double")), path, ["created_at", "id"])


def write_summary(runs: DataFrame, path: str) -> None:
    """Run totals, state counts and distinct parameters as one JSON object."""
    run_ops.summary(runs).write.mode("overwrite").json(path)


def write_inventory(stats: DataFrame, path: str, at: Column | None = None) -> None:
    """Ingest counts per kind of run, with the time of the ingest."""
    stamp = F.date_format(at if at is not None else F.current_timestamp(), "yyyy-MM-dd HH:mm:ss")
    counts = F.struct("total", "downloaded", "skipped", "failed")
    wide = stats.groupBy().agg(
        *[F.first(F.when(F.col("kind") == k, counts), ignorenulls=True).alias(f"{k}_runs") for k in ("grid", "other")]
    )
    wide.select(stamp.alias("download_date"), "*").write.mode("overwrite").json(path)


def write_metrics(tables: Mapping[str, DataFrame], path: str, keys: Sequence[str] = ("model_folder", "subset")) -> None:
    """Prediction, report, confusion and distribution tables, each keyed by its folder."""
    for name, table in tables.items():
        write_by(table, keys, f"{path.rstrip('/')}/{name}", mode="overwrite")


def append_metric(values: DataFrame, path: str, metric: str, batch: str, run: str = "name") -> None:
    """Add a metric per run to the metric history, as one batch, which takes the place of an earlier write of that batch.

    ``batch`` names the job that measured the values.  A job that is run again writes the same partition again, so the
    history holds every value once; other metrics and batches are not touched.
    """
    row = values.select(
        quoted(run).alias("name"),
        quoted(metric).cast("double").alias("value"),
        F.current_timestamp().alias("logged_at"),
        F.lit(metric).alias("metric"),
        F.lit(batch).alias("batch"),
    )
    row.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("metric", "batch").parquet(path)
