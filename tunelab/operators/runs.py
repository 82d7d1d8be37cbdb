"""Run metadata: names, filters, summaries, matching and ingest status."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunelab.functions import names
from tunelab.schemas import quoted, union_all

CONFIG_KEYS = ("model_size", "method", "learning_rate", "lora_rank")


def parse_names(runs: DataFrame) -> DataFrame:
    """Add the fields parsed from ``name``.

    They are unfolded from one struct, so each run is parsed once: a later
    condition on a field reads the field and does not repeat the pattern.
    """
    fields = [value.alias(field) for field, value in names.run_name_fields(F.col("name")).items()]
    return runs.select("*", F.inline(F.array(F.struct(*fields))))


def overview(raw: DataFrame) -> DataFrame:
    """Raw runs with config (without private keys) and summary as JSON text."""
    return raw.select(
        "name",
        "id",
        "state",
        "created_at",
        F.to_json(names.public_config(F.col("config"))).alias("config"),
        F.to_json("summary").alias("summary"),
    )


def filter_runs(
    runs: DataFrame,
    model_size: str | None = None,
    method: str | None = None,
    learning_rate: float | None = None,
    lora_rank: int | None = None,
    state: str = "finished",
) -> DataFrame:
    """Runs in ``state`` that meet every given criterion."""
    tests: list[Column] = [F.col("state") == state]
    if model_size:
        tests.append(F.col("model_size") == model_size)
    if method:
        tests.append(F.col("method") == method)
    if learning_rate is not None:
        tests.append(F.col("learning_rate") == F.lit(float(learning_rate)))
    if lora_rank is not None:
        tests.append(F.col("lora_rank") == lora_rank)
    return runs.where(reduce(and_, tests))


def first_per_config(runs: DataFrame, keep: Sequence[str] = ("run_id", "name")) -> DataFrame:
    """The earliest run of each configuration, ties by id.

    An aggregate, not a window: each map task passes on one row per
    configuration, however many runs a configuration has.
    """
    row = F.struct(*keep)
    first = F.min_by(row, F.struct("created_at", "run_id"))
    return runs.groupBy(*CONFIG_KEYS).agg(first.alias("first")).select(*CONFIG_KEYS, "first.*")


def summary(runs: DataFrame) -> DataFrame:
    """One row: totals, runs per state, and the sorted distinct hyper-parameters of the grid runs.

    Counted per state first; the few state rows are then put together.
    """
    grid = F.col("is_grid_run")
    counts = {
        "total_runs": F.count(F.lit(1)),
        "grid_runs": F.count_if(grid),
        "lora_runs": F.count_if(grid & (F.col("method") == "lora")),
        "full_ft_runs": F.count_if(grid & (F.col("method") == "full")),
        "other_runs": F.count_if(~grid),
    }
    distinct = {"learning_rates": "learning_rate", "lora_ranks": "lora_rank", "model_sizes": "model_size"}
    per_state = runs.groupBy("state").agg(
        *[value.alias(name) for name, value in counts.items()],
        *[F.collect_set(F.when(grid, F.col(column))).alias(name) for name, column in distinct.items()],
    )
    states = F.filter(F.collect_list(F.struct("state", "total_runs")), lambda s: s["state"].isNotNull())
    return per_state.agg(
        *[F.coalesce(F.sum(name), F.lit(0).cast("long")).alias(name) for name in counts],
        F.map_from_entries(states).alias("states"),
        *[F.array_sort(F.array_distinct(F.flatten(F.collect_list(name)))).alias(name) for name in distinct],
    )


def counts_by(runs: DataFrame, column: str) -> DataFrame:
    return runs.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def mark_members(runs: DataFrame, members: DataFrame, flag: str, on: str = "name") -> DataFrame:
    """Flag the runs whose name occurs in ``members``.

    Both halves of a semi/anti split come out of one join.
    """
    known = members.select(on).distinct().withColumn(flag, F.lit(True))
    return runs.join(known, on, "left").withColumn(flag, F.coalesce(flag, F.lit(False)))


def split_members(runs: DataFrame, members: DataFrame, on: str = "name") -> tuple[DataFrame, DataFrame]:
    """Runs whose name occurs in ``members``, and the others."""
    known = members.select(on)
    return runs.join(known, on, "left_semi"), runs.join(known, on, "left_anti")


def update_final_loss(runs: DataFrame, losses: DataFrame) -> DataFrame:
    """Replace ``final_loss`` by the losses; the number of runs stays.

    ``losses`` may name a run more than once; any one loss of it is kept (they
    were read from the same history).
    """
    unique = losses.groupBy("name").agg(F.max("final_loss").alias("final_loss"))
    return runs.drop("final_loss").join(unique, "name", "left")


def with_final_loss(runs: DataFrame, losses: DataFrame) -> DataFrame:
    """Grid runs with their final loss, which is looked up only when the column is absent."""
    grid_runs = runs.where("is_grid_run")
    return grid_runs if "final_loss" in runs.columns else update_final_loss(grid_runs, losses)


def attach_metric(runs: DataFrame, values: DataFrame, column: str, on: str = "name") -> DataFrame:
    """Write a metric into every run of that name; other runs keep their value.

    Of several values for a name the largest counts; the number of runs stays.
    """
    new = values.groupBy(on).agg(F.max(quoted(column)).alias("_new"))
    old = quoted(column) if column in runs.columns else F.lit(None).cast("double")
    return runs.join(new, on, "left").withColumn(column, F.coalesce(F.col("_new"), old)).drop("_new")


def matched_metrics(runs: DataFrame, values: DataFrame, column: str, on: str = "name") -> DataFrame:
    """One row per run that a metric was found for, the largest of several."""
    return runs.join(values.groupBy(on).agg(F.max(quoted(column)).alias(column)), on, "inner")


def unmatched(values: DataFrame, runs: DataFrame, on: str = "name") -> DataFrame:
    """Metrics whose name no run has (each is worth a warning)."""
    return values.join(runs.select(on), on, "left_anti")


def ingest_status(
    incoming: DataFrame, ingested: DataFrame, has_history: str = "has_history", overwrite: bool = False
) -> DataFrame:
    """What a history ingest does with each incoming run.

    Histories are stored per name.  A run is ``skipped`` when its name is
    already stored, also when an earlier run (by ``created_at``, ``run_id``) of
    the same name stores it; ``downloaded`` when it has a history; else
    ``failed``.  With ``overwrite`` nothing is skipped.
    """
    if overwrite:
        return incoming.withColumn("status", F.when(F.col(has_history), "downloaded").otherwise("failed"))
    order = F.struct("created_at", "run_id")
    # One row per name tells both, so the incoming runs are joined once and
    # adaptive execution may split a name that many runs share.
    stored = ingested.select("name", F.lit(True).alias("_stored"))
    with_history = incoming.where(F.col(has_history)).select("name", order.alias("_first"))
    by_name = (
        union_all([stored, with_history], allow_missing=True)
        .groupBy("name")
        .agg(F.coalesce(F.bool_or("_stored"), F.lit(False)).alias("_stored"), F.min("_first").alias("_first"))
    )
    skipped = F.coalesce(F.col("_stored") | (order > F.col("_first")), F.lit(False))
    status = F.when(skipped, "skipped").when(F.col(has_history), "downloaded").otherwise("failed")
    return incoming.join(by_name, "name", "left").withColumn("status", status).drop("_stored", "_first")


def ingest_new(incoming: DataFrame, ingested: DataFrame) -> DataFrame:
    """Incoming runs whose history is not stored yet."""
    return incoming.join(ingested.select("name"), "name", "left_anti")


def ingest_stats(status: DataFrame, kind: str = "kind") -> DataFrame:
    """Runs per status for each kind of run."""
    return status.groupBy(kind).agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(F.col("status") == s).alias(s) for s in ("downloaded", "skipped", "failed")],
    )
