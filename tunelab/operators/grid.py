"""Hyper-parameter grids: enumeration, coverage, what is left to run."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tunelab.functions import names

# ---------------------------------------------------------------------------
# The experiment grid.
# ---------------------------------------------------------------------------
LEARNING_RATES = (1e-5, 1e-4, 1e-3)
LORA_RANKS = (1, 2, 4, 8, 16, 32, 64, 128, 256, 512)
MODEL_SIZES = ("8B", "70B")
# ---------------------------------------------------------------------------

POINT = ("model_size", "method", "learning_rate", "lora_rank")


@dataclass(frozen=True)
class Grid:
    """A grid; full fine-tuning has its own rates and the single rank 1."""

    model_sizes: Sequence[str] = MODEL_SIZES
    learning_rates: Sequence[float] = LEARNING_RATES
    lora_ranks: Sequence[int] = LORA_RANKS
    full_rates: Sequence[float] | None = None
    methods: Sequence[str] = field(default=("lora", "full"))

    def rates(self, method: str) -> Sequence[float]:
        if method == "full" and self.full_rates is not None:
            return self.full_rates
        return self.learning_rates

    def ranks(self, method: str) -> Sequence[int]:
        return self.lora_ranks if method == "lora" else (1,)


def _list(values: Sequence, dtype: str) -> Column:
    return F.array(*map(F.lit, values)).cast(f"array<{dtype}>")


def grid_points(spark: SparkSession, grid: Grid = Grid()) -> DataFrame:
    """All points of a grid in their order (model, method, rate, rank).

    Parameter lists are unfolded inside one row; no table is crossed with
    another.
    """
    per_method = F.array(
        *[
            F.struct(
                F.lit(method).alias("method"),
                _list(grid.rates(method), "double").alias("rates"),
                _list(grid.ranks(method), "int").alias("ranks"),
            )
            for method in grid.methods
        ]
    )
    return (
        spark.range(1)
        .select(F.posexplode(_list(grid.model_sizes, "string")).alias("i", "model_size"))
        .select("*", F.posexplode(per_method).alias("j", "m"))
        .select("i", "model_size", "j", "m", F.posexplode("m.rates").alias("k", "learning_rate"))
        .select("*", F.posexplode("m.ranks").alias("l", "lora_rank"))
        .select(F.struct("i", "j", "k", "l").alias("place"), F.col("m.method").alias("method"), "model_size",
                "learning_rate", "lora_rank")
    )


def _found_points(runs: DataFrame) -> DataFrame:
    """Distinct points of the grid runs; full fine-tuning matches whatever its rank."""
    rank = F.when(F.col("method") == "full", F.lit(1)).otherwise(F.col("lora_rank"))
    return (
        runs.where("is_grid_run")
        .select("model_size", "method", "learning_rate", rank.cast("int").alias("lora_rank"))
        .distinct()
    )


def missing(runs: DataFrame, grid: Grid = Grid()) -> DataFrame:
    """Grid points without a run."""
    points = grid_points(runs.sparkSession, grid)
    return points.join(_found_points(runs), list(POINT), "left_anti").select("place", *POINT)


def first_missing(gaps: DataFrame, n: int = 10) -> DataFrame:
    """The first ``n`` missing points in grid order, with the number of further ones.

    The one-partition window is over missing points, at most one per grid point.
    """
    more = F.greatest(F.lit(0).cast("long"), F.count(F.lit(1)).over(Window.partitionBy(F.lit(1))) - n)
    return gaps.withColumn("and_more", more).orderBy("place").limit(n).select(*POINT, "and_more")


def coverage(runs: DataFrame, grid: Grid = Grid()) -> DataFrame:
    """Expected and found points and the percentage, per model and over all."""
    found = _found_points(runs).withColumn("found", F.lit(1))
    points = grid_points(runs.sparkSession, grid).join(found, list(POINT), "left")
    expected = F.count(F.lit(1))
    hit = F.count("found")
    return points.groupingSets([[F.col("model_size")], []], F.col("model_size")).agg(
        expected.alias("total_expected"),
        hit.alias("total_found"),
        F.round(F.coalesce(F.try_divide(hit * 100.0, expected), F.lit(0.0)), 6).alias("coverage_percent"),
    ).select(F.coalesce("model_size", F.lit("all")).alias("model_size"), "total_expected", "total_found",
             "coverage_percent")


def planned_runs(points: DataFrame, base_dir: str) -> DataFrame:
    """Run id, job name and output folder of each point."""
    run = names.run_id(names.rate_text(F.col("learning_rate")), F.col("lora_rank"), F.col("method"),
                       F.col("model_size"))
    return points.select(
        *POINT, run.alias("run_id"), names.job_name(run).alias("job_name"),
        names.output_dir(base_dir, run).alias("output_dir"),
    )


def observed_grid(runs: DataFrame) -> DataFrame:
    """The full grid spanned by the parameters that occur in the runs.

    The distinct parameter values are few; they are gathered in one row and
    unfolded again.
    """
    lora = F.col("method") == "lora"
    axes = runs.where("is_grid_run").agg(
        F.collect_set("model_size").alias("sizes"),
        F.collect_set(F.when(lora, F.col("learning_rate"))).alias("rates"),
        F.collect_set(F.when(lora, F.col("lora_rank"))).alias("ranks"),
    )
    return (
        axes.select("rates", "ranks", F.explode("sizes").alias("model_size"))
        .select("model_size", "ranks", F.explode("rates").alias("learning_rate"))
        .select("model_size", F.lit("lora").alias("method"), "learning_rate", F.explode("ranks").alias("lora_rank"))
    )


def completed_folders(files: DataFrame, path: str = "path") -> DataFrame:
    """Output folders that hold at least one model file."""
    done = F.bool_or(names.is_model_file(F.col(path)))
    return (
        files.groupBy(F.regexp_extract(F.col(path), "^(.*)/[^/]+$", 1).alias("output_dir"))
        .agg(done.alias("done"))
        .where("done")
        .select("output_dir")
    )


def pending(plan: DataFrame, running_jobs: DataFrame, completed: DataFrame) -> DataFrame:
    """Planned runs that are neither running nor completed."""
    return plan.join(running_jobs.select("job_name"), "job_name", "left_anti").join(
        completed.select("output_dir"), "output_dir", "left_anti"
    )
