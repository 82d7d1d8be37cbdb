"""Data behind the experiment report: sweeps, heat-map, curves, benchmark.

Inputs are run tables (one row per run) and histories.  Whatever is small here
is small by construction: distinct (model, rate, rank) points of a grid.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tunelab.functions import names
from tunelab.operators import runs as run_ops
from tunelab.operators.grid import LEARNING_RATES, MODEL_SIZES
from tunelab.operators.history import TAIL_POINTS, last_points
from tunelab.schemas import STEP_COLUMN, quoted

# ---------------------------------------------------------------------------
# Fixed values of the report.
# ---------------------------------------------------------------------------
DIVERGED_LOSS = 2.0
DIVERGED_MODEL, DIVERGED_RANK, DIVERGED_RATE = "70B", 1, 1e-3
CURVE_RANKS = {"8B": (1, 2, 4, 8, 16, 32, 64, 128, 256), "70B": (16, 64, 512)}
LORA_TO_FULL_RATE = {1e-3: 1e-4, 1e-4: 1e-5, 1e-5: 1e-6}
COMPARED = ((1e-3, 64), (1e-3, 256), (1e-4, 64), (1e-4, 256))
BASELINE = {"8B": 0.271, "70B": 0.331}
AXIS_MARGIN = 0.05
BENCH_SUBSET = "mcq_4_choices"
# ---------------------------------------------------------------------------

DIGITS = 8
SERIES = ("model_size", "method", "lora_rank")


def is_diverged_cell(rate: str = "learning_rate", rank: str = "lora_rank") -> Column:
    """The one configuration known to diverge; false for runs without a rank."""
    cell = (
        (F.col("model_size") == DIVERGED_MODEL)
        & (F.col(rank) == DIVERGED_RANK)
        & (F.col(rate) == F.lit(DIVERGED_RATE))
    )
    return F.coalesce(cell, F.lit(False))


def converged(runs: DataFrame) -> DataFrame:
    """Finished runs with a loss below the divergence limit; NaN counts as missing."""
    loss = F.col("final_loss")
    kept = loss.isNotNull() & ~F.isnan(loss) & (loss < DIVERGED_LOSS)
    return run_ops.filter_runs(runs).where(kept)


def rate_sweep(runs: DataFrame, min_points: Mapping[str, int] | None = None) -> DataFrame:
    """Final loss over learning rate, per (model, method, rank) series.

    Series with too few points are left out: by default LoRA needs two, full
    fine-tuning one.  ``place`` is the position of the rate within its series.
    """
    least = min_points or {"lora": 2, "full": 1}
    points = (
        converged(runs)
        .where(~is_diverged_cell())
        .where(F.col("method").isin(*least))
        .select(*SERIES, "learning_rate", "final_loss", F.coalesce("lora_rank", F.lit(0)).alias("series_rank"))
    )
    needed = F.lit(None).cast("int")
    for method, n in least.items():
        needed = F.when(F.col("method") == method, n).otherwise(needed)
    series = ["model_size", "method", "series_rank"]
    full = points.groupBy(*series).agg(F.count("final_loss").alias("n")).where(F.col("n") >= needed)
    along = F.row_number().over(Window.partitionBy(*series).orderBy("learning_rate"))
    places = points.select(*series, "learning_rate").distinct().withColumn("place", along)
    kept = points.join(full, series, "left_semi").join(places, [*series, "learning_rate"])
    return kept.select(*SERIES, "learning_rate", "place", "final_loss")


def mean_loss(runs: DataFrame) -> DataFrame:
    """Mean final loss of the LoRA runs per (model, rate, rank), whatever their state."""
    return (
        runs.where(F.col("method") == "lora")
        .groupBy("model_size", "learning_rate", "lora_rank")
        .agg(F.round(F.avg("final_loss"), DIGITS).alias("final_loss"))
    )


def heatmap(runs: DataFrame, metric: str = "final_loss") -> DataFrame:
    """Mean metric of finished LoRA runs per (model, rank, rate): the cells of the map, whatever rates were run."""
    lora = run_ops.filter_runs(runs, method="lora")
    cells = lora.groupBy("model_size", "lora_rank", "learning_rate").agg(F.round(F.avg(metric), DIGITS).alias(metric))
    return cells.select("model_size", "lora_rank", names.rate_text(F.col("learning_rate")).alias("lr"), metric)


def best_rate(runs: DataFrame, by: Sequence[str] = ("model_size", "method")) -> DataFrame:
    """Learning rate with the least final loss; the smaller rate on ties.

    Runs are first reduced to one loss per rate, by a plain hash aggregate.
    """
    per_rate = converged(runs).where("is_grid_run").groupBy(*by, "learning_rate").agg(F.min("final_loss").alias("loss"))
    best = F.min(F.struct("loss", "learning_rate")).alias("best")
    return per_rate.groupBy(*by).agg(best).select(
        *by, F.col("best.learning_rate").alias("learning_rate"), F.col("best.loss").alias("final_loss")
    )


def full_vs_lora(runs: DataFrame) -> DataFrame:
    """Least loss of both methods per model, and how far full fine-tuning is below, in percent."""
    def least(method: str) -> Column:
        return F.min(F.when(F.col("method") == method, F.col("final_loss")))

    both = converged(runs).where("is_grid_run").groupBy("model_size").agg(
        least("lora").alias("lora_loss"), least("full").alias("full_loss")
    )
    gap = F.try_divide(F.col("lora_loss") - F.col("full_loss"), F.col("lora_loss")) * 100
    return both.withColumn("gap_percent", F.round(gap, 6))


def pair_rates(runs: DataFrame, pairs: Mapping[float, float] = LORA_TO_FULL_RATE) -> DataFrame:
    """Each LoRA rate next to the full fine-tuning run at the paired (lower) rate.

    One row per (model, LoRA rate) that has LoRA runs; the full run is the
    first of its configuration, null without one.
    """
    finished = run_ops.filter_runs(runs).where("is_grid_run")
    lookup = F.create_map(*[F.lit(v) for pair in pairs.items() for v in pair])
    lora = (
        finished.where(F.col("method") == "lora")
        .groupBy("model_size", F.col("learning_rate").alias("lora_rate"))
        .agg(F.min("final_loss").alias("lora_loss"))
        .withColumn("full_rate", F.try_element_at(lookup, "lora_rate"))
        .where("full_rate is not null")
    )
    full = run_ops.first_per_config(
        finished.where(F.col("method") == "full"), keep=("name", "final_loss")
    ).select(
        "model_size",
        F.col("learning_rate").alias("full_rate"),
        F.col("name").alias("full_run"),
        F.col("final_loss").alias("full_loss"),
    )
    return lora.join(full, ["model_size", "full_rate"], "left").select(
        "model_size", "lora_rate", "full_rate", "lora_loss", "full_run", "full_loss"
    )


def _rank_list(ranks: Mapping[str, Sequence[int]]) -> Column:
    return F.create_map(
        *[v for model, values in ranks.items() for v in (F.lit(model), F.array(*map(F.lit, values)))]
    )


def available_ranks(runs: DataFrame, ranks: Mapping[str, Sequence[int]] = CURVE_RANKS) -> DataFrame:
    """Representative ranks that finished LoRA runs have, per model."""
    seen = run_ops.filter_runs(runs, method="lora").select("model_size", "lora_rank")
    wanted = (
        runs.sparkSession.range(1)
        .select(F.explode(_rank_list(ranks)).alias("model_size", "ranks"))
        .select("model_size", F.explode("ranks").alias("lora_rank"))
    )
    return seen.intersect(wanted)


def _chosen(runs: DataFrame, condition: Column) -> DataFrame:
    """First finished LoRA run of each configuration that meets the condition."""
    return run_ops.first_per_config(run_ops.filter_runs(runs, method="lora").where(condition), keep=("name",))


def _with_history(chosen: DataFrame, history: DataFrame, loss: str, run: str, step: str) -> DataFrame:
    """Curve points of chosen runs.

    ``chosen`` has at most one row per named (model, rate, rank), so it is
    small whatever the histories weigh; broadcasting it leaves the histories
    unshuffled, and a hot run is read where it lies.
    """
    points = history.where(quoted(loss).isNotNull()).select(
        F.col(run).alias("name"), quoted(step).alias("step"), quoted(loss).alias("loss")
    )
    return points.join(F.broadcast(chosen), "name")


def learning_curves(
    runs: DataFrame,
    history: DataFrame,
    ranks: Mapping[str, Sequence[int]] = CURVE_RANKS,
    rates: Sequence[float] = LEARNING_RATES,
    pairs: Mapping[float, float] = LORA_TO_FULL_RATE,
    loss: str = "train/loss",
    run: str = "name",
    step: str = STEP_COLUMN,
) -> DataFrame:
    """Loss per step of the chosen runs, per panel (model, LoRA rate ``lr``); ``panel_place`` counts rates from the highest.

    Chosen are the first LoRA run of each representative rank and the first full
    fine-tuning run at the paired (lower) rate ``run_lr``.
    """
    listed = F.array_contains(F.try_element_at(_rank_list(ranks), F.col("model_size")), F.col("lora_rank"))
    wanted = F.col("lora_rank").isNotNull() & F.coalesce(listed, F.lit(False)) & F.col("learning_rate").isin(*rates)
    lora = _chosen(runs, wanted).withColumn("panel", F.col("learning_rate"))
    lookup = F.create_map(*[F.lit(v) for pair in pairs.items() for v in pair])
    panels = lora.select("model_size", "panel", F.try_element_at(lookup, "panel").alias("learning_rate")).distinct()
    full = run_ops.first_per_config(run_ops.filter_runs(runs, method="full"), keep=("name",))
    chosen = lora.unionByName(full.join(panels, ["model_size", "learning_rate"]).select(*lora.columns))
    return _with_history(chosen, history, loss, run, step).select(
        "model_size",
        names.rate_text(F.col("panel")).alias("lr"),
        F.array_position(F.array(*map(F.lit, sorted(rates, reverse=True))), F.col("panel")).cast("int").alias("panel_place"),
        "method",
        "lora_rank",
        names.rate_text(F.col("learning_rate")).alias("run_lr"),
        "name",
        "step",
        "loss",
    )


def curve_tail(curves: DataFrame, n: int = TAIL_POINTS) -> DataFrame:
    """The last ``n`` points of every chosen run: the inset of the curves."""
    return last_points(curves, "name", "step", n)


def model_comparison(
    runs: DataFrame,
    history: DataFrame,
    configs: Sequence[tuple[float, int]] = COMPARED,
    models: Sequence[str] = MODEL_SIZES,
    loss: str = "train/loss",
    run: str = "name",
    step: str = STEP_COLUMN,
) -> DataFrame:
    """Both models at the same (rate, rank), one loss column per model."""
    cells = [(F.col("learning_rate") == F.lit(rate)) & (F.col("lora_rank") == rank) for rate, rank in configs]
    wanted = reduce(or_, cells) & F.col("model_size").isin(*models)
    points = _with_history(_chosen(runs, wanted), history, loss, run, step)
    return points.groupBy(
        names.rate_text(F.col("learning_rate")).alias("lr"), "lora_rank", "step"
    ).agg(*[F.max(F.when(F.col("model_size") == m, F.col("loss"))).alias(f"loss_{m.lower()}") for m in models])


def axis_limits(runs: DataFrame, margin: float = AXIS_MARGIN) -> DataFrame:
    """Range of the pooled LoRA and full losses per model, widened on both sides."""
    low, high = F.min("final_loss"), F.max("final_loss")
    pad = (high - low) * margin
    pooled = converged(runs).where(F.col("method").isin("lora", "full"))
    return pooled.groupBy("model_size").agg(
        F.round(low - pad, DIGITS).alias("y_min"), F.round(high + pad, DIGITS).alias("y_max")
    )


def task_accuracy(task: DataFrame) -> DataFrame:
    """Task accuracy in percent over log2(rank), without the diverged cell."""
    return task.where(~is_diverged_cell("lr", "rank")).select(
        "model_size",
        F.col("lr"),
        "rank",
        F.round(F.log2(F.col("rank").cast("double")), 10).alias("log2_rank"),
        F.round(F.col("eval_accuracy") * 100, DIGITS).alias("accuracy_percent"),
    )


def rank_series(task: DataFrame) -> DataFrame:
    """Position of each rank within its (model, rate) series; one row per point comes in."""
    series = Window.partitionBy("model_size", "lr").orderBy("rank")
    return task.where(~is_diverged_cell("lr", "rank")).withColumn("position", F.dense_rank().over(series) - 1)


def benchmark_series(merged: DataFrame) -> DataFrame:
    """Mean benchmark accuracy and loss over the ranks of each (model, rate), with the ``place`` of the rank."""
    points = merged.groupBy("model_size", "learning_rate", "lora_rank").agg(
        F.round(F.avg("accuracy"), DIGITS).alias("accuracy"), F.max("final_loss").alias("final_loss")
    )
    along = Window.partitionBy("model_size", "learning_rate").orderBy("lora_rank")
    return points.withColumn("place", F.row_number().over(along))


def plateau_gap(task: DataFrame) -> DataFrame:
    """Distance of each rank to the best rank of its (model, rate); one row per point comes in."""
    best = F.max("eval_accuracy").over(Window.partitionBy("model_size", "lr"))
    return task.where(~is_diverged_cell("lr", "rank")).select(
        "model_size", "lr", "rank", F.round(best - F.col("eval_accuracy"), DIGITS).alias("gap")
    )


def unpivot_benchmark(
    wide: DataFrame, models: Sequence[str] = MODEL_SIZES, subset: str = BENCH_SUBSET
) -> DataFrame:
    """Wide benchmark export (a column per model folder) to one row per value.

    For each model the rows are those whose name holds ``grid_{m}_lora`` or
    matches ``lr.*lora_{m}``, and the columns those that name the model and the
    subset's accuracy.  A row may serve both models.
    """
    metrics = [c for c in wide.columns if f"{subset}/accuracy" in c]
    if not metrics:
        raise ValueError(f"no accuracy column of {subset}")
    # One map per row, unfolded: cheaper to plan and to run than one projection
    # per column, since there is a column per model folder.
    values = F.array(*map(quoted, metrics)).cast("array<double>")
    table = F.map_from_arrays(F.array(*map(F.lit, metrics)), values)
    long = wide.select("name", F.explode(table).alias("metric", "value"))
    return benchmark_cells(long, models, subset)


def benchmark_cells(cells: DataFrame, models: Sequence[str] = MODEL_SIZES, subset: str = BENCH_SUBSET) -> DataFrame:
    """Benchmark accuracies among the cells (name, metric, value) of wide exports, one row per value.

    The same rows as :func:`unpivot_benchmark`; a value that is no number is none.
    """
    value = F.col("value").try_cast("double")
    long = cells.where(F.col("metric").contains(f"{subset}/accuracy")).select("name", "metric", value.alias("accuracy"))
    fits = [
        F.when(
            F.coalesce(
                F.col("name").contains(f"grid_{m}_lora") | F.col("name").rlike(f"lr.*lora_{m}"), F.lit(False)
            )
            & F.col("metric").contains(m),
            m,
        )
        for m in models
    ]
    return (
        long.where(F.col("accuracy").isNotNull() & ~F.isnan("accuracy"))
        .select("name", "metric", "accuracy", F.explode(F.array_compact(F.array(*fits))).alias("model_size"))
        .select(
            "model_size",
            names.metric_rate(F.col("metric")).alias("learning_rate"),
            names.metric_rank(F.col("metric")).alias("lora_rank"),
            "name",
            "metric",
            "accuracy",
        )
    )


def benchmark_vs_loss(bench: DataFrame, runs: DataFrame) -> DataFrame:
    """Benchmark accuracy next to the mean training loss of its (model, rate, rank)."""
    keys = ["model_size", "learning_rate", "lora_rank"]
    return bench.join(mean_loss(runs), keys, "left").where(~is_diverged_cell())


def baseline_delta(merged: DataFrame, baseline: Mapping[str, float] = BASELINE) -> DataFrame:
    """Mean loss and accuracy per (model, rate) and the change from the untuned model."""
    base = F.try_element_at(F.create_map(*[F.lit(v) for pair in baseline.items() for v in pair]), F.col("model_size"))
    accuracy = F.avg("accuracy")
    return (
        merged.groupBy("model_size", "learning_rate")
        .agg(F.round(F.avg("final_loss"), DIGITS).alias("mean_loss"), accuracy.alias("mean_accuracy"))
        .withColumn("delta", F.round(F.col("mean_accuracy") - base, DIGITS))
        .withColumn("mean_accuracy", F.round("mean_accuracy", DIGITS))
    )
