"""Whole jobs: preparation, generation, scoring, benchmark and report.

A job is a chain of operators.  Model output is expensive, so jobs that
generate write it first and score the written table: an executor that is lost
while scoring costs no second generation.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tunelab import schemas
from tunelab.operators import checkpoints, generate, grid, history, positions, prep, report, runs, scoring
from tunelab.plans.params import BenchmarkJob, GenerateJob, PrepareJob, ScoreJob
from tunelab.session import stored
from tunelab.sources import readers, sinks

# Both get the job, which holds the sampling limits; a grid model also gets the
# checkpoint path of each model folder and is called with a folder and prompts.
Model = Callable[[GenerateJob], generate.GenerateFn]
GridModel = Callable[[BenchmarkJob, Mapping[str, str]], Callable[[str, list[str]], list[str]]]
REPORT_NAMES = {0: "Dismissal (0)", 1: "Approval (1)"}


def prepare_training(spark: SparkSession, job: PrepareJob) -> DataFrame:
    """Training rows of a dataset.

    The judgment strategies keep the train split only and all their columns
    become ``messages``; the default strategy keeps rows and columns.
    """
    strategy = prep.pick_strategy(prep.TRAINING_STRATEGIES, job.strategy)
    df = readers.load_dataset(spark, job.dataset, job.config)
    if strategy is not prep.default_text and readers.SPLIT_COLUMN in df.columns:
        df = prep.only_split(df, job.train_split)
    if job.debug:
        df = positions.head(df, job.key, job.debug_rows)
    return strategy(df)


def generate_answers(spark: SparkSession, job: GenerateJob, model: Model) -> DataFrame:
    """Generate one answer per row of a slice, write the rows, and read them back.

    A job that was cut short and is run again with the same output asks the model only for the rows that are not there yet.
    """
    strategy = prep.pick_strategy(prep.INFERENCE_STRATEGIES, job.strategy)
    df = readers.load_dataset(spark, job.dataset, job.config, job.split)
    if job.start or job.end is not None:
        df = positions.slice_rows(df, job.key, job.start, job.end)
    columns = df.columns
    prompts = strategy(df, job.input_col)
    done = generate.generate_resumably(prompts, [job.key], lambda: model(job), job.output, "prompt", job.output_col, job.batches)
    return done.select(*map(schemas.quoted, columns), schemas.quoted(job.output_col))


def score_answers(spark: SparkSession, job: ScoreJob) -> dict[str, DataFrame]:
    """Accuracy, parse errors and classification report of generated answers.

    The answers are read once, for one count per (label, prediction); all three
    tables are worked out from the stored counts.
    """
    df = readers.load_results(spark, job.dataset, job.from_disk, job.multi_folder, job.split)
    judged = scoring.label_answers(df, job.gen_col)
    counts = stored(scoring.label_counts(judged, job.label_col, "pred"), "label_counts")
    return {
        "accuracy": scoring.accuracy(counts, "gold", "pred", rows="n"),
        "parse_errors": scoring.parse_errors(counts, rows="n"),
        "report": scoring.class_report(counts, classes=[0, 1], names=REPORT_NAMES),
    }


def score_runs(spark: SparkSession, parent: str, known: DataFrame) -> dict[str, DataFrame]:
    """Accuracy of all ``group/run`` results, written onto the runs of the same name."""
    results = scoring.label_answers(readers.load_run_results(spark, parent))
    by_run = stored(scoring.accuracy(results, keys=["run_group", "run_name"]), "run_accuracy")
    # The same run name may occur in two groups; the last group by name wins.
    values = by_run.groupBy("run_name").agg(F.max_by("accuracy", "run_group").alias("eval_accuracy"))
    values = values.withColumnRenamed("run_name", "name")
    return {
        "accuracy": by_run,
        "runs": runs.attach_metric(known, values, "eval_accuracy"),
        "unmatched": runs.unmatched(values, known),
    }


def benchmark_items(spark: SparkSession, job: BenchmarkJob) -> DataFrame:
    """Items of all subsets with their prompts."""
    frames = []
    for subset in job.subsets:
        items = readers.load_dataset(spark, job.dataset, subset, job.split)
        frames.append(prep.mcq_prompts(prep.read_literals(items)).withColumn("subset", F.lit(subset)))
    return schemas.union_all(frames, allow_missing=True)


def benchmark_grid(spark: SparkSession, job: BenchmarkJob, model: GridModel) -> dict[str, DataFrame]:
    """Every model of a grid on every item: predictions, results, reports, leaderboard.

    Answers are logged below the output; a job that is run again asks a model only what it has not answered there.
    """
    listing = readers.list_checkpoints(spark, job.grid_dir)
    found = checkpoints.discover(listing, job.checkpoint, job.single_model).collect()
    if not found:
        raise ValueError(f"no {job.checkpoint} below {job.grid_dir}")
    paths = {row["model_folder"]: row["checkpoint_path"] for row in found}
    items = benchmark_items(spark, job)
    log = f"{job.output.rstrip('/')}/answers"
    answered = generate.generate_grid_resumably(items, [job.key, "subset"], list(paths), lambda: model(job, paths), log, batches=job.batches)
    answered = answered.where(F.col("model_folder").isin(list(paths)))
    keep = [job.key, "model_folder", "subset", generate.SECONDS_COLUMN]
    rows = scoring.choice_predictions(answered, pattern=job.pattern, keep=keep)
    table = f"{job.output.rstrip('/')}/predictions"
    sinks.write_by(rows, ["model_folder", "subset"], table, mode="overwrite")

    predictions = spark.read.parquet(table)
    keys = ["model_folder", "subset"]
    counts = stored(scoring.label_counts(predictions, "gold", "prediction", keys), "label_counts")
    results = scoring.grid_results(predictions, job.checkpoint, keys, F.col(generate.SECONDS_COLUMN))
    return {
        "predictions": predictions,
        "results": results,
        "leaderboard": scoring.leaderboard(results),
        "report": scoring.class_report(counts, keys, with_overall=False),
        "confusion": scoring.confusion(counts, keys),
        "distribution": scoring.pred_distribution(counts, keys),
    }


def update_losses(spark: SparkSession, parsed: DataFrame, history_dir: str) -> DataFrame:
    """Run table with the final losses of the histories in a folder."""
    return runs.update_final_loss(parsed, history.final_loss(readers.load_histories(spark, history_dir)))


def report_tables(
    known: DataFrame, histories: DataFrame, task: DataFrame, wide: DataFrame, plan: grid.Grid = grid.Grid()
) -> dict[str, DataFrame]:
    """Every table of the experiment report from its four inputs."""
    merged = report.benchmark_vs_loss(report.unpivot_benchmark(wide), known)
    return {
        "coverage": grid.coverage(known, plan),
        "missing": grid.missing(known, plan),
        "sweep": report.rate_sweep(known),
        "heatmap": report.heatmap(known),
        "axis_limits": report.axis_limits(known),
        "best_rate": report.best_rate(known),
        "full_vs_lora": report.full_vs_lora(known),
        "pairs": report.pair_rates(known),
        "curves": report.learning_curves(known, histories),
        "comparison": report.model_comparison(known, histories),
        "task_accuracy": report.task_accuracy(task),
        "plateau": report.plateau_gap(task),
        "benchmark": merged,
        "baseline_delta": report.baseline_delta(merged),
    }
