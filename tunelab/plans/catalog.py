"""Registered queries: one per operator, each ``(spark, sf_dir) -> DataFrame``.

Every query reads whole tables.  Nested results are shown as text, and
timestamps as text, so that another engine can be compared with them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tunelab.functions import names, prompts
from tunelab.operators import checkpoints, generate, grid, history, lengths, positions, prep, report, runs, scoring
from tunelab.plans.derived import table, view
from tunelab.schemas import quoted
from tunelab.session import scratch_dir
from tunelab.sources import readers, sinks
from tunelab.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

MCQ_KEYS = ("model_folder", "subset")
REPORT_NAMES = {0: "Dismissal (0)", 1: "Approval (1)"}
STAMP = "yyyy-MM-dd HH:mm:ss"
# A grid with rates that were not run, so that some points are missing.
WIDE_GRID = grid.Grid(learning_rates=(1e-6, 1e-5, 1e-4, 1e-3), full_rates=(1e-6, 1e-5, 1e-4))
OUTPUT_BASE = "/out"


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# ---- inputs ---------------------------------------------------------------


def judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.label_answers(view(spark, sf_dir, "judgment"))


def judgment_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "judgment")


def all_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document, labelled or not: prompts and answers need no label."""
    return view(spark, sf_dir, "cases")


def mcq_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items with their choices as the text of a list, the way files hold them."""
    options = F.transform(
        F.sequence(F.lit(0), F.col("n_choices") - 1), lambda i: F.concat(F.lit("option "), i.cast("string"))
    )
    text = F.concat(F.lit("['"), F.array_join(options, "', '"), F.lit("']"))
    return view(spark, sf_dir, "mcq").withColumn("choices", text)


def mcq_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    gold = prompts.gold_label(F.col("gold"), F.col("n_choices"))
    answers = view(spark, sf_dir, "mcq")
    return answers.select(*MCQ_KEYS, gold.alias("gold"), prompts.parse_choice(F.col("generated_text")).alias("pred"))


def mcq_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.label_counts(mcq_answers(spark, sf_dir), "gold", "pred", MCQ_KEYS)


def all_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.parse_names(view(spark, sf_dir, "runs"))


def histories(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = {"step": "_step", "loss_1": "train/loss", "loss_2": "loss"}
    return view(spark, sf_dir, "history").withColumnsRenamed(columns)


def runs_with_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.update_final_loss(all_runs(spark, sf_dir), history.final_loss(histories(spark, sf_dir)))


def run_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = scoring.accuracy(judged(spark, sf_dir), keys=["run_name"])
    return scored.select(F.col("run_name").alias("name"), F.col("accuracy").alias("eval_accuracy"))


def wide_benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide export: a column per model folder of the grid."""
    folders = [
        f"lr1e-{rate}_r{rank}_lora_{model}{suffix}"
        for rate in (3, 4, 5)
        for rank in grid.LORA_RANKS
        for model in grid.MODEL_SIZES
        for suffix in ("", "_retry")
    ]
    columns = [f"{folder}/mcq_4_choices/accuracy" for folder in folders]
    unknown = F.raise_error(F.concat(F.lit("no column for the metric "), "metric"))
    listed = F.when(F.col("metric").isin(columns), F.col("metric")).otherwise(unknown)
    return view(spark, sf_dir, "bench").withColumn("metric", listed).groupBy("name").pivot("metric", columns).agg(F.max("value"))


def benchmark_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The benchmark values out of wide exports, here one per name: a header of model folders and a line of values."""
    cell = F.struct("metric", F.coalesce(F.col("value").cast("string"), F.lit("")).alias("value"))
    per = view(spark, sf_dir, "bench").groupBy("name").agg(F.collect_list(cell).alias("cells"))
    header = F.concat(F.lit("name,"), F.array_join("cells.metric", ","))
    values = F.concat(F.col("name"), F.lit(","), F.array_join("cells.value", ","))
    lines = per.select(F.col("name").alias("path"), F.explode(F.array(header, values)).alias("value"))
    return report.benchmark_cells(readers.wide_cells(lines))


def messages_text() -> Column:
    turns = F.transform("messages", lambda m: F.concat(m["role"], F.lit(": "), m["content"]))
    return F.array_join(turns, "\n")


# ---- sources --------------------------------------------------------------


@query
def src_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.load_dataset(spark, sf_dir, config="documents.parquet")


@query
def src_multi_folder_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "results_by_source")
    cases = all_cases(spark, sf_dir).select("row_id", "source", "label", "generated_answer")
    sinks.write_by(cases, ["source"], path)
    return readers.load_prefix(spark, f"{path}/source=").select("row_id", "folder", "label", "generated_answer")


@query
def src_run_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accuracy of run folders as they are found: one run has not answered at all, one lacks the column of answers."""
    path = scratch_dir(spark, "run_results")
    cases = judgment_cases(spark, sf_dir).select("run_group", "run_name", "label", "generated_answer")
    lacks = F.col("run_name") == "unknown-run-18"
    answer = F.when(F.col("run_name") != "unknown-run-17", F.col("generated_answer"))
    sinks.write_by(cases.where(~lacks).withColumn("generated_answer", answer), ["run_group", "run_name"], path)
    sinks.write_by(cases.where(lacks).drop("generated_answer"), ["run_group", "run_name"], path, mode="append")
    return scoring.accuracy(scoring.label_answers(readers.load_run_results(spark, path)), keys=["run_group", "run_name"])


@query
def src_checkpoint_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checkpoints of a grid folder, listed in the tasks."""
    path = scratch_dir(spark, "grid")
    known = view(spark, sf_dir, "checkpoints")
    step = names.base_name(F.col("path")).alias("checkpoint")
    known.select(F.col("model_folder").alias("model"), step, F.coalesce("config", F.lit("{}")).alias("value")).write.partitionBy("model", "checkpoint").text(path)
    listed = readers.list_checkpoints(spark, path)
    folder = F.regexp_replace("model_folder", "^model=", "")
    where = F.concat(F.lit("/grid/"), folder, F.lit("/"), F.regexp_extract("path", "/checkpoint=([^/]*)$", 1))
    listed = listed.where(F.col("model_folder").startswith("model="))
    return checkpoints.discover(listed.select(folder.alias("model_folder"), where.alias("path")))


# ---- scoring --------------------------------------------------------------


@query
def eval_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.accuracy(judged(spark, sf_dir))


@query
def eval_accuracy_by_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.accuracy(judged(spark, sf_dir), keys=["run_group", "run_name"])


@query
def eval_parse_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.parse_errors(judged(spark, sf_dir))


@query
def eval_class_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = scoring.label_counts(judged(spark, sf_dir), "label", "pred")
    return scoring.class_report(counts, classes=[0, 1], names=REPORT_NAMES)


@query
def mcq_gold_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Also asks for indexes before the first and after the last choice.
    index = (F.col("gold") * 2 - 3).alias("gold_index")
    items = view(spark, sf_dir, "mcq").select("row_id", index, "n_choices")
    label = prompts.gold_label(F.col("gold_index"), F.col("n_choices"))
    return items.withColumns({"gold_label": label, "out_of_range": label.isNull()})


@query
def mcq_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = prep.mcq_prompts(mcq_items(spark, sf_dir))
    return scoring.choice_predictions(items, keep=["row_id", *MCQ_KEYS])


@query
def mcq_other_pattern(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers read by another pattern than the default one."""
    answers = view(spark, sf_dir, "mcq")
    choice = prompts.parse_choice(F.col("generated_text"), "(?:thought|Answer:) ###([A-Z])")
    return answers.select("row_id", choice.alias("prediction"))


@query
def mcq_literal_choices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Choices with escapes, constants, numbers and texts that are no list."""
    kind = F.col("doc_id") % 5
    word = F.regexp_extract("text", "[a-zA-Z]+", 0)
    text = (
        F.when(kind == 0, F.concat(F.lit("['it\\'s "), word, F.lit("', \"a \\\"b\\\" c\", None]")))
        .when(kind == 1, F.concat(F.lit("[1, 2.5, True, '"), word, F.lit("']")))
        .when(kind == 2, F.concat(F.lit("('"), word, F.lit("', 'tuple')")))
        .when(kind == 3, F.lit("[]"))
        .otherwise(word)
    )
    rows = table(spark, sf_dir, "documents").select("doc_id", text.alias("choices"))
    found = prep.parsed_choices(rows)
    return rows.select("doc_id", F.size(found).alias("n"), F.array_join(found, "|").alias("choices"))


@query
def mcq_class_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.class_report(mcq_counts(spark, sf_dir), keys=MCQ_KEYS, with_overall=False)


@query
def mcq_confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.confusion(mcq_counts(spark, sf_dir), MCQ_KEYS)


@query
def mcq_pred_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.pred_distribution(mcq_counts(spark, sf_dir), MCQ_KEYS)


@query
def mcq_label_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.label_union(mcq_counts(spark, sf_dir), MCQ_KEYS)


def grid_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    answers = view(spark, sf_dir, "mcq")
    gold = prompts.gold_label(F.col("gold"), F.col("n_choices"))
    right = scoring.is_right(gold, prompts.parse_choice(F.col("generated_text")))
    scored = answers.select(*MCQ_KEYS, right.alias("correct"), (F.length("generated_text") / 100).alias("seconds"))
    return scoring.grid_results(scored, checkpoints.CHECKPOINT, MCQ_KEYS, F.col("seconds"))


@query
def eval_grid_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid_results(spark, sf_dir)


@query
def eval_leaderboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.leaderboard(grid_results(spark, sf_dir))


def prompt_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = prep.mcq_prompts(mcq_items(spark, sf_dir))
    return items.select("subset", prompts.token_count(F.col("prompt")).alias("length"))


@query
def grid_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stand-in base model with two adapters, each asked every item."""

    def load():
        return lambda model, texts: [f"###{'ABCD'[(len(t) + len(model)) % 4]}###" for t in texts]

    items = view(spark, sf_dir, "mcq").select("row_id", F.col("question").alias("prompt"))
    return generate.generate_grid(items, ["lora_8B", "lora_70B"], load).select("row_id", "model_folder", "generated_text")


@query
def prompt_length_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lengths by an injected tokenizer, here a stand-in for one that cannot be built."""

    def missing():
        raise OSError("no tokenizer")

    factory = generate.with_fallback(missing, lambda: lambda texts: [len((t or "").split(" ")) for t in texts])
    items = view(spark, sf_dir, "mcq").select("subset", generate.token_length(F.col("question"), factory).alias("length"))
    return lengths.length_stats(items, ["subset"])


@query
def prompt_length_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lengths.length_stats(prompt_lengths(spark, sf_dir), ["subset"])


@query
def prompt_length_hist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lengths.length_histogram(prompt_lengths(spark, sf_dir), ["subset"])


# ---- training rows and prompts --------------------------------------------


@query
def prep_judgment_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = F.when(F.col("toxic") == 1, "test").otherwise("train")
    cases = judgment_cases(spark, sf_dir).withColumn("split", split)
    chat = prep.pick_strategy(prep.TRAINING_STRATEGIES, "swiss_judgment_prediction")
    rows = chat(prep.only_split(cases, "train"))
    return rows.select(
        F.size("messages").alias("n_messages"),
        F.col("messages")[0]["role"].alias("first_role"),
        F.col("messages")[0]["content"].alias("first_content"),
        F.col("messages")[1]["role"].alias("second_role"),
        F.col("messages")[1]["content"].alias("second_content"),
    )


@query
def prep_default_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prep.default_text(table(spark, sf_dir, "documents").drop("text"))


@query
def prompt_judgment(spark: SparkSession, sf_dir: str) -> DataFrame:
    prompt = prep.pick_strategy(prep.INFERENCE_STRATEGIES, "swiss_judgement_prediction")
    return prompt(all_cases(spark, sf_dir)).select("row_id", "prompt")


@query
def prompt_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    cases = prep.default_prompt(all_cases(spark, sf_dir), "text")
    return prep.default_prompt(cases, "no_such_column", "absent_prompt").select("row_id", "prompt", "absent_prompt")


@query
def mcq_prompt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prep.mcq_prompts(mcq_items(spark, sf_dir)).select("row_id", "subset", "n_choices", "prompt")


@query
def conversations_to_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = prep.conversation_messages(table(spark, sf_dir, "conversations"))
    return rows.select("conv_id", F.size("messages").alias("n_messages"), messages_text().alias("messages"))


@query
def render_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = prep.conversation_messages(table(spark, sf_dir, "conversations"))
    text = prompts.render_chat(F.col("messages"), add_generation_prompt=True)
    return rows.select("conv_id", text.alias("chat"))


@query
def batch_generate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stand-in model that answers by the parity of the prompt's length."""

    def load():
        return lambda texts: ["dismissal" if len(t) % 2 == 0 else "approval" for t in texts]

    cases = prep.judgment_chat_prompt(all_cases(spark, sf_dir)).select("row_id", "label", "prompt")
    return generate.batch_generate(cases, load).select("row_id", "label", "generated_answer")


@query
def generate_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers of a run that had done the labelled cases only before it was taken up again."""

    def load():
        return lambda texts: ["dismissal" if len(t) % 2 == 0 else "approval" for t in texts]

    path = scratch_dir(spark, "answers")
    cases = prep.judgment_chat_prompt(all_cases(spark, sf_dir)).select("row_id", "label", "prompt")
    generate.generate_resumably(cases.where("label is not null"), ["row_id"], load, path, batches=2)
    return generate.generate_resumably(cases, ["row_id"], load, path, batches=2).select("row_id", "label", "generated_answer")


# ---- positions ------------------------------------------------------------


@query
def slice_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return positions.slice_rows(table(spark, sf_dir, "events"), "event_id", 100, 900).drop("ts")


@query
def shard_contiguous(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "user_id")
    return positions.with_shard(events, "event_id", 7)


@query
def debug_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    return positions.head(table(spark, sf_dir, "documents"), "doc_id").select("doc_id", "text", "source")


# ---- runs -----------------------------------------------------------------


@query
def runs_parse_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return all_runs(spark, sf_dir).select("run_id", "name", "state", "is_grid_run", *runs.CONFIG_KEYS)


@query
def runs_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = view(spark, sf_dir, "runs").select(
        "name",
        F.col("run_id").cast("string").alias("id"),
        "state",
        F.date_format("created_at", STAMP).alias("created_at"),
        F.create_map(F.lit("run_name"), "name", F.lit("_internal"), F.lit("x"), F.lit("host"), F.lit("node")).alias(
            "config"
        ),
        F.create_map(F.lit("events"), F.col("n_events").cast("string")).alias("summary"),
    )
    return runs.overview(raw)


@query
def runs_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = runs.filter_runs(all_runs(spark, sf_dir), model_size="8B", method="lora", learning_rate=1e-4)
    return kept.select("run_id", "name", "learning_rate", "lora_rank")


@query
def runs_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = runs.summary(all_runs(spark, sf_dir)).drop("states")
    return one.withColumns(
        {
            "learning_rates": F.array_join(F.transform("learning_rates", names.rate_text), ","),
            "lora_ranks": F.array_join("lora_ranks", ","),
            "model_sizes": F.array_join("model_sizes", ","),
        }
    )


@query
def runs_state_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.counts_by(all_runs(spark, sf_dir), "state")


@query
def runs_size_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.counts_by(all_runs(spark, sf_dir).where("is_grid_run"), "model_size")


@query
def runs_first_per_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.first_per_config(runs.filter_runs(all_runs(spark, sf_dir)).where("is_grid_run"))


@query
def runs_grid_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    everything = all_runs(spark, sf_dir)
    finished_grid = runs.filter_runs(everything).where("is_grid_run")
    marked = runs.mark_members(everything, finished_grid, "in_grid")
    return marked.select("run_id", "name", F.when(F.col("in_grid"), "grid").otherwise("other").alias("kind"))


@query
def runs_update_final_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs_with_loss(spark, sf_dir).select("run_id", "name", "final_loss")


@query
def runs_with_final_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.with_final_loss(all_runs(spark, sf_dir), history.final_loss(histories(spark, sf_dir)))
    stamp = names.timestamped(F.col("name"), F.col("created_at")).alias("stamped")
    return found.select("run_id", stamp, "final_loss", names.metric_title(F.lit("final_loss")).alias("title"))


@query
def runs_attach_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = F.when(F.col("state") == "failed", F.lit(0.5)).alias("eval_accuracy")
    known = view(spark, sf_dir, "runs").select("run_id", "name", old)
    return runs.attach_metric(known, run_accuracy(spark, sf_dir), "eval_accuracy")


@query
def runs_matched_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = view(spark, sf_dir, "runs").select("run_id", "name")
    return runs.matched_metrics(known, run_accuracy(spark, sf_dir), "eval_accuracy")


@query
def runs_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.unmatched(run_accuracy(spark, sf_dir), view(spark, sf_dir, "runs"))


def _ingest(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Finished runs, and the names whose history was stored before a cut-off time."""
    finished = runs.filter_runs(all_runs(spark, sf_dir))
    kind = F.when(F.col("is_grid_run"), "grid").otherwise("other").alias("kind")
    stored = finished.where(F.col("created_at") < F.lit("2024-01-01 02:00:00").cast("timestamp")).select("name")
    return finished.select("run_id", "name", "created_at", "has_history", kind), stored


@query
def ingest_new_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    incoming, stored = _ingest(spark, sf_dir)
    return runs.ingest_new(incoming, stored).select("run_id", "name", "kind")


@query
def ingest_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.ingest_status(*_ingest(spark, sf_dir)).select("run_id", "name", "kind", "status")


@query
def ingest_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.ingest_stats(runs.ingest_status(*_ingest(spark, sf_dir)))


@query
def ingest_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status of the history files of a folder, those of the 70B models without any loss column."""
    folder, table_, bad, state = (scratch_dir(spark, n) for n in ("histories", "ingested", "quarantine", "state"))
    points = histories(spark, sf_dir).withColumn("run", F.col("name"))
    for size, rows in ((False, points), (True, points.withColumnsRenamed({"train/loss": "eval", "loss": "eval2"}))):
        rows.where(F.col("run").contains("70B") == size).drop("name").write.partitionBy("run").mode("append").option("header", True).csv(folder)
    for _ in range(2):  # a second call finds nothing new
        ingest.ingest_files(ingest.line_stream(spark, folder), table_, bad, state, name=lambda p: F.regexp_extract(p, "/run=([^/]*)/", 1))
    found = ingest.ingested_files(spark, table_, bad)
    return runs.ingest_stats(runs.parse_names(found).select("status", F.when(F.col("is_grid_run"), "grid").otherwise("other").alias("kind")))


@query
def metric_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metric history after a job that was run twice."""
    path = scratch_dir(spark, "metrics")
    for _ in range(2):
        sinks.append_metric(run_accuracy(spark, sf_dir), path, "eval_accuracy", "evaluation-1")
    return spark.read.parquet(path).select("name", "metric", "batch", "value")


# ---- histories ------------------------------------------------------------


@query
def hist_final_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.final_loss(histories(spark, sf_dir))


@query
def hist_curve_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.curve_stats(histories(spark, sf_dir))


@query
def hist_custom_metric(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Curve statistics with a metric of the caller's: the spread of the loss."""
    spread = F.round(F.max(quoted("train/loss")) - F.min(quoted("train/loss")), 8)
    return history.curve_stats(histories(spark, sf_dir), extra={"spread": spread}).select("name", "num_steps", "spread")


@query
def hist_last_100(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.last_points(histories(spark, sf_dir)).select("name", "_step", quoted("train/loss").alias("loss"))


# ---- grid and checkpoints -------------------------------------------------


@query
def grid_run_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    everything = all_runs(spark, sf_dir)
    plan = grid.planned_runs(grid.observed_grid(everything), OUTPUT_BASE)
    return plan.drop("learning_rate")


@query
def grid_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    gaps = grid.missing(runs.filter_runs(all_runs(spark, sf_dir)), WIDE_GRID)
    return gaps.select("model_size", "method", names.rate_text(F.col("learning_rate")).alias("lr"), "lora_rank")


@query
def grid_missing_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    gaps = grid.missing(runs.filter_runs(all_runs(spark, sf_dir)), WIDE_GRID)
    rate = names.rate_text(F.col("learning_rate")).alias("lr")
    return grid.first_missing(gaps).select("model_size", "method", rate, "lora_rank", "and_more")


@query
def grid_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid.coverage(runs.filter_runs(all_runs(spark, sf_dir)), WIDE_GRID)


@query
def grid_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running jobs are the runs in that state; finished runs left a model file, others a log."""
    known = view(spark, sf_dir, "runs")
    running = known.where("state = 'running'").select(names.job_name(F.col("name")).alias("job_name"))
    last_file = F.when(F.col("state") == "finished", "adapter.safetensors").otherwise("trainer.log")
    files = known.select(F.concat(names.output_dir(OUTPUT_BASE, F.col("name")), F.lit("/"), last_file).alias("path"))
    plan = grid.planned_runs(grid.grid_points(spark, WIDE_GRID), OUTPUT_BASE)
    left = grid.pending(plan, running, grid.completed_folders(files))
    return left.select("run_id", "job_name", "output_dir")


@query
def grid_pending_listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``grid_pending``, with the files of finished and other runs listed from their output folders."""
    path = scratch_dir(spark, "out")
    known = view(spark, sf_dir, "runs")
    running = known.where("state = 'running'").select(names.job_name(F.col("name")).alias("job_name"))
    last_file = F.when(F.col("state") == "finished", "adapter.safetensors").otherwise("trainer.log").alias("file")
    known.select(F.col("name").alias("run"), last_file, F.col("name").alias("value")).write.partitionBy("run", "file").text(path)
    shown = F.regexp_replace("path", "^.*/run=([^/]*)/(?:file=)?([^/]*)$", f"{OUTPUT_BASE}/$1/$2").alias("path")
    plan = grid.planned_runs(grid.grid_points(spark, WIDE_GRID), OUTPUT_BASE)
    left = grid.pending(plan, running, grid.completed_folders(readers.list_files(spark, path).select(shown)))
    return left.select("run_id", "job_name", "output_dir")


@query
def ranks_available(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.available_ranks(all_runs(spark, sf_dir))


@query
def ckpt_discover(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checkpoints.discover(view(spark, sf_dir, "checkpoints"))


@query
def ckpt_single_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checkpoints.discover(view(spark, sf_dir, "checkpoints"), single_model="lr1e-4_r2_lora_70B")


@query
def ckpt_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checkpoints.without_checkpoint(view(spark, sf_dir, "checkpoints"))


@query
def ckpt_adapter_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    listing = view(spark, sf_dir, "checkpoints")
    configs = readers.adapters_from_json(listing.where("config is not null"))
    return checkpoints.with_adapter(listing.select("path", "model_folder"), configs)


@query
def ckpt_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checkpoints.latest(view(spark, sf_dir, "checkpoints"))


@query
def ckpt_run_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checkpoints.run_info(view(spark, sf_dir, "checkpoints"))


# ---- report ---------------------------------------------------------------


@query
def sweep_lr_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.rate_sweep(runs_with_loss(spark, sf_dir))


@query
def loss_by_lr_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.mean_loss(runs_with_loss(spark, sf_dir))


@query
def heatmap_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.heatmap(runs_with_loss(spark, sf_dir))


@query
def best_lr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.best_rate(runs_with_loss(spark, sf_dir))


@query
def best_lr_per_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    lora = runs_with_loss(spark, sf_dir).where("method = 'lora'")
    return report.best_rate(lora, by=["model_size", "lora_rank"])


@query
def full_vs_lora_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.full_vs_lora(runs_with_loss(spark, sf_dir))


@query
def pair_lora_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.pair_rates(runs_with_loss(spark, sf_dir))


@query
def chart_learning_curves(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.learning_curves(all_runs(spark, sf_dir), histories(spark, sf_dir))


@query
def chart_curve_tail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.curve_tail(report.learning_curves(all_runs(spark, sf_dir), histories(spark, sf_dir)))


@query
def chart_model_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.model_comparison(all_runs(spark, sf_dir), histories(spark, sf_dir))


@query
def chart_axis_limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.axis_limits(runs_with_loss(spark, sf_dir))


@query
def chart_task_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.task_accuracy(view(spark, sf_dir, "task"))


@query
def chart_rank_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.rank_series(view(spark, sf_dir, "task")).select("model_size", "lr", "rank", "position", "eval_accuracy")


@query
def rank_plateau_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.plateau_gap(view(spark, sf_dir, "task"))


@query
def bench_unpivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return benchmark_long(spark, sf_dir)


def bench_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    long = benchmark_long(spark, sf_dir)
    return report.benchmark_vs_loss(long, runs_with_loss(spark, sf_dir))


@query
def bench_vs_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bench_merged(spark, sf_dir).select(
        "model_size", "learning_rate", "lora_rank", "name", "accuracy", "final_loss"
    )


@query
def chart_bench_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.benchmark_series(bench_merged(spark, sf_dir))


@query
def bench_baseline_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.baseline_delta(bench_merged(spark, sf_dir))
