"""Readers, writers and whole jobs on files."""

import json
import os
import uuid
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tunelab import session
from tunelab.operators import checkpoints, generate, report, runs, scoring
from tunelab.operators import runs as run_ops
from tunelab.plans import jobs
from tunelab.plans.params import BenchmarkJob, GenerateJob, PrepareJob, ScoreJob
from tunelab.sources import readers, sinks
from tunelab.streaming import ingest


def rows(df, *columns):
    return sorted(tuple(r[c] for c in columns or df.columns) for r in df.collect())


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def part_file(path, suffix):
    return next(os.path.join(path, f) for f in os.listdir(path) if f.endswith(suffix))


# ---- scratch --------------------------------------------------------------


def test_scratch_is_below_the_shared_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    first, second = session.scratch_dir(spark, "x"), session.scratch_dir(spark, "x")
    assert first.startswith(base) and first != second


# ---- readers --------------------------------------------------------------


@pytest.fixture
def dataset(spark, tmp_path):
    path = str(tmp_path / "ds")
    df = spark.range(20).selectExpr(
        "id AS row_id", "if(id < 15, 'train', 'test') AS split", "cast(id % 2 AS int) AS label",
        "concat('case ', id) AS text", "2000 AS year",
    )
    df.write.partitionBy("split").parquet(f"{path}/all")
    return path


def test_load_dataset_by_config_and_split(spark, dataset):
    assert readers.load_dataset(spark, dataset, "all").count() == 20
    test = readers.load_dataset(spark, dataset, "all", "test")
    assert test.count() == 5 and "split" not in test.columns
    plan = test._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan
    with pytest.raises(ValueError, match="missing"):
        readers.load_dataset(spark, dataset, "all", "validation")


def test_load_first_falls_back(spark, dataset, tmp_path):
    assert readers.load_first(spark, [str(tmp_path / "none"), dataset], "all", "test").count() == 5
    with pytest.raises(FileNotFoundError):
        readers.load_first(spark, [str(tmp_path / "none")])


def test_load_prefix(spark, tmp_path):
    for name in ("res_b", "res_a", "other", "res c"):
        spark.createDataFrame([(name,)], "v string").write.parquet(str(tmp_path / name))
    write(tmp_path / "res_file", "not a folder")
    for prefix in ("res", "res*"):
        got = rows(readers.load_prefix(spark, str(tmp_path / prefix)), "folder", "v")
        assert got == [("res c", "res c"), ("res_a", "res_a"), ("res_b", "res_b")]
    with pytest.raises(ValueError, match="no folder"):
        readers.load_prefix(spark, str(tmp_path / "nope"))
    assert readers.load_results(spark, str(tmp_path / "res_a"), from_disk=True).count() == 1
    assert readers.load_results(spark, str(tmp_path / "res_"), multi_folder=True).count() == 2
    spark.createDataFrame([("z", 1)], "v string, later int").write.parquet(str(tmp_path / "res_z"))
    found = readers.load_prefix(spark, str(tmp_path / "res_"))
    assert sorted(rows(found.fillna(0), "v", "later")) == [("res_a", 0), ("res_b", 0), ("z", 1)]
    with pytest.raises(ValueError, match="missing"):
        readers.load_results(spark, str(tmp_path / "res_a"), split="test")


def test_run_results_skip_incomplete_runs(spark, tmp_path):
    good = spark.createDataFrame([(0, "dismissed"), (1, "no idea")], "label int, generated_answer string")
    good.write.parquet(str(tmp_path / "g1" / "run1"))
    good.limit(1).write.parquet(str(tmp_path / "g2" / "run2"))
    good.drop("generated_answer").write.parquet(str(tmp_path / "g2" / "run3"))
    known = spark.createDataFrame([(1, "run1"), (2, "run1"), (3, "runX")], "run_id int, name string")
    out = jobs.score_runs(spark, str(tmp_path), known)
    assert rows(out["accuracy"], "run_group", "run_name", "accuracy") == [("g1", "run1", 0.5), ("g2", "run2", 1.0)]
    assert rows(out["runs"].fillna(-1.0), "run_id", "eval_accuracy") == [(1, 0.5), (2, 0.5), (3, -1.0)]
    assert rows(out["unmatched"], "name") == [("run2",)]
    with pytest.raises(ValueError, match="columns"):
        readers.load_run_results(spark, str(tmp_path), required=["nope"])


def test_run_results_keep_runs_without_any_answer(spark, tmp_path):
    good = spark.createDataFrame([(0, "dismissed", 1), (1, "no idea", 2)], "label int, generated_answer string, more int")
    good.write.parquet(str(tmp_path / "g" / "some"))
    silent = good.withColumn("generated_answer", F.lit(None).cast("string")).drop("more")
    silent.write.parquet(str(tmp_path / "g" / "silent"))
    silent.withColumn("label", F.lit(None).cast("int")).write.parquet(str(tmp_path / "g" / "nothing"))
    good.drop("label").write.parquet(str(tmp_path / "g" / "no_label"))
    good.limit(0).write.parquet(str(tmp_path / "g" / "empty"))
    found = readers.load_run_results(spark, str(tmp_path))
    assert rows(found.groupBy("run_name").count()) == [("nothing", 2), ("silent", 2), ("some", 2)]
    scored = jobs.score_runs(spark, str(tmp_path), spark.createDataFrame([], "name string"))["accuracy"]
    assert rows(scored, "run_name", "accuracy") == [("nothing", 0.0), ("silent", 0.0), ("some", 0.5)]
    with pytest.raises(ValueError, match="cannot be required"):
        spark.createDataFrame([(0, [1])], "label int, generated_answer array<int>").write.parquet(str(tmp_path / "other" / "g" / "r"))
        readers.load_run_results(spark, str(tmp_path / "other"))


def test_run_results_take_as_many_jobs_for_many_runs(spark, tmp_path):
    tracker = spark.sparkContext.statusTracker()
    jobs_of = {}
    for n in (10, 60):
        df = spark.range(n * 4).selectExpr("cast(id % 2 AS int) AS label", "'approved' AS generated_answer", f"concat('r', id % {n}) AS run")
        df.repartition("run").write.partitionBy("run").parquet(str(tmp_path / f"n{n}" / "g"))
        spark.sparkContext.setJobGroup(f"runs-{n}", "")
        assert readers.load_run_results(spark, str(tmp_path / f"n{n}")).count() == n * 4
        jobs_of[n] = len(tracker.getJobIdsForGroup(f"runs-{n}"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs_of[60] <= jobs_of[10] + 2


def test_parsed_runs(spark, tmp_path):
    path = str(tmp_path / "runs.csv")
    with pytest.raises(FileNotFoundError, match="export"):
        readers.load_parsed_runs(spark, path)
    header = "name,id,state,created_at,is_grid_run,learning_rate,lora_rank,method,model_size,final_loss\n"
    write(tmp_path / "runs.csv", header + "a,1,finished,2024-01-01T00:00:00Z,True,0.0001,64.0,lora,8B,NaN\n"
          "b,2,failed,2024-01-02T00:00:00Z,False,,,,,\n")
    got = rows(readers.load_parsed_runs(spark, path).drop("created_at").fillna(-1), "name", "is_grid_run", "lora_rank",
               "learning_rate", "final_loss")
    assert got == [("a", True, 64, 1e-4, -1.0), ("b", False, -1, -1.0, -1.0)]


def test_task_eval_and_wide_benchmark(spark, tmp_path):
    from tunelab.operators import report
    from tunelab.schemas import TASK_EVAL

    columns = [c.split()[0].strip("`") for c in TASK_EVAL.split(",")] if isinstance(TASK_EVAL, str) else TASK_EVAL.fieldNames()
    values = {"model_size": "8B", "lr": "0.0001", "rank": "8", "eval_accuracy": "NaN"}
    write(tmp_path / "task.csv", ",".join(columns) + "\n" + ",".join(values.get(c, "") for c in columns) + "\n")
    task = readers.load_task_eval(spark, str(tmp_path / "task.csv")).first()
    assert (task["model_size"], task["rank"], task["eval_accuracy"]) == ("8B", 8, None)
    write(tmp_path / "wide.csv", "name,lr1e-4_r8_lora_8B/mcq_4_choices/accuracy\ngrid_8B_lora_x,0.25\nother,0.5\n")
    long = report.unpivot_benchmark(readers.load_wide_benchmark(spark, str(tmp_path / "wide.csv")))
    assert rows(long, "model_size", "learning_rate", "lora_rank", "accuracy") == [("8B", 1e-4, 8, 0.25)]


def test_histories_with_different_headers(spark, tmp_path):
    write(tmp_path / "h" / "a.csv", "_step,train/loss\n1,0.9\n2,NaN\n3,\n")
    write(tmp_path / "h" / "b.csv", "train/loss,_step,extra\r\n0.5,1,x\r\nnan,2,y\r\n")
    write(tmp_path / "h" / "c d.csv", "loss,_step\n0.3,7\n0.2,8\n")
    write(tmp_path / "h" / "empty.csv", "")
    df = readers.load_histories(spark, str(tmp_path / "h")).fillna(-1.0)
    got = rows(df, "name", "_step", "train/loss", "loss")
    assert got == [
        ("a", 1, 0.9, -1.0), ("a", 2, -1.0, -1.0), ("a", 3, -1.0, -1.0), ("b", 1, 0.5, -1.0), ("b", 2, -1.0, -1.0),
        ("c d", 7, -1.0, 0.3), ("c d", 8, -1.0, 0.2),
    ]
    known = spark.createDataFrame([("a",), ("c d",), ("none",)], "name string")
    same = readers.load_histories(spark, str(tmp_path / "h" / "a.csv"), ["_step", "train/loss"]).fillna(-1.0)
    assert rows(same, "name", "_step", "train/loss") == [("a", 1, 0.9), ("a", 2, -1.0), ("a", 3, -1.0)]
    updated = jobs.update_losses(spark, known, str(tmp_path / "h"))
    assert rows(updated.fillna(-1.0)) == [("a", 0.9), ("c d", 0.2), ("none", -1.0)]


def test_checkpoints_and_adapters(spark, tmp_path):
    grid_dir = tmp_path / "grid"
    write(grid_dir / "m1" / "checkpoint-467" / "adapter_config.json", json.dumps({"base_model_name_or_path": "b", "r": 8}))
    write(grid_dir / "m2" / "checkpoint-467" / "adapter_config.json", "{\n \"x\": 1\n}")
    write(grid_dir / "m3" / "checkpoint-467" / "model.safetensors", "")
    write(grid_dir / "m4" / "checkpoint-100" / "x", "")
    (grid_dir / "m5").mkdir()
    write(grid_dir / "notes.txt", "")
    listing = readers.list_checkpoints(spark, str(grid_dir))
    assert rows(checkpoints.discover(listing), "model_folder") == [("m1",), ("m2",), ("m3",)]
    assert rows(checkpoints.discover(listing, single_model="m2"), "model_folder") == [("m2",)]
    assert rows(checkpoints.without_checkpoint(listing)) == [("m4",), ("m5",)]
    found = checkpoints.with_adapter(listing.where("path like '%467'"), readers.load_adapters(spark, str(grid_dir)))
    assert rows(found.fillna(-1).fillna("-"), "model_folder", "is_lora", "base_model", "lora_rank") == [
        ("m1", True, "b", 8), ("m2", True, "", 64), ("m3", False, "-", -1),
    ]
    assert readers.list_files(spark, str(grid_dir / "m1")).count() == 1
    with pytest.raises(ValueError, match="does not exist"):
        readers.list_checkpoints(spark, str(tmp_path / "nope"))


def test_cells_of_wide_exports(spark, tmp_path):
    write(tmp_path / "a.csv", 'name,"lr1e-4_r8_lora_8B/mcq_4_choices/accuracy",lr1e-3_r2_lora_70B/mcq_4_choices/accuracy,other,"x,y"\n'
          'grid_8B_lora_x,0.5,0.25,7,"p,q"\n"grid_70B_lora, y",,NaN,,\nlr_lora_8B_lora_70B,n/a,1e-1,,\n')
    write(tmp_path / "b.csv", "lr1e-5_r4_lora_8B/mcq_4_choices/accuracy,name\n0.75,grid_8B_lora_z\n")
    cells = readers.load_wide_cells(spark, str(tmp_path))
    assert ("grid_8B_lora_x", "x,y", "p,q") in rows(cells) and cells.count() == 8
    got = rows(report.benchmark_cells(cells), "model_size", "learning_rate", "lora_rank", "name", "accuracy")
    assert got == [("70B", 1e-3, 2, "lr_lora_8B_lora_70B", 0.1), ("8B", 1e-4, 8, "grid_8B_lora_x", 0.5), ("8B", 1e-5, 4, "grid_8B_lora_z", 0.75)]
    wide = report.unpivot_benchmark(readers.load_wide_benchmark(spark, str(tmp_path / "b.csv")))
    assert rows(wide) == rows(report.benchmark_cells(readers.load_wide_cells(spark, str(tmp_path / "b.csv"))))


def test_listing_of_many_folders(spark, tmp_path):
    for i in range(3000):
        (tmp_path / f"m {i}%" / "checkpoint-467").mkdir(parents=True)
    (tmp_path / "m 7%" / "checkpoint-468").mkdir()
    for base in (str(tmp_path), tmp_path.as_uri()):
        listing = readers.list_checkpoints(spark, base, tasks=7)
        assert listing.count() == 3001 and listing.where("model_folder = 'm 7%'").count() == 2
        assert listing.select("path").distinct().count() == 3001
        assert listing.where(~F.col("path").startswith(f"file:{tmp_path}/m ")).isEmpty()
    assert readers.list_files(spark, str(tmp_path / "absent")).count() == 0


def test_no_list_of_paths_on_the_driver(spark, tmp_path, monkeypatch):
    """Listings are plans whose rows come from the tasks; the driver only asks whether the folder exists."""
    (tmp_path / "m1" / "checkpoint-467").mkdir(parents=True)
    asked = []
    monkeypatch.setattr(readers, "_glob", lambda spark, pattern, folders_only=False: asked.append(pattern) or [pattern])
    plan = readers.list_checkpoints(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert set(asked) == {str(tmp_path)} and "MapInArrow" in plan and "LocalTableScan" not in plan


def test_headers_as_a_csv_reader_sees_them(spark, tmp_path):
    write(tmp_path / "a.csv", '"a,b",_step,"say ""x""", train/loss\n"1,5",3,z,0.25\n')
    write(tmp_path / "b.csv", "train/loss,_step\r\n0.5,4\r\n")
    found = readers.load_histories(spark, str(tmp_path))
    assert set(found.columns) == {"a,b", "_step", 'say "x"', "train/loss", "name"}
    assert rows(found.fillna("-"), "name", "_step", "train/loss", "a,b", 'say "x"') == [("a", 3, 0.25, "1,5", "z"), ("b", 4, 0.5, "-", "-")]
    cells = spark.createDataFrame([(",,",), ("",), ('"",a,"b ""c"" ,"',), ("x,\r",)], "v string").select(readers.csv_cells(F.col("v")).alias("c"))
    assert [r["c"] for r in cells.collect()] == [["", "", ""], [""], ["", "a", 'b "c" ,'], ["x", ""]]


# ---- writers --------------------------------------------------------------


def raw_runs(spark, tmp_path):
    lines = [
        {"id": "1", "name": "lr1e-4_r8_lora_8B", "state": "finished", "created_at": "2024-01-01T00:00:00Z",
         "config": {"lr": "1", "_x": "2"}, "summary": {"a": "b"}},
        {"id": "2", "name": "debug", "state": "failed", "created_at": "2024-01-02T00:00:00Z", "config": {}, "summary": {}},
    ]
    write(tmp_path / "raw.json", "\n".join(map(json.dumps, lines)))
    return readers.load_raw_runs(spark, str(tmp_path / "raw.json"))


def test_run_files(spark, tmp_path):
    raw = raw_runs(spark, tmp_path)
    sinks.write_overview(raw, str(tmp_path / "overview"))
    text = spark.read.option("header", True).option("escape", '"').option("escape", "\\").csv(str(tmp_path / "overview"))
    assert text.columns == ["name", "id", "state", "created_at", "config", "summary"]
    assert text.first()["config"] == '{"lr":"1"}'

    sinks.write_parsed_runs(raw, str(tmp_path / "parsed"))
    parsed = readers.load_parsed_runs(spark, str(tmp_path / "parsed"))
    assert rows(parsed.fillna(-1), "id", "is_grid_run", "lora_rank", "final_loss") == [
        ("1", True, 8, -1.0), ("2", False, -1, -1.0),
    ]
    sinks.write_summary(runs.parse_names(raw), str(tmp_path / "summary"))
    with open(part_file(tmp_path / "summary", ".json")) as f:
        summary = json.load(f)
    assert summary["total_runs"] == 2 and summary["grid_runs"] == 1 and summary["lora_ranks"] == [8]
    assert summary["states"] == {"finished": 1, "failed": 1}


def test_inventory_and_metric_history(spark, tmp_path):
    stats = spark.createDataFrame(
        [("grid", 3, 1, 1, 1), ("other", 1, 0, 0, 1)],
        "kind string, total long, downloaded long, skipped long, failed long",
    )
    sinks.write_inventory(stats, str(tmp_path / "inv"), F.lit("2024-01-02 03:04:05").cast("timestamp"))
    with open(part_file(tmp_path / "inv", ".json")) as f:
        inventory = json.load(f)
    assert inventory["download_date"] == "2024-01-02 03:04:05"
    assert inventory["grid_runs"] == {"total": 3, "downloaded": 1, "skipped": 1, "failed": 1}
    values = spark.createDataFrame([("a", 0.5)], "name string, eval_accuracy double")
    log = str(tmp_path / "metrics")
    for batch in ("first", "first", "second"):
        sinks.append_metric(values, log, "eval_accuracy", batch)
    sinks.append_metric(values.selectExpr("name", "eval_accuracy + 1 AS final_loss"), log, "final_loss", "first")
    want = [("a", "eval_accuracy", "first", 0.5), ("a", "eval_accuracy", "second", 0.5), ("a", "final_loss", "first", 1.5)]
    assert rows(spark.read.parquet(log), "name", "metric", "batch", "value") == want
    sinks.append_metric(values.withColumn("eval_accuracy", F.lit(0.75)), log, "eval_accuracy", "first")
    assert rows(spark.read.parquet(log), "name", "metric", "batch", "value") == [("a", "eval_accuracy", "first", 0.75), *want[1:]]


def test_skewed_write_is_split(spark, tmp_path):
    df = spark.range(5000).selectExpr("if(id < 4000, 'hot', concat('k', id % 5)) AS run", "id")
    sinks.write_by(df, ["run"], str(tmp_path / "by"))
    back = spark.read.parquet(str(tmp_path / "by"))
    assert back.count() == 5000 and back.where("run = 'hot'").count() == 4000


# ---- jobs -----------------------------------------------------------------


def test_prepare_training(spark, dataset):
    chat = jobs.prepare_training(spark, PrepareJob(dataset, "all", "swiss_judgment_prediction"))
    assert chat.columns == ["messages"] and chat.count() == 15
    short = PrepareJob(dataset, "all", "swiss_judgment_prediction", debug=True, debug_rows=4)
    assert jobs.prepare_training(spark, short).count() == 4
    plain = jobs.prepare_training(spark, PrepareJob(dataset, "all"))
    assert plain.count() == 20 and "text" in plain.columns


def test_generate_then_score(spark, dataset, tmp_path):
    out = str(tmp_path / "out")
    job = GenerateJob(f"{dataset}/all", out, strategy="swiss_judgement_prediction", start=1, end=4)

    def load(asked):
        assert asked.max_new_tokens == 200 and asked.temperature == 0.0
        return lambda texts: ["approval" if "case 17" in t or "case 18" in t else "?" for t in texts]

    done = jobs.generate_answers(spark, job, load)
    assert rows(done, "row_id", "generated_answer") == [(16, "?"), (17, "approval"), (18, "approval")]
    tables = jobs.score_answers(spark, ScoreJob(out, from_disk=True))
    assert tables["accuracy"].first()[0] == pytest.approx(1 / 3)
    assert tables["parse_errors"].first()["parse_errors"] == 1
    assert {r["class"]: r["support"] for r in tables["report"].collect()}["Dismissal (0)"] == 2


def test_benchmark_grid(spark, tmp_path):
    for model in ("m1", "m2"):
        write(tmp_path / "grid" / model / "checkpoint-467" / "x", "")
    for subset, n in (("mcq_4_choices", 4), ("mcq_8_choices", 8)):
        items = [(i, f"q{i}", str([f"o{j}" for j in range(n)]), i % n) for i in range(12)]
        df = spark.createDataFrame(items, "row_id long, question string, choices string, gold int")
        df.withColumn("split", F.lit("test")).write.parquet(str(tmp_path / "items" / subset))
    job = BenchmarkJob(
        str(tmp_path / "items"), str(tmp_path / "grid"), str(tmp_path / "out"), ("mcq_4_choices", "mcq_8_choices")
    )

    def model(asked, paths):
        assert sorted(paths) == ["m1", "m2"] and asked.max_lora_rank == 512
        return lambda name, texts: [f"###{'A' if name == 'm1' else 'B'}###" for _ in texts]

    out = jobs.benchmark_grid(spark, job, model)
    results = rows(out["results"], "model_folder", "subset", "correct", "total")
    assert results == [("m1", "mcq_4_choices", 3, 12), ("m1", "mcq_8_choices", 2, 12), ("m2", "mcq_4_choices", 3, 12),
                       ("m2", "mcq_8_choices", 2, 12)]
    assert out["results"].columns == list(sinks.GRID_RESULT_COLUMNS)
    assert {r["n"] for r in out["distribution"].collect()} == {12}
    path = sinks.grid_results_path(str(tmp_path / "grid"))
    assert path.endswith("/eval_results_checkpoint-467.csv")
    sinks.write_grid_results(out["results"], path)
    assert spark.read.option("header", True).csv(path).count() == 4
    sinks.write_metrics({k: out[k] for k in ("report", "confusion")}, str(tmp_path / "tables"))
    assert spark.read.parquet(str(tmp_path / "tables" / "confusion")).agg(F.sum("n")).first()[0] == 48
    assert scoring.leaderboard(out["results"]).count() == 4
    with pytest.raises(ValueError, match="checkpoint-9"):
        jobs.benchmark_grid(spark, BenchmarkJob(job.dataset, job.grid_dir, job.output, checkpoint="checkpoint-9"), model)


def test_report_tables(spark):
    from tunelab.plans import catalog
    from tunelab.plans.derived import view

    sf_dir = "/root/testdata/sf0.001"
    tables = jobs.report_tables(
        catalog.runs_with_loss(spark, sf_dir), catalog.histories(spark, sf_dir), view(spark, sf_dir, "task"),
        catalog.wide_benchmark(spark, sf_dir),
    )
    assert {name for name, df in tables.items() if df.count() == 0} <= {"comparison", "pairs"}


# ---- streaming ------------------------------------------------------------


def test_ingest_takes_up_new_histories_only(spark, tmp_path):
    folder, table, state = tmp_path / "h", str(tmp_path / "table"), str(tmp_path / "state")
    write(folder / "a.csv", "_step,train/loss\n1,0.9\n2,NaN\n")

    def run():
        ingest.ingest_histories(ingest.history_stream(spark, str(folder)), table, state)
        return rows(spark.read.parquet(table).fillna(-1.0))

    first = [("a", 1, 0.9), ("a", 2, -1.0)]
    assert run() == first and run() == first
    write(folder / "b.csv", "_step,train/loss\n5,0.1\n")
    assert run() == [*first, ("b", 5, 0.1)]


def test_ingest_never_reads_by_position(spark, tmp_path):
    write(tmp_path / "h" / "a.csv", "train/loss,_step\n0.9,1\n")
    stream = ingest.history_stream(spark, str(tmp_path / "h"))
    with pytest.raises(Exception, match="CSV header|_step"):
        ingest.ingest_histories(stream, str(tmp_path / "table"), str(tmp_path / "state"))


def test_bad_files_stop_nothing(spark, tmp_path):
    folder, table, bad, state = tmp_path / "h", str(tmp_path / "table"), str(tmp_path / "bad"), str(tmp_path / "state")
    write(folder / "a.csv", "_step,train/loss\n1,0.9\n2,NaN\n3,\n")
    write(folder / "turned.csv", '"x,y",train/loss,_step\n"p,q",0.5,7\n')
    write(folder / "second.csv", "loss,_step\n0.4,8\n")
    write(folder / "no_header.csv", "1,2\n")
    write(folder / "no_loss.csv", "_step,acc\n1,2\n")
    write(folder / "short.csv", "_step,train/loss\n1,0.5\n2\n")
    write(folder / "words.csv", "_step,train/loss\n1,high\n")
    (folder / "binary.csv").write_bytes(bytes(range(256)))

    def run():
        ingest.ingest_files(ingest.line_stream(spark, str(folder)), table, bad, state)
        return rows(spark.read.parquet(table).fillna(-1.0), "name", "_step", "train/loss", "loss")

    first = [("a", 1, 0.9, -1.0), ("a", 2, -1.0, -1.0), ("a", 3, -1.0, -1.0), ("second", 8, -1.0, 0.4), ("turned", 7, 0.5, -1.0)]
    assert run() == first and run() == first
    write(folder / "late.csv", "_step,train/loss\n5,0.1\n")
    write(folder / "late_bad.csv", "nothing\n")
    assert run() == [*first[:3], ("late", 5, 0.1, -1.0), *first[3:]]
    found = ingest.ingested_files(spark, table, bad)
    reasons = {r["name"]: r["reason"] for r in found.where("status = 'failed'").collect()}
    assert reasons == {
        "no_header": "no header", "no_loss": "no loss column", "short": "a row of another length",
        "words": "train/loss is no number", "binary": "no header", "late_bad": "no header",
    }
    stats = run_ops.ingest_stats(found.withColumn("kind", F.lit("grid")))
    assert rows(stats, "total", "downloaded", "skipped", "failed") == [(10, 4, 0, 6)]


def test_a_batch_that_is_written_again_adds_nothing(spark, tmp_path):
    """The state of the stream is lost after its first batch was written: the second run replaces that batch."""
    folder, table, bad = tmp_path / "h", str(tmp_path / "table"), str(tmp_path / "bad")
    write(folder / "a.csv", "_step,train/loss\n1,0.9\n")
    for state in ("first", "second"):
        ingest.ingest_files(ingest.line_stream(spark, str(folder)), table, bad, str(tmp_path / state))
    assert rows(spark.read.parquet(table), "name", "_step") == [("a", 1)]
    assert rows(ingest.ingested_files(spark, str(tmp_path / "none"), bad)) == []


# ---- resumed generation ---------------------------------------------------


def counting_model(log, fails_on=None):
    """A model that leaves a file per prompt it was asked, and breaks down at one of them."""

    def load():
        def answer(texts):
            for text in texts:
                if text == fails_on:
                    raise RuntimeError("the machine is gone")
                with open(os.path.join(log, f"{text}-{uuid.uuid4().hex}"), "w"):
                    pass
            return [f"answer {t}" for t in texts]

        return answer

    return load


def asked(log):
    return Counter(name.split("-")[0] for name in os.listdir(log))


def test_a_killed_generation_asks_only_for_the_rest(spark, tmp_path):
    df = spark.range(40).selectExpr("id AS row_id", "CAST(id AS string) AS prompt").repartition(3)
    path, first, second = str(tmp_path / "answers"), tmp_path / "first", tmp_path / "second"
    first.mkdir(), second.mkdir()
    with pytest.raises(Exception, match="the machine is gone"):
        generate.generate_resumably(df, ["row_id"], counting_model(str(first), "17"), path, batches=8)
    logged = {r["prompt"] for r in spark.read.parquet(path).collect()}
    assert logged and "17" not in logged
    found = generate.generate_resumably(df, ["row_id"], counting_model(str(second)), path, batches=8)
    assert rows(found, "prompt", "generated_answer") == sorted((str(i), f"answer {i}") for i in range(40))
    assert asked(second) == Counter({str(i): 1 for i in range(40) if str(i) not in logged})
    assert logged <= set(asked(first))
    generate.generate_resumably(df, ["row_id"], counting_model(str(second)), path, batches=3)
    assert sum(asked(second).values()) == 40 - len(logged)


def test_a_killed_grid_asks_each_model_only_for_the_rest(spark, tmp_path):
    items = spark.range(12).selectExpr("id AS row_id", "if(id % 5 = 0, null, 's') AS subset", "CAST(id AS string) AS prompt")
    path, log = str(tmp_path / "answers"), tmp_path / "log"
    log.mkdir()

    model = counting_model(str(log))

    def load(fails=False):
        plain = model()

        def answer(name, texts):
            if fails and name == "b" and "7" in texts:
                raise RuntimeError("the machine is gone")
            return plain([f"{name}{t}" for t in texts])

        return answer

    with pytest.raises(Exception, match="the machine is gone"):
        generate.generate_grid_resumably(items, ["row_id", "subset"], ["a", "b"], lambda: load(True), path, batches=4)
    had = {(r["model_folder"], r["prompt"]) for r in spark.read.parquet(path).collect()} if os.path.exists(path) else set()
    for name in os.listdir(log):
        os.unlink(log / name)
    found = generate.generate_grid_resumably(items, ["row_id", "subset"], ["a", "b", "c"], lambda: load(), path, batches=4)
    assert rows(found, "model_folder", "prompt", "generated_text") == sorted((m, str(i), f"answer {m}{i}") for m in "abc" for i in range(12))
    assert found.columns == ["row_id", "subset", "prompt", "model_folder", "generated_text", "generation_seconds"]
    assert asked(log) == Counter({f"{m}{i}": 1 for m in "abc" for i in range(12) if (m, str(i)) not in had})


def test_generation_of_nothing(spark, tmp_path):
    none = spark.createDataFrame([], "row_id long, prompt string")
    found = generate.generate_resumably(none, ["row_id"], counting_model(str(tmp_path)), str(tmp_path / "log"))
    assert found.count() == 0 and "generated_answer" in found.columns
    grid_ = generate.generate_grid_resumably(none, ["row_id"], ["a"], lambda: None, str(tmp_path / "grid"))
    assert grid_.count() == 0 and "generated_text" in grid_.columns
