"""Operators against hand-worked results, NumPy, and brute force on small inputs."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tunelab.operators import checkpoints, generate, grid, history, lengths, positions, report, runs, scoring


def rows(df, *columns):
    return [tuple(r[c] for c in columns or df.columns) for r in df.collect()]


# ---- scoring --------------------------------------------------------------


def random_pairs(spark, labels, n=400, seed=3):
    rng = random.Random(seed)
    pairs = [(rng.choice("ab"), rng.choice(labels), rng.choice(labels)) for _ in range(n)]
    return pairs, spark.createDataFrame(pairs, "k string, gold string, pred string")


def brute_report(pairs, labels):
    out = {}
    for c in labels:
        hit = sum(g == p == c for g, p in pairs)
        support, said = sum(g == c for g, _ in pairs), sum(p == c for _, p in pairs)
        p, r = hit / said if said else 0.0, hit / support if support else 0.0
        f = 2 * hit / (support + said) if support + said else 0.0
        out[c] = (p, r, f, support)
    total = sum(v[3] for v in out.values())
    out["macro avg"] = (*[sum(v[i] for k, v in out.items()) / len(labels) for i in range(3)], total)
    out["weighted avg"] = (
        *[sum(out[c][i] * out[c][3] for c in labels) / total if total else 0.0 for i in range(3)], total,
    )
    return out


def test_open_class_report(spark):
    pairs, df = random_pairs(spark, ["A", "B", "None", "AA"])
    counts = scoring.label_counts(df, "gold", "pred", ["k"])
    got = scoring.class_report(counts, ["k"], with_overall=False).collect()
    for key in "ab":
        mine = [(g, p) for k, g, p in pairs if k == key]
        want = brute_report(mine, sorted({x for pair in mine for x in pair}))
        seen = {r["class"]: (r["precision"], r["recall"], r["f1"], r["support"]) for r in got if r["k"] == key}
        assert set(seen) == set(want)
        for name, values in want.items():
            assert seen[name] == pytest.approx(values, abs=1e-9)


def report_of(spark, pairs, **kw):
    df = spark.createDataFrame(pairs, "label int, pred int")
    counts = scoring.label_counts(df, "label", "pred")
    return {r["class"]: r for r in scoring.class_report(counts, classes=[0, 1], **kw).collect()}


def test_fixed_class_report_overall_row(spark):
    clean = report_of(spark, [(0, 0), (0, 1), (1, 1), (1, 1)])
    assert "micro avg" not in clean and clean["accuracy"]["f1"] == 0.75 and clean["accuracy"]["precision"] is None
    mixed = report_of(spark, [(0, 0), (0, -1), (1, 1), (1, 0)])
    assert "accuracy" not in mixed
    micro = mixed["micro avg"]
    assert micro["precision"] == pytest.approx(2 / 3) and micro["recall"] == 0.5 and micro["support"] == 4


def test_fixed_class_report_without_hits(spark):
    """A class that is never right, predicted or present counts as 0, not as an error."""
    got = report_of(spark, [(1, -1), (1, -1)])
    assert (got["0"]["precision"], got["0"]["recall"], got["0"]["f1"], got["0"]["support"]) == (0.0, 0.0, 0.0, 0)
    assert got["1"]["f1"] == 0.0 and got["weighted avg"]["f1"] == 0.0


def test_confusion_is_dense_and_sums_to_rows(spark):
    pairs, df = random_pairs(spark, list("ABCDE"), n=60)
    counts = scoring.label_counts(df, "gold", "pred", ["k"])
    cells = scoring.confusion(counts, ["k"]).collect()
    assert sum(r["n"] for r in cells) == 60
    for key in "ab":
        mine = {(r["gold"], r["pred"]): r["n"] for r in cells if r["k"] == key}
        assert mine == Counter((g, p) for k, g, p in pairs if k == key)


@pytest.mark.parametrize("n", [1000, 1001])
def test_confusion_does_not_depend_on_the_number_of_labels(spark, n):
    df = spark.range(n).selectExpr("'k' AS k", "concat('l', id) AS gold", "concat('l', (id + 1) % 7) AS pred")
    counts = scoring.label_counts(df, "gold", "pred", ["k"])
    assert scoring.confusion(counts, ["k"]).count() == n
    places = {r["label"]: r["place"] for r in scoring.label_union(counts, ["k"]).collect()}
    assert sorted(places, key=places.get) == sorted(places) and len(places) == n


def test_rows_without_gold_belong_to_no_class(spark):
    df = spark.createDataFrame([("A", "A"), ("A", "B"), (None, "A"), ("B", "B")], "gold string, pred string")
    counts = scoring.label_counts(df, "gold", "pred")
    known = scoring.label_counts(df.where("gold is not null"), "gold", "pred")
    for classes in (None, ["A", "B"]):
        got, want = (sorted(rows(scoring.class_report(c, classes=classes)), key=str) for c in (counts, known))
        assert got == want and None not in {r[0] for r in got}


def test_leaderboard_ties_by_name(spark):
    df = spark.createDataFrame(
        [("s", "m2", 0.5), ("s", "m1", 0.5), ("s", "m3", 0.9), ("t", "m1", 0.1)],
        "subset string, model_folder string, accuracy double",
    )
    got = rows(scoring.leaderboard(df).orderBy("subset", "place"), "subset", "place", "model_folder")
    assert got == [("s", 1, "m3"), ("s", 2, "m1"), ("s", 3, "m2"), ("t", 1, "m1")]


# ---- lengths --------------------------------------------------------------


@pytest.mark.parametrize("values", [list(range(1, 200)), [7] * 5, [1, 2], [0, 50, 100, 100, 1, 49, 51, 99], [3]])
def test_lengths_as_numpy(spark, values):
    df = spark.createDataFrame([("s", v) for v in [*values, None]], "subset string, length int")
    stats = lengths.length_stats(df, ["subset"]).first()
    assert (stats["min"], stats["max"], stats["count"]) == (min(values), max(values), len(values))
    want = [np.mean(values), np.median(values), np.std(values), np.percentile(values, 95), np.percentile(values, 99)]
    assert [stats[c] for c in ("mean", "median", "std", "p95", "p99")] == pytest.approx(want, abs=1e-5)

    bins = lengths.length_histogram(df, ["subset"]).orderBy("bin").collect()
    counts, edges = np.histogram(values, bins=50)
    assert [r["n"] for r in bins] == counts.tolist()
    assert [r["bin_start"] for r in bins] == pytest.approx(edges[:-1].tolist(), abs=1e-5)


# ---- positions ------------------------------------------------------------


@pytest.fixture(scope="module")
def keyed(spark):
    keys = random.Random(2).sample(range(-5000, 5000), 997)
    return sorted(keys), spark.createDataFrame([(k, f"v{k}") for k in keys], "k long, v string").repartition(7).cache()


@pytest.mark.parametrize("start,end", [(0, None), (0, 10), (10, 500), (990, None), (996, 997), (5, 5), (0, 0)])
def test_slice(keyed, start, end):
    keys, df = keyed
    got = sorted(r["k"] for r in positions.slice_rows(df, "k", start, end).collect())
    assert got == keys[start:end]


def test_slice_outside(keyed):
    with pytest.raises(IndexError):
        positions.slice_rows(keyed[1], "k", 0, 998)
    with pytest.raises(IndexError):
        positions.slice_rows(keyed[1], "k", 6, 5)


@pytest.mark.parametrize("n", [1, 2, 7, 997, 1000])
def test_shards_partition_the_rows(keyed, n):
    keys, df = keyed
    labelled = sorted((r["k"], r["shard"]) for r in positions.with_shard(df, "k", n).collect())
    want = [(k, i) for i, part in enumerate(np.array_split(keys, n)) for k in part.tolist()]
    assert labelled == want


def test_one_shard_is_its_label(keyed):
    keys, df = keyed
    for index in (0, 3, 6):
        got = sorted(r["k"] for r in positions.shard(df, "k", 7, index).collect())
        assert got == np.array_split(keys, 7)[index].tolist()
    for bad in ((7, 7), (7, -1), (0, 0)):
        with pytest.raises(ValueError):
            positions.shard(df, "k", *bad)


def test_text_keys_and_nulls(spark):
    keys = [f"k{i:03d}" for i in range(50)]
    df = spark.createDataFrame([(k,) for k in reversed(keys)], "k string")
    assert sorted(r[0] for r in positions.slice_rows(df, "k", 5, 45).collect()) == keys[5:45]
    with pytest.raises(ValueError, match="nulls"):
        positions.slice_rows(df.union(spark.createDataFrame([(None,)], "k string")), "k", 0, 2)


def test_key_of_several_columns(spark):
    pairs = [(a, b) for a in range(9) for b in "xyz"]
    df = spark.createDataFrame(random.Random(4).sample(pairs, 27), "a int, b string")
    assert rows(positions.slice_rows(df, ["a", "b"], 4, 20).orderBy("a", "b")) == pairs[4:20]
    labelled = {(r["a"], r["b"]): r["shard"] for r in positions.with_shard(df, ["a", "b"], 4).collect()}
    want = {pairs[i]: n for n, part in enumerate(np.array_split(range(27), 4)) for i in part}
    assert labelled == want
    assert rows(positions.head(df, ["a", "b"], 5).orderBy("a", "b")) == pairs[:5]


def test_shared_limit_is_refused(spark):
    df = spark.createDataFrame([(1,), (2,), (2,), (3,)], "k int")
    with pytest.raises(ValueError, match="unique"):
        positions.slice_rows(df, "k", 0, 2)
    assert sorted(r["k"] for r in positions.slice_rows(df, "k", 0, 3).collect()) == [1, 2, 2]


def test_slice_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).write.parquet(path)
    plan = positions.slice_rows(spark.read.parquet(path), "id", 10, 20)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(id,10)" in plan and "LessThan(id,20)" in plan and "Exchange" not in plan


# ---- runs -----------------------------------------------------------------


RUNS = "run_id long, name string, state string, created_at timestamp, has_history boolean"


def some_runs(spark, data):
    df = spark.createDataFrame([(*d[:3], None, d[4]) for d in data], RUNS)
    times = {d[0]: d[3] for d in data}
    stamp = F.lit(None).cast("timestamp")
    for run, t in times.items():
        stamp = F.when(F.col("run_id") == run, F.lit(f"2024-01-01 00:00:{t:02d}").cast("timestamp")).otherwise(stamp)
    return df.withColumn("created_at", stamp)


def test_ingest_status_as_sequential_run(spark):
    data = [
        (1, "a", "finished", 1, False), (2, "a", "finished", 2, True), (3, "a", "finished", 3, True),
        (4, "b", "finished", 4, True), (5, "c", "finished", 5, False), (6, "d", "finished", 6, True),
        (7, "d", "finished", 6, True),
    ]
    stored, want = {"b"}, {}
    for run, name, _, _, has in data:  # files appear one by one
        want[run] = "skipped" if name in stored else "downloaded" if has else "failed"
        if want[run] == "downloaded":
            stored.add(name)
    incoming, known = some_runs(spark, data), spark.createDataFrame([("b",)], "name string")
    assert dict(rows(runs.ingest_status(incoming, known), "run_id", "status")) == want
    again = dict(rows(runs.ingest_status(incoming, known, overwrite=True), "run_id", "status"))
    assert again == {d[0]: "downloaded" if d[4] else "failed" for d in data}
    stats = runs.ingest_stats(runs.ingest_status(incoming, known).withColumn("kind", F.lit("grid"))).first()
    assert (stats["total"], stats["downloaded"], stats["skipped"], stats["failed"]) == (7, 2, 3, 2)


def test_update_final_loss_keeps_the_number_of_runs(spark):
    known = spark.createDataFrame([(1, "a", 9.0), (2, "a", 9.0), (3, "z", 9.0)], "id int, name string, final_loss double")
    losses = spark.createDataFrame([("a", 0.5), ("a", 0.5)], "name string, final_loss double")
    got = sorted(rows(runs.update_final_loss(known, losses), "id", "final_loss"))
    assert got == [(1, 0.5), (2, 0.5), (3, None)]


def test_attach_metric(spark):
    known = spark.createDataFrame([(1, "a", 0.1), (2, "a", None), (3, "b", 0.3)], "id int, name string, m double")
    values = spark.createDataFrame([("a", 0.9), ("x", 0.8)], "name string, m double")
    assert sorted(rows(runs.attach_metric(known, values, "m"), "id", "m")) == [(1, 0.9), (2, 0.9), (3, 0.3)]
    twice = values.union(values.withColumn("m", F.col("m") - 0.5))
    assert sorted(rows(runs.attach_metric(known, twice, "m"), "id", "m")) == [(1, 0.9), (2, 0.9), (3, 0.3)]
    assert runs.matched_metrics(known.drop("m"), twice, "m").count() == 2
    assert sorted(rows(runs.matched_metrics(known.drop("m"), values, "m"), "id", "m")) == [(1, 0.9), (2, 0.9)]
    assert rows(runs.unmatched(values, known), "name") == [("x",)]
    member, other = runs.split_members(known, values)
    assert sorted(rows(member, "id")) == [(1,), (2,)] and rows(other, "id") == [(3,)]


def test_first_per_config_and_filter(spark):
    data = [(3, "lr1e-4_r8_lora_8B", "finished", 5, True), (2, "lr1e-4_r8_lora_8B_x", "finished", 5, True),
            (1, "lr1e-4_r8_lora_8B", "failed", 1, True), (4, "lr1e-3_r1_full_8B", "finished", 2, True)]
    known = runs.parse_names(some_runs(spark, data))
    first = runs.first_per_config(runs.filter_runs(known))
    assert sorted(rows(first, "run_id", "method")) == [(2, "lora"), (4, "full")]
    assert rows(runs.filter_runs(known, lora_rank=8, learning_rate=1e-4, state="failed"), "run_id") == [(1,)]
    assert rows(runs.filter_runs(known, model_size="70B"), "run_id") == []
    losses = spark.createDataFrame([("lr1e-3_r1_full_8B", 0.5)], "name string, final_loss double")
    assert sorted(rows(runs.with_final_loss(known, losses).fillna(-1.0), "run_id", "final_loss"))[-1] == (4, 0.5)
    kept = known.withColumn("final_loss", F.lit(7.0))
    assert {r["final_loss"] for r in runs.with_final_loss(kept, losses).collect()} == {7.0}
    one = runs.summary(known).first()
    assert one["states"] == {"finished": 3, "failed": 1}
    none = runs.summary(known.limit(0)).first()
    assert none["total_runs"] == 0 and none["lora_ranks"] == [] and none["states"] == {}
    assert (one["total_runs"], one["lora_runs"], one["full_ft_runs"], one["lora_ranks"]) == (4, 3, 1, [8])


# ---- histories ------------------------------------------------------------


def test_losses_fall_through_but_stats_do_not(spark):
    data = [("a", 1, 0.9, 5.0), ("a", 3, None, 6.0), ("a", 2, 0.7, 7.0), ("b", 1, None, 0.4), ("b", 2, None, 0.3),
            ("c", 1, None, None)]
    df = spark.createDataFrame(data, "name string, _step int, `train/loss` double, loss double")
    assert sorted(rows(history.final_loss(df))) == [("a", 0.7), ("b", 0.3), ("c", None)]
    stats = history.curve_stats(df, extra={"max_loss": F.max("`train/loss`")})
    assert rows(stats) == [("a", 0.7, 0.7, 0.8, 2, 0.9)]
    assert sorted(rows(history.curve_stats(df.drop("train/loss")), "name", "num_steps")) == [("a", 3), ("b", 2)]
    assert sorted(rows(history.final_loss(df.drop("train/loss", "loss")))) == [("a", None), ("b", None), ("c", None)]


def test_points_without_step_and_equal_steps(spark):
    data = [("a", None, 0.9), ("b", None, 0.8), ("b", 1, 0.7), ("c", 5, 0.2), ("c", 5, 0.4), ("c", 4, 0.9)]
    df = spark.createDataFrame(data, "name string, _step int, `train/loss` double").repartition(4)
    assert sorted(rows(history.final_loss(df))) == [("a", 0.9), ("b", 0.7), ("c", 0.4)]
    assert sorted(rows(history.curve_stats(df), "name", "final_loss")) == [("a", 0.9), ("b", 0.7), ("c", 0.4)]
    assert sorted(rows(history.last_points(df, n=1), "name", "train/loss")) == [("a", 0.9), ("b", 0.7), ("c", 0.4)]


@pytest.mark.parametrize("n", [3, 1000, 1001])
def test_last_points_of_a_hot_run(spark, n):
    df = spark.range(6000).select(
        F.when(F.col("id") < 4000, "hot").otherwise(F.concat(F.lit("r"), F.col("id") % 50)).alias("name"),
        F.col("id").alias("_step"),
    )
    want = {}
    for name, step in rows(df):
        want.setdefault(name, []).append(step)
    want = sorted((name, step) for name, steps in want.items() for step in sorted(steps)[-n:])
    assert sorted(rows(history.last_points(df, n=n))) == want


def test_last_points_are_cut_before_the_last_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 3 AS name", "id AS _step")
    plan = history.last_points(df)._jdf.queryExecution().executedPlan().toString()
    exchange = plan.index("Exchange")
    assert "WindowGroupLimit" in plan[exchange:] and "Partial" in plan[exchange:]


def test_last_points_order_equal_and_missing_steps(spark):
    """Only the points from the n-th last step on are ordered whole; ties there go by the other columns, runs may be null."""
    rng = random.Random(3)
    data = [(rng.choice(["a", "b", None]), rng.choice([None, 1, 2, 3, 4, 5]), rng.randrange(100) / 4) for _ in range(400)]
    df = spark.createDataFrame(data, "name string, _step int, loss double").repartition(4)
    for n in (1, 30, 99, 1000):
        want = []
        for run in ("a", "b", None):
            points = [x for x in data if x[0] == run]
            want += sorted(points, key=lambda x: (x[1] is None, -(x[1] or 0), -x[2]))[:n]
        assert Counter(map(tuple, history.last_points(df, n=n).collect())) == Counter(want)


@pytest.mark.parametrize("n, shards", [(300_000, 7), (50_000, 2)])
def test_positions_by_selection(spark, monkeypatch, n, shards):
    """Keys at positions by repeated counting, without a sort, a shuffle of rows or a written key."""
    monkeypatch.setattr(positions, "SORTED_KEYS", 500)
    df = spark.range(n, numPartitions=8).selectExpr("(id * 7919) % 1000003 AS b", "pmod(id, 3) AS a", "cast((id * 7919) % 1000003 AS string) AS s")
    for key in ("b", "s", ["a", "b"]):
        columns = [key] if isinstance(key, str) else key
        order = [tuple(r) if len(columns) > 1 else r[0] for r in df.select(*columns).orderBy(*columns).collect()]
        at = [0, 1, n // 3, n - 1]
        found = positions.keys_at(df, key, positions.count_keys(df, key), at)
        assert [tuple(x) if len(columns) > 1 else x for x in found] == [order[p] for p in at]
    labelled = positions.with_shard(df, "b", shards).groupBy("shard").agg(F.count("*").alias("n"), F.min("b"), F.max("b"))
    got = [tuple(r) for r in labelled.orderBy("shard").collect()]
    keys = sorted((i * 7919) % 1000003 for i in range(n))
    starts = [*positions.shard_starts(n, shards), n]
    assert got == [(i, b - a, keys[a], keys[b - 1]) for i, (a, b) in enumerate(zip(starts, starts[1:]))]


def test_positions_beside_a_key_that_repeats(spark, monkeypatch):
    monkeypatch.setattr(positions, "SORTED_KEYS", 4096)
    df = spark.range(20_000).selectExpr("if(id < 15000, -1, id) AS k")
    assert sorted(r["k"] for r in positions.slice_rows(df, "k", 15_100, 15_200).collect()) == list(range(15_100, 15_200))
    assert positions.slice_rows(df, "k", 0, 15_000).count() == 15_000
    with pytest.raises(ValueError, match="not unique"):
        positions.slice_rows(df, "k", 7, 15_100)


# ---- grid -----------------------------------------------------------------


def test_default_grid_has_66_points(spark):
    assert grid.grid_points(spark).count() == 66


def test_found_and_missing_make_the_grid(spark):
    names = ["lr1e-5_r1_full_8B", "lr1e-4_r8_lora_8B", "lr1e-4_r8_lora_8B_retry", "lr1e-3_r7_lora_8B", "baseline"]
    known = runs.parse_names(spark.createDataFrame([(n,) for n in names], "name string"))
    gaps = grid.missing(known)
    assert gaps.count() == 64
    table = {r["model_size"]: r for r in grid.coverage(known).collect()}
    assert (table["all"]["total_expected"], table["all"]["total_found"]) == (66, 2)
    assert table["8B"]["coverage_percent"] == pytest.approx(100 * 2 / 33, abs=1e-6)
    assert table["70B"]["total_found"] == 0
    top = grid.first_missing(gaps).collect()
    assert len(top) == 10 and {r["and_more"] for r in top} == {54}
    first = top[0]
    assert (first["model_size"], first["method"], first["learning_rate"], first["lora_rank"]) == ("8B", "lora", 1e-5, 1)


def test_pending(spark):
    small = grid.Grid(model_sizes=["8B"], learning_rates=[1e-4], lora_ranks=[1, 2, 4, 8], methods=["lora"])
    plan = grid.planned_runs(grid.grid_points(spark, small), "/out/")
    jobs = spark.createDataFrame([("sft-lr1e-4_r1_lora_8B",), ("other",)], "job_name string")
    files = spark.createDataFrame(
        [("/out/lr1e-4_r2_lora_8B/config.json",), ("/out/lr1e-4_r2_lora_8B/log.txt",),
         ("/out/lr1e-4_r4_lora_8B/log.txt",)], "path string",
    )
    left = grid.pending(plan, jobs, grid.completed_folders(files))
    assert sorted(rows(left, "run_id")) == [("lr1e-4_r4_lora_8B",), ("lr1e-4_r8_lora_8B",)]


def test_latest_checkpoint_is_numeric(spark):
    paths = [f"/g/lr1e-4_r1/checkpoint-{n}" for n in (467, 1000, 99)] + ["/g/lr1e-4_r1/logs"]
    df = spark.createDataFrame([("lr1e-4_r1", p) for p in paths], "model_folder string, path string")
    assert rows(checkpoints.latest(df)) == [("lr1e-4_r1", "/g/lr1e-4_r1/checkpoint-1000", 1000)]


# ---- report ---------------------------------------------------------------


REPORT_RUNS = (
    "run_id int, name string, state string, created_at int, model_size string, method string, learning_rate double, "
    "lora_rank int, is_grid_run boolean, final_loss double"
)


def report_runs(spark):
    data = [
        (1, "a", "finished", 1, "8B", "lora", 1e-4, 8, True, 0.9),
        (2, "b", "finished", 2, "8B", "lora", 1e-3, 8, True, 0.7),
        (3, "c", "finished", 3, "8B", "lora", 1e-3, 4, True, 0.6),  # one point only
        (4, "d", "finished", 4, "8B", "full", 1e-4, None, True, 0.5),
        (5, "e", "finished", 5, "70B", "lora", 1e-3, 1, True, 1.2),  # the diverged cell
        (6, "f", "finished", 6, "70B", "lora", 1e-4, 1, True, 1.0),
        (7, "g", "failed", 7, "70B", "lora", 1e-4, 1, True, 0.1),
        (8, "h", "finished", 8, "70B", "lora", 1e-5, 1, True, float("nan")),
        (9, "i", "finished", 9, "70B", "lora", 1e-5, 1, True, 3.0),
    ]
    return spark.createDataFrame(data, REPORT_RUNS)


def test_rate_sweep(spark):
    got = sorted(rows(report.rate_sweep(report_runs(spark)), "model_size", "method", "learning_rate", "final_loss"))
    assert got == [("8B", "full", 1e-4, 0.5), ("8B", "lora", 1e-4, 0.9), ("8B", "lora", 1e-3, 0.7)]
    strict = report.rate_sweep(report_runs(spark), {"lora": 1, "full": 2})
    assert sorted(rows(strict, "method", "final_loss")) == [("lora", 0.6), ("lora", 0.7), ("lora", 0.9), ("lora", 1.0)]


def test_best_rates_and_gap(spark):
    known = report_runs(spark)
    best = sorted(rows(report.best_rate(known), "model_size", "method", "learning_rate", "final_loss"))
    assert best == [("70B", "lora", 1e-4, 1.0), ("8B", "full", 1e-4, 0.5), ("8B", "lora", 1e-3, 0.6)]
    gap = {r["model_size"]: r["gap_percent"] for r in report.full_vs_lora(known).collect()}
    assert gap["8B"] == pytest.approx(100 * 0.1 / 0.6, abs=1e-5) and gap["70B"] is None
    pairs = {(r["model_size"], r["lora_rate"]): r["full_run"] for r in report.pair_rates(known).collect()}
    assert pairs[("8B", 1e-3)] == "d" and pairs[("8B", 1e-4)] is None


def test_heatmap_and_limits(spark):
    known = report_runs(spark).where("not isnan(final_loss)")
    fourth = known.where("lora_rank = 8 and method = 'lora'").withColumn("learning_rate", F.lit(1e-6))
    cells = report.heatmap(known.union(fourth.select(*known.columns)))
    heat = {(r["model_size"], r["lora_rank"], r["lr"]): r["final_loss"] for r in cells.collect()}
    assert heat[("8B", 8, "1e-4")] == 0.9 and ("8B", 8, "1e-5") not in heat
    assert heat[("70B", 1, "1e-5")] == 3.0  # the heat-map keeps diverged runs
    assert ("8B", 8, "1e-6") in heat  # and whatever rate was run
    limits = {r["model_size"]: (r["y_min"], r["y_max"]) for r in report.axis_limits(known).collect()}
    assert limits["8B"] == pytest.approx((0.48, 0.92))


def test_unpivot_benchmark(spark):
    wide = spark.createDataFrame(
        [("grid_8B_lora_x", "0.25", "0.5", "NaN"), ("lr1e-4_r8_lora_70B", "0.1", "0.2", None), ("plain", "1", "1", "1"),
         (None, "1", "1", "1")],
        "name string, `lr1e-4_r8_lora_8B/mcq_4_choices/accuracy` string, "
        "`lr1e-4_r8_lora_70B/mcq_4_choices/accuracy` string, `lr1e-3_r1_lora_8B/mcq_4_choices/accuracy` string",
    )
    got = sorted(rows(report.unpivot_benchmark(wide), "model_size", "learning_rate", "lora_rank", "accuracy"))
    assert got == [("70B", 1e-4, 8, 0.2), ("8B", 1e-4, 8, 0.25)]


def test_curves_use_first_run_of_each_configuration(spark):
    known = report_runs(spark).withColumn("model_size", F.lit("8B"))
    points = spark.createDataFrame([("a", 1, 0.5), ("b", 1, None), ("b", 2, 0.4), ("zz", 1, 0.1)],
                                   "name string, _step int, `train/loss` double")
    got = sorted(rows(report.learning_curves(known, points), "lr", "lora_rank", "step", "loss"))
    assert got == [("1e-3", 8, 2, 0.4), ("1e-4", 8, 1, 0.5)]


def test_curves_hold_the_paired_full_run(spark):
    names_ = ["lr1e-3_r8_lora_8B", "lr1e-4_r1_full_8B", "lr1e-5_r1_full_8B"]
    known = runs.parse_names(spark.createDataFrame([(i, n, "finished", i) for i, n in enumerate(names_)],
                                                   "run_id int, name string, state string, created_at int"))
    points = spark.createDataFrame([(n, s, 1.0 / s) for n in names_ for s in range(1, 151)],
                                   "name string, _step int, `train/loss` double")
    curves = report.learning_curves(known, points)
    shown = sorted(rows(curves.select("lr", "method", "run_lr", "name").distinct()))
    assert shown == [("1e-3", "full", "1e-4", names_[1]), ("1e-3", "lora", "1e-3", names_[0])]
    tail = report.curve_tail(curves)
    assert tail.count() == 200 and tail.agg(F.min("step")).first()[0] == 51


# ---- generation -----------------------------------------------------------


def test_batch_generate_keeps_rows_together(spark):
    # Large and missing numbers pass unchanged.
    big = "if(id % 2 = 0, id + 9007199254740993, null) AS big"
    df = spark.range(500).selectExpr("id", "concat('p', id) AS prompt", big, "array(id) AS ids").repartition(5)
    done = generate.batch_generate(df, lambda: lambda texts: [t[::-1] for t in texts])
    assert all(r["generated_answer"] == r["prompt"][::-1] for r in done.collect())
    assert done.drop("generated_answer", "generation_seconds").exceptAll(df).isEmpty() and done.count() == 500
    with pytest.raises(Exception, match="1 texts for"):
        generate.batch_generate(df, lambda: lambda texts: ["one"]).collect()


def test_generate_grid_answers_every_item_once_per_model(spark):
    items = spark.range(40).selectExpr("id AS row_id", "concat('p', id) AS prompt")
    done = generate.generate_grid(items, ["m1", "m2", "m3"], lambda: lambda m, texts: [f"{m}:{t}" for t in texts])
    got = {(r["model_folder"], r["row_id"]): r["generated_text"] for r in done.collect()}
    assert got == {(m, i): f"{m}:p{i}" for m in ("m1", "m2", "m3") for i in range(40)}


def test_token_length_with_fallback(spark):
    def broken():
        raise OSError("no tokenizer")

    factory = generate.with_fallback(broken, lambda: lambda texts: [len(t) for t in texts])
    df = spark.createDataFrame([("abc",), ("",)], "t string")
    assert [r[0] for r in df.select(generate.token_length(F.col("t"), factory)).collect()] == [3, 0]
