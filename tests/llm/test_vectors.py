"""Operators on embeddings against brute force."""

import math

import numpy as np
import pytest
from llm_cases import groups, rows_of
from pyspark.sql import functions as F

from tunelab.llm import embedding_dedup, topk

SMALL = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, label int, v string, norm string, rep string, n string, q string, k1 string"


@pytest.fixture(scope="module")
def given(spark):
    return spark.read.parquet(f"{SMALL}/embeddings.parquet")


@pytest.fixture(scope="module")
def awkward():
    rng = np.random.default_rng(5)
    rows = []
    for i in range(400):
        v = rng.standard_normal(7).astype(np.float32)
        rows.append((i, [float(x) for x in v]))
        if i % 5 == 0:
            rows.append((1000 + i, [float(x) for x in v]))  # a copy
        if i % 4 == 0:
            rows.append((2000 + i, [float(x) for x in (v + 0.2 * rng.standard_normal(7)).astype(np.float32)]))
    rows += [(3000 + i, [3.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0]) for i in range(40)]
    rows += [(100, None), (200, []), (300, [0.0] * 7), (3500, [math.nan] * 7), (3600, [1.0, None, 1.0]), (3700, [math.inf, 1.0]), (3800, [1.0, 2.0]), (3900, [2.0, 4.0])]
    rows += [(None, [1.0] * 7), (3000, [3.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0]), (4000, [1e30, -1e30, 1e25, 0.0, 1.0, 2.0, 3.0]), (4100, [-1e30, 1e30, 0.0, 0.0, 1.0, 2.0, 3.0])]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, *["clash"] * 6) for i, v in rows], SCHEMA).repartition(3)


def usable(v):
    return v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v)


def brute_topk(rows, every, best=10):
    clip = lambda n: max(-(1 << 63), min((1 << 63) - 1, n))
    whole = [(i, [clip(math.floor(1024 * float(np.float32(x)))) for x in v]) for i, v in rows if i is not None and usable(v)]
    whole = [(i, [int(float(x)) for x in v]) for i, v in whole]
    out = []
    asks = {}
    for i, v in whole:
        if i % every == 0:
            asks.setdefault((i, len(v)), []).append(v)
    for (q, _), vs in asks.items():
        mine = [(clip(sum(a * b for a, b in zip(min(vs), v))), i) for i, v in whole if i != q and len(v) == len(vs[0])]
        out += [(q, r, i, s) for r, (s, i) in enumerate(sorted(mine, key=lambda x: (-x[0], x[1]))[:best], 1)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("sizes", [(8192, 2048, 2048), (64, 3, 16)])
def test_topk(spark, awkward, given, monkeypatch, sizes):
    for name, n in zip(("VECTORS", "QUERIES", "HEAD"), sizes):
        monkeypatch.setattr(topk, name, n)
    plain = [x for x in awkward if x[0] is None or x[0] < 4000]
    columns = ("query_id", "rank", "vec_id", "score")
    for df, rows in ((frame(spark, plain), plain), (given, [(r["vec_id"], r["embedding"]) for r in given.collect()])):
        assert rows_of(topk.top_k(df, F.col("vec_id") % 100 == 0), *columns) == brute_topk(rows, 100)


def test_topk_of_huge_numbers(spark):
    rows = [(i * 100, [float(x) * 2.0**40 for x in v]) for i, v in enumerate(np.random.default_rng(1).integers(-9, 9, (60, 5)))]
    found = topk.top_k(frame(spark, rows), F.col("vec_id") % 100 == 0)
    assert rows_of(found, "query_id", "rank", "vec_id", "score") == brute_topk(rows, 100)


def brute_links(rows, cosine=0.9):
    n = len(rows)
    unit = [np.array(v, float) / max(map(abs, v)) if i is not None and usable(v) and any(v) else None for i, v in rows]
    unit = [u if u is None else u / np.linalg.norm(u) for u in unit]
    near = [[j for j in range(n) if j != i and unit[i] is not None and unit[j] is not None and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= cosine] for i in range(n)]
    group = groups(n, lambda i: near[i])
    least = {g: min((rows[i][0] for i in range(n) if group[i] == g and rows[i][0] is not None), default=None) for g in set(group)}
    return sorted(((rows[i][0], len(near[i]), least[group[i]], rows[i][0] == least[group[i]]) for i in range(n)), key=repr)


@pytest.mark.parametrize("sizes", [(512, 4096), (24, 16)])
def test_near_duplicates(spark, awkward, given, monkeypatch, sizes):
    for name, n in zip(("LIST", "BLOCK"), sizes):
        monkeypatch.setattr(embedding_dedup, name, n)
    for df, rows in ((frame(spark, awkward), awkward), (given, [(r["vec_id"], r["embedding"]) for r in given.collect()])):
        got = rows_of(embedding_dedup.near_duplicates(df), "vec_id", "n_links", "component_id", "kept")
        want = brute_links(rows)
        assert len(got) == len(want)
        if sizes[0] >= len(rows) / 2:
            assert got == want
        else:  # several lists: links may be missed, none may be made up
            assert sum(x[1] for x in got) >= 0.9 * sum(x[1] for x in want)
            assert all(a[1] <= b[1] for a, b in zip(got, want))


def test_empty_tables(spark):
    none = frame(spark, [(1, [1.0])]).limit(0)
    assert topk.top_k(none, F.col("vec_id") % 100 == 0).count() == 0
    assert embedding_dedup.near_duplicates(none).count() == 0


def test_vectors_that_share_an_id_are_linked_by_what_they_hold(spark):
    rows = [(5, [1.0, 0.0]), (5, [1.0, 0.1]), (5, [0.0, 1.0]), (7, [0.1, 1.0]), (3, [-1.0, 0.0]), (3, [-1.0, 0.1]), (9, [-1.0, 0.1])]
    found = embedding_dedup.near_duplicates(frame(spark, rows))
    assert rows_of(found, "vec_id", "n_links", "component_id", "kept") == brute_links(rows)
