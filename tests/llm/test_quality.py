"""Quality classifier: brute force, held-out accuracy, awkward rows."""

import duckdb
import numpy as np
import pytest
from llm_cases import TEXTS, brute_quality, brute_weights, gumbel, rows_of
from pyspark.sql import functions as F

from tunelab.llm import quality

SMALL, LARGER = "/root/testdata/sf0.001", "/root/testdata/sf0.1"
LABELS = "doc_id long, quality int, toxic int"


def _order(row):
    return -1 if row[0] is None else row[0], round(row[1], 3)


def test_weights_and_draw(spark, documents):
    labels = {1: 1, 2: 1, 6: 1, 12: 0, 10: 1, 13: 0}
    table = spark.createDataFrame([(d, q, 0) for d, q in labels.items()] + [(12, 1, 0), (None, 1, 0), (3, None, 0), (77, 0, 0)], LABELS)
    rows = [x[:2] for x in TEXTS]
    found = quality.classify(documents, table).collect()
    drawn = [bool(x) for x in brute_quality(rows, labels)]
    want = sorted(((d, float(w), float(w + gumbel(d)), k) for (d, _), w, k in zip(rows, brute_weights(rows, labels), drawn)), key=_order)
    got = sorted(((r["doc_id"], r["log_weight"], r["key"], r["kept"]) for r in found), key=_order)
    assert [(d, k) for d, _, _, k in got] == [(d, k) for d, _, _, k in want]
    assert np.allclose([x[1:3] for x in got], [x[1:3] for x in want], atol=1e-5)
    kept = quality.accepted(documents, table)
    assert kept.columns == documents.columns
    assert rows_of(kept, "doc_id", "text") == sorted((r for r, k in zip(rows, drawn) if k), key=repr)


def test_without_labels_all_stay(spark, documents, no_documents):
    none = spark.createDataFrame([], LABELS)
    assert quality.accepted(documents, none).count() == len(TEXTS)
    assert quality.classify(no_documents, none).count() == 0


def test_slices_do_not_change_the_symbols(monkeypatch):
    text = "Wort wort wort! größere Wörter " * 50 + "x" * 30 + " end end"
    whole = [np.bincount(np.concatenate(list(quality.grams(text))), minlength=quality.BUCKETS + 2)]
    monkeypatch.setattr(quality, "SLICE", 64)
    assert (np.bincount(np.concatenate(list(quality.grams(text))), minlength=quality.BUCKETS + 2) == whole[0]).all()
    assert list(quality.grams(None)) == list(quality.grams("")) == []


@pytest.mark.parametrize("k", [1, 5, 50, 500])
def test_kth_largest(spark, k):
    values = np.round(np.random.default_rng(k).lognormal(0, 3, 500), 1)
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    assert quality.kth_largest(df, "x", k, bins=7) == np.sort(values)[::-1][k - 1]


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{LARGER}/{t}.parquet") for t in ("documents", "labels"))
    known, unseen = (labels.where(F.xxhash64("doc_id") % 2 == r) for r in (0, 1))
    unseen = unseen.union(labels.where(F.xxhash64("doc_id") % 2 == -1))
    rated = quality.classify(docs, known).join(unseen, "doc_id")
    kept = {r["quality"]: (r["n"], r["k"]) for r in rated.groupBy("quality").agg(F.count("*").alias("n"), F.sum(F.col("kept").cast("int")).alias("k")).collect()}
    assert kept[1][1] >= 0.998 * kept[1][0]
    assert kept[0][1] <= 0.03 * kept[0][0]
