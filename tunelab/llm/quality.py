"""Quality classifier by importance resampling: hashed n-gram models and Gumbel top-k."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunelab.llm.common import bounded_batches, stored, text_key

#: Buckets of the hashed byte n-grams; two more hold repeated and new words.
BUCKETS = 1 << 14
GRAM = 3
#: Labelled rows that are used at most, the first in hash order.
SAMPLE = 20_000
#: A good document lost weighs as much as so many bad ones kept.
CAUTION = 5
#: Weights are those of a text of so many symbols, so that the length of a text does not outweigh what it holds; as many
#: neutral symbols are added to every text, so that a few odd ones do not decide over a short text.
TYPICAL, NEUTRAL = 3000, 300
SLICE = 1 << 20
SEED = "gumbel"

_POWERS = np.cumprod(np.full(256, 0x100000001B3, np.uint64), dtype=np.uint64)


def grams(text: str | None) -> Iterator[np.ndarray]:
    """Symbols of a text, slice by slice: hashed byte 3-grams, and for each word whether it repeats the one before.

    Slices end at white space; a word longer than a slice counts as several.
    """
    data = np.frombuffer((text or "").encode(), np.uint8)
    last = np.zeros(0, np.uint64)
    start = 0
    while start < len(data):
        end = min(len(data), start + SLICE)
        space = (data[start:end] == 32) | ((data[start:end] >= 9) & (data[start:end] <= 13))
        if end < len(data) and (cuts := np.flatnonzero(space)).size:
            end, space = start + int(cuts[-1]) + 1, space[: int(cuts[-1]) + 1]
        run = data[start : end + GRAM - 1].astype(np.uint64)
        hashes = np.zeros(max(0, len(run) - GRAM + 1), np.uint64)
        for k in range(GRAM):
            hashes = hashes * np.uint64(257) + run[k : k + len(hashes)]
        yield ((hashes * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64)
        begins = np.flatnonzero(~space & np.concatenate([[True], space[:-1]]))
        if begins.size:
            at = np.zeros(len(space), np.int64)
            at[begins] = begins
            at = np.arange(len(space)) - np.maximum.accumulate(at)
            letters = np.where(space, np.uint64(0), (data[start:end] + np.uint64(1)) * _POWERS[at & 255])
            words = np.concatenate([last, np.add.reduceat(letters, begins)])
            yield np.where(words[1:] == words[:-1], BUCKETS, BUCKETS + 1)
            last = words[-1:]
        start = end


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(batch.column(0), batch.column(1))


def symbol_counts(docs: DataFrame, quality: dict[int, int]) -> np.ndarray:
    """How often each symbol occurs in all documents (row 0) and in the good ones of the labelled sample (row 1)."""
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, BUCKETS + 2), np.int64)
        for doc_id, text in _batches(batches):
            good = quality.get(doc_id.as_py()) == 1
            for found in grams(text.as_py()):
                own = np.bincount(found, minlength=BUCKETS + 2)
                counts[0] += own
                counts[1] += own * good
        used = np.flatnonzero(counts[0])
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[0, used]), pa.array(counts[1, used])], names=["symbol", "all", "good"])

    parts = docs.select("doc_id", "text").mapInArrow(run, "symbol long, all long, good long")
    total = np.zeros((2, BUCKETS + 2), np.int64)
    for r in parts.groupBy("symbol").agg(F.sum("all").alias("all"), F.sum("good").alias("good")).collect():
        total[:, r["symbol"]] = r["all"], r["good"]
    return total


def log_ratios(counts: np.ndarray) -> np.ndarray:
    """Per symbol: log of its probability in good text over that in all text; n-grams and words are two models."""
    logs = []
    for part in (counts[:, :BUCKETS], counts[:, BUCKETS:]):
        smooth = part + 1.0
        logs.append(np.log(smooth / smooth.sum(axis=1, keepdims=True)))
    logs = np.concatenate(logs, axis=1)
    return logs[1] - logs[0]


def with_weight(docs: DataFrame, ratios: np.ndarray) -> DataFrame:
    """``docs`` in a struct ``row``, with ``log_weight``: the log importance weight of the whole text, scaled to a typical length."""
    bounded_batches(docs.sparkSession)
    named = docs.select(F.struct(*docs.columns).alias("row"), F.col("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for text in batch.column(1):
                total, n = 0.0, NEUTRAL
                for symbols in grams(text.as_py()):
                    total += float(ratios[symbols].sum())
                    n += len(symbols)
                found.append(TYPICAL * total / n)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.float64())], names=["row", "log_weight"])

    schema = f"row {named.schema['row'].dataType.simpleString()}, log_weight double"
    return named.mapInArrow(run, schema)


def with_key(weighed: DataFrame, seed: str = SEED) -> DataFrame:
    """Add ``key``: the log weight plus Gumbel noise that depends on the seed and doc_id alone."""
    number = text_key(F.lit(seed), F.coalesce(F.col("row.doc_id").cast("string"), F.lit("")))
    uniform = (number.cast("double") + 0.5) / float(1 << 60)
    return weighed.withColumn("key", F.col("log_weight") - F.log(-F.log(uniform)))


def cut_point(good: np.ndarray, bad: np.ndarray, caution: float = CAUTION) -> float:
    """The weight that parts good from bad labelled documents best: the middle of the widest best gap."""
    if not len(good) or not len(bad):
        return -math.inf
    values = np.unique(np.concatenate([good, bad]))
    good, bad = np.sort(good), np.sort(bad)
    cuts = np.concatenate([[values[0] - 1], (values[1:] + values[:-1]) / 2])
    gaps = np.concatenate([[0.0], np.diff(values)])
    cost = caution * np.searchsorted(good, cuts) + len(bad) - np.searchsorted(bad, cuts)
    best = np.flatnonzero(cost == cost.min())
    return float(cuts[best[gaps[best].argmax()]])


def kth_largest(df: DataFrame, column: str, k: int, bins: int = 1000) -> float:
    """The k-th largest value, exactly: counts in ever finer bins; the driver sees the counts of one round only."""
    low, high = df.agg(F.min(column), F.max(column)).first()
    while low < high:
        step = (high - low) / bins
        if low + step <= low or high - step >= high:
            break
        bin_of = F.least(F.floor((F.col(column) - low) / step), F.lit(bins - 1))
        inside = df.where(F.col(column).between(low, high)).groupBy(bin_of.alias("bin"))
        found = inside.agg(F.count("*").alias("n"), F.min(column).alias("low"), F.max(column).alias("high")).collect()
        above = df.where(F.col(column) > high).count()
        for r in sorted(found, key=lambda r: -r["bin"]):
            if above + r["n"] >= k:
                low, high = r["low"], r["high"]
                break
            above += r["n"]
    return low


@dataclass
class Classifier:
    ratios: np.ndarray
    threshold: float


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, caution: float = CAUTION, seed: str = SEED) -> tuple[Classifier, DataFrame]:
    """The classifier of a corpus, and the stored (doc_id, log_weight, key) of all its documents.

    Target model: n-grams of the documents labelled good, in a bounded sample of ``sample`` labelled rows.  Raw
    model: n-grams of all documents.  The weight that parts labelled good and bad documents best says how many documents
    resemble the target; as many are drawn, by Gumbel top-k over log weights.  Without
    good and bad labels all documents are kept.
    """
    rated = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    known = rated.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).collect()
    quality = {r["doc_id"]: int(r["quality"] >= 1) for r in known}
    ratios = log_ratios(symbol_counts(docs, quality)) if any(quality.values()) else np.zeros(BUCKETS + 2)
    weighed = with_key(with_weight(docs.select("doc_id", "text"), ratios), seed).select("row.doc_id", "log_weight", "key")
    weighed = stored(weighed, "weights")
    marks = docs.sparkSession.createDataFrame(list(quality.items()), "doc_id long, quality int")
    seen = weighed.join(F.broadcast(marks), "doc_id").groupBy("doc_id").agg(F.min("log_weight").alias("w"), F.min("quality").alias("q")).collect()
    cut = cut_point(np.array([r["w"] for r in seen if r["q"]]), np.array([r["w"] for r in seen if not r["q"]]), caution)
    k = weighed.where(F.col("log_weight") >= F.lit(cut)).count()
    threshold = kth_largest(weighed, "key", k) if k and cut > -math.inf else -math.inf
    return Classifier(ratios, threshold), weighed


def classify(docs: DataFrame, labels: DataFrame, **how) -> DataFrame:
    """(doc_id, log_weight, key, kept): importance weight of every document, and whether the resampling draws it.

    Null and empty texts have weight 0; texts are whole, in slices if long.  Rows that repeat a doc_id are rated by
    what each holds; equal keys are kept or rejected together.  An empty table gives an empty one; other columns are ignored.
    Labels that are null or belong to no document are left out; of several for one document the lowest counts.
    """
    model, weighed = fit(docs, labels, **how)
    return weighed.withColumn("kept", F.col("key") >= F.lit(model.threshold))


def accepted(docs: DataFrame, labels: DataFrame, **how) -> DataFrame:
    """The documents that :func:`classify` keeps, with all their columns; texts are not shuffled."""
    model, _ = fit(docs, labels, **how)
    return with_key(with_weight(docs, model.ratios)).where(F.col("key") >= F.lit(model.threshold)).select("row.*")
