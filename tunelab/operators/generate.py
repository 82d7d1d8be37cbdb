"""Bulk generation and token lengths around injected Python callables.

These are the only operators whose core is Python: a model and a tokenizer
cannot be SQL expressions.  Spark partitions the rows, Arrow carries them in
batches, and the callable is built once per Python worker.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence
from functools import partial, reduce
from operator import and_

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tunelab.schemas import quoted
from tunelab.session import scratch_dir
from tunelab.sources.readers import exists

GenerateFn = Callable[[list[str]], list[str]]
ModelFactory = Callable[[], GenerateFn]
# Called with a model name and prompts: one base model that serves many adapters.
AdapterFactory = Callable[[], Callable[[str, list[str]], list[str]]]

OUTPUT_COLUMN = "generated_answer"
SECONDS_COLUMN = "generation_seconds"
#: Spark jobs that a resumable generation is cut into.
BATCHES = 8


def _answered(df: DataFrame, out: str) -> T.StructType:
    added = [T.StructField(out, T.StringType()), T.StructField(SECONDS_COLUMN, T.DoubleType())]
    return T.StructType([*df.schema.fields, *added])


def _answer(batch: pa.RecordBatch, prompt_col: str, generate: GenerateFn, out: str) -> pa.RecordBatch:
    """The batch with its texts and each row's share of the wall time; other columns pass as they are."""
    start = time.perf_counter()
    texts = generate(batch.column(prompt_col).to_pylist())
    if len(texts) != batch.num_rows:
        raise ValueError(f"{len(texts)} texts for {batch.num_rows} prompts")
    seconds = (time.perf_counter() - start) / batch.num_rows
    columns = [*batch.columns, pa.array(texts, pa.string()), pa.array([seconds] * batch.num_rows, pa.float64())]
    return pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, out, SECONDS_COLUMN])


def batch_generate(
    df: DataFrame, factory: ModelFactory, prompt_col: str = "prompt", out: str = OUTPUT_COLUMN
) -> DataFrame:
    """One generated text per prompt, kept in the row of its prompt.

    ``factory`` runs once per task, before its first batch.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        generate: GenerateFn | None = None
        for batch in batches:
            if batch.num_rows:
                generate = generate or factory()
                yield _answer(batch, prompt_col, generate, out)

    return df.mapInArrow(run, _answered(df, out))


def generate_grid(
    items: DataFrame,
    models: Sequence[str],
    factory: AdapterFactory,
    prompt_col: str = "prompt",
    out: str = "generated_text",
    answered: str | None = None,
) -> DataFrame:
    """Answers of every model of a grid to every item.

    The models are adapters of one base, built once per task, which goes through
    them for each batch of items.  Prompts are neither copied per model nor
    shuffled.  ``models`` comes from a folder listing.  ``answered`` may name a column of
    models that an item needs no more; it is not returned.
    """
    folder = T.StructField("model_folder", T.StringType())
    kept = [c for c in items.columns if c != answered]
    schema = T.StructType([*[items.schema[c] for c in kept], folder, *_answered(items, out).fields[-2:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        generate = None
        for batch in batches:
            done = batch.column(answered).to_pylist() if answered else [()] * batch.num_rows
            plain = batch.select(kept)
            for model in models:
                open_ = [i for i, had in enumerate(done) if model not in (had or ())]
                if not open_:
                    continue
                own = plain if len(open_) == len(done) else plain.take(pa.array(open_))
                generate = generate or factory()
                own = pa.RecordBatch.from_arrays([*own.columns, pa.array([model] * own.num_rows)], names=[*kept, "model_folder"])
                yield _answer(own, prompt_col, partial(generate, model), out)

    return items.mapInArrow(run, schema)


def _logged(spark: SparkSession, path: str) -> DataFrame | None:
    """The log of answers so far; None before its first batch."""
    return spark.read.parquet(path) if exists(spark, f"{path.rstrip('/')}/*.parquet") else None


def _in_batches(todo: DataFrame, keys: Sequence[str], batches: int, answer: Callable[[DataFrame], DataFrame], path: str) -> None:
    """Append the answers batch by batch; what a batch has written is not lost when a later one fails."""
    batch = F.pmod(F.xxhash64(*map(quoted, keys)), F.lit(batches)).alias("_batch")
    folder = scratch_dir(todo.sparkSession, "to_generate")
    todo.select("*", batch).write.partitionBy("_batch").parquet(folder)
    rows = todo.sparkSession.read.schema(T.StructType([*todo.schema.fields, T.StructField("_batch", T.LongType())])).parquet(folder)
    for row in rows.groupBy("_batch").agg(F.count(F.lit(1))).orderBy("_batch").collect():
        answer(rows.where(F.col("_batch") == row["_batch"]).drop("_batch")).write.mode("append").parquet(path)


def generate_resumably(
    df: DataFrame,
    keys: Sequence[str],
    factory: ModelFactory,
    path: str,
    prompt_col: str = "prompt",
    out: str = OUTPUT_COLUMN,
    batches: int = BATCHES,
) -> DataFrame:
    """One generated text per prompt in the log at ``path``; only rows whose ``keys`` are not in it yet are asked for.

    Rows are dealt into ``batches`` by their keys.  Each batch is a Spark job of its own that appends its answers, so a run that is
    cut short loses the batch it was in, and the next one asks the model for the rest only.  The keys must tell rows apart.
    """
    log = _logged(df.sparkSession, path)
    todo = df
    if log is not None:
        same = [quoted(k).eqNullSafe(F.col(f"_done_{i}")) for i, k in enumerate(keys)]
        todo = df.join(log.select(*[quoted(k).alias(f"_done_{i}") for i, k in enumerate(keys)]), reduce(and_, same), "left_anti")
    _in_batches(todo, keys, batches, lambda rows: batch_generate(rows, factory, prompt_col, out), path)
    log = _logged(df.sparkSession, path)
    return batch_generate(df.limit(0), factory, prompt_col, out) if log is None else log


def generate_grid_resumably(
    items: DataFrame,
    keys: Sequence[str],
    models: Sequence[str],
    factory: AdapterFactory,
    path: str,
    prompt_col: str = "prompt",
    out: str = "generated_text",
    batches: int = BATCHES,
) -> DataFrame:
    """The answers of :func:`generate_grid` in the log at ``path``; a model is asked only what it has not answered there.

    The log gives each item the set of models that have answered it, at most one entry per model of the grid.
    """
    log = _logged(items.sparkSession, path)
    todo = items.withColumn("_answered", F.lit(None).cast("array<string>"))
    if log is not None:
        had = log.groupBy(*[quoted(k).alias(f"_done_{i}") for i, k in enumerate(keys)]).agg(F.collect_set("model_folder").alias("_answered"))
        same = [quoted(k).eqNullSafe(F.col(f"_done_{i}")) for i, k in enumerate(keys)]
        todo = items.join(had, reduce(and_, same), "left").select(*[items[c] for c in items.columns], "_answered")
        left = F.size(F.array_except(F.array(*map(F.lit, models)), F.coalesce("_answered", F.array().cast("array<string>"))))
        todo = todo.where(left > 0)
    _in_batches(todo, keys, batches, lambda rows: generate_grid(rows, models, factory, prompt_col, out, "_answered"), path)
    log = _logged(items.sparkSession, path)
    return generate_grid(items.limit(0), models, factory, prompt_col, out) if log is None else log


def token_length(text: Column, factory: Callable[[], Callable[[list[str]], list[int]]]) -> Column:
    """Token count per text with an injected tokenizer."""

    def lengths(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        count = factory()
        for batch in batches:
            yield pd.Series(count(batch.tolist()), dtype="int32")

    return F.pandas_udf(lengths, "int")(text)


def with_fallback(first: Callable, second: Callable) -> Callable:
    """A factory that builds ``second`` when ``first`` cannot be built."""

    def build():
        try:
            return first()
        except Exception as error:  # e.g. a tokenizer that is not installed
            print(f"falling back: {error}")
            return second()

    return build
