"""Explicit input schemas and the two ingest rules (defaults, NaN to null)."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MESSAGES = "array<struct<role:string,content:string>>"

JUDGMENT_CASES = (
    "year int, language string, source_language string, region string, canton string, "
    "legal_area string, text string, label int"
)
MCQ_ITEMS = "question string, choices array<string>, course string, gold int"
RAW_RUNS = (
    "id string, name string, state string, created_at timestamp, config map<string,string>, summary map<string,string>"
)
# lora_rank is written as 64.0 because the column holds missing values.
PARSED_RUNS = (
    "name string, id string, state string, created_at timestamp, is_grid_run boolean, learning_rate double, "
    "lora_rank double, method string, model_size string, final_loss double"
)
TASK_EVAL = "model_size string, lr double, rank int, eval_accuracy double"
ADAPTER_CONFIG = "base_model_name_or_path string, r int"

# Names of the loss column, first match first.
LOSS_COLUMNS = ("train/loss", "loss", "train_loss")
STEP_COLUMN = "_step"

# Column order of the grid results file.
GRID_RESULT_COLUMNS = (
    "model_folder",
    "checkpoint",
    "subset",
    "accuracy",
    "correct",
    "total",
    "generation_time",
)


def quoted(name: str) -> Column:
    """A column by its exact name, which may hold ``/``, ``-`` or dots."""
    return F.col(f"`{name}`")


def with_defaults(df: DataFrame, defaults: Mapping[str, Any]) -> DataFrame:
    """Add each missing column as a constant; existing columns stay, nulls too."""
    absent = {name: value if isinstance(value, Column) else F.lit(value) for name, value in defaults.items()}
    return df.withColumns({name: value for name, value in absent.items() if name not in df.columns})


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN means missing in the inputs, so every floating column drops it on ingest."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    if not floats:
        return df
    return df.withColumns({name: F.when(~F.isnan(quoted(name)), quoted(name)) for name in floats})


def has_columns(df: DataFrame, names: list[str]) -> bool:
    """Required-column guard: callers skip a source that lacks one."""
    return all(name in df.columns for name in names)


def union_all(frames: list[DataFrame], allow_missing: bool = False) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)
