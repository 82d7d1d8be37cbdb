"""Training rows and inference prompts."""

from __future__ import annotations

import ast
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tunelab.functions import prompts
from tunelab.schemas import quoted

Strategy = Callable[..., DataFrame]


def judgment_messages(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Labelled cases as chat rows; every source column is dropped."""
    user = prompts.message("user", prompts.judgment_prompt(df, text_col))
    assistant = prompts.message("assistant", prompts.label_word(df))
    return df.select(F.array(user, assistant).alias("messages"))


def default_text(df: DataFrame) -> DataFrame:
    """Unchanged with a ``text`` column, else the row as JSON in ``text``."""
    if "text" in df.columns:
        return df
    row = F.struct(*[quoted(c) for c in df.columns])
    return df.withColumn("text", F.to_json(row, {"ignoreNullFields": "false"}))


def default_prompt(df: DataFrame, input_col: str = "text", out: str = "prompt") -> DataFrame:
    """The input column as it is; empty text when the column is missing."""
    return df.withColumn(out, quoted(input_col) if input_col in df.columns else F.lit(""))


def judgment_chat_prompt(
    df: DataFrame, input_col: str = "text", out: str = "prompt", fmt: prompts.ChatFormat = prompts.ChatFormat()
) -> DataFrame:
    """The judgment prompt as a single user turn, opened for the reply."""
    turn = F.array(prompts.message("user", prompts.judgment_prompt(df, input_col)))
    return df.withColumn(out, prompts.render_chat(turn, fmt, add_generation_prompt=True))


# Strategy names are fixed values; both spellings of the judgment strategy
# occur in job files, so both are known to both registries.
TRAINING_STRATEGIES: dict[str, Strategy] = {
    "default": default_text,
    "swiss_judgment_prediction": judgment_messages,
    "swiss_judgement_prediction": judgment_messages,
}
INFERENCE_STRATEGIES: dict[str, Strategy] = {
    "default": default_prompt,
    "swiss_judgment_prediction": judgment_chat_prompt,
    "swiss_judgement_prediction": judgment_chat_prompt,
}


def register_strategy(registry: dict[str, Strategy], name: str, strategy: Strategy) -> None:
    registry[name] = strategy


def pick_strategy(registry: dict[str, Strategy], name: str) -> Strategy:
    if name not in registry:
        raise ValueError(f"unknown processing strategy {name!r}; known: {sorted(registry)}")
    return registry[name]


def only_split(df: DataFrame, split: str, split_col: str = "split") -> DataFrame:
    """Rows of one split without the split column; an absent split is an error."""
    kept = df.where(quoted(split_col) == split)
    if kept.isEmpty():
        raise ValueError(f"split {split!r} is missing")
    return kept.drop(split_col)


def literal_choices(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Python list literals as lists of texts; anything else as null."""

    def read(text: str | None) -> list[str] | None:
        if text is None:
            return None
        try:
            value = ast.literal_eval(text)
        except Exception:  # not a literal: the text stands for itself, so no choices
            return None
        return [str(item) for item in value] if isinstance(value, list) else None

    for series in texts:
        yield series.map(read, na_action="ignore")


# One item of a list literal: a quoted text, a constant, or a number that is written the way it prints.
_QUOTED = r"""\"[^\"\\\x00-\x1f]*+(?:\\[\"'\\][^\"\\\x00-\x1f]*+)*+\"|'[^'\\\x00-\x1f]*+(?:\\[\"'\\][^'\\\x00-\x1f]*+)*+'"""
_NUMBER = r"-?(?:0|[1-9][0-9]{0,8})\.(?:0|[0-9]{0,3}[1-9])(?![0-9.eEjJ_])|(?:0|-?[1-9][0-9]{0,17})(?![0-9.eEjJ_xXoObB])"
_ITEM = rf"{_QUOTED}|\b(?:None|True|False)\b|(?<![0-9A-Za-z_.+-])(?:{_NUMBER})"


def _is_plain(value: Column) -> Column:
    """What is left after the items are cut out must be [,,,]."""
    bare = F.regexp_replace(value, _ITEM, "\u0001")
    bare = F.regexp_replace(F.regexp_replace(bare, "[ \\t\\r\\n]", ""), "\u0001,(?=[\u0001\\]])", "")
    return bare.isin("[]", "[\u0001]") | (F.regexp_replace(bare, "\u0001,", "\u0001") == F.lit("[\u0001]"))


def parsed_choices(df: DataFrame, name: str = "choices") -> Column:
    """The choices as ``array<string>``; null when they are no list or not readable.

    A text that holds a list of quoted strings (with escaped quotes and
    backslashes), None, True, False and plain numbers is read by patterns.
    Other literals, such as nested lists, are flagged by :func:`unread_choices`
    and left to :func:`read_literals`.
    """
    dtype = df.schema[name].dataType
    value = quoted(name)
    if isinstance(dtype, T.ArrayType):
        return value.cast("array<string>")
    if not isinstance(dtype, T.StringType):
        return F.lit(None).cast("array<string>")

    def text(item: Column) -> Column:
        inner = F.regexp_replace(F.substring(item, 2, 1 << 30), ".$", "")
        is_text = F.left(item, F.lit(1)).isin("'", '"')
        return F.when(is_text, F.regexp_replace(inner, "(?s)\\\\(.)", "$1")).otherwise(item)

    return F.when(_is_plain(value), F.transform(F.regexp_extract_all(value, F.lit(f"(?s){_ITEM}"), 0), text))


def unread_choices(df: DataFrame, name: str = "choices") -> Column:
    """Whether the choices are a text that looks like a list but is not read by :func:`parsed_choices`."""
    if not isinstance(df.schema[name].dataType, T.StringType):
        return F.lit(False)
    return F.coalesce(quoted(name).rlike(r"^\s*\[") & ~_is_plain(quoted(name)), F.lit(False))


def read_literals(df: DataFrame, name: str = "choices") -> DataFrame:
    """Read the choices of all rows; a job of its own for files that may hold unusual literals.

    Only flagged rows go to Python, where they are read as literals, never evaluated.
    """
    if not isinstance(df.schema[name].dataType, T.StringType):
        return df.withColumn(name, parsed_choices(df, name))
    flagged = unread_choices(df, name)
    plain = df.where(~flagged).withColumn(name, parsed_choices(df, name))
    return plain.unionByName(df.where(flagged).withColumn(name, F.pandas_udf(literal_choices, "array<string>")(quoted(name))))


def mcq_prompts(df: DataFrame, choices_col: str = "choices", out: str = "prompt") -> DataFrame:
    """Attach the multiple-choice prompt and the number of choices."""
    with_list = df.withColumn(choices_col, parsed_choices(df, choices_col))
    choices = quoted(choices_col)
    return with_list.withColumns(
        {
            out: prompts.mcq_prompt(with_list, choices),
            "n_choices": F.when(choices.isNotNull(), F.size(choices)),
        }
    )


def conversation_messages(
    df: DataFrame, keys: Sequence[str] = ("conv_id",), turn: str = "turn", role: str = "role", content: str = "text"
) -> DataFrame:
    """Conversation turns as ``messages``: one row per conversation, however many turns it has.

    A conversation is one record of the format, so its turns meet in one row.
    """
    item = F.struct(
        quoted(turn).alias("turn"), quoted(role).alias("role"), F.coalesce(quoted(content), F.lit("")).alias("content")
    )
    ordered = F.array_sort(F.collect_list(item))
    messages = F.transform(ordered, lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content")))
    return df.groupBy(*keys).agg(messages.alias("messages"))
