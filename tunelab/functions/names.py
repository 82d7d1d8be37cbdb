"""Names and paths of runs, jobs and checkpoints as native columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Name formats.
# A run name is lr{rate}_r{rank}_{lora|full}_{size}B, anchored at its start
# only, so a suffix such as "_retry" is allowed.
# ---------------------------------------------------------------------------
RUN_NAME = "^lr([0-9.e-]+)_r([0-9]+)_(lora|full)_([0-9]+)B"
JOB_PREFIX = "sft-"
MODEL_FILE = "\\.(json|safetensors)$"
TIMESTAMP_SUFFIX = "yyyy-MM-dd_HH-mm-ss"
# ---------------------------------------------------------------------------


def run_name_fields(name: Column) -> dict[str, Column]:
    """Columns parsed from a run name; all null (and not a grid run) without a match.

    No group of the pattern can match an empty text, so empty means no match.
    """

    def part(group: int) -> Column:
        return F.nullif(F.regexp_extract(name, RUN_NAME, group), F.lit(""))

    return {
        "is_grid_run": F.coalesce(name.rlike(RUN_NAME), F.lit(False)),
        "learning_rate": part(1).try_cast("double"),
        "lora_rank": F.when(part(3) == "lora", part(2)).try_cast("int"),
        "method": part(3),
        "model_size": F.concat(part(4), F.lit("B")),
    }


def rate_text(rate: Column) -> Column:
    """0.0001 as ``1e-4``."""
    return F.regexp_replace(F.format_string("%.0e", rate), "e-0", "e-")


def metric_title(name: Column) -> Column:
    """``final_loss`` as ``Final Loss``."""
    return F.initcap(F.replace(name, F.lit("_"), F.lit(" ")))


def run_id(rate_str: Column, rank: Column, method: Column, model_size: Column) -> Column:
    """Name of a planned run; the rate is kept in its written form."""
    return F.concat(F.lit("lr"), rate_str, F.lit("_r"), rank.cast("string"), F.lit("_"), method, F.lit("_"), model_size)


def job_name(run: Column) -> Column:
    return F.concat(F.lit(JOB_PREFIX), run)


def output_dir(base: str, run: Column) -> Column:
    return F.concat(F.lit(base.rstrip("/") + "/"), run)


def base_name(path: Column) -> Column:
    """Last part of a path."""
    return F.substring_index(path, "/", -1)


def parent_name(path: Column) -> Column:
    """Last but one part of a path; empty without one."""
    return F.coalesce(F.try_element_at(F.split(path, "/"), F.lit(-2)), F.lit(""))


def checkpoint_id(path: Column) -> Column:
    """``{parent}/{name}`` for a checkpoint folder, else the folder's own name."""
    name = base_name(path)
    return F.when(name.contains("checkpoint"), F.concat(parent_name(path), F.lit("/"), name)).otherwise(name)


def checkpoint_step(path: Column) -> Column:
    """The number at the end of a checkpoint folder's name."""
    return F.regexp_extract(path, "checkpoint-([0-9]+)/?$", 1).try_cast("long")


def is_model_file(path: Column) -> Column:
    return path.rlike(MODEL_FILE)


def timestamped(base: Column, at: Column) -> Column:
    """``{base}_{YYYY-MM-DD_HH-MM-SS}``."""
    return F.concat(base, F.lit("_"), F.date_format(at, TIMESTAMP_SUFFIX))


def public_config(config: Column) -> Column:
    """A config map without the keys that start with an underscore."""
    return F.map_filter(config, lambda k, v: ~k.startswith("_"))


def metric_rate(metric: Column) -> Column:
    """Learning rate in ``lr{rate}_r{rank}_.../subset/metric``."""
    folder = F.split(F.split(metric, "/")[0], "_")
    return F.replace(F.get(folder, F.lit(0)), F.lit("lr"), F.lit("")).try_cast("double")


def metric_rank(metric: Column) -> Column:
    """Rank in ``lr{rate}_r{rank}_.../subset/metric``."""
    folder = F.split(F.split(metric, "/")[0], "_")
    return F.replace(F.get(folder, F.lit(1)), F.lit("r"), F.lit("")).try_cast("int")
