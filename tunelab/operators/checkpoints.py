"""Checkpoint folders of a grid."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunelab.functions import names

# ---------------------------------------------------------------------------
# Defaults of checkpoint evaluation.
# ---------------------------------------------------------------------------
CHECKPOINT = "checkpoint-467"
DEFAULT_RANK = 64
DEFAULT_BASE_MODEL = ""
# ---------------------------------------------------------------------------


def folders(listing: DataFrame, checkpoint: str = CHECKPOINT, single_model: str | None = None) -> DataFrame:
    """Each model folder with the path of the wanted checkpoint, null without it.

    One pass over the listing answers both questions: which folders have the
    checkpoint, and which are worth a warning.
    """
    if single_model:
        listing = listing.where(F.col("model_folder") == single_model)
    wanted = F.when(names.base_name(F.col("path")) == checkpoint, F.col("path"))
    return listing.groupBy("model_folder").agg(F.min(wanted).alias("checkpoint_path"))


def discover(listing: DataFrame, checkpoint: str = CHECKPOINT, single_model: str | None = None) -> DataFrame:
    """Model folders with the wanted checkpoint, sorted by name."""
    return (
        folders(listing, checkpoint, single_model)
        .where("checkpoint_path is not null")
        .withColumn("checkpoint_name", F.lit(checkpoint))
        .orderBy("model_folder")
    )


def without_checkpoint(listing: DataFrame, checkpoint: str = CHECKPOINT) -> DataFrame:
    """Model folders that lack the wanted checkpoint."""
    return folders(listing, checkpoint).where("checkpoint_path is null").select("model_folder").orderBy("model_folder")


def with_adapter(listing: DataFrame, adapters: DataFrame) -> DataFrame:
    """Checkpoints with their adapter config; one without a config is a full model.

    ``adapters`` holds ``path``, ``base_model_name_or_path`` and ``r``.
    """
    known = adapters.select(
        "path",
        F.lit(True).alias("is_lora"),
        F.coalesce("base_model_name_or_path", F.lit(DEFAULT_BASE_MODEL)).alias("base_model"),
        F.coalesce("r", F.lit(DEFAULT_RANK)).cast("int").alias("lora_rank"),
    )
    return listing.join(known, "path", "left").withColumn("is_lora", F.coalesce("is_lora", F.lit(False)))


def latest(listing: DataFrame) -> DataFrame:
    """The checkpoint with the highest step of each model folder."""
    step = names.checkpoint_step(F.col("path"))
    return listing.groupBy("model_folder").agg(
        F.max_by("path", step).alias("path"), F.max(step).alias("step")
    )


def run_info(listing: DataFrame) -> DataFrame:
    """Short identity of each checkpoint path."""
    return listing.select("path", names.checkpoint_id(F.col("path")).alias("run_info"))
