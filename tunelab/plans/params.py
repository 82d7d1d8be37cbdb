"""Job parameters.  The defaults are fixed values of the jobs they stand for."""

from __future__ import annotations

from dataclasses import dataclass

from tunelab.functions.prompts import CHOICE_PATTERN, check_choice_pattern
from tunelab.operators.checkpoints import CHECKPOINT
from tunelab.operators.generate import BATCHES, OUTPUT_COLUMN


@dataclass(frozen=True)
class PrepareJob:
    dataset: str
    config: str | None = None
    strategy: str = "default"
    train_split: str = "train"
    debug: bool = False
    debug_rows: int = 100
    key: str = "row_id"


@dataclass(frozen=True)
class GenerateJob:
    dataset: str
    output: str
    config: str | None = None
    split: str | None = "test"
    strategy: str = "default"
    input_col: str = "text"
    output_col: str = OUTPUT_COLUMN
    start: int = 0
    end: int | None = None
    key: str = "row_id"
    max_new_tokens: int = 200
    temperature: float = 0.0
    batches: int = BATCHES


@dataclass(frozen=True)
class ScoreJob:
    dataset: str
    from_disk: bool = False
    multi_folder: bool = False
    split: str = "test"
    label_col: str = "label"
    gen_col: str = OUTPUT_COLUMN


@dataclass(frozen=True)
class BenchmarkJob:
    dataset: str
    grid_dir: str
    output: str
    subsets: tuple[str, ...] = ("mcq_4_choices",)
    split: str = "test"
    pattern: str = CHOICE_PATTERN
    checkpoint: str = CHECKPOINT
    single_model: str | None = None
    key: str = "row_id"
    max_new_tokens: int = 2048
    temperature: float = 0.0
    max_lora_rank: int = 512
    batches: int = BATCHES

    def __post_init__(self) -> None:
        check_choice_pattern(self.pattern)
