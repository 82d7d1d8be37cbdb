"""Training histories: all runs in one table, one row per run and step."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tunelab.schemas import LOSS_COLUMNS, STEP_COLUMN, quoted

DIGITS = 8
TAIL_POINTS = 100
TAIL_BUCKETS = 64


def _last(column: Column, step: Column) -> Column:
    """Last non-missing value, combined on the map side.

    A point without step comes before all others; of points with the same step,
    as a resumed run logs them, the larger value counts.
    """
    return F.max_by(column, F.when(column.isNotNull(), F.struct(step, column)))


def final_loss(
    history: DataFrame, run: str = "name", step: str = STEP_COLUMN, columns: Sequence[str] = LOSS_COLUMNS
) -> DataFrame:
    """Last loss per run, from the first loss column that has any value in that run."""
    present = [quoted(c) for c in columns if c in history.columns]
    last = [_last(c, quoted(step)) for c in present]
    loss = F.coalesce(*last) if last else F.lit(None).cast("double")
    return history.groupBy(run).agg(loss.alias("final_loss"))


def curve_stats(
    history: DataFrame,
    run: str = "name",
    step: str = STEP_COLUMN,
    columns: Sequence[str] = LOSS_COLUMNS,
    extra: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Final, least and mean loss and the number of steps per run.

    Only the first existing loss column counts, also when it is empty; a run
    without a value in it gives no row.  ``extra`` adds aggregates by name.
    """
    present = [c for c in columns if c in history.columns]
    if not present:
        raise ValueError(f"no loss column among {history.columns}")
    loss = quoted(present[0])
    return (
        history.where(loss.isNotNull())
        .groupBy(run)
        .agg(
            _last(loss, quoted(step)).alias("final_loss"),
            F.min(loss).alias("min_loss"),
            F.round(F.avg(loss), DIGITS).alias("mean_loss"),
            F.count(loss).alias("num_steps"),
            *[value.alias(name) for name, value in (extra or {}).items()],
        )
    )


def last_points(
    history: DataFrame, run: str = "name", step: str = STEP_COLUMN, n: int = TAIL_POINTS
) -> DataFrame:
    """The last ``n`` points of each run, all if it has fewer.

    Points without step come first, equal steps are ordered by the other
    columns.  The step of the n-th last point of each run comes from run and step alone; only the
    points from that step on are then ordered whole, at most ``n`` and those of equal step.  Points are cut within hash
    buckets of a run, then in the run, so a run with a third of all points is no hot spot, whatever ``n``.
    """
    steps = history.select(quoted(run).alias("_run"), quoted(step).alias("_step_at"))
    nth = _newest(steps, "_run", [F.col("_step_at").desc_nulls_last()], F.xxhash64("_step_at"), n, last_only=True)
    late = history.join(nth, quoted(run).eqNullSafe(F.col("_run")), "left").where(F.col("_step_at").isNull() | (quoted(step) >= F.col("_step_at")))
    others = [quoted(c).desc_nulls_last() for c in history.columns if c not in (run, step)]
    mixed = F.xxhash64(*[quoted(c) for c in history.columns if c != run])
    return _newest(late.select(*map(quoted, history.columns)), run, [quoted(step).desc_nulls_last(), *others], mixed, n)


def _newest(points: DataFrame, run: str, order: Sequence[Column], mixed: Column, n: int, last_only: bool = False) -> DataFrame:
    """The first ``n`` points of each run in the order, or only the n-th; cut in hash buckets of the run first."""
    kept = points
    for keys in ([quoted(run), F.pmod(mixed, F.lit(TAIL_BUCKETS))], [quoted(run)]):
        place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        kept = kept.withColumn("_place", place).where(F.col("_place") <= n)
    return (kept.where(F.col("_place") == n) if last_only else kept).drop("_place")
