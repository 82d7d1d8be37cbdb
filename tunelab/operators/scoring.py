"""Scoring of predictions.

Everything here starts from one count per (keys, gold, prediction).  That
aggregation is combined on the map side, so a model or subset that holds a
third of all rows costs no more than any other, and all later steps work on
the label table, which no longer grows with the rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tunelab.functions import prompts
from tunelab.schemas import quoted

DIGITS = 10


def is_right(gold: Column, pred: Column) -> Column:
    return F.coalesce(gold == pred, F.lit(False))


def label_answers(df: DataFrame, gen_col: str = "generated_answer", out: str = "pred") -> DataFrame:
    """Parse the generated answer into a class number."""
    return df.withColumn(out, prompts.answer_label_of(df, gen_col))


def accuracy(
    df: DataFrame, gold: str = "label", pred: str = "pred", keys: Sequence[str] = (), rows: str | None = None
) -> DataFrame:
    """Share of right predictions; an unparsed answer is a wrong one.

    With ``rows`` each input row stands for that many (a table of counts).
    """
    n = quoted(rows) if rows else F.lit(1).cast("long")
    right = F.sum(F.when(is_right(quoted(gold), quoted(pred)), n).otherwise(F.lit(0).cast("long")))
    return df.groupBy(*keys).agg((right.cast("double") / F.sum(n)).alias("accuracy"))


def parse_errors(
    df: DataFrame, pred: str = "pred", keys: Sequence[str] = (), rows: str | None = None
) -> DataFrame:
    """Rows, unparsed answers and their share in percent (null without rows)."""
    none = F.lit(0).cast("long")
    n = quoted(rows) if rows else F.lit(1).cast("long")
    errors = F.coalesce(F.sum(F.when(quoted(pred) == prompts.UNPARSED_LABEL, n).otherwise(none)), none)
    total = F.coalesce(F.sum(n), none)
    percent = F.round(F.try_divide(errors.cast("double"), total) * 100, 2)
    return df.groupBy(*keys).agg(
        total.alias("total_rows"), errors.alias("parse_errors"), percent.alias("parse_error_percent")
    )


def label_counts(df: DataFrame, gold: str, pred: str, keys: Sequence[str] = ()) -> DataFrame:
    """Rows per (keys, gold, pred): the only step that reads all predictions."""
    by = [*keys, quoted(gold).alias("gold"), quoted(pred).alias("pred")]
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))


def _per_class(counts: DataFrame, keys: Sequence[str], classes: Sequence | None) -> DataFrame:
    """hits, support and predictions per class, and rows outside the fixed classes."""
    none = F.lit(0).cast("long")
    if classes is None:
        by_gold = F.struct(
            F.col("gold").alias("label"),
            F.when(is_right(F.col("gold"), F.col("pred")), F.col("n")).otherwise(none).alias("_hits"),
            F.col("n").alias("support"),
            none.alias("_predicted"),
            none.alias("_outside"),
        )
        by_pred = F.struct(
            F.col("pred").alias("label"),
            none.alias("_hits"),
            none.alias("support"),
            F.col("n").alias("_predicted"),
            none.alias("_outside"),
        )
        parts = [by_gold, by_pred]
    else:
        fixed = [F.lit(c) for c in classes]
        inside = F.coalesce(F.col("gold").isin(*fixed) & F.col("pred").isin(*fixed), F.lit(False))
        parts = []
        for value in fixed:
            is_gold = F.coalesce(F.col("gold") == value, F.lit(False))
            is_pred = F.coalesce(F.col("pred") == value, F.lit(False))
            parts.append(
                F.struct(
                    value.alias("label"),
                    F.when(is_gold & is_pred, F.col("n")).otherwise(none).alias("_hits"),
                    F.when(is_gold, F.col("n")).otherwise(none).alias("support"),
                    F.when(is_pred, F.col("n")).otherwise(none).alias("_predicted"),
                    F.when(inside, none).otherwise(F.col("n")).alias("_outside"),
                )
            )
    sums = ["_hits", "support", "_predicted", "_outside"]
    cells = counts.select(*keys, F.inline(F.array(*parts)))
    return cells.groupBy(*keys, "label").agg(*[F.sum(c).alias(c) for c in sums])


def _ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b), F.lit(0.0))


def class_report(
    counts: DataFrame,
    keys: Sequence[str] = (),
    classes: Sequence | None = None,
    names: Mapping | None = None,
    with_overall: bool = True,
) -> DataFrame:
    """Precision, recall, F1 and support per class, then the summary rows.

    ``classes`` fixes the reported classes; without it they are all labels seen
    as gold or prediction.  The overall row is ``accuracy`` unless a label lies
    outside the fixed classes; then it is the ``micro avg`` over them.  Empty
    denominators count as 0.  Rows without a gold label (an index out of range)
    belong to no class and are left out.

    The class rows and the averages come from one aggregation over two grouping
    sets, so the label table is read once.
    """
    rated = _per_class(counts.where("gold is not null"), keys, classes).select(
        *keys,
        "label",
        "_hits",
        "support",
        "_predicted",
        "_outside",
        _ratio(F.col("_hits"), F.col("_predicted")).alias("_p"),
        _ratio(F.col("_hits"), F.col("support")).alias("_r"),
        _ratio(2 * F.col("_hits"), F.col("support") + F.col("_predicted")).alias("_f"),
    )
    key_cols = [quoted(k) for k in keys]
    total = F.sum("support")
    grouped = rated.groupingSets([[*key_cols, F.col("label")], key_cols], *key_cols, F.col("label")).agg(
        F.grouping("label").alias("_summary"),
        F.sum("_hits").alias("_hits"),
        F.sum("_predicted").alias("_predicted"),
        total.alias("support"),
        F.max("_outside").alias("_outside"),
        *[F.avg(m).alias(f"{m}_avg") for m in ("_p", "_r", "_f")],
        *[_ratio(F.sum(F.col(m) * F.col("support")), total).alias(f"{m}_wavg") for m in ("_p", "_r", "_f")],
    )

    def row(name: Column, p: Column, r: Column, f: Column) -> Column:
        return F.struct(
            name.alias("class"),
            F.round(p, DIGITS).alias("precision"),
            F.round(r, DIGITS).alias("recall"),
            F.round(f, DIGITS).alias("f1"),
            F.col("support").alias("support"),
        )

    label = F.col("label").cast("string")
    for value, shown in (names or {}).items():
        label = F.when(F.col("label") == F.lit(value), shown).otherwise(label)
    micro_p = _ratio(F.col("_hits"), F.col("_predicted"))
    micro_r = _ratio(F.col("_hits"), F.col("support"))
    micro_f = _ratio(2 * F.col("_hits"), F.col("support") + F.col("_predicted"))
    unnamed = F.lit(None).cast("double")
    mixed = F.col("_outside") > 0
    overall = row(
        F.when(mixed, "micro avg").otherwise("accuracy"),
        F.when(mixed, micro_p).otherwise(unnamed),
        F.when(mixed, micro_r).otherwise(unnamed),
        F.when(mixed, micro_f).otherwise(micro_r),
    )
    summary = [
        row(F.lit("macro avg"), F.col("_p_avg"), F.col("_r_avg"), F.col("_f_avg")),
        row(F.lit("weighted avg"), F.col("_p_wavg"), F.col("_r_wavg"), F.col("_f_wavg")),
    ]
    if with_overall:
        summary.insert(0, overall)
    one = F.array(row(label, F.col("_p_avg"), F.col("_r_avg"), F.col("_f_avg")))
    rows = F.when(F.col("_summary") == 1, F.array(*summary)).otherwise(one)
    return grouped.select(*keys, F.inline(rows))


def label_union(counts: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Distinct labels seen as gold or as prediction, with their ``place`` in order."""
    labels = counts.select(*keys, F.explode(F.array("gold", "pred")).alias("label")).where("label is not null")
    place = F.row_number().over(Window.partitionBy(*keys).orderBy("label"))
    return labels.distinct().withColumn("place", place)


def pred_distribution(counts: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Rows per predicted label."""
    return counts.groupBy(*keys, "pred").agg(F.sum("n").alias("n"))


def confusion(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows per (gold, prediction), the cells that occur; an absent cell is zero.

    The axes of the matrix are the labels of :func:`label_union`.
    """
    return counts.select(*keys, "gold", "pred", "n")


def choice_predictions(
    df: DataFrame,
    text_col: str = "generated_text",
    pattern: str = prompts.CHOICE_PATTERN,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Prediction rows of a multiple-choice run.

    ``df`` holds ``prompt``, ``gold``, ``n_choices`` and the generated text in
    one row, so nothing is zipped by position.
    """
    gold = prompts.gold_label(F.col("gold"), F.col("n_choices"))
    pred = prompts.parse_choice(quoted(text_col), pattern)
    return df.select(
        *keep,
        "prompt",
        gold.alias("gold"),
        pred.alias("prediction"),
        quoted(text_col).alias("generated_text"),
        is_right(gold, pred).alias("correct"),
    )


def grid_results(
    predictions: DataFrame,
    checkpoint: str,
    keys: Sequence[str] = ("model_folder", "subset"),
    seconds: Column | None = None,
) -> DataFrame:
    """accuracy, right, total and generation seconds per (model, subset)."""
    right = F.count_if("correct")
    total = F.count(F.lit(1))
    time = F.lit(0.0) if seconds is None else F.round(F.sum(seconds), 6)
    return predictions.groupBy(*keys).agg(
        F.coalesce(F.try_divide(right.cast("double"), total), F.lit(0.0)).alias("accuracy"),
        right.alias("correct"),
        total.alias("total"),
        time.alias("generation_time"),
    ).select(
        "model_folder",
        F.lit(checkpoint).alias("checkpoint"),
        "subset",
        "accuracy",
        "correct",
        "total",
        "generation_time",
    )


def leaderboard(results: DataFrame) -> DataFrame:
    """Models of each subset by falling accuracy; one row per (model, subset) comes in."""
    order = Window.partitionBy("subset").orderBy(F.col("accuracy").desc(), "model_folder")
    return results.select(
        "subset", F.row_number().over(order).alias("place"), "model_folder", "accuracy"
    )
