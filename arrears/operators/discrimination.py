"""How well scores rank defaults: AUC, Gini, average precision, accuracy."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arrears.functions.measures import gini, to_class
from arrears.operators.ordered import ROWS_PER_RANGE, running_totals, totals_of_counts, value_counts
from arrears.session import materialise


def ranking_metrics(
    df: DataFrame,
    groups: Sequence[str] = (),
    score: str = "prediction_score",
    label: str = "label",
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Per group ``n_rows``, ``n_positive``, ``auc``, ``gini`` and ``average_precision``.

    AUC is the rank sum with mid-ranks for equal scores, null when a class is
    missing. Average precision gives all rows of one score the precision
    reached at that score, so it does not depend on the order of equal scores;
    it is zero without positives.
    """
    return metrics_of_totals(running_totals(_labelled(df, label), groups, score, _sums(label), rows_per_range), groups)


def _labelled(df: DataFrame, label: str) -> DataFrame:
    return df.filter(F.col(label).isNotNull())


def _sums(label: str) -> dict[str, Column]:
    return {"n": F.lit(1), "pos": F.col(label).cast("bigint")}


def metrics_of_totals(ranked: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """``ranking_metrics`` from running totals of ``n`` rows and ``pos`` positive ones."""
    mid_rank = F.col("n_below") + (F.col("n") + 1) / F.lit(2.0)
    taken = F.col("n_total") - F.col("n_below")
    hits = F.col("pos_total") - F.col("pos_below")
    sums_per_group = ranked.groupBy(*groups).agg(
        F.max("n_total").alias("n_rows"),
        F.max("pos_total").alias("n_positive"),
        F.sum(F.col("pos") * mid_rank).alias("_rank_sum"),
        F.sum(F.col("pos") * hits / taken).alias("_precision_sum"),
    )
    pos = F.col("n_positive").cast("double")
    neg = (F.col("n_rows") - F.col("n_positive")).cast("double")
    auc = F.try_divide(F.col("_rank_sum") - pos * (pos + 1) / 2, pos * neg)
    return sums_per_group.withColumn("auc", auc).select(
        *groups,
        "n_rows",
        "n_positive",
        "auc",
        F.expr(gini("auc")).alias("gini"),
        F.coalesce(F.try_divide(F.col("_precision_sum"), pos), F.lit(0.0)).alias("average_precision"),
    )


def auc(df: DataFrame, groups: Sequence[str] = (), score: str = "prediction_score", label: str = "label", **kw) -> DataFrame:
    return ranking_metrics(df, groups, score, label, **kw).select(*groups, "n_rows", "n_positive", "auc")


def accuracy(df: DataFrame, groups: Sequence[str] = (), prediction: str = "prediction", label: str = "label") -> DataFrame:
    """Share of rows whose class is the label."""
    return df.groupBy(*groups).agg(
        F.avg((F.col(prediction).cast("int") == F.col(label).cast("int")).cast("double")).alias("accuracy")
    )


def classification_metrics(
    df: DataFrame, groups: Sequence[str] = (), score: str = "prediction_score", label: str = "label"
) -> DataFrame:
    """AUC, Gini, average precision and accuracy at one half; ``df`` is read once, as hits are added up with the scores."""
    hit = (F.expr(to_class(score)).cast("int") == F.col(label).cast("int")).cast("bigint")
    present = _labelled(df, label).dropna(subset=[*groups, score])
    counts = materialise(value_counts(present, groups, score, _sums(label) | {"hits": hit}), "value_counts")
    ranked = metrics_of_totals(totals_of_counts(counts, groups, score, ["n", "pos"]), groups)
    right = counts.groupBy(*groups).agg((F.sum("hits") / F.sum("n")).alias("accuracy"))
    if not groups:
        return ranked.withColumn("accuracy", right.scalar())
    return ranked.join(right, list(groups))
