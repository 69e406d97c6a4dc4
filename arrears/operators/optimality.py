"""Whether a logistic model is where its loss is least: first-order conditions on scored rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def descent_left(
    df: DataFrame,
    weights: Sequence[float],
    penalty: float,
    inputs: str = "inputs",
    score: str = "prediction_score",
    label: str = "label",
    standardised: bool = False,
) -> DataFrame:
    """One row, ``left``: length of the gradient at the model over that at the best constant score; zero at the optimum, one for a constant.

    ``inputs`` is an array of the model's inputs, beside which the free intercept
    counts as a further one. The loss is the mean logistic loss plus half the
    penalty times the squared weights, taken in units of the inputs' deviations
    if ``standardised``. Coordinates are compared in these units. One row for each
    input comes out of the grouped aggregation.
    """
    wanted = F.array(*[F.lit(float(w)) for w in [*weights, 0.0]])
    cells = df.select(F.col(label).cast("double").alias("y"), F.col(score).alias("p"), F.posexplode(F.concat(F.col(inputs), F.array(F.lit(1.0)))).alias("i", "x"))
    sums = cells.groupBy("i").agg(
        F.avg((F.col("p") - F.col("y")) * F.col("x")).alias("slope"),
        (F.avg("y") * F.avg("x") - F.avg(F.col("y") * F.col("x"))).alias("start"),
        F.stddev_samp("x").alias("spread"),
    )
    unit = F.when(F.col("spread") > 0, F.col("spread")).otherwise(F.lit(1.0))
    weight = F.get(wanted, F.col("i"))
    pull = F.lit(float(penalty)) * weight * (unit * unit if standardised else F.lit(1.0))
    lengths = sums.agg(F.sum(((F.col("slope") + pull) / unit) ** 2).alias("now"), F.sum((F.col("start") / unit) ** 2).alias("first"))
    return lengths.select(F.sqrt(F.try_divide("now", "first")).alias("left"))
