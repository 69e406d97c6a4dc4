"""Population stability of scores against a reference."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrears.constants import PSI_BINS, PSI_SHARE_FLOOR
from arrears.operators.ordered import ROWS_PER_RANGE, exact_quantiles


def quantile_cuts(
    reference: DataFrame, score: str, bins: int = PSI_BINS, rows_per_range: int = ROWS_PER_RANGE
) -> DataFrame:
    """One row, ``cuts``: distinct exact quantiles, or equal steps on [0, 1] when fewer than three differ."""
    probabilities = [i / bins for i in range(bins + 1)]
    quantiles = exact_quantiles(reference, [], score, probabilities, rows_per_range)
    # Multiples of the step, whose rounding decides where a score on an edge goes.
    equal = ", ".join(f"{i * (1 / bins)!r}D" for i in range(bins)) + ", 1D"
    distinct = "array_sort(array_distinct(filter(quantiles, x -> x IS NOT NULL)))"
    return quantiles.selectExpr(f"CASE WHEN size({distinct}) < 3 THEN array({equal}) ELSE {distinct} END AS cuts")


def bin_index(value: str, cuts: Sequence[float]) -> str:
    """SQL for the 1-based bin of ``value``; null outside the cuts. The last bin includes its upper edge."""
    inner = " ".join(f"WHEN {value} < {edge!r}D THEN {i}" for i, edge in enumerate(cuts[1:-1], start=1))
    return (
        f"CASE WHEN {value} IS NULL OR {value} < {cuts[0]!r}D OR {value} > {cuts[-1]!r}D THEN NULL "
        f"{inner} ELSE {len(cuts) - 1} END"
    )


def histogram(df: DataFrame, cuts: Sequence[float], score: str, groups: Sequence[str] = ()) -> DataFrame:
    """Rows per group and bin; ``bin`` is null for values out of range."""
    binned = df.withColumn("bin", F.expr(bin_index(f"`{score}`", cuts)))
    return binned.groupBy(*groups, "bin").agg(F.count(F.lit(1)).alias("n"))


@dataclass(frozen=True)
class ScoreReference:
    """Bin edges and row shares of the reference scores: a few numbers, fitted once."""

    cuts: list[float]
    shares: list[float]


def fit_reference(
    reference: DataFrame, score: str = "score", bins: int = PSI_BINS, rows_per_range: int = ROWS_PER_RANGE
) -> ScoreReference:
    """Fit the edges and shares. At most ``bins`` + 1 numbers come to the driver."""
    cuts = quantile_cuts(reference, score, bins, rows_per_range).first()
    if cuts is None:
        raise ValueError("there are no reference scores")
    cuts = list(cuts["cuts"])
    counts = {r["bin"]: r["n"] for r in histogram(reference, cuts, score).collect()}
    inside = [counts.get(b, 0) for b in range(1, len(cuts))]
    return ScoreReference(cuts, [n / max(sum(inside), 1) for n in inside])


def population_stability(
    actual: DataFrame, reference: ScoreReference, score: str = "prediction_score", groups: Sequence[str] = (), weight: str = "1"
) -> DataFrame:
    """``score_psi`` and ``n_out_of_range`` per group of ``actual``, in one grouped aggregation.

    Shares are of the rows within the range of the reference and are floored,
    so an empty bin on one side stays finite. A row counts ``weight`` times.
    """
    bins = range(1, len(reference.cuts))
    binned = actual.filter(F.col(score).isNotNull()).withColumn(
        "_bin", F.expr(bin_index(f"`{score}`", reference.cuts))
    )
    counted = binned.groupBy(*groups).agg(
        F.expr(f"sum(CASE WHEN _bin IS NOT NULL THEN {weight} ELSE 0 END) AS _inside"),
        F.expr(f"cast(sum(CASE WHEN _bin IS NULL THEN {weight} ELSE 0 END) AS bigint) AS n_out_of_range"),
        *[F.expr(f"sum(CASE WHEN _bin = {b} THEN {weight} ELSE 0 END) AS _n{b}") for b in bins],
    )
    terms = []
    for b, expected in zip(bins, reference.shares):
        want = f"{max(expected, PSI_SHARE_FLOOR)!r}D"
        got = f"greatest(_n{b} / greatest(_inside, 1), {PSI_SHARE_FLOOR!r}D)"
        terms.append(f"({got} - {want}) * ln({got} / {want})")
    return counted.selectExpr(*groups, f"{' + '.join(terms)} AS score_psi", "n_out_of_range")
