"""Exact order statistics of groups too big for one task.

Equal values are summed up first, so a value held by a third of all rows is one
row; these sums are stored, so the input is read once. Every value has an
integer form of the same order, and its leading bits name the range of values it
lies in. A range with too many different values is divided by its next bits,
until none is left. Ranges are ordered on their own and the totals of the ranges
below are added. No task ever sees a whole big group, nothing is sampled or sent
along with the rows, and results do not depend on where ranges end.

Medians of many columns and the cut of a split need no order of rows at all:
they are found by counting, in passes over the columns side by side.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import ROUND_HALF_UP, Decimal
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arrears.session import materialise

#: Different values that one range should hold.
ROWS_PER_RANGE = 1_000_000
#: Bits below the leading ones: ranges start with sign, exponent and eight bits of the fraction.
FIRST_SHIFT = 44
#: Bits by which a heavy range is divided at a time.
STEP = 12
#: Values that may come to the driver to pick one by its rank.
LISTED = 5_000
#: Accuracy of the sketches that bracket a rank.
ACCURACY = 2_000


def order_bits(value: str) -> str:
    """SQL for the integer whose order is that of the numbers ``value``: sign and magnitude of the 64-bit float.

    The exponent comes from the logarithm, corrected by comparison with the
    powers of two beside it, so the form is exact. Not-a-number is the largest.
    """
    x = f"cast({value} AS double)"
    size = f"abs({x})"
    guess = f"floor(log2({size}))"
    exponent = f"({guess} + CASE WHEN {size} >= pow(2D, {guess} + 1) THEN 1 WHEN {size} < pow(2D, {guess}) THEN -1 ELSE 0 END)"
    normal = f"(cast({exponent} AS bigint) + 1023) * {2**52} + cast(({size} / pow(2D, {exponent}) - 1) * {2**52}D AS bigint)"
    magnitude = (
        f"CASE WHEN isnan({x}) THEN {0x7FF8 << 48} WHEN {size} = double('Infinity') THEN {0x7FF0 << 48} "
        f"WHEN {size} < pow(2D, -1022) THEN cast({size} / pow(2D, -1074) AS bigint) ELSE {normal} END"
    )
    return f"(CASE WHEN {x} < 0 THEN -1 ELSE 1 END * ({magnitude}))"


def value_counts(
    df: DataFrame, groups: Sequence[str], value: str, sums: Mapping[str, Column]
) -> DataFrame:
    """One row per group and distinct value with the sums of its rows."""
    return df.groupBy(*groups, value).agg(*[F.sum(expr).alias(name) for name, expr in sums.items()])


def _range_at(shift: int) -> Column:
    """Smallest integer form with the same leading bits."""
    return F.shiftleft(F.shiftright("_bits", shift), shift)


def with_ranges(counts: DataFrame, groups: Sequence[str], rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Rows with ``_bits`` also get ``_range``, the least integer form of the range they lie in.

    Ranges of one group do not overlap, so they are in the order of their
    ``_range``, however far each was divided. Heavy ranges are few: rows over
    ``rows_per_range`` at most.
    """
    frame, shift = counts.withColumn("_range", _range_at(FIRST_SHIFT)), FIRST_SHIFT
    while shift > 0:
        heavy = frame.groupBy(*groups, "_range").agg(F.count(F.lit(1)).alias("_values")).where(F.col("_values") > rows_per_range)
        heavy = heavy.select(*groups, "_range", F.lit(True).alias("_heavy"))
        if heavy.limit(1).count() == 0:
            break
        shift = max(shift - STEP, 0)
        marked = frame.join(materialise(heavy, "heavy"), [*groups, "_range"], "left")
        frame = marked.withColumn("_range", F.when(F.col("_heavy"), _range_at(shift)).otherwise(F.col("_range"))).drop("_heavy")
    return frame


def running_totals(
    df: DataFrame,
    groups: Sequence[str],
    value: str,
    sums: Mapping[str, Column],
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Distinct values with, per sum, the total of all smaller values.

    Columns: groups, value, ``<sum>``, ``<sum>_below`` and ``<sum>_total`` (of
    the group). Rows with a null value or a null group are left out.
    """
    present = df.dropna(subset=[*groups, value])
    stored = materialise(value_counts(present, groups, value, sums), "value_counts")
    return totals_of_counts(stored, groups, value, list(sums), rows_per_range)


def totals_of_counts(
    stored: DataFrame, groups: Sequence[str], value: str, sums: Sequence[str], rows_per_range: int = ROWS_PER_RANGE
) -> DataFrame:
    """``running_totals`` of a stored table that has one row for each group and value already."""
    groups = list(groups)
    bits = stored.withColumn("_bits", F.expr(order_bits(f"`{value}`")))
    counts = with_ranges(bits, groups, rows_per_range)
    in_group = Window.partitionBy(*groups) if groups else Window.partitionBy()
    # One row per group and range.
    per_range = counts.groupBy(*groups, "_range").agg(*[F.sum(s).alias(s) for s in sums])
    before = in_group.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_range.select(
        *groups,
        "_range",
        *[F.coalesce(F.sum(s).over(before), F.lit(0)).alias(f"_{s}_offset") for s in sums],
        *[F.sum(s).over(in_group).alias(f"{s}_total") for s in sums],
    )

    in_range = Window.partitionBy(*groups, "_range").orderBy(value)
    smaller = in_range.rowsBetween(Window.unboundedPreceding, -1)
    ordered = counts.withColumns(
        {f"_{s}_here": F.coalesce(F.sum(s).over(smaller), F.lit(0)) for s in sums}
    )
    return ordered.join(offsets, [*groups, "_range"]).select(
        *groups,
        value,
        *sums,
        *[(F.col(f"_{s}_offset") + F.col(f"_{s}_here")).alias(f"{s}_below") for s in sums],
        *[f"{s}_total" for s in sums],
    )


def exact_quantiles(
    df: DataFrame,
    groups: Sequence[str],
    value: str,
    probabilities: Sequence[float],
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Groups plus ``quantiles``, linearly interpolated between neighbouring order statistics."""
    totals = running_totals(df, groups, value, {"n": F.lit(1)}, rows_per_range)

    def at_rank(rank: str) -> str:
        return f"max(CASE WHEN n_below <= {rank} AND {rank} < n_below + n THEN `{value}` END)"

    parts, found_at = [], []
    for i, p in enumerate(probabilities):
        position = f"({float(p)!r}D * (n_total - 1))"
        parts += [
            F.expr(f"{at_rank(f'floor({position})')} AS _lo{i}"),
            F.expr(f"{at_rank(f'ceil({position})')} AS _hi{i}"),
            F.expr(f"max({position} - floor({position})) AS _t{i}"),
        ]
        found_at.append(f"_lo{i} + (_hi{i} - _lo{i}) * _t{i}")
    found = totals.groupBy(*groups).agg(*parts)
    return found.selectExpr(*groups, f"array({', '.join(found_at)}) AS quantiles")


class _Bracket:
    """Ranks of one column that are looked for between two of its values, both exclusive; None is open.

    ``below`` rows of the column lie at or under ``low``, ``inside`` strictly between.
    """

    def __init__(self, column: str, ranks: list[int], low=None, high=None, below: int = 0, inside: int = 0):
        self.column, self.ranks, self.low, self.high, self.below, self.inside = column, ranks, low, high, below, inside

    def values(self) -> Column:
        x = F.col(f"`{self.column}`").cast("double")
        within = [c for c in (None if self.low is None else x > self.low, None if self.high is None else x < self.high) if c is not None]
        for c in within:
            x = F.when(c, x)
        return x

    def sketch(self, accuracy: int) -> Column:
        """Two values around the ranks: four errors of the sketch apart, ends included."""
        spread = 2 / accuracy
        first, last = ((r - self.below) / max(self.inside - 1, 1) for r in (min(self.ranks), max(self.ranks)))
        return F.percentile_approx(self.values(), [max(first - spread, 0.0), min(last + spread, 1.0)], accuracy)

    def counts(self, low, high) -> Column:
        x = self.values()
        return F.struct(F.count_if(x < low), F.count_if(x == low), F.count_if((x > low) & (x < high)), F.count_if(x == high))

    def parted(self, low, high, counted, found: dict) -> list[_Bracket]:
        """Ranks that fall on ``low`` or ``high`` go to ``found``; narrower brackets for the others."""
        under, at_low, between, at_high = counted
        at_high = 0 if low == high else at_high
        edges = [self.below + n for n in (under, under + at_low, under + at_low + between, under + at_low + between + at_high)]
        over = self.below + self.inside - edges[3]
        parts = [
            _Bracket(self.column, [r for r in self.ranks if r < edges[0]], self.low, low, self.below, under),
            _Bracket(self.column, [r for r in self.ranks if edges[1] <= r < edges[2]], low, high, edges[1], between),
            _Bracket(self.column, [r for r in self.ranks if r >= edges[3]], high, self.high, edges[3], over),
        ]
        for r in self.ranks:
            if edges[0] <= r < edges[1]:
                found[self.column, r] = low
            elif edges[2] <= r < edges[3]:
                found[self.column, r] = high
        return [p for p in parts if p.ranks]


def exact_medians(df: DataFrame, columns: Sequence[str], accuracy: int = ACCURACY, listed: int = LISTED) -> dict[str, float | None]:
    """Median of every column, None without values; ``df`` is read several times, all columns side by side.

    A pass of counts and sketches brackets the middle ranks, a pass of counts says
    how many values lie below and inside, and the few inside are listed; where
    too many are left, the bracket is narrowed in the same way. Nothing is shuffled but
    sketches and counts, and sketches only steer: every result is exact.
    """
    values = [F.col(f"`{c}`").cast("double") for c in columns]
    middle = [max(0.5 - 2 / accuracy, 0.0), min(0.5 + 2 / accuracy, 1.0)]
    sizes, ends = df.agg(F.struct(*map(F.count, values)).alias("n"), F.struct(*[F.percentile_approx(x, middle, accuracy) for x in values]).alias("v")).first()
    first_ends = dict(zip(columns, ends))
    wanted = {c: sorted({(n - 1) // 2, n // 2}) for c, n in zip(columns, sizes) if n}
    open_brackets = [_Bracket(c, ranks, inside=n) for (c, n), ranks in ((z, wanted[z[0]]) for z in zip(columns, sizes) if z[1])]
    found: dict[tuple[str, int], float] = {}
    while open_brackets:
        few = [b for b in open_brackets if b.inside <= listed]
        many = [b for b in open_brackets if b.inside > listed]
        open_brackets = []
        if few:
            rows = df.agg(F.struct(*[F.sort_array(F.collect_list(b.values())) for b in few]).alias("v")).first()["v"]
            found.update({(b.column, r): values[r - b.below] for b, values in zip(few, rows) for r in b.ranks})
        if many:
            ends = [first_ends.pop(b.column, None) for b in many]
            if None in ends:
                ends = df.agg(F.struct(*[b.sketch(accuracy) for b in many]).alias("v")).first()["v"]
            counted = df.agg(F.struct(*[b.counts(low, high) for b, (low, high) in zip(many, ends)]).alias("v")).first()["v"]
            for b, (low, high), c in zip(many, ends, counted):
                open_brackets += b.parted(low, high, c, found)
    return {c: (found[c, wanted[c][0]] + found[c, wanted[c][-1]]) / 2 if c in wanted else None for c in columns}


def share_cuts(df: DataFrame, group: str, value: str, share: float, bits: int = 60, listed: int = LISTED) -> dict:
    """Per value of ``group`` the smallest ``value`` at or below which ``round(share * rows)`` rows lie, None if that is no row.

    ``value`` is an integer from 0 up to ``2 ** bits``. Radix selection: the
    rows are counted by the leading bits, then those of the one bin that holds
    the cut by the next bits, until the bin is small enough to be listed or one
    value. ``df`` is read once a step; at most ``2 ** STEP`` counts of each group
    come to the driver. Rows with a null group are left out.
    """
    x, g = F.col(f"`{value}`"), F.col(f"`{group}`")
    rows = df.where(g.isNotNull() & x.isNotNull())

    def counted(inside: DataFrame, shift: int) -> dict[object, list[tuple[int, int]]]:
        found: dict = {}
        for r in inside.groupBy(g.alias("g"), F.shiftright(x, shift).alias("bin")).agg(F.count(F.lit(1)).alias("n")).collect():
            found.setdefault(r["g"], []).append((r["bin"], r["n"]))
        return {key: sorted(pairs) for key, pairs in found.items()}

    def holding(found: list[tuple[int, int]], rank: int) -> tuple[int, int, int]:
        """The bin that holds the row of that rank (from 1), the rank in it, and its rows."""
        for at, n in found:
            if rank <= n:
                return at, rank, n
            rank -= n
        raise ValueError("the rows changed between two passes")

    shift = max(bits - STEP, 0)
    first = counted(rows, shift)
    # Rounded as Spark rounds doubles, half away from zero.
    ranks = {key: int(Decimal(repr(share * sum(n for _, n in found))).quantize(Decimal(1), ROUND_HALF_UP)) for key, found in first.items()}
    cuts: dict = dict.fromkeys(first)
    bins = {key: holding(found, ranks[key]) for key, found in first.items() if ranks[key] > 0}
    while bins and shift > 0:
        places = [(g == F.lit(key)) & (F.shiftright(x, shift) == at) for key, (at, _, _) in bins.items()]
        few = max(size for _, _, size in bins.values()) <= listed
        shift = 0 if few else max(shift - STEP, 0)
        found = counted(rows.where(reduce(or_, places)), shift)
        bins = {key: holding(found[key], rank) for key, (_, rank, _) in bins.items()}
    return cuts | {key: at for key, (at, _, _) in bins.items()}
