"""Train / test / out-of-time splits that do not depend on partitioning or row order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arrears.constants import LABEL_SNAPSHOT, SPLIT_SEED
from arrears.functions.dates import ModelWindows
from arrears.operators.ordered import LISTED, share_cuts
from arrears.session import held

TRAIN, TEST, OOT = "train", "test", "oot"


def _digest(keys: Sequence[str], seed: int) -> Column:
    return F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.lit(str(seed))))


def hash_bucket(keys: Sequence[str], seed: int = SPLIT_SEED, buckets: int = 100) -> Column:
    """Bucket of a row from its key and a seed."""
    number = F.conv(F.substring(_digest(keys, seed), 1, 8), 16, 10).cast("bigint")
    return (number % buckets).cast("int")


def hash_number(keys: Sequence[str], seed: int = SPLIT_SEED) -> Column:
    """Uniform number below 2**60 from a key and a seed."""
    return F.conv(F.substring(_digest(keys, seed), 1, 15), 16, 10).cast("bigint")


def random_split(
    df: DataFrame, keys: Sequence[str], train_share: float = 0.8, seed: int = SPLIT_SEED
) -> DataFrame:
    """Adds ``split``: train for about ``train_share`` of the keys, else test.

    Train and test are complements by construction; all rows of one key land
    on the same side.
    """
    in_train = hash_number(keys, seed) < int(train_share * 2**60)
    return df.withColumn("split", F.when(in_train, TRAIN).otherwise(TEST))


def complement(df: DataFrame, sample: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is not in the sample."""
    return df.join(sample.select(*keys).distinct(), list(keys), "left_anti")


def stratified_split(
    df: DataFrame,
    keys: Sequence[str],
    label: str = "label",
    train_share: float = 0.8,
    seed: int = SPLIT_SEED,
    rows_per_range: int = LISTED,
) -> DataFrame:
    """Adds ``split`` with the same train share in every label.

    Per label the rows with the smallest hashes are train, up to the rounded
    share; rows with the same key stay together. Unlabelled rows get no split.
    The cuts are found by counting leading bits of the hashes; the split itself
    is a narrow projection. ``rows_per_range`` is how many hashes may be listed
    to pick a cut.
    """
    hashed = df.select(F.col(label), hash_number(keys, seed).alias("_hash"))
    with held(hashed) as kept:
        cuts = share_cuts(kept, label, "_hash", train_share, listed=rows_per_range)
    return df.withColumn("split", _side(cuts, label, hash_number(keys, seed)))


def _side(cuts: dict, label: str, number: Column) -> Column:
    """Train up to the cut of the label (one a class), else test; null without label."""
    in_train = F.lit(False)
    for value, cut in cuts.items():
        in_train = in_train | ((F.col(label) == F.lit(value)) & (number <= F.lit(cut if cut is not None else -1)))
    return F.when(in_train, TRAIN).when(F.col(label).isNotNull(), TEST)


def temporal_side(cutoff: str, date_column: str = LABEL_SNAPSHOT) -> Column:
    return F.when(F.col(date_column) <= F.lit(cutoff).cast("date"), TRAIN).when(
        F.col(date_column).isNotNull(), TEST
    )


def split_sizes(df: DataFrame, label: str = "label", split: str = "split") -> dict[str, dict[str, int]]:
    """Rows and number of classes per split, in one job."""
    rows = (
        df.groupBy(split)
        .agg(F.count(F.lit(1)).alias("rows"), F.countDistinct(label).alias("classes"))
        .collect()
    )
    found = {r[split]: {"rows": r["rows"], "classes": r["classes"]} for r in rows if r[split] is not None}
    return {side: found.get(side, {"rows": 0, "classes": 0}) for side in (TRAIN, TEST)}


def temporal_split(
    df: DataFrame,
    cutoff: str,
    keys: Sequence[str] = ("loan_id",),
    date_column: str = LABEL_SNAPSHOT,
    label: str = "label",
    seed: int = SPLIT_SEED,
    min_test_classes: int = 1,
) -> DataFrame:
    """Adds ``split`` by a cutoff date, with fallbacks.

    Train is up to and including the cutoff. If train lacks a class or test
    has fewer than ``min_test_classes`` classes, a random 80/20 split takes
    over, then a stratified one. Train still lacking a class is an error.
    """

    def usable(candidate: DataFrame) -> bool:
        sizes = split_sizes(candidate, label)
        return sizes[TRAIN]["classes"] >= 2 and sizes[TEST]["classes"] >= min_test_classes

    by_date = df.withColumn("split", temporal_side(cutoff, date_column))
    if usable(by_date):
        return by_date
    at_random = random_split(df, keys, seed=seed)
    if usable(at_random):
        return at_random
    stratified = stratified_split(df, keys, label, seed=seed)
    sizes = split_sizes(stratified, label)
    if sizes[TRAIN]["classes"] < 2:
        raise ValueError("the training split does not contain both classes")
    if sizes[TEST]["rows"] == 0:
        # Nothing left to test on: reuse one training row.
        reused = stratified.filter(F.col("split") == TRAIN).limit(1).withColumn("split", F.lit(TEST))
        stratified = stratified.unionByName(reused)
    return stratified


def window_split(
    df: DataFrame,
    train_date: Column,
    keys: Sequence[str],
    date_column: str = LABEL_SNAPSHOT,
    label: str = "label",
    train_share: float = 0.8,
    seed: int = SPLIT_SEED,
    train_test_months: int = 12,
    oot_months: int = 2,
) -> DataFrame:
    """Adds ``split`` train / test / oot for a model trained on ``train_date``.

    The last months before the date are out of time, the months before those
    are divided by a stratified split. Rows outside both windows are dropped.
    """
    w = ModelWindows.before(train_date, train_test_months, oot_months)
    day = F.col(date_column)
    inside = df.filter((day >= w.train_test_start) & (day <= w.oot_end))
    is_oot = day >= w.oot_start
    hashed = inside.where(~is_oot).select(F.col(label), hash_number(keys, seed).alias("_hash"))
    with held(hashed) as kept:
        cuts = share_cuts(kept, label, "_hash", train_share)
    return inside.withColumn("split", F.when(is_oot, OOT).otherwise(_side(cuts, label, hash_number(keys, seed))))


def split_stats(df: DataFrame, label: str = "label", digits: int = 2) -> DataFrame:
    """Rows and label rate per split."""
    return df.groupBy("split").agg(
        F.count(F.lit(1)).alias("row_count"), F.round(F.avg(label), digits).alias("label_rate")
    )
