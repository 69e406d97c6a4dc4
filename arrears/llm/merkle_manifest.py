"""Merkle manifest of a table: one tree of fan-out eight per group, one over the groups.

Rows are numbered within their group by a range shuffle and running counts of
its partitions. Nodes are then dealt by blocks of ``8 ** LEVELS`` neighbours, so
one shuffle serves several levels: on every level a node lives on the row of its
first leaf, the siblings of a node are the rows a fixed number of rows before
and after it, read by lag and lead and masked by the node's slot and the length
of its run, and the rows of first children hash the parents. The nodes left at
the top of the blocks are a table of the same form, a few thousand times
smaller, which is treated the same way.

No group is ordered by one task, and nothing is collected but the largest number
of nodes in a group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arrears.llm.common import materialise

FANOUT = 8
#: Levels that one block of neighbours covers.
LEVELS = 4

_PATH = "array<struct<left:string,right:string>>"


def framed(value: Column) -> Column:
    """A value as its UTF-8 byte count, a colon and itself; null as a minus sign."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the parts joined."""
    return F.sha2(F.concat(*parts), 256)


def row_digest(columns: Sequence[Column]) -> Column:
    return digest(*[framed(c) for c in columns])


def numbered(rows: DataFrame, groups: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``rows`` with ``pos`` (from 0, by ``order`` within the group, nulls first) and ``n``, the rows of the group.

    Rows are dealt and sorted by ranges of (groups, order); those equal in all of
    it are interchangeable and parted by where they were read, so no value,
    however frequent, makes a large partition. Counts per partition and group,
    at most partitions plus groups of them, are added up to offsets.
    """
    ascending = [F.col(c).asc_nulls_first() for c in (*groups, *order, "_read")]
    ranged = rows.withColumn("_read", F.monotonically_increasing_id()).repartitionByRange(*ascending).sortWithinPartitions(*ascending)
    # The number of the partition in the upper bits, of the row in it in the lower 33.
    stored = materialise(ranged.select(*rows.columns, F.monotonically_increasing_id().alias("_at")), "ranged")
    part = F.shiftright("_at", 33).alias("_part")
    counts = stored.groupBy(*groups, part).agg(F.count(F.lit(1)).alias("_rows"), F.min("_at").alias("_first"))
    group = Window.partitionBy(*groups) if groups else Window.partitionBy(F.lit(1))
    earlier = group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        *[F.col(g).alias(f"_{g}") for g in groups],
        F.col("_part").alias("_of"),
        (F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first")).alias("_offset"),
        F.sum("_rows").over(group).alias("n"),
    )
    matched = F.shiftright("_at", 33) == F.col("_of")
    for g in groups:
        matched = matched & F.col(g).eqNullSafe(F.col(f"_{g}"))
    return stored.join(offsets, matched).withColumn("pos", F.col("_at") + F.col("_offset")).select(*rows.columns, "pos", "n")


def block_levels(nodes: DataFrame, groups: Sequence[str], levels: int = LEVELS) -> DataFrame:
    """Nodes (groups, ``pos``, ``n``, ``node``) with ``path`` and ``top`` within their block of ``8 ** levels``.

    ``path`` holds the siblings left and right of the node and of its ancestors,
    one entry for each level on which the group has several nodes; ``top`` is
    the block's last ancestor.
    """
    block = F.expr(f"pos div {FANOUT**levels}")
    window = Window.partitionBy(*groups, "_block").orderBy("pos")
    frame = nodes.withColumn("_block", block).withColumn("_h", F.col("node"))
    steps = []
    for level in range(levels):
        span = FANOUT**level
        # Nodes of the group on this level, the node's slot in its run, and the run's length.
        count = F.expr(f"(n + {span - 1}) div {span}")
        slot = F.expr(f"(pos div {span}) % {FANOUT}")
        length = F.least(F.lit(FANOUT), count - (F.expr(f"pos div {span}") - slot))
        several, lives = count > 1, F.expr(f"pos % {span} = 0")
        behind = [F.when(slot >= k, F.lag("_h", k * span).over(window)) for k in range(FANOUT - 1, 0, -1)]
        ahead = [F.when(slot + k < length, F.lead("_h", k * span).over(window)) for k in range(1, FANOUT)]
        sides = F.struct(F.concat_ws("", *behind).alias("left"), F.concat_ws("", *ahead).alias("right"))
        frame = frame.withColumn("_own", F.when(several & lives, sides))
        # Rows between two nodes of this level have the node before them as ancestor.
        reached = F.last("_own", ignorenulls=True).over(window.rowsBetween(Window.unboundedPreceding, 0)) if level else F.col("_own")
        parent = F.when(several, F.when(lives & (slot == 0), digest(F.col("_h"), F.col("_own.right")))).otherwise(F.col("_h"))
        frame = frame.withColumn(f"_s{level}", F.when(several, reached)).withColumn("_h", parent)
        steps.append(f"_s{level}")
    path = F.array_compact(F.array(*steps)).cast(_PATH)
    top = F.first("_h").over(window.rowsBetween(Window.unboundedPreceding, 0))
    return frame.withColumn("path", path).withColumn("top", top).drop("_h", "_own", *steps)


def climbed(nodes: DataFrame, groups: Sequence[str], levels: int = LEVELS) -> DataFrame:
    """Nodes with their whole ``path`` and their group's ``top``; ``nodes`` must be stored, as it is read once a round."""
    within = block_levels(nodes, groups, levels)
    span = FANOUT**levels
    most = nodes.agg(F.max("n")).first()[0] or 0
    if most <= span:
        return within.drop("_block")
    tops = block_levels(nodes.select(*groups, "pos", "n", "node"), groups, levels).where(f"pos % {span} = 0")
    tops = tops.select(*groups, F.col("_block").alias("pos"), F.expr(f"(n + {span - 1}) div {span}").alias("n"), F.col("top").alias("node"))
    above = climbed(materialise(tops, "tops"), groups, levels).select(
        *[F.col(g).alias(f"_{g}") for g in groups], F.col("pos").alias("_above"), F.col("path").alias("_rest"), F.col("top").alias("_last")
    )
    matched = F.col("_block") == F.col("_above")
    for g in groups:
        matched = matched & F.col(g).eqNullSafe(F.col(f"_{g}"))
    joined = within.join(above, matched)
    whole = joined.withColumn("path", F.concat("path", "_rest")).withColumn("top", F.col("_last"))
    return whole.drop("_block", "_above", "_rest", "_last", *[f"_{g}" for g in groups])


def manifest(
    docs: DataFrame,
    columns: Sequence[str],
    group: str = "lang",
    doc_id: str = "doc_id",
    changed: dict[str, Column] | None = None,
    where_changed: Column | None = None,
) -> DataFrame:
    """Per row ``doc_id``, ``leaf``, ``subroot``, ``root``, ``path`` (siblings left and right, from the leaf up to the root)
    and ``presented``, the leaf of the row as it is now.

    A leaf is the digest of ``columns``. Leaves of a group ascend by ``doc_id``,
    null first, rows of one id by their leaf; equal rows are interchangeable.
    Groups ascend bytewise, null first, null being a group of its own and apart
    from the empty string. ``changed`` gives values in place of columns on the
    rows of ``where_changed``, as a copy of the data would have them.

    Null and empty values have different digests. A table of one row is its own
    root, an empty table gives an empty one. Columns not named are not read.
    """
    source = [F.col(f"`{c}`") for c in columns]
    now = [(changed or {}).get(c, F.col(f"`{c}`")) for c in columns]
    differs = F.coalesce(where_changed, F.lit(False)) if where_changed is not None else F.lit(False)
    leaves = docs.select(
        F.col(f"`{group}`").alias("grp"),
        F.col(f"`{doc_id}`").alias("doc_id"),
        row_digest(source).alias("node"),
        F.when(differs, row_digest(now)).alias("other"),
    )
    # Finding the ranges reads its input once more: better the digests than the texts.
    digests = materialise(leaves, "digests")
    stored = materialise(numbered(digests, ["grp"], ["doc_id", "node"]), "leaves")
    climbs = climbed(stored, ["grp"])
    roots = materialise(climbs.where("pos = 0").select("grp", F.col("top").alias("node")), "subroots")
    forest = climbed(materialise(numbered(roots, [], ["grp"]), "groups"), []).select(
        F.col("grp").alias("_group"), F.col("path").alias("_rest"), F.col("top").alias("root")
    )
    return climbs.join(forest, F.col("grp").eqNullSafe(F.col("_group"))).select(
        "doc_id", F.col("node").alias("leaf"), F.col("top").alias("subroot"), "root", F.concat("path", "_rest").alias("path"), F.coalesce("other", "node").alias("presented")
    )


def folded(leaf: Column, path: Column) -> Column:
    """Root that ``leaf`` has with the siblings of ``path``."""
    return F.aggregate(path, leaf, lambda h, s: F.sha2(F.concat(s["left"], h, s["right"]), 256))


def proof_digest(path: Column) -> Column:
    """Digest of all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def verify(leaves: DataFrame) -> DataFrame:
    """What ``manifest`` gives, with ``proof_sha256``, ``folded_root`` and ``verified``."""
    checked = leaves.withColumn("proof_sha256", proof_digest(F.col("path"))).withColumn("folded_root", folded(F.col("presented"), F.col("path")))
    return checked.withColumn("verified", F.col("folded_root") == F.col("root"))


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, everything else as it is."""
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, letters, letters.lower())
