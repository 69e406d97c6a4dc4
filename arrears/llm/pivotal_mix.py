"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source should be taken ``target / source_size`` times. The
whole part of that is certain; the fraction is a probability. The pivotal
method takes two documents with fractional probabilities and moves probability
from one to the other, at random in such a way that neither expectation
changes, until one of them is 0 or 1. The amount moved is measured in words, so
the expected words of the pair stay the same, and in the end the words taken
miss the target by half of one document at most. Of rows that repeat a document
all but one are settled by arithmetic.

Pairs are formed along a tree: documents are dealt to small buckets by hash,
each bucket is folded in one pass and leaves one open document at most, and the
open ones are dealt again until one bucket a source is left. Only DataFrame
functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arrears.llm.common import materialise, text_key, word_count

#: Weights of the sources in order of their names, again and again.
WEIGHTS = (5.0, 2.0, 1.0)
#: Largest number of times a document is taken.
MOST = 3
#: Mean size of a bucket of the tree.
FAN_IN = 64
SEED = 20_240_229

_EPS = 1e-12


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """``sizes`` (``source``, ``source_size``) with ``target``, the words each source should give.

    All words are shared by weight; a source gives at most ``most`` times its
    size, and what exceeds that is shared again by weight. Sources are taken in
    code-point order, null last. With sources by rising ``cap / weight``, the
    capped ones come first: a source is capped while its cap is below its share
    of what the earlier ones leave. One row a source, so one task orders them.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(by_name) - 1) % len(weights)
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), place)
    rows = sizes.select("source", "source_size", weight.alias("weight"), (F.col("source_size") * float(most)).alias("cap"))
    fill = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    after = fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    rows = rows.select(
        "*",
        F.sum("source_size").over(Window.partitionBy()).alias("total"),
        F.coalesce(F.sum("cap").over(before), F.lit(0.0)).alias("capped"),
        F.sum("weight").over(after).alias("open_weight"),
    )
    # What a unit of weight would get if all earlier sources were capped and no later one.
    rows = rows.withColumn("unit", (F.col("total") - F.col("capped")) / F.col("open_weight"))
    full = F.col("cap") <= F.col("unit") * F.col("weight")
    unit = F.min(F.when(~full, F.struct(F.col("capped"), F.col("unit")))).over(Window.partitionBy())["unit"]
    target = F.when(F.coalesce(unit, F.lit(float("inf"))) * F.col("weight") >= F.col("cap"), F.col("cap")).otherwise(unit * F.col("weight"))
    return rows.select("source", "source_size", target.cast("double").alias("target"))


def _uniform(*of: Column) -> Column:
    """Number in [0, 1) fixed by its arguments."""
    return F.pmod(F.xxhash64(*of, F.lit(SEED)), F.lit(1 << 52)) / float(1 << 52)


def _fold(members: Column, level: int) -> Column:
    """State after all members of a bucket: ``open`` document and those ``done``.

    Large documents come first, so that the one left open tends to be small.
    """
    member = "struct<doc_id:bigint,text_key:bigint,size:bigint,p:double>"
    start = F.struct(F.lit(None).cast(member).alias("open"), F.array().cast(f"array<{member}>").alias("done"))

    def put(state: Column, x: Column) -> Column:
        def settle(pair: Column) -> Column:
            """``pair`` has the open document and the new one after the move; one of them is whole."""
            whole = lambda m: (m["p"] <= _EPS) | (m["p"] >= 1 - _EPS)
            done = F.concat(state["done"], F.filter(F.array(pair["a"], pair["b"]), whole))
            left = F.get(F.filter(F.array(pair["a"], pair["b"]), lambda m: ~whole(m)), F.lit(0))
            return F.struct(left.alias("open"), done.alias("done"))

        def moved(a: Column) -> Column:
            u, v = a["size"].cast("double"), x["size"].cast("double")
            up = F.least(1 - a["p"], x["p"] * v / u)
            down = F.least(a["p"], (1 - x["p"]) * v / u)
            raised = _uniform(a["doc_id"], a["text_key"], x["doc_id"], x["text_key"], F.lit(level)) < down / (up + down)
            step = F.when(raised, up).otherwise(-down)
            rest = x["p"] - step * u / v
            # The one that became whole is set to 0 or 1 exactly.
            pa = F.when(raised & (up >= 1 - a["p"]), 1.0).when(~raised & (down >= a["p"]), 0.0).otherwise(a["p"] + step)
            pb = F.when(raised & (up < 1 - a["p"]), 0.0).when(~raised & (down < a["p"]), 1.0).otherwise(F.least(F.greatest(rest, F.lit(0.0)), F.lit(1.0)))
            return F.struct(a.withField("p", pa).alias("a"), x.withField("p", pb).alias("b"))

        first = F.struct(x.alias("open"), state["done"].alias("done"))
        pair = F.get(F.transform(F.transform(F.array(state["open"]), moved), settle), F.lit(0))
        return F.when(state["open"].isNull(), first).otherwise(pair)

    return F.aggregate(F.transform(F.array_sort(members), lambda m: m["unit"]), start, put)


def copies(units: DataFrame, fan_in: int = FAN_IN) -> DataFrame:
    """Settle the fractions of ``units`` (``source``, ``doc_id``, ``text_key``, ``size``, ``p``).

    Returns the same columns with ``p`` 0 or 1. The number of levels follows
    from the largest source: each level leaves one open unit a bucket, and each
    level's outcome is written to the shared folder. Buckets are of bounded size
    because keys are distinct and dealt by hash, whatever source they belong to.
    """
    key = ["doc_id", "text_key", "size", "p"]
    still = "p > 1e-12 AND p < 1 - 1e-12 AND size > 0"
    # A document without words takes nothing from a target; it is rounded by itself.
    empty = units.where(f"NOT ({still})").select(
        "source", *key[:3], F.when(F.col("p").between(_EPS, 1 - _EPS), (_uniform(F.col("doc_id"), F.col("text_key")) < F.col("p")).cast("double")).otherwise(F.round("p")).alias("p")
    )
    settled, level = [empty], 0
    rest = units.where(still)
    most = rest.groupBy("source").count().agg(F.max("count")).first()[0] or 0
    while most > 0:
        last = most <= fan_in
        counts = rest.groupBy("source").agg(F.count("*").alias("of"))
        counts = counts.select(F.col("source").alias("__s"), F.ceil(F.col("of") / fan_in).cast("long").alias("buckets"))
        dealt = rest.join(counts, F.col("source").eqNullSafe(F.col("__s")))
        bucket = F.pmod(F.xxhash64("doc_id", "text_key", F.lit(SEED + level)), F.lit(1) if last else F.col("buckets"))
        folded = dealt.groupBy("source", bucket.alias("bucket")).agg(_fold(F.collect_list(F.struct((-F.col("size")).alias("rank"), F.struct(*key).alias("unit"))), level).alias("state"))
        folded = materialise(folded, f"mix_level_{level}")
        settled.append(folded.select("source", F.inline("state.done")).withColumn("p", F.round("p")))
        rest = folded.where("state.open IS NOT NULL").select("source", "state.open.*")
        if last:
            # The one unit of a source that is left goes to the nearer whole number.
            settled.append(rest.select("source", *key[:3], F.round("p").alias("p")))
            break
        most = rest.groupBy("source").count().agg(F.max("count")).first()[0] or 0
        level += 1
    out = settled[0]
    for part in settled[1:]:
        out = out.unionByName(part)
    return out


def planned(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """One row for each different (``source``, ``doc_id``, ``text_key``) with ``size``, ``source_size``, ``target``, its
    ``rows``, how often each of them is taken (``base``), and how many of them once more (``more``).

    Equal rows are interchangeable: what they have to give beyond ``base`` is a
    number of whole rows and the fraction of one, and that one alone goes into
    the tree, so many copies miss a target no further than a single row.
    """
    rows = docs.select(
        F.col("`doc_id`").cast("long").alias("doc_id"), text_key(F.col("`text`")).alias("text_key"), F.col("`source`").alias("source"), word_count(F.col("`text`")).alias("size")
    )
    units = materialise(rows.groupBy("source", "doc_id", "text_key", "size").agg(F.count("*").alias("rows")), "mix_units")
    sizes = units.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).alias("source_size"))
    goals = materialise(targets(sizes, weights, most), "mix_targets").withColumnRenamed("source", "__s")
    # One row a source; the planner broadcasts it where it is small.
    rated = units.join(goals, F.col("source").eqNullSafe(F.col("__s"))).drop("__s")
    times = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(most)))).otherwise(0.0)
    rated = rated.withColumn("times", times).withColumn("base", F.floor("times"))
    beyond = F.col("rows") * (F.col("times") - F.col("base"))
    rated = rated.withColumn("whole", F.floor(beyond))
    fractions = rated.select("source", "doc_id", "text_key", "size", (beyond - F.col("whole")).alias("p"))
    chosen = copies(fractions).select(F.col("source").alias("__s"), F.col("doc_id").alias("__d"), F.col("text_key").alias("__k"), F.col("p").cast("long").alias("extra"))
    same = F.expr("source <=> __s AND doc_id <=> __d AND text_key = __k")
    return rated.join(chosen, same).select(
        "source", "doc_id", "text_key", "size", "source_size", "target", "rows", F.col("base").cast("int").alias("base"), (F.col("whole") + F.col("extra")).alias("more")
    )


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """How often each document is taken so that sources come near their targets.

    One row for each row of ``docs``: ``doc_id``, ``text_key``, ``source``,
    ``size`` (words; a null text has none), ``source_size``, ``target`` and
    ``copies`` (0 to ``most``). Rows that agree in doc_id, source and text are
    interchangeable; their copies differ by one at most. A source without words
    has target 0 and is not taken. An empty table gives an empty one. Equal
    input gives equal results, however it is partitioned. Other columns are not
    read, whatever their names.
    """
    each = F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))).alias("row")
    rows = planned(docs, weights, most).select("*", each)
    taken = F.col("base") + (F.col("row") <= F.col("more")).cast("int")
    return rows.select("doc_id", "text_key", "source", "size", "source_size", "target", taken.alias("copies"))


def mixed(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """``docs`` with every row as often as the mix takes it, all columns kept, whatever their names.

    Null and empty texts have no words and are taken as ``mix`` says; equal rows
    are numbered, without bringing them together, to take some of them once more;
    an empty table gives an empty one.
    """
    plan = planned(docs, weights, most).where("base > 0 OR more > 0")
    plan = plan.select(F.col("source").alias("s"), F.col("doc_id").alias("d"), F.col("text_key").alias("k"), "base", "more", "rows")
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole")
    keyed = docs.select(whole, F.col("`source`").alias("of"), F.col("`doc_id`").cast("long").alias("id"), text_key(F.col("`text`")).alias("key"))
    joined = keyed.join(plan, F.expr("of <=> s AND id <=> d AND key = k")).select("whole", "s", "d", "k", "base", "more", "rows")
    # Where all equal rows are taken equally often, as nearly everywhere, no row needs a number.
    uneven = (F.col("more") > 0) & (F.col("more") < F.col("rows"))
    joined = materialise(joined.withColumn("at", F.monotonically_increasing_id()), "mixed_rows")
    even = joined.where(~uneven).select("whole", (F.col("base") + (F.col("more") > 0).cast("int")).alias("copies"))
    split = joined.where(uneven).withColumn("part", F.shiftright("at", 33))
    unit = ["s", "d", "k"]
    counts = split.groupBy(*unit, "part").agg(F.count(F.lit(1)).alias("here"))
    before = Window.partitionBy(*unit).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*[F.col(c).alias(f"_{c}") for c in (*unit, "part")], F.coalesce(F.sum("here").over(before), F.lit(0)).alias("offset"))
    numbered = split.withColumn("number", F.row_number().over(Window.partitionBy(*unit, "part").orderBy("at")))
    placed = numbered.join(offsets, F.expr("s <=> _s AND d <=> _d AND k = _k AND part = _part"))
    odd = placed.select("whole", (F.col("base") + (F.col("offset") + F.col("number") <= F.col("more")).cast("int")).alias("copies"))
    taken = even.unionByName(odd).where("copies > 0")
    return taken.select("whole", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("whole.*")
