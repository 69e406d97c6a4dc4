"""Quality rules whose cutoffs come with a bound on false rejections.

Base rules reject a document outright. Beyond them, each rule measures a ratio,
and a document is rejected where the ratio exceeds the rule's cutoff in its
stratum. Cutoffs come from a fixed grid. For each stratum, rule and grid value,
the labelled holdout tells how many good documents the cutoff would reject; a
cutoff holds only if so few rejections (or fewer) would be improbable under a
false rejection rate of ``alpha / rules``, by the exact binomial distribution,
at the level ``delta / (rules * strata)``. Cutoffs of one rule are nested: a
stricter one rejects whatever a laxer one does. So they are tested in a fixed
sequence from the laxest on, up to the first that fails, which needs no further
correction for the grid. Together the rules then reject more than ``alpha`` of
the good documents of some stratum with a probability below ``delta``. Among
the cutoffs before the first failure the one with the best balance of bad and
good documents rejected is taken, or none.

Trials have to be independent, so labelled rows of one stratum with the same
text are one trial, which is good only if all of them are.

Only DataFrame functions are used.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arrears.llm.common import WORD, materialise, text_key

SPACES = r"[\x20\x09-\x0D]+"

#: Ratio of each rule, over the counts of ``rule_counts``; the larger, the worse.
RULES = {
    "symbols": "n_symbols / word_chars",
    "repeats": "n_repeat_words / n_words",
    "dup_lines": "n_dup_lines / n_words",
    "long_words": "word_chars / n_words / 20",
    "short_words": "1 - word_chars / n_words / 20",
}

#: Cutoffs tried for every rule.
GRID = [0.01, 0.02, 0.05, 0.1, 0.15, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]


@dataclass(frozen=True)
class Risk:
    """Bounds of the selection."""

    #: Largest share of good documents that all rules together may reject in a stratum.
    alpha: float = 0.02
    #: Probability that the bound fails anywhere.
    delta: float = 0.05
    #: Bad documents that one good document rejected has to be worth.
    worth: float = 10.0


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def rule_counts(text: Column) -> dict[str, Column]:
    """Counts of a whole text (null: no words) by name, as longs."""
    whole = F.coalesce(text, F.lit(""))
    words = F.array_remove(F.split(whole, SPACES), "")
    lines = F.filter(F.split(whole, "\n"), lambda line: line.rlike(WORD))
    counts = let(
        words,
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.char_length(F.array_join(w, "")).cast("long").alias("word_chars"),
            _repeated(w).alias("n_repeat_words"),
        ),
    )
    return {
        "counted": counts,
        "n_symbols": F.regexp_count(whole, F.lit("[#*$%&|<>]")).cast("long"),
        "n_dup_lines": let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long")),
    }


def _repeated(words: Column, width: int = 5) -> Column:
    """Words that lie in windows of ``width`` words found twice or more."""
    n = F.size(words)

    def grams(hashes: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), n - width), lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(width)]))

    def covered(found: Column) -> Column:
        ordered = F.array_sort(F.transform(found, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))

        def positions(o: Column) -> Column:
            # Neighbours with an equal window; null beyond the ends is no equality.
            twice = F.filter(
                o,
                lambda x, k: F.coalesce(F.get(o, k - 1)["g"] == x["g"], F.lit(False)) | F.coalesce(F.get(o, k + 1)["g"] == x["g"], F.lit(False)),
            )
            return F.array_sort(F.transform(twice, lambda x: x["i"]))

        def union(at: Column) -> Column:
            start = F.struct(F.lit(0).alias("upto"), F.lit(0).alias("total"))
            folded = F.aggregate(
                at,
                start,
                lambda s, p: F.struct((p + width).alias("upto"), (s["total"] + p + width - F.greatest(s["upto"], p)).alias("total")),
            )
            return folded["total"]

        return let(let(ordered, positions), union)

    def count(found: Column) -> Column:
        return F.when(F.size(F.array_distinct(found)) == F.size(found), F.lit(0)).otherwise(covered(found))

    hashed = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(n <= width, F.lit(0)).otherwise(let(let(hashed, grams), count)).cast("long")


def counted(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``stratum`` (the language), ``text_key``, the counts and ``base_failed`` of every row."""
    c = rule_counts(F.col("text"))
    rows = docs.select(
        F.col("doc_id"), F.col("lang").alias("stratum"), text_key(F.col("text")).alias("text_key"), *[v.alias(k) for k, v in c.items()]
    ).select("doc_id", "stratum", "text_key", "counted.*", "n_symbols", "n_dup_lines")
    return rows.withColumn("base_failed", F.expr("n_words < 10 OR 100 * n_repeat_words > 20 * n_words"))


def ratios() -> list[Column]:
    """The rules' ratios; zero where the document has no words."""
    return [F.coalesce(F.expr(f"CASE WHEN n_words > 0 THEN {ratio} END"), F.lit(0.0)).cast("double").alias(name) for name, ratio in RULES.items()]


def cutoffs(stats: DataFrame, labels: DataFrame, risk: Risk = Risk()) -> DataFrame:
    """``stratum`` and a cutoff column for each rule; null where no grid value is safe.

    ``stats`` comes from ``counted``. Labelled documents that pass the base rules
    are the holdout; nothing is fitted on them but the choice. A document whose
    labels disagree counts as bad, null labels are left out, and rows without
    doc_id have no label. What is gathered has one row for each stratum, rule
    and grid value at most.
    """
    quality = labels.where("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("good"))
    labelled = stats.where("NOT base_failed").join(quality, "doc_id").select("stratum", "text_key", "good", *ratios())
    # Equal texts have equal ratios.
    held = labelled.groupBy("stratum", "text_key").agg(F.min("good").alias("good"), *[F.first(r).alias(r) for r in RULES])
    tries = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.col(r).alias("ratio")) for r in RULES])).alias("t")
    # The number of grid values below the ratio says which cutoffs reject it.
    level = sum((F.col("t.ratio") > c).cast("int") for c in GRID)
    bins = held.select("stratum", "good", tries).groupBy("stratum", F.col("t.rule").alias("rule"), level.alias("level"))
    bins = bins.agg(F.sum("good").alias("good"), F.sum(1 - F.col("good")).alias("bad"))
    rejected = bins.select("stratum", "rule", "good", "bad", F.posexplode(F.array(*map(F.lit, GRID))).alias("k", "cutoff"), "level")
    tests = rejected.groupBy("stratum", "rule", "cutoff").agg(
        F.sum("good").alias("n"),
        F.sum(F.when(F.col("level") > F.col("k"), F.col("good")).otherwise(0)).alias("lost"),
        F.sum(F.when(F.col("level") > F.col("k"), F.col("bad")).otherwise(0)).alias("caught"),
    )
    rate = risk.alpha / len(RULES)
    # Null is a stratum beside the empty string.
    strata = tests.agg(F.greatest(F.count_distinct(F.struct("stratum")), F.lit(1)).alias("strata")).scalar()
    fails = binomial_tail(F.col("lost"), F.col("n"), rate) > F.lit(risk.delta / len(RULES)) / strata
    # One row for each grid value in a window.
    laxer = Window.partitionBy("stratum", "rule").orderBy(F.col("cutoff").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    safe = tests.withColumn("fails", fails).withColumn("failed", F.max(F.col("fails")).over(laxer)).where("NOT failed")
    gain = F.col("caught") - risk.worth * F.col("lost")
    best = safe.where(gain > 0).groupBy("stratum", "rule").agg(F.max_by("cutoff", F.struct(gain, F.col("cutoff"))).alias("cutoff"))
    return best.groupBy("stratum").pivot("rule", list(RULES)).agg(F.max("cutoff"))


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """Probability of ``k`` or fewer hits in ``n`` trials at rate ``p``; 1 where ``k`` is above the mean."""
    odds = F.log(F.lit(p) / (1 - p))
    start = n * F.log(F.lit(1.0) - p)
    first = F.struct(start.alias("log"), F.exp(start).alias("sum"))

    def add(s: Column, i: Column) -> Column:
        log = s["log"] + F.log((n - i + 1) / i) + odds
        return F.struct(log.alias("log"), (s["sum"] + F.exp(log)).alias("sum"))

    terms = F.when(k > 0, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<bigint>"))
    return F.when(k >= n * p, F.lit(1.0)).otherwise(F.aggregate(terms, first, add)["sum"])


def judge(stats: DataFrame, limits: DataFrame) -> DataFrame:
    """``stats`` with ``kept``: past the base rules and no ratio above its stratum's cutoff."""
    chosen = limits.select(F.col("stratum").alias("__stratum"), *[F.col(r).alias(f"__{r}") for r in RULES])
    # One row a stratum that is large enough to prove a bound; the planner chooses how to join it.
    joined = stats.join(chosen, F.col("stratum").eqNullSafe(F.col("__stratum")), "left")
    broken = [F.coalesce(ratio > F.col(f"__{name}"), F.lit(False)) for name, ratio in zip(RULES, ratios())]
    rejected = broken[0]
    for b in broken[1:]:
        rejected = rejected | b
    return joined.withColumn("kept", ~F.col("base_failed") & ~rejected).drop("__stratum", *[f"__{r}" for r in RULES])


def quality_rules(docs: DataFrame, labels: DataFrame, risk: Risk = Risk()) -> DataFrame:
    """Verdict on every row of ``docs``.

    Returns ``doc_id``, ``text_key``, the counts, ``base_failed`` and ``kept``.
    A null or empty text has no words and fails the base rules; null languages
    are a stratum of their own; repeated rows get equal verdicts; without labels
    only the base rules act; an empty table gives an empty one. Other columns
    are ignored. The texts are read once: counts are written to the shared
    folder, narrow, and serve both the selection and the verdict.
    """
    stats = materialise(counted(docs.select("doc_id", "text", "lang")), "rule_counts")
    limits = materialise(cutoffs(stats, labels, risk), "cutoffs")
    return judge(stats, limits)


def keep_good(docs: DataFrame, labels: DataFrame, risk: Risk = Risk()) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns, whatever their names.

    Verdicts are those of ``quality_rules``: rows without words go, repeated
    rows stay or go together, an empty table gives an empty one.
    """
    kept = quality_rules(docs, labels, risk).where("kept").select(F.col("doc_id").alias("id"), F.col("text_key").alias("chosen"))
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole")
    keyed = docs.select(whole, F.col("`doc_id`").alias("of"), text_key(F.col("`text`")).alias("key"))
    return keyed.join(kept, F.expr("of <=> id AND key = chosen"), "left_semi").select("whole.*")
