"""Exact top-k inner products by the three-phase uniform threshold algorithm.

The components of the vectors are cut into lists; the score of a pair is the
sum of its partial scores, one from each list. Phase one gathers the best
partial scores of every list from every task and resolves these few candidates
exactly; the k-th best of them is a lower bound t on the k-th best score. Phase
two broadcasts t: with m lists, a candidate that reaches t has a partial score
of t / m or more in some list. Candidates whose lists are too short for that
are not multiplied at all, entries below t / m are not collected, and those
whose known partial scores and the most that the others can give stay below t
are dropped. Phase three resolves the rest exactly and sends on what reaches t.

Queries are broadcast in groups of bounded size and the candidates are read in
place, so the shuffle holds entries of the result lists and nothing else.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from arrears.llm.common import materialise

SCALE = 1024
#: Lists that the components are cut into.
LISTS = 2
#: Queries in a group, candidates after which results are merged, candidates scored at once.
GROUP, BLOCK, CHUNK = 16_384, 8_192, 1_024
#: Bytes of vectors that a group of queries has at most, about.
GROUP_BYTES = 32_000_000
#: Scores are longs; those beyond count as the nearest long.
LOWEST, HIGHEST = -(1 << 63), (1 << 63) - 1

_ENTRY = "query long, query_id long, vec_id long, score long"


def whole_vectors(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """``vec_id``, ``dim`` and ``v``, the components as little-endian doubles, of every row that takes part.

    Rows whose id or vector is null, or whose vector holds a null or non-finite
    component, are left out; rows that repeat an id stay.
    """
    frame = vectors.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), F.col(f"`{embedding}`").cast("array<double>").alias("e"))
    usable = "vec_id IS NOT NULL AND e IS NOT NULL AND forall(e, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity'))"

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            lists = part.column(1)
            values = lists.flatten().to_numpy(zero_copy_only=False).astype("<f8")
            sizes = np.diff(lists.offsets.to_numpy())
            stops = np.cumsum(sizes)
            packed = [values[b - n : b].tobytes() for n, b in zip(sizes.tolist(), stops.tolist())]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sizes, pa.int32()), pa.array(packed, pa.binary())], names=["vec_id", "dim", "v"])

    return frame.where(usable).mapInArrow(run, "vec_id long, dim int, v binary")


def integers(packed: list[bytes], dim: int) -> np.ndarray:
    """floor(1024 * x) of every component, one row a vector, in the smallest type that holds them exactly.

    Scaling by a power of two and the floor are exact in doubles, up to their largest.
    """
    x = np.frombuffer(b"".join(packed), "<f8").reshape(len(packed), dim)
    with np.errstate(over="ignore"):
        scaled = np.floor(SCALE * x)
    if np.isfinite(scaled).all():
        return scaled
    return np.array([[int(b) if np.isfinite(b) else SCALE * int(a) for a, b in zip(*rows)] for rows in zip(x.tolist(), scaled.tolist())], object).reshape(x.shape)


def _largest(a: np.ndarray) -> int:
    return int(max(abs(x) for x in a.flat)) if a.dtype == object and a.size else int(np.abs(a).max(initial=0))


def _exactly(q: np.ndarray, c: np.ndarray) -> type:
    """Smallest number type in which all inner products of these integers are exact."""
    top = max(1, q.shape[1]) * _largest(q) * _largest(c)
    # With room for the number of lists as a factor.
    return np.float64 if top < 1 << 49 else np.int64 if top < 1 << 58 else object


def _as(a: np.ndarray, kind: type) -> np.ndarray:
    if kind is not object or a.dtype == object:
        return a.astype(kind)
    return np.array([[int(x) for x in row] for row in a.tolist()], object).reshape(a.shape)


def _slices(dim: int, lists: int) -> list[slice]:
    cuts = np.linspace(0, dim, min(lists, max(1, dim)) + 1).astype(int)
    return [slice(a, b) for a, b in zip(cuts[:-1], cuts[1:])]


def _best(query: np.ndarray, vec: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` best rows of each query, ties to the smaller id."""
    # Not ``-score``: the smallest long has no negative.
    order = np.lexsort((vec, ~score, query))
    query = query[order]
    start = np.flatnonzero(np.append(True, query[1:] != query[:-1])) if len(query) else np.empty(0, int)
    rank = np.arange(len(query)) - np.repeat(start, np.diff(np.append(start, len(query))))
    return order[rank < k]


def within_reach(q: np.ndarray, c: np.ndarray, bound: np.ndarray, known: np.ndarray, lists: int) -> np.ndarray:
    """Candidates that some query may give ``bound / lists`` in some list, by the lengths of both; all if a query has no bound."""
    if not known.all() or (bound <= 0).any() or q.dtype == object or c.dtype == object:
        return np.ones(len(c), bool)
    parts = _slices(q.shape[1], lists)
    out = np.zeros(len(c), bool)
    for s in parts:
        with np.errstate(divide="ignore", over="ignore"):
            needed = (bound / len(parts) / np.sqrt(np.square(q[:, s]).sum(axis=1))).min()
            # A little less than needed, for rounding.
            out |= np.sqrt(np.square(c[:, s]).sum(axis=1)) >= needed * (1 - 1e-9)
    return out


def _gathered(q: np.ndarray, c: np.ndarray, k: int, lists: int, kind: type) -> np.ndarray:
    """Phase one: the best ``k`` of each list, and one more, as the query itself may be among them."""
    wanted = np.zeros((len(q), len(c)), bool)
    if len(c) <= k + 1:
        return ~wanted
    for s in _slices(q.shape[1], lists):
        partial = q[:, s] @ c[:, s].T
        top = (np.argsort(-partial, axis=1) if kind is object else np.argpartition(-partial, k, axis=1))[:, : k + 1]
        np.put_along_axis(wanted, top, True, axis=1)
    return wanted


def _sufficient(q: np.ndarray, c: np.ndarray, lists: int, bound: np.ndarray, known: np.ndarray, kind: type) -> np.ndarray:
    """Phase two: entries of ``bound / lists`` or more, less those that cannot reach ``bound``; all for a query without bound."""
    # Scores of these numbers lie well within the limits that a bound is cut to, so nothing overflows.
    cut = bound if kind is object else np.clip(bound, -(1 << 59), 1 << 59)
    parts, limit = _slices(q.shape[1], lists), _as(cut[:, None], kind)
    sums, count = np.zeros((len(q), len(c)), kind), np.zeros((len(q), len(c)), np.int8)
    for s in parts:
        partial = q[:, s] @ c[:, s].T
        enough = (partial * len(parts) >= limit).astype(bool)
        sums = sums + np.where(enough, partial, 0)
        count += enough
    # A list that did not send the candidate gives less than bound / lists.
    reached = (sums * len(parts) + (len(parts) - count) * limit >= limit * len(parts)).astype(bool)
    return ((count > 0) & reached) | ~known[:, None]


def _resolved(q: np.ndarray, c: np.ndarray, wanted: np.ndarray, kind: type) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query places, candidate places and exact scores, within the longs, of the wanted pairs."""
    a, b = np.nonzero(wanted)
    if kind is object:
        score = np.array([min(max(sum(x * y for x, y in zip(q[i], c[j])), LOWEST), HIGHEST) for i, j in zip(a, b)], np.int64)
    else:
        score = np.einsum("ij,ij->i", q[a], c[b]).astype(np.int64)
    return a, b, score


class Queries:
    """A group of queries by number of components: row numbers, ids, integers, and the cutoffs once known."""

    def __init__(self, table: pa.Table):
        self.by_dim: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        dims = table.column("dim").to_numpy()
        for dim in np.unique(dims).tolist():
            chosen = table.filter(pa.array(dims == dim))
            self.by_dim[dim] = chosen.column("row").to_numpy(), chosen.column("vec_id").to_numpy(), integers(chosen.column("v").to_pylist(), dim)
        self.cutoffs: dict[int, int] = {}


def search(shared, k: int, lists: int, phase: int, counted: Callable[[int], None] | None = None) -> Callable:
    """Function for ``mapInArrow``: the task's ``k`` best entries of each query of the group, by the rules of the phase."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group = shared.value
        held = {dim: [np.empty(0, np.int64)] * 3 for dim in group.by_dim}
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in set(np.unique(dims).tolist()) & set(group.by_dim):
                rows, _, q = group.by_dim[dim]
                bound = np.array([group.cutoffs.get(r, 0) for r in rows.tolist()], np.int64)
                known = np.array([r in group.cutoffs for r in rows.tolist()], bool)
                chosen = batch.filter(pa.array(dims == dim))
                numbers, ids, packed = chosen.column("row").to_numpy(), chosen.column("vec_id").to_numpy(), chosen.column("v").to_pylist()
                for start in range(0, len(ids), BLOCK):
                    out = [held[dim]]
                    for i in range(start, min(start + BLOCK, len(ids)), CHUNK):
                        part = slice(i, min(i + CHUNK, start + BLOCK))
                        out.append(_chunk(q, integers(packed[part], dim), rows, numbers[part], ids[part], bound, known, k, lists, phase, counted))
                    query, vec, score = (np.concatenate(x) for x in zip(*out))
                    best = _best(query, vec, score, k)
                    held[dim] = [query[best], vec[best], score[best]]
        for dim, (rows, own, _) in group.by_dim.items():
            query, vec, score = held[dim]
            yield pa.RecordBatch.from_arrays([pa.array(rows[query]), pa.array(own[query]), pa.array(vec), pa.array(score)], ["query", "query_id", "vec_id", "score"])

    return run


def _chunk(q, c, rows, numbers, ids, bound, known, k, lists, phase, counted):
    if phase == 2:
        near = within_reach(q, c, bound, known, lists)
        c, numbers, ids = c[near], numbers[near], ids[near]
    kind = _exactly(q, c)
    qk, ck = _as(q, kind), _as(c, kind)
    wanted = _gathered(qk, ck, k, lists, kind) if phase == 1 else _sufficient(qk, ck, lists, bound, known, kind)
    wanted &= rows[:, None] != numbers[None, :]
    a, b, score = _resolved(qk, ck, wanted, kind)
    if counted is not None:
        counted(len(a))
    good = (score >= bound[a]) | ~known[a] if phase == 2 else np.ones(len(a), bool)
    return [a[good], ids[b[good]], score[good]]


def top_k(vectors: DataFrame, every: int = 100, k: int = 10, lists: int = LISTS, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """The ``k`` best candidates of every query: ``query_id``, ``rank``, ``vec_id``, ``score``.

    Queries are the rows whose id is divisible by ``every``, candidates all rows
    of the same number of components but the query's own row; a row that repeats
    another is a query and a candidate of its own. Fewer candidates than ``k``:
    all of them; none: no rows. Ties go to the smaller id. A score beyond the
    longs counts as the nearest long. See ``whole_vectors`` for rows that take
    no part; an empty table gives an empty one. Other columns are not used.
    """
    spark = vectors.sparkSession
    rows = materialise(whole_vectors(vectors, vec_id, embedding).withColumn("row", F.monotonically_increasing_id()), "whole_vectors")
    asked = rows.where(F.col("vec_id") % every == 0)
    count, size = asked.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("v")), F.lit(0))).first()
    groups = max(1, -(-count // GROUP), -(-size // GROUP_BYTES))
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), "vec_id")
    results = []
    for g in range(groups):
        group = Queries(asked.where(F.pmod(F.xxhash64("row"), F.lit(groups)) == g).select("row", "vec_id", "dim", "v").toArrow())
        first = rows.mapInArrow(search(spark.sparkContext.broadcast(group), k, lists, 1), _ENTRY)
        ranked = first.withColumn("rank", F.row_number().over(order)).where(F.col("rank") == k)
        # One number for each query of the group.
        group.cutoffs = {r["query"]: r["score"] for r in ranked.select("query", "score").collect()}
        found = rows.mapInArrow(search(spark.sparkContext.broadcast(group), k, lists, 2), _ENTRY)
        found = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
        results.append(found if groups == 1 else materialise(found, "found"))
    out = results[0]
    for found in results[1:]:
        out = out.union(found)
    return out
