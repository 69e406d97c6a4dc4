"""Full-batch gradient descent of several penalised logistic losses at once.

A descent of hundreds of steps need not read the data at every step. A pass over
the rows gives gradient and Hessian of every candidate at its present weights;
between two passes the steps are taken on that quadratic model, which needs no
data. The next pass gives the derivatives at the end of the stretch; with them the
steps are taken once more, the Hessian now changing along the way. Where that
moves the weights too far, the stretch is done again with fewer steps, otherwise
the next one is longer. As weights settle, stretches grow, so a few dozen passes
replace hundreds.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrears.session import batch_bytes

BLOCK_ROWS = 2_048
#: Bytes of blocks that a worker gets at once, at least one block.
BATCH_BYTES = 4 << 20
#: Largest correction of a weight that a stretch of steps may need. What is left after it is far smaller.
TOLERANCE = 1e-3
_BLOCK = "rows int, x binary, y binary"


def blocks_of(rows: DataFrame, columns: Sequence[str], label: str, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Blocks of rows as matrices of doubles."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(len(columns))], axis=1).astype("<f8")
            y = batch.column(len(columns)).to_numpy(zero_copy_only=False).astype("<f8")
            parts = [slice(i, i + block_rows) for i in range(0, len(y), block_rows)]
            packed = [{"rows": len(y[s]), "x": x[s].tobytes(), "y": y[s].tobytes()} for s in parts]
            yield pa.RecordBatch.from_pylist(packed, pa.schema([("rows", pa.int32()), ("x", pa.binary()), ("y", pa.binary())]))

    return rows.select(*[F.col(f"`{c}`").cast("double") for c in columns], F.col(label).cast("double")).mapInArrow(pack, _BLOCK)


def _sums(weights: Sequence[np.ndarray]) -> Callable:
    """Function for ``mapInArrow``: per candidate the sums of gradient and Hessian over the rows, one entry a row.

    The last weight is the intercept. Entry 0 is the number of rows and entry 1 that of positive ones, then come the
    gradient and the upper triangle of the Hessian.
    """

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d = len(weights[0])
        upper = np.triu_indices(d)
        totals = np.zeros((len(weights), 2 + d + len(upper[0])))
        for batch in batches:
            # Cells are views of the batch, so one block at a time is copied.
            for x, y in zip(batch.column(0), batch.column(1)):
                y = np.frombuffer(y.as_buffer(), "<f8")
                x = np.column_stack([np.frombuffer(x.as_buffer(), "<f8").reshape(len(y), d - 1), np.ones(len(y))])
                for i, w in enumerate(weights):
                    p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
                    hessian = (x * (p * (1 - p))[:, None]).T @ x
                    totals[i] += np.concatenate([[len(y), y.sum()], x.T @ (p - y), hessian[upper]])
        entries = np.tile(np.arange(totals.shape[1]), len(weights))
        candidates = np.repeat(np.arange(len(weights)), totals.shape[1])
        yield pa.RecordBatch.from_arrays([pa.array(candidates, pa.int32()), pa.array(entries, pa.int32()), pa.array(totals.ravel())], ["candidate", "entry", "total"])

    return add


def derivatives(blocks: DataFrame, weights: Sequence[np.ndarray]) -> list[tuple[float, float, np.ndarray, np.ndarray]]:
    """Per candidate the rows, positive rows, and mean gradient and Hessian of the loss without penalty, from one pass.

    Sums are added by candidate and entry; d * d / 2 numbers a candidate come to the driver, however many rows there are.
    """
    d = len(weights[0])
    with batch_bytes(blocks.sparkSession, BATCH_BYTES):
        summed = blocks.select("x", "y").mapInArrow(_sums(weights), "candidate int, entry int, total double").groupBy("candidate", "entry").agg(F.sum("total").alias("total")).toArrow()
    totals = np.zeros((len(weights), 2 + d + d * (d + 1) // 2))
    totals[summed.column("candidate").to_numpy(), summed.column("entry").to_numpy()] = summed.column("total").to_numpy()
    out = []
    for t in totals:
        n = max(t[0], 1.0)
        hessian = np.zeros((d, d))
        hessian[np.triu_indices(d)] = t[2 + d :] / n
        out.append((t[0], t[1], t[2 : 2 + d] / n, hessian + np.triu(hessian, 1).T))
    return out


@dataclass
class _Run:
    """One candidate on its way: weights where its derivatives are known, and where the next stretch has led."""

    penalty: np.ndarray
    at: np.ndarray
    gradient: np.ndarray
    hessian: np.ndarray
    done: int = 0
    stretch: int = 4
    steps: int = 0
    reached: np.ndarray | None = None
    passes: int = 0

    def walk(self, rate: float, steps: int, bend: Callable[[np.ndarray], np.ndarray] | None = None) -> np.ndarray:
        """Weights after so many steps on the quadratic model, with the change of its Hessian along the way where known."""
        w = self.at
        for _ in range(steps):
            way = w - self.at
            gradient = self.gradient + self.hessian @ way + (bend(way) if bend else 0)
            w = w - rate * (gradient + self.penalty * w)
        return w

    def go(self, rate: float, epochs: int) -> None:
        self.steps = min(self.stretch, epochs - self.done)
        self.reached, self.passes = self.walk(rate, self.steps), self.passes + 1

    def judge(self, gradient: np.ndarray, hessian: np.ndarray, rate: float, tolerance: float) -> None:
        """Correct the stretch by what the derivatives at its end say, and take it unless the correction is large."""
        whole, change = self.reached - self.at, hessian - self.hessian
        # What a Hessian that changes evenly along the way leaves of the gradient at the end.
        rest = gradient - self.gradient - (self.hessian + change / 2) @ whole
        length = max(float(whole @ whole), 1e-300)

        def bend(way: np.ndarray) -> np.ndarray:
            part = float(way @ whole) / length
            return change @ way * (part / 2) + rest * part**3

        corrected = self.walk(rate, self.steps, bend)
        off = np.abs(corrected - self.reached).max()
        # The correction itself grows with the cube of the steps, about.
        fits = min(4.0, 0.9 * (tolerance / max(off, 1e-300)) ** (1 / 3))
        if off > tolerance and self.steps > 1:
            self.stretch = max(1, int(self.steps * min(0.8, fits)))
            return
        self.gradient, self.hessian = gradient + hessian @ (corrected - self.reached), hessian
        self.at, self.done = corrected, self.done + self.steps
        self.stretch = max(1, int(self.steps * fits)) if fits < 1 else max(self.stretch, int(self.steps * fits))


def descend(blocks: DataFrame, penalties: Mapping[str, float], features: int, rate: float, epochs: int, tolerance: float = TOLERANCE) -> dict[str, tuple[np.ndarray, float]]:
    """Weights and intercept of every candidate after ``epochs`` full-batch steps from zero weights.

    The loss is the mean logistic loss plus half the candidate's penalty times
    the squared weights; the intercept is free and starts at the log-odds of the
    label, whose rate is kept within 1e-4 of zero and one. ``blocks`` is read once a
    pass, for all candidates together.
    """
    zero = np.zeros(features + 1)
    n, positive, _, _ = derivatives(blocks, [zero])[0]
    share = min(max(positive / n if n else 0.5, 1e-4), 1 - 1e-4)
    start = np.append(np.zeros(features), np.log(share / (1 - share)))
    _, _, gradient, hessian = derivatives(blocks, [start])[0]
    runs = {name: _Run(np.append(np.full(features, float(l2)), 0.0), start, gradient, hessian) for name, l2 in penalties.items()}
    while pending := [r for r in runs.values() if r.done < epochs]:
        for run in pending:
            run.go(rate, epochs)
        for run, (_, _, gradient, hessian) in zip(pending, derivatives(blocks, [r.reached for r in pending])):
            run.judge(gradient, hessian, rate, tolerance)
    return {name: (r.at[:-1], float(r.at[-1])) for name, r in runs.items()}


def margin_sql(weights: Sequence[float], intercept: float, columns: Sequence[str]) -> str:
    """The margin as an expression over the feature columns."""
    return " + ".join([f"({float(intercept)!r}D)", *[f"({float(w)!r}D * `{c}`)" for w, c in zip(weights, columns)]])
