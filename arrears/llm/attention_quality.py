"""Quality scores by attention-based multiple-instance learning.

A document is a bag of passages, and only the document has a label. Each
passage is described by its content (hashed words and hashed runs of three
characters) and by counts of its words and characters, and encoded by a learned
layer. Gated attention gives the passages weights that add up to one,
and the score is a logistic function of the weighted encoding. All weights are
learned from document labels.
"""

from __future__ import annotations

import operator
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Words in a passage.
PASSAGE = 64
#: Labelled documents that the model is fitted on, their characters together, and those of one, at most.
TRAINING_DOCS, TRAINING_CHARS, LONGEST = 4_000, 16_000_000, 400_000
#: Rounds of fitting, and units of the encoding and of the attention.
ROUNDS, UNITS, GATES = 400, 16, 8

_MARKS = "|#*$%&!?.,;:<>=()[]{}/\\-_\"'@+"
_COUNTS = 12 + len(_MARKS)
#: Buckets of hashed words and of hashed runs of three characters.
WORD_BUCKETS, RUN_BUCKETS = 32, 32
FEATURES = _COUNTS + WORD_BUCKETS + RUN_BUCKETS


def content_features(words: list[str]) -> np.ndarray:
    """Shares of the words, and of the runs of three characters, that fall in each bucket; the spread of even shares as unit."""
    out = np.zeros(WORD_BUCKETS + RUN_BUCKETS)
    if words:
        hashed = [crc32(w.encode("utf-8", "surrogatepass")) % WORD_BUCKETS for w in words]
        out[:WORD_BUCKETS] = np.bincount(hashed, minlength=WORD_BUCKETS) / len(words)
        codes = np.frombuffer(" ".join(words).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
        if len(codes) > 2:
            runs = (codes[:-2] * np.uint64(0x9E3779B1) + codes[1:-1] * np.uint64(0x85EBCA77) + codes[2:] * np.uint64(0xC2B2AE3D)) >> np.uint64(7)
            out[WORD_BUCKETS:] = np.bincount((runs % np.uint64(RUN_BUCKETS)).astype(np.int64), minlength=RUN_BUCKETS) / len(runs)
    return out


def passage_features(words: list[str]) -> list[float]:
    """Counts of one passage; all ratios, so passages of any length compare."""
    n = max(1, len(words))
    text = "".join(words)
    chars = max(1, len(text))
    lengths = list(map(len, words))
    lower = [w.lower() for w in words]
    return [
        min(1.0, n / PASSAGE) if words else 0.0,
        chars / n / 10,
        max(lengths, default=0) / 50,
        sum(x <= 2 for x in lengths) / n,
        sum(map(str.isupper, words)) / n,
        sum(map(str.isalpha, words)) / n,
        len(set(lower)) / n,
        sum(map(operator.eq, lower, lower[1:])) / n,
        sum(map(operator.eq, lower, lower[2:])) / n,
        sum(map(str.isdigit, words)) / n,
        len(set(text)) / chars,
        sum(map(str.istitle, words)) / n,
        *[10 * text.count(m) / chars for m in _MARKS],
    ]


def document_features(text: str) -> np.ndarray:
    """One row for each passage of a whole text; one row of zeros where it has no word."""
    words = text.split()
    passages = [words[i : i + PASSAGE] for i in range(0, len(words), PASSAGE)]
    rows = [np.concatenate([passage_features(p), content_features(list(map(str.lower, p)))]) for p in passages]
    return np.array(rows or [[0.0] * FEATURES], np.float32)


@dataclass(frozen=True)
class Model:
    """Weights of the encoder, the gated attention and the score."""

    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]

    def scores(self, features: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Score of each bag; ``starts`` are the first rows of the bags."""
        return _forward(self.weights, self.prepared(features), starts)["score"]

    def prepared(self, features: np.ndarray) -> np.ndarray:
        return np.clip((features - self.mean) / self.scale, -8, 8)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _forward(w: dict[str, np.ndarray], x: np.ndarray, starts: np.ndarray) -> dict[str, np.ndarray]:
    sizes = np.diff(np.append(starts, len(x)))
    h = np.tanh(x @ w["enc"] + w["enc0"])
    t, g = np.tanh(h @ w["att"]), _sigmoid(h @ w["gate"])
    e = (t * g) @ w["out"]
    top = np.repeat(np.maximum.reduceat(e, starts), sizes)
    p = np.exp(e - top)
    a = p / np.repeat(np.add.reduceat(p, starts), sizes)
    z = np.add.reduceat(a[:, None] * h, starts, axis=0)
    return {"h": h, "t": t, "g": g, "a": a, "z": z, "sizes": sizes, "score": _sigmoid(z @ w["top"] + w["top0"])}


def fit(features: np.ndarray, starts: np.ndarray, labels: np.ndarray, rounds: int = ROUNDS, seed: int = 7) -> Model:
    """Fit by gradient descent with adaptive moments on the cross-entropy of the bags, both classes weighing the same."""
    mean, scale = features.mean(axis=0), features.std(axis=0) + 1e-3
    model = Model(mean, scale, {})
    x, y = model.prepared(features).astype(np.float64), labels.astype(np.float64)
    rng = np.random.default_rng(seed)
    w = {
        "enc": rng.normal(0, 0.3 / np.sqrt(x.shape[1]), (x.shape[1], UNITS)) * 3,
        "enc0": np.zeros(UNITS),
        "att": rng.normal(0, 0.3, (UNITS, GATES)),
        "gate": rng.normal(0, 0.3, (UNITS, GATES)),
        "out": rng.normal(0, 0.3, GATES),
        "top": rng.normal(0, 0.3, UNITS),
        "top0": np.zeros(1),
    }
    share = np.clip(y.mean(), 0.02, 0.98) if len(y) else 0.5
    cost = np.where(y > 0.5, 0.5 / share, 0.5 / (1 - share))
    first, second = {k: np.zeros_like(v) for k, v in w.items()}, {k: np.zeros_like(v) for k, v in w.items()}
    for step in range(1, rounds + 1 if len(y) else 0):
        f = _forward(w, x, starts)
        bag = np.repeat(np.arange(len(starts)), f["sizes"])
        d = cost * (f["score"] - y) / len(y)
        dz = d[:, None] * w["top"]
        pull = (dz[bag] * f["h"]).sum(axis=1)
        mean_pull = np.add.reduceat(f["a"] * pull, starts)
        de = f["a"] * (pull - mean_pull[bag])
        dgate = de[:, None] * w["out"]
        dt, dg = dgate * f["g"] * (1 - f["t"] ** 2), dgate * f["t"] * f["g"] * (1 - f["g"])
        dh = f["a"][:, None] * dz[bag] + dt @ w["att"].T + dg @ w["gate"].T
        dx = dh * (1 - f["h"] ** 2)
        grad = {
            "enc": x.T @ dx,
            "enc0": dx.sum(axis=0),
            "att": f["h"].T @ dt,
            "gate": f["h"].T @ dg,
            "out": (f["t"] * f["g"]).T @ de,
            "top": f["z"].T @ d,
            "top0": d.sum(keepdims=True),
        }
        for k, v in grad.items():
            v = v + 1e-5 * w[k]
            first[k] = 0.9 * first[k] + 0.1 * v
            second[k] = 0.999 * second[k] + 0.001 * v * v
            w[k] -= 0.02 * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return Model(mean, scale, w)


def held_out(doc_id) -> F.Column:
    """Whether a row's label is never learned: crc32 of the id as text divisible by 5; null ids are not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, most: int = TRAINING_DOCS, rounds: int = ROUNDS) -> Model:
    """Model of ``labels.quality`` from ``most`` labelled rows at most, none of them held out.

    The rows are the ones whose ids have the smallest hashes, so that reruns
    agree, as long as their texts together keep to ``TRAINING_CHARS``; texts
    above ``LONGEST`` are not learned from. Only the passage descriptions of these
    whole texts come to the driver, so their bytes are bounded. Null labels and
    ids are left out, a document whose labels disagree counts as 0, and of
    documents with one id the one with the smallest description is learned from.
    Without any row the model scores everything one half.
    """
    usable = labels.where("quality IS NOT NULL AND doc_id IS NOT NULL").where(~held_out(F.col("doc_id")))
    rows = usable.groupBy("doc_id").agg(F.min("quality").alias("quality")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    whole = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("t"))
    # One row for each chosen id, so one task may order them.
    sized = whole.join(F.broadcast(rows), "doc_id").groupBy("doc_id", "quality").agg(F.max(F.char_length("t")).alias("chars")).where(F.col("chars") <= LONGEST)
    upto = Window.orderBy(F.xxhash64("doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    fitting = sized.withColumn("upto", F.sum("chars").over(upto)).where(F.col("upto") <= TRAINING_CHARS).select("doc_id", "quality")
    texts = whole.where(F.char_length("t") <= LONGEST).join(F.broadcast(fitting), "doc_id").select("doc_id", "quality", "t")

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            found = [document_features(t.as_py()).astype("<f4").tobytes() for t in part.column(2)]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(found, pa.binary())], names=["doc_id", "quality", "x"])

    described = texts.mapInArrow(run, "doc_id long, quality int, x binary")
    # One row an id, so that rows that repeat an id add nothing to what the driver gets.
    one = described.groupBy("doc_id", "quality").agg(F.min("x").alias("x"))
    got = one.toArrow().sort_by([("doc_id", "ascending")])
    bags = [np.frombuffer(x, "<f4").reshape(-1, FEATURES) for x in got.column("x").to_pylist()]
    features = np.concatenate(bags) if bags else np.zeros((0, FEATURES), np.float32)
    sizes = np.array([len(b) for b in bags], np.int64)
    if not len(bags):
        zeros = {"enc": np.zeros((FEATURES, UNITS)), "enc0": np.zeros(UNITS), "att": np.zeros((UNITS, GATES)), "gate": np.zeros((UNITS, GATES))}
        return Model(np.zeros(FEATURES), np.ones(FEATURES), zeros | {"out": np.zeros(GATES), "top": np.zeros(UNITS), "top0": np.zeros(1)})
    return fit(features, np.cumsum(sizes) - sizes, np.array(got.column("quality").to_pylist()), rounds)


def score(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of every row of ``docs``.

    Only the text enters a score. A null or empty text is a bag of one passage
    without words; repeated rows get equal scores; an empty table gives an empty
    one. Columns other than ``doc_id`` and ``text`` are not used.
    """
    frame = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), F.coalesce("text", F.lit("")).alias("t"))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for i in range(0, part.num_rows, 512):
                piece = part.slice(i, 512)
                bags = [document_features(t.as_py()) for t in piece.column(2)]
                sizes = np.array([len(b) for b in bags])
                found = model.scores(np.concatenate(bags), np.cumsum(sizes) - sizes)
                verdict = pa.array((found >= threshold).astype(np.int32))
                yield pa.RecordBatch.from_arrays([piece.column(0), piece.column(1), pa.array(found.astype(np.float64)), verdict], names=["doc_id", "held_out", "score", "predicted"])

    return frame.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
