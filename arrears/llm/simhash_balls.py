"""SimHash near duplicates by meet-in-the-middle ball hashing.

Every fingerprint emits the fingerprints within half the radius (its variants).
Two fingerprints within the radius have a variant in common. The radius being
odd (2h + 1), half of it is h for one of the two and h + 1 for the other.
Fingerprints at an odd distance differ in the parity of their bits, those at an
even distance do not and need h only; so just the fingerprints of odd parity
emit the larger ball. Of 2h + 1 differing bits, h + 1 lie in one half of the
word, so the variants at h + 1 whose flipped bits all lie in one half suffice.
For radius 3 that makes 65 variants, and 992 more for odd parity.

Variants go to buckets by a map that is linear over exclusive or:
``bucket(x ^ m) == bucket(x) ^ bucket(m)``. A bucket therefore knows which flips
led a fingerprint to it, and the shuffle carries each fingerprint once for every
bucket that holds one of its variants instead of once for every variant.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrears.llm.common import materialise, text_key
from arrears.llm.components import components

BITS = 64
SEED = 42
#: Variants that one bucket holds on average.
BUCKET_VARIANTS = 3_000_000
#: Fingerprints whose buckets are worked out at once.
CHUNK = 2_048

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def fingerprint(text: str, shingle: int = 3) -> int:
    """SimHash of a text over shingles of that many words, repeats included; zero without words."""
    words = text.encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    grams = zip(*(words[i:] for i in range(shingle))) if len(words) >= shingle else [words]
    hashes = np.array([digest(b" ".join(g), SEED) for g in grams], "<u8")
    ones = np.zeros(BITS, np.int64)
    for i in range(0, len(hashes), 1 << 16):
        part = hashes[i : i + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, shingle: int = 3, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``text_key`` and ``fp`` (the fingerprint as a signed long) of every row; a null text has no words."""
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    frame = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), text_key(F.col(f"`{text}`")).alias("text_key"), whole.alias("t"))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            found = np.array([fingerprint(t, shingle) for t in part.column(2).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(found.view(np.int64))], names=["doc_id", "text_key", "fp"])

    return frame.mapInArrow(run, "doc_id long, text_key long, fp long")


def flips(radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Masks that every fingerprint emits, and those that only odd parity adds."""

    def weight(bits, n):
        return [sum(1 << b for b in chosen) for chosen in combinations(bits, n)]

    h = radius // 2
    every = [m for n in range(h + 1) for m in weight(range(BITS), n)]
    odd = [m for half in (range(BITS // 2), range(BITS // 2, BITS)) for m in weight(half, h + 1)] if radius % 2 else []
    return np.array(every, np.uint64), np.array(odd, np.uint64)


class Buckets:
    """The linear map from variants to ``2 ** bits`` buckets, and the flips behind each difference of buckets."""

    def __init__(self, bits: int, radius: int):
        rng = np.random.default_rng(SEED)
        columns = rng.integers(0, 1 << bits, BITS, dtype=np.uint64)
        self._tables = np.zeros((8, 256), np.uint64)
        for byte in range(8):
            for value in range(256):
                for bit in range(8):
                    if value >> bit & 1:
                        self._tables[byte, value] ^= columns[8 * byte + bit]
        self.every, odd = flips(radius)
        self.all = np.concatenate([self.every, odd])
        moves = self.of(self.all)
        self._order = np.argsort(moves, kind="stable")
        self._sorted = moves[self._order]
        self.moves_every = np.unique(moves[: len(self.every)])
        self.moves_all = np.unique(moves)

    def of(self, values: np.ndarray) -> np.ndarray:
        parts = np.ascontiguousarray(values).view(np.uint8).reshape(-1, 8)
        out = np.zeros(len(values), np.uint64)
        for byte in range(8):
            out ^= self._tables[byte, parts[:, byte]]
        return out

    def variants(self, fps: np.ndarray, bucket: int) -> tuple[np.ndarray, np.ndarray]:
        """All variants of ``fps`` that lie in ``bucket``, each with the place of its fingerprint."""
        moves = self.of(fps) ^ np.uint64(bucket)
        low, high = np.searchsorted(self._sorted, moves, "left"), np.searchsorted(self._sorted, moves, "right")
        counts = high - low
        owner = np.repeat(np.arange(len(fps)), counts)
        offset = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
        which = self._order[np.repeat(low, counts) + offset]
        held = (which < len(self.every)) | odd_parity(fps)[owner]
        owner, which = owner[held], which[held]
        return fps[owner] ^ self.all[which], owner


def odd_parity(fps: np.ndarray) -> np.ndarray:
    return (np.bitwise_count(fps) & 1).astype(bool)


def close_pairs(variants: np.ndarray, owner: np.ndarray, fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of fingerprints that share a variant and differ in ``radius`` bits at most, each pair once."""
    order = np.argsort(variants, kind="stable")
    variants, owner = variants[order], owner[order]
    shared = np.flatnonzero(variants[1:] == variants[:-1])
    found = [np.empty(0, np.int64)]
    step, n = 1, len(fps)
    while len(shared):
        a, b = owner[shared], owner[shared + step]
        near = np.bitwise_count(fps[a] ^ fps[b]) <= radius
        found.append(np.unique(np.minimum(a[near], b[near]) * n + np.maximum(a[near], b[near])))
        step += 1
        shared = shared[shared + step < len(variants)]
        shared = shared[variants[shared] == variants[shared + step]]
    pairs = np.unique(np.concatenate(found))
    return pairs // n, pairs % n


def hang(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest place that each of ``n`` places reaches over the links ``a``-``b``."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


def links(distinct: DataFrame, radius: int = 3, fp: str = "fp") -> DataFrame:
    """Edges ``a``, ``b`` that connect all fingerprints within ``radius`` bits of each other.

    ``distinct`` has every fingerprint once. Each bucket finds and verifies all
    its close pairs and gives a spanning forest of them, so that a dense group
    of g fingerprints gives g edges a bucket and not all pairs.
    """
    rows = distinct.count()
    every, odd = flips(radius)
    per = len(every) + len(odd) / 2
    bits = max(1, int(np.ceil(np.log2(max(2, rows * per / BUCKET_VARIANTS)))))

    def deal(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets = Buckets(bits, radius)
        for part in parts:
            whole = part.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for i in range(0, len(whole), CHUNK):
                fps = whole[i : i + CHUNK]
                places, values = [], []
                odd_ones = odd_parity(fps)
                for chosen, moves in ((fps[~odd_ones], buckets.moves_every), (fps[odd_ones], buckets.moves_all)):
                    places.append((buckets.of(chosen)[:, None] ^ moves[None, :]).ravel())
                    values.append(np.repeat(chosen, len(moves)))
                place, value = np.concatenate(places), np.concatenate(values)
                order = np.argsort(place, kind="stable")
                place, value = place[order], value[order]
                starts = np.flatnonzero(np.append(True, place[1:] != place[:-1])) if len(place) else np.empty(0, int)
                stops = np.append(starts[1:], len(place))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(place[starts].astype(np.int32), pa.int32()),
                        pa.array([value[s:e].tobytes() for s, e in zip(starts.tolist(), stops.tolist())], pa.binary()),
                    ],
                    names=["bucket", "fps"],
                )

    def meet(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        fps = np.frombuffer(b"".join(table.column("fps").to_pylist()), np.uint64)
        variants, owner = Buckets(bits, radius).variants(fps, bucket)
        a, b = close_pairs(variants, owner, fps, radius)
        root = hang(a, b, len(fps))
        linked = np.flatnonzero(root != np.arange(len(fps)))
        return pa.table({"a": pa.array(fps[linked].view(np.int64)), "b": pa.array(fps[root[linked]].view(np.int64))})

    dealt = distinct.select(F.col(fp).alias("fp")).mapInArrow(deal, "bucket int, fps binary")
    return dealt.groupBy("bucket").applyInArrow(meet, "a long, b long")


def near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 3, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Groups of rows whose fingerprints are linked at ``radius`` or fewer differing bits.

    One row for each row of ``docs``: ``doc_id``, ``fingerprint`` (16 hex digits),
    ``component_id`` (smallest doc_id reachable, its own included), ``fp``,
    ``text_key`` and ``component`` (smallest ``fp`` reachable, which tells groups
    apart where ids repeat or are null). Rows without words have fingerprint zero
    and are linked like any other. Equal fingerprints are one node, so copies
    cost no pairs. Rows without doc_id are linked too; a group with no doc_id at
    all has a null component_id. An empty table gives an empty one; other columns are ignored.
    """
    rows = materialise(fingerprints(docs, shingle, doc_id, text), "fingerprints")
    distinct = materialise(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct_fingerprints")
    edges = links(distinct.select("fp"), radius)
    found = materialise(components(edges), "components")
    labelled = distinct.join(found, distinct.fp == found.node, "left").select("fp", "least", F.coalesce("component", "fp").alias("component"))
    least = labelled.groupBy("component").agg(F.min("least").alias("component_id"))
    named = labelled.join(least, "component").select("fp", "component_id", "component")
    return rows.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "fp", "text_key", "component")


def keep_one(docs: DataFrame, shingle: int = 3, radius: int = 3) -> DataFrame:
    """``docs`` with one row of each group: the smallest doc_id, of equal ones the smallest text key.

    A group without any doc_id keeps one row in the same way. All columns stay,
    whatever their names. Null and empty texts are alike; an empty table gives
    an empty one.
    """
    groups = near_duplicates(docs.select("doc_id", "text"), shingle, radius)
    own = groups.where("doc_id <=> component_id")
    chosen = own.groupBy("component").agg(F.min("component_id").alias("id"), F.min("text_key").alias("chosen"))
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole")
    keyed = docs.select(whole, F.col("`doc_id`").alias("of"), text_key(F.col("`text`")).alias("key"))
    kept = keyed.join(chosen, F.expr("of <=> id AND key = chosen"), "left_semi")
    return kept.dropDuplicates(["of", "key"]).select("whole.*")
