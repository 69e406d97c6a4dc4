"""Removal of repeated byte strings by sorting suffixes, shallow then deep.

A byte is removed when a string of ``length`` bytes that covers it also starts
earlier. All windows of that length are suffixes cut to it; equal windows stand
side by side in the sorted order, and of each run of equal ones only the
earliest stays.

Sorting every suffix of a corpus in one place is out of the question, so the
windows are first dealt into groups that equal windows cannot leave: the window
goes with its smallest hashed 24-byte string (its anchor, one in about 39
bytes). Anchors are exchanged as hashes, and most occur once. An anchor with
its whole surroundings that has been seen earlier is a copy as a whole. Only
where one anchor has different surroundings are their bytes fetched, and there
the windows are sorted: multikey quicksort by words to a shallow depth, then
the groups that remain, whose members share a long prefix, by blind tries.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrears.llm.common import materialise, shuffle_partitions

GRAM = 24
#: Bytes up to which windows are sorted by multikey quicksort.
SHALLOW = 24
#: Anchors that one bucket holds on average.
BUCKET_ANCHORS = 1_000_000
#: Different surroundings of one anchor above which its windows are told apart
#: by their hashes, so that they spread over all buckets.
HOT = 2_000
#: Bytes hashed at once, bytes whose anchors are combined before the shuffle,
#: and surroundings whose windows are sorted at once.
HASHED_BYTES, COMBINED_BYTES, SORTED_PLACES = 1 << 19, 1 << 23, 2_000

_PRIMES = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


def _mix(x: np.ndarray, prime: int) -> np.ndarray:
    x = x * _PRIMES[prime]
    x ^= x >> np.uint64(29)
    return x


def _words(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on as one integer; zeros follow the end."""
    x = np.zeros(len(data) + 7, np.uint64)
    x[: len(data)] = data
    x = x[:-1] | x[1:] << np.uint64(8)
    x = x[:-2] | x[2:] << np.uint64(16)
    return x[:-4] | x[4:] << np.uint64(32)


def _smallest(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbours."""
    reach = 1
    while 2 * reach <= width:
        x = np.minimum(x[:-reach], x[reach:])
        reach *= 2
    return np.minimum(x[: len(x) - (width - reach)], x[width - reach :]) if width > reach else x


def _digest(words: np.ndarray, start: np.ndarray, size: np.ndarray, prime: int) -> np.ndarray:
    """64-bit hash of ``size`` bytes (eight at least) from each ``start``."""
    out = size.astype(np.uint64)
    for j in range(int(size.max(initial=0)) // 8):
        more = 8 * j + 8 <= size
        out = np.where(more, _mix(out ^ words[np.where(more, start + 8 * j, 0)], prime), out)
    return _mix(out ^ words[start + size - 8], (prime + 1) % 4)


def anchors(data: np.ndarray, offsets: np.ndarray, sizes: np.ndarray, length: int) -> dict[str, np.ndarray]:
    """Anchors of documents laid end to end.

    ``key`` and ``ctx`` hash the anchor and the bytes of all its windows; ``lo``
    and ``hi`` are its first and last window, ``at`` its place, ``doc`` its document.
    """
    words = _words(data)
    n = len(data)
    valid = np.ones(n, bool)
    for a, size in zip(offsets.tolist(), sizes.tolist()):
        valid[max(a, a + size - length + 1) : a + size] = False
    starts = np.flatnonzero(valid)
    if not len(starts):
        return {k: np.empty(0, np.int64) for k in ("lo", "hi", "at", "doc")} | {k: np.empty(0, np.uint64) for k in ("key", "ctx")}
    h = _mix(words[: n - GRAM + 1], 0)
    for i, step in enumerate(range(8, GRAM, 8)):
        h = _mix(h ^ words[step : n - GRAM + 1 + step], i + 1)
    ranked = h & np.uint64(0xFFFFFFFF00000000) | np.arange(len(h), dtype=np.uint64)
    at = (_smallest(ranked, length - GRAM + 1)[starts] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
    last = np.append(first[1:], len(at)) - 1
    lo, hi, at = starts[first], starts[last], at[first]
    return {
        "key": h[at],
        "ctx": _digest(words, lo, hi - lo + length, 1) ^ _mix((at - lo).astype(np.uint64), 2),
        "lo": lo,
        "hi": hi,
        "at": at,
        "doc": np.searchsorted(offsets, lo, "right") - 1,
    }


def first_of(*keys: np.ndarray, by: tuple[np.ndarray, ...]) -> np.ndarray:
    """For each row, whether it is the first by ``by`` among those with equal ``keys``."""
    order = np.lexsort((*by[::-1], *keys))
    differs = np.zeros(len(order), bool)
    differs[:1] = True
    for k in keys:
        differs[1:] |= k[order][1:] != k[order][:-1]
    out = np.empty(len(order), bool)
    out[order] = differs
    return out


def joined_runs(doc: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of window starts with those put together that touch, per document."""
    if not len(doc):
        return doc, lo, hi
    order = np.lexsort((lo, doc))
    doc, lo, hi = doc[order], lo[order].astype(np.int64), hi[order].astype(np.int64)
    far = np.cumsum(np.append(False, doc[1:] != doc[:-1])) << 40
    new = np.append(True, (lo + far)[1:] > np.maximum.accumulate(hi + far)[:-1] + 1)
    start = np.flatnonzero(new)
    return doc[start], lo[start], np.maximum.reduceat(hi, start)


def _packed(bucket: np.ndarray, columns: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
    """One row a bucket, each column's values of the bucket as bytes."""
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    start = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(bucket) else np.empty(0, int)
    stop = np.append(start[1:], len(bucket))
    arrays = [pa.array(bucket[start].astype(np.int32), pa.int32())]
    for values in columns.values():
        values = np.ascontiguousarray(values[order])
        arrays.append(pa.array([values[a:b].tobytes() for a, b in zip(start.tolist(), stop.tolist())], pa.binary()))
    yield pa.RecordBatch.from_arrays(arrays, names=["bucket", *columns])


def _unpacked(table: pa.Table, kinds: dict[str, str]) -> dict[str, np.ndarray]:
    return {name: np.frombuffer(b"".join(table.column(name).to_pylist()), kind) for name, kind in kinds.items()}


#: Columns of the exchanges. An anchor or window names its document by order (doc_id) and uid.
_ANCHOR = {"key": "<u4", "ctx": "<u8", "ord": "<i8", "uid": "<i8", "lo": "<u4", "span": "u1", "off": "u1"}
_PLACE = {"key": "<u8", "ord": "<i8", "uid": "<i8", "lo": "<u4", "span": "u1", "off": "u1", "bytes": "u1"}
_WINDOW = {"a": "<u8", "b": "<u8", "ord": "<i8", "uid": "<i8", "lo": "<u4"}


def _binary(kinds: dict[str, str]) -> str:
    return "bucket int, " + ", ".join(f"{k} binary" for k in kinds)


def _order(doc_ids: list[int | None]) -> np.ndarray:
    return np.array([-(1 << 63) if d is None else d for d in doc_ids], np.int64)


def _texts(parts: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[bytes]]]:
    """Rows and texts of about ``COMBINED_BYTES`` at a time."""
    reader, held, texts, size = zstandard.ZstdDecompressor(), [], [], 0
    for part in parts:
        for row in zip(*(c.to_pylist() for c in part.columns[:-1]), part.column(part.num_columns - 1)):
            text = reader.decompress(row[-1].as_py())
            if size and size + len(text) > COMBINED_BYTES:
                yield held, texts
                held, texts, size = [], [], 0
            held.append(row[:-1])
            texts.append(text)
            size += len(text)
    if texts:
        yield held, texts


def _laid(texts: list[bytes], limit: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Texts end to end, about ``limit`` bytes at a time: first text, bytes, offsets, sizes."""
    i = 0
    while i < len(texts):
        j, size = i, 0
        while j < len(texts) and (j == i or size + len(texts[j]) <= limit):
            size += len(texts[j])
            j += 1
        sizes = np.array([len(t) for t in texts[i:j]], np.int64)
        # Empty texts hold no window; their offset equals that of the next.
        yield i, np.frombuffer(b"".join(texts[i:j]), np.uint8), np.cumsum(sizes) - sizes, sizes
        i = j


def repeats_of(strings: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Class of each row of ``strings`` (bytes, one row a string): equal rows of a group get the same number.

    Shallow part: groups are split by eight bytes at a time, as multikey
    quicksort splits by characters; a group of one is done. Deep part: each
    remaining group grows a blind trie. Its first member is a path from the root
    to a leaf; every other member leaves that path at the length of the common
    prefix, with the byte that follows, and those that leave at the same branch
    form the group of that subtree. Members that never leave are equal to it.
    """
    n, length = strings.shape
    out = np.full(n, -1, np.int64)
    rows, group = np.arange(n), np.unique(group, return_inverse=True)[1] if n else group
    depth, named = 0, 0

    def alone(rows: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Name groups of one; what remains is sorted by group."""
        nonlocal named
        count = np.bincount(group)
        single = count[group] == 1
        out[rows[single]] = named + np.arange(single.sum())
        named += int(single.sum())
        rows, group = rows[~single], group[~single]
        order = np.argsort(group, kind="stable")
        return rows[order], group[order]

    rows, group = alone(rows, group) if n else (rows, group)
    while len(rows) and depth + 8 <= min(SHALLOW, length):
        word = np.ascontiguousarray(strings[rows, depth : depth + 8]).view(">u8")[:, 0]
        order = np.lexsort((word, group))
        rows, group, word = rows[order], group[order], word[order]
        group = np.cumsum(np.append(False, (group[1:] != group[:-1]) | (word[1:] != word[:-1])))
        rows, group = alone(rows, group)
        depth += 8
    while len(rows):
        start = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
        which = np.cumsum(np.append(False, group[1:] != group[:-1]))
        path = rows[start][which]
        differ = strings[rows, depth:] != strings[path, depth:]
        leaves = differ.any(axis=1)
        out[rows[~leaves]] = named + which[~leaves]
        named += len(start)
        rows, which = rows[leaves], which[leaves]
        if not len(rows):
            break
        prefix = differ[leaves].argmax(axis=1) + depth
        code = (which * (length + 1) + prefix) * 256 + strings[rows, prefix]
        rows, group = alone(rows, np.unique(code, return_inverse=True)[1])
    return out


def stored(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` as a table in the shared folder: ``uid`` (the row), ``doc_id``, ``z`` (compressed UTF-8)."""
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    frame = docs.select(F.monotonically_increasing_id().alias("uid"), F.col(f"`{doc_id}`").cast("long").alias("doc_id"), whole.alias("t"))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = zstandard.ZstdCompressor(level=6)
        for part in parts:
            packed = [writer.compress(t.as_py().encode("utf-8", "surrogatepass")) for t in part.column(2)]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(packed, pa.binary())], names=["uid", "doc_id", "z"])

    return materialise(frame.mapInArrow(run, "uid long, doc_id long, z binary"), "stored_texts")


def repeated_runs(table: DataFrame, length: int = 100) -> DataFrame:
    """``uid``, ``lo``, ``hi``: runs of window starts whose window also starts earlier.

    ``table`` comes from ``stored``. Earlier means a smaller doc_id (null first),
    then an earlier row of the table, then an earlier start.
    """
    if not GRAM <= length <= 255:
        raise ValueError(f"length must be between {GRAM} and 255")
    spark = table.sparkSession
    total = table.agg(F.sum(F.length("z"))).first()[0] or 0
    # Texts are compressed to about a third, and one byte in 39 is an anchor.
    buckets = max(shuffle_partitions(spark), round(total * 3 / 39 / BUCKET_ANCHORS))

    def deal(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in _texts(parts):
            order = np.lexsort(([r[0] for r in rows], _order([r[1] for r in rows])))
            rows, texts = [rows[i] for i in order], [texts[i] for i in order]
            found: dict[str, list[np.ndarray]] = {k: [] for k in ("key", "ctx", "lo", "hi", "at", "doc")}
            for first, data, offsets, sizes in _laid(texts, HASHED_BYTES):
                if len(data) < length:
                    continue
                part = anchors(data, offsets, sizes, length)
                base = offsets[part["doc"]]
                for k in ("lo", "hi", "at"):
                    part[k] = part[k] - base
                part["doc"] = part["doc"] + first
                for k, v in part.items():
                    found[k].append(v)
            if not found["key"]:
                continue
            x = {k: np.concatenate(v) for k, v in found.items()}
            uid, ordinal = np.array([r[0] for r in rows], np.int64), _order([r[1] for r in rows])
            lead = first_of(x["ctx"], x["key"], by=(x["doc"], x["lo"]))
            # Copies within these texts are settled here and travel as runs, in the bucket of their document.
            doc, lo, hi = joined_runs(x["doc"][~lead], x["lo"][~lead], x["hi"][~lead])
            bucket = (x["key"] % np.uint64(buckets)).astype(np.int64)[lead]
            yield from _packed(
                bucket,
                {
                    "key": (x["key"][lead] >> np.uint64(32)).astype("<u4"),
                    "ctx": x["ctx"][lead],
                    "ord": ordinal[x["doc"][lead]],
                    "uid": uid[x["doc"][lead]],
                    "lo": x["lo"][lead].astype("<u4"),
                    "span": (x["hi"] - x["lo"])[lead].astype(np.uint8),
                    "off": (x["at"] - x["lo"])[lead].astype(np.uint8),
                    **{k: np.empty(int(lead.sum()), "V0") for k in ("run_uid", "run_lo", "run_hi")},
                },
            )
            if len(doc):
                empty = {k: np.empty(len(doc), "V0") for k in _ANCHOR}
                yield from _packed(uid[doc] % buckets, {**empty, "run_uid": uid[doc], "run_lo": lo.astype("<u4"), "run_hi": hi.astype("<u4")})

    runs = {"run_uid": "<i8", "run_lo": "<u4", "run_hi": "<u4"}
    found = "uid long, ord long, key long, lo int, hi int, off int, kind int"

    def compare(packed: pa.Table) -> pa.Table:
        """Runs that are settled (kind 0), and places whose windows have to be compared (1, of hot anchors 2)."""
        x, r = _unpacked(packed, _ANCHOR), _unpacked(packed, runs)
        bucket = packed.column("bucket")[0].as_py()
        lead = first_of(x["ctx"], x["key"], by=(x["ord"], x["uid"], x["lo"]))
        key = x["key"].astype(np.int64)
        names, which, count = np.unique(key[lead], return_inverse=True, return_counts=True)
        several = count[which] > 1
        place = np.flatnonzero(lead)[several]
        kind = np.where(count[which][several] > HOT, 2, 1)
        copy = ~lead
        n_copy, n_run, n_place = int(copy.sum()), len(r["run_uid"]), len(place)
        lo = x["lo"].astype(np.int64)
        hi = lo + x["span"]
        return pa.table(
            {
                "uid": np.concatenate([x["uid"][copy], r["run_uid"], x["uid"][place]]),
                "ord": np.concatenate([np.zeros(n_copy + n_run, np.int64), x["ord"][place]]),
                "key": np.concatenate([np.zeros(n_copy + n_run, np.int64), key[place] * buckets + bucket]),
                "lo": np.concatenate([lo[copy], r["run_lo"].astype(np.int64), lo[place]]).astype(np.int32),
                "hi": np.concatenate([hi[copy], r["run_hi"].astype(np.int64), hi[place]]).astype(np.int32),
                "off": np.concatenate([np.zeros(n_copy + n_run, np.int32), x["off"][place].astype(np.int32)]),
                "kind": np.concatenate([np.zeros(n_copy + n_run, np.int32), kind.astype(np.int32)]),
            }
        )

    dealt = table.select("uid", "doc_id", "z").mapInArrow(deal, _binary(_ANCHOR | runs))
    first = materialise(dealt.groupBy("bucket").applyInArrow(compare, found), "repeats_first")

    def fetch(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in _texts(parts):
            places = [np.array([(p["key"], p["lo"], p["hi"], p["off"], p["kind"]) for p in r[2]], np.int64).reshape(-1, 5) for r in rows]
            doc = np.repeat(np.arange(len(rows)), [len(p) for p in places])
            key, lo, hi, off, kind = np.concatenate(places).T
            uid, ordinal = np.array([r[0] for r in rows], np.int64)[doc], _order([r[1] for r in rows])[doc]
            sizes = np.array([len(t) for t in texts], np.int64)
            data, base = np.frombuffer(b"".join(texts), np.uint8), (np.cumsum(sizes) - sizes)[doc]
            normal = np.flatnonzero(kind == 1)
            if len(normal):
                bucket = key[normal] % buckets
                order = np.argsort(bucket, kind="stable")
                normal, bucket = normal[order], bucket[order]
                start = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
                batch = []
                for rows_of in np.split(normal, start[1:]):
                    part = {
                        "bucket": int(key[rows_of[0]] % buckets),
                        "key": key[rows_of].tobytes(),
                        "ord": ordinal[rows_of].tobytes(),
                        "uid": uid[rows_of].tobytes(),
                        "lo": lo[rows_of].astype("<u4").tobytes(),
                        "span": (hi - lo)[rows_of].astype(np.uint8).tobytes(),
                        "off": off[rows_of].astype(np.uint8).tobytes(),
                        "bytes": b"".join(data[a:b].tobytes() for a, b in zip((base + lo)[rows_of].tolist(), (base + hi + length)[rows_of].tolist())),
                    }
                    batch.append(part | {k: b"" for k in (*_WINDOW, *runs) if k not in part})
                yield pa.RecordBatch.from_pylist(batch, schema=fetched)
            hot = np.flatnonzero(kind == 2)
            if len(hot):
                words = _words(data)
                count = (hi - lo)[hot] + 1
                own = np.repeat(hot, count)
                at = lo[own] + np.arange(len(own)) - np.repeat(np.cumsum(count) - count, count)
                start, size = base[own] + at, np.full(len(own), length, np.int64)
                a, b = _digest(words, start, size, 0), _digest(words, start, size, 2)
                lead = first_of(b, a, by=(ordinal[own], uid[own], at))
                d, low, high = joined_runs(doc[own][~lead], at[~lead], at[~lead])
                columns = {k: np.empty(int(lead.sum()), "V0") for k in kinds if k not in _WINDOW}
                window = {"a": a[lead], "b": b[lead], "ord": ordinal[own][lead], "uid": uid[own][lead], "lo": at[lead].astype("<u4")}
                yield from _ordered(_packed((a[lead] % np.uint64(buckets)).astype(np.int64), columns | window), fetched)
                if len(d):
                    uids = np.array([r[0] for r in rows], np.int64)[d]
                    columns = {k: np.empty(len(d), "V0") for k in kinds if k not in runs}
                    run = {"run_uid": uids, "run_lo": low.astype("<u4"), "run_hi": high.astype("<u4")}
                    yield from _ordered(_packed(uids % buckets, columns | run), fetched)

    def settle(packed: pa.Table) -> pa.Table:
        out = [(np.empty(0, np.int64),) * 3]
        if any(packed.column("bytes").to_pylist()):
            rows = packed.filter(pa.compute.greater(pa.compute.binary_length(packed.column("bytes")), 0))
            out.append(_sorted_runs(_unpacked(rows, _PLACE), length))
        rows = packed.filter(pa.compute.greater(pa.compute.binary_length(packed.column("a")), 0))
        if rows.num_rows:
            x = _unpacked(rows, _WINDOW)
            copy = ~first_of(x["b"], x["a"], by=(x["ord"], x["uid"], x["lo"]))
            out.append(joined_runs(*(x[k][copy].astype(np.int64) for k in ("uid", "lo", "lo"))))
        r = _unpacked(packed, runs)
        out.append(tuple(r[k].astype(np.int64) for k in runs))
        uid, lo, hi = (np.concatenate(c) for c in zip(*out))
        return pa.table({"uid": uid, "lo": lo.astype(np.int32), "hi": hi.astype(np.int32)})

    kinds = _PLACE | {k: v for k, v in _WINDOW.items() if k not in _PLACE} | runs
    fetched = pa.schema([("bucket", pa.int32()), *[(k, pa.binary()) for k in kinds]])
    places = first.where("kind > 0").groupBy("uid").agg(F.collect_list(F.struct("key", "lo", "hi", "off", "kind")).alias("places"))
    joined = table.join(places, "uid").select("uid", "doc_id", "places", "z")
    second = joined.mapInArrow(fetch, _binary(kinds)).groupBy("bucket").applyInArrow(settle, "uid long, lo int, hi int")
    return first.where("kind = 0").select("uid", "lo", "hi").union(second)


def _ordered(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield batch.select(schema.names)


def _sorted_runs(x: dict[str, np.ndarray], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with an earlier equal one, among places that share anchors."""
    size = x["span"].astype(np.int64) + length
    base = np.cumsum(size) - size
    order = np.argsort(x["key"], kind="stable")
    edges = np.flatnonzero(np.append(True, x["key"][order][1:] != x["key"][order][:-1]))
    stops = np.append(edges[1:], len(order))
    out, start = [(np.empty(0, np.int64),) * 3], 0
    for stop, following in zip(stops.tolist(), [*stops[1:].tolist(), 1 << 62]):
        if following - start <= SORTED_PLACES and stop != len(order):
            continue
        rows = order[start:stop]
        start = stop
        count = x["span"][rows].astype(np.int64) + 1
        own = np.repeat(rows, count)
        step = np.arange(len(own)) - np.repeat(np.cumsum(count) - count, count)
        # Equal windows have the anchor at the same distance, so only those are compared.
        group = x["key"][own] * np.uint64(256) + (x["off"][own] - step).astype(np.uint8)
        windows = np.lib.stride_tricks.sliding_window_view(x["bytes"], length)[base[own] + step]
        name = repeats_of(windows, group)
        at = x["lo"][own].astype(np.int64) + step
        copy = ~first_of(name, by=(x["ord"][own], x["uid"][own], at))
        out.append(joined_runs(x["uid"][own][copy], at[copy], at[copy]))
    return tuple(np.concatenate(c) for c in zip(*out))


def remove_repeats(docs: DataFrame, length: int = 100, doc_id: str = "doc_id", text: str = "text", keep_bytes: bool = False) -> DataFrame:
    """What stays of every whole text when repeated strings of ``length`` bytes are removed.

    One row for each row of ``docs``: ``doc_id``, ``n_bytes``, ``n_removed``,
    ``n_spans`` (maximal removed runs), ``kept_sha256`` and, with ``keep_bytes``,
    ``kept``. Removal works on UTF-8 bytes and may cut a character. A null text
    is empty; texts shorter than ``length`` lose nothing; null doc_ids come
    first, and rows of equal doc_id are judged in the order in which the table
    gives them, so that of repeated rows the first stays whole. An empty table
    gives an empty one; other columns are not used.
    """
    table = stored(docs, doc_id, text)
    runs = repeated_runs(table, length).groupBy("uid").agg(F.collect_list(F.struct("lo", "hi")).alias("runs"))
    joined = table.join(runs, "uid", "left").select("doc_id", "runs", "z")
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept binary" if keep_bytes else "")

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = zstandard.ZstdDecompressor()
        for part in parts:
            out: list[tuple] = []
            for found, z in zip(part.column(1), part.column(2)):
                data = np.frombuffer(reader.decompress(z.as_py()), np.uint8)
                if not found.is_valid:
                    out.append((len(data), 0, 0, hashlib.sha256(data).hexdigest(), data.tobytes()))
                    continue
                low = found.values.field("lo").to_numpy()
                high = found.values.field("hi").to_numpy().astype(np.int64) + length
                depth = np.zeros(len(data) + 1, np.int64)
                np.add.at(depth, low, 1)
                np.add.at(depth, high, -1)
                gone = np.cumsum(depth)[:-1] > 0
                kept = data[~gone].tobytes()
                spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
                out.append((len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(), kept))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), *([pa.binary()] if keep_bytes else []))
            columns = [pa.array([row[i] for row in out], kind) for i, kind in enumerate(kinds)]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", *(["kept"] if keep_bytes else [])]
            yield pa.RecordBatch.from_arrays([part.column(0), *columns], names=names)

    return joined.mapInArrow(run, schema)
