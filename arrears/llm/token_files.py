"""Token ids in patched frame-of-reference blocks.

A segment is the byte string of one token file:

====================  =====================================================
magic                 ``PFR1``
counts                ids, documents, blocks, packed words, exceptions
                      (five unsigned 64-bit integers)
smallest              one unsigned 32-bit integer a block, subtracted
width                 one byte a block, bits that each value is packed with
start                 one unsigned 32-bit integer a block: its first word
exceptions before     one unsigned 32-bit integer a block
exception places      one byte each, position in the block
exception values      one unsigned 32-bit integer each, the whole difference
words                 unsigned 64-bit integers, the packed values
document ids          one signed 64-bit integer each, then a byte each: 0 null
document lengths      one unsigned 32-bit integer each, end id included
====================  =====================================================

All integers are little-endian. Blocks hold 256 ids, the last one fewer. The
width of a block is that of the 90th percentile of its differences; what does
not fit is kept in the exception list. The block starts let a reader open any
range of ids without unpacking the rest.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from arrears.llm.common import scratch_path, text_key
from arrears.llm.pieces import LATIN, PieceEncoder, is_word, slices

MAGIC = b"PFR1"
BLOCK = 256
#: Share of a block's values that its width has to hold.
FITTING = 0.9
#: Ids after which a segment is closed at the next document.
SEGMENT_IDS = 1_000_000

#: Pieces that a worker remembers; about 200 bytes each.
REMEMBERED = 1_000_000
#: Pieces handed to the library as one text.
JOINED = 200
#: Bytes of text whose pieces are told apart at once.
SLICE_BYTES = 8_000_000

_HEAD = struct.Struct("<4s5Q")


def _bits(values: np.ndarray) -> np.ndarray:
    """Bits needed for each unsigned value."""
    return np.frexp(values.astype(np.float64))[1].astype(np.uint8)


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """Rows of 256 values below 2**width as rows of 4 * width words."""
    columns = np.ascontiguousarray(values.T).astype(np.uint64)
    out = np.zeros((BLOCK * width // 64, len(values)), np.uint64)
    for i in range(BLOCK):
        word, shift = divmod(i * width, 64)
        out[word] |= columns[i] << np.uint64(shift)
        if shift + width > 64:
            out[word + 1] |= columns[i] >> np.uint64(64 - shift)
    return out.T


def _unpack(words: np.ndarray, width: int) -> np.ndarray:
    """Inverse of ``_pack``."""
    columns = np.ascontiguousarray(words.T)
    out = np.empty((BLOCK, len(words)), np.uint64)
    mask = np.uint64((1 << width) - 1)
    for i in range(BLOCK):
        word, shift = divmod(i * width, 64)
        value = columns[word] >> np.uint64(shift)
        if shift + width > 64:
            value = value | columns[word + 1] << np.uint64(64 - shift)
        out[i] = value & mask
    return out.T.astype(np.uint32)


def write_segment(ids: np.ndarray, doc_ids: list[int | None], lengths: list[int]) -> bytes:
    """Bytes of one token file for the ids of whole documents, end ids included."""
    n = len(ids)
    blocks = -(-n // BLOCK)
    padded = np.empty(blocks * BLOCK, np.uint32)
    padded[:n] = ids
    padded[n:] = ids[-1] if n else 0
    table = padded.reshape(blocks, BLOCK)
    smallest = table.min(axis=1) if blocks else np.empty(0, np.uint32)
    rest = table - smallest[:, None]
    at = int(np.ceil(FITTING * BLOCK)) - 1
    width = _bits(np.partition(rest, at, axis=1)[:, at]) if blocks else np.empty(0, np.uint8)
    fits = rest >> width[:, None].astype(np.uint32) == 0
    fits |= width[:, None] == 32
    block_of, place = np.nonzero(~fits)
    exceptions = rest[block_of, place]
    rest[block_of, place] = 0
    before = np.zeros(blocks, np.uint32)
    np.cumsum(np.bincount(block_of, minlength=blocks)[:-1], out=before[1:]) if blocks > 1 else None
    size = width.astype(np.int64) * (BLOCK // 64)
    start = np.cumsum(size) - size
    words = np.zeros(int(size.sum()), np.uint64)
    for w in np.unique(width):
        if w:
            rows = np.flatnonzero(width == w)
            words[start[rows][:, None] + np.arange(int(w) * BLOCK // 64)] = _pack(rest[rows], int(w))
    return b"".join(
        [
            _HEAD.pack(MAGIC, n, len(doc_ids), blocks, len(words), len(exceptions)),
            smallest.astype("<u4").tobytes(),
            width.tobytes(),
            start.astype("<u4").tobytes(),
            before.astype("<u4").tobytes(),
            place.astype(np.uint8).tobytes(),
            exceptions.astype("<u4").tobytes(),
            words.astype("<u8").tobytes(),
            np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
            bytes(d is not None for d in doc_ids),
            np.array(lengths, "<u4").tobytes(),
        ]
    )


class Segment:
    """Reader of the bytes of one token file."""

    def __init__(self, data: bytes):
        magic, self.n_ids, docs, blocks, words, exceptions = _HEAD.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not a token file of this format")
        offset = _HEAD.size

        def part(kind: str, count: int) -> np.ndarray:
            nonlocal offset
            found = np.frombuffer(data, kind, count, offset)
            offset += found.nbytes
            return found

        self._smallest, self._width = part("<u4", blocks), part("u1", blocks)
        self._start, self._before = part("<u4", blocks), part("<u4", blocks)
        self._places, self._values = part("u1", exceptions), part("<u4", exceptions)
        self._words = part("<u8", words)
        ids, known = part("<i8", docs).tolist(), part("u1", docs).tolist()
        self.doc_ids = [d if k else None for d, k in zip(ids, known)]
        self.lengths = part("<u4", docs)
        if offset != len(data):
            raise ValueError("the token file is cut off or has trailing bytes")

    def ids(self, start: int = 0, stop: int | None = None) -> np.ndarray:
        """Ids from ``start`` to ``stop``; only the blocks that hold them are unpacked."""
        stop = self.n_ids if stop is None else min(stop, self.n_ids)
        if start >= stop:
            return np.empty(0, np.uint32)
        first, last = start // BLOCK, -(-stop // BLOCK)
        width, out = self._width[first:last], np.empty((last - first, BLOCK), np.uint32)
        for w in np.unique(width):
            rows = np.flatnonzero(width == w)
            if w:
                at = self._start[first + rows].astype(np.int64)
                out[rows] = _unpack(self._words[at[:, None] + np.arange(int(w) * BLOCK // 64)], int(w))
            else:
                out[rows] = 0
        low = int(self._before[first])
        high = int(self._before[last]) if last < len(self._before) else len(self._values)
        counts = np.diff(np.append(self._before[first:last], high).astype(np.int64))
        out[np.repeat(np.arange(last - first), counts), self._places[low:high]] = self._values[low:high]
        out += self._smallest[first:last, None]
        return out.reshape(-1)[start - first * BLOCK : stop - first * BLOCK]


@lru_cache(maxsize=2)
def _encoder(path: str) -> PieceEncoder:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    from tokenizers.pre_tokenizers import ByteLevel

    tokenizer = Tokenizer.from_file(path)
    model, bytewise = tokenizer.model, ByteLevel(add_prefix_space=False, use_regex=False)
    # How the model spells the bytes of the characters that a word may have, and of the space.
    spelt = {i: bytewise.pre_tokenize_str(chr(i))[0][0] for i in range(ord(LATIN))}
    # Nothing but the model has a say in a word, as the pattern takes it whole with its space.
    added = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
    direct = tokenizer.normalizer is None and tokenizer.truncation is None and not any(t.replace(" ", "a").isalpha() for t in added)
    vocabulary = tokenizer.get_vocab()
    # In a byte-level vocabulary each character of a token stands for a byte.
    size = np.zeros(max(vocabulary.values(), default=-1) + 1, np.int64)
    size[list(vocabulary.values())] = list(map(len, vocabulary))

    def ids_of(texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, "<u4") for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(pieces: list[str]) -> list[bytes]:
        """A space and a word go to the model as they are, other pieces that begin with their only outer space end to end, many at a time.

        A token never crosses the space, so the bytes that tokens stand for
        tell where each piece ends.
        """
        out: list[bytes] = [b""] * len(pieces)
        inner, rest = [], []
        for i, p in enumerate(pieces):
            behind = p[1:]
            if direct and p[:1] == " " and is_word(behind):
                # ASCII letters stand for themselves.
                ids = [t.id for t in model.tokenize(spelt[32] + (behind if behind.isascii() else behind.translate(spelt)))]
                out[i] = struct.pack(f"<{len(ids)}I", *ids)
            # One space ahead, nothing stripped behind it; an empty piece or a space alone is no such piece.
            elif p[:1] == " " and behind and behind == p.strip():
                inner.append(i)
            else:
                rest.append(i)
        runs = [inner[i : i + JOINED] for i in range(0, len(inner), JOINED)]
        joined = [[pieces[i] for i in run] for run in runs]
        for run, parts, ids in zip(runs, joined, ids_of(list(map("".join, joined)))):
            ends = np.cumsum([len(p) if p.isascii() else len(p.encode()) for p in parts])
            tokens = np.cumsum(size[ids])
            cuts = np.searchsorted(tokens, ends) + 1
            if not len(ids) or not np.array_equal(tokens[np.minimum(cuts, len(ids)) - 1], ends):
                raise ValueError("the tokenizer's ids do not spell the text")
            raw, start = ids.tobytes(), 0
            for i, stop in zip(run, (4 * cuts).tolist()):
                out[i] = raw[start:stop]
                start = stop
        for i, ids in zip(rest, ids_of([pieces[i] for i in rest]) if rest else ()):
            out[i] = ids.tobytes()
        return out

    return PieceEncoder(encode, REMEMBERED)


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int, doc_id: str = "doc_id", text: str = "text") -> None:
    """Encode every whole text, append ``end_id`` and write the ids in ascending ``doc_id`` order.

    Each row of the Parquet table at ``folder`` is one token file: ``part`` and
    ``segment`` order the files, ``before`` counts the ids of earlier files of
    the part, ``data`` holds the file. A null text is empty, so only its end id
    is written; a null doc_id comes first; rows of equal doc_id are ordered by a
    hash of the text. Other columns are not written. The tokenizer's splitting
    has to be the byte-level pattern (see ``pieces``), and its file readable
    where tasks run.
    """
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    ordered = docs.select(F.col(f"`{doc_id}`").cast("long").alias("d"), whole.alias("t"), text_key(F.col(f"`{text}`")).alias("k"))
    ordered = ordered.repartitionByRange("d", "k").sortWithinPartitions("d", "k").select("d", "t", F.spark_partition_id().alias("p"))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = _encoder(tokenizer), np.array([end_id], "<u4").tobytes()
        part_id, segment, before, size = 0, 0, 0, 0
        held: list[bytes] = []
        names: list[int | None] = []
        lengths: list[int] = []

        def close() -> pa.RecordBatch:
            nonlocal segment, before
            ids = np.frombuffer(b"".join(held), "<u4")
            data = write_segment(ids, names, lengths)
            row = pa.RecordBatch.from_pylist([{"part": part_id, "segment": segment, "before": before, "ids": len(ids), "data": data}], schema=arrow)
            segment, before = segment + 1, before + len(ids)
            held.clear(), names.clear(), lengths.clear()
            return row

        for part in parts:
            if not part.num_rows:
                continue
            part_id = part.column(2)[0].as_py()
            doc_ids, texts = part.column(0).to_pylist(), part.column(1)
            for start, stop in slices(texts, SLICE_BYTES):
                for d, ids in zip(doc_ids[start:stop], encoder.encode_column(texts.slice(start, stop - start))):
                    held.append(ids + end)
                    names.append(d)
                    lengths.append(len(ids) // 4 + 1)
                    size += lengths[-1]
                    if size >= SEGMENT_IDS:
                        yield close()
                        size = 0
        if names:
            yield close()

    schema = "part int, segment int, before long, ids long, data binary"
    arrow = pa.schema([("part", pa.int32()), ("segment", pa.int32()), ("before", pa.int64()), ("ids", pa.int64()), ("data", pa.binary())])
    ordered.mapInArrow(run, schema).write.parquet(folder)


def read_token_files(spark, folder: str) -> DataFrame:
    """One row for each document in the token files at ``folder``.

    ``doc_id``, ``start`` (ids of all documents before it), ``n_tokens`` (with
    the end id) and ``ids_crc32`` (of its ids as little-endian 32-bit integers).
    The ids come from unpacked blocks. What is gathered across files is one sum
    for each part, of which there are as many as write tasks.
    """
    files = spark.read.schema("part int, segment int, before long, ids long, data binary").parquet(folder)
    sums = files.groupBy("part").agg(F.sum("ids").alias("ids"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(F.col("part").alias("p"), F.coalesce(F.sum("ids").over(earlier), F.lit(0)).alias("offset"))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for p, before, data in zip(*(c.to_pylist() for c in part.columns)):
                segment = Segment(data)
                raw = memoryview(segment.ids().astype("<u4", copy=False).tobytes())
                ends = np.cumsum(segment.lengths, dtype=np.int64)
                starts = ends - segment.lengths
                sums = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([p] * len(sums), pa.int32()),
                        pa.array(segment.doc_ids, pa.int64()),
                        pa.array(before + starts, pa.int64()),
                        pa.array(segment.lengths, pa.int64()),
                        pa.array(sums, pa.int64()),
                    ],
                    names=["part", "doc_id", "start", "n_tokens", "ids_crc32"],
                )

    rows = files.select("part", "before", "data").mapInArrow(run, "part int, doc_id long, start long, n_tokens long, ids_crc32 long")
    joined = rows.join(F.broadcast(offsets), F.col("part") == F.col("p"))
    return joined.select("doc_id", (F.col("start") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32")


def token_files(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """Write the token files of ``docs`` to the shared folder and read them back, see above."""
    folder = scratch_path(docs.sparkSession, "token_files")
    write_token_files(docs, folder, tokenizer, end_id)
    return read_token_files(docs.sparkSession, folder)
