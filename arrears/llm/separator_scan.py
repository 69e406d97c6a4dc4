"""Token counts of documents in flat token files that have no index.

A token file is nothing but unsigned 16-bit little-endian ids: after each
document comes the end-of-document id. The ids of a document are preceded by
five ids that spell its number, so that a file needs no list beside it. Files
end with a line feed, which the text writer adds; a last odd byte is no id.

The scan cuts files into blocks, searches each block for the end id with one
vectorised comparison and so gets pieces of documents. A prefix sum over the
blocks' counts of end ids gives every piece the number of its document in the
file, and pieces of one number are added up.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from arrears.llm.common import materialise, scratch_path
from arrears.llm.pieces import slices
from arrears.llm.prefix_bpe import codec

#: Ids that spell a document number: digits to this base, plus one value for null.
DIGITS = 5
BASE = 50_000
#: Ids after which a file is closed at the next document, and ids in a block of the scan.
FILE_IDS = 4_000_000
BLOCK_IDS = 1 << 20


def spell(doc_id: int | None) -> list[int]:
    """A document number (null included) as five ids below ``BASE``."""
    value = 0 if doc_id is None else doc_id + (1 << 63) + 1
    out = []
    for _ in range(DIGITS):
        value, digit = divmod(value, BASE)
        out.append(digit)
    return out


def unspell(ids: list[int]) -> int | None:
    """Inverse of ``spell``."""
    value = sum(digit * BASE**i for i, digit in enumerate(ids))
    return value - (1 << 63) - 1 if value else None


def write_flat_files(docs: DataFrame, folder: str, ranks: str, pattern: str, end_id: int, doc_id: str = "doc_id", text: str = "text") -> None:
    """Encode every whole text into flat token files below ``folder``.

    ``end_id`` must not be a vocabulary id and ids must be below 65,536. A null
    text is empty. Input partitions stay where they are: nothing is shuffled,
    and the order of documents in the files means nothing.
    """
    if not BASE <= end_id < 1 << 16:
        raise ValueError("the end id must be above the digits and below 65536")
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    frame = docs.select(F.col(f"`{doc_id}`").cast("long").alias("d"), whole.alias("t"))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, end = codec(ranks, pattern), np.array([end_id], "<u2").tobytes()
        held, size = [], 0

        def close() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([b"".join(held)], pa.binary())], names=["ids"])

        for part in parts:
            doc_ids, texts = part.column(0).to_pylist(), part.column(1)
            for start, stop in slices(texts):
                for d, ids in zip(doc_ids[start:stop], bpe.encode(texts.slice(start, stop - start).to_pylist())):
                    body = np.frombuffer(ids, "<u4")
                    if body.size and body.max() >= end_id:
                        raise ValueError("a vocabulary id is not below the end id")
                    held.append(np.array(spell(d), "<u2").tobytes() + body.astype("<u2").tobytes() + end)
                    size += body.size + DIGITS + 1
                    if size >= FILE_IDS:
                        yield close()
                        held, size = [], 0
        if held:
            yield close()

    rows = frame.mapInArrow(run, "ids binary").select(F.col("ids").cast("string").alias("value"))
    # One row a file; the writer adds a line feed, and the scan drops an odd byte.
    rows.write.option("maxRecordsPerFile", 1).text(folder)


def pieces(files: DataFrame, end_id: int, block_ids: int = BLOCK_IDS) -> DataFrame:
    """Pieces of documents in each block: ``file``, ``block``, ``piece``, ``n`` ids, the first of them, ``ended``.

    ``files`` has ``path`` and ``content``. The piece after the last end id of a
    block is open: the document goes on in the next block.
    """
    width = 2 * block_ids
    blocks = files.select(
        F.col("path").alias("file"),
        F.posexplode(
            F.transform(
                F.sequence(F.lit(0), F.floor((F.length("content") - 1) / width).cast("int")),
                lambda i: F.substring(F.col("content"), i * width + 1, F.lit(width)),
            )
        ).alias("block", "bytes"),
    )

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for file, block, data in zip(*(c.to_pylist() for c in part.columns)):
                ids = np.frombuffer(data, "<u2", len(data) // 2)
                ends = np.flatnonzero(ids == end_id)
                starts = np.concatenate(([0], ends + 1))
                stops = np.append(ends, len(ids))
                heads = [ids[a : min(a + DIGITS, b)].tolist() for a, b in zip(starts.tolist(), stops.tolist())]
                n = len(starts)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([file] * n, pa.string()),
                        pa.array([block] * n, pa.int32()),
                        pa.array(np.arange(n), pa.int32()),
                        pa.array(stops - starts, pa.int64()),
                        pa.array(heads, pa.list_(pa.int32())),
                        pa.array(np.arange(n) < n - 1, pa.bool_()),
                    ],
                    names=["file", "block", "piece", "n", "head", "ended"],
                )

    schema = "file string, block int, piece int, n long, head array<int>, ended boolean"
    return blocks.where("length(bytes) > 0").mapInArrow(run, schema)


def stitch(found: DataFrame) -> DataFrame:
    """Documents from pieces: ``file``, ``ordinal`` in the file, ``n`` ids, the first five of them, ``ended``.

    The number of a piece's document is the count of end ids in earlier blocks
    of the file plus its place in the block. Only the open pieces at block
    borders have to be brought together with others.
    """
    # Every block has exactly one open piece, whose place is the block's count of end ids.
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    counts = found.where("NOT ended").select("file", "block", F.coalesce(F.sum("piece").over(earlier), F.lit(0)).alias("ends_before"))
    placed = found.join(counts, ["file", "block"]).withColumn("ordinal", F.col("piece") + F.col("ends_before"))
    parts = F.array_sort(F.collect_list(F.struct("block", "head")))
    whole = placed.groupBy("file", "ordinal").agg(F.sum("n").alias("n"), parts.alias("parts"), F.max("ended").alias("ended"))
    head = F.slice(F.flatten(F.transform("parts", lambda p: p["head"])), 1, DIGITS)
    return whole.select("file", "ordinal", "n", head.alias("head"), "ended").where("ended OR n > 0")


def scan_flat_files(spark: SparkSession, folder: str, end_id: int, block_ids: int = BLOCK_IDS) -> DataFrame:
    """One row for each document in the files below ``folder``.

    ``doc_id``, ``n_tokens`` (without number and end id), ``file`` and
    ``ordinal``. Ids after the last end id of a file are a document without an
    end. No file or only empty ones: no rows.
    """
    files = spark.read.format("binaryFile").load(folder).where("length > 1")
    name = F.element_at(F.split("path", "/"), -1)
    docs = stitch(materialise(pieces(files.select(name.alias("path"), "content"), end_id, block_ids), "token_pieces"))
    # Digits to the base, least first; the sum exceeds a long, a decimal holds it.
    value = F.lit(0).cast("decimal(38,0)")
    for i in range(DIGITS):
        value = value + F.coalesce(F.get("head", F.lit(i)), F.lit(0)).cast("decimal(10,0)") * F.lit(Decimal(BASE**i))
    number = F.when(value > 0, (value - F.lit(Decimal((1 << 63) + 1))).cast("long"))
    return docs.select(number.alias("doc_id"), (F.col("n") - DIGITS).alias("n_tokens"), "file", "ordinal")


def token_counts(docs: DataFrame, ranks: str, pattern: str, end_id: int) -> DataFrame:
    """Write ``docs`` as flat token files in the shared folder and count them by the scan, see above.

    One row for each row of ``docs``; equal rows stay apart. Columns other than
    ``doc_id`` and ``text`` are not used.
    """
    folder = scratch_path(docs.sparkSession, "flat_tokens")
    write_flat_files(docs, folder, ranks, pattern, end_id)
    return scan_flat_files(docs.sparkSession, folder, end_id)
