"""Benchmark decontamination by Wu-Manber search for many strings at once.

Items and texts are lower-cased (A-Z) and written as their words with one space
around each, so a run of words in a text is a plain byte string. Every window of
an item is a string to be found. For strings of a like length the search keeps

* a shift table: for the hash of each block of bytes, how far the block's last
  place in the first ``m`` bytes of any string lies from their end; blocks that
  no string has shift by the most possible, and those bytes are never looked at,
* buckets of strings by the hash of their last block before ``m``, each parted
  by the first bytes of the string, asked only where the shift is zero,
* the strings, which are compared byte by byte.

A slice of the texts is cut into lanes whose cursors move together, so that one
numpy call advances thousands of them.

The strings come in blocks of bounded bytes. Each block is sent to every task
and the documents pass once for each block, so a benchmark of any size works in
bounded memory; nothing of the documents is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrears.llm.common import materialise
from arrears.llm.pieces import slices

WINDOW = 10
#: Bytes of item text that one block holds on average; a block's tables are about twenty times that.
BLOCK_BYTES = 4_000_000
#: Windows that one piece of a long item has at most.
PIECE_WINDOWS = 5_000
#: Strings are searched in classes of these least lengths, so that a short one does not shorten all shifts.
CLASSES = (3, 12, 24, 48)
#: Longest prefix that a shift table covers, so that shifts fit a byte.
LONGEST_PREFIX = 200
#: Bytes of a slice that one cursor covers, and bytes of a slice.
LANE, SLICE = 1_024, 4_000_000
#: Pairs of a place and a string that are compared at a time.
PAIRS = 1_000_000

_SPACE, _BREAK = 0x20, 0x0A
#: Letters in lower case, digits and every byte of other characters as they are, all else a space.
_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else _SPACE for b in range(256))
_MIX = np.uint64(0x9E3779B97F4A7C15)
_MIX_PREFIX = np.uint64(0xC2B2AE3D27D4EB4F)


def words_of(text: bytes | None) -> list[bytes]:
    """Words of a UTF-8 text; null has none."""
    return (text or b"").translate(_WORDS).split()


def words_at(buffer: np.ndarray) -> np.ndarray:
    """The eight bytes from every place on, as an integer; the buffer ends with eight spare bytes."""
    return np.ndarray((len(buffer) - 7,), "<u8", buffer, strides=(1,))


class Length:
    """Shift table and buckets of the strings of one class of lengths."""

    def __init__(self, strings: np.ndarray, starts: np.ndarray, lengths: np.ndarray, numbers: np.ndarray):
        self.prefix = int(min(lengths.min(), LONGEST_PREFIX))
        self.block = 3 if self.prefix < CLASSES[1] else 8
        self._keep_block = np.uint64((1 << 8 * self.block) - 1)
        self._keep_first = np.uint64((1 << 8 * min(self.prefix, 8)) - 1)
        at = words_at(strings)
        hashes = max(len(strings), 1 << 10)
        self.bits = np.uint64(64 - min(24, hashes.bit_length() + 2))
        longest = self.prefix - self.block + 1
        self.shift = np.full(1 << int(64 - self.bits), longest, np.uint8)
        # Later blocks have smaller shifts and overwrite earlier ones.
        for offset in range(longest):
            self.shift[self._hash(at[starts + offset])] = longest - 1 - offset
        keys = self._key(at[starts + longest - 1], at[starts])
        order = np.argsort(keys, kind="stable")
        self.keys, self.numbers = keys[order], numbers[order]

    def _hash(self, block: np.ndarray) -> np.ndarray:
        return ((block & self._keep_block) * _MIX) >> self.bits

    def _key(self, last: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Bucket of the last block, parted by the first bytes."""
        return ((last & self._keep_block) * _MIX) ^ ((first & self._keep_first) * _MIX_PREFIX)

    def places(self, buffer: np.ndarray, size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places where a string may start, and which one: every pair of a place and a string of its bucket."""
        at, back = words_at(buffer), self.block - 1
        ends = np.arange(self.prefix - 1, size, LANE, dtype=np.int64)
        limits = np.minimum(ends + LANE, size)
        found = []
        while len(ends):
            steps = self.shift[self._hash(at[ends - back])]
            still = steps == 0
            if still.any():
                found.append(ends[still])
            ends = ends + np.maximum(steps, 1)
            going = ends < limits
            if not going.all():
                ends, limits = ends[going], limits[going]
        last = np.sort(np.concatenate(found)) if found else np.empty(0, np.int64)
        first = last - self.prefix + 1
        keys = self._key(at[last - back], at[first])
        low, high = np.searchsorted(self.keys, keys, "left"), np.searchsorted(self.keys, keys, "right")
        some = high > low
        first, low, counts = first[some], low[some], (high - low)[some]
        # Big buckets are laid out a bounded number of pairs at a time.
        part = np.cumsum(counts) // PAIRS
        for cut in np.split(np.arange(len(first)), np.flatnonzero(np.diff(part)) + 1):
            n = counts[cut]
            inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            yield np.repeat(first[cut], n), self.numbers[np.repeat(low[cut], n) + inside]


class Strings:
    """All windows of one block of items, ready to be searched for.

    ``pieces`` are (item, text as words with one space around each, words in a window).
    """

    def __init__(self, pieces: Sequence[tuple[str | None, bytes, int]]):
        self.items: list[str | None] = []
        numbers: dict[bytes, int] = {}
        item_numbers: dict[str | None, int] = {}
        starts, lengths, sizes, pairs, offset, texts = [], [], [], set(), 0, []
        for item, text, words in pieces:
            item_number = item_numbers.setdefault(item, len(item_numbers))
            spaces = [i for i, b in enumerate(text) if b == _SPACE]
            for low, high in zip(spaces, spaces[words:]):
                number = numbers.setdefault(text[low : high + 1], len(numbers))
                if number == len(starts):
                    starts.append(offset + low)
                    lengths.append(high + 1 - low)
                    sizes.append(words)
                pairs.add((number, item_number))
            texts.append(text)
            offset += len(text)
        self.items = list(item_numbers)
        self.text = b"".join(texts)
        self.starts, self.lengths = np.array(starts, np.int64), np.array(lengths, np.int64)
        self.sizes = np.array(sizes, np.int64)
        linked = np.array(sorted(pairs), np.int64).reshape(-1, 2)
        self.linked_items = linked[:, 1]
        self.first_link = np.searchsorted(linked[:, 0], np.arange(len(starts) + 1))
        spare = np.frombuffer(self.text + bytes(8), np.uint8)
        self.classes = []
        for least, most in zip(CLASSES, [*CLASSES[1:], np.inf]):
            inside = np.flatnonzero((self.lengths >= least) & (self.lengths < most))
            if len(inside):
                self.classes.append(Length(spare, self.starts[inside], self.lengths[inside], inside))

    def occurrences(self, text: bytes, buffer: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, string) of every occurrence in ``text``, which ``buffer`` is with eight spare bytes."""
        starts, strings = [], []
        for length in self.classes:
            for places, numbers in length.places(buffer, len(text)):
                spans = zip(places.tolist(), numbers.tolist(), self.starts[numbers].tolist(), self.lengths[numbers].tolist())
                for place, number, low, n in spans:
                    if text[place : place + n] == self.text[low : low + n]:
                        starts.append(place)
                        strings.append(number)
        return np.array(starts, np.int64), np.array(strings, np.int64)

    def search(self, texts: Sequence[bytes | None]) -> list[tuple[int, list[tuple[int, int]], list[str | None]]]:
        """Per text its number of words, the runs of hit words (end exclusive) and the items with an occurring window."""
        spaced = b"".join(b" " + (t or b"").translate(_WORDS) + b" \n" for t in texts)
        raw = np.frombuffer(spaced, np.uint8)
        single = raw == _SPACE
        single[1:] &= raw[:-1] == _SPACE
        single[0] = False
        buffer = np.append(raw[~single], np.zeros(8, np.uint8))
        text = buffer[:-8].tobytes()
        breaks = np.flatnonzero(buffer[:-8] == _BREAK)
        before = (buffer[:-8] == _SPACE) & (buffer[1:-7] != _BREAK)
        word_starts = np.flatnonzero(before)
        words_to = np.searchsorted(word_starts, breaks)
        words_from = np.concatenate([[0], words_to[:-1]])
        out = [(int(n), [], []) for n in words_to - words_from]
        places, strings = self.occurrences(text, buffer)
        if not len(places):
            return out
        first = np.searchsorted(word_starts, places)
        owner = np.searchsorted(breaks, places)
        # Per word the occurrences that begin at it, less those that end before it; a run never leaves its text.
        change = np.zeros(len(word_starts) + 1, np.int64)
        np.add.at(change, first, 1)
        np.add.at(change, first + self.sizes[strings], -1)
        hit = np.cumsum(change[:-1]) > 0
        for doc in np.unique(owner).tolist():
            edges = np.flatnonzero(np.diff(hit[words_from[doc] : words_to[doc]].astype(np.int8), prepend=0, append=0))
            out[doc][1].extend(zip(edges[::2].tolist(), edges[1::2].tolist()))
        order = np.lexsort((strings, owner))
        owner, strings = owner[order], strings[order]
        cuts = np.flatnonzero(np.diff(owner)) + 1
        for doc, mine in zip(owner[np.concatenate([[0], cuts])].tolist(), np.split(strings, cuts)):
            linked = [self.linked_items[self.first_link[s] : self.first_link[s + 1]] for s in np.unique(mine).tolist()]
            out[doc][2].extend(self.items[i] for i in np.unique(np.concatenate(linked)).tolist())
        return out


def item_pieces(benchmark: DataFrame, window: int = WINDOW, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(item, piece, words): every window of an item lies in one of its pieces; items without words have none."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for item, whole in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                words = words_of(whole)
                size = min(window, len(words))
                for i in range(0, len(words) - size + 1 if words else 0, PIECE_WINDOWS):
                    piece = b" ".join(words[i : i + PIECE_WINDOWS + size - 1])
                    rows.append({"item": item, "piece": b" " + piece + b" ", "words": size})
            yield pa.RecordBatch.from_pylist(rows, pa.schema([("item", pa.string()), ("piece", pa.binary()), ("words", pa.int32())]))

    frame = benchmark.select(F.col(f"`{item_id}`").cast("string"), F.col(f"`{text}`").cast("string"))
    return frame.mapInArrow(cut, "item string, piece binary, words int").distinct()


def blocks(pieces: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[Strings]:
    """The strings in blocks of about ``block_bytes``, at least one; one block at a time is on the driver."""
    size = F.octet_length("piece") + F.coalesce(F.octet_length("item"), F.lit(0))
    total = pieces.agg(F.sum(size)).first()[0] or 0
    number = max(1, -(-total // block_bytes))
    dealt = F.pmod(F.xxhash64("item", "piece"), F.lit(number))
    for i in range(number):
        rows = pieces.where(dealt == i).toArrow()
        columns = (rows.column(c).to_pylist() for c in ("item", "piece", "words"))
        yield Strings(sorted(zip(*columns), key=lambda r: (r[0] is None, r[0] or "", r[1])))


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Per document ``doc_id``, ``n_words``, ``hit_runs`` (array of start and end word, end exclusive) and ``items``.

    A window is ``window`` consecutive words of an item; an item of fewer words,
    but not none, is one window. ``items`` lists the distinct ids, as strings in
    byte order, of the items with an occurring window.

    One row for each input row, repeated rows included, whatever their ids. A
    null or empty text has no words; a null or empty item has no window. An
    item without id marks words and adds nothing to ``items``; items that share
    an id count as one. An empty benchmark hits nothing, an empty table gives an
    empty one. Other columns are not read, whatever their names.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"),
        F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"),
        F.lit(0).cast("long").alias("n_words"),
        F.array().cast("array<long>").alias("runs"),
        F.array().cast("array<string>").alias("items"),
    )
    schema = rows.schema
    done = False
    for strings in blocks(item_pieces(benchmark, window, item_id, item_text), block_bytes):
        if done:
            rows = materialise(rows, "searched")
        rows, done = rows.mapInArrow(_pass(spark.sparkContext.broadcast(strings)), schema), True
    ends = F.expr("transform(sequence(0, size(runs) div 2 - 1), i -> named_struct('start', runs[2 * i], 'end', runs[2 * i + 1]))")
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    return rows.select("doc_id", "n_words", F.when(F.size("runs") > 0, ends).otherwise(none).alias("hit_runs"), F.array_sort(F.array_distinct("items")).alias("items"))


def _pass(shared):
    """Function for ``mapInArrow`` that searches one block and adds what it finds to what earlier blocks found."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        strings = shared.value
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            for low, high in slices(texts, SLICE):
                part = batch.slice(low, high - low)
                n_words, runs, items = [], [], []
                known = zip(part.column("runs").to_pylist(), part.column("items").to_pylist())
                for (n, new, named), (old, listed) in zip(strings.search(texts.slice(low, high - low).to_pylist()), known):
                    n_words.append(n)
                    runs.append(joined([*zip(old[::2], old[1::2]), *new]))
                    items.append([*listed, *(i for i in named if i is not None)])
                columns = {
                    "doc_id": part.column("doc_id"),
                    "text": part.column("text"),
                    "n_words": pa.array(n_words, pa.int64()),
                    "runs": pa.array(runs, pa.list_(pa.int64())),
                    "items": pa.array(items, pa.list_(pa.string())),
                }
                yield pa.RecordBatch.from_pydict(columns)

    return search


def joined(runs: Sequence[tuple[int, int]]) -> list[int]:
    """Runs in order, overlapping and touching ones as one, flat."""
    out: list[int] = []
    for start, end in sorted(runs):
        if out and start <= out[-1]:
            out[-1] = max(out[-1], end)
        else:
            out += (start, end)
    return out
