"""Byte-level BPE by dynamic programming over prefixes.

Within one match of the splitting pattern, the encoding of a byte prefix is
fixed by its last token: the rest is the encoding of the shorter prefix. For
every prefix the table stores that one token. It is the only vocabulary entry
that ends there, continues the encoding of what precedes it, and does not get
merged with it. Appending bytes therefore only adds entries, and after an edit
the table is right again once the entries repeat over the longest token.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrears.llm.pieces import PieceEncoder, is_word, slices

#: Token pairs whose verdict one worker remembers before it starts anew.
REMEMBERED_PAIRS = 400_000
#: Matches whose ids one worker remembers before it starts anew, beside whole pieces.
REMEMBERED_MATCHES = 50_000


class Vocabulary:
    """Ranks of byte strings, and what merging by rank implies about neighbours."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.words = {rank: word for word, rank in ranks.items()}
        self.longest = max(map(len, ranks), default=0)
        self._halves: dict[int, tuple[int, int] | None] = {}
        self.known_pairs: dict[int, bool] = {}

    @classmethod
    def from_file(cls, path: str) -> Vocabulary:
        with open(path, "rb") as lines:
            return cls({base64.b64decode(word): int(rank) for word, rank in (line.split() for line in lines if line.strip())})

    def merge(self, data: bytes, below: float = float("inf")) -> list[int]:
        """Ids after all merges of rank under ``below``, lowest first; for short strings."""
        ids = [self.ranks[data[i : i + 1]] for i in range(len(data))]
        while len(ids) > 1:
            ranked = [(self.ranks.get(self.words[a] + self.words[b], below), i) for i, (a, b) in enumerate(zip(ids, ids[1:]))]
            rank, at = min(ranked)
            if rank >= below:
                break
            ids[at : at + 2] = [rank]
        return ids

    def halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens that ``token`` is merged from; None for a byte or a token no merge makes."""
        if token not in self._halves:
            word = self.words[token]
            parts = self.merge(word, token) if len(word) > 1 else []
            self._halves[token] = (parts[0], parts[1]) if len(parts) == 2 else None
        return self._halves[token]

    def alone(self, token: int) -> bool:
        """Whether the bytes of ``token`` are encoded as that token."""
        return len(self.words[token]) == 1 or self.halves(token) is not None

    def follows(self, left: int, right: int) -> bool:
        """Whether merging leaves ``left`` and ``right`` side by side.

        Undoes the merges next to the border, latest first. If at some moment
        the two tokens at the border would have been merged before the undone
        merge took place, the pair cannot stand. Of two merges of one rank the
        left one comes first.
        """
        key = left << 32 | right
        known = self.known_pairs.get(key)
        if known is None:
            if len(self.known_pairs) > REMEMBERED_PAIRS:
                self.known_pairs.clear()
            known = self.known_pairs[key] = self._stand(left, right)
        return known

    def _stand(self, left: int, right: int) -> bool:
        before = float("inf")
        while True:
            joint = self.ranks.get(self.words[left] + self.words[right])
            if joint is not None and joint < before:
                return False
            from_left, from_right = self.halves(left), self.halves(right)
            if from_left and (not from_right or left > right):
                before, left = left, from_left[1]
            elif from_right:
                before, right = right + 1, from_right[0]
            else:
                return True


class PrefixTable:
    """Last token of every prefix of one match of the splitting pattern."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary = vocabulary
        self.data = b""
        self.last: list[int] = []
        self.append(data)

    def append(self, data: bytes) -> None:
        """Add bytes; entries that exist stay as they are."""
        self.data += data
        data, last, v = self.data, self.last, self.vocabulary
        rank_of, verdict, longest, follows, alone = v.ranks.get, v.known_pairs.get, v.longest, v.follows, v.alone
        reach = len(v.words[last[-1]]) if last else 0
        for end in range(len(last) + 1, len(data) + 1):
            # Only one token is right, so the order of trials is free: the last
            # token grown by a byte first, then from short to long.
            start = end - reach - 1
            token = rank_of(data[start:end])
            if token is not None and start:
                pair = last[start - 1] << 32 | token
                good = verdict(pair)
                if good is None:
                    good = follows(last[start - 1], token)
            else:
                good = token is not None and alone(token)
            if not good:
                for start in range(end - 1, max(0, end - longest - 1), -1):
                    token = rank_of(data[start:end])
                    if token is not None:
                        pair = last[start - 1] << 32 | token
                        good = verdict(pair)
                        if good is None:
                            good = follows(last[start - 1], token)
                        if good:
                            break
                else:
                    start = 0
                    token = rank_of(data[:end])
                    if token is None or not alone(token):
                        raise ValueError("the vocabulary lacks a byte")
            last.append(token)
            reach = end - start

    def replace(self, start: int, stop: int, data: bytes) -> int:
        """Put ``data`` for the bytes from ``start`` to ``stop``; returns how many entries were worked out."""
        tail, old = self.data[stop:], self.last[stop:]
        self.data, self.last = self.data[:start], self.last[:start]
        self.append(data)
        same = done = 0
        while done < len(tail) and same < self.vocabulary.longest:
            self.append(tail[done : done + 1])
            same = same + 1 if self.last[-1] == old[done] else 0
            done += 1
        self.data += tail[done:]
        self.last += old[done:]
        return len(data) + done

    def ids(self, length: int | None = None) -> list[int]:
        """Encoding of the first ``length`` bytes (all if not given)."""
        end, words, out = len(self.data) if length is None else length, self.vocabulary.words, []
        while end:
            out.append(self.last[end - 1])
            end -= len(words[out[-1]])
        return out[::-1]


class BpeCodec:
    """Encoder and decoder of texts for one vocabulary and splitting pattern."""

    def __init__(self, vocabulary: Vocabulary, pattern: str):
        self.vocabulary = vocabulary
        self._pattern = regex.compile(pattern)
        self._ids_of: dict[str, bytes] = {}
        self._pieces = PieceEncoder(self._encode_pieces)
        width = max(vocabulary.words, default=-1) + 1
        self._words = [vocabulary.words.get(i) for i in range(width)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        return self._pieces.encode(texts)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self._words.__getitem__, np.frombuffer(ids, "<u4").tolist()))

    def _encode_pieces(self, pieces: list[str]) -> list[bytes]:
        # A space and a word are one match, which is remembered as a piece.
        return [
            self._ids(piece) if piece[:1] == " " and is_word(piece[1:]) else b"".join(map(self._match_ids, self._pattern.findall(piece)))
            for piece in pieces
        ]

    def _ids(self, match: str) -> bytes:
        data = match.encode("utf-8", "surrogatepass")
        whole = self.vocabulary.ranks.get(data)
        ids = [whole] if whole is not None else PrefixTable(self.vocabulary, data).ids()
        return struct.pack(f"<{len(ids)}I", *ids)

    def _match_ids(self, match: str) -> bytes:
        known = self._ids_of.get(match)
        if known is None:
            known = self._ids(match)
            if len(match) <= 32:
                if len(self._ids_of) > REMEMBERED_MATCHES:
                    self._ids_of.clear()
                self._ids_of[match] = known
        return known


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> BpeCodec:
    """One codec a worker for each vocabulary file."""
    return BpeCodec(Vocabulary.from_file(path), pattern)


def encode_texts(docs: DataFrame, path: str, pattern: str, text: str = "text", keep_ids: bool = False) -> DataFrame:
    """Encode and decode every whole text.

    Returns all columns of ``docs`` except ``text``, then ``n_tokens`` (long),
    ``ids_sha256`` over the ids as little-endian 32-bit integers,
    ``decoded_sha256`` over the decoded bytes and, with ``keep_ids``, ``ids``
    as such bytes. Columns of those names in ``docs`` give way. A null text
    counts as empty and has no tokens; special tokens are ordinary text. Rows
    are independent: equal rows get equal results, an empty table gives an
    empty one. ``path`` must be readable where tasks run.
    """
    added = {"n_tokens": "long", "ids_sha256": "string", "decoded_sha256": "string"} | ({"ids": "binary"} if keep_ids else {})
    kept = [c for c in docs.columns if c != text and c.lower() not in added]
    frame = docs.select(*[F.col(f"`{c}`") for c in kept], F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("__text"))
    schema = frame.drop("__text").schema
    for name, kind in added.items():
        schema = schema.add(name, kind)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(path, pattern)
        for part in parts:
            texts = part.column(part.num_columns - 1)
            for start, stop in slices(texts):
                ids = bpe.encode(texts.slice(start, stop - start).to_pylist())
                columns = [c.slice(start, stop - start) for c in part.columns[:-1]]
                columns.append(pa.array([len(i) // 4 for i in ids], pa.int64()))
                columns.append(pa.array([hashlib.sha256(i).hexdigest() for i in ids], pa.string()))
                columns.append(pa.array([hashlib.sha256(bpe.decode(i)).hexdigest() for i in ids], pa.string()))
                if keep_ids:
                    columns.append(pa.array(ids, pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names=schema.fieldNames())

    return frame.mapInArrow(run, schema)
