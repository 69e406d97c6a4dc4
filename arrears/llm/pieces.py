"""Encoding of whole texts through a bounded memory of the pieces between single spaces.

The splitting pattern of byte-level vocabularies never joins what lies on both
sides of a space between two other characters: the space starts the match on
its right. So a text may be cut before such a space, each piece encoded by
itself, and the ids joined. Pieces repeat, so most are looked up.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: A space with no white space on either side.
_CUT = re.compile(r"(?<=\S) (?=\S)")

#: Marks that the pattern always parts from the letters before them, as one match
#: to the end of the piece, and the first character for which libraries may not
#: agree on what a letter is. The apostrophe may belong to letters behind it.
_MARKS, LATIN = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~", "\u0250"
#: Marks in a row whose ids are kept for good.
MARKS_IN_A_ROW = 3

#: Pieces longer than this are encoded but not remembered.
REMEMBERED_CHARS = 64
#: Pieces remembered by one worker before it starts anew, unless told otherwise.
REMEMBERED_PIECES = 400_000


class PieceEncoder:
    """Ids of texts as little-endian 32-bit bytes.

    ``encode`` takes a list of strings and returns their ids as such bytes; it
    gives the reference result for a whole text, and is called here with pieces.
    """

    def __init__(self, encode: Callable[[list[str]], list[bytes]], remembered: int = REMEMBERED_PIECES):
        self._encode = encode
        self._remembered = remembered
        self._known: dict[str, bytes] = {}
        self._marks: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        """One byte string for each text; empty texts give empty bytes."""
        if len(self._known) > self._remembered:
            self._known.clear()
        known, plans, unseen = self._known, [], {}
        for text in texts:
            pieces = text.split(" ")
            found = list(map(known.get, pieces[1:]))
            gaps = _gaps(found)
            if gaps:
                new = {pieces[i + 1] for i in gaps}
                if "" in new or list(map(str.strip, new)) != list(new):
                    pieces = _CUT.split(text)
                    found = list(map(known.get, pieces[1:]))
                    gaps = _gaps(found)
                    new = {pieces[i + 1] for i in gaps}
                unseen.update(dict.fromkeys(new))
            plans.append((pieces, found, gaps))
        missing = self._learn(unseen)
        heads = self._encode([pieces[0] for pieces, _, _ in plans])
        out = []
        for (pieces, found, gaps), head in zip(plans, heads):
            for i in gaps:
                found[i] = missing[pieces[i + 1]]
            out.append(head + b"".join(found))
        return out

    def encode_column(self, texts: pa.Array) -> list[bytes]:
        """As ``encode``, for a column of strings, none of them null; a piece is looked up once for all its places."""
        if not len(texts):
            return []
        if len(self._known) > self._remembered:
            self._known.clear()
        rows = pc.split_pattern(texts, " ")
        places, starts, used, pieces = _distinct(rows)
        found = list(map(self._known.get, pieces))
        gaps = [i for i in _gaps(found) if used[i]]
        # An empty piece or one with white space around it shows a cut that must not be.
        wrong = [i for i in gaps if not pieces[i] or pieces[i].strip() != pieces[i]]
        if wrong:
            marks = np.zeros(len(pieces), bool)
            marks[wrong] = True
            marks = marks[places]
            marks[starts] = False
            odd = np.logical_or.reduceat(marks, starts)
            cut = pa.array(list(map(_CUT.split, texts.filter(pa.array(odd)).to_pylist())), rows.type)
            back = np.argsort(np.argsort(odd, kind="stable"))
            rows = pa.concat_arrays([rows.filter(pa.array(~odd)), cut]).take(pa.array(back))
            places, starts, used, pieces = _distinct(rows)
            found = list(map(self._known.get, pieces))
            gaps = [i for i in _gaps(found) if used[i]]
        missing = self._learn([pieces[i] for i in gaps])
        for i in gaps:
            found[i] = missing[pieces[i]]
        heads = self._encode([pieces[i] for i in places[starts].tolist()])
        places[starts] = np.arange(len(pieces), len(pieces) + len(heads))
        # 64-bit offsets, as ids may take four times the bytes of the text.
        joined = pa.array(found + heads, pa.large_binary()).take(pa.array(places))
        ends = np.frombuffer(joined.buffers()[1], np.int64)[np.append(starts, len(places))]
        return pa.Array.from_buffers(pa.large_binary(), len(texts), [None, pa.py_buffer(ends), joined.buffers()[2]]).to_pylist()

    def _learn(self, new: Iterable[str]) -> dict[str, bytes]:
        """Ids of pieces not known, each behind a space; what is short enough is remembered."""
        known, missing, marked = self._known, {}, {}
        for p in new:
            word = p.rstrip(_MARKS)
            if 0 < len(p) - len(word) <= MARKS_IN_A_ROW and is_word(word):
                marked[p] = word
                if word not in known:
                    missing[word] = b""
            else:
                missing[p] = b""
        order = list(missing)
        for piece, ids in zip(order, self._encode([" " + p for p in order]) if order else ()):
            missing[piece] = ids
        for piece, word in marked.items():
            ids = missing.get(word)
            missing[piece] = (known[word] if ids is None else ids) + self._mark(piece[len(word) :])
        for piece, ids in missing.items():
            if len(piece) <= REMEMBERED_CHARS and piece.strip() == piece:
                known[piece] = ids
        return missing

    def _mark(self, marks: str) -> bytes:
        if marks not in self._marks:
            self._marks[marks] = self._encode([marks])[0]
        return self._marks[marks]


def _gaps(found: list[bytes | None]) -> list[int]:
    """Places of what is not known."""
    places, at = [], -1
    for _ in range(found.count(None)):
        at = found.index(None, at + 1)
        places.append(at)
    return places


def _distinct(rows: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[str]]:
    """Pieces of texts as numbers, where texts start, which numbers stand behind a start, and the different pieces."""
    counts = pc.list_value_length(rows).to_numpy(zero_copy_only=False).astype(np.int64)
    starts = np.cumsum(counts) - counts
    told = pc.dictionary_encode(rows.flatten())
    places = told.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    n = len(told.dictionary)
    used = np.bincount(places, minlength=n) > np.bincount(places[starts], minlength=n)
    return places, starts, used, told.dictionary.to_numpy(zero_copy_only=False).tolist()


def is_word(piece: str) -> bool:
    """Whether a piece is nothing but letters, by any library's account."""
    return piece.isalpha() and (piece.isascii() or max(piece) < LATIN)


def slices(column: pa.Array, size: int = 1_000_000) -> Iterator[tuple[int, int]]:
    """Consecutive (start, stop) runs of a column of texts of about ``size`` bytes, at least one text each."""
    start, held = 0, 0
    for i, n in enumerate(pc.binary_length(column).to_pylist()):
        if held and held + n > size:
            yield start, i
            start, held = i, 0
        held += n
    if start < len(column):
        yield start, len(column)
