"""Spelling variants by a bit-sliced position index over the vocabulary.

An index over a block of words holds, per (position, letter), the bitset of the
words that have the letter there, and per length the bitset of its words. A
query walks through its letters and keeps four sets, word-parallel over the
block: words equal so far (zero errors), and words with one error so far, being
a replaced letter (same position from then on), a letter more (positions one
further) or a letter less (positions one back). What is left at the end and has
the right length differs by exactly one letter.

Two words that differ by one letter, the shorter of length ``c``, agree in their
first ``c // 2`` letters or in the other letters counted from the end. Words are
dealt by both, for the lengths ``c`` they can have part in, and groups of such
keys share an index. A pair is taken from the group of its equal beginnings, and
only where these differ from that of its endings, so once. A key that many words
share is cut into chunks, and every chunk of queries meets every chunk of the
index in a group of its own, so that no group is large.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrears.llm.common import materialise

#: Every how many occurrences, by their hash, one loses a letter.
LOSING = 199
LEAST_LETTERS, LEAST_COUNT = 6, 5
#: A form is this many times as frequent as its variant.
TIMES = 5
#: Words that a group holds on average, and at most of one key.
GROUP_WORDS = 4_096
#: Bytes that one set of the queries walking together takes.
SET_BYTES = 1_000_000
#: Distinct words a worker counts before it hands its counts on.
HELD_WORDS = 500_000

_RUN = re.compile("[A-Za-zÀ-ÿ]+")
_LOWER = {c: c + 32 for c in range(65, 91)}


def runs_of(doc_id: int | None, text: str | None) -> Counter:
    """Occurrences of a text's runs, A-Z lowered, a letter lost where the hash of id and run says so.

    All occurrences of one run in one row have one hash.
    """
    found: Counter = Counter()
    head = b"%d:" % doc_id if doc_id is not None else b":"
    for run, n in Counter(_RUN.findall(text or "")).items():
        found[run.lower() if run.isascii() else run.translate(_LOWER)] += n
    for run in list(found):
        h = zlib.crc32(head + run.encode())
        if h % LOSING == 0:
            at = h % len(run)
            # Counted apart, as the shortened run may be a run of the text as well.
            found[(run[:at] + run[at + 1 :],)] += found.pop(run)
    return found


def vocabulary(docs: DataFrame, least_letters: int = LEAST_LETTERS, least_count: int = LEAST_COUNT, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n): words of at least so many letters and occurrences. Counts are added up before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            for key, whole in zip(batch.column(0).to_pylist(), batch.column(1)):
                for run, n in runs_of(key, whole.as_py()).items():
                    word = run if isinstance(run, str) else run[0]
                    if len(word) >= least_letters:
                        held[word] += n
                if len(held) > HELD_WORDS:
                    yield pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"])
                    held.clear()
        yield pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"])

    frame = docs.select(F.col(f"`{doc_id}`").cast("long"), F.col(f"`{text}`").cast("string"))
    counted = frame.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= least_count)


class SlicedIndex:
    """Bitsets of a block of words per (position, letter) and per length."""

    def __init__(self, words: Sequence[str]):
        self.lanes = -(-len(words) // 64)
        self.lengths = np.array([len(w) for w in words], np.int64)
        self.width = int(self.lengths.max()) + 2
        codes = letter_codes(words, self.width)
        self.letters = np.unique(codes[codes > 0])
        # Row 0 is the empty set: letters no word has, and places before a word or beyond all of them.
        self.rows = np.zeros((1 + self.width * len(self.letters), self.lanes), "<u8")
        for place in range(self.width):
            for number in np.unique(codes[:, place]):
                if number:
                    letter = int(np.searchsorted(self.letters, number))
                    self.rows[1 + place * len(self.letters) + letter] = self._bits(codes[:, place] == number)
        self.of_length = {n: self._bits(self.lengths == n) for n in np.unique(self.lengths).tolist()}

    def _bits(self, chosen: np.ndarray) -> np.ndarray:
        packed = np.zeros(self.lanes * 8, np.uint8)
        bits = np.packbits(chosen, bitorder="little")
        packed[: len(bits)] = bits
        return packed.view("<u8")

    def slots(self, codes: np.ndarray, shift: int) -> np.ndarray:
        """Row numbers of the queries' letters, each looked up ``shift`` places after its own."""
        places = np.arange(codes.shape[1]) + shift
        letter = np.searchsorted(self.letters, codes).clip(max=max(len(self.letters) - 1, 0))
        known = (self.letters[letter] == codes) & (places >= 0) & (places < self.width) if len(self.letters) else np.zeros(codes.shape, bool)
        return np.where(known, 1 + places * len(self.letters) + letter, 0)

    def near(self, queries: Sequence[str], beginning: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Sets, one row a query (all of one length): words with a letter replaced, one more, one less, and words with the
        same first ``beginning`` letters."""
        size = len(queries[0])
        codes = letter_codes(queries, size)
        here, after, back = (self.slots(codes, s) for s in (0, 1, -1))
        equal = np.full((len(queries), self.lanes), ~np.uint64(0))
        replaced, longer, shorter = (np.zeros_like(equal) for _ in range(3))
        begins = equal
        for i in range(size):
            has = self.rows[here[:, i]]
            replaced = (replaced & has) | (equal & ~has)
            # A letter put in before this one, or the pair was one letter apart before.
            longer = (longer | equal) & self.rows[after[:, i]]
            # This letter left out, or the pair was one letter apart before.
            shorter = (shorter & self.rows[back[:, i]]) | equal
            equal = equal & has
            if i + 1 == beginning:
                begins = equal
        none = np.zeros(self.lanes, "<u8")
        return (
            replaced & self.of_length.get(size, none),
            (longer | equal) & self.of_length.get(size + 1, none),
            shorter & self.of_length.get(size - 1, none),
            begins,
        )


def letter_codes(words: Sequence[str], width: int) -> np.ndarray:
    """Code points of the words, zero beyond their ends."""
    return np.array(words, f"<U{width}").view("<u4").reshape(len(words), width)


def near_within(index: Sequence[str], queries: Sequence[str], least: int, starts: bool) -> Iterator[tuple[int, np.ndarray]]:
    """(number of a query, numbers of the words near it) in the class of pairs whose shorter word has ``least`` letters.

    ``starts`` takes the pairs that share the first half, otherwise those that do not.
    """
    sliced = SlicedIndex(index)
    lengths = np.array([len(q) for q in queries])
    for size in (least, least + 1):
        chosen = np.flatnonzero(lengths == size)
        step = max(1, SET_BYTES // (8 * sliced.lanes))
        for low in range(0, len(chosen), step):
            part = chosen[low : low + step]
            replaced, longer, shorter, begins = sliced.near([queries[i] for i in part], least // 2)
            found = (replaced | longer if size == least else shorter) & (begins if starts else ~begins)
            for i in np.flatnonzero(found.any(axis=1)).tolist():
                bits = np.unpackbits(np.ascontiguousarray(found[i]).view(np.uint8), bitorder="little")
                yield int(part[i]), np.flatnonzero(bits)


def _neighbours(keys: tuple, table: pa.Table) -> pa.Table:
    """Per query of a group the number of near words and the best of them."""
    least, starts = keys[0].as_py(), keys[1].as_py()
    rows: dict[str, list] = {"word": [], "n_near": [], "best_n": [], "best": []}
    words, counts = np.array(table.column("word").to_pylist(), object), table.column("n").to_numpy()
    index, queries = (np.flatnonzero(table.column(c).to_numpy()) for c in ("held", "asks"))
    if len(index) and len(queries):
        for number, near in near_within(words[index].tolist(), words[queries].tolist(), least, starts):
            places = index[near]
            most = counts[places].max()
            rows["word"].append(words[queries[number]])
            rows["n_near"].append(len(places))
            rows["best_n"].append(int(most))
            rows["best"].append(min(words[p] for p in places if counts[p] == most))
    return pa.table(rows, pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("best_n", pa.int64()), ("best", pa.string())]))


def neighbours(words: DataFrame, group_words: int = GROUP_WORDS) -> DataFrame:
    """(word, n_near, best, best_n) of every word of ``words`` (word, n; distinct words) that has a near one.

    ``best`` is the near word of largest ``n``, ties to the first in code-point order.
    """
    size = F.length("word")
    halves = []
    for least in (size, size - 1):
        half = F.floor(least / 2).cast("int")
        # A class whose shorter words are empty has pairs of single letters: their beginnings are empty, too.
        halves.append(F.struct(least.alias("least"), F.lit(True).alias("starts"), F.substring("word", F.lit(1), half).alias("part")))
        rest = least - half
        halves.append(F.struct(least.alias("least"), F.lit(False).alias("starts"), F.substring("word", size - rest + 1, rest).alias("part")))
    dealt = words.select("word", "n", F.explode(F.array(*halves)).alias("key")).where("key.least > 0").select("word", "n", "key.*")
    dealt = materialise(dealt, "dealt")
    key = ["least", "starts", "part"]
    sizes = dealt.groupBy(*key).agg(F.count(F.lit(1)).alias("members"))
    many = sizes.where(F.col("members") > group_words).select(*key, F.ceil(F.col("members") / group_words).cast("int").alias("chunks"))
    # Two rows for each length that words have: a thousand lengths are a few kilobytes.
    classes = sizes.groupBy("least", "starts").agg(F.ceil(F.sum("members") / group_words).cast("long").alias("homes"))
    frame = dealt.join(many, key, "left").join(F.broadcast(classes), ["least", "starts"])
    own, mine = F.xxhash64(*key), F.expr("CAST(pmod(xxhash64(word, 1), chunks) AS int)")

    def place(home, ask, hold, asks, held):
        return F.struct(home.alias("home"), ask.alias("ask"), hold.alias("hold"), asks.alias("asks"), held.alias("held"))

    # A word of a key in chunks asks once for each chunk of the index, and is held for each chunk of queries.
    # Negative homes are one key's alone.
    chunks, alone = F.sequence(F.lit(0), F.col("chunks") - 1), -F.abs(own.bitwiseAND(F.lit(2**62 - 1))) - 1
    asking = F.transform(chunks, lambda i: place(alone, mine, i, F.lit(True), i == mine))
    holding = F.transform(F.filter(chunks, lambda i: i != mine), lambda i: place(alone, i, mine, F.lit(False), F.lit(True)))
    shared = place(F.pmod(own, F.col("homes")), F.lit(0), F.lit(0), F.lit(True), F.lit(True))
    places = F.when(F.col("chunks").isNull(), F.array(shared)).otherwise(F.concat(asking, holding))
    placed = frame.select("word", "n", "least", "starts", F.explode(places).alias("place")).select("word", "n", "least", "starts", "place.*")
    found = placed.groupBy("least", "starts", "home", "ask", "hold").applyInArrow(_neighbours, "word string, n_near long, best_n long, best string")
    # The smallest of (-n, word) is the most frequent word, the first among equals.
    best = F.min(F.struct((-F.col("best_n")).alias("n"), "best"))
    summed = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("_best"))
    return summed.select("word", "n_near", F.col("_best.best").alias("best"), (-F.col("_best.n")).alias("best_n"))


def rooted(forms: DataFrame) -> DataFrame:
    """(word, root) for every row of ``forms`` (word, form): the last form that following forms leads to.

    Each round joins every word with what its present form has come to, which
    doubles the steps taken; frequencies rise by a factor at every step, so
    chains are short.
    """
    at = materialise(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = at.select(F.col("word").alias("_from"), F.col("root").alias("_to"))
        at = materialise(at.join(further, F.col("root") == F.col("_from"), "left").select("word", F.coalesce("_to", "root").alias("root"), F.col("_to").isNotNull().alias("moved")), "roots")
        if at.where("moved").limit(1).count() == 0:
            return at.select("word", "root")
        at = at.drop("moved")


def spelling_groups(
    docs: DataFrame,
    least_letters: int = LEAST_LETTERS,
    least_count: int = LEAST_COUNT,
    times: int = TIMES,
    doc_id: str = "doc_id",
    text: str = "text",
    group_words: int = GROUP_WORDS,
) -> DataFrame:
    """Per word of the vocabulary ``word``, ``form``, ``root``, ``n``, ``n_near`` and ``form_n``.

    ``form`` is the most frequent word one letter away (ties: first in
    code-point order), if it is at least ``times`` as frequent, else null;
    ``root`` the word that forms lead to in the end, the word itself without one.

    Repeated rows count as often as they occur. A null text has no words; a
    null id counts as an empty one where a letter is lost by hash. Texts are
    read whole. An empty table, or one without frequent words, gives an empty
    table. Other columns are not read, whatever their names.
    """
    words = materialise(vocabulary(docs, least_letters, least_count, doc_id, text), "vocabulary")
    near = neighbours(words, group_words)
    joined = words.join(near, "word", "left")
    fits = F.col("best_n") >= times * F.col("n")
    formed = materialise(
        joined.select("word", F.when(fits, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(fits, F.col("best_n")).alias("form_n")), "formed"
    )
    roots = rooted(formed.where("form IS NOT NULL").select("word", "form"))
    return formed.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
