"""Personal data by patterns and a skip-chain conditional random field.

Patterns give the base spans. The field then looks at every string of a text
that might be personal data (a node): strings around an at sign and groups of
digits. Its labels are the kinds and "none". Nodes that a base span covers are
observed; the others are free. Potentials are

* of a node: its looks (digits, separators, length), the word before it and
  whether its digits pass the Luhn test,
* of neighbouring nodes in the text (the chain),
* of nodes that are the same or similar but far apart (the skips): equal digits,
  the same last nine digits, or the same name before the at sign.

Skips lead from each node to the next one with the same key, and from each free
node to an observed one with its key, so their number grows with the nodes and
not with their pairs, and every free mention hears of an observed one in the
first round, however many lie between. Loopy message passing carries the label
of an observed mention to the others in the document, for example to a telephone
number that is repeated without its country code. A free node whose most
probable label is a kind becomes a span.

Weights are learned from the base spans of all documents, as sums. A free node
that shares a skip with an observed one is left out of the learning, since its
label is what is being asked. As no free node shows what a pattern needs, looks of
a kind are learned from observed mentions as they would be written without that:
a telephone number without its plus sign and perhaps its prefix, digits with
other separators, an email address without the dots of its host. A second pass
learns what a shared key is worth: looks of all free nodes that share one tell, by
expectation and maximisation, how many of them are the same by chance. Nothing is
clipped: looks, neighbours and skips are weighed against each other, so a number
that only ends like an observed one stays if its looks and the word before it say
so, and a number among telephone numbers becomes one without any skip.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
NONE = len(KINDS)
#: Rounds of message passing, and the change below which it ends.
ROUNDS, STILL = 30, 1e-4

_NAME = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_HOST = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9][0-9.]*")
_DIGITS = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_GROUP = re.compile(r"\(?[0-9][0-9\x20().-]{5,}[0-9]")
#: Where one group surely holds two numbers: after a full stop, or between brackets.
_CUT = re.compile(r"\.\x20+|\)\x20*(?=\()")
_RUN = re.compile(r"[0-9]+")
_TAIL = re.compile(r"[A-Za-z0-9.-]*")
#: Digits of one number, at least and at most.
LEAST_DIGITS, MOST_DIGITS = 7, 19

Span = tuple[int, int, int]


def emails(text: str) -> list[Span]:
    """Names, an at sign and a dotted host, leftmost and not overlapping; linear in the text."""
    out, at, free = [], text.find("@"), 0
    while at >= 0:
        before = text[free:at]
        start = free + len(before.rstrip(_NAME))
        host = _HOST.match(text, at + 1) if start < at else None
        if host:
            out.append((start, 0, host.end()))
        free = host.end() if host else at + 1
        at = text.find("@", free)
    return out


def addresses(text: str) -> list[Span]:
    """Four numbers with dots between, of which matches with a part above 255 are dropped."""
    out = []
    for run in _DOTTED.finditer(text):
        parts = run.group().split(".")
        if len(parts) < 4:
            continue
        at, held = run.start(), []
        for part in parts:
            held = [*held, (at, part)] if part else []
            at += len(part) + 1
            if len(held) == 4:
                if all(len(p.lstrip("0")) <= 3 and int(p[-3:] if len(p) > 3 else p) <= 255 for _, p in held):
                    out.append((held[0][0], 1, at - 1))
                held = []
    return out


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def cards(text: str) -> list[Span]:
    """Digits with single spaces or hyphens, 14 to 19 of them, that pass the Luhn test."""
    out = []
    for m in _DIGITS.finditer(text):
        if 14 <= m.end() - m.start() <= 40:
            digits = m.group().replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
    return out


def phones(text: str) -> list[Span]:
    """A plus sign and 10 to 15 digits with the usual separators."""
    if "+" not in text:
        return []
    return [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 10 <= sum(c.isdigit() for c in m.group()) <= 15]


def base_spans(text: str) -> list[Span]:
    """(start, kind, end) of all pattern matches, by start, then kind."""
    return sorted(emails(text) + addresses(text) + cards(text) + phones(text))


@dataclass(frozen=True)
class Node:
    """A string that may be personal data, with the keys that tie it to others."""

    start: int
    end: int
    looks: tuple[int, ...]
    keys: tuple[str, ...]
    context: tuple[int, ...] = ()


LOOKS = 40
#: First rows of the counts of digits, dots, spaces and hyphens among the looks, and of the flags.
DIGITS_AT, DOTS_AT, SPACES_AT, HYPHENS_AT, FLAGS_AT = 1, 22, 27, 31, 35
#: Buckets for the word before a node (the first: none) and characters that are looked at for it.
WORDS, WORD_REACH = 64, 40
#: Rows of the context: words, then whether 14 to 19 digits fail or pass the Luhn test, or are not so many.
CONTEXT = WORDS + 3
#: Parts into which a mention is divided when it counts for several ways of writing it; every share is whole.
SHARES = 60
_LETTERS = re.compile(r"[^\W\d_]+")


def _looks(text: str, start: int, end: int, at: int) -> tuple[int, ...]:
    """Numbers of the features that hold, each below ``LOOKS``."""
    s = text[start:end]
    digits = sum(c.isdigit() for c in s)
    before = text[max(0, start - 1) : start]
    out = [0, DIGITS_AT + min(digits, 20), DOTS_AT + min(s.count("."), 4), SPACES_AT + min(s.count(" "), 3), HYPHENS_AT + min(s.count("-"), 3)]
    for place, holds in enumerate((at >= 0, "(" in s, before == "+", bool(before) and not before.isspace(), end - start > 30), FLAGS_AT):
        if holds:
            out.append(place)
    return tuple(out)


def _context(text: str, start: int, digits: str) -> tuple[int, ...]:
    """Rows of the word before a node and of the Luhn test of its digits."""
    words = _LETTERS.findall(text, max(0, start - WORD_REACH), start)
    bucket = 1 + zlib.crc32(words[-1].lower().encode("utf-8", "surrogatepass")) % (WORDS - 1) if words else 0
    return bucket, WORDS + ((1 + luhn(digits)) if 14 <= len(digits) <= MOST_DIGITS else 0)


def unlike_patterns(text: str, node: Node, kind: int) -> np.ndarray:
    """Looks of an observed mention, were it written so that no pattern takes it; in ``SHARES`` parts."""
    out = np.zeros(LOOKS)
    s = text[node.start : node.end]
    out[0] = SHARES
    if kind == 0:
        s = "@".join((s.partition("@")[0], s.partition("@")[2].partition(".")[0]))
        out[[i for i in _looks(s, 0, len(s), s.find("@")) if 0 < i < FLAGS_AT]] = SHARES
        out[FLAGS_AT] = SHARES
    else:
        runs = _RUN.findall(s) or [""]
        digits = sum(map(len, runs))
        short = digits - len(runs[0]) if kind == KINDS.index("phone") else digits
        for n in (digits, short if short >= LEAST_DIGITS else digits):
            out[DIGITS_AT + min(n, 20)] += SHARES // 2
        for first, last in ((DOTS_AT, 4), (SPACES_AT, 3), (HYPHENS_AT, 3)):
            most = min(len(runs) - 1, last)
            out[first : first + most + 1] += SHARES // (most + 1)
        out[FLAGS_AT + 1] = SHARES // 2 if "(" in s else 0
    before = text[max(0, node.start - 1) : node.start]
    out[FLAGS_AT + 3] = SHARES if before and before != "+" and not before.isspace() else 0
    out[FLAGS_AT + 4] = SHARES if len(s) > 30 else 0
    return out


def number_keys(digits: str) -> tuple[str, ...]:
    """Keys of a number: all its digits, and the last nine where it may be a number with a prefix."""
    return ("d" + digits, *(("s" + digits[-9:],) if 9 <= len(digits) <= MOST_DIGITS else ()))


def pieces(text: str, start: int, end: int) -> list[tuple[int, int]]:
    """Parts of a group of digits between the places where it surely holds two numbers; the group itself if there are none."""
    cuts = [(m.start(), m.end()) for m in _CUT.finditer(text, start, end)]
    return list(zip([start, *(b for _, b in cuts)], [*(a for a, _ in cuts), end]))


def known_within(text: str, start: int, end: int, known: set[str]) -> list[tuple[int, int]]:
    """Neighbouring runs of digits of a group that make up a known number, from the left, not overlapping.

    All digits equal go before the last nine equal; of the latter the shortest
    counts, so that digits beside a number stay outside.
    """
    runs = [(m.start(), m.end(), m.group()) for m in _RUN.finditer(text, start, end)]
    out, i = [], 0
    while i < len(runs):
        digits, same, alike = "", -1, -1
        for j in range(i, len(runs)):
            if len(digits) + len(runs[j][2]) > MOST_DIGITS:
                break
            digits += runs[j][2]
            if len(digits) >= LEAST_DIGITS and "d" + digits in known:
                same = j
            if alike < 0 and len(digits) >= 9 and "s" + digits[-9:] in known and all("s" + "".join(r[2] for r in runs[k : j + 1])[-9:] not in known for k in range(i + 1, j + 1)):
                alike = j
        j = same if same >= 0 else alike
        if j >= 0:
            low, high = runs[i][0], runs[j][1]
            out.append((low - (low > start and text[low - 1] == "(" and ")" in text[low:high]), high))
        i = max(i, j) + 1
    return out


def nodes(text: str, base: list[Span] | tuple = ()) -> list[Node]:
    """Strings around at signs, and groups of seven digits or more, in order of their starts.

    A group may hold several numbers. Its parts at sure cuts are nodes too, and
    so are the runs of digits in it that make up a number of ``base``.
    """
    out, at, free = [], text.find("@"), 0
    while at >= 0:
        start = at - len(text[free:at]) + len(text[free:at].rstrip(_NAME))
        end = _TAIL.match(text, at + 1).end()
        if start < at:
            out.append(Node(start, end, _looks(text, start, end, at), ("n" + text[start:at].lower(),), _context(text, start, "")))
        free = max(at + 1, end)
        at = text.find("@", free)
    known = {key for a, kind, b in base if kind for part in {(a, b), *pieces(text, a, b)} for key in number_keys("".join(_RUN.findall(text, *part)))}
    for m in _GROUP.finditer(text):
        parts = {m.span(), *pieces(text, *m.span())}
        if known:
            parts |= {part for p in parts for part in known_within(text, *p, known)}
        for start, end in parts:
            digits = "".join(_RUN.findall(text, start, end))
            if len(digits) >= LEAST_DIGITS:
                out.append(Node(start, end, _looks(text, start, end, -1), number_keys(digits), _context(text, start, digits)))
    return sorted(out, key=lambda n: (n.start, n.end))


def skips(found: list[Node]) -> list[tuple[int, int]]:
    """Places of nodes that share a key, each with the next one that does."""
    last: dict[str, int] = {}
    out = set()
    for i, node in enumerate(found):
        for key in node.keys:
            if key in last:
                out.add((last[key], i))
            last[key] = i
    return sorted(out)


def anchored(found: list[Node], seen: list[int]) -> list[tuple[int, int]]:
    """Places of free nodes, each with the last observed one before it that shares a key, or else the first one."""
    first: dict[str, int] = {}
    for i, node in enumerate(found):
        if seen[i] >= 0:
            for key in node.keys:
                first.setdefault(key, i)
    out, last = set(), dict(first)
    for i, node in enumerate(found):
        for key in node.keys:
            if seen[i] >= 0:
                last[key] = i
            elif key in last:
                out.add((min(i, last[key]), max(i, last[key])))
    return sorted(out)


def observed(found: list[Node], base: list[Span]) -> list[int]:
    """Kind of the base span that each node overlaps, or -1; one sweep over both."""
    out, at = [], 0
    reach = []
    for start, kind, end in base:
        reach.append((start, max(end, reach[-1][1]) if reach else end))
    for node in found:
        while at < len(base) and reach[at][1] <= node.start:
            at += 1
        hit, i = -1, at
        while i < len(base) and base[i][0] < node.end:
            if base[i][2] > node.start:
                hit = base[i][1]
                break
            i += 1
        out.append(hit)
    return out


@dataclass(frozen=True)
class Weights:
    """Log potentials by label: of looks, of neighbours and of skips (label by label), of the context, of escaping a pattern.

    ``prior`` is the part of the first look that comes from the labels' shares alone.
    """

    look: np.ndarray
    chain: np.ndarray
    skip: np.ndarray
    context: np.ndarray = field(default_factory=lambda: np.zeros((CONTEXT, NONE + 1)))
    escape: np.ndarray = field(default_factory=lambda: np.zeros(NONE + 1))
    prior: np.ndarray = field(default_factory=lambda: np.zeros(NONE + 1))


#: Mentions' worth of belief that a feature says nothing of the label, and that skips join one label.
TRUST, SAME_TRUST = 20.0, 50.0
#: Share of nodes and pairs that come about in ways the counts do not show.
ODD = 0.01
#: Share of free nodes with an observed node's key that have its label, as believed beforehand, by as many mentions as ``TRUST``.
SAME = 0.95
#: Least share of repeated mentions that escape their pattern.
LEAST_ESCAPE = 1e-3
#: Bins of what looks say for a kind, from the first value on, and steps of expectation and maximisation.
BINS, BIN_WIDTH, STEPS = 121, 0.25, 200
FIRST_BIN = -(BINS // 2) * BIN_WIDTH


def potentials(found: list[Node], seen: list[int], w: Weights) -> np.ndarray:
    """Log potential of every label of every node by itself; that of an observed node is its kind alone."""
    own = np.stack([w.look[list(node.looks)].sum(axis=0) + w.context[list(node.context)].sum(axis=0) for node in found]) + w.escape
    own -= own[:, NONE:]
    for i, kind in enumerate(seen):
        if kind >= 0:
            own[i] = np.where(np.arange(NONE + 1) == kind, 0.0, -50.0)
    return own


def chained(found: list[Node]) -> list[tuple[int, int]]:
    """Places of neighbouring nodes; parts of one group that overlap are none."""
    return [(i, i + 1) for i in range(len(found) - 1) if found[i].end <= found[i + 1].start]


def infer(found: list[Node], seen: list[int], w: Weights) -> np.ndarray:
    """Label probabilities of all nodes, by loopy sum-product over chain and skip edges."""
    n, labels = len(found), NONE + 1
    own = potentials(found, seen, w)
    pairs = [(i, j, 0) for i, j in chained(found)] + [(a, b, 1) for a, b in sorted({*skips(found), *anchored(found, seen)})]
    if not pairs:
        return _normal(own)
    a, b, which = np.array(pairs).T
    table = np.stack([w.chain, w.skip])[which]
    source, target = np.concatenate([a, b]), np.concatenate([b, a])
    table = np.concatenate([table, table.transpose(0, 2, 1)])
    back = np.concatenate([np.arange(len(a)) + len(a), np.arange(len(a))])
    message = np.zeros((len(source), labels))
    # What is observed stays so, however many messages say otherwise.
    fixed = np.array(seen) >= 0
    for _ in range(ROUNDS):
        belief = own.copy()
        np.add.at(belief, target, message)
        out = np.where(fixed[source, None], own[source], belief[source] - message[back])
        new = np.logaddexp.reduce(out[:, :, None] + table, axis=1)
        new -= np.logaddexp.reduce(new, axis=1, keepdims=True)
        moved = np.abs(new - message).max()
        message = 0.5 * message + 0.5 * new
        if moved < STILL:
            break
    belief = own.copy()
    np.add.at(belief, target, message)
    return _normal(np.where(fixed[:, None], own, belief))


def _normal(log: np.ndarray) -> np.ndarray:
    return np.exp(log - np.logaddexp.reduce(log, axis=1, keepdims=True))


def find(text: str, w: Weights) -> tuple[list[Span], list[Span]]:
    """Base spans of a text, and all spans."""
    if "@" not in text and not any(map(text.__contains__, "0123456789")):
        return [], []
    base = base_spans(text)
    found = nodes(text, base)
    seen = observed(found, base)
    if not found or not base or min(seen) >= 0:
        # Without an observed node nothing carries a label to a free one.
        return base, base
    best = infer(found, seen, w).argmax(axis=1)
    added, free = [], 0
    # Of nodes that start together the longest counts.
    for node, kind, label in sorted(zip(found, seen, best.tolist()), key=lambda x: (x[0].start, -x[0].end)):
        if kind < 0 and label != NONE and node.start >= free:
            added.append((node.start, label, node.end))
            free = node.end
    return base, sorted(base + added)


def spelled(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def counts(text: str) -> dict[str, np.ndarray]:
    """What learning needs of one text, in whole numbers, so that sums do not depend on their order.

    Looks (in ``SHARES`` parts) and context by label, neighbour and skip label
    pairs, and of nodes that repeat an observed one, by its kind, how many are free and how many observed.
    """
    labels = NONE + 1
    out = {"look": np.zeros((LOOKS, labels)), "chain": np.zeros((labels, labels)), "skip": np.zeros((labels, labels)), "context": np.zeros((CONTEXT, labels)), "repeat": np.zeros((2, labels))}
    if "@" not in text and not any(map(text.__contains__, "0123456789")):
        return out
    base = base_spans(text)
    found = nodes(text, base)
    seen = observed(found, base)
    edges = sorted({*skips(found), *anchored(found, seen)})
    asked = {i: seen[j] for a, b in edges for i, j in ((a, b), (b, a)) if seen[i] < 0 <= seen[j]}
    label = [NONE if kind < 0 else kind for kind in seen]
    for i, node in enumerate(found):
        if i in asked:
            out["repeat"][0, asked[i]] += 1
            continue
        if seen[i] < 0:
            out["look"][list(node.looks), NONE] += SHARES
        else:
            out["look"][:, seen[i]] += unlike_patterns(text, node, seen[i])
        out["context"][list(node.context), label[i]] += 1
    for i, j in chained(found):
        if i not in asked and j not in asked:
            out["chain"][label[i], label[j]] += 1
    again = set()
    for a, b in edges:
        if a not in asked and b not in asked:
            out["skip"][label[a], label[b]] += 1
            if label[a] == label[b] != NONE:
                again.add(b)
    for i in again:
        out["repeat"][1, label[i]] += 1
    return out


def _given(count: np.ndarray) -> np.ndarray:
    """Log probability of each value of a feature (rows) given the label (columns).

    Drawn towards the probability among all nodes, so a label with few nodes
    says little, and mixed with it, so that no value is impossible.
    """
    among_all = ((count.sum(axis=1) + 1) / (count.sum() + len(count)))[:, None]
    return np.log((1 - ODD) * (count + TRUST * among_all) / (count.sum(axis=0) + TRUST) + ODD * among_all)


def _meeting(count: np.ndarray, of_label: np.ndarray, belief: np.ndarray, trust: float, odd: float) -> np.ndarray:
    """Log of how much likelier the second label (columns) gets by the first (rows)."""
    after = (count + trust * belief) / (count.sum(axis=1, keepdims=True) + trust)
    return np.log((1 - odd) * after / of_label + odd)


def evidence(text: str, w: Weights) -> np.ndarray:
    """Bins of what looks and context say for the kind whose key a free node shares, against none; counts by kind."""
    out = np.zeros((BINS, NONE + 1))
    if "@" not in text and not any(map(text.__contains__, "0123456789")):
        return out
    base = base_spans(text)
    found = nodes(text, base)
    seen = observed(found, base)
    asked = {i: seen[j] for a, b in anchored(found, seen) for i, j in ((a, b), (b, a)) if seen[i] < 0 <= seen[j]}
    if asked:
        own = potentials(found, [-1] * len(found), w) - w.prior + w.prior[NONE] - w.escape
        for i, kind in asked.items():
            out[int(np.clip(round((own[i, kind] - FIRST_BIN) / BIN_WIDTH), 0, BINS - 1)), kind] += 1
    return out


def shares_of_same(asked: np.ndarray) -> np.ndarray:
    """Share of free nodes with an observed node's key that have its label, by kind.

    ``asked`` are bins of ``evidence``; of two explanations, one label or
    chance, each node's looks say how much likelier they are under the first.
    """
    likelier = np.exp(FIRST_BIN + BIN_WIDTH * np.arange(BINS))[:, None]
    share = np.full(asked.shape[1], SAME)
    for _ in range(STEPS):
        same = (asked * (share * likelier / (share * likelier + 1 - share))).sum(axis=0)
        share = (same + TRUST * SAME) / (asked.sum(axis=0) + TRUST)
    return share


def learn(total: dict[str, np.ndarray], asked: np.ndarray | None = None) -> Weights:
    """Piecewise weights from sums of ``counts`` and then of ``evidence``: logarithms of smoothed probabilities.

    Looks and context count as independent given the label. Chain and skip
    weights compare how often two labels meet with chance. A skip from an
    observed node is worth what makes the share of ``shares_of_same`` come out
    for a node whose looks say nothing.
    """
    labels = NONE + 1
    look, context, repeat = total["look"] / SHARES, total.get("context", np.zeros((CONTEXT, labels))), total.get("repeat", np.zeros((2, labels)))
    share = shares_of_same(np.zeros((BINS, labels)) if asked is None else asked)
    of_label = (look[0] + 1) / (look[0] + 1).sum()
    weights = np.zeros((LOOKS, labels))
    weights[0] = np.log(of_label)
    for first, stop in zip((DIGITS_AT, DOTS_AT, SPACES_AT, HYPHENS_AT), (DOTS_AT, SPACES_AT, HYPHENS_AT, FLAGS_AT)):
        weights[first:stop] = _given(look[first:stop])
    for place in range(FLAGS_AT, LOOKS):
        off, on = _given(np.stack([look[0] - look[place], look[place]]))
        weights[0] += off
        weights[place] = on - off
    around = np.concatenate([_given(context[:WORDS]), _given(context[WORDS:])])
    chance, one = np.broadcast_to(of_label, (labels, labels)), np.eye(labels)
    chain = (_meeting(total["chain"], of_label, chance, TRUST, ODD) + _meeting(total["chain"].T, of_label, chance, TRUST, ODD).T) / 2
    skip = _meeting(total["skip"] + total["skip"].T, of_label, one, SAME_TRUST, ODD)
    skip = (skip + skip.T) / 2
    escaped = repeat[0] * share
    escape = np.log((1 - LEAST_ESCAPE) * (escaped + 1) / (escaped + repeat[1] + 1 / LEAST_ESCAPE) + LEAST_ESCAPE)
    escape[NONE] = 0.0
    prior = np.log(of_label)
    worth = np.log(share / (1 - share)) - (prior - prior[NONE]) - escape
    for kind in range(NONE):
        skip[kind, NONE] = skip[NONE, kind] = skip[kind, kind] - worth[kind]
    return Weights(weights, chain, skip, around, escape, prior)


def _sums(texts: DataFrame, of_text: Callable[[str], np.ndarray], size: int) -> np.ndarray:
    """Sum of an array of each text over all rows, of which only the sums come to the driver."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for part in parts:
            for t in part.column(0):
                total += of_text(t.as_py())
        (at,) = total.nonzero()
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at])], names=["i", "n"])

    out = np.zeros(size)
    for r in texts.mapInArrow(run, "i int, n double").groupBy("i").agg(F.sum("n").alias("n")).collect():
        out[r.i] = r.n
    return out


def train(docs: DataFrame) -> Weights:
    """Weights from all rows, in two passes; null texts count as empty.

    Without any row the weights are those of smoothing alone. Repeated rows
    count as often as they are there; other columns are not used.
    """
    texts = docs.select(F.coalesce("text", F.lit("")).alias("t"))
    shapes = {name: count.shape for name, count in counts("").items()}
    sizes = [rows * columns for rows, columns in shapes.values()]
    flat = _sums(texts, lambda t: np.concatenate([v.ravel() for v in counts(t).values()]), sum(sizes))
    total = {name: part.reshape(shape) for (name, shape), part in zip(shapes.items(), np.split(flat, np.cumsum(sizes)[:-1]))}
    w = learn(total)
    return learn(total, _sums(texts, lambda t: evidence(t, w).ravel(), BINS * (NONE + 1)).reshape(BINS, -1))


def personal_data(docs: DataFrame, weights: Weights) -> DataFrame:
    """Spans of personal data in every whole text.

    One row for each row of ``docs``: ``doc_id``, ``n_email``, ``n_ip``,
    ``n_card``, ``n_phone`` (base spans), ``base_sha256`` (of the base spans as
    kind:start:end, in code points, joined by commas), ``spans`` (all of them in
    that form) and ``n_added``. A null or empty text has none; repeated rows get
    equal results; an empty table gives an empty one; other columns are not used.
    """
    frame = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("t"))
    names = ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added"]

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            found = [find(t.as_py(), weights) for t in part.column(1)]
            columns = [pa.array([sum(s[1] == k for s in base) for base, _ in found], pa.int64()) for k in range(NONE)]
            columns.append(pa.array([hashlib.sha256(spelled(base).encode()).hexdigest() for base, _ in found], pa.string()))
            columns.append(pa.array([spelled(spans) for _, spans in found], pa.string()))
            columns.append(pa.array([len(spans) - len(base) for base, spans in found], pa.int64()))
            yield pa.RecordBatch.from_arrays([part.column(0), *columns], names=names)

    return frame.mapInArrow(run, "doc_id long, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string, n_added long")


def masked(text: str, spans: list[Span]) -> str:
    """``text`` with each span, or run of overlapping ones, replaced by the name of its first kind."""
    out, at = [], 0
    for start, kind, end in spans:
        if start >= at:
            out += [text[at:start], f"<{KINDS[kind].upper()}>"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def mask_personal_data(docs: DataFrame, weights: Weights) -> DataFrame:
    """``docs`` with personal data masked in ``text``; ``n_chars``, if there, follows it.

    Every row stays a row with all its columns: null texts stay null, empty ones
    empty, repeated rows are masked alike, an empty table gives an empty one. Names of other columns do not matter.
    """
    columns = docs.columns
    text_at = columns.index("text")

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            old = part.column(text_at).to_pylist()
            new = [None if t is None else masked(t, find(t, weights)[1]) for t in old]
            arrays = list(part.columns)
            arrays[text_at] = pa.array(new, pa.string())
            if "n_chars" in columns:
                i = columns.index("n_chars")
                kept = part.column(i).to_pylist()
                arrays[i] = pa.array([k if a == b else len(b) for k, a, b in zip(kept, old, new)], part.schema.field(i).type)
            yield pa.RecordBatch.from_arrays(arrays, names=columns)

    return docs.mapInArrow(run, docs.schema)
