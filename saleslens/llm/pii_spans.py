"""Operator 12: personal data by fixed patterns and a semi-Markov conditional random field.

Four kinds: e-mail addresses, IP addresses, card numbers, phone numbers. Spans that the patterns of
`PATTERNS` match, and that pass the test of their kind, always stay. The model adds spans in forms that no
pattern lists (a phone number without country code, an address with its `@` and dots written out or
bracketed, groups of a card number parted by dots). It is a conditional random field over segments: a text
near digits, `@` or a written-out dot is cut into atoms (runs of digits, runs of letters, single signs), any run
of at most `LONGEST` atoms may be a segment of one kind, and the features describe the segment as a whole:
digits in all, number and lengths of digit groups, check digit, separators, what touches its edges. A
dynamic program over the segments chooses boundaries and kinds of all spans of a stretch together. Everything
outside scores zero, as every segment needs at least `LEAST_DIGITS` digits or an at-sign, so stretches without
these are never looked at, and only segments with a positive score can be part of the best choice.

The weights are trained on the driver by the exact likelihood (forward-backward over segments) on
`EXAMPLES` stretches: numbers and addresses in many written forms, and look-alikes (dates, amounts, versions,
hashes, article numbers, failed check digits), drawn with a fixed seed and set between words of at most `SAMPLE` documents. No label is
read. Scoring happens where a text is read, whole and without a shuffle; memory grows with the longest text.

Offsets are code points, ends exclusive. Edge cases: null and empty texts have no spans; null and repeated
doc_ids pass through row by row; an empty table gives an empty result; other columns are not read, whatever
their names. Spans of different kinds may overlap only if both match a pattern.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleslens.llm.shared import byte_texts, parts_of

KINDS = ["email", "ip", "card", "phone"]
LONGEST = 24  # atoms of a segment
LEAST_DIGITS = 7
MARGIN = 48  # bytes around a number or an at-sign that a stretch covers
SAMPLE = 200  # documents that lend words to the training stretches
EXAMPLES = 1500
EPOCHS = 120
SEED = 7

# Fixed patterns of the spans that always stay, and what their matches must hold.
PATTERNS = {
    "email": re.compile(rb"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(rb"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)"),
    "card": re.compile(rb"[0-9](?:[\x20-]?[0-9])+"),
    "phone": re.compile(rb"\+[0-9][\x20().0-9-]+[0-9]"),
}


def luhn(digits: bytes) -> bool:
    total = 0
    for i, digit in enumerate(reversed(digits)):
        value = digit - 48
        if i % 2:
            value = 2 * value - 9 * (value > 4)
        total += value
    return total % 10 == 0


def _digits(match: bytes) -> bytes:
    return bytes(b for b in match if 48 <= b <= 57)


def passes(kind: str, match: bytes) -> bool:
    if kind == "ip":
        return all(int(part) <= 255 for part in match.split(b".") if part)
    if kind == "card":
        digits = _digits(match)
        return 14 <= len(digits) <= 19 and luhn(digits)
    if kind == "phone":
        return 10 <= len(_digits(match)) <= 15
    return True


def _table(characters: str) -> np.ndarray:
    table = np.zeros(256, bool)
    table[[ord(c) for c in characters]] = True
    return table


_DIGIT = "0123456789"
_LETTER = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
IN_MAIL = _table(_DIGIT + _LETTER + "._%+-@")
IN_NUMBER = _table(_DIGIT + " ().-+")
IN_STRETCH = _table(_DIGIT + " ().-+/[]:,_")
IS_DIGIT = _table(_DIGIT)
ALNUM = _table(_DIGIT + _LETTER) | (np.arange(256) >= 0x80)


def _runs(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    return edges[::2], edges[1::2]


class Joined:
    """Several texts as bytes, a line end behind each; no span crosses a line end of this kind."""

    def __init__(self, texts: list[bytes]):
        self.raw = b"\n".join(texts) + b"\n"
        self.data = np.frombuffer(self.raw, np.uint8)
        self.first = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
        self.behind = np.concatenate([[0], np.cumsum((self.data & 0xC0) == 0x80)])
        self.digits = np.concatenate([[0], np.cumsum(IS_DIGIT[self.data])])

    def places(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Text and code point of byte positions."""
        text = np.searchsorted(self.first, at, "right") - 1
        first = self.first[text]
        return text, at - first - (self.behind[at] - self.behind[first])


def fixed_spans(joined: Joined) -> list[tuple[int, int, str]]:
    """(start, stop, kind) in bytes of all matches that stay.

    A match consists of characters of one class, so searching the runs of this class that can hold
    one finds what a search of the whole text would.
    """
    found = []
    starts, stops = _runs(IN_MAIL[joined.data])
    signs = np.flatnonzero(joined.data == ord("@"))
    for i in np.unique(np.searchsorted(starts, signs, "right") - 1):
        found += _matches(joined, "email", starts[i], stops[i])
    starts, stops = _runs(IN_NUMBER[joined.data])
    digits = joined.digits[stops] - joined.digits[starts]
    for i in np.flatnonzero(digits >= 4):
        found += _matches(joined, "ip", starts[i], stops[i])
        if digits[i] >= 10:
            found += _matches(joined, "phone", starts[i], stops[i])
        if digits[i] >= 14:
            found += _matches(joined, "card", starts[i], stops[i])
    return sorted(found, key=lambda span: (span[0], KINDS.index(span[2])))


def _matches(joined: Joined, kind: str, start: int, stop: int) -> Iterator[tuple[int, int, str]]:
    part = joined.raw[start:stop]
    for match in PATTERNS[kind].finditer(part):
        if passes(kind, match.group()):
            yield int(start) + match.start(), int(start) + match.end(), kind


# Stretches and their atoms

ATOM = re.compile(rb"[0-9]+|[A-Za-z\x80-\xff]+|[^\s]")


def stretches(joined: Joined) -> list[tuple[int, int]]:
    """Byte ranges around numbers, at-signs and written-out dots, within a line."""
    data = joined.data
    starts, stops = _runs(IN_STRETCH[data])
    many = joined.digits[stops] - joined.digits[starts] >= LEAST_DIGITS
    lower = data | 0x20
    dot = np.flatnonzero((lower[:-2] == ord("d")) & (lower[1:-1] == ord("o")) & (lower[2:] == ord("t")))
    dot = dot[(dot > 0) & ~ALNUM[data[dot - 1]] & ~ALNUM[data[np.minimum(dot + 3, len(data) - 1)]]]
    sign = np.flatnonzero(data == ord("@"))
    first = np.concatenate([starts[many], dot, sign])
    last = np.concatenate([stops[many], dot + 3, sign + 1])
    order = np.argsort(first, kind="stable")
    ends = np.flatnonzero(data == 0x0A)
    out: list[tuple[int, int]] = []
    for a, b in zip(first[order], last[order], strict=True):
        line = np.searchsorted(ends, a)
        a, b = max(a - MARGIN, ends[line - 1] + 1 if line else 0), min(b + MARGIN, ends[line])
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], int(b)))
        else:
            out.append((int(a), int(b)))
    return [(_widened(data, a, -1), _widened(data, b, 1)) for a, b in out]


def _widened(data: np.ndarray, at: int, step: int) -> int:
    """Move an edge out of a word, so that no atom is cut."""
    while 0 < at < len(data) and ALNUM[data[at - 1]] and ALNUM[data[at]]:
        at += step
    return at


@dataclass
class Atoms:
    start: np.ndarray
    stop: np.ndarray
    stretch: np.ndarray
    values: list[bytes]


def atoms_of(raw: bytes, ranges: list[tuple[int, int]]) -> Atoms:
    start, stop, stretch, values = [], [], [], []
    reached = 0
    for number, (a, b) in enumerate(ranges):
        for match in ATOM.finditer(raw, max(a, reached), b):
            start.append(match.start())
            stop.append(match.end())
            stretch.append(number)
            values.append(match.group())
        reached = max(reached, b)
    return Atoms(np.array(start, np.int64), np.array(stop, np.int64), np.array(stretch, np.int64), values)


@dataclass
class Segments:
    """Segments that may be spans: first atom, atom behind the last, features of the whole."""

    first: np.ndarray
    last: np.ndarray
    features: np.ndarray


def _steps(values: np.ndarray, bounds: list[int]) -> list[np.ndarray]:
    """One column for each interval between the bounds."""
    edges = [*bounds, np.iinfo(np.int64).max]
    return [(values >= a) & (values < b) for a, b in zip(edges[:-1], edges[1:], strict=True)]


def segments_of(atoms: Atoms, taken: np.ndarray | None = None) -> Segments:
    """All admissible segments. `taken` marks atoms that belong to spans that stay."""
    n = len(atoms.values)
    size = atoms.stop - atoms.start
    digit = np.array([v[:1].isdigit() for v in atoms.values], bool)
    letter = np.array([v[:1].isalpha() or v[0] >= 0x80 for v in atoms.values], bool)
    word = [v.lower() if ok else b"" for v, ok in zip(atoms.values, letter, strict=True)]
    sign = np.array([0 if d or c else v[0] for v, d, c in zip(atoms.values, digit, letter, strict=True)], np.int64)
    gap = np.concatenate([[0], atoms.start[1:] - atoms.stop[:-1]])
    at_word = np.array([w == b"at" for w in word], bool)
    dot_word = np.array([w == b"dot" for w in word], bool)
    at, dot = at_word | (sign == ord("@")), dot_word | (sign == ord("."))
    byte_value = np.array([d and len(v) <= 3 and int(v) <= 255 for v, d in zip(atoms.values, digit, strict=True)], bool)
    barrier = gap > 1
    blocked = np.zeros(n, bool) if taken is None else taken

    def sums(flags) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(flags)])

    total = {
        "digits": sums(size * digit), "letters": sums(size * letter), "groups": sums(digit), "words": sums(letter),
        "at": sums(at), "dot": sums(dot), "blank": sums(gap == 1), "barrier": sums(barrier), "blocked": sums(blocked),
        "hyphen": sums(sign == ord("-")), "bracket": sums(np.isin(sign, [ord(c) for c in "()[]{}"])),
        "slash": sums(np.isin(sign, [ord(c) for c in "/:,"])), "byte": sums(byte_value), "written": sums(at_word | dot_word), "spelled": sums(dot_word), "sign": sums(sign == ord("@")),
        "odd": sums((sign > 0) & ~np.isin(sign, [ord(c) for c in "@.-()[]{}/:,+_%"])), "under": sums(np.isin(sign, [ord(c) for c in "_%+"])),
    }
    named = letter & ~at_word & ~dot_word
    opens = digit | named | (sign == ord("+")) | (sign == ord("("))
    closes = digit | named
    firsts, lasts, longest, shortest = [], [], [], []
    top, low = size * digit, np.where(digit, size, 1 << 30)
    for length in range(1, LONGEST + 1):
        if length > n:
            break
        if length > 1:
            top = np.maximum(top[:-1], (size * digit)[length - 1 :])
            low = np.minimum(low[:-1], np.where(digit, size, 1 << 30)[length - 1 :])
        i = np.arange(n - length + 1)
        j = i + length
        good = (atoms.stretch[i] == atoms.stretch[j - 1]) & opens[i] & closes[j - 1]
        good &= total["barrier"][j] - total["barrier"][i + 1] == 0
        good &= total["blocked"][j] - total["blocked"][i] == 0
        good &= total["odd"][j] - total["odd"][i] == 0
        spelled = (total["spelled"][j] > total["spelled"][i]) | (total["bracket"][j] - total["bracket"][i] >= 2)
        address = (total["at"][j] - total["at"][i] == 1) & (total["dot"][j] > total["dot"][i])
        address &= (total["sign"][j] > total["sign"][i]) | spelled  # "at" and a full stop alone are plain prose
        good &= (total["digits"][j] - total["digits"][i] >= LEAST_DIGITS) | address
        firsts.append(i[good])
        lasts.append(j[good])
        longest.append(top[good])
        shortest.append(low[good])
    if not firsts:
        return Segments(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, 0)))
    i, j = np.concatenate(firsts), np.concatenate(lasts)
    longest, shortest = np.concatenate(longest), np.concatenate(shortest)
    has = {name: total[name][j] - total[name][i] for name in total}
    has["blank"] = total["blank"][j] - total["blank"][i + 1]
    after = np.minimum(j, n - 1)
    near_left = (i > 0) & (gap[i] == 0) & (atoms.stretch[np.maximum(i - 1, 0)] == atoms.stretch[i])
    near_right = (j < n) & (gap[after] == 0) & (atoms.stretch[after] == atoms.stretch[j - 1])
    solid = ~np.isin(sign, [ord(c) for c in ".,;:!?*%$#&()\"'"])
    check = np.zeros(len(i), bool)
    for s in np.flatnonzero((has["letters"] == 0) & (has["digits"] >= 13) & (has["digits"] <= 19)):
        check[s] = luhn(b"".join(v for v, d in zip(atoms.values[i[s] : j[s]], digit[i[s] : j[s]], strict=True) if d))
    numeric = has["letters"] == 0
    mail = (has["at"] == 1) & (has["dot"] >= 1) & letter[j - 1] & (size[j - 1] >= 2) & (size[j - 1] <= 6)
    quad = (has["groups"] == 4) & (has["byte"] == 4)
    plain = (has["slash"] == 0) & (has["under"] == 0)
    phone = numeric & (has["digits"] >= 10) & (has["digits"] <= 15) & (longest <= 5) & (has["groups"] >= 2)
    columns = [np.ones(len(i), bool)]
    columns += _steps(has["digits"], [0, 1, 4, 7, 10, 11, 12, 13, 14, 16, 17, 20])
    columns += _steps(has["letters"], [0, 1, 3, 8])
    columns += _steps(has["groups"], [0, 1, 2, 3, 4, 5, 7])
    columns += _steps(longest, [0, 1, 4, 5, 7, 13])
    columns += _steps(shortest, [0, 2, 3, 4, 5])
    columns += _steps(has["dot"], [0, 1, 2, 3, 4])
    columns += _steps(has["blank"], [0, 1, 2, 3, 4, 6])
    columns += _steps(has["hyphen"], [0, 1, 2, 3, 4])
    columns += _steps(has["bracket"], [0, 2, 3, 5])
    columns += _steps(has["slash"], [0, 1, 2])
    columns += [has["at"] == 1, has["at"] > 1, has["written"] > 0, has["under"] > 0]
    columns += [near_left & solid[np.maximum(i - 1, 0)], near_right & solid[after]]
    columns += [(i > 0) & (gap[i] == 1) & digit[np.maximum(i - 1, 0)], (j < n) & (gap[after] == 1) & digit[after]]
    columns += [sign[i] == ord("+"), sign[i] == ord("("), digit[i], digit[j - 1], letter[i]]
    columns += [check & plain, check & plain & (has["dot"] == 3), check & (has["digits"] == 16), numeric & ~check & (has["digits"] >= 13)]
    columns += [mail, mail & (has["groups"] + has["words"] - has["written"] == has["dot"] + 2), mail & (has["blank"] == 0), mail & (has["written"] >= 2)]
    columns += [quad & numeric & (has["dot"] == 3), quad & numeric & plain & (has["bracket"] == 6), quad & (has["written"] == 3), quad & (has["dot"] == 3)]
    columns += [phone & plain, phone & plain & (has["dot"] <= 2), phone & (has["bracket"] == 2), phone & plain & (has["groups"] <= 4)]
    columns += [phone & (shortest >= 2) & (has["groups"] == 3), numeric & (has["groups"] == 1), ~numeric & (has["at"] == 0)]
    return Segments(i, j, np.stack(columns, 1).astype(np.float32))


# The model


@dataclass
class Model:
    """Weight of each feature for each kind."""

    weights: np.ndarray

    def scores(self, segments: Segments) -> np.ndarray:
        if not len(segments.first):
            return np.zeros((0, len(KINDS)))
        return segments.features @ self.weights

    def decode(self, atoms: Atoms, segments: Segments) -> list[tuple[int, int, str, float]]:
        """The best-scoring set of segments without overlap: (first atom, atom behind the last, kind, score)."""
        scores = self.scores(segments)
        kind, best = scores.argmax(1) if len(scores) else np.zeros(0, int), scores.max(1, initial=0)
        useful = np.flatnonzero(best > 0)
        useful = useful[np.lexsort((segments.first[useful], segments.last[useful]))]
        ends = segments.last[useful]
        value, taken = np.zeros(len(useful) + 1), np.zeros(len(useful) + 1, bool)
        before = np.searchsorted(ends, segments.first[useful], "right")
        for n, (s, b) in enumerate(zip(useful, before, strict=True)):
            gain = value[b] + best[s]
            taken[n + 1] = gain > value[n]
            value[n + 1] = max(gain, value[n])
        out, n = [], len(useful)
        while n:
            if taken[n]:
                s = useful[n - 1]
                out.append((int(segments.first[s]), int(segments.last[s]), KINDS[kind[s]], float(best[s])))
                n = before[n - 1]
            else:
                n -= 1
        return out[::-1]


class Chains:
    """Forward and backward sums over all ways to cut stretches into segments."""

    def __init__(self, atoms: Atoms, segments: Segments):
        self.count = int(atoms.stretch[-1]) + 1
        origin = np.searchsorted(atoms.stretch, np.arange(self.count))
        self.stretch = atoms.stretch[segments.first]
        self.first, self.last = segments.first - origin[self.stretch], segments.last - origin[self.stretch]
        self.length = int(np.bincount(atoms.stretch).max())
        self.ending = [np.flatnonzero(self.last == p) for p in range(self.length + 1)]
        self.starting = [np.flatnonzero(self.first == p) for p in range(self.length + 1)]

    def _step(self, base: np.ndarray, stretch: np.ndarray, values: np.ndarray) -> np.ndarray:
        top = base.copy()
        np.maximum.at(top, stretch, values)
        total = np.exp(base - top)
        np.add.at(total, stretch, np.exp(values - top[stretch]))
        return top + np.log(total)

    def marginals(self, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Probability of each segment and kind, and the logarithm of each stretch's sum over all cuts."""
        top = scores.max(1)
        joint = top + np.log(np.exp(scores - top[:, None]).sum(1))
        forward = np.zeros((self.length + 1, self.count))
        backward = np.zeros((self.length + 1, self.count))
        for p in range(1, self.length + 1):
            s = self.ending[p]
            forward[p] = self._step(forward[p - 1], self.stretch[s], forward[self.first[s], self.stretch[s]] + joint[s])
        for p in range(self.length - 1, -1, -1):
            s = self.starting[p]
            backward[p] = self._step(backward[p + 1], self.stretch[s], backward[self.last[s], self.stretch[s]] + joint[s])
        total = forward[-1]
        logs = forward[self.first, self.stretch] + backward[self.last, self.stretch] - total[self.stretch]
        return np.exp(scores + logs[:, None]), total


def train(examples: list[tuple[bytes, list[tuple[int, int, str]]]], epochs: int = EPOCHS) -> Model:
    """Weights of the greatest likelihood of the marked spans, with a quadratic penalty, by Adam steps."""
    raw, ranges, marked = b"", [], []
    for text, spans in examples:
        marked += [(len(raw) + a, len(raw) + b, kind) for a, b, kind in spans]
        ranges.append((len(raw), len(raw) + len(text)))
        raw += text + b"\n"
    atoms = atoms_of(raw, ranges)
    segments = segments_of(atoms)
    gold = np.zeros((len(segments.first), len(KINDS)), np.float32)
    place = {(int(a), int(b)): s for s, (a, b) in enumerate(zip(atoms.start[segments.first], atoms.stop[segments.last - 1], strict=True))}
    for a, b, kind in marked:
        if (a, b) in place:
            gold[place[a, b], KINDS.index(kind)] = 1
    chains = Chains(atoms, segments)
    weights = np.zeros((segments.features.shape[1], len(KINDS)))
    mean, square = np.zeros_like(weights), np.zeros_like(weights)
    for step in range(1, epochs + 1):
        chance, _ = chains.marginals(segments.features @ weights)
        gradient = segments.features.T @ (gold - chance) / chains.count - 1e-4 * weights
        mean, square = 0.9 * mean + 0.1 * gradient, 0.99 * square + 0.01 * gradient**2
        weights += 0.15 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    return Model(weights)


# Training stretches


def _number(draw: random.Random, count: int) -> str:
    return "".join(draw.choice(_DIGIT) for _ in range(count))


def _card(draw: random.Random) -> str:
    head = draw.choice("3456") + _number(draw, draw.choice([14, 14, 14, 13]))
    return next(head + d for d in _DIGIT if luhn((head + d).encode()))


def _grouped(draw: random.Random, digits: str, sign: str) -> str:
    return sign.join(digits[i : i + 4] for i in range(0, len(digits), 4))


def _positive(draw: random.Random, word: Callable[[], str]) -> tuple[str, str]:
    """A kind and one of its written forms."""
    kind = draw.choice(KINDS)
    if kind == "card":
        return kind, _grouped(draw, _card(draw), draw.choice(["", " ", "-", ".", " - "]))
    if kind == "ip":
        parts = [str(draw.randint(0, 255)) for _ in range(4)]
        return kind, draw.choice([".", ".", "[.]", "(.)", " dot ", "[dot]"]).join(parts)
    if kind == "phone":
        area, middle, end = (_number(draw, n) for n in draw.choice([(3, 3, 4), (3, 3, 4), (3, 4, 4), (2, 4, 4), (4, 3, 4)]))
        sign = draw.choice(["-", " ", ".", " - "])
        bare = draw.choice([f"({area}) {middle}{sign}{end}", f"({area}){middle}-{end}", sign.join([area, middle, end])])
        return kind, draw.choice(["", "", "1-", "+1 ", "+49 ", "0049 ", "001 "]) + bare
    name = draw.choice(["", f"{word()}.", f"{word()}_"]) + draw.choice([word(), f"{word()}{_number(draw, 2)}", _number(draw, 2)])
    host = [word(), *([f"mail{_number(draw, 1)}"] if draw.random() < 0.3 else []), draw.choice(["com", "org", "net", "example", "de", "info"])]
    at, dot = draw.choice([("@", "."), ("@", "."), (" at ", " dot "), ("[at]", "."), (" (at) ", "."), ("(at)", "(dot)"), (" [at] ", " [dot] "), (" @ ", ".")])
    if not name[0].isalnum():
        name = word()
    return kind, name + at + dot.join(host)


def _look_alike(draw: random.Random, word: Callable[[], str]) -> str:
    card = _card(draw)
    wrong = card[:-1] + draw.choice([d for d in _DIGIT if d != card[-1]])
    return draw.choice(
        [
            wrong,
            _grouped(draw, wrong, draw.choice([" ", "-"])),
            f"{draw.randint(1990, 2030)}-{draw.randint(10, 12)}-{draw.randint(10, 28)} {draw.randint(10, 23)}:{draw.randint(10, 59)}:{draw.randint(10, 59)}",
            f"{draw.randint(1, 28)}.{draw.randint(1, 12)}.{draw.randint(1990, 2030)}",
            f"{draw.randint(1, 28)}/{draw.randint(1, 12)}/{draw.randint(1990, 2030)} - {draw.randint(1, 28)}/{draw.randint(1, 12)}/{draw.randint(1990, 2030)}",
            f"{draw.randint(1, 999)},{_number(draw, 3)},{_number(draw, 3)}.{_number(draw, 2)}",
            f"{draw.randint(0, 9)}.{_number(draw, draw.randint(6, 15))}",
            " ".join(str(draw.randint(0, 10 ** draw.randint(1, 5))) for _ in range(draw.randint(3, 10))),
            ", ".join(str(draw.randint(0, 10 ** draw.randint(1, 7))) for _ in range(draw.randint(3, 8))),
            f"978-{_number(draw, 1)}-{_number(draw, 2)}-{_number(draw, 6)}-{_number(draw, 1)}",
            f"{word()}-{_number(draw, 8)}",
            f"{word().upper()}{_number(draw, draw.randint(7, 12))}",
            "".join(draw.choice("0123456789abcdef") for _ in range(draw.choice([32, 40, 64]))),
            _number(draw, draw.randint(7, 14)),
            _number(draw, draw.randint(17, 30)),
            f"{draw.randint(300, 999)}.{draw.randint(300, 999)}.{draw.randint(256, 999)}.{draw.randint(1, 999)}",
            f"{_number(draw, 1)}.{_number(draw, 1)}.{_number(draw, 2)}.{_number(draw, 6)}",
            f"{word()} @ {word()}",
            f"@{word()} {word()}. {word()}",
            f"{word()} at the {word()}. {word()}",
            f"{word()} dot {word()}",
            f"{draw.randint(1, 99)}:{draw.randint(10, 59)}:{draw.randint(10, 59)}.{_number(draw, 6)}",
        ]
    )


def examples(words: list[str], count: int = EXAMPLES, seed: int = SEED) -> list[tuple[bytes, list[tuple[int, int, str]]]]:
    """Stretches of words with spans and look-alikes in between, and the byte ranges of the spans."""
    draw = random.Random(seed)

    def word() -> str:
        return draw.choice(words)

    def name() -> str:
        return re.sub(r"[^a-z]", "", word().lower()) or draw.choice(["info", "mail", "team"])

    out = []
    for _ in range(count):
        text, spans = b"", []
        for _ in range(draw.choice([1, 1, 1, 2])):
            text += "".join(f"{word()}{draw.choice([' ', ' ', ' ', ', ', ': '])}" for _ in range(draw.randint(0, 4))).encode()
            if draw.random() < 0.5:
                kind, form = _positive(draw, name)
                spans.append((len(text), len(text) + len(form.encode()), kind))
            else:
                form = _look_alike(draw, name)
            text += form.encode() + draw.choice([" ", " ", " ", ". ", ", ", "! ", "*** ", "%%% ", "!! "]).encode()
        text += " ".join(word() for _ in range(draw.randint(0, 3))).encode()
        out.append((text.strip(b" "), spans))
    return out


def _sample_words(texts: DataFrame) -> list[str]:
    """Words of at most `SAMPLE` documents, up to 200 from each, drawn by a hash of the text."""
    texts = texts.where(F.length("text") > 0).select(F.xxhash64("text").alias("draw"), "text")
    draws = [r.draw for r in texts.select("draw").distinct().orderBy("draw").limit(SAMPLE).collect()]
    part = F.slice(F.split(F.substring("text", 1, 4000), r"\s+"), 1, 200)
    rows = texts.where(F.col("draw").isin(draws)).groupBy("draw").agg(F.min(part).alias("words")).collect() if draws else []
    words = sorted({w.strip(".,;:!?") for row in rows for w in row.words if not any(c.isdigit() or c == "@" for c in w)} - {""})
    return [w for w in words if w.isalpha() and len(w) < 20] or ["a", "word"]


def trained(docs: DataFrame, text_col: str = "text") -> Model:
    return train(examples(_sample_words(docs.select(F.col(text_col).alias("text")))))


# The operator

FOUND = "array<struct<kind:string,start:long,end:long,fixed:boolean,score:double>>"
_FOUND_ARROW = pa.list_(
    pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("fixed", pa.bool_()), ("score", pa.float64())])
)


def all_spans(texts: list[bytes], model: Model) -> list[list[dict]]:
    """Spans of each text, in order of start and kind."""
    joined = Joined(texts)
    fixed = fixed_spans(joined)
    spans = [(a, b, kind, True, None) for a, b, kind in fixed]
    atoms = atoms_of(joined.raw, stretches(joined))
    if atoms.values:
        taken = np.zeros(len(atoms.start) + 1, np.int64)
        for a, b, _ in fixed:
            taken[np.searchsorted(atoms.stop, a, "right")] += 1
            taken[np.searchsorted(atoms.start, b)] -= 1
        segments = segments_of(atoms, np.cumsum(taken[:-1]) > 0)
        spans += [(int(atoms.start[i]), int(atoms.stop[j - 1]), kind, False, score) for i, j, kind, score in model.decode(atoms, segments)]
    spans.sort(key=lambda span: (span[0], KINDS.index(span[2])))
    out: list[list[dict]] = [[] for _ in texts]
    edges = np.array([span[:2] for span in spans], np.int64).reshape(-1, 2)
    text, start = joined.places(edges[:, 0])
    _, end = joined.places(edges[:, 1])
    for t, a, b, (_, _, kind, stays, score) in zip(text, start, end, spans, strict=True):
        out[t].append({"kind": kind, "start": int(a), "end": int(b), "fixed": stays, "score": score})
    return out


def find_spans(docs: DataFrame, text_col: str = "text", model: Model | None = None, into: str = "spans") -> DataFrame:
    """The documents with a column of spans (kind, start, end, whether a pattern matched, score of the model)."""
    spark = docs.sparkSession
    given = spark.sparkContext.broadcast(model or trained(docs, text_col))
    kept = [c for c in docs.columns if c != into]
    frame = docs.select(*[F.col(f"`{c}`") for c in kept])
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema) + f", `{into}` {FOUND}"

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts_of(batch, text_col):
                spans = all_spans(byte_texts(part.column(text_col)), given.value)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(spans, _FOUND_ARROW)], names=[*kept, into])

    return frame.mapInArrow(find, schema)


def redact(docs: DataFrame, text_col: str = "text", model: Model | None = None) -> DataFrame:
    """The documents with every span replaced by its kind in angle brackets; a null text stays null."""
    spark = docs.sparkSession
    given = spark.sparkContext.broadcast(model or trained(docs, text_col))
    schema = docs.schema

    def hide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts_of(batch, text_col):
                texts = part.column(text_col).to_pylist()
                spans = all_spans(byte_texts(part.column(text_col)), given.value)
                new = [None if t is None else hidden(t, s) for t, s in zip(texts, spans, strict=True)]
                columns = [pa.array(new, pa.string()) if c == text_col else part.column(c) for c in part.schema.names]
                yield pa.RecordBatch.from_arrays(columns, names=part.schema.names)

    return docs.mapInArrow(hide, schema)


def hidden(text: str, spans: list[dict]) -> str:
    """Overlapping spans are hidden as one, under the kind of the first."""
    out, reached = [], 0
    for span in spans:
        if span["start"] >= reached:
            out += [text[reached : span["start"]], f"<{span['kind'].upper()}>"]
        reached = max(reached, span["end"])
    return "".join([*out, text[reached:]])


DIGEST = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"


def _joined(spans: list[dict]) -> str:
    return ",".join(f"{s['kind']}:{s['start']}:{s['end']}" for s in spans)


def query(docs: DataFrame) -> DataFrame:
    """Counts and digest of the spans that match a pattern, all spans as text, number of added ones."""
    found = find_spans(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, spans in zip(batch.column("doc_id").to_pylist(), batch.column("spans").to_pylist(), strict=True):
                fixed = [s for s in spans if s["fixed"]]
                counts = {f"n_{kind}": sum(s["kind"] == kind for s in fixed) for kind in KINDS}
                sha = hashlib.sha256(_joined(fixed).encode()).hexdigest()
                rows.append({"doc_id": doc_id, **counts, "base_sha256": sha, "spans": _joined(spans), "n_added": len(spans) - len(fixed)})
            schema = pa.schema([("doc_id", pa.int64()), *[(f"n_{k}", pa.int64()) for k in KINDS], ("base_sha256", pa.string()), ("spans", pa.string()), ("n_added", pa.int64())])
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return found.select("doc_id", "spans").mapInArrow(digest, DIGEST)
