"""Operator 4: byte-level BPE, encoded and decoded, with vectorised pre-tokenisation.

The split pattern of the rank files is a small automaton over classes of code points. Every class is a
function from state to state; the functions and their compositions are a finite set, numbered, with a
table of compositions. A doubling scan over these numbers gives the state before every code point of
many texts at once: composition is associative, and most classes forget the state, so that the scan
ends after two or three rounds. A table over (state, class) then says where pieces begin.

Pieces are looked up among those met before; a new one is merged pair by pair, lowest rank first. Ids
are kept as little-endian unsigned 32-bit integers. Decoding looks up where each id's bytes begin and
end, and fills the text by these offsets.

Edge cases: a null or empty text has no ids and decodes to no bytes; null and repeated doc_ids pass
through, row by row; an empty table gives an empty result. Texts are worked on in chunks of a few MB,
a longer text alone; the kept pieces are bounded.
"""

from __future__ import annotations

import base64
import heapq
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleslens.llm.shared import parts_of

KNOWN_PIECES = 250_000
LONG_PIECE = 64  # bytes from which merges are queued instead of searched

# White space as the split pattern understands it.
WHITE_SPACE = [
    *range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
]
# Endings of a contraction, by their number of letters.
SHORT_ENDINGS = "stmd"
LONG_ENDINGS = ["re", "ve", "ll"]

# Classes of code points, the last ones set by what follows.
LETTER, NUMBER, OTHER, SPACE, JOINS, LAST, ONE_LEFT, TWO_LEFT, BETWEEN = range(9)
# States: nothing yet, in a run of each kind, after a space that joins the next run, within a contraction.
START, IN_LETTERS, IN_NUMBERS, IN_OTHERS, IN_SPACE, JOINING, TWO_TO_GO, ONE_TO_GO = range(8)
STATES = 8


def _step(state: int, kind: int) -> tuple[int, bool]:
    """Next state, and whether a piece begins before this code point."""
    if kind == BETWEEN:
        return START, True
    if kind == JOINS:
        return JOINING, True
    if kind == LAST:
        return IN_SPACE, True
    if kind == SPACE:
        return IN_SPACE, state != IN_SPACE
    if kind in (ONE_LEFT, TWO_LEFT):
        if state in (IN_OTHERS, JOINING):
            return IN_OTHERS, False
        return (ONE_TO_GO if kind == ONE_LEFT else TWO_TO_GO), True
    if kind == LETTER and state == TWO_TO_GO:
        return ONE_TO_GO, False
    if kind == LETTER and state == ONE_TO_GO:
        return START, False
    run = {LETTER: IN_LETTERS, NUMBER: IN_NUMBERS, OTHER: IN_OTHERS}[kind]
    return run, state not in (run, JOINING)


def _compositions() -> tuple[np.ndarray, np.ndarray]:
    """Table of compositions of the numbered functions (classes come first), and the state a constant
    function gives (-1: not constant)."""
    functions = [tuple(_step(s, k)[0] for s in range(STATES)) for k in range(BETWEEN + 1)]
    numbers = {f: i for i, f in reversed(list(enumerate(functions)))}
    pairs: dict[tuple[int, int], int] = {}
    size = 0
    while size < len(functions):
        size = len(functions)
        for i, first in enumerate(functions[:size]):
            for j, second in enumerate(functions[:size]):
                if (i, j) not in pairs:
                    both = tuple(second[s] for s in first)
                    if both not in numbers:
                        numbers[both] = len(functions)
                        functions.append(both)
                    pairs[i, j] = numbers[both]
    table = np.zeros((size, size), np.uint8)
    for (i, j), both in pairs.items():
        table[i, j] = both
    constant = np.array([f[0] if len(set(f)) == 1 else -1 for f in functions], np.int8)
    return table, constant


COMPOSED, CONSTANT = _compositions()
BEGINS = np.array([[_step(s, k)[1] for k in range(BETWEEN + 1)] for s in range(STATES)])


@lru_cache(maxsize=1)
def code_point_classes() -> np.ndarray:
    kinds = np.full(0x110000, OTHER, np.uint8)
    for point in range(0x110000):
        major = unicodedata.category(chr(point))[0]
        if major in "LN":
            kinds[point] = LETTER if major == "L" else NUMBER
    kinds[WHITE_SPACE] = SPACE
    return kinds


def piece_starts(texts: list[str]) -> tuple[str, np.ndarray, np.ndarray]:
    """The texts joined by one code point each, where pieces begin (those code points too), and where
    texts begin."""
    joined = "\n".join(texts) + "\n"
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = np.cumsum([len(t) + 1 for t in texts]) - 1
    kinds = code_point_classes()[points]
    kinds[ends] = BETWEEN
    space = kinds == SPACE
    before_run = np.flatnonzero(space[:-1] & ~space[1:] & (kinds[1:] != BETWEEN))
    kinds[before_run] = np.where(points[before_run] == ord(" "), JOINS, LAST)
    for at in np.flatnonzero(points == ord("'")):
        if joined[at + 1] in SHORT_ENDINGS and kinds[at + 1] != BETWEEN:
            kinds[at] = ONE_LEFT
        elif joined[at + 1 : at + 3] in LONG_ENDINGS:
            kinds[at] = TWO_LEFT
    state = CONSTANT[_scanned(kinds)]
    before = np.empty_like(state)
    before[0], before[1:] = START, state[:-1]
    starts = np.flatnonzero(BEGINS[before, kinds])
    return joined, starts, np.concatenate([[0], ends + 1])


def _scanned(kinds: np.ndarray) -> np.ndarray:
    """For each place the number of a constant function: the composition of all up to it.

    The first place is composed with START by hand, so that every composition is constant in the end.
    """
    scanned = kinds.copy()
    constants = {int(CONSTANT[f]): f for f in range(len(CONSTANT)) if CONSTANT[f] >= 0}
    scanned[0] = constants[_step(START, int(kinds[0]))[0]]
    open_ = np.flatnonzero(CONSTANT[scanned] < 0)
    reach = 1
    while len(open_):
        scanned[open_] = COMPOSED[scanned[open_ - reach], scanned[open_]]
        open_ = open_[CONSTANT[scanned[open_]] < 0]
        reach *= 2
    return scanned


class Ranks:
    """A rank file: merging, and the bytes of each id."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.known: dict[str, bytes] = {}
        by_id = {rank: token for token, rank in self.ranks.items()}
        tokens = [by_id.get(i, b"") for i in range(max(by_id) + 1)]
        self.pool = np.frombuffer(b"".join(tokens), np.uint8)
        self.sizes = np.array([len(t) for t in tokens], np.int64)
        self.begins = np.cumsum(self.sizes) - self.sizes

    def merge(self, piece: bytes) -> list[int]:
        """Ids of a piece: the pair of lowest rank is joined first, the leftmost of equals."""
        ranks = self.ranks
        if piece in ranks:
            return [ranks[piece]]
        if len(piece) >= LONG_PIECE:
            return self._merge_long(piece)
        parts = [piece[i : i + 1] for i in range(len(piece))]
        found = [ranks.get(a + b) for a, b in zip(parts, parts[1:])]
        while True:
            best, at = None, -1
            for i, rank in enumerate(found):
                if rank is not None and (best is None or rank < best):
                    best, at = rank, i
            if best is None:
                return [ranks[p] for p in parts]
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del found[at]
            if at < len(found):
                found[at] = ranks.get(parts[at] + parts[at + 1])
            if at:
                found[at - 1] = ranks.get(parts[at - 1] + parts[at])

    def _merge_long(self, piece: bytes) -> list[int]:
        """The same with a queue of pairs over a linked list: n log n for a piece of n bytes."""
        ranks, size = self.ranks, len(piece)
        stop = list(range(1, size + 1))  # part i is piece[i:stop[i]]; 0 once it was joined to another
        left = list(range(-1, size - 1))
        queue = [(ranks[piece[i : i + 2]], i, i + 1, i + 2) for i in range(size - 1) if piece[i : i + 2] in ranks]
        heapq.heapify(queue)
        while queue:
            _, a, b, end = heapq.heappop(queue)
            if stop[a] != b or b >= size or stop[b] != end:
                continue
            stop[a], stop[b] = end, 0
            if end < size:
                left[end] = a
                if (rank := ranks.get(piece[a : stop[end]])) is not None:
                    heapq.heappush(queue, (rank, a, end, stop[end]))
            if (before := left[a]) >= 0 and (rank := ranks.get(piece[before:end])) is not None:
                heapq.heappush(queue, (rank, before, a, end))
        ids, at = [], 0
        while at < size:
            ids.append(ranks[piece[at : stop[at]]])
            at = stop[at]
        return ids

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        joined, starts, begins = piece_starts(texts)
        known = self.known
        if len(known) > KNOWN_PIECES:
            known.clear()
        bounds = starts.tolist()
        pieces = [joined[a:b] for a, b in zip(bounds, bounds[1:])]  # the last start is a joint
        for piece in set(pieces).difference(known):
            known[piece] = np.array(self.merge(piece.encode("utf-8", "surrogatepass")), "<u4").tobytes()
        first = np.searchsorted(starts, begins[:-1]).tolist()
        last = np.searchsorted(starts, begins[1:] - 1).tolist()
        return [b"".join(map(known.__getitem__, pieces[a:b])) for a, b in zip(first, last, strict=True)]

    def offsets(self, ids: np.ndarray) -> np.ndarray:
        """Where each id's bytes begin in the text, and the text's size at the end."""
        return np.concatenate([[0], np.cumsum(self.sizes[ids])])

    def decode(self, ids: np.ndarray) -> bytes:
        at = self.offsets(ids)
        shift = np.repeat(self.begins[ids] - at[:-1], self.sizes[ids])
        return self.pool[shift + np.arange(at[-1])].tobytes()

    def decode_all(self, encoded: list[bytes]) -> list[bytes]:
        return [self.decode(np.frombuffer(ids, "<u4").astype(np.int64)) for ids in encoded]


@lru_cache(maxsize=2)
def ranks_of(path: str) -> Ranks:
    return Ranks(path)


def encode_documents(docs: DataFrame, ranks: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ids (binary, little-endian unsigned 32-bit) of whole texts, without a shuffle."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc_ids, ids in _encoded(batches, ranks):
            yield pa.RecordBatch.from_arrays([doc_ids, pa.array(ids, pa.binary())], ["doc_id", "ids"])

    return _rows(docs, id_col, text_col).mapInArrow(encode, "doc_id long, ids binary")


def decode_documents(encoded: DataFrame, ranks: str) -> DataFrame:
    """doc_id, ids and the decoded bytes."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (part for batch in batches for part in parts_of(batch, "ids")):
            texts = ranks_of(ranks).decode_all(part.column("ids").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("ids"), pa.array(texts, pa.binary())], ["doc_id", "ids", "decoded"]
            )

    return encoded.mapInArrow(decode, "doc_id long, ids binary, decoded binary")


def round_trip(docs: DataFrame, ranks: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids and the bytes decoded from these ids, in one pass over the texts."""

    def encode_decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc_ids, ids in _encoded(batches, ranks):
            columns = [doc_ids, pa.array(ids, pa.binary()), pa.array(ranks_of(ranks).decode_all(ids), pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "decoded"])

    return _rows(docs, id_col, text_col).mapInArrow(encode_decode, "doc_id long, ids binary, decoded binary")


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))


def _encoded(batches: Iterator[pa.RecordBatch], ranks: str) -> Iterator[tuple[pa.Array, list[bytes]]]:
    vocabulary = ranks_of(ranks)
    for part in (part for batch in batches for part in parts_of(batch)):
        yield part.column("doc_id"), vocabulary.encode([t or "" for t in part.column("text").to_pylist()])


def digests(decoded: DataFrame, *also: str) -> DataFrame:
    """doc_id, columns of `decoded` that are wanted too, number of ids, digests of ids and bytes."""
    return decoded.select(
        "doc_id",
        *also,
        (F.octet_length("ids") / F.lit(4)).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def query(docs: DataFrame, ranks: str) -> DataFrame:
    """Contract of op4."""
    return digests(round_trip(docs, ranks))
