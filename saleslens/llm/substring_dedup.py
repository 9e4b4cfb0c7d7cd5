"""Operator 3: removal of repeated byte strings by a hash-compared suffix sort.

Every byte of a string of `size` bytes that also starts earlier (smaller doc_id, or the same document and
an earlier start) is removed. Strings are judged on the input.

A sort of all suffixes would shuffle a row per byte. Instead each string (window) of `size` bytes is known by
its anchor: the leftmost of the GRAM-byte grams in it with the lowest hash. Equal windows have equal
anchors at equal places, and one anchor serves about 35 windows in a row, a segment:

1. grams that anchor more than a thousandth of all segments are found. They are under 1000. Their segments
   are split into windows, each of which is a segment of its own with a hash of the whole window for anchor.
   So a passage's edges, which differ by document, go to as many tasks as there are different windows;
2. every task cuts its texts into segments and, per chunk, hands on one of equal segments: the others
   are repeats already, whatever the rest holds. So a passage in a third of all rows costs one row a chunk;
3. segments meet by anchor. All but the first of equal ones are repeats. Where an anchor has several
   different segments, the windows of the first of each are compared. Those of an anchor with over MOST
   segments are split into windows too, and equal windows meet by hash; so no task holds more of an anchor;
4. the other windows are sorted as suffixes, by anchor and place of the anchor: a mergesort whose comparisons
   find the common extension of two suffixes by binary search over prefix polynomial hashes, in
   log(size) steps. Neighbours that agree in `size` bytes by hash are checked byte by byte;
5. spans meet their texts by document, and are cut out.

Equal segments have equal anchors (a 64-bit hash of 32 bytes) and two equal independent 64-bit hashes of all
their bytes; these are not checked byte by byte. Texts are shuffled once.

Edge cases: null and empty texts have no bytes; texts shorter than `size` lose nothing; a null doc_id
is the smallest; rows that share a doc_id are told apart and ordered by a 64-bit hash of their text, and
fully equal rows count as one and get the same result; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from saleslens.llm.shared import (
    BYTE_CODES,
    Powers,
    byte_texts,
    documents_of,
    mixed,
    odd_numbers,
    parts_of,
    prefix_hashes,
    shown_id,
    slice_hashes,
    stored,
)

SIZE = 100
GRAM = 32
HOT = 1000
MOST = 2000
GRAM_POWERS = Powers(0xA0761D6478BD642F)
SEGMENT_POWERS = Powers(0xE7037ED1A0B428DB)
CHECK_POWERS, CHECK_CODES = Powers(0x8EBC6AF09C88C6E3), odd_numbers(256, 13)
SORT_BYTES = 1 << 20
SEGMENTS = "key long, seg long, check long, doc_id long, digest long, pos long, size long, lead long, covered boolean"


# Segments


def _lowest(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the leftmost lowest value in each window of `width`, by doubling."""
    best, at = values, np.arange(len(values), dtype=np.int32)
    reach = 1
    while reach < width:
        shift = min(reach, width - reach)
        left, right = best[:-shift], best[shift:]
        lower = right < left
        best = np.where(lower, right, left)
        at = np.where(lower, at[shift:], at[:-shift])
        reach += shift
    return at


def segments(texts: list[bytes], size: int):
    """Segments of all texts in order: text, start in it, length, place of the anchor in the segment,
    hash of the anchor and two of the segment (with length and place)."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    none = np.zeros(0, np.int64)
    if len(data) < size:
        return (none,) * 7
    codes = BYTE_CODES[data]
    begins = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    sums = prefix_hashes(codes, GRAM_POWERS)
    at = np.arange(len(data) - GRAM + 1)
    grams = mixed(slice_hashes(sums, at, at + GRAM, GRAM_POWERS)) >> np.uint64(1)
    anchors = _lowest(grams, size - GRAM + 1)
    left = np.repeat(begins[1:], np.diff(begins))[: len(anchors)] - np.arange(len(anchors))
    valid = left >= size
    new = valid.copy()
    new[1:] &= (anchors[1:] != anchors[:-1]) | ~valid[:-1]
    first = np.flatnonzero(new)
    if not len(first):
        return (none,) * 7
    breaks = np.flatnonzero(new | ~valid)
    following = np.searchsorted(breaks, first, "right")
    last = np.append(breaks, len(valid))[following] - 1
    length = last - first + size
    lead = anchors[first] - first
    text = np.searchsorted(begins, first, "right") - 1
    seg, check = _two_hashes(data, first, first + length, (length * 256 + lead).astype(np.uint64))
    return text, first - begins[text], length, lead, grams[anchors[first]], seg, check


def _two_hashes(data: np.ndarray, starts: np.ndarray, stops: np.ndarray, salt: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    one = slice_hashes(prefix_hashes(BYTE_CODES[data], SEGMENT_POWERS), starts, stops, SEGMENT_POWERS)
    two = slice_hashes(prefix_hashes(CHECK_CODES[data], CHECK_POWERS), starts, stops, CHECK_POWERS)
    return mixed(one + salt), mixed(two + salt)


def _split(data: np.ndarray, begins: np.ndarray, start, length, lead, key, size: int):
    """Windows of segments that begin at `begins` in `data`, as segments of their own: number of the segment
    they come from, and the columns start to hash of a segment. Equal windows have equal hashes."""
    counts = length - size + 1
    owner = np.repeat(np.arange(len(counts)), counts)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    depth = lead[owner] - place
    at = begins[owner] + place
    whole = slice_hashes(prefix_hashes(BYTE_CODES[data], GRAM_POWERS), at, at + size, GRAM_POWERS)
    own = mixed(whole + mixed(key[owner].astype(np.uint64) + depth.astype(np.uint64))) >> np.uint64(1)
    return owner, start[owner] + place, np.full(len(owner), size), depth, own, *_two_hashes(data, at, at + size, depth.astype(np.uint64))


def _once(order: np.ndarray, text, start, length, lead, key, seg, check):
    """Per chunk: which segments are the first of their kind, in document order."""
    by = np.lexsort((start, order[text], check, seg, key))
    first = np.ones(len(by), bool)
    first[1:] = np.logical_or.reduce([x[by][1:] != x[by][:-1] for x in (key, seg, check)])
    kept = np.empty(len(by), bool)
    kept[by] = first
    return kept


def merged(owner: np.ndarray, start: np.ndarray, stop: np.ndarray):
    """Spans sorted by owner and start, joined where they touch."""
    if not len(owner):
        return owner, start, stop
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (start[1:] > stop[:-1])
    first = np.flatnonzero(new)
    return owner[first], start[first], stop[np.append(first[1:], len(owner)) - 1]


def _distinct(batch: pa.RecordBatch, *columns: str) -> pa.RecordBatch:
    """The first of rows that agree in some whole numbers: equal rows of the input are one text."""
    keys = np.stack([batch.column(c).to_numpy() for c in columns])
    _, first = np.unique(keys, axis=1, return_index=True)
    return batch if len(first) == batch.num_rows else batch.take(pa.array(np.sort(first)))


def _each_chunk(batches: Iterator[pa.RecordBatch], crowded: np.ndarray, size: int):
    for part in (part for batch in batches for part in parts_of(batch)):
        part = _distinct(part, "doc_id", "digest")
        ids, digests = (part.column(c).to_numpy() for c in ("doc_id", "digest"))
        order = np.empty(len(ids), np.int64)
        order[np.lexsort((digests, ids))] = np.arange(len(ids))
        texts = byte_texts(part.column("text"))
        found = segments(texts, size)
        if not len(found[0]):
            continue
        kept = _once(order, *found)
        hot = kept & np.isin(found[4], crowded)
        if hot.any():
            text, start, length, lead, key, *_ = (column[hot] for column in found)
            data = np.frombuffer(b"".join(texts), np.uint8)
            begins = np.cumsum([0, *map(len, texts)])[text] + start
            owner, *rest = _split(data, begins, start, length, lead, key, size)
            windows = (text[owner], *rest)
            found = tuple(np.concatenate([column[~hot], new]) for column, new in zip(found, windows, strict=True))
            kept = np.concatenate([kept[~hot], _once(order, *windows)])
        yield ids, digests, found, kept


def _crowded(docs: DataFrame, size: int) -> np.ndarray:
    """Grams that anchor over a thousandth of all segments: under 1000."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0
        for _, _, (_, _, _, _, key, *_), kept in _each_chunk(batches, np.zeros(0, np.uint64), size):
            grams, n = np.unique(key[kept], return_counts=True)
            total += int(n.sum())
            many = n >= max(8, int(n.sum()) // HOT)
            yield pa.RecordBatch.from_arrays([pa.array(grams[many].astype(np.int64)), pa.array(n[many])], ["key", "n"])
        yield pa.RecordBatch.from_arrays([pa.array([-1], pa.int64()), pa.array([total], pa.int64())], ["key", "n"])

    found = stored(docs.mapInArrow(count, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")), "crowded")
    total = found.where("key = -1").first()
    least = max(HOT, (total.n if total else 0) // HOT)
    return np.array([r.key for r in found.where((F.col("key") >= 0) & (F.col("n") >= least)).collect()], np.uint64)


def _cut(docs: DataFrame, crowded: np.ndarray, size: int) -> DataFrame:
    """Segments that are first in their chunk, and merged spans of the others."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, digests, (text, start, length, lead, key, seg, check), kept in _each_chunk(batches, crowded, size):
            again = np.flatnonzero(~kept)
            again = again[np.lexsort((start[again], text[again]))]
            t, a, b = merged(text[again], start[again], (start + length)[again])
            spread = mixed((ids[t] ^ (digests[t] + a)).astype(np.uint64)) >> np.uint64(1)
            text, start = np.concatenate([text[kept], t]), np.concatenate([start[kept], a])
            columns = [
                np.concatenate([key[kept], spread]).astype(np.int64),
                np.concatenate([seg[kept].view(np.int64), np.zeros(len(t), np.int64)]),
                np.concatenate([check[kept].view(np.int64), np.zeros(len(t), np.int64)]),
                ids[text],
                digests[text],
                start,
                np.concatenate([length[kept], b - a]),
                np.concatenate([lead[kept], np.zeros(len(t), np.int64)]).astype(np.int64),
                np.concatenate([np.zeros(kept.sum(), bool), np.ones(len(t), bool)]),
            ]
            names = ["key", "seg", "check", "doc_id", "digest", "pos", "size", "lead", "covered"]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)

    return docs.mapInArrow(cut, SEGMENTS)


def _judged(cut: DataFrame) -> DataFrame:
    """Spans that are repeats, and the segments whose windows are to be compared, with the rows of their anchor."""
    ordered = Window.partitionBy("key", "seg", "check").orderBy("doc_id", "digest", "pos")
    alone = Window.partitionBy("key")
    same = F.dense_rank().over(ordered) > 1  # rows of equal texts share the first place
    differ = (F.max("seg").over(alone) != F.min("seg").over(alone)) | (F.max("check").over(alone) != F.min("check").over(alone))
    rows = cut.withColumns({"same": same, "differ": differ, "n": F.count("*").over(alone)})
    again = F.col("covered") | F.col("same")
    return rows.withColumn("covered", again).where(again | F.col("differ")).select(
        "key", "doc_id", "digest", "pos", "size", "lead", "covered", "n"
    )


def _windows(parts: DataFrame, size: int) -> DataFrame:
    """Segments (key, doc_id, digest, pos, lead, part) split into windows, of equal ones the first of each batch;
    and the others as spans that are repeats."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (_distinct(batch, "key", "doc_id", "digest", "pos") for batch in batches):
            ids, digests, pos, lead, key = (batch.column(c).to_numpy() for c in ("doc_id", "digest", "pos", "lead", "key"))
            segs = byte_texts(batch.column("part"))
            lengths = np.array([len(s) for s in segs], np.int64)
            data = np.frombuffer(b"".join(segs), np.uint8)
            owner, start, length, depth, own, seg, check = _split(data, np.cumsum(lengths) - lengths, pos, lengths, lead, key, size)
            order = np.empty(len(ids), np.int64)
            order[np.lexsort((pos, digests, ids))] = np.arange(len(ids))
            kept = _once(order, owner, start, length, depth, own, seg, check)
            spread = mixed((ids[owner] ^ (digests[owner] + start)).astype(np.uint64)) >> np.uint64(1)
            columns = [np.where(kept, own, spread).astype(np.int64), seg.view(np.int64), check.view(np.int64), ids[owner], digests[owner], start, length, depth, ~kept]
            names = ["key", "seg", "check", "doc_id", "digest", "pos", "size", "lead", "covered"]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)

    return parts.mapInArrow(split, SEGMENTS)


# Suffix sort


class Suffixes:
    """Suffixes of a byte string, compared in their first `limit` bytes by prefix polynomial hashes."""

    def __init__(self, data: np.ndarray, limit: int):
        self.data, self.limit = data, limit
        self.sums = prefix_hashes(BYTE_CODES[data], GRAM_POWERS)
        self.steps = [1 << i for i in reversed(range(limit.bit_length()))]

    def extension(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Number of bytes two suffixes have in common, up to the limit."""
        same = np.zeros(len(a), np.int64)
        for step in self.steps:
            fits = np.flatnonzero(same + step <= self.limit)
            x, y = a[fits] + same[fits], b[fits] + same[fits]
            equal = slice_hashes(self.sums, x, x + step, GRAM_POWERS) == slice_hashes(self.sums, y, y + step, GRAM_POWERS)
            same[fits[equal]] += step
        return same

    def before(self, a: np.ndarray, b: np.ndarray, or_equal: np.ndarray) -> np.ndarray:
        """Whether suffix a sorts before b; equal ones as `or_equal` says."""
        same = self.extension(a, b)
        equal = same >= self.limit
        at = np.minimum(same, self.limit - 1)
        return np.where(equal, or_equal, self.data[a + at] < self.data[b + at])

    def sort(self, suffixes: np.ndarray, firsts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Stable mergesort within groups that stand one after the other; gives the new order.

        All groups are merged at once: an item's place in a merged run is its place in its own run plus its
        rank in the other, found by binary search.
        """
        order = np.arange(len(suffixes))
        group = np.repeat(np.arange(len(firsts)), sizes)
        run = 1
        while run < sizes.max(initial=0):
            item = np.flatnonzero(sizes[group] > run)
            base, size = firsts[group[item]], sizes[group[item]]
            place = item - base
            right = (place // run) % 2 == 1
            other = np.where(right, place // run - 1, place // run + 1) * run
            low, high = np.minimum(other, size), np.minimum(other + run, size)
            begin = low.copy()
            mine = suffixes[order[item]]
            while True:
                open_ = np.flatnonzero(low < high)
                if not len(open_):
                    break
                middle = (low[open_] + high[open_]) // 2
                theirs = suffixes[order[base[open_] + middle]]
                goes = self.before(theirs, mine[open_], right[open_])
                low[open_[goes]] = middle[goes] + 1
                high[open_[~goes]] = middle[~goes]
            target = base + place // (2 * run) * (2 * run) + place % run + (low - begin)
            moved = order[item].copy()
            order[target] = moved
            run *= 2
        return order

    def equal_bytes(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        out = np.zeros(len(a), bool)
        offsets = np.arange(self.limit)
        for i in range(0, len(a), 16384):
            x, y = a[i : i + 16384, None] + offsets, b[i : i + 16384, None] + offsets
            out[i : i + 16384] = (self.data[x] == self.data[y]).all(axis=1)
        return out


def repeated_windows(segs: list[bytes], key: np.ndarray, lead: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Windows equal to one of an earlier segment of their anchor: number of the segment, place in it.

    Segments stand in order of anchor, document and position.
    """
    lengths = np.array([len(s) for s in segs], np.int64)
    begins = np.cumsum(lengths) - lengths
    counts = lengths - size + 1
    owner = np.repeat(np.arange(len(segs)), counts)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    depth = lead[owner] - place  # where the anchor stands in the window
    by = np.lexsort((owner, depth, key[owner]))
    owner, place, depth = owner[by], place[by], depth[by]
    new = np.ones(len(by), bool)
    new[1:] = (depth[1:] != depth[:-1]) | (key[owner][1:] != key[owner][:-1])
    firsts = np.flatnonzero(new)
    sizes = np.diff(np.append(firsts, len(by)))
    suffixes = begins[owner] + place
    text = Suffixes(np.frombuffer(b"".join(segs), np.uint8), size)
    order = text.sort(suffixes, firsts, sizes)
    sorted_ = suffixes[order]
    a, b = sorted_[:-1], sorted_[1:]
    neighbours = np.flatnonzero(~new[1:])
    same = neighbours[text.extension(a[neighbours], b[neighbours]) >= size]
    if not text.equal_bytes(a[same], b[same]).all():
        return _by_bytes(segs, key, owner, place, depth, size)  # two strings with one hash: compare bytes alone
    again = order[same + 1]
    return owner[again], place[again]


def _by_bytes(segs, key, owner, place, depth, size):
    seen, again = set(), np.zeros(len(owner), bool)
    for i, (o, p, d) in enumerate(zip(owner, place, depth, strict=True)):
        window = (key[o], d, segs[o][p : p + size])
        again[i] = window in seen
        seen.add(window)
    return owner[again], place[again]


def _compare(rows: DataFrame, size: int) -> DataFrame:
    """(doc_id, digest, pos, size) of repeated windows, merged; rows (key, doc_id, digest, pos, lead, part) come sorted
    by anchor."""

    def spans(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = _distinct(pa.Table.from_batches(held).combine_chunks().to_batches()[0], "key", "doc_id", "digest", "pos")
        ids, digests, pos = (table.column(c).to_numpy() for c in ("doc_id", "digest", "pos"))
        key, lead = table.column("key").to_numpy(), table.column("lead").to_numpy()
        owner, place = repeated_windows(table.column("part").to_pylist(), key, lead, size)
        by = np.lexsort((place, owner))
        owner, start, stop = merged(owner[by], place[by], place[by] + size)
        columns = [ids[owner], digests[owner], pos[owner] + start, stop - start]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["doc_id", "digest", "pos", "size"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, held_bytes = [], 0
        for batch in batches:
            while batch.num_rows:
                key = batch.column("key").to_numpy()
                if held_bytes >= SORT_BYTES:  # up to the next anchor
                    rest = int(np.searchsorted(key, held[-1].column("key")[-1].as_py(), "right"))
                    if rest < len(key):
                        yield spans([*held, batch.slice(0, rest)])
                        held, held_bytes, batch = [], 0, batch.slice(rest)
                        continue
                    part = batch
                else:
                    part = batch.slice(0, 4096)
                held.append(part)
                held_bytes += part.nbytes
                batch = batch.slice(part.num_rows)
        if held:
            yield spans(held)

    return rows.mapInArrow(compare, "doc_id long, digest long, pos long, size long")


# The whole


def _parts(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """Bytes of segments, from the texts they stand in."""
    by_doc = rows.groupBy("doc_id", "digest").agg(F.collect_set(F.struct("key", F.col("pos").alias("start"), "size", "lead")).alias("asked"))
    met = docs.join(by_doc.hint("shuffle_hash"), ["doc_id", "digest"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = byte_texts(batch.column("text"))
            columns = zip(batch.column("doc_id").to_pylist(), batch.column("digest").to_pylist(), batch.column("asked").to_pylist(), texts, strict=True)
            for doc_id, digest, asked, text in columns:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([x["key"] for x in asked], pa.int64()),
                        pa.array([doc_id] * len(asked), pa.int64()),
                        pa.array([digest] * len(asked), pa.int64()),
                        pa.array([x["start"] for x in asked], pa.int64()),
                        pa.array([x["lead"] for x in asked], pa.int64()),
                        pa.array([text[x["start"] : x["start"] + x["size"]] for x in asked], pa.binary()),
                    ],
                    ["key", "doc_id", "digest", "pos", "lead", "part"],
                )

    return met.select("doc_id", "digest", "text", "asked").mapInArrow(cut, "key long, doc_id long, digest long, pos long, lead long, part binary")


def repeated_spans(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """doc_id, digest and spans (start, size) of repeated bytes, of documents that have any."""
    crowded = _crowded(docs, size)
    judged = stored(_judged(_cut(docs, crowded, size)), "judged")
    open_ = judged.where("not covered")
    few = _parts(open_.where(F.col("n") <= MOST), docs).repartition("key").sortWithinPartitions("key", "doc_id", "digest", "pos")
    spans = judged.where("covered").select("doc_id", "digest", "pos", "size").unionByName(_compare(few, size))
    many = open_.where(F.col("n") > MOST)
    if not many.isEmpty():
        windows = _judged(_windows(_parts(many, docs), size))
        spans = spans.unionByName(windows.where("covered").select("doc_id", "digest", "pos", "size"))
    return spans.groupBy("doc_id", "digest").agg(F.collect_list(F.struct(F.col("pos").alias("start"), "size")).alias("spans"))


def with_digest(docs: DataFrame) -> DataFrame:
    return docs.withColumn("digest", F.xxhash64("text"))


def remove_repeats(docs: DataFrame, size: int = SIZE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, kept (the bytes left), removed (the runs of bytes cut out)."""
    docs = with_digest(documents_of(docs, id_col, text_col))
    found = docs.join(repeated_spans(docs, size).hint("shuffle_hash"), ["doc_id", "digest"], "left")

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, kept, runs = byte_texts(batch.column("text")), [], []
            for text, spans in zip(texts, batch.column("spans").to_pylist(), strict=True):
                cut: list[list[int]] = []
                for start, stop in sorted((s["start"], s["start"] + s["size"]) for s in spans or ()):
                    if cut and start <= cut[-1][1]:
                        cut[-1][1] = max(cut[-1][1], stop)
                    else:
                        cut.append([start, stop])
                edges = [0, *(x for run in cut for x in run), len(text)]
                kept.append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
                runs.append([{"start": a, "size": b - a} for a, b in cut])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(t) for t in texts], pa.int64()),
                    pa.array(kept, pa.binary()),
                    pa.array(runs, pa.list_(pa.struct([("start", pa.int64()), ("size", pa.int64())]))),
                ],
                ["doc_id", "n_bytes", "kept", "removed"],
            )

    schema = "doc_id long, n_bytes long, kept binary, removed array<struct<start:long,size:long>>"
    return found.select("doc_id", "text", "spans").mapInArrow(remove, schema)


def query(docs: DataFrame) -> DataFrame:
    """Contract of op3."""
    return remove_repeats(docs).select(
        shown_id(),
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
