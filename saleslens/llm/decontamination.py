"""Operator 7: benchmark decontamination by word windows.

Words are runs of digits, letters and non-ASCII code points with A-Z lower-cased. A window is `size`
consecutive words of a benchmark text; a text of fewer words, but not none, is one window. Every
document word inside an occurrence of a window is hit.

The windows are hashed, sorted and broadcast: their number is checked, and a larger benchmark is cut
into blocks of at most `BLOCK_ITEMS` items and `BLOCK_BYTES` bytes, each scanned against all documents.
Documents are never shuffled. Every hash hit is verified word by word.

Edge cases: null and empty texts have no words, on either side; a null doc_id stays null, repeated
doc_ids are judged row by row; items that repeat an item_id count as one; a null item_id counts as the
empty name; without benchmark items nothing is hit; an empty table gives an empty result.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleslens.llm.shared import byte_texts, parts_of, run_hashes, words_of

WINDOW = 10
BLOCK_ITEMS = 20_000
BLOCK_BYTES = 32 << 20
HITS = "doc_id long, text string, n_words long, spans array<struct<first:int,last:int>>, items array<string>"
_SPAN = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))


class Windows:
    """Hashed windows of some benchmark items, by length."""

    def __init__(self, items: list[tuple[str, bytes]], size: int):
        self.items = [name for name, _ in items]
        joined, starts, stops, hashes, firsts = words_of([text for _, text in items])
        data = joined.tobytes()
        self.words = [data[a:b] for a, b in zip(starts, stops, strict=True)]
        at: dict[int, list[tuple[int, int]]] = {}
        for item, (first, last) in enumerate(zip(firsts[:-1], firsts[1:], strict=True)):
            length = min(size, last - first)
            if length:
                at.setdefault(int(length), []).extend((item, w) for w in range(first, last - length + 1))
        self.by_length = {}
        for length, found in at.items():
            item, word = np.array(found).T
            code = run_hashes(hashes, length)[word]
            order = np.argsort(code, kind="stable")
            self.by_length[length] = (code[order], item[order], word[order])

    def scan(self, texts: list[bytes]):
        """Per text: number of words, hit word spans and item names."""
        joined, starts, stops, hashes, firsts = words_of(texts)
        hit: list[list[tuple[int, int]]] = [[] for _ in texts]
        names: list[set[str]] = [set() for _ in texts]
        data = joined.tobytes()
        for length, (codes, items, places) in self.by_length.items():
            runs = run_hashes(hashes, length)
            low = np.searchsorted(codes, runs)
            for word in np.flatnonzero(codes[np.minimum(low, len(codes) - 1)] == runs):
                text = int(np.searchsorted(firsts, word, "right")) - 1
                if word + length > firsts[text + 1]:
                    continue
                own = [data[starts[w] : stops[w]] for w in range(word, word + length)]
                k, code = int(low[word]), runs[word]
                while k < len(codes) and codes[k] == code:
                    place = places[k]
                    if self.words[place : place + length] == own:
                        begin = int(word - firsts[text])
                        if not hit[text] or hit[text][-1] != (begin, begin + length):
                            hit[text].append((begin, begin + length))
                        names[text].add(self.items[items[k]])
                    k += 1
        return np.diff(firsts), [merged(spans) for spans in hit], [sorted(n) for n in names]


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans without overlap, in order."""
    out: list[tuple[int, int]] = []
    for first, last in sorted(spans):
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], last))
        else:
            out.append((first, last))
    return out


_KNOWN: dict[str, Windows] = {}  # windows of the last block, kept by each worker


def _windows(token: str, block: Broadcast, size: int) -> Windows:
    if token not in _KNOWN:
        _KNOWN.clear()
        _KNOWN[token] = Windows(block.value, size)
    return _KNOWN[token]


def _blocks(benchmark: DataFrame, item_col: str, text_col: str) -> Iterator[list[tuple[str, bytes]]]:
    """The benchmark in blocks of a bounded size, one at a time on the driver."""
    items = benchmark.select(
        F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"), F.col(text_col).alias("text")
    ).where("text is not null")
    block: list[tuple[str, bytes]] = []
    held = 0
    for row in items.toLocalIterator():
        text = row.text.encode()
        if block and (len(block) >= BLOCK_ITEMS or held + len(text) > BLOCK_BYTES):
            yield block
            block, held = [], 0
        block.append((row.item, text))
        held += len(text)
    yield block


def _scan(rows: DataFrame, block: list[tuple[str, bytes]], size: int) -> DataFrame:
    """Add the hits of one block of items to what earlier blocks hit."""
    token, shared = uuid.uuid4().hex, rows.sparkSession.sparkContext.broadcast(block)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = _windows(token, shared, size)
        for part in (part for batch in batches for part in parts_of(batch)):
            n_words, spans, names = windows.scan(byte_texts(part.column("text")))
            before = part.column("spans").to_pylist(), part.column("items").to_pylist()
            spans = [merged([*new, *((s["first"], s["last"]) for s in old)]) for new, old in zip(spans, before[0], strict=True)]
            names = [sorted({*new, *old}) for new, old in zip(names, before[1], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    part.column("text"),
                    pa.array(n_words, pa.int64()),
                    pa.array([[{"first": a, "last": b} for a, b in s] for s in spans], _SPAN),
                    pa.array(names, pa.list_(pa.string())),
                ],
                ["doc_id", "text", "n_words", "spans", "items"],
            )

    return rows.mapInArrow(scan, HITS)


def find_hits(
    docs: DataFrame,
    benchmark: DataFrame,
    size: int = WINDOW,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """doc_id, text, n_words, spans (hit words, ends exclusive, merged) and items (names in string order)."""
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(text_col).alias("text"),
        F.lit(0).cast("long").alias("n_words"),
        F.expr("cast(array() as array<struct<first:int,last:int>>)").alias("spans"),
        F.expr("cast(array() as array<string>)").alias("items"),
    )
    for block in _blocks(benchmark, item_col, item_text_col):
        rows = _scan(rows, block, size)
    return rows


def remove_spans(hits: DataFrame) -> DataFrame:
    """doc_id and text without the bytes from the first to the last hit word of each span."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, out = batch.column("text").to_pylist(), []
            for text, spans in zip(texts, batch.column("spans").to_pylist(), strict=True):
                if spans:
                    raw = text.encode()
                    _, starts, stops, _, _ = words_of([raw])
                    edges = [0, *(x for s in spans for x in (starts[s["first"]], stops[s["last"] - 1])), len(raw)]
                    text = b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)).decode()
                out.append(text)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.string())], ["doc_id", "text"])

    return hits.select("doc_id", "text", "spans").mapInArrow(cut, "doc_id long, text string")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """Rows of `docs`, with all their columns, without a hit word."""
    for block in _blocks(benchmark, "item_id", "text"):
        docs = _clean_rows(docs, block, size)
    return docs


def _clean_rows(docs: DataFrame, block: list[tuple[str, bytes]], size: int) -> DataFrame:
    token, shared = uuid.uuid4().hex, docs.sparkSession.sparkContext.broadcast(block)

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = _windows(token, shared, size)
        for part in (part for batch in batches for part in parts_of(batch)):
            _, spans, _ = windows.scan(byte_texts(part.column("text")))
            yield part.filter(pa.array([not s for s in spans]))

    return docs.mapInArrow(clean, docs.schema)


def sha256_of_items(column: str):
    return F.sha2(F.array_join(column, ","), 256)


def query(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Contract of op7."""
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["last"] - s["first"])
    return find_hits(docs, benchmark).select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        sha256_of_items("items").alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )
