"""Operator 11: ranked lexical search with hashed max-sketches.

A document's score for a query adds, over the query's terms, a weight of the term (rarer terms weigh
more) times the term's impact in the document (its occurrences against the document's length). Terms are
runs of digits, letters and non-ASCII code points, A-Z lower-cased; weights, impacts and scores are whole
numbers, so that results do not depend on the order of addition.

A first pass counts documents, terms and, for the terms of the queries, the documents that hold them. In
the second pass every document folds the impacts of all its terms into a sketch of `width` coordinates, the
largest impact at each hashed coordinate. One matrix product looks up a batch of queries in the sketches of
a chunk of documents: as no impact is above its coordinate, it gives upper bounds of all scores. Each query
then has its documents rescored exactly by falling bound, until the next bound is below the lowest of the
`k` best scores the task has found so far. Tasks hand on k rows a query; nothing else is shuffled, and a
document is read where it lies.

Queries come to the driver in blocks of at most `BLOCK_ITEMS` items and `BLOCK_BYTES` bytes of text (a longer
text is a block of its own); each block is broadcast, scanned against all documents, stored and released.

Edge cases: null and empty texts have no terms, are found by nothing and do not count as documents; rows
that repeat a doc_id are ranked one by one, a null doc_id is the smallest; items with one item_id are one item
whose terms add up, equal rows counting once, and a null item_id is an item like others; items without terms
or matches have no rows; empty tables give an empty result; other columns are not read, whatever their names.
Equal scores are ranked by doc_id, and then in no fixed order, as such rows look the same.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from saleslens.llm.shared import LOWER, WORD_BYTE, byte_texts, chunks, documents_of, shown_id
from saleslens.sources.layers import scratch_folder

TOP = 10
WIDTH = 1024  # coordinates of a sketch
BLOCK_ITEMS = 1024
BLOCK_BYTES = 4 << 20
CHUNK = 4 << 20
LOOKUP = 256  # queries looked up by one matrix product
RESCORED = 64  # documents rescored at a time
SLACK = 1 + 1e-9  # bounds are sums of doubles


@dataclass
class Terms:
    """Terms of some texts: the distinct ones, which stands at each place, and the first place of each text."""

    words: pa.Array
    at: np.ndarray
    firsts: np.ndarray


def terms_of(texts: list[bytes]) -> Terms:
    data = LOWER[np.frombuffer(b"\x00".join(texts) + b"\x00", np.uint8)]
    inside = WORD_BYTE[data]
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    starts, stops = edges[::2], edges[1::2]
    offsets = np.zeros(len(starts) + 1, np.int32)
    np.cumsum(stops - starts, out=offsets[1:])
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(data[inside])]
    coded = pa.Array.from_buffers(pa.binary(), len(starts), buffers).dictionary_encode()
    ends = np.cumsum([len(t) + 1 for t in texts])
    firsts = np.concatenate([[0], np.searchsorted(starts, ends)])
    return Terms(coded.dictionary, coded.indices.to_numpy().astype(np.int64), firsts)


def impacts(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def weights(df: np.ndarray, documents: int) -> np.ndarray:
    return np.floor(1000 * np.log((2 * documents + 2) / (2 * df + 1))).astype(np.int64)


class Block:
    """Some queries: their distinct terms, and each query's term numbers with repeats."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]]):
        self.names = [name for name, _ in items]
        ids: dict[bytes, int] = {}
        self.terms, self.repeats = [], []
        for _, texts in items:
            found = terms_of(texts)
            counts = Counter(found.words.take(pa.array(found.at)).to_pylist())
            self.terms.append(np.array([ids.setdefault(t, len(ids)) for t in counts], np.int64))
            self.repeats.append(np.array(list(counts.values()), np.int64))
        self.words = pa.array(list(ids), pa.binary())

    def numbers(self, words: pa.Array) -> np.ndarray:
        """Number of each word in this block, -1 if no query holds it."""
        if not len(self.words):
            return np.full(len(words), -1)
        return pc.index_in(words, value_set=self.words).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)


def coordinates(words: pa.Array, width: int) -> np.ndarray:
    return np.fromiter((zlib.crc32(w) for w in words.to_pylist()), np.int64, len(words)) % width


def sketches(docs: np.ndarray, places: np.ndarray, values: np.ndarray, count: int, width: int) -> np.ndarray:
    """Largest value of each document at each coordinate."""
    table = np.zeros(count * width)
    np.maximum.at(table, docs * width + places, values.astype(float))
    return table.reshape(count, width)


def _chunks(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, Terms]]:
    for batch in batches:
        texts, ids = byte_texts(batch.column("text")), batch.column("doc_id").to_numpy()
        for start, stop in chunks([len(t) for t in texts], CHUNK):
            yield ids[start:stop], terms_of(texts[start:stop])


def _frequencies(terms: Terms, only: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, term, occurrences) in this order, of the terms marked in `only`."""
    doc = np.repeat(np.arange(len(terms.firsts) - 1), np.diff(terms.firsts))
    at = terms.at
    if only is not None:
        held = only[at]
        doc, at = doc[held], at[held]
    count = max(len(terms.words), 1)
    keys, tf = np.unique(doc * count + at, return_counts=True)
    return keys // count, keys % count, tf


DOCUMENTS, ALL_TERMS = -1, -2


def _statistics(block) -> Callable:
    """Documents a term is in, by the term's number; number of documents and of all their terms."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = block.value
        df = np.zeros(len(queries.words), np.int64)
        documents = total = 0
        for _, terms in _chunks(batches):
            lengths = np.diff(terms.firsts)
            documents += int((lengths > 0).sum())
            total += int(lengths.sum())
            number = queries.numbers(terms.words)
            _, found, _ = _frequencies(terms, number >= 0)
            df += np.bincount(number[found], minlength=len(df))
        held = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([held, [DOCUMENTS, ALL_TERMS]])),
                pa.array(np.concatenate([df[held], [documents, total]])),
            ],
            names=["term", "count"],
        )

    return count


class Best:
    """The k best (score, doc_id) of a query so far: higher scores first, then smaller ids."""

    def __init__(self, k: int):
        self.k, self.scores, self.ids = k, np.zeros(0, np.int64), np.zeros(0, np.int64)

    def least(self) -> int:
        """A score that a document must reach to come in."""
        return max(int(self.scores[-1]), 1) if len(self.scores) == self.k else 1

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        good = scores >= self.least()
        scores, ids = np.append(self.scores, scores[good]), np.append(self.ids, ids[good])
        order = np.lexsort((ids, -scores))[: self.k]
        self.scores, self.ids = scores[order], ids[order]


class Search:
    """One block of queries against chunks of documents."""

    def __init__(self, block: Block, df: np.ndarray, documents: int, total: int, k: int, width: int):
        self.block, self.documents, self.total, self.width = block, documents, total, width
        weight = weights(df, documents)
        place = coordinates(block.words, width)
        self.weights = [weight[t] * n for t, n in zip(block.terms, block.repeats, strict=True)]
        self.lookup = np.zeros((width, len(block.names)))
        for q, (terms, held) in enumerate(zip(block.terms, self.weights, strict=True)):
            np.add.at(self.lookup[:, q], place[terms], held.astype(float))
        self.best = [Best(k) for _ in block.names]
        self.by_term = np.zeros(len(block.words), np.int64)
        self.rescored = 0

    def add(self, ids: np.ndarray, terms: Terms) -> None:
        lengths = np.diff(terms.firsts)
        m = 25 + (75 * lengths * self.documents) // self.total
        doc, term, tf = _frequencies(terms)
        value = impacts(tf, m[doc])
        sketch = sketches(doc, coordinates(terms.words, self.width)[term], value, len(ids), self.width)
        number = self.block.numbers(terms.words)[term]
        asked = number >= 0
        doc, number, value = doc[asked], number[asked], value[asked]
        firsts = np.searchsorted(doc, np.arange(len(ids) + 1))
        for start in range(0, len(self.best), LOOKUP):
            bounds = (sketch @ self.lookup[:, start : start + LOOKUP]) * SLACK
            for q in range(start, min(start + LOOKUP, len(self.best))):
                self._rescore(q, bounds[:, q - start], ids, firsts, number, value)

    def _rescore(self, q: int, bounds, ids, firsts, number, value) -> None:
        best = self.best[q]
        likely = np.flatnonzero(bounds >= best.least())
        if not len(likely):
            return
        likely = likely[np.argsort(-bounds[likely], kind="stable")]
        self.by_term[self.block.terms[q]] = self.weights[q]
        for start in range(0, len(likely), RESCORED):
            part = likely[start : start + RESCORED]
            part = part[bounds[part] >= best.least()]
            if not len(part):
                break
            sizes = firsts[part + 1] - firsts[part]
            ends = np.cumsum(sizes)
            held = np.repeat(firsts[part] - ends + sizes, sizes) + np.arange(ends[-1])
            sums = np.concatenate([[0], np.cumsum(self.by_term[number[held]] * value[held])])
            best.add(sums[ends] - sums[ends - sizes], ids[part])
            self.rescored += len(part)
        self.by_term[self.block.terms[q]] = 0


FOUND = "item int, doc_id long, score long"


def _best_of_task(block, df: np.ndarray, documents: int, total: int, k: int, width: int) -> Callable:
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = Search(block.value, df, documents, total, k, width)
        for ids, terms in _chunks(batches):
            run.add(ids, terms)
        sizes = [len(b.ids) for b in run.best]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)),
                pa.array(np.concatenate([b.ids for b in run.best])),
                pa.array(np.concatenate([b.scores for b in run.best])),
            ],
            names=["item", "doc_id", "score"],
        )

    return search


def _blocks(items: DataFrame, item_col: str, text_col: str, most: int) -> Iterator[Block]:
    """Items in order of their ids, some at a time; the driver holds one block."""
    rows = items.select(
        F.col(item_col).cast("string").alias("item"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    ).distinct()
    held: list[tuple[str | None, list[bytes]]] = []
    size = 0
    for row in rows.orderBy("item", "text").toLocalIterator():
        text = row.text.encode()
        if held and held[-1][0] == row.item:
            held[-1][1].append(text)
        else:
            if held and (len(held) >= most or size + len(text) > BLOCK_BYTES):
                yield Block(held)
                held, size = [], 0
            held.append((row.item, [text]))
        size += len(text)
    if held:
        yield Block(held)


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = TOP,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    width: int = WIDTH,
    block_items: int = BLOCK_ITEMS,
) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of each item."""
    spark: SparkSession = docs.sparkSession
    texts = documents_of(docs, id_col, text_col)
    kind = items.schema[item_col].dataType.simpleString()
    schema = f"item_id {kind}, rank int, doc_id long, score long"
    folder, written = scratch_folder(spark, "lexical"), 0
    for block in _blocks(items, item_col, item_text_col, block_items):
        given = spark.sparkContext.broadcast(block)
        counts = texts.mapInArrow(_statistics(given), "term long, count long").groupBy("term").agg(F.sum("count").alias("count"))
        df = np.zeros(len(block.words), np.int64)
        documents = total = 0
        for term, count in counts.collect():  # one row a term of the block
            if term == DOCUMENTS:
                documents = count
            elif term == ALL_TERMS:
                total = count
            else:
                df[term] = count
        if total:
            found = texts.mapInArrow(_best_of_task(given, df, documents, total, k, width), FOUND)
            order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc("doc_id"))
            best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            numbers = list(enumerate(block.names))
            names = F.broadcast(spark.createDataFrame(numbers, "item int, name string"))  # at most a block of items
            (
                best.join(names, "item")
                .select(F.col("name").cast(kind).alias("item_id"), "rank", shown_id(), "score")
                .write.parquet(f"{folder}/block={written}")
            )
            written += 1
        given.destroy()
    if not written:
        return spark.createDataFrame([], schema)
    paths = [f"{folder}/block={i}" for i in range(written)]
    return spark.read.schema(schema).parquet(*paths)


def query(docs: DataFrame, items: DataFrame) -> DataFrame:
    return search(docs, items)


ORACLE_SQL = r"""
WITH terms AS (
  SELECT row_number() OVER () AS id, doc_id, regexp_extract_all(translate(text,
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t
  FROM documents
), held AS (
  SELECT id, doc_id, len(t) AS n, t FROM terms WHERE len(t) > 0
), total AS (
  SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM held
), counted AS (
  SELECT id, term, count(*) AS tf FROM (SELECT id, unnest(t) AS term FROM held) GROUP BY ALL
), weighted AS (
  SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM counted, total GROUP BY term, docs
), asked AS (
  SELECT item_id, unnest(regexp_extract_all(translate(text,
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT DISTINCT item_id, text FROM benchmark)
), wanted AS (
  SELECT item_id, term, count(*) * w AS w FROM asked JOIN weighted USING (term) GROUP BY item_id, term, w
), scored AS (
  SELECT item_id, h.id, doc_id,
    sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + ((75 * n * docs) // total.terms)))))::BIGINT AS score
  FROM wanted JOIN counted USING (term) JOIN held h ON h.id = counted.id, total GROUP BY item_id, h.id, doc_id
)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS FIRST)::INT AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 10
"""
