"""Operator 2: removal of lines that many documents share, with reversible increments.

A `LineIndex` is a versioned set of tables in the shared folder:

    postings  (k1, k2, doc_id)          every key of every document: the exact record
    counts    (shard, k1, k2, n, first) documents holding the key and the smallest of them
    filters   (shard, n_keys, cells)    one cuckoo filter per shard over the keys in `counts`

A key is a line stripped of `[ \\t-\\r]` at both ends with A-Z lower-cased; lines with keys under
`min_chars` code points are never dropped. Keys are known by two 64-bit hashes (128 bits, not
collision-proof against an adversary). Insertions ask the filters which keys of the batch are surely
new, and only the rest meet the exact counts; deletions lower the counts and take fingerprints of keys
that no document holds any more out of the filters, so deleting a batch undoes its insertion exactly.
A filter that runs full is built anew, larger, from the exact counts.

Edge cases: a null or empty text is one empty line; a null doc_id is the smallest id; rows that share a
doc_id count as one document and each loses the same lines; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saleslens.llm.shared import (
    NO_ID,
    byte_texts,
    documents_of,
    join_hot,
    mixed,
    partitions,
    parts_of,
    shown_id,
    stored,
)

MIN_CHARS = 10
SPACE = b" \t\n\x0b\x0c\r"
LOWERED = bytes(range(256)).lower()  # A-Z alone; bytes of other characters stay
KEYS = ["k1", "k2"]


# Cuckoo filter


class CuckooFilter:
    """Buckets of four 16-bit fingerprints; each key has two buckets, and may be deleted again.

    Works on arrays of 64-bit hashes that are distinct among themselves. Keys whose buckets are both
    full after many moves make `insert` report False: the caller builds a larger filter.
    """

    SLOTS, MOVES = 4, 500

    def __init__(self, cells: np.ndarray):
        self.cells = cells.reshape(-1, self.SLOTS)
        self.mask = np.uint64(len(self.cells) - 1)

    @classmethod
    def for_keys(cls, count: int) -> CuckooFilter:
        buckets = 1 << max(2, int(np.ceil(np.log2(max(count, 1) / (cls.SLOTS * 0.8)))))
        return cls(np.zeros(buckets * cls.SLOTS, np.uint16))

    def _places(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        spread = mixed(hashes.astype(np.uint64))
        prints = (spread >> np.uint64(48)).astype(np.uint16)
        prints[prints == 0] = 1
        one = spread & self.mask
        return prints, one, self._other(one, prints)

    def _other(self, bucket, prints):
        return (bucket ^ mixed(np.asarray(prints, np.uint64))) & self.mask

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        prints, one, two = self._places(hashes)
        wanted = prints[:, None]
        return (self.cells[one] == wanted).any(axis=1) | (self.cells[two] == wanted).any(axis=1)

    def insert(self, hashes: np.ndarray) -> bool:
        prints, one, two = self._places(hashes)
        for second in (False, True):  # all that fit without a move, one per bucket and round
            place = two if second else one
            for _ in range(self.SLOTS):
                if not len(prints):
                    return True
                free = self.cells[place] == 0
                open_ = free.any(axis=1)
                _, first = np.unique(place, return_index=True)
                taken = first[open_[first]]
                self.cells[place[taken], free[taken].argmax(axis=1)] = prints[taken]
                rest = np.ones(len(prints), bool)
                rest[taken] = False
                prints, two, place = prints[rest], two[rest], place[rest]
        return all(self._move_in(int(p), int(b)) for p, b in zip(prints, two, strict=True))

    def _move_in(self, fingerprint: int, bucket: int) -> bool:
        for turn in range(self.MOVES):
            free = np.flatnonzero(self.cells[bucket] == 0)
            slot = int(free[0]) if len(free) else (turn * 7 + fingerprint) % self.SLOTS
            fingerprint, self.cells[bucket, slot] = int(self.cells[bucket, slot]), fingerprint
            if not fingerprint:
                return True
            bucket = int(self._other(np.array([bucket], np.uint64), [fingerprint])[0])
        return False

    def delete(self, hashes: np.ndarray) -> None:
        for fingerprint, one, two in zip(*self._places(hashes), strict=True):
            for bucket in (one, two):
                found = np.flatnonzero(self.cells[bucket] == fingerprint)
                if len(found):
                    self.cells[bucket, found[0]] = 0
                    break


def built(hashes: np.ndarray) -> CuckooFilter:
    size = len(hashes)
    while True:
        made = CuckooFilter.for_keys(size)
        if made.insert(hashes):
            return made
        size = 2 * max(size, 8)


# Keys


def line_keys(text: bytes, min_chars: int) -> list[tuple[int, int] | None]:
    """The two hashes of each line's key, or None for a short key."""
    keys = [line.strip(SPACE) for line in text.translate(LOWERED).split(b"\n")]
    return [
        (xxhash.xxh64_intdigest(key, 1) - 2**63, xxhash.xxh64_intdigest(key, 2) - 2**63)
        if len(key) >= min_chars and (len(key) >= 4 * min_chars or len(key.decode()) >= min_chars)
        else None
        for key in keys
    ]


def postings_of(docs: DataFrame, min_chars: int) -> DataFrame:
    """(k1, k2, doc_id), once per row of `docs`; repeats within a text go before any shuffle."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (part for batch in batches for part in parts_of(batch)):
            ids = part.column("doc_id").to_pylist()
            found = [
                (*key, doc_id)
                for doc_id, text in zip(ids, byte_texts(part.column("text")), strict=True)
                for key in set(line_keys(text, min_chars)) - {None}
            ]
            columns = np.array(found, np.int64).reshape(-1, 3).T
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["k1", "k2", "doc_id"])

    return docs.select("doc_id", "text").mapInArrow(work, "k1 long, k2 long, doc_id long")


def counted(postings: DataFrame, shards: int) -> DataFrame:
    """Documents per key and the smallest one; combined in every task, so hot keys are not gathered."""
    return postings.groupBy(*KEYS).agg(F.count("*").alias("n"), F.min("doc_id").alias("first")).withColumn(
        "shard", F.pmod("k1", F.lit(shards)).cast("int")
    )


# The index


@dataclass(frozen=True)
class LineIndex:
    """One version of the index; `insert` and `delete` give the next one and leave this one as it is."""

    postings: DataFrame
    counts: DataFrame
    filters: DataFrame
    shards: int
    min_chars: int = MIN_CHARS

    @classmethod
    def empty(cls, spark: SparkSession, shards: int | None = None, min_chars: int = MIN_CHARS) -> LineIndex:
        return cls(
            spark.createDataFrame([], "k1 long, k2 long, doc_id long"),
            spark.createDataFrame([], "k1 long, k2 long, n long, first long, shard int"),
            spark.createDataFrame([], "shard int, n_keys long, cells binary"),
            shards or partitions(spark),
            min_chars,
        )

    def insert(self, docs: DataFrame) -> LineIndex:
        """With the keys of documents (doc_id, text) that are not in the index yet."""
        fresh = _once_per_document(postings_of(docs, self.min_chars))
        fresh = stored(fresh, "postings")
        batch = counted(fresh, self.shards)
        asked = stored(self._asked(batch), "asked")
        sure = asked.where("not seen")
        maybe = asked.where("seen").join(
            self.counts.select(*KEYS, F.col("n").alias("old_n"), F.col("first").alias("old_first")), KEYS, "left"
        )
        met = maybe.select(
            *KEYS,
            (F.col("n") + F.coalesce("old_n", F.lit(0))).alias("n"),
            F.least("first", "old_first").alias("first"),
            "shard",
        )
        columns = self.counts.columns
        kept = self.counts.join(asked.where("seen").select(*KEYS), KEYS, "left_anti")
        counts = stored(kept.select(columns).unionByName(sure.select(columns)).unionByName(met.select(columns)), "counts")
        new_keys = maybe.where("old_n is null").select("shard", "k1").unionByName(sure.select("shard", "k1"))
        return LineIndex(
            self.postings.unionByName(fresh), counts, self._grown(new_keys, counts), self.shards, self.min_chars
        )

    def delete(self, docs: DataFrame) -> LineIndex:
        """Without documents; they must have been inserted with the same texts."""
        gone = stored(_once_per_document(postings_of(docs, self.min_chars)), "gone")
        postings = stored(self.postings.join(gone, [*KEYS, "doc_id"], "left_anti"), "postings")
        touched = gone.select(*KEYS).distinct()
        left = counted(postings.join(touched, KEYS, "left_semi"), self.shards)
        columns = self.counts.columns
        counts = stored(self.counts.join(touched, KEYS, "left_anti").select(columns).unionByName(left.select(columns)), "counts")
        dead = touched.join(left, KEYS, "left_anti").withColumn("shard", F.pmod("k1", F.lit(self.shards)).cast("int"))
        return LineIndex(postings, counts, self._shrunk(dead.select("shard", "k1"), counts), self.shards, self.min_chars)

    def shared(self) -> DataFrame:
        """Keys in two documents or more."""
        return self.counts.where("n >= 2").select(*KEYS, "n", "first")

    # A shard holds distinct keys only, so its size is set by the number of shards, never by a hot line.

    def _asked(self, batch: DataFrame) -> DataFrame:
        """The batch's keys with whether the filters may hold them."""

        def ask(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            if len(right) and len(left):
                filter_ = CuckooFilter(np.frombuffer(right["cells"].iloc[0], np.uint16))
                return left.assign(seen=filter_.holds(left["k1"].to_numpy()))
            return left.assign(seen=False)

        schema = "k1 long, k2 long, n long, first long, shard int, seen boolean"
        grouped = batch.select("k1", "k2", "n", "first", "shard").groupBy("shard")
        return grouped.cogroup(self.filters.groupBy("shard")).applyInPandas(ask, schema)

    def _grown(self, new_keys: DataFrame, counts: DataFrame) -> DataFrame:
        def grow(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            if not len(left):
                return right
            added, shard = left["k1"].to_numpy().astype(np.uint64), int(left["shard"].iloc[0])
            cells = np.frombuffer(right["cells"].iloc[0], np.uint16).copy() if len(right) else np.zeros(0, np.uint16)
            held = int(right["n_keys"].iloc[0]) if len(right) else 0
            filter_ = CuckooFilter(cells) if len(cells) else built(added)
            full = bool(len(cells)) and (held + len(added) > 0.9 * len(cells) or not filter_.insert(added))
            return pd.DataFrame({"shard": [shard], "n_keys": [held + len(added)], "cells": [b"" if full else filter_.cells.tobytes()]})

        grown = new_keys.groupBy("shard").cogroup(self.filters.groupBy("shard")).applyInPandas(grow, self.filters.schema)
        return _rebuilt(stored(grown, "filters"), counts)

    def _shrunk(self, dead: DataFrame, counts: DataFrame) -> DataFrame:
        def shrink(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            if not len(left) or not len(right):
                return right
            filter_ = CuckooFilter(np.frombuffer(right["cells"].iloc[0], np.uint16).copy())
            filter_.delete(left["k1"].to_numpy())
            return right.assign(n_keys=right["n_keys"] - len(left), cells=[filter_.cells.tobytes()])

        return stored(
            dead.groupBy("shard").cogroup(self.filters.groupBy("shard")).applyInPandas(shrink, self.filters.schema), "filters"
        )


def _rebuilt(filters: DataFrame, counts: DataFrame) -> DataFrame:
    """Filters that ran full (no cells) made anew from the exact counts."""
    full = filters.where(F.length("cells") == 0).select("shard")
    if full.isEmpty():
        return filters

    def rebuild(group: pd.DataFrame) -> pd.DataFrame:
        keys = group["k1"].to_numpy().astype(np.uint64)
        return pd.DataFrame({"shard": [int(group["shard"].iloc[0])], "n_keys": [len(keys)], "cells": [built(keys).cells.tobytes()]})

    anew = counts.join(F.broadcast(full), "shard").select("shard", "k1").groupBy("shard").applyInPandas(rebuild, filters.schema)
    return stored(filters.where(F.length("cells") > 0).unionByName(anew), "filters")


def _once_per_document(postings: DataFrame) -> DataFrame:
    """Rows that share a doc_id are one document."""
    return postings.distinct()


# Dedup


def drop_lines(docs: DataFrame, index: LineIndex, *more: str) -> DataFrame:
    """doc_id, text, n_lines (before), n_dropped and further columns of `docs`, whose documents are in the
    index, after shared lines outside their first document went.

    Which keys a document loses is worked out on hashes alone; the texts are shuffled once, by document.
    """
    shared = stored(index.shared(), "shared")
    lost = (
        join_hot(index.postings, shared, KEYS, "n", index.postings.count())
        .where(F.col("doc_id") != F.col("first"))
        .groupBy("doc_id")
        .agg(F.collect_list(F.struct(*KEYS)).alias("lost"))
    )
    found = docs.select("doc_id", "text", *more).join(lost.hint("shuffle_hash"), "doc_id", "left")
    min_chars = index.min_chars

    def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (part for batch in batches for part in parts_of(batch)):
            texts, n_lines, n_dropped = [], [], []
            for text, lost in zip(byte_texts(part.column("text")), part.column("lost").to_pylist(), strict=True):
                n_lines.append(text.count(b"\n") + 1)
                kept = n_lines[-1]
                if lost:
                    gone = {(k["k1"], k["k2"]) for k in lost}
                    keys = line_keys(text, min_chars)
                    rest = [line for line, key in zip(text.split(b"\n"), keys, strict=True) if key not in gone]
                    text, kept = b"\n".join(rest), len(rest)
                texts.append(text)
                n_dropped.append(n_lines[-1] - kept)
            made = {
                "doc_id": part.column("doc_id"),
                "text": pa.array(texts, pa.binary()).cast(pa.string()),
                "n_lines": pa.array(n_lines, pa.int64()),
                "n_dropped": pa.array(n_dropped, pa.int64()),
            } | {c: part.column(c) for c in more}
            yield pa.RecordBatch.from_arrays(list(made.values()), list(made))

    counts = [F.lit(0).cast("long").alias(c) for c in ("n_lines", "n_dropped")]
    return found.mapInArrow(drop, found.select("doc_id", "text", *counts, *more).schema)


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """Insert all documents into a new index and drop their repeated lines."""
    docs = documents_of(docs, id_col, text_col)
    return drop_lines(docs, LineIndex.empty(docs.sparkSession, min_chars=min_chars).insert(docs))


def without_repeats(docs: DataFrame) -> DataFrame:
    """All rows and columns of `docs` with the lines of `text` that an earlier document holds taken out.

    A column n_chars is brought up to date. Rows that share a doc_id lose the same lines.
    """
    kinds = {f.name: f.dataType for f in docs.schema}
    names = {f"in_{i}": c for i, c in enumerate(docs.columns) if c not in ("doc_id", "text", "n_chars")}
    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.col("text").isNull().alias("no_text"),
        *(F.col(c).alias(name) for name, c in names.items()),
    )
    index = LineIndex.empty(docs.sparkSession).insert(rows.select("doc_id", "text"))
    found = drop_lines(rows, index, "no_text", *names)
    text = F.when(~F.col("no_text"), F.col("text"))
    made = {"doc_id": shown_id(), "text": text, "n_chars": F.char_length(text)} | {c: F.col(n) for n, c in names.items()}
    return found.select(*(made[c].cast(kinds[c]).alias(c) for c in docs.columns))


def query(docs: DataFrame) -> DataFrame:
    """Contract of op2."""
    return dedup(docs).select(shown_id(), "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


ORACLE_SQL = """
WITH lines AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
           generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i
    FROM documents
), keyed AS (
    SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
    FROM lines
), shared AS (
    SELECT k, min(doc_id) AS first FROM keyed WHERE length(k) >= 10
    GROUP BY k HAVING count(DISTINCT doc_id) >= 2
), marked AS (
    SELECT doc_id, i, line, coalesce(doc_id <> first, false) AS dropped FROM keyed LEFT JOIN shared USING (k)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
