"""Helpers of the training-data operators: stored steps, hot keys, batches of bytes, words."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saleslens.sources.layers import scratch_folder

NO_ID = -(2**63)  # stands for a null id inside the operators, so a null id is the smallest
CHUNK_BYTES = 1 << 20  # texts worked on at a time in numpy
BATCH_ROWS = 1000
HOT_SHARE = 1000  # a key with more than 1/1000 of all rows is hot, so there are under 1000


def ready(spark: SparkSession) -> None:
    """Let Python workers import this package also where only the driver has it on its path, and hand
    them texts in small batches, as documents may be long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    root = str(Path(__file__).resolve().parents[2])
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(":"):
        spark.sparkContext.environment["PYTHONPATH"] = f"{root}:{known}".rstrip(":")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(frame: DataFrame, name: str) -> DataFrame:
    """Write a step to the shared folder and read it back: cuts the lineage, so that a lost
    executor costs a re-read and steps used twice are worked out once."""
    spark = frame.sparkSession
    path = scratch_folder(spark, name)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def documents_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) with null ids as the smallest id and null texts empty; no other column."""
    return docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc_id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )


def shown_id(column: str = "doc_id"):
    """The id as the caller knows it."""
    return F.when(F.col(column) != NO_ID, F.col(column)).alias(column)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def join_hot(rows: DataFrame, keyed: DataFrame, keys: list[str], weight: str, total: int, how: str = "inner") -> DataFrame:
    """Join (inner or left) of many rows with one row per key, where `weight` of a key is its number of rows.

    Keys with more than total / 1000 rows, of which there are under 1000, meet the rows by broadcast;
    the others by a shuffle, in which no key is larger than that share.
    """
    least = max(total // HOT_SHARE, 1000)
    hot = keyed.where(F.col(weight) > least)
    cold = keyed.where(F.col(weight) <= least)
    hot_keys = F.broadcast(hot.select(*keys))
    return rows.join(F.broadcast(hot), keys).unionByName(
        rows.join(hot_keys, keys, "left_anti").join(cold, keys, how)
    )


def byte_texts(column: pa.Array) -> list[bytes]:
    """A text column as UTF-8 bytes; null is empty."""
    return [value or b"" for value in column.cast(pa.binary()).to_pylist()]


def chunks(sizes: Iterable[int], most: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Slices of a sequence with about `most` bytes each; a longer item is alone."""
    start = held = stop = 0
    for i, size in enumerate(sizes):
        if held and held + size > most:
            yield start, i
            start, held = i, 0
        held += size
        stop = i + 1
    if start < stop:
        yield start, stop


def parts_of(batch: pa.RecordBatch, text: str = "text", most: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """A batch in slices of a bounded number of text bytes."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0)
    for start, stop in chunks(sizes.to_pylist(), most):
        yield batch.slice(start, stop - start)


# Words


def _word_bytes() -> np.ndarray:
    known = np.zeros(256, bool)
    known[0x80:] = True
    for first, last in ("09", "AZ", "az"):
        known[ord(first) : ord(last) + 1] = True
    return known


WORD_BYTE = _word_bytes()
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def odd_numbers(count: int, seed: int) -> np.ndarray:
    """Fixed random odd 64-bit numbers."""
    return np.random.default_rng(seed).integers(0, 2**63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


_MIX = [np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)]


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit hashes evenly."""
    values = (values ^ (values >> np.uint64(30))) * _MIX[0]
    values = (values ^ (values >> np.uint64(27))) * _MIX[1]
    return values ^ (values >> np.uint64(31))


class Powers:
    """Powers of an odd base and of its inverse modulo 2^64, grown as texts need them."""

    def __init__(self, base: int):
        self.base, self.inverse = base | 1, pow(base | 1, -1, 2**64)
        self.up = np.ones(1, np.uint64)
        self.down = np.ones(1, np.uint64)

    def upto(self, count: int) -> tuple[np.ndarray, np.ndarray]:
        while len(self.up) < count:
            n = len(self.up)
            self.up = np.concatenate([self.up, self.up * np.uint64(pow(self.base, n, 2**64))])
            self.down = np.concatenate([self.down, self.down * np.uint64(pow(self.inverse, n, 2**64))])
        return self.up[:count], self.down[:count]


def prefix_hashes(values: np.ndarray, powers: Powers) -> np.ndarray:
    """sums[i] = sum of values[j] * base^j for j < i, modulo 2^64."""
    up, _ = powers.upto(len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[:-1], out=sums[1:])
    return sums


def slice_hashes(sums: np.ndarray, starts: np.ndarray, stops: np.ndarray, powers: Powers) -> np.ndarray:
    """Polynomial hashes of slices: equal slices have equal hashes wherever they stand."""
    _, down = powers.upto(len(sums))
    return (sums[stops] - sums[starts]) * down[starts]


WORD_POWERS = Powers(0x9E3779B97F4A7C15)
RUN_POWERS = Powers(0xD1B54A32D192ED03)
BYTE_CODES = odd_numbers(256, 11)


def words_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of several texts, A-Z lower-cased: runs of digits, letters and non-ASCII code points.

    Gives the joined lower-cased bytes, start and stop of each word, its hash (over bytes and
    length), and the number of the first word of each text, with the number of all words at the end.
    """
    joined = LOWER[np.frombuffer(b"\x00".join(texts) + b"\x00", np.uint8)]
    inside = WORD_BYTE[joined]
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if inside[0]:
        edges = np.concatenate([[0], edges])
    starts, stops = edges[::2], edges[1::2]
    ends = np.cumsum([len(t) + 1 for t in texts])
    firsts = np.concatenate([[0], np.searchsorted(starts, ends)])
    sums = prefix_hashes(BYTE_CODES[joined], WORD_POWERS)
    hashes = mixed(slice_hashes(sums, starts, stops, WORD_POWERS) + (stops - starts).astype(np.uint64))
    return joined, starts, stops, hashes, firsts


def run_hashes(hashes: np.ndarray, length: int) -> np.ndarray:
    """Hash of the `length` words from each word on (across text ends too: mask these)."""
    if len(hashes) < length:
        return np.zeros(0, np.uint64)
    at = np.arange(len(hashes) - length + 1)
    return mixed(slice_hashes(prefix_hashes(hashes, RUN_POWERS), at, at + length, RUN_POWERS))
