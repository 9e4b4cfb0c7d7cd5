"""Operator 10: exact top-k search by inner product, with a uniform threshold in three phases.

The dimensions are cut into slices; a slice's product with a query is a partial score, and the score is
their sum. For one block of queries against all rows:

1. every task finds, per query and slice, its rows with the highest partial scores, completes their
   scores and sends the k best per query: a short list from each task;
2. the k-th best score so gathered is a safe cutoff: at least k rows reach it. It is broadcast, and every
   task collects all rows with a partial score of at least cutoff / slices in some slice. A row
   below that in every slice cannot reach the cutoff;
3. the collected rows' scores are completed, and the k best per query kept, first in the task, then
   of all tasks.

Queries go in blocks of at most `QUERY_BLOCK`, so what the driver and a broadcast hold is bounded; the
rows are scanned twice a block and never shuffled, only lists of k per query and task are.

Edge cases: vectors that are null, hold a null or a non-finite component, or have no id take no part;
vectors of another dimension than the query's have no score with it; rows with the query's id are its own
and no candidates, and a repeated query id is one query, with its smallest vector; ties go to the smaller
id; sums beyond a long are cut to its limits. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

K = 5
SCALE = 256
SLICES = 4
QUERY_BLOCK = 1024
ROWS = 2048  # candidate rows scored at a time
NONE = -(2**63)  # no score yet, no cutoff
HIGHEST = 2**63 - 1


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, x): whole-number components, of the rows that take part."""
    finite = F.forall(vector_col, lambda v: v.isNotNull() & (F.abs(v.cast("double")) < F.lit(float("inf"))))
    rows = vectors.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & finite)
    return rows.select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.transform(vector_col, lambda v: F.lit(float(SCALE)) * v.cast("double")).alias("x"),
    )


def _whole(values: np.ndarray) -> np.ndarray:
    """Floors: as doubles while these are exact, else as Python integers."""
    floors = np.floor(values)
    if not floors.size or np.abs(floors).max() < 2**53:
        return floors
    return np.array([int(v) for v in floors.ravel()], object).reshape(floors.shape)


def _matrices(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids and vectors of a batch by dimension, a bounded number of rows at a time."""
    column = batch.column("x")
    ids = batch.column("vec_id").to_numpy(zero_copy_only=False)
    offsets = column.offsets.to_numpy()
    values = column.values.to_numpy(zero_copy_only=False)
    sizes = np.diff(offsets)
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        for at in range(0, len(rows), ROWS):
            own = rows[at : at + ROWS]
            yield ids[own], _whole(values[offsets[own][:, None] + np.arange(size)])


def _partials(x: np.ndarray, q: np.ndarray) -> list[np.ndarray]:
    """Partial scores (rows x queries) of each slice, exact."""
    size = x.shape[1]
    if x.dtype != object and q.dtype != object and x.size and q.size:
        reach = float(np.abs(x).max()) * float(np.abs(q).max()) * size
        if reach >= 2**53:
            kind = np.int64 if reach < 2**62 else object
            x, q = (np.array([int(v) for v in m.ravel()], kind).reshape(m.shape) for m in (x, q))
    cuts = np.linspace(0, size, SLICES + 1).astype(int)
    if x.dtype == object or q.dtype == object:
        x, q = x.astype(object), q.astype(object)
        zero = np.zeros((len(x), len(q)), object)
        return [x[:, a:b] @ q[:, a:b].T if b > a else zero for a, b in zip(cuts, cuts[1:])]
    return [x[:, a:b] @ q[:, a:b].T for a, b in zip(cuts, cuts[1:])]


def _as_long(scores: np.ndarray) -> np.ndarray:
    if scores.dtype == object:
        return np.array([min(max(int(s), NONE + 1), HIGHEST) for s in scores.ravel()], np.int64).reshape(scores.shape)
    return scores.astype(np.int64)


class _Queries:
    """A block of queries by dimension: their places in the block, ids and vectors."""

    def __init__(self, rows: list[tuple[int, list[float]]]):
        self.size = len(rows)
        self.by_size: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        sizes = np.array([len(x) for _, x in rows])
        for size in np.unique(sizes):
            places = np.flatnonzero(sizes == size)
            matrix = np.array([rows[i][1] for i in places], float).reshape(len(places), size)
            self.by_size[int(size)] = (places, np.array([rows[i][0] for i in places]), _whole(matrix))


def _leading_scores(ids: np.ndarray, q_ids: np.ndarray, parts: list[np.ndarray], k: int) -> np.ndarray:
    """Phase 1 on some rows: true scores (k x queries) of rows that lead in a slice, each row once."""
    top = min(k + 1, len(ids))  # one more: the query's own row may lead
    leaders = np.concatenate([np.argpartition(-p, top - 1, axis=0)[:top] for p in parts])
    leaders.sort(axis=0)
    columns = np.arange(len(q_ids))
    scores = _as_long(sum(p[leaders, columns] for p in parts))
    again = np.zeros(leaders.shape, bool)
    again[1:] = leaders[1:] == leaders[:-1]
    scores[again | (ids[leaders] == q_ids)] = NONE
    scores = -np.sort(-scores, axis=0)[:k]
    return np.pad(scores, ((0, k - len(scores)), (0, 0)), constant_values=NONE)


def _best(found: np.ndarray, k: int) -> np.ndarray:
    """The k best rows (place, id, score) of each query."""
    found = found[np.lexsort((found[:, 1], -found[:, 2], found[:, 0]))]
    first = np.searchsorted(found[:, 0], found[:, 0])
    return found[np.arange(len(found)) - first < k]


def _block(rows: DataFrame, queries: list[tuple[int, list[float]]], k: int) -> DataFrame:
    """Phases 1 to 3 for one block of queries: query_id, vec_id, score."""
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast(queries)

    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = _Queries(shared.value)
        best = np.full((k, block.size), NONE)
        for batch in batches:
            for ids, x in _matrices(batch):
                if x.shape[1] in block.by_size:
                    places, q_ids, q = block.by_size[x.shape[1]]
                    new = _leading_scores(ids, q_ids, _partials(x, q), k)
                    best[:, places] = -np.sort(-np.concatenate([best[:, places], new]), axis=0)[:k]
        place = np.tile(np.arange(block.size, dtype=np.int32), k)
        held = best.ravel() > NONE
        yield pa.RecordBatch.from_arrays([pa.array(place[held]), pa.array(best.ravel()[held])], ["place", "score"])

    gathered = rows.mapInArrow(lists, "place int, score long")
    ordered = Window.partitionBy("place").orderBy(F.desc("score"))
    at_k = gathered.withColumn("rank", F.row_number().over(ordered)).where(F.col("rank") <= k)
    cutoffs = np.full(len(queries), NONE)
    for row in at_k.where(F.col("rank") == k).collect():
        cutoffs[row.place] = row.score
    cut = spark.sparkContext.broadcast(cutoffs)

    def resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, least = _Queries(shared.value), cut.value
        best = np.zeros((0, 3), np.int64)
        for batch in batches:
            for ids, x in _matrices(batch):
                if x.shape[1] not in block.by_size:
                    continue
                places, q_ids, q = block.by_size[x.shape[1]]
                parts = _partials(x, q)
                safe = np.where(least[places] == NONE, -np.inf, least[places] / len(parts) - 1)
                enough = np.zeros(parts[0].shape, bool)
                for p in parts:
                    enough |= p >= safe
                row, column = np.nonzero(enough)
                scores = _as_long(sum(p[row, column] for p in parts))
                kept = (scores >= least[places][column]) & (ids[row] != q_ids[column])
                new = np.stack([places[column[kept]], ids[row[kept]], scores[kept]], axis=1)
                best = _best(np.concatenate([best, new]), k)
        q_id = np.array([i for i, _ in shared.value], np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(q_id[best[:, 0]]), pa.array(best[:, 1]), pa.array(best[:, 2])], ["query_id", "vec_id", "score"]
        )

    return rows.mapInArrow(resolve, "query_id long, vec_id long, score long")


def _blocks(queries: DataFrame) -> Iterator[list[tuple[int, list[float]]]]:
    block: list[tuple[int, list[float]]] = []
    for row in queries.toLocalIterator():
        if len(block) == QUERY_BLOCK:
            yield block
            block = []
        block.append((row.vec_id, row.x))
    if block:
        yield block


def top_k(
    vectors: DataFrame, is_query, k: int = K, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """query_id, rank, vec_id, score of the k best other rows of each row for which `is_query` holds."""
    rows = usable(vectors, id_col, vector_col)
    queries = rows.where(is_query(F.col("vec_id"))).groupBy("vec_id").agg(F.min("x").alias("x"))
    found = None
    for block in _blocks(queries):
        part = _block(rows, block, k)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = rows.sparkSession.createDataFrame([], "query_id long, vec_id long, score long")
    ordered = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(ordered)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def query(embeddings: DataFrame) -> DataFrame:
    """Contract of op10."""
    return top_k(embeddings, lambda vec_id: vec_id % 50 == 0)


ORACLE_SQL = """
WITH usable AS (
    SELECT vec_id, list_transform(embedding, lambda v: CAST(floor(256 * CAST(v AS DOUBLE)) AS BIGINT)) AS x
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id,
           CAST(list_sum(list_transform(list_zip(q.x, c.x), lambda p: p[1] * p[2])) AS BIGINT) AS score
    FROM usable q JOIN usable c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""
