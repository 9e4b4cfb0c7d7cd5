"""Operator 8: language identification as mixture inference.

A language is a distribution over hashed letter trigrams (a letter with its neighbours, white space and
marks counting as one). The likelihood of a word in each language follows from its trigrams. A document is
a mixture of languages: expectation-maximisation finds the proportions, and languages are
taken out one by one, the least first, while the likelihood loses less than the penalty for a free
proportion (half the logarithm of the number of words). The language with the largest proportion is
the prediction, the proportion its score.

Counts come from at most `SAMPLE` labelled documents a language, chosen by a hash of their id; they are
counted in tasks, and one table of `BUCKETS` numbers a language reaches the driver and is broadcast.
Documents are never shuffled to be classified.

Edge cases: a null text, or one without a letter, is `und` with score 0, as is every text when
nothing can be learned; null and repeated doc_ids pass through row by row; null languages teach nothing;
with equal proportions the language that sorts first is taken.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from saleslens.llm.byte_bpe import LETTER, code_point_classes
from saleslens.llm.shared import parts_of

SAMPLE = 600  # labelled documents a language to learn from, at most
BUCKETS = 1 << 16
ROUNDS = 6
UNKNOWN = "und"


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket of the trigram around every letter, where words begin among them, and where texts
    begin among the words (with the number of words at the end)."""
    joined = "\n".join(texts) + "\n"
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = code_point_classes()[points] == LETTER
    around = np.where(letter, points, 0)
    around = np.concatenate([[0], around, [0]]).astype(np.uint32)
    mixed = around[:-2] * np.uint32(0x9E3779B1) + around[1:-1] * np.uint32(0x85EBCA77) + around[2:] * np.uint32(0xC2B2AE3D)
    mixed = (mixed ^ (mixed >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    at = np.flatnonzero(letter)
    buckets = (mixed[at] >> np.uint32(16)).astype(np.int64)
    begins = ~np.concatenate([[False], letter[:-1]])[at]
    words = np.flatnonzero(begins)
    ends = np.cumsum([len(t) + 1 for t in texts])
    firsts = np.concatenate([[0], np.searchsorted(at[words], ends)])
    return buckets, words, firsts


def _texts(column: pa.Array) -> list[str]:
    return [(t or "").lower() for t in column.to_pylist()]


class Model:
    """Languages and the log-probabilities of their trigrams (buckets x languages)."""

    def __init__(self, languages: list[str], logs: np.ndarray):
        self.languages, self.logs = languages, logs

    def predict(self, texts: list[str]) -> tuple[list[str], list[float], np.ndarray]:
        """Per text: language, score and the proportions of all languages."""
        buckets, words, firsts = trigrams(texts)
        n_words = np.diff(firsts)
        shares = np.zeros((len(texts), len(self.languages)))
        names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        known = np.flatnonzero(n_words)
        if len(known) and self.languages:
            logs = np.add.reduceat(self.logs[buckets], words, axis=0, dtype=np.float64)
            shares[known] = proportions(logs, firsts[known], n_words[known])
            for i, best in zip(known, shares[known].argmax(axis=1), strict=True):
                names[i], scores[i] = self.languages[best], float(min(1.0, shares[i, best]))
        return names, scores, shares


def proportions(logs: np.ndarray, firsts: np.ndarray, n_words: np.ndarray) -> np.ndarray:
    """Language proportions of documents, from the log-likelihoods (words x languages) of their words."""
    top = logs.max(axis=1, keepdims=True)
    likely = np.exp(logs - top)
    owner = np.repeat(np.arange(len(firsts)), n_words)
    kinds = logs.shape[1]

    def maximised(shares: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
        for _ in range(rounds):
            parts = likely * shares[owner]
            whole = parts.sum(axis=1, keepdims=True)
            parts /= np.maximum(whole, 1e-300)
            shares = np.add.reduceat(parts, firsts, axis=0) / n_words[:, None]
        whole = np.maximum((likely * shares[owner]).sum(axis=1), 1e-300)
        return shares, np.add.reduceat(np.log(whole), firsts)

    shares, fit = maximised(np.full((len(firsts), kinds), 1 / kinds), ROUNDS)
    penalty = np.log(np.maximum(n_words, 2)) / 2
    open_ = np.ones(len(firsts), bool)
    for left in range(kinds, 1, -1):
        least = np.where(shares > 0, shares, 2).argmin(axis=1)
        fewer = shares.copy()
        fewer[np.arange(len(fewer)), least] = 0
        fewer /= np.maximum(fewer.sum(axis=1, keepdims=True), 1e-300)
        fewer, fit_fewer = maximised(fewer, 2)
        better = open_ & ((shares > 0).sum(axis=1) == left) & (fit_fewer + penalty >= fit)
        shares[better], fit[better] = fewer[better], fit_fewer[better]
        open_ = better
        if not better.any():
            break
    return shares


def learn(labelled: DataFrame, sample: int = SAMPLE) -> Model:
    """Trigram counts of a bounded sample (doc_id, text, lang); one is added to every count."""
    known = labelled.where("lang is not null and text is not null")
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    picked = (
        known.select("doc_id", "lang").distinct().withColumn("place", F.row_number().over(order)).where(F.col("place") <= sample)
    )
    texts = known.join(F.broadcast(picked.select("doc_id", "lang")), ["doc_id", "lang"]).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            langs, found = batch.column("lang").to_pylist(), _texts(batch.column("text"))
            for lang, text in zip(langs, found, strict=True):
                buckets = trigrams([text])[0]
                totals[lang] = totals.get(lang, 0) + np.bincount(buckets, minlength=BUCKETS)
        for lang, total in totals.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at), pa.string()), pa.array(at), pa.array(total[at])], ["lang", "bucket", "n"]
            )

    counts = texts.mapInArrow(count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    rows = counts.toPandas()
    languages = sorted(rows["lang"].unique())
    tables = []
    for lang in languages:
        own = rows[rows["lang"] == lang]
        table = np.ones(BUCKETS)
        table[own["bucket"].to_numpy()] += own["n"].to_numpy()
        tables.append(np.log(table / table.sum()))
    logs = np.stack(tables, axis=1) if tables else np.zeros((BUCKETS, 0))
    return Model(languages, logs.astype(np.float32))


def classify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score and the proportions by language of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = "doc_id long, lang_pred string, score double, shares array<double>"

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (part for batch in batches for part in parts_of(batch)):
            names, scores, shares = shared.value.predict(_texts(part.column("text")))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    pa.array(names, pa.string()),
                    pa.array(scores, pa.float64()),
                    pa.array(shares.tolist(), pa.list_(pa.float64())),
                ],
                ["doc_id", "lang_pred", "score", "shares"],
            )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(predict, schema)


def held_out(id_col: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def train(docs: DataFrame) -> Model:
    """From the documents that are not held out."""
    return learn(docs.where(~held_out()).select("doc_id", "text", "lang"))


def query(docs: DataFrame) -> DataFrame:
    """Contract of op8."""
    return classify(docs, train(docs)).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def keep_identified(docs: DataFrame) -> DataFrame:
    """Rows of `docs`, with all their columns, whose language can be told: what would be `und` goes."""
    shared = docs.sparkSession.sparkContext.broadcast(train(docs))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (part for batch in batches for part in parts_of(batch)):
            names, _, _ = shared.value.predict(_texts(part.column("text")))
            yield part.filter(pa.array([n != UNKNOWN for n in names]))

    return docs.mapInArrow(keep, docs.schema)
