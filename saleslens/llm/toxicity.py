"""Operator 6: toxicity by compression distance.

Two zstandard dictionaries are trained: one on windows of ordinary text, one on toxic windows. As most of a
toxic text is ordinary wording, which tells nothing, the toxic windows are reduced before training to the parts
that ordinary text does not explain: runs of byte grams that are several times as frequent in the toxic
sample and stand in many different surroundings there (copies of one text do not count again). A text is cut
into windows of four words; each is compressed with the ordinary dictionary, and with the ordinary plus the
toxic one, behind the same short phrase, so that the format's fixed costs are paid and a single short
match shows. The bytes saved by the latter are the window's distance. How many windows reach each of several
thresholds is weighed by a logistic model calibrated on labelled texts the dictionaries in use were not trained on.

Only the training is on a sample: at most `SAMPLE` labelled texts a class, by a hash of their id, ending where
`SAMPLE_BYTES` are reached, on the driver. All texts are scored whole, where they are read, without a shuffle.

Edge cases: null and empty texts are one empty window and get a score; null and repeated doc_ids pass
through row by row; null labels teach nothing, of contradicting ones the toxic counts; when a class has
no labelled text every score is 0; an empty table gives an empty result. There is no SQL for it: SQL has no
compressor.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleslens.llm.shared import parts_of

SAMPLE = 4000
SAMPLE_BYTES = 16 << 20  # a class
WORDS = 4
GRAM = 6
ORDINARY_BYTES, TOXIC_BYTES = 16 << 10, 6 << 10
MOST_SAVED = 8
RATIO = 4  # times as frequent in toxic texts
SPREAD = 8  # different surroundings
FOLDS = 3
TEXTS = 6  # toxic texts that hold a gram
CARRIER = b" the house of many common words, again and again: "  # stands before every window, and in both dictionaries


def words_in(text: str) -> list[bytes]:
    return text.lower().encode().split()


def windows(text: str) -> list[bytes]:
    words = words_in(text)
    return [b" " + b" ".join(words[i : i + WORDS]) + b" " for i in range(0, len(words), WORDS)] or [b""]


# What sets toxic texts apart


def _grams(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8).astype(np.uint64)
    if len(raw) < GRAM:
        return np.zeros(0, np.uint64)
    return sum(raw[i : len(raw) - GRAM + 1 + i] << np.uint64(8 * i) for i in range(GRAM))


def _surroundings(texts: list[bytes], among: np.ndarray) -> np.ndarray:
    """The larger number of different grams before, or after, each of some sorted grams."""
    spread = np.zeros(len(among), np.int64)
    pad = b" " * GRAM
    for shift in (-GRAM, GRAM):
        seen = []
        for text in texts:
            grams = _grams(pad + text + pad)
            inner = np.arange(GRAM, len(grams) - GRAM)
            at = np.minimum(np.searchsorted(among, grams[inner]), len(among) - 1)
            hit = among[at] == grams[inner]
            seen.append(np.stack([at[hit].astype(np.uint64), grams[inner[hit] + shift]]))
        pairs = np.unique(np.concatenate(seen, axis=1), axis=1)
        spread = np.maximum(spread, np.bincount(pairs[0].astype(np.int64), minlength=len(among)))
    return spread


def _counted(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, int]:
    """Grams in order, how often each occurs, and how many there are in all."""
    grams = np.concatenate([_grams(t) for t in texts])
    found, count = np.unique(grams, return_counts=True)
    return found, count, max(len(grams), 1)


def telling_grams(toxic: list[bytes], ordinary: list[bytes]) -> np.ndarray:
    """Grams that set toxic texts apart, in order."""
    found, count, total = _counted(toxic)
    plain, often, rest = _counted(ordinary)
    if not len(found):
        return found
    at = np.minimum(np.searchsorted(plain, found), max(len(plain) - 1, 0))
    known = np.where(plain[at] == found, often[at], 0) if len(plain) else np.zeros(len(found), np.int64)
    texts = np.unique(np.concatenate([np.unique(_grams(t)) for t in toxic]), return_counts=True)[1]
    found = found[(texts >= min(TEXTS, max(2, len(toxic) // 10))) & (count / total >= RATIO * (known + 3) / rest)]
    return found[_surroundings(toxic, found) >= min(SPREAD, max(2, len(toxic) // 10))] if len(found) else found


def telling_parts(samples: list[bytes], grams: np.ndarray) -> list[bytes]:
    """The parts of windows that such grams cover, in order."""
    data = b"\x00".join(samples)
    found = _grams(data)
    if not len(grams) or not len(found):
        return []
    at = np.minimum(np.searchsorted(grams, found), len(grams) - 1)
    hit = np.flatnonzero(grams[at] == found)
    change = np.bincount(hit, minlength=len(data) + 1) - np.bincount(hit + GRAM, minlength=len(data) + 1)
    edges = np.flatnonzero(np.diff(np.cumsum(change) > 0, prepend=False, append=False))
    return [data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)]


def _trained(size: int, samples: list[bytes], segment: int) -> bytes:
    """A zstandard dictionary of a fixed size; too few samples to train on are taken as they are.

    The format's tables remember some positions only, by their distance from the start: with fixed sizes these are
    the same ones whatever was learned, and distances can be compared.
    """
    try:
        content = zstandard.train_dictionary(size, samples, k=segment, d=GRAM).as_bytes()
    except zstandard.ZstdError:
        content = b"".join(samples)
    return content[-size:].rjust(size)


# Model


@dataclass(frozen=True)
class Model:
    """Two dictionaries, and the calibrated weights of the features (none: nothing was learned)."""

    ordinary: bytes
    toxic: bytes
    weights: tuple[float, ...]

    def score(self, text: str) -> float:
        if not self.weights:
            return 0.0
        value = float(np.dot(features(_compressors(self.ordinary, self.toxic), text), self.weights))
        return float(1 / (1 + np.exp(-np.clip(value, -500, 500))))


_PARAMETERS = zstandard.ZstdCompressionParameters(
    strategy=zstandard.STRATEGY_GREEDY, min_match=5, hash_log=17, chain_log=17, search_log=4, window_log=20,
    target_length=32, write_checksum=0, write_content_size=0, write_dict_id=0,
)


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    known = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    known.precompute_compress(compression_params=_PARAMETERS)
    return zstandard.ZstdCompressor(dict_data=known, compression_params=_PARAMETERS)


@lru_cache(maxsize=2)
def _compressors(ordinary: bytes, toxic: bytes):
    return _compressor(ordinary + CARRIER), _compressor(ordinary + toxic + CARRIER)


def distances(compressors, text: str) -> np.ndarray:
    """Bytes saved by the toxic dictionary in each window."""
    plain, extended = compressors[0].compress, compressors[1].compress
    carried = [CARRIER + w for w in windows(text)]
    return np.array([len(plain(w)) - len(extended(w)) for w in carried])


def features(compressors, text: str) -> np.ndarray:
    """How many windows reach each threshold, their share, and figures of the whole text."""
    saved = distances(compressors, text)
    count = np.array([(saved >= least).sum() for least in range(1, MOST_SAVED + 1)])
    total = len(saved)
    return np.concatenate([np.log1p(count), count / total, [np.log(total), saved.max(), saved.mean(), 1.0]])


def _calibrated(rows: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Logistic weights by Newton's method with a small ridge, on standardised features."""
    middle, spread = rows.mean(axis=0), rows.std(axis=0)
    middle[-1], spread[spread == 0] = 0, 1
    x = (rows - middle) / spread
    fitted = np.zeros(x.shape[1])
    ridge = np.full(x.shape[1], 1.0)
    ridge[-1] = 1e-6
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ fitted, -30, 30)))
        slope = x.T @ (weight * (p - toxic)) + ridge * fitted
        curve = (x * (weight * p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(ridge)
        fitted -= np.linalg.solve(curve, slope)
    out = fitted / spread
    out[-1] = fitted[-1] - (fitted[:-1] / spread[:-1]) @ middle[:-1]
    return out


def _dictionaries(toxic: list[str], ordinary: list[str]) -> tuple[bytes, bytes]:
    padded = [[b" " + b" ".join(words_in(x)) + b" " for x in part] for part in (toxic, ordinary)]
    parts = telling_parts([w for x in toxic for w in windows(x)], telling_grams(*padded))
    samples = [b"".join(parts[i : i + 8]) for i in range(0, len(parts), 8)]
    plain = [w for x in ordinary for w in windows(x)][:: max(1, len(ordinary) // 250)]
    return _trained(ORDINARY_BYTES, plain, 64), _trained(TOXIC_BYTES, samples, 16)


def fit(toxic: list[str], ordinary: list[str], toxic_share: float) -> Model:
    """From texts of both classes.

    The weights are calibrated on texts the dictionaries have not seen: each of `FOLDS` parts is measured with
    dictionaries trained on the others. Those of the model are then trained on all.
    """
    if not toxic or not ordinary:
        return Model(b"", b"", ())
    rows, is_toxic = [], []
    folds = FOLDS if min(len(toxic), len(ordinary)) >= FOLDS else 1
    for fold in range(folds):
        held = [x[fold::folds] for x in (toxic, ordinary)]
        rest = [[x for i, x in enumerate(part) if folds == 1 or i % folds != fold] for part in (toxic, ordinary)]
        compressors = _compressors(*_dictionaries(*rest))
        rows += [features(compressors, x) for part in held for x in part]
        is_toxic += [1.0] * len(held[0]) + [0.0] * len(held[1])
    rows, is_toxic = np.array(rows), np.array(is_toxic)
    weight = np.where(is_toxic == 1, toxic_share / is_toxic.sum(), (1 - toxic_share) / (1 - is_toxic).sum()) * len(rows)
    return Model(*_dictionaries(toxic, ordinary), tuple(_calibrated(rows, is_toxic, weight)))


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """From labelled documents that are not held out."""
    known = labels.where(F.col("toxic").isNotNull() & ~held_out()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sizes = {r.toxic: r.n for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    texts = {}
    for kind in (1, 0):
        picked = known.where(F.col("toxic") == kind).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).select("doc_id")
        rows = docs.select("doc_id", "text").where(F.octet_length("text") > 0).join(F.broadcast(picked), "doc_id")
        texts[kind], held = [], 0
        for row in rows.orderBy(F.xxhash64("doc_id"), "doc_id", "text").limit(sample).toLocalIterator():
            held += len(row.text)
            if held > SAMPLE_BYTES:
                break
            texts[kind].append(row.text)
    total = sizes.get(1, 0) + sizes.get(0, 0)
    return fit(texts[1], texts[0], sizes.get(1, 0) / total if total else 0.0)


def held_out(id_col: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and score of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (part for batch in batches for part in parts_of(batch)):
            scores = [shared.value.score(t or "") for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(scores, pa.float64())], ["doc_id", "score"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(work, "doc_id long, score double")


def query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Contract of op6."""
    return score(docs, learn(docs, labels)).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
