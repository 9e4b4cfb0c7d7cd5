"""Operator 1: token ids in bit-packed files.

Each id takes the fewest bits that hold the vocabulary. A table of token files is a folder of
Parquet files, one per shard, whose rows are blocks in ascending order:

    shard, block   place of the block; shards are ranges of document ids in ascending order
    first, n_ids   position of its first id in the shard, and its number of ids
    bits, payload  width of an id, and the ids most significant bit first, padded with zeros
    open_from      where in the shard the document begins that goes on into this block, else null
    doc_ids, lens  documents of the block in order and how many of their ids are in it

`first` is the block index: the block of any id is found by a filter on (shard, first), and id i of
a block starts at bit i * bits, so ranges are unpacked with numpy without reading what stands before.
Blocks are written by Spark's own writer, so a lost task leaves no half-written file.

Edge cases: a null text is empty and still gets the end id; a null doc_id comes first; rows with one
doc_id are separate documents, ordered by a hash of the text; an empty table gives no blocks.
"""

from __future__ import annotations

import json
import os
import re
import string
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from saleslens.llm.shared import documents_of, partitions, parts_of, shown_id, stored
from saleslens.sources.layers import scratch_folder

BLOCK_IDS = 1 << 16
CACHE_WORDS = 500_000  # words in a worker's cache, about 20 MB; if there are more, three quarters as many stay
CHUNK_BYTES = 2 << 20  # so that each word is looked up seldom
MARKERS = "~^|=_"  # one that is in none of the words stands between them while they are encoded together
END_ID = 1
BLOCKS = (
    "shard int, block int, first long, n_ids int, bits int, payload binary, open_from long, "
    "doc_ids array<long>, lens array<int>"
)
_SCHEMA = pa.schema(
    [("shard", pa.int32()), ("block", pa.int32()), ("first", pa.int64()), ("n_ids", pa.int32()), ("bits", pa.int32()),
     ("payload", pa.binary()), ("open_from", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("lens", pa.list_(pa.int32()))]
)
PIECES = "shard int, start long, doc_id long, block int, n int, crc long, edge boolean"


def id_bits(vocabulary: int) -> int:
    return max(1, int(vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids as a stream of `bits` bits each; whole bytes need no spreading to single bits."""
    if bits % 8 == 0:
        return ids.astype(">u4").view(np.uint8).reshape(-1, 4)[:, 4 - bits // 8 :].tobytes()
    spread = np.unpackbits(ids.astype(">u4").view(np.uint8).reshape(-1, 4), axis=1)
    return np.packbits(spread[:, 32 - bits :]).tobytes()


def unpack(payload: bytes, bits: int, start: int, stop: int) -> np.ndarray:
    """Ids `start` to `stop` of a block."""
    first = start * bits // 8
    if bits % 8 == 0:
        wide = np.zeros((stop - start, 4), np.uint8)
        wide[:, 4 - bits // 8 :] = np.frombuffer(payload, np.uint8)[first : stop * bits // 8].reshape(stop - start, bits // 8)
        return wide.view(">u4").ravel().astype(np.uint32)
    raw = np.frombuffer(payload, np.uint8)[first : -(-stop * bits // 8)]
    skip = start * bits - first * 8
    flat = np.unpackbits(raw)[skip : skip + (stop - start) * bits].reshape(-1, bits)
    wide = np.zeros((len(flat), 32), np.uint8)
    wide[:, 32 - bits :] = flat
    return np.packbits(wide, axis=1).view(">u4").ravel().astype(np.uint32)


# Encoding


# What could be composed, or lower-cased by context: all but letters whose lower case stands alone.
_NOT_PLAIN = re.compile("[^\x00-\u02ff]|\u0130")
# Steps of a normalizer that leave plain lower-case words as they are, and a split that takes a run of letters, and the
# punctuation behind it, each as one piece.
_NO_EFFECT = [{"type": "NFC"}, {"type": "Lowercase"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}]
_LETTER_RUNS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


class WordEncoder:
    """A tokenizer of the tokenizers library that splits at white space, with the ids of known words kept.

    Normalising, splitting and merging never reach across white space in such a tokenizer, so the ids
    of a text are those of its words in order. Texts with control characters that Python, but not the
    tokenizer, takes as white space are encoded whole. If the tokenizer lower-cases, so are ASCII texts
    beforehand, unless they may hold a special token: fewer words are then different.

    Words of such texts skip the normalizer if it has no effect on them. If the tokenizer splits at the ends of runs
    of letters and marks the last id of each piece, runs of letters are encoded together and cut at these
    ids, and so is punctuation behind them.

    Words and their ids are Arrow arrays: each different word of a batch is looked up once, and the ids of all words
    are taken in a row. When there are too many known words, those that were met last stay.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # other tasks use the other cores
        self.tokenizer = Tokenizer.from_file(path)
        self.vocabulary = self.tokenizer.get_vocab_size(with_added_tokens=True)
        normalizer = self.tokenizer.normalizer
        self.lowers = normalizer is not None and normalizer.normalize_str("A") == "a"
        self.bare, self.ends = self._without_normalizer(path)
        self.batch = 0
        self.words, self.ids, self.met = pa.array([], pa.string()), pa.array([], pa.binary()), np.zeros(0, np.int64)
        self.markers = [
            (m, ids[0]) for m in MARKERS if len(ids := np.frombuffer(self._encode([m], self.tokenizer)[0], np.uint32)) == 1
        ]

    def _without_normalizer(self, path: str):
        """The tokenizer for words that need no normalizer, and which ids end a piece (None if that is not known)."""
        from tokenizers import Tokenizer

        parts = json.loads(self.tokenizer.to_str())
        steps = parts["normalizer"] or {"type": "Sequence", "normalizers": []}
        if any(step not in _NO_EFFECT for step in steps.get("normalizers", [steps])):
            return self.tokenizer, None
        bare = Tokenizer.from_file(path)
        bare.normalizer = None
        splits = (parts["pre_tokenizer"] or {}).get("pretokenizers") or [{}]
        suffix = parts["model"].get("end_of_word_suffix")
        if splits[0].get("pattern") != {"Regex": _LETTER_RUNS} or [x["type"] for x in splits] != ["Split", "ByteLevel"] or not suffix:
            return bare, None
        ends = np.zeros(self.vocabulary, bool)
        ends[[i for token, i in parts["model"]["vocab"].items() if token.endswith(suffix)]] = True
        return bare, ends

    @property
    def known(self) -> set[str]:
        return set(self.words.to_pylist())

    def _encode(self, texts: list[str], tokenizer) -> list[bytes]:
        found = tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in found]

    def _learn(self, words: list[str], tokenizer) -> dict[str, bytes]:
        cuts = [words[i : i + 512] for i in range(0, len(words), 512)]
        return {word: ids for cut in cuts for word, ids in zip(cut, self._encode_words(cut, tokenizer), strict=True)}

    def _learn_plain(self, words: list[str]) -> dict[str, bytes]:
        """As `_learn`, for words that need no normalizer."""
        if self.ends is None:
            return self._learn(words, self.bare)
        stems = {word: stem for word in words if (stem := word.rstrip(string.punctuation)).isalpha()}
        tails = {word: word[len(stem) :] for word, stem in stems.items() if len(stem) < len(word)}
        known = self._learn(list({word for word in words if word not in stems}.union(tails.values())), self.bare)
        runs = list(set(stems.values()))
        for i in range(0, len(runs), 256):
            known.update(zip(runs[i : i + 256], self._encode_runs(runs[i : i + 256]), strict=True))
        known.update([(word, known[stems[word]] + known[tail]) for word, tail in tails.items()])
        return known

    def _encode_runs(self, runs: list[str]) -> list[bytes]:
        """As `_encode`, but as one text, cut where pieces end, if there are as many as runs: each gives one at least."""
        found = self._encode([" ".join(runs)], self.bare)[0]
        stops = (4 * np.flatnonzero(self.ends[np.frombuffer(found, np.uint32)]) + 4).tolist()
        if len(stops) == len(runs) and stops[-1] == len(found):
            return [found[a:b] for a, b in zip([0, *stops], stops, strict=False)]
        return self._encode(runs, self.bare)

    def _encode_words(self, words: list[str], tokenizer) -> list[bytes]:
        """As `_encode`, but as one text, cut at the ids of a marker between the words: one that gives a single id each time,
        so that there is one fewer than words only if no word gives that id."""
        for marker, marked in self.markers:
            text = f" {marker} ".join(words)
            if text.count(marker) == len(words) - 1:
                found = self._encode([text], tokenizer)[0]
                ends = np.flatnonzero(np.frombuffer(found, np.uint32) == marked).tolist()
                if len(ends) == len(words) - 1:
                    stops = [*(4 * e for e in ends), len(found)]
                    return [found[a:b] for a, b in zip([0, *(4 * e + 4 for e in ends)], stops, strict=True)]
        return self._encode(words, tokenizer)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        whole = [_odd_space(t) for t in texts]
        plain = [_is_plain(t) for t in texts]
        cut = ["" if w else t.lower() if self.lowers and p else t for t, w, p in zip(texts, whole, plain, strict=True)]
        lists = pc.utf8_split_whitespace(pa.array(cut, pa.string()))
        begins, coded = lists.offsets.to_numpy(), lists.values.dictionary_encode()
        raw = np.zeros(len(coded.dictionary), bool)
        for i in (i for i, p in enumerate(plain) if not p):
            raw[coded.indices[begins[i] : begins[i + 1]].to_numpy()] = True
        ids = self._ids_of(coded.dictionary, raw).take(coded.indices)
        stops = np.frombuffer(ids.buffers()[1], np.int32)[ids.offset :][begins] // 4 if len(ids) else begins
        found = np.frombuffer(ids.buffers()[2] or b"", np.uint32) if len(ids) else np.zeros(0, np.uint32)
        return [
            np.frombuffer(self._encode([text], self.tokenizer)[0], np.uint32) if w else found[a:b]
            for text, w, a, b in zip(texts, whole, stops[:-1], stops[1:], strict=True)
        ]

    def _ids_of(self, words: pa.Array, raw: np.ndarray) -> pa.Array:
        """Ids of different words; the raw ones are of texts that are not plain."""
        at = pc.index_in(words, value_set=self.words)
        old = at.is_valid().to_numpy(zero_copy_only=False)
        new = np.flatnonzero(~old)
        added = words.take(pa.array(new))
        texts = added.to_pylist()
        learnt = self._learn_plain([t for t, r in zip(texts, raw[new], strict=True) if not r])
        learnt |= self._learn([t for t, r in zip(texts, raw[new], strict=True) if r], self.tokenizer)
        at = at.fill_null(0).to_numpy().astype(np.int64)
        at[new] = len(self.words) + np.arange(len(new))
        self.words = pa.concat_arrays([self.words, added])
        self.ids = pa.concat_arrays([self.ids, pa.array([learnt[t] for t in texts], pa.binary())])
        self.met = np.concatenate([self.met, np.zeros(len(new), np.int64)])
        self.batch += 1
        self.met[at] = self.batch
        found = self.ids.take(pa.array(at))
        if len(self.words) > CACHE_WORDS:
            kept = pa.array(np.argsort(-self.met, kind="stable")[: CACHE_WORDS * 3 // 4])
            self.words, self.ids, self.met = self.words.take(kept), self.ids.take(kept), self.met[kept.to_numpy()]
        return found


def _is_plain(text: str) -> bool:
    """Whether lower-casing here gives what the tokenizer would make of the text, and no special token is in it."""
    return "<|" not in text and (text.isascii() or not _NOT_PLAIN.search(text))


def _odd_space(text: str) -> bool:
    return any(c in text for c in "\x1c\x1d\x1e\x1f")


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


class _Shard:
    """Blocks of one shard, filled document by document."""

    def __init__(self, shard: int, bits: int, block_ids: int):
        self.shard, self.bits, self.block_ids = shard, bits, block_ids
        self.block = self.first = 0
        self._clear(None)

    def _clear(self, open_from):
        self.held: list[np.ndarray] = []
        self.size, self.doc_ids, self.lens, self.open_from = 0, [], [], open_from

    def flush(self, open_from=None) -> tuple:
        ids = np.concatenate(self.held)
        row = (self.shard, self.block, self.first, len(ids), self.bits, pack(ids, self.bits), self.open_from, self.doc_ids, self.lens)
        self.block, self.first = self.block + 1, self.first + len(ids)
        self._clear(open_from)
        return row

    def add(self, doc_id: int, ids: np.ndarray) -> Iterator[tuple]:
        begins = self.first + self.size
        while len(ids):
            room = self.block_ids - self.size
            part, ids = ids[:room], ids[room:]
            self.held.append(part)
            self.doc_ids.append(doc_id)
            self.lens.append(len(part))
            self.size += len(part)
            if self.size == self.block_ids:
                yield self.flush(begins if len(ids) else None)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _SCHEMA, strict=True)], schema=_SCHEMA)


def write_token_files(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    end_id: int = END_ID,
    id_col: str = "doc_id",
    text_col: str = "text",
    block_ids: int = BLOCK_IDS,
) -> str:
    """Encode whole texts and write them below `folder` in ascending id order; returns `folder`.

    One shuffle moves the texts into ranges of ids; each task then encodes, packs and writes its shard
    block by block, holding one block and one batch of texts.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(tokenizer)
        shard = _Shard(TaskContext.get().partitionId(), id_bits(max(words.vocabulary, end_id + 1)), block_ids)
        end = np.array([end_id], np.uint32)
        for part in (part for batch in batches for part in parts_of(batch, most=CHUNK_BYTES)):
            ids, texts = part.column("doc_id").to_pylist(), part.column("text").to_pylist()
            for doc_id, found in zip(ids, words.encode(texts), strict=True):
                for row in shard.add(doc_id, np.concatenate([found, end])):
                    yield _rows([row])
        if shard.size:
            yield _rows([shard.flush()])

    order = ["doc_id", "digest"]
    ranged = (
        documents_of(docs, id_col, text_col)
        .withColumn("digest", F.xxhash64("text"))
        .repartitionByRange(partitions(docs.sparkSession), *order)
        .sortWithinPartitions(*order)
    )
    ranged.drop("digest").mapInArrow(encode, BLOCKS).write.mode("overwrite").parquet(folder)
    return folder


# Reading


def read_blocks(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(BLOCKS).parquet(folder)


def read_range(blocks: DataFrame, shard: int, start: int, stop: int) -> np.ndarray:
    """Ids `start` to `stop` of a shard, from the blocks that hold them alone (random access)."""
    rows = blocks.where((F.col("shard") == shard) & (F.col("first") < stop) & (F.col("first") + F.col("n_ids") > start))
    parts = [
        unpack(bytes(r.payload), r.bits, max(0, start - r.first), min(r.n_ids, stop - r.first))
        for r in rows.orderBy("first").collect()
    ]
    return np.concatenate(parts) if parts else np.zeros(0, np.uint32)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: list[tuple] = []
        for row in batch.to_pylist():
            ids = unpack(row["payload"], row["bits"], 0, row["n_ids"]).astype("<u4")
            at = 0
            for k, (doc_id, n) in enumerate(zip(row["doc_ids"], row["lens"], strict=True)):
                goes_on = k == 0 and row["open_from"] is not None
                start = row["open_from"] if goes_on else row["first"] + at
                edge = goes_on or k == len(row["lens"]) - 1  # only there may documents go on
                out.append((row["shard"], start, doc_id, row["block"], n, zlib.crc32(ids[at : at + n].tobytes()), edge))
                at += n
        if out:
            yield pa.RecordBatch.from_pandas(
                pd.DataFrame(out, columns=["shard", "start", "doc_id", "block", "n", "crc", "edge"]).astype(
                    {"shard": "int32", "block": "int32", "n": "int32"}
                ),
                preserve_index=False,
            )


def _times(matrix: list[int], vector: int) -> int:
    total = i = 0
    while vector:
        if vector & 1:
            total ^= matrix[i]
        vector >>= 1
        i += 1
    return total


@lru_cache(maxsize=None)
def _zero_bytes(power: int) -> list[int]:
    """The effect of 2^power zero bytes."""
    step = _zero_bytes(power - 1) if power else [0xEDB88320] + [1 << i for i in range(31)]  # one zero bit
    for _ in range(1 if power else 3):
        step = [_times(step, v) for v in step]
    return step


def joined_crc(first: int, second: int, size: int) -> int:
    """crc32 of two byte strings in a row, from their own crc32 and the size of the second."""
    for power in range(size.bit_length()):
        if size >> power & 1:
            first = _times(_zero_bytes(power), first)
    return first ^ second


@F.pandas_udf(LongType())
def _whole_crc(sizes: pd.Series, crcs: pd.Series) -> pd.Series:
    def whole(n, parts):
        total = int(parts[0])
        for size, crc in zip(n[1:], parts[1:], strict=True):
            total = joined_crc(total, int(crc), 4 * int(size))
        return total

    return pd.Series([whole(n, parts) for n, parts in zip(sizes, crcs, strict=True)], dtype="int64")


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Per document, from the files: doc_id, start (ids of all documents before), n_tokens, ids_crc32, shard.

    Documents that span blocks are put together from their pieces' sums; only the pieces at the edges of blocks are
    grouped for that. The shards' sizes are one small row per file.
    """
    blocks = read_blocks(spark, folder)
    sizes = blocks.groupBy("shard").agg(F.sum("n_ids").alias("ids"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = sizes.select("shard", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base"))
    pieces = stored(blocks.mapInArrow(_pieces, PIECES), "pieces")
    place = ["shard", "start", "doc_id"]
    inside = pieces.where("NOT edge").select(*place, F.col("n").cast("long").alias("n_tokens"), F.col("crc").alias("ids_crc32"))
    parts = pieces.where("edge").groupBy(*place).agg(
        F.array_sort(F.collect_list(F.struct("block", "n", "crc"))).alias("parts")
    )
    joined = parts.select(
        *place,
        F.aggregate("parts.n", F.lit(0).cast("long"), lambda a, n: a + n).alias("n_tokens"),
        _whole_crc("parts.n", "parts.crc").alias("ids_crc32"),
    )
    return inside.unionByName(joined).join(F.broadcast(shards), "shard").select(
        shown_id(), (F.col("base") + F.col("start")).alias("start"), "n_tokens", "ids_crc32", "shard"
    )


def query(spark: SparkSession, docs: DataFrame, tokenizer: str) -> DataFrame:
    """Contract of op1: write all documents, then report from the files."""
    return read_documents(spark, write_token_files(docs, scratch_folder(spark, "tokens"), tokenizer))
