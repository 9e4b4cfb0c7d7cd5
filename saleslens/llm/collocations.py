"""Operator 13: phrase collocations by direct-address tiling of word pairs.

Texts are cut into pieces at `.,;:!?` and line ends and these into words at blanks, A-Z lower-cased. All
counts are per language. The words found often enough get ids by falling frequency, so that the pairs that
occur most stand close to the origin of the table of all pairs. That table is cut into square tiles: tiles
that a chunk of texts fills are counted by numpy's bincount over the cell number and kept for the
whole task, the other pairs as sorted coordinates with counts. Spark adds the counts up. The frequent pairs
are ranked again, and the table of (pair, third word) is counted in the same way, leaving out positions
where either pair is too rare for the three words to be a candidate.

What tasks are given is bounded: the `head` most frequent words, the `pair_head` most frequent pairs, and,
if there are more frequent pairs, one bitmap of `FILTER_BITS` bits over the hashes of the others, which may
let a rare pair pass (it is counted and then dropped) but holds back no frequent one. If there are more
frequent words than `head`, phrases with a word outside of it are counted as texts in one more pass. So
every bound moves work, none drops a phrase. Counts are 64-bit, scores are taken on decimals of 38 digits.

Edge cases: null texts are empty; a null language is `und` (and counts together with that name); repeated
rows and repeated or null doc_ids all count; languages without a candidate have no row; an empty table gives
an empty result; other columns are not read, whatever their names. Ties in score and count are settled by
the phrase in UTF-8 byte order.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from saleslens.llm.shared import LOWER, byte_texts, chunks, stored

LEAST = 10  # occurrences of a candidate
COVERED = 50  # per cent of a phrase's occurrences inside a longer candidate that drop it
TOP = 2000  # phrases reported a language
BITS = 20  # of a word id: three ids fit one 64-bit code
HEAD = 1 << BITS
HEAD_BYTES = 64 << 20
PAIR_HEAD = 1 << 21
FILTER_BITS = 1 << 27
BITMAP_BITS = 1 << 15  # Spark's bitmaps hold as many
CHUNK = 8 << 20
TILE_BITS = 9
TILES = 16  # a side: ids below 8,192 are addressed directly
FILLED = 1 << (2 * TILE_BITS - 5)  # pairs of a chunk in one tile that make it worth counting densely
SALTS = 16

WORD_ROWS = "lang string, word string, f long"
CODE_ROWS = "code long, f long"
PHRASE_ROWS = "lang string, phrase string, f long"
_LOW = (1 << BITS) - 1

_CLASS = np.zeros(256, np.uint8)  # 0 part of a word, 1 blank, 2 end of a piece
_CLASS[[0x20, 0x09]] = 1
_CLASS[[ord(c) for c in ".,;:!?"] + [0x0A, 0x0B, 0x0C, 0x0D]] = 2


@dataclass
class Tokens:
    """Words of some texts of one language: the distinct ones, which one stands at each place, and whether
    the next place is in the same piece."""

    words: pa.Array
    at: np.ndarray
    joined: np.ndarray


def tokens_of(texts: list[bytes]) -> Tokens:
    data = LOWER[np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)]
    kind = _CLASS[data]
    inside = kind == 0
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    starts, stops = edges[::2], edges[1::2]
    piece = np.cumsum(kind == 2, dtype=np.int32)[starts]
    offsets = np.zeros(len(starts) + 1, np.int32)
    np.cumsum(stops - starts, out=offsets[1:])
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(data[inside])]
    coded = pa.Array.from_buffers(pa.binary(), len(starts), buffers).dictionary_encode()
    return Tokens(coded.dictionary, coded.indices.to_numpy(), piece[1:] == piece[:-1])


def _by_language(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, Tokens]]:
    """Tokens of chunks of texts, one language each; texts wait until a chunk is full, together at most
    four chunks."""
    waiting: dict[str, list[bytes]] = {}
    size: dict[str, int] = {}

    def take(lang: str) -> Iterator[tuple[str, Tokens]]:
        texts = waiting.pop(lang)
        del size[lang]
        for start, stop in chunks([len(t) for t in texts], CHUNK):
            yield lang, tokens_of(texts[start:stop])

    for batch in batches:
        langs = batch.column("lang").to_pylist()
        for lang, text in zip(langs, byte_texts(batch.column("text")), strict=True):
            waiting.setdefault(lang, []).append(text)
            size[lang] = size.get(lang, 0) + len(text) + 1
            if size[lang] >= CHUNK:
                yield from take(lang)
            elif sum(size.values()) >= 4 * CHUNK:
                yield from take(max(size, key=size.get))
    for lang in list(waiting):
        yield from take(lang)


def _texts(array: pa.Array) -> pa.Array:
    return array.cast(pa.string())


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences of each word of a chunk, and of all its words under a null word."""
    for lang, tokens in _by_language(batches):
        words = pa.concat_arrays([_texts(tokens.words), pa.nulls(1, pa.string())])
        counts = np.append(np.bincount(tokens.at, minlength=len(tokens.words)), len(tokens.at)).astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(words), pa.string()), words, pa.array(counts)], names=["lang", "word", "f"]
        )


# Counting by tiles


class Tiles:
    """Counts of (row, column) cells: dense in the tiles that are well filled, else sorted coordinates."""

    def __init__(self, filled: int = FILLED):
        self.filled = filled
        self.dense: dict[int, np.ndarray] = {}

    def add(self, rows: np.ndarray, columns: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Count some cells. Gives those not kept in dense tiles as (rows, columns, counts), sorted."""
        near = (rows < TILES << TILE_BITS) & (columns < TILES << TILE_BITS)
        tile = ((rows[near] >> TILE_BITS) * TILES + (columns[near] >> TILE_BITS)).astype(np.uint16)
        sizes = np.bincount(tile, minlength=TILES * TILES)
        order = np.argsort(tile, kind="stable")
        mask = (1 << TILE_BITS) - 1
        cell = (((rows[near] & mask) << TILE_BITS) + (columns[near] & mask))[order]
        ends = np.cumsum(sizes)
        far = [(rows[~near] << 32) | columns[~near]]
        for number in np.flatnonzero(sizes):
            part = cell[ends[number] - sizes[number] : ends[number]]
            if sizes[number] >= self.filled or number in self.dense:
                counts = np.bincount(part, minlength=1 << (2 * TILE_BITS))
                held = self.dense.get(number)
                self.dense[number] = counts if held is None else held + counts
            else:
                row, column = self._place(number, part)
                far.append((row << 32) | column)
        codes, counts = np.unique(np.concatenate(far), return_counts=True)
        return codes >> 32, codes & 0xFFFFFFFF, counts

    @staticmethod
    def _place(number: int, cell: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        mask = (1 << TILE_BITS) - 1
        return (
            (int(number) // TILES << TILE_BITS) + (cell >> TILE_BITS),
            (int(number) % TILES << TILE_BITS) + (cell & mask),
        )

    def rest(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """The cells of the dense tiles."""
        for number, counts in self.dense.items():
            cells = np.flatnonzero(counts)
            yield *self._place(number, cells), counts[cells]


def _code_rows(codes: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(codes.astype(np.int64)), pa.array(counts.astype(np.int64))], names=["code", "f"]
    )


# What tasks are given


class Words:
    """The most frequent words of all languages; a word's id is its place by falling frequency."""

    def __init__(self, langs: pa.Array, words: pa.Array, counts: np.ndarray, whole: bool):
        self.langs, self.words, self.counts, self.whole = langs, words, counts, whole
        coded = langs.dictionary_encode()
        at = coded.indices.to_numpy()
        self.ids = {lang: np.flatnonzero(at == i) for i, lang in enumerate(coded.dictionary.to_pylist())}
        raw = words.cast(pa.binary())
        self.sets = {lang: raw.take(pa.array(ids)) for lang, ids in self.ids.items()}

    def ids_of(self, lang: str, words: pa.Array) -> np.ndarray:
        """Id of each word, -1 where it is not among them."""
        if lang not in self.ids:
            return np.full(len(words), -1)
        place = pc.index_in(words, value_set=self.sets[lang]).fill_null(-1).to_numpy(zero_copy_only=False)
        return np.where(place >= 0, self.ids[lang][place], -1)


_PRIME = [np.uint64(p) for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63)]
_START = np.uint64((42 + 0x27D4EB2F165667C5 + 8) % 2**64)


def _turned(values: np.ndarray, by: int) -> np.ndarray:
    return (values << np.uint64(by)) | (values >> np.uint64(64 - by))


def hashed(codes: np.ndarray) -> np.ndarray:
    """xxhash64 of 64-bit numbers, the same as Spark's function of this name gives."""
    values = codes.astype(np.uint64)
    values = _START ^ (_turned(values * _PRIME[1], 31) * _PRIME[0])
    values = _turned(values, 27) * _PRIME[0] + _PRIME[3]
    values = (values ^ (values >> np.uint64(33))) * _PRIME[1]
    values = (values ^ (values >> np.uint64(29))) * _PRIME[2]
    return values ^ (values >> np.uint64(32))


class Pairs:
    """The most frequent pairs, with ids by falling frequency, and a bitmap of the other frequent ones."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray, bitmap: np.ndarray | None):
        order = np.argsort(codes)
        self.codes, self.ids, self.counts = codes[order], order.astype(np.int64), counts[order]
        self.by_id, self.bitmap = codes, bitmap

    def find(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of each pair in `codes` (-1: none), and whether it may be frequent."""
        if not len(self.codes):
            return np.full(len(codes), -1), np.zeros(len(codes), bool)
        place = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        place = np.where(self.codes[place] == codes, place, -1)
        if self.bitmap is None:
            return place, place >= 0
        bit = hashed(codes) & np.uint64(FILTER_BITS - 1)
        held = (self.bitmap[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1
        return place, (place >= 0) | (held == 1)


def _pair_counts(words, filled: int) -> Callable:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, tiles = words.value, Tiles(filled)
        for lang, tokens in _by_language(batches):
            ids = known.ids_of(lang, tokens.words)[tokens.at]
            good = tokens.joined & (ids[:-1] >= 0) & (ids[1:] >= 0)
            rows, columns, counts = tiles.add(ids[:-1][good], ids[1:][good])
            yield _code_rows((rows << BITS) | columns, counts)
        for rows, columns, counts in tiles.rest():
            yield _code_rows((rows << BITS) | columns, counts)

    return count


def _triple_counts(words, pairs, filled: int) -> Callable:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, frequent, tiles = words.value, pairs.value, Tiles(filled)
        for lang, tokens in _by_language(batches):
            ids = known.ids_of(lang, tokens.words)[tokens.at]
            good = np.flatnonzero(tokens.joined & (ids[:-1] >= 0) & (ids[1:] >= 0))
            codes = (ids[good] << BITS) | ids[good + 1]
            place, likely = frequent.find(codes)
            good, codes, place = good[likely], codes[likely], place[likely]
            first = np.flatnonzero(good[1:] == good[:-1] + 1)  # both pairs of three words may be frequent
            codes, place, third = codes[first], place[first], ids[good[first] + 2]
            ranked = place >= 0
            rows, columns, counts = tiles.add(frequent.ids[place[ranked]], third[ranked])
            yield _code_rows((frequent.by_id[rows] << BITS) | columns, counts)
            rare, counts = np.unique((codes[~ranked] << BITS) | third[~ranked], return_counts=True)
            yield _code_rows(rare, counts)
        for rows, columns, counts in tiles.rest():
            yield _code_rows((frequent.by_id[rows] << BITS) | columns, counts)

    return count


def _outside_counts(words) -> Callable:
    """Phrases of two and three words with at least one word that has no id."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = words.value
        for lang, tokens in _by_language(batches):
            outside = (known.ids_of(lang, tokens.words) < 0)[tokens.at]
            at, joined, names = tokens.at, tokens.joined, _texts(tokens.words)
            pair = np.flatnonzero(joined & (outside[:-1] | outside[1:]))
            triple = np.flatnonzero(joined[:-1] & joined[1:] & (outside[:-2] | outside[1:-1] | outside[2:]))
            for places, size in ((pair, 2), (triple, 3)):
                found, counts = np.unique(np.stack([at[places + i] for i in range(size)]), axis=1, return_counts=True)
                phrases = pc.binary_join_element_wise(*[names.take(pa.array(row)) for row in found], " ")
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(counts), pa.string()), phrases, pa.array(counts.astype(np.int64))],
                    names=["lang", "phrase", "f"],
                )

    return count


def _summed(rows: DataFrame, keys: list[str], least: int) -> DataFrame:
    return rows.groupBy(*keys).agg(F.sum("f").alias("f")).where(F.col("f") >= least)


def _head(spark: SparkSession, words: DataFrame, most: int) -> Words:
    """The `most` most frequent words; fewer if they are very long."""
    top = words.orderBy(F.desc("f"), "lang", "word").limit(most + 1).toArrow().combine_chunks()
    if not len(top):
        return Words(pa.array([], pa.string()), pa.array([], pa.string()), np.zeros(0, np.int64), True)
    sizes = pc.add(pc.binary_length(top["word"]), pc.binary_length(top["lang"])).to_numpy()
    kept = min(int(np.searchsorted(np.cumsum(sizes, dtype=np.int64), HEAD_BYTES, "right")), most, len(top))
    whole, top = kept == len(top), top.slice(0, kept).combine_chunks()
    langs, names = (pa.concat_arrays(top[c].chunks) if kept else pa.array([], pa.string()) for c in ("lang", "word"))
    return Words(langs, names, top["f"].to_numpy(), whole)


def _pair_head(pairs: DataFrame, most: int) -> Pairs:
    top = pairs.orderBy(F.desc("f"), "code").limit(most + 1).toArrow()
    codes, counts = (top[c].to_numpy().copy() for c in ("code", "f"))
    if len(codes) <= most:
        return Pairs(codes, counts, None)
    codes, counts, least = codes[:most], counts[:most], int(counts[most])
    bit = F.expr(f"xxhash64(code) & {FILTER_BITS - 1}")
    maps = (
        pairs.where(F.col("f") <= least)
        .select(bit.alias("bit"))
        .groupBy(F.floor(F.col("bit") / BITMAP_BITS).alias("map"))
        .agg(F.bitmap_construct_agg(F.col("bit") % BITMAP_BITS).alias("bits"))
    )
    bitmap = np.zeros(FILTER_BITS // 8, np.uint8)
    for row in maps.toLocalIterator():
        at = row.map * (BITMAP_BITS // 8)
        bitmap[at : at + BITMAP_BITS // 8] |= np.frombuffer(bytes(row.bits), np.uint8)
    return Pairs(codes, counts, bitmap)


# From codes to phrases with the counts of their parts

_SCORED = "lang string, phrase string, size int, a long, f1 long, f2 long, f3 long, f12 long, f23 long, code12 long, code23 long"


def _spelled(words, pairs, size: int) -> Callable:
    """Phrases of codes, with the counts of their words and, where tasks know them, of their pairs."""

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, frequent = words.value, pairs.value
        for batch in batches:
            code = batch.column("code").to_numpy()
            ids = [(code >> (BITS * i)) & _LOW for i in reversed(range(size))]
            names = [known.words.take(pa.array(i)) for i in ids]
            phrase = pc.binary_join_element_wise(*names, " ")
            none = pa.nulls(len(code), pa.int64())
            counts = [pa.array(known.counts[i]) for i in ids] + [none] * (3 - size)
            inner, keys = [none, none], [none, none]
            if size == 3:
                for j, pair in enumerate([code >> BITS, code & ((1 << (2 * BITS)) - 1)]):
                    place, _ = frequent.find(pair)
                    inner[j] = pa.array(frequent.counts[place], mask=place < 0)
                    keys[j] = pa.array(pair)
            lang = known.langs.take(pa.array(ids[0]))
            sizes = pa.array(np.full(len(code), size, np.int32))
            yield pa.RecordBatch.from_arrays(
                [lang, phrase, sizes, batch.column("f"), *counts, *inner, *keys],
                names=[c.split()[0] for c in _SCORED.split(", ")],
            )

    return spell


def _with_pairs(triples: DataFrame, pairs: DataFrame) -> DataFrame:
    """Look up the pair counts that tasks did not know; these pairs are outside the most frequent, so none is hot."""
    for name in ("12", "23"):
        found = pairs.select(F.col("code").alias(f"code{name}"), F.col("f").alias("found"))
        triples = (
            triples.withColumn("asked", F.when(F.col(f"f{name}").isNull(), F.col(f"code{name}")))
            .join(found.withColumnRenamed(f"code{name}", "asked"), "asked", "left")
            .withColumn(f"f{name}", F.coalesce(f"f{name}", "found"))
            .drop("asked", "found")
        )
    return triples


def _outside(phrases: DataFrame, counts: DataFrame) -> DataFrame:
    """Phrases with words outside the head, with the counts of their parts looked up by text.

    A frequent word may be a part of very many of them: its lookups are spread over `SALTS` rows a part.
    """
    part = F.split("phrase", " ")
    spread = F.pmod(F.xxhash64("phrase"), F.lit(SALTS)).cast("int")
    rows = phrases.select("lang", "phrase", F.size(part).alias("size"), F.col("f").alias("a"), part.alias("w"), spread.alias("salt"))
    table = counts.select(
        "lang", F.col("phrase").alias("part"), F.col("f").alias("found"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    )
    parts = {
        "f1": F.expr("w[0]"),
        "f2": F.expr("w[1]"),
        "f3": F.expr("get(w, 2)"),
        "f12": F.when(F.col("size") == 3, F.concat_ws(" ", F.expr("w[0]"), F.expr("w[1]"))),
        "f23": F.when(F.col("size") == 3, F.concat_ws(" ", F.expr("w[1]"), F.expr("get(w, 2)"))),
    }
    for name, text in parts.items():
        rows = rows.withColumn("part", text).join(table, ["lang", "part", "salt"], "left").withColumnRenamed("found", name).drop("part")
    return rows.select("lang", "phrase", "size", "a", *parts)


def _scored(rows: DataFrame) -> DataFrame:
    """Counts l and r and the score of the lowest-scoring cut, the first of equal ones."""

    def cut(left: str, right: str):
        top = "CAST(a AS DECIMAL(15,0)) * CAST(a AS DECIMAL(15,0)) * CAST(1000000 AS DECIMAL(7,0))"
        score = F.expr(f"({top}) div (CAST({left} AS DECIMAL(15,0)) * CAST({right} AS DECIMAL(15,0)))")
        return F.struct(score.alias("score"), F.col(left).alias("l"), F.col(right).alias("r"))

    first, second = cut("f1", "f23"), cut("f12", "f3")
    best = F.when(F.col("size") == 2, cut("f1", "f2")).when(first["score"] <= second["score"], first).otherwise(second)
    return rows.withColumn("best", best).select("lang", "phrase", "size", "a", "best.*")


def _uncovered(rows: DataFrame, covered: int) -> DataFrame:
    """Without the pairs of which a phrase of three words covers a stated share."""
    words = F.split("phrase", " ")
    inside = F.explode(F.array(F.concat_ws(" ", words[0], words[1]), F.concat_ws(" ", words[1], F.get(words, F.lit(2)))))
    most = rows.where("size = 3").select("lang", inside.alias("phrase"), F.col("a").alias("longer")).groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    pairs = rows.where("size = 2").join(most, ["lang", "phrase"], "left")
    kept = pairs.where(F.col("longer").isNull() | (100 * F.col("longer") < covered * F.col("a"))).drop("longer")
    return kept.unionByName(rows.where("size = 3"))


def collocations(
    docs: DataFrame,
    lang_col: str = "lang",
    text_col: str = "text",
    least: int = LEAST,
    covered: int = COVERED,
    top: int = TOP,
    head: int = HEAD,
    pair_head: int = PAIR_HEAD,
    filled: int = FILLED,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best phrases of two and three words of each language."""
    spark = docs.sparkSession
    texts = docs.select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    words = stored(
        texts.mapInArrow(_word_counts, WORD_ROWS)
        .groupBy("lang", "word")
        .agg(F.sum("f").alias("f"))
        .where(F.col("word").isNull() | (F.col("f") >= least)),
        "phrase-words",
    )
    totals = words.where("word is null").select("lang", F.col("f").alias("n"))
    frequent = words.where("word is not null")
    known = _head(spark, frequent, min(head, HEAD))
    given = spark.sparkContext.broadcast(known)
    pairs = stored(_summed(texts.mapInArrow(_pair_counts(given, filled), CODE_ROWS), ["code"], least), "phrase-pairs")
    given_pairs = spark.sparkContext.broadcast(_pair_head(pairs, pair_head))
    triples = stored(
        _summed(texts.mapInArrow(_triple_counts(given, given_pairs, filled), CODE_ROWS), ["code"], least), "phrase-triples"
    )
    spelled = [pairs.mapInArrow(_spelled(given, given_pairs, 2), _SCORED), triples.mapInArrow(_spelled(given, given_pairs, 3), _SCORED)]
    if given_pairs.value.bitmap is not None:
        spelled[1] = _with_pairs(spelled[1], pairs)
    rows = spelled[0].unionByName(spelled[1])
    if not known.whole:
        others = stored(_summed(texts.mapInArrow(_outside_counts(given), PHRASE_ROWS), ["lang", "phrase"], least), "phrase-others")
        counts = (
            frequent.select("lang", F.col("word").alias("phrase"), "f")
            .unionByName(rows.where("size = 2").select("lang", "phrase", F.col("a").alias("f")))
            .unionByName(others)
        )
        rows = rows.select("lang", "phrase", "size", "a", "f1", "f2", "f3", "f12", "f23").unionByName(_outside(others, counts))
    kept = _uncovered(_scored(rows), covered)
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(SALTS))).orderBy(*order)
    best = kept.withColumn("rank", F.row_number().over(salted)).where(F.col("rank") <= top)
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )


def query(docs: DataFrame) -> DataFrame:
    return collocations(docs)


ORACLE_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), numbered AS (
  SELECT lang, row_number() OVER () AS id, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), words AS (
  SELECT lang, id, unnest(w) AS w1, generate_subscripts(w, 1) AS i FROM numbered
), places AS (
  SELECT lang, w1, lead(w1, 1) OVER piece AS w2, lead(w1, 2) OVER piece AS w3 FROM words WINDOW piece AS (PARTITION BY id ORDER BY i)
), grams AS (
  SELECT lang, 1 AS k, w1 AS phrase, count(*) AS f FROM places GROUP BY ALL
  UNION ALL SELECT lang, 2, w1 || ' ' || w2, count(*) FROM places WHERE w2 IS NOT NULL GROUP BY ALL
  UNION ALL SELECT lang, 3, w1 || ' ' || w2 || ' ' || w3, count(*) FROM places WHERE w3 IS NOT NULL GROUP BY ALL
), totals AS (
  SELECT lang, sum(f)::BIGINT AS n FROM grams WHERE k = 1 GROUP BY lang
), candidates AS (
  SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM grams WHERE k > 1 AND f >= 10
), cuts AS (
  SELECT c.lang, c.k, c.phrase, c.a, cut, array_to_string(w[1:cut], ' ') AS head, array_to_string(w[cut + 1:k], ' ') AS tail
  FROM candidates c, (VALUES (1), (2)) AS places(cut) WHERE cut < k
), scored AS (
  SELECT cuts.lang, cuts.k, cuts.phrase, a, cut, x.f AS l, y.f AS r,
    ((1000000::HUGEINT * a * a) // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM cuts JOIN grams x ON x.lang = cuts.lang AND x.phrase = cuts.head JOIN grams y ON y.lang = cuts.lang AND y.phrase = cuts.tail
), chosen AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
), inner_pairs AS (
  SELECT lang, phrase, max(a) AS longer FROM (
    SELECT lang, array_to_string(w[1:2], ' ') AS phrase, a FROM candidates WHERE k = 3
    UNION ALL SELECT lang, array_to_string(w[2:3], ' '), a FROM candidates WHERE k = 3) GROUP BY ALL
), kept AS (
  SELECT c.* FROM chosen c LEFT JOIN inner_pairs i ON i.lang = c.lang AND i.phrase = c.phrase
  WHERE i.longer IS NULL OR 100 * i.longer < 50 * c.a
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept JOIN totals USING (lang)
QUALIFY rank <= 2000
"""
