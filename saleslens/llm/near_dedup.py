"""Operator 9: near-duplicate documents by DartMinHash signatures and banded joining.

A document is a weighted set of shingles of five words. Its darts come from a random process over
(weight, rank) that is fixed for each shingle by hashing: the darts of a shingle below its weight are
the document's, and each is assigned a coordinate by hash. The dart of lowest rank in each coordinate is
the signature, and two documents agree in a coordinate with the probability of their (weighted)
Jaccard similarity. Only ranks up to a bound near k ln k / total weight are thrown, so the work
is proportional to the shingles and k ln k; where a coordinate stays empty the bound is doubled.

Signatures are cut into bands; documents that agree in a band are candidates (at similarity 0.8 a pair
is missed with a probability of 3e-6). Every link is verified on the shingle sets:

1. texts with the same words are one class, and so are texts without words that are equal byte for byte; the
   smallest id of a class goes on alone;
2. in each bucket of a band, every member is compared with the smallest one. Linked documents and
   copies form components, found by passing the smallest id along and by pointer jumping;
3. members of one bucket that are still in different components are compared too, unless a link is ruled
   out: by the distances to the bucket's smallest member (Jaccard distance is a metric), or by the
   number of shingles that only one of all these documents has, or by counts of shingles in groups. What
   is found joins whole components, so that their smallest ids are linked once more.

So no link between documents that share a band is lost, and buckets of copies cost one comparison a
member. Buckets with very many members are met by broadcast of their smallest member, not gathered.

Edge cases: a text with fewer words than a shingle, but not none, is one shingle; texts
without words have no shingles and are alike only to equal texts; null and empty texts are alike to nothing
and keep their own class; a null doc_id is the
smallest id and shown as null; rows that share a doc_id get one class, the union of their links; an
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleslens.llm.shared import (
    NO_ID,
    RUN_POWERS,
    byte_texts,
    chunks,
    documents_of,
    join_hot,
    mixed,
    parts_of,
    prefix_hashes,
    run_hashes,
    shown_id,
    slice_hashes,
    stored,
    words_of,
)

SHINGLE = 5
SIMILAR = 0.8
BANDS, ROWS = 24, 4
LOWEST_RANK = -8  # darts below rank 2^LOWEST_RANK are thrown together
CELL_AREA = 8.0
BROADCAST_IDS = 1_000_000
BROADCAST_ROOTS = 250_000
OUTLINE, PLANES = 256, 4
_CELL = 0x9E3779B97F4A7C15


# Signatures


def shingle_hashes(texts: list[bytes], size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Shingles of several texts one after the other, repeats too: hash, number of the text, where each
    text's begin (with the end of all), and two hashes (texts x 2) of all its words in order."""
    _, _, _, hashes, firsts = words_of(texts)
    n_words = np.diff(firsts)
    runs = run_hashes(hashes, size)
    counts = np.maximum(n_words - size + 1, 0)
    counts[(n_words > 0) & (n_words < size)] = 1
    begins = np.concatenate([[0], np.cumsum(counts)])
    owner = np.repeat(np.arange(len(texts)), counts)
    at = np.arange(begins[-1]) - begins[owner] + firsts[owner]
    short = n_words[owner] < size
    shingles = np.zeros(len(at), np.uint64)
    shingles[~short] = runs[at[~short]]
    whole = np.stack([_sequence_hashes(hashes, firsts, salt) for salt in (3, 5)], axis=1)
    shingles[short] = whole[owner[short], 0]
    return shingles, owner, begins, whole


def _sequence_hashes(hashes: np.ndarray, firsts: np.ndarray, salt: int) -> np.ndarray:
    """Hash of all words of each text, over their number too."""
    sums = prefix_hashes(mixed(hashes + np.uint64(salt)), RUN_POWERS)
    return mixed(slice_hashes(sums, firsts[:-1], firsts[1:], RUN_POWERS) + np.diff(firsts).astype(np.uint64))


def _uniform(hashes: np.ndarray) -> np.ndarray:
    return ((hashes >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53


def _cell_darts(shingles, weights, owner, weight_at, weight_size, rank_at, rank_size, cell: int):
    """Owner, rank, coordinate hash and name of the darts of one cell that lie below the weights.

    The number of darts has a Poisson distribution with the cell's area as mean, drawn by hash.
    """
    mean = weight_size * rank_size
    key = mixed(shingles + np.uint64((cell + 1) * _CELL % 2**64))
    draw = _uniform(key)
    term = total = float(np.exp(-mean))
    own = np.flatnonzero(draw > total)
    key, draw, count = key[own], draw[own], np.ones(len(own), np.int64)
    for n in range(1, 64):
        term *= mean / n
        total += term
        over = draw > total
        if not over.any():
            break
        count[over] += 1
    if not len(own):
        return None
    own, key = np.repeat(own, count), np.repeat(key, count)
    turn = np.arange(len(own)) - np.repeat(np.cumsum(count) - count, count)
    name = mixed(key + (turn + 1).astype(np.uint64) * np.uint64(_CELL))
    place = _uniform(mixed(name ^ np.uint64(0x5851F42D4C957F2D)))
    below = weight_at + weight_size * place < weights[own]
    own, name = own[below], name[below]
    rank = rank_at + rank_size * _uniform(mixed(name ^ np.uint64(0x14057B7EF767814F)))
    return owner[own], rank, mixed(name ^ np.uint64(0x2545F4914F6CDD1D)), name


def _strip_darts(shingles, weights, owner, low: float, high: float, number: int) -> Iterator[tuple]:
    """Darts of ranks from `low` to `high`, in cells of an area of CELL_AREA at most. The cells depend on
    the strip alone, so documents of any size see the same darts."""
    rank_cuts = max(1, int(np.ceil((high - low) / CELL_AREA)))
    rank_size = (high - low) / rank_cuts
    top = float(weights.max(initial=0))
    weight_at, weight_size, column = 0.0, 1.0, 0
    while weight_at < top:
        reach = slice(None) if weight_at == 0 else weights > weight_at
        part = shingles[reach], weights[reach], owner[reach]
        parts = max(1, int(np.ceil(weight_size * rank_size / CELL_AREA)))
        size = weight_size / parts
        for i in range(parts):
            for j in range(rank_cuts):
                cell = ((number * 64 + column) * 2**20 + i) * 2**20 + j
                darts = _cell_darts(*part, weight_at + i * size, size, low + j * rank_size, rank_size, cell)
                if darts is not None:
                    yield darts
        weight_at += weight_size
        weight_size, column = weight_at, column + 1  # [0, 1), [1, 2), [2, 4), [4, 8) ...


def signatures(shingles: np.ndarray, weights: np.ndarray, owner: np.ndarray, texts: int, k: int) -> np.ndarray:
    """Names of the darts of lowest rank in each of k coordinates, for texts that have shingles.

    A shingle that stands twice throws the same darts, so repeats count once at the larger weight.
    """
    total = np.bincount(owner, weights, minlength=texts)
    wanted = (k * np.log(k) + 2 * k) / np.maximum(total, 1e-9)
    upto = np.maximum(LOWEST_RANK, np.ceil(np.log2(wanted)).astype(int))
    best_rank, best = np.full(texts * k, np.inf), np.zeros(texts * k, np.uint64)
    open_ = total > 0

    def throw(low: float, high: float, number: int, chosen: np.ndarray) -> None:
        mine = chosen[owner]
        for own, rank, coordinate, name in _strip_darts(shingles[mine], weights[mine], owner[mine], low, high, number):
            at = own * k + (coordinate % np.uint64(k)).astype(np.int64)
            order = np.argsort(-rank, kind="stable")  # the lowest is written last
            at, rank, name = at[order], rank[order], name[order]
            better = rank < best_rank[at]
            best_rank[at[better]], best[at[better]] = rank[better], name[better]

    throw(0.0, 2.0**LOWEST_RANK, 0, open_)
    exponent = LOWEST_RANK
    while open_.any():
        chosen = open_ & ((upto > exponent) | np.isinf(best_rank.reshape(texts, k)).any(axis=1))
        open_ = chosen
        if chosen.any():
            throw(2.0**exponent, 2.0 ** (exponent + 1), exponent - LOWEST_RANK + 1, chosen)
        exponent += 1
    return best.reshape(texts, k)


def band_keys(names: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """One hash per text and band, over the band's coordinates and its number."""
    cut = names.reshape(len(names), bands, rows)
    keys = np.tile(np.arange(bands, dtype=np.uint64), (len(names), 1))
    for row in range(rows):
        keys = mixed(keys * np.uint64(_CELL) + cut[:, :, row])
    return keys


def _weights(shingles: np.ndarray, owner: np.ndarray, weighted: bool) -> np.ndarray:
    """1 for sets; else how often the shingle stands in its text."""
    if not weighted or not len(shingles):
        return np.ones(len(shingles))
    order = np.lexsort((shingles, owner))
    new = np.ones(len(order), bool)
    new[1:] = (shingles[order][1:] != shingles[order][:-1]) | (owner[order][1:] != owner[order][:-1])
    group = np.cumsum(new) - 1
    weights = np.empty(len(order))
    weights[order] = np.bincount(group)[group]
    return weights


def sign(docs: DataFrame, weighted: bool = False) -> DataFrame:
    """doc_id, two hashes of the words (of the bytes without words, null for an empty text), and the band keys
    (empty without words), where the texts are read."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (part for batch in batches for part in parts_of(batch)):
            texts = byte_texts(part.column("text"))
            shingles, owner, begins, whole = shingle_hashes(texts)
            for i in np.flatnonzero(np.diff(begins) == 0):
                whole[i] = np.frombuffer(hashlib.blake2b(texts[i], digest_size=16).digest(), np.uint64)
            names = signatures(shingles, _weights(shingles, owner, weighted), owner, part.num_rows, BANDS * ROWS)
            some = np.diff(begins) > 0
            keys = band_keys(names).view(np.int64)[some]
            lists = pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], np.cumsum(some * BANDS)]), pa.int32()), pa.array(keys.ravel())
            )
            empty = np.array([not t for t in texts], bool)
            words = [pa.array(np.ascontiguousarray(whole[:, i]).view(np.int64), mask=empty) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), *words, lists], ["doc_id", "w1", "w2", "keys"])

    return docs.mapInArrow(work, "doc_id long, w1 long, w2 long, keys array<long>")


# Verification


def similarity(one, two, weighted: bool) -> float:
    """(Weighted) Jaccard similarity of two texts' shingles, given with repeats."""
    if not weighted:
        one, two = set(one), set(two)
        both = len(one & two)
        return both / (len(one) + len(two) - both) if one or two else 0.0
    one, two = Counter(one), Counter(two)
    most = (one | two).total()
    return (one & two).total() / most if most else 0.0


def _texts_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Texts of some documents; up to BROADCAST_IDS ids are counted and broadcast, so that no other text is
    shuffled, and more meet the texts by a shuffle."""
    ids = stored(ids, "ids")
    few = ids.count() <= BROADCAST_IDS
    return docs.select("doc_id", "text").join(F.broadcast(ids) if few else ids, "doc_id", "left_semi")


def verified(pairs: DataFrame, docs: DataFrame, weighted: bool = False) -> DataFrame:
    """(a, b) with their similarity. Texts meet the pairs by a shuffle; a document in very many pairs is
    split by adaptive execution, as each pair needs one row of it."""
    texts = _texts_of(docs, pairs.select("a").unionByName(pairs.select(F.col("b").alias("a"))).distinct().toDF("doc_id"))
    met = pairs.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b").join(
        texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a"
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ones, twos = byte_texts(batch.column("text_a")), byte_texts(batch.column("text_b"))
            found = np.zeros(len(ones))
            for start, stop in chunks([len(x) + len(y) for x, y in zip(ones, twos, strict=True)]):
                texts = [t for pair in zip(ones[start:stop], twos[start:stop], strict=True) for t in pair]
                shingles, _, begins, _ = shingle_hashes(texts)
                parts = [shingles[i:j].tolist() for i, j in zip(begins[:-1], begins[1:], strict=True)]
                found[start:stop] = [similarity(x, y, weighted) for x, y in zip(parts[::2], parts[1::2], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(found)], ["a", "b", "similar"])

    return met.select("a", "b", "text_a", "text_b").mapInArrow(compare, "a long, b long, similar double")


# Components


def components(links: DataFrame) -> DataFrame:
    """(doc_id, root) for all ids in links (a, b): root is the smallest id of the component.

    Alternates two steps: ids between smaller and larger neighbours hand their smallest one to the larger ones,
    then ids with several smaller neighbours hand the smallest to the others. Once no id is of either kind, every
    id is a neighbour of its root. The smallest neighbour is a combined minimum, and what is handed on meets the
    links by broadcast, or by a join for hot keys if it is much.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v")
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        smaller = F.max(F.when(F.col("v") < F.col("u"), F.col("v")))
        roles = stored(
            both.groupBy("u").agg(
                F.count("*").alias("n"),
                F.min("v").alias("m"),
                ((F.min("v") < F.col("u")) & (F.max("v") > F.col("u"))).alias("between"),
                F.coalesce(smaller != F.min("v"), F.lit(False)).alias("forked"),
            ),
            "roles",
        )
        if roles.where("between OR forked").isEmpty():
            return roles.select(F.col("u").alias("doc_id"), F.least("u", "m").alias("root"))
        edges = stored(_small_star(_large_star(edges, roles.where("between"))), "edges")


def _met(edges: DataFrame, by: DataFrame, how: str) -> DataFrame:
    """Links with the smallest neighbour m of their id u, for the ids of `by`."""
    by = by.select("u", "n", "m")
    if by.count() <= BROADCAST_ROOTS:
        return edges.join(F.broadcast(by), "u", how)
    return join_hot(edges, by, ["u"], "n", edges.count(), how)


def _large_star(edges: DataFrame, between: DataFrame) -> DataFrame:
    larger = edges.select(F.col("v").alias("u"), F.col("u").alias("v"))
    return _met(larger, between, "left").select(F.col("v").alias("u"), F.coalesce("m", "u").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    smaller = edges.groupBy("u").agg(F.count("*").alias("n"), F.min("v").alias("m"), F.max("v").alias("last"))
    smaller = stored(smaller, "smaller")
    handed = _met(edges, smaller.where("m <> last"), "inner").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return smaller.select("u", F.col("m").alias("v")).unionByName(handed.where("u <> v"))


def _rooted(rows: DataFrame, column: str, roots: DataFrame) -> DataFrame:
    """`rows` with the root of the ids in `column`; an id without links is its own."""
    found = roots.select(F.col("doc_id").alias(column), F.col("root").alias(f"{column}_root"))
    found = F.broadcast(found) if roots.count() <= BROADCAST_ROOTS else found
    return rows.join(found, column, "left").withColumn(f"{column}_root", F.coalesce(f"{column}_root", column))


# Classes


def _chosen(signed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Links of copies to the first document with the same words (bytes without words), and the signatures of
    the first ones."""
    words = ["w1", "w2"]
    some = signed.where("w1 IS NOT NULL")
    # Texts with the same words have the same signature.
    firsts = some.groupBy(*words).agg(F.count("*").alias("n"), F.min("doc_id").alias("first"), F.first("keys").alias("keys"))
    firsts = stored(firsts, "firsts")
    rows = join_hot(some.select("doc_id", *words), firsts.drop("keys"), words, "n", signed.count())
    copies = rows.where("doc_id <> first").select(F.col("first").alias("a"), F.col("doc_id").alias("b")).distinct()
    return copies, firsts.select(F.col("first").alias("doc_id"), "keys")


def _members(heads: DataFrame) -> DataFrame:
    """(key, first, doc_id): other documents of each bucket, and its smallest."""
    rows = heads.select("doc_id", F.explode("keys").alias("key"))
    buckets = stored(
        rows.groupBy("key").agg(F.count("*").alias("n"), F.min("doc_id").alias("first")).where("n > 1"), "buckets"
    )
    return join_hot(rows, buckets, ["key"], "n", heads.count() * BANDS).where("doc_id <> first").select("key", "first", "doc_id")


def _own_shingles(docs: DataFrame, weighted: bool) -> DataFrame:
    """(doc_id, own): the weight of a document's shingles that no other document here has, if there are any."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (part for batch in batches for part in parts_of(batch)):
            shingles, owner, _, _ = shingle_hashes(byte_texts(part.column("text")))
            weight = _weights(shingles, owner, weighted)
            order = np.lexsort((shingles, owner))
            new = np.ones(len(order), bool)
            new[1:] = (shingles[order][1:] != shingles[order][:-1]) | (owner[order][1:] != owner[order][:-1])
            kept = order[new]
            ids = part.column("doc_id").to_numpy()[owner[kept]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids), pa.array(shingles[kept].view(np.int64)), pa.array(weight[kept])], ["doc_id", "shingle", "weight"]
            )

    rows = docs.select("doc_id", "text").mapInArrow(work, "doc_id long, shingle long, weight double")
    # One row a shingle and task before the shuffle; the weights of shingles held twice go to no owner.
    held = rows.groupBy("shingle").agg(F.min("doc_id").alias("one"), F.max("doc_id").alias("other"), F.max("weight").alias("weight"))
    return held.where("one = other").groupBy(F.col("one").alias("doc_id")).agg(F.sum("weight").alias("own"))


def outline(shingles: np.ndarray, weighted: bool) -> tuple[float, np.ndarray, int]:
    """Weight of a text's shingles; bits that tell in which of OUTLINE groups of hashes they weigh 1 at least, 2 at
    least and so on up to PLANES; and the weight beyond that in all groups together."""
    known, count = np.unique(shingles, return_counts=True)
    count = count if weighted else np.ones(len(known), np.int64)
    weight = np.bincount((known % np.uint64(OUTLINE)).astype(np.int64), count, minlength=OUTLINE).astype(np.int64)
    bits = np.packbits(weight[None, :] > np.arange(PLANES)[:, None], bitorder="little").view(np.int64)
    return float(weight.sum()), bits, int(np.maximum(weight - PLANES, 0).sum())


def _outlines(docs: DataFrame, weighted: bool) -> DataFrame:
    """(doc_id, size, bits, rest) of each text: its `outline`."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (part for batch in batches for part in parts_of(batch)):
            shingles, _, begins, _ = shingle_hashes(byte_texts(part.column("text")))
            found = [outline(shingles[a:b], weighted) for a, b in zip(begins[:-1], begins[1:], strict=True)]
            sizes, bits, rests = zip(*found, strict=True)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(sizes, pa.float64()), pa.array([b.tolist() for b in bits], pa.list_(pa.int64())), pa.array(rests, pa.int64())],
                ["doc_id", "size", "bits", "rest"],
            )

    return docs.select("doc_id", "text").mapInArrow(work, "doc_id long, size double, bits array<long>, rest long")


def _left_open(
    members: DataFrame, compared: DataFrame, roots: DataFrame, docs: DataFrame, similar: float, weighted: bool
) -> DataFrame:
    """Pairs (a, b) of one bucket, in different components (a_root < b_root, in any order), that may still be links.

    A pair is ruled out by the distances of both to the bucket's smallest member; by the shingles that only
    one document of all these buckets has, which are outside the intersection and inside the union; or by
    the outlines: the intersection is at most the sum over groups of the smaller weight, of which the bits
    give the first PLANES of each group. The buckets are joined on few bytes a row, as each row meets many.
    """
    far = (1 - F.col("similar")).alias("far")
    pairs = _rooted(_rooted(compared, "a", roots), "b", roots).select("a", "b", "b_root", far, (F.col("a_root") != F.col("b_root")).alias("astray"))
    sides = members.select("key", F.col("first").alias("a"), F.col("doc_id").alias("b")).join(pairs, ["a", "b"])
    sides = stored(sides.drop("a"), "sides")
    asked = sides.join(sides.where("astray").select("key").distinct(), "key", "left_semi")
    texts = _texts_of(docs, asked.select(F.col("b").alias("doc_id")).distinct())
    outlines = _outlines(texts, weighted).groupBy("doc_id").agg(
        F.sum("size").alias("size"), F.first("bits").alias("bits"), F.first("rest").alias("rest")
    )
    own = outlines.join(_own_shingles(texts, weighted), "doc_id", "left").withColumn("own", F.coalesce("own", F.lit(0.0)))
    own = stored(own.where(F.col("size") - F.col("own") >= similar * F.col("size") - 1e-6).withColumnRenamed("doc_id", "b"), "own")
    sides = stored(sides.join(own, "b"), "sides")
    columns = ["b", "b_root", "far", "astray", "size", "own", "bits", "rest"]
    others = sides.select("key", *(F.col(c).alias(f"r_{c}") for c in columns))
    common = F.least("rest", "r_rest")
    for i in range(OUTLINE * PLANES // 64):
        common = common + F.bit_count(F.col("bits")[i].bitwiseAND(F.col("r_bits")[i]))
    shared = F.least(F.col("size") - F.col("own"), F.col("r_size") - F.col("r_own"))
    union = F.greatest(F.col("size") + F.col("r_own"), F.col("r_size") + F.col("own"))
    lost = sides.where("astray")
    possible = (
        (F.col("b_root") != F.col("r_b_root"))
        & (~F.col("r_astray") | (F.col("b") < F.col("r_b")))
        & (F.abs(F.col("far") - F.col("r_far")) <= 1 - similar + 1e-9)
        & (shared >= similar * union - 1e-6)
        & (common >= similar * (F.col("size") + F.col("r_size") - common) - 1e-6)
    )
    return lost.join(others, (lost["key"] == others["key"]) & possible).select(
        F.least("b", "r_b").alias("a"),
        F.greatest("b", "r_b").alias("b"),
        F.least("b_root", "r_b_root").alias("a_root"),
        F.greatest("b_root", "r_b_root").alias("b_root"),
    ).distinct()


def classes(
    docs: DataFrame, similar: float = SIMILAR, weighted: bool = False, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id and class_id, the smallest doc_id of all documents linked to it, directly or not."""
    docs = documents_of(docs, id_col, text_col)
    signed = stored(sign(docs, weighted), "signed")
    copies, heads = _chosen(signed)
    copies, heads = stored(copies, "copies"), stored(heads, "heads")
    members = stored(_members(heads), "members")
    firsts = stored(members.select(F.col("first").alias("a"), F.col("doc_id").alias("b")).distinct(), "firsts")
    compared = stored(verified(firsts, docs, weighted).groupBy("a", "b").agg(F.max("similar").alias("similar")), "compared")
    linked = compared.where(F.col("similar") >= similar).select("a", "b")
    roots = components(copies.unionByName(linked))
    open_ = stored(_left_open(members, compared, roots, docs, similar, weighted), "open")
    near = verified(open_.select("a", "b"), docs, weighted).where(F.col("similar") >= similar).select("a", "b").distinct()
    more = stored(open_.join(near, ["a", "b"], "left_semi").select(F.col("a_root").alias("a"), F.col("b_root").alias("b")), "more")
    ids = signed.select("doc_id").distinct()
    found = _rooted(_rooted(ids, "doc_id", roots), "doc_id_root", components(more))
    return found.select("doc_id", F.col("doc_id_root_root").alias("class_id"))


def query(docs: DataFrame) -> DataFrame:
    """Near-duplicate classes of all documents: doc_id, class_id and whether the document stays."""
    found = classes(docs)
    kept = (F.col("doc_id") == F.col("class_id")).alias("kept")
    return found.select(shown_id(), shown_id("class_id"), kept)


def keep_first(docs: DataFrame) -> DataFrame:
    """Rows of `docs`, with all their columns, whose document is the first of its class.

    Of rows that share a doc_id, all stay or none.
    """
    found = classes(docs)
    gone = stored(found.where("doc_id <> class_id").select(F.col("doc_id").alias("_gone")), "gone")
    return docs.join(gone, F.coalesce(docs["doc_id"].cast("long"), F.lit(NO_ID)) == gone["_gone"], "left_anti")
