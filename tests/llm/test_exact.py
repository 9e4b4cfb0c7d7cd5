"""Operators with exact results against brute force, on awkward and on given documents."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from saleslens.llm import (
    byte_bpe,
    decontamination,
    line_dedup,
    sharding,
    substring_dedup,
    token_files,
    top_k,
)
from tests.llm import brute
from tests.llm.conftest import awkward, frame

WORDS = public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module", params=["awkward", "small"])
def docs(request, small):
    return awkward() if request.param == "awkward" else small


def by_id(result, *columns):
    return {r.doc_id: tuple(r[c] for c in columns) for r in result.collect()}


# 1


def test_token_files(spark, docs, tmp_path):
    tokenizer = Tokenizer.from_file(WORDS)
    folder = token_files.write_token_files(frame(spark, docs), str(tmp_path / "t"), WORDS, block_ids=500)
    start, wanted = 0, {}
    for doc_id, text in sorted(docs):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        wanted[doc_id] = (start, len(ids), brute.ids_crc(ids))
        start += len(ids)
    found = token_files.read_documents(spark, folder)
    assert by_id(found, "start", "n_tokens", "ids_crc32") == wanted
    assert {r.bits for r in token_files.read_blocks(spark, folder).collect()} == {16}


def test_cache_of_words_has_a_bound_and_frequent_words_stay():
    tokenizer, words = Tokenizer.from_file(WORDS), token_files.WordEncoder(WORDS)
    for i in range(0, 600_000, 20_000):
        words.encode(["often " + " ".join(f"w{n}" for n in range(i, i + 20_000))])
        assert "often" in words.known
    assert len(words.known) + len(getattr(words, "older", {})) < 550_000
    texts = ["often w1 w599999", "a ~ b~c ^ | = _ ~^|=_", "~", "é\u0301 \u0301x <|endoftext|> ~", ""]
    wanted = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert [found.tolist() for found in words.encode(texts)] == wanted
    assert [found.tolist() for text in texts for found in words.encode([text])] == wanted


def test_words_are_encoded_as_the_tokenizer_does():
    """Odd white space, special tokens, punctuation between and behind letters, with words forgotten in between."""
    tokenizer, words = Tokenizer.from_file(WORDS), token_files.WordEncoder(WORDS)
    draw = random.Random(3)
    some = [*"aAbz09.,!?'$%-<|>~^_ \n\t\x0b\x1c\x1f\x85\xa0\u2003\u3000éÉßİıª²ʰ漢한🙂\u0301\u200d\x00", "<|endoftext|>", "<|STARTOFTEXT|>", "it's ", " Word, ", "..."]
    texts = ["", " ", " a "] + ["".join(draw.choice(some) for _ in range(draw.randint(0, 40))) for _ in range(3000)]
    for i in range(0, len(texts), 400):
        wanted = [e.ids for e in tokenizer.encode_batch_fast(texts[i : i + 400], add_special_tokens=False)]
        assert [found.tolist() for found in words.encode(texts[i : i + 400])] == wanted


def test_unknown_words_cost_no_normalizing():
    """Plain words that are runs of letters, with punctuation behind them or not, are cut at the ids that end a piece."""
    words = token_files.WordEncoder(WORDS)
    asked = []
    encode = words._encode
    words._encode = lambda texts, *tokenizer: asked.append((texts, *tokenizer)) or encode(texts, *tokenizer)
    (found,) = words.encode(["Unheard of, unheard of. words; unheard words;"])
    assert found.tolist() == Tokenizer.from_file(WORDS).encode("Unheard of, unheard of. words; unheard words;", add_special_tokens=False).ids
    assert all(tokenizer.normalizer is None for _, tokenizer in asked)
    assert sum(text.count("unheard") + text.count("words") + text.split().count("of") for texts, _ in asked for text in texts) == 3


def test_random_access(spark, tmp_path):
    folder = token_files.write_token_files(frame(spark, awkward()), str(tmp_path / "t"), WORDS, block_ids=64)
    blocks = token_files.read_blocks(spark, folder)
    shard = max(blocks.collect(), key=lambda r: r.first).shard
    rows = blocks.where(f"shard = {shard}").orderBy("first").collect()
    whole = np.concatenate([token_files.unpack(bytes(r.payload), r.bits, 0, r.n_ids) for r in rows])
    for a, b in ((0, 1), (60, 200), (63, 65), (0, len(whole))):
        assert token_files.read_range(blocks, shard, a, b).tolist() == whole[a:b].tolist()


@given(st.integers(1, 32), st.lists(st.integers(0, 2**32 - 1), max_size=50), st.data())
def test_packing(bits, ids, data):
    ids = np.array(ids, np.uint32) & np.uint32(2**bits - 1)
    packed = token_files.pack(ids, bits)
    assert len(packed) == -(-len(ids) * bits // 8)
    a = data.draw(st.integers(0, len(ids)))
    b = data.draw(st.integers(a, len(ids)))
    assert token_files.unpack(packed, bits, a, b).tolist() == ids[a:b].tolist()


@given(st.binary(max_size=40), st.binary(max_size=40))
def test_joined_crc(a, b):
    assert token_files.joined_crc(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)


def test_token_files_of_null_and_repeated_ids(spark, tmp_path):
    docs = frame(spark, [(None, "b"), (5, "x"), (5, "y"), (5, "x"), (1, None)])
    rows = token_files.read_documents(spark, token_files.write_token_files(docs, str(tmp_path / "t"), WORDS)).orderBy("start").collect()
    assert [r.doc_id for r in rows] == [None, 1, 5, 5, 5]
    assert [r.start for r in rows] == [0, 2, 3, 5, 7]


# 2


def test_lines(spark, docs):
    found = line_dedup.query(frame(spark, docs))
    wanted = {i: (n, d, brute.sha(t)) for i, (n, d, t) in brute.lines(docs).items()}
    assert by_id(found, "n_lines", "n_dropped", "kept_sha256") == wanted


def state(index):
    counts = sorted(tuple(r) for r in index.counts.select("k1", "k2", "n", "first").collect())
    return counts, sorted(tuple(r) for r in index.postings.collect())


def test_line_index_is_reversible(spark):
    docs = [d for d in awkward() if d[0] < 77]
    plain = [(i, t or "") for i, t in docs]
    one, two = (spark.createDataFrame(plain[k::2], "doc_id long, text string") for k in (0, 1))
    both = spark.createDataFrame(plain, "doc_id long, text string")
    empty = line_dedup.LineIndex.empty(spark, shards=3)
    first = empty.insert(one)
    second = first.insert(two)
    assert state(second) == state(empty.insert(both))
    assert state(second.delete(two)) == state(first)
    assert state(first.delete(one)) == ([], [])
    keys = np.array([r.k1 for r in second.counts.where("shard = 1").collect()])
    cells = second.filters.where("shard = 1").first().cells
    assert line_dedup.CuckooFilter(np.frombuffer(cells, np.uint16)).holds(keys).all()
    sizes = {r.shard: r.n_keys for r in second.delete(two).filters.collect()}
    assert sum(sizes.values()) == first.counts.count()


def test_cuckoo_filter():
    draw = np.random.default_rng(3)
    keys = draw.integers(0, 2**63, 20_000, dtype=np.uint64)
    made = line_dedup.built(keys[:10_000])
    assert made.holds(keys[:10_000]).all()
    assert made.holds(keys[10_000:]).mean() < 0.001
    made.delete(keys[:5_000])
    assert made.holds(keys[5_000:10_000]).all()
    assert made.holds(keys[:5_000]).mean() < 0.001
    assert made.insert(keys[:5_000]) and made.holds(keys[:10_000]).all()


def test_line_stage_keeps_columns(spark):
    docs = frame(spark, [(1, "a shared line here\nown"), (2, "A shared line HERE \nmine"), (None, None)])
    found = line_dedup.without_repeats(docs)
    assert found.columns == docs.columns and found.schema["n_chars"].dataType == docs.schema["n_chars"].dataType
    rows = {r.doc_id: r for r in found.collect()}
    assert rows[1].text == "a shared line here\nown" and rows[2].text == "mine"
    assert rows[2].n_chars == 4 and rows[None].text is None and rows[2].key == "k"


# 3


@pytest.mark.parametrize("size", [100, 40])
def test_substrings(spark, docs, size):
    found = substring_dedup.remove_repeats(frame(spark, docs), size)
    rows = {r.doc_id: (r.n_bytes, sum(x["size"] for x in r.removed), len(r.removed), bytes(r.kept)) for r in found.collect()}
    assert rows == brute.substrings(docs, size)


def test_substrings_avoid_crowded_anchors(spark, monkeypatch):
    docs = awkward(2)
    wanted = brute.substrings(docs, 50)
    plain = substring_dedup.with_digest(substring_dedup.documents_of(frame(spark, docs)))
    cut = substring_dedup._cut(plain, np.zeros(0, np.uint64), 50)
    keys = np.array([r.key for r in cut.where("not covered").select("key").distinct().limit(40).collect()], np.uint64)
    monkeypatch.setattr(substring_dedup, "_crowded", lambda docs, size: keys)
    rows = substring_dedup.remove_repeats(frame(spark, docs), 50).collect()
    assert {r.doc_id: bytes(r.kept) for r in rows} == {i: w[3] for i, w in wanted.items()}


@pytest.mark.parametrize("hot, most", [(1000, 2000), (20, 2000), (10**9, 30)])
def test_hot_passage_is_not_gathered(spark, monkeypatch, hot, most):
    """Edges of a passage that many documents hold differ; no comparison holds more than `most` segments of an anchor."""
    draw = random.Random(5)
    passage = "".join(draw.choice("abcdefgh ") for _ in range(160))
    docs = [(i, "".join(draw.choice("klmnopqr") for _ in range(90)) + passage + str(i % 7) * 60) for i in range(60)]
    monkeypatch.setattr(substring_dedup, "HOT", hot)
    monkeypatch.setattr(substring_dedup, "MOST", most)
    asked, parts = [], substring_dedup._compare

    def compare(rows, size):
        asked.append(rows.groupBy("key").count().agg({"count": "max"}).first()[0] or 0)
        return parts(rows, size)

    monkeypatch.setattr(substring_dedup, "_compare", compare)
    rows = substring_dedup.remove_repeats(frame(spark, docs), 50).collect()
    assert {r.doc_id: bytes(r.kept) for r in rows} == {i: w[3] for i, w in brute.substrings(docs, 50).items()}
    assert asked and max(asked) <= (30 if (hot, most) != (1000, 2000) else 2000)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text("ab", min_size=12, max_size=30), min_size=1, max_size=12), st.integers(4, 12))
def test_suffix_sort(texts, limit):
    data = np.frombuffer("".join(texts).encode() + b"a" * limit, np.uint8)
    raw = data.tobytes()
    starts = np.arange(len(raw) - limit)
    cut = len(starts) // 3
    sizes = np.array([s for s in (cut, len(starts) - cut) if s])
    firsts = np.cumsum(sizes) - sizes
    order = substring_dedup.Suffixes(data, limit).sort(starts, firsts, sizes)
    wanted = [i for f, n in zip(firsts, sizes, strict=True) for i in sorted(range(f, f + n), key=lambda i: raw[i : i + limit])]
    assert order.tolist() == wanted


def test_collisions_are_checked(monkeypatch):
    monkeypatch.setattr(substring_dedup, "slice_hashes", lambda sums, a, b, powers: np.zeros(len(a), np.uint64))
    segs = [b"abcdef", b"abcdeg", b"abcdef"]
    owner, place = substring_dedup.repeated_windows(segs, np.zeros(3, np.int64), np.full(3, 1), 5)
    assert sorted(zip(owner.tolist(), place.tolist(), strict=True)) == [(1, 0), (2, 0), (2, 1)]


def test_segments_with_one_equal_hash_differ(spark):
    """Segments that agree in anchor and first hash but not in the second are no repeats: their windows are compared."""
    one = np.ones(2, np.int64)
    assert substring_dedup._once(np.arange(2), np.arange(2), one, one, one, one, one, np.array([1, 2])).tolist() == [True, True]
    rows = [(1, 2, check, i, 0, 0, 120, 0, False) for i, check in enumerate([5, 5, 6])]
    found = substring_dedup._judged(spark.createDataFrame(rows, substring_dedup.SEGMENTS)).collect()
    assert {r.doc_id: r.covered for r in found} == {0: False, 1: True, 2: False}


def test_substrings_of_equal_rows_and_null_ids(spark):
    text = "".join(chr(97 + (i * i + i // 7) % 26) for i in range(150))
    rows = substring_dedup.query(frame(spark, [(3, text), (3, text), (4, text), (None, text)])).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_removed) for r in rows) == [(False, 3, 150), (False, 3, 150), (False, 4, 150), (True, 0, 0)]


@pytest.mark.parametrize("partitions", [1, 3, 7])
@pytest.mark.parametrize("hot, most", [(1000, 2000), (8, 3)])
def test_substrings_of_equal_rows_alone(spark, monkeypatch, partitions, hot, most):
    """Rows that repeat are one text: nothing starts earlier in it, so no copy of it is lost."""
    monkeypatch.setattr(substring_dedup, "HOT", hot)
    monkeypatch.setattr(substring_dedup, "MOST", most)
    draw = random.Random(2)
    a, b, c = ("".join(draw.choice("abcdefgh") for _ in range(500)) for _ in range(3))
    docs = [(1, a + c[:150]), (2, b), (3, c + a[:120]), (4, "x" * 30 + c[50:250] + a[:110])]
    docs += [(10 + i, f"{i:04d}" + a[200:330] + str(i % 5) * 40) for i in range(30)]
    wanted = brute.substrings(docs, 100)
    rows = substring_dedup.remove_repeats(frame(spark, docs * 3, partitions)).collect()
    assert len(rows) == 3 * len(docs)
    assert {(r.doc_id, bytes(r.kept)) for r in rows} == {(i, w[3]) for i, w in wanted.items()}


def test_substrings_of_many_texts_with_null_ids(spark):
    """Texts under one id are told apart, and ordered by their 64-bit hash."""
    draw = random.Random(8)
    shared = "".join(draw.choice("abcdefgh ") for _ in range(120))
    texts = [f"{i:05d}" + "".join(draw.choice("klmnopqr") for _ in range(draw.randint(0, 200))) + shared * (i % 2) for i in range(4000)]
    rows = substring_dedup.remove_repeats(frame(spark, [(None, t) for t in texts])).collect()
    by_hash = sorted(texts, key=lambda t: np.uint64(xxhash.xxh64_intdigest(t, seed=42)).astype(np.int64))
    wanted = brute.substrings(list(enumerate(by_hash)), 100)
    assert sorted(bytes(r.kept) for r in rows) == sorted(w[3] for w in wanted.values())



# 4


def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.ranks_of(RANKS).ranks, special_tokens={})


def test_byte_bpe(spark, docs):
    encoding = library()
    found = byte_bpe.query(frame(spark, docs), RANKS)
    wanted = {}
    for doc_id, text in docs:
        ids = np.array(encoding.encode_ordinary(text or ""), "<u4")
        wanted[doc_id] = (len(ids), brute.sha(ids.tobytes()), brute.sha(text or ""))
    assert by_id(found, "n_tokens", "ids_sha256", "decoded_sha256") == wanted


PARTS = ["a", "s", "re", "'", "'s", "'ll", " ", "  ", "\n", "\t", "1", "é", "漢", "!", "　", "\x1c", "\x85", "́", "٣", "😀"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.sampled_from(PARTS), st.characters(codec="utf-8")), max_size=40).map("".join))
def test_pieces(text):
    ids = byte_bpe.ranks_of(RANKS).encode(["x", text, "y"])
    assert np.frombuffer(ids[1], "<u4").tolist() == library().encode_ordinary(text)
    assert byte_bpe.ranks_of(RANKS).decode(np.frombuffer(ids[1], "<u4").astype(np.int64)) == text.encode()


@pytest.mark.parametrize("piece", ["a" * 5000, "ab" * 700, "!" * 200, "é漢" * 90])
def test_long_pieces(piece):
    assert byte_bpe.ranks_of(RANKS).merge(piece.encode()) == library().encode_ordinary(piece)


# 5


def shard_of(key: int, shards: int) -> int:
    """The shard of the highest -1 / ln(u), that is of the largest u, drawn as Spark's xxhash64 does."""

    def draw(shard):
        seed = xxhash.xxh64_intdigest(shard.to_bytes(4, "little", signed=True), 42)
        return xxhash.xxh64_intdigest(key.to_bytes(8, "little", signed=True), seed) >> 11

    return max(range(shards), key=draw)


def test_sharding(spark, docs):
    rows = sharding.query(frame(spark, docs)).collect()
    texts = dict(docs)
    for r in rows:
        text = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law) == (len(text) + 8, zlib.crc32(text), "key")
        assert (r.shard, r.grown_shard) == (shard_of(r.doc_id, 24), shard_of(r.doc_id, 25))
        assert r.grown_shard in (r.shard, 24)
    for shard in {r.shard for r in rows}:
        slots = sorted(r.slot for r in rows if r.shard == shard)
        assert slots == list(range(len(slots)))


def test_sharding_follows_weights_and_moves_little(spark):
    rows = spark.range(20_000)
    cut = sharding.assign(rows, "id", [1, 2, 1])
    share = {r.shard: r["count"] / 20_000 for r in cut.groupBy("shard").count().collect()}
    assert abs(share[1] - 0.5) < 0.02 and abs(share[0] - 0.25) < 0.02
    heavier = sharding.assign(cut, "id", [1, 3, 1], into="now")
    moved = heavier.where("shard <> now")
    assert moved.where("now <> 1").count() == 0 and abs(moved.count() / 20_000 - 0.1) < 0.02
    shrunk = sharding.assign(cut, "id", [1, 2, 0], into="now")
    assert shrunk.where("shard <> 2 and shard <> now").count() == 0


def test_sharding_is_native_and_takes_nulls(spark):
    found = sharding.query(frame(spark, [(None, None), (None, ""), (4, "x"), (4, "x")]))
    assert "Python" not in found._jdf.queryExecution().executedPlan().toString()
    rows = found.collect()
    assert len(rows) == 4 and len({r.shard for r in rows if r.doc_id is None}) == 1


# 7

ITEMS = [(1, "alpha1 Béta2 gamma3"), (2, "one"), (3, None), (4, "..."), (5, "never seen words " * 5)]


@pytest.fixture(scope="module")
def items(docs):
    long = [t for _, t in docs if t and len(t) > 300][:3]
    return ITEMS + [(10 + i, t[50:250]) for i, t in enumerate(long)] + [(20, long[0][50:250])]


def test_hits(spark, docs, items):
    table = spark.createDataFrame(items, "item_id long, text string")
    found = decontamination.query(frame(spark, docs), table)
    assert by_id(found, "n_words", "n_hit", "n_items", "items_sha256") == brute.hits(docs, items)
    assert all(r.contaminated == (r.n_hit > 0) for r in found.collect())


def test_hits_in_several_blocks(spark, docs, items, monkeypatch):
    monkeypatch.setattr(decontamination, "BLOCK_ITEMS", 2)
    table = spark.createDataFrame(items, "item_id long, text string")
    found = decontamination.query(frame(spark, docs), table)
    assert by_id(found, "n_words", "n_hit", "n_items", "items_sha256") == brute.hits(docs, items)
    left = decontamination.drop_contaminated(frame(spark, docs), table)
    assert {r.doc_id for r in left.collect()} == {i for i, h in brute.hits(docs, items).items() if not h[1]}


def test_span_removal(spark):
    docs = frame(spark, [(1, "Keep THIS, a b c d and more"), (2, None), (3, "clean")])
    hits = decontamination.find_hits(docs, spark.createDataFrame([(1, "a, B; c d")], "item_id long, text string"))
    assert by_id(decontamination.remove_spans(hits), "text") == {1: ("Keep THIS,  and more",), 2: (None,), 3: ("clean",)}


# 10


def best(rows, queries, k=5):
    whole = [(i, [int(np.floor(256 * float(x))) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = set()
    for q, v in whole:
        if queries(q):
            scores = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in whole if i != q and len(w) == len(v))
            out |= {(q, rank, i, -s) for rank, (s, i) in enumerate(scores[:k], 1)}
    return out


@pytest.mark.parametrize("scale", [1, 1e6, 1e12])
def test_top_k(spark, scale, monkeypatch):
    monkeypatch.setattr(top_k, "QUERY_BLOCK", 3)
    draw = np.random.default_rng(5)
    rows = [(i, [float(x) for x in draw.normal(size=9) * scale]) for i in range(300)]
    rows += [(300 + i, rows[i][1]) for i in range(40)]
    rows += [(400, None), (401, [1.0, None]), (402, [float("nan")] * 9), (None, rows[0][1]), (500, [1.0, 2.0]), (550, [2.0, 1.0]), (600, [])]
    frame_ = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    if scale == 1e12:
        rows = [(i, v) for i, v in rows]
        found = {(r.query_id, r["rank"]): r.score for r in top_k.query(frame_).collect()}
        wanted = {(q, rank): min(s, 2**63 - 1) for q, rank, _, s in best(rows, lambda i: i % 50 == 0)}
        assert found == wanted
    else:
        assert {tuple(r) for r in top_k.query(frame_).collect()} == best(rows, lambda i: i % 50 == 0)


def test_empty_tables(spark):
    docs = frame(spark, [(1, "x")]).where("doc_id > 5")
    items = spark.createDataFrame([], "item_id long, text string")
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>")
    for found in (
        line_dedup.query(docs),
        substring_dedup.query(docs),
        byte_bpe.query(docs, RANKS),
        sharding.query(docs),
        token_files.query(spark, docs, WORDS),
        decontamination.query(docs, items),
        top_k.query(vectors),
    ):
        assert found.collect() == []
