"""Near duplicates, language and toxicity: brute force, known similarities and held-out accuracy."""

import random
from collections import Counter

import numpy as np
import pytest

from saleslens.llm import language, near_dedup, toxicity
from tests.llm import brute
from tests.llm.conftest import SMALL, awkward, frame

# 9


@pytest.mark.parametrize("which", ["awkward", "small"])
def test_near_classes(spark, small, which):
    docs = awkward() if which == "awkward" else small
    found = {r.doc_id: (r.class_id, r.kept) for r in near_dedup.query(frame(spark, docs)).collect()}
    wanted = brute.near_classes(docs)
    assert found == {i: (c, c == i) for i, c in wanted.items()}


def test_chains_and_astray_members(spark):
    """Texts that change word by word: only neighbours are similar, and buckets hold several classes."""
    draw = random.Random(4)
    words = [f"w{i}" for i in range(80)]
    docs = []
    for i in range(60):
        docs.append((i * 3 % 61, " ".join(words)))
        for _ in range(draw.choice([0, 1, 1, 2])):
            words[draw.randrange(80)] = f"n{draw.randrange(10**6)}"
    found = {r.doc_id: r.class_id for r in near_dedup.query(frame(spark, docs)).collect()}
    assert found == brute.near_classes(docs)


def test_signatures_estimate_similarity():
    draw = np.random.default_rng(2)
    agree, true = [], []
    for _ in range(60):
        shingles = draw.integers(0, 2**63, 40, dtype=np.uint64)
        one = draw.integers(1, 6, 40).astype(float)
        two = one + draw.integers(0, 4, 40) * (draw.random(40) < 0.4)
        owner = np.repeat([0, 1], 40)
        both = near_dedup.signatures(np.concatenate([shingles, shingles]), np.concatenate([one, two]), owner, 2, 96)
        agree.append((both[0] == both[1]).mean())
        true.append(np.minimum(one, two).sum() / np.maximum(one, two).sum())
    assert abs(np.mean(agree) - np.mean(true)) < 0.02


def test_signatures_do_not_depend_on_neighbours():
    draw = np.random.default_rng(6)
    shingles = [draw.integers(0, 2**63, n, dtype=np.uint64) for n in (1, 3, 5000)]
    together = near_dedup.signatures(np.concatenate(shingles), np.ones(5004), np.repeat([0, 1, 2], [1, 3, 5000]), 3, 96)
    for i, own in enumerate(shingles):
        alone = near_dedup.signatures(own, np.ones(len(own)), np.zeros(len(own), int), 1, 96)
        assert (alone[0] == together[i]).all()


def test_weighted_similarity():
    assert near_dedup.similarity([1, 1, 2], [1, 2, 2], weighted=True) == 2 / 4
    assert near_dedup.similarity([1, 1, 2], [1, 2, 2], weighted=False) == 1
    assert near_dedup.similarity([], [], weighted=False) == 0


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, j) for j in range(101, 130)] + [(7, 7)]
    found = near_dedup.components(spark.createDataFrame(links, "a long, b long"))
    wanted = {i: 0 for i in range(41)} | {j: 100 for j in range(100, 130)}
    assert {r.doc_id: r.root for r in found.collect()} == wanted


def test_components_without_broadcasts(spark, monkeypatch):
    """Ids with very many neighbours on both sides, and chains from one to the next."""
    monkeypatch.setattr(near_dedup, "BROADCAST_ROOTS", 0)
    links = [(5000, j) for j in range(1, 1500)] + [(5000, j) for j in range(6000, 7500)] + [(7000 + i, 9000 + i) for i in range(5)]
    links += [(20000 + i, 20001 + i) for i in range(9)] + [(20009, 20000), (30001, 30000), (30000, 30001)]
    found = near_dedup.components(spark.createDataFrame(links, "a long, b long"))
    ids = {i for link in links for i in link}
    assert {r.doc_id: r.root for r in found.collect()} == {i: 1 if i < 10000 else i // 10000 * 10000 for i in ids}


def test_stars_take_no_second_round(spark):
    links = spark.createDataFrame([(i % 7, i) for i in range(7, 200)], "a long, b long")
    spark.sparkContext.setJobGroup("stars", "components")
    try:
        found = near_dedup.components(links)
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("stars")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert {r.doc_id: r.root for r in found.collect()} == {i: i % 7 for i in range(200)}
    assert 0 < len(jobs) <= 5


@pytest.mark.parametrize("weighted", [False, True])
def test_outlines_bound_the_intersection(weighted):
    draw = np.random.default_rng(8)
    for n in (1, 40, 300, 3000):
        pool = draw.integers(0, 2**63, n, dtype=np.uint64)
        one, two = (draw.choice(pool, n) for _ in range(2))
        (size, bits, rest), (size2, bits2, rest2) = (near_dedup.outline(x, weighted) for x in (one, two))
        both = Counter(one.tolist()) & Counter(two.tolist())
        bound = min(rest, rest2) + int(np.bitwise_count((bits & bits2).view(np.uint64)).sum())
        assert len(bits) == near_dedup.OUTLINE * near_dedup.PLANES // 64
        assert (both.total() if weighted else len(both)) <= bound <= min(size, size2)


def test_stage_keeps_the_first_and_all_columns(spark):
    text = " ".join(f"w{i}" for i in range(40))
    docs = frame(spark, [(5, text), (3, text), (9, text + " more"), (11, "other words"), (None, None), (12, "")])
    found = near_dedup.keep_first(docs)
    assert found.columns == docs.columns
    assert {r.doc_id for r in found.collect()} == {3, 11, None, 12}


def test_equal_texts_without_words_are_one_class(spark):
    docs = frame(spark, [(5, "--\n**"), (3, "--\n**"), (7, "--\n* *"), (9, "?!"), (8, "?!"), (10, "one"), (None, None), (12, "")])
    found = {r.doc_id: r.class_id for r in near_dedup.query(docs).collect()}
    assert found == {5: 3, 3: 3, 7: 7, 9: 8, 8: 8, 10: 10, None: None, 12: 12}


# 8


def test_language_on_held_out_documents(spark):
    docs = spark.read.parquet(f"{SMALL.replace('0.001', '0.01')}/documents.parquet")
    found = language.query(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert np.mean([r.lang == r.lang_pred for r in found]) > 0.98
    assert all(0 <= r.score <= 1 for r in found)


def test_mixture_is_found():
    draw = np.random.default_rng(1)
    logs = np.full((100, 3), -30.0)
    kinds = np.array([0] * 70 + [1] * 30)
    logs[np.arange(100), kinds] = -5
    draw.shuffle(logs)
    shares = language.proportions(logs, np.array([0]), np.array([100]))
    assert np.allclose(shares[0], [0.7, 0.3, 0], atol=1e-6)


def test_language_edge_cases(spark):
    docs = frame(spark, [(None, "und so weiter"), (1, None), (1, ""), (2, "12 !?"), (3, "the words of it"), (4, "x" * 50_000)])
    rows = language.query(docs).collect()
    assert [r.lang_pred for r in rows if r.doc_id in (1, 2)] == ["und"] * 3
    assert all(r.lang_pred == "en" for r in rows if r.doc_id not in (1, 2))
    assert {r.doc_id for r in language.keep_identified(docs).collect()} == {None, 3, 4}
    nothing = language.query(docs.withColumn("lang", docs["lang"].substr(9, 9)).where("false")).collect()
    assert nothing == []


# 6


def test_toxicity_on_held_out_documents(spark):
    folder = SMALL.replace("0.001", "0.1")
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    rows = toxicity.query(docs, labels).join(labels, "doc_id").where("held_out").collect()
    toxic, ordinary = ([r.predicted for r in rows if r.toxic == kind] for kind in (1, 0))
    assert np.mean(toxic) > 0.5 and np.mean(ordinary) < 0.03 and all(0 <= r.score <= 1 for r in rows)


def test_toxicity_steps_equal_plain_ones():
    """Grams, parts, distances and features against plain counting, window by window."""
    draw = random.Random(9)
    plain = ["".join(draw.choices("abcdefgh", k=6)) for _ in range(300)]
    ordinary = [" ".join(draw.choices(plain, k=40)) for _ in range(60)]
    toxic = [" ".join(draw.choices([*plain, "zyxwvut", "qrstqrst"], [1] * 300 + [30, 30], k=40)) for _ in range(40)]
    padded = [[b" " + b" ".join(toxicity.words_in(x)) + b" " for x in part] for part in (toxic, ordinary)]

    def grams(text):
        return [text[i : i + toxicity.GRAM] for i in range(len(text) - toxicity.GRAM + 1)]

    often = [Counter(g for t in part for g in grams(t)) for part in padded]
    total = [sum(c.values()) for c in often]
    wanted = set()
    for gram, n in often[0].items():
        if sum(gram in t for t in padded[0]) < 4 or n / total[0] < toxicity.RATIO * (often[1][gram] + 3) / total[1]:
            continue
        places = [(" " * 6).encode() + t + (" " * 6).encode() for t in padded[0]]
        around = [{t[i + s : i + s + 6] for t in places for i in range(6, len(t) - 11) if t[i : i + 6] == gram} for s in (-6, 6)]
        if max(map(len, around)) >= 4:
            wanted.add(gram)
    found = toxicity.telling_grams(*padded)
    assert {int(g).to_bytes(8, "little")[: toxicity.GRAM] for g in found} == wanted and b" zyxwv" in wanted

    samples = [w for x in toxic for w in toxicity.windows(x)]
    parts = []
    for w in samples:
        held = [any(w[j : j + 6] in wanted for j in range(max(0, i - 5), i + 1)) for i in range(len(w))]
        parts += [w[a:b] for a, b in _runs(held)]
    assert toxicity.telling_parts(samples, found) == parts

    model = toxicity.fit(toxic, ordinary, 0.4)
    text = " ".join([toxic[3], ordinary[2], "zyxwvut"])
    saved = []
    for w in toxicity.windows(text):
        sizes = [len(toxicity._compressor(d + toxicity.CARRIER).compress(toxicity.CARRIER + w)) for d in (model.ordinary, model.ordinary + model.toxic)]
        saved.append(sizes[0] - sizes[1])
    compressors = toxicity._compressors(model.ordinary, model.toxic)
    assert toxicity.distances(compressors, text).tolist() == saved
    count = [sum(x >= least for x in saved) for least in range(1, 9)]
    rest = [np.log(len(saved)), max(saved), sum(saved) / len(saved), 1]
    assert np.allclose(toxicity.features(compressors, text), [*np.log1p(count), *(n / len(saved) for n in count), *rest])
    assert model.score(toxic[0]) > 0.5 > model.score(ordinary[0])


def _runs(held):
    edges = [i for i in range(len(held) + 1) if (i < len(held) and held[i]) != (i > 0 and held[i - 1])]
    return list(zip(edges[::2], edges[1::2], strict=True))


def test_toxicity_edge_cases(spark):
    docs = frame(spark, [(None, "a"), (1, None), (1, ""), (2, "word " * 30_000)])
    labels = spark.createDataFrame([(1, None), (None, 1), (2, 0)], "doc_id long, toxic int")
    rows = toxicity.query(docs, labels).collect()
    assert len(rows) == 4 and {r.score for r in rows} == {0.0}
    assert toxicity.query(docs.where("false"), labels).collect() == []
    model = toxicity.fit(["bad awful text"] * 3, ["fine text here"] * 3, 0.5)
    assert 0 <= model.score("") <= 1
