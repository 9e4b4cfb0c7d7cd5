"""Lexical search, personal data and phrases against plain versions on awkward and on given documents."""

import hashlib
import itertools
import math
import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from saleslens.llm import collocations, lexical_search, pii_spans
from tests.llm import brute
from tests.llm.conftest import SMALL, awkward, frame

PARTS = re.compile(r"[.,;:!?\x0A-\x0D]")
BLANKS = re.compile(r"[^\x20\x09]+")


# 11


def plain_search(docs, items, k=10):
    held = [(i, Counter(words), len(words)) for i, t in docs if (words := brute.words_of_search(t))]
    total = sum(n for _, _, n in held)
    df = Counter(term for _, counts, _ in held for term in counts)
    asked = defaultdict(Counter)
    for name, text in set(items):
        asked[name].update(brute.words_of_search(text))
    out = set()
    for name, terms in asked.items():
        scored = []
        for doc_id, counts, n in held:
            m = 25 + 75 * n * len(held) // total
            score = sum(
                times * math.floor(1000 * math.log((2 * len(held) + 2) / (2 * df[t] + 1))) * (10**9 * counts[t] // (1000 * counts[t] + 8 * m))
                for t, times in terms.items()
                if t in counts
            )
            if score > 0:
                scored.append((-score, doc_id))
        out |= {(name, rank, doc_id, -score) for rank, (score, doc_id) in enumerate(sorted(scored)[:k], 1)}
    return out


def rows_of(result):
    return {(r.item_id, r["rank"], r.doc_id, r.score) for r in result.collect()}


ITEMS = [
    (1, "alpha7 gamma3 DELTA5"), (2, "A line that many documents hold"), (3, None), (4, ""), (5, "nowhere"), (1, "zeta9 zeta9"),
    (6, "漢字1 Béta44"), (6, "漢字1 Béta44"), (None, "omega1 x2 éps7"), (7, "7 12 b"),
]


@pytest.mark.parametrize("width,block", [(1024, 1024), (2, 2)])
def test_search(spark, width, block):
    items = spark.createDataFrame([(i, t, 1) for i, t in ITEMS], "item_id long, text string, rank int")
    docs = awkward()
    found = lexical_search.search(frame(spark, docs), items, width=width, block_items=block)
    wanted = plain_search(docs, [(i, t or "") for i, t in ITEMS])
    assert rows_of(found) == wanted
    assert found.columns == ["item_id", "rank", "doc_id", "score"]


def test_search_with_ties_repeats_and_null_ids(spark):
    docs = [(i, "one two") for i in (5, 3, 3, None)] + [(i, "two three") for i in range(20, 40)]
    items = spark.createDataFrame([(1, "two"), (2, "one")], "item_id long, text string")
    found = sorted(lexical_search.search(frame(spark, docs, 5), items).collect())
    assert [(r["rank"], r.doc_id) for r in found if r.item_id == 2] == [(1, None), (2, 3), (3, 3), (4, 5)]
    assert [r.doc_id for r in found if r.item_id == 1] == [None, 3, 3, 5, *range(20, 26)]


def test_search_empty_tables(spark):
    items = spark.createDataFrame([(1, "two")], "item_id long, text string")
    for docs, asked in (([], items), ([(1, "two")], items.where("false")), ([(1, None), (2, "..")], items)):
        assert lexical_search.search(frame(spark, docs), asked).collect() == []


def test_bounds_hold_and_spare_work():
    draw = random.Random(3)
    words = [f"w{i}" for i in range(400)]
    texts = [" ".join(draw.choices(words, [1 / (i + 1) for i in range(400)], k=draw.randint(5, 60))).encode() for _ in range(600)]
    block = lexical_search.Block([("q", [b"w3 w17 w200 w250 w399"])])
    terms = lexical_search.terms_of(texts)
    number = block.numbers(terms.words)
    _, held, _ = lexical_search._frequencies(terms, number >= 0)
    df = np.bincount(number[held], minlength=5)
    run = lexical_search.Search(block, df, 600, int(np.diff(terms.firsts).sum()), 10, 256)
    run.add(np.arange(600), terms)
    wanted = plain_search([(i, t.decode()) for i, t in enumerate(texts)], [("q", "w3 w17 w200 w250 w399")])
    assert {("q", i + 1, int(d), int(s)) for i, (d, s) in enumerate(zip(run.best[0].ids, run.best[0].scores, strict=True))} == wanted
    assert run.rescored < 300


# 12


def plain_spans(text):
    found = []
    kinds = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }
    for order, (kind, pattern) in enumerate(kinds.items()):
        for match in re.finditer(pattern, text or ""):
            digits = [int(c) for c in match.group() if c.isdigit()]
            doubled = [sum(divmod(2 * d, 10)) if i % 2 else d for i, d in enumerate(digits[::-1])]
            if kind == "ip" and any(int(p) > 255 for p in match.group().split(".")):
                continue
            if kind == "card" and (not 14 <= len(digits) <= 19 or sum(doubled) % 10):
                continue
            if kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            found.append((match.start(), order, f"{kind}:{match.start()}:{match.end()}"))
    return [s for _, _, s in sorted(found)]


PERSONAL = [
    "é mail a.b@c-d.e.fr, x@y@z.org and @none.com a@b.c@d.e ünï@host.de",
    "1.2.3.4 256.1.1.1 1.2.3.4.5.6.7.8 1.2.3 0001.02.3.255",
    "4111 1111 1111 1111 4111-1111-1111-1112 4111111111111111 12 4111111111111111",
    "漢字 +1 (499) 555-6503 and +49 30 1234567 +1 2 +1234567890123456 +4111111111111111",
    "+1 (499) 555-6503 10.0.0.1\n+1 (499) 555-6503\t7", "5500-0000-0000-0004", "\x00+1\x00", "1" * 500, "a@" * 200, "+" * 99,
]


def test_fixed_spans(spark, small):
    docs = small + [(1000 + i, t) for i, t in awkward() + list(enumerate(PERSONAL, 500))] + [(None, PERSONAL[0]), (1, PERSONAL[1])]
    rows = pii_spans.query(frame(spark, docs)).collect()
    wanted = Counter()
    for i, text in docs:
        spans = plain_spans(text)
        counts = Counter(s.split(":")[0] for s in spans)
        wanted[i, counts["email"], counts["ip"], counts["card"], counts["phone"], hashlib.sha256(",".join(spans).encode()).hexdigest()] += 1
    assert Counter((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in rows) == wanted
    texts = defaultdict(list)
    for i, text in docs:
        texts[i].append(set(plain_spans(text)))
    for r in rows:
        assert any(spans <= set(filter(None, r.spans.split(","))) for spans in texts[r.doc_id])


@pytest.fixture(scope="module")
def model():
    return pii_spans.train(pii_spans.examples(["wort", "the", "house", "mesa", "ciel"]))


def test_unseen_forms_are_found_and_look_alikes_left_alone(model):
    words = ["lampe", "river", "sur", "of", "campo", "und"]
    found = wanted = right = 0
    for text, spans in pii_spans.examples(words, 800, seed=99):
        marked = {(kind, len(text[:a].decode()), len(text[:b].decode())) for a, b, kind in spans}
        chosen = {(s["kind"], s["start"], s["end"]) for s in pii_spans.all_spans([text], model)[0]}
        found, wanted, right = found + len(chosen), wanted + len(marked), right + len(chosen & marked)
    assert right / wanted > 0.9 and right / found > 0.9


def test_written_forms(model):
    text = "call (499) 555-6503 or mail anna at house dot com, not 2024-05-17 12:30:45"
    spans = {(s["kind"], text[s["start"] : s["end"]]) for s in pii_spans.all_spans([text.encode()], model)[0]}
    assert spans == {("phone", "(499) 555-6503"), ("email", "anna at house dot com")}
    assert pii_spans.hidden("a b@c.de", [{"kind": "email", "start": 2, "end": 8}]) == "a <EMAIL>"


def cut_everywhere(segments, size, scores):
    """Every set of segments without overlap, with its score."""
    held = list(zip(segments.first, segments.last, strict=True))
    sets = [(0.0, [])]
    for s, (a, b) in sorted(enumerate(held), key=lambda x: x[1]):
        for k, score in enumerate(scores[s]):
            sets += [(v + score, [*c, (s, k)]) for v, c in sets if all(held[o][1] <= a or held[o][0] >= b for o, _ in c)]
    return sets


def test_dynamic_programs_equal_enumeration():
    raw = b"ab 12 34 567 @ c.d 1-2"
    atoms = pii_spans.atoms_of(raw, [(0, len(raw))])
    segments = pii_spans.segments_of(atoms)
    keep = np.linspace(0, len(segments.first) - 1, min(len(segments.first), 6)).astype(int)
    segments = pii_spans.Segments(segments.first[keep], segments.last[keep], segments.features[keep])
    draw = np.random.default_rng(5)
    model = pii_spans.Model(draw.normal(size=(segments.features.shape[1], 4)))
    scores = model.scores(segments)
    sets = cut_everywhere(segments, len(atoms.values), scores)
    chosen = model.decode(atoms, segments)
    assert np.isclose(sum(c[3] for c in chosen), max(v for v, _ in sets))
    chance, total = pii_spans.Chains(atoms, segments).marginals(scores)
    weight = np.exp([v for v, _ in sets])
    assert np.isclose(total[0], np.log(weight.sum()))
    for s, k in itertools.product(range(len(keep)), range(4)):
        own = sum(w for w, (_, c) in zip(weight, sets, strict=True) if (s, k) in c)
        assert np.isclose(chance[s, k], own / weight.sum())


def test_spans_of_other_columns_and_empty_tables(spark, model):
    docs = frame(spark, [(1, "mail a@b.cd"), (2, None)])
    assert pii_spans.query(docs.where("false")).collect() == []
    hidden = {r.doc_id: r for r in pii_spans.redact(docs, model=model).collect()}
    assert hidden[1].text == "mail <EMAIL>" and hidden[2].text is None and hidden[1].key == "k"
    spans = pii_spans.find_spans(docs, model=model)
    assert spans.columns == [*docs.columns, "spans"]


# 13


def plain_phrases(rows, least=10, top=2000):
    counts, total = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in PARTS.split((text or "").translate(brute.UPPER)):
            words = BLANKS.findall(piece)
            total[lang] += len(words)
            for k in (1, 2, 3):
                counts[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = set()
    for lang, found in counts.items():
        chosen = []
        for phrase, a in found.items():
            if len(phrase) < 2 or a < least:
                continue
            cuts = [(10**6 * a * a // (found[phrase[:k]] * found[phrase[k:]]), k) for k in range(1, len(phrase))]
            score, k = min(cuts)
            longer = [f for p, f in found.items() if len(p) == 3 and f >= least and len(phrase) == 2 and phrase in (p[:2], p[1:])]
            if not any(100 * f >= 50 * a for f in longer):
                chosen.append((-score, -a, " ".join(phrase).encode(), found[phrase[:k]], found[phrase[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(chosen)[:top], 1):
            out.add((lang, rank, phrase.decode(), -a, left, right, total[lang], -score))
    return out


def phrase_docs():
    draw = random.Random(4)
    words = ["a", "B", "çé", "漢字", "one", "two;", "x-y", "New", "york", "city.", "z\t", "q\x00"]
    rows = []
    for i in range(60):
        text = " ".join(draw.choices(words, [1 / (j + 1) for j in range(len(words))], k=draw.randint(0, 60)))
        rows.append((i % 50, text + " New york city", [None, "und", "en", "fr"][i % 4], 1, "k"))
    return [*rows, (None, None, "en", 1, "k"), (None, "", "it", 1, "k"), (3, "New York City " * 3000, "de", 1, "k"), rows[2], rows[2]]


@pytest.mark.parametrize("bounds", [{}, {"head": 4, "pair_head": 3, "filled": 5}, {"head": 0}, {"pair_head": 1, "filled": 1}])
def test_phrases(spark, bounds):
    rows = phrase_docs()
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, f long, phrase string").repartition(4)
    found = collocations.collocations(docs, **bounds)
    wanted = plain_phrases([(r[2], r[1]) for r in rows])
    assert len(wanted) > 20
    assert {tuple(r) for r in found.collect()} == wanted


def test_phrases_of_empty_tables(spark):
    assert collocations.query(frame(spark, [])).collect() == []
    assert collocations.query(frame(spark, [(1, None), (2, "once only")])).collect() == []


def test_only_the_first_of_a_language_are_reported(spark):
    rows = [(i, "a b. c d. e f. a b", lang) for i in range(10) for lang in ("en", "fr")]
    found = collocations.collocations(spark.createDataFrame(rows, "doc_id long, text string, lang string"), top=2)
    assert sorted((r.lang, r["rank"], r.phrase) for r in found.collect()) == [
        ("en", 1, "a b"), ("en", 2, "c d"), ("fr", 1, "a b"), ("fr", 2, "c d"),
    ]


def test_counts_beyond_64_bits(spark):
    rows = spark.createDataFrame([("en", "p q", 2, 10**13, 10**13, 2 * 10**13, None, None, None)],
                                 "lang string, phrase string, size int, a long, f1 long, f2 long, f3 long, f12 long, f23 long")
    assert collocations._scored(rows).first().score == 500000


def test_pair_hash_is_that_of_spark(spark):
    codes = np.array([0, 1, -5, 2**40 - 1, 123456789], np.int64)
    rows = spark.createDataFrame([(int(c),) for c in codes], "code long").selectExpr("xxhash64(code) AS h").collect()
    assert [r.h for r in rows] == collocations.hashed(codes).astype(np.int64).tolist()


def test_queries_equal_sql_without_spill():
    connection = duckdb.connect()
    for table in ("documents", "benchmark"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    docs = connection.execute("SELECT doc_id, text, lang FROM documents").fetchall()
    items = connection.execute("SELECT item_id, text FROM benchmark").fetchall()
    assert set(connection.execute(lexical_search.ORACLE_SQL).fetchall()) == plain_search([r[:2] for r in docs], items)
    assert set(connection.execute(collocations.ORACLE_SQL).fetchall()) == plain_phrases([(r[2], r[1]) for r in docs])
