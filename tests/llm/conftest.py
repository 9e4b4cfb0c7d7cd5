"""Small documents with the awkward cases, and the small tables."""

import random

import duckdb
import pytest

from saleslens.llm.shared import ready

SMALL = "/root/testdata/sf0.001"
DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long, first long, key string, n long"


@pytest.fixture(scope="session")
def spark(spark):
    ready(spark)
    return spark


@pytest.fixture(scope="session")
def small():
    """(doc_id, text) of the smallest table."""
    return duckdb.connect().execute(f"SELECT doc_id, text FROM '{SMALL}/documents.parquet' ORDER BY doc_id").fetchall()


def frame(spark, docs, partitions=3):
    """Documents with columns whose names clash with those the operators use inside."""
    rows = [(i, t, "en", "s", len(t or ""), 7, "k", 1) for i, t in docs]
    return spark.createDataFrame(rows, DOCUMENT).repartition(partitions)


def awkward(seed=1):
    """Nulls, empty texts, one long text, exact and near copies, shared and repeated passages, odd characters."""
    draw = random.Random(seed)
    some = ["alpha", "Béta", "gamma", "DELTA", "éps", "zeta", "漢字", "7", "it's", "we'll", "x", "omega"]

    def prose(n):
        return " ".join(draw.choice(some) + str(draw.randint(0, 99)) for _ in range(n))

    passage, line = prose(60), "A line that many documents hold, word for word"
    docs = [(i, prose(draw.randint(5, 80))) for i in range(30)]
    docs += [(30 + i, docs[i][1]) for i in range(5)]
    docs += [(40 + i, docs[10][1] + f" tail{i}") for i in range(8)]
    docs += [(50 + i, prose(10) + "\n" + passage + "\n" + prose(3)) for i in range(6)]
    docs += [(60 + i, f"{prose(4)}\n  {line.upper() if i % 2 else line}\t\n{line}\n{prose(2)}") for i in range(6)]
    docs += [(70, None), (71, ""), (72, "\n\n \n"), (73, "one"), (74, "a" * 400), (75, "ab " * 300), (76, "12 !! ... \x1c \x85 \x00")]
    docs += [(77, prose(3000) + "\n" + passage), (78, passage + " " + passage), (79, "\x1c".join(["a b", "c"]))]
    return docs
