"""The pipeline stage by stage against plain versions of the stages, and the registered queries."""

import random

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from saleslens.llm import byte_bpe, oracle_sql, queries
from tests.llm import brute
from tests.llm.conftest import SMALL, frame
from tests.oracle_check import difference

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def test_pipeline_equals_plain_stages(spark, small):
    items = duckdb.connect().execute(f"SELECT item_id, text FROM '{SMALL}/benchmark.parquet'").fetchall()
    rows = corpus_pipeline.run(spark, SMALL).collect()
    docs = [(i, t) for i, t in small if t and any(c.isalpha() for c in t)]
    lines = brute.lines(docs)
    docs = [(i, lines[i][2]) for i, _ in docs if lines[i][2].strip(" \t\n\x0b\x0c\r")]
    classes = brute.near_classes(docs)
    docs = [(i, t) for i, t in docs if classes[i] == i]
    hits = brute.hits(docs, items)
    docs = [(i, t) for i, t in docs if not hits[i][1]]
    assert {(r.doc_id, r.decoded_sha256) for r in rows} == {(i, brute.sha(t)) for i, t in docs}
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.ranks_of(RANKS).ranks, special_tokens={})
    texts = dict(docs)
    assert all(np.frombuffer(r.ids, "<u4").tolist() == own.encode_ordinary(texts[r.doc_id]) for r in rows)


def _written(spark, folder, rows):
    """Tables of a folder: some documents, and the benchmark of the smallest folder."""
    schema = spark.read.parquet(f"{SMALL}/documents.parquet").schema
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], schema)
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.read.parquet(f"{SMALL}/benchmark.parquet").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


def test_copies_near_copies_nulls_and_repeated_rows(spark, tmp_path):
    draw = random.Random(3)
    words = [w for (t,) in [("the house of many words and a river that runs to town",)] for w in t.split()]
    texts = [" ".join(draw.choice(words) + draw.choice("abcdefgh") for _ in range(80)) for _ in range(6)]
    near = texts[0].split()
    near[40] = "changed"
    lines = "\n".join(texts[4][i : i + 60] for i in range(0, 240, 60))
    rows = [(10 + i, t) for i, t in enumerate(texts)]
    rows += [(30, texts[0]), (31, " ".join(near)), (None, None), (None, ""), (32, None), (33, "--"), (34, lines), (35, lines), (12, texts[2])]
    left = corpus_pipeline.run(spark, _written(spark, tmp_path, rows)).collect()
    assert sorted(r.doc_id for r in left) == [10, 11, 12, 12, 13, 14, 15, 34]
    assert all(r.n_tokens > 0 for r in left)


def test_empty_tables_pass_all_stages(spark, tmp_path):
    result = corpus_pipeline.run(spark, _written(spark, tmp_path, []))
    assert result.collect() == [] and "ids" in result.columns


def test_copies_without_words_after_line_dedup_leave_one(spark):
    """Exact copies lose their long lines to the first one; what is left of them is equal and has no words."""
    docs = frame(spark, [(i, "a long line that all copies hold\n--\n**") for i in range(1, 7)])
    left = corpus_pipeline.near_dedup_stage(spark, corpus_pipeline.line_dedup_stage(spark, docs, SMALL), SMALL)
    assert sorted(r.doc_id for r in left.collect()) == [1, 2]


def test_stages_return_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SMALL).schema == docs.schema


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "embeddings", "benchmark"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    assert difference(queries()[name](spark, SMALL), connection, oracle_sql()[name]) is None


def test_one_query_for_each_operator():
    assert all(isinstance(sql, str) for sql in oracle_sql().values())
    assert sorted(int(name[2:].split("_")[0]) for name in queries()) == list(range(1, 14))
