"""Registered queries against their SQL, and the pipeline against plain Python."""

from __future__ import annotations

import os

import brute
import duckdb
import pytest

import corpus_pipeline
from framestore.llm import ORACLES, QUERIES
from framestore.llm.secrets import redacted, secret_spans


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    con = duckdb.connect()
    for view in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {view} AS SELECT * FROM '{os.path.join(sf_dir, view)}.parquet'")
    result = con.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(df.columns)
    assert sorted(map(tuple, df.select(*names).collect()), key=repr) == sorted(result.fetchall(), key=repr)


def test_pipeline(spark, sf_dir, tmp_path):
    """Stage by stage on 60 documents, a null and an empty one."""
    rows = sorted(map(tuple, spark.read.parquet(f"{sf_dir}/documents.parquet").collect()))
    rows = rows[:60] + [(70001, None, "en", "s", 0), (70002, "", "en", None, 0), (70003, rows[2][1] + " token=abcdefgh", "en", "s", 1)]
    schema = spark.read.parquet(f"{sf_dir}/documents.parquet").schema
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()

    kept = [r for r in rows if brute.quality(r[1])[-1]]
    texts = [(r[0], t) for r, t in zip(kept, brute.line_dedup([(r[0], r[1]) for r in kept])) if brute.WORD.search(t)]
    groups = brute.jaccard([t for _, t in texts])
    texts = [x for k, (x, (_, root)) in enumerate(zip(texts, groups)) if k == root]
    texts = [(i, redacted(t, secret_spans(t), "[SECRET]")) for i, t in texts]
    assert sorted(tuple(r[:5]) for r in got) == sorted(brute.token_pieces(texts))
    assert 20 < len(texts) < len(rows)


def test_stages_keep_the_columns(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, empty, sf_dir)
        assert out.columns == docs.columns and out.count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, empty, sf_dir).count() == 0
