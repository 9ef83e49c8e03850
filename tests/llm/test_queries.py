"""The registered queries and the pipeline."""

from __future__ import annotations

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2] / "tools"))

import __spark_entry__ as entry  # noqa: E402
from check_oracle import compare  # noqa: E402
from conftest import SF_SMALL  # noqa: E402

import corpus_pipeline  # noqa: E402
from stratum.llm import queries  # noqa: E402

COLUMNS = {
    "op1": {"doc_id": "bigint", "size": "bigint", "text_crc32": "bigint", "law": "string", "shard": "int", "slot": "bigint", "grown_shard": "int"},
    "op2": {"doc_id": "bigint", "start": "bigint", "length": "bigint", "ids_crc32": "bigint", "doc_tokens": "bigint", "sequence_id": "bigint", "offset": "bigint"},
    "op5": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op6": {"doc_id": "bigint", "n_bytes": "bigint", "n_removed": "bigint", "n_spans": "bigint", "kept_sha256": "string"},
    "op7": {"doc_id": "bigint", "n_assign": "bigint", "n_access": "bigint", "n_hex": "bigint", "base_sha256": "string", "spans": "string"},
    "op8": {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint", "kept": "boolean"},
    "op9": {"page_id": "bigint", "url": "string", "text": "string", "n_chars": "bigint"},
    "op10": {"doc_id": "bigint", "start": "bigint", "n_tokens": "bigint", "ids_crc32": "bigint"},
    "op11": {"conv_id": "bigint", "depth": "bigint", "parent_conv_id": "bigint", "n_convs": "bigint", "n_children": "bigint", "n_leaves": "bigint", "saved_tokens": "bigint", "ends_sha256": "string"},
    "op12": {"doc_id": "bigint", "leaf": "string", "subroot": "string", "root": "string", "proof_sha256": "string", "folded_root": "string", "verified": "boolean"},
    "op13": {"doc_id": "bigint", "n_words": "bigint", "n_base": "bigint", "first_word": "bigint", "last_word": "bigint", "base_labels": "string", "labels": "string", "score": "double"},
}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings", "pages", "labels", "conversations"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_registered():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in entry.queries()
    assert set(queries.ORACLE_SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_oracle(spark, con, name):
    r = compare(spark, con, name, queries.QUERIES[name], queries.ORACLE_SQL[name], SF_SMALL)
    assert r["cols"] and r["count"] and r["values"], r


@pytest.mark.parametrize("name", sorted(n for n in queries.QUERIES if n.split("_")[0] in COLUMNS))
def test_columns_and_rows(spark, name):
    df = queries.QUERIES[name](spark, SF_SMALL)
    assert dict(df.dtypes) == COLUMNS[name.split("_")[0]]
    table = {"op9": "pages", "op11": "conversations"}.get(name.split("_")[0], "documents")
    n = spark.read.parquet(f"{SF_SMALL}/{table}.parquet").count()
    if name.startswith("op11"):
        assert 1 < df.count() <= n + 1
    else:
        assert df.count() == n if not name.startswith("op2") else df.count() >= n


@pytest.mark.parametrize("name", ["op1_jump_shards", "op4_multi_index_hashing", "op7_blob_ledger"])
def test_native_plans(spark, name):
    """No Python on the path of the native operators (and of the code search)."""
    plan = queries.QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not any(w in plan for w in ("Python", "Pandas", "ArrowEval", "MapInArrow"))


def test_pipeline(spark, tmp_dir):
    docs = before = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    counts = [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF_SMALL)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == before.columns
        out.write.parquet(f"{tmp_dir}/{name}")
        docs = spark.read.parquet(f"{tmp_dir}/{name}")
        counts.append(docs.select("doc_id").distinct().count())
    assert counts == sorted(counts, reverse=True) and counts[3] == counts[4] == counts[5] and counts[5] > 0.5 * counts[0]
    run = corpus_pipeline.run(spark, SF_SMALL)
    key = ["doc_id", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, run.select(*key).collect())) == sorted(map(tuple, docs.select(*key).collect()))


def test_pipeline_on_edge_rows(corpus, nothing, tmp_dir):
    spark = corpus.sparkSession
    for k, start in enumerate((corpus, nothing)):
        docs = start
        for name, stage in corpus_pipeline.STAGES:
            stage(spark, docs, SF_SMALL).write.parquet(f"{tmp_dir}/{k}-{name}")
            docs = spark.read.parquet(f"{tmp_dir}/{k}-{name}")
        assert (docs.count() > 0) == (k == 0)
