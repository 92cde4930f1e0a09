"""Queries against their SQL, and the pipeline stage by stage against brute force."""

from __future__ import annotations

import duckdb
import numpy as np
import pytest
from compare import oracle_rows, rows_of, spark_rows

import corpus_pipeline
from fleetstate.llm import queries, simhash, toxicity

SF_DIR = "/root/testdata/sf0.001"


def test_every_operator_has_a_query():
    numbers = sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES if name.startswith("op"))
    assert numbers == list(range(1, 14)) and "pipeline" in queries.QUERIES
    assert set(queries.ORACLE) <= set(queries.QUERIES)


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_parity(spark, name):
    columns, rows = spark_rows(queries.QUERIES[name](spark, SF_DIR))
    expected_columns, expected = oracle_rows(queries.ORACLE[name], SF_DIR)
    assert columns == expected_columns
    assert rows == expected


def by_sql(spark, docs, sql, path):
    """SQL of a query over the documents of a stage."""
    docs.write.parquet(path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{path}/*.parquet')")
    con.execute(f"CREATE VIEW benchmark AS SELECT * FROM read_parquet('{SF_DIR}/benchmark.parquet')")
    result = con.execute(sql)
    return [d[0] for d in result.description], result.fetchall()


def test_pipeline_stage_by_stage(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, kept = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF_DIR)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == columns and out.dtypes == docs.dtypes
        out.write.parquet(str(tmp_path / name))
        kept.append((name, docs, spark.read.parquet(str(tmp_path / name))))
        docs = kept[-1][2]
    (_, before, calm), (_, _, lined), (_, _, single), (_, _, clean), (_, _, encoded) = kept

    scores = toxicity.toxicity_scores(before, toxicity.fit(before, spark.read.parquet(f"{SF_DIR}/labels.parquet")))
    assert {r.doc_id for r in calm.collect()} == {r.doc_id for r in scores.collect() if r.score < 0.5}

    names, rows = by_sql(spark, calm, queries.ORACLE["op5_line_dedup"], str(tmp_path / "sql5"))
    expected = {r[names.index("doc_id")]: r[names.index("text")] for r in rows}
    found = lined.collect()
    assert {r.doc_id: r.text for r in found} == expected
    assert all(r.n_chars == len(r.text or "") for r in found)

    prints = np.array([simhash.fingerprint_of(r.text, 4) for r in found], dtype=np.uint64)
    near = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 4
    label = np.array([r.doc_id for r in found])
    while True:
        new = np.where(near, label[None, :], label.max()).min(axis=1)
        if (new == label).all():
            break
        label = new
    assert sorted(r.doc_id for r in single.collect()) == sorted(set(label.tolist()))

    names, rows = by_sql(spark, single, queries.ORACLE["op2_benchmark_decontamination"], str(tmp_path / "sql2"))
    fair = {r[names.index("doc_id")] for r in rows if not r[names.index("contaminated")]}
    assert {r.doc_id for r in clean.collect()} == fair

    assert encoded.count() == clean.count() and encoded.filter("not lossless").isEmpty()


def test_pipeline_of_odd_rows(spark, tmp_path):
    """Null ids and texts, repeated rows, columns with names that the operators use themselves, and no rows at all."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, score string, row string, fp string, th string"
    rows = [(None, None), (1, None), (2, ""), (2, ""), (3, "same text here " * 30), (4, "same text here " * 30), (5, "x " * 30_000)]
    docs = spark.createDataFrame([(*r, "en", "s", 1, "a", "b", "c", "d") for r in rows], schema)
    empty = docs.limit(0)
    for source, label in ((docs, "docs"), (empty, "empty")):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, source, SF_DIR)
            assert name == "sentencepiece" or out.columns == docs.columns
            out.write.parquet(str(tmp_path / f"{label}-{name}"))
            source = spark.read.parquet(str(tmp_path / f"{label}-{name}"))
        assert source.count() == (3 if label == "docs" else 0)


def test_run(spark):
    columns, rows = rows_of(*(lambda df: (df.columns, [tuple(r) for r in df.collect()]))(corpus_pipeline.run(spark, SF_DIR)))
    assert columns == ["doc_id", "ids", "lossless", "n_pieces"] and rows
