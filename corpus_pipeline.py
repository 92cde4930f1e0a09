"""A training corpus from raw documents: five stages, each an operator of fleetstate.llm over all that the last one kept.

`STAGES` lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame. All but the last return
the columns of `docs`. `run` writes each stage's result as Parquet to the shared folder and reads it again. Nulls, empty
and long texts, repeated rows, empty tables and further columns are handled as the operators' docstrings say; in short:
a document without text passes the filters and shares one SimHash group with all others without words.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetstate.llm import decontaminate, linededup, pieces, simhash, toxicity
from fleetstate.llm.common import table
from fleetstate.session import delete_path, shared_base


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is under one half. The model learns from the labelled rows of `docs`."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.drop_toxic(docs, model)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the runs of lines that stood before; n_chars, if there, is that of the new text."""
    clean = linededup.dedup_lines(docs, report="_report").drop("_report")
    if "n_chars" not in docs.columns:
        return clean
    size = F.coalesce(F.length("text"), F.lit(0)).cast(docs.schema["n_chars"].dataType)
    return clean.withColumn("n_chars", size).select(*[F.col(f"`{c}`") for c in docs.columns])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose fingerprints link within 4 bits: the one with the least id."""
    return simhash.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window of words with a benchmark item."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def to_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, ids, n_pieces, lossless): sampled pieces of each text."""
    return pieces.encode(docs.select("doc_id", "text"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("simhash_near_dedup", drop_near_copies),
    ("benchmark_decontamination", drop_contaminated),
    ("sentencepiece", to_pieces),
]

#: SQL cannot express the learned scores of the first stage nor the sampling of the last.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents of `sf_dir`. Their results are written to the session's shared folder; all but the last,
    which is returned, go once the next is written."""
    conf = spark.conf
    base = conf.get("spark.checkpoint.dir", None) or shared_base(spark.sparkContext.master, None, None, conf.get("spark.sql.warehouse.dir"))
    folder = f"{base.rstrip('/')}/corpus-{uuid.uuid4().hex}"
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if before:
            delete_path(spark, f"{folder}/{before}")
        before = name
    return docs
