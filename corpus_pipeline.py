"""A corpus made ready for training: stages over ``documents``, each written and read again.

Every stage works on all rows that the one before kept. All but the last return the
columns of their input; the last one returns the index of the token files it writes.
"""

from __future__ import annotations

import public_tokenizers as tokenizers
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gondola.llm import decontaminate as wm
from gondola.llm import jaccard_join, mixing, repair, toxicity
from gondola.llm.frames import marked, read, stored
from gondola.session import fresh_path

TOKENIZER = "word_bpe_49k.json"


def _whole(docs: DataFrame) -> DataFrame:
    """Every row as one value beside its text: no result name can meet a column of the input."""
    return docs.select(F.struct(*docs.columns).alias("_row"), F.col("text").alias("_text"))


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go. It is fitted on all labelled rows of docs.

    Null and empty texts hold no evidence and stay, as does every row where the labels hold
    one class or none; repeated rows share their fate. No documents give no rows.
    """
    model = toxicity.fit(docs, read(spark, sf_dir, "labels"))
    rows = docs.select(F.struct(*docs.columns).alias("_row"))
    return toxicity.score(rows, model, text="_row.text", keep=["_row"],
                          clean_only=True).select("_row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, the one with the smallest id.

    Groups are connected by a Jaccard similarity of at least 0.8 on five-word shingles.
    Documents without words have no group and stay, as do rows without id. Rows of one id
    are one document: they stay or go together. No documents give no rows.
    """
    found = jaccard_join.jaccard_components(docs, n=5, num=80, den=100)
    copies = stored(found.filter("component_id < doc_id").select("doc_id").distinct(), "copies")
    near = marked(_whole(docs).withColumn("_id", F.col("_row.doc_id").cast("bigint")),
                  "_id", copies, "doc_id")
    away = near.filter("not _maybe").select("_row.*")  # the most, without a shuffle
    kept = near.filter("_maybe").join(copies, F.col("_id") == F.col("doc_id"), "left_anti")
    return away.unionByName(kept.select("_row.*"))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go.

    Null and empty texts are clean, repeated rows are judged alike, an empty benchmark
    leaves every row, and no documents give no rows.
    """
    clean = wm.decontaminate(_whole(docs), read(spark, sf_dir, "benchmark"), text="_text",
                             keep=["_row"], clean_only=True)
    return clean.select("_row.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of the mix: the files that are written follow it.

    A null source is a source of its own and a null id an id; texts are not looked at.
    Repeated rows of one id and source stay together. No documents give no rows.
    """
    return mixing.ordered(docs, mixing.mix(docs))


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files in the order of the mix, and from them what each document takes up.

    A null or empty text is an end mark alone; rows without id keep a null id, repeated
    rows are written again; no documents give no files and no rows.
    """
    order, named = ["_part", "_file", "_place"], docs.select("doc_id", "text")
    try:  # rows of files keep the place the mix gave them
        placed = docs.select("doc_id", "text",
                             F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1)
                             .cast("bigint").alias("_part"),
                             F.col("_metadata.file_name").alias("_file"),
                             F.col("_metadata.row_index").alias("_place"))
    except AnalysisException:  # rows that come from no file have no place but their id
        placed, order = named, ["doc_id"]
    path = fresh_path(spark, "pipeline-tokens")
    repair.write_shards(placed, path, tokenizers.path(TOKENIZER), order=order)
    return repair.read_shards(spark, path)


STAGES = [
    ("toxicity", toxicity_filter),
    ("near_duplicates", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("mix_sources", mix_sources),
    ("token_files", token_files),
]

# no SQL form: the toxicity model is fitted by iteration, the mix follows a schedule and
# the tokenizer is a library; the tests hold the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
