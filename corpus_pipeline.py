"""The corpus pipeline: stages applied one after the other, each written and read again."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationloom.llm.blocks import checkpoint_folder, checkpointed
from stationloom.llm.classifier import score_documents
from stationloom.llm.decontaminate import find_test_items
from stationloom.llm.lines import drop_repeated_lines
from stationloom.llm.neardup import class_labels
from stationloom.llm.packing import pack_documents
from stationloom.session import apply_settings

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _with_row(docs: DataFrame) -> DataFrame:
    """Documents with ``row``, 128 bits of id and text: never null, and one for each text under an id or without one."""
    text = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.coalesce("text", F.lit("")))
    return docs.select(*COLUMNS, F.unhex(F.md5(text)).alias("row"))


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """Documents whose ``row`` is not among those of ``gone``."""
    return docs.join(gone.select("row").distinct(), "row", "left_anti").select(*COLUMNS)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier keeps."""
    apply_settings(spark)
    scored = score_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), carry=("text", "lang", "source", "n_chars"))
    return scored.filter("keep").select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that others hold; the number of characters follows the text."""
    apply_settings(spark)
    done = drop_repeated_lines(docs, carry=("lang", "source"))
    return done.select("doc_id", F.col("kept").alias("text"), "lang", "source", F.length("kept").cast("long").alias("n_chars"))


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class: that of the least id, an id before none, and the least ``row`` of several texts under it.

    Rows with the same id and text count as one, the least by the other columns. Rows without words all stay.
    """
    apply_settings(spark)
    docs = _with_row(docs)
    named = class_labels(docs, carry=("row",)).filter(F.col("label").isNotNull())
    rows = checkpointed(named.groupBy("label", "doc_id", "row").agg(F.count("*").alias("n")))
    first = rows.groupBy("label").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row"))["row"].alias("row")).select("row")
    gone = rows.join(first, "row", "left_anti").select("row")
    repeated = rows.filter("n > 1").join(first, "row", "left_semi").select("row")
    # grouped by another form of the row, so that copies are combined before they meet in one task
    one = (docs.join(repeated, "row", "left_semi").groupBy(F.hex("row").alias("at"))
           .agg(F.min(F.struct(*COLUMNS)).alias("one")).select("one.*"))
    return _without(docs, gone.union(repeated)).union(one)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows in whose text no test item was found, whatever their ids."""
    apply_settings(spark)
    docs = _with_row(docs)
    return _without(docs, find_test_items(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), carry=("row",)))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents and their places in sequences of 1024 tokens."""
    apply_settings(spark)
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup),
    ("minhash_near_dedup", minhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("best_fit_packing", best_fit_packing),
]
#: The classifier is fitted, so SQL cannot express the pipeline; tests hold its stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; tables between them lie in the shared folder."""
    folder = f"{checkpoint_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}-{name}")
        docs = spark.read.parquet(f"{folder}/{k}-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
