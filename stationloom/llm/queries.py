"""One thin query per operator: it applies the operator to its whole table and derives digest columns."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .blocks import checkpoint_folder
from .idfiles import read_ids, write_ids
from .lines import drop_repeated_lines
from .tokens import count_tokens
from .packing import pack_documents
from .sql import ORACLES  # noqa: F401
from .neardup import near_duplicates
from .decontaminate import find_test_items
from .classifier import score_documents
from .chat import expand_conversations, masked_text, read_turns
from .credentials import count_kind, scan_secrets, write_spans
from .ranked import rank_documents
from .rules import apply_rules, fit_rules
from .substrings import remove_repeated_windows
from .whitening import whiten


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = remove_repeated_windows(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept"), 256).alias("kept_sha256"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = drop_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept"), 256).alias("kept_sha256"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op8_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_test_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"))
    made = expand_conversations(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(extra))
    last = F.col("example") == F.col("n_examples") - 1
    own = made.select("conv_id", "example", F.length("formatted").alias("size"), F.when(last, read_turns(F.col("formatted"))).alias("turns"),
                      masked_text(F.col("formatted"), F.col("loss_start"), F.col("loss_end")).alias("loss"))
    read = own.groupBy("conv_id").agg(F.sum("size").alias("formatted_chars"), F.first("turns", ignorenulls=True).alias("turns"),
                                      F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("example", "loss"))), lambda x: x["loss"]), "").alias("loss"))
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(whole, 256).alias("turns_sha256"),
                       F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")


def op6_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(table(spark, sf_dir, "documents"))
    return found.select("doc_id", *[count_kind(F.col("base"), k).alias(f"n_{k}") for k in ("assign", "access", "hex")],
                        F.sha2(write_spans(F.col("base")), 256).alias("base_sha256"), write_spans(F.col("spans")).alias("spans"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return apply_rules(docs, fit_rules(docs, table(spark, sf_dir, "labels")))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))


def op13_token_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{checkpoint_folder(spark)}/ids-{uuid.uuid4().hex}"
    write_ids(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), folder)
    return read_ids(spark, folder)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op7_substring_dedup": op7_substring_dedup,
    "op3_line_dedup": op3_line_dedup,
    "op4_token_counts": op4_token_counts,
    "op1_best_fit_packing": op1_best_fit_packing,
    "op8_minhash_near_dedup": op8_minhash_near_dedup,
    "op5_benchmark_decontamination": op5_benchmark_decontamination,
    "op10_quality_classifier": op10_quality_classifier,
    "op2_chat_formatting": op2_chat_formatting,
    "op6_secret_scans": op6_secret_scans,
    "op9_quality_rules": op9_quality_rules,
    "op11_ranked_search": op11_ranked_search,
    "op12_embedding_whitening": op12_embedding_whitening,
    "op13_token_id_files": op13_token_id_files,
}
