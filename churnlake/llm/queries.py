"""The operators of this subpackage bound to the given tables."""

from __future__ import annotations

import os
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlake.llm import chat, fingerprints, fmindex, itq, kdtree, manifest, mining, mixing, partenum, pieces, topk, toxicity, urls

Query = Callable[[SparkSession, str], DataFrame]

# Fixed values of the contracts.
TOP_K = 20
URL_RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]
SHARDS = 16
ANCHOR_EVERY = 50
LABELS = 10
# Folder of the public tokenizer files.
TOKENIZERS = os.environ.get("TOKENIZER_FILES", "/opt/tokenizers")
PIECE_MODEL = "piece_bpe_32k.model"
TOXIC_FROM = 0.3
CONTROL_TEXT = "</s>[INST] ok [/INST]"


def _table(spark: SparkSession, base: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{base}/{name}.parquet")


def op1_exact_top_k(spark: SparkSession, base: str) -> DataFrame:
    vectors = topk.whole_vectors(_table(spark, base, "embeddings"))
    return topk.top_k(vectors, F.col("vec_id") % 20 == 0, TOP_K)


def op2_chat_windows(spark: SparkSession, base: str) -> DataFrame:
    turns = _table(spark, base, "conversations").select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text"
    )
    extra = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, F.lit("user")).otherwise(F.lit("assistant")).alias("role"),
        F.lit(CONTROL_TEXT).alias("text"),
    )
    windows = chat.chat_windows(turns.union(extra))
    said = lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))
    each = chat.read_back(windows.select("conv_id", "window", "text", "repeated", "loss")).select(
        "conv_id",
        "window",
        F.size("turns").alias("n"),
        F.array_join(F.transform("turns", said), "").alias("turns"),
        F.array_join("learned", "").alias("learned"),
    )
    shown = windows.groupBy("conv_id").agg(
        F.sum(F.length("text")).cast("long").alias("formatted_chars"), F.count(F.lit(1)).alias("n_windows")
    )
    in_order = F.array_sort(F.collect_list(F.struct("window", "turns", "learned")))
    joined = each.groupBy("conv_id").agg(F.sum("n").cast("long").alias("n_turns"), in_order.alias("all"))
    turns_text, learned = F.array_join("all.turns", ""), F.array_join("all.learned", "")
    return joined.join(shown, "conv_id").select(
        "conv_id",
        "n_turns",
        F.sha2(turns_text, 256).alias("turns_sha256"),
        F.length(learned).cast("long").alias("loss_chars"),
        F.sha2(learned, 256).alias("loss_sha256"),
        "formatted_chars",
        "n_windows",
    )


def op3_url_verdicts(spark: SparkSession, base: str) -> DataFrame:
    # The rules' paths start with a slash; a rule is shown as host and path together.
    rules = spark.createDataFrame(URL_RULES, "action string, host string, path string")
    return urls.judge(_table(spark, base, "pages"), rules)


def op4_itq_near_groups(spark: SparkSession, base: str) -> DataFrame:
    return itq.near_groups(_table(spark, base, "embeddings"))


def op5_mix_words(spark: SparkSession, base: str) -> DataFrame:
    mixed = mixing.mix_words(_table(spark, base, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies")


def op6_string_kernel_toxicity(spark: SparkSession, base: str) -> DataFrame:
    docs = _table(spark, base, "documents").select("doc_id", "text")
    model = toxicity.learn(docs, _table(spark, base, "labels"))
    return toxicity.score_texts(docs, model, "score").select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"),
    )


def op7_jaccard_groups(spark: SparkSession, base: str) -> DataFrame:
    return partenum.jaccard_groups(_table(spark, base, "documents"))


def op8_fm_index_repeats(spark: SparkSession, base: str) -> DataFrame:
    return fmindex.repeat_digest(_table(spark, base, "documents"))


def op9_kd_shards(spark: SparkSession, base: str) -> DataFrame:
    return kdtree.kd_shards(_table(spark, base, "documents"), shards=SHARDS).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def piece_model(folder: str = TOKENIZERS) -> bytes:
    """The model file's content; it travels to the tasks with the function that uses it."""
    return (Path(folder) / PIECE_MODEL).read_bytes()


def op10_piece_encoding(spark: SparkSession, base: str) -> DataFrame:
    return pieces.encode_documents(_table(spark, base, "documents"), piece_model())


def op11_hard_negatives(spark: SparkSession, base: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % LABELS).otherwise(F.col("label"))
    rows = mining.labelled_vectors(_table(spark, base, "embeddings"), label)
    return mining.hard_negatives(rows, F.col("vec_id") % ANCHOR_EVERY == 0)


def op12_merkle_manifest(spark: SparkSession, base: str) -> DataFrame:
    return manifest.checked_manifest(_table(spark, base, "documents"))


def op13_merkle_fingerprints(spark: SparkSession, base: str) -> DataFrame:
    return fingerprints.edited_fingerprints(_table(spark, base, "documents"))


QUERIES: dict[str, Query] = {
    "op1_exact_top_k": op1_exact_top_k,
    "op2_chat_windows": op2_chat_windows,
    "op3_url_verdicts": op3_url_verdicts,
    "op4_itq_near_groups": op4_itq_near_groups,
    "op5_mix_words": op5_mix_words,
    "op6_string_kernel_toxicity": op6_string_kernel_toxicity,
    "op7_jaccard_groups": op7_jaccard_groups,
    "op8_fm_index_repeats": op8_fm_index_repeats,
    "op9_kd_shards": op9_kd_shards,
    "op10_piece_encoding": op10_piece_encoding,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_merkle_fingerprints": op13_merkle_fingerprints,
}
