"""Registered queries of the training-data operators, over whole tables.

``opN_<name>`` applies operator N with production parameters and derives the
columns of its contract; ``pipeline`` runs corpus_pipeline.py.
"""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.llm import (alignment, ann, bpe, conversations, licenses, line_dedup, mixing, ngram_join, quality, secret_scan, topk,
                          toxicity, warc)
from starmart.llm.common import arrow_rows, cut, fold, ship, table

VOCABULARY = "byte_bpe_50k.tiktoken"


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = bpe.round_trip(docs, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)
    return out.select("doc_id", F.expr("cast(octet_length(ids) div 4 as long)").alias("n_tokens"),
                      F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op2_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(topk.scaled(table(spark, sf_dir, "embeddings")), F.col("vec_id") % 100 == 0)


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return line_dedup.remove_boilerplate(docs).select("doc_id", "n_lines", "n_removed", "text")


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.resolved(warc.write(table(spark, sf_dir, "pages")))


def op5_line_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.train(docs, table(spark, sf_dir, "labels"), lambda c: fold(c, 3) != 1)
    out = quality.score(docs, model)
    return out.select("doc_id", F.coalesce(fold("doc_id", 3) == 1, F.lit(False)).alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op7_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(table(spark, sf_dir, "documents"))


def op8_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op9_pu_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), lambda c: fold(c, 4) != 2)
    out = toxicity.score(docs, model)
    return out.select("doc_id", F.coalesce(fold("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "score",
                      (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op10_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(ann.usable(table(spark, sf_dir, "embeddings")), F.col("vec_id") % 100 == 0)


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = alignment.align(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"),
                            public_tokenizers.PATTERN)
    found = found.select("doc_id", "n_a", "n_b", "n_groups", "n_links",
                         F.coalesce(F.sha2("groups", 256), F.lit("")).alias("groups_sha256"), "pairs", "times")
    with arrow_rows(spark, 512):
        found = cut(found, "token-alignment")
    return alignment.score_links(found)


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    repaired = conversations.repair(conversations.damage(rows)).drop("repaired").withColumnRenamed("conv_id", "_conv")
    every = rows.select("conv_id").distinct().join(repaired, F.col("conv_id").eqNullSafe(F.col("_conv")), "left")
    zeros = [F.coalesce(c, F.lit(0)).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return every.select("conv_id", *zeros, F.coalesce("audit", F.lit("")).alias("audit"),
                        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    kinds = F.transform("base", lambda s: s["kind"])
    n = [(F.size("base") - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k, *_ in secret_scan.BASE]
    return found.select("doc_id", *n, F.sha2(secret_scan.listed(F.col("base")), 256).alias("base_sha256"),
                        secret_scan.listed(F.concat("base", "random")).alias("spans"))


def _shipped(query: Callable) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)
    run.__name__, run.__doc__ = query.__name__, query.__doc__
    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}
    return {name: _shipped(f) for name, f in [*sorted(found.items()), ("pipeline", corpus_pipeline.run)]}


def oracle_sql() -> dict[str, str]:
    return {"op3_line_dedup": line_dedup.oracle_sql(), "op8_source_mix": mixing.oracle_sql()}
