"""The queries of the training-data problems, and their SQL where SQL can state them."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.llm import leaks, lookalike, neardup, pairs, sentences, syntax, tokenize, truncated
from millrace.session import table


def _p6_found(spark, d):
    p = neardup.similar_pairs(neardup.step_texts(table(spark, d, "translated_steps")), "step_id", "text")
    return p.select(F.col("id_a").alias("step_id_a"), F.col("id_b").alias("step_id_b"))


def _p6_groups(spark, d):
    g = neardup.groups(neardup.step_texts(table(spark, d, "translated_steps")), "step_id", "text")
    return g.withColumnRenamed("id", "step_id")


def _p8_found(spark, d):
    return leaks.leaks(table(spark, d, "documents"), "doc_id", "text", table(spark, d, "eval_items"), "item_id", "text", "lang")


def queries() -> dict:
    return {
        "p1_found": lambda s, d: sentences.sentences(table(s, d, "rag_points"), "point_id", ["original_text", "modern_chinese_summary"]).withColumnRenamed("id", "point_id"),
        "p2_found": lambda s, d: lookalike.same_look(
            table(s, d, "rag_points").select(F.col("point_id").alias("id"), "text"), table(s, d, "grounded_refs").select(F.col("ref_id").alias("id"), "text")
        ),
        "p2_canonical": lambda s, d: lookalike.canonical(table(s, d, "grounded_refs"), "ref_id", "text").withColumnRenamed("id", "ref_id"),
        "p5_found": lambda s, d: pairs.broken_pairs(table(s, d, "rag_points"), "point_id", "original_text", "summary_zh").withColumnRenamed("id", "point_id"),
        "p7_ids": lambda s, d: tokenize.token_ids(table(s, d, "documents"), "doc_id", "text").withColumnRenamed("id", "doc_id"),
        "p7_round_trip": lambda s, d: tokenize.round_trip(table(s, d, "documents"), "doc_id", "text", "source").withColumnRenamed("grp", "source"),
        "p8_found": _p8_found,
        "p8_items": lambda s, d: _p8_found(s, d).groupBy("item_id").agg(F.count("*").alias("documents")),
        "p9_found": lambda s, d: truncated.judged(table(s, d, "documents"), "doc_id", "text", "source").where("cut is not null").select(F.col("id").alias("doc_id")),
        "p9_rates": lambda s, d: truncated.rates(table(s, d, "documents"), "doc_id", "text", "source"),
        "p4_found": lambda s, d: syntax.invalid_steps(table(s, d, "translated_steps")),
        "p4_errors": lambda s, d: syntax.error_table(table(s, d, "translated_steps")),
        "p4_rates": lambda s, d: syntax.rates(table(s, d, "translated_steps")),
        "p6_found": _p6_found,
        "p6_groups": _p6_groups,
    }


def oracle_sql() -> dict:
    return {}
