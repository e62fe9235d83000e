"""Problem 3: export files whose fields drift."""

from __future__ import annotations

from millrace.operators import schema_drift
from millrace.plans.base import Plans
from millrace.session import table

P = Plans()
EXPORT = ("collection_name", "file_name", "file_no", "raw")
PAYLOAD = ["text", "content", "original_text", "modern_chinese_summary", "source", "chapter"]


@P.add("p3_found")
def p3_found(spark, d):
    return schema_drift.changes(table(spark, d, "rag_exports"), *EXPORT)


@P.add("p3_unified")
def p3_unified(spark, d):
    return schema_drift.unified(table(spark, d, "rag_exports"), *EXPORT, PAYLOAD, "line_no").withColumnRenamed("collection", "collection_name")
