"""op7: secrets of the documents table through a blob ledger."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestar.llm import secrets
from lodestar.llm.common import read_table
from lodestar.llm.registry import query
from lodestar.session import scratch_path


@query("op7_secret_scan")
def op7_secret_scan(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    ledger = scratch_path(spark, "secret-ledger")
    secrets.scan(docs, ledger)
    f = F.col("findings")

    def count(kind):
        return F.size(F.filter(f, lambda x: x["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    base = [r.kind for r in secrets.BASE_RULES]
    return secrets.findings_by_path(docs, ledger).select(
        "doc_id", *[count(k) for k in base],
        F.sha2(secrets.spans_text(f, base), 256).alias("base_sha256"), secrets.spans_text(f).alias("spans"))
