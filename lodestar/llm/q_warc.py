"""op10: WARC archive of the pages table."""

from __future__ import annotations

from lodestar.llm import warc_store
from lodestar.llm.common import read_table
from lodestar.llm.registry import query
from lodestar.session import scratch_path


# SHA-1 in base32 has no DuckDB spelling short of bit arithmetic on hex digits, which SQL can do.
_B32 = ("list_aggregate(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST("
        "('0x' || lpad(substr(h, CAST(1 + (i // 8) * 10 AS INT), 10), 16, '0'))::BIGINT "
        ">> (35 - 5 * (i % 8)) & 31 AS INT), 1)), 'string_agg', '')")


@query("op10_warc_archive", f"""
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, coalesce(html, '') AS body,
  sha1(coalesce(html, '')) AS h FROM pages),
m AS (SELECT *, max(page_id) OVER (PARTITION BY body) AS last_id FROM p)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, {_B32} AS payload_digest,
  CASE WHEN last_id IS NULL OR page_id IS NOT DISTINCT FROM last_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM last_id THEN last_id END AS refers_to
FROM m
""")
def op10_warc_archive(spark, sf_dir):
    path = scratch_path(spark, "warc")
    warc_store.write_archive(read_table(spark, sf_dir, "pages"), path)
    return warc_store.read_archive(spark, path).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
