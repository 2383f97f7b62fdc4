"""op5: documents against the benchmark."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestar.llm import decontam
from lodestar.llm.common import read_table
from lodestar.llm.registry import query

_WORDS = (r"regexp_extract_all(translate(coalesce({t}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
          r"'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")


@query("op5_decontaminate", f"""
WITH b AS (SELECT item_id::VARCHAR AS item_id, {_WORDS.format(t='text')} AS w FROM benchmark),
bw AS (SELECT item_id, w, least(len(w), 10) AS n FROM b WHERE len(w) > 0),
g AS (SELECT DISTINCT item_id, n, array_to_string(w[i : i + n - 1], ' ') AS gram
      FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM bw)),
d AS (SELECT row_number() OVER () AS k, doc_id, {_WORDS.format(t='text')} AS w FROM documents),
ns AS (SELECT DISTINCT n FROM g),
dg AS (SELECT k, n, i, array_to_string(w[i : i + n - 1], ' ') AS gram
       FROM (SELECT k, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, ns WHERE len(w) >= n)),
hits AS (SELECT k, n, i, gram FROM dg SEMI JOIN (SELECT DISTINCT n, gram FROM g) USING (n, gram)),
nh AS (SELECT k, count(DISTINCT p) AS n_hit FROM (SELECT k, unnest(range(i, i + n)) AS p FROM hits) GROUP BY k),
it AS (SELECT k, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
       FROM (SELECT DISTINCT k, item_id FROM hits JOIN g USING (n, gram) WHERE item_id IS NOT NULL) GROUP BY k)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN nh USING (k) LEFT JOIN it USING (k)
""")
def op5_decontaminate(spark, sf_dir):
    per_doc, _ = decontam.scan(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return per_doc.select(
        F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))
