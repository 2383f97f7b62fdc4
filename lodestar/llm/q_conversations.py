"""op12: prefix trie of the conversations table, rebuilt on shared first turns."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from lodestar.llm import conversation_trie
from lodestar.llm.common import fold_of, read_table
from lodestar.llm.registry import query

#: A conversation c opens with turns of conversation c - c % FAMILY, fewer than HEADS.
FAMILY, HEADS = 20, 4


def rebuilt(conversations):
    """(conv_id, turns): the first turns of the family's first conversation, then those of its own after as many."""
    rows = conversation_trie.turns(conversations)
    family = F.col("conv_id") - F.col("conv_id") % FAMILY
    own = (rows.withColumn("family", family).repartition("family").groupBy("family", "conv_id")
           .agg(conversation_trie.in_order(F.collect_list(F.struct("turn", "digest", "words"))).alias("own")))
    first = F.when(F.col("conv_id") == F.col("family"), F.slice("own", 1, HEADS - 1))
    h = fold_of("conv_id", HEADS).cast("int")
    head = F.coalesce(F.max(first).over(Window.partitionBy("family")), F.slice("own", 1, 0))
    return own.withColumn("head", head).select(
        "conv_id", F.concat(F.slice("head", F.lit(1), h), F.slice("own", h + 1, F.greatest(
            F.size("own") - h, F.lit(0)))).alias("turns"))


@query("op12_conversation_trie", r"""
WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, conv_id - conv_id % 20 AS family, xor(list_reduce(
      list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ord(x)::BIGINT)),
      lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)),
                               lambda x, k: xor(x // 2, (x % 2) * 3988292384::BIGINT))), 4294967295::BIGINT) % 4 AS h
  FROM (SELECT DISTINCT conv_id FROM t)),
r AS (SELECT c.conv_id, 0 AS own, i, role, text FROM c JOIN t ON t.conv_id = c.family AND t.i <= c.h
  UNION ALL SELECT c.conv_id, 1 AS own, i, role, text FROM c JOIN t ON t.conv_id = c.conv_id AND t.i > c.h),
s AS (SELECT c.conv_id, coalesce(seq, []) AS seq FROM c LEFT JOIN (
  SELECT conv_id, list({'role': role, 'text': text} ORDER BY own, i) AS seq FROM r GROUP BY conv_id) USING (conv_id)),
p AS (SELECT conv_id, d, len(seq) AS n, sha256(to_json(seq[1 : d])::VARCHAR) AS k,
    CASE WHEN d > 0 THEN sha256(to_json(seq[1 : d - 1])::VARCHAR) END AS pk,
    CASE WHEN d > 0 THEN len(regexp_extract_all(seq[d].text, '[^\x20\x09-\x0D]+')) ELSE 0 END AS words
  FROM (SELECT conv_id, seq, unnest(range(0, len(seq) + 1)) AS d FROM s)),
n AS (SELECT d, k, any_value(pk) AS pk, min(conv_id) AS conv_id, count(*) AS n_convs,
    (count(*) - 1) * any_value(words) AS saved,
    coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (d = n), '') AS ends FROM p GROUP BY d, k),
kids AS (SELECT pk AS k, count(*) AS n_children FROM n GROUP BY pk),
m AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN kids USING (k)),
under AS (SELECT DISTINCT a.k AS top, b.k AS k FROM p a JOIN p b ON a.conv_id = b.conv_id AND b.d >= a.d),
sums AS (SELECT top AS k, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved) AS saved_tokens
  FROM under JOIN m USING (k) GROUP BY top)
SELECT m.conv_id, CAST(m.d AS BIGINT) AS depth, up.conv_id AS parent_conv_id, m.n_convs,
  CAST(m.n_children AS BIGINT) AS n_children, n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens,
  sha256(m.ends) AS ends_sha256
FROM m JOIN sums USING (k) LEFT JOIN n up ON up.k = m.pk
""")
def op12_conversation_trie(spark, sf_dir):
    nodes = conversation_trie.trie(rebuilt(read_table(spark, sf_dir, "conversations")))
    return nodes.select("conv_id", F.col("depth").cast("bigint").alias("depth"), "parent_conv_id", "n_convs",
                        "n_children", "n_leaves", "saved_tokens", "ends_sha256")
