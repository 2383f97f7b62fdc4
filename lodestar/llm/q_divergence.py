"""op13: how far the sources of each language differ in their words."""

from __future__ import annotations

from lodestar.llm import divergence
from lodestar.llm.common import read_table
from lodestar.llm.registry import query

_SHARE = "1 + (1000000000 * ({n} + 2)::HUGEINT) // ({t} + 2 * v)"


@query("op13_source_divergence", rf"""
WITH d AS (SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
tf AS (SELECT lang, source, term, count(*) AS n, count(DISTINCT k) AS df
       FROM (SELECT k, lang, source, unnest(w) AS term FROM d) GROUP BY ALL),
kept AS (SELECT lang, term, sum(n) AS all_n FROM tf GROUP BY ALL HAVING sum(df) >= 10),
l AS (SELECT lang, count(*) AS v, sum(all_n) AS lang_n FROM kept GROUP BY lang),
g AS (SELECT lang, source, coalesce(sum(n), 0) AS source_n
      FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN (SELECT * FROM tf SEMI JOIN kept USING (lang, term)) tf
      USING (lang, source) GROUP BY ALL),
s AS (SELECT g.lang, g.source, kept.term, coalesce(tf.n, 0) AS n,
        {_SHARE.format(n='coalesce(tf.n, 0)', t='source_n')} AS p, {_SHARE.format(n='all_n', t='lang_n')} AS q
      FROM g JOIN l USING (lang) JOIN kept USING (lang) LEFT JOIN tf
      ON tf.lang = g.lang AND tf.source = g.source AND tf.term = kept.term),
pair AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
         FROM s a JOIN s b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
          FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN pair ON pair.lang = a.lang AND pair.source = a.source AND pair.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // (p + q) AS value
          FROM s WHERE n > 0 AND p > q)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
      FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
WHERE part = 'pair' OR rank <= 10
""")
def op13_source_divergence(spark, sf_dir):
    return divergence.audit(read_table(spark, sf_dir, "documents"))
