"""op4: near-duplicate components of the documents table."""

from __future__ import annotations

from lodestar.llm import signature_tree
from lodestar.llm.common import read_table
from lodestar.llm.registry import query


@query("op4_ngram_jaccard_join")
def op4_ngram_jaccard_join(spark, sf_dir):
    per_doc, _ = signature_tree.join(read_table(spark, sf_dir, "documents"))
    return per_doc.select("doc_id", "n_shingles", "component_id")
