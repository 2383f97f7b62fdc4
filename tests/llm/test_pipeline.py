"""The pipeline against a brute-force version of its stages."""

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from lodestar.llm import byte_cnn, stages
from tests.conftest import SF_SMALL
from tests.llm.edge import CLASHES, PASSAGE, ROWS, documents, folder
from tests.llm.test_decontam_warc import brute as contaminated
from tests.llm.test_neardup import shingles
from tests.llm.test_neardup import brute as components
from tests.llm.test_secrets import brute as found


def redact(t):
    out, at = [], 0
    for s, _, _, e in found(t):
        if s >= at:
            out += [t[at:s], "[SECRET]"]
        at = max(at, e)
    return "".join(out) + t[at:]


def test_run_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    net = byte_cnn.fit(docs, F.lit(True))
    rows = {r["doc_id"]: r for r in docs.collect()}
    lang, score = net.predict([r["text"] for r in rows.values()])
    left = [i for i, a, s in zip(rows, lang, score) if a != "und" and s >= stages.MIN_LANGUAGE_SCORE]
    comp = components([(i, rows[i]["text"]) for i in left], *stages.NEAR[:2])
    left = [i for i in left if comp[i][1] == i]
    bench = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    hit = {x[0] for x in contaminated([(i, rows[i]["text"]) for i in left], bench) if x[5]}
    want = {i: redact(rows[i]["text"]) for i in left if i not in hit}
    got = {r["doc_id"]: r for r in corpus_pipeline.run(spark, SF_SMALL).collect()}
    assert set(got) == set(want) and len(want) > 100
    lib = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for i, t in want.items():
        ids = lib.encode(t, add_special_tokens=False).ids
        assert got[i]["text"] == t and got[i]["n_chars"] == len(t)
        assert np.frombuffer(got[i]["token_ids"], "<u4").tolist() == ids and got[i]["n_tokens"] == len(ids)
        assert got[i]["decoded"] == lib.decode(ids, skip_special_tokens=False)


def test_stages_on_awkward_rows(spark, tmp_path):
    d = folder(spark, tmp_path, benchmark=[(1, PASSAGE, "x")])
    docs = documents(spark)
    sizes = []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path / f"stage{k}")
        stage(spark, docs, d).write.parquet(path)
        new = spark.read.parquet(path)
        if name != "tokenize":
            assert new.columns == docs.columns
        docs = new
        sizes.append(docs.count())
    ids = sorted((r["doc_id"] for r in docs.collect()), key=str)
    assert sizes[0] == 11  # null, empty, blank, digits and symbols only are gone
    assert 0 not in ids and 5 not in ids and 9 not in ids and 8 in ids and None in ids
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert text[None] == "no id here, [SECRET]" and text[4] == dict((r[0], r[1]) for r in ROWS)[4]
    assert text[6] == "x" * 5000 and all(r[c] == c for r in docs.collect() for c in CLASHES)


def test_near_duplicates_keep_one_of_repeated_rows_and_all_empty(spark):
    rows = [(1, "a b c d e", None, None)] * 3 + [(2, None, None, None), (3, "", None, None), (3, "", None, None),
                                                 (None, "q r s t u", None, None)]
    out = stages.near_duplicates(spark, documents(spark, rows), "").collect()
    assert sorted((str(r["doc_id"]) for r in out)) == ["1", "2", "3", "3", "None"]
    assert shingles(None) == frozenset()


def test_near_duplicates_keep_unlinked_texts_with_null_or_shared_ids(spark):
    long = " ".join(f"w{k}" for k in range(60))
    rows = [(i, t, None, None) for i, t in [
        (None, "q r s t u"), (None, "one two three four five six"), (5, "a b c d e"), (5, "k l m n o p"),
        (7, long), (None, long + " x"), (None, "v " + long),  # linked: 7 stays
        (None, "y " + long.replace("w", "z")), (None, long.replace("w", "z")),  # linked, no id: one stays
        (5, "h " + long.replace("w", "u")), (4, long.replace("w", "u"))]]  # linked: 4 stays
    out = {(r["doc_id"], r["text"]) for r in stages.near_duplicates(spark, documents(spark, rows), "").collect()}
    keep = {r[:2] for r in rows}
    keep -= {(None, long + " x"), (None, "v " + long), (5, "h " + long.replace("w", "u"))}
    pair = {r[:2] for r in rows[7:9]}
    assert len(out & pair) == 1 and out - pair == keep - pair


def test_stages_on_an_empty_table(spark, tmp_path):
    d = folder(spark, tmp_path, [])
    docs = documents(spark, [])
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, d)
        assert docs.count() == 0


def test_entry_lists_all_queries():
    import __spark_entry__ as entry

    names = entry.queries()
    assert "pipeline" in names
    for n in range(1, 14):
        assert len([k for k in names if k.startswith(f"op{n}_")]) == 1
