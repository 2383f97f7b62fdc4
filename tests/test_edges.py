"""Edge rows of SURVEY §5: partition invariance of whole queries, zero vectors,
tied scores, per-epoch reshuffle, over-long text, oversized groups."""

import pytest
from pyspark.sql import functions as F

from lodestar.functions import arrays as AR
from lodestar.functions import vectors as V
from lodestar.operators import contrastive as C
from lodestar.operators.order import batch_epochs, with_positions
from lodestar.plans.registry import load_all
from tests.conftest import SF_SMALL

QUERIES, _ = load_all()


@pytest.mark.parametrize("key", ["loss_ntxent", "shuffle_global", "aug_dispatch", "eval_ndcg",
                                 "metrics_tumbling", "tok_vocab_join"])
def test_query_is_partition_invariant(spark, key):
    results = []
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in ("1", "13"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            results.append(sorted(tuple(r) for r in QUERIES[key](spark, SF_SMALL).collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert results[0] == results[1]


def test_zero_vector_normalises_to_null(spark):
    df = spark.createDataFrame([([0.0, 0.0],), ([3.0, 4.0],)], "v array<double>")
    got = [r.n for r in df.select(V.l2_normalize("v").alias("n")).collect()]
    assert got[0] is None and got[1] == [0.6, 0.8]


def test_tied_negatives_are_selected_together(spark):
    # Row 0: positive 1.0, negatives 0.9, 0.9, 0.5 -> top-1 distinct score keeps both 0.9s.
    rows = [(0, 0, 0, 1.0), (0, 0, 1, 0.9), (0, 0, 2, 0.9), (0, 0, 3, 0.5)]
    pairs = spark.createDataFrame(rows, "batch_id long, qi long, di long, logit double")
    sel = C.hard_negatives(C.eligible(pairs, "none"), k=1)
    assert sorted(r.di for r in sel.collect()) == [1, 2]
    sel2 = C.hard_negatives(C.eligible(pairs, "none"), k=2)
    assert sorted(r.di for r in sel2.collect()) == [1, 2, 3]


def test_epochs_straddle_and_reshuffle(spark):
    df = with_positions(spark.range(0, 10).withColumnRenamed("id", "k"), ["k"], pos="pos")
    same = batch_epochs(df, "pos", 4, 3)
    sizes = sorted(r["count"] for r in same.groupBy("batch_id").count().collect())
    assert sizes == [2, 4, 4, 4, 4, 4, 4, 4]        # 30 rows in batches of 4; batch 2 spans epochs 0/1
    re = batch_epochs(df, "pos", 4, 3, reshuffle_key="k")
    orders = {e: [r.k for r in sorted(re.filter(F.col("epoch") == e).collect(), key=lambda r: r.pos)]
              for e in range(3)}
    assert all(sorted(o) == list(range(10)) for o in orders.values())
    assert len({tuple(o) for o in orders.values()}) > 1


def test_truncation_can_drop_eos(spark):
    df = spark.createDataFrame([([2, 6, 10, 11, 1],)], "t array<int>")
    r = df.select(AR.last_eos(AR.truncate("t", 3)).alias("e"), AR.mask_to_eos(AR.truncate("t", 3)).alias("m"),
                  AR.last_eos("t").alias("e2"), AR.mask_special("t").alias("s")).first()
    assert r.e is None and r.m == [0, 0, 0] and r.e2 == 4 and r.s == [0, 1, 1, 1, 0]


def test_tiles_give_the_same_pairs(spark):
    df = spark.range(0, 70).select(F.pmod("id", F.lit(2)).alias("batch_id"), F.col("id").alias("pos"),
                                   F.array(F.col("id").cast("double")).alias("qv"), F.array(F.lit(2.0)).alias("dv"))
    plain = sorted(map(tuple, C.in_batch_pairs(df).collect()))
    assert len(plain) == 2 * 35 * 35 and sorted(map(tuple, C.in_batch_pairs(df, tile=8).collect())) == plain


def test_tokenize_without_broadcast_matches(spark):
    from lodestar.operators import tokens as TK
    from lodestar.plans import fixtures as fx

    x3 = fx.lines(spark, SF_SMALL)
    v = TK.build_vocab(x3, "line", max_size=300)
    a = sorted((r.version, r.pos, tuple(r.tokens)) for r in TK.tokenize(x3, ["version", "pos"], "line", v, keep_input=False).collect())
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        b = sorted((r.version, r.pos, tuple(r.tokens)) for r in TK.tokenize(x3, ["version", "pos"], "line", v, keep_input=False).collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert a == b
    assert any(t == (2,) for _, _, t in a)          # blank lines give [BOS] only


def test_best_record_sink(spark):
    from lodestar.operators.metrics import best_so_far, write_best_record
    from lodestar.session import scratch_path

    df = spark.createDataFrame([(0, 1, 0.2), (0, 2, 0.1), (0, 3, 0.5), (1, 1, -0.1), (1, 2, 0.3)],
                               "run long, step long, score double")
    imp = best_so_far(df)
    assert sorted((r.run, r.step) for r in imp.collect()) == [(0, 1), (0, 3), (1, 2)]
    path = scratch_path(spark, "best")
    write_best_record(imp, path)
    assert sorted(tuple(r) for r in spark.read.parquet(path).collect()) == [(0, 3, 0.5), (1, 2, 0.3)]


def test_tokenize_long_form_equals_arrays(spark):
    from lodestar.operators import tokens as TK
    from lodestar.plans import fixtures as fx

    x3 = fx.lines(spark, SF_SMALL)
    v = TK.build_vocab(x3, "line", max_size=300)
    arr = {(r.version, r.pos): list(r.tokens)
           for r in TK.tokenize(x3, ["version", "pos"], "line", v, keep_input=False).collect()}
    rows = TK.tokenize(x3, ["version", "pos"], "line", v, long_form=True).collect()
    longf = {}
    for r in rows:
        longf.setdefault((r.version, r.pos), []).append((r.tok_pos, r.token_id))
    assert arr == {k: [t for _, t in sorted(v)] for k, v in longf.items()}


def test_batch_sink_layout_and_roundtrip(spark):
    import os

    from lodestar.session import scratch_path
    from lodestar.sinks.batches import read_batches, write_batches

    df = spark.range(0, 2000).select(F.col("id").alias("pos"), F.expr("id div 16").alias("batch_id"),
                                     F.array(F.col("id").cast("int")).alias("input_ids"))
    path = scratch_path(spark, "test-batches")
    write_batches(df, path, files=4)
    assert len([f for f in os.listdir(path) if f.endswith(".parquet")]) <= 4     # 125 batches
    back = read_batches(spark, path).select("pos", "batch_id", "input_ids")
    assert sorted(tuple(r[:2]) + (tuple(r[2]),) for r in back.collect()) == \
        sorted(tuple(r[:2]) + (tuple(r[2]),) for r in df.collect())


def test_read_lines_keeps_file_order_across_splits(spark):
    from lodestar.plans import fixtures as fx
    from lodestar.session import scratch_path
    from lodestar.sources.lines import read_lines, write_lines

    x3 = fx.lines(spark, SF_SMALL).filter(F.col("version") == "v7")
    path = scratch_path(spark, "test-lines")
    write_lines(x3, path, ["pos"])
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")   # many splits per file
    try:
        back = read_lines(spark, {"v7": path}, strip=False)
        got = [r.line for r in back.orderBy("pos").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == [r.line for r in x3.orderBy("pos").collect()]


def test_encoder_plugin_contract(spark):
    import pytest as _pt

    from lodestar.operators.encode import HashingEncoder, encode_texts

    df = spark.createDataFrame([(1, "a b c"), (2, "one two three four five six")], "id long, text string")
    f = HashingEncoder.factory(16)
    mean = {r.id: r.embedding for r in encode_texts(df, "text", F.lit("query"), f, pooling="mean").collect()}
    assert all(abs(sum(x * x for x in v) - 1.0) < 1e-5 for v in mean.values())
    eos = {r.id: r.embedding for r in encode_texts(df, "text", F.lit("query"), f, pooling="eos", max_length=4).collect()}
    assert eos[1] == eos[2] and eos[1] is not None   # a limit keeps <eos> as the last token
    long = spark.createDataFrame([(1, "w " * 5000), (2, ""), (3, None)], "id long, text string")
    got = {r.id: r.embedding for r in encode_texts(long, "text", F.lit("document"), f).collect()}
    assert got[1] is not None and got[2] is not None and got[3] is None
    with _pt.raises(ValueError):
        encode_texts(df, "text", F.lit("query"), f, pooling="max")


def test_sample_rounds_cap_and_seed_advance(spark):
    from lodestar.sources.sample import sample_pairs

    df = spark.range(0, 5000).withColumnRenamed("id", "key")
    s = sample_pairs(df, "key", p=0.05, seed=42, rounds=4, cap=100)
    per = {r["round"]: r["count"] for r in s.groupBy("round").count().collect()}
    assert set(per) == {0, 1, 2, 3} and all(v == 100 for v in per.values())   # ~250 drawn, capped at 100
    keys = {r: {x.key for x in s.filter(F.col("round") == r).collect()} for r in range(4)}
    assert len(keys[0] & keys[1]) < 50                                          # a new seed each round
    again = sample_pairs(df.repartition(7), "key", p=0.05, seed=42, rounds=4, cap=100)
    assert sorted(tuple(r) for r in again.collect()) == sorted(tuple(r) for r in s.collect())


def test_alignment_reports_missing_version(spark):
    from lodestar.operators.teacher import check_alignment

    toks = spark.createDataFrame([("v6", 0), ("v6", 1), ("v7", 0)], "version string, pos long")
    qv = spark.createDataFrame([("v6", 0), ("v6", 1), ("v7", 0)], "version string, pos long")
    dv = spark.createDataFrame([("v6", 0), ("v6", 1)], "version string, pos long")   # no v7 at all
    got = {r.version: (r.n_tokens, r.n_query, r.n_doc, r.ok)
           for r in check_alignment({"tokens": toks, "query": qv, "doc": dv}).collect()}
    assert got == {"v6": (2, 2, 2, True), "v7": (1, 1, 0, False)}


def test_plugin_cache_tells_closures_apart():
    from lodestar.operators import encode as EN

    for k in range(40):
        assert EN._cached(lambda k=k: ("made", k)) == ("made", k)
    assert len(EN._CACHE) <= EN.MAX_PLUGINS


def test_no_document_is_without_a_vector(spark):
    from lodestar.operators.encode import hash_encode

    d = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    extra = spark.createDataFrame([(-1, None), (-2, ""), (-3, "word " * 3000)], "doc_id long, text string")
    rows = {r.doc_id: r for r in hash_encode(d.unionByName(extra), "doc_id", "text", F.lit("document")).collect()}
    assert len(rows) == d.count() + 3
    assert rows[-1].embedding is None and rows[-1].reason == "null_text"
    for i, r in rows.items():
        if i != -1:
            assert abs(sum(x * x for x in r.embedding) - 1) < 1e-9 and r.reason is None
    cut = {r.doc_id: r.embedding for r in hash_encode(extra, "doc_id", "text", F.lit("document"), max_length=5).collect()}
    assert cut[-3] is not None and cut[-3] != rows[-3].embedding


def test_alignment_fails_on_a_missing_position(spark):
    from pyspark.errors import PySparkException

    from lodestar.operators.teacher import align

    a = spark.createDataFrame([("v6", 0, 1), ("v6", 1, 2)], "version string, pos long, x int")
    b = spark.createDataFrame([("v6", 0, 3), ("v6", 1, 4)], "version string, pos long, y int")
    assert align(a, b).count() == 2
    with pytest.raises(PySparkException):
        align(a, b.filter("pos = 0")).collect()


def test_broadcast_threshold_is_read_like_spark_reads_it(spark):
    from lodestar.session import broadcast_row_limit

    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for text, rows in (("1KB", 1), ("2m", 2048), ("-1", 0), ("4096", 4), ("1g", 1 << 20)):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", text)
            assert broadcast_row_limit(spark, 1024) == rows
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_replayed_epoch_is_written_once(spark):
    """The write of an epoch done twice, as after a failure, leaves one copy."""
    from lodestar.session import scratch_path
    from lodestar.streaming import streams as S

    root = scratch_path(spark, "replay")
    spark.createDataFrame([("{\"query\": \"q%d\", \"document\": \"d\"}" % k,) for k in range(9)], "value string") \
        .coalesce(1).write.text(f"{root}/in")
    for run in range(2):  # a new checkpoint makes the second run replay epoch 0
        S.stream_batches(spark, f"{root}/in", f"{root}/out", f"{root}/ck{run}", size=4)
    rows = S.read_batches(spark, f"{root}/out").collect()
    assert len(rows) == 9 and sorted(r.query for r in rows) == [f"q{k}" for k in range(9)]


def test_two_writers_of_the_best_record_lose_nothing(spark, tmp_path, monkeypatch):
    """A second writer commits while the first one has read the old version but not yet committed its own."""
    from lodestar.operators import metrics as M

    path, schema = str(tmp_path / "best"), "run long, step long, score double"
    M.update_best_record(spark.createDataFrame([(0, 1, 0.1)], schema), path)
    real, calls = M._commit, []

    def commit(spark, path, n, folder):
        calls.append(n)
        if len(calls) == 1:
            monkeypatch.setattr(M, "_commit", real)
            M.update_best_record(spark.createDataFrame([(0, 2, 0.5), (1, 2, 0.7)], schema), path)
            monkeypatch.setattr(M, "_commit", commit)
        return real(spark, path, n, folder)
    monkeypatch.setattr(M, "_commit", commit)
    M.update_best_record(spark.createDataFrame([(0, 3, 0.4), (2, 3, 0.9)], schema), path)
    assert calls == [1, 2]
    assert sorted(tuple(r) for r in M.read_best_record(spark, path).collect()) == [(0, 2, 0.5), (1, 2, 0.7), (2, 3, 0.9)]
