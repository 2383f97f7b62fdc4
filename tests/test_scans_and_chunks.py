"""Prefix scans, chunked tokenization, line numbers, plug-in encoder, passage judgments and the sample sink
against direct computations."""

import random
import re

import pytest
from pyspark.sql import functions as F

from lodestar.operators import tokens as TK
from lodestar.operators.encode import DrawEncoder, encode_texts, hash_encode
from lodestar.operators.evaluate import encode_side, evaluate_texts
from lodestar.operators.judgments import by_passage
from lodestar.operators.order import running_agg
from lodestar.sinks.samples import latest_version, read_samples, write_samples
from lodestar.sources.jsonl import numbered_lines
from tests.conftest import SF_SMALL


@pytest.mark.parametrize("how", ["sum", "max"])
@pytest.mark.parametrize("inclusive", [True, False])
def test_running_values_over_partitions_and_batches(spark, how, inclusive):
    rng = random.Random(1)
    rows = [(rng.choice(["hot", "hot", "hot", "a", "b", None]), i, rng.choice([None, rng.randint(-5, 9)])) for i in range(400)]
    df = spark.createDataFrame(rows, "g string, at long, v int")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = {r["at"]: r["out"] for r in running_agg(df, ["at"], "v", ["g"], how, inclusive, "out", partitions=9).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    state: dict = {}
    for g, at, v in rows:
        before = state.get(g)
        after = before if v is None else v if before is None else before + v if how == "sum" else max(before, v)
        state[g] = after
        assert got[at] == (after if inclusive else before)
    assert len(got) == 400


def test_running_values_without_groups_rows_or_whole_numbers(spark):
    df = spark.createDataFrame([(i, i / 4) for i in range(50)], "at long, v double")
    got = [r["s"] for r in running_agg(df, ["at"], "v", out="s", partitions=5).orderBy("at").collect()]
    assert got == [sum(j / 4 for j in range(i + 1)) for i in range(50)]
    assert running_agg(df.limit(0), ["at"], "v", out="s").count() == 0


def test_no_exchange_after_the_checkpoint(spark):
    df = spark.createDataFrame([(i % 3, i, i) for i in range(50)], "g long, at long, v long")
    plan = running_agg(df, ["at"], "v", ["g"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan and "MapInArrow" in plan


@pytest.mark.parametrize("chunk, small", [(1 << 19, True), (5, True), (5, False)])
def test_chunked_tokens_equal_a_plain_look_up(spark, monkeypatch, chunk, small):
    rng = random.Random(2)
    words = [f"w{i}" for i in range(40)] + ["<eos>", "日本", "é"]
    texts = [(i, rng.choice(["q", None]), " ".join(rng.choices(words, k=rng.randint(0, 12)))) for i in range(60)]
    texts += [(60, "q", None), (61, "q", ""), (62, "q", "  "), (63, "q", "<unused0>w1<eos>"), (64, "q", "w1 " * 500)]
    df = spark.createDataFrame(texts, "id long, role string, text string").repartition(3)
    vocab = TK.build_vocab(df.filter("id < 30"), "text")
    real = TK._chunks

    def cut(df, keys, text):  # the task's own copy of the module has the usual size
        monkeypatch.setattr(TK, "CHUNK_WORDS", chunk)
        kind, there = type(df), type(df).mapInArrow

        def patched(self, f, s):
            def run(batches):
                import lodestar.operators.tokens as T
                T.CHUNK_WORDS = chunk
                yield from f(batches)
            return there(self, run, s)
        monkeypatch.setattr(kind, "mapInArrow", patched)
        try:
            return real(df, keys, text)
        finally:
            monkeypatch.setattr(kind, "mapInArrow", there)
    monkeypatch.setattr(TK, "_chunks", cut)
    if not small:
        monkeypatch.setattr(TK, "broadcast_row_limit", lambda *a: 0)
        monkeypatch.setattr(TK, "HOT_WORDS", 3)
    ids = {r["token"]: r["id"] for r in vocab.collect()}
    got = {r["id"]: r["tokens"] for r in TK.tokenize(df, ["id", "role"], "text", vocab, keep_input=False).collect()}
    assert len(got) == len(texts)
    for i, _, t in texts:
        cut_up = re.sub(TK.SPECIAL_PATTERN, r" \1 ", t or "").split()
        assert got[i] == [2] + [ids.get(w, 3) for w in cut_up]


def test_no_row_per_word_is_shuffled(spark):
    df = spark.createDataFrame([(i, "a b c a b c a a a") for i in range(20)], "id long, text string")
    vocab = TK.build_vocab(df, "text")
    found = TK._chunks(df.coalesce(1), ["id"], "text")
    assert found.filter("_word is not null").count() == 3 and found.filter("_codes is not null").count() == 20
    plan = TK.tokenize(df, "id", "text", vocab)._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "collect_list" not in plan


def test_line_numbers_over_splits(spark, tmp_path):
    lines = {f: [rng.choice(["", "x", "not json", "y" * 30]) for _ in range(n)] for f, n, rng in (
        ("a", 200, random.Random(1)), ("b", 1, random.Random(2)), ("c", 90, random.Random(3)))}
    for f, x in lines.items():
        (tmp_path / f).write_text("\n".join(x) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    spark.conf.set("spark.sql.files.openCostInBytes", "10")
    try:
        t = numbered_lines(spark, str(tmp_path))
        assert t.rdd.getNumPartitions() > 3 or t.select(F.spark_partition_id()).distinct().count() > 1
        got = sorted((r["file"].rsplit("/", 1)[1], r["line_no"], r["value"]) for r in t.collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == sorted((f, i + 1, v) for f, x in lines.items() for i, v in enumerate(x))


def test_plug_in_encoder_equals_the_expressions(spark):
    rows = [(1, "a b a"), (2, ""), (3, None), (4, "x " * 3000), (5, " \t "), (6, " é 日本\x1c z")]
    df = spark.createDataFrame(rows, "id long, text string")
    for pooling in ("mean", "eos"):
        for norm in (True, False):
            for limit in (None, 4):
                a = {r.id: r.embedding for r in encode_texts(df, "text", F.lit("query"), DrawEncoder.factory(), pooling,
                                                             limit, norm, batch_size=2, element="double").collect()}
                b = {r.id: r.embedding for r in hash_encode(df, "id", "text", F.lit("query"), pooling, limit, norm).collect()}
                assert a[3] is None and b[3] is None
                for i in (1, 2, 4, 5, 6):
                    assert len(a[i]) == 64 and max(abs(x - y) for x, y in zip(a[i], b[i])) < 1e-12


def test_judgments_by_passage(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(500)]

    def text(n):
        return " ".join(rng.choices(words, k=n))
    items = [(k, text(25)) for k in range(8)] + [(8, "Only three words"), (9, None), (10, "")]
    docs = []
    for k in range(60):
        t = text(40)
        if k % 3 == 0:
            w = items[k % 8][1].split()
            a = rng.randint(0, 14)
            t = f"{t} {' '.join(w[a:a + rng.choice([9, 10, 12])]).upper()}\n{text(5)}"
        if k == 7:
            t += " only  three\twords"
        docs.append((k, t))
    docs += [(60, None), (61, "only three"), (62, "x only three words y")]
    q = spark.createDataFrame([("t", *r) for r in items], "task string, qid long, text string")
    d = spark.createDataFrame([("t", *r) for r in docs], "task string, did long, text string")
    want = set()
    for qid, t in items:
        w = (t or "").lower().split()
        runs = {" ".join(w[i:i + min(10, len(w))]) for i in range(len(w) - min(10, len(w)) + 1)} - {""}
        want |= {(qid, did) for did, x in docs if any(f" {r} " in f" {' '.join((x or '').lower().split())} " for r in runs)}
    got = [(r.qid, r.did) for r in by_passage(q, d).collect()]
    assert len(want) > 10 and sorted(got) == sorted(want)


def test_evaluation_of_the_tasks_asked_for(spark):
    q = spark.createDataFrame([("a", 1, "alpha beta"), ("b", 1, "gamma"), ("c", 1, "not asked for")],
                              "task string, qid long, text string")
    d = spark.createDataFrame([("a", 1, "alpha beta"), ("a", 2, "other words"), ("b", 3, "gamma"), ("c", 4, "x")],
                              "task string, did long, text string")
    rel = spark.createDataFrame([("a", 1, 1, 1), ("c", 1, 4, 1)], "task string, qid long, did long, rel int")
    summary, scores = evaluate_texts(q, d, rel, ("a", "b", "z"))
    s = summary.first()
    assert s.ndcg_at_5_by_task == {"a": s.avg_ndcg_at_5} and (s.total_tasks, s.valid_tasks) == (3, 1)
    assert {r.task for r in scores.collect()} == {"a"}
    one = encode_side(q, "query", DrawEncoder.factory(), "qv", task_name="a", max_length=2048)
    assert [r.qid for r in one.collect()] == [1] and "text" not in one.columns


def test_sample_versions_are_checked_against_their_manifest(spark, tmp_path):
    path = str(tmp_path)
    a = spark.range(10).withColumn("v", F.lit("a"))
    first = write_samples(a, path)
    second = write_samples(a.withColumn("v", F.lit("b")).repartition(3), path)
    assert latest_version(spark, path).endswith(second.rsplit("/", 1)[1]) and first != second
    assert {(r.id, r.v) for r in read_samples(spark, path).collect()} == {(i, "b") for i in range(10)}
    gone = next((tmp_path / second.rsplit("/", 1)[1] / "data").glob("part-*.parquet"))
    gone.rename(tmp_path / "kept-aside.parquet")
    with pytest.raises(ValueError, match="manifest says"):
        read_samples(spark, path)
    with pytest.raises(FileNotFoundError):
        read_samples(spark, str(tmp_path / "none"))


def test_eval_texts_reads_whole_tables(spark):
    import __spark_entry__ as e

    r = e.queries()["eval_texts"](spark, SF_SMALL).first()
    assert r.total_tasks == 5 and 1 <= r.valid_tasks <= 4 and r.ndcg_at_5_by_task.count("=") == r.valid_tasks
