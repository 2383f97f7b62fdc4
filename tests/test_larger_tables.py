"""Steps that must not grow faster than their input: what tasks hold, what is shuffled, what is computed once."""
import hashlib
import os
import time
from types import SimpleNamespace

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lodestar.operators import encode as EN
from lodestar.plans import q_pipelines, q_sources, q_tokens


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_encoder_sums_whole_texts_in_their_tasks(spark):
    df = spark.createDataFrame([(1, "a b a"), (1, "c"), (2, None)], "id long, text string")
    t = EN.hash_encode(df, "id", "text", F.lit("query"))
    assert "Generate" not in plan(t)  # no row per token
    assert {r.id: (r.embedding is None, r.reason) for r in t.collect()} == {1: (False, None), 2: (True, "null_text")}


@pytest.mark.parametrize("pooling", ["mean", "eos"])
def test_draw_encoder_blocks_and_forgotten_draws_change_nothing(monkeypatch, pooling):
    texts = [" ".join(f"w{(i * k) % 97}" for i in range(150)) for k in (1, 5, 11)] + [""]
    want, n = EN.DrawEncoder().sums(texts, ["query", "", None, "document"], pooling)
    monkeypatch.setattr(EN, "DRAW_BLOCK", 32)
    small = EN.DrawEncoder(keep=40)
    got, m = small.sums(texts, ["query", "", None, "document"], pooling)
    assert (got == want).all() and (n == m).all() and len(small.rows) <= 40
    toks = ["<bos>", "<unused0>", *texts[0].split(), "<eos>"]
    draw = [int.from_bytes(hashlib.md5(f"0|vector0|{t}".encode()).digest()[:2], "big") - 32768 for t in toks]
    assert want[0, 0] == sum(x * (1 if pooling == "mean" else 1 + i % 7) for i, x in enumerate(draw))


def test_plug_in_encoder_keeps_to_its_batches(spark):
    class Sizes:
        def encode(self, texts, roles, pooling, max_length, normalize):
            return [np.array([len(texts), len(t)], np.float32) for t in texts]
    df = spark.createDataFrame([(i, None if i == 9 else "x" * i) for i in range(10)], "id int, text string").coalesce(1)
    t = EN.encode_texts(df, "text", F.lit("query"), Sizes, batch_size=4)
    assert "ArrowEvalPython" in plan(t) and "predict" not in plan(t)
    got = {r.id: r.embedding for r in t.collect()}
    assert got == {i: None if i == 9 else [2.0 if i > 7 else 4.0, float(i)] for i in range(10)}


def test_plug_in_tokenizer_holds_a_bounded_part_of_the_vocabulary(spark, tmp_path):
    path = str(tmp_path / "vocab")
    n = EN.HOT_IDS + 5000
    spark.range(n).select(F.concat(F.lit("w"), "id").alias("token"), F.col("id").cast("int").alias("id")).write.parquet(path)
    assert len(EN.VocabTokenizer.load(path).mapping) == EN.HOT_IDS
    df = spark.createDataFrame([(1, f"w5 w{n - 1} zz"), (1, f"w{n - 1} w7"), (2, None)], "id int, text string")
    tok = EN.tokenize_udf(EN.VocabTokenizer.factory(path))
    t = EN.with_rare_words(df, "text", spark.read.parquet(path)).select("id", tok("text", "rare_words", "rare_ids").alias("t"))
    assert sorted((r.id, r.t) for r in t.collect()) == [(1, [2, 5, n - 1, 3]), (1, [2, n - 1, 7]), (2, None)]


def test_windows_of_a_block_are_folded_in_one_call():
    from lodestar.streaming.streams import _fold_windows

    kept = {}
    state = SimpleNamespace(hasTimedOut=False, exists=False, getCurrentWatermarkMs=lambda: 50,
                            update=lambda v: kept.update(v=v), setTimeoutTimestamp=lambda t: kept.update(t=t))
    rows = pd.DataFrame({"window_id": [1, 0, 1, 2], "step": [4, 1, 3, 5], "loss": [4.0, 1.0, 2.0, 9.0], "tokens": [1, 2, 3, 4],
                         "dt": [1.0, 0.0, 1.0, 1.0], "until": [70, 60, 80, 90]})
    more = rows[rows["window_id"] == 0].assign(step=2, loss=3.0, until=61)
    out = pd.concat(_fold_windows(2)((7, 0), [rows, more], state))
    assert out["window_id"].tolist() == [0, 1] and out["run"].tolist() == [7, 7]
    assert out["mean_loss"].tolist() == [2.0, 3.0] and out["instant_loss"].tolist() == [3.0, 4.0]
    assert out["tokens_per_sec"].tolist() == [0.0, 2.0]
    assert kept["v"][0] == [2] and kept["t"] == 90


def test_shuffled_chars_by_batches(spark):
    from lodestar.operators.augment import shuffle_chars, shuffle_words

    lines = ["", "abcdefghi", "\U0001F600x \u00e9", None, "two  words\there"]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "id int, line string")
    t = df.select("id", shuffle_chars("line", 42, F.col("id")).alias("c"), shuffle_words("line", 42, F.col("id")).alias("w"))
    assert "ArrowEvalPython" in plan(t) and "lambda" not in plan(t)

    def order(parts, salt, i):
        return [p for _, _, p in sorted((hashlib.md5(f"42|{salt}|{i}|{k // 4}".encode()).hexdigest()[8 * (k % 4):8 * (k % 4) + 8], k, p)
                                        for k, p in enumerate(parts))]
    for r in t.collect():
        x = lines[r.id]
        assert (r.c, r.w) == ((None, None) if x is None else ("".join(order(x, "chars", r.id)), " ".join(order(x.split(), "words", r.id))))


def test_group_offsets_do_not_gather_a_group(spark):
    from lodestar.operators.order import global_from_group_positions

    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.createDataFrame([("b", 0), ("a", 0), ("a", 1)], "v string, pos long")
        t = global_from_group_positions(df, "v", "pos")
        assert "BroadcastHashJoin" in plan(t)
        assert sorted(r.gpos for r in t.collect()) == [0, 1, 2]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.fixture
def docs(spark, tmp_path):
    spark.createDataFrame([(i, f"a b c{i}\nd e\n\nf{i}") for i in range(6)], "doc_id long, text string").write.parquet(
        str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, np.arange(i, i + 96.0).tolist()) for i in range(9)], "vec_id long, embedding array<float>").write.parquet(
        str(tmp_path / "embeddings.parquet"))
    return str(tmp_path)


def test_token_lines_are_tokenized_once(spark, docs, monkeypatch):
    seen = []
    land = q_sources.land_versions
    monkeypatch.setattr(q_sources, "land_versions", lambda s, df, *a: (seen.append(plan(df)), land(s, df, *a))[1])
    assert q_sources.src_token_lines(spark, docs).count() == 29
    assert "CoGroup" not in seen[0]


def _aligned(monkeypatch, module):
    seen = []
    align = module.D.align
    monkeypatch.setattr(module.D, "align", lambda *d, **k: (seen.extend(d), align(*d, **k))[1])
    return seen


def test_distillation_carries_the_drawn_vector_only(spark, docs, monkeypatch):
    seen = _aligned(monkeypatch, q_pipelines)
    out = q_pipelines.pipeline_distill_samples(spark, docs).collect()
    q, d = ({(r.version, r.pos): r[2] for r in t.collect()} for t in seen[1:])
    assert len(out) == len(q) == 29 and all((q[k] is None) != (d[k] is None) for k in q)
    assert all(len(q[k] or d[k]) == q_pipelines.KEPT for k in q)
    assert all((q[r["version"], r.idx] is None) == (r.role == "document") for r in out)


def test_positional_join_carries_no_vectors(spark, docs, monkeypatch):
    seen = _aligned(monkeypatch, q_tokens)
    assert q_tokens.join_positional(spark, docs).count() == 29
    assert not [f for t in seen for f in t.schema if f.dataType.typeName() == "array"]


def _shuffle_files(spark) -> set:
    """Names of the shuffle files that the session holds (in local mode there is one block manager)."""
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for i in range(files.size()) if (name := files.apply(i).getName()).startswith("shuffle_")}


def test_distillation_drops_what_a_part_has_moved(spark, docs, monkeypatch):
    whole = sorted(map(tuple, q_pipelines.pipeline_distill_samples(spark, docs).collect()))
    monkeypatch.setattr(q_pipelines, "PART_BYTES", 256)
    made, path = [], q_pipelines.scratch_path
    monkeypatch.setattr(q_pipelines, "scratch_path", lambda s, name: (made.append(path(s, name)), made[-1])[1])
    seen, had = _aligned(monkeypatch, q_pipelines), _shuffle_files(spark)
    out = q_pipelines.pipeline_distill_samples(spark, docs)
    for _ in range(50):  # files go shortly after their execution
        if not (left := _shuffle_files(spark) - had):
            break
        time.sleep(0.2)
    assert not left
    codes = [x for x in made if "/token-codes-" in x]
    assert len(codes) == q_pipelines.PARTS and not [x for x in codes if os.path.exists(x.removeprefix("file:"))]
    tokens = next(x for x in made if "/line-tokens-" in x)
    assert not [x for x in os.listdir(tokens.removeprefix("file:")) if x.startswith("part=")]
    assert len(seen) == 3 * q_pipelines.PARTS  # tokens and both teachers of every part
    assert sorted(map(tuple, out.collect())) == whole and len(whole) == 29


def test_samples_in_parts_are_one_version(spark, tmp_path):
    from lodestar.sinks.samples import read_samples, write_samples

    path = str(tmp_path)
    version = write_samples((spark.range(10 * k, 10 * k + 10) for k in range(3)), path)
    assert sorted(r.id for r in read_samples(spark, path).collect()) == list(range(30))
    assert spark.read.parquet(f"{version}/manifest").agg(F.sum("rows")).first()[0] == 30


def test_line_parts_and_keys_are_the_lines(spark, docs):
    from lodestar.plans import fixtures as fx

    want = sorted((r.version, r.pos, r.line) for r in fx.lines(spark, docs).collect())
    places = fx.line_places(spark, docs)
    parts = [[(r.version, r.pos, r.line) for r in fx.line_part(spark, docs, places, k, 3).collect()] for k in range(3)]
    assert sorted(sum(parts, [])) == want and all(parts)
    assert sorted(map(tuple, fx.line_keys(places).collect())) == [x[:2] for x in want]


def test_four_decimals_are_those_of_printf(spark):
    x = F.col("x")
    values = [0.0, -0.0, 1.0, -1.0, 5e-5, -5e-5, -4.999e-5, 0.12345, -0.00015, 0.99995, 1.0000000000000002, 1e-300, float("nan")]
    df = spark.createDataFrame([(v,) for v in [*values, *np.random.default_rng(5).uniform(-1, 1, 500).tolist()]], "x double")
    t = df.select(q_pipelines._four_decimals(x).alias("got"), F.format_string("%.4f", F.round(x, 4) + F.lit(0.0)).alias("want"))
    assert "format_string" not in plan(df.select(q_pipelines._four_decimals(x)))
    assert [r.got for r in t.collect()] == [r.want for r in t.collect()]
