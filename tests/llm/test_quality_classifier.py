"""Operator 11: held-out ranking, the risk's gradient, the prior, awkward rows."""

import random

import numpy as np
from pyspark.sql import functions as F

from lodestar.llm import pu_quality as pu
from lodestar.llm import q_labels
from tests.llm.edge import ROWS, documents
from tests.llm.test_models import crc

SF = "/root/testdata/sf0.1"
LABELS = "doc_id long, quality int, toxic int, text string, lang string, h string"


def auc(good, bad):
    return np.mean((good[:, None] > bad[None]) + 0.5 * (good[:, None] == bad[None]))


def test_held_out_ranking(spark):
    label = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    df = q_labels.op11_quality_classifier(spark, SF)
    assert df.dtypes == [("doc_id", "bigint"), ("held_out", "boolean"), ("score", "double"), ("predicted", "int")]
    rows = df.collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r["held_out"] == (crc(r["doc_id"]) % 4 == 2) and 0 <= r["score"] <= 1
               and r["predicted"] == (r["score"] >= 0.7) for r in rows)
    held = [(r["score"], label[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in label]
    good, bad = (np.array([s for s, y in held if y == k]) for k in (1, 0))
    assert auc(good, bad) > 0.98 and (good >= 0.7).mean() > 0.97 and (bad >= 0.7).mean() < 0.15


def test_the_prior_is_found_from_positives_and_unlabelled_rows_alone():
    rng = np.random.default_rng(0)

    def rows(n, share):
        x = rng.normal(0, 0.05, (n, pu.SIZE))
        x[:, 3] += np.where(rng.random(n) < share, 0.6, 0.0)
        return x

    for share in (0.3, 0.6, 0.85):
        assert abs(pu.estimate_prior(rows(1500, 1.0), rows(3000, share)) - share) < 0.08


def test_slope_is_the_gradient_of_the_risk():
    rng = np.random.default_rng(1)
    zp, zu = rng.normal(0, 1, 7), rng.normal(0, 1, 9)

    def risk(zp, zu, prior):
        rest = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        return prior * np.logaddexp(0, -zp).mean() + max(0.0, rest)

    for prior in (0.3, 0.95):
        for shift in (0.0, -4.0):  # the second one makes the part after the bar negative
            gp, gu = pu.non_negative(prior)(zp, zu + shift)
            for z, g, at in ((zp, gp, 0), (zu + shift, gu, 1)):
                for k in range(len(z)):
                    e = np.zeros(len(z))
                    e[k] = 1e-6
                    up, down = ([zp + e, zu + shift], [zp - e, zu + shift]) if at == 0 else (
                        [zp, zu + shift + e], [zp, zu + shift - e])
                    assert abs((risk(*up, prior) - risk(*down, prior)) / 2e-6 - g[k]) < 1e-6


def test_features_are_of_the_whole_text(monkeypatch):
    text = "Some wörds here, and more.\n" * 300 + "x " * 50
    whole = pu.features(text)
    monkeypatch.setattr(pu, "CHUNK", 1000)
    assert np.array_equal(whole, pu.features(text))
    assert not np.array_equal(whole, pu.features(text[:-60]))
    for t in (None, "", "\x00", " \n ", "é", "x" * 10):
        assert np.isfinite(pu.features(t)).all()


def test_long_clean_texts_score_as_short_ones(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    net = pu.fit(docs, labels, F.lit(True), prior=0.857)
    plain = [r["text"] for r in docs.join(labels.filter("quality = 1"), "doc_id").filter(
        "lang = 'en' and n_chars between 500 and 1500").orderBy("doc_id").limit(400).collect()]
    joined = [" ".join(random.Random(k).sample(plain, 60)) for k in range(20)]
    assert (net.scores(np.stack([pu.features(t) for t in joined])) >= 0.7).all()


def folder(spark, tmp_path, rows, labels):
    d = str(tmp_path)
    documents(spark, rows).coalesce(1).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(*r, None, "x", "x", "x") for r in labels], LABELS).coalesce(1).write.parquet(f"{d}/labels.parquet")
    return d


def test_awkward_rows(spark, tmp_path):
    labels = [(r[0], k % 2) for k, r in enumerate(ROWS)] + [(0, 0), (0, 1), (4, 1), (4, 1), (8, None), (9, 7), (777, 1)]
    d = folder(spark, tmp_path / "a", ROWS, labels)
    rows = q_labels.op11_quality_classifier(spark, d).collect()
    assert sorted(str(r["doc_id"]) for r in rows) == sorted(str(r[0]) for r in ROWS)
    assert all(0 <= r["score"] <= 1 and np.isfinite(r["score"]) for r in rows)
    by = {r["doc_id"]: r["score"] for r in rows}
    assert by[1] == by[2]  # null is the empty text
    none = q_labels.op11_quality_classifier(spark, folder(spark, tmp_path / "b", ROWS, [(0, 0), (1, None)])).collect()
    assert {r["score"] for r in none} == {0.5} and len(none) == len(ROWS)
    assert q_labels.op11_quality_classifier(spark, folder(spark, tmp_path / "c", [], [])).count() == 0
    one = q_labels.op11_quality_classifier(spark, folder(spark, tmp_path / "d", ROWS, [(4, 1), (6, 1)])).collect()
    assert len(one) == len(ROWS)


def test_labels_that_contradict_each_other_are_not_trusted(spark):
    docs = documents(spark, [(k, f"text number {k}", "en", "a") for k in range(8)])
    labels = spark.createDataFrame([(0, 1), (1, 1), (1, 0), (2, None), (2, 1), (3, 2), (4, 0), (None, 1)],
                                   "doc_id long, quality int")
    pos, unl = pu.samples(docs, labels, F.lit(True))
    assert len(unl) == 8 and {p.astype(np.float32).tobytes() for p in pos} == {
        pu.features(f"text number {k}").tobytes() for k in (0, 2)}
    pos, unl = pu.samples(docs, labels, F.lit(True), positives=1, unlabelled=3)
    assert len(pos) == 1 and len(unl) == 3
