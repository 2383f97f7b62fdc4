"""Augmentation invariants and token-budget packing contract."""

from collections import Counter

from pyspark.sql import functions as F

from lodestar.operators import augment as A
from lodestar.operators import tokens as TK
from lodestar.plans import fixtures as fx
from tests.conftest import SF_SMALL


def test_augmentations_keep_their_invariants(spark):
    x3 = fx.lines(spark, SF_SMALL)
    k = [F.col("version"), F.col("pos")]
    rows = x3.select("line", A.shuffle_words("line", 1, *k).alias("w"), A.shuffle_chars("line", 1, *k).alias("c"),
                     A.substring_random("line", 1, *k).alias("s"), A.reverse_half("line").alias("h"),
                     A.repeat_random("line", 1, *k).alias("r"), A.reverse_word("line", 1, *k).alias("rw")).collect()
    for r in rows:
        line = r.line
        assert sorted(r.w.split(" ")) == sorted(line.split()) or (not line.split() and r.w == "")
        assert Counter(r.c) == Counter(line)
        assert r.s in line and (len(r.s) >= 1 or line == "")
        assert r.h == line[: len(line) // 2] + line[len(line) // 2:][::-1]
        assert r.r in (line, line * 2, line * 3)
        assert len(r.rw) == len(line)


def test_dispatch_uses_every_case(spark):
    x3 = fx.lines(spark, SF_SMALL)
    t = A.augment(x3, "line", 42, ["version", "pos"])
    cases = {r.case for r in t.select("case").distinct().collect()}
    assert cases == set(range(1, 9))
    assert t.count() == x3.count()


def test_token_budget_contract(spark):
    lens = spark.range(0, 2500).select(F.col("id").alias("pos"),
                                       (F.pmod(F.col("id") * 7919, F.lit(300)) + 1).cast("int").alias("n"))
    budget = 256
    p = TK.pack_token_budget(lens, "pos", "n", budget, buffer=1000).collect()
    assert sorted(r.pos for r in p) == list(range(2500))
    batches = {}
    for r in p:
        batches.setdefault(r.batch_id, []).append(r.n)
    for ns in batches.values():
        assert len(ns) * max(ns) <= budget or len(ns) == 1
