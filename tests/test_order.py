"""Global positions, running aggregates and batching: permutation and
partition-invariance properties."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from lodestar.operators.order import batch_fixed, micro_split, running_agg, shuffle, with_positions


def _events(spark):
    return spark.read.parquet("/root/testdata/sf0.01/events.parquet").select(
        "event_id", F.pmod("user_id", F.lit(4)).alias("run"), "value")


def test_positions_are_a_dense_permutation(spark):
    ev = _events(spark)
    n = ev.count()
    p = with_positions(ev, ["event_id"], pos="pos")
    got = p.agg(F.min("pos"), F.max("pos"), F.countDistinct("pos")).first()
    assert tuple(got) == (0, n - 1, n)
    ref = ev.withColumn("ref", F.row_number().over(Window.orderBy("event_id")) - 1)
    assert p.join(ref, "event_id").filter(F.col("pos") != F.col("ref")).count() == 0


def test_positions_partition_invariant(spark):
    ev = _events(spark)
    outs = []
    for parts in (1, 4, 13):
        p = with_positions(ev, ["event_id"], pos="pos", group_by=["run"], partitions=parts)
        outs.append(sorted((r.event_id, r.pos) for r in p.select("event_id", "pos").collect()))
    assert outs[0] == outs[1] == outs[2]


def test_running_agg_matches_window(spark):
    ev = _events(spark)
    w = Window.partitionBy("run").orderBy("event_id")
    ref = ev.withColumn("s", F.sum("value").over(w.rowsBetween(Window.unboundedPreceding, 0))) \
            .withColumn("m", F.max("value").over(w.rowsBetween(Window.unboundedPreceding, -1)))
    s = running_agg(ev, ["event_id"], "value", group_by=["run"], how="sum", out="s2", partitions=5)
    m = running_agg(ev, ["event_id"], "value", group_by=["run"], how="max", inclusive=False, out="m2", partitions=7)
    j = ref.join(s.select("event_id", "s2"), "event_id").join(m.select("event_id", "m2"), "event_id")
    assert j.filter(F.abs(F.col("s") - F.col("s2")) > 1e-6).count() == 0
    assert j.filter(~F.col("m").eqNullSafe(F.col("m2"))).count() == 0


def test_shuffle_is_seeded_permutation(spark):
    ev = _events(spark).select(F.col("event_id").cast("string").alias("k"))
    a = shuffle(ev, "k", 7).select("k", "pos")
    b = shuffle(ev.repartition(3), "k", 7).select("k", "pos")
    c = shuffle(ev, "k", 8).select("k", "pos")
    assert sorted(a.collect()) == sorted(b.collect())
    assert sorted(a.collect()) != sorted(c.collect())
    assert a.select("pos").distinct().count() == ev.count()


def test_batches_cover_positions_once_and_micro_split_drops_tail(spark):
    df = spark.range(0, 50).withColumnRenamed("id", "pos")
    b = batch_fixed(df, "pos", 16)
    sizes = dict(b.groupBy("batch_id").count().collect())
    assert sizes == {0: 16, 1: 16, 2: 16, 3: 2}
    m = micro_split(b, 3)
    per = {(r.batch_id, r.micro_id): r["count"] for r in m.groupBy("batch_id", "micro_id").count().collect()}
    assert per[(0, 0)] == 5 and (0, 3) not in per      # 16 // 3 = 5, tail of 1 dropped
    assert all(k[0] != 3 for k in per)                  # 2 // 3 = 0: nothing kept
