from __future__ import annotations

from statistics import median

import pytest
from pyspark.sql import functions as F

from annofold.operators import hits as h
from annofold.operators.skew import skew_join, with_frequent


@pytest.fixture()
def no_broadcast(spark):
    """Only what is hinted is broadcast, and nothing is planned anew: skew has to be met by the plan itself."""
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def sides(spark, n=20_000):
    """40 % of the left rows and a tenth of the right ones have one key."""
    left = spark.range(n).select(F.when(F.col("id") % 5 < 2, "hot").otherwise(F.concat(F.lit("k"), F.pmod(F.col("id"), F.lit(997)))).alias("key"), F.col("id").alias("a"))
    right = spark.range(3 * 997).select(F.concat(F.lit("k"), F.pmod(F.col("id"), F.lit(997))).alias("key"), F.col("id").alias("b"))
    return left, right.union(spark.range(330).select(F.lit("hot").alias("key"), (-F.col("id") - 1).alias("b")))


def test_frequent_values(spark):
    left, _ = sides(spark)
    held, cells = with_frequent(left, "key", 1000)
    assert cells == {"hot": 8} and held.count() == 20_000
    assert with_frequent(left, "key", 10_000)[1] == {} and with_frequent(left.limit(0), "key", 1)[1] == {}
    nulls = left.withColumn("key", F.when(F.col("key") != "hot", F.col("key")))
    assert with_frequent(nulls, "key", 1000)[1] == {}


def task_rows(df):
    """Rows in each task of the join, copies not counted."""
    return [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]


def test_no_task_far_above_the_median(spark, rows, no_broadcast):
    left, right = sides(spark)
    dealt = skew_join(left, right, "key", (("a",), ("b",)), 250)
    plain = left.join(right, "key")
    assert max(task_rows(plain)) > 3 * median(task_rows(plain))
    assert max(task_rows(dealt)) <= 3 * median(task_rows(dealt))
    assert dealt.columns == plain.columns
    total = lambda df: df.agg(F.count("*"), F.sum(F.xxhash64("key", "a", "b").cast("decimal(38,0)"))).first()
    assert tuple(total(dealt)) == tuple(total(plain))


@pytest.mark.parametrize("cell", [1, 3, 50, 1000])
def test_every_pair_once(spark, rows, cell):
    left = spark.createDataFrame([(k, v) for v in range(40) for k in (["x"] * (v % 3 == 0) + ["y"] + ["z"] * (v % 10 == 0) + [None])], "key string, a long")
    right = spark.createDataFrame([(k, v) for v in range(30) for k in (["x", "w"] + ["y"] * (v % 4 == 0) + [None])], "key string, b long")
    assert rows(skew_join(left, right, "key", (("a",), ("b",)), cell)) == rows(left.join(right, "key"))


def test_label_transfer_with_a_target_in_two_fifths_of_the_hits(spark, rows):
    hits = spark.range(4000).select(
        F.concat(F.lit("q"), F.pmod(F.col("id"), F.lit(1500))).alias("query_id"),
        F.when(F.col("id") % 5 < 2, "t0").otherwise(F.concat(F.lit("t"), F.pmod(F.col("id") * 7, F.lit(90)))).alias("target_id"),
        (F.pmod(F.col("id"), F.lit(9)) / 10 + 0.05).alias("hit_weight"),
    )
    labels = spark.range(600).select(
        F.concat(F.lit("t"), F.pmod(F.col("id"), F.lit(60))).alias("entry_id"), F.concat(F.lit("T"), F.floor(F.col("id") / 60)).alias("term"), F.lit("MF").alias("branch")
    )
    near = lambda df: [(*r[:3], round(r[3], 9), *r[4:]) for r in rows(df)]
    assert near(h.aggregate_hit_labels(hits, labels, cell_rows=100)) == near(h.aggregate_hit_labels(hits, labels))
