"""Key-or-name join: split forms are bag-equal to the literal OR join (NULLs included)."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from strata.operators import joins as J
from tests.naive import or_join_naive


def bags(spark, seed):
    rnd = random.Random(seed)
    keys = [None, 1, 2, 3, 4]
    names = [None, "a", "b", "c"]
    left = [(rnd.choice(keys), rnd.choice(names), i) for i in range(25)]
    right = [(rnd.choice(keys), rnd.choice(names), rnd.randint(0, 3)) for _ in range(40)]
    l = spark.createDataFrame(left, "k bigint, n string, lid int")
    r = spark.createDataFrame(right, "k bigint, n string, v int")
    return l, r


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("strategy", ["tagged", "union"])
def test_split_equals_naive_or(spark, seed, strategy):
    l, r = bags(spark, seed)
    pairs = [("k", "k"), ("n", "n")]
    got = Counter(map(tuple, J.or_equi_join(l, r, pairs, strategy=strategy).collect()))
    want = Counter(map(tuple, or_join_naive(l, r, pairs).collect()))
    assert got == want


def test_split_plan_has_no_nested_loop(spark):
    l, r = bags(spark, 1)
    plan = J.or_equi_join(l, r, [("k", "k"), ("n", "n")])._jdf.queryExecution() \
        .executedPlan().toString()
    assert "NestedLoop" not in plan


def test_set_form_is_union_distinct(spark):  # U3
    l, r = bags(spark, 4)
    got = set(map(tuple, J.or_equi_join(l, r, [("k", "k"), ("n", "n")], dedup=True,
                                        keep_right_keys=False).collect()))
    by_k = l.join(r.withColumnRenamed("n", "n_r"), "k").select("k", "n", "lid", "v")
    by_n = l.join(r.withColumnRenamed("k", "k_r"), "n").select("k", "n", "lid", "v")
    want = set(map(tuple, by_k.unionByName(by_n).distinct().collect()))
    assert got == want


def test_three_key_pairs(spark):
    l = spark.createDataFrame([(1, "a", "x"), (2, None, "y")], "k bigint, n string, z string")
    r = spark.createDataFrame([(1, "b", "q"), (3, "a", "x"), (None, None, "y")],
                              "k bigint, n string, z string")
    pairs = [("k", "k"), ("n", "n"), ("z", "z")]
    got = Counter(map(tuple, J.or_equi_join(l, r, pairs).collect()))
    want = Counter(map(tuple, or_join_naive(l, r, pairs).collect()))
    assert got == want and sum(got.values()) == 3


def test_union_and_distinct(spark):  # U1, U2
    a = spark.createDataFrame([(1, "x")], "id int, v string")
    b = spark.createDataFrame([("x", 1), ("y", 2)], "v string, id int")
    u = J.union_all([a, b])
    assert u.count() == 3 and J.distinct_rows(u).count() == 2


@pytest.mark.parametrize("strategy", ["tagged", "union"])
def test_hot_key_is_split(spark, strategy):
    """A third of the rows on one key, sort-merge join: AQE cuts that partition."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2"}
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        facts = spark.range(0, 300_000, 1, 8).selectExpr(
            "IF(id % 3 = 0, 0, id % 5000) AS k", "CAST(NULL AS STRING) AS n", "sha2(CAST(id AS STRING), 256) AS v")
        banks = spark.range(5000).selectExpr("id AS k", "CONCAT('n', id) AS n")
        out = J.or_equi_join(banks, facts, [("k", "k"), ("n", "n")], strategy=strategy)
        out = out.selectExpr("count(v)", "max(v)")
        assert out.collect()[0][0] == 300_000
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_heavy_keys_are_salted(spark):
    """A key with a third of the rows, sort-merge joins, no skew handling by Spark: no task makes twice
    the pairs of the median one, and the bag is that of the plain join."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16",
            "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        facts = spark.range(0, 200_000, 1, 8).selectExpr(
            "CASE WHEN id % 7 = 0 THEN NULL WHEN id % 3 = 0 THEN 0 ELSE id % 50000 END AS k",
            "IF(id % 5 = 0, CONCAT('n', id % 50000), NULL) AS n", "id AS v")
        banks = spark.range(50_000).selectExpr("id AS k", "CONCAT('n', id) AS n")
        heavy = J.heavy_keys(facts, ["k", "n"])
        assert [(h.pair, h.value) for h in heavy] == [(0, 0)] and heavy[0].salts > 4
        pairs = [("k", "k"), ("n", "n")]
        salted = J.or_equi_join(banks, facts, pairs, heavy=heavy).select(F.col("k").alias("a"), "v")
        plain = J.or_equi_join(banks, facts, pairs).select(F.col("k").alias("a"), "v")
        assert salted.exceptAll(plain).isEmpty() and plain.exceptAll(salted).isEmpty()

        def largest(df):
            sizes = sorted(r[1] for r in df.groupBy(F.spark_partition_id()).count().collect())
            return sizes[-1] / sizes[len(sizes) // 2]

        assert largest(plain) > 4 and largest(salted) < 2
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_heavy_keys_of_odd_inputs(spark):
    empty = spark.createDataFrame([], "k int, n string")
    assert J.heavy_keys(empty, ["k", "n"]) == []
    nulls = spark.createDataFrame([(None, None)] * 5, "k int, n string")
    assert J.heavy_keys(nulls, ["k", "n"]) == []
    rows = spark.createDataFrame([(None, "x")] * 9 + [(1, "y"), (2, None)], "k int, n string")
    heavy = J.heavy_keys(rows, ["k", "n"], share=0.3)
    assert [(h.pair, h.value, h.salts) for h in heavy] == [(1, "x", 3)]
    left = spark.createDataFrame([(1, "x"), (1, "x"), (3, "y"), (None, None)], "k int, n string")
    got = J.or_equi_join(left, rows, [("k", "k"), ("n", "n")], heavy=heavy)
    assert got.count() == 2 * 9 + 2 + 1
