"""Data-quality metrics, checks and the gate."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata import sinks
from strata.operators import metric_states as MS
from strata.operators import quality as Q
from strata.plans import derive
from strata.plans.catalog._base import register
from strata.session import scratch_path


_DQ_SRC_SQL = """SELECT o_orderkey, o_custkey, o_orderstatus,
       CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_totalprice END AS price,
       CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderpriority END AS priority,
       o_totalprice - 200000 AS margin
FROM orders"""


def _dq_source(spark, sf_dir):
    o = derive.table(spark, sf_dir, "orders")
    return o.select(
        "o_orderkey", "o_custkey", "o_orderstatus",
        F.when(F.col("o_orderkey") % 5 != 0, F.col("o_totalprice")).alias("price"),
        F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderpriority")).alias("priority"),
        (F.col("o_totalprice") - 200000).alias("margin"))


DQ_ANALYZERS = [
    Q.Size(), Q.Completeness("price"), Q.Completeness("priority"),
    Q.CountDistinct("o_custkey"), Q.Distinctness("o_custkey"),
    Q.Maximum("price"), Q.Minimum("price"), Q.Mean("price"), Q.StandardDeviation("price"),
    Q.CountDistinct("priority"),
]


@register("dq_metrics", f"""WITH src AS ({_DQ_SRC_SQL})
SELECT 'Dataset' AS entity, '*' AS instance, 'Size' AS name, round(count(*), 6) AS value FROM src
UNION ALL SELECT 'Column', 'price', 'Completeness', round(count(price) / count(*), 6) FROM src
UNION ALL SELECT 'Column', 'priority', 'Completeness', round(count(priority) / count(*), 6) FROM src
UNION ALL SELECT 'Column', 'o_custkey', 'CountDistinct', round(count(DISTINCT o_custkey), 6) FROM src
UNION ALL SELECT 'Column', 'o_custkey', 'Distinctness',
  round(count(DISTINCT o_custkey) / count(o_custkey), 6) FROM src
UNION ALL SELECT 'Column', 'price', 'Maximum', round(max(price), 6) FROM src
UNION ALL SELECT 'Column', 'price', 'Minimum', round(min(price), 6) FROM src
UNION ALL SELECT 'Column', 'price', 'Mean', round(avg(price), 6) FROM src
UNION ALL SELECT 'Column', 'price', 'StandardDeviation', round(stddev_pop(price), 6) FROM src
UNION ALL SELECT 'Column', 'priority', 'CountDistinct', round(count(DISTINCT priority), 6) FROM src""")
def dq_metrics(spark, sf_dir):
    m = Q.analyze(_dq_source(spark, sf_dir), DQ_ANALYZERS)
    return m.select("entity", "instance", "name", F.round("value", 6).alias("value"))


def dq_suite() -> Q.Check:
    return (Q.Check("Warning", "Review Check")
            .has_size(lambda n: n >= 1)
            .has_completeness("price", lambda c: c >= 0.9)
            .has_completeness("priority", lambda c: c >= 0.5)
            .is_contained_in("o_orderstatus", ["F", "O", "P"])
            .is_contained_in("priority", ["1-URGENT", "2-HIGH"])
            .is_non_negative("price")
            .is_non_negative("margin"))


_CHECK_ROWS_SQL = f"""WITH src AS ({_DQ_SRC_SQL}),
m AS (
  SELECT count(*) AS size, count(price) / count(*) AS c_price,
         count(priority) / count(*) AS c_priority,
         avg(CASE WHEN o_orderstatus IS NULL OR o_orderstatus IN ('F','O','P') THEN 1 ELSE 0 END)
           AS in_status,
         avg(CASE WHEN priority IS NULL OR priority IN ('1-URGENT','2-HIGH') THEN 1 ELSE 0 END)
           AS in_priority,
         avg(CASE WHEN coalesce(price, 0) >= 0 THEN 1 ELSE 0 END) AS nn_price,
         avg(CASE WHEN coalesce(margin, 0) >= 0 THEN 1 ELSE 0 END) AS nn_margin
  FROM src),
c AS (
  SELECT 'SizeConstraint(Size(None))' AS "constraint", size >= 1 AS ok, size AS v FROM m
  UNION ALL SELECT 'CompletenessConstraint(Completeness(price,None))', c_price >= 0.9, c_price FROM m
  UNION ALL SELECT 'CompletenessConstraint(Completeness(priority,None))', c_priority >= 0.5,
    c_priority FROM m
  UNION ALL SELECT 'ComplianceConstraint(Compliance(o_orderstatus contained in F,O,P,'
    || '`o_orderstatus` IS NULL OR `o_orderstatus` IN (''F'',''O'',''P''),None))',
    in_status = 1, in_status FROM m
  UNION ALL SELECT 'ComplianceConstraint(Compliance(priority contained in 1-URGENT,2-HIGH,'
    || '`priority` IS NULL OR `priority` IN (''1-URGENT'',''2-HIGH''),None))',
    in_priority = 1, in_priority FROM m
  UNION ALL SELECT 'ComplianceConstraint(Compliance(price is non-negative,'
    || 'COALESCE(CAST(`price` AS DECIMAL(20,10)), 0.0) >= 0,None))', nn_price = 1, nn_price FROM m
  UNION ALL SELECT 'ComplianceConstraint(Compliance(margin is non-negative,'
    || 'COALESCE(CAST(`margin` AS DECIMAL(20,10)), 0.0) >= 0,None))', nn_margin = 1, nn_margin FROM m)"""


@register("dq_checks", f"""{_CHECK_ROWS_SQL}
SELECT 'Review Check' AS "check", 'Warning' AS check_level,
       CASE WHEN bool_and(ok) OVER () THEN 'Success' ELSE 'Warning' END AS check_status,
       "constraint", CASE WHEN ok THEN 'Success' ELSE 'Failure' END AS constraint_status,
       CASE WHEN ok THEN '' ELSE 'does not meet the constraint requirement!' END AS message_end,
       round(v, 6) AS metric_value
FROM c""")
def dq_checks(spark, sf_dir):
    r = Q.verify(_dq_source(spark, sf_dir), [dq_suite()])
    return r.select("check", "check_level", "check_status", "constraint", "constraint_status",
                    # a message states the value as a double; what follows it is compared
                    F.regexp_replace("constraint_message", "^Value: [-0-9.E]+ ", "").alias("message_end"),
                    F.round("metric_value", 6).alias("metric_value"))


@register("dq_gate", f"""{_CHECK_ROWS_SQL}
SELECT 'full_suite' AS suite, count(*) FILTER (WHERE NOT ok) > 0 AS gate_raised,
       count(*) FILTER (WHERE NOT ok) AS n_failed FROM c
UNION ALL
SELECT 'passing_subset', false, 0 FROM (SELECT 1) t""")
def dq_gate(spark, sf_dir):
    """Runs the gate on the full suite (fails) and on its passing subset; reports
    whether each raised. Metrics are computed on the same source frame."""
    src = _dq_source(spark, sf_dir)
    passing = (Q.Check("Warning", "Review Check")
               .has_size(lambda n: n >= 1)
               .is_contained_in("o_orderstatus", ["F", "O", "P"])
               .is_non_negative("price"))
    rows = []
    for suite, check in (("full_suite", dq_suite()), ("passing_subset", passing)):
        result = Q.verify(src, [check])
        n_failed = Q.failed_constraints(result).count()
        try:
            Q.gate(result)
            raised = False
        except Q.DataQualityError:
            raised = True
        rows.append((suite, raised, n_failed))
    return spark.createDataFrame(rows, "suite string, gate_raised boolean, n_failed bigint")


@register("dq_non_negative_large", """WITH v AS (
  SELECT CASE WHEN l_linenumber = 1 THEN NULL ELSE l_orderkey * 20000000000 END AS up,
         CASE WHEN l_linenumber = 1 THEN NULL WHEN l_linenumber = 2 THEN -l_orderkey * 20000000000
              ELSE l_orderkey * 20000000000 END AS mixed FROM lineitem)
SELECT 'up' AS instance, count(*) FILTER (up IS NULL OR up >= 0) / count(*) = 1 AS passed,
       round(count(*) FILTER (up IS NULL OR up >= 0) / count(*), 6) AS metric_value FROM v
UNION ALL
SELECT 'mixed', count(*) FILTER (mixed IS NULL OR mixed >= 0) / count(*) = 1,
       round(count(*) FILTER (mixed IS NULL OR mixed >= 0) / count(*), 6) FROM v""")
def dq_non_negative_large(spark, sf_dir):
    """Non-negative checks on values far above 1e10, of both signs, with NULLs."""
    value = F.col("l_orderkey") * F.lit(20000000000).cast("bigint")
    line = F.col("l_linenumber")
    src = derive.table(spark, sf_dir, "lineitem").select(
        F.when(line != 1, value).alias("up"),
        F.when(line == 2, -value).when(line > 2, value).alias("mixed"))
    r = Q.verify(src, [Q.Check().is_non_negative("up").is_non_negative("mixed")])
    return r.select(F.regexp_extract("constraint", r"Compliance\((\w+) is", 1).alias("instance"),
                    (F.col("constraint_status") == "Success").alias("passed"),
                    F.round("metric_value", 6).alias("metric_value"))


_STATE_ANALYZERS = [a for a in DQ_ANALYZERS if a.name not in ("CountDistinct", "Distinctness")] + [
    Q.Maximum("margin"), Q.Minimum("margin"), Q.Mean("margin"), Q.StandardDeviation("margin")]


@register("dq_merged_states", f"""WITH src AS ({_DQ_SRC_SQL})
SELECT 'Dataset' AS entity, '*' AS instance, 'Size' AS name, round(count(*), 4) AS value FROM src
UNION ALL SELECT 'Column', 'price', 'Completeness', round(count(price) / count(*), 4) FROM src
UNION ALL SELECT 'Column', 'priority', 'Completeness', round(count(priority) / count(*), 4) FROM src
""" + "".join(f"""UNION ALL SELECT 'Column', '{c}', '{name}', round({f}({c}), 4) FROM src
""" for c in ("price", "margin") for name, f in (("Maximum", "max"), ("Minimum", "min"), ("Mean", "avg"),
                                                 ("StandardDeviation", "stddev_pop"))))
def dq_merged_states(spark, sf_dir):
    """Orders loaded in two waves of partitions, the second of which replaces some of the first
    (whose rows were then half there): metrics merged from the stored states of the partitions."""
    root = scratch_path(spark, "metric_states")
    by, part = ["part"], F.pmod("o_orderkey", F.lit(7)).cast("int")
    src = _dq_source(spark, sf_dir).withColumn("part", part)
    half = F.col("o_custkey") % 2 == 0
    for wave in (src.where((part < 3) | ((part < 5) & half)), src.where(part >= 3)):
        sinks.write_partitioned(MS.partition_states(wave, by, _STATE_ANALYZERS), root, by=by, layout="none",
                                overwrite="partitions")
    m = MS.merged_metrics(spark.read.parquet(root), _STATE_ANALYZERS)
    return m.select("entity", "instance", "name", F.round("value", 4).alias("value"))


@register("dq_distinct_sketch", "\nUNION ALL ".join(
    f"SELECT '{c}' AS instance, count(DISTINCT {c}) AS n_distinct, true AS within_bound FROM {t}"
    for c, t in (("l_orderkey", "lineitem"), ("l_partkey", "lineitem"), ("l_extendedprice", "lineitem"),
                 ("l_linestatus", "lineitem"))))
def dq_distinct_sketch(spark, sf_dir):
    """Distinct counts from one stored sketch per return flag, merged: exact count, and whether the
    estimate is within the stated bound of it."""
    root = scratch_path(spark, "distinct_states")
    lines = derive.table(spark, sf_dir, "lineitem")
    columns = ["l_orderkey", "l_partkey", "l_extendedprice", "l_linestatus"]
    analyzers = [Q.CountDistinct(c) for c in columns]
    sinks.write_partitioned(MS.partition_states(lines.withColumn("flag", F.col("l_returnflag")), ["flag"], analyzers),
                            root, by="flag", layout="none")
    near = MS.merged_metrics(spark.read.parquet(root), analyzers)
    exact = Q.analyze(lines, analyzers).select("instance", F.col("value").cast("long").alias("n_distinct"))
    return exact.join(near, "instance").select(
        "instance", "n_distinct",
        (F.abs(F.col("value") - F.col("n_distinct")) <= MS.DISTINCT_ERROR * F.col("n_distinct")).alias("within_bound"))
