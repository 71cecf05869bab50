import math

import pytest
from pyspark.sql import functions as F

from strata.operators import metric_states as MS
from strata.operators import quality as Q
from strata.plans import jobs as J

ANALYZERS = [Q.Size(), Q.Completeness("x"), Q.Mean("x"), Q.StandardDeviation("x"), Q.Maximum("x"), Q.Minimum("x"),
             Q.Completeness("s"), Q.Compliance("x small", "x IS NULL OR x < 5"), Q.CountDistinct("s"), Q.Distinctness("s")]


def frame(spark, rows):
    return spark.createDataFrame(rows, "p int, x double, s string")


def same(got, want):
    return got == want or (got is not None and want is not None and math.isclose(got, want, rel_tol=1e-9, abs_tol=1e-9))


def values(df, analyzers):
    return {(r.instance, r.name): r.value for r in Q.analyze(df, analyzers).collect()}


def test_merged_states_equal_metrics_of_the_whole(spark):
    rows = [(i % 5 if i % 11 else None, None if i % 7 == 0 else 1e6 + i * 0.25, None if i % 3 else f"v{i % 40}") for i in range(400)]
    rows += [(9, None, None)] * 3
    df = frame(spark, rows)
    merged = MS.merged_values(MS.partition_states(df, ["p"], ANALYZERS), ANALYZERS)
    want = values(df, ANALYZERS)
    for a, v in merged.items():
        assert same(v, want[(a.instance, a.name)]), a


@pytest.mark.parametrize("rows", [[], [(1, None, None)]])
def test_no_rows_or_no_values(spark, rows):
    df = frame(spark, rows)
    merged = MS.merged_values(MS.partition_states(df, ["p"], ANALYZERS), ANALYZERS)
    want = values(df, ANALYZERS)
    for a, v in merged.items():
        assert v == want[(a.instance, a.name)], a


def test_new_states_replace_those_of_their_partitions(spark):
    old = MS.partition_states(frame(spark, [(1, 1.0, "a"), (2, 2.0, "b"), (None, 3.0, "c")]), ["p"], ANALYZERS)
    new = MS.partition_states(frame(spark, [(2, 7.0, "d"), (2, 9.0, "e"), (None, 5.0, "c")]), ["p"], ANALYZERS)
    got = MS.merged_values(MS.replace_states(old, new, ["p"]), ANALYZERS)
    assert got[Q.Size()] == 4 and got[Q.Mean("x")] == 5.5 and got[Q.CountDistinct("s")] == 4


def test_sketch_error_is_within_its_bound(spark):
    df = spark.range(60_000).select((F.col("id") % 6).cast("int").alias("p"), (F.col("id") % 50_000).alias("k"))
    got = MS.merged_values(MS.partition_states(df, ["p"], [Q.CountDistinct("k")]), [Q.CountDistinct("k")])
    assert abs(got[Q.CountDistinct("k")] - 50_000) <= MS.DISTINCT_ERROR * 50_000


def raw_banks(spark, n):
    return spark.createDataFrame([(f"S{i % 5 + 1}", str(i), f"N{i}") for i in range(n)], "Segmento string, CNPJ string, Nome string")


def test_metrics_ride_on_the_write(spark, scratch, monkeypatch):
    """The staged table is read for nothing but the exact distinct count."""
    read = []
    plain = Q._metric_values
    monkeypatch.setattr(Q, "_metric_values", lambda df, analyzers: read.append(list(analyzers)) or plain(df, analyzers))
    root = scratch("observed")
    J.run_sot(spark, "bancos", raw_banks(spark, 50), f"{root}/sot", "2023-08-14", dq_root=f"{root}/dq", run_id="r")
    assert read == [[Q.CountDistinct("num_cnpj_instituicao")]]
    got = {(r.instance, r.name): r.value for r in spark.read.parquet(f"{root}/dq").collect()}
    assert got[("*", "Size")] == 50 and got[("num_cnpj_instituicao", "CountDistinct")] == 50


def test_an_empty_write_is_measured_too(spark, scratch):
    root = scratch("observed_empty")
    with pytest.raises(Q.DataQualityError):
        J.run_sot(spark, "bancos", raw_banks(spark, 3).where("CNPJ = 'none'"), f"{root}/sot", "2023-08-14", dq_root=f"{root}/dq")
    got = {(r.instance, r.name): r.value for r in spark.read.parquet(f"{root}/dq").collect()}
    assert got[("*", "Size")] == 0 and got[("nom_instituicao", "Completeness")] is None


def test_partition_loads_store_metrics_of_the_table(spark, scratch):
    root = scratch("states")
    banks = raw_banks(spark, 30)
    for date, rows in (("2023-08-14", banks), ("2023-08-15", banks.limit(10)), ("2023-08-14", banks.limit(20))):
        J.run_sot(spark, "bancos", rows, f"{root}/sot", date, dq_root=f"{root}/dq", run_id="last", overwrite="partitions",
                  states_root=f"{root}/dq/_states/bancos")
    sizes = [r.value for r in spark.read.parquet(f"{root}/dq").where("name = 'Size' AND anomesdia = '20230814'").collect()]
    assert sizes == [30.0] and spark.read.parquet(f"{root}/sot").count() == 30
