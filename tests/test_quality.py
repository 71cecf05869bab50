import pytest
from pyspark.sql import functions as F

from strata.operators import quality as Q


@pytest.fixture
def df(spark):
    return spark.createDataFrame(
        [("S1", 1, 2.0), ("S9", 2, -1.0), (None, 2, None), ("S2", None, 4.0)],
        "seg string, k bigint, v double")


def test_metrics_long_form_one_scan(df):
    m = {(r.instance, r.name): r.value for r in Q.analyze(df, [
        Q.Size(), Q.Completeness("seg"), Q.CountDistinct("k"), Q.Distinctness("k"),
        Q.Maximum("v"), Q.Minimum("v"), Q.Mean("v"), Q.StandardDeviation("v")]).collect()}
    assert m[("*", "Size")] == 4 and m[("seg", "Completeness")] == 0.75
    assert m[("k", "CountDistinct")] == 2 and m[("k", "Distinctness")] == pytest.approx(2 / 3)
    assert m[("v", "Maximum")] == 4.0 and m[("v", "Minimum")] == -1.0
    assert m[("v", "Mean")] == pytest.approx(5 / 3)
    direct = df.agg(F.stddev_pop("v")).first()[0]
    assert m[("v", "StandardDeviation")] == pytest.approx(direct)


def test_null_passes_containment_and_non_negative(spark):  # Q13, Q14
    df = spark.createDataFrame([("S1", 1.0), (None, None)], "seg string, v double")
    chk = Q.Check().is_contained_in("seg", ["S1", "S2"]).is_non_negative("v")
    res = Q.verify(df, [chk]).collect()
    assert all(r.constraint_status == "Success" for r in res)
    assert res[0].check_status == "Success"
    Q.gate(Q.verify(df, [chk]))


def test_failures_and_gate(df):  # Q11, Q12, Q15, Q16
    chk = (Q.Check("Error").has_size(lambda n: n >= 1)
           .has_completeness("seg", lambda c: c >= 0.98)
           .is_contained_in("seg", ["S1", "S2"]).is_non_negative("v"))
    res = {r.constraint: r for r in Q.verify(df, [chk]).collect()}
    status = {k.split("(")[0] + ("" if "Compliance" not in k else k.split(",")[0][-15:]):
              r.constraint_status for k, r in res.items()}
    assert list(res.values())[0].check_status == "Error"
    assert sum(r.constraint_status == "Failure" for r in res.values()) == 3
    assert res["SizeConstraint(Size(None))"].constraint_status == "Success"
    assert "does not meet" in res["CompletenessConstraint(Completeness(seg,None))"].constraint_message
    with pytest.raises(Q.DataQualityError):
        Q.gate(Q.verify(df, [chk]))
    assert status


def test_approx_distinct_option(df):
    m = Q.analyze(df, [Q.CountDistinct("k", approx=True)]).first()
    assert m.value == 2.0


def test_run_suite_one_scan_matches_separate_calls(df):
    analyzers = [Q.Size(), Q.Completeness("seg"), Q.Mean("v")]
    chk = Q.Check().has_completeness("k", lambda c: c >= 0.9).is_non_negative("v")
    metrics, checks = Q.run_suite(df, analyzers, [chk])
    assert sorted(map(tuple, metrics.collect())) == sorted(map(tuple, Q.analyze(df, analyzers).collect()))
    assert [tuple(r) for r in checks.collect()] == [tuple(r) for r in Q.verify(df, [chk]).collect()]


def test_row_verdicts_agree_with_the_metrics(spark):
    """NULL passes a domain and a sign test, but not completeness; each failure is named once."""
    check = (Q.Check().has_size(lambda n: n > 0).is_contained_in("s", ["a", "b'c"]).is_non_negative("x")
             .has_completeness("s", lambda v: v == 1.0))
    rows = [("a", 1.0), ("b'c", None), ("z", -1.0), (None, 0.0), (None, None), ("a", -0.5), ("a", 1.0)]
    judged = Q.row_verdicts(spark.createDataFrame(rows, "s string, x double"), [check])
    n_failed = [len(r[Q.ROW_FAILURES]) for r in judged.collect()]
    assert n_failed == [0, 0, 2, 1, 1, 1, 0]
    kept, rejected = Q.split_rows(judged)
    assert kept.columns == ["s", "x"] and kept.count() == 3 and rejected.count() == 4
    values = {r.constraint: r.metric_value for r in Q.verify(judged, [check]).collect()}
    for text in Q.row_predicates([check]):
        failed = sum(text in r[Q.ROW_FAILURES] for r in judged.collect())
        assert abs(values[text] - (1 - failed / len(rows))) < 1e-12
    assert Q.split_rows(Q.row_verdicts(kept, [Q.Check()]))[1].isEmpty()
    assert Q.split_rows(Q.row_verdicts(kept.limit(0), [check]))[0].isEmpty()


def test_rejection_gate():
    assert Q.rejection_gate(0, 0, 0.0) == 0.0 and Q.rejection_gate(4, 1, 0.25) == 0.25
    with pytest.raises(Q.DataQualityError, match="1 of 3 rows rejected"):
        Q.rejection_gate(3, 1, 0.3)


def test_load_with_quarantine(spark, scratch):
    """Kept and quarantined rows are the input; a repeat of the run replaces its rows; too many
    rejected rows stop the load and leave the trusted table as it was."""
    from strata.plans import jobs as J
    kind = "Segmento string, CNPJ string, Nome string"
    rows = [("S1", "1", "A"), ("S9", "2", "B"), ("S2", " ", "C"), ("S3", "4", None), ("S4", "5", "E")]
    sor = spark.createDataFrame(rows, kind)
    root = scratch("quarantine")
    where = dict(ref_date="2023-08-14", quarantine_root=f"{root}/q", run_id="r1")
    for _ in range(2):
        J.run_sot(spark, "bancos", sor, f"{root}/sot", max_rejected=0.6, **where)
    kept = {r.nom_instituicao for r in spark.read.parquet(f"{root}/sot").collect()}
    put_aside = spark.read.parquet(f"{root}/q").collect()
    assert kept == {"A", "E"} and {r.nom_instituicao for r in put_aside} == {"B", "C", None} and len(put_aside) == 3
    assert all(len(r[Q.ROW_FAILURES]) == 1 for r in put_aside)
    with pytest.raises(Q.DataQualityError, match="3 of 5 rows rejected"):
        J.run_sot(spark, "bancos", sor, f"{root}/sot", max_rejected=0.5, **where)
    assert spark.read.parquet(f"{root}/sot").count() == 2
