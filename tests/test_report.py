"""Two-level report semantics (T10-T13) and the collapse-before-join rewrite."""

import random

from pyspark.sql import functions as F

import pytest

from strata.operators import report as R

BANKS = "nom_segto_instituicao string, num_cnpj_instituicao bigint, nom_instituicao string"
COMPLAINTS = ("num_cnpj_instituicao bigint, nom_instituicao string, qtd_totl_clie_css_scr bigint, "
              "qtd_totl_recl bigint, vlr_ind_recl double, ano int, num_trimestre int")
EMPLOYERS = "nom_instituicao string, vlr_ind_satis_geral double, vlr_ind_remu_bene double"


def frames(spark, banks, complaints, employers):
    return (spark.createDataFrame(banks, BANKS), spark.createDataFrame(complaints, COMPLAINTS),
            spark.createDataFrame(employers, EMPLOYERS))


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_key_or_name_and_two_levels(spark):
    b, c, e = frames(spark,
                     [("S1", 1, "BANCO A"), ("S2", 2, "BANCO B"), ("S3", 3, "BANCO C")],
                     [(1, None, 100, 10, 1.5, 2021, 1),        # key only
                      (None, "BANCO A", 300, 5, None, 2021, 2),  # name only
                      (2, "BANCO B", 50, 7, 2.0, 2021, 1),       # both
                      (None, None, 999, 999, 9.9, 2021, 1)],     # neither
                     [("BANCO A", 3.5, 3.0), ("BANCO A", 4.0, 2.0),  # two employer rows (T12)
                      ("BANCO B", 4.5, 4.5)])
    out = {r.num_cnpj_instituicao: r for r in R.snapshot_report(b, c, e).collect()}
    assert set(out) == {1, 2}  # BANCO C has no complaint/employer -> inner join drops it
    a = out[1]
    assert a.max_qtd_totl_clie_ccs_scr == 300 and a.sum_qtd_totl_recl == 10  # T11: sum = max
    assert a.avg_ind_recl == 1.5
    assert a.avg_ind_geral_instituicao == 4.0 and a.avg_ind_remu_bene_instituicao == 3.0  # T12


def test_all_null_average_stays_null(spark):  # T13
    b, c, e = frames(spark, [("S1", 1, "X")], [(1, "X", 1, 1, None, 2021, 1)], [("X", 1.0, 1.0)])
    assert R.snapshot_report(b, c, e).first().avg_ind_recl is None


@pytest.mark.parametrize("seed", [7, 8])
def test_collapse_before_join_is_exact(spark, seed):
    rnd = random.Random(seed)
    names = ["A", "B", "C", "D", None]
    banks = [(f"S{rnd.randint(1, 5)}", k, rnd.choice(names[:4])) for k in range(1, 6)]
    complaints = [(rnd.choice([None, 1, 2, 3, 4, 5, 6]), rnd.choice(names), rnd.randint(0, 50),
                   rnd.randint(0, 9), rnd.choice([None, 0.5, 1.25, 2.0]), 2021,
                   rnd.randint(1, 4)) for _ in range(60)]
    employers = [(rnd.choice(names), rnd.choice([None, 1.0, 2.5]), rnd.choice([0.5, 3.0]))
                 for _ in range(8)]
    b, c, e = frames(spark, banks, complaints, employers)
    assert rows(R.snapshot_report(b, c, e)) == rows(R.snapshot_report(b, c, e, pre_aggregate=False))
    assert rows(R.quarterly_report(b, c, e)) == rows(
        R.quarterly_report(b, c, e, pre_aggregate=False))


def test_quarterly_client_count_is_mean(spark):  # G4
    b, c, e = frames(spark, [("S1", 1, "X")],
                     [(1, "X", 10, 1, 1.0, 2021, 1), (1, "X", 30, 2, 1.0, 2021, 1),
                      (1, "X", 5, 1, 1.0, 2021, 2)], [("X", 1.0, 1.0)])
    out = {(r.ano, r.num_trimestre): r for r in R.quarterly_report(b, c, e).collect()}
    assert out[(2021, 1)].max_qtd_totl_clie_ccs_scr == 30.0
    assert out[(2021, 2)].max_qtd_totl_clie_ccs_scr == 5.0


def test_sort_desc_nulls_last_and_top_k(spark):  # O1-O6
    df = spark.createDataFrame([(1, 5.0), (2, None), (3, 9.0), (4, 5.0)], "id int, v double")
    assert [r.id for r in R.sort_desc(df, "v", ["id"]).collect()] == [3, 1, 4, 2]
    assert [r.id for r in R.top_k(df, "v", 2, ["id"]).collect()] == [3, 1]
    plan = R.top_k(df, "v", 2)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_count_by_non_null(spark):  # G5
    df = spark.createDataFrame([("S1", "a"), ("S1", None), ("S2", "b")], "seg string, n string")
    assert dict(map(tuple, R.count_by(df, "seg", "n").collect())) == {"S1": 1, "S2": 1}


def test_finalize_report_names(spark):
    b, c, e = frames(spark, [("S1", 1, "X")], [(1, "X", 7, 3, 0.5, 2021, 1)], [("X", 1.0, 2.0)])
    snap = R.finalize_report(R.snapshot_report(b, c, e))
    assert snap.columns[0] == "nome_banco" and dict(snap.dtypes)["quantidade_clientes_banco"] == "int"
    disp = R.finalize_report(R.snapshot_report(b, c, e), "display")
    assert disp.columns[0] == "Nome do Banco"


def test_first_rows_peek(spark):  # O6 (unordered head)
    assert R.first_rows(spark.range(100), 5).count() == 5


def test_sort_without_tiebreak_spreads_a_repeated_value(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(2000).select((F.col("id") % 2).cast("double").alias("v"), "id")
        out = R.sort_desc(df, "v")
        sizes = out.groupBy(F.spark_partition_id().alias("p")).count().collect()
        assert max(r["count"] for r in sizes) < 1000  # no single task holds a whole tie
        vals = [r.v for r in out.collect()]
        assert vals == sorted(vals, reverse=True)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_with_position_is_a_distributed_row_number(spark):  # O1-O5
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(3000).select(((F.col("id") * 7919) % 101).cast("double").alias("v"),
                                      "id")
        got = {r.id: r.position for r in R.with_position(df, "v", ["id"]).collect()}
        want = sorted(df.collect(), key=lambda r: (-r.v, r.id))
        assert [got[r.id] for r in want] == list(range(1, 3001))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_maxima_of_changed_quarters_only(spark, scratch):
    """NULL quarters, a quarter that loses all rows and quarters that were not named."""
    from strata.plans import jobs as J
    from strata.sinks import write_partitioned
    kinds = ("num_cnpj_instituicao bigint, nom_instituicao string, qtd_totl_clie_css_scr bigint, qtd_totl_recl bigint, "
             "vlr_ind_recl float, ano int, num_trimestre int")
    root = scratch("maxima")

    def frame(rows):
        return spark.createDataFrame(rows, kinds)

    def save(rows):
        write_partitioned(frame(rows), f"{root}/complaints", by=["ano", "num_trimestre"])

    def stored():
        cols = ["num_cnpj_instituicao", "nom_instituicao", "ano", "num_trimestre", "qtd_totl_recl"]
        return {tuple(r) for r in spark.read.parquet(f"{root}/maxima").select(cols).collect()}

    first = [(1, "a", 1, 5, 1.0, 2020, 1), (1, "a", 9, 3, 1.0, 2020, 1), (2, None, 1, 7, 1.0, 2020, 2),
             (None, "c", 1, 1, 1.0, None, 3), (None, None, 1, 99, 1.0, 2020, 1), (3, "d", 1, 2, 1.0, 2021, 1)]
    save(first)
    J.refresh_maxima(spark, f"{root}/complaints", f"{root}/maxima")
    assert stored() == {(1, "a", 2020, 1, 5), (2, None, 2020, 2, 7), (None, "c", None, 3, 1), (3, "d", 2021, 1, 2)}
    # 2020/2 loses its rows; 2021/1 changes too, but is not named and stays as it was
    save([(1, "a", 1, 6, 1.0, 2020, 1), (None, "c", 1, 8, 1.0, None, 3), (3, "d", 1, 50, 1.0, 2021, 1)])
    periods = spark.createDataFrame([(2020, 1), (2020, 2), (None, 3)], "ano int, num_trimestre int")
    for _ in range(2):  # a repeat changes nothing
        J.refresh_maxima(spark, f"{root}/complaints", f"{root}/maxima", periods)
        assert stored() == {(1, "a", 2020, 1, 6), (None, "c", None, 3, 8), (3, "d", 2021, 1, 2)}
    J.refresh_maxima(spark, f"{root}/complaints", f"{root}/maxima", periods.limit(0))
    assert len(stored()) == 3
