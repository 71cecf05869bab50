"""Golden replay on small invented feeds: raw -> SoR -> SoT (checked) -> SPEC."""

import pytest
from pyspark.sql import functions as F

from strata import schemas as SC
from strata.operators import quality as Q
from strata.plans import jobs as J
from tests.test_sources_sinks import write_file

REF = "2023-08-14"


def complaint(year, q, cnpj, name, index, total, clients):
    return ";".join([year, q, "Top 10", "Conglomerado", cnpj, name, index, "1", "2", "3", total,
                     clients, "10", "20"]) + ";\n"


def employer(name, seg, geral, remu, hq="Recife, Brasil", industry="/a/b/setor.9,40_IP1.htm"):
    vals = dict.fromkeys(SC.EMPLOYER_FIELDS, "")
    vals.update({"employer_name": name, "reviews_count": "250.0", "employer-headquarters": hq,
                 "employer-founded": "2000.0", "employer-industry": industry, "Geral": geral,
                 "Remuneração e benefícios": remu, "Segmento": seg, "Nome": name})
    return "|".join(vals[f] for f in SC.EMPLOYER_FIELDS) + "\n"


@pytest.fixture(scope="module")
def feeds(spark, tmp_path_factory):
    from strata.session import scratch_path
    root = scratch_path(spark, "golden")
    write_file(f"{root}/landing/Bancos/bancos.tsv", "Segmento\tCNPJ\tNome\n"
               "S1\t100\tBANCO ALFA - PRUDENCIAL\nS2\t200\tBANCO BETA\nS3\t300\tBANCO GAMA\n")
    write_file(f"{root}/landing/Reclamacoes/2021_tri_01.csv",
               ";".join(SC.COMPLAINT_FIELDS) + ";\n"
               + complaint("2021", "1º", "100", "BANCO ALFA (conglomerado)", "1,50", "10", "1000")
               + complaint("2021", "1º", "200", "BANCO BETA", " ", "7", "50"))
    write_file(f"{root}/landing/Reclamacoes/2021_tri_02.csv",
               ";".join(SC.COMPLAINT_FIELDS) + ";\n"
               + complaint("2021", "2º", " ", "BANCO ALFA (conglomerado)", "16.699,13", "20", "2000")
               + complaint("2022", "4º", " ", "BANCÔ GAMA", "2,00", "4", " "))
    write_file(f"{root}/landing/Empregados/emp.csv",
               "|".join(SC.EMPLOYER_FIELDS) + "\n"
               + employer("BANCO ALFA", "S1", "3.8", "3.5")
               + employer("BANCO BETA", "S2", "4.0", "3.0", hq="Recife")
               + employer("BANCO BETA - PRUDENCIAL", "S2", "4.5", "2.0", industry="no-slug")
               + employer("BANCO ZETA", "12345678", "1.0", "1.0"), "\r\n")
    sor, sot = {}, {}
    for d, folder in (("bancos", "Bancos"), ("reclamacoes", "Reclamacoes"),
                      ("empregados", "Empregados")):
        sor[d] = J.run_sor(spark, d, f"{root}/landing/{folder}", f"{root}/sor/{d}", REF)
    for d in sor:
        schema = SC.all_string_schema(SC.RAW_FORMATS[d]["fields"]).add("anomesdia", "string")
        prof = J.quality_profile(d, {"num_cnpj_instituicao": 0.5} if d == "reclamacoes" else None)
        J.run_sot(spark, d, spark.read.schema(schema).parquet(sor[d]), f"{root}/sot/{d}", REF,
                  dq_root=f"{root}/dq", profile=prof)
        sot[d] = f"{root}/sot/{d}"
    return {"root": root, "sor": sor, "sot": sot}


def test_sor_partitions(spark, feeds):  # C1, C2
    recl = spark.read.parquet(feeds["sor"]["reclamacoes"])
    parts = sorted({str(r.anomesdia) for r in recl.select("anomesdia").collect()})
    assert parts == ["20210301", "20210601", "20221201"]
    assert spark.read.parquet(feeds["sor"]["empregados"]).count() == 4  # T7 row still in SoR


def test_sot_cleaning(spark, feeds):  # C3, C4, C5
    banks = {r.num_cnpj_instituicao: r.nom_instituicao
             for r in spark.read.parquet(feeds["sot"]["bancos"]).collect()}
    assert banks == {100: "BANCO ALFA", 200: "BANCO BETA", 300: "BANCO GAMA"}
    emp = spark.read.parquet(feeds["sot"]["empregados"])
    assert emp.count() == 3  # ZETA removed by the segment filter
    beta = {(r.nom_pais_sede_instituicao, r.nom_segto_atua_instituicao)
            for r in emp.filter("vlr_ind_satis_geral >= 4").collect()}
    assert beta == {(None, "setor"), ("Brasil", "")}
    assert {r.ano_fund_instituicao for r in emp.collect()} == {2000}
    recl = spark.read.parquet(feeds["sot"]["reclamacoes"])
    assert dict(recl.dtypes)["vlr_ind_recl"] == "float"
    names = {r.nom_instituicao for r in recl.collect()}
    assert names == {"BANCO ALFA", "BANCO BETA", "BANCO GAMA"}
    idx = sorted((r.vlr_ind_recl or 0.0) for r in recl.collect())
    assert idx[-1] == pytest.approx(16699.13, rel=1e-6) and idx[0] == 0.0


def test_metrics_stored(spark, feeds):  # K9, Q10
    m = spark.read.parquet(f"{feeds['root']}/dq")
    tabs = {str(r.nom_tab) for r in m.select("nom_tab").distinct().collect()}
    assert tabs == {"tb_bancos", "tb_reclamacoes", "tb_empregados"}
    size = m.filter("nom_tab = 'tb_bancos' AND name = 'Size'").first().value
    assert size == 3.0


def test_spec_snapshot_report(spark, feeds):  # C6
    sot = feeds["sot"]
    out = J.run_spec(spark, sot["bancos"], sot["reclamacoes"], sot["empregados"],
                     f"{feeds['root']}/spec", ref_date=REF)
    rep = {r.cnpj: r for r in spark.read.parquet(out).collect()}
    assert set(rep) == {100, 200}  # GAMA has no employer row
    alfa, beta = rep[100], rep[200]
    assert alfa.quantidade_clientes_banco == 2000 and alfa.quantidade_reclamacoes == 20
    assert alfa.indice_reclamacoes == pytest.approx(16699.13, rel=1e-6)
    assert alfa.indice_satisfacao_funcionarios_bancos == pytest.approx(3.8, rel=1e-6)
    assert beta.indice_reclamacoes is None
    assert beta.indice_satisfacao_funcionarios_bancos == pytest.approx(4.5)
    assert beta["indice_satisfação_salarios_funcionarios_bancos"] == pytest.approx(3.0)
    assert str(alfa.anomesdia) == "20230814"


def test_spec_csv_and_quarterly(spark, feeds):  # C8, K8
    sot = feeds["sot"]
    path = J.run_spec(spark, sot["bancos"], sot["reclamacoes"], sot["empregados"],
                      f"{feeds['root']}/spec_csv", sink="csv", ref_date=REF)
    assert spark.read.option("sep", ";").option("header", True).csv(path).count() == 2
    qpath = J.run_spec_quarterly(spark, sot["bancos"], sot["reclamacoes"], sot["empregados"],
                                 f"{feeds['root']}/spec_q", ref_date=REF)
    q = spark.read.option("sep", ";").option("header", True).csv(qpath)
    assert q.count() == 3 and "ano" in q.columns


def test_gate_blocks_default_thresholds(spark, feeds, scratch):  # Q16, T16
    schema = SC.all_string_schema(SC.COMPLAINT_FIELDS).add("anomesdia", "string")
    sor = spark.read.schema(schema).parquet(feeds["sor"]["reclamacoes"])
    out, dq = scratch("blocked"), scratch("dq")
    with pytest.raises(Q.DataQualityError):
        J.run_sot(spark, "reclamacoes", sor, out, REF, dq_root=dq)
    assert spark.read.parquet(dq).count() > 0  # metrics stored before the gate
    from strata.sources import path_length
    assert path_length(spark, out) is None


def test_display_names_for_database(spark, feeds):  # C7 frame
    sot = feeds["sot"]
    b, c, e = J.spec_inputs(spark, sot["bancos"], sot["reclamacoes"], sot["empregados"])
    cols = J.spec_frame(b, c, e, style="display", ref_date=REF).columns
    assert cols[:2] == ["Nome do Banco", "CNPJ"] and cols[-2:] == ["dat_hor_psst", "anomesdia"]
    assert F is not None


@pytest.mark.parametrize("materialize", ["stage", "persist"])
def test_sot_materialize_modes_agree(spark, feeds, scratch, materialize):
    schema = SC.all_string_schema(SC.COMPLAINT_FIELDS).add("anomesdia", "string")
    sor = spark.read.schema(schema).parquet(feeds["sor"]["reclamacoes"])
    out = scratch("sot_mode")
    prof = J.quality_profile("reclamacoes", {"num_cnpj_instituicao": 0.5})
    J.run_sot(spark, "reclamacoes", sor, out, REF, profile=prof, materialize=materialize)
    got = sorted(map(tuple, spark.read.parquet(out).drop("dat_hor_psst").collect()), key=repr)
    want = sorted(map(tuple, spark.read.parquet(feeds["sot"]["reclamacoes"])
                      .drop("dat_hor_psst").collect()), key=repr)
    assert got == want


def test_publish_partitions_keeps_other_partitions(spark, scratch):
    from strata import sinks
    target, stage = scratch("pub_target"), scratch("pub_stage")
    sinks.write_partitioned(spark.createDataFrame([(1, "a"), (2, "b")], "v int, p string"),
                            target, by="p")
    sinks.write_partitioned(spark.createDataFrame([(9, "a")], "v int, p string"), stage, by="p")
    sinks.publish_staged(spark, stage, target, ["p"], overwrite="partitions")
    assert sorted(map(tuple, spark.read.parquet(target).collect())) == [(2, "b"), (9, "a")]


def test_spec_complaint_filter_prunes_partitions(spark, feeds):  # T14 option
    sot = feeds["sot"]
    b, c, e = J.spec_inputs(spark, sot["bancos"], sot["reclamacoes"], sot["empregados"],
                            complaint_filter="ano >= 2022")
    plan = c._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ano" in plan and c.count() == 1


def test_hot_key_third_of_rows(spark):
    """One bank holds a third of all complaint rows: exact result, fact rows collapsed
    by partial aggregation before any shuffle."""
    from strata.operators import report as R
    from tests.test_report import frames, rows
    complaints = [(1 if i % 3 == 0 else (i % 50) + 2, f"B{i % 7}", i, i % 11, float(i % 5),
                   2021, 1 + i % 4) for i in range(3000)]
    banks = [("S1", k, f"B{k % 7}") for k in range(1, 60)]
    employers = [(f"B{k}", float(k), float(k) / 2) for k in range(7)]
    b, c, e = frames(spark, banks, complaints, employers)
    fast = R.snapshot_report(b, c, e)
    assert rows(fast) == rows(R.snapshot_report(b, c, e, pre_aggregate=False))
    plan = fast._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan


def test_cli_runs_the_layers(spark, feeds, scratch):
    from strata.plans import cli
    root = scratch("cli")
    land = f"{feeds['root']}/landing"
    sor = cli.main(["--auto-size", "sor", "--dataset", "bancos", "--input", f"{land}/Bancos",
                    "--output", f"{root}/sor_b", "--ref-date", REF], spark=spark)
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8"  # tiny input -> floor
    for key in ("spark.sql.adaptive.advisoryPartitionSizeInBytes",
                "spark.sql.files.maxPartitionBytes"):
        spark.conf.unset(key)
    sot = cli.main(["sot", "--dataset", "bancos", "--input", sor, "--output", f"{root}/sot_b",
                    "--ref-date", REF, "--dq-root", f"{root}/dq"], spark=spark)
    assert spark.read.parquet(sot).count() == 3
    out = cli.main(["spec", "--banks", sot, "--complaints", feeds["sot"]["reclamacoes"],
                    "--employers", feeds["sot"]["empregados"], "--output", f"{root}/spec",
                    "--ref-date", REF, "--sink", "csv"], spark=spark)
    assert spark.read.option("sep", ";").option("header", True).csv(out).count() == 2


def test_spec_from_catalog_tables(spark, feeds):  # S8: three pruned catalog reads
    from strata import sinks
    sot = feeds["sot"]
    sinks.create_table(spark, "g_bancos", sot["bancos"],
                       "nom_segto_instituicao string, num_cnpj_instituicao bigint, "
                       "nom_instituicao string, dat_hor_psst timestamp, anomesdia string",
                       by=["anomesdia"])
    sinks.repair_table(spark, "g_bancos")
    spark.read.parquet(sot["reclamacoes"]).createOrReplaceTempView("g_recl")
    spark.read.parquet(sot["empregados"]).createOrReplaceTempView("g_emp")
    b, c, e = J.spec_inputs(spark, "g_bancos", "g_recl", "g_emp", from_tables=True)
    assert J.spec_frame(b, c, e, stamp=False).count() == 2


def test_jdbc_writer_arguments(monkeypatch):  # K6 without a database
    from strata.sinks import writers as W
    calls = {}

    class FakeWriter:
        def jdbc(self, url, table, mode, properties):
            calls.update(url=url, table=table, mode=mode, properties=properties)

    class FakeFrame:
        write = FakeWriter()

        def coalesce(self, n):
            calls["coalesce"] = n
            return self

    W.write_jdbc(FakeFrame(), "jdbc:mysql://db:3306/rep", "tb_report",
                 {"user": "u", "driver": "com.mysql.cj.jdbc.Driver"}, num_partitions=4)
    assert calls["mode"] == "append" and calls["coalesce"] == 4
    assert calls["properties"]["batchsize"] == "10000" and calls["table"] == "tb_report"


def test_cli_csv_layers(spark, feeds, scratch):
    from strata.plans import cli
    root = scratch("cli_csv")
    land = f"{feeds['root']}/landing"
    sor = cli.main(["sor", "--dataset", "reclamacoes", "--input", f"{land}/Reclamacoes",
                    "--output", f"{root}/sor", "--format", "csv", "--overwrite", "partitions"],
                   spark=spark)
    sot = cli.main(["sot", "--dataset", "reclamacoes", "--input", sor, "--input-format", "csv",
                    "--output", f"{root}/sot", "--output-format", "csv",
                    "--min-completeness", "num_cnpj_instituicao=0.5"], spark=spark)
    back = spark.read.option("sep", ";").option("header", True).csv(sot)
    assert back.count() == 4 and {"ano", "num_trimestre"} <= set(back.columns)


def test_cli_parses_every_command():
    from strata.plans import cli
    p = cli._parser()
    a = p.parse_args(["export", "--table", "db.t", "--jdbc-url", "jdbc:x", "--jdbc-table", "t",
                      "--jdbc-user", "u"])
    assert cli._jdbc_props(a) == {"user": "u"}
    a = p.parse_args(["spec", "--banks", "b", "--complaints", "c", "--employers", "e",
                      "--sink", "jdbc", "--jdbc-url", "jdbc:x", "--jdbc-table", "r"])
    assert a.sink == "jdbc" and a.jdbc_table == "r"
    a = p.parse_args(["spec-quarterly", "--banks", "b", "--complaints", "c", "--employers", "e",
                      "--output", "o"])
    assert a.cmd == "spec-quarterly"
    a = p.parse_args(["stream", "--landing", "l", "--sor-root", "s", "--checkpoint", "k",
                      "--refresh", "partitions", "--sot-root", "t"])
    assert a.refresh == "partitions" and a.max_files_per_trigger == 1000
