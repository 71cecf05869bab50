"""What the layer jobs move and store for a row: no shuffle into the trusted layer, compressed
landing files of bounded size, and only the datasets that a query reads."""

from strata.plans import jobs as J
from strata.plans import raw_render as RR
from strata.plans.catalog import layers as L
from strata.plans.derive import table
from strata.sinks import writers as W

SF = "/root/testdata/sf0.001"


def test_trusted_rows_keep_the_layout_of_the_raw_table(spark, scratch, monkeypatch):
    root = scratch("trusted")
    RR.land(RR.raw_reclamacoes(spark, SF), f"{root}/landing", sep=";")
    sor = J.run_sor(spark, "reclamacoes", f"{root}/landing", f"{root}/sor", "2023-08-14")
    plans, write = [], W.write_partitioned

    def seen(df, path, by=None, layout="auto", files=None, **kwargs):
        laid = W._layout(df, [by] if isinstance(by, str) else list(by or []), layout, files)
        plans.append((path, laid._jdf.queryExecution().optimizedPlan().toString()))
        return write(df, path, by=by, layout=layout, files=files, **kwargs)

    monkeypatch.setattr(W, "write_partitioned", seen)
    out = J.run_sot(spark, "reclamacoes", spark.read.schema(L._sor_schema("reclamacoes")).parquet(sor), f"{root}/sot",
                    "2023-08-14", quarantine_root=f"{root}/quarantine", run_id="r").output_path
    assert len(plans) == 3 and not [p for _, p in plans if "Rebalance" in p or "Repartition" in p]
    stored = spark.read.parquet(out).count() + spark.read.parquet(f"{root}/quarantine").count()
    assert stored == table(spark, SF, "lineitem").count()


def test_landed_files_are_compressed_and_bounded(spark, scratch, monkeypatch):
    monkeypatch.setattr(RR, "LAND_ROWS", 1000)
    folder = RR.land(RR.raw_reclamacoes(spark, SF), f"{scratch('landed')}/Reclamacoes", sep=";")
    names = [n for n in W.list_names(spark, folder) if n.startswith("part-")]
    rows = table(spark, SF, "lineitem").count()
    assert all(n.endswith(".csv.gz") for n in names) and len(names) >= rows / 1000
    landed = J.sor_frame(spark, "reclamacoes", folder)
    raw = RR.raw_reclamacoes(spark, SF).drop("_trailing")
    assert landed.count() == rows
    # blank and empty fields are as they were rendered; an empty field is read as NULL
    assert landed.select(raw.columns).na.fill("").exceptAll(raw.na.fill("")).count() == 0


def test_a_bank_query_loads_the_banks_only(spark, monkeypatch):
    monkeypatch.setattr(L, "_LAYERS", {})
    assert L.job_sot_bancos(spark, SF).count() == table(spark, SF, "supplier").count()
    (state,) = L._LAYERS.values()
    assert W.list_names(spark, f"{state['root']}/landing") == ["Bancos"]
    assert list(state["sot"]) == ["bancos"]
    # the others follow when a query reads them, and no load is run twice
    assert list(L.layers(spark, SF)["sot"]) == ["bancos", "reclamacoes", "empregados"]
    metrics = spark.read.parquet(f"{state['root']}/data_quality")
    assert metrics.groupBy("nom_tab", "entity", "instance", "name").count().where("count > 1").isEmpty()
