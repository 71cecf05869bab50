import pytest
"""Physical-plan properties that matter at scale."""

import __spark_entry__ as entry
from strata.plans import catalog

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_flagship_scans_fact_table_once_without_nested_loop(spark):
    plan = plan_of(catalog.flagship_report(spark, SF))
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan
    assert plan.count("lineitem.parquet") == 1
    # partial aggregation below the first shuffle of the fact table
    assert "partial_max" in plan


def test_sql_form_has_no_nested_loop(spark):
    plan = plan_of(catalog.flagship_report_sql(spark, SF))
    assert "NestedLoop" not in plan


def test_scan_prunes_columns(spark):
    df = catalog.flagship_report(spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    # only the five lineitem columns the report derives from are read
    import re
    schema = re.search(r"lineitem\.parquet\].*?ReadSchema: struct<([^>]*)>", plan, re.S)
    assert schema is not None
    assert set(x.split(":")[0] for x in schema.group(1).split(",")) == {
        "l_orderkey", "l_suppkey", "l_linenumber", "l_quantity", "l_discount"}


def test_entry_returns_report(spark):
    assert entry.entry(spark).columns[0] == "nome_banco"


def test_encoding_parameter(spark, scratch):  # T9
    import os
    from strata import schemas as SC
    from strata.session import local_dir
    from strata.sources import read_delimited
    d = scratch("latin1")
    os.makedirs(local_dir(d))
    with open(f"{local_dir(d)}/b.tsv", "wb") as fh:
        fh.write("Segmento\tCNPJ\tNome\nS1\t1\tBANCO SÃO JOSÉ\n".encode("iso-8859-1"))
    row = read_delimited(spark, d, sep="\t", schema=SC.all_string_schema(SC.BANK_FIELDS), encoding="ISO-8859-1").first()
    assert row.Nome == "BANCO SÃO JOSÉ"


def test_add_partition(spark, scratch):
    from strata import sinks
    d = scratch("addpart")
    sinks.create_table(spark, "t_addpart", d, "v int, p string", by=["p"])
    sinks.write_partitioned(spark.createDataFrame([(1, "a"), (2, "b")], "v int, p string"), d,
                            by="p")
    sinks.add_partition(spark, "t_addpart", {"p": "a"})
    assert spark.read.table("t_addpart").count() == 1


def test_sizing_from_input_bytes(spark):
    from strata.session import input_bytes, sizing
    assert sizing(0)["spark.sql.shuffle.partitions"] == "8"
    assert sizing(100 * 1024 ** 4)["spark.sql.shuffle.partitions"] == "524288"  # 100 TB
    assert sizing(10 * 1024 ** 3)["spark.sql.shuffle.partitions"] == "52"
    assert input_bytes(spark, [f"{SF}/lineitem.parquet"]) > 0


def test_cluster_needs_a_shared_folder():
    from types import SimpleNamespace

    from strata.session import shared_root

    class Unset:
        def get(self, *_):
            return None
    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]"):
        sc = SimpleNamespace(master=master, getConf=Unset, getCheckpointDir=lambda: None)
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            shared_root(SimpleNamespace(sparkContext=sc, conf=Unset()))


def test_sizing_has_no_cap_of_its_own():
    from strata.session import sizing
    assert int(sizing(100 * 10 ** 12)["spark.sql.shuffle.partitions"]) > 400_000
    assert sizing(100 * 10 ** 12, max_partitions=50)["spark.sql.shuffle.partitions"] == "50"
