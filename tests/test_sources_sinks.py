import os

import pytest

from pyspark.sql import functions as F

from strata import schemas as SC
from strata import sinks, sources as S
from strata.session import local_dir


def write_file(path, text, newline="\n"):
    p = local_dir(path)
    os.makedirs(os.path.dirname(p), exist_ok=True)
    with open(p, "w", encoding="utf-8", newline="") as fh:
        fh.write(text.replace("\n", newline))


def test_trailing_empty_field_keeps_rows(spark, scratch):  # T8, S3
    d = scratch("recl")
    header = ";".join(SC.COMPLAINT_FIELDS) + ";\n"
    row = "2021;1º;Top 10;Conglomerado; ;BANCO X (conglomerado);16.699,13;1;2;3;6; ;10;20;\n"
    write_file(f"{d}/2021_tri_01.csv", header + row * 3)
    df = S.read_delimited(spark, d, sep=";", schema=SC.all_string_schema(SC.COMPLAINT_FIELDS))
    assert df.count() == 3
    r = df.first()
    assert r["CNPJ IF"] == " " and r["Índice"] == "16.699,13" and r["Quantidade de clientes  SCR"] == "20"


def test_pipe_crlf_and_header_per_file(spark, scratch):  # S2, S4, T7
    d = scratch("emp")
    fields = SC.EMPLOYER_FIELDS
    row1 = ["BANCO A"] + [""] * 19 + ["S1", "BANCO A", "100"]
    row2 = ["BANCO Z"] + [""] * 19 + ["12345678", "BANCO Z", "90"]
    write_file(f"{d}/a.csv", "|".join(fields) + "\n" + "|".join(row1) + "\n", "\r\n")
    other = fields[:20] + ["CNPJ"] + fields[21:]
    write_file(f"{d}/b.csv", "|".join(other) + "\n" + "|".join(row2) + "\n", "\r\n")
    df = S.read_delimited(spark, d, sep="|", schema=SC.all_string_schema(SC.EMPLOYER_FIELDS))
    got = sorted((r.Segmento, r.match_percent) for r in df.collect())
    assert got == [("12345678", "90"), ("S1", "100")]  # headers dropped, no '\r' left
    assert df.filter(F.col("Segmento").startswith("S")).count() == 1


def test_headerless_read_keeps_all_lines(spark, scratch):  # T21
    d = scratch("nohdr")
    write_file(f"{d}/x.tsv", "S1\t1\tA\nS2\t2\tB\n")
    assert S.read_delimited(spark, d, sep="\t", schema=SC.all_string_schema(SC.BANK_FIELDS), header=False).count() == 2


def test_recursive_read_with_overrides(spark, scratch):  # S5
    d = scratch("rec")
    write_file(f"{d}/anomesdia=20230814/t.csv", "id;v\n1;2.5\n2;3.0\n")
    write_file(f"{d}/anomesdia=20230815/t.csv", "id;v\n3;1.0\n")
    write_file(f"{d}/anomesdia=20230815/notes.txt", "not;csv\nx;y\n")
    df = S.read_csv_recursive(spark, d, overrides={"id": "bigint"})
    assert df.columns == ["id", "v"] and dict(df.dtypes)["id"] == "bigint"
    assert df.count() == 3


def test_nonempty_listing_skips_empty(spark, scratch):  # S6
    d = scratch("files")
    write_file(f"{d}/a.csv", "x\n1\n")
    sinks.touch_empty(spark, f"{d}/empty.csv")
    paths = [r.path for r in S.list_nonempty_files(spark, d).collect()]
    assert len(paths) == 1 and paths[0].endswith("a.csv")


def test_overwrite_scopes(spark, scratch):  # K1, K2, T15
    for scope, expected in (("partitions", {("a", "v2"), ("b", "v1")}), ("table", {("a", "v2")})):
        d = scratch("ow")
        first = spark.createDataFrame([("a", "v1"), ("b", "v1")], "p string, ver string")
        sinks.write_partitioned(first, d, by="p", fmt="csv", overwrite=scope)
        second = spark.createDataFrame([("a", "v2")], "p string, ver string")
        sinks.write_partitioned(second, d, by="p", fmt="csv", overwrite=scope)
        back = spark.read.option("sep", ";").option("header", True).csv(d)
        assert {(r.p, r.ver) for r in back.collect()} == expected


def test_repair_registers_partitions(spark, scratch):  # K5
    d = scratch("repair")
    sinks.create_table(spark, "t_repair", d, "v int, p string", by=["p"])
    sinks.write_partitioned(spark.createDataFrame([(1, "a"), (2, "b")], "v int, p string"), d,
                            by="p")
    assert spark.read.table("t_repair").count() == 0
    sinks.repair_table(spark, "t_repair")
    assert spark.read.table("t_repair").count() == 2
    assert S.read_table(spark, "t_repair", ["v"]).columns == ["v"]


def test_report_csv_and_metric_append(spark, scratch):  # K8, K9, S9
    d = scratch("rep")
    df = spark.createDataFrame([("X", 1.5)], "n string, v double")
    path = sinks.write_report_csv(df, d, "2023-08-14")
    assert path.endswith("anomesdia=20230814")
    assert S.read_delimited(spark, path, sep=";").first().n == "X"
    m = scratch("dq")
    for _ in range(2):
        sinks.append_metrics(df.select(F.lit("Size").alias("name")), m, "tb_x", "2023-08-14")
    back = spark.read.parquet(m)
    assert back.count() == 2 and set(back.columns) >= {"dat_hor_psst", "anomesdia", "nom_tab"}


def test_rebalanced_write_plan(spark, scratch):  # K4
    d = scratch("reb")
    df = spark.range(1000).withColumn("p", (F.col("id") % 3).cast("string"))
    sinks.write_partitioned(df, d, by="p", max_records_per_file=200)
    assert spark.read.parquet(d).count() == 1000
    files = [f for _, _, fs in os.walk(local_dir(d)) for f in fs if f.endswith(".parquet")]
    assert len(files) >= 6  # 3 partitions x >= 2 files (record cap)


def test_charset_spellings():  # T9
    from strata.sources.files import normalize_charset
    assert normalize_charset("ISO 8859-1") == "ISO-8859-1"
    assert normalize_charset("iso-8859-1") == "ISO-8859-1"
    assert normalize_charset("utf-8") == "UTF-8"


def test_multiline_quoted_field(spark, scratch):
    d = scratch("multi")
    write_file(f"{d}/m.csv", 'Segmento;CNPJ;Nome\nS1;1;"BANCO\nDOIS"\n')
    rows = S.read_delimited(spark, d, sep=";", schema=SC.all_string_schema(SC.BANK_FIELDS), multiline=True).collect()
    assert len(rows) == 1 and rows[0].Nome == "BANCO\nDOIS"


def test_report_is_one_file_only_on_request(spark, scratch):  # K8
    for files in (None, 1):
        path = sinks.write_report_csv(spark.range(1000).repartition(4), scratch("report"), "2023-08-14", files=files)
        found = [f for f in os.listdir(local_dir(path)) if f.endswith(".csv")]
        assert found and (files is None or len(found) == 1)
        assert S.read_delimited(spark, path, sep=";").count() == 1000


def test_failed_publish_brings_the_table_back(spark, scratch):
    root = scratch("publish")
    spark.range(3).write.parquet(f"{root}/target")
    with pytest.raises(Exception):
        sinks.publish_staged(spark, f"{root}/never-written", f"{root}/target", [])
    assert spark.read.parquet(f"{root}/target").count() == 3


def test_publish_after_a_crash_between_the_moves(spark, scratch):
    root = scratch("crash")
    spark.range(3).write.parquet(f"{root}/_aside.target")  # the published table, set aside
    with pytest.raises(Exception):
        sinks.publish_staged(spark, f"{root}/never-written", f"{root}/target", [])
    assert spark.read.parquet(f"{root}/target").count() == 3
    spark.range(5).write.parquet(f"{root}/staged")
    sinks.publish_staged(spark, f"{root}/staged", f"{root}/target", [])
    assert spark.read.parquet(f"{root}/target").count() == 5
    assert not os.path.exists(local_dir(f"{root}/_aside.target"))


def test_lines_with_other_field_counts_are_rejected(spark, scratch):
    """Quoted separators do not count, a closing separator is allowed, whatever columns are read."""
    d = scratch("checked")
    write_file(f"{d}/a.csv", 'x;y;z\n1;2;3\n4;5;6;\n7;8\n\n9;10;11;12\n"a;b";c;d\n;;\n1;2;3;;\n')
    write_file(f"{d}/b.csv", "x;y;z;\n5;;\n")
    schema = SC.all_string_schema(["x y", "line", "again"])
    rows, rejected = S.read_delimited_checked(spark, d, schema)
    got = sorted(map(tuple, rows.collect()), key=str)
    assert got == sorted([("1", "2", "3"), ("4", "5", "6"), ("a;b", "c", "d"), (None, None, None), ("5", None, None)], key=str)
    assert sorted(r.line for r in rejected.collect()) == ["1;2;3;;", "7;8", "9;10;11;12"]
    assert {r.path.rsplit("/", 1)[1] for r in rejected.collect()} == {"a.csv"}
    assert rows.count() == 5 and rejected.count() == 3 and rows.select("again").where("again = '6'").count() == 1
    bare = scratch("checked_header_only")
    write_file(f"{bare}/a.csv", "x;y;z\n")
    rows, rejected = S.read_delimited_checked(spark, bare, schema)
    assert rows.isEmpty() and rejected.isEmpty()
