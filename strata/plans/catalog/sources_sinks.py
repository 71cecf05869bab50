"""Sources and sinks: write derived data to a fresh folder below the shared checkpoint
root, read it back with the library readers."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata import sinks
from strata import sources as S
from strata.functions import columns as C
from strata.operators import projection as P
from strata.operators import quality as Q
from strata.plans import derive
from strata.session import scratch_path
from strata.plans.catalog._base import register
from strata.plans.catalog.reports import SQL_FLAGSHIP, flagship_report
from strata.plans.catalog.cleaning import _RAW_COMPLAINT_SQL, _raw_complaints
from strata.plans.catalog.quality import _DQ_SRC_SQL, _dq_source


@register("csv_roundtrip", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def csv_roundtrip(spark, sf_dir):
    """Tab-separated with header, fixed all-string schema, typed back by a spec."""
    path = scratch_path(spark, "csv_roundtrip")
    sinks.write_partitioned(derive.table(spark, sf_dir, "supplier"), path, fmt="csv", sep="\t")
    cols = ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"]
    raw = S.read_delimited(spark, path, sep="\t",
                           schema=T.StructType([T.StructField(c, T.StringType()) for c in cols]))
    return P.apply_spec(raw, [("s_suppkey", "s_suppkey", "bigint"), ("s_name", "s_name", "string"),
                              ("s_nationkey", "s_nationkey", "int"),
                              ("s_acctbal", "s_acctbal", "double")])


def _typed_back(spark, path, like, sep):
    """All-text read of ``path``, cast to the types of ``like``."""
    raw = S.read_delimited(spark, path, sep=sep, schema=T.StructType(
        [T.StructField(n, T.StringType()) for n in like.columns]))
    return raw.select(*[F.col(n).cast(kind).alias(n) for n, kind in like.dtypes])


@register("csv_pipe_roundtrip", "SELECT * FROM customer")
def csv_pipe_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "csv_pipe")
    c = derive.table(spark, sf_dir, "customer")
    sinks.write_partitioned(c, path, fmt="csv", sep="|")
    return _typed_back(spark, path, c, "|")


@register("csv_trailing_field", f"""WITH raw AS ({_RAW_COMPLAINT_SQL})
SELECT "Ano" AS ano_text, "CNPJ IF" AS cnpj_text, "Instituição financeira" AS nome
FROM raw""")
def csv_trailing_field(spark, sf_dir):
    """Semicolon lines ending with an empty extra field, read with the named fields
    only in PERMISSIVE mode: every line is kept."""
    path = scratch_path(spark, "csv_trailing")
    raw = _raw_complaints(spark, sf_dir).select(
        "Ano", "CNPJ IF", "Instituição financeira", F.lit("").alias("_trailing"))
    sinks.write_partitioned(raw, path, fmt="csv", sep=";", empty_value="",
                            header=True)
    schema = T.StructType([T.StructField(n, T.StringType())
                           for n in ["Ano", "CNPJ IF", "Instituição financeira"]])
    back = S.read_delimited(spark, path, sep=";", schema=schema, encoding="UTF-8")
    return back.select(F.col("Ano").alias("ano_text"),
                       F.coalesce(F.col("`CNPJ IF`"), F.lit(" ")).alias("cnpj_text"),
                       F.col("`Instituição financeira`").alias("nome"))


@register("rejected_lines", """SELECT 'kept' AS place, l_orderkey || '|' || l_partkey || '|' || l_suppkey AS line, count(*) AS n
FROM lineitem WHERE l_linenumber NOT IN (2, 3) GROUP BY ALL
UNION ALL SELECT 'rejected', l_orderkey || ';' || l_partkey || CASE l_linenumber WHEN 2 THEN ';' || l_suppkey || ';x' ELSE '' END,
       count(*) FROM lineitem WHERE l_linenumber IN (2, 3) GROUP BY ALL""")
def rejected_lines(spark, sf_dir):
    """Semicolon lines, one per line item: with a closing separator (line 1), a surplus field (2) or a
    missing one (3). Rows that were read, and rejected lines as they stand in the files."""
    path = scratch_path(spark, "rejected_lines")
    number = F.col("l_linenumber")
    line = F.concat(F.concat_ws(";", "l_orderkey", "l_partkey"),
                    F.when(number != 3, F.concat(F.lit(";"), F.col("l_suppkey").cast("string"))).otherwise(F.lit("")),
                    F.when(number == 1, F.lit(";")).when(number == 2, F.lit(";x")).otherwise(F.lit("")))
    derive.table(spark, sf_dir, "lineitem").select(line.alias("value")).write.text(path)
    schema = T.StructType([T.StructField(n, T.StringType()) for n in ("order", "part", "supplier")])
    rows, rejected = S.read_delimited_checked(spark, path, schema, header=False)
    both = (rows.select(F.lit("kept").alias("place"), F.concat_ws("|", "order", "part", "supplier").alias("line"))
            .unionByName(rejected.select(F.lit("rejected").alias("place"), "line")))
    return both.groupBy("place", "line").agg(F.count(F.lit(1)).alias("n"))


@register("csv_directory", "SELECT * FROM orders")
def csv_directory(spark, sf_dir):
    """Many files with one header each, read as one table."""
    path = scratch_path(spark, "csv_dir")
    o = derive.table(spark, sf_dir, "orders")
    sinks.write_partitioned(o.repartition(7), path, fmt="csv", sep=";", layout="none")
    return _typed_back(spark, path, o, ";")


@register("csv_recursive", "SELECT * EXCLUDE (l_returnflag) FROM lineitem")
def csv_recursive(spark, sf_dir):
    """Partitioned CSV tree read recursively with inference; the partition column
    (l_returnflag) is not turned into a column; keys overridden to bigint."""
    path = scratch_path(spark, "csv_recursive")
    sinks.write_partitioned(derive.table(spark, sf_dir, "lineitem"), path, by="l_returnflag", fmt="csv", sep=";")
    keys = ("l_orderkey", "l_partkey", "l_suppkey")
    return S.read_csv_recursive(spark, path, sep=";", overrides=dict.fromkeys(keys, "bigint"))


@register("nonempty_files", "SELECT count(*) AS n_rows, true AS saw_empty_file FROM nation")
def nonempty_files(spark, sf_dir):
    path = scratch_path(spark, "nonempty")
    sinks.write_partitioned(derive.table(spark, sf_dir, "nation").repartition(3), path,
                            fmt="csv", sep=";", layout="none")
    empty = f"{path}/empty-landing.csv"
    sinks.touch_empty(spark, empty)
    kept = S.list_nonempty_files(spark, path, glob="*.csv")
    listing = kept.agg(
        F.count(F.lit(1)).alias("n_kept"),
        F.coalesce(F.sum(F.col("path").endswith("empty-landing.csv").cast("int")), F.lit(0))
        .alias("n_empty_listed")).first()  # file metadata only: one row
    saw_empty = (S.path_length(spark, empty) == 0 and listing.n_kept > 0
                 and listing.n_empty_listed == 0)
    rows = S.read_delimited(spark, path, sep=";").agg(F.count(F.lit(1)).alias("n_rows"))
    return rows.select("n_rows", F.lit(saw_empty).alias("saw_empty_file"))


@register("read_table", "SELECT p_partkey, p_name, p_size FROM part")
def read_table(spark, sf_dir):
    path = scratch_path(spark, "read_table")
    sinks.write_partitioned(derive.table(spark, sf_dir, "part"), path, fmt="parquet")
    name = "strata_part_" + path.rsplit("-", 1)[-1]
    sinks.create_table(spark, name, path,
                       "p_partkey bigint, p_name string, p_brand string, p_type string, "
                       "p_size int, p_retailprice double")
    back = scratch_path(spark, "read_back")
    S.read_table(spark, name, ["p_partkey", "p_name", "p_size"]).write.parquet(back)
    spark.sql(f"DROP TABLE {name}")  # an external table: its files stay
    return spark.read.parquet(back)


_ORDERS_PART_SQL = """SELECT *,
  CAST(year(o_orderdate) AS VARCHAR) ||
  CASE quarter(o_orderdate) WHEN 1 THEN '03' WHEN 2 THEN '06' WHEN 3 THEN '09' ELSE '12' END
  || '01' AS anomesdia
FROM orders"""


def _orders_with_partition(spark, sf_dir):
    o = derive.table(spark, sf_dir, "orders")
    return o.withColumn("anomesdia", C.quarter_partition(F.year("o_orderdate"),
                                                         F.quarter("o_orderdate").cast("string")))


@register("parquet_partitioned", _ORDERS_PART_SQL)
def parquet_partitioned(spark, sf_dir):
    path = scratch_path(spark, "parquet_part")
    df = _orders_with_partition(spark, sf_dir)
    sinks.write_partitioned(df, path, by="anomesdia", fmt="parquet", overwrite="table")
    return spark.read.schema(df.schema).parquet(path)


@register("parquet_multi_part", """SELECT *, CAST(year(o_orderdate) AS INTEGER) AS ano,
       CAST(quarter(o_orderdate) AS INTEGER) AS num_trimestre FROM orders""")
def parquet_multi_part(spark, sf_dir):
    path = scratch_path(spark, "parquet_multi")
    o = derive.table(spark, sf_dir, "orders").withColumns(
        {"ano": F.year("o_orderdate"), "num_trimestre": F.quarter("o_orderdate")})
    sinks.write_partitioned(o, path, by=["ano", "num_trimestre"], fmt="parquet")
    return spark.read.schema(o.schema).parquet(path)


def _overwrite(spark, sf_dir, scope):
    path = scratch_path(spark, f"overwrite_{scope}")
    o = derive.table(spark, sf_dir, "orders")
    o = o.select(*[c for c in o.columns if c != "o_orderstatus"], "o_orderstatus")
    sinks.write_partitioned(o.withColumn("version", F.lit("v1")), path, by="o_orderstatus",
                            fmt="csv", sep=";", overwrite=scope)
    second = o.filter(F.col("o_orderstatus") == "F").withColumn("version", F.lit("v2"))
    sinks.write_partitioned(second, path, by="o_orderstatus", fmt="csv", sep=";",
                            overwrite=scope)
    schema = T.StructType([f for f in o.schema if f.name != "o_orderstatus"]) \
        .add("version", "string").add("o_orderstatus", "string")
    return spark.read.schema(schema).option("sep", ";").option("header", True).csv(path)


@register("overwrite_partitions", """SELECT *,
  CASE WHEN o_orderstatus = 'F' THEN 'v2' ELSE 'v1' END AS version FROM orders""")
def overwrite_partitions(spark, sf_dir):
    """Dynamic overwrite: only the partition present in the second batch is replaced."""
    return _overwrite(spark, sf_dir, "partitions")


@register("overwrite_table", """SELECT *, 'v2' AS version FROM orders
WHERE o_orderstatus = 'F'""")
def overwrite_table(spark, sf_dir):
    """Static overwrite: the second batch replaces the whole table."""
    return _overwrite(spark, sf_dir, "table")


@register("repair_table", "SELECT *, 0 AS n_rows_before FROM orders")
def repair_table(spark, sf_dir):
    """Partitions written behind the catalog's back are seen after the repair only."""
    path = scratch_path(spark, "repair")
    o = derive.table(spark, sf_dir, "orders")
    name = "strata_orders_" + path.rsplit("-", 1)[-1]
    sinks.create_table(spark, name, path, ", ".join(f"{n} {kind}" for n, kind in o.dtypes),
                       by=["o_orderstatus"])
    sinks.write_partitioned(o, path, by="o_orderstatus", fmt="parquet")
    before = spark.read.table(name).count()
    sinks.repair_table(spark, name)
    back = scratch_path(spark, "repaired")
    spark.read.table(name).withColumn("n_rows_before", F.lit(before)).write.parquet(back)
    spark.sql(f"DROP TABLE {name}")  # an external table: its files stay
    return spark.read.parquet(back)


@register("report_csv", SQL_FLAGSHIP)
def report_csv(spark, sf_dir):
    """Report written as one CSV with header below anomesdia=..., read back (S9)."""
    from strata.schemas import report_spec
    root = scratch_path(spark, "report_csv")
    rep = flagship_report(spark, sf_dir)
    path = sinks.write_report_csv(rep, root, "2023-08-14")
    names = [t for _, t, _ in report_spec("snapshot")]
    raw = S.read_delimited(spark, path, sep=";", schema=T.StructType(
        [T.StructField(n, T.StringType()) for n in names]))
    return P.apply_spec(raw, [(t, t, ty) for _, t, ty in report_spec("snapshot")])


@register("metrics_append", f"""WITH src AS ({_DQ_SRC_SQL}),
m AS (
  SELECT 'Size' AS name, '*' AS instance, count(*) * 1.0 AS value FROM src
  UNION ALL SELECT 'Completeness', 'price', count(price) / count(*) FROM src
  UNION ALL SELECT 'Mean', 'price', avg(price) FROM src)
SELECT name, instance, round(value, 6) AS value, CAST(2 AS BIGINT) AS n_runs, 'tb_orders' AS nom_tab,
       '20230814' AS anomesdia FROM m""")
def metrics_append(spark, sf_dir):
    """Two runs append metrics under the same date/table partition."""
    root = scratch_path(spark, "metrics")
    src = _dq_source(spark, sf_dir)
    for _ in range(2):
        m = Q.analyze(src, [Q.Size(), Q.Completeness("price"), Q.Mean("price")])
        sinks.append_metrics(m, root, "tb_orders", "2023-08-14")
    back = spark.read.option("basePath", root).schema(
        "entity string, instance string, name string, value double, dat_hor_psst timestamp, "
        "anomesdia string, nom_tab string").parquet(root)
    return back.groupBy("name", "instance", "nom_tab", "anomesdia").agg(
        F.round(F.max("value"), 6).alias("value"), F.count(F.lit(1)).alias("n_runs"))


@register("write_files", "SELECT * FROM lineitem")
def write_files(spark, sf_dir):
    """Default layout (rebalance, AQE-sized files) with a per-file row cap."""
    path = scratch_path(spark, "write_files")
    sinks.write_partitioned(derive.table(spark, sf_dir, "lineitem"), path, fmt="parquet", max_records_per_file=20000)
    return spark.read.parquet(path)
