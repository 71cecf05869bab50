"""Writers: partitioned Parquet / CSV with a chosen overwrite scope, catalog
registration and repair, single-file reports, JDBC, and metric appends.

File layout (``layout``):
  ``'auto'``      rebalance when there are partition columns, else write as is;
  ``'rebalance'`` REBALANCE hint on the partition columns: AQE cuts every output
                  partition into tasks of the advisory size
                  (``spark.sql.adaptive.advisoryPartitionSizeInBytes``) and splits a
                  skewed value across several tasks, so one hot date never lands in
                  one task and no directory gets one small file per input task;
  ``'none'``      no shuffle: each task writes its own files (right when every row
                  goes to the same partition, e.g. a constant run date).
``files=n`` coalesces to n tasks instead, only for small outputs.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.columns import col_ref, ref_date_text, with_load_ts


def _layout(df: DataFrame, by: list[str], layout: str, files: int | None) -> DataFrame:
    if files:
        return df.coalesce(files)
    if layout == "auto":
        layout = "rebalance" if by else "none"
    if layout == "rebalance":
        return df.hint("rebalance", *by) if by else df.hint("rebalance")
    if layout == "none":
        return df
    raise ValueError(f"layout must be auto|rebalance|none, got {layout!r}")


def write_partitioned(df: DataFrame, path: str, by: str | list[str] | None = None,
                      fmt: str = "parquet", overwrite: str = "table", mode: str = "overwrite",
                      sep: str = ";", header: bool = True, compression: str | None = None,
                      layout: str = "auto", files: int | None = None,
                      max_records_per_file: int | None = None,
                      empty_value: str | None = None,
                    observe: Callable[[DataFrame], DataFrame] | None = None) -> str:
    """Write ``df`` below ``path`` in Hive layout (``col=value`` directories).

    overwrite: ``'table'`` replaces everything under ``path``; ``'partitions'``
    replaces only the partition directories present in ``df`` (dynamic overwrite).
    observe: adds an observation to the frame as it is written, above its layout.
    """
    by = [by] if isinstance(by, str) else list(by or [])
    laid = _layout(df, by, layout, files)
    writer = (observe(laid) if observe else laid).write.mode(mode)
    if mode == "overwrite":
        writer = writer.option("partitionOverwriteMode",
                               "dynamic" if overwrite == "partitions" else "static")
    if by:
        writer = writer.partitionBy(*by)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    if compression == "gzip":  # quick: the text shrinks to a quarter, at the default level to a fifth
        writer = writer.option("zlib.compress.level", "BEST_SPEED")
    if fmt == "parquet":
        writer.parquet(path, compression=compression or "snappy")
    elif fmt == "csv":
        # keep values byte-exact: a blank field stays ' ' (Spark trims on write by default)
        writer = (writer.option("sep", sep).option("header", header)
                  .option("ignoreLeadingWhiteSpace", False)
                  .option("ignoreTrailingWhiteSpace", False))
        if empty_value is not None:
            writer = writer.option("emptyValue", empty_value)
        if compression:
            writer = writer.option("compression", compression)
        writer.csv(path)
    else:
        writer.format(fmt).save(path)
    return path


def create_table(spark: SparkSession, name: str, path: str, schema_ddl: str,
                 by: list[str] | None = None, fmt: str = "parquet",
                 options: dict | None = None) -> None:
    """Register an external table over ``path`` (no data is moved)."""
    make_dirs(spark, path)
    part = f" PARTITIONED BY ({', '.join(by)})" if by else ""
    opts = ""
    if options:
        opts = " OPTIONS (" + ", ".join(f"'{k}' '{v}'" for k, v in options.items()) + ")"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({schema_ddl}) USING {fmt}{opts}{part} "
              f"LOCATION '{path}'")


def repair_table(spark: SparkSession, name: str) -> None:
    """Register partition directories written since the last repair."""
    spark.sql(f"MSCK REPAIR TABLE {name}")


def add_partition(spark: SparkSession, name: str, spec: dict[str, str]) -> None:
    """Register one known partition (cheaper than a full repair)."""
    kv = ", ".join(f"{k}='{v}'" for k, v in spec.items())
    spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS PARTITION ({kv})")


def write_report_csv(df: DataFrame, root: str, ref_date: _dt.date | str | None = None,
                     sep: str = ";", files: int | None = None) -> str:
    """CSV report with header below ``root/anomesdia=<date>/``.

    Written as rebalanced files of the advisory size whatever the row count. ``files=1``
    asks for the one file of a small report, which one task then writes.
    """
    path = f"{root.rstrip('/')}/anomesdia={ref_date_text(ref_date)}"
    _layout(df, [], "rebalance", files).write.mode("overwrite") \
        .option("sep", sep).option("header", True).csv(path)
    return path


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict,
               mode: str = "append", batch_size: int = 10000,
               num_partitions: int | None = None) -> None:
    """Relational sink. Each task opens its own connection; ``num_partitions`` caps the
    number of concurrent connections the database receives."""
    out = df.coalesce(num_partitions) if num_partitions else df
    props = dict(properties)
    props.setdefault("batchsize", str(batch_size))
    out.write.jdbc(url=url, table=table, mode=mode, properties=props)


def export_table(spark: SparkSession, source_table: str, url: str, table: str,
                 properties: dict, mode: str = "append") -> None:
    """Copy a catalog table unchanged into a database table."""
    write_jdbc(spark.read.table(source_table), url, table, properties, mode=mode)


def append_metrics(metrics: DataFrame, root: str, table_name: str,
                   ref_date: _dt.date | str | None = None, stamp: bool = True,
                   run_id: str | None = None) -> str:
    """Metric rows below ``root/anomesdia=<date>/nom_tab=<table>/run_id=<run>/``.

    A run id that is written again replaces its own rows, so a repeated load leaves each
    metric once; without one every call is a run of its own.
    """
    out = with_load_ts(metrics) if stamp else metrics
    out = out.withColumn("anomesdia", F.lit(ref_date_text(ref_date))) \
             .withColumn("nom_tab", F.lit(table_name)) \
             .withColumn("run_id", F.lit(run_id or uuid.uuid4().hex))
    write_partitioned(out, root, by=["anomesdia", "nom_tab", "run_id"], overwrite="partitions", files=1)
    return root


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath, hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def make_dirs(spark: SparkSession, path: str) -> None:
    """Create ``path`` (and parents) through its Hadoop file system."""
    hpath, fs = _fs(spark, path)
    fs.mkdirs(hpath)


def touch_empty(spark: SparkSession, path: str) -> None:
    """Create a zero-byte file through the Hadoop file system of ``path``."""
    hpath, fs = _fs(spark, path)
    fs.create(hpath, True).close()


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below ``path`` (none if it does not exist)."""
    hpath, fs = _fs(spark, path)
    return sorted(st.getPath().getName() for st in fs.listStatus(hpath)) if fs.exists(hpath) else []


def remove_file(spark: SparkSession, path: str) -> None:
    hpath, fs = _fs(spark, path)
    fs.delete(hpath, False)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete ``path`` with all below it through its Hadoop file system."""
    hpath, fs = _fs(spark, path)
    fs.delete(hpath, True)


def _leaf_partitions(fs, root_path, depth: int) -> list:
    """``col=value`` directories ``depth`` levels below ``root_path``."""
    level = [root_path]
    for _ in range(depth):
        nxt = []
        for p in level:
            for st in fs.listStatus(p):
                if st.isDirectory() and "=" in st.getPath().getName():
                    nxt.append(st.getPath())
        level = nxt
    return level


def partition_filter(by: list[str], rows: list) -> Column:
    """Rows of the named partitions (NULL is a value): a filter on partition columns alone, so
    other folders are neither listed nor read."""
    def one(row) -> Column:
        return reduce(lambda a, b: a & b, [col_ref(c).eqNullSafe(F.lit(v)) for c, v in zip(by, row)])
    return reduce(lambda a, b: a | b, [one(row) for row in rows], F.lit(False))


def partition_folder(by: list[str], row) -> str:
    """``a=1/b=2`` for a partition of numbers or plain words."""
    return "/".join(f"{c}={'__HIVE_DEFAULT_PARTITION__' if v is None else v}" for c, v in zip(by, row))


def list_partitions(spark: SparkSession, root: str, depth: int) -> list[str]:
    """Folders of the partitions below ``root``, as :func:`partition_folder` names them."""
    hpath, fs = _fs(spark, root)
    if not fs.exists(hpath):
        return []
    return [p.toUri().getPath()[len(hpath.toUri().getPath().rstrip("/")) + 1:] for p in _leaf_partitions(fs, hpath, depth)]


def drop_partitions(spark: SparkSession, root: str, folders: list[str]) -> None:
    for folder in folders:
        remove_folder(spark, f"{root}/{folder}")


def publish_staged(spark: SparkSession, staging: str, target: str, by: list[str],
                   overwrite: str = "table") -> str:
    """Move a staged (already written and checked) table into place.

    Same file system: directory renames only (metadata, no data copied).
    ``overwrite='table'`` replaces ``target``; ``'partitions'`` replaces only the
    partition directories present in the staged output. Different file systems:
    the staged Parquet is rewritten to ``target`` (a plain scan, no recomputation).
    """
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    src = jvm.org.apache.hadoop.fs.Path(staging)
    dst = jvm.org.apache.hadoop.fs.Path(target)
    src_fs, dst_fs = src.getFileSystem(conf), dst.getFileSystem(conf)
    if src_fs.getUri().toString() != dst_fs.getUri().toString():
        staged = spark.read.parquet(staging)
        write_partitioned(staged, target, by=by, fmt="parquet", overwrite=overwrite)
        return target
    if overwrite == "table" or not by:
        _swap(dst_fs, src, dst)
        return target
    dst_fs.mkdirs(dst)
    root_len = len(src.toUri().getPath().rstrip("/")) + 1
    for part in _leaf_partitions(src_fs, src, len(by)):
        rel = part.toUri().getPath()[root_len:]
        _swap(dst_fs, part, jvm.org.apache.hadoop.fs.Path(dst, rel))
    return target


def _swap(fs, new, goal) -> None:
    """Put the folder ``new`` in the place of ``goal``.

    The published folder is set aside under a name that readers skip, and goes only when
    the new one stands. If the move fails it comes back; if the process dies in between,
    the next publish of the same place finds it there and puts it back first.
    """
    aside = goal.getParent().suffix(f"/_aside.{goal.getName()}")
    if fs.exists(aside):
        if fs.exists(goal):
            fs.delete(aside, True)
        else:
            fs.rename(aside, goal)
    fs.mkdirs(goal.getParent())
    had = fs.exists(goal) and fs.rename(goal, aside)
    moved = False
    try:
        moved = fs.rename(new, goal)
    finally:
        if had and not moved:
            fs.rename(aside, goal)
    if not moved:
        raise OSError(f"could not move {new} to {goal}")
    if had:
        fs.delete(aside, True)
