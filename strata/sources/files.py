"""Readers: delimited text with a fixed schema, recursive CSV with inference, file
listings, and catalog tables. All return lazy DataFrames; Spark splits large files
across tasks (``spark.sql.files.maxPartitionBytes``) and prunes unread columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.columns import col_ref, safe_cast


def normalize_charset(name: str) -> str:
    """Java charset name for common spellings (``'ISO 8859-1'`` -> ``'ISO-8859-1'``)."""
    n = name.strip().upper().replace("_", "-")
    if n.startswith("ISO") and not n.startswith("ISO-"):
        n = "ISO-" + n[3:].lstrip(" -")
    return n.replace(" ", "-")


def read_delimited(spark: SparkSession, path: str | list[str], sep: str = ";",
                   schema: T.StructType | None = None, header: bool = True,
                   encoding: str = "UTF-8", mode: str = "PERMISSIVE",
                   recursive: bool = False, multiline: bool = False) -> DataFrame:
    """Delimited text (tab, pipe, semicolon ...). ``path`` may be a file, a directory
    of files (every file's header line is skipped) or a list of paths.

    Without ``schema`` every field is read as a string (no inference pass).
    ``PERMISSIVE`` keeps lines with extra trailing fields (the extra tokens are
    ignored) and fills missing ones with NULL. A headerless read keeps every line.
    ``multiline=True`` allows line breaks inside quoted fields (each file is then
    parsed by one task, so keep it off for large single files).
    """
    reader = (spark.read.option("sep", sep).option("header", header)
              .option("encoding", normalize_charset(encoding)).option("mode", mode)
              .option("inferSchema", False))
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    if multiline:
        reader = reader.option("multiLine", True)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def read_delimited_checked(spark: SparkSession, path: str | list[str], schema: T.StructType, sep: str = ";",
                           header: bool = True, encoding: str = "UTF-8") -> tuple[DataFrame, DataFrame]:
    """Rows of the lines that have the fields of ``schema`` (all strings), and the other lines.

    :func:`read_delimited` drops surplus fields and fills missing ones with NULL without a word. Here a
    line has to have exactly these fields; one more is allowed if it is empty (a closing separator).
    Every other line is a row ``path, line`` of the second frame, as it was read. Quoted separators
    do not count. Both frames read the same files, the first line of each left out with ``header``;
    blank lines are skipped. Lines with a closing separator are parsed a second time.
    """
    names = [f"c{i}" for i in range(len(schema.fields))]
    first = T.StructType([*(T.StructField(n, T.StringType()) for n in names), T.StructField("line", T.StringType())])
    # without pruning a line's fields are counted whatever columns are selected
    raw = (spark.read.option("sep", sep).option("header", header).option("encoding", normalize_charset(encoding))
           .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "line").option("columnPruning", False)
           .option("enforceSchema", True).schema(first).csv(path))
    longer = ", ".join(f"{n} string" for n in [*names, "surplus", "bad"])
    again = raw.withColumns({"again": F.from_csv("line", longer, {"sep": sep, "mode": "PERMISSIVE",
                                                                  "columnNameOfCorruptRecord": "bad"}),
                             "path": F.col("_metadata.file_path")})
    # Spark refuses a scan of which only the line is read; so the first field takes part
    closed = (F.col("again.bad").isNull() & F.col("again.surplus").isNull()
              & F.col("again.c0").eqNullSafe(F.col("c0")))
    rows = again.where(F.col("line").isNull() | closed).select(*[
        F.when(F.col("line").isNull(), F.col(n)).otherwise(F.col(f"again.{n}")).alias(f.name)
        for n, f in zip(names, schema.fields)])
    return rows, again.where(F.col("line").isNotNull() & ~closed).select("path", "line")


def read_csv_recursive(spark: SparkSession, root: str, sep: str = ";", header: bool = True,
                       overrides: dict[str, str] | None = None,
                       sampling_ratio: float = 1.0, glob: str | None = "*.csv") -> DataFrame:
    """Every ``glob`` file below ``root`` as one table, types inferred
    (``sampling_ratio`` of the rows is read for the inference pass: the inference is
    an extra scan, so lower it on large inputs), ``overrides`` = {column: type} applied
    with the tolerant cast. Partition directories are NOT turned into columns."""
    reader = (spark.read.option("sep", sep).option("header", header)
              .option("inferSchema", True).option("samplingRatio", sampling_ratio)
              .option("recursiveFileLookup", True))
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    df = reader.csv(root)
    if overrides:
        lower = {k.lower(): v for k, v in overrides.items()}
        types = {f.name: f.dataType for f in df.schema.fields}
        df = df.select(*[
            safe_cast(c, lower[c.lower()], isinstance(types[c], T.StringType)).alias(c)
            if c.lower() in lower else col_ref(c) for c in df.columns])
    return df


def list_nonempty_files(spark: SparkSession, root: str, glob: str | None = None) -> DataFrame:
    """``path, length, modificationTime`` of the files below ``root`` with length > 0.
    Only file metadata is read: the ``content`` column is pruned from the scan."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    files = reader.load(root).select("path", "length", "modificationTime")
    return files.filter(F.col("length") > 0)


def path_length(spark: SparkSession, path: str) -> int | None:
    """Byte length of one file through its Hadoop file system (None if absent)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.getFileStatus(hpath).getLen() if fs.exists(hpath) else None


def read_table(spark: SparkSession, name: str, columns: list[str] | None = None) -> DataFrame:
    """Catalog table, optionally pruned to ``columns`` (only those reach the scan)."""
    df = spark.read.table(name)
    return df.select(*[col_ref(c) for c in columns]) if columns else df
