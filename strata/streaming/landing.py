"""Incremental landing-folder ingestion with Structured Streaming.

A file arriving in the landing folder starts the raw (SoR) load of its dataset. The
stream itself only discovers files: a ``binaryFile`` source of which path and length are
read, never the content. The dataset is chosen from the path (first matching pattern
wins) and empty files are left out. Each micro-batch then loads its files with the same
batch reader as the scheduled jobs (``plans.jobs.sor_frame``), so headers, blank lines,
quoting and charsets mean the same on both ways, and adds them to the dataset's SoR folder.

A file that no pattern matches stops the stream before its batch writes anything, unless a
quarantine folder is given, which then receives its lines.

A file that is delivered again under another name is dropped: the stream keeps the digests of
the contents it has taken, per dataset, in its state store. Files above ``digest_limit`` are told
apart by path alone, as their content is not read into one row.

Raw complaints are partitioned by the cleaned year and quarter as well (``plans.jobs.LINEAGE``), so a
refresh of some trusted partitions prunes the raw table to the rows that feed them.

Exactly-once output: every micro-batch writes below its own ``batch_id=<n>`` folder, which
is replaced as a whole. So a batch that is run again after a failure, also on another run
date, replaces its own rows; the checkpoint records which files were consumed. ``trigger='availableNow'`` processes what has landed and stops
(the scheduled-job form of an object-created trigger).
"""

from __future__ import annotations

import datetime as _dt
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamReader, StreamingQuery

from strata import schemas as SC
from strata.functions import columns as C
from strata.sinks.writers import (
    list_names, list_partitions, partition_filter, remove_file, touch_empty, write_partitioned,
)

DIGEST_LIMIT = 256 * 1024 ** 2  # bytes of a file whose content is digested
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"  # fixed value: folder name of a NULL partition value
BINARY_FILE = "path string, modificationTime timestamp, length long, content binary"


class UnroutedFileError(ValueError):
    """A landed file matches no dataset pattern and there is no quarantine folder."""


_META = set(".^$*+?{}[]\\|()")


def _path_test(p: Column, pattern: str) -> Column:
    """``.*TEXT.*`` (match anywhere) becomes a plain substring test: same answer for
    paths, without the quadratic backtracking of a leading ``.*`` under ``rlike``."""
    if pattern.startswith(".*") and pattern.endswith(".*"):
        core = pattern[2:-2]
        if core and not (set(core) & _META):
            return p.contains(core)
    return p.rlike(pattern)


def route_by_path(path: str | Column, routes: list[tuple[str, str]] | None = None) -> Column:
    """Dataset name for a file path (first matching route wins); NULL when none matches."""
    p = C.col_ref(path) if isinstance(path, str) else path
    expr = None
    for name, pattern in routes or SC.ROUTES:
        test = _path_test(p, pattern)
        expr = F.when(test, F.lit(name)) if expr is None else expr.when(test, F.lit(name))
    return expr


def routed_files(files: DataFrame) -> DataFrame:
    """``path``, ``length`` and ``dataset`` of a ``binaryFile`` scan; contents are pruned."""
    return files.select("path", "length").withColumn("dataset", route_by_path("path"))


def arrivals(reader: DataStreamReader, root: str, redelivered: str = "drop", digest_limit: int = DIGEST_LIMIT,
             forget_after: str | None = None) -> DataFrame:
    """Non-empty files below ``root`` as they arrive: ``path``, ``length``, ``dataset``.

    ``redelivered='drop'`` lets each content pass once per dataset; ``forget_after`` (an interval
    of modification time, e.g. ``'90 days'``) bounds how long a digest is kept.
    """
    def files(where: str) -> DataFrame:
        return reader.load(root).where(f"length > 0 AND {where}").withColumn("dataset", route_by_path("path"))

    if redelivered == "keep":
        return files("true").select("path", "length", "dataset")
    columns = ["path", "length", "dataset", "modificationTime", "digest"]
    small = files(f"length <= {digest_limit}").withColumn("digest", F.sha2("content", 256)).select(columns)
    large = files(f"length > {digest_limit}").withColumn("digest", F.concat(F.lit("path:"), "path")).select(columns)
    both = small.union(large)
    if forget_after:
        once = both.withWatermark("modificationTime", forget_after).dropDuplicatesWithinWatermark(["dataset", "digest"])
    else:
        once = both.dropDuplicates(["dataset", "digest"])
    return once.select("path", "length", "dataset")


def _literal(path: str) -> str:
    """``path`` with the characters escaped that a reader would take for a glob."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", path)


def nonempty_by_dataset(routed: DataFrame) -> dict[str | None, list[str]]:
    """Paths of the non-empty files per dataset (None: no route). File names only."""
    found: dict[str | None, list[str]] = {}
    for r in routed.filter("length > 0").select("dataset", "path").collect():
        found.setdefault(r.dataset, []).append(_literal(r.path))
    return {dataset: sorted(paths) for dataset, paths in found.items()}


def lineage(dataset: str) -> list[str]:
    """Partition columns of a streamed raw table that name the trusted partition of a row."""
    from strata.plans import jobs as J
    return list(J.LINEAGE[dataset])


def _sor(spark: SparkSession, dataset: str, sor_root: str) -> DataFrame:
    schema = SC.all_string_schema(SC.RAW_FORMATS[dataset]["fields"]) \
        .add("anomesdia", "string").add("batch_id", "long")
    for name in lineage(dataset):
        schema = schema.add(name, "integer")
    return spark.read.schema(schema).parquet(f"{sor_root}/{dataset}")


@dataclass(frozen=True)
class Landing:
    """Where a landing stream writes, and how it refreshes the trusted tables."""

    sor_root: str
    ref_date: _dt.date | str | None = None
    quarantine_root: str | None = None
    sot_root: str | None = None
    dq_root: str | None = None
    refresh: str = "table"
    encoding: str = "UTF-8"
    pending_root: str | None = None  # set: table refreshes wait here for the end of the run

    def refresh_table(self, spark: SparkSession, dataset: str) -> None:
        """The whole trusted table from the whole raw table."""
        from strata.plans import jobs as J
        sor = _sor(spark, dataset, self.sor_root)
        last = sor.agg(F.max("batch_id")).first()[0]
        J.run_sot(spark, dataset, sor, f"{self.sot_root}/{dataset}", self.ref_date,
                  dq_root=self.dq_root, overwrite="table", run_id=f"batch-{last}",
                  layout=J.WRITE_LAYOUT[dataset])

    def refresh_partitions(self, spark: SparkSession, dataset: str, batch: DataFrame,
                           batch_id: int) -> None:
        """The trusted partitions that ``batch`` feeds, from all raw rows that feed them.

        Keyed on the cleaned partition values: raw rows whose spelling differs, or whose
        raw date does, can meet in one trusted partition. NULL is a value like others.
        """
        from strata.plans import jobs as J
        feeding = self.feeding(spark, dataset, batch_id)
        if feeding is None or batch.isEmpty():
            return  # the batch held only header lines for this dataset
        J.run_sot(spark, dataset, feeding, f"{self.sot_root}/{dataset}",
                  self.ref_date, dq_root=self.dq_root, overwrite="partitions",
                  run_id=f"batch-{batch_id}",
                  states_root=f"{self.dq_root}/_states/{dataset}" if self.dq_root else None)

    def feeding(self, spark: SparkSession, dataset: str, batch_id: int) -> DataFrame | None:
        """Raw rows of all batches that feed the trusted partitions of batch ``batch_id`` (None: it has
        none). The raw table is partitioned by them, so the others are not read; the batch's own
        values are the names of its folders."""
        from strata.plans import jobs as J
        sor, by = _sor(spark, dataset, self.sor_root), lineage(dataset)
        if not by:
            return sor  # all rows feed the partition of the run date
        values = [tuple(None if v == NO_VALUE else int(v) for v in (part.split("=", 1)[1] for part in folder.split("/")))
                  for folder in list_partitions(spark, f"{self.sor_root}/{dataset}/batch_id={batch_id}", len(by))]
        return sor.where(partition_filter(by, values)).drop(*by) if values else None

    def write_batch(self, batch: DataFrame, batch_id: int) -> None:
        from strata.plans import jobs as J
        spark = batch.sparkSession
        files = nonempty_by_dataset(batch)
        stray = files.pop(None, [])
        if stray and not self.quarantine_root:
            raise UnroutedFileError(f"{len(stray)} landed file(s) match no dataset route, e.g. {stray[:5]}")
        if stray:
            lines = spark.read.text(stray).select(F.col("_metadata.file_path").alias("path"), "value")
            write_partitioned(lines, f"{self.quarantine_root}/batch_id={batch_id}", fmt="parquet")
        for dataset, paths in files.items():
            out = J.sor_frame(spark, dataset, paths, self.ref_date, self.encoding)
            write_partitioned(J.with_lineage(dataset, out), f"{self.sor_root}/{dataset}/batch_id={batch_id}",
                              by=[*lineage(dataset), "anomesdia"], fmt="parquet")
            if not self.sot_root:
                continue
            if self.refresh == "partitions":
                self.refresh_partitions(spark, dataset, out, batch_id)
            elif self.pending_root:
                touch_empty(spark, f"{self.pending_root}/{dataset}")
            else:
                self.refresh_table(spark, dataset)


def _start(spark: SparkSession, landing_root: str, checkpoint: str, landing: Landing, trigger: str,
           max_files_per_trigger: int | None, max_bytes_per_trigger: str | None, redelivered: str,
           forget_after: str | None) -> StreamingQuery:
    if redelivered not in ("drop", "keep"):
        raise ValueError(f"redelivered must be drop|keep, got {redelivered!r}")
    if landing.refresh not in ("table", "partitions"):
        raise ValueError(f"refresh must be table|partitions, got {landing.refresh!r}")
    reader = spark.readStream.format("binaryFile").option("recursiveFileLookup", True)
    if max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
    elif max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    files = arrivals(reader.schema(BINARY_FILE), landing_root, redelivered, forget_after=forget_after)
    writer = files.writeStream.foreachBatch(landing.write_batch).option("checkpointLocation", checkpoint)
    if trigger == "availableNow":
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=trigger)
    return writer.start()


def start_landing_stream(spark: SparkSession, landing_root: str, sor_root: str,
                         checkpoint: str, ref_date: _dt.date | str | None = None,
                         quarantine_root: str | None = None,
                         trigger: str = "availableNow",
                         max_files_per_trigger: int | None = 1000,
                         max_bytes_per_trigger: str | None = None,
                         sot_root: str | None = None,
                         dq_root: str | None = None,
                         refresh: str = "table",
                         encoding: str = "UTF-8",
                         redelivered: str = "drop",
                         forget_after: str | None = None) -> StreamingQuery:
    """Start the landing stream (returns the running query).

    ``max_files_per_trigger`` or ``max_bytes_per_trigger`` bounds each micro-batch
    (``availableNow`` then runs as several batches); a batch holds file names only.
    ``sot_root``: after each batch, rebuild the trusted table of every dataset that
    received files (raw -> trusted chain with the quality gate); a failed gate stops
    the stream with the batch uncommitted, so a re-run repeats it, metrics included.
    ``refresh``: 'table' (the whole trusted table after each batch) or 'partitions'
    (only the trusted partitions that the batch feeds: the raw complaints are partitioned by
    them, so only their raw rows are read, checked and written; the metrics stored are those of
    the whole table, merged from partition states). ``redelivered``: 'drop' takes each content once per
    dataset, 'keep' every file; see :func:`arrivals`."""
    return _start(spark, landing_root, checkpoint,
                  Landing(sor_root, ref_date, quarantine_root, sot_root, dq_root, refresh, encoding),
                  trigger, max_files_per_trigger, max_bytes_per_trigger, redelivered, forget_after)


def stream_landing(spark: SparkSession, landing_root: str, sor_root: str, checkpoint: str,
                   ref_date: _dt.date | str | None = None,
                   quarantine_root: str | None = None, timeout_s: int | None = None,
                   max_files_per_trigger: int | None = 1000, sot_root: str | None = None,
                   dq_root: str | None = None, refresh: str = "table",
                   max_bytes_per_trigger: str | None = None, encoding: str = "UTF-8",
                   redelivered: str = "drop", forget_after: str | None = None) -> None:
    """Process every file landed so far and stop (``availableNow``).

    With ``refresh='table'`` a trusted table is rebuilt once, after the last batch. What
    is still to be rebuilt is noted beside the checkpoint first, so a run whose gate
    failed, or that was lost, is made up for by the next one, new files or not."""
    pending = f"{checkpoint.rstrip('/')}-pending"
    landing = Landing(sor_root, ref_date, quarantine_root, sot_root, dq_root, refresh, encoding, pending)
    q = _start(spark, landing_root, checkpoint, landing, "availableNow", max_files_per_trigger,
               max_bytes_per_trigger, redelivered, forget_after)
    q.awaitTermination(timeout_s)
    if q.exception() is not None:
        raise q.exception()
    if q.isActive:
        q.stop()
        raise TimeoutError(f"the landing stream took more than {timeout_s} s")
    for note in list_names(spark, pending) if sot_root and refresh == "table" else []:
        landing.refresh_table(spark, note)
        remove_file(spark, f"{pending}/{note}")
