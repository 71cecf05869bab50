"""Command-line entry for the layer jobs (``spark-submit -m`` style or
``python -m strata.plans.cli``). One sub-command per job:

  sor            raw file(s) -> SoR table      (--dataset --input --output [--ref-date])
  sot            SoR -> SoT with DQ + gate     (--dataset --input --output [--dq-root])
  spec           SoT x3 -> report              (--banks --complaints --employers --output
                                                [--sink parquet|csv|jdbc --jdbc-url ...])
  spec-quarterly SoT x3 -> quarterly CSV       (same inputs)
  stream         landing folder -> SoR (+ SoT) (--landing --sor-root --checkpoint
                                                [--sot-root --refresh table|partitions])
  export         catalog table -> database     (--table --jdbc-url --jdbc-table ...)

Inputs/outputs are paths, or catalog table names with ``--tables``.
"""

from __future__ import annotations

import argparse
import sys

from strata import schemas as SC
from strata.plans import jobs as J
from strata.session import build_session


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="strata")
    p.add_argument("--auto-size", action="store_true",
                   help="size shuffle partitions from the input bytes before running")
    sub = p.add_subparsers(dest="cmd", required=True)

    s = sub.add_parser("sor")
    s.add_argument("--dataset", required=True, choices=sorted(SC.RAW_FORMATS))
    s.add_argument("--input", required=True, nargs="+")
    s.add_argument("--output", required=True)
    s.add_argument("--ref-date")
    s.add_argument("--encoding", default="UTF-8")
    s.add_argument("--table", help="catalog table to repair after the write")
    s.add_argument("--format", default="parquet", choices=["parquet", "csv"])
    s.add_argument("--overwrite", default="table", choices=["table", "partitions"])

    t = sub.add_parser("sot")
    t.add_argument("--dataset", required=True, choices=sorted(SC.RAW_FORMATS))
    t.add_argument("--input", required=True, help="SoR path, or table with --tables")
    t.add_argument("--output", required=True)
    t.add_argument("--ref-date")
    t.add_argument("--dq-root")
    t.add_argument("--tables", action="store_true")
    t.add_argument("--input-format", default="parquet", choices=["parquet", "csv"])
    t.add_argument("--output-format", default="parquet", choices=["parquet", "csv"])
    t.add_argument("--overwrite", default="table", choices=["table", "partitions"])
    t.add_argument("--min-completeness", action="append", default=[],
                   metavar="COLUMN=FRACTION")
    t.add_argument("--approx-distinct", action="store_true")

    for name in ("spec", "spec-quarterly"):
        r = sub.add_parser(name)
        r.add_argument("--banks", required=True)
        r.add_argument("--complaints", required=True)
        r.add_argument("--employers", required=True)
        r.add_argument("--output", default="")
        r.add_argument("--ref-date")
        r.add_argument("--tables", action="store_true")
        if name == "spec":
            r.add_argument("--sink", default="parquet", choices=["parquet", "csv", "jdbc"])
            _jdbc_args(r, table_flag="--jdbc-table")

    st = sub.add_parser("stream")
    st.add_argument("--landing", required=True)
    st.add_argument("--sor-root", required=True)
    st.add_argument("--checkpoint", required=True)
    st.add_argument("--ref-date")
    st.add_argument("--quarantine", help="folder for files without a route (default: stop)")
    st.add_argument("--max-files-per-trigger", type=int, default=1000)
    st.add_argument("--sot-root", help="also rebuild trusted tables")
    st.add_argument("--dq-root")
    st.add_argument("--refresh", default="table", choices=["table", "partitions"])

    e = sub.add_parser("export")
    e.add_argument("--table", required=True)
    _jdbc_args(e, table_flag="--jdbc-table", required=True)
    return p


def _jdbc_args(p, table_flag: str, required: bool = False) -> None:
    p.add_argument("--jdbc-url", required=required)
    p.add_argument(table_flag, dest="jdbc_table", required=required)
    p.add_argument("--jdbc-user")
    p.add_argument("--jdbc-password")
    p.add_argument("--jdbc-driver")


def _jdbc_props(a) -> dict:
    props = {"user": a.jdbc_user, "password": a.jdbc_password, "driver": a.jdbc_driver}
    return {k: v for k, v in props.items() if v}


def main(argv: list[str] | None = None, spark=None) -> str:
    a = _parser().parse_args(argv)
    spark = spark or build_session(app=f"strata-{a.cmd}")
    if a.auto_size:
        from strata.session import apply_sizing
        inputs = {"sor": lambda: a.input, "sot": lambda: [a.input],
                  "spec": lambda: [a.banks, a.complaints, a.employers],
                  "spec-quarterly": lambda: [a.banks, a.complaints, a.employers],
                  "stream": lambda: [a.landing]}.get(a.cmd, lambda: [])()
        if not getattr(a, "tables", False):
            apply_sizing(spark, list(inputs))
    if a.cmd == "sor":
        return J.run_sor(spark, a.dataset, a.input, a.output, a.ref_date, table=a.table,
                         encoding=a.encoding, fmt=a.format, overwrite=a.overwrite)
    if a.cmd == "sot":
        fmt = SC.RAW_FORMATS[a.dataset]
        schema = SC.all_string_schema(fmt["fields"]).add("anomesdia", "string")
        if a.tables:
            sor = spark.read.table(a.input)
        elif a.input_format == "csv":
            sor = (spark.read.schema(schema).option("sep", ";").option("header", True)
                   .csv(a.input))
        else:
            sor = spark.read.schema(schema).parquet(a.input)
        floors = {k: float(v) for k, v in (x.split("=", 1) for x in a.min_completeness)}
        res = J.run_sot(spark, a.dataset, sor, a.output, a.ref_date, dq_root=a.dq_root,
                        profile=J.quality_profile(a.dataset, floors, a.approx_distinct),
                        overwrite=a.overwrite, fmt=a.output_format)
        return res.output_path
    if a.cmd == "spec":
        jdbc = None
        if a.sink == "jdbc":
            jdbc = {"url": a.jdbc_url, "table": a.jdbc_table, "properties": _jdbc_props(a)}
        return J.run_spec(spark, a.banks, a.complaints, a.employers, a.output, sink=a.sink,
                          ref_date=a.ref_date, jdbc=jdbc, from_tables=a.tables)
    if a.cmd == "spec-quarterly":
        return J.run_spec_quarterly(spark, a.banks, a.complaints, a.employers, a.output,
                                    ref_date=a.ref_date)
    if a.cmd == "stream":
        from strata.streaming import stream_landing
        stream_landing(spark, a.landing, a.sor_root, a.checkpoint, a.ref_date,
                       a.quarantine, max_files_per_trigger=a.max_files_per_trigger,
                       sot_root=a.sot_root, dq_root=a.dq_root, refresh=a.refresh)
        return a.sor_root
    if a.cmd == "export":
        from strata.sinks import export_table
        export_table(spark, a.table, a.jdbc_url, a.jdbc_table, _jdbc_props(a))
        return a.jdbc_table
    raise AssertionError(a.cmd)


if __name__ == "__main__":
    print(main(sys.argv[1:]))
