"""Command line: ``python -m stockgap <command> ...`` (or via spark-submit).

  ledger   materialize the stock ledger as parquet
  risk     print the ranked risk list
  export   write the dashboard extracts as CSV
  rebuild  write all tables and the ledger as parquet
  load     write all star-schema tables as versioned snapshots, each only if its
           constraints hold, and bring the ledger by month up to date from the
           first month that changed
  check    print the data-quality reports

Input is either the TPC-H-shaped parquet tables (``--tables DIR``) or the
star-schema CSV files (``--csv DIR``).  Under spark-submit the cluster's
session is used; ``--local N`` starts a local one.
"""

from __future__ import annotations

import argparse

import datetime as dt

from pyspark.sql import SparkSession

from . import params as P
from .operators import ledger, quality, reports, risk
from .operators.refresh import refresh_ledger
from .session import cluster_conf, dense_partitions, local_session, scratch_path
from .sources.bindings import bind_driver_tables
from .sources.csv_io import write_table
from .sources.snapshots import SnapshotTable
from .sources.reference import bind_reference_tables, load_reference_csvs


def _parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="stockgap", description=__doc__,
                                 formatter_class=argparse.RawDescriptionHelpFormatter)
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--tables", help="folder of TPC-H-shaped parquet tables")
    src.add_argument("--csv", help="folder of star-schema CSV files")
    ap.add_argument("--max-rejects", type=int, metavar="N",
                    help="with --csv: leave out up to N lines a table that do not fit it (default: the first one ends the job)")
    ap.add_argument("--params", choices=["driver", "reference"], default=None,
                    help="threshold set (default: driver for --tables, reference for --csv)")
    ap.add_argument("--local", type=int, default=0, help="start a local session with N cores")
    ap.add_argument("--size", type=float, default=0, metavar="GB",
                    help="input size; with --cores sizes shuffles and broadcasts of a cluster run")
    ap.add_argument("--cores", type=int, default=0, help="executor cores of the cluster")
    sub = ap.add_subparsers(dest="cmd", required=True)
    led = sub.add_parser("ledger")
    led.add_argument("--out", required=True)
    led.add_argument("--layout", choices=["generated", "month", "runs"], default="runs")
    led.add_argument("--scope", choices=["full", "active"], default="full")
    rk = sub.add_parser("risk")
    rk.add_argument("--top", type=int, default=10)
    ex = sub.add_parser("export")
    ex.add_argument("--out", required=True)
    ex.add_argument("--files", action="store_true", help="plain files <name>.csv instead of folders")
    ex.add_argument("--stuffer", help="distributor of the series (default: most stuffing flags)")
    ex.add_argument("--hoarder", nargs=2, metavar=("DISTRIBUTOR", "SKU"),
                    help="pair of the sales series (default: the first leaked one)")
    ex.add_argument("--from", dest="start", type=dt.date.fromisoformat, help="first day of the pair series")
    ex.add_argument("--to", dest="end", type=dt.date.fromisoformat, help="last day of the pair series")
    ex.add_argument("--dumper", help="distributor of the drop sizes (default: most bulk drops)")
    rb = sub.add_parser("rebuild", help="write dimensions, facts and ledger as parquet, replacing earlier ones")
    rb.add_argument("--out", required=True)
    ld = sub.add_parser("load", help="checked tables and ledger as versioned snapshots")
    ld.add_argument("--out", required=True)
    ld.add_argument("--since", type=dt.date.fromisoformat, help="recompute the ledger from this day in any case")
    ld.add_argument("--keep", type=int, default=2, help="versions that stay (default 2)")
    ck = sub.add_parser("check")
    ck.add_argument("--ledger", help="stored ledger to check (default: one is written first)")
    return ap


def load_snapshots(spark: SparkSession, wh, folder: str, since: dt.date | None = None, keep: int = 2) -> dict[str, int | None]:
    """Every table and the ledger as :class:`SnapshotTable`s under
    ``folder``; the version of each.  The first broken constraint ends the load;
    that table and those after it keep their earlier versions, and the ledger
    follows from the loaded tables only when all of them are in."""
    rules = (lambda name: quality.reference_rules(wh.raw, name)) if "dim_date" in wh.raw else (lambda name: {})
    order = sorted(wh.raw, key=lambda n: (n.startswith("fact_"), n))  # parents before children
    tables = {name: SnapshotTable(spark, f"{folder}/{name}") for name in order}
    done = {name: t.write(wh.raw[name], **rules(name)) for name, t in tables.items()}
    tables["ledger"] = SnapshotTable(spark, f"{folder}/ledger")
    loaded = {name: tables[name].read() for name in order}
    stored = bind_reference_tables(loaded) if "dim_date" in wh.raw else wh
    done["ledger"] = refresh_ledger(stored, tables["ledger"], since)
    for t in tables.values():
        t.expire(keep)
    return done


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    sizing = cluster_conf(int(args.size * (1 << 30)), args.cores) if args.size and args.cores else {}
    spark = local_session(args.local, **sizing) if args.local else SparkSession.builder.config(map=sizing).getOrCreate()
    if args.tables:
        wh = bind_driver_tables(spark, args.tables)
        params = P.REFERENCE if args.params == "reference" else P.DRIVER
    else:
        wh = bind_reference_tables(load_reference_csvs(spark, args.csv, args.max_rejects))
        params = P.DRIVER if args.params == "driver" else P.REFERENCE

    if args.cmd == "ledger":
        if args.layout != "runs":  # dense rows: size the generating tasks by what they make
            lo, hi = wh.span().first()
            pairs = wh.dist_keys().count() * wh.products.select("sku_id").distinct().count()
            parts = dense_partitions(pairs, (hi - lo).days + 1)
            spark.conf.set("spark.sql.shuffle.partitions",
                           str(max(parts, int(spark.conf.get("spark.sql.shuffle.partitions")))))
        ledger.materialize_ledger(wh, args.out, layout=args.layout, scope=args.scope)
        print(f"ledger written to {args.out}")
    elif args.cmd == "risk":
        risk.risk_top(risk.risk_score(wh, params), args.top).show(args.top, truncate=False)
    elif args.cmd == "export":
        hoarder = args.hoarder and dict(distributor_id=args.hoarder[0], sku_id=args.hoarder[1],
                                        start=args.start, end=args.end)
        for name, path in reports.export_dashboard_extracts(
                spark, wh, args.out, params, args.stuffer, hoarder, args.dumper, args.files).items():
            print(f"{name}: {path}")
    elif args.cmd == "rebuild":
        for name, df in wh.raw.items():
            write_table(df, f"{args.out}/{name}")
        ledger.materialize_ledger(wh, f"{args.out}/ledger")
        print(f"{len(wh.raw)} tables and the ledger written to {args.out}")
    elif args.cmd == "load":
        for name, version in load_snapshots(spark, wh, args.out, args.since, args.keep).items():
            print(f"{name}: {'unchanged' if version is None else f'version {version}'}")
    elif args.cmd == "check":
        if args.csv:
            reports_ = list(quality.reference_quality(wh).values())
        else:
            reports_ = [job(wh) for job in (quality.dq_duplicate_keys, quality.dq_null_counts,
                                            quality.dq_orphans, quality.dq_range)]
        path = args.ledger
        if not path:
            path = scratch_path(spark, "ledger")
            ledger.materialize_ledger(wh, path)
        for df in reports_ + [quality.dq_ledger_identity(wh, spark.read.parquet(path))]:
            df.show(df.count(), truncate=False)  # a row per check: bounded by the schema


if __name__ == "__main__":
    main()
