"""Command line: the reference's three steps (transform, load, export) as Spark jobs.

    python -m txnlake transform --ids ids.csv --features data.csv --out processed/
    python -m txnlake load --processed processed/ --warehouse wh/
    python -m txnlake export --warehouse wh/ --out analytics/ [--only V1,V3]
    python -m txnlake run --ids ids.csv --features data.csv --warehouse wh/ --out analytics/
    python -m txnlake audit --warehouse wh/
    python -m txnlake views --warehouse wh/ --out views/ [--only V1,V3]

``export`` writes one ordered CSV file per view; ``views`` refreshes the views
as tables of their own schemas (``customer.rfm_segments``) for SQL sessions.

Paths are anything Spark can read and write (shared storage on a cluster).
"""

from __future__ import annotations

import argparse
import json
import sys

from .operators.transform import from_lines, transform
from .plans import catalog
from .plans.published import attach_views, publish_views
from .plans.warehouse import LAST_LOAD_REPORT, audit_integrity, load, open_warehouse
from .session import get_spark
from .sources import files as IO


def _transform(spark, ids: str, features: str, out: str, fmt: str) -> None:
    IO.write_processed(transform(IO.read_raw(spark, ids, features, multi_line=True)).lines, out, fmt)


def _load(spark, processed: str, warehouse: str) -> dict:
    load(spark, from_lines(IO.read_processed(spark, processed)), warehouse)
    return dict(LAST_LOAD_REPORT)


def _export(spark, warehouse: str, out: str, only: list[str] | None) -> dict:
    return catalog.export_all(open_warehouse(spark, warehouse), out, only=only, single_file=True)


def main(argv: list[str] | None = None, spark=None) -> dict:
    p = argparse.ArgumentParser(prog="txnlake")
    sub = p.add_subparsers(dest="cmd", required=True)
    t = sub.add_parser("transform")
    t.add_argument("--ids", required=True)
    t.add_argument("--features", required=True)
    t.add_argument("--out", required=True)
    t.add_argument("--format", default="parquet", choices=["parquet", "csv"])
    ld = sub.add_parser("load")
    ld.add_argument("--processed", required=True)
    ld.add_argument("--warehouse", required=True)
    e = sub.add_parser("export")
    e.add_argument("--warehouse", required=True)
    e.add_argument("--out", required=True)
    e.add_argument("--only", default="")
    r = sub.add_parser("run")
    r.add_argument("--ids", required=True)
    r.add_argument("--features", required=True)
    r.add_argument("--warehouse", required=True)
    r.add_argument("--processed", default=None)
    r.add_argument("--out", default=None)
    r.add_argument("--only", default="")
    a = sub.add_parser("audit")
    a.add_argument("--warehouse", required=True)
    pv = sub.add_parser("views")
    pv.add_argument("--warehouse", required=True)
    pv.add_argument("--out", required=True)
    pv.add_argument("--only", default="")
    args = p.parse_args(argv)

    spark = spark or get_spark(**{"spark.scheduler.mode": "FAIR"})
    only = [x for x in getattr(args, "only", "").split(",") if x] or None
    result: dict = {}
    if args.cmd == "transform":
        _transform(spark, args.ids, args.features, args.out, args.format)
    elif args.cmd == "load":
        result["inserted"] = _load(spark, args.processed, args.warehouse)
    elif args.cmd == "export":
        result["export"] = _export(spark, args.warehouse, args.out, only)
    elif args.cmd == "run":
        processed = args.processed or f"{args.warehouse.rstrip('/')}_processed"
        _transform(spark, args.ids, args.features, processed, "parquet")
        result["inserted"] = _load(spark, processed, args.warehouse)
        if args.out:
            result["export"] = _export(spark, args.warehouse, args.out, only)
    elif args.cmd == "views":
        version = publish_views(open_warehouse(spark, args.warehouse), args.out, only)
        result["views"] = {"version": version, "attached": attach_views(spark, args.out)}
    elif args.cmd == "audit":
        result["violations"] = {f"{r['table_name']}.{r['check_type']}.{r['column_name']}": r["violations"]
                                for r in audit_integrity(open_warehouse(spark, args.warehouse)).collect()
                                if r["violations"]}
    print(json.dumps(result, default=str))
    return result


if __name__ == "__main__":
    main(sys.argv[1:])
