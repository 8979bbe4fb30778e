"""Run a named query from the command line.

    python -m gridflow list
    python -m gridflow run billing_windows --sf /root/testdata/sf0.1 --out /shared/out/bills
    python -m gridflow run district_summary --sf /root/testdata/sf0.01 --show 20

``--master`` defaults to the one spark-submit provides (or ``local[*]``).
"""

from __future__ import annotations

import argparse
import sys


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="gridflow")
    sub = ap.add_subparsers(dest="cmd", required=True)
    sub.add_parser("list", help="list the registered queries")
    run = sub.add_parser("run", help="run one registered query")
    run.add_argument("name")
    run.add_argument("--sf", default="/root/testdata/sf0.01", help="folder with the input tables")
    run.add_argument("--out", help="write the result here as parquet (overwrite)")
    run.add_argument("--show", type=int, default=20, help="rows to print when --out is not given")
    run.add_argument("--master", default=None)
    args = ap.parse_args(argv)

    from gridflow.plans.catalog import QUERIES
    if args.cmd == "list":
        for name in sorted(QUERIES):
            print(name)
        return 0
    if args.name not in QUERIES:
        print(f"unknown query {args.name!r}; see `python -m gridflow list`", file=sys.stderr)
        return 2
    from gridflow.session import get_session
    spark = get_session(args.master or None)
    df = QUERIES[args.name](spark, args.sf)
    if args.out:
        df.write.mode("overwrite").parquet(args.out)
        print(f"wrote {args.name} to {args.out}")
    else:
        df.show(args.show, truncate=False)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
