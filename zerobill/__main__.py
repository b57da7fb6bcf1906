"""Command line: run one month of the alarm job.

    python -m zerobill --run-date 2025-03-20 \
        --customer semantic.customer --billing-line semantic.billing_line \
        --tax-line-1 raw.tax_line_1 --tax-line-2 raw.tax_line_2 \
        --alarm-factor work.alarm_factor \
        --zero-invoice-table work.zero_invoice --alarm-table work.alarm_final

Inputs are catalog tables unless ``--input-format`` names a file format, in
which case they are paths. The kept table is ``--zero-invoice-table``, a folder
(``--zero-invoice-path``), or with both an external table below that folder.
``--alarm-table`` is an existing table (positional insert) unless
``--alarm-format`` is given, in which case it is a path.
``--replace-period`` makes the alarm write idempotent per month.
"""

from __future__ import annotations

import argparse
import datetime as dt

from zerobill.plans.job import run_month
from zerobill.run import RunContext
from zerobill.session import build_session, cluster_conf
from zerobill.sources.catalog import read_sources


def parse_args(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="zerobill", description=__doc__,
                                formatter_class=argparse.RawDescriptionHelpFormatter)
    p.add_argument("--run-date", type=dt.date.fromisoformat, default=dt.date.today())
    for name in ("customer", "billing-line", "tax-line-1", "tax-line-2", "alarm-factor"):
        p.add_argument(f"--{name}", required=True)
    p.add_argument("--input-format", default=None, help="e.g. orc or parquet; default: tables")
    p.add_argument("--zero-invoice-table", default=None)
    p.add_argument("--zero-invoice-path", default=None)
    p.add_argument("--alarm-table", required=True)
    p.add_argument("--alarm-format", default=None, help="write to a path in this format")
    p.add_argument("--replace-period", action="store_true")
    p.add_argument("--input-bytes", type=int, default=None, help="bytes the job scans; with --cores sizes scans and shuffles")
    p.add_argument("--cores", type=int, default=None, help="cores of the cluster")
    return p.parse_args(argv)


def main(argv: list[str] | None = None) -> None:
    args = parse_args(argv)
    if args.replace_period and not args.alarm_format:
        raise SystemExit("--replace-period writes partitioned files: give --alarm-format too")
    if not args.zero_invoice_table and not args.zero_invoice_path:
        raise SystemExit("name the kept table: --zero-invoice-table, --zero-invoice-path or both")
    sized = cluster_conf(args.input_bytes, args.cores) if args.input_bytes and args.cores else None
    spark = build_session(app_name="zerobill-monthly", extra=sized)
    sources = read_sources(
        spark,
        {
            "customer": args.customer,
            "billing_line": args.billing_line,
            "tax_line_1": args.tax_line_1,
            "tax_line_2": args.tax_line_2,
            "alarm_factor": args.alarm_factor,
        },
        fmt=args.input_format,
    )
    run_month(
        spark,
        sources,
        RunContext(args.run_date),
        zero_invoice_path=args.zero_invoice_path,
        alarm_target=args.alarm_table,
        alarm_format=args.alarm_format,
        idempotent=args.replace_period,
        zero_invoice_table=args.zero_invoice_table,
    )


if __name__ == "__main__":
    main()
