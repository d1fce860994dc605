"""Command line for ``spark-submit``: list editions, extract, or build the report.

    spark-submit rollcall/__main__.py editions --landing s3://landing --contains run
    spark-submit rollcall/__main__.py extract  --landing s3://landing --edition "City Run 2025" --out s3://extracts
    spark-submit rollcall/__main__.py report   --landing s3://landing --edition "City Run 2025" \\
        --first 2022-05-01 --last 2026-05-31 --as-of 2025-06-30 --out s3://reports
    spark-submit rollcall/__main__.py pending  --landing s3://landing --edition "City Run 2025" --out s3://requests
    spark-submit rollcall/__main__.py land --url jdbc:mysql://db:3306/tickets --user u --password p \\
        --tables checkoutparticipant,checkoutsession --partition-column id --lower 1 \\
        --upper 90000000 --partitions 400 --clustered --out s3://landing

``report`` and ``pending`` extract first, or read with ``--extract PATH`` what
``extract`` wrote, whole or one ``--batch`` of it.  ``report`` also writes the
lookup's counters and unresolved rows (``<out>_counters``, ``<out>_unresolved``).
``extract`` writes ``forms``, ``forms_profile`` (the postal-code profile) and
``participants`` under ``--out``.  Tables are read from ``<landing>/<table>``
with their declared schemas
(``--format parquet`` or ``csv``); ``report`` and ``pending`` also read
``<landing>/responses``.  ``pending`` writes the next request of the provider
chain for every code the edition's forms need (provider, code, URL), for a
fetcher that lands the answers in ``responses``.
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys

from rollcall import fixed_values as fv


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="rollcall")
    sub = p.add_subparsers(dest="command", required=True)
    land = sub.add_parser("land", help="scan operational tables over JDBC and land them as Parquet")
    land.add_argument("--url", required=True)
    land.add_argument("--user", default=None)
    land.add_argument("--password", default=None)
    land.add_argument("--driver", default=None)
    land.add_argument("--tables", required=True, help="comma-separated table names")
    land.add_argument("--partition-column", default=None)
    land.add_argument("--lower", type=int, default=None)
    land.add_argument("--upper", type=int, default=None)
    land.add_argument("--partitions", type=int, default=None)
    land.add_argument("--key-width", type=int, default=None,
                      help="plan the splits from the database's counts per so many keys, instead of --lower and --upper")
    land.add_argument("--above", type=int, default=None, help="with --key-width: land (append) only keys after this one")
    land.add_argument("--out", required=True)
    land.add_argument("--clustered", action="store_true",
                      help="sort tables of all events by the id that extractions restrict them by")
    land.add_argument("--month-partitioned", action="store_true",
                      help="partition purchase-dated tables by month of createdAt")
    helps = {
        "editions": "list editions (optionally those containing a fragment)",
        "extract": "write the forms, their postal-code profile and the participants of one edition",
        "report": "write the participant report with resolved addresses, and the lookup counters",
        "pending": "write the next provider request of every postal code the edition needs",
    }
    for name in ("editions", "extract", "report", "pending"):
        s = sub.add_parser(name, help=helps[name])
        s.add_argument("--landing", required=True)
        s.add_argument("--format", default="parquet", choices=("parquet", "csv"))
        s.add_argument("--month-partitioned", action="store_true",
                       help="the landing was written with land --month-partitioned")
        s.add_argument("--option-view", action="store_true",
                       help="the landing holds checkoutparticipant_array_vw instead of participant_options")
        if name == "editions":
            s.add_argument("--contains", default=None)
            s.add_argument("--out", default=None, help="write here instead of printing")
            continue
        s.add_argument("--edition", required=True)
        s.add_argument("--first", default=None)
        s.add_argument("--last", default=None)
        s.add_argument("--max-rows", type=int, default=None)
        s.add_argument("--rows-per-batch", type=int, default=fv.DEFAULT_ROWS_PER_BATCH)
        s.add_argument("--as-of", default=None, help="date ages are computed at (default: today)")
        s.add_argument("--out", required=True)
        s.add_argument("--input-bytes", type=int, default=None, help="size of the landing: sizes splits and shuffles")
        s.add_argument("--cores", type=int, default=None, help="cores of the cluster, with --input-bytes")
        if name in ("report", "pending"):
            s.add_argument("--extract", default=None, help="read what extract wrote here instead of extracting")
            s.add_argument("--batch", type=int, default=None, help="of --extract: only this batch of participants")
        if name == "report":
            s.add_argument("--out-format", default="parquet", choices=("parquet", "csv"))
    return p


def _land(args, spark):
    from rollcall.session import build_session
    from rollcall.sources.readers import (PURCHASE_DATED, RESTRICTED_BY, jdbc_options, land_table, read_jdbc,
                                          read_jdbc_balanced)
    names = [t.strip() for t in args.tables.split(",") if t.strip()]
    if args.partition_column is None:
        from rollcall.sources.schemas import SPANNING
        if whole := [n for n in names if n in SPANNING]:
            raise SystemExit(f"{', '.join(whole)}: tables of all events need --partition-column, --lower, --upper, --partitions")
    counted = args.key_width is not None
    if counted and (args.partition_column is None or args.partitions is None or args.lower is not None or args.upper is not None):
        raise SystemExit("--key-width needs --partition-column and --partitions, and no bounds")
    if args.above is not None and not counted:
        raise SystemExit("--above needs --key-width")
    split = {} if counted else {"partition_column": args.partition_column, "lower_bound": args.lower,
                                "upper_bound": args.upper, "num_partitions": args.partitions}
    options = [jdbc_options(args.url, t, user=args.user, password=args.password, driver=args.driver, **split) for t in names]
    spark = spark or build_session()
    for name, opts in zip(names, options):
        rows = (read_jdbc_balanced(spark, name, opts, args.partition_column, args.partitions, args.key_width, args.above)
                if counted else read_jdbc(spark, name, opts))
        land_table(rows, args.out, name, month_of=PURCHASE_DATED.get(name) if args.month_partitioned else None,
                   cluster_by=RESTRICTED_BY.get(name) if args.clustered else None, append=args.above is not None)


def _editions(args, spark, tables):
    from rollcall.operators.catalogue import list_editions
    editions = list_editions(tables["eventcomplement"], args.contains)
    if args.out:
        editions.write.mode("overwrite").parquet(args.out)
    else:
        for row in editions.toLocalIterator():
            print(row[0])


def _extract(args, spark, tables):
    from pyspark.sql import functions as F

    from rollcall.operators.postal import normalise_postal_codes, observe_profile, profile_display
    from rollcall.plans.extract import edition_scope, extract_forms, extract_participants
    from rollcall.session import run_concurrently
    from rollcall.sources.sinks import write_extract
    scope = edition_scope(tables, args.edition, shared=True)

    def forms_job():
        forms = normalise_postal_codes(extract_forms(tables, args.edition, args.first, args.last,
                                                     args.max_rows, args.rows_per_batch, scope=scope))
        forms, profile_of = observe_profile(forms)      # counted while the forms are written
        write_extract(forms, f"{args.out}/forms", "edicao", edition=args.edition)
        profile = profile_of()
        profile = profile.join(profile_display(profile), "label").withColumn("edicao", F.lit(args.edition))
        write_extract(profile, f"{args.out}/forms_profile", "edicao", edition=args.edition)

    def people_job():
        people = extract_participants(tables, args.edition, args.first, args.last, args.max_rows,
                                      args.rows_per_batch, _as_of(args), scope=scope)
        write_extract(people, f"{args.out}/participants", "edition", edition=args.edition)

    run_concurrently(spark, forms_job, people_job)   # independent jobs


def _pending(args, spark, tables):
    from rollcall.operators.lookup import pending_requests
    from rollcall.operators.postal import normalise_postal_codes
    from rollcall.plans.extract import extract_forms
    from rollcall.plans.report import batch_forms
    from rollcall.sources.readers import read_extract
    if args.extract:
        people, forms = read_extract(spark, args.extract, args.edition)
        if args.batch is not None:
            forms = batch_forms(people, forms, args.batch)
    else:
        forms = normalise_postal_codes(extract_forms(tables, args.edition, args.first, args.last, args.max_rows,
                                                     args.rows_per_batch))
    pending_requests(forms, _responses(args, spark)).write.mode("overwrite").parquet(args.out)


def _report(args, spark, tables):
    from rollcall.plans.report import build_report, report_from_extract
    from rollcall.sources.readers import read_extract
    from rollcall.sources.sinks import display_participants, write_beside_report, write_report
    if args.extract:
        report = report_from_extract(*read_extract(spark, args.extract, args.edition), _responses(args, spark), args.batch)
    else:
        report = build_report(tables, _responses(args, spark), args.edition, args.first, args.last, _as_of(args),
                              rows_per_batch=args.rows_per_batch, max_rows=args.max_rows)
    now = dt.datetime.now()
    write_report(display_participants(report.report), args.out, now, fmt=args.out_format, edition=args.edition, batch=args.batch)
    write_beside_report(report.resolved.counters.withColumnsRenamed(fv.COUNTER_DISPLAY_NAMES),
                        f"{args.out}_counters", now, args.edition, batch=args.batch)
    write_beside_report(report.resolved.unresolved, f"{args.out}_unresolved", now, args.edition, batch=args.batch)


def _as_of(args) -> dt.date:
    return dt.date.fromisoformat(args.as_of) if args.as_of else dt.date.today()


def _responses(args, spark):
    from rollcall.sources.readers import read_table
    return read_table(spark, args.landing, "responses", args.format)


COMMANDS = {"editions": _editions, "extract": _extract, "pending": _pending, "report": _report}


def main(argv=None, spark=None) -> int:
    args = _parser().parse_args(argv)
    if args.command == "land":
        _land(args, spark)
        return 0
    from rollcall.session import build_session, run_folder, scale_conf
    from rollcall.sources.readers import PURCHASE_DATED, read_tables
    from rollcall.sources.schemas import OPERATIONAL
    if getattr(args, "batch", None) is not None and not args.extract:
        raise SystemExit("--batch needs --extract")
    sized = getattr(args, "input_bytes", None) and args.cores
    spark = spark or build_session(conf=scale_conf(args.input_bytes, args.cores) if sized else None)
    names = list(OPERATIONAL)
    if args.option_view:
        names = [n for n in names if n != "participant_options"] + ["checkoutparticipant_array_vw"]
    tables = read_tables(spark, args.landing, names=names, fmt=args.format,
                         months=PURCHASE_DATED if args.month_partitioned else None)
    with run_folder(spark):     # a run's intermediates go when it ends
        COMMANDS[args.command](args, spark, tables)
    return 0


if __name__ == "__main__":
    sys.exit(main())
