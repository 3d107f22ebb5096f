"""Batch job entry point: build a session, load the seven tables, write the mart.

    python -m tarmac --source 's3://bucket/airline/{name}' --sink 's3://bucket/marts/{name}'
    python -m tarmac --source-format bigquery --warehouse-dataset proj.airline \\
                     --sink-format bigquery --staging-bucket my-bucket --name segments=segments_v1
    python -m tarmac --source-format jdbc --source-option url=jdbc:postgresql://db/demo \\
                     --table-option segments.partitionColumn=flight_id ... --sink '/marts/{name}'
    python -m tarmac --source /dumps/airline.sql --source-format copy_dump --sink '/marts/{name}' --sink-format versioned

Stored table names are substituted for ``{name}``.  Spark settings (master,
memory, checkpoint folder, ...) come from spark-submit / spark-defaults as usual.
"""

from __future__ import annotations

import argparse
from dataclasses import replace

from tarmac.plans.checks import Checks
from tarmac.plans.mart import run_job
from tarmac.session import build_session
from tarmac.sources.dump import dump_source
from tarmac.sources.tables import TableSource, warehouse_source


def _pairs(items: list[str] | None) -> dict[str, str]:
    """``key=value`` arguments as a dict."""
    out = {}
    for item in items or []:
        key, sign, value = item.partition("=")
        if not sign:
            raise SystemExit(f"expected key=value, got {item!r}")
        out[key] = value
    return out


def _source(
    fmt: str,
    location: str | None,
    dataset: str | None,
    staging: str | None,
    options: list[str] | None = None,
    names: list[str] | None = None,
    table_options: list[str] | None = None,
) -> TableSource:
    own: dict[str, dict[str, str]] = {}
    for key, value in _pairs(table_options).items():
        table, dot, option = key.partition(".")
        if not dot:
            raise SystemExit(f"expected table.option=value, got {key!r}")
        own.setdefault(table, {})[option] = value
    if dataset:
        source = warehouse_source(dataset, fmt=fmt, staging_bucket=staging)
    elif location or fmt == "jdbc":
        source = TableSource(format=fmt, location=location, table_option="dbtable" if fmt == "jdbc" else None)
    else:
        raise SystemExit("give a path template with {name}, a warehouse dataset or the jdbc format")
    return replace(source, options={**source.options, **_pairs(options)}, names=_pairs(names), table_options=own)


def main(argv: list[str] | None = None, spark=None) -> None:
    """Run the job; a session passed in is used and left running."""
    p = argparse.ArgumentParser(prog="python -m tarmac", description=__doc__.splitlines()[0])
    p.add_argument("--source", help="path template of the seven input tables, with {name}")
    p.add_argument("--source-format", default="parquet")
    p.add_argument("--source-option", action="append", metavar="KEY=VALUE", help="reader option of all input tables")
    p.add_argument("--name", action="append", metavar="TABLE=STORED", help="stored name of one input table")
    p.add_argument("--table-option", action="append", metavar="TABLE.KEY=VALUE", help="reader option of one input table")
    p.add_argument("--sink", help="path template of the output table, with {name}")
    p.add_argument("--sink-format", default="parquet")
    p.add_argument("--sink-option", action="append", metavar="KEY=VALUE", help="writer option")
    p.add_argument("--warehouse-dataset", help="dataset of connector-backed tables (source and sink)")
    p.add_argument("--staging-bucket", help="staging bucket option for connector writes")
    p.add_argument("--table", default="daily_airport_mart", help="name of the output table")
    p.add_argument("--lang", default=None, help="name language (default: first entry of each name)")
    p.add_argument("--partition-by", nargs="*", default=None, help="output partition columns, e.g. date")
    p.add_argument("--column", action="append", metavar="COLUMN=PUBLISHED", help="published name of one output column")
    args = p.parse_args(argv)

    own_session = spark is None
    if own_session:
        spark = build_session(app_name="daily-airport-mart")
    if args.source_format == "copy_dump":
        source = dump_source(spark, args.source, _pairs(args.name))
    else:
        source = _source(
            args.source_format,
            args.source,
            args.warehouse_dataset,
            args.staging_bucket,
            args.source_option,
            args.name,
            args.table_option,
        )
    dataset = None if args.sink else args.warehouse_dataset
    sink = _source(args.sink_format, args.sink, dataset, args.staging_bucket, args.sink_option)
    checks = Checks()
    written = run_job(
        spark, source, sink, table_name=args.table, lang=args.lang, partition_by=args.partition_by, columns=_pairs(args.column), checks=checks
    )
    print(f"wrote {args.table}: {len(written.columns)} columns")
    print("checks: " + ", ".join(f"{k} {v}" for k, v in sorted(checks.report().items())))
    if own_session:
        spark.stop()


if __name__ == "__main__":
    main()
