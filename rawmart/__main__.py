"""Run one ingestion run as a Spark job.

    spark-submit -m rawmart --zones s3a://bucket/zones \
        --indicator-bodies s3a://bucket/captured/indicator --hourly-bodies s3a://bucket/captured/hourly \
        --locations "oslo:59.9139:10.7522;quito:-0.1807:-78.4678" --tz Europe/Oslo

Bodies are either body tables (``--bodies-format parquet|json``) or one captured response per file
(``--bodies-format files``, request in the folder names). Bodies that carry a run id and a capture time keep them;
others get the run id and ingestion time that are fixed once on the driver (a fresh 32-hex id and the current UTC time
with microseconds unless given).
"""

from __future__ import annotations

import argparse
import sys
import uuid
from datetime import datetime, timezone

from pyspark.sql import SparkSession


def parse_args(argv=None):
    p = argparse.ArgumentParser(prog="rawmart")
    p.add_argument("--zones", required=True, help="base folder of landing/raw/staging/mart/dead_letter")
    p.add_argument("--indicator-bodies")
    p.add_argument("--hourly-bodies")
    p.add_argument("--bodies-format", default="parquet", choices=["parquet", "json", "files"])
    p.add_argument("--locations", default="", help="id:lat:lon;id:lat:lon")
    p.add_argument("--tz", default="UTC", help="time zone of the hourly wall times")
    p.add_argument("--disable-archive", action="store_true")
    p.add_argument("--disable-forecast", action="store_true")
    p.add_argument("--run-id")
    p.add_argument("--ingested-at", help="ISO time of this run; an offset is converted to UTC, none means UTC")
    p.add_argument("--full-rescan", action="store_true", help="stage all raw rows instead of those not staged yet")
    p.add_argument("--indicators", default="", help="comma-separated indicator ids (default: all captured)")
    p.add_argument("--measures", default="", help="comma-separated hourly measures (default: the standard three)")
    p.add_argument("--steps", default="", help="comma-separated transform steps to run (default: all)")
    p.add_argument("--exclude-steps", default="", help="comma-separated transform steps to leave out")
    p.add_argument("--strict", action="store_true", help="fail on broken pages and bad local times instead of rejecting them")
    p.add_argument("--namespace-prefix", help="prefix of the catalog namespaces raw, staging, mart (default: from --zones)")
    p.add_argument("--versioned", action="store_true", help="take the run as one commit of a store of versioned tables below --zones")
    p.add_argument("--ui", action="store_true", help="keep the Spark web UI on (off by default)")
    return p.parse_args(argv)


def main(argv=None, spark: SparkSession | None = None):
    from rawmart import schemas as S
    from rawmart.fixed import MEASURES
    from rawmart.plans.job import Zones, run_job
    from rawmart.session import configure
    from rawmart.sources.captured import HOURLY_FILE_PARTS, INDICATOR_FILE_PARTS, read_body_files, read_body_table
    from rawmart.sources.config_text import parse_locations

    args = parse_args(argv)
    validate(args)
    if spark is None:
        builder = SparkSession.builder.appName("rawmart")
        if not args.ui:
            builder = builder.config("spark.ui.enabled", "false")
        spark = builder.getOrCreate()
    configure(spark)
    run_id = args.run_id or uuid.uuid4().hex
    ingested_at = utc_text(args.ingested_at)

    def bodies(path, schema, parts):
        if not path:
            return None
        if args.bodies_format == "files":
            return read_body_files(spark, path, parts)
        return read_body_table(spark, path, schema, args.bodies_format)

    indicator = bodies(args.indicator_bodies, S.INDICATOR_BODY, INDICATOR_FILE_PARTS)
    hourly = bodies(args.hourly_bodies, S.HOURLY_BODY, HOURLY_FILE_PARTS)
    locations = parse_locations(spark.range(1).selectExpr(f"{_sql_text(args.locations)} AS spec"))
    variants = [v for v, off in (("archive", args.disable_archive), ("forecast", args.disable_forecast)) if not off]
    listed = lambda text: [x.strip() for x in text.split(",") if x.strip()] or None
    if args.versioned:
        from rawmart.operators.snapshots import Store
        from rawmart.plans.ingest import run_once

        store = Store(spark, args.zones)
        landed = run_once(
            spark, store, indicator, hourly, locations, run_id, ingested_at, tz=args.tz, enabled_variants=variants,
            measures=listed(args.measures) or list(MEASURES), indicator_ids=listed(args.indicators), strict=args.strict,
        )
        print(f"run {run_id}: landed={landed} version={store.state().version}")
        return store
    result = run_job(
        spark, Zones(args.zones, args.namespace_prefix), indicator, hourly, locations, run_id, ingested_at, tz=args.tz,
        incremental=not args.full_rescan, enabled_variants=variants, measures=listed(args.measures) or list(MEASURES),
        indicator_ids=listed(args.indicators), strict=args.strict, steps=listed(args.steps), exclude=listed(args.exclude_steps) or (),
    )
    print(f"run {run_id}: landed={result.landed} steps={result.steps}")
    for source, entity, outcome, n, cursor in result.report():
        print(f"  {source} {entity} {outcome}: {n}" + (f" up to {cursor}" if cursor else ""))
    return result


def validate(args) -> None:
    """Fail before any Spark work on configuration errors."""
    from zoneinfo import ZoneInfo

    if args.versioned and (args.steps or args.exclude_steps or args.full_rescan):
        raise ValueError("--versioned takes a whole run: no --steps, --exclude-steps or --full-rescan")
    if not (args.indicator_bodies or args.hourly_bodies):
        raise ValueError("give --indicator-bodies and/or --hourly-bodies")
    if args.hourly_bodies:
        if not [p for p in args.locations.split(";") if p.strip()]:
            raise ValueError("--locations must name at least one location for hourly bodies")
        if args.disable_archive and args.disable_forecast:
            raise ValueError("archive and forecast are both disabled")
    try:
        ZoneInfo(args.tz)
    except Exception as ex:  # noqa: BLE001
        raise ValueError(f"unknown time zone {args.tz!r}") from ex


def utc_text(given: str | None) -> str:
    """The run's time as ISO text in UTC without offset, to the microsecond."""
    at = datetime.fromisoformat(given) if given else datetime.now(timezone.utc)
    if at.tzinfo is not None:
        at = at.astimezone(timezone.utc).replace(tzinfo=None)
    return at.isoformat()


def _sql_text(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


if __name__ == "__main__":
    main(sys.argv[1:])
