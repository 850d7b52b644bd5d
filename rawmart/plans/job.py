"""One run as a dataflow.

Order: zone tables first -> both batches built -> each landed (dead letters first, raw only when there are valid
rows) -> staging and mart steps in order, only if some valid rows landed. Steps are plain Python functions over
DataFrames, selected by name (``run_steps``), with settings passed as arguments instead of text templates.

A batch is noted in the state folder before its raw rows are written, and noted as done after its marts are: whatever
a failed run left in raw is staged by the next one, with the mart partitions it touches.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rawmart import fixed as X
from rawmart import schemas as S
from rawmart.functions import parse_once
from rawmart.operators.cursors import last_time_cursor, max_year_cursor
from rawmart.operators.merge import merge_upsert, overwrite_partitions, partition_filter
from rawmart.operators.quality import DEFAULT_MEASURES
from rawmart.plans import zones
from rawmart.session import SHREDDED_VARIANT_WRITE, by_folder, folder_count, materialize, path_exists, run_folders_write, scratch_scope, session_conf
from rawmart.sources.bodies import unwrap_with_errors
from rawmart.sources.landing import land_jsonl, landing_name, write_dead_letters


@dataclass
class Zones:
    """Folder layout of one deployment (any Hadoop path: shared file system or object store).

    ``prefix`` comes before the catalog's namespaces raw, staging and mart. Unless given it is made from ``base``, so
    that several deployments can share a catalog.
    """

    base: str
    prefix: str | None = None

    def path(self, name: str) -> str:
        return f"{self.base.rstrip('/')}/{name}"

    @property
    def landing(self) -> str:
        return self.path("landing")

    @property
    def dead_letters(self) -> str:
        return self.path("dead_letter")

    @property
    def rejects(self) -> str:
        return self.path("reject")

    @property
    def state(self) -> str:
        return self.path("state")

    @property
    def figures(self) -> str:
        return self.path("figures")

    @property
    def namespace(self) -> str:
        return f"z{zlib.crc32(self.base.rstrip('/').encode()):08x}_" if self.prefix is None else self.prefix

    def table(self, folder: str) -> str:
        """Catalog name of a folder such as ``mart/<table>``."""
        return self.namespace + folder.replace("/", ".")

    raw_indicator = property(lambda self: self.path(f"raw/{X.RAW_INDICATOR_TABLE}"))
    raw_hourly = property(lambda self: self.path(f"raw/{X.RAW_HOURLY_TABLE}"))
    stg_indicator = property(lambda self: self.path(f"staging/{X.STG_INDICATOR_TABLE}"))
    stg_hourly = property(lambda self: self.path(f"staging/{X.STG_HOURLY_TABLE}"))
    mart_indicator = property(lambda self: self.path(f"mart/{X.MART_INDICATOR_TABLE}"))
    mart_hourly = property(lambda self: self.path(f"mart/{X.MART_HOURLY_TABLE}"))


class Figures(Mapping):
    """A run's figures by entity, as written tables: the last column by the others. They number with the entities of the captured
    requests, so they reach the driver only where they are looked at one by one."""

    def __init__(self) -> None:
        self.tables: list[DataFrame] = []

    def _rows(self) -> Iterator[tuple]:
        for table in self.tables:
            yield from (tuple(r) for r in table.toLocalIterator())

    def __getitem__(self, key: tuple):
        for table in self.tables:
            *keys, value = table.columns
            same = [F.col(c).eqNullSafe(F.lit(k)) for c, k in zip(keys, key, strict=True)]
            for row in table.where(reduce(Column.__and__, same)).select(value).take(1):
                return row[0]
        raise KeyError(key)

    def __iter__(self) -> Iterator[tuple]:
        return (r[:-1] for r in self._rows())

    def __len__(self) -> int:
        return sum(table.count() for table in self.tables)

    def items(self) -> list[tuple[tuple, object]]:
        return [(r[:-1], r[-1]) for r in self._rows()]


@dataclass
class RunResult:
    landed: list[str] = field(default_factory=list)
    steps: list[str] = field(default_factory=list)
    # (source table, entity, outcome) -> rows; one entry per requested indicator / location and variant
    metrics: Figures = field(default_factory=Figures)
    # (source table, entity) -> cursor text of this run's valid rows
    cursors: Figures = field(default_factory=Figures)

    def report(self) -> Iterator[tuple]:
        """(source table, entity, outcome, rows, cursor), sorted; the cursor of valid rows, else None. Read part by part."""
        if not self.metrics.tables:
            return iter(())
        counts = reduce(DataFrame.unionByName, self.metrics.tables)
        if not self.cursors.tables:
            out = counts.withColumn("cursor", F.lit(None).cast("string"))
        else:
            own = reduce(DataFrame.unionByName, self.cursors.tables).withColumn("outcome", F.lit("valid"))
            out = counts.join(own, ["prefix", "entity", "outcome"], "left")
        columns = ["prefix", "entity", "outcome"]
        return (tuple(r) for r in out.orderBy(*columns).select(*columns, "records", "cursor").toLocalIterator())


@dataclass
class Batch:
    raw: DataFrame
    dead: DataFrame


def _stamp(df: DataFrame, run_id: str | None, ingested_at: str | None) -> DataFrame:
    """Bodies that carry their own run id and time keep them; others get this run's, fixed on the driver."""

    def own(name: str, value, kind: str):
        given = F.lit(value).cast(kind)
        return F.coalesce(F.col(name), given) if name in df.columns else given

    return df.withColumns({"extract_run_id": own("extract_run_id", run_id, "string"), "ingested_at": own("ingested_at", ingested_at, "timestamp_ntz")})


def build_batches(
    indicator_bodies: DataFrame | None,
    hourly_bodies: DataFrame | None,
    locations: DataFrame,
    run_id: str | None,
    ingested_at: str | None,
    enabled_variants: Sequence[str] = X.VARIANTS,
    measures: Sequence[str] = DEFAULT_MEASURES,
    indicator_ids: Sequence[str] | DataFrame | None = None,
    strict: bool = False,
) -> dict[str, Batch]:
    """O2/O3: both sources are built before anything is landed (a failing source aborts the run).

    ``indicator_ids`` limits the indicators: a short list, or a DataFrame with a column ``indicator_id`` of any length. ``enabled_variants`` and ``measures`` the hourly side. With ``strict`` a
    broken page fails the run; otherwise it is a dead letter.
    """
    out = {}
    if indicator_bodies is not None:
        bodies = _stamp(indicator_bodies, run_id, ingested_at)
        if indicator_ids is not None:
            chosen = isinstance(indicator_ids, DataFrame)
            bodies = bodies.join(indicator_ids.select("indicator_id"), "indicator_id", "left_semi") if chosen else bodies.where(F.col("indicator_id").isin(list(indicator_ids)))
        # each body is parsed once: the unwrap writes records and errors, and all that follows reads them
        records, errors = unwrap_with_errors(bodies, carry=("ingested_at",))
        if strict and (first := errors.first()) is not None:
            raise ValueError(f"page {first['page_no']} of {first['indicator_id']}: {first['reason']}")
        raw, dead = zones.indicator_batch(records, materialize=True)
        out[X.RAW_INDICATOR_TABLE] = Batch(raw, dead.unionByName(zones.page_dead_letters(errors)))
    if hourly_bodies is not None:
        stamped = _stamp(hourly_bodies, run_id, ingested_at)
        payloads = parse_once(stamped, "body", keep=stamped.columns)
        out[X.RAW_HOURLY_TABLE] = Batch(*zones.hourly_batch(payloads, locations, enabled_variants, measures, materialize=True))
    return out


def batch_metrics(prefix: str, raw: DataFrame, dead: DataFrame) -> DataFrame:
    """Valid and dead-lettered rows per requested indicator or per location and variant (G3): prefix, entity, outcome, records."""
    if prefix == X.RAW_INDICATOR_TABLE:
        valid_entity, dead_entity = F.col("indicator_id"), F.col("context")["indicator_id"]
    else:
        valid_entity = F.concat_ws("/", "location_id", "source_variant")
        dead_entity = F.concat_ws("/", F.col("context")["location_id"], F.col("context")["source_variant"])
    both = raw.select(valid_entity.alias("entity"), F.lit("valid").alias("outcome")).unionByName(
        dead.select(dead_entity.alias("entity"), F.lit("dead_letter").alias("outcome"))
    )
    counts = both.groupBy("entity", "outcome").agg(F.count(F.lit(1)).alias("records"))
    return counts.select(F.lit(prefix).alias("prefix"), "entity", "outcome", "records")


def batch_cursors(prefix: str, raw: DataFrame) -> DataFrame:
    """Greatest year text per indicator, or last time text of the newest payload per location and variant: prefix, entity, cursor."""
    if prefix == X.RAW_INDICATOR_TABLE:
        found = max_year_cursor(raw).select(F.col("indicator_id").alias("entity"), F.col("max_cursor_value").alias("cursor"))
    else:
        newest = F.max(F.struct("ingested_at", last_time_cursor().alias("cursor")))
        found = raw.groupBy(F.concat_ws("/", "location_id", "source_variant").alias("entity")).agg(newest.alias("n")).select("entity", "n.cursor")
    return found.select(F.lit(prefix).alias("prefix"), "entity", "cursor")


def _keep(spark: SparkSession, z: Zones, figures: DataFrame) -> DataFrame:
    """Figures of a run, written to a folder of their own."""
    path = f"{z.figures}/{uuid.uuid4().hex}"
    figures.write.mode("errorifexists").parquet(path)
    return spark.read.schema(figures.schema).parquet(path)


# ---------------------------------------------------------------- state of landed batches

_STATE = "id string, prefix string, source_file string, days array<date>, state string"


def _note(spark: SparkSession, z: Zones, *rows: tuple) -> None:
    spark.createDataFrame(list(rows), _STATE).coalesce(1).write.mode("append").json(z.state)


def unfinished(spark: SparkSession, z: Zones) -> list:
    """Noted batches that no run has taken to the marts: a row for each."""
    if not path_exists(spark, z.state):
        return []
    notes = spark.read.schema(_STATE).json(z.state)
    done = notes.where("state = 'done'").select("id")
    return notes.where("state = 'landed'").join(done, "id", "left_anti").collect()


def land_batch(spark: SparkSession, z: Zones, prefix: str, batch: Batch, run_id: str, label_iso: str, has_raw: bool, has_dead: bool) -> bool:
    """Dead letters first (even with no valid rows), then raw JSONL + raw table when not empty."""
    if has_dead:
        write_dead_letters(batch.dead, z.dead_letters, runs=folder_count(batch.dead, "source_name", "extract_run_id"))
    if not has_raw:
        return False
    name = landing_name(prefix, run_id, label_iso)
    landed = zones.with_ingest_date(batch.raw.withColumn("source_file", F.lit(name)))
    span = landed.groupBy(S.RAW_PART).agg(F.min("extract_run_id").alias("a"), F.max("extract_run_id").alias("b")).collect()
    days = sorted(r[S.RAW_PART] for r in span if r[S.RAW_PART] is not None)
    _note(spark, z, (uuid.uuid4().hex, prefix, name, days, "landed"))
    one_run = len({r["a"] for r in span} | {r["b"] for r in span}) == 1
    land_jsonl(batch.raw, f"{z.landing}/{prefix}", source_file=name, one_run=one_run, runs=1 if one_run else folder_count(batch.raw, "extract_run_id"))
    # raw zone: append, partitioned by ingest day, clustered by (entity, run); one day's rows stay where they are
    entity = "indicator_id" if prefix == X.RAW_INDICATOR_TABLE else "location_id"
    path = z.raw_indicator if prefix == X.RAW_INDICATOR_TABLE else z.raw_hourly
    rows = landed if len(span) == 1 else by_folder(landed, [S.RAW_PART], len(span))
    with session_conf(spark, SHREDDED_VARIANT_WRITE):
        rows.sortWithinPartitions(S.RAW_PART, entity, "extract_run_id").write.mode("append").partitionBy(S.RAW_PART).parquet(path)
    zones.register_partitions(spark, z.table(f"raw/{prefix}"), S.RAW_PART, days)
    return True


def _raw_rows(spark: SparkSession, path: str, schema, files: Sequence[str] | None, days: Sequence[date]) -> DataFrame:
    """Raw rows to stage: those of the named landing files (their ingest-day partitions only), or all of raw."""
    df = spark.read.schema(type(schema)([*schema.fields]).add(S.RAW_PART, "date")).parquet(path)
    if files is not None:
        df = df.where(F.col(S.RAW_PART).isin(list(days)) & F.col("source_file").isin(list(files)))
    return df


def step_functions(
    spark: SparkSession,
    z: Zones,
    tz: str,
    pending: Sequence | None = None,
    measures: Sequence[str] = DEFAULT_MEASURES,
    strict: bool = False,
    rejects: bool = True,
) -> dict[str, Callable[[], None]]:
    """The ordered transform steps (staging before mart).

    ``pending``: batches to stage (``unfinished``); ``None`` rescans all raw rows. Rows that can't reach staging go to the
    reject sink, or fail the step when ``strict`` (a bad time). A mart is a projection of staging, so its touched
    partitions are rebuilt from staging and replaced.
    """
    touched: dict[str, list[tuple] | None] = {"indicator": None, "hourly": None}

    def raw(prefix: str, path: str, schema) -> DataFrame:
        own = None if pending is None else [p for p in pending if p["prefix"] == prefix]
        files = None if own is None else sorted({p["source_file"] for p in own})
        return _raw_rows(spark, path, schema, files, sorted({d for p in own or [] for d in p["days"]}))

    def reject(found: DataFrame, source: str) -> None:
        if rejects:
            runs = folder_count(found, "extract_run_id")
            out = by_folder(found.withColumn("source_name", F.lit(source)), ["source_name", "extract_run_id"], runs)
            with session_conf(spark, run_folders_write(spark, runs)):
                out.write.mode("append").partitionBy("source_name", "extract_run_id").json(z.rejects)

    def register(folder: str, part: str, kind: str) -> None:
        zones.register_partitions(spark, z.table(folder), part, [t[0] for t in touched[kind] or []])

    # rows are parsed and typed once: staging and rejects come from one written table
    def stg_indicator():
        with scratch_scope(spark):
            typed = materialize(zones.indicator_typed(raw(X.RAW_INDICATOR_TABLE, z.raw_indicator, S.RAW_INDICATOR)), "typed")
            reject(zones.indicator_refused(typed), X.INDICATOR_SOURCE)
            src = zones.with_partition(zones.indicator_latest(typed, keep_order=True), "indicator")
            touched["indicator"] = merge_upsert(
                spark, z.stg_indicator, src, S.INDICATOR_KEYS, [S.INDICATOR_PART], ["country_iso3", "indicator_id"], recency=(zones.ORDER_COL,)
            )
        register(f"staging/{X.STG_INDICATOR_TABLE}", S.INDICATOR_PART, "indicator")

    def stg_hourly():
        with scratch_scope(spark):
            typed = materialize(zones.hourly_rows(raw(X.RAW_HOURLY_TABLE, z.raw_hourly, S.RAW_HOURLY), tz, measures, strict), "typed")
            if not strict:
                reject(zones.hourly_refused(typed), X.HOURLY_SOURCE)
            src = zones.with_partition(zones.hourly_latest(typed, measures, keep_order=True), "hourly")
            touched["hourly"] = merge_upsert(
                spark, z.stg_hourly, src, S.HOURLY_KEYS, [S.HOURLY_PART], ["location_id"], recency=(zones.ORDER_COL,)
            )
        register(f"staging/{X.STG_HOURLY_TABLE}", S.HOURLY_PART, "hourly")

    def mart(kind: str, stg_path: str, path: str, part: str, cluster: list[str], folder: str, source) -> None:
        if touched[kind] == [] or not path_exists(spark, stg_path):
            return
        stg = spark.read.parquet(stg_path)
        if touched[kind] is not None:  # without a staging step in this run, all of staging
            stg = stg.where(partition_filter([part], touched[kind]))
        rows = zones.with_partition(source(stg), kind)
        overwrite_partitions(spark, path, rows, [part], cluster)
        if touched[kind] is None:
            touched[kind] = [(r[0],) for r in spark.read.parquet(path).select(part).distinct().collect()]
        register(folder, part, kind)

    def mart_indicator():
        mart("indicator", z.stg_indicator, z.mart_indicator, S.INDICATOR_PART, ["country_iso3", "indicator_id"], f"mart/{X.MART_INDICATOR_TABLE}", zones.mart_indicator_source)

    def mart_hourly():
        mart("hourly", z.stg_hourly, z.mart_hourly, S.HOURLY_PART, ["location_id"], f"mart/{X.MART_HOURLY_TABLE}", lambda stg: zones.mart_hourly_source(stg, measures))

    return {"stage_indicator": stg_indicator, "stage_hourly": stg_hourly, "mart_indicator": mart_indicator, "mart_hourly": mart_hourly}


def run_steps(steps: dict[str, Callable[[], None]], names: Iterable[str] | None = None, exclude: Iterable[str] = ()) -> list[str]:
    """Run the steps in their order, or only the named ones, minus exclusions. An unknown name raises."""
    names = list(steps) if names is None else list(names)
    skip = set(exclude)
    if unknown := (set(names) | skip) - set(steps):
        raise ValueError(f"no such step: {sorted(unknown)}")
    ran = []
    for name in names:
        if name not in skip:
            steps[name]()
            ran.append(name)
    return ran


def run_job(
    spark: SparkSession,
    z: Zones,
    indicator_bodies: DataFrame | None,
    hourly_bodies: DataFrame | None,
    locations: DataFrame,
    run_id: str | None,
    ingested_at: str | None,
    tz: str = "UTC",
    incremental: bool = True,
    enabled_variants: Sequence[str] = X.VARIANTS,
    measures: Sequence[str] = DEFAULT_MEASURES,
    indicator_ids: Sequence[str] | DataFrame | None = None,
    strict: bool = False,
    steps: Iterable[str] | None = None,
    exclude: Iterable[str] = (),
) -> RunResult:
    """O1: one run end to end. Staging and mart steps only run when some valid rows landed.

    ``run_id`` and ``ingested_at`` (UTC) stamp bodies without stamps of their own. ``incremental`` stages every batch that no
    run has taken to the marts yet, this one included; otherwise all of raw is staged again. ``steps`` and ``exclude`` choose
    steps by name; a batch counts as done when both steps of its source ran.
    """
    result = RunResult()
    zones.create_zone_tables(spark, z.base, z.namespace, measures)
    with scratch_scope(spark):
        batches = build_batches(indicator_bodies, hourly_bodies, locations, run_id, ingested_at, enabled_variants, measures, indicator_ids, strict)
        for prefix, batch in batches.items():
            counts = _keep(spark, z, batch_metrics(prefix, batch.raw, batch.dead))
            result.metrics.tables.append(counts)
            outcomes = {r["outcome"] for r in counts.select("outcome").distinct().collect()}
            label_run, label_at = (run_id, ingested_at) if run_id is not None else ("captured", uuid.uuid4().hex)
            if land_batch(spark, z, prefix, batch, label_run, str(label_at), "valid" in outcomes, "dead_letter" in outcomes):
                result.landed.append(prefix)
                result.cursors.tables.append(_keep(spark, z, batch_cursors(prefix, batch.raw)))
    if not result.landed:
        return result
    pending = unfinished(spark, z)
    chosen = pending if incremental else None
    own = {X.RAW_INDICATOR_TABLE: ("stage_indicator", "mart_indicator"), X.RAW_HOURLY_TABLE: ("stage_hourly", "mart_hourly")}
    skip = set(exclude)
    for prefix, names in own.items():
        missing = all(p["prefix"] != prefix for p in pending) if incremental else not path_exists(spark, z.path(f"raw/{prefix}"))
        if missing:
            skip |= set(names)
    result.steps = run_steps(step_functions(spark, z, tz, chosen, measures, strict), steps, skip)
    done = [(p["id"], p["prefix"], p["source_file"], p["days"], "done") for p in pending if set(own[p["prefix"]]) <= set(result.steps)]
    if done:
        _note(spark, z, *done)
    return result
