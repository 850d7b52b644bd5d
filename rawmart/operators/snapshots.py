"""Tables whose readers see whole versions only: immutable Parquet folders, and one commit file for each version.

A store is a folder with many tables. Every transaction writes its rows to folders of its own
(``data/<table>/_commit=<id>/<part>=<value>``) and then puts one new file into ``commits``, whose name is the next version's number and whose text
names the folders of all tables in that version. Only that last step makes anything visible, for all tables at once, so a
reader sees the version before or after it and a killed transaction leaves nothing but folders that no version names.

The file of a version can be made once only. A transaction that finds its number taken looks at what the others changed: if
they left the partitions that it read as they were, it takes the next number; otherwise it raises ``Conflict`` and ``transact``
runs it again on the newer version. So overlapping runs end as if they had run one after another.

A commit file has a line's worth of text for each folder in use, that is for each partition and each append since the last
``compact``; it is read and written by the driver. Its making relies on a file system whose rename or link fails when the target
exists (HDFS, local disks); object stores need a connector that has such a rename.

A table may be bucketed by its upsert keys (J6, J7). The rows of a key then lie in the same bucket of every version, so an upsert
shuffles its source only: the touched partitions of the target are read bucket by bucket, joined, and written as the same buckets.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, IntegralType, StructType

from rawmart.operators.merge import merge_plan
from rawmart.session import create_once, delete_path, list_names, modified_ms, path_exists, read_text, scratch_path, scratch_scope

COMMIT_COL = "_commit"
NULL_PART = "=__HIVE_DEFAULT_PARTITION__"


class Conflict(Exception):
    """Another transaction changed what this one had read."""


@dataclass
class Entry:
    """A folder of a table: the rows of one partition that one transaction wrote, with least and greatest values of some columns:
    numbers as numbers, all else as text, whose order is that of the values for text, dates and timestamps."""

    commit: str
    folder: str
    rows: int
    stats: dict[str, list] = field(default_factory=dict)

    @property
    def key(self) -> tuple[str, str]:
        return self.commit, self.folder


@dataclass
class Buckets:
    """Rows lie in ``n`` buckets by the hash of ``keys``; a task reads one bucket of all partitions that are read at once."""

    n: int
    keys: list[str]


@dataclass
class Table:
    part: str
    schema: StructType
    entries: list[Entry] = field(default_factory=list)
    buckets: Buckets | None = None

    def folders(self, names: set[str] | None = None) -> dict[str, set[tuple[str, str]]]:
        out: dict[str, set[tuple[str, str]]] = {}
        for e in self.entries:
            if names is None or e.folder in names:
                out.setdefault(e.folder, set()).add(e.key)
        return out


@dataclass
class State:
    version: int = 0
    tables: dict[str, Table] = field(default_factory=dict)
    streams: dict[str, int] = field(default_factory=dict)

    def to_json(self) -> str:
        tables = {n: {"part": t.part, "schema": t.schema.jsonValue(), "entries": [[e.commit, e.folder, e.rows, e.stats] for e in t.entries], "buckets": t.buckets and [t.buckets.n, t.buckets.keys]} for n, t in self.tables.items()}
        return json.dumps({"version": self.version, "tables": tables, "streams": self.streams})

    @staticmethod
    def of(text: str) -> State:
        raw = json.loads(text)
        buckets = {n: Buckets(*t["buckets"]) if t.get("buckets") else None for n, t in raw["tables"].items()}
        tables = {n: Table(t["part"], StructType.fromJson(t["schema"]), [Entry(*e) for e in t["entries"]], buckets[n]) for n, t in raw["tables"].items()}
        return State(raw["version"], tables, raw["streams"])


class Store:
    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")

    def _commit_path(self, version: int) -> str:
        return f"{self.base}/commits/{version:020d}"

    def data(self, table: str) -> str:
        return f"{self.base}/data/{table}"

    def versions(self) -> list[int]:
        return [int(n) for n in list_names(self.spark, f"{self.base}/commits") if n.isdigit()]

    def state(self, version: int | None = None) -> State:
        """A version's state; without a number the newest one's (an empty one before the first commit)."""
        if version is None:
            version = max(self.versions(), default=0)
        return State.of(read_text(self.spark, self._commit_path(version))) if version else State()

    def read(self, table: str, version: int | None = None, state: State | None = None, folders: set[str] | None = None, between: dict[str, tuple] | None = None) -> DataFrame:
        """The rows of a table in one version (the newest, unless given); only of partitions ``folders`` (``part=value``).

        The DataFrame names its folders, so later commits don't change it. ``between`` (column -> (least, greatest)) leaves out
        folders whose statistics show that they have no such row; the caller still filters the rows.
        """
        t = (state or self.state(version)).tables[table]
        own = [e for e in t.entries if (folders is None or e.folder in folders) and _may_hold(e, between or {})]
        if not own:
            return self.spark.createDataFrame([], t.schema)
        schema = StructType([*t.schema.fields]).add(COMMIT_COL, "string")
        paths = [f"{self.data(table)}/{COMMIT_COL}={e.commit}/{e.folder}" for e in own]
        return self.spark.read.schema(schema).option("basePath", self.data(table)).parquet(*paths).select(*t.schema.fieldNames())

    @contextmanager
    def read_buckets(self, table: str, state: State, folders: set[str]) -> Iterator[DataFrame | None]:
        """Partitions ``folders`` of a bucketed table as a scan that Spark knows to be partitioned by the keys; None if it can't be.

        Only the catalog can tell a scan its buckets, so an external table that names the folders stands there meanwhile.
        Rows without a partition value, and partitions in several folders, have no such form.
        """
        t = state.tables[table]
        own = [e for e in t.entries if e.folder in folders]
        plain = t.buckets is None or not own or len({e.folder for e in own}) < len(own) or any(e.folder.endswith(NULL_PART) for e in own)
        if plain:
            yield None
            return
        name, home = f"bucketed_{uuid.uuid4().hex}", scratch_path(self.spark, f"materialized/bucketed-{uuid.uuid4().hex}")
        try:
            empty = self.spark.createDataFrame([], t.schema).write.format("parquet").partitionBy(t.part)
            empty.bucketBy(t.buckets.n, *t.buckets.keys).option("path", home).saveAsTable(name)
            quoted = lambda text: "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
            at = [f"PARTITION (`{t.part}` = {quoted(_unquoted(e.folder.split('=', 1)[1]))}) LOCATION {quoted(f'{self.data(table)}/{COMMIT_COL}={e.commit}/{e.folder}')}" for e in own]
            self.spark.sql(f"ALTER TABLE {name} ADD {' '.join(at)}")
            yield self.spark.table(name).select(*t.schema.fieldNames())
        finally:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")  # an external table's files stay
            delete_path(self.spark, home)

    def begin(self) -> Transaction:
        return Transaction(self)

    def compact(self, table: str, at_least: int = 2) -> int:
        """Rewrite partitions that lie in ``at_least`` folders or more as one folder each; returns how many. Rows don't change."""

        def rewrite(txn: Transaction) -> int:
            t = txn.state.tables.get(table)
            many = {f for f, keys in t.folders().items() if len(keys) >= at_least} if t else set()
            if many:
                stats = sorted({c for e in t.entries for c in e.stats})
                txn.replace(table, self.read(table, state=txn.state, folders=many), t.part, stats=stats, reads=many)
            return len(many)

        return transact(self, rewrite)

    def vacuum(self, keep: int = 10, older_than_ms: int = 24 * 3600 * 1000) -> int:
        """Delete what the last ``keep`` versions don't name: older commit files, and folders that no transaction has touched for
        ``older_than_ms`` (a running one may not be committed yet). Returns the number of deleted data folders."""
        versions = sorted(self.versions())
        for v in versions[:-keep]:
            delete_path(self.spark, self._commit_path(v))
        used = {(n, e.commit, e.folder) for v in versions[-keep:] for n, t in self.state(v).tables.items() for e in t.entries}
        now = int(self.spark.sql("SELECT unix_millis(current_timestamp())").first()[0])
        gone = 0
        for table in self._tables():
            for commit in list_names(self.spark, self.data(table)):
                folder = f"{self.data(table)}/{commit}"
                names = [n for n in list_names(self.spark, folder) if "=" in n]
                live = [n for n in names if (table, commit.split("=", 1)[-1], n) in used]
                if now - modified_ms(self.spark, folder) < older_than_ms:
                    continue
                for n in names:
                    if n not in live:
                        delete_path(self.spark, f"{folder}/{n}")
                        gone += 1
                if not live:
                    delete_path(self.spark, folder)
        return gone

    def _tables(self) -> list[str]:
        zones = list_names(self.spark, f"{self.base}/data")
        return [f"{zone}/{name}" for zone in zones for name in list_names(self.spark, f"{self.base}/data/{zone}")]


def _may_hold(entry: Entry, between: dict[str, tuple]) -> bool:
    for column, (least, greatest) in between.items():
        low, high = entry.stats.get(column, [None, None])
        alike = (lambda v: v) if isinstance(low, int | float) else str
        if low is not None and ((greatest is not None and low > alike(greatest)) or (least is not None and high < alike(least))):
            return False
        if low is None and column in entry.stats:  # all null
            return False
    return True


class Transaction:
    """Changes to tables of a store; they are visible after ``commit``. Names of tables are ``<zone>/<table>``."""

    def __init__(self, store: Store):
        self.store, self.spark, self.id = store, store.spark, uuid.uuid4().hex
        self.state = store.state()
        self.added: list[tuple[str, Table, set[str]]] = []  # table, what it gains, partitions that this replaces
        self.reads: dict[str, set[str]] = {}
        self.marks: dict[str, int] = {}
        self._n = 0

    # ------------------------------------------------------------ what a transaction does

    def read(self, table: str, folders: set[str] | None = None) -> DataFrame | None:
        """Rows as this transaction sees them at its start; the partitions read (all, without ``folders``) may not change until the commit."""
        t = self.state.tables.get(table)
        if t is None:
            self.reads.setdefault(table, set()).update(folders or {"*"})
            return None
        self.reads.setdefault(table, set()).update({"*"} if folders is None else folders)
        return self.store.read(table, state=self.state, folders=folders)

    def append(self, table: str, rows: DataFrame, part: str, cluster: Sequence[str] = (), stats: Sequence[str] = ()) -> list[Entry]:
        """Add rows; appends of several transactions never conflict. A bucketed table takes no appends, as its partitions are one folder each."""
        if (t := self.state.tables.get(table)) is not None and t.buckets is not None:
            raise ValueError(f"{table} is bucketed; upsert or replace")
        return self._write(table, rows, part, cluster, stats, replace=False).entries

    def replace(self, table: str, rows: DataFrame, part: str, cluster: Sequence[str] = (), stats: Sequence[str] = (), reads: set[str] = frozenset()) -> list[Entry]:
        """Replace exactly the partitions that ``rows`` has (and those in ``reads``, from which rows were made)."""
        if reads:
            self.reads.setdefault(table, set()).update(reads)
        return self._write(table, rows, part, cluster, stats, replace=True).entries

    def upsert(self, table: str, source: DataFrame, keys: Sequence[str], part: str, cluster: Sequence[str] = (), recency: Sequence[str] | None = None, stats: Sequence[str] = (), buckets: int | None = None) -> set[str]:
        """Upsert key-unique ``source`` by ``keys``, of which ``part`` is a function. Returns the partitions (``part=value``) it has rows in.

        The source is written once, by partition, which names the touched partitions without collecting a value. With ``recency`` a
        matched row is replaced only by one that is not older; both sides then meet in a single join. ``buckets`` lays a new table
        out in that many buckets by ``keys`` (``part`` not among them); later upserts keep them and shuffle the source alone.
        """
        known = self.state.tables.get(table)
        layout = known.buckets if known is not None else Buckets(buckets, list(keys)) if buckets else None
        if buckets and layout != Buckets(buckets, list(keys)):
            raise ValueError(f"{table} has the layout {layout}, not {buckets} buckets by {list(keys)}")
        if layout is not None and part in layout.keys:
            raise ValueError(f"{part} can't be a bucket key and the partition")
        path = scratch_path(self.spark, f"materialized/upsert-{self.id}-{self._next()}")
        try:
            source.hint("rebalance", part).write.mode("errorifexists").partitionBy(part).parquet(path)
            touched = {n for n in list_names(self.spark, path) if "=" in n}
            if not touched:
                return touched
            src = self.spark.read.schema(source.schema).parquet(path).select(*source.columns)
            target = self.read(table, touched)
            if target is None:
                self._write(table, src, part, cluster, stats, replace=True, buckets=layout)
                return touched
            with self.store.read_buckets(table, self.state, touched) as bucketed:
                target = _with_columns_of(target if bucketed is None else bucketed, src)
                src = src if bucketed is None else src.repartition(layout.n, *layout.keys)
                merged = merge_plan(target, src, keys) if recency is None else merge_newest(target, _with_columns_of(src, target), keys, recency)
                self._write(table, merged, part, cluster, stats, replace=True, buckets=layout, laid_out=bucketed is not None)
            return touched
        finally:
            delete_path(self.spark, path)

    def gained(self, table: str) -> DataFrame | None:
        """The rows this transaction has written to a table; None if there are none."""
        own = [t for n, t, _ in self.added if n == table and t.entries]
        if not own:
            return None
        schema = own[0].schema
        for t in own[1:]:
            schema = evolved(schema, t.schema)
        return self.store.read(table, state=State(tables={table: Table(own[0].part, schema, [e for t in own for e in t.entries])}))

    def mark(self, stream: str, batch: int) -> bool:
        """Note that ``batch`` of a stream is in this commit. False: an earlier commit has it, so there is nothing to do."""
        if self.state.streams.get(stream, -1) >= batch:
            return False
        self.marks[stream] = batch
        return True

    def commit(self) -> int | None:
        """Make all changes visible as the next version and return its number; None if there are none."""
        if not self.added and not self.marks:
            return None
        while True:
            now = self.store.state()
            if now.version != self.state.version:
                self._check(now)
            for table, gain, replaced in self.added:
                t = now.tables.get(table)
                if t is None:
                    now.tables[table] = Table(gain.part, gain.schema, list(gain.entries), gain.buckets)
                    continue
                if t.part != gain.part:
                    raise ValueError(f"{table} is partitioned by {t.part}, not {gain.part}")
                if t.buckets != gain.buckets:
                    raise ValueError(f"{table} has the layout {t.buckets}, not {gain.buckets}")
                t.schema = evolved(t.schema, gain.schema)
                t.entries = [e for e in t.entries if e.folder not in replaced] + gain.entries
            now.streams.update(self.marks)
            now.version += 1
            if create_once(self.spark, self.store._commit_path(now.version), now.to_json()):
                return now.version

    # ------------------------------------------------------------ inside

    def _next(self) -> int:
        self._n += 1
        return self._n

    def _write(self, table: str, rows: DataFrame, part: str, cluster: Sequence[str], stats: Sequence[str], replace: bool, buckets: Buckets | None = None, laid_out: bool = False) -> Table:
        """``laid_out``: the rows of a bucket come from few tasks already, so they are written as they are."""
        if buckets is None and (t := self.state.tables.get(table)) is not None:
            buckets = t.buckets
        commit = f"{self.id}-{self._next()}"
        path = f"{self.store.data(table)}/{COMMIT_COL}={commit}"
        if buckets is None:
            out = rows.hint("rebalance", part)
            out = out.sortWithinPartitions(part, *cluster) if cluster else out
            out.write.mode("errorifexists").partitionBy(part).parquet(path)
        else:
            out = rows if laid_out else rows.repartition(buckets.n, *buckets.keys)
            name = f"bucketed_{uuid.uuid4().hex}"
            writer = out.write.format("parquet").partitionBy(part).bucketBy(buckets.n, *buckets.keys).option("path", path)
            try:
                (writer.sortBy(*cluster) if cluster else writer).saveAsTable(name)
            finally:
                self.spark.sql(f"DROP TABLE IF EXISTS {name}")  # an external table's files stay
        columns = [f for f in rows.schema.fields if f.name != part] + [f for f in rows.schema.fields if f.name == part]
        schema = StructType([type(f)(f.name, f.dataType, True) for f in columns])
        names = [n for n in list_names(self.spark, path) if "=" in n]
        gain = Table(part, schema, self._entries(path, commit, schema, stats) if names else [], buckets)
        self.added.append((table, gain, set(names) if replace else set()))
        return gain

    def _entries(self, path: str, commit: str, schema: StructType, stats: Sequence[str]) -> list[Entry]:
        """Rows, least and greatest values of the folders just written: a scan of the statistics' columns alone."""
        found = folder_stats(self.spark.read.schema(schema).parquet(path), stats).collect()  # a row for each partition
        return [Entry(commit, _unquoted(r["_folder"]), r["n"], {c: [r[f"lo_{c}"], r[f"hi_{c}"]] for c in stats}) for r in found]

    def _check(self, now: State) -> None:
        for table, folders in self.reads.items():
            whole = "*" in folders
            names = None if whole else folders
            before, after = (s.tables[table].folders(names) if table in s.tables else {} for s in (self.state, now))
            if before != after:
                raise Conflict(f"{table}: {sorted(f for f in {*before, *after} if before.get(f) != after.get(f))[:5]}")
        for stream in self.marks:
            if now.streams.get(stream) != self.state.streams.get(stream):
                raise Conflict(f"stream {stream}")


def folder_stats(rows: DataFrame, stats: Sequence[str]) -> DataFrame:
    """Per folder of a scan: ``_folder``, rows ``n``, ``lo_<c>`` and ``hi_<c>`` of each of ``stats``.

    Rows are grouped by their file's path as it is; only a file's row is taken to its folder, since a pattern on the path of every
    row costs more than the scan.
    """
    text = lambda c: F.col(c) if isinstance(rows.schema[c].dataType, IntegralType | FloatType | DoubleType) else F.col(c).cast("string")
    of = [x for c in stats for x in (F.min(text(c)).alias(f"lo_{c}"), F.max(text(c)).alias(f"hi_{c}"))]
    both = [x for c in stats for x in (F.min(f"lo_{c}").alias(f"lo_{c}"), F.max(f"hi_{c}").alias(f"hi_{c}"))]
    files = rows.select("*", F.col("_metadata.file_path").alias("_file")).groupBy("_file").agg(F.count(F.lit(1)).alias("n"), *of)
    return files.groupBy(F.element_at(F.split("_file", "/"), -2).alias("_folder")).agg(F.sum("n").alias("n"), *both)


def _unquoted(name: str) -> str:
    """A folder's name as the file system lists it, from the URI text of ``_metadata.file_path``."""
    from urllib.parse import unquote

    return unquote(name)


def _with_columns_of(rows: DataFrame, other: DataFrame) -> DataFrame:
    """``rows`` with a null column for each that only ``other`` has."""
    new = [f for f in other.schema.fields if f.name not in rows.columns]
    return rows if not new else rows.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in new])


def evolved(old: StructType, new: StructType) -> StructType:
    """The old fields and those that are new, all nullable; a field of another type raises (S3: fields are only added)."""
    have = {f.name: f.dataType for f in old.fields}
    for f in new.fields:
        if f.name in have and have[f.name] != f.dataType:
            raise ValueError(f"field {f.name} is {have[f.name].simpleString()}, not {f.dataType.simpleString()}")
    return StructType([*old.fields, *[f for f in new.fields if f.name not in have]])


def merge_newest(target: DataFrame, source: DataFrame, keys: Sequence[str], recency: Sequence[str]) -> DataFrame:
    """Both sides joined once: of a target and a source row with one key the newer, the source's if neither is. Rows with a null key stay."""
    cols = target.columns
    pack = lambda df, name: df.select(*[F.col(k).alias(f"{name}_{i}") for i, k in enumerate(keys)], F.struct(*cols).alias(name))
    t, s = pack(target, "_t"), pack(source, "_s")
    on = [F.col(f"_t_{i}") == F.col(f"_s_{i}") for i in range(len(keys))]
    order = lambda name: F.struct(*[F.col(f"{name}.{c}") for c in recency])
    keep = F.col("_s").isNull() | (F.col("_t").isNotNull() & (order("_t") > order("_s")))
    return t.join(s, on, "full_outer").select(F.when(keep, F.col("_t")).otherwise(F.col("_s")).alias("r")).select(*[F.col(f"r.{c}").alias(c) for c in cols])


def transact(store: Store, work: Callable[[Transaction], object], attempts: int = 10):
    """Run ``work`` in a transaction and commit it; if what it read has changed meanwhile, run it again on the newer version."""
    for attempt in range(1, attempts + 1):
        txn = store.begin()
        with scratch_scope(store.spark):
            result = work(txn)
        try:
            txn.commit()
        except Conflict:
            if attempt == attempts:
                raise
            continue
        return result


def freshness(store: Store, tables: dict[str, str], as_of, max_age_hours: float, column: str = "ingested_at") -> DataFrame:
    """C5 from the statistics of the newest version: source, last_ingested_at, age_hours, is_stale; no data file is read."""
    state = store.state()
    last = lambda t: max((e.stats[column][1] for e in state.tables[t].entries if e.stats.get(column, [None])[-1] is not None), default=None) if t in state.tables else None
    rows = store.spark.createDataFrame([(name, last(t)) for name, t in tables.items()], "source string, last string")
    at = F.col("last").cast("timestamp_ntz")
    age = F.timestamp_diff("MICROSECOND", at, F.lit(as_of).cast("timestamp_ntz")) / 3.6e9
    return rows.select("source", at.alias("last_ingested_at"), age.alias("age_hours"), (at.isNull() | (age > F.lit(max_age_hours))).alias("is_stale"))
