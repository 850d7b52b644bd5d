"""Session settings the engine relies on."""

from __future__ import annotations

import re
import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

# Settings every job needs; they change results or safety, not just speed.
REQUIRED_CONF = {
    # Operators never depend on the session zone, but pin it so displayed values are stable.
    "spark.sql.session.timeZone": "UTC",
    # Upserts rewrite only the partitions they touch.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # rebalance before partitioned writes splits a hot partition (one day, one year) into many tasks
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def build_session(
    master: str = "local[*]", shuffle_partitions: int = 8, app: str = "rawmart", conf: dict | None = None
) -> SparkSession:
    """Local session for tests and the bench. On a cluster, use the cluster's session and call ``configure``."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
    )
    for key, value in {**REQUIRED_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings the operators need to an existing session."""
    for key, value in REQUIRED_CONF.items():
        spark.conf.set(key, value)
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set by the cluster (a shared file system): a machine-local folder would lose
    intermediate tables, so an unset folder raises there. Only on a local master (tests) a fresh local
    scratch folder is set.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not is_local(spark):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        current = tempfile.mkdtemp(prefix="rawmart-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    if spark.sparkContext.getCheckpointDir() is None:
        # each call makes a fresh sub-folder, so set it once per context
        spark.sparkContext.setCheckpointDir(current)
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for intermediate tables."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"


def is_local(spark: SparkSession) -> bool:
    """Whether driver and executors are one process (``local-cluster`` has executors of its own)."""
    return re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master) is not None


def _hadoop(spark: SparkSession, path: str):
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jpath


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = _hadoop(spark, path)
    return fs.exists(jpath)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the direct children of a folder; empty when it does not exist."""
    fs, jpath = _hadoop(spark, path)
    return sorted(st.getPath().getName() for st in fs.listStatus(jpath)) if fs.exists(jpath) else []


def delete_path(spark: SparkSession, path: str) -> None:
    fs, jpath = _hadoop(spark, path)
    fs.delete(jpath, True)


def read_text(spark: SparkSession, path: str) -> str:
    """A small file's text."""
    fs, jpath = _hadoop(spark, path)
    stream = fs.open(jpath)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def bytes_below(spark: SparkSession, path: str) -> int:
    """Bytes of a file or of all files in a folder."""
    fs, jpath = _hadoop(spark, path)
    return fs.getContentSummary(jpath).getLength()


def modified_ms(spark: SparkSession, path: str) -> int:
    fs, jpath = _hadoop(spark, path)
    return fs.getFileStatus(jpath).getModificationTime()


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Make a small file with this text, at once and whole. False, and nothing is changed, if the file is there already.

    The text is written beside it first. On a local disk a hard link then gives it its name, elsewhere a rename that does not
    overwrite; both fail if another process came first.
    """
    jvm = spark.sparkContext._jvm
    fs, target = _hadoop(spark, path)
    _, draft = _hadoop(spark, f"{path}.{uuid.uuid4().hex}.tmp")
    stream = fs.create(draft, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    try:
        if fs.getUri().getScheme() == "file":
            local = lambda p: jvm.java.io.File(p.toUri().getPath()).toPath()
            jvm.java.nio.file.Files.createLink(local(target), local(draft))
        else:
            kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
            how = spark.sparkContext._gateway.new_array(kind, 1)
            how[0] = kind.NONE
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark.sparkContext._jsc.hadoopConfiguration()).rename(draft, target, how)
        return True
    except Py4JJavaError as e:
        if "FileAlreadyExistsException" not in e.java_exception.getClass().getName():
            raise
        return False
    finally:
        fs.delete(draft, False)


def delete_at_exit(spark: SparkSession, path: str) -> str:
    """Scratch whose reader is not known (a query's lazy result) goes when the application ends."""
    fs, jpath = _hadoop(spark, path)
    fs.deleteOnExit(jpath)
    return path


# scratch tables of the innermost open scope of this thread of control
_SCOPE: ContextVar[list[str] | None] = ContextVar("rawmart_scratch", default=None)


@contextmanager
def scratch_scope(spark: SparkSession):
    """Scratch tables written inside belong to this scope and are deleted when it ends, also after a failure.

    Scopes nest, and scopes of concurrent runs (threads) don't see each other.
    """
    token = _SCOPE.set([])
    try:
        yield
    finally:
        paths = _SCOPE.get()
        _SCOPE.reset(token)
        for path in paths:
            delete_path(spark, path)


def materialize(df, name: str, partition_by=()):
    """Cut lineage: write ``df`` once as Parquet under the shared checkpoint folder and read it back.

    One pass over the input (an eager ``DataFrame.checkpoint`` on an uncached plan computes it twice),
    columnar, and on the shared file system, so a lost executor recomputes nothing upstream.
    With ``partition_by`` the scratch table is laid out in partition folders, each written by tasks of
    bounded size. Deleted with the open ``scratch_scope``, else at the end of the application.
    """
    import uuid

    spark = df.sparkSession
    path = scratch_path(spark, f"materialized/{name}/{uuid.uuid4().hex}")
    scope = _SCOPE.get()
    if scope is None:
        delete_at_exit(spark, path)
    else:
        scope.append(path)
    if partition_by:
        df.hint("rebalance", *partition_by).write.mode("errorifexists").partitionBy(*partition_by).parquet(path)
    else:
        df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def partition_values(df, partition_by) -> list[tuple]:
    """Distinct partition values of a table, by an aggregate that is combined in the tasks (one row per partition)."""
    found = [tuple(r) for r in df.select(*partition_by).distinct().collect()]
    return sorted(found, key=lambda t: tuple((v is None, v) for v in t))


def folder_count(df, *cols) -> int:
    """About how many folders a write partitioned by ``cols`` makes (one pass over these columns, one row to the driver)."""
    from pyspark.sql import functions as F

    return df.agg(F.approx_count_distinct(F.struct(*cols), 0.02)).first()[0]


def by_folder(df, cols, folders: int = 0):
    """``df`` rebalanced for a write partitioned by ``cols`` into about ``folders`` folders.

    A shuffle part above the advisory size is split, and each piece can hold all of the part's folders. With a part for each
    folder the files number with the folders plus the bytes, not with their product; small parts are joined.
    """
    parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), folders)
    return df.hint("rebalance", parts, *cols)


class session_conf:
    """Set session settings for the duration of a ``with`` block, restoring the previous values."""

    def __init__(self, spark, settings: dict):
        self.spark, self.settings, self.saved = spark, settings, {}

    def __enter__(self):
        for key, value in self.settings.items():
            self.saved[key] = self.spark.conf.get(key, None)
            self.spark.conf.set(key, value)
        return self.spark

    def __exit__(self, *exc):
        for key, value in self.saved.items():
            if value is None:
                self.spark.conf.unset(key)
            else:
                self.spark.conf.set(key, value)
        return False


# Sinks with a folder for each run: opening a run's file costs far more than its few rows, so their tasks get small shares.
RUN_FOLDERS_WRITE = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "2m"}
# With more folders than shuffle partitions a share of 2 MB can hold dozens of files, one after another.
MANY_FOLDERS_WRITE = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "256k"}


def run_folders_write(spark, folders: int) -> dict:
    """Settings of a write with about so many run folders."""
    return MANY_FOLDERS_WRITE if folders > int(spark.conf.get("spark.sql.shuffle.partitions")) else RUN_FOLDERS_WRITE

# Raw-zone Parquet writes shred the VARIANT payload into typed sub-columns inferred from the data:
# smaller files and faster path extraction for every later staging scan (Spark 4.1 Parquet variant shredding).
SHREDDED_VARIANT_WRITE = {
    "spark.sql.variant.writeShredding.enabled": "true",
    "spark.sql.variant.inferShreddingSchema": "true",
}
