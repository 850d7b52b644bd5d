"""Landing zone: newline JSON files per run, re-read with a fixed schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rawmart.fixed import LANDING_NAME, LANDING_TIME_REPLACE
from rawmart.schemas import DEAD_LETTER
from rawmart.session import by_folder, run_folders_write, session_conf


def landing_name(prefix: str, extract_run_id: str, labelled_at_iso: str) -> str:
    """``<prefix>_<run>_<iso with ':' -> '-'>.jsonl``; recorded in ``source_file`` of every landed row."""
    return LANDING_NAME.format(prefix=prefix, run=extract_run_id, at=labelled_at_iso.replace(*LANDING_TIME_REPLACE))


def land_jsonl(
    df: DataFrame, path: str, source_file: str | None = None, mode: str = "append", by_run: bool = True, one_run: bool = False, runs: int = 0
) -> None:
    """Write rows as newline JSON under ``path/extract_run_id=<run>/`` (one folder per run, or flat).

    NULL fields are written (``ignoreNullFields=false``); the VARIANT payload is written as nested JSON.
    ``mode`` is the write disposition: append (default), overwrite or errorifexists. The rows of many runs
    are first rebalanced by run, so the files number with the bytes and not with tasks times runs (``runs`` says
    about how many there are, where they can be more than the shuffle partitions); ``one_run``
    says that there is only one, which is written where its rows are, without a shuffle.
    """
    out = df if source_file is None else df.withColumn("source_file", F.lit(source_file))
    if by_run and not one_run:
        out = by_folder(out, ["extract_run_id"], runs)
    writer = out.write.mode(mode).option("ignoreNullFields", "false").option("compression", "none")
    if by_run:
        writer = writer.partitionBy("extract_run_id")
    with session_conf(df.sparkSession, run_folders_write(df.sparkSession, runs) if by_run else {}):
        writer.json(path)


def read_landed(spark: SparkSession, path: str, schema: StructType, corrupt_column: str | None = "_corrupt") -> DataFrame:
    """Read landed JSON with an explicit schema: unknown top-level fields are ignored, missing ones are
    NULL, drift inside ``payload`` is kept by the VARIANT type, and unreadable lines land in
    ``corrupt_column`` instead of failing the load. In a run-partitioned layout ``extract_run_id``
    comes back from the folder name with the schema's type (no partition type inference)."""
    read_schema = StructType(list(schema.fields))
    reader = spark.read
    if corrupt_column:
        read_schema = read_schema.add(corrupt_column, "string")
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column).option("mode", "PERMISSIVE")
    return reader.schema(read_schema).json(path)


def write_dead_letters(dead: DataFrame, path: str, runs: int = 0) -> None:
    """Dead-letter sink: newline JSON, one folder per source and run (of which there are about ``runs``); rebalanced, so files
    number with the bytes."""
    writer = (
        by_folder(dead.select(*DEAD_LETTER.fieldNames()), ["source_name", "extract_run_id"], runs)
        .write.mode("append")
        .option("ignoreNullFields", "false")
        .option("compression", "none")
        .partitionBy("source_name", "extract_run_id")
    )
    with session_conf(dead.sparkSession, run_folders_write(dead.sparkSession, runs)):
        writer.json(path)


def read_dead_letters(spark: SparkSession, path: str) -> DataFrame:
    """Dead letters back from the sink; partition folders give ``source_name`` and ``extract_run_id`` as text."""
    return spark.read.schema(DEAD_LETTER).json(path)
