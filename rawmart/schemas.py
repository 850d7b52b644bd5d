"""Table schemas of the zones (raw, staging, mart) and of the captured inputs."""

from pyspark.sql.types import (
    BooleanType,
    DoubleType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    VariantType,
)

from rawmart.fixed import MEASURES

TS = TimestampNTZType()  # UTC instants, independent of the session time zone


def _s(*fields):
    return StructType([StructField(n, t, True) for n, t in fields])


INDICATOR_BODY = _s(
    ("indicator_id", StringType()),
    ("page_no", IntegerType()),
    ("body", StringType()),
    ("extract_run_id", StringType()),
    ("ingested_at", TS),
)
HOURLY_BODY = _s(
    ("location_id", StringType()),
    ("source_variant", StringType()),
    ("body", StringType()),
    ("extract_run_id", StringType()),
    ("ingested_at", TS),
)
LOCATION = _s(("location_id", StringType()), ("latitude", DoubleType()), ("longitude", DoubleType()))

RAW_INDICATOR = _s(
    ("ingested_at", TS),
    ("extract_run_id", StringType()),
    ("source_file", StringType()),
    ("indicator_id", StringType()),
    ("payload", VariantType()),
)
RAW_HOURLY = _s(
    ("ingested_at", TS),
    ("extract_run_id", StringType()),
    ("source_file", StringType()),
    ("location_id", StringType()),
    ("latitude", DoubleType()),
    ("longitude", DoubleType()),
    ("source_variant", StringType()),
    ("payload", VariantType()),
)
DEAD_LETTER = _s(
    ("source_name", StringType()),
    ("reason", StringType()),
    ("ingested_at", TS),
    ("extract_run_id", StringType()),
    ("context", MapType(StringType(), StringType())),
    ("payload", VariantType()),
)
STG_INDICATOR = _s(
    ("country_iso3", StringType()),
    ("country_name", StringType()),
    ("indicator_id", StringType()),
    ("indicator_name", StringType()),
    ("year", LongType()),
    ("value_num", DoubleType()),
    ("ingested_at", TS),
    ("extract_run_id", StringType()),
)
MART_INDICATOR = _s(*[(f.name, f.dataType) for f in STG_INDICATOR.fields if f.name not in ("ingested_at", "extract_run_id")])
_LINEAGE = (("ingested_at", TS), ("extract_run_id", StringType()))


def stg_hourly(measures=MEASURES) -> StructType:
    place = (("location_id", StringType()), ("latitude", DoubleType()), ("longitude", DoubleType()), ("timestamp", TS))
    return _s(*place, *[(m, DoubleType()) for m in measures], *_LINEAGE)


def mart_hourly(measures=MEASURES) -> StructType:
    return _s(("location_id", StringType()), ("timestamp", TS), *[(m, DoubleType()) for m in measures])


STG_HOURLY, MART_HOURLY = stg_hourly(), mart_hourly()
# the staging order key as the files of the staging tables carry it (zones.ORDER_COL)
INDICATOR_ORDER = _s(*_LINEAGE, ("_digest", LongType()))
HOURLY_ORDER = _s(*_LINEAGE, ("_archive", BooleanType()), ("_digest", LongType()), ("pos", IntegerType()))

# merge keys, partition and cluster columns per table
INDICATOR_KEYS = ("country_iso3", "indicator_id", "year")
HOURLY_KEYS = ("location_id", "timestamp")
INDICATOR_PART = "year_bucket"
HOURLY_PART = "event_date"
RAW_PART = "ingest_date"
