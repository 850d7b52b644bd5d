"""Names, formats and ranges the results must share with the reference job.

They are data, not logic; every module takes them from here.
"""

# Source names and dead-letter reasons (the hourly reason embeds the variant).
INDICATOR_SOURCE = "world_bank"
HOURLY_SOURCE = "open_meteo"
INDICATOR_REASON = "invalid_indicator_record"
HOURLY_REASON_PREFIX = "invalid_"
HOURLY_REASON_SUFFIX = "_payload"
VARIANTS = ("archive", "forecast")

# The hourly measures stored in staging and mart.
MEASURES = ("temperature_2m", "precipitation", "wind_speed_10m")

# Table names of the raw, staging and mart zones (raw names double as landing-file prefixes).
RAW_INDICATOR_TABLE = "world_bank_indicator"
RAW_HOURLY_TABLE = "open_meteo_response"
STG_INDICATOR_TABLE = "stg_world_bank_indicator"
STG_HOURLY_TABLE = "stg_open_meteo_hourly"
MART_INDICATOR_TABLE = "country_indicator_year"
MART_HOURLY_TABLE = "weather_hourly"

# Year range partitioning (first year, end year, step).
YEAR_RANGE = (1900, 2200, 1)

# Accepted text shapes for the safe casts and the local wall-time format.
INTEGER_TEXT = r"^\s*[+-]?[0-9]+\s*$"
HEX_TEXT = r"^\s*([+-]?)0[xX]([0-9a-fA-F]{1,16})\s*$"
SPECIAL_NUMBER_TEXT = r"^\s*[+-]?([iI][nN][fF]([iI][nN][iI][tT][yY])?|[nN][aA][nN])\s*$"
NUMBER_TEXT = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
LOCAL_MINUTE_TEXT = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}$"

# Landing file name, with ':' of the ISO time written as '-'.
LANDING_NAME = "{prefix}_{run}_{at}.jsonl"
LANDING_TIME_REPLACE = (":", "-")
