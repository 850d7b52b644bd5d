from rawmart.functions.jsonops import (  # noqa: F401
    day_of,
    is_array,
    is_object,
    json_array,
    json_scalar,
    json_text,
    json_type,
    local_ts_to_utc,
    parse_once,
    safe_double,
    safe_long,
    truthy,
    year_bucket,
)
