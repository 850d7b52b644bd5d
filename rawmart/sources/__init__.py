from rawmart.sources.bodies import page_cut, unwrap_pages  # noqa: F401
from rawmart.sources.captured import read_body_files, read_body_table  # noqa: F401
from rawmart.sources.config_text import id_list, parse_locations, request_params, request_window  # noqa: F401
from rawmart.sources.landing import (  # noqa: F401
    land_jsonl,
    landing_name,
    read_dead_letters,
    read_landed,
    write_dead_letters,
)
