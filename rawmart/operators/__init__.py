from rawmart.operators.arrays import align_arrays  # noqa: F401
from rawmart.operators.cursors import (  # noqa: F401
    high_water,
    last_time_cursor,
    max_year_cursor,
    run_metrics,
    unseen_runs,
)
from rawmart.operators.latest import latest_per_key  # noqa: F401
from rawmart.operators.merge import merge_plan, merge_upsert  # noqa: F401
from rawmart.operators.quality import (  # noqa: F401
    dead_letter,
    hourly_valid,
    indicator_valid,
    split_valid,
)
