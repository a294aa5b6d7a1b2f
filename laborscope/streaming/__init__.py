from laborscope.streaming.incremental import (  # noqa: F401
    incremental_keep_first,
    incremental_mean_length_by,
    incremental_mean_list_size,
    incremental_token_counts,
)
from laborscope.streaming.native import (  # noqa: F401
    run_append,
    run_complete,
    run_update,
    stream_dedup,
    stream_length_totals_by,
    stream_parquet,
    stream_token_counts,
)
