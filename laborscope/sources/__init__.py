from laborscope.sources.convert import ROWS_PER_PART, csv_to_parquet, write_parts  # noqa: F401
from laborscope.sources.csv_text import read_csv_text  # noqa: F401
from laborscope.sources.files import (  # noqa: F401
    PART_GLOB,
    SOURCE_ORDER,
    per_file,
    project,
    read_complete_parquet,
    read_parquet,
    text_schema,
)
from laborscope.sources.in_place import first_rows_in_place  # noqa: F401
from laborscope.sources.large_csv import read_large_csv  # noqa: F401
from laborscope.sources.sinks import (  # noqa: F401
    collect_small,
    head_and_count,
    preview,
    sample_json,
    write_csv,
    write_sample_csv,
    write_sample_json,
)
from laborscope.sources.storage import total_bytes, work_folder  # noqa: F401
