from laborscope.operators.dedup import (  # noqa: F401
    dedup_summary,
    first_by_key,
    keep_any,
    keep_first,
    keep_last,
)
from laborscope.operators.heavy import (  # noqa: F401
    heavy_keys,
    join_heavy,
    join_heavy_null_safe,
    lookup_heavy,
)
from laborscope.operators.joins import (  # noqa: F401
    join_null_safe,
    join_on_key,
    lookup,
    null_safe_key,
)
from laborscope.operators.quality import (  # noqa: F401
    blanks_to_null,
    drop_missing_key,
    impute,
    impute_nulls,
    null_profile,
    treatment_report,
)
from laborscope.operators.ranking import (  # noqa: F401
    count_by,
    count_equal,
    first_rows,
    labelled_ranking,
    number_rows,
    rank_counts,
    ranking,
    top_k,
    unique_values,
)
from laborscope.operators.textstats import (  # noqa: F401
    add_list,
    array_mean,
    length_totals_by,
    list_summary,
    mean_by,
    mean_from_totals,
    mean_length_by,
    mean_list_size,
    mean_list_size_by,
    token_ranking,
    tokens,
    top_tokens,
)
