from laborscope.functions.text import (  # noqa: F401
    DEFAULT_SEPARATOR,
    MISSING_LABEL,
    NULL_LABEL,
    WHITESPACE,
    as_column,
    blank_to_null,
    fill_missing,
    fill_null,
    has_text,
    is_blank,
    is_missing,
    list_count,
    list_size,
    not_empty,
    round2,
    strip,
    strip_spaces,
    text_digest,
    text_length,
    to_list,
)
