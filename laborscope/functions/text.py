"""Column expressions for delimited and free text. All run on the JVM."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character for which str.isspace() holds; the last one is U+3000.
WHITESPACE = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())

# Fixed values
DEFAULT_SEPARATOR = ", "
MISSING_LABEL = "No especificado"
NULL_LABEL = "Not Specified"


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _printable(c: Column) -> Column:
    """True if the first byte is a visible ASCII character; one byte comparison."""
    return (c >= "!") & (c < "\x7f")


def strip(c: Column | str) -> Column:
    """Remove Unicode whitespace at both ends; Spark's plain ``trim`` removes spaces only."""
    text = as_column(c)
    # Trimming with 29 characters is slow, and most texts need none.
    clean = _printable(text) & _printable(F.substring(text, -1, 1))
    return F.when(clean, text).otherwise(F.trim(text, F.lit(WHITESPACE)))


def strip_spaces(c: Column | str) -> Column:
    """Remove U+0020 only."""
    return F.trim(as_column(c))


def has_text(c: Column | str) -> Column:
    """Filter condition: neither null nor blank. The value itself stays untrimmed."""
    text = as_column(c)
    return _printable(text) | (F.ltrim(text, F.lit(WHITESPACE)) != "")


def is_blank(c: Column | str) -> Column:
    """True for text made of whitespace only, null for null."""
    return ~has_text(c)


def is_missing(c: Column | str) -> Column:
    """Null or blank, never null itself."""
    return F.coalesce(is_blank(c), F.lit(True))


def not_empty(c: Column | str) -> Column:
    """Filter condition: neither null nor ``""``; a lone space passes."""
    return as_column(c) != ""


def blank_to_null(c: Column | str) -> Column:
    """Blank text becomes null, anything else stays as it is."""
    return F.when(has_text(c), as_column(c))


def fill_missing(c: Column | str, label: str = MISSING_LABEL) -> Column:
    """Replace null and blank text by ``label``."""
    return F.coalesce(blank_to_null(c), F.lit(label))


def fill_null(c: Column | str, value) -> Column:
    """Replace null only."""
    return F.coalesce(as_column(c), F.lit(value))


def _literal(separator: str) -> str:
    if not separator:
        raise ValueError("the separator must not be empty")
    return re.sub(r"([\\.\[\]{}()*+?^$|])", r"\\\1", separator)


def to_list(c: Column | str, separator: str = DEFAULT_SEPARATOR) -> Column:
    """Split delimited text; null and blank text give an empty list, empty tokens are kept."""
    text = as_column(c)
    tokens = F.split(text, _literal(separator), -1)
    return F.when(has_text(text), tokens).otherwise(F.array().cast("array<string>"))


def list_size(c: Column | str) -> Column:
    return F.size(as_column(c)).cast("long")


def list_count(c: Column | str, separator: str = DEFAULT_SEPARATOR) -> Column:
    """Same number as ``size(to_list(c))`` from byte lengths, without building the list."""
    if not separator:
        raise ValueError("the separator must not be empty")
    text = as_column(c)
    removed = F.octet_length(text) - F.octet_length(F.replace(text, F.lit(separator), F.lit("")))
    count = (removed / len(separator.encode())).cast("long") + 1
    return F.when(has_text(text), count).otherwise(F.lit(0).cast("long"))


def text_length(c: Column | str) -> Column:
    """Length in Unicode code points."""
    return F.length(as_column(c)).cast("long")


def text_digest(c: Column | str) -> Column:
    """A 64-character key that stands for a long text in a shuffle; null stays null."""
    return F.sha2(as_column(c), 256)


def round2(c: Column | str) -> Column:
    return F.round(as_column(c), 2)
