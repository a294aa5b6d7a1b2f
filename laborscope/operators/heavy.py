"""Joins on keys of which a few may hold a large share of the rows.

A counting pass finds the heavy keys of the left side: those with at least a share of
``1 / HEAVY_KEYS`` of its rows, so at most ``HEAVY_KEYS`` of them, whatever the size. Their
rows are dealt to ``PIECES`` tasks each, and the right side's rows of these keys, and of
no others, are copied to all pieces. Null keys, which match nothing, are spread as well.
The plan is the same with and without adaptive execution.

A key that is heavy on both sides has as many joined rows as the product of its rows. For
results that only add them up, ``sums`` takes aggregates of the left rows: those of one key
and piece are then joined as one row with these aggregates, so that a right row has at most
``PIECES`` joined rows, whatever the size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from laborscope.operators.joins import NULL_SAFE_KEY, null_safe_key

HEAVY_KEYS = 200
PIECES = 64

_PIECE, _COUNT = "_piece", "_rows_of_key"


def heavy_keys(df: DataFrame, keys: list[str], most: int = HEAVY_KEYS) -> DataFrame:
    """Keys with at least ``1 / most`` of all rows; at most ``most`` of them. Nulls are left out."""
    counts = df.dropna(subset=keys).groupBy(*keys).agg(F.count("*").alias(_COUNT))
    total = df.agg(F.count("*").alias("n"))
    # One number, computed by its own query.
    return counts.filter(F.col(_COUNT) * most >= total.scalar()).select(*keys)


def _dealt(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    most: int,
    pieces: int,
    sums: dict[str, Column] | None = None,
    kept: tuple[str, ...] = (),
) -> tuple[DataFrame, DataFrame]:
    """Both sides with the piece that a row belongs to; with ``sums``, one left row per key and piece.

    Columns ``kept`` follow from the keys and stay as well.
    """
    # Bounded by ``most`` rows.
    heavy = F.broadcast(heavy_keys(left, keys, most).withColumn("_heavy", F.lit(True)))
    missing = F.lit(False)
    for k in keys:
        missing = missing | F.col(k).isNull()
    own = F.pmod(F.monotonically_increasing_id(), F.lit(pieces)).cast("int")
    spread: Column = F.col("_heavy").isNotNull() | missing
    left = left.withColumn("_own", own).join(heavy, keys, "left")
    left = left.withColumn(_PIECE, F.when(spread, F.col("_own")).otherwise(F.lit(0))).drop("_own", "_heavy")
    if sums is not None:
        left = left.groupBy(*keys, *kept, _PIECE).agg(*(c.alias(n) for n, c in sums.items()))
    copies = F.when(F.col("_heavy").isNotNull(), F.sequence(F.lit(0), F.lit(pieces - 1))).otherwise(F.array(F.lit(0)))
    right = right.dropna(subset=keys).join(heavy, keys, "left")
    return left, right.withColumn(_PIECE, F.explode(copies)).drop("_heavy")


def join_heavy(
    left: DataFrame,
    right: DataFrame,
    key: str,
    how: str = "inner",
    *,
    most: int = HEAVY_KEYS,
    pieces: int = PIECES,
    sums: dict[str, Column] | None = None,
) -> DataFrame:
    """Inner or left join, the same rows as ``left.join(right, key, how)``.

    With ``sums``, the left columns besides the key are these aggregates of its rows, in up to
    ``pieces`` rows per key: adding them up over the joined rows gives what the plain join gives.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    if how == "inner":
        left = left.dropna(subset=[key])
    one, two = _dealt(left, right, [key], most, pieces, sums)
    return one.join(two, [key, _PIECE], how).drop(_PIECE)


def lookup_heavy(
    left: DataFrame, right: DataFrame, key: str, fill: dict[str, object], **options
) -> DataFrame:
    """Left join that fills the unmatched columns of ``right``."""
    joined = join_heavy(left, right, key, "left", **options)
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in fill.items()})


def join_heavy_null_safe(
    left: DataFrame, right: DataFrame, key: str, how: str = "inner", **options
) -> DataFrame:
    """Join in which a null key matches a null key; null may be a heavy key like others.

    Takes the options of :func:`join_heavy`.
    """
    one = left.select("*", *null_safe_key(left, key))
    two = right.select(*(c for c in right.columns if c != key), *null_safe_key(right, key))
    most, pieces = options.get("most", HEAVY_KEYS), options.get("pieces", PIECES)
    one, two = _dealt(one, two, NULL_SAFE_KEY, most, pieces, options.get("sums"), (key,))
    return one.join(two, [*NULL_SAFE_KEY, _PIECE], how).drop(*NULL_SAFE_KEY, _PIECE)
