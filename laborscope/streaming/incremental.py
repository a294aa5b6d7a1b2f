"""Incremental variants that keep the first row per key in source order.

Which keys have come is kept in the state store: a batch reads and writes the state
of its own keys only. What a batch adds goes to a table that is merged when it is read
(:mod:`laborscope.streaming.versions`), below ``folder``; a repeated batch counts once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from laborscope.functions import DEFAULT_SEPARATOR, list_count
from laborscope.operators.dedup import Keys
from laborscope.operators.joins import null_safe_key
from laborscope.operators.ranking import count_by
from laborscope.operators.textstats import (
    first_levels,
    length_totals,
    mean_from_totals,
    mean_size_over_keys,
    tokens,
)
from laborscope.streaming.lookup import joined_levels, write_lookup
from laborscope.streaming.state import first_rows_per_key, run_batches
from laborscope.streaming.versions import Versions, summed_per_key


def incremental_keep_first(
    stream: DataFrame, key: str, columns: Sequence[str], order: Keys, folder: str
) -> DataFrame:
    """The first row per key over all batches so far."""
    wanted = list(dict.fromkeys([key, *columns]))
    schema = stream.select(*(F.col(f"`{c}`") for c in wanted)).schema
    rows = Versions(stream.sparkSession, f"{folder}/rows", schema)

    def handle(batch: DataFrame, batch_id: int) -> None:
        rows.save(batch.filter("_new").select(*(F.col(f"`{c}`") for c in wanted)), batch_id)

    run_batches(first_rows_per_key(stream, key, wanted, order), handle, folder, "update")
    return rows.read()


def incremental_token_counts(
    stream: DataFrame,
    key: str,
    text: str,
    order: Keys,
    folder: str,
    name: str = "token",
    count: str = "n",
    separator: str = DEFAULT_SEPARATOR,
) -> DataFrame:
    """Count per list item over the first row per key; rank or cut the result as needed."""
    schema = StructType([StructField(name, StringType()), StructField(count, LongType())])
    counts = Versions(stream.sparkSession, f"{folder}/counts", schema, summed_per_key([name]))

    def handle(batch: DataFrame, batch_id: int) -> None:
        new = batch.filter("_new")
        counts.save(count_by(tokens(new, text, name, separator), name, count), batch_id)

    run_batches(first_rows_per_key(stream, key, [text], order), handle, folder, "update")
    return counts.read()


def incremental_mean_length_by(
    stream: DataFrame,
    levels: DataFrame,
    key: str,
    text: str,
    level: str,
    order: Keys,
    folder: str,
    count: str = "n",
    mean: str = "mean_length",
) -> DataFrame:
    """Texts and mean length per level; ``levels`` is a static table.

    The levels are deduplicated and dealt to buckets once. A batch sums its lengths per
    key, and reads the buckets that its keys are in.
    """
    spark, table = stream.sparkSession, f"{folder}/levels"
    static = first_levels(levels, key, level, order)
    write_lookup(static.select(key, level), key, table)
    level_type = static.schema[level].dataType
    names = [StructField(level, level_type), StructField("_n", LongType()), StructField("_total", LongType())]
    totals = Versions(spark, f"{folder}/totals", StructType(names), summed_per_key([level]))

    def handle(batch: DataFrame, batch_id: int) -> None:
        joined = joined_levels(length_totals(batch, key, text), key, table)
        summed = joined.groupBy(level).agg(F.sum("_n").alias("_n"), F.sum("_total").alias("_total"))
        totals.save(summed, batch_id)

    run_batches(stream, handle, folder)
    return mean_from_totals(totals.read(), level, count, mean)


def incremental_mean_list_size(
    base: DataFrame,
    stream: DataFrame,
    key: str,
    text: str,
    order: Keys,
    folder: str,
    separator: str = DEFAULT_SEPARATOR,
    rows: str = "rows",
    with_items: str = "rows_with_items",
    mean: str = "mean_items",
) -> DataFrame:
    """Mean list size over the keys of ``base``, from list sizes stored per batch."""
    sized = stream.withColumn("_size", list_count(text, separator))
    sizes = incremental_keep_first(sized, key, ["_size"], order, folder)
    sizes = sizes.select(*null_safe_key(sizes, key), "_size")
    return mean_size_over_keys(base, sizes, key, rows, with_items, mean)
