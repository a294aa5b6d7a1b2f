"""Every operator bound to the test tables, with the same query as SQL.

``QUERIES`` maps a name to ``f(spark, folder) -> DataFrame``; ``SQL`` maps the
name to a query over views of the same tables.
"""

from laborscope.catalog import (  # noqa: F401
    aggregates,
    columns,
    functions,
    jobs,
    keys,
    missing,
    reports,
    sources,
    streams,
)
from laborscope.catalog.base import QUERIES, SQL  # noqa: F401
