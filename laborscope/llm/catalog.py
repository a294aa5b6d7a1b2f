"""All queries of this subpackage: importing a module registers its query."""

from laborscope.llm import backoff, decontamination, divergence, jaccard_join, packing, quality  # noqa: F401
from laborscope.llm import rules, search, secret_scan, sharding, substrings, toxicity, warc  # noqa: F401
from laborscope.llm.base import QUERIES, SQL  # noqa: F401
