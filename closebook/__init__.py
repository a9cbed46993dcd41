"""closebook: sales and finance marts as Spark DataFrame plans.

Raw ERP and ledger feeds go through staging, two intermediate joins and five
marts, plus an SCD2 customer history, a revenue reconciliation and a set of
data-quality checks. Every function takes DataFrames and returns a lazy
DataFrame; nothing here triggers an action except the sinks.

Entry points: ``Marts`` (the model graph over any raw feeds), ``RawFeeds``
(feeds derived from the TPC-H-like tables), ``StoredFeeds`` / ``write_feeds``
(staged parquet feeds), ``refresh`` (full refresh of the marts),
``run_checks`` with ``all_checks`` (data tests), ``snapshot_apply`` (SCD2).
"""

from closebook.config import DEFAULT_CONFIG, MartConfig
from closebook.operators.quality import run_checks
from closebook.operators.snapshot import snapshot_apply
from closebook.plans.checks import all_checks
from closebook.plans.models import Marts
from closebook.plans.refresh import refresh
from closebook.sources.files import StoredFeeds, write_feeds
from closebook.sources.tpch import RawFeeds

__all__ = [
    "DEFAULT_CONFIG", "MartConfig", "Marts", "RawFeeds", "StoredFeeds",
    "all_checks", "refresh", "run_checks", "snapshot_apply", "write_feeds",
]
