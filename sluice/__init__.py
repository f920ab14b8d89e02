"""Contract-driven layered ingestion on Spark."""

from sluice.operators import (
    conform,
    contract_report,
    drop_feed_columns,
    duplicate_keys,
    keep_changes,
    latest_per_key,
    load_summary,
    preview,
    schema_summary,
    table_changes,
    upsert,
)
from sluice.plans.contract import Contract, Field
from sluice.plans.pipeline import (
    Status,
    raise_failures,
    read_raw,
    read_typed,
    read_unfit,
    register_views,
    run_bronze,
    run_silver,
    summarize,
)
from sluice.plans.registry import Dataset, Layout, read_registry
from sluice.sources.bronze import BronzeTable
from sluice.sources.silver import SilverTable
from sluice.streaming.ingest import ingest, start_ingest

__all__ = [
    "BronzeTable",
    "Contract",
    "Dataset",
    "Field",
    "Layout",
    "SilverTable",
    "Status",
    "conform",
    "contract_report",
    "drop_feed_columns",
    "duplicate_keys",
    "ingest",
    "keep_changes",
    "latest_per_key",
    "load_summary",
    "preview",
    "raise_failures",
    "read_raw",
    "read_registry",
    "read_typed",
    "read_unfit",
    "register_views",
    "run_bronze",
    "run_silver",
    "schema_summary",
    "start_ingest",
    "summarize",
    "table_changes",
    "upsert",
]
