from sluice.operators.changes import drop_feed_columns, keep_changes, table_changes
from sluice.operators.conform import conform
from sluice.operators.keys import duplicate_keys, latest_per_key
from sluice.operators.reports import contract_report, load_summary, preview, schema_summary
from sluice.operators.upsert import upsert

__all__ = [
    "conform",
    "contract_report",
    "drop_feed_columns",
    "duplicate_keys",
    "keep_changes",
    "latest_per_key",
    "load_summary",
    "preview",
    "schema_summary",
    "table_changes",
    "upsert",
]
