from sluice.functions.columns import any_null, free_name, none_null, quoted, quoted_all
from sluice.functions.parsing import readings, typed
from sluice.functions.types import resolve_type

__all__ = ["any_null", "free_name", "none_null", "quoted", "quoted_all", "readings", "resolve_type", "typed"]
