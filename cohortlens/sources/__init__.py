"""Readers, sinks and test-table adapters."""

from cohortlens.sources.adapters import events_transactions, orders_transactions
from cohortlens.sources.files import (
    MissingInputError,
    load_testdata,
    read_chart_inputs,
    read_clean_transactions,
    read_profile_inputs,
    read_raw_transactions,
    read_temporal_inputs,
    read_table,
    require_columns,
    write_table,
)

__all__ = [
    "MissingInputError",
    "events_transactions",
    "load_testdata",
    "orders_transactions",
    "read_chart_inputs",
    "read_clean_transactions",
    "read_profile_inputs",
    "read_raw_transactions",
    "read_temporal_inputs",
    "read_table",
    "require_columns",
    "write_table",
]
