"""Readers and writers: driver tables, Bronze fixtures and the layer store."""

from ledgerlake.sources.fixtures import (
    bronze_sources,
    bronze_transaction_details,
    bronze_transactions,
    bronze_users,
)
from ledgerlake.sources.layers import (
    layer_path,
    partition_exists,
    read_layer,
    stored_dates,
    write_layer,
)
from ledgerlake.sources.tables import read_table

__all__ = [
    "bronze_sources",
    "bronze_transaction_details",
    "bronze_transactions",
    "bronze_users",
    "layer_path",
    "partition_exists",
    "read_layer",
    "read_table",
    "stored_dates",
    "write_layer",
]
