"""Writers: parquet/CSV sinks, idempotent publishing, bulk table loads."""

from .core import (attach_if_incomplete, bulk_sink, csv_sink, ddl_types, load_if_incomplete, loads_unchanged, parquet_sink,
                   publish_if_absent, table_count)
from .ledger import LedgerTable

__all__ = ["LedgerTable", "attach_if_incomplete", "bulk_sink", "csv_sink", "ddl_types", "load_if_incomplete", "loads_unchanged", "parquet_sink",
           "publish_if_absent", "table_count"]
