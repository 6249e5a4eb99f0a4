"""Sources: positional CSV feeds (S1-S8) and stored tables."""

from feedworks.sources.csv_feed import Feed, INGEST_ORDER, field_count, from_rows, read_feed
from feedworks.sources.tables import TABLES, register_views, table

__all__ = ["Feed", "INGEST_ORDER", "field_count", "from_rows", "read_feed", "TABLES",
           "register_views", "table"]
