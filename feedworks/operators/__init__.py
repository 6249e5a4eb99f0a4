"""DataFrame operators: flatten, quality, upsert, changes, reports, metrics, sinks."""
