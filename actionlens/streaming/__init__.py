from actionlens.streaming.ingest import ingest_day_counts, read_day_counts  # noqa: F401
