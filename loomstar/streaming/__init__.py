from loomstar.streaming.ingest import refresh_counts, run_for_date, store_plays, stream_events

__all__ = ["refresh_counts", "run_for_date", "store_plays", "stream_events"]
