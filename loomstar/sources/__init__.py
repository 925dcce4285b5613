from loomstar.sources.files import (
    ARRIVAL, arrival_places, day_of, events_path, file_census, read_events, read_events_csv, read_events_for, read_json_tree, read_plays_csv,
    read_songs, read_table, union_sources, with_arrival, with_arrival_number, with_file_date,
)
from loomstar.sources.records import csv_records, read_csv_records
from loomstar.sources.staging import (
    EVENT_MAPPING, EVENT_STAGE, WHOLE_EVENTS, WHOLE_SONGS, stage, stage_auto, stage_table,
)

__all__ = [
    "ARRIVAL", "EVENT_MAPPING", "EVENT_STAGE", "WHOLE_EVENTS", "WHOLE_SONGS", "arrival_places", "csv_records", "day_of", "events_path", "file_census", "read_events", "read_events_csv",
    "read_csv_records", "read_events_for", "read_json_tree", "read_plays_csv", "read_songs", "read_table", "stage",
    "stage_auto", "stage_table", "union_sources", "with_arrival", "with_arrival_number", "with_file_date",
]
