from loomstar.functions.casts import blank_to_null, conform, is_truthy, whole_units
from loomstar.functions.keys import dense_id, event_key, play_key, surrogate_id
from loomstar.functions.timeparts import (
    calendar, from_epoch_millis, from_epoch_seconds, to_epoch_millis, weekday,
)

__all__ = [
    "blank_to_null", "calendar", "conform", "dense_id", "event_key", "from_epoch_millis",
    "from_epoch_seconds", "is_truthy", "play_key", "surrogate_id", "to_epoch_millis",
    "weekday", "whole_units",
]
