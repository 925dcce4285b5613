"""Play facts: the log's natural keys resolved against the catalogue."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomstar.functions.casts import whole_units
from loomstar.functions.timeparts import from_epoch_millis, from_epoch_seconds
from loomstar.operators.dedup import pick_per_key
from loomstar.operators.skew import BROADCAST_BYTES, lookup_join

# Log column -> catalogue column, in the order in which keys are added.
_MATCH = {"song": "title", "artist": "artist_name", "length": "duration"}


def with_start_time(events: DataFrame, precision: str = "ms") -> DataFrame:
    """Every column and the start time, in milliseconds or whole seconds."""
    convert = {"ms": from_epoch_millis, "s": from_epoch_seconds}[precision]
    return events.withColumn("start_time", convert("ts"))


def catalogue(songs: DataFrame, artists: DataFrame) -> DataFrame:
    """Songs with their artist's name; repeated artist ids fan out."""
    return songs.join(artists, "artist_id").select(
        "song_id", "artist_id", "title", F.col("name").alias("artist_name"), "duration"
    )


def songplays(
    plays: DataFrame,
    songs: DataFrame,
    how: str = "left",
    keys: int = 3,
    match: str = "all",
    distinct: bool = False,
    truncate_duration: bool = False,
    broadcast_bytes: int = BROADCAST_BYTES,
    also: Sequence[str] = (),
) -> DataFrame:
    """The play fact without its generated key.

    plays   events with a start_time
    songs   song_id, artist_id, title, artist_name, duration
    how     `left` keeps plays without a song, `inner` drops them
    keys    2 matches on title and artist, 3 on duration as well
    match   `all` lets a play match several songs, `first` takes the lowest id
    distinct           drop repeated fact rows
    truncate_duration  compare durations by whole seconds, the rest cut off
    also               further columns of the plays that the fact carries
    """
    if how not in ("left", "inner") or match not in ("all", "first") or keys not in (2, 3):
        raise ValueError(f"unsupported: how={how!r}, match={match!r}, keys={keys!r}")
    on = list(_MATCH)[:keys]

    def key(name: str) -> Column:
        return whole_units(name) if truncate_duration and name in ("length", "duration") else F.col(name)

    plays = plays.select(
        "start_time",
        F.col("userId").try_cast("bigint").alias("user_id"),
        "level",
        F.col("sessionId").alias("session_id"),
        "location",
        F.col("userAgent").alias("user_agent"),
        *also,
        *[key(c).alias(c) for c in on],
    )
    songs = songs.select("song_id", "artist_id", *[key(_MATCH[c]).alias(c) for c in on])

    if match == "first":
        unique = pick_per_key(songs, on, ["song_id"])
        joined = lookup_join(plays, unique, on, broadcast_bytes, at_most=songs)
        if how == "inner":
            joined = joined.filter(F.col("song_id").isNotNull())
    else:
        # No hint: Spark broadcasts the catalogue if its size allows, otherwise
        # both sides meet in a sort-merge join whose hot partitions AQE splits.
        # Repeated catalogue rows cannot add to a distinct result, so they go first.
        joined = plays.join(songs.distinct() if distinct else songs, on, how)

    fact = joined.select(
        "start_time", "user_id", "level", "song_id", "artist_id", "session_id", "location",
        "user_agent", *also,
    )
    return fact.distinct() if distinct else fact
