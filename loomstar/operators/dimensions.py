"""The four dimensions, with the deduplication rule as an option.

`row` keeps every distinct row, so a key may repeat; `first` and `last` keep
one row per key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomstar.functions.timeparts import calendar
from loomstar.operators.dedup import pick_per_key

EVENT_ORDER = ("ts", "sessionId", "itemInSession")
SONG_ORDER = ("song_id",)


def dimension(
    source: DataFrame,
    columns: Mapping[str, Column | str],
    keys: Sequence[str],
    dedup: str = "row",
    order_by: Sequence[str] = (),
) -> DataFrame:
    """`columns` of `source`, deduplicated by whole row or by key."""
    shaped = [(F.col(c) if isinstance(c, str) else c).alias(name) for name, c in columns.items()]
    if dedup == "row":
        return source.select(*shaped).distinct()
    if dedup not in ("first", "last"):
        raise ValueError(f"unknown dedup rule {dedup!r}")
    if not order_by:
        raise ValueError("first and last need an order")
    ranks = [F.col(c).alias(f"_rank{i}") for i, c in enumerate(order_by)]
    ranked = source.select(*shaped, *ranks)
    names = [f"_rank{i}" for i in range(len(ranks))]
    return pick_per_key(ranked, keys, names, dedup).drop(*names)


def users_dim(
    plays: DataFrame, dedup: str = "row", order_by: Sequence[str] = EVENT_ORDER
) -> DataFrame:
    """Users seen in the plays."""
    columns = {
        "user_id": F.col("userId").try_cast("bigint"),
        "first_name": "firstName",
        "last_name": "lastName",
        "gender": "gender",
        "level": "level",
    }
    return dimension(plays, columns, ["user_id"], dedup, order_by)


def songs_dim(
    songs: DataFrame, dedup: str = "row", order_by: Sequence[str] = SONG_ORDER
) -> DataFrame:
    columns = {c: c for c in ("song_id", "title", "artist_id", "year", "duration")}
    return dimension(songs, columns, ["song_id"], dedup, order_by)


def artists_dim(
    songs: DataFrame, dedup: str = "row", order_by: Sequence[str] = SONG_ORDER
) -> DataFrame:
    columns = {
        "artist_id": "artist_id",
        "name": "artist_name",
        "location": "artist_location",
        "latitude": "artist_latitude",
        "longitude": "artist_longitude",
    }
    return dimension(songs, columns, ["artist_id"], dedup, order_by)


def time_dim(plays: DataFrame, start: str = "start_time", weekday_style: str = "name") -> DataFrame:
    """One row per distinct start time; the parts are computed after the distinct."""
    starts = plays.select(F.col(start).alias("start_time")).distinct()
    return starts.withColumns(calendar("start_time", weekday_style))


def time_dim_from_fact(
    fact: DataFrame, weekday_style: str = "sunday0", also: Sequence[str] = ()
) -> DataFrame:
    """One row per fact row, with further columns of it: equal start times stay repeated."""
    parts = calendar("start_time", weekday_style)
    return fact.select("start_time", *[c.alias(name) for name, c in parts.items()], *also)
