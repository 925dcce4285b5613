"""Whole loads from raw files to the star schema, in four variants.

Each parses the raw text once into typed parquet; every later step reads from
there just the columns it needs.  Nothing is cached on executors, so losing
one costs its running tasks only.

`root` holds song_data/ and log_data/; `out` receives the tables.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from loomstar.functions.keys import play_key, surrogate_id
from loomstar.operators.dimensions import (
    artists_dim, songs_dim, time_dim, time_dim_from_fact, users_dim,
)
from loomstar.operators.facts import catalogue, songplays, with_start_time
from loomstar.operators.filters import plays
from loomstar.operators.quality import (
    assert_checks, fused_checks, has_rows_checks, run_checks,
)
from loomstar.operators.skew import sized
from loomstar.plans.steps import together
from loomstar.schemas import ARTISTS, EVENT, SONG, SONGPLAYS, SONGS, STAR_KEYS, TIME, USERS
from loomstar.sinks.tables import (
    append, exists, insert_by_name, insert_by_position, insert_if_absent, layout, load_dimension,
    overwrite, overwrite_partitions, partition_path, reset_tables, write_table,
)
from loomstar.sources.files import (
    day_of, read_events, read_events_for, read_json_tree, read_songs, read_table, with_file_date,
)
from loomstar.sources.staging import (
    EVENT_MAPPING, EVENT_STAGE, WHOLE_EVENTS, WHOLE_SONGS, stage, stage_auto,
)

# The generated key is a number, unlike the md5 key.
_NUMBERED = ["songplay_id", *[c for c in SONGPLAYS.fieldNames() if c != "songplay_id"]]
_FILE_DATE = {"event_date": ("event_date", "date")}
_DATED = StructType([*SONGPLAYS.fields, StructField("event_date", DateType())])
# What every star must satisfy: columns without nulls, and columns that refer to a table's key.
_REQUIRED = {"songplays": ["start_time"]}
_REFERENCES = {
    "songplays": {"start_time": "time", "user_id": "users", "song_id": "songs", "artist_id": "artists"},
}


def _staged(df: DataFrame, path: str) -> DataFrame:
    """`df` from a typed file, packed tightly: it holds the whole log and is read a column at a time."""
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _stored(out: str, written: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The tables as stored; their schemas are known, so empty ones read back too."""
    return {
        name: read_table(df.sparkSession, f"{out}/{name}", df.schema)
        for name, df in written.items()
    }


def _checked(
    spark: SparkSession, tables: dict[str, DataFrame], unique: Sequence[str] = ()
) -> dict[str, DataFrame]:
    """The tables, if unique keys do not repeat, plays have a time and references exist."""
    keys = {name: STAR_KEYS[name] for name in unique}
    assert_checks(fused_checks(tables, keys, _REQUIRED, _REFERENCES))
    return tables


def _write_days(df: DataFrame, path: str, day: dt.date | None, add: bool) -> None:
    """Replace the days in `df`, or the one `day` even if it has no rows; or add to them."""
    if day is None:
        (append if add else overwrite_partitions)(df, path, ["event_date"])
    else:
        (append if add else overwrite)(df.drop("event_date"), partition_path(path, "event_date", day))


def star_first_wins(
    spark: SparkSession, root: str, out: str, page: str = "NextSong"
) -> dict[str, DataFrame]:
    """Millisecond plays, each matched to at most one song; stored dimension rows win.

    Runs of the same files leave the dimensions as they are; plays are appended.
    Fails if a dimension's key repeats, a play lacks its time, or a reference is missing.
    """
    songs, events = together(
        lambda: _staged(read_json_tree(spark, f"{root}/song_data", SONG), f"{out}/staging_songs"),
        lambda: _staged(read_json_tree(spark, f"{root}/log_data", EVENT), f"{out}/staging_events"),
    )
    played = with_start_time(plays(events, page), "ms")

    dims = {
        "songs": songs_dim(songs, "first"),
        "artists": artists_dim(songs, "first"),
        "users": users_dim(played, "first"),
        "time": time_dim(played, weekday_style="name"),
    }
    # New events are mostly later than all stored times, which are then not read.
    pruned = {"time": ["start_time"]}
    together(*[
        partial(insert_if_absent, dim, f"{out}/{name}", STAR_KEYS[name], prune_on=pruned.get(name, ()))
        for name, dim in dims.items()
    ])

    known = catalogue(
        read_table(spark, f"{out}/songs", SONGS), read_table(spark, f"{out}/artists", ARTISTS)
    )
    fact = songplays(played, known, match="first")
    target, start = f"{out}/songplays", 0
    if exists(spark, target):
        last = read_table(spark, target).agg(F.max("songplay_id")).first()[0]
        start = 0 if last is None else last + 1
    numbered = surrogate_id(fact, start=start).select(*_NUMBERED)
    append(numbered, target)
    return _checked(spark, _stored(out, {**dims, "songplays": numbered}), unique=list(dims))


def star_distinct(
    spark: SparkSession, root: str, out: str, page: str = "NextSong"
) -> dict[str, DataFrame]:
    """Typed staging, distinct dimensions, distinct facts matched on title and artist.

    Fails if a play lacks its time or a reference is missing.
    """
    raw_songs = read_json_tree(spark, f"{root}/song_data", SONG)
    raw_events = read_json_tree(spark, f"{root}/log_data", EVENT)
    songs, events = together(
        lambda: _staged(stage_auto(raw_songs, SONG), f"{out}/staging_songs"),
        lambda: _staged(stage(raw_events, EVENT_MAPPING), f"{out}/staging_events"),
    )
    played = plays(events, page).withColumnsRenamed({**EVENT_STAGE, "ts": "start_time"})

    schemas = {"users": USERS, "songs": SONGS, "artists": ARTISTS, "time": TIME}
    reset_tables(spark, out, schemas)
    dims = {
        "users": insert_by_name(users_dim(played), USERS),
        "songs": insert_by_name(songs_dim(songs), SONGS),
        "artists": insert_by_name(artists_dim(songs), ARTISTS),
        "time": insert_by_name(time_dim(played, weekday_style="sunday0"), TIME),
    }
    together(*[partial(append, dim, f"{out}/{name}") for name, dim in dims.items()])
    fact = songplays(played, songs, how="inner", keys=2, distinct=True)
    numbered = surrogate_id(fact).select(*_NUMBERED)
    overwrite(numbered, f"{out}/songplays")
    return _checked(spark, _stored(out, {**dims, "songplays": numbered}))


def star_lake(
    spark: SparkSession,
    root: str,
    out: str,
    page: str = "NextSong",
    songs_by: Sequence[str] = ("year", "artist_id"),
) -> dict[str, DataFrame]:
    """Partitioned parquet, whole seconds, plays matched on title and artist name.

    Fails if a table is already there, before it writes anything, and if a play lacks
    its time or a reference is missing.  Partitioning songs by artist makes a folder
    per artist and year; for a catalogue with many artists pass songs_by=["year"].
    """
    there = [name for name in STAR_KEYS if exists(spark, f"{out}/{name}")]
    if there:
        raise FileExistsError(f"{out} already holds {', '.join(there)}")
    songs, events = together(
        lambda: _staged(read_songs(spark, root), f"{out}/staging_songs"),
        lambda: _staged(read_events(spark, root), f"{out}/staging_events"),
    )
    played = with_start_time(plays(events, page), "s")
    dims = {
        "songs": songs_dim(songs),
        "artists": artists_dim(songs),
        "users": users_dim(played),
        "time": time_dim(played, weekday_style="short"),
    }
    folders = {"songs": songs_by, "time": ["year", "month"]}
    together(*[
        partial(write_table, dim, f"{out}/{name}", partition_by=folders.get(name, ()))
        for name, dim in dims.items()
    ])

    known = catalogue(
        read_table(spark, f"{out}/songs", SONGS), read_table(spark, f"{out}/artists", ARTISTS)
    )
    fact = songplays(played, known, how="inner", keys=2)
    by = ["year", "month"]
    placed = fact.withColumns({"year": F.year("start_time"), "month": F.month("start_time")})
    dated = surrogate_id(layout(placed, by)).select(*_NUMBERED, *by)  # numbered after the shuffle
    dated.write.partitionBy(*by).parquet(f"{out}/songplays")
    return _checked(spark, _stored(out, {**dims, "songplays": dated}))


def star_daily(
    spark: SparkSession,
    root: str,
    out: str,
    run_date: dt.date | str | None = None,
    page: str = "NextSong",
    layout: str = "file",
    append_fact: bool = False,
    carry_users: bool = False,
) -> dict[str, DataFrame]:
    """Stage one day (or the whole log), add its plays, rebuild the dimensions, check.

    Measures are whole numbers, times whole seconds, keys md5.  Users come from
    the staged events, times from the plays with repeats kept.  A play belongs to
    the day of its file, also when it begins on a neighbouring day, so whole loads
    and daily ones agree.  The plays, and their times, replace those of an earlier
    run for the same days and no other day is read or written; `append_fact` adds
    them regardless.  Fails if a table ends up empty or a play lacks its time.

    By default the users are those of the staged events alone, so after a daily run the
    fact names users that the dimension lacks.  `carry_users` keeps the stored ones and
    adds those that are new, and every reference of the fact is checked as well.
    """
    day = None if run_date is None else day_of(run_date)
    raw = (
        with_file_date(read_json_tree(spark, f"{root}/log_data", EVENT))
        if day is None
        else read_events_for(spark, root, day, layout).withColumn("event_date", F.lit(day))
    )
    raw_songs = read_json_tree(spark, f"{root}/song_data", SONG)
    events, songs = together(
        lambda: _staged(stage(raw, {**WHOLE_EVENTS, **_FILE_DATE}), f"{out}/staging_events"),
        lambda: _staged(stage(raw_songs, WHOLE_SONGS), f"{out}/staging_songs"),
    )
    played = with_start_time(plays(events, page), "s")

    fact = songplays(played, sized(songs), also=["event_date"]).select(
        play_key("session_id", "start_time").alias("songplay_id"), "*"
    )
    dated = insert_by_position(fact, _DATED)
    _write_days(dated, f"{out}/songplays", day, append_fact)
    # The times of the days in hand, from the plays just stored.
    stored = read_table(spark, f"{out}/songplays", _DATED)
    if day is not None:
        stored = stored.where(F.col("event_date") == F.lit(day))
    times = time_dim_from_fact(stored, also=["event_date"])
    _write_days(times, f"{out}/time", day, False)

    dims = {"users": users_dim(played), "songs": songs_dim(songs), "artists": artists_dim(songs)}
    loads = {name: partial(load_dimension, dim, f"{out}/{name}") for name, dim in dims.items()}
    if carry_users:
        loads["users"] = partial(insert_if_absent, dims["users"], f"{out}/users", dims["users"].columns)
    together(*loads.values())

    tables = _stored(out, {**dims, "time": times, "songplays": dated})
    checked = {"staging_events": events, "staging_songs": songs, **tables}
    whole = fused_checks(tables, required=_REQUIRED, references=_REFERENCES if carry_users else None)
    assert_checks(run_checks(spark, has_rows_checks(checked)).unionByName(whole))
    return tables
