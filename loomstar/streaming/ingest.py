"""Incremental loads: new files as they appear, and one day again and again."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomstar.functions.keys import event_key, play_key
from loomstar.operators.analytics import day_counts
from loomstar.operators.facts import songplays, with_start_time
from loomstar.operators.filters import plays
from loomstar.operators.skew import sized
from loomstar.schemas import EVENT
from loomstar.sinks.tables import insert_if_absent, overwrite, overwrite_partitions, partition_path
from loomstar.sources.files import JSON_FILES, day_of, read_events_for

_BY_MONTH = ["year", "month"]
#: Files in one batch of a stream, which commits after each.
MAX_FILES = 1_000


def keyed_plays(
    events: DataFrame, songs: DataFrame, page: str = "NextSong", **options
) -> DataFrame:
    """Play facts under their md5 key, in whole seconds; `options` as in `songplays`."""
    fact = songplays(with_start_time(plays(events, page), "s"), sized(songs), **options)
    return fact.select(play_key("session_id", "start_time").alias("songplay_id"), "*")


def store_plays(events: DataFrame, songs: DataFrame, sink: str, page: str = "NextSong") -> None:
    """Insert the plays of `events` that `sink` lacks; repeating it changes nothing.

    A play is known by `event_key`, a digest of the whole record: plays of one
    session in the same second, or without a session, stay apart, while a record
    that is delivered again is not stored again.  Year and month follow from the
    record, so only the months the events fall into are read back.
    """
    played = with_start_time(plays(events, page), "s").withColumn("event_key", event_key(EVENT.fieldNames()))
    fact = songplays(played, songs, match="first", also=["event_key"])
    fact = fact.withColumns({"year": F.year("start_time"), "month": F.month("start_time")})
    own = {"songplay_id": play_key("session_id", "start_time")}  # a digest as wide as some rows
    insert_if_absent(fact, sink, ["event_key"], ["start_time"], _BY_MONTH, _BY_MONTH, own)


def stream_events(
    spark: SparkSession,
    root: str,
    checkpoint: str,
    load: Callable[[DataFrame], None],
    max_files: int | None = MAX_FILES,
) -> int:
    """Give `load` every log file below `root` not yet seen; return the batches run.

    Files come `max_files` at a time (None: all at once) and are committed after
    each batch in the checkpoint.  A batch that failed half way is given again, so
    `load` must bear repeating, as `store_plays` does.
    """
    reader = (
        spark.readStream.schema(EVENT)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", JSON_FILES)
        .option("mode", "FAILFAST")
    )
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    batches = []

    def run(batch: DataFrame, number: int) -> None:
        load(batch)
        batches.append(number)

    query = (
        reader.json(root)
        .writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return len(batches)


def run_for_date(
    spark: SparkSession,
    root: str,
    run_date: dt.date | str,
    songs: DataFrame,
    sink: str,
    page: str = "NextSong",
    layout: str = "file",
) -> None:
    """Load the plays of one day's file, replacing what an earlier run of that day stored."""
    day = day_of(run_date)
    fact = keyed_plays(read_events_for(spark, root, day, layout), songs, page)
    overwrite(fact, partition_path(sink, "event_date", day))


def refresh_counts(spark: SparkSession, sink: str, counts: str, keys: Sequence[str], run_date: dt.date | str | None = None) -> None:
    """Bring `day_counts` of the plays at `sink` up to date, for all days or for one.

    Only that day's plays are read and only its counts replaced, so a report after a daily
    run costs the day and the stored counts, however many plays there are.
    """
    if run_date is None:
        overwrite_partitions(day_counts(spark.read.parquet(sink), keys), counts, ["event_date"])
        return
    day = day_of(run_date)
    plays_ = spark.read.parquet(partition_path(sink, "event_date", day)).withColumn("event_date", F.lit(day))
    overwrite(day_counts(plays_, keys).drop("event_date"), partition_path(counts, "event_date", day))
