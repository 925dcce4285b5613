"""From the CSV export to one query-first table per question."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession

from loomstar.operators.filters import non_empty, project_play11
from loomstar.operators.lookups import (
    song_data_by_session, song_data_by_user_and_session, user_data_by_song,
)
from loomstar.plans.steps import together
from loomstar.sinks.tables import once, packing, write_csv
from loomstar.sinks.versions import read_versions, upsert_versions
from loomstar.sources.files import ARRIVAL_NUMBER, arrival_places, read_events_csv, with_arrival_number

# The columns that place a row and order it there; files are sorted by both.
PLACEMENT = {
    "song_data_by_session": (["session_id"], ["item_in_session"]),
    "song_data_by_user_and_session": (["user_id", "session_id"], ["item_in_session"]),
    "user_data_by_song": (["song_title"], ["user_id"]),
}
#: Columns of the log and of the tables in which most rows have a value of their own.
MANY_VALUED = (
    "lastName", "registration", "sessionId", "song", "ts", "userId", "arrival_row",
    "session_id", "song_title", "user_id", "user_last_name",
)
_BUILD = {
    "song_data_by_session": song_data_by_session,
    "song_data_by_user_and_session": song_data_by_user_and_session,
    "user_data_by_song": user_data_by_song,
}


def wide_tables(
    spark: SparkSession, root: str, out: str, multi_line: bool = True, compression: str = "none"
) -> dict[str, DataFrame]:
    """Merge the CSV files into one play file and upsert the three tables from them.

    The export is parsed once, into typed parquet, with the place of each record;
    of records with one key the later wins, by file name and then by line.  The
    merged play file is written from there.  `multi_line` reads line breaks inside
    quotes, by as many tasks as a file has blocks; without it such a record fails the load.  A stored
    table takes the plays as a version of its own, which wins when it is read.
    `compression` is that of the merged play file.
    """
    played = non_empty(read_events_csv(spark, root, multi_line, arrival=True), "artist")
    staged = f"{out}/staging_plays"
    played.write.mode("overwrite").options(**packing(MANY_VALUED)).parquet(staged)
    plays = spark.read.schema(played.schema).parquet(staged)
    numbered = with_arrival_number(plays, once(arrival_places(plays)))  # for three tables
    tables = {name: build(numbered, [ARRIVAL_NUMBER]) for name, build in _BUILD.items()}

    def load(name: str) -> None:
        # The choice per key has brought rows together; each file is sorted by place, so a
        # lookup opens a row group of it, and a hot session or song stays spread over files.
        key = [*PLACEMENT[name][0], *PLACEMENT[name][1]]
        upsert_versions(tables[name], f"{out}/{name}", key, sort=key, chosen=True, options=packing(MANY_VALUED))

    merge = partial(write_csv, project_play11(plays), f"{out}/plays_csv", mode="overwrite", compression=compression)
    together(merge, *[partial(load, name) for name in PLACEMENT])
    keys = {name: [*dist, *sort] for name, (dist, sort) in PLACEMENT.items()}
    return {name: read_versions(spark, f"{out}/{name}", keys[name], df.schema) for name, df in tables.items()}
