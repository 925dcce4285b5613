"""Raw file scans.

Every scan takes its schema as given: inferring one would read the files twice
and type them by accident.  A malformed record fails the read by default, as a
silently nulled row would make the result wrong; pass mode="PERMISSIVE" to
keep going.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from loomstar.schemas import EVENT, EVENT_CSV, PLAY11, SONG
from loomstar.sources.records import PLACE as ARRIVAL
from loomstar.sources.records import read_csv_records

#: Names of JSON files; a compressed one is read whole, by one task.
JSON_FILES = "*.{json,json.gz}"
ARRIVAL_NUMBER = "arrival"


def read_json_tree(
    spark: SparkSession, root: str | list[str], schema: StructType, mode: str = "FAILFAST"
) -> DataFrame:
    """All JSON files below `root`, at any depth, plain or compressed, one record per line."""
    return (
        spark.read.schema(schema)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", JSON_FILES)
        .option("mode", mode)
        .json(root)
    )


def read_songs(spark: SparkSession, root: str, mode: str = "FAILFAST") -> DataFrame:
    """Song metadata, kept three directory levels below song_data/."""
    return spark.read.schema(SONG).option("mode", mode).json(f"{root}/song_data/*/*/*/{JSON_FILES}")


def read_events(spark: SparkSession, root: str, mode: str = "FAILFAST") -> DataFrame:
    """The event log, kept by year and month below log_data/."""
    return spark.read.schema(EVENT).option("mode", mode).json(f"{root}/log_data/*/*/{JSON_FILES}")


def day_of(run_date: dt.date | str) -> dt.date:
    """A run date; text must be YYYY-MM-DD."""
    return dt.date.fromisoformat(run_date) if isinstance(run_date, str) else run_date


def events_path(root: str, run_date: dt.date | str) -> str:
    """Where the event log of one day lies."""
    day = day_of(run_date)
    return f"{root}/log_data/{day:%Y}/{day:%m}/{day:%Y-%m-%d}-events.json"


def with_file_date(df: DataFrame, name: str = "event_date") -> DataFrame:
    """Add the date that each record's file is named by, in either layout of `read_events_for`.

    A day is what its file holds, also where a record's own time lies on a
    neighbouring day.  Null for files without a date; call it on a scan.
    """
    found = F.regexp_extract("_metadata.file_path", r"(\d{4}-\d{2}-\d{2})(?:-events\.json(?:\.gz)?|/[^/]+)$", 1)
    return df.withColumn(name, found.try_cast("date"))


def read_events_for(
    spark: SparkSession,
    root: str,
    run_date: dt.date | str,
    layout: str = "file",
    mode: str = "FAILFAST",
) -> DataFrame:
    """The event log of one day only; no other day's folder is even listed.

    layout  `file`       log_data/YYYY/MM/YYYY-MM-DD-events.json
            `partition`  log_data/event_date=YYYY-MM-DD/
    """
    if layout == "file":
        return spark.read.schema(EVENT).option("mode", mode).json(events_path(root, run_date))
    if layout != "partition":
        raise ValueError(f"unknown layout {layout!r}")
    folder = f"{root}/log_data/event_date={day_of(run_date)}"
    return spark.read.schema(EVENT).option("mode", mode).json(folder)


def _csv(
    spark: SparkSession, root: str | list[str], schema: StructType, multi_line: bool, mode: str, arrival: bool = False
) -> DataFrame:
    if multi_line:
        records = read_csv_records(spark, root, schema, mode)
        return records if arrival else records.drop(*ARRIVAL)
    scan = (
        spark.read.schema(schema)
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')  # a quote inside a field is doubled
        .option("encoding", "UTF-8")
        .option("recursiveFileLookup", True)
        .option("columnPruning", False)  # a pruned parse cannot see that a record is malformed
        .option("mode", mode)
        .csv(root)
    )
    return with_arrival(scan) if arrival else scan


def read_events_csv(
    spark: SparkSession, root: str | list[str], multi_line: bool = False, mode: str = "FAILFAST", arrival: bool = False
) -> DataFrame:
    """The CSV export of the log: one header per file, any number of files.

    `multi_line` allows line breaks inside quotes, at the price of reading the text again;
    without it such a record fails the read.  Files are split over tasks either
    way.  `arrival` adds ARRIVAL, the order in which records lie.
    """
    return _csv(spark, root, EVENT_CSV, multi_line, mode, arrival)


def read_plays_csv(
    spark: SparkSession, path: str, multi_line: bool = False, mode: str = "FAILFAST"
) -> DataFrame:
    """The merged 11-column play file."""
    return _csv(spark, path, PLAY11, multi_line, mode)


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """A parquet table, its columns by name in the order of `schema`.

    Partition columns come back last from a plain read, so a caller that cares
    about order must select; with a schema their types are fixed too.
    """
    if schema is None:
        return spark.read.parquet(path)
    return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())


def with_arrival(df: DataFrame) -> DataFrame:
    """Add ARRIVAL, the order in which a scan's records lie: by file, then by place in it.

    The row number grows within each task's part of a file, which the block start
    puts in order, so the order does not depend on how tasks were scheduled.
    """
    file, block, row = ARRIVAL
    return df.select(
        "*",
        F.col("_metadata.file_path").alias(file),
        F.col("_metadata.file_block_start").alias(block),
        F.monotonically_increasing_id().alias(row),
    )


def arrival_places(df: DataFrame) -> DataFrame:
    """The blocks of all files, a row each, numbered in their order by one task."""
    file, block, _ = ARRIVAL
    order = Window.orderBy(file, block)
    return df.select(file, block).distinct().withColumn("_place", F.row_number().over(order).cast("bigint"))


def with_arrival_number(df: DataFrame, places: DataFrame | None = None) -> DataFrame:
    """ARRIVAL as one number of the same order, which makes rows that are sorted or moved by it narrow.

    A row's place in its block is the low part of its ARRIVAL row.  `places` is
    `arrival_places(df)` if it was stored, as for several uses.
    """
    file, block, row = ARRIVAL
    places = arrival_places(df) if places is None else places
    within = F.col(row).bitwiseAND(F.lit((1 << 33) - 1))
    numbered = df.join(F.broadcast(places), [file, block])
    return numbered.withColumn(ARRIVAL_NUMBER, F.shiftleft("_place", 33) + within).drop("_place", *ARRIVAL)


def union_sources(*frames: DataFrame) -> DataFrame:
    """All rows of all frames, columns matched by name, missing ones null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def file_census(df: DataFrame) -> DataFrame:
    """How many records each input file of a scan gave."""
    return df.groupBy(F.col("_metadata.file_path").alias("file_path")).agg(
        F.count("*").alias("n_records")
    )
