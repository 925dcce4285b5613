"""Staging: raw records into typed columns, by mapping or by name."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from loomstar.functions.casts import conform, whole_units
from loomstar.functions.timeparts import from_epoch_millis

EPOCH_MILLIS = "epoch_millis"
WHOLE = "whole"

# Staged column -> (raw field, type).
EVENT_MAPPING = {
    "artist": ("artist", "string"),
    "auth": ("auth", "string"),
    "first_name": ("firstName", "string"),
    "gender": ("gender", "string"),
    "item_in_session": ("itemInSession", "int"),
    "last_name": ("lastName", "string"),
    "length": ("length", "double"),
    "level": ("level", "string"),
    "location": ("location", "string"),
    "method": ("method", "string"),
    "page": ("page", "string"),
    "registration": ("registration", "double"),
    "session_id": ("sessionId", "bigint"),
    "song": ("song", "string"),
    "status": ("status", "int"),
    "ts": ("ts", EPOCH_MILLIS),
    "user_agent": ("userAgent", "string"),
    "user_id": ("userId", "bigint"),
}
# The same two sources with whole-number measures, raw names kept.
WHOLE_EVENTS = {
    "artist": ("artist", "string"),
    "auth": ("auth", "string"),
    "firstName": ("firstName", "string"),
    "gender": ("gender", "string"),
    "itemInSession": ("itemInSession", "int"),
    "lastName": ("lastName", "string"),
    "length": ("length", WHOLE),
    "level": ("level", "string"),
    "location": ("location", "string"),
    "method": ("method", "string"),
    "page": ("page", "string"),
    "registration": ("registration", WHOLE),
    "sessionId": ("sessionId", "bigint"),
    "song": ("song", "string"),
    "status": ("status", "int"),
    "ts": ("ts", "bigint"),
    "userAgent": ("userAgent", "string"),
    "userId": ("userId", "bigint"),
}
WHOLE_SONGS = {
    "num_songs": ("num_songs", "int"),
    "artist_id": ("artist_id", "string"),
    "artist_name": ("artist_name", "string"),
    "artist_latitude": ("artist_latitude", WHOLE),
    "artist_longitude": ("artist_longitude", WHOLE),
    "artist_location": ("artist_location", "string"),
    "song_id": ("song_id", "string"),
    "title": ("title", "string"),
    "duration": ("duration", WHOLE),
    "year": ("year", "int"),
}
# Staged names back to those of a raw event.
EVENT_STAGE = {staged: raw for staged, (raw, _) in EVENT_MAPPING.items()}


def stage(df: DataFrame, mapping: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Columns of `df` picked, renamed and typed by an explicit mapping.

    The type `epoch_millis` parses a number as a timestamp, `whole` cuts off
    its fraction.  Text that does not fit its type becomes null.
    """

    def pick(target: str, source: str, kind: str) -> Column:
        if kind == EPOCH_MILLIS:
            value = from_epoch_millis(source)
        elif kind == WHOLE:
            value = whole_units(source)
        else:
            value = F.col(source).try_cast(kind)
        return value.alias(target)

    return df.select(*[pick(target, source, kind) for target, (source, kind) in mapping.items()])


def stage_auto(df: DataFrame, schema: StructType, epoch_millis: tuple[str, ...] = ()) -> DataFrame:
    """Columns of `df` matched to `schema` by name, case ignored; missing ones null.

    Columns named in `epoch_millis` hold numbers and are read as timestamps.
    """
    wanted = {c.lower() for c in epoch_millis}
    parsed = {c: from_epoch_millis(c) for c in df.columns if c.lower() in wanted}
    return conform(df.withColumns(parsed) if parsed else df, schema)


def stage_table(
    spark: SparkSession,
    path: str,
    fmt: str,
    options: Mapping[str, object],
    target: str,
    schema: StructType | None = None,
    mapping: Mapping[str, tuple[str, str]] | None = None,
) -> DataFrame:
    """Load files of any format into the emptied staging table `target`.

    Later steps then read typed columns from parquet, each only those it
    needs, instead of parsing the raw text once per step.
    """
    reader = spark.read.format(fmt).options(**options)
    raw = (reader.schema(schema) if schema is not None else reader).load(path)
    staged = stage(raw, mapping) if mapping is not None else raw
    staged.write.mode("overwrite").parquet(target)
    return spark.read.schema(staged.schema).parquet(target)
