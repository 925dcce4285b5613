"""The given tables in the roles of an event log and a song catalogue.

A line item is an event of its order's customer, and a play if it was returned
('R'); a part is a song by its brand.  Eight neighbouring parts share a title,
so a title and artist can name several songs, but never more than eight at any
scale.  Closed ('F') plays write the brand in capitals, which the catalogue
does not know.  A play lasts the part's size plus the discount, so durations
agree exactly only for full-price plays and otherwise in whole seconds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomstar.functions.timeparts import from_epoch_millis, to_epoch_millis
from loomstar.schemas import EVENT
from loomstar.session import scratch_path
from loomstar.sinks.tables import FILE_RECORDS

PLAY = "R"
PURCHASE = "purchase"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _title(number: Column) -> Column:
    return F.concat(F.lit("Track "), number.cast("string"))


def song_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SONG records, one per part."""
    part = table(spark, sf_dir, "part")
    return part.select(
        F.lit(1).alias("num_songs"),
        F.regexp_replace("p_brand", "Brand#", "AR").alias("artist_id"),
        F.when(F.col("p_type") != "PROMO", F.length("p_type") * 7.25).alias("artist_latitude"),
        F.lit(None).cast("double").alias("artist_longitude"),
        F.col("p_type").alias("artist_location"),
        F.col("p_brand").alias("artist_name"),
        F.concat(F.lit("S"), F.lpad(F.col("p_partkey").cast("string"), 12, "0")).alias("song_id"),
        _title(F.floor(F.col("p_partkey") / 8)).alias("title"),
        F.col("p_size").cast("double").alias("duration"),
        (F.length("p_type") + 1990).alias("year"),
    )


def _lines(spark: SparkSession, sf_dir: str, users: bool, songs: bool, names: bool) -> DataFrame:
    """Line items with the rows that the flags of `event_log` name.

    Line items move while they are narrow: to their part first, which adds little, and then,
    as the few values that an event is made of, to their order, which has met its customer
    before.  There they are placed as a choice per session needs them.
    """
    log = table(spark, sf_dir, "lineitem")
    at = to_epoch_millis("l_shipdate") + F.col("l_linenumber") * 3_600_000 + F.col("l_suppkey")
    values = {"at": at}
    if songs:
        log = log.join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
        played = F.col("l_returnflag") == PLAY
        values["p_brand"] = F.col("p_brand")
        values["length"] = F.when(played, F.col("p_size") + F.col("l_discount"))
        values["title"] = F.when(played, F.floor(F.col("p_partkey") / 8))
    named = [c.alias(name) for name, c in values.items()]
    log = log.select("l_orderkey", "l_linenumber", "l_linestatus", "l_returnflag", *named)
    if users or names:
        orders = table(spark, sf_dir, "orders")
        if names:
            orders = orders.join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        log = log.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return log


def event_log(
    spark: SparkSession, sf_dir: str, users: bool = True, songs: bool = True, names: bool = False
) -> DataFrame:
    """EVENT records, one per line item.

    Each flag joins the table behind some fields, which stay null without it:
    `users` the order, `songs` the part, `names` the customer as well.
    """
    log = _lines(spark, sf_dir, users, songs, names)
    page = F.col("l_returnflag")
    fields = {
        "auth": F.lit("Logged In"),
        "itemInSession": F.col("l_linenumber"),
        "location": F.col("l_linestatus"),
        "method": F.lit("PUT"),
        "page": page,
        "sessionId": F.col("l_orderkey"),
        "status": F.lit(200),
        "ts": F.col("at"),
    }
    if users or names:
        fields |= {
            "gender": F.col("o_orderstatus"),
            "level": F.col("o_orderpriority"),
            "registration": F.col("o_totalprice"),
            "userId": F.col("o_custkey").cast("string"),
        }
    if names:
        fields |= {"firstName": F.col("c_mktsegment"), "lastName": F.col("c_name")}
    if songs:
        spelled = F.when(F.col("l_linestatus") == "F", F.upper("p_brand"))
        fields |= {
            "artist": F.when(page == PLAY, spelled.otherwise(F.col("p_brand"))).when(
                page == "A", F.lit("")
            ),
            "length": F.col("length"),
            "song": F.when(page == PLAY, _title(F.col("title"))).when(page == "A", F.lit("")),
            "userAgent": F.concat(F.lit('"agent '), F.col("p_brand"), F.lit('"')),
        }
    return _records(log, fields)


def _records(df: DataFrame, fields: dict[str, Column]) -> DataFrame:
    """EVENT records of the given fields, the others null."""
    return df.select(*[
        fields.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in EVENT.fields
    ])


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """EVENT records, one per row of `events`; a purchase is a play."""
    k = F.get_json_object("props", "$.k")
    fields = {
        "artist": F.concat(F.lit("Brand#"), k),
        "gender": F.lit("X"),
        "itemInSession": k,
        "length": F.col("value"),
        "level": F.when(F.col("value") < 50, "free").otherwise("paid"),
        "page": F.col("event_type"),
        "sessionId": F.col("event_id"),
        "song": _title(k),
        "ts": to_epoch_millis("ts"),
        "userId": F.col("user_id").cast("string"),
    }
    return _records(table(spark, sf_dir, "events"), fields)


def write_json(df: DataFrame, path: str, by: Sequence[str] = ()) -> None:
    """Raw JSON as logs are kept: compressed, in files that one task can read whole."""
    writer = df.write.option("compression", "gzip").option("maxRecordsPerFile", FILE_RECORDS)
    writer.partitionBy(*by).json(path)


def export_songs(spark: SparkSession, sf_dir: str, root: str) -> None:
    """Write the catalogue as JSON, three directory levels below song_data/."""
    levels = {"a": F.col("artist_location"), "b": F.col("year"), "c": F.col("num_songs")}
    songs = song_records(spark, sf_dir).withColumns(levels)
    write_json(songs.hint("rebalance", *levels), f"{root}/song_data", [*levels])


def export_monthly(spark: SparkSession, sf_dir: str) -> str:
    """Write line items and parts as raw JSON below a fresh folder; return it.

    A task of the last join writes a file for each of its months, so the wide records do
    not move once more; there are some 80 months at any size.
    """
    root, day = scratch_path(spark, "raw"), from_epoch_millis("ts")
    log = event_log(spark, sf_dir, names=True).withColumns({"y": F.year(day), "m": F.month(day)})
    write_json(log, f"{root}/log_data", ["y", "m"])
    export_songs(spark, sf_dir, root)
    return root


def filed_on() -> Column:
    """The day whose file holds a record of `event_stream`: one in ten comes a day late."""
    late = F.when(F.col("sessionId") % 10 == 0, 1).otherwise(0)
    return F.date_add(F.to_date(from_epoch_millis("ts")), late)


def export_daily(spark: SparkSession, sf_dir: str) -> str:
    """Write the events by day of their file, and the parts, below a fresh folder; return it."""
    root = scratch_path(spark, "raw")
    log = event_stream(spark, sf_dir).withColumn("event_date", filed_on())
    write_json(log.hint("rebalance", "event_date"), f"{root}/log_data", ["event_date"])
    export_songs(spark, sf_dir, root)
    return root
