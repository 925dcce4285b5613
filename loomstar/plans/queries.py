"""Registered queries: every operator over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomstar import functions as fn
from loomstar import operators as op
from loomstar import sinks, sources
from loomstar.plans import star, wide
from loomstar.plans.roles import (
    PLAY, PURCHASE, event_log, event_stream, export_daily, export_monthly, filed_on, song_records, table,
    write_json,
)
from loomstar.schemas import EVENT, SONG, SONGPLAYS, SONGS, STAR, USERS
from loomstar.session import scratch_path
from loomstar.streaming import refresh_counts, run_for_date, store_plays, stream_events
from loomstar.streaming.ingest import keyed_plays

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)
LINE_KEY = ["l_orderkey", "l_linenumber"]
RUN_DATE, NEXT_DATE = "2024-01-15", "2024-01-16"


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def _plays(spark: SparkSession, sf_dir: str, precision: str = "ms", **parts: bool) -> DataFrame:
    return op.with_start_time(op.plays(event_log(spark, sf_dir, **parts), PLAY), precision)


def _log_times(spark: SparkSession, sf_dir: str, precision: str = "ms") -> DataFrame:
    return _plays(spark, sf_dir, precision, users=False, songs=False)


def _all_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: table(spark, sf_dir, name) for name in TABLES}


# Filters and projections


@query
def plays_filter(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumnRenamed("event_type", "page")
    return op.plays(events, PURCHASE).select("event_id", "user_id", "ts", "value")


@query
def non_empty_filter(spark, sf_dir):
    return op.non_empty(event_log(spark, sf_dir, users=False), "artist").select(
        "sessionId", "itemInSession", "artist", "song"
    )


@query
def project_rename(spark, sf_dir):
    return op.project_play11(_plays(spark, sf_dir, names=True))


@query
def preview(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    return op.preview(customers, ["c_custkey"])


@query
def numeric_casts(spark, sf_dir):
    """Text fields to numbers, '' and words to null."""
    item, user = F.col("itemInSession"), F.col("userId")
    text = F.when(item == 1, F.lit("")).when(item == 2, F.concat(F.lit("no "), user)).otherwise(user)
    raw = event_log(spark, sf_dir).select(
        text.alias("user_id"), F.col("userId").alias("first_name"), F.col("level").alias("LEVEL")
    )
    counts = fn.conform(raw, USERS).groupBy("user_id", "level", "gender")
    return counts.agg(F.count("*").alias("n"), F.count_distinct("first_name").alias("n_names"))


@query
def missing_values(spark, sf_dir):
    """Blank text and absent measures as nulls, counted per page."""
    log = event_log(spark, sf_dir, users=False)
    log = log.withColumn("artist", fn.blank_to_null("artist"))
    return log.groupBy("page").agg(
        F.count("*").alias("n"), F.count("artist").alias("n_artist"), F.count("length").alias("n_length")
    )


# Dimensions


def _users(spark, sf_dir, dedup):
    return op.users_dim(_plays(spark, sf_dir, songs=False, names=True), dedup)


@query
def users_dim_distinct(spark, sf_dir):
    return _users(spark, sf_dir, "row")


@query
def users_dim_first(spark, sf_dir):
    return _users(spark, sf_dir, "first")


@query
def users_dim_last(spark, sf_dir):
    return _users(spark, sf_dir, "last")


@query
def songs_dim(spark, sf_dir):
    return op.songs_dim(song_records(spark, sf_dir))


@query
def artists_dim(spark, sf_dir):
    return op.artists_dim(song_records(spark, sf_dir))


@query
def artists_dim_first(spark, sf_dir):
    return op.artists_dim(song_records(spark, sf_dir), "first")


@query
def time_dim_fullname(spark, sf_dir):
    return op.time_dim(_log_times(spark, sf_dir), weekday_style="name")


@query
def time_dim_short(spark, sf_dir):
    return op.time_dim(_log_times(spark, sf_dir, "s"), weekday_style="short")


@query
def time_dim_sunday0(spark, sf_dir):
    log = event_log(spark, sf_dir, users=False, songs=False)
    staged = sources.stage(log, sources.EVENT_MAPPING)
    return op.time_dim(op.plays(staged, PLAY), "ts", "sunday0")


@query
def time_dim_seconds(spark, sf_dir):
    events = op.with_start_time(event_stream(spark, sf_dir), "s")
    return op.time_dim(op.plays(events, PURCHASE), weekday_style="name")


@query
def time_scalars(spark, sf_dir):
    """Both epoch precisions and every calendar part, per event."""
    events = table(spark, sf_dir, "events").select("event_id", fn.to_epoch_millis("ts").alias("ms"))
    at = fn.from_epoch_millis("ms")
    return events.select(
        "event_id",
        at.alias("at_ms"),
        fn.from_epoch_seconds("ms").alias("at_s"),
        *[part.alias(name) for name, part in fn.calendar(at).items()],
        fn.weekday(at, "short").alias("weekday_short"),
        fn.weekday(at, "sunday0").alias("weekday_number"),
    )


@query
def time_from_fact_dups(spark, sf_dir):
    plays = _plays(spark, sf_dir, "s", users=False)
    fact = op.songplays(plays, song_records(spark, sf_dir), how="inner", keys=2)
    return op.time_dim_from_fact(fact)


# Facts


def _repeated_songs(spark, sf_dir):
    """The catalogue, every tenth song of it twice under another id, so that plays match both."""
    songs = song_records(spark, sf_dir)
    again = songs.filter(F.col("song_id").endswith("3"))
    return songs.unionByName(again.withColumn("song_id", F.regexp_replace("song_id", "^S", "R")))


@query
def catalogue_join(spark, sf_dir):
    songs = song_records(spark, sf_dir)
    return op.catalogue(op.songs_dim(songs), op.artists_dim(songs))


@query
def fact_left_one(spark, sf_dir):
    return op.songplays(_plays(spark, sf_dir), _repeated_songs(spark, sf_dir), match="first")


@query
def fact_left_one_split(spark, sf_dir):
    """The same fact by the route for catalogues too large to broadcast."""
    return op.songplays(
        _plays(spark, sf_dir), _repeated_songs(spark, sf_dir), match="first", broadcast_bytes=0
    )


@query
def fact_inner_distinct(spark, sf_dir):
    """Plays of which some are logged twice."""
    plays = _plays(spark, sf_dir)
    plays = plays.unionByName(plays.filter("itemInSession = 1"))
    return op.songplays(plays, song_records(spark, sf_dir), how="inner", keys=2, distinct=True)


@query
def fact_inner(spark, sf_dir):
    songs = song_records(spark, sf_dir)
    known = op.catalogue(op.songs_dim(songs), op.artists_dim(songs))
    return op.songplays(_plays(spark, sf_dir, "s"), known, how="inner", keys=2)


@query
def fact_left_fanout(spark, sf_dir):
    return op.songplays(_plays(spark, sf_dir, "s"), _repeated_songs(spark, sf_dir))


@query
def fact_left_truncated(spark, sf_dir):
    return op.songplays(
        _plays(spark, sf_dir, "s"), song_records(spark, sf_dir), truncate_duration=True
    )


@query
def fact_md5_key(spark, sf_dir):
    return keyed_plays(
        event_log(spark, sf_dir), song_records(spark, sf_dir), PLAY, truncate_duration=True
    )


@query
def fact_partition_cols(spark, sf_dir):
    fact = op.songplays(_plays(spark, sf_dir, "s"), song_records(spark, sf_dir), how="inner", keys=2)
    return fact.withColumns({"year": F.year("start_time"), "month": F.month("start_time")})


@query
def surrogate_id(spark, sf_dir):
    fact = op.songplays(
        _plays(spark, sf_dir, users=False), song_records(spark, sf_dir), how="inner", keys=2
    )
    return fn.surrogate_id(fact).agg(
        F.count("*").alias("n_rows"), F.count_distinct("songplay_id").alias("n_ids")
    )


@query
def dense_id(spark, sf_dir):
    fact = op.songplays(
        _plays(spark, sf_dir, users=False), song_records(spark, sf_dir), how="inner", keys=2
    )
    return fn.dense_id(fact, start=1).agg(
        F.count_distinct("songplay_id").alias("n_ids"),
        F.min("songplay_id").alias("first_id"),
        F.max("songplay_id").alias("last_id"),
    )


# Reports


def _fact_with_key(spark, sf_dir, users=False):
    log = event_log(spark, sf_dir, users)
    return keyed_plays(log, song_records(spark, sf_dir), PLAY, how="inner", keys=2)


@query
def top_artists_all(spark, sf_dir):
    artists = op.artists_dim(song_records(spark, sf_dir), "first")
    return op.top_artists_all(_fact_with_key(spark, sf_dir), artists)


@query
def plays_by_weekday_hour(spark, sf_dir):
    played = _plays(spark, sf_dir, users=False)
    fact = op.songplays(played, song_records(spark, sf_dir), match="first")
    return op.plays_by_weekday_hour(fact, op.time_dim(_log_times(spark, sf_dir)))


@query
def top_users(spark, sf_dir):
    users = op.users_dim(_plays(spark, sf_dir, songs=False, names=True), "first")
    return op.top_users(_fact_with_key(spark, sf_dir, users=True), users)


@query
def top_users_distinct_rows(spark, sf_dir):
    """With whole-row users: one who changed level counts once per level."""
    users = op.users_dim(_plays(spark, sf_dir, songs=False, names=True), "row")
    return op.top_users(_fact_with_key(spark, sf_dir, users=True), users)


@query
def top_artists(spark, sf_dir):
    return op.top_artists(_fact_with_key(spark, sf_dir), op.artists_dim(song_records(spark, sf_dir)))


@query
def top_songs(spark, sf_dir):
    songs = song_records(spark, sf_dir)
    return op.top_songs(
        _fact_with_key(spark, sf_dir), op.artists_dim(songs, "first"), op.songs_dim(songs)
    )


# Query-first tables and lookups


@query
def song_data_by_session(spark, sf_dir):
    return op.song_data_by_session(_plays(spark, sf_dir, users=False)).withColumn(
        "length", F.round(F.col("length").cast("double"), 2)
    )


@query
def song_data_by_user_and_session(spark, sf_dir):
    return op.song_data_by_user_and_session(_plays(spark, sf_dir, names=True))


@query
def user_data_by_song(spark, sf_dir):
    return op.user_data_by_song(_plays(spark, sf_dir, names=True))


@query
def lookup_session_item(spark, sf_dir):
    found = op.q_session_item(op.song_data_by_session(_plays(spark, sf_dir, users=False)), 14, 6)
    return found.withColumn("length", F.round(F.col("length").cast("double"), 2))


@query
def lookup_user_session(spark, sf_dir):
    plays = _plays(spark, sf_dir, names=True)
    return op.q_user_session(op.song_data_by_user_and_session(plays), 1122, 56)


@query
def lookup_users_by_song(spark, sf_dir):
    plays = _plays(spark, sf_dir, names=True)
    return op.q_users_by_song(op.user_data_by_song(plays), "Track 3")


@query
def lookups_clustered(spark, sf_dir):
    """The three lookups from one table of all plays, clustered by session, user and song."""
    path = scratch_path(spark, "clustered")
    plays = _plays(spark, sf_dir, names=True).withColumn("user_id", F.col("userId").try_cast("bigint"))
    sinks.write_clustered(plays, path, ["sessionId", "user_id", "song"])
    stored = spark.read.parquet(path)
    own = lambda **values: sinks.where_equal(stored, values).drop("user_id")
    found = {
        "session_item": op.q_session_item(op.song_data_by_session(own(sessionId=14)), 14, 6),
        "user_session": op.q_user_session(op.song_data_by_user_and_session(own(user_id=1122, sessionId=56)), 1122, 56),
        "users_by_song": op.q_users_by_song(op.user_data_by_song(own(song="Track 3")), "Track 3"),
    }
    rows = sources.union_sources(*[df.withColumn("lookup", F.lit(name)) for name, df in found.items()])
    return rows.withColumn("length", F.round(F.col("length").cast("double"), 2))


# Writes, each read back


def _halves(spark, sf_dir):
    """Line items by status: a stored table and the rows that come later."""
    lines = table(spark, sf_dir, "lineitem")
    return lines.filter("l_linestatus = 'O'"), lines.filter("l_linestatus = 'F'")


@query
def insert_if_absent(spark, sf_dir):
    path = scratch_path(spark, "absent")
    stored, later = _halves(spark, sf_dir)
    for rows in (stored, later, later):
        sinks.insert_if_absent(rows, path, LINE_KEY, ["l_shipdate"])
    return spark.read.parquet(path)


@query
def insert_if_absent_by_digest(spark, sf_dir):
    """The same insertions, of which each reads only stored files that may hold one of its keys."""
    path = scratch_path(spark, "absent")
    stored, later = _halves(spark, sf_dir)
    for rows in (stored, later, later):
        sinks.insert_if_absent_by_digest(rows, path, LINE_KEY, ["l_shipdate"])
    return spark.read.parquet(path)


@query
def upsert_last(spark, sf_dir):
    path = scratch_path(spark, "upsert")
    stored, later = _halves(spark, sf_dir)
    for rows in (stored, later):
        sinks.upsert_versions(rows, path, LINE_KEY, ["l_shipdate"])
    return sinks.read_versions(spark, path, LINE_KEY, stored.schema)


@query
def upsert_compacted(spark, sf_dir):
    """All lines, then those of each return flag again at no price, the versions made one table on the way."""
    path, lines = scratch_path(spark, "upsert"), table(spark, sf_dir, "lineitem")
    free = lines.withColumn("l_extendedprice", F.lit(0.0))
    for rows in (lines, *(free.filter(F.col("l_returnflag") == flag) for flag in ("R", "A"))):
        sinks.upsert_versions(rows, path, LINE_KEY, ["l_shipdate"], sort=LINE_KEY, compact_at=0.2)
    return sinks.read_versions(spark, path, LINE_KEY, lines.schema)


@query
def upsert_partitions(spark, sf_dir):
    """Customers' balances upserted by segment and key, one touched partition at a time."""
    path = scratch_path(spark, "upsert")
    customers = table(spark, sf_dir, "customer")
    paid = customers.filter("c_mktsegment = 'BUILDING'").withColumn("c_acctbal", F.lit(0.0))
    for rows in (customers, paid):
        sinks.upsert(rows, path, ["c_mktsegment", "c_custkey"], [], ["c_mktsegment"])
    return spark.read.schema(customers.schema).parquet(path)


@query
def append_fact(spark, sf_dir):
    path = scratch_path(spark, "append")
    for rows in _halves(spark, sf_dir):
        sinks.append(rows, path)
    return spark.read.parquet(path)


@query
def overwrite_dim(spark, sf_dir):
    path = scratch_path(spark, "overwrite")
    for rows in _halves(spark, sf_dir):
        sinks.load_dimension(rows, path, truncate=True)
    return spark.read.parquet(path)


@query
def load_dimension_append(spark, sf_dir):
    path = scratch_path(spark, "dimension")
    users = op.users_dim(_plays(spark, sf_dir, songs=False, names=True))
    for truncate in (True, False):
        sinks.load_dimension(users, path, truncate)
    return spark.read.parquet(path)


@query
def insert_by_name(spark, sf_dir):
    songs = song_records(spark, sf_dir).select("artist_id", "duration", "song_id", "title")
    return sinks.insert_by_name(songs, SONGS, {"year": F.lit(0)})


@query
def insert_by_position(spark, sf_dir):
    songs = song_records(spark, sf_dir)
    return sinks.insert_by_position(
        songs.select("song_id", "artist_name", "artist_location", "duration", "year"), SONGS
    )


@query
def reset_tables(spark, sf_dir):
    """Fill the user dimension, reset the star, count what is left, fill it again."""
    root = scratch_path(spark, "reset")
    users = op.users_dim(_plays(spark, sf_dir, songs=False, names=True))
    sinks.append(users, f"{root}/users")
    sinks.reset_tables(spark, root, STAR)
    empty = op.row_counts({name: spark.read.parquet(f"{root}/{name}") for name in STAR})
    again = f"{root}/users_again"
    sinks.append(users, again)
    return empty.unionByName(op.row_counts({"users_again": spark.read.parquet(again)}))


@query
def parquet_plain_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "plain")
    sinks.write_table(op.artists_dim(song_records(spark, sf_dir)), path)
    return sources.read_table(spark, path)


@query
def parquet_partition_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "partitioned")
    sinks.write_table(
        op.songs_dim(song_records(spark, sf_dir)), path, partition_by=["year", "artist_id"]
    )
    return sources.read_table(spark, path, SONGS)


@query
def layout_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "layout")
    plays = op.song_data_by_user_and_session(_plays(spark, sf_dir, names=True))
    key = ["user_id", "session_id"]
    sinks.write_table(plays, path, dist=key, sort=[*key, "item_in_session"])
    return sources.read_table(spark, path)


@query
def bucketed_roundtrip(spark, sf_dir):
    """A table in buckets, read back."""
    plays = op.song_data_by_user_and_session(_plays(spark, sf_dir, names=True))
    return sinks.in_buckets(plays, 8, ["user_id"], ["session_id", "item_in_session"])


@query
def fact_inner_bucketed(spark, sf_dir):
    """Plays and catalogue stored in equal buckets of title and artist, and joined where they lie."""
    songs = song_records(spark, sf_dir)
    known = op.catalogue(op.songs_dim(songs), op.artists_dim(songs))
    known = sinks.in_buckets(known, 16, ["title", "artist_name"], ["title", "artist_name"])
    plays = sinks.in_buckets(_plays(spark, sf_dir, "s"), 16, ["song", "artist"], ["song", "artist"])
    return op.songplays(plays, known.hint("merge"), how="inner", keys=2)


@query
def csv_quoted_roundtrip(spark, sf_dir):
    """Quotes inside fields, and the play file written from the log and read again."""
    path = scratch_path(spark, "csv")
    plays = op.non_empty(event_log(spark, sf_dir, names=True), "artist")
    quoted = plays.withColumn("location", F.col("userAgent"))
    sinks.write_csv(op.project_play11(quoted), path)
    return sources.read_plays_csv(spark, path)


@query
def csv_events_roundtrip(spark, sf_dir):
    """The 17-column export, in two files sets with a header each."""
    root = scratch_path(spark, "csv-export")
    log = event_log(spark, sf_dir, names=True).drop("userAgent")
    for status in ("F", "O"):
        sinks.write_csv(log.filter(F.col("location") == status), f"{root}/{status}", quote_all=False)
    return op.non_empty(sources.read_events_csv(spark, root), "artist")


def _json_tree(spark, sf_dir):
    root = scratch_path(spark, "json")
    log = event_log(spark, sf_dir).withColumns({"a": F.col("page"), "b": F.col("level")})
    write_json(log, f"{root}/log_data", ["a", "b"])
    return root


@query
def json_roundtrip(spark, sf_dir):
    return sources.read_json_tree(spark, _json_tree(spark, sf_dir), EVENT)


@query
def json_glob_roundtrip(spark, sf_dir):
    return sources.read_events(spark, _json_tree(spark, sf_dir))


@query
def json_songs_roundtrip(spark, sf_dir):
    root = scratch_path(spark, "songs")
    songs = song_records(spark, sf_dir)
    levels = {"a": F.col("artist_location"), "b": F.col("year"), "c": F.col("num_songs")}
    write_json(songs.withColumns(levels), f"{root}/song_data", [*levels])
    return sources.read_songs(spark, root)


@query
def file_census(spark, sf_dir):
    """Records of all files of a scan; the files themselves are named at random."""
    files = sources.file_census(sources.read_json_tree(spark, _json_tree(spark, sf_dir), EVENT))
    return files.agg(
        F.sum("n_records").alias("n_records"), (F.min("n_records") > 0).alias("none_empty")
    )


# Staging


@query
def stage_mapping(spark, sf_dir):
    return sources.stage(event_log(spark, sf_dir), sources.EVENT_MAPPING)


@query
def stage_auto(spark, sf_dir):
    songs = song_records(spark, sf_dir)
    return sources.stage_auto(songs.toDF(*[c.upper() for c in songs.columns]), SONG)


@query
def stage_table(spark, sf_dir):
    """JSON files into a staging table, twice: the second load replaces the first."""
    root, target = _json_tree(spark, sf_dir), scratch_path(spark, "staged")
    options = {"recursiveFileLookup": True}
    for _ in range(2):
        staged = sources.stage_table(
            spark, root, "json", options, target, EVENT, sources.EVENT_MAPPING
        )
    return staged


@query
def union_sources(spark, sf_dir):
    """The JSON log and the CSV export of the other log as one relation."""
    path = scratch_path(spark, "export")
    sinks.write_csv(event_stream(spark, sf_dir).drop("userAgent"), path)
    both = sources.union_sources(event_log(spark, sf_dir), sources.read_events_csv(spark, path))
    return both.groupBy("page").agg(
        F.count("*").alias("n"), F.count("userAgent").alias("n_agents"), F.count("song").alias("n_songs")
    )


# Incremental


@query
def date_incremental(spark, sf_dir):
    root = export_daily(spark, sf_dir)
    return sources.read_events_for(spark, root, RUN_DATE, layout="partition").select(
        "sessionId", "userId", "page", "song", "artist", "length", "ts"
    )


@query
def date_incremental_file(spark, sf_dir):
    """One day of a log of one file a day, beside the next day's."""
    root = scratch_path(spark, "raw")
    log = event_stream(spark, sf_dir)
    for day in (RUN_DATE, NEXT_DATE):
        log.filter(filed_on() == F.lit(day).cast("date")).write.json(sources.events_path(root, day))
    return sources.read_events_for(spark, root, RUN_DATE).select(
        "sessionId", "userId", "page", "song", "artist", "length", "ts"
    )


@query
def stream_ingest(spark, sf_dir):
    """Closed lines streamed in, then all lines, which overlap them; some plays lack a session."""
    session = F.col("sessionId")
    log = event_log(spark, sf_dir).withColumn("sessionId", F.when(session % 50 != 0, session))
    log = sinks.once(log)  # for both files sets
    root, sink = scratch_path(spark, "json"), scratch_path(spark, "streamed")
    songs, checkpoint = song_records(spark, sf_dir), scratch_path(spark, "progress")
    for name, rows in (("first", log.filter("location = 'F'")), ("second", log)):
        write_json(rows, f"{root}/{name}")
        stream_events(spark, root, checkpoint, lambda batch: store_plays(batch, songs, sink, PLAY))
    return spark.read.parquet(sink).drop("event_key")


def _reruns(spark, sf_dir):
    """The whole log loaded by its files' dates, then neighbouring days run again, one of them twice."""
    root, sink = export_daily(spark, sf_dir), scratch_path(spark, "daily")
    songs = song_records(spark, sf_dir)
    log = sources.with_file_date(sources.read_json_tree(spark, f"{root}/log_data", EVENT))
    sinks.overwrite_partitions(keyed_plays(log, songs, PURCHASE, also=["event_date"]), sink, ["event_date"])
    for day in (RUN_DATE, NEXT_DATE, "2024-01-17", NEXT_DATE, RUN_DATE, RUN_DATE):
        run_for_date(spark, root, day, songs, sink, PURCHASE, layout="partition")
    return spark.read.parquet(sink)


@query
def rerun_idempotent(spark, sf_dir):
    """The plays of all days after the whole log was loaded and some days run again."""
    return _reruns(spark, sf_dir)


@query
def report_day_counts(spark, sf_dir):
    """Plays by artist and by user from counts kept by day, brought up to date after days were run again."""
    root, sink = export_daily(spark, sf_dir), scratch_path(spark, "daily")
    songs, kept = song_records(spark, sf_dir), {key: scratch_path(spark, "counts") for key in ("artist_id", "user_id")}
    log = sources.with_file_date(sources.read_json_tree(spark, f"{root}/log_data", EVENT))
    log = log.where(F.col("event_date") != F.lit(NEXT_DATE).cast("date"))  # comes later
    sinks.overwrite_partitions(keyed_plays(log, songs, PURCHASE, also=["event_date"]), sink, ["event_date"])
    for key, path in kept.items():
        refresh_counts(spark, sink, path, [key])
    for day in (RUN_DATE, NEXT_DATE, RUN_DATE):
        run_for_date(spark, root, day, songs, sink, PURCHASE, layout="partition")
        for key, path in kept.items():
            refresh_counts(spark, sink, path, [key], day)
    sums = [F.sum(n).alias(n) for n in ("n_rows", "n_plays")]
    parts = [
        spark.read.parquet(path).groupBy(F.col(key).cast("string").alias("key")).agg(*sums).withColumn("report", F.lit(key))
        for key, path in kept.items()
    ]
    return sources.union_sources(*parts)


# Quality


@query
def row_counts(spark, sf_dir):
    return op.row_counts(_all_tables(spark, sf_dir))


@query
def quality_report(spark, sf_dir):
    """Has-rows checks on all tables, and checks that fail in each possible way."""
    tables = _all_tables(spark, sf_dir)
    lines, docs = tables["lineitem"], tables["documents"]
    log = event_log(spark, sf_dir, users=False)
    repeated = op.pk_violations(lines, LINE_KEY)
    lines.createOrReplaceTempView("quality_lines")
    checks = {
        **op.has_rows_checks(tables),
        "some_discount_in_sql": "SELECT count(*) AS n, max(l_discount) AS most FROM quality_lines",
        "some_loss_in_sql": "SELECT count(*) AS n FROM quality_lines WHERE l_extendedprice < 0",
        "lineitem_key_unique": repeated.agg((F.count("*") == 0).alias("unique")),
        "order_key_unique": op.pk_violations(tables["orders"], ["o_orderkey"]).agg(
            (F.count("*") == 0).alias("unique")
        ),
        "no_unlabelled_document": op.fk_violations(docs, tables["labels"], "doc_id").agg(
            (F.count("*") == 0).alias("none")
        ),
        "a_free_part_exists": tables["part"].filter("p_retailprice = 0").select("p_partkey"),
        "quiet_page_has_artist": log.filter("page = 'N'").agg(F.max("artist").alias("artist")),
        "blank_page_has_artist": log.filter("page = 'A'").agg(F.max("artist").alias("artist")),
    }
    return op.run_checks(spark, checks).select("test_name", "passed")


@query
def failed_checks(spark, sf_dir):
    """The one error that names every failed check of the report above."""
    report = quality_report(spark, sf_dir).withColumn("detail", F.lit(""))
    try:
        op.assert_checks(report)
    except op.DataQualityError as error:
        return spark.createDataFrame([(int(str(error).split()[0]),)], "n_failed bigint")
    return spark.createDataFrame([(0,)], "n_failed bigint")


def _star_rules(spark, sf_dir):
    tables = {
        "lines": table(spark, sf_dir, "lineitem").withColumnsRenamed({"l_orderkey": "o_orderkey", "l_partkey": "p_partkey"}),
        "orders": table(spark, sf_dir, "orders"),
        "parts": table(spark, sf_dir, "part").filter("p_partkey % 2 = 0"),
        "log": event_log(spark, sf_dir, users=False),
    }
    rules = {
        "unique": {"orders": ["o_orderkey"], "lines": ["o_orderkey"]},
        "required": {"lines": ["o_orderkey"], "log": ["ts", "length"]},
        "references": {"lines": {"o_orderkey": "orders", "p_partkey": "parts"}},
    }
    return tables, rules


@query
def star_violations(spark, sf_dir):
    """Checks of keys, required columns and references on the log, of which some fail."""
    tables, rules = _star_rules(spark, sf_dir)
    return op.run_checks(spark, op.star_checks(tables, **rules)).select("test_name", "passed")


@query
def star_violations_fused(spark, sf_dir):
    """The same checks with one scan of each table."""
    tables, rules = _star_rules(spark, sf_dir)
    return op.fused_checks(tables, **rules).select("test_name", "passed")


@query
def pk_violations(spark, sf_dir):
    return op.pk_violations(table(spark, sf_dir, "lineitem"), LINE_KEY)


@query
def null_violations(spark, sf_dir):
    return op.null_violations(event_log(spark, sf_dir), ["artist", "song", "length", "ts", "userId"])


@query
def fk_violations(spark, sf_dir):
    return op.fk_violations(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "doc_id"
    )


# Whole loads


def _out(spark):
    return scratch_path(spark, "star")


@query
def star_first_wins(spark, sf_dir):
    tables = star.star_first_wins(spark, export_monthly(spark, sf_dir), _out(spark), PLAY)
    return tables["songplays"].drop("songplay_id")


@query
def star_first_wins_rerun(spark, sf_dir):
    """Table sizes after two runs: dimensions as after one, plays appended twice."""
    root, out = export_monthly(spark, sf_dir), _out(spark)
    for _ in range(2):
        tables = star.star_first_wins(spark, root, out, PLAY)
    numbered = op.pk_violations(tables["songplays"], ["songplay_id"])
    return op.row_counts({**tables, "repeated_ids": numbered})


@query
def star_distinct(spark, sf_dir):
    tables = star.star_distinct(spark, export_monthly(spark, sf_dir), _out(spark), PLAY)
    return op.top_songs(tables["songplays"], tables["artists"], tables["songs"])


@query
def star_lake(spark, sf_dir):
    tables = star.star_lake(spark, export_monthly(spark, sf_dir), _out(spark), PLAY)
    return tables["songplays"].drop("songplay_id")


@query
def star_daily(spark, sf_dir):
    root, out = export_daily(spark, sf_dir), _out(spark)
    tables = star.star_daily(spark, root, out, page=PURCHASE)
    return tables["songplays"].select(*SONGPLAYS.fieldNames())


@query
def star_distinct_fact(spark, sf_dir):
    tables = star.star_distinct(spark, export_monthly(spark, sf_dir), _out(spark), PLAY)
    return tables["songplays"].drop("songplay_id")


def _daily_reruns(spark, sf_dir):
    """The whole log loaded, then two neighbouring days again, across whose midnight plays fall."""
    root, out = export_daily(spark, sf_dir), _out(spark)
    for run_date in (None, RUN_DATE, NEXT_DATE):
        tables = star.star_daily(spark, root, out, run_date, PURCHASE, layout="partition")
    return tables


@query
def star_daily_rerun(spark, sf_dir):
    return _daily_reruns(spark, sf_dir)["songplays"]


@query
def star_daily_times(spark, sf_dir):
    return _daily_reruns(spark, sf_dir)["time"]


def _daily_carried(spark, sf_dir):
    """The whole log loaded, then one day of it again with the users carried forward."""
    root, out = export_daily(spark, sf_dir), _out(spark)
    for run_date in (None, RUN_DATE):
        tables = star.star_daily(spark, root, out, run_date, PURCHASE, layout="partition", carry_users=True)
    return tables


@query
def star_daily_tables(spark, sf_dir):
    """Table sizes after loading the whole log and then one day again."""
    return op.row_counts(_daily_carried(spark, sf_dir))


@query
def star_daily_users(spark, sf_dir):
    """All users after a run of one day, not only that day's."""
    return _daily_carried(spark, sf_dir)["users"]


@query
def wide_tables(spark, sf_dir):
    """The play file upserted into the three tables, twice over; all their rows.

    A later file logs some plays again, under a title with a line break in it.
    Within a file, whose line order SQL cannot know, an item occurs once.
    """
    root, out = scratch_path(spark, "csv-log"), scratch_path(spark, "wide")
    log = event_log(spark, sf_dir, names=True).drop("userAgent")
    log = sinks.once(op.pick_per_key(log, ["sessionId", "itemInSession"], ["ts"]), wide.MANY_VALUED)  # for both files sets
    live = F.when(F.col("artist") != "", F.concat("song", F.lit("\n(live)"))).otherwise(F.col("song"))
    for name, rows in (("a", log), ("b", log.filter("location = 'F'").withColumn("song", live))):
        sinks.write_csv(rows, f"{root}/{name}", quote_all=False, compression="gzip")
    for _ in range(2):
        tables = wide.wide_tables(spark, root, out, compression="gzip")
    rows = [df.withColumn("table_name", F.lit(name)) for name, df in tables.items()]
    return sources.union_sources(*rows).withColumn("length", F.round(F.col("length").cast("double"), 2))
