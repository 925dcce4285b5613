"""Dimensions, facts and reports on the hand-made input."""

import collections
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

import fixtures
from loomstar import functions as fn
from loomstar import operators as op


@pytest.fixture
def plays(spark):
    return op.with_start_time(op.plays(fixtures.events(spark)), "ms")


def test_plays_filter(spark):
    assert op.plays(fixtures.events(spark)).count() == 5
    assert op.non_empty(fixtures.events(spark), "artist").count() == 5


def test_users_by_each_rule(spark, plays):
    pairs = lambda rule: sorted((r.user_id, r.level) for r in op.users_dim(plays, rule).collect())
    assert pairs("row") == [(1, "free"), (1, "paid"), (2, "free"), (3, "free")]
    assert pairs("first") == [(1, "free"), (2, "free"), (3, "free")]
    assert pairs("last") == [(1, "paid"), (2, "free"), (3, "free")]


def test_unknown_options_are_refused(spark, plays):
    with pytest.raises(ValueError):
        op.users_dim(plays, "newest")
    with pytest.raises(ValueError):
        op.users_dim(plays, "first", [])
    with pytest.raises(ValueError):
        op.songplays(plays, fixtures.songs(spark), how="outer")
    with pytest.raises(ValueError):
        op.pick_per_key(plays, ["userId"], ["ts"], "middle")


def test_logged_out_user_id_is_null_not_an_error(spark):
    users = op.users_dim(fixtures.events(spark)).filter("user_id is null")
    assert users.count() == 1


def test_time_precision_and_weekdays(spark):
    events = op.plays(fixtures.events(spark))
    assert op.time_dim(op.with_start_time(events, "ms")).count() == 3
    assert op.time_dim(op.with_start_time(events, "s")).count() == 2
    for style, expected in (("name", "Friday"), ("short", "Fri"), ("sunday0", 5)):
        rows = op.time_dim(op.with_start_time(events, "s"), weekday_style=style).collect()
        assert {r.weekday for r in rows} == {expected}
        assert {(r.week, r.month, r.year, r.day, r.hour) for r in rows} == {(44, 11, 2018, 2, 1)}


def test_time_from_fact_keeps_repeats(spark, plays):
    fact = op.songplays(plays, fixtures.songs(spark), match="first")
    assert op.time_dim_from_fact(fact).count() == 5


@pytest.mark.parametrize(
    "options, rows, matched",
    [
        (dict(match="first"), 5, 3),
        (dict(how="inner", keys=2, distinct=True), 6, 6),
        (dict(how="inner", keys=2), 8, 8),
        (dict(), 6, 4),
        (dict(truncate_duration=True), 6, 5),
        (dict(match="first", how="inner"), 3, 3),
        (dict(match="first", broadcast_bytes=0), 5, 3),
        (dict(match="first", broadcast_bytes=0), 5, 3),
    ],
)
def test_fact_variants(spark, plays, options, rows, matched):
    fact = op.songplays(plays, fixtures.songs(spark), **options)
    assert (fact.count(), fact.filter("song_id is not null").count()) == (rows, matched)


def test_first_match_is_the_lowest_id(spark, plays):
    fact = op.songplays(plays, fixtures.songs(spark), match="first")
    assert {r.song_id for r in fact.collect()} == {"s1", "s3", None}


def test_catalogue_join_equals_staged_songs(spark, plays):
    songs = fixtures.songs(spark)
    known = op.catalogue(op.songs_dim(songs), op.artists_dim(songs))
    fact = op.songplays(plays, known, how="inner", keys=2)
    assert sorted(r["count"] for r in fact.groupBy("artist_id").count().collect()) == [2, 6]


def test_md5_key(spark):
    events = op.with_start_time(op.plays(fixtures.events(spark)), "s")
    keyed = events.select(fn.play_key("sessionId", "start_time").alias("songplay_id"))
    repeated = op.pk_violations(keyed, ["songplay_id"]).collect()
    assert [tuple(r) for r in repeated] == [("d7cac584778b7faa3e95c31c599187c1", 2)]
    null = spark.range(1).select(fn.play_key(F.lit(None).cast("long"), F.lit("x")).alias("k"))
    assert null.first().k is None


def test_reports(spark, plays):
    songs = fixtures.songs(spark)
    fact = fn.surrogate_id(op.songplays(plays, songs, match="first"))
    artists, titles = op.artists_dim(songs, "first"), op.songs_dim(songs)
    assert [tuple(r) for r in op.top_songs(fact, artists, titles).collect()] == [
        ("Ann", "T1", 2), ("Bob", "T2", 1),
    ]
    assert [tuple(r) for r in op.top_artists_all(fact, artists).collect()] == [("Ann", 2), ("Bob", 1)]
    assert [tuple(r) for r in op.top_artists(fact, artists, 1).collect()] == [("Ann", 2)]
    when = op.plays_by_weekday_hour(fact, op.time_dim(plays)).collect()
    assert [tuple(r) for r in when] == [("Friday", 1, 5)]
    # User 1 played three songs and is listed once per level.
    both = op.top_users(fact, op.users_dim(plays, "row")).collect()
    assert [(r.user_id, r.songplay_count) for r in both] == [(1, 6), (2, 1), (3, 1)]


def test_ties_in_top_k_fall_to_the_group_columns(spark):
    counts = spark.createDataFrame([("b", 2), ("a", 2), ("c", 3), ("d", 2)], "name string, n long")
    assert [r.name for r in op.top_k(counts, "n", 3).collect()] == ["c", "a", "b"]


def test_surrogate_and_dense_ids(spark):
    rows = spark.range(0, 1000, 1, 7).withColumnRenamed("id", "v")
    ids = [r.songplay_id for r in fn.surrogate_id(rows, start=5).collect()]
    assert len(set(ids)) == 1000 and min(ids) == 5
    dense = fn.dense_id(rows.filter("v % 3 = 0"), start=1).collect()
    assert sorted(r.songplay_id for r in dense) == list(range(1, 335))
    assert sorted(r.v for r in dense) == list(range(0, 1000, 3))


def test_epoch_conversion_does_not_follow_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        at = fn.from_epoch_millis(F.lit(1541121934796))
        row = spark.range(1).select(
            at.alias("ms"), fn.from_epoch_seconds(F.lit(1541121934796)).alias("s"),
            fn.to_epoch_millis(at).alias("back"), fn.weekday(at).alias("day"),
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert row.ms == dt.datetime(2018, 11, 2, 1, 25, 34, 796000)
    assert row.s == dt.datetime(2018, 11, 2, 1, 25, 34)
    assert (row.back, row.day) == (1541121934796, "Friday")


def test_durations_are_cut_not_rounded(spark):
    row = spark.range(1).select(
        fn.whole_units(F.lit(218.93179)).alias("a"), fn.whole_units(F.lit(-3.9)).alias("b")
    ).first()
    assert (int(row.a), int(row.b)) == (218, -3)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_facts_against_brute_force(spark, seed):
    """Random plays and songs, a third of the plays on one key, some keys null."""
    draw = random.Random(seed)
    songs = [
        {"song_id": f"s{i:03}", "title": f"T{draw.randrange(9)}", "artist_id": "A",
         "artist_name": draw.choice("xyz"), "duration": draw.choice([1.0, 1.5, 2.0])}
        for i in range(60)
    ]
    rows = []
    for i in range(300):
        hot = i % 3 == 0
        rows.append((
            "NextSong", 1541121934796 + i, str(i), "free", i, 0,
            "T1" if hot else draw.choice([f"T{draw.randrange(12)}", None]),
            "x" if hot else draw.choice("xyzw"), 1.0 if hot else draw.choice([1.0, 1.5, 2.0, 3.0]),
        ))
    plays = op.with_start_time(fixtures.events(spark, rows))
    known = fixtures.frame(spark, songs, fixtures.SONG)

    def expect(keys, how, first, cut=False):
        out = collections.Counter()
        for row in rows:
            length = int(row[8]) if cut else row[8]
            hits = sorted(
                s["song_id"] for s in songs
                if row[6] == s["title"] and row[7] == s["artist_name"]
                and (keys == 2 or length == (int(s["duration"]) if cut else s["duration"]))
            )
            hits = hits[:1] if first else hits
            for hit in hits or ([None] if how == "left" else []):
                out[(row[4], hit)] += 1
        return out

    def got(**options):
        fact = op.songplays(plays, known, **options)
        return collections.Counter((r.session_id, r.song_id) for r in fact.collect())

    assert got(match="first") == expect(3, "left", True)
    assert got(match="first", broadcast_bytes=0) == expect(3, "left", True)
    assert got(match="first", keys=2, broadcast_bytes=0) == expect(2, "left", True)
    assert got() == expect(3, "left", False)
    assert got(how="inner", keys=2) == expect(2, "inner", False)
    assert got(truncate_duration=True) == expect(3, "left", False, cut=True)
