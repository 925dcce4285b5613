"""Scans and staging."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, TimestampNTZType

import fixtures
from loomstar import sources
from loomstar.schemas import EVENT, SONG, SONGS

SONG_LINE = """{"num_songs": 1, "artist_id": "AR00000000000000Q1", "artist_latitude": null, "artist_longitude": null, "artist_location": "Nowhere - NW", "artist_name": "Quiet Lamps", "song_id": "SO00000000000000Q1", "title": "Don't Wake The Moss", "duration": 201.12345, "year": 0}"""
EVENT_LINE = r"""{"artist":"L'orme","auth":"Logged In","firstName":"Pia","gender":"F","itemInSession":1,"lastName":"Quill","length":187.5,"level":"free","location":"Nowhere, NW","method":"PUT","page":"NextSong","registration":1540000000000.0,"sessionId":77,"song":"Paper Tide","status":200,"ts":1541100000123,"userAgent":"\"Browser\/1.0\"","userId":"8"}"""


@pytest.fixture
def raw(tmp_path):
    fixtures.write_raw(str(tmp_path))
    return str(tmp_path)


def test_json_scans_agree(spark, raw):
    assert sources.read_json_tree(spark, f"{raw}/song_data", SONG).count() == 5
    assert sources.read_songs(spark, raw).count() == 5
    tree = sources.read_json_tree(spark, f"{raw}/log_data", EVENT)
    assert tree.count() == sources.read_events(spark, raw).count() == 7
    assert tree.schema == EVENT


def test_sample_records(spark, tmp_path):
    (tmp_path / "song.json").write_text(SONG_LINE)
    (tmp_path / "event.json").write_text(EVENT_LINE)
    song = sources.read_json_tree(spark, str(tmp_path / "song.json"), SONG).first()
    assert (song.title, song.duration, song.artist_latitude, song.year) == (
        "Don't Wake The Moss", 201.12345, None, 0,
    )
    event = sources.read_json_tree(spark, str(tmp_path / "event.json"), EVENT).first()
    assert (event.userId, event.ts, event.userAgent) == ("8", 1541100000123, '"Browser/1.0"')


def test_malformed_record_fails_unless_allowed(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"song_id": "s1"}\n{"song_id": \n')
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|Malformed"):
        sources.read_json_tree(spark, str(tmp_path), SONG).collect()
    lax = sources.read_json_tree(spark, str(tmp_path), SONG, mode="DROPMALFORMED").collect()
    assert [r.song_id for r in lax] == ["s1"]


def test_one_day(spark, raw):
    for day in ("2018-11-03", dt.date(2018, 11, 3)):
        assert [r.userId for r in sources.read_events_for(spark, raw, day).collect()] == ["7"]
    with pytest.raises(ValueError):
        sources.read_events_for(spark, raw, "2018-11-03", layout="hourly")


def test_one_day_by_partition_opens_only_that_partition(spark, out):
    events = fixtures.events(spark).withColumn("event_date", F.lit("2018-11-02").cast("date"))
    later = events.withColumn("event_date", F.lit("2018-11-03").cast("date"))
    events.unionByName(later).write.partitionBy("event_date").json(f"{out}/log_data")
    day = sources.read_events_for(spark, out, "2018-11-02", layout="partition")
    assert day.count() == 6 and day.schema == EVENT
    assert {"event_date=2018-11-02" in f for f in day.inputFiles()} == {True}


def test_file_census(spark, raw):
    files = sources.file_census(sources.read_json_tree(spark, f"{raw}/log_data", EVENT))
    assert sorted(r.n_records for r in files.collect()) == [1, 6]


def test_stage_by_mapping(spark):
    staged = sources.stage(fixtures.events(spark), sources.EVENT_MAPPING)
    assert staged.columns[:4] == ["artist", "auth", "first_name", "gender"]
    row = staged.filter("page = 'Home'").first()
    assert row.user_id is None and row.ts == dt.datetime(2018, 11, 2, 1, 26, 41)


def test_stage_by_name_ignores_case_and_fills_gaps(spark):
    df = spark.createDataFrame(
        [("s1", "7", float("nan"), 1541121934796)], "SONG_ID string, Year string, duration double, at long"
    )
    row = sources.stage_auto(df, SONGS).first()
    assert (row.song_id, row.year, row.duration, row.title) == ("s1", 7, None, None)
    timed = sources.stage_auto(df, StructType([StructField("At", TimestampNTZType())]), ("at",))
    assert timed.first().At == dt.datetime(2018, 11, 2, 1, 25, 34, 796000)


def test_stage_table_replaces(spark, raw, out):
    target = f"{out}/staged"
    for expected in (7, 7):
        staged = sources.stage_table(
            spark, f"{raw}/log_data/*/*/*.json", "json", {}, target, EVENT, sources.EVENT_MAPPING
        )
        assert staged.count() == expected
    assert dict(staged.dtypes)["ts"] == "timestamp_ntz"


def test_union_of_unlike_sources(spark):
    events = fixtures.events(spark)
    both = sources.union_sources(events, events.drop("userAgent").select("ts", "page", "song"))
    assert both.count() == 12 and both.columns == events.columns
