"""Whole loads and incremental loads on the hand-made input."""

import pytest

import fixtures
from loomstar import operators as op
from loomstar import session
from loomstar.plans import star_daily, star_distinct, star_first_wins, star_lake
from loomstar.streaming import refresh_counts, run_for_date, store_plays, stream_events


@pytest.fixture
def raw(tmp_path):
    fixtures.write_raw(str(tmp_path / "raw"))
    return str(tmp_path / "raw")


def counts(tables):
    return {name: df.count() for name, df in tables.items()}


def test_first_wins_load_and_a_second_run(spark, raw, out):
    tables = star_first_wins(spark, raw, f"{out}/star")
    assert counts(tables) == {"users": 4, "songs": 5, "artists": 2, "time": 4, "songplays": 6}
    assert tables["users"].filter("user_id = 1").first().level == "free"
    assert tables["songplays"].filter("song_id is not null").count() == 4
    tables = star_first_wins(spark, raw, f"{out}/star")
    assert counts(tables) == {"users": 4, "songs": 5, "artists": 2, "time": 4, "songplays": 12}
    assert op.pk_violations(tables["songplays"], ["songplay_id"]).count() == 0


def test_distinct_load_starts_over(spark, raw, out):
    for _ in range(2):
        tables = star_distinct(spark, raw, f"{out}/star")
        assert counts(tables) == {"users": 5, "songs": 5, "artists": 2, "time": 4, "songplays": 8}
    assert op.pk_violations(tables["users"], ["user_id"]).count() == 1
    assert [tuple(r) for r in op.top_artists(tables["songplays"], tables["artists"]).collect()] == [
        ("Ann", 6), ("Bob", 2),
    ]


def test_lake_load_refuses_to_run_twice(spark, raw, out):
    tables = star_lake(spark, raw, f"{out}/star")
    assert counts(tables) == {"users": 5, "songs": 5, "artists": 2, "time": 3, "songplays": 10}
    assert {(r.year, r.month) for r in tables["songplays"].collect()} == {(2018, 11)}
    with pytest.raises(FileExistsError, match="songplays"):
        star_lake(spark, raw, f"{out}/star")


def test_daily_load_adds_days_and_repeats_safely(spark, raw, out):
    tables = star_daily(spark, raw, f"{out}/star", "2018-11-02")
    assert counts(tables) == {"users": 4, "songs": 5, "artists": 2, "time": 6, "songplays": 6}
    for _ in range(2):
        tables = star_daily(spark, raw, f"{out}/star", "2018-11-03")
        assert counts(tables) == {"users": 1, "songs": 5, "artists": 2, "time": 7, "songplays": 7}
    again = star_daily(spark, raw, f"{out}/star", "2018-11-03", append_fact=True)
    assert op.pk_violations(again["songplays"], ["songplay_id"]).count() > 0


def test_daily_load_carries_users_forward(spark, raw, out):
    """After a whole load and a day, all users of the fact are known, and a lost one fails the next load."""
    whole = star_daily(spark, raw, f"{out}/star", carry_users=True)
    users = sorted(map(str, whole["users"].collect()))
    for _ in range(2):
        tables = star_daily(spark, raw, f"{out}/star", "2018-11-03", carry_users=True)
        assert sorted(map(str, tables["users"].collect())) == users and len(users) == 5
    assert op.fk_violations(tables["songplays"], tables["users"], "user_id").count() == 0
    star_daily(spark, raw, f"{out}/star", "2018-11-03")  # the day's users alone
    with pytest.raises(op.DataQualityError, match="songplays_user_id_in_users"):
        star_daily(spark, raw, f"{out}/star", "2018-11-03", carry_users=True)


def test_counts_by_day_give_the_reports_of_the_fact(spark, raw, out):
    """After any rerun of a day, reports from the stored counts equal a recount; only that day is read."""
    songs, sink = fixtures.songs(spark), f"{out}/sink"
    keys = ["artist_id", "song_id"]
    for day in ("2018-11-02", "2018-11-03"):
        run_for_date(spark, raw, day, songs, sink)
    refresh_counts(spark, sink, f"{out}/counts", keys)
    dims = star_distinct(spark, raw, f"{out}/star")
    wanted = [(dims["artists"].select("artist_id", "name"), "artist_id"), (dims["songs"].select("song_id", "title"), "song_id")]
    for rows in (fixtures.event_rows()[:1] * 3, [], fixtures.event_rows()):
        fixtures.write_lines(f"{raw}/log_data/2018/11/2018-11-02-events.json", rows)
        run_for_date(spark, raw, "2018-11-02", songs, sink)
        refresh_counts(spark, sink, f"{out}/counts", keys, "2018-11-02")
        recount = op.star_counts(spark.read.parquet(sink), wanted, ["name", "title"], "n", "songplay_id")
        kept = op.counts_by(spark.read.parquet(f"{out}/counts"), wanted, ["name", "title"], "n")
        assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, recount.collect()))


def test_daily_load_fails_on_an_empty_table(spark, raw, out):
    with pytest.raises(op.DataQualityError, match="songplays_has_rows"):
        star_daily(spark, raw, f"{out}/star", page="No such page")


def test_stream_takes_each_file_once(spark, raw, out):
    songs, sink, progress = fixtures.songs(spark), f"{out}/sink", f"{out}/progress"
    load = lambda batch: store_plays(batch, songs, sink)
    assert stream_events(spark, f"{raw}/log_data", progress, load, max_files=1) == 2
    stored = spark.read.parquet(sink)
    assert stored.count() == 5  # the copied play has the key of its original
    assert stream_events(spark, f"{raw}/log_data", progress, load) == 0
    rows = fixtures.event_rows()
    fixtures.write_lines(f"{raw}/log_data/2018/12/2018-12-01-events.json", [
        {**rows[1], "ts": rows[1]["ts"] + 86_400_000 * 29}, rows[2],
    ])
    assert stream_events(spark, f"{raw}/log_data", progress, load) == 1
    stored = spark.read.parquet(sink)
    assert stored.count() == 6 and stored.filter("month = 12").count() == 1


def test_a_batch_given_twice_changes_nothing(spark, out):
    events, songs, sink = fixtures.events(spark), fixtures.songs(spark), f"{out}/sink"
    for _ in range(2):
        store_plays(events, songs, sink)
        assert spark.read.parquet(sink).count() == 4


def test_a_second_run_in_another_zone_finds_what_is_stored(spark, raw, out):
    """Some plays fall on either side of New York's midnight."""
    songs, sink = fixtures.songs(spark), f"{out}/sink"
    rows = [
        ("NextSong", 1541121934796 + h * 3_600_000, str(h), "free", h, 0, "T1", "Ann", 100.9)
        for h in range(48)
    ]
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for name in ("America/New_York", "Asia/Tokyo", "UTC"):
            spark.conf.set("spark.sql.session.timeZone", name)
            store_plays(fixtures.events(spark, rows), songs, sink)
            tables = star_first_wins(spark, raw, f"{out}/star")
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert spark.read.parquet(sink).count() == 48
    assert tables["time"].count() == 4


def test_batches_are_counted_beyond_the_progress_that_is_kept(spark, out):
    kept = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        for k in range(5):
            fixtures.write_lines(f"{out}/log/{k}.json", fixtures.event_rows()[:1])
        assert stream_events(spark, f"{out}/log", f"{out}/progress", lambda batch: None, max_files=1) == 5
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", kept)


def test_plays_of_one_second_and_without_a_session_stay_apart(spark, out):
    row = ("NextSong", 1541121934796, "1", "free", None, 0, "T1", "Ann", 100.9)
    rows = [row, (*row[:6], "T2", "Bob", 1.0), (row[0], row[1] + 1, *row[2:])]
    rows += [(*row[:4], 10, *row[5:6], song, "Ann", 100.9) for song in ("T1", "T3")]
    for _ in range(2):
        store_plays(fixtures.events(spark, rows), fixtures.songs(spark), f"{out}/sink")
        assert spark.read.parquet(f"{out}/sink").count() == 5


def test_a_day_is_what_its_file_holds(spark, raw, out):
    """A play that begins after midnight stays with its file, in whole and in daily loads."""
    rows = fixtures.event_rows()
    late = {**rows[0], "ts": rows[0]["ts"] + 86_400_000, "sessionId": 77}
    fixtures.write_lines(f"{raw}/log_data/2018/11/2018-11-02-events.json", [*rows, late])
    star_daily(spark, raw, f"{out}/star")
    for day in ("2018-11-02", "2018-11-03", "2018-11-02"):
        tables = star_daily(spark, raw, f"{out}/star", day)
        plays = tables["songplays"]
        assert [str(r.event_date) for r in plays.filter("session_id = 77").collect()] == ["2018-11-02"]
        assert (plays.count(), tables["time"].count()) == (8, 8)


def test_loads_fail_on_a_play_without_a_time(spark, raw, out):
    rows = [{**fixtures.event_rows()[0], "ts": None}]
    fixtures.write_lines(f"{raw}/log_data/2018/11/2018-11-04-events.json", rows)
    with pytest.raises(op.DataQualityError, match="songplays_required"):
        star_distinct(spark, raw, f"{out}/star")


def test_run_for_date_replaces_its_day(spark, raw, out):
    songs, sink = fixtures.songs(spark), f"{out}/sink"
    for day in ("2018-11-02", "2018-11-03", "2018-11-02", "2018-11-02"):
        run_for_date(spark, raw, day, songs, sink)
    stored = spark.read.parquet(sink)
    assert {str(r.event_date): r["count"] for r in stored.groupBy("event_date").count().collect()} == {
        "2018-11-02": 6, "2018-11-03": 1,
    }


def test_a_day_run_again_without_plays_is_emptied(spark, raw, out):
    songs, sink = fixtures.songs(spark), f"{out}/sink"
    for day in ("2018-11-02", "2018-11-03"):
        run_for_date(spark, raw, day, songs, sink)
    quiet = [{**fixtures.event_rows()[4], "userId": ""}]
    fixtures.write_lines(f"{raw}/log_data/2018/11/2018-11-02-events.json", quiet)
    run_for_date(spark, raw, "2018-11-02", songs, sink)
    left = spark.read.parquet(sink)
    assert [str(r.event_date) for r in left.collect()] == ["2018-11-03"]


def test_scratch_paths_lie_in_the_named_folder(spark):
    root = session.scratch_root(spark)
    first, second = session.scratch_path(spark, "x"), session.scratch_path(spark, "x")
    assert first != second and first.startswith(root)
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert named is None or root == named


def test_scratch_is_removed_on_request(spark):
    path = session.scratch_path(spark, "x")
    spark.range(3).write.parquet(path)
    assert spark.read.parquet(path).count() == 3
    session.clear_scratch(spark)
    session.clear_scratch(spark)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)


def test_task_sizes_follow_the_input_and_the_cluster():
    tb = 1 << 40
    small, large = session.sizing(10 << 30, 64), session.sizing(100 * tb, 4000)
    assert small["spark.sql.shuffle.partitions"] == "128"
    assert small["spark.sql.files.maxPartitionBytes"] == str(128 << 20)
    assert large["spark.sql.shuffle.partitions"] == str(100 * tb // (256 << 20))
    assert 128 << 20 < int(large["spark.sql.files.maxPartitionBytes"]) <= 1 << 30
