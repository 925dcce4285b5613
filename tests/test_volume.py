"""What loads write and move, and the forms of raw files that keep it small."""

import glob
import gzip
import os
import re

from pyspark.sql import functions as F

import fixtures
from loomstar import operators as op
from loomstar import sinks, sources
from loomstar.plans import roles
from loomstar.schemas import EVENT, EVENT_CSV
from loomstar.streaming import stream_events

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_compressed_json_is_read_like_plain_json(spark, tmp_path):
    raw = str(tmp_path / "raw")
    fixtures.events(spark).write.option("compression", "gzip").json(f"{raw}/log_data/2018/11")
    rows = fixtures.events(spark).count()
    assert sources.read_events(spark, raw).count() == rows
    assert sources.read_json_tree(spark, raw, EVENT).count() == rows
    seen = []
    stream_events(spark, f"{raw}/log_data", str(tmp_path / "progress"), lambda batch: seen.append(batch.count()))
    assert sum(seen) == rows


def test_raw_exports_are_compressed_and_hold_every_line(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(roles, "scratch_path", lambda spark, name: f"{tmp_path}/{name}")
    root = roles.export_monthly(spark, SF_DIR)
    files = glob.glob(f"{root}/log_data/*/*/part-*")
    assert files and all(f.endswith(".json.gz") for f in files)
    assert sources.read_events(spark, root).count() == spark.read.parquet(f"{SF_DIR}/lineitem.parquet").count()
    plain = sum(len(gzip.open(f).read()) for f in files)
    assert sum(map(os.path.getsize, files)) < plain / 4


def test_lines_do_not_move_once_more_for_a_choice_per_session(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        log = roles.event_log(spark, SF_DIR, names=True)
        moves = lambda df: plan(df).count("Exchange hashpartitioning")
        assert moves(op.pick_per_key(log, ["sessionId", "itemInSession"], ["ts"])) == moves(log)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_lines_move_to_their_order_as_the_values_of_an_event(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        found = plan(roles.event_log(spark, SF_DIR, names=True).drop("userAgent")).split("Exchange hashpartitioning(l_orderkey", 1)[1]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    moved = found.split("\n")[1]
    names = set(re.findall(r"(?:\[|, |AS )(\w+)#\d+L?(?=[,\]])", moved))
    assert names == {"l_orderkey", "l_linenumber", "l_linestatus", "l_returnflag", "at", "p_brand", "length", "title"}


def csv_log(spark, tmp_path, compression="none"):
    log = fixtures.events(spark).select(*EVENT_CSV.fieldNames()).withColumn("song", F.lit('two\n"lines"'))
    sinks.write_csv(log.repartition(3), str(tmp_path / compression), compression=compression)
    return str(tmp_path / compression)


def test_text_of_csv_records_stays_in_its_tasks(spark, tmp_path):
    records = sources.csv_records(spark, csv_log(spark, tmp_path))
    assert "MapInArrow" in plan(records)
    assert "starts" not in plan(records)  # no window over all lines


def test_compressed_csv_gives_the_same_records(spark, tmp_path):
    read = lambda kind: sources.read_events_csv(spark, csv_log(spark, tmp_path, kind), multi_line=True).collect()
    plain, packed = read("none"), read("gzip")
    assert sorted(map(str, plain)) == sorted(map(str, packed))
    assert len(packed) == fixtures.events(spark).count() and {r.song for r in packed} == {'two\n"lines"'}


def test_the_arrival_number_orders_as_arrival_does(spark, tmp_path):
    log = sources.read_events_csv(spark, csv_log(spark, tmp_path), multi_line=True, arrival=True)
    staged = str(tmp_path / "staged")
    log.withColumn("at", F.struct(*sources.ARRIVAL)).write.parquet(staged)
    numbered = sources.with_arrival_number(spark.read.parquet(staged))
    rows = numbered.select("at", "arrival").collect()
    assert len({r.arrival for r in rows}) == len(rows) == fixtures.events(spark).count()
    assert [r.at for r in sorted(rows, key=lambda r: r.arrival)] == sorted(r.at for r in rows)


def test_places_of_blocks_may_be_stored(spark, tmp_path):
    log = sources.read_events_csv(spark, csv_log(spark, tmp_path), multi_line=True, arrival=True)
    log.write.parquet(str(tmp_path / "staged"))
    staged = spark.read.parquet(str(tmp_path / "staged"))
    numbers = lambda *places: sorted(map(str, sources.with_arrival_number(staged, *places).collect()))
    stored = sinks.once(sources.arrival_places(staged))
    assert numbers(stored) == numbers()
    assert "Window" not in plan(sources.with_arrival_number(staged, stored))


def test_derived_columns_are_written_and_not_needed_to_insert(spark, out):
    rows = spark.createDataFrame([(1, 10, "a"), (2, 11, "b")], "k int, part int, v string")
    more = spark.createDataFrame([(2, 11, "z"), (3, 10, "c"), (None, 12, "n")], "k int, part int, v string")
    for df in (rows, more, more):
        sinks.insert_if_absent(df, f"{out}/t", ["k"], ["v"], ["part"], ["part"], {"name": F.concat("v", F.lit("!"))})
    table = spark.read.parquet(f"{out}/t")
    assert table.columns[0] == "name"
    assert sorted(map(str, table.select("k", "part", "v", "name").collect())) == sorted(
        f"Row(k={k}, part={p}, v='{v}', name='{v}!')" for k, p, v in [(1, 10, "a"), (2, 11, "b"), (3, 10, "c"), (None, 12, "n")]
    )


def test_a_catalogue_over_the_limit_is_not_sent_through_the_driver(spark):
    songs = spark.range(5_000).select(F.col("id").alias("k"), F.lit("same").alias("v"))
    plays = spark.range(9).withColumnRenamed("id", "k")
    assert "BroadcastHashJoin" in plan(plays.join(op.sized(songs), "k", "left"))
    assert "Broadcast" not in plan(plays.join(op.sized(songs, 1_000), "k", "left"))
    assert plays.join(op.sized(songs, 1_000), "k", "left").filter("v is null").count() == 0
