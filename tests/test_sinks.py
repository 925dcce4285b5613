"""Write modes and table lifecycle."""

import re

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from loomstar import sinks, sources
from loomstar.schemas import SONGS, STAR

KV = "k int, v string, at int"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def kv(spark, *values):
    return spark.createDataFrame(values, KV)


def test_default_mode_refuses_an_existing_table(spark, out):
    sinks.write_table(kv(spark, (1, "a", 0)), f"{out}/t")
    with pytest.raises(AnalysisException):
        sinks.write_table(kv(spark, (1, "a", 0)), f"{out}/t")


def test_append_overwrite_and_the_switch(spark, out):
    path, one = f"{out}/t", kv(spark, (1, "a", 0))
    sinks.append(one, path)
    sinks.append(one, path)
    assert spark.read.parquet(path).count() == 2
    sinks.overwrite(one, path)
    assert spark.read.parquet(path).count() == 1
    sinks.load_dimension(one, path, truncate=False)
    assert spark.read.parquet(path).count() == 2
    sinks.load_dimension(one, path)
    assert spark.read.parquet(path).count() == 1


def test_insert_if_absent_first_write_wins(spark, out):
    path = f"{out}/t"
    for _ in range(2):
        sinks.insert_if_absent(kv(spark, (1, "b", 2), (1, "a", 1), (None, "n", 0)), path, ["k"], ["at"])
        sinks.insert_if_absent(kv(spark, (1, "c", 0), (2, "d", 0)), path, ["k"], ["at"])
    assert rows(spark.read.parquet(path)) == [(1, "a", 1), (2, "d", 0), (None, "n", 0)]


def test_insert_if_absent_opens_only_the_partitions_it_needs(spark, out):
    """A stray old row opens its own partition, not all of them since."""
    path = f"{out}/t"
    first = kv(spark, *[(k, "a", k) for k in range(10)])
    sinks.insert_if_absent(first, path, ["k"], [], ["at"], ["at"])
    again = kv(spark, (9, "z", 9), (1, "z", 1), (99, "n", 9))
    stored = sinks.tables.touching(spark.read.parquet(path), again, ["at"])
    assert sorted(r.at for r in stored.select("at").distinct().collect()) == [1, 9]
    plan = stored._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "at#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    sinks.insert_if_absent(again, path, ["k"], [], ["at"], ["at"])
    assert spark.read.parquet(path).count() == 11


def test_whole_keys_join_on_the_partitioning_they_have(spark, out):
    """One exchange on each side: rows already parted by key do not shuffle again."""
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fresh = kv(spark, *[(k, "a", k) for k in range(5)]).groupBy("k").agg(F.min("v").alias("v"))
        plan = sinks.tables.absent(fresh, kv(spark, (1, "b", 1)), ["k"])._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning(k#") <= 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_more_combinations_than_a_filter_holds(spark, monkeypatch):
    monkeypatch.setattr(sinks.tables, "MAX_TOUCHED", 2)
    table = kv(spark, *[(k, "a", k) for k in range(9)], (10, "a", None))
    found = sinks.tables.touching(table, kv(spark, (0, "", 1), (0, "", 4), (0, "", 6), (0, "", None)), ["at"])
    assert sorted(str(r.at) for r in found.collect()) == ["1", "4", "6", "None"]


def test_upsert_last_write_wins(spark, out):
    path = f"{out}/t"
    read = lambda: rows(spark.read.parquet(path).select("k", "v", "at"))
    sinks.upsert(kv(spark, (1, "a", 9), (1, "b", 1), (2, "c", 0)), path, ["k"], ["at"], buckets=4)
    assert read() == [(1, "a", 9), (2, "c", 0)]
    sinks.upsert(kv(spark, (1, "z", 0), (3, "n", 0)), path, ["k"], ["at"])
    assert read() == [(1, "z", 0), (2, "c", 0), (3, "n", 0)]


def test_upsert_of_one_key_rewrites_one_bucket_and_fails_safely(spark, out):
    path = f"{out}/t"
    sinks.upsert(kv(spark, *[(k, "a", 0) for k in range(100)]), path, ["k"], buckets=8)
    files = lambda: {r[0] for r in spark.read.parquet(path).select(F.input_file_name()).distinct().collect()}
    before = files()
    sinks.upsert(kv(spark, (5, "z", 1)), path, ["k"])
    assert len(before - files()) == 1 and len(files()) == len(before)
    state, stored = files(), rows(spark.read.parquet(path).select("k", "v", "at"))
    bad = kv(spark, (6, "x", 1)).withColumn("v", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        sinks.upsert(bad, path, ["k"])
    assert files() == state and rows(spark.read.parquet(path).select("k", "v", "at")) == stored


def test_upsert_touches_only_its_partitions(spark, out):
    path, key = f"{out}/t", ["at", "k"]
    sinks.upsert(kv(spark, (1, "a", 1), (2, "b", 2), (3, "c", None)), path, key, [], ["at"])
    files = lambda: spark.read.parquet(path).filter("at = 2").select(F.input_file_name()).first()[0]
    untouched = files()
    sinks.upsert(kv(spark, (1, "z", 1), (9, "n", None)), path, key, [], ["at"])
    table = spark.read.parquet(path)
    assert rows(table.select("k", "v", "at")) == [
        (1, "z", 1), (2, "b", 2), (3, "c", None), (9, "n", None),
    ]
    assert untouched == files()


def test_overwrite_partitions_is_repeatable(spark, out):
    path = f"{out}/t"
    sinks.overwrite_partitions(kv(spark, (1, "a", 1), (2, "b", 2)), path, ["at"])
    for _ in range(2):
        sinks.overwrite_partitions(kv(spark, (5, "x", 2)), path, ["at"])
    assert rows(spark.read.parquet(path).select("k", "v", "at")) == [(1, "a", 1), (5, "x", 2)]


def test_inserts_by_name_and_by_position(spark):
    df = spark.createDataFrame([(2.5, "t", "s1")], "duration double, title string, song_id string")
    generated = {"artist_id": F.lit("A"), "year": F.lit(0)}
    named = sinks.insert_by_name(df, SONGS, generated)
    assert [tuple(r) for r in named.collect()] == [("s1", "t", "A", 0, 2.5)]
    with pytest.raises(ValueError):
        sinks.insert_by_position(df, SONGS)
    placed = sinks.insert_by_position(df.select("song_id", "title", F.lit("A"), F.lit("7"), "duration"), SONGS)
    assert [tuple(r) for r in placed.collect()] == [("s1", "t", "A", 7, 2.5)]
    assert placed.dtypes == [(f.name, f.dataType.simpleString()) for f in SONGS.fields]


def test_reset_leaves_empty_typed_tables(spark, out):
    sinks.append(kv(spark, (1, "a", 0)), f"{out}/users")
    sinks.reset_tables(spark, out, STAR)
    for name, schema in STAR.items():
        table = spark.read.parquet(f"{out}/{name}")
        assert table.count() == 0 and table.schema == schema


def test_partition_columns_come_back_in_place(spark, out):
    songs = spark.createDataFrame([("s1", "t", "A1", 2000, 1.5), ("s2", "u", "A2", 0, 2.5)], SONGS)
    sinks.write_table(songs, f"{out}/t", partition_by=["year", "artist_id"])
    assert spark.read.parquet(f"{out}/t").columns[-2:] == ["year", "artist_id"]
    back = sources.read_table(spark, f"{out}/t", SONGS)
    assert back.schema == SONGS and rows(back) == rows(songs)


def test_layout_splits_a_hot_value_and_sorts_each_task(spark, out):
    """A third of the rows share one value, yet no task gets them all."""
    size = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    try:
        # An id per row, so that nothing but the hot value itself is repeated.
        df = spark.range(0, 300_000, 1, 8).selectExpr(
            "case when id % 3 = 0 then 0 else id end as k", "uuid() as v", "id"
        )
        sinks.write_table(df, f"{out}/t", dist=["k"], sort=["k", "id"])
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", size)
    back = spark.read.parquet(f"{out}/t")
    assert back.count() == 300_000 and back.select("id").distinct().count() == 300_000
    per_file = back.filter("k = 0").groupBy(F.input_file_name()).count().collect()
    assert len(per_file) > 1 and max(r["count"] for r in per_file) < 90_000


def test_bucketed_tables_join_without_a_shuffle(spark):
    left = spark.range(1000).selectExpr("id as k", "id * 2 as a")
    right = spark.range(1000).selectExpr("id as k", "id * 3 as b")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sinks.save_bucketed(left, "bucket_left", 4, ["k"], ["k"], "overwrite")
        sinks.save_bucketed(right, "bucket_right", 4, ["k"], ["k"], "overwrite")
        joined = spark.table("bucket_left").join(spark.table("bucket_right"), "k")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and joined.count() == 1000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        for name in ("bucket_left", "bucket_right"):
            spark.sql(f"drop table if exists {name}")
