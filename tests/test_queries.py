"""Every registered query against its SQL, and the shape of the plans."""

import os
import re

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry  # noqa: F401  (it must import)
from loomstar import operators as op
from loomstar.operators import lookup_join, measured_bytes
from loomstar.plans.oracles import ORACLES
from loomstar.plans.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for file in os.listdir(SF_DIR):
        con.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{SF_DIR}/{file}'")
    return con


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    cursor = duck.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    places = [names.index(c) for c in columns]
    order = lambda row: tuple((v is None, str(v)) for v in row)
    expected = sorted((tuple(row[i] for i in places) for row in cursor.fetchall()), key=order)
    got = sorted((tuple(row[c] for c in columns) for row in df.collect()), key=order)
    assert got == expected


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


LAZY = [
    "plays_filter", "users_dim_distinct", "users_dim_first", "users_dim_last", "songs_dim",
    "time_dim_fullname", "catalogue_join", "fact_left_one", "fact_left_one_split",
    "fact_inner_distinct", "fact_inner", "fact_left_fanout", "fact_left_truncated", "fact_md5_key",
    "top_artists_all", "plays_by_weekday_hour", "top_users", "top_artists", "top_songs",
    "song_data_by_session", "user_data_by_song", "quality_report", "fk_violations",
]


@pytest.mark.parametrize("name", LAZY)
def test_plans_hold_no_python_no_cross_join_no_global_window(spark, name):
    plan = executed(QUERIES[name](spark, SF_DIR))
    for node in ("EvalPython", "InPandas", "CartesianProduct", "BroadcastNestedLoopJoin", "Window ["):
        assert node not in plan


def test_play_filter_and_columns_reach_the_scan(spark):
    plan = executed(QUERIES["top_artists"](spark, SF_DIR))
    scan = next(line for line in plan.splitlines() if "lineitem.parquet" in line)
    assert "EqualTo(l_returnflag,R)" in scan
    assert "l_extendedprice" not in scan and "l_tax" not in scan


def test_reports_count_before_they_join(spark):
    """Below the dimension joins there is already one row per key."""
    plan = executed(QUERIES["top_users"](spark, SF_DIR))
    above = plan[: plan.index("partial_count(songplay_id")]
    assert re.search(r"Join \[user_id", above)


def test_one_row_per_key_combines_before_the_shuffle(spark):
    plan = executed(QUERIES["users_dim_first"](spark, SF_DIR))
    assert plan.index("Exchange hashpartitioning(user_id") < plan.index("partial_min(struct(")


def test_lookup_broadcasts_only_what_it_measured(spark):
    small = executed(QUERIES["fact_left_one"](spark, SF_DIR))
    assert "LeftOuter, BuildRight" in small and "Exchange hashpartitioning(song" not in small.split("LeftOuter")[0]
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = executed(QUERIES["fact_left_one_split"](spark, SF_DIR))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "SortMergeJoin [coalesce(song" in large and large.count("parquet") == small.count("parquet")


def test_measured_bytes_follow_the_data(spark):
    narrow = spark.range(1000).selectExpr("id", "'ab' as s")
    wide = spark.range(1000).selectExpr("id", "repeat('ab', 500) as s")
    assert measured_bytes(spark.range(0)) == 0
    assert 1000 * 10 < measured_bytes(narrow) < 200_000 < 1000 * 1000 < measured_bytes(wide)


def test_hot_keys_of_any_number_are_split(spark):
    """More than a thousand hot keys: every partition that holds one may be split."""
    conf = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "0.1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        facts = spark.range(200_000, numPartitions=8).selectExpr("cast(id % 2000 as string) as k", "id as n")
        known = spark.range(2_000).selectExpr("cast(id as string) as k", "id as v").groupBy("k").agg(F.min("v").alias("v"))
        joined = lookup_join(facts, known, ["k"], broadcast_bytes=0)
        assert joined.agg(F.count("v"), F.sum(F.col("k").cast("bigint") - F.col("v"))).first() == (200_000, 0)
        joined.collect()
        assert "skew=true" in executed(joined)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_null_keys_match_nothing_by_either_route(spark):
    facts = spark.createDataFrame([(None, 1), ("a", 2), ("b", 3)], "k string, n int")
    known = spark.createDataFrame([(None, 7), ("a", 8)], "k string, v int")
    for size in (0, 1 << 20):
        rows = lookup_join(facts, known, ["k"], broadcast_bytes=size).collect()
        assert sorted((r.n, r.v) for r in rows) == sorted([(1, None), (2, 8), (3, None)], key=lambda x: x[0])


def test_reruns_leave_other_days_alone(spark, out):
    """Days run again give what they gave, and a run of one day leaves every other day's rows as they are."""
    from loomstar.plans.queries import RUN_DATE, _reruns
    from loomstar.plans.roles import PURCHASE, export_daily, song_records
    from loomstar.sinks import overwrite_partitions
    from loomstar.streaming import run_for_date

    whole = _reruns(spark, SF_DIR)
    prints = lambda df: {str(r.event_date): (r.n_rows, r.digest) for r in op.fingerprints(df, ["event_date"]).collect()}
    before = prints(whole)
    assert len(before) > 3
    overwrite_partitions(whole, f"{out}/sink", ["event_date"])
    less = song_records(spark, SF_DIR).limit(0)  # the day's plays will differ: no song is known any more
    run_for_date(spark, export_daily(spark, SF_DIR), RUN_DATE, less, f"{out}/sink", PURCHASE, layout="partition")
    after = prints(spark.read.parquet(f"{out}/sink").select(whole.columns))
    assert {day for day in before if before[day] != after[day]} <= {RUN_DATE} and before.keys() == after.keys()


def test_stored_buckets_join_without_an_exchange(spark):
    joined = QUERIES["fact_inner_bucketed"](spark, SF_DIR)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "SortMergeJoin" in plan and joined.count() > 0
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("buckets_")]
