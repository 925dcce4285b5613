"""Upsert tables kept as versions."""

import random

import pytest
from pyspark.sql import functions as F

from loomstar import sinks
from loomstar.sinks.versions import bytes_of, versions

KV = "k int, v string, at int"


def kv(spark, *rows):
    return spark.createDataFrame(list(rows), KV)


def read(spark, path, keys=("k",)):
    return sinks.read_versions(spark, path, list(keys), kv(spark).schema)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("compact_at", [0.0, 0.5, 100.0])
def test_any_order_of_upserts_equals_a_dictionary(spark, out, compact_at):
    """Whatever is compacted on the way; null keys are one key."""
    pick, want = random.Random(5), {}
    for n in range(6):
        new = [(pick.choice([None, *range(12)]), f"{n}-{j}", j) for j in range(pick.randint(0, 9))]
        sinks.upsert_versions(kv(spark, *new), f"{out}/t", ["k"], ["at"], compact_at=compact_at)
        want |= {k: (k, v, at) for k, v, at in new}
        assert rows(read(spark, f"{out}/t")) == sorted(want.values(), key=str)
    sinks.compact(spark, f"{out}/t", ["k"], kv(spark).schema)
    assert rows(read(spark, f"{out}/t")) == sorted(want.values(), key=str)
    assert versions(spark, f"{out}/t")[-1].base


def test_no_table_and_empty_upserts(spark, out):
    assert rows(read(spark, f"{out}/none")) == []
    for _ in range(2):
        sinks.upsert_versions(kv(spark), f"{out}/t", ["k"])
    assert rows(read(spark, f"{out}/t")) == []


def test_an_upsert_writes_what_comes_in(spark, out):
    """1,000 random keys into a table 100 times larger write less than a tenth of it."""
    path, n = f"{out}/t", 100_000
    wide = lambda ids: ids.select(F.col("id").cast("int").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"), F.lit(0).alias("at"))
    sinks.upsert_versions(wide(spark.range(n)), path, ["k"])
    before = bytes_of(spark, path)
    keys = random.Random(1).sample(range(n), 1_000)
    new = kv(spark, *[(k, "new", 1) for k in keys])
    sinks.upsert_versions(new, path, ["k"])
    assert bytes_of(spark, path) - before < before / 10
    found = read(spark, path)
    assert found.count() == n and found.filter("v = 'new'").count() == 1_000


def test_rows_are_rewritten_a_bounded_number_of_times(spark, out):
    path, written = f"{out}/t", 0
    for n in range(12):
        known = {v.path for v in versions(spark, path)}
        sinks.upsert_versions(kv(spark, *[(n * 100 + j, "x" * 50 + str(j), n) for j in range(100)]), path, ["k"])
        written += sum(v.base for v in versions(spark, path) if v.path not in known)
    assert read(spark, path).count() == 1_200 and written <= 5


def test_a_failed_upsert_leaves_no_trace_and_readers_see_whole_versions(spark, out):
    path = f"{out}/t"
    sinks.upsert_versions(kv(spark, (1, "a", 0), (2, "b", 0)), path, ["k"])
    begun = read(spark, path)
    bad = kv(spark, (1, "x", 1)).withColumn("v", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        sinks.upsert_versions(bad, path, ["k"])
    assert rows(read(spark, path)) == [(1, "a", 0), (2, "b", 0)]
    sinks.upsert_versions(kv(spark, (1, "z", 1)), path, ["k"])
    sinks.compact(spark, path, ["k"], kv(spark).schema)
    assert rows(begun) == [(1, "a", 0), (2, "b", 0)]  # a read that began before still ends
    assert rows(read(spark, path)) == [(1, "z", 1), (2, "b", 0)]


def test_filters_on_keys_reach_all_scans(spark, out):
    path = f"{out}/t"
    for rows_ in ([(k, "a", 0) for k in range(50)], [(3, "b", 1)]):
        sinks.upsert_versions(kv(spark, *rows_), path, ["k"], sort=["k"])
    found = read(spark, path).filter("k = 3")
    assert rows(found) == [(3, "b", 1)]
    assert found._jdf.queryExecution().executedPlan().toString().count("EqualTo(k,3)") >= 2


def test_chosen_rows_are_not_chosen_from_once_more(spark, out, monkeypatch):
    first, later = ((1, "a", 0), (2, "b", 0), (None, "n", 0)), ((2, "z", 1), (3, "c", 1), (None, "m", 1))
    calls = []
    with monkeypatch.context() as patched:
        patched.setattr("loomstar.sinks.versions.pick_per_key", lambda *args: calls.append(args))
        for new in (first, later):
            sinks.upsert_versions(kv(spark, *new), f"{out}/t", ["k"], chosen=True)
    assert not calls
    for new in (first, later):
        sinks.upsert_versions(kv(spark, *new), f"{out}/u", ["k"])
    assert rows(read(spark, f"{out}/t")) == rows(read(spark, f"{out}/u"))
