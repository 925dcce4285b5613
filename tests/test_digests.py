"""Insertions that read only the files that may hold a key."""

import random

import pytest
from pyspark.sql import functions as F

from loomstar import sinks
from loomstar.sinks import digests

KV = "k int, v string, day string"


def kv(spark, *rows):
    return spark.createDataFrame(list(rows), KV).coalesce(1)


def rows(df):
    return sorted((tuple(r) for r in df.select("k", "v", "day").collect()), key=str)


@pytest.mark.parametrize("bits", [48, 3])
@pytest.mark.parametrize("by", [[], ["day"]])
def test_insertions_equal_a_dictionary(spark, out, monkeypatch, bits, by):
    """Null keys are one key; hashes that collide are decided by the key itself."""
    monkeypatch.setattr(digests, "BITS", bits)
    pick, want = random.Random(bits), {}
    for n in range(5):
        new = [(pick.choice([None, *range(30)]), f"{n}-{j}", pick.choice(["a b", "c%2Bd+", "é"])) for j in range(8)]
        sinks.insert_if_absent_by_digest(kv(spark, *new), f"{out}/t", ["k"], ["v"], by)
        for k, v, day in sorted(new, key=lambda r: r[1]):
            want.setdefault(k, (k, v, day))
        assert rows(spark.read.schema(KV).parquet(f"{out}/t")) == sorted(want.values(), key=str)


def test_only_files_that_may_hold_a_key_are_read(spark, out):
    path, schema = f"{out}/t", kv(spark).schema
    for n in range(6):
        sinks.insert_if_absent_by_digest(kv(spark, *[(100 * n + j, "x", "d") for j in range(50)]), path, ["k"])
    files = spark.read.parquet(path).inputFiles()
    assert len(files) == 6
    held = {f: spark.read.parquet(f).agg(F.min("k")).first()[0] // 100 for f in files}
    new = kv(spark, (205, "y", "d"), (249, "y", "d"), (999, "y", "d"))
    assert [held[f] for f in sinks.files_with(new, path, schema, ["k"])] == [2]
    assert sinks.files_with(kv(spark, (999, "y", "d")), path, schema, ["k"]) == []
    sinks.insert_if_absent_by_digest(new, path, ["k"])
    assert spark.read.parquet(path).count() == 301


def test_files_that_came_another_way_and_files_that_are_gone(spark, out):
    path, schema = f"{out}/t", kv(spark).schema
    sinks.append(kv(spark, (1, "a", "d")), path)  # without a digest
    sinks.insert_if_absent_by_digest(kv(spark, (1, "b", "d"), (2, "b", "d")), path, ["k"])
    sinks.append(kv(spark, (3, "c", "d")), path)
    sinks.insert_if_absent_by_digest(kv(spark, (3, "e", "d"), (2, "e", "d")), path, ["k"])
    assert rows(spark.read.parquet(path)) == [(1, "a", "d"), (2, "b", "d"), (3, "c", "d")]
    (gone,) = sinks.files_with(kv(spark, (2, "", "")), path, schema, ["k"])
    folder = spark._jvm.org.apache.hadoop.fs.Path(gone)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, False)
    sinks.insert_if_absent_by_digest(kv(spark, (2, "f", "d")), path, ["k"])
    assert rows(spark.read.parquet(path)) == [(1, "a", "d"), (2, "f", "d"), (3, "c", "d")]
