"""One table clustered by several columns."""

import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from loomstar import sinks
from loomstar.sinks import clustering


def plays(spark, n):
    """Rows with a hot user that a third of them share, and some nulls."""
    user = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, None).otherwise((F.col("id") * 7919) % 5_000)
    return spark.range(n).select(
        "id", (F.col("id") % 3_001).alias("session"), user.cast("long").alias("user"),
        F.concat(F.lit("song "), (F.col("id") * 31) % 2_003).alias("song"),
    )


def row_groups(path, columns):
    """Of each row group the ranges of the columns' hashes."""
    for file in glob.glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(file).metadata
        place = {meta.schema.column(k).name: k for k in range(meta.num_columns)}
        for g in range(meta.num_row_groups):
            stats = {c: meta.row_group(g).column(place[f"hash_of_{c}"]).statistics for c in columns}
            yield {c: (s.min, s.max) for c, s in stats.items()}


LOOKUPS = [{"session": 17}, {"user": 41, "session": 99}, {"song": "song 12"}, {"user": 7}, {"user": None}, {"session": -1}]


@pytest.fixture
def whole_plans(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    yield
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_lookups_by_any_column_read_a_small_share(spark, out, whole_plans):
    df, columns = plays(spark, 60_000), ["session", "user", "song"]
    sinks.write_clustered(df.repartition(8), f"{out}/t", columns, row_group_bytes=16_000)
    table, groups = spark.read.parquet(f"{out}/t"), list(row_groups(f"{out}/t", columns))
    assert len(groups) > 60
    for values in LOOKUPS:
        found = sinks.where_equal(table, values)
        assert found.columns == df.columns
        wanted = df
        for c, v in values.items():
            wanted = wanted.where(F.col(c).isNull() if v is None else F.col(c) == v)
        assert sorted(map(str, found.collect())) == sorted(map(str, wanted.collect()))
        kinds = dict(table.dtypes)
        own = {c: spark.range(1).select(clustering._hash(F.lit(v).cast(kinds[c]))).first()[0] for c, v in values.items()}
        read = sum(all(g[c][0] <= h <= g[c][1] for c, h in own.items()) for g in groups)
        if values != {"user": 7}:  # a third of all rows
            assert read <= len(groups) / (3 if len(values) == 1 else 6), (values, read, len(groups))
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert all(f"EqualTo(hash_of_{c},{h})" in plan for c, h in own.items())


def test_too_many_columns_are_refused(spark):
    with pytest.raises(ValueError):
        clustering.interleaved(list("abcdef"))
