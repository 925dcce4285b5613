"""Table writes: plain, partitioned, insert-if-absent, upsert, reset.

Tables are parquet directories.  One writer per table at a time is assumed.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from loomstar.operators.dedup import pick_per_key
from loomstar.operators.skew import BROADCAST_BYTES, equal_nulls, measured_bytes, prefixed
from loomstar.session import scratch_path


#: Combinations of values that become a filter of the stored partitions.
MAX_TOUCHED = 1_000
#: Partitions of a new upsert table without partition columns; pass more for a large one.
BUCKETS = 64
#: Records of one compressed text file, some 300 MB of text.
FILE_RECORDS = 1_000_000
#: Of gzip: a third of the default level's time, files a tenth larger.
GZIP_LEVEL = "FOUR"
_BUCKET = "bucket_of_"


def layout(df: DataFrame, dist: Sequence[str] = (), sort: Sequence[str] = ()) -> DataFrame:
    """Rows grouped by `dist` and sorted by `sort` inside each output task.

    Grouping is a rebalance rather than a repartition: AQE splits the task of
    a hot value and merges small ones, so files come out evenly sized.  The
    sort gives row groups narrow value ranges, which lets a lookup skip most
    of them.
    """
    if dist:
        df = df.hint("rebalance", *dist)
    return df.sortWithinPartitions(*sort) if sort else df


def packing(many: Sequence[str] = ()) -> dict[str, str]:
    """Parquet options for rows that are many: zstd, and no dictionary for columns of `many` values.

    A dictionary that nearly every row adds to is given up only when it has grown large.
    """
    return {"compression": "zstd"} | {f"parquet.enable.dictionary#{c}": "false" for c in many}


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "errorifexists",
    partition_by: Sequence[str] = (),
    dist: Sequence[str] = (),
    sort: Sequence[str] = (),
    options: Mapping[str, str] | None = None,
) -> None:
    """Write parquet, by default refusing to touch an existing table.

    Rows of one partition, or of one `dist` value, are brought together first,
    so that the write makes a few full files and not one sliver per task.
    `options` are those of the files, such as `packing`.
    """
    # The writer needs rows ordered by partition; sorting by it first spares a second sort.
    order = [*partition_by, *sort] if sort else []
    writer = layout(df, [*partition_by, *dist], order).write.mode(mode).options(**(options or {}))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def save_bucketed(
    df: DataFrame,
    table: str,
    buckets: int,
    by: Sequence[str],
    sort: Sequence[str] = (),
    mode: str = "errorifexists",
    path: str | None = None,
) -> None:
    """Save a catalog table hashed into buckets, so joins on `by` need no shuffle.

    A join reads each bucket in one task.  Where one value of `by` holds a
    large share of the rows use `layout`, whose reads and joins can be split.
    Its files lie at `path`, or in the warehouse, which a cluster must share.
    """
    writer = layout(df, by).write.mode(mode).format("parquet").bucketBy(buckets, *by)
    writer = writer.option("path", path) if path else writer
    (writer.sortBy(*sort) if sort else writer).saveAsTable(table)


def in_buckets(df: DataFrame, buckets: int, by: Sequence[str], sort: Sequence[str] = ()) -> DataFrame:
    """`df` from a scratch table in hash buckets: joins of two such frames on all of `by` need no shuffle.

    Worth its one shuffle where a frame is joined on the same keys again and again.  The
    table leaves the catalog at once; its files stay until `clear_scratch`.
    """
    spark, name = df.sparkSession, f"buckets_{uuid.uuid4().hex}"
    save_bucketed(df, name, buckets, by, sort, path=scratch_path(spark, "buckets"))
    stored = spark.table(name)
    stored.schema  # resolved before the name goes
    spark.sql(f"DROP TABLE {name}")
    return stored


def write_csv(
    df: DataFrame, path: str, quote_all: bool = True, mode: str = "errorifexists", compression: str = "none"
) -> None:
    """CSV with a header in every file, quotes inside a field doubled.

    A compressed file is read whole, by one task, so it holds FILE_RECORDS at most.
    """
    (
        df.write.mode(mode)
        .option("compression", compression)
        .option("zlib.compress.level", GZIP_LEVEL)
        .option("maxRecordsPerFile", 0 if compression == "none" else FILE_RECORDS)
        .option("header", True)
        .option("quoteAll", quote_all)
        .option("quote", '"')
        .option("escape", '"')
        .option("emptyValue", "")
        .csv(path)
    )


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Add rows.  Not safe to repeat; see `insert_if_absent` and `overwrite_partitions`."""
    write_table(df, path, "append", partition_by)


def overwrite(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Empty the table and insert."""
    write_table(df, path, "overwrite", partition_by)


def overwrite_partitions(
    df: DataFrame, path: str, partition_by: Sequence[str], sort: Sequence[str] = ()
) -> None:
    """Replace just the partitions that occur in `df`; the others stay.

    Repeating the write gives the same table, and no stored row is read.
    """
    order = [*partition_by, *sort] if sort else []
    writer = layout(df, partition_by, order).write.mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)


def partition_path(path: str, column: str, value: object) -> str:
    """Where one partition of the table at `path` lies.

    Writing there as a table of its own shuffles nothing and, unlike a
    partition overwrite, also empties the partition when there are no rows.
    """
    return f"{path}/{column}={value}"


def load_dimension(df: DataFrame, path: str, truncate: bool = True) -> None:
    """Insert a dimension, emptying the table first if `truncate`."""
    (overwrite if truncate else append)(df, path)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a parquet table with a schema lies at `path`."""
    try:
        spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise
    return True


def within(target: DataFrame, source: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows of `target` between the smallest and largest values in `source`, and nulls.

    The ends are known when the read is planned, so partitions and row groups
    outside them are not opened.  They travel as text, which no time zone
    shifts; zoned timestamps, whose text can be ambiguous, are not narrowed.
    """
    kinds = {c: k for c, k in source.dtypes if c in columns and k != "timestamp"}
    if not kinds:
        return target
    ends = source.agg(*[
        f(c).cast("string").alias(f"{f.__name__}_{c}") for c in kinds for f in (F.min, F.max)
    ]).first()
    for c, kind in kinds.items():
        low, high = (F.lit(ends[f"{end}_{c}"]).cast(kind) for end in ("min", "max"))
        target = target.filter(F.col(c).between(low, high) | F.col(c).isNull())
    return target


def touching(target: DataFrame, source: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows of `target` that share a combination of values with `source`, null equal to null.

    Up to MAX_TOUCHED combinations become a filter, so exactly their partitions are
    opened: a stray old row in `source` opens one more.  Beyond that the rows are
    narrowed to the range of each column and semi-joined.
    """
    kinds = dict(source.dtypes)
    combinations = source.select(*columns).distinct()
    if "timestamp" not in {kinds[c] for c in columns}:  # its text can be ambiguous
        texts = [F.col(c).cast("string").alias(c) for c in columns]
        found = combinations.select(*texts).limit(MAX_TOUCHED + 1).collect()
        if len(found) <= MAX_TOUCHED:
            same = [
                reduce(lambda a, b: a & b, [
                    F.col(c).isNull() if row[c] is None else F.col(c) == F.lit(row[c]).cast(kinds[c]) for c in columns
                ])
                for row in found
            ]
            return target.filter(reduce(lambda a, b: a | b, same, F.lit(False)))
    marked = prefixed(combinations, columns)
    if measured_bytes(marked) <= BROADCAST_BYTES:
        marked = F.broadcast(marked)  # stored rows stay where they are read
    return within(target, source, columns).join(marked, equal_nulls(columns), "left_semi")


def absent(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of `source` whose key `target` lacks; null keys compare as equal.

    Whole keys join by plain equality, which reuses a partitioning by key; rows
    with a null in their key, usually few, take a branch of their own.
    """
    whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in keys])
    known = prefixed(target, keys)
    same = reduce(lambda a, b: a & b, [F.col(c) == F.col(f"_{c}") for c in keys])
    broken = prefixed(target.filter(~whole), keys)
    return source.filter(whole).join(known, same, "left_anti").unionByName(
        source.filter(~whole).join(broken, equal_nulls(keys), "left_anti")
    )


def once(df: DataFrame, many: Sequence[str] = ()) -> DataFrame:
    """`df` computed once and for all, in a file of the shared folder, packed as columns of `many` values need it."""
    path = scratch_path(df.sparkSession, "incoming")
    df.write.options(**packing(many)).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def insert_if_absent(
    df: DataFrame,
    path: str,
    keys: Sequence[str],
    order_by: Sequence[str] = (),
    partition_by: Sequence[str] = (),
    prune_on: Sequence[str] = (),
    derived: Mapping[str, Column] | None = None,
) -> None:
    """Insert the rows whose key is new; a stored row is never changed.

    Of several new rows with one key the first in `order_by` is taken, ties by
    the remaining columns.  Repeating the call changes nothing.  `prune_on`
    names columns that the key determines and the table is partitioned or
    sorted by; stored rows with other values are then not read.  `derived` columns
    follow from the others; they are worked out, and put first, when rows are written.
    """
    spark = df.sparkSession
    fresh = pick_per_key(df, keys, order_by, "first")
    if exists(spark, path):
        stored = spark.read.schema(df.schema).parquet(path)
        if prune_on and set(prune_on) <= set(partition_by):
            # Few values, read apart: the rows then meet the stored ones where the choice put them.
            stored = touching(stored, once(df.select(*prune_on).distinct()), prune_on)
        elif prune_on:
            fresh = once(fresh)  # for its values and for the insert
            stored = touching(stored, fresh, prune_on)
        fresh = absent(fresh, stored, keys)
    placed = layout(fresh, partition_by).select(*[c.alias(name) for name, c in (derived or {}).items()], "*")
    writer = placed.write.mode("append")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def merged(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """`target` after `source`, of one row per key, was written over it."""
    both = target.withColumn("_new", F.lit(0)).unionByName(source.withColumn("_new", F.lit(1)))
    return pick_per_key(both, keys, ["_new"], "last").drop("_new")


def upsert(
    df: DataFrame,
    path: str,
    keys: Sequence[str],
    order_by: Sequence[str] = (),
    partition_by: Sequence[str] = (),
    sort: Sequence[str] = (),
    buckets: int = BUCKETS,
) -> None:
    """Insert new keys and replace the rows of stored ones, last write wins.

    `partition_by` names columns that the key determines.  Without any the table is
    partitioned by a hash of the key, `buckets` of them when it is created, in a
    column that readers drop by naming theirs.  Only the partitions that `df` touches
    are read and rewritten: into a folder beside them, which takes their place when
    all rows are there, so a write that fails leaves the stored rows as they were.
    """
    spark = df.sparkSession
    stored = spark.read.parquet(path) if exists(spark, path) else None
    if not partition_by:
        known = [c for c in stored.columns if c.startswith(_BUCKET)] if stored is not None else []
        name = known[0] if known else f"{_BUCKET}{buckets}"
        size = int(name.removeprefix(_BUCKET))
        df = df.withColumn(name, F.pmod(F.xxhash64(*keys), F.lit(size)).cast("int"))
        partition_by = [name]
    latest = pick_per_key(df, keys, order_by, "last")
    if stored is not None:
        latest = once(latest)  # for its partitions and for the merge
        stored = spark.read.schema(df.schema).parquet(path).select(*df.columns)
        latest = merged(latest, touching(stored, latest, partition_by), keys)
    overwrite_partitions(latest, path, partition_by, sort)


def insert_by_name(
    df: DataFrame, schema: StructType, generated: Mapping[str, Column] | None = None
) -> DataFrame:
    """Columns of `df` put in the table's order by their names and cast.

    Table columns that `df` lacks take their expression from `generated`.
    """
    generated = generated or {}
    return df.select(*[
        (F.col(f.name) if f.name in df.columns else generated[f.name]).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ])


def insert_by_position(df: DataFrame, schema: StructType) -> DataFrame:
    """Columns of `df` taken for the table's columns one by one, whatever their names."""
    if len(df.columns) != len(schema.fields):
        raise ValueError(f"{len(df.columns)} columns for a table of {len(schema.fields)}")
    renamed = df.toDF(*schema.fieldNames())
    return renamed.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def reset_tables(spark: SparkSession, root: str, schemas: Mapping[str, StructType]) -> None:
    """Drop every named table below `root` and create it empty."""
    for name, schema in schemas.items():
        columns = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
        spark.range(0).select(*columns).coalesce(1).write.mode("overwrite").parquet(f"{root}/{name}")
