"""Generated keys for fact rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomstar.session import scratch_path


def play_key(session: Column | str, start: Column | str) -> Column:
    """md5 of session id and start time as text; null if either is null."""
    session = F.col(session) if isinstance(session, str) else session
    start = F.col(start) if isinstance(start, str) else start
    return F.md5(F.concat(session.cast("string"), start.cast("string")))


def event_key(columns: Sequence[str]) -> Column:
    """A digest of whole records, never null: equal only for equal records, nulls included."""
    return F.md5(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}))


#: Bits of a surrogate id that name its task.
_TASK_BITS = 20


def surrogate_id(df: DataFrame, name: str = "songplay_id", start: int = 0) -> DataFrame:
    """Add a unique 64-bit id, not dense, without a shuffle.

    Ids count rows within a task in steps of 2^20 and add the task's number, so a
    run uses up little more than a million ids for each row of its largest task.
    More tasks than that fail.  Pass `start` above the largest id already stored when
    appending, since every batch counts from zero again.  Number rows after their
    last shuffle: a task that runs again then numbers its own output afresh.
    """
    raw = F.monotonically_increasing_id()
    task, row = F.shiftright(raw, 33), raw.bitwiseAND(F.lit((1 << 33) - 1))
    number = F.shiftleft(row, _TASK_BITS) + task + F.lit(start)
    most = f"more than {1 << _TASK_BITS} tasks"
    checked = F.when(task < (1 << _TASK_BITS), number).otherwise(F.raise_error(F.lit(most)).cast("bigint"))
    return df.select(checked.alias(name), "*")


def dense_id(df: DataFrame, name: str = "songplay_id", start: int = 0) -> DataFrame:
    """Add ids start, start+1, … without gaps and without sorting the data.

    Rows are staged as parquet first, so that counting and numbering see the same
    partitions, and counting reads no column.  The offsets are a running sum over
    one row per partition; the rows themselves are neither shuffled nor gathered.
    """
    spark, path = df.sparkSession, scratch_path(df.sparkSession, "numbered")
    df.write.parquet(path)
    fixed = spark.read.schema(df.schema).parquet(path)
    tagged = fixed.select(
        F.spark_partition_id().alias("_part"),
        # The low 33 bits are the row's position inside its partition.
        F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("_pos"),
        "*",
    )
    sizes = fixed.groupBy(F.spark_partition_id().alias("_part")).agg(F.count("*").alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset")
    )
    return tagged.join(F.broadcast(offsets), "_part").select(
        (F.col("_offset") + F.col("_pos") + F.lit(start)).alias(name), *df.columns
    )
