"""What the operators of this subpackage share: narrow inputs, bounded batches, stored steps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomstar.session import scratch_path

#: Characters that part words, fixed values: blank, tab, line feed, vertical tab, form feed, return.
WHITE = " \t\n\x0b\x0c\r"

#: Rows in one Arrow batch, and its bytes.  Texts are whole, so rows alone bound nothing.
BATCH_ROWS = 1_000
BATCH_BYTES = 32 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def narrow(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, cast; whatever else the table holds cannot clash further on."""
    return df.select(*(F.col(f"`{name}`").cast(kind).alias(name) for name, kind in columns.items()))


def bounded(df: DataFrame) -> DataFrame:
    """`df`, with Arrow batches held to a size a task's Python can take.

    The two settings belong to the session and stay after the call: batches of its other
    Python operators are held to the same size, which changes no result.
    """
    conf = df.sparkSession.conf
    rows = int(conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000"))
    if rows <= 0 or rows > BATCH_ROWS:
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df


def store(df: DataFrame, name: str) -> DataFrame:
    """Write to the folder all executors share and read back: lineage ends there."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def if_small(df: DataFrame, max_rows: int) -> DataFrame:
    """`df` marked for broadcast if it was counted to hold at most `max_rows` narrow rows.

    Beyond that the join shuffles; the result is the same.
    """
    return F.broadcast(df) if df.count() <= max_rows else df


#: A key with more than one row in so many goes by broadcast, so there are fewer such keys than that.
HOT_KEYS = 1_000


def join_sized(left: DataFrame, right: DataFrame, key: str, size: str) -> DataFrame:
    """`left` joined to `right`, which has one row per `key` with its number of rows, `size`.

    Keys that hold more than a HOT_KEYS-th of all rows, fewer than HOT_KEYS, meet their rows
    where these are; all other keys shuffle.  `right` is read three times, so store it.
    """
    least = (right.agg(F.sum(size)).first()[0] or 0) / HOT_KEYS
    hot = F.broadcast(right.where(F.col(size) > least))
    keys = F.broadcast(right.where(F.col(size) > least).select(key))
    cold = left.join(keys, key, "left_anti").join(right.where(F.col(size) <= least), key)
    return left.join(hot, key).unionByName(cold)


def crc32_mod(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo `modulus`; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


def text_md5(text: Column) -> Column:
    """A short name of the exact text; null is empty."""
    return F.md5(F.coalesce(text.cast("string"), F.lit("")).cast("binary"))


def drop_unkept(docs: DataFrame, judged: DataFrame, max_rows: int = 100_000) -> DataFrame:
    """`docs`, all its columns, without the rows that `judged` (doc_id, text_md5, kept) drops.

    Rows are told apart by id and text.  Where rows repeat both, as many as `judged` keeps
    (one at most) stay.  Marks for dropped rows travel by broadcast up to `max_rows`.
    """
    per_key = judged.groupBy("doc_id", "text_md5").agg(F.max("kept").alias("stays"), F.count(F.lit(1)).alias("rows"))
    marks = store(per_key.where(~F.col("stays") | (F.col("rows") > 1)).drop("rows"), "marks")
    marks = if_small(marks, max_rows)
    wide = docs.select(
        F.struct("*").alias("__doc"),
        F.col("`doc_id`").cast("long").alias("__doc_id"),
        text_md5(F.col("`text`")).alias("__md5"),
    )
    match = wide["__doc_id"].eqNullSafe(marks["doc_id"]) & (wide["__md5"] == marks["text_md5"])
    seen = wide.join(marks, match, "left")
    single = seen.where("stays is null").select("__doc.*")
    again = seen.where("stays").dropDuplicates(["__doc_id", "__md5"]).select("__doc.*")
    return single.unionByName(again)
