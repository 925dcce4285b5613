"""Which files of a table may hold a key, without opening them.

Beside its files a table keeps a digest of their keys: for every file the distinct 48-bit
hashes of its keys.  Incoming keys meet the digest, and only files that hold one of their
hashes are read; whether a key is really there is decided by its columns.  A file without a
digest, because it came by another way, is digested when it is first met, and digests of
files that are gone are passed over, so the digest never makes a result wrong.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from loomstar.operators.dedup import pick_per_key
from loomstar.sinks.tables import absent, append, exists, once

#: Bits of a key's hash: a thousand million stored keys answer falsely for one in 280,000.
BITS = 48
_CELLS = "file string, cell bigint"
#: What a file's name begins with is written in several ways.
_SCHEME = "^[A-Za-z][A-Za-z0-9+.-]*:/*"


def _cell(keys: Sequence[str]) -> Column:
    return F.xxhash64(*keys).bitwiseAND(F.lit((1 << BITS) - 1)).alias("cell")


def _path(path: str) -> str:
    return f"{path}/_digest"  # readers pass over names that begin with an underscore


def _refresh(spark: SparkSession, path: str, schema: StructType, keys: Sequence[str]) -> tuple[DataFrame, dict[str, str]]:
    """The digest, up to date, and the table's files: their names in it and as they are read."""
    files = {re.sub(_SCHEME, "", f): f for f in map(unquote, spark.read.schema(schema).parquet(path).inputFiles())}
    digest = spark.read.schema(_CELLS).parquet(_path(path)) if exists(spark, _path(path)) else None
    known = {r.file for r in digest.select("file").distinct().collect()} if digest is not None else set()  # a name per file
    missing = [f for name, f in files.items() if name not in known]
    if missing:
        rows = spark.read.schema(schema).option("basePath", path).parquet(*missing)
        place = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
        append(rows.select(F.regexp_replace(place, _SCHEME, "").alias("file"), _cell(keys)).distinct(), _path(path))
        digest = spark.read.schema(_CELLS).parquet(_path(path))
    return digest, files


def files_with(source: DataFrame, path: str, schema: StructType, keys: Sequence[str]) -> list[str]:
    """Files of the table at `path` that may hold a key of `source`; all others do not."""
    digest, files = _refresh(source.sparkSession, path, schema, keys)
    if digest is None:
        return []
    cells = source.select(_cell(keys)).distinct()
    touched = digest.join(cells, "cell", "left_semi").select("file").distinct().collect()  # a name per file
    return sorted(files[r.file] for r in touched if r.file in files)


def insert_if_absent_by_digest(
    df: DataFrame, path: str, keys: Sequence[str], order_by: Sequence[str] = (), partition_by: Sequence[str] = ()
) -> None:
    """Insert the rows whose key is new, as `insert_if_absent`, reading only files that may hold one.

    For tables whose partitions the key does not determine.  Repeating the call changes
    nothing; one writer at a time is assumed.
    """
    spark = df.sparkSession
    fresh = pick_per_key(df, keys, order_by, "first")
    if exists(spark, path):
        fresh = once(fresh)  # for its hashes and for the insert
        touched = files_with(fresh, path, df.schema, keys)
        if touched:
            stored = spark.read.schema(df.schema).option("basePath", path).parquet(*touched).select(*df.columns)
            fresh = absent(fresh, stored, keys)
    append(fresh, path, partition_by)
