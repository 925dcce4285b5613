"""Upsert tables that write what comes in: new rows lie beside the old ones and win on read.

A table is a folder of versions.  An upsert writes its rows, one per key, as the next
version and touches no other file, so what it writes grows with what comes in and not with
the table.  A read takes the newest base, drops the rows whose key a later version has, and
adds the latest row of each such key.  When the versions after a base outgrow a share of
it, the next upsert makes their union the new base; every row is so rewritten a bounded
number of times over the table's life.

A version appears under its name when all its files are there.  A reader that comes while
a base is made sees the same rows before and after, and the versions that a new base
replaces stay until the one after it, so a read that has begun can end.  One writer at a
time is assumed.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from loomstar.operators.dedup import pick_per_key
from loomstar.sinks.tables import absent, write_table

#: Bytes of later versions against bytes of their base at which a new base is made.
COMPACT_AT = 1.0
_NAME = re.compile(r"version_=(\d{9})(b?)$")
_VERSION = "version_"


@dataclass(frozen=True)
class Version:
    number: int
    base: bool
    path: str


def _folder(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def versions(spark: SparkSession, path: str) -> list[Version]:
    """All versions that are there, oldest first; at one number the base comes last."""
    folder, files = _folder(spark, path)
    if not files.exists(folder):
        return []
    found = []
    for status in files.listStatus(folder):
        name = _NAME.search(status.getPath().getName())
        if name:
            found.append(Version(int(name[1]), bool(name[2]), f"{path}/{name[0]}"))
    return sorted(found, key=lambda v: (v.number, v.base))


def _live(found: Sequence[Version]) -> tuple[Version | None, list[Version]]:
    """The newest base and the versions after it."""
    bases = [v for v in found if v.base]
    if not bases:
        return None, [v for v in found]
    return bases[-1], [v for v in found if not v.base and v.number > bases[-1].number]


def bytes_of(spark: SparkSession, path: str) -> int:
    """Bytes of all files below `path`."""
    folder, files = _folder(spark, path)
    return files.getContentSummary(folder).getLength()


def read_versions(spark: SparkSession, path: str, keys: Sequence[str], schema: StructType) -> DataFrame:
    """The rows of an upsert table, one per key; filters on keys reach every scan."""
    base, later = _live(versions(spark, path))
    scan = lambda v: spark.read.schema(schema).parquet(v.path)
    if base is None and not later:
        return spark.createDataFrame([], schema)
    if not later:
        return scan(base)
    new = scan(later[0]).withColumn(_VERSION, F.lit(later[0].number))
    for v in later[1:]:
        new = new.unionByName(scan(v).withColumn(_VERSION, F.lit(v.number)))
    # A version has one row per key, so one version needs no choice.
    new = (pick_per_key(new, keys, [_VERSION], "last") if len(later) > 1 else new).drop(_VERSION)
    return new if base is None else absent(scan(base), new, keys).unionByName(new)


def _write(
    df: DataFrame, path: str, number: int, base: bool, dist: Sequence[str], sort: Sequence[str], options: Mapping[str, str] | None
) -> None:
    spark = df.sparkSession
    pending = f"{path}/_pending-{uuid.uuid4().hex}"
    source, files = _folder(spark, pending)
    try:
        write_table(df, pending, dist=dist, sort=sort, options=options)
    except BaseException:
        files.delete(source, True)
        raise
    target, _ = _folder(spark, f"{path}/{_VERSION}={number:09d}{'b' if base else ''}")
    if not files.rename(source, target):
        raise OSError(f"{target} could not be put in place")


def compact(
    spark: SparkSession, path: str, keys: Sequence[str], schema: StructType, dist: Sequence[str] = (), sort: Sequence[str] = (),
    options: Mapping[str, str] | None = None,
) -> None:
    """Make all versions one base, and drop those that an earlier base had replaced."""
    found = versions(spark, path)
    base, later = _live(found)
    if not later:
        return
    _write(read_versions(spark, path, keys, schema), path, later[-1].number, True, dist, sort, options)
    for v in found:
        if base is not None and (v.number, v.base) < (base.number, base.base):
            folder, files = _folder(spark, v.path)
            files.delete(folder, True)


def upsert_versions(
    df: DataFrame,
    path: str,
    keys: Sequence[str],
    order_by: Sequence[str] = (),
    dist: Sequence[str] = (),
    sort: Sequence[str] = (),
    compact_at: float = COMPACT_AT,
    chosen: bool = False,
    options: Mapping[str, str] | None = None,
) -> None:
    """Insert new keys and replace the rows of stored ones, last write wins.

    Of several rows with one key the last in `order_by` is taken, ties by the remaining
    columns; null keys are equal.  Rows that `pick_per_key` gave for these keys are `chosen`
    and not chosen from once more.  `options` are those of the files.  Read the table with
    `read_versions`.
    """
    spark = df.sparkSession
    base, later = _live(versions(spark, path))
    if base is not None and later:
        held = sum(bytes_of(spark, v.path) for v in later)
        if held > compact_at * bytes_of(spark, base.path):
            compact(spark, path, keys, df.schema, dist, sort, options)
            base, later = _live(versions(spark, path))
    last = max((v.number for v in [*([base] if base else []), *later]), default=0)
    rows = df if chosen else pick_per_key(df, keys, order_by, "last")
    _write(rows, path, last + 1, base is None, dist, sort, options)
