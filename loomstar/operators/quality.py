"""Data-quality checks; reports are DataFrames."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomstar.functions.casts import is_truthy


class DataQualityError(Exception):
    """Raised when at least one check of a report failed."""


def run_checks(spark: SparkSession, checks: Mapping[str, str | DataFrame]) -> DataFrame:
    """Run every check and report test_name, passed and detail.

    A check is a query, as SQL or as a DataFrame, whose first row must exist
    and hold no null, zero, empty or false value.  All checks run as one job
    and one failing does not stop the others.
    """

    def evaluate(name: str, check: str | DataFrame) -> DataFrame:
        row = (spark.sql(check) if isinstance(check, str) else check).limit(1)
        folded = [c.lower() for c in row.columns]
        row = row.toDF(*[
            c if folded.count(c.lower()) == 1 else f"{c}_{i}" for i, c in enumerate(row.columns)
        ])
        fields = row.schema.fields
        holds = reduce(lambda a, b: a & b, [is_truthy(f.name, f.dataType) for f in fields])
        text = F.to_json(F.struct(*[f"`{f.name}`" for f in fields]), {"ignoreNullFields": "false"})
        return row.agg(F.min(holds).alias("holds"), F.min(text).alias("row")).select(
            F.lit(name).alias("test_name"),
            F.coalesce("holds", F.lit(False)).alias("passed"),
            F.coalesce("row", F.lit("no row")).alias("detail"),
        )

    return reduce(DataFrame.unionByName, [evaluate(*check) for check in checks.items()])


def assert_checks(report: DataFrame) -> None:
    """Raise one error that names every failed check, if any failed."""
    failed = report.filter(~F.col("passed")).select("test_name", "detail").collect()
    if failed:
        names = ", ".join(f"{r.test_name} ({r.detail})" for r in failed)
        raise DataQualityError(f"{len(failed)} data quality checks failed: {names}")


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("row_count"))


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count of each table, as one job."""
    parts = [
        row_count(df).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def has_rows_checks(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """One `<table>_has_rows` check per table, for `run_checks`."""
    return {f"{name}_has_rows": row_count(df) for name, df in tables.items()}


def star_checks(
    tables: Mapping[str, DataFrame],
    unique: Mapping[str, Sequence[str]] | None = None,
    required: Mapping[str, Sequence[str]] | None = None,
    references: Mapping[str, Mapping[str, str]] | None = None,
) -> dict[str, DataFrame]:
    """Checks for `run_checks`: keys that must not repeat, columns without nulls, references.

    `references` maps a table's columns to tables that have a column of that name.
    """
    none = lambda df: df.agg((F.count("*") == 0).alias("none"))
    checks = {f"{t}_key_unique": none(pk_violations(tables[t], keys)) for t, keys in (unique or {}).items()}
    for t, columns in (required or {}).items():
        nulls = null_violations(tables[t], columns).filter("n_nulls > 0")
        checks[f"{t}_required"] = none(nulls)
    for t, columns in (references or {}).items():
        for c, dim in columns.items():
            checks[f"{t}_{c}_in_{dim}"] = none(fk_violations(tables[t], tables[dim], c))
    return checks


def pk_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, and how often."""
    counts = df.groupBy(*keys).agg(F.count("*").alias("n_rows"))
    return counts.filter(F.col("n_rows") > 1)


def null_violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Nulls per required column, all columns counted in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], list(columns), "column_name", "n_nulls")


def fk_violations(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Key values of the fact that its dimension lacks, and their row counts.

    Counting per key comes first, so the anti join handles each key once.
    """
    counts = fact.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n_rows"))
    return counts.join(dim.select(key), key, "left_anti")


def fingerprints(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows and an order-free digest of each part of a table: equal only for equal parts.

    Two runs that leave a part alone leave its fingerprint alone.
    """
    rest = [c for c in df.columns if c not in by]
    digest = F.sum(F.xxhash64(*rest).cast("decimal(38,0)")).cast("string")
    return df.groupBy(*by).agg(F.count("*").alias("n_rows"), digest.alias("digest"))


def fused_checks(
    tables: Mapping[str, DataFrame],
    unique: Mapping[str, Sequence[str]] | None = None,
    required: Mapping[str, Sequence[str]] | None = None,
    references: Mapping[str, Mapping[str, str]] | None = None,
) -> DataFrame:
    """The checks of `star_checks` in one pass: test_name, passed and detail, the number of violations.

    Every table is scanned once.  A row becomes one entry for its key, one for each
    reference it makes or answers, and one for each missing value; entries are counted by
    check and key, combined before the shuffle, so a hot key costs one entry a task.
    """
    entries: dict[str, list[Column]] = {t: [] for t in tables}
    names: list[tuple[str]] = []
    # A key is violated if it is held more often than allowed, or missed by what refers to it.
    entry = lambda name, key, held, missed: F.struct(
        F.lit(name).alias("test_name"), key.alias("key"), F.lit(held).alias("held"), F.lit(missed).alias("missed")
    )
    text = lambda columns: F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
    for t, keys in (unique or {}).items():
        names.append((f"{t}_key_unique",))
        entries[t].append(entry(names[-1][0], text(keys), 1, 0))
    for t, columns in (required or {}).items():
        names.append((f"{t}_required",))
        entries[t] += [F.when(F.col(c).isNull(), entry(names[-1][0], F.lit(c), 0, 1)) for c in columns]
    for t, keys in (references or {}).items():
        for c, dim in keys.items():
            names.append((f"{t}_{c}_in_{dim}",))
            entries[t].append(F.when(F.col(c).isNotNull(), entry(names[-1][0], F.col(c).cast("string"), 0, 1)))
            # An entry of zeros answers the references to its key, however often it is held.
            entries[dim].append(F.when(F.col(c).isNotNull(), entry(names[-1][0], F.col(c).cast("string"), 0, 0)))
    parts = [
        tables[t].select(F.explode(F.filter(F.array(*own), lambda e: e.isNotNull())).alias("e")).select("e.*")
        for t, own in entries.items() if own
    ]
    spark = next(iter(tables.values())).sparkSession
    known = spark.createDataFrame(names, "test_name string")
    each = reduce(DataFrame.unionByName, parts).groupBy("test_name", "key").agg(
        F.sum("held").alias("held"), F.sum("missed").alias("missed"),
        F.max((F.col("held") + F.col("missed") == 0).cast("int")).alias("answered"),
    )
    broken = (F.col("held") > 1) | ((F.col("missed") > 0) & (F.col("answered") == 0))
    found = each.groupBy("test_name").agg(F.count_if(broken).alias("n"))
    counted = known.join(F.broadcast(found), "test_name", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return counted.select("test_name", (F.col("n") == 0).alias("passed"), F.format_string("%d violations", "n").alias("detail"))
