"""Checks and their reports."""

import pytest

from loomstar import operators as op


@pytest.mark.parametrize(
    "query, passed",
    [
        ("select 3", True),
        ("select 0", False),
        ("select 1, null", False),
        ("select ''", False),
        ("select 'x', true, 2.5", True),
        ("select false", False),
        ("select array()", False),
        ("select cast('nan' as double)", True),
        ("select date'2020-01-01'", True),
        ("select 1 where 1 = 0", False),
        ("select count(*), count(*) from range(3)", True),
        ("select 1 as a, 0 as A", False),
        ("select cast('' as binary)", False),
        ("select cast(0 as decimal(10,2))", False),
    ],
)
def test_what_counts_as_passing(spark, query, passed):
    report = op.run_checks(spark, {"check": query}).collect()
    assert [(r.test_name, r.passed) for r in report] == [("check", passed)]


def test_all_checks_run_and_one_error_names_the_failures(spark):
    checks = {"a": "select 0", "b": "select 1", "c": "select 1 where false"}
    report = op.run_checks(spark, checks)
    assert report.count() == 3
    with pytest.raises(op.DataQualityError, match=r"^2 data quality checks failed: a .*, c \(no row\)"):
        op.assert_checks(report)
    op.assert_checks(op.run_checks(spark, {"b": "select 1"}))


def test_has_rows(spark):
    tables = {"full": spark.range(3), "empty": spark.range(0)}
    report = {r.test_name: (r.passed, r.detail) for r in op.run_checks(spark, op.has_rows_checks(tables)).collect()}
    assert report == {
        "full_has_rows": (True, '{"row_count":3}'), "empty_has_rows": (False, '{"row_count":0}'),
    }
    assert {r.table_name: r.row_count for r in op.row_counts(tables).collect()} == {"full": 3, "empty": 0}


def test_constraint_checks(spark):
    fact = spark.createDataFrame([(1, "a"), (1, "b"), (2, None), (None, "c")], "k int, v string")
    dim = spark.createDataFrame([(1,), (None,)], "k int")
    assert [tuple(r) for r in op.pk_violations(fact, ["k"]).collect()] == [(1, 2)]
    assert {tuple(r) for r in op.null_violations(fact, ["k", "v"]).collect()} == {("k", 1), ("v", 1)}
    assert [tuple(r) for r in op.fk_violations(fact, dim, "k").collect()] == [(2, 1)]


def test_fused_checks_equal_the_single_ones_and_scan_each_table_once(spark, tmp_path):
    fact = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, None, 3), (None, "c", 3)], "k int, v string, w int")
    dim = spark.createDataFrame([(1, "x"), (1, "y"), (None, "z")], "k bigint, label string")
    other = spark.createDataFrame([(1,), (2,), (3,)], "w int")
    for name, df in (("fact", fact), ("dim", dim), ("other", other), ("empty", fact.limit(0))):
        df.write.parquet(f"{tmp_path}/{name}")
    tables = {name: spark.read.parquet(f"{tmp_path}/{name}") for name in ("fact", "dim", "other", "empty")}
    rules = dict(
        unique={"fact": ["k", "v"], "dim": ["k"], "empty": ["k"]},
        required={"fact": ["k", "w"], "dim": ["label"], "empty": ["k"]},
        references={"fact": {"k": "dim", "w": "other"}, "empty": {"k": "dim"}},
    )
    one = {r.test_name: r.passed for r in op.run_checks(spark, op.star_checks(tables, **rules)).collect()}
    fused = op.fused_checks(tables, **rules)
    assert {r.test_name: r.passed for r in fused.collect()} == one and len(one) == 9 and not all(one.values())
    plan = fused._jdf.queryExecution().optimizedPlan().toString()
    assert all(plan.count(f"/{name}") <= 1 for name in tables) and plan.count("parquet") == len(tables)


def test_fingerprints_tell_parts_apart(spark):
    rows = [(1, "a", None), (1, "b", 2), (2, "a", None)]
    of = lambda rows: {r.k: (r.n_rows, r.digest) for r in op.fingerprints(spark.createDataFrame(rows, "k int, v string, n int"), ["k"]).collect()}
    first, again, other = of(rows), of(rows[::-1]), of([*rows[:2], (2, "b", None)])
    assert first == again and first[1] == other[1] and first[2] != other[2]
