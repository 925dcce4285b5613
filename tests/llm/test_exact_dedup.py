import random

import duckdb

from loomstar.llm import exact_dedup
from loomstar.llm.queries import ORACLES
from tests.llm.cases import documents, key, text

# One text makes up a third of the rows, some are spaced differently, some are null.
PICK = random.Random(1)
ROWS = [(k, text(30), "aa") for k in range(100)]
ROWS += [(100 + k, text(5, k % 60) if k % 7 else text(5, k % 60).replace(" ", "\n\t "), "aa") for k in range(190)]
ROWS += [(400 + k, [None, "", " "][k % 3], "aa") for k in range(9)]
PICK.shuffle(ROWS)


def test_equals_sql(spark):
    got = exact_dedup.exact_dedup(documents(spark, ROWS)).toPandas()
    con = duckdb.connect()
    con.execute("create table documents as select * from (values " + ", ".join(["(?, ?)"] * len(ROWS)) + ") t(doc_id, text)",
                [x for r in ROWS for x in r[:2]])
    cursor = con.execute(ORACLES["op4_exact_dedup"])
    names = [d[0] for d in cursor.description]
    assert sorted(map(tuple, got[names].values.tolist()), key=key) == sorted(cursor.fetchall(), key=key)


def test_frequent_digests_are_found_and_verified(spark):
    rows = exact_dedup._digested(documents(spark, ROWS)).selectExpr("*", "monotonically_increasing_id() as row")
    found = exact_dedup.frequent_winners(rows, support=0.2).collect()
    assert [(r.group_size, r.best.doc_id) for r in found] == [(100, 0)]


def test_support_changes_the_plan_not_the_result(spark):
    docs = documents(spark, ROWS)
    one, other = (sorted(map(tuple, exact_dedup.exact_dedup(docs, s).collect()), key=key) for s in (0.5, 0.002))
    assert one == other


def test_no_python_on_the_main_path(spark):
    plan = exact_dedup.exact_dedup(documents(spark, ROWS))._jdf.queryExecution().toString()
    assert "Python" not in plan and "InPandas" not in plan
