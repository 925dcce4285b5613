"""The registered queries: all of them, whole tables, and the SQL where there is any."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from loomstar.llm.queries import ORACLES, QUERIES
from tests.llm.cases import key

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
CONTRACT = {
    1: "doc_id n_words n_base first_word last_word base_labels labels score",
    2: "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    3: "page_id url text n_chars",
    4: "doc_id keep_id group_size kept text_sha256",
    5: "doc_id held_out lang_pred score",
    6: "doc_id held_out n_tokens n_known train_tokens base_score score",
    7: "doc_id class_id class_size kept",
    8: "doc_id start length ids_crc32 doc_tokens sequence_id offset",
    9: "doc_id n_ids ids_crc32 n_chars text_sha256 lossless",
    10: "conv_id n_turns turns_sha256 loss_chars loss_sha256 formatted_chars",
    11: "vec_id cluster distance cluster_inertia inertia centroid_sha256",
    12: "doc_id n_words n_hit n_items items_sha256 contaminated",
    13: "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256",
}


def test_all_and_the_pipeline_are_registered():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_queries_return_their_contract(spark, name):
    df = QUERIES[name](spark, SF_DIR)
    number = int(name[2:].split("_")[0])
    wanted = CONTRACT[number].split()
    assert df.columns[: len(wanted)] == wanted or set(wanted) <= set(df.columns)
    kinds = dict(df.dtypes)
    assert all(kinds[c] == "bigint" for c in wanted if c.startswith("n_") or c.endswith(("_id", "_crc32", "_chars")))
    rows = df.collect()
    if number == 11:
        assert sorted(r.vec_id for r in rows) == sorted(r.vec_id for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect())
    elif number in (3, 10):
        source, n = ("pages", 0) if number == 3 else ("conversations", 1)
        held = spark.read.parquet(f"{SF_DIR}/{source}.parquet")
        assert len(rows) == (held.count() if number == 3 else held.select("conv_id").distinct().count() + n)
    else:
        documents = sorted(r.doc_id for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id").collect())
        found = [r.doc_id for r in rows]
        assert (sorted(set(found)) if number == 8 else sorted(found)) == documents
    if number == 9:
        assert all(r.lossless for r in rows)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_equal_sql(spark, name):
    df = QUERIES[name](spark, SF_DIR)
    con = duckdb.connect()
    for name_ in ("documents", "embeddings", "benchmark"):
        con.execute(f"CREATE VIEW {name_} AS SELECT * FROM '{SF_DIR}/{name_}.parquet'")
    cursor = con.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(df.columns)
    got = sorted((tuple(r[c] for c in names) for r in df.collect()), key=key)
    assert got == sorted(cursor.fetchall(), key=key)
