"""Every operator and every stage on awkward rows and on no rows."""

import pytest

import corpus_pipeline
from loomstar.llm import (
    alignment, chat, decontaminate, exact_dedup, html_text, language_id, license_scan, near_dedup, packing, pieces, ppm, quality,
)
from tests.llm.cases import DOCUMENTS, documents, labels

PER_ROW = {
    "license_scan": lambda spark, docs: license_scan.license_scan(docs),
    "quality_rules": lambda spark, docs: quality.quality_rules(docs, labels(spark)),
    "exact_dedup": lambda spark, docs: exact_dedup.exact_dedup(docs),
    "language_id": lambda spark, docs: language_id.language_id(docs),
    "ppm": lambda spark, docs: ppm.score(docs),
    "near_dedup": lambda spark, docs: near_dedup.near_dedup(docs),
    "pieces": lambda spark, docs: pieces.decode(pieces.encode(docs)),
    "decontaminate": lambda spark, docs: decontaminate.decontaminate(docs, spark.createDataFrame([(1, "ka lo"), (None, None)], "item_id long, text string")),
    "alignment": lambda spark, docs: alignment.links(docs),
}
FILTERS = {
    "keep_good": lambda spark, docs: quality.keep_good(docs, labels(spark)),
    "keep_known_language": lambda spark, docs: language_id.keep_known_language(docs),
    "drop_exact_copies": lambda spark, docs: exact_dedup.drop_exact_copies(docs),
    "drop_near_copies": lambda spark, docs: near_dedup.drop_near_copies(docs),
}


@pytest.mark.parametrize("name", PER_ROW)
def test_one_row_out_for_each_row_in(spark, name):
    rows = PER_ROW[name](spark, documents(spark)).collect()
    assert sorted(str(r.doc_id) for r in rows) == sorted(str(d[0]) for d in DOCUMENTS)


@pytest.mark.parametrize("name", PER_ROW)
def test_no_rows_give_no_rows(spark, name):
    out = PER_ROW[name](spark, documents(spark, []))
    assert out.collect() == []


@pytest.mark.parametrize("name", FILTERS)
def test_filters_keep_all_columns_and_only_given_rows(spark, name):
    docs = documents(spark)
    out = FILTERS[name](spark, docs)
    assert out.columns == docs.columns
    given = [tuple(r) for r in docs.collect()]
    assert all(tuple(r) in given for r in out.collect())
    assert FILTERS[name](spark, documents(spark, [])).collect() == []


def test_exact_copies_leave_one_row_of_each_text(spark):
    kept = exact_dedup.drop_exact_copies(documents(spark)).collect()
    texts = [("".join((r.text or "").split(None)) if r.text else "") for r in kept]
    assert len(texts) == len(set(texts))
    assert {r.doc_id for r in kept} >= {1, 8, 9, 2**62} and 11 not in {r.doc_id for r in kept}


def test_stages_run_on_awkward_rows(spark, tmp_path):
    documents(spark).write.parquet(f"{tmp_path}/documents.parquet")
    labels(spark).write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, str(tmp_path)).columns == docs.columns
    empty = docs.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, str(tmp_path)).count() == 0
    assert {"doc_id", "start", "sequence_id"} <= set(corpus_pipeline.run(spark, str(tmp_path)).columns)


def test_pages_and_chats_without_rows(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert html_text.extract(pages).collect() == []
    talks = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.digest_chats(chat.format_chats(chat.as_events(talks))).collect() == []


def test_packing_without_rows(spark):
    assert packing.pack(documents(spark, [])).collect() == []
