"""The pipeline on the smallest tables, each stage against what the stages before it kept."""

import os
import re

import pytest

import corpus_pipeline
from loomstar.llm import encoding, language_id, quality
from loomstar.llm.common import store, table

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def steps(spark):
    docs = table(spark, SF_DIR, "documents")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out.append(store(stage(spark, out[-1], SF_DIR), name))
    return out


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def sets(rows):
    out = {}
    for r in rows:
        w = re.findall(r"\w+", r.text.lower())
        out[r.doc_id] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))}
    return out


def test_the_stages_are_those_asked_for():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "language_id", "exact_dedup", "near_dedup", "packing"
    ]
    assert corpus_pipeline.ORACLE_SQL is None


def test_quality_keeps_what_the_rules_keep(spark, steps):
    judged = quality.quality_rules(steps[0], table(spark, SF_DIR, "labels")).collect()
    assert ids(steps[1]) == sorted(r.doc_id for r in judged if r.kept)
    assert 0 < len(ids(steps[1])) < len(ids(steps[0]))


def test_language_keeps_what_it_knows(steps):
    found = language_id.language_id(steps[1]).collect()
    want = [r.doc_id for r in found if r.lang_pred != "und" and r.score >= language_id.MIN_SCORE]
    assert ids(steps[2]) == sorted(want)


def test_exact_copies_by_brute_force(steps):
    best = {}
    for r in steps[2].collect():
        k = re.sub(r"[\x20\x09-\x0D]", "", r.text)
        best[k] = min(best.get(k, (1,)), (-len(r.text), r.doc_id))
    assert ids(steps[3]) == sorted(i for _, i in best.values())


def test_near_copies_by_brute_force(steps):
    own = sets(steps[3].collect())
    of = {i: i for i in own}
    for a in own:
        for b in own:
            if b < a and own[a] & own[b] and len(own[a] & own[b]) >= 0.8 * len(own[a] | own[b]):
                old, new = max(of[a], of[b]), min(of[a], of[b])
                of = {i: new if c == old else c for i, c in of.items()}
    assert ids(steps[4]) == sorted(set(of.values()))


def test_packing_holds_every_document_whole(spark, steps):
    pieces = corpus_pipeline.run(spark, SF_DIR).collect()
    special = dict(encoding.added_tokens(encoding.public("byte_bpe_50k.json")))
    encode = encoding.ByteEncoder(encoding.public("byte_bpe_50k.tiktoken"), special)
    tokens = {r.doc_id: len(encode(r.text)) // 2 + 1 for r in steps[4].collect()}
    found = dict.fromkeys(tokens, 0)
    for p in pieces:
        found[p.doc_id] += p.length
    assert found == tokens


def test_stages_keep_the_columns_of_documents(steps):
    assert all(s.columns == steps[0].columns for s in steps)
