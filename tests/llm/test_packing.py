import zlib
from collections import defaultdict

import numpy as np
import pytest
import public_tokenizers
from tokenizers import Tokenizer

from loomstar.llm import packing
from tests.llm.cases import DOCUMENTS, documents, text

ROWS = [r for r in DOCUMENTS if r[0] not in (None, 2)] + [(100 + k, text(20 + 9 * k, k), "aa") for k in range(60)]
ROWS += [(310, "<|endoftext|>", "aa"), (311, "a <|endoftext|> b<|endoftext|><|endoftext|", "aa"), (312, " <|endoftext|>c  d", "aa")]
ROWS += [(300, "a  b   c\n\n d \te\r\n f", "aa"), (301, " lead", "aa"), (302, "trail ", "aa"), (303, "it's we'll 1234 é x", "aa")]


@pytest.fixture(scope="module")
def ids():
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return {k: tokenizer.encode(t or "", add_special_tokens=False).ids + [0] for k, t, _ in ROWS}


@pytest.mark.parametrize("shard", [1000, 7])
def test_every_id_lies_in_one_piece(spark, ids, monkeypatch, shard):
    monkeypatch.setattr(packing, "SHARD_DOCUMENTS", shard)
    pieces = packing.pack(documents(spark, ROWS)).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append(p)
        assert np.frombuffer(p.ids, "<u2").tolist() == ids[p.doc_id][p.start : p.start + p.length]
        assert p.ids_crc32 == zlib.crc32(np.frombuffer(p.ids, "<u2").astype("<u4").tobytes())
        assert p.doc_tokens == len(ids[p.doc_id])
    assert set(by_doc) == set(ids)
    for k, own in by_doc.items():
        own.sort(key=lambda p: p.start)
        assert [p.start for p in own] == [sum(q.length for q in own[:n]) for n in range(len(own))]
        assert sum(p.length for p in own) == len(ids[k])
    for own in by_sequence.values():
        own.sort(key=lambda p: p.offset)
        assert [p.offset for p in own] == [sum(q.length for q in own[:n]) for n in range(len(own))]
        assert sum(p.length for p in own) <= packing.WINDOW
    if shard == 1000:
        short = [own for own in by_sequence.values() if sum(p.length for p in own) < packing.WINDOW]
        assert len(short) <= 4  # one for each partition at most


def test_neighbours_are_the_best_unused_by_bm25():
    """A seed's window holds the texts that share its rare ids."""
    topic = lambda k, n: (0, np.array([1000 + k] * n + [5], "<u2").tobytes())
    items = [topic(k % 3, 200) for k in range(12)]
    documents_ = np.zeros(packing.VOCABULARY, np.int64)
    documents_[[1000, 1001, 1002]], documents_[5] = 4, 12
    placed = packing.pack_shard(items, documents_, 12)
    windows = defaultdict(set)
    for k, _, _, window, _ in placed:
        windows[window].add(k % 3)
    assert windows[0] >= {0} and [p[0] % 3 for p in placed[:4]] == [0] * 4


def test_all_ids_of_a_seed_take_part():
    """40 ids that only the seed holds do not crowd out the one it shares."""
    item = lambda *own: (0, np.array(own, "<u2").tobytes())
    items = [item(*range(2000, 2040), 7)] + [item(*range(3000 + 30 * k, 3030 + 30 * k)) for k in range(60)]
    items += [item(7, *range(9000, 9030))]
    documents_ = np.zeros(packing.VOCABULARY, np.int64)
    for _, x in items:
        documents_[np.unique(np.frombuffer(x, "<u2"))] += 1
    placed = packing.pack_shard(items, documents_, len(items))
    assert [p[0] for p in placed[:2]] == [0, 61]


def recall_of_top(texts, size, k=5):
    """Share of each text's k best by BM25 over all that lie in its own shard, and the share of their scores found there."""
    n = len(texts)
    documents_ = np.zeros(packing.VOCABULARY, np.int64)
    for x in texts:
        documents_[np.unique(np.frombuffer(x, "<u2"))] += 1
    centers = packing.fit_centroids(texts[: packing.SAMPLE], documents_, n)
    near = packing._nearest(packing._vectors(texts, documents_, n), centers)
    shard = np.empty(n, int)
    shard[np.lexsort((packing._sketches(texts, documents_), near))] = np.arange(n) // size
    used = np.flatnonzero(documents_)
    tf = np.stack([np.bincount(np.frombuffer(x, "<u2"), minlength=packing.VOCABULARY)[used] for x in texts]).astype(float)
    df, length = documents_[used], tf.sum(axis=1)
    idf = np.log1p((n - df + 0.5) / (df + 0.5))
    weight = tf * (packing.K1 + 1) / (tf + packing.K1 * (1 - packing.B + packing.B * length / length.mean())[:, None]) * idf
    score = (tf > 0) @ weight.T
    np.fill_diagonal(score, -1)
    found, share = [], []
    for s in range(n):
        best = np.argsort(-score[s], kind="stable")[:k]
        own = np.sort(score[s][(shard == shard[s]) & (np.arange(n) != s)])[-k:]
        found.append(np.mean(shard[best] == shard[s]))
        share.append(own.sum() / max(score[s][best].sum(), 1e-9))
    return np.mean(found), np.mean(share)


def test_neighbours_of_a_topic_lie_in_one_of_many_shards():
    """Against BM25 over all shards: texts of 12 topics among common words, dealt into 12 shards."""
    pick = np.random.default_rng(8)
    common, topics = np.arange(100, 160), [np.arange(1000 + 40 * t, 1040 + 40 * t) for t in range(12)]
    texts = [
        np.concatenate([pick.choice(common, 80), pick.choice(topics[k % 12], 60)]).astype("<u2").tobytes() for k in range(600)
    ]
    recall, share = recall_of_top(texts, 50)
    assert recall >= 0.9 and share >= 0.95


def test_shards_without_topics_hold_neighbours_nearly_as_good_as_the_best():
    """Texts of one language: the five best of all are spread over all shards, those found score nearly as high."""
    texts = [np.frombuffer(x, "<u2")[:500].tobytes() for x in packing.byte_encoder(packing.public("byte_bpe_50k.tiktoken"), ()).many(
        [text(60 + 7 * (k % 20), k) for k in range(400)]
    )]
    recall, share = recall_of_top(texts, 100)
    assert share >= 0.9 and recall > 0.25  # a quarter is chance
