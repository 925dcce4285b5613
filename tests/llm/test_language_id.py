import zlib

import numpy as np

from loomstar.llm import language_id
from tests.llm.cases import documents, text


def make(lang, n, first):
    sounds = {"aa": str.maketrans("", ""), "bb": str.maketrans("aiou", "äyöü"), "cc": str.maketrans("klmr", "жшщц")}
    return [(first + k, text(30, first + k).translate(sounds[lang]), lang) for k in range(n)]


ROWS = make("aa", 40, 0) + make("bb", 40, 100) + make("cc", 40, 200) + [(300, None, "aa"), (301, "12 --", "bb"), (302, "ж", None)]


def test_held_out_accuracy(spark):
    rows = {r.doc_id: r for r in language_id.language_id(documents(spark, ROWS)).collect()}
    for doc_id, _, lang in ROWS:
        r = rows[doc_id]
        assert r.held_out == (zlib.crc32(str(doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1
        if doc_id < 300:
            assert r.lang_pred == lang
    assert (rows[300].lang_pred, rows[300].score) == ("und", 0.0) == (rows[301].lang_pred, rows[301].score)
    assert rows[302].lang_pred in {"aa", "bb", "cc"}  # one letter is enough for a guess


def test_bundles_equal_letter_by_letter_binding():
    texts = ["Ab  cab.", "", "é1é", None]
    got = language_id.bundles(texts, np.arange(4), 4)
    vector = lambda c: language_id.letter_vectors(np.array([ord(c)], np.uint32))[0].astype(int)
    want = np.zeros((4, language_id.DIMENSIONS))
    for k, t in enumerate([" ab cab ", "", " é é ", ""]):
        for a in range(len(t) - 2):
            if t[a : a + 3].strip():
                want[k] += vector(t[a]) * np.roll(vector(t[a + 1]), 1) * np.roll(vector(t[a + 2]), 2)
    assert (got == want).all()


def test_grouping_and_chunks_do_not_matter(monkeypatch):
    texts = [text(50, k) for k in range(6)]
    whole = language_id.bundles(texts, np.zeros(6, int), 1)
    monkeypatch.setattr(language_id, "CHUNK", 7)
    assert (sum(language_id.bundles([t], np.zeros(1, int), 1) for t in texts) == whole).all()


def test_without_languages_all_is_undetermined(spark):
    rows = language_id.language_id(documents(spark, [(1, "some text", None), (2, "more", None)])).collect()
    assert {(r.lang_pred, r.score) for r in rows} == {("und", 0.0)}


def test_marks_without_a_letter_have_no_language():
    names, vectors = ["aa"], np.ones((1, language_id.DIMENSIONS)) / language_id.DIMENSIONS**0.5
    lang, score = language_id.predict(["́̂ ́̂̃", "éa", None, ""], names, vectors)
    assert lang == ["und", "aa", "und", "und"] and score[0] == 0.0
