import math
from collections import Counter

import numpy as np

from loomstar.llm import quality
from loomstar.llm.words import hashed, mix, windows
from tests.llm.cases import documents, labels, text, words

TRUSTED = [(k, text(80, k), "aa") for k in range(30)]
JUNK = [(100 + k, " ".join(w + "###" for w in words(80, 50 + k)), "aa") for k in range(8)]
REPEATED = [(200, " ".join(words(12, 9) * 6), "aa"), (201, "one line\nother\none line\n\n\none line", "aa"), (202, text(19, 3), "aa")]
ROWS = TRUSTED + JUNK + REPEATED


def judged(spark):
    given = labels(spark, [(k, 1) for k in range(30)])
    return {r.doc_id: r for r in quality.quality_rules(documents(spark, ROWS), given).collect()}


def test_base_rules_equal_brute_force(spark):
    rows = judged(spark)
    for doc_id, t, _ in ROWS:
        w = [x for x in t.replace("\t", " ").replace("\n", " ").split(" ") if x]
        seen = Counter(tuple(w[k : k + 8]) for k in range(len(w) - 7))
        inside = {k + j for k in range(len(w) - 7) if seen[tuple(w[k : k + 8])] > 1 for j in range(8)}
        lines = [x for x in t.split("\n") if x.split()]
        r = rows[doc_id]
        assert (r.n_words, r.word_chars) == (len(w), sum(map(len, w)))
        assert r.n_symbols == sum(c in "#*$%&|<>" for c in t)
        assert r.n_dup_lines == len(lines) - len(set(lines))
        assert r.n_repeat_words == len(inside)
        assert r.base_failed == (len(w) < 20 or 100 * len(inside) > 30 * len(w))


def test_scores_equal_brute_force(spark):
    rows = judged(spark)
    cells = {}
    for doc_id, t, _ in ROWS:
        one = hashed(t.encode().split())
        two, _, _ = windows(one, np.array([len(one)]), 2)
        cells[doc_id] = Counter([int(x) for x in mix(one) % np.uint64(quality.CELLS)] + [int(x) for x in two % np.uint64(quality.CELLS)])
    raw, good = Counter(), Counter()
    for doc_id, c in cells.items():
        raw += c
        if doc_id < 30:
            good += c
    scale = sum(raw.values()) / sum(good.values())
    for doc_id, c in cells.items():
        s = sum(
            n * (math.log(good[x] * scale + quality.SMOOTHING) - math.log(raw[x] - n + quality.SMOOTHING)) for x, n in c.items()
        ) / sum(c.values())
        assert abs(rows[doc_id].score - s) < 1e-9


def test_trusted_stays_and_junk_goes(spark):
    rows = judged(spark)
    assert all(rows[k].kept for k in range(30))
    assert not any(rows[k].kept for k in range(100, 108)) and not rows[200].kept


def test_without_trusted_text_base_rules_decide(spark):
    rows = quality.quality_rules(documents(spark, ROWS), labels(spark, [])).collect()
    assert all(r.score == 0 and r.kept == (not r.base_failed) for r in rows)


def test_an_id_called_bad_once_is_not_trusted(spark):
    assert {r.doc_id for r in quality.trusted_ids(labels(spark)).collect()} == {1, 2, 8}
