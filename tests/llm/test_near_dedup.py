import random
import re
from collections import Counter

import numpy as np
import pytest

from loomstar.llm import near_dedup
from loomstar.llm.components import components
from tests.llm.cases import documents, words


def variant(w, edits, seed):
    """The words with a few of them replaced."""
    pick, out = random.Random(seed), list(w)
    for k in range(edits):
        out[pick.randrange(len(out))] = f"new{seed}x{k}"
    return " ".join(out)


def brute(rows):
    sets = []
    for _, t, _ in rows:
        w = re.findall(r"\w+", (t or "").lower())
        sets.append({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    of = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            union = len(sets[a] | sets[b])
            if union and len(sets[a] & sets[b]) / union >= 0.8:
                old, new = max(of[a], of[b]), min(of[a], of[b])
                of = [new if x == old else x for x in of]
    return {r[0]: min(rows[k][0] for k in range(len(rows)) if of[k] == of[a]) for a, r in enumerate(rows)}


BASE = [words(150, k) for k in range(3)]
# Variants of a base lie within 0.8 of it, but mostly not of each other: the base links them.
ROWS = [(k, variant(BASE[0], 3, k), "aa") for k in range(40)] + [(40, " ".join(BASE[0]), "aa")]
ROWS += [(50 + k, variant(BASE[1], 2, 50 + k), "aa") for k in range(6)]
ROWS += [(60 + k, " ".join(BASE[2]).upper() + "." * k, "aa") for k in range(12)]
ROWS += [(80, variant(BASE[2], 2, 80), "aa"), (81, variant(BASE[2], 20, 81), "aa"), (82, None, "aa"), (83, "", "aa")]
ROWS += [(84, "two words", "aa"), (85, "Two, words!", "aa"), (86, "two other", "aa")]
ROWS += [(90 + k, " ".join(words(60, 500 + k)), "aa") for k in range(30)]
# A second hub whose variants reach only each other, and texts that are part of a base.
ROWS += [(130 + k, variant(variant(BASE[0], 9, 777).split(), 1, 130 + k), "aa") for k in range(12)]
ROWS += [(150 + k, " ".join(BASE[0][: 100 + 4 * k]), "aa") for k in range(12)]


@pytest.mark.parametrize("small", [8, 2])
def test_classes_equal_brute_force(spark, monkeypatch, small):
    monkeypatch.setattr(near_dedup, "SMALL_BUCKET", small)
    rows = near_dedup.near_dedup(documents(spark, ROWS)).collect()
    want = brute(ROWS)
    assert {r.doc_id: r.class_id for r in rows} == want
    sizes = Counter(want.values())
    assert all(r.class_size == sizes[r.class_id] and r.kept == (r.doc_id == r.class_id) for r in rows)


def test_repeated_rows_leave_one(spark):
    rows = [(1, " ".join(BASE[0]), "aa")] * 3 + [(None, variant(BASE[0], 1, 1), "aa")]
    docs = documents(spark, rows)
    assert sorted((str(r.class_id), r.kept) for r in near_dedup.near_dedup(docs).collect()) == [("1", False)] * 3 + [("1", True)]
    assert [r.doc_id for r in near_dedup.drop_near_copies(docs).collect()] == [1]


def test_signatures_estimate_probability_jaccard():
    """Components agree as often as the probability Jaccard similarity of weighted sets says."""
    x, y = {1: 3, 2: 1, 3: 2, 4: 1}, {1: 1, 2: 2, 3: 2, 5: 1}
    jp = sum(1 / sum(max(x.get(j, 0) / x[i], y.get(j, 0) / y[i]) for j in {*x, *y}) for i in {*x} & {*y})
    agree = n = 0
    for trial in range(150):
        h = near_dedup.mix(np.array([*x, *y], np.uint64) + np.uint64(1000 * trial))
        s = near_dedup.signatures(h, np.repeat([0, 1], 4), np.array([*x.values(), *y.values()]), 2)
        agree, n = agree + (s[0] == s[1]).sum(), n + s.shape[1]
    assert abs(agree / n - jp) < 0.02


def test_early_end_changes_nothing():
    """Letting every shingle run on gives the same signature."""
    h, times = near_dedup.mix(np.arange(40, dtype=np.uint64)), np.arange(40) % 3 + 1
    got = near_dedup.signatures(h, np.zeros(40, int), times, 1)[0]
    m = near_dedup.BANDS * near_dedup.ROWS
    best, kept = np.full(m, np.inf), np.zeros(m, np.uint64)
    for x, w in zip(h, times):
        clock = 0.0
        for arrival in range(1, 400):
            draw = near_dedup.mix(np.array([x]) + np.array([arrival], np.uint64) * near_dedup._STEP)
            clock -= np.log1p(-float(draw[0] >> np.uint64(11)) * 2.0**-53) / w
            at = int(near_dedup.mix(draw)[0] % np.uint64(m))
            if clock < best[at]:
                best[at], kept[at] = clock, x
    assert (got == kept).all()


def test_components_of_chains_and_stars(spark):
    links = [(k, k + 1) for k in range(30)] + [(100, 100 + k) for k in range(1, 50)] + [(7, 3), (500, 500)]
    found = {r.unit: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {**{k: 0 for k in range(31)}, **{100 + k: 100 for k in range(50)}}


def test_passages_repeated_often_hide_no_link(spark):
    """Pairs at a set similarity of 0.8 or more, of which one text repeats its own part 100 times."""
    rows = []
    for k in range(30):
        shared, own = words(420, 9000 + k), [f"own{k}x{j}" for j in range(60)]
        rows += [(2 * k, " ".join(shared), "aa"), (2 * k + 1, " ".join(shared + own * 100), "aa")]
    want = brute(rows)
    assert all(want[2 * k + 1] == 2 * k for k in range(30))
    assert {r.doc_id: r.class_id for r in near_dedup.near_dedup(documents(spark, rows)).collect()} == want
