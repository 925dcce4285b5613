import re

import pytest

from loomstar.llm import decontaminate
from tests.llm.cases import DOCUMENTS, documents, words

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def split(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def brute(docs, items):
    windows = {}
    for item, text in items:
        w = split(text)
        for k in range(max(1, len(w) - 9)) if w else ():
            windows.setdefault(tuple(w[k : k + 10]), set()).add("" if item is None else str(item))
    out = []
    for doc_id, text in docs:
        w, hit, found = split(text), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                own = windows.get(tuple(w[k : k + n]))
                if own:
                    hit.update(range(k, k + n))
                    found |= own
        out.append((str(doc_id), len(w), len(hit), sorted(found)))
    return sorted(out, key=str)


ITEM = words(30, 70)
ITEMS = [
    (1, " ".join(ITEM)), (2, "Ka, LO!"), (3, None), (None, ""), (None, " ".join(words(11, 71))), (2, "vo vo vo"),
    (4, " ".join(ITEM[5:25])), (10, "!!!"), (11, "Éa ñu 漢字 x1"), (12, " ".join(words(10, 72)) + " ka lo"),
]
ROWS = [r[:2] for r in DOCUMENTS] + [
    (50, "Before " + ", ".join(ITEM[3:20]).upper() + " after"), (51, " ".join(ITEM[3:12])), (52, "ka-lo ka lo"),
    (53, "vo vo vo vo vo"), (54, "x éa ñu 漢字 X1"), (55, "Éa ñu 漢字 x1 y"), (56, " ".join(ITEM) * 3), (57, " ".join(words(10, 72))),
]


def benchmark(spark, rows=ITEMS):
    return spark.createDataFrame(rows, "item_id long, text string").selectExpr("*", "'x' as item", "0 as window", "'y' as words")


def docs(spark, rows=ROWS):
    return documents(spark, [(a, b, "aa") for a, b in rows])


@pytest.mark.parametrize("most", [60_000, 7])
def test_equal_to_brute_force_in_one_automaton_and_in_many(spark, monkeypatch, most):
    monkeypatch.setattr(decontaminate, "MAX_WINDOWS", most)
    rows = decontaminate.decontaminate(docs(spark), benchmark(spark)).collect()
    got = sorted(((str(r.doc_id), r.n_words, r.n_hit, list(r["items"])) for r in rows), key=str)
    assert got == brute(ROWS, ITEMS)
    assert all(r.n_items == len(r["items"]) and r.contaminated == (r.n_hit > 0) for r in rows)
    text = dict(ROWS)
    for r in rows:
        assert sum(len(split(text[r.doc_id][s.start : s.end])) for s in r.spans) == r.n_hit


def test_offsets_are_those_of_the_original_text(spark):
    (r,) = decontaminate.decontaminate(docs(spark, [(1, "🙂 É! KA,\n lo - tail")]), benchmark(spark)).collect()
    assert [(s.start, s.end) for s in r.spans] == [(5, 12)]


def test_no_rows_and_no_items(spark):
    assert decontaminate.decontaminate(docs(spark, []), benchmark(spark)).collect() == []
    rows = decontaminate.decontaminate(docs(spark), benchmark(spark, [])).collect()
    assert len(rows) == len(ROWS) and not any(r.contaminated or r["items"] or r.spans for r in rows)


def test_many_words_and_matches_at_every_place():
    """More words than one alphabet holds, and windows within windows."""
    known = [f"w{k}" for k in range(40_000)]
    scan = decontaminate.Scanner({b"a": ["1"], b"a a": ["2"], **{w.encode(): ["3"] for w in known}})
    assert scan([b"a"] * 5 + [b"b"] + [known[-1].encode()] + [b"b"]) == ([(0, 5), (6, 7)], {"1", "2", "3"})
