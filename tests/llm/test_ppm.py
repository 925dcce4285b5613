import math
import zlib
from collections import Counter, defaultdict

import pytest

from loomstar.llm import ppm
from tests.llm.cases import documents, text

ROWS = [(k, text(30, k % 25), "aa") for k in range(40)] + [(50, None, "aa"), (51, "", "aa"), (52, "ÄB Ab\x00\tnew", "aa"), (57, "zzz", "aa")]


def low(t):
    return (t or "").encode().lower()


class Brute:
    """Prediction by partial matching, one symbol at a time."""

    def __init__(self, texts):
        counts = [Counter() for _ in range(ppm.ORDER + 1)]
        for t in texts:
            s = [ppm.START] * ppm.ORDER + list(t) + [ppm.END]
            for i in range(ppm.ORDER, len(s)):
                for k in range(ppm.ORDER + 1):
                    counts[k][tuple(s[i - k : i + 1])] += 1
        least = max(1, sum(counts[0].values()) * ppm.SHARE)
        self.total, self.after = Counter(), defaultdict(dict)
        for k, found in enumerate(counts):
            for g, n in found.items():
                self.total[g[:-1]] += n
                if n >= least:
                    self.after[g[:-1]][g[-1]] = n

    def log(self, context, symbol):
        out, excluded = 0.0, set()
        for k in range(ppm.ORDER, -1, -1):
            c = context[len(context) - k :]
            if c not in self.after:
                continue
            pruned = self.total[c] - sum(self.after[c].values())
            own = {s: n for s, n in self.after[c].items() if s not in excluded}
            whole = sum(own.values()) + pruned + len(own)
            if symbol in own:
                return out + math.log(own[symbol] / whole)
            if pruned + len(own):
                out += math.log((pruned + len(own)) / whole)
            excluded |= set(self.after[c])
        return out - math.log(ppm.SYMBOLS - len(excluded))

    def text(self, t):
        s = [ppm.START] * ppm.ORDER + list(t) + [ppm.END]
        return sum(self.log(tuple(s[i - ppm.ORDER : i]), s[i]) for i in range(ppm.ORDER, len(s))) / math.log(10)


@pytest.mark.parametrize("share, word_share", [(2.0**-18, 2.0**-20), (0.002, 0.01)])
def test_scores_equal_brute_force(spark, monkeypatch, share, word_share):
    monkeypatch.setattr(ppm, "SHARE", share)
    monkeypatch.setattr(ppm, "WORD_SHARE", word_share)
    rows = {r.doc_id: r for r in ppm.score(documents(spark, ROWS)).collect()}
    held = {k: zlib.crc32(str(k).encode()) % 7 == 2 for k, _, _ in ROWS}
    train = [low(t) for k, t, _ in ROWS if not held[k]]
    model = Brute(train)
    count = Counter(w for t in train for w in [*t.split(), None])
    n, v = sum(count.values()), len(count)
    for k, t, _ in ROWS:
        r, tokens = rows[k], [*low(t).split(), None]
        assert (r.held_out, r.n_tokens, r.train_tokens) == (held[k], len(tokens), n)
        assert r.n_known == sum(count[w] > 0 for w in tokens)
        assert r.base_score == pytest.approx(sum(math.log10((count[w] + 1) / (n + v + 1)) for w in tokens))
        assert r.score == pytest.approx(model.text(low(t)))


def test_predictions_sum_to_one():
    model = Brute([low(t) for _, t, _ in ROWS])
    for context in ((ppm.START,) * ppm.ORDER, tuple(b"ka l"), tuple(b"????")):
        assert sum(math.exp(model.log(context, s)) for s in range(ppm.SYMBOLS)) == pytest.approx(1)


def test_without_training_text_symbols_are_equally_likely(spark):
    held = next(k for k in range(100) if zlib.crc32(str(k).encode()) % 7 == 2)
    row = ppm.score(documents(spark, [(held, "ab c", "aa")])).first()
    assert row.score == pytest.approx(-5 * math.log10(ppm.SYMBOLS))
    assert (row.n_known, row.train_tokens, row.base_score) == (0, 0, 0.0)


def test_rare_strings_of_a_large_corpus_count(spark, monkeypatch):
    """More than 2^19 positions: strings seen once predict as well, be they looked up in a task or by a join."""
    rows = [(k, text(6_000, 1000 + k), "aa") for k in range(30)] + [(200, "qzj xq~ qzj", "aa"), (201, "qzj xq~ wv", "aa")]
    held = {k: zlib.crc32(str(k).encode()) % 7 == 2 for k, _, _ in rows}
    train = [low(t) for k, t, _ in rows if not held[k]]
    assert sum(map(len, train)) > 2**19 and held[200] and not held[201]
    got = {r.doc_id: r.score for r in ppm.score(documents(spark, rows)).collect()}
    monkeypatch.setattr(ppm, "SHARE", 0.0)
    model = Brute(train)
    for k, t, _ in rows[-2:] + rows[:2]:
        assert got[k] == pytest.approx(model.text(low(t)))


def test_scores_do_not_depend_on_what_is_broadcast(spark, monkeypatch):
    score = lambda: {r.doc_id: r.score for r in ppm.score(documents(spark, ROWS)).collect()}
    whole = score()
    for share in (0.001, 2.0):
        monkeypatch.setattr(ppm, "COMMON_SHARE", share)
        assert score() == pytest.approx(whole)
