import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from loomstar.llm import alignment
from tests.llm.cases import DOCUMENTS, documents, text

ALPHABET = " ab\n\té漢🙂<s>\x00​ 　'.1\r"


def odd(n, seed):
    pick = random.Random(seed)
    more = ["<s>", "</s>", "<unk>", "<0x41>", "the", "<|endoftext|>", "▁"]
    draw = lambda: pick.choice(ALPHABET) if pick.random() < 0.93 else pick.choice(more)
    return ["".join(draw() for _ in range(pick.randint(1, 30))) for _ in range(n)]


def byte_of_letter():
    """The byte that each letter of a byte-level vocabulary stands for."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {**{chr(b): b for b in plain}, **{chr(256 + k): b for k, b in enumerate(other)}}


def tokens(rows):
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    letters = byte_of_letter()
    spell = lambda k: bytes([int(b.id_to_piece(k)[3:5], 16)]) if b.is_byte(k) else b.id_to_piece(k).replace("▁", " ").encode()
    for t in rows:
        if not t:
            yield [], []
            continue
        one, two = a.encode(" " + t, add_special_tokens=False), b.encode(t)
        left = [(k, bytes(letters[c] for c in s)) for k, s in zip(one.ids, one.tokens)]
        right = [(k, spell(k)) for k in two]
        same = all(b"".join(s for _, s in side) == (" " + t).encode() for side in (left, right))
        yield (left, right) if same else ([], [])


def groups(left, right):
    ends = [np.cumsum([len(s) for _, s in side]).tolist() for side in (left, right)]
    cuts, out, at = sorted(set(ends[0]) & set(ends[1])), [], [0, 0]
    for cut in cuts:
        group = ([], [])
        for side, tokens_ in enumerate((left, right)):
            while at[side] < len(tokens_) and ends[side][at[side]] <= cut:
                group[side].append(tokens_[at[side]][0])
                at[side] += 1
        out.append(group)
    return out


def brute(rows):
    cut = [groups(*sides) for sides in tokens(rows)]
    link = [[(a, b) for x, y in g for a in x for b in y] for g in cut]
    count = Counter(p for own in link for p in set(own))
    best = {}
    for (a, _), n in count.items():
        best[a] = max(best.get(a, 0), n)
    line = lambda g: ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in g)
    return [
        (sum(len(x) for x, _ in g), sum(len(y) for _, y in g), len(g), len(own), sum(count[p] == best[p[0]] for p in own),
         sum(count[p] for p in own), hashlib.sha256(line(g).encode()).hexdigest() if g else "")
        for g, own in zip(cut, link)
    ]


ROWS = [r for r in DOCUMENTS if r[0] != 8] + [(100 + k, t, "aa") for k, t in enumerate(odd(300, 5))]
ROWS += [(900, text(1500, 3), "aa"), (901, "漢字仮名" * 300, "aa"), (902, "a▁b", "aa"), (903, " lead  and two ", "aa")]


@pytest.mark.parametrize("share, links", [(2.0**-20, 1 << 16), (2.0**-6, 3), (1.0, 1)])
def test_equal_to_brute_force(spark, monkeypatch, share, links):
    """Whether pairs travel or are joined, and groups are laid out or combined first."""
    monkeypatch.setattr(alignment, "COMMON_SHARE", share)
    monkeypatch.setattr(alignment, "GROUP_LINKS", links)
    want = sorted((str(r[0]), *found) for r, found in zip(ROWS, brute([r[1] for r in ROWS])))
    got = alignment.links(documents(spark, ROWS)).collect()
    columns = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted((str(r.doc_id), *(r[c] for c in columns)) for r in got) == want


def test_aligned_ids_and_flags(spark):
    r = alignment.align(documents(spark, [(1, "Onwards, onwards", "aa")])).collect()[0]
    assert sum(r.a_last) == sum(r.b_last) and len(r.a_ids) == 2 * len(r.a_last) and len(r.b_ids) == 2 * len(r.b_last)
    assert alignment.groups_text(r.a_ids, r.b_ids, r.a_last, r.b_last).count(";") == sum(r.a_last) - 1


@pytest.mark.parametrize("seed", range(30))
def test_run_skipping_finds_every_common_end(seed):
    pick = np.random.default_rng(seed)
    n = int(pick.integers(1, 400))
    draw = lambda p: np.union1d(np.flatnonzero(pick.random(n) < p) + 1, [n])
    a = draw(pick.choice([0.1, 0.5, 1.0]))
    b = np.union1d(a[pick.random(len(a)) < pick.choice([0.0, 0.5, 0.95])], [n]) if seed % 2 else draw(0.5)
    last_a, last_b = alignment.last_flags(a, b)
    common = np.intersect1d(a, b).tolist()
    assert a[np.frombuffer(last_a, np.uint8) == 1].tolist() == common == b[np.frombuffer(last_b, np.uint8) == 1].tolist()


def test_no_rows(spark):
    assert alignment.links(documents(spark, [])).collect() == []
