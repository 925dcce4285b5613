"""Sampled piece segmentations: forward filtering, backward sampling over the piece lattice.

A text's lattice has an edge for every piece of the vocabulary that stands somewhere in it.
A segmentation is drawn with probability proportional to the product of its pieces'
weights: forwards, the weights of all paths to each place are summed; backwards from the
end, each last piece is drawn in proportion to the paths it closes.  Draws depend on the
seed, the row key and the place alone, so any rerun on any cluster gives the same ids.

Pieces hold the blank mark at their beginning only, so the lattice falls apart at blanks
and words are filtered once however often they occur; their draws stay independent.  A long
run without a blank is filtered on its own, block by block, whatever its length.
Characters that no piece has become byte pieces, as does the blank mark itself where a text
has it, so decoding gives back every text exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import exp, log

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomstar.llm.common import bounded, narrow, text_md5
from loomstar.llm.words import mix

SEED = 7
#: Weights are (1 + rank) ** -SHARPNESS; larger values draw fewer, commoner pieces.
SHARPNESS = 1.0
#: Nodes of one lattice, 130 bytes each.
NODES = 500_000
#: Longer runs without a blank are filtered one character after another, in blocks of BLOCK
#: characters, and keep 8 bytes a character.
LONG, BLOCK = 256, 1 << 16
#: Characters whose lattices are built from one set of arrays, about 100 bytes each.
CHARACTERS = 2_000_000

_BLANK, _MARK, _LITERAL = 0x20, 0x2581, 0x110000  # fixed values: blank, blank mark, a stand-in for a mark in a text
_STEP = np.uint64(0x9E3779B97F4A7C15)  # fixed value: an odd 64-bit multiplier


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Vocabulary:
    """The pieces of a model as a trie of code points, and what each id decodes to."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.bytes: list[bytes] = []
        self.byte_ids = np.full(256, -1)
        nodes: dict[tuple[int, int], int] = {}
        ends: dict[int, tuple[int, float]] = {}
        letters, self.longest = set(), 1
        for id_ in range(size):
            piece = model.id_to_piece(id_)
            if model.is_byte(id_):
                value = int(piece[3:5], 16)
                self.byte_ids[value] = id_
                self.bytes.append(bytes([value]))
                continue
            if model.is_control(id_) or model.is_unknown(id_):
                self.bytes.append(b"")
                continue
            self.bytes.append(piece.replace(chr(_MARK), " ").encode())
            if chr(_MARK) in piece.lstrip(chr(_MARK)):
                continue  # would cross a word's beginning
            rank = min(-model.get_score(id_), size)
            node = 0
            for c in map(ord, piece):
                node = nodes.setdefault((node, c), len(nodes) + 1)
                letters.add(c)
            ends[node] = id_, -SHARPNESS * np.log1p(rank)
            self.longest = max(self.longest, len(piece))
        steps = sorted((node << 21 | c, child) for (node, c), child in nodes.items())
        self.keys = np.array([k for k, _ in steps], np.int64)
        self.children = np.array([c for _, c in steps], np.int64)
        self.id_at, self.weight_at = np.full(len(nodes) + 1, -1), np.full(len(nodes) + 1, -np.inf)
        for node, (id_, weight) in ends.items():
            self.id_at[node], self.weight_at[node] = id_, weight
        self.byte_weight = -SHARPNESS * np.log1p(size)
        self.letters = np.zeros(_LITERAL + 1, bool)
        self.letters[list(letters)] = True

    def step(self, nodes: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Children by code point; -1 where there is none."""
        wanted = nodes << 21 | codes
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.children[at], -1)


@lru_cache(2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def _chunks(codes: np.ndarray, starts_of_texts: np.ndarray, letters: np.ndarray) -> np.ndarray:
    """Where chunks begin: at texts, at runs of blanks, and around characters that no piece has."""
    begin = np.zeros(len(codes), bool)
    begin[starts_of_texts] = True
    blank = codes == _MARK
    begin[1:] |= blank[1:] & ~blank[:-1]
    foreign = ~letters[codes]
    begin |= foreign
    begin[1:] |= foreign[:-1]
    return np.flatnonzero(begin)


def _unique(codes: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(chunk -> number of its distinct chunk, a chunk that represents each)."""
    place = np.arange(len(codes)) - np.repeat(start, length)
    h = np.add.reduceat(mix(codes.astype(np.uint64) * _STEP + place.astype(np.uint64) + np.uint64(1)), start)
    of, _ = pd.factorize(mix(h + length.astype(np.uint64)))
    first = np.full(of.max() + 1, -1)
    first[of[::-1]] = np.arange(len(of))[::-1]
    # equal hashes must be equal texts; a chunk that differs stands for itself
    same = length[first[of]] == length
    twin = np.repeat(start[first[of]], length) + place
    differs = codes[np.minimum(twin, len(codes) - 1)] != codes
    same &= np.add.reduceat(differs, start, dtype=np.int64) == 0
    odd = np.flatnonzero(~same)
    of[odd] = len(first) + np.arange(len(odd))
    return of, np.concatenate([first, odd])


def _lattice(vocab: Vocabulary, codes: np.ndarray, start: np.ndarray, length: np.ndarray):
    """Filter some distinct chunks, given in order of falling length.

    Returns each chunk's first node, and for every node and piece length L the share of
    paths to the node whose last piece is at most L long, with the id of the piece of
    length L.  A chunk of n characters has n + 1 nodes.
    """
    sizes = length + 1
    base = np.cumsum(sizes) - sizes
    nodes = int(sizes.sum())
    weight = np.full((vocab.longest, nodes), -np.inf, np.float32)
    ids = np.full((vocab.longest, nodes), -1, np.int32)
    flat = np.repeat(start - (np.cumsum(length) - length), length) + np.arange(int(length.sum()))
    node = np.repeat(base - (np.cumsum(length) - length), length) + np.arange(len(flat))
    room = np.repeat(start + length, length) - flat
    at, state = np.arange(len(flat)), np.zeros(len(flat), np.int64)
    for k in range(vocab.longest):
        state = vocab.step(state, codes[flat[at] + k])
        at, state = at[state >= 0], state[state >= 0]
        ends = vocab.id_at[state] >= 0
        weight[k, node[at[ends]] + k + 1] = vocab.weight_at[state[ends]]
        ids[k, node[at[ends]] + k + 1] = vocab.id_at[state[ends]]
        on = room[at] > k + 1
        at, state = at[on], state[on]
    # a character that is no piece itself: its bytes
    alone = node[ids[0, node + 1] < 0] + 1
    c = codes[flat[ids[0, node + 1] < 0]]
    count = 1 + (c >= 0x80) + (c >= 0x800) + ((c >= 0x10000) & (c < _LITERAL))
    weight[0, alone] = count * vocab.byte_weight
    ids[0, alone] = -2

    alpha = np.full(nodes, -np.inf)
    alpha[base] = 0.0
    share = np.zeros((vocab.longest, nodes), np.float32)
    active = len(length)
    for t in range(1, int(length.max(initial=0)) + 1):
        active = int(np.searchsorted(-length[:active], -t, side="right"))
        here = base[:active] + t
        reach = min(t, vocab.longest)
        paths = np.stack([alpha[here - k - 1] + weight[k, here] for k in range(reach)])
        top = paths.max(axis=0)
        sums = np.cumsum(np.exp(paths - top), axis=0)
        alpha[here] = top + np.log(sums[-1])
        # from the last possible piece on, the share is above any draw
        last = reach - 1 - np.argmax(np.isfinite(paths)[::-1], axis=0)
        part = sums / sums[-1]
        part[np.arange(reach)[:, None] >= last[None, :]] = 2.0
        share[:reach, here] = part
    return base, share, ids


def _edges(vocab: Vocabulary, codes: np.ndarray, lo: int, hi: int) -> tuple[list[int], list[int], list[int], list[float]]:
    """Pieces of a run that end at nodes lo + 1 to hi: (first piece of each node, length - 1, id, weight), shorter ones first."""
    begin = np.arange(max(0, lo - vocab.longest + 1), hi)
    state, places = np.zeros(len(begin), np.int64), begin
    found = []
    for k in range(vocab.longest):
        state = vocab.step(state, codes[places + k])
        places, state = places[state >= 0], state[state >= 0]
        ends = vocab.id_at[state] >= 0
        found.append((places[ends] + k + 1, np.full(int(ends.sum()), k), vocab.id_at[state[ends]], vocab.weight_at[state[ends]]))
        on = places + k + 1 < hi
        places, state = places[on], state[on]
    # a character that is no piece itself: its bytes
    single = np.zeros(hi + 1, bool)
    single[found[0][0]] = True
    alone = begin[~single[begin + 1]]
    c = codes[alone]
    count = 1 + (c >= 0x80) + (c >= 0x800) + ((c >= 0x10000) & (c < _LITERAL))
    found.append((alone + 1, np.zeros(len(alone), np.int64), np.full(len(alone), -2), count * vocab.byte_weight))
    node, k, id_, weight = (np.concatenate(x) for x in zip(*found))
    own = node > lo
    order = np.lexsort((k[own], node[own]))
    first = np.searchsorted(node[own][order], np.arange(lo + 1, hi + 2))
    return first.tolist(), k[own][order].tolist(), id_[own][order].tolist(), weight[own][order].tolist()


def _long_filter(vocab: Vocabulary, codes: np.ndarray) -> np.ndarray:
    """Logarithm of the weight of all paths to each node of one run."""
    alpha = np.zeros(len(codes) + 1)
    near: list[float] = [0.0]  # of the last nodes
    for lo in range(0, len(codes), BLOCK):
        hi = min(lo + BLOCK, len(codes))
        first, k, _, weight = _edges(vocab, codes, lo, hi)
        held = len(near)
        for t in range(hi - lo):
            end = held + t - 1
            paths = [near[end - k[e]] + weight[e] for e in range(first[t], first[t + 1])]
            top = max(paths)
            near.append(top + log(sum([exp(x - top) for x in paths])) if len(paths) > 1 else top)
        alpha[lo + 1 : hi + 1] = near[held:]
        near = near[-vocab.longest :]
    return alpha


def _long_draw(vocab: Vocabulary, codes: np.ndarray, alpha: np.ndarray, seed: np.uint64, shift: int) -> np.ndarray:
    """Ids of one segmentation of a run at the places where their pieces begin, -1 elsewhere."""
    drawn = np.full(len(codes), -1, np.int32)
    at = len(codes)
    for lo in range((at - 1) // BLOCK * BLOCK, -1, -BLOCK):
        hi = min(lo + BLOCK, len(codes))
        first, k, ids, weight = _edges(vocab, codes, lo, hi)
        left = max(0, lo - vocab.longest)
        near = alpha[left : hi + 1].tolist()
        draw = mix(seed + (shift + np.arange(lo + 1, hi + 1)).astype(np.uint64) * _STEP)
        u = ((draw >> np.uint64(11)).astype(float) * 2.0**-53).tolist()
        while at > lo:
            e, last = first[at - lo - 1], first[at - lo] - 1
            rest, total = u[at - lo - 1], near[at - left]
            while e < last:
                rest -= exp(near[at - left - k[e] - 1] + weight[e] - total)
                if rest < 0:
                    break
                e += 1
            at -= k[e] + 1
            drawn[at] = ids[e]
    return drawn


def sample(vocab: Vocabulary, texts: list[str], keys: np.ndarray) -> list[np.ndarray]:
    """Ids of one drawn segmentation of each text; `keys` are 64-bit row keys."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    total = int(sizes.sum())
    if not total:
        return [np.zeros(0, np.int32) for _ in texts]
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    codes[codes == _MARK] = _LITERAL
    codes[codes == _BLANK] = _MARK
    text_start = np.cumsum(sizes) - sizes
    start = _chunks(codes, text_start[sizes > 0], vocab.letters)
    length = np.diff(np.append(start, total))
    of, first = _unique(codes, start, length)
    order = np.argsort(-length[first], kind="stable")
    number = np.empty(len(order), np.int64)
    number[order] = np.arange(len(order))
    first, of = first[order], number[of]
    long = int(np.searchsorted(-length[first], -LONG, side="left"))  # distinct chunks of more characters
    group_of = np.cumsum(length[first] + 1) // NODES
    group_of[:long] = -1

    owner = np.repeat(np.arange(len(texts)), sizes)[start]
    seed = mix(mix(keys.astype(np.uint64)) + np.uint64(SEED))[owner]
    shift = start - text_start[owner]  # place of the chunk in its text
    drawn = np.full(total, -1, np.int32)
    for number in range(long):
        run = codes[start[first[number]] : start[first[number]] + length[first[number]]]
        alpha = _long_filter(vocab, run)
        for chunk in np.flatnonzero(of == number):
            drawn[start[chunk] : start[chunk] + len(run)] = _long_draw(vocab, run, alpha, seed[chunk], int(shift[chunk]))
    for group in np.unique(group_of[long:]):  # distinct chunks, as many as one lattice holds
        a, b = np.searchsorted(group_of, [group, group + 1])
        base, share, ids = _lattice(vocab, codes, start[first[a:b]], length[first[a:b]])
        chunk = np.flatnonzero((of >= a) & (of < b))
        left = length[chunk]
        while len(chunk):
            node = base[of[chunk] - a] + left
            draw = mix(seed[chunk] + (shift[chunk] + left).astype(np.uint64) * _STEP)
            u = (draw >> np.uint64(11)).astype(float) * 2.0**-53
            taken = np.zeros(len(chunk), np.int64)
            open_ = np.arange(len(chunk))
            for k in range(vocab.longest):  # the piece that the draw falls on
                open_ = open_[u[open_] >= share[k, node[open_]]]
                if not len(open_):
                    break
                taken[open_] += 1
            left = left - taken - 1
            drawn[start[chunk] + left] = ids[taken, node]
            chunk, left = chunk[left > 0], left[left > 0]

    at = np.flatnonzero(drawn != -1)
    out = drawn[at].astype(np.int64)
    c = np.select([codes[at] == _LITERAL, codes[at] == _MARK], [_MARK, _BLANK], codes[at])
    width = np.where(out == -2, 1 + (c >= 0x80) + (c >= 0x800) + (c >= 0x10000), 1)
    ids_of = np.repeat(out, width)
    ends = np.cumsum(width)
    for w in range(1, 5):  # UTF-8 bytes of characters that no piece has
        own = np.flatnonzero((out == -2) & (width == w))
        for k in range(w):
            lead = c[own] >> (6 * (w - 1 - k))
            byte = lead if w == 1 else (lead | (0xF00 >> w) & 0xFF) if k == 0 else lead & 0x3F | 0x80
            ids_of[ends[own] - w + k] = vocab.byte_ids[byte]
    owner_of = np.repeat(np.repeat(np.arange(len(texts)), sizes)[at], width)
    cuts = np.cumsum(np.bincount(owner_of, minlength=len(texts)))[:-1]
    return np.split(ids_of.astype(np.int32), cuts)


ENCODED = "doc_id long, text_md5 string, n_ids long, ids binary"


def encode(docs: DataFrame, model: str | None = None) -> DataFrame:
    """One row per row of `docs`: ENCODED, with ids as little-endian 32-bit numbers.

    Null and empty texts have no ids.  Rows are drawn by their doc_id (a null one by 0), so
    repeated rows get equal ids.  Other columns are not read; an empty table gives an empty
    result.
    """
    path = model or default_model()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vocab = vocabulary(path)
        for batch in batches:
            sizes = batch["text"].map(lambda t: len(t or "")).to_numpy()
            part = (np.cumsum(sizes) - 1).clip(0) // CHARACTERS
            for k in np.unique(part):
                rows = batch.iloc[np.flatnonzero(part == k)]
                keys = rows["doc_key"].to_numpy(np.int64).view(np.uint64)
                ids = sample(vocab, [t or "" for t in rows["text"]], keys)
                yield pd.DataFrame({
                    "doc_id": rows["doc_id"].array, "text_md5": rows["text_md5"].to_numpy(),
                    "n_ids": [len(x) for x in ids], "ids": [x.astype("<i4").tobytes() for x in ids],
                })

    one = narrow(docs, doc_id="long", text="string")
    one = one.withColumn("doc_key", F.coalesce("doc_id", F.lit(0))).withColumn("text_md5", text_md5(F.col("text")))
    return bounded(one).mapInPandas(run, ENCODED)


def decode(encoded: DataFrame, model: str | None = None) -> DataFrame:
    """The columns of `encode`, and `text`: exactly the text that was encoded (null as empty)."""
    path = model or default_model()

    @F.pandas_udf("string")
    def text(ids: pd.Series) -> pd.Series:
        table = vocabulary(path).bytes
        one = lambda x: b"".join(map(table.__getitem__, np.frombuffer(x, "<i4").tolist())).decode("utf-8", "surrogatepass")
        return ids.map(one)

    return bounded(encoded).withColumn("text", text("ids"))
