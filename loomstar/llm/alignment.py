"""Alignment of two tokenizers' ids by diagonal run skipping.

Both tokenizers spell the same bytes, so a text is two rising arrays of byte offsets at
which tokens end.  Where tokens match one to one, the arrays are equal at a fixed index
shift: the run is probed with doubling lengths and its end found by halving, so that a run
costs the logarithm of its length.  Where they do not, the side that is behind moves on
until both ends meet again; that group is resolved on the spot and the shift updated.
Common ends cut the tokens into groups.

Tokens that share a group are linked.  A pair of ids counts once for each document that
holds it linked.  The counts are of the whole corpus: tasks combine their own documents'
pairs before the shuffle.  Pairs that a 2^-20 share of all counts falls on, 2^20 of them at
most, travel to every task; all other pairs meet their counts in a join.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomstar.llm.common import bounded, narrow
from loomstar.llm.encoding import byte_encoder, lengths, piece_encoder, public
from loomstar.session import scratch_path

#: Share of all counts that sends a pair to every task.
COMMON_SHARE = 2.0**-20
#: Tokens whose links are laid out at the same time, and links of one group beyond which ids are combined first.
TOKENS, GROUP_LINKS = 1 << 19, 1 << 16
#: Distinct pairs that a task holds before it hands them on.
HELD = 1 << 20

ALIGNED = "doc_id long, a_ids binary, b_ids binary, a_last binary, b_last binary"


def last_flags(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[bytearray, bytearray]:
    """For each token of both sides 1 if it is the last of its group, else 0.

    Both arrays rise and have the same last number.
    """
    n, m = len(ends_a), len(ends_b)
    a, b = ends_a.astype("<u4").tobytes(), ends_b.astype("<u4").tobytes()
    at_a, at_b = ends_a.tolist(), ends_b.tolist()
    last_a, last_b = bytearray(b"\1") * n, bytearray(b"\1") * m
    i = j = 0
    while i < n:
        x, y = at_a[i], at_b[j]
        if x == y:
            i, j, reach = i + 1, j + 1, 1
            while reach:
                reach = min(reach, n - i, m - j)
                if a[4 * i : 4 * (i + reach)] == b[4 * j : 4 * (j + reach)]:
                    i, j, reach = i + reach, j + reach, 2 * reach
                    continue
                same = 0  # so many are equal, `reach` are not
                while reach - same > 1:
                    half = (same + reach) // 2
                    if a[4 * (i + same) : 4 * (i + half)] == b[4 * (j + same) : 4 * (j + half)]:
                        same = half
                    else:
                        reach = half
                i, j, reach = i + same, j + same, 0
            continue
        while x != y:
            if x < y:
                last_a[i] = 0
                i += 1
                x = at_a[i]
            else:
                last_b[j] = 0
                j += 1
                y = at_b[j]
        i, j = i + 1, j + 1
    return last_a, last_b


def _aligned(path_a: str, path_b: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode_a, encode_b = byte_encoder(path_a), piece_encoder(path_b)
        long_a, long_b = lengths(encode_a.spellings()), lengths(encode_b.spellings())
        for batch in batches:
            texts = [t or "" for t in batch["text"]]
            ids_b = [ids if t else b"" for t, ids in zip(texts, encode_b.many(texts))]
            ids_a = encode_a.many([f" {t}" if ids else "" for t, ids in zip(texts, ids_b)])
            out = []
            for a, b in zip(ids_a, ids_b):
                ends_a = np.cumsum(long_a[np.frombuffer(a, "<u2")])
                ends_b = np.cumsum(long_b[np.frombuffer(b, "<u2")])
                last_a, last_b = last_flags(ends_a, ends_b)
                out.append((a, b, bytes(last_a), bytes(last_b)))
            frame = pd.DataFrame(out, columns=["a_ids", "b_ids", "a_last", "b_last"])
            frame.insert(0, "doc_id", batch["doc_id"].array)
            yield frame

    return run


def align(docs: DataFrame, tokens_a: str | None = None, tokens_b: str | None = None) -> DataFrame:
    """One row per row of `docs`: doc_id, a_ids, b_ids, a_last, b_last.

    Ids are little-endian 16-bit numbers of the byte-level vocabulary `tokens_a` (of a blank
    and the text) and of the piece model `tokens_b` (which adds the blank itself); a flag is
    a byte, 1 for the last token of a group.  Special tokens' strings are plain text.  Null
    and empty texts, and texts that a tokenizer does not spell out byte by byte, have no
    tokens.  Repeated rows are aligned alike; other columns are not read; an empty table
    gives an empty result.
    """
    paths = tokens_a or public("byte_bpe_50k.tiktoken"), tokens_b or public("piece_bpe_32k.model")
    return bounded(narrow(docs, doc_id="long", text="string")).mapInPandas(_aligned(*paths), ALIGNED)


def groups_text(a_ids: bytes, b_ids: bytes, a_last: bytes, b_last: bytes) -> str:
    """`a1,a2|b1;a3|b2,b3`: the ids of both sides of all groups in order."""
    a, b = np.frombuffer(a_ids, "<u2"), np.frombuffer(b_ids, "<u2")
    ends_a, ends_b = np.frombuffer(a_last, np.uint8), np.frombuffer(b_last, np.uint8)
    if not len(a):
        return ""
    # Groups before a token, and so its place among the tokens of both sides.
    group_a, group_b = np.cumsum(ends_a) - ends_a, np.cumsum(ends_b) - ends_b
    size_a, size_b = np.bincount(group_a), np.bincount(group_b)
    code = np.empty(len(a) + len(b), np.int64)
    place_a = np.arange(len(a)) + (np.cumsum(size_b) - size_b)[group_a]
    code[place_a] = 3 * a.astype(np.int64) + ends_a
    code[np.arange(len(b)) + np.cumsum(size_a)[group_b]] = 3 * b.astype(np.int64) + 2 * ends_b
    return _names()[code].tobytes().translate(None, b"\0")[:-1].decode()


@lru_cache(1)
def _names() -> np.ndarray:
    """Decimal ids followed by a comma, by a bar, by a semicolon; each padded to 8 bytes."""
    return np.array([f"{k}{mark}" for k in range(1 << 16) for mark in ",|;"], "S8").view(np.uint64)


def _chunks(batch: pd.DataFrame) -> Iterator[pd.DataFrame]:
    """Parts of a batch of about TOKENS tokens, a document whole."""
    sizes = batch["a_ids"].map(len).to_numpy() // 2
    part = (np.cumsum(sizes) - 1).clip(0) // TOKENS
    for k in np.unique(part):
        yield batch.iloc[np.flatnonzero(part == k)]


def _joined(values: pd.Series, kind: str) -> tuple[np.ndarray, np.ndarray]:
    flat = np.frombuffer(b"".join(values), kind)
    return flat.astype(np.int64), values.map(len).to_numpy() // np.dtype(kind).itemsize


def _sum_by(key: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    code, unique = pd.factorize(key)
    total = np.zeros(len(unique), np.int64)
    np.add.at(total, code, times)
    return unique, total


def links_of(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Linked id pairs of some aligned documents, each pair of a document once.

    Gives (document, pair, links) and by document (groups, links); a pair is a << 16 | b.
    """
    n = len(rows)
    a, tokens = _joined(rows["a_ids"], "<u2")
    b, _ = _joined(rows["b_ids"], "<u2")
    ends_a, _ = _joined(rows["a_last"], "u1")
    ends_b, _ = _joined(rows["b_last"], "u1")
    owner = np.repeat(np.arange(n), tokens)
    group_a, group_b = np.cumsum(ends_a) - ends_a, np.cumsum(ends_b) - ends_b
    size_a, size_b = np.bincount(group_a), np.bincount(group_b)
    start_a, start_b = np.cumsum(size_a) - size_a, np.cumsum(size_b) - size_b
    of = owner[start_a]  # each group's document
    groups, product = np.bincount(of, minlength=n), size_a * size_b
    total = np.zeros(n, np.int64)
    np.add.at(total, of, product)

    found = []
    big = product > GROUP_LINKS
    for g in np.flatnonzero(big):  # ids of a large group are combined before they are paired
        own_a, times_a = np.unique(a[start_a[g] : start_a[g] + size_a[g]], return_counts=True)
        own_b, times_b = np.unique(b[start_b[g] : start_b[g] + size_b[g]], return_counts=True)
        for k in range(0, len(own_a), max(1, TOKENS // len(own_b))):
            side = slice(k, k + max(1, TOKENS // len(own_b)))
            key = (of[g] << 32) | (own_a[side, None] << 16) | own_b[None, :]
            found.append((key.ravel(), (times_a[side, None] * times_b[None, :]).ravel()))
    wide = np.where(big, 0, size_b)[group_a]  # links of each A token
    cut = np.searchsorted(np.cumsum(wide), np.arange(TOKENS, wide.sum() + TOKENS, TOKENS), side="left") + 1
    for lo, hi in zip([0, *cut[:-1]], cut):
        each = wide[lo:hi]
        at = np.repeat(start_b[group_a[lo:hi]] - np.cumsum(each) + each, each) + np.arange(each.sum())
        key = np.repeat((owner[lo:hi] << 32) | (a[lo:hi] << 16), each) | b[at]
        found.append(_sum_by(key, np.ones(len(key), np.int64)))
    if not found:
        none = np.zeros(0, np.int64)
        return none, none, none, groups, total
    key, times = found[0] if len(found) == 1 else _sum_by(*(np.concatenate(x) for x in zip(*found)))
    return key >> 32, key & 0xFFFFFFFF, times, groups, total


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """In how many documents of this task each pair is linked, combined as far as memory allows."""
    held, size = [], 0
    for batch in batches:
        for rows in _chunks(batch):
            pair = links_of(rows)[1]
            held.append(_sum_by(pair, np.ones(len(pair), np.int64)))
            size += len(held[-1][0])
            if size > 2 * HELD:
                held = [_sum_by(*(np.concatenate(x) for x in zip(*held)))]
                size = len(held[0][0])
                if size > HELD:
                    yield pd.DataFrame({"pair": held[0][0], "n": held[0][1]})
                    held, size = [], 0
    if held:
        pair, n = _sum_by(*(np.concatenate(x) for x in zip(*held)))
        yield pd.DataFrame({"pair": pair, "n": n})


_SCORED = (
    "row long, pair long, links long, n_best long, count_sum long, doc_id long, n_a long, n_b long, n_groups long, "
    "n_links long, groups_sha256 string"
)


_PARTS = ["a_ids", "b_ids", "a_last", "b_last"]


def _digest(*parts: bytes) -> str:
    """Lowercase hex sha256 of the groups' text; empty without tokens."""
    return sha256(groups_text(*parts).encode()).hexdigest() if parts[0] else ""


def _score(share):
    """A row per document with what the common pairs give it, and a row per other pair of a document."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pairs, counts, best = share.value
        for batch in batches:
            for rows in _chunks(batch):
                owner, pair, times, groups, total = links_of(rows)
                at = np.minimum(np.searchsorted(pairs, pair), max(len(pairs) - 1, 0))
                common = pairs[at] == pair if len(pairs) else np.zeros(len(pair), bool)
                n_best, count_sum = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
                own, at, each = owner[common], at[common], times[common]
                np.add.at(n_best, own, each * best[at])
                np.add.at(count_sum, own, each * counts[at])
                yield pd.DataFrame({
                    "row": rows["row"].to_numpy(), "pair": pd.array([None] * len(rows), "Int64"), "links": 0,
                    "n_best": n_best, "count_sum": count_sum, "doc_id": rows["doc_id"].array,
                    "n_a": rows["a_ids"].map(len).to_numpy() // 2, "n_b": rows["b_ids"].map(len).to_numpy() // 2,
                    "n_groups": groups, "n_links": total,
                    "groups_sha256": [_digest(*x) for x in zip(*(rows[c] for c in _PARTS))],
                })
                rare = np.flatnonzero(~common)
                for k in range(0, len(rare), 100_000):
                    part = rare[k : k + 100_000]
                    empty = pd.array([None] * len(part), "Int64")
                    yield pd.DataFrame({
                        "row": rows["row"].to_numpy()[owner[part]], "pair": pair[part], "links": times[part], "n_best": 0,
                        "count_sum": 0, "doc_id": empty, "n_a": empty, "n_b": empty, "n_groups": empty, "n_links": empty,
                        "groups_sha256": None,
                    })

    return run


def _pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, n, best): documents that hold each pair linked; `best` if no pair of its A id has more."""
    spark = aligned.sparkSession
    rows = bounded(aligned.select("a_ids", "b_ids", "a_last", "b_last"))
    counts = rows.mapInPandas(_count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    path = scratch_path(spark, "pairs")
    counts.write.parquet(path)
    counts = spark.read.schema(counts.schema).parquet(path)
    of = F.shiftright("pair", 16).alias("a")
    highest = F.broadcast(counts.groupBy(of).agg(F.max("n").alias("most")))  # a row per id: 65,536 at most
    return counts.withColumn("a", of).join(highest, "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def links(docs: DataFrame, tokens_a: str | None = None, tokens_b: str | None = None) -> DataFrame:
    """`align`, each document's groups and links weighed by the corpus.

    doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256: `n_best` are links
    whose pair has the highest count of its A id, ties included; `count_sum` is the sum of
    the pairs' counts over all links; the digest is that of `groups_text`.  Rows without
    tokens have zeros and an empty digest.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "aligned")
    found = align(docs, tokens_a, tokens_b).withColumn("row", F.monotonically_increasing_id())
    found.write.option("compression", "zstd").parquet(path)
    aligned = spark.read.schema(found.schema).parquet(path)
    counts = _pair_counts(aligned)
    least = max(1.0, COMMON_SHARE * (counts.agg(F.sum("n")).first()[0] or 0))
    held = counts.where(F.col("n") >= least).toPandas().sort_values("pair")
    share = spark.sparkContext.broadcast(tuple(held[c].to_numpy(np.int64) for c in ("pair", "n", "best")))

    path = scratch_path(spark, "scored")
    bounded(aligned).mapInPandas(_score(share), _SCORED).write.parquet(path)
    scored = spark.read.schema(_SCORED).parquet(path)
    rare = scored.where("pair is not null").select("row", "pair", "links").join(counts.where(F.col("n") < least), "pair")
    best = F.sum(F.col("links") * F.col("best").cast("long")).alias("more_best")
    more = rare.groupBy("row").agg(best, F.sum(F.col("links") * F.col("n")).alias("more_sum"))
    plus = lambda c, m: (F.col(c) + F.coalesce(m, F.lit(0))).alias(c)
    return scored.where("pair is null").join(more, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", plus("n_best", "more_best"), plus("count_sum", "more_sum"), "groups_sha256"
    )
