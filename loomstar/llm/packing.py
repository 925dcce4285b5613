"""Packing documents into training windows by lexical neighbourhood.

A document is its token ids and an end id.  Whole windows are cut off a document first;
what remains, less than a window, is packed with its lexical neighbours.  The index over
all remainders is sharded by content: centroids of BM25 vectors, fitted on a bounded sample,
give every remainder a cluster, and clusters, ordered so that similar ones adjoin, and the
rarest ids inside them put neighbours into one shard.  Each shard is an inverted index under
BM25, with document frequencies of the whole corpus: its first unused document seeds a
window, and the best-scoring unused neighbours fill it.  The last one is cut at the
window's end and what is left of it goes back to the index, so that only a shard's last
window is padded.

A seed is answered by its own shard.  The five best neighbours of a text in the whole
corpus cannot all lie there: texts without a topic have thousands of neighbours as good as
the best, and to rank them all takes work with the square of the corpus.  What a shard finds
is close to them: see the measured recall and score in the README.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomstar.llm.common import bounded, narrow
from loomstar.llm.encoding import added_tokens, byte_encoder, public
from loomstar.session import scratch_path

WINDOW = 1024
END_ID = 0
#: Ids below this are document-frequency cells: 2 bytes an id, 8 bytes a cell.
VOCABULARY = 1 << 16
#: Remainders in one shard, two million tokens at most: its index takes some 100 MB.
SHARD_DOCUMENTS = 2_000
#: Centroids, the dimensions that ids are folded into, and the remainders they are fitted on, about so many and
#: never more than twice as many.
CLUSTERS, DIMENSIONS, SAMPLE, FITTINGS = 16, 1_024, 4_096, 10
K1, B = 1.2, 0.75
#: An id that one text of so many in a shard holds has a row of all texts in its index: 130 MB at most.
DENSE = 16


def crc(ids: bytes) -> int:
    """crc32 over the ids as little-endian 32-bit numbers."""
    return zlib.crc32(np.frombuffer(ids, "<u2").astype("<u4").tobytes())


PIECE = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"
)
_CUT = "doc_id long, start long, doc_tokens long, ids binary, part int"


def _cut(path: str, special: tuple[tuple[str, int], ...]):
    """Whole windows (part 0) and the remainder (1) of each document, as rows of pieces.

    Part 2 is in how many remainders of this task each id (`start`) occurs (`doc_tokens`).
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode, end = byte_encoder(path, special), np.array([END_ID], "<u2").tobytes()
        found = np.zeros(VOCABULARY, np.int64)
        for batch in batches:
            rows = []
            for doc_id, ids in zip(batch["doc_id"].array, encode.many([t or "" for t in batch["text"]])):
                ids += end
                tokens = len(ids) // 2
                last = tokens - tokens % WINDOW
                for start in range(0, last, WINDOW):
                    rows.append((doc_id, start, tokens, ids[2 * start : 2 * (start + WINDOW)], 0))
                if last < tokens:
                    rest = ids[2 * last :]
                    rows.append((doc_id, last, tokens, rest, 1))
                    found[_distinct(np.frombuffer(rest, "<u2"))[0]] += 1
            yield pd.DataFrame(rows, columns=["doc_id", "start", "doc_tokens", "ids", "part"])
        used = np.flatnonzero(found)
        none = pd.array([None] * len(used), "Int64")
        yield pd.DataFrame({"doc_id": none, "start": used, "doc_tokens": found[used], "ids": b"", "part": 2})

    return run


def _distinct(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rising distinct ids of one text, and how often each stands there."""
    ordered = np.sort(ids)
    begin = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1])) if len(ids) else np.zeros(0, np.int64)
    return ordered[begin], np.diff(np.append(begin, len(ids)))


def _sketches(batch: list[bytes], documents: np.ndarray) -> np.ndarray:
    """Each text's rarest two ids that other documents hold too: near documents sort together."""
    ids = np.frombuffer(b"".join(batch), "<u2").astype(np.int64)
    sizes = np.fromiter(map(len, batch), np.int64, len(batch)) // 2
    often = documents[ids]
    rank = np.where(often > 1, often, np.int64(1) << 40) * VOCABULARY + ids
    starts = np.cumsum(sizes) - sizes
    first = np.minimum.reduceat(rank, starts)
    rest = np.where(rank == np.repeat(first, sizes), np.iinfo(np.int64).max, rank)
    second = np.minimum(np.minimum.reduceat(rest, starts), np.iinfo(np.int64).max - 1)
    return first % VOCABULARY * VOCABULARY + second % VOCABULARY


def _vectors(batch: list[bytes], documents: np.ndarray, total: int) -> np.ndarray:
    """BM25 weights of each text's ids, folded into DIMENSIONS and scaled to length 1.

    Ids that fall on one dimension count as one id of their mean IDF.
    """
    ids = np.frombuffer(b"".join(batch), "<u2")
    sizes = np.fromiter(map(len, batch), np.int64, len(batch)) // 2
    cell = np.repeat(np.arange(len(batch)) * DIMENSIONS, sizes) + ids % DIMENSIONS
    idf = np.log1p((total - documents + 0.5) / (documents + 0.5))
    times = np.bincount(cell, minlength=len(batch) * DIMENSIONS).reshape(len(batch), DIMENSIONS)
    out = np.bincount(cell, weights=idf[ids], minlength=len(batch) * DIMENSIONS).reshape(len(batch), DIMENSIONS)
    out *= (K1 + 1) / (times + K1 * (1 - B + B * sizes[:, None] / (WINDOW / 2)))
    return out / np.maximum(np.sqrt(np.einsum("ij,ij->i", out, out)), 1e-12)[:, None]


def fit_centroids(sample: list[bytes], documents: np.ndarray, total: int) -> np.ndarray:
    """Centroids of the sample, in an order in which similar ones adjoin."""
    if not sample:
        return np.zeros((1, DIMENSIONS))
    x = _vectors(sample, documents, total)
    centers = x[:CLUSTERS].copy()
    for _ in range(FITTINGS):
        nearest = _nearest(x, centers)
        for k in np.unique(nearest):
            mean = x[nearest == k].mean(axis=0)
            centers[k] = mean / max(np.linalg.norm(mean), 1e-12)
    chain, left = [0], list(range(1, len(centers)))
    while left:
        chain.append(left.pop(int(np.argmax(np.round(centers[left] @ centers[chain[-1]], 9)))))
    return centers[chain]


def _nearest(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    return np.round(x @ centers.T, 9).argmax(axis=1)  # rounded: alike on any machine


def pack_shard(items: list[tuple[int, bytes]], documents: np.ndarray, total: int) -> list[tuple[int, int, int, int, int]]:
    """Windows of one shard: (item, start in it, length, window, offset), every id once.

    `items` are (any number, ids); neighbours are ranked by BM25, ties by place.
    """
    ids = [np.frombuffer(x, "<u2") for _, x in items]
    n = len(items)
    terms, owners, times = [], [], []
    for k, x in enumerate(ids):
        own, often = _distinct(x)
        terms.append(own)
        owners.append(np.full(len(own), k))
        times.append(often)
    term, owner, tf = np.concatenate(terms).astype(np.int64), np.concatenate(owners), np.concatenate(times)
    length = np.fromiter(map(len, ids), float, n)
    idf = np.log1p((total - documents + 0.5) / (documents + 0.5))
    weight = idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length[owner] / length.mean()))
    order = np.argsort(term, kind="stable")
    term, owner, weight = term[order], owner[order], weight[order].astype(np.float32)
    first = np.searchsorted(term, np.arange(VOCABULARY + 1))
    often = np.diff(first)
    # Postings of ids that many texts hold are whole rows, all others are lists.
    full = np.flatnonzero(often >= max(2, n // DENSE))
    row_of = np.full(VOCABULARY, -1)
    row_of[full] = np.arange(len(full))
    rows = np.zeros((len(full), n), np.float32)
    own = row_of[term] >= 0
    rows[row_of[term[own]], owner[own]] = weight[own]

    left = length.astype(np.int64)
    begin = np.zeros(n, np.int64)
    out, window, seed = [], 0, 0
    while True:
        while seed < n and not left[seed]:
            seed += 1
        if seed == n:
            return out
        out.append((seed, int(begin[seed]), int(left[seed]), window, 0))
        room, offset = WINDOW - int(left[seed]), int(left[seed])
        left[seed] = 0
        # The query is all ids of the seed; one that the seed alone holds matches nothing else.
        query = terms[seed].astype(np.int64)
        place = row_of[query]
        score = rows[place[place >= 0]].sum(axis=0)
        rare = query[(place < 0) & (often[query] > 1)]
        if len(rare):
            start, size = first[rare], often[rare]
            at = np.repeat(start - np.cumsum(size) + size, size) + np.arange(size.sum())
            score += np.bincount(owner[at], weights=weight[at], minlength=n).astype(np.float32)
        score[left == 0] = -1
        while room:
            k = int(score.argmax())  # ties by place
            if score[k] < 0:
                break
            score[k] = -1
            take = min(room, int(left[k]))
            out.append((k, int(begin[k]), take, window, offset))
            begin[k] += take
            left[k] -= take
            room -= take
            offset += take
        window += 1


def _pack(documents: np.ndarray, total: int):
    """Shards of a sorted partition, one after another, each of SHARD_DOCUMENTS remainders."""

    def flush(held: list[tuple], base: int) -> tuple[pd.DataFrame, int]:
        placed = pack_shard([(0, row[3]) for row in held], documents, total)
        rows = []
        for k, start, length, window, offset in placed:
            doc_id, begin, tokens, ids = held[k]
            part = ids[2 * start : 2 * (start + length)]
            rows.append((doc_id, begin + start, length, crc(part), tokens, base + window, offset, part))
        names = [x.split()[0] for x in PIECE.split(", ")]
        return pd.DataFrame(rows, columns=names), base + (placed[-1][3] + 1 if placed else 0)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        base, held = (TaskContext.get().partitionId() + 1) << 36, []
        for batch in batches:
            for row in zip(batch["doc_id"].array, batch["start"], batch["doc_tokens"], batch["ids"]):
                held.append(row)
                if len(held) == SHARD_DOCUMENTS:
                    out, base = flush(held, base)
                    held = []
                    yield out
        if held:
            yield flush(held, base)[0]

    return run


def _whole(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A whole window is a sequence of its own, under a negative number."""
    from pyspark import TaskContext

    base, n = (TaskContext.get().partitionId() + 1) << 36, 0
    for batch in batches:
        size = len(batch)
        yield pd.DataFrame({
            "doc_id": batch["doc_id"].array, "start": batch["start"], "length": WINDOW,
            "ids_crc32": [crc(x) for x in batch["ids"]], "doc_tokens": batch["doc_tokens"],
            "sequence_id": -(base + n + np.arange(size)), "offset": 0, "ids": batch["ids"],
        })
        n += size


def pack(docs: DataFrame, ranks: str | None = None, tokenizer: str | None = None) -> DataFrame:
    """Pieces of all documents: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids.

    `ranks` and `tokenizer` are the two files of one vocabulary; a string that the second
    gives an id of its own, such as an end-of-text mark, gets that id inside a text too, as
    from the tokenizer itself.  `ids` are little-endian 16-bit numbers.  Every id of every document lies in exactly
    one piece; a sequence holds WINDOW ids at most, its pieces gapless from offset 0.  Null
    and empty texts are the end id alone.  Rows that repeat are packed each for itself.  An
    empty table gives no pieces; other columns are not read.
    """
    spark = docs.sparkSession
    path, special = ranks or public("byte_bpe_50k.tiktoken"), added_tokens(tokenizer or public("byte_bpe_50k.json"))
    one = narrow(docs, doc_id="long", text="string")
    place = scratch_path(spark, "cut")
    bounded(one).mapInPandas(_cut(path, special), _CUT).write.partitionBy("part").parquet(place)
    cut = spark.read.schema(_CUT).parquet(place)
    rest, whole = cut.where("part = 1"), cut.where("part = 0")

    counts = cut.where("part = 2").groupBy(F.col("start").alias("id")).agg(F.sum("doc_tokens").alias("documents")).toPandas()
    documents = np.zeros(VOCABULARY, np.int64)
    documents[counts["id"]] = counts["documents"]
    total = rest.count()
    # About SAMPLE rows whatever the number of tasks; a limit for rows that repeat over and over.
    chance = F.pmod(F.xxhash64("doc_id", "start", "ids"), F.lit(1 << 30)).alias("chance")
    some = rest.select("ids", chance).where(F.col("chance") <= (1 << 30) * SAMPLE // max(total, 1)).limit(2 * SAMPLE)
    sample = sorted((r.chance, bytes(r.ids)) for r in some.collect())
    centers = fit_centroids([ids for _, ids in sample], documents, total)
    share = spark.sparkContext.broadcast((documents, centers))

    @F.pandas_udf("long")
    def sketch(ids: pd.Series) -> pd.Series:
        batch, (frequent, centers) = ids.tolist(), share.value
        if not batch:
            return pd.Series([], dtype="int64")
        near = _nearest(_vectors(batch, frequent, total), centers)
        return pd.Series(near * (VOCABULARY * VOCABULARY) + _sketches(batch, frequent))

    def packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return _pack(share.value[0], total)(batches)

    # Documents with the same rare ids are neighbours in the order, and so in a shard; equal
    # sketches of any number are parted by id, so no shard outgrows its size.
    shards = max(1, -(-total // SHARD_DOCUMENTS))
    order = ["sketch", "doc_id", "start", "tie"]
    dealt = bounded(rest).withColumn("sketch", sketch("ids")).withColumn("tie", F.xxhash64("ids"))
    dealt = dealt.repartitionByRange(max(1, -(-shards // 2)), *order).sortWithinPartitions(*order)
    parts = bounded(dealt.select("doc_id", "start", "doc_tokens", "ids")).mapInPandas(packed, PIECE)
    return parts.unionByName(bounded(whole.select("doc_id", "start", "doc_tokens", "ids")).mapInPandas(_whole, PIECE))
