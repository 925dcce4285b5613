"""Quality rules: fixed base rules, then a hashed n-gram log-likelihood ratio.

Two multinomials over hashed word 1- and 2-grams are counted: one over the trusted
documents (`labels.quality` is 1), one over the whole raw corpus.  A document's score is
the mean over its n-grams of log p(trusted) - log p(raw).  Its own n-grams are taken out
of the raw counts first, or a small corpus would hold every text against itself; an
n-gram that neither side has then counts 0.  Every document is held against one fixed
threshold; nothing is drawn at random.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomstar.llm.common import bounded, if_small, narrow, store
from loomstar.llm.words import flat, hashed, mix, windows

#: Both multinomials have this many cells, whatever the corpus holds: 1 MB in all.
CELLS = 1 << 16
SMOOTHING = 2.0
#: The mean log ratio that a document must reach.  Clean texts of at least 20 words lie
#: above -0.1 in corpora of 10,000 documents or more, above -0.2 in one of 1,000 nearly
#: always; text of foreign make lies far below.
THRESHOLD = -0.2
MIN_WORDS = 20
MAX_REPEATED_PERCENT = 30
WINDOW = 8
#: Trusted ids travel by broadcast up to this many (8 bytes each), else the join shuffles.
BROADCAST_IDS = 1_000_000

_SYMBOLS = b"#*$%&|<>"
_BLANKS = b" \t\n\x0b\x0c\r"


def _cells(words: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Cells of all 1- and 2-grams, the text of each, and the word hashes with their counts."""
    items, sizes = flat(words)
    one = hashed(items)
    two, owner, _ = windows(one, sizes, 2)
    owners = np.concatenate([np.repeat(np.arange(len(sizes)), sizes), owner])
    cells = np.concatenate([mix(one) % np.uint64(CELLS), two % np.uint64(CELLS)])
    return cells.astype(np.int64), owners, one, sizes


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A task's counts by cell; memory is fixed, rows out are CELLS at most."""
    raw, trusted = np.zeros(CELLS, np.int64), np.zeros(CELLS, np.int64)
    for batch in batches:
        words = [(t or "").encode("utf-8", "surrogatepass").split() for t in batch["text"]]
        cells, owners, _, _ = _cells(words)
        raw += np.bincount(cells, minlength=CELLS)
        good = batch["trusted"].to_numpy(dtype=bool)
        trusted += np.bincount(cells[good[owners]], minlength=CELLS)
    used = np.flatnonzero(raw)
    yield pd.DataFrame({"cell": used, "raw": raw[used], "trusted": trusted[used]})


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Ids that labels call good and never bad; a null id or quality says nothing."""
    one = narrow(labels, doc_id="long", quality="int").where("doc_id is not null and quality is not null")
    return one.groupBy("doc_id").agg(F.min("quality").alias("least")).where("least >= 1").select("doc_id")


def cell_counts(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """By cell: log of the trusted counts, scaled to the raw corpus and smoothed; the raw counts.

    Without any trusted text the first array is empty.
    """
    ids = if_small(store(trusted_ids(labels), "trusted-ids"), BROADCAST_IDS)
    one = narrow(docs, doc_id="long", text="string")
    flagged = one.join(ids.withColumn("trusted", F.lit(True)), "doc_id", "left")
    flagged = flagged.select("text", F.coalesce("trusted", F.lit(False)).alias("trusted"))
    counts = bounded(flagged).mapInPandas(_count, "cell int, raw long, trusted long")
    total = counts.groupBy("cell").agg(F.sum("raw").alias("raw"), F.sum("trusted").alias("trusted")).toPandas()
    raw, trusted = np.zeros(CELLS, np.int64), np.zeros(CELLS)
    raw[total["cell"]], trusted[total["cell"]] = total["raw"], total["trusted"]
    if not trusted.any():
        return np.zeros(0), raw
    return np.log(trusted * (raw.sum() / trusted.sum()) + SMOOTHING), raw


def _scores(cells: np.ndarray, owners: np.ndarray, n: int, good: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """The mean log ratio of each text, its own n-grams left out of `raw`; 0 without n-grams."""
    if not len(good) or not len(cells):
        return np.zeros(n)
    code, unique = pd.factorize(owners * CELLS + cells)
    others = raw[cells] - np.bincount(code, minlength=len(unique))[code]
    ratio = good[cells] - np.log(np.maximum(others, 0) + SMOOTHING)
    return np.bincount(owners, weights=ratio, minlength=n) / np.maximum(np.bincount(owners, minlength=n), 1)


def _repeated_words(one: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Words of each text inside an 8-word window that the text holds twice or more."""
    grams, owner, at = windows(one, sizes, WINDOW)
    key = mix(grams + mix(owner.astype(np.uint64) + np.uint64(1)))
    ordered = np.sort(key)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    edge = np.zeros(len(one) + 1, np.int64)
    if len(twice):
        hit = at[np.isin(key, twice)]
        np.add.at(edge, hit, 1)
        np.add.at(edge, hit + WINDOW, -1)
    covered = np.cumsum(edge)[:-1] > 0
    return np.bincount(np.repeat(np.arange(len(sizes)), sizes), weights=covered, minlength=len(sizes)).astype(np.int64)


def _repeated_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in text.split("\n") if x.strip(" \t\r\x0b\x0c")]
    return len(lines) - len(set(lines))


SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "score double, base_failed boolean, kept boolean"
)


def judge(texts: list[str | None], good: np.ndarray, corpus: np.ndarray) -> pd.DataFrame:
    """The columns after doc_id, for some texts; the arrays are those of `cell_counts`."""
    texts = [t or "" for t in texts]
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    words = [b.split() for b in raw]
    cells, owners, one, sizes = _cells(words)
    score = _scores(cells, owners, len(texts), good, corpus)
    out = pd.DataFrame({
        "n_words": sizes,
        "word_chars": [len(t) - len(b) + len(b.translate(None, _BLANKS)) for t, b in zip(texts, raw)],
        "n_symbols": [len(b) - len(b.translate(None, _SYMBOLS)) for b in raw],
        "n_dup_lines": [_repeated_lines(t) for t in texts],
        "n_repeat_words": _repeated_words(one, sizes),
        "score": score,
    })
    out["base_failed"] = (sizes < MIN_WORDS) | (100 * out["n_repeat_words"] > MAX_REPEATED_PERCENT * sizes)
    out["kept"] = ~out["base_failed"] & (score >= THRESHOLD)
    return out


def quality_rules(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per row of `docs`: doc_id, the base counts, score, base_failed and kept.

    Null and empty texts have no words and fail.  Repeated rows and null ids are judged
    like any other.  Without trusted text every score is 0 and only the base rules reject.
    Other columns are not read.
    """
    share = docs.sparkSession.sparkContext.broadcast(cell_counts(docs, labels))

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = judge(batch["text"].tolist(), *share.value)
            out.insert(0, "doc_id", batch["doc_id"].array)
            yield out

    return bounded(narrow(docs, doc_id="long", text="string")).mapInPandas(score, SCHEMA)


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """`docs`, all its columns, without the rows that `quality_rules` rejects."""
    share = docs.sparkSession.sparkContext.broadcast(cell_counts(docs, labels))

    @F.pandas_udf("boolean")
    def good(texts: pd.Series) -> pd.Series:
        return judge(texts.tolist(), *share.value)["kept"]

    return bounded(docs).where(good(F.col("text").cast("string")))
