"""Language-model scores: prediction by partial matching over bytes, and a word unigram base.

The model is a trie of byte strings.  Every position of every training text counts one
string: the ORDER bytes before it and its own byte.  Shorter strings' counts are sums of
those.  Every counted string is a node of the trie, which is a stored table.

A byte is predicted from the longest context that the trie holds.  If the context has not
been followed by it, an escape is paid (method C), and the next shorter context predicts
it, where all bytes that the longer one could have predicted are excluded.  Below the
empty context all remaining symbols are equally likely.  Because a trie node's suffix is
in the trie as well, what is excluded depends on the longer context alone; its sums are
worked out once by a join of each order with the next shorter one.

A string's log probability is worked out once, for every distinct string of all texts,
training or not, by a join per order.  The frequent strings travel to every task; a text's
other strings meet their log probabilities in a join, as rare words meet their counts.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from math import log10

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomstar.llm.common import bounded, crc32_mod, narrow, store

ORDER = 4
#: Strings below this share of all positions would leave the trie; none do.
SHARE = 0.0
#: Strings this frequent go to every task (2^20 of them at most, 16 MB); all others meet their values in a join.
COMMON_SHARE = 2.0**-20
FOLDS, HELD_OUT = 7, 2
#: Words this frequent go to every task (2^20 of them at most); all others meet their counts in a join.
WORD_SHARE = 2.0**-20
#: Distinct strings and words that a task holds before it hands them on.
HELD = 1_000_000

# Symbols 0 to 255 are bytes.
END, START, SYMBOLS, BITS = 256, 257, 257, 9


def lowered(text: str | None) -> bytes:
    """UTF-8, with A-Z in lower case."""
    return (text or "").encode("utf-8", "surrogatepass").lower()


def strings_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """For every byte of every text and each text's end: (string of ORDER + 1 symbols as one number, text)."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    n = int(sizes.sum()) + len(texts) * (ORDER + 1)
    symbols = np.full(n, START, np.int64)
    owner = np.repeat(np.arange(len(texts)), sizes + ORDER + 1)
    first = np.cumsum(sizes + ORDER + 1) - sizes - 1  # of each text, after its START symbols
    own = np.ones(n, bool)
    for k in range(ORDER):
        own[first - 1 - k] = False
    symbols[first + sizes] = END
    body = own.copy()
    body[first + sizes] = False
    symbols[body] = np.frombuffer(b"".join(texts), np.uint8)
    packed = np.zeros(n, np.int64)
    for k in range(ORDER + 1):
        packed[ORDER:] += symbols[ORDER - k : n - k] << (BITS * k)
    return packed[own], owner[own]


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A task's counts of strings (`n` in training, `seen` in all texts) and of training words, combined as far as memory allows."""

    def strings(found: list) -> pd.DataFrame:
        grams, counts, seen = (np.concatenate(x) for x in zip(*found))
        code, unique = pd.factorize(grams)
        total = lambda x: np.bincount(code, weights=x, minlength=len(unique)).astype(np.int64)
        return pd.DataFrame({"string": unique, "word": None, "n": total(counts), "seen": total(seen)})

    def worded(words: Counter) -> pd.DataFrame:
        n = list(words.values())
        return pd.DataFrame({"string": None, "word": list(words), "n": n, "seen": n}).astype({"string": "Int64"})

    found, held, words = [], 0, Counter()
    for batch in batches:
        texts, train = [lowered(t) for t in batch["text"]], batch["train"].to_numpy(bool)
        grams, owner = strings_of(texts)
        code, unique = pd.factorize(grams)
        seen = np.bincount(code, minlength=len(unique))
        found.append((unique, np.bincount(code, weights=train[owner], minlength=len(unique)), seen))
        held += len(unique)
        for t, own in zip(texts, train):
            if own:
                words.update(t.split())
        if held > HELD:
            merged = strings(found)
            found, held = [tuple(merged[c].to_numpy() for c in ("string", "n", "seen"))], len(merged)
            if held > HELD // 2:
                yield merged
                found, held = [], 0
        if len(words) > HELD // 2:
            yield worded(words)
            words = Counter()
    if found:
        yield strings(found)
    if words:
        yield worded(words)


def _find(sorted_: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Places of the wanted numbers, -1 where absent."""
    if not len(sorted_):
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(sorted_, wanted), len(sorted_) - 1)
    return np.where(sorted_[at] == wanted, at, -1)


def _suffix(string: str, k: int) -> Column:
    """The last k symbols."""
    return F.col(string).bitwiseAND((1 << (BITS * k)) - 1)


def _trie(top: DataFrame) -> tuple[list[DataFrame], list[DataFrame]]:
    """By order: nodes (string, n); contexts (context, whole, escape, rest, rest_escape).

    `whole` is the denominator of a context that nothing is excluded from; `rest` and
    `rest_escape` are the same two of its suffix, once this context's symbols are excluded.
    """
    each = [F.struct(F.lit(k).alias("k"), _suffix("string", k + 1).alias("s")) for k in range(ORDER + 1)]
    all_ = top.select(F.explode(F.array(*each)).alias("of"), "n").groupBy("of.k", "of.s").agg(F.sum("n").alias("n"))
    all_ = store(all_.withColumnRenamed("s", "string"), "nodes")
    positions = all_.where("k = 0").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first().n
    stays = F.col("n") >= max(1.0, positions * SHARE)
    sums = all_.groupBy("k", F.shiftright("string", BITS).alias("context")).agg(
        F.sum("n").alias("total"), F.sum(F.when(stays, F.col("n"))).alias("own"), F.count(F.when(stays, 1)).alias("kinds")
    )
    sums = store(sums.where("kinds > 0"), "contexts")
    all_ = all_.where(stays)

    nodes = [all_.where(F.col("k") == k).select("string", "n") for k in range(ORDER + 1)]
    contexts = []
    for k in range(ORDER + 1):
        own = sums.where(F.col("k") == k)
        whole, escape = F.col("total") + F.col("kinds"), F.col("total") - F.col("own") + F.col("kinds")
        if not k:
            one = F.lit(1).cast("long")
            contexts.append(own.select("context", whole.alias("whole"), escape.alias("escape"), one.alias("rest"), one.alias("rest_escape")))
            continue
        below = nodes[k - 1].select(F.col("string").alias("suffix"), F.col("n").alias("less"))
        less = nodes[k].select("string", _suffix("string", k).alias("suffix")).join(below, "suffix")
        less = less.groupBy(F.shiftright("string", BITS).alias("context")).agg(F.sum("less").alias("excluded"))
        shorter = sums.where(F.col("k") == k - 1).select(
            F.col("context").alias("suffix"), F.col("total").alias("b_total"), F.col("own").alias("b_own"), F.col("kinds").alias("b_kinds")
        )
        if k <= 2:  # 66,000 contexts at most
            shorter = F.broadcast(shorter)
        both = own.join(less, "context").withColumn("suffix", _suffix("context", k - 1)).join(shorter, "suffix")
        rest_escape = F.col("b_total") - F.col("b_own") + F.col("b_kinds") - F.col("kinds")
        rest = F.col("b_total") - F.col("excluded") + F.col("b_kinds") - F.col("kinds")
        # nothing left to predict or to escape from: the shorter context is passed over
        left = lambda x: F.when(rest_escape > 0, x).otherwise(1)
        contexts.append(both.select(
            "context", whole.alias("whole"), escape.alias("escape"), left(rest).alias("rest"), left(rest_escape).alias("rest_escape")
        ))
    return nodes, contexts


def _values(top: DataFrame) -> DataFrame:
    """(string, seen, log): the natural log of the probability of each string's last symbol after the others."""
    nodes, contexts = _trie(top.where("n > 0").select("string", "n"))
    kinds = nodes[0].count()
    known = nodes[ORDER].join(contexts[ORDER].select("context", "whole"), F.shiftright("string", BITS) == F.col("context"))
    known = known.select(F.col("string").alias("node"), (F.log("n") - F.log("whole")).alias("known"))
    known = store(top.select("string", "seen").join(known, F.col("string") == F.col("node"), "left").drop("node"), "known")

    # Strings that no training text holds escape from order to order.
    open_ = known.where("known is null").select("string", "seen")
    open_ = open_.withColumns({"log": F.lit(0.0), "hit": F.lit(False), **{c: F.lit(None).cast("long") for c in ("bottom", "pay")}})
    for k in range(ORDER, -1, -1):
        node = nodes[k].select(F.col("string").alias("node"), "n")
        context = contexts[k]
        if k <= 1:  # 66,000 strings at most
            node = F.broadcast(node)
        if k <= 2:
            context = F.broadcast(context)
        g = open_.withColumn("wanted", _suffix("string", k + 1)).withColumn("before", F.shiftright("wanted", BITS))
        g = g.join(context, F.col("before") == F.col("context"), "left").join(node, F.col("wanted") == F.col("node"), "left")
        bottom, pay = F.coalesce("bottom", "whole"), F.coalesce("pay", "escape")
        step = F.when(F.col("n").isNotNull(), F.log("n") - F.log(bottom)).when(
            F.col("context").isNotNull(), F.log(pay) - F.log(bottom)
        ).otherwise(0.0)
        open_ = g.select(
            "string", "seen", F.when(F.col("hit"), F.col("log")).otherwise(F.col("log") + step).alias("log"),
            (F.col("hit") | F.col("n").isNotNull()).alias("hit"), F.col("rest").alias("bottom"), F.col("rest_escape").alias("pay"),
        )
    left = F.when(F.col("bottom").isNotNull(), F.log(F.lit(float(max(SYMBOLS - kinds, 1))))).otherwise(F.log(F.lit(float(SYMBOLS))))
    open_ = open_.select("string", "seen", F.when(F.col("hit"), F.col("log")).otherwise(F.col("log") - left).alias("log"))
    return store(known.where("known is not null").withColumnRenamed("known", "log").unionByName(open_), "values")


@dataclass
class Trained:
    strings: np.ndarray  # the frequent ones, sorted
    logs: np.ndarray
    words: dict[bytes, int]  # the frequent ones
    documents: int
    tokens: int
    kinds: int


def _with_fold(docs: DataFrame) -> DataFrame:
    return narrow(docs, doc_id="long", text="string").withColumn("held_out", crc32_mod(F.col("doc_id"), FOLDS) == HELD_OUT)


def train(docs: DataFrame) -> tuple[Trained, DataFrame, DataFrame]:
    """The model from all documents outside the held-out fold, the counts (word, n) of all
    rarer words, and the values (string, log) of all rarer strings of any document."""
    one = _with_fold(docs).select("text", (~F.col("held_out")).alias("train"))
    counted = bounded(one).mapInPandas(_count, "string long, word binary, n long, seen long")
    counted = store(counted.groupBy("string", "word").agg(F.sum("n").alias("n"), F.sum("seen").alias("seen")), "counts")

    top = counted.where("string is not null")
    values = _values(top)
    places = top.agg(F.coalesce(F.sum("seen"), F.lit(0)).alias("n")).first().n
    most = max(1.0, places * COMMON_SHARE)
    frequent = values.where(F.col("seen") >= most).select("string", "log").toArrow()
    strings, logs = (frequent.column(c).to_numpy() for c in ("string", "log"))
    order = np.argsort(strings)

    words = counted.where("word is not null").select("word", "n")
    size = words.agg(F.count(F.lit(1)).alias("kinds"), F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()
    documents = one.where("train").count()
    often = max(1.0, size.n * WORD_SHARE)
    common = {bytes(r.word): r.n for r in words.where(F.col("n") >= often).toLocalIterator()}
    trained = Trained(strings[order], logs[order], common, documents, size.n + documents, size.kinds + (documents > 0))
    return trained, words.where(F.col("n") < often), values.where(F.col("seen") < most).select("string", "log")


SCHEMA = (
    "doc_id long, held_out boolean, n_tokens long, known long, logs double, score double, "
    "rare array<binary>, times array<int>, strings array<long>, places array<int>"
)


def _score(trained: Trained, batch: pd.DataFrame) -> pd.DataFrame:
    texts = [lowered(t) for t in batch["text"]]
    strings, owner = strings_of(texts)
    code, unique = pd.factorize(strings)
    at = _find(trained.strings, unique)
    logs_of = np.where(at >= 0, trained.logs[at], 0.0) if len(trained.strings) else np.zeros(len(unique))
    score = np.bincount(owner, weights=logs_of[code], minlength=len(texts))
    rarer = at[code] < 0
    each, places = np.unique(owner[rarer] * len(unique) + code[rarer], return_counts=True)
    parts = np.searchsorted(each, np.arange(1, len(texts)) * len(unique))
    own, places = np.split(unique[each % max(len(unique), 1)], parts), np.split(places.astype(np.int32), parts)
    common, rows = trained.words, []
    for text in texts:
        found = Counter(text.split())
        known, logs, rare, times = int(trained.documents > 0), log10(trained.documents + 1), [], []
        for word, n in found.items():
            c = common.get(word)
            if c is None:
                rare.append(word)
                times.append(n)
            else:
                known += n
                logs += n * log10(c + 1)
        rows.append((sum(found.values()) + 1, known, logs, rare, times))
    out = pd.DataFrame(rows, columns=["n_tokens", "known", "logs", "rare", "times"])
    out.insert(0, "doc_id", batch["doc_id"].array)
    out.insert(1, "held_out", batch["held_out"].to_numpy())
    out.insert(5, "score", score)
    out["strings"], out["places"] = own, places
    return out


def score(docs: DataFrame) -> DataFrame:
    """One row per row of `docs`: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    `score` is the trie's log10 probability of the text's bytes and its end; `base_score`
    that of its words and its end under add-one unigrams.  Null texts are empty and have
    their end alone.  Repeated rows are scored each for itself; a null id is trained on.
    Without training text every symbol is equally likely and every word unknown.  Other
    columns are not read; an empty table gives an empty result.
    """
    trained, rarer, values = train(docs)
    share = docs.sparkSession.sparkContext.broadcast(trained)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield _score(share.value, batch)

    scored = bounded(_with_fold(docs)).mapInPandas(run, SCHEMA).withColumn("row", F.monotonically_increasing_id())
    scored = store(scored, "scored")
    rare = scored.select("row", F.explode(F.arrays_zip("rare", "times")).alias("of")).select("row", "of.rare", "of.times")
    counted = rare.join(rarer, rare["rare"] == rarer["word"])
    sums = counted.groupBy("row").agg(
        F.sum("times").alias("more"), F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("more_logs")
    )
    open_ = scored.select("row", F.explode(F.arrays_zip("strings", "places")).alias("of")).select("row", "of.strings", "of.places")
    found = open_.join(values, open_["strings"] == values["string"])
    found = found.groupBy("row").agg(F.sum(F.col("places") * F.col("log")).alias("more_score"))
    zero, bottom = F.lit(0), float(np.log10(trained.tokens + trained.kinds + 1))
    joined = scored.drop("rare", "times", "strings", "places").join(sums, "row", "left").join(found, "row", "left")
    return joined.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("more", zero)).alias("n_known"),
        F.lit(trained.tokens).cast("long").alias("train_tokens"),
        (F.col("logs") + F.coalesce("more_logs", zero) - F.col("n_tokens") * bottom).alias("base_score"),
        ((F.col("score") + F.coalesce("more_score", F.lit(0.0))) / float(np.log(10))).alias("score"),
    )
