"""Near duplicates by ProbMinHash signatures, banding, and exact verification.

A text is the weighted set of its five-word shingles; one that occurs n times weighs
1 + ln n, so that a line repeated a thousand times does not outweigh the rest.  Every shingle is a Poisson process of that rate, whose arrivals fall on random
components of the signature; a component keeps its first arrival.  A shingle stops as soon
as its next arrival is later than all that its text has kept, so most stop at once.  Two
texts agree in a component with the probability Jaccard similarity of their shingles.

A text that repeats shingles has a second signature, in which every shingle weighs 1, so
that components agree with the Jaccard similarity of the shingle sets; where nothing repeats
the two are one.  Their bands lie side by side, equal bands count once.

Texts that agree in a whole band are candidates.  Candidates are verified on their texts:
a link is a Jaccard similarity of the shingle sets of 0.8 or more.  Classes are the
connected components of the links.

A bucket of a few texts is verified pair by pair.  In a larger one all members are first
held against its most central member, which connects most of them.  Whatever is left
outside a bucket's largest component is then held against each member outside its own,
unless an exact bound shows that the two cannot be linked: they share at most what both
share with the central member, and of the rest only shingles that another text holds too.
So no pair that shares a bucket is left undecided, and a bucket of thousands of near copies
costs a few comparisons for each.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomstar.llm.common import bounded, drop_unkept, if_small, join_sized, narrow, store, text_md5
from loomstar.llm.components import components, more_components
from loomstar.llm.words import flat, hashed, mix, windows

WIDTH = 5
SIMILARITY = 0.8
#: 25 bands of 4 components: texts at set similarity 0.8 share a band but for one pair in
#: 500,000, whatever they repeat; at 0.5 four fifths do, at 0.1 one in four hundred.
BANDS, ROWS = 25, 4
#: Buckets up to this size are verified pair by pair: 28 pairs at most.
SMALL_BUCKET = 8
#: Ids of candidate texts travel by broadcast up to this many (about 60 bytes each).
BROADCAST_ROWS = 100_000

_WORD = re.compile(r"\w+")
_STEP = np.uint64(0x9E3779B97F4A7C15)  # fixed value: an odd 64-bit multiplier


def word_lists(texts: list[str | None]) -> list[list[str]]:
    """Lower-cased runs of letters, digits and underscores."""
    return [_WORD.findall((t or "").lower()) for t in texts]


def shingles(words: list[list[str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text: (hash, text, times).  One to four words make one shingle."""
    items, sizes = flat(words)
    one = hashed(items)
    found, owner, _ = windows(one, sizes, WIDTH)
    starts = np.cumsum(sizes) - sizes
    short = np.flatnonzero((sizes > 0) & (sizes < WIDTH))
    for k in range(1, WIDTH):
        of = short[sizes[short] == k]
        h = np.full(len(of), k, np.uint64)
        for j in range(k):
            h = mix(h * _STEP + one[starts[of] + j])
        found, owner = np.concatenate([found, h]), np.concatenate([owner, of])
    code, unique = pd.factorize(mix(found + mix(owner.astype(np.uint64) + np.uint64(1))))
    first = np.zeros(len(unique), np.int64)
    first[code[::-1]] = np.arange(len(code))[::-1]
    return found[first], owner[first], np.bincount(code, minlength=len(unique))


def signatures(h: np.ndarray, owner: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
    """ProbMinHash signatures, `n` rows of BANDS * ROWS; a row without shingles is zero."""
    m = BANDS * ROWS
    best, kept = np.full(n * m, np.inf), np.zeros(n * m, np.uint64)
    clock, rate = np.zeros(len(h)), weight.astype(float)
    arrival = np.zeros(1, np.uint64)
    while len(h):
        arrival += np.uint64(1)
        draw = mix(h + arrival * _STEP)
        clock = clock - np.log1p(-(draw >> np.uint64(11)).astype(float) * 2.0**-53) / rate
        place = owner * m + (mix(draw) % np.uint64(m)).astype(np.int64)
        np.minimum.at(best, place, clock)
        won = clock == best[place]
        kept[place[won]] = h[won]
        rows = np.unique(owner)
        latest = np.zeros(n)
        latest[rows] = best.reshape(n, m)[rows].max(axis=1)
        on = clock < latest[owner]
        h, owner, rate, clock = h[on], owner[on], rate[on], clock[on]
    return kept.reshape(n, m)


def band_hashes(signature: np.ndarray) -> np.ndarray:
    """One number per band; equal parts of different bands differ."""
    out = np.arange(1, BANDS + 1, dtype=np.uint64)[None, :] * _STEP
    for k in range(ROWS):
        out = mix(out + signature[:, k::ROWS])
    return out.view(np.int64)


def bands_of(h: np.ndarray, owner: np.ndarray, times: np.ndarray, n: int) -> list[np.ndarray]:
    """Each text's distinct bands, of its weighted shingles and of its shingle set."""
    out = [np.unique(x) for x in band_hashes(signatures(h, owner, 1 + np.log(times), n))]
    again = np.unique(owner[times > 1])
    own = np.isin(owner, again)
    plain = band_hashes(signatures(h[own], np.searchsorted(again, owner[own]), np.ones(own.sum()), len(again)))
    for k, x in zip(again, plain):
        out[k] = np.union1d(out[k], x)
    return out


def _sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    from hashlib import blake2b

    for batch in batches:
        words = word_lists(batch["text"].tolist())
        h, owner, times = shingles(words)
        bands = bands_of(h, owner, times, len(words))
        yield pd.DataFrame({
            "doc_id": batch["doc_id"].array,
            "text_md5": batch["text_md5"],
            "words": [blake2b(" ".join(w).encode("utf-8", "surrogatepass"), digest_size=16).digest() for w in words],
            "bands": [list(b) if w else [] for b, w in zip(bands, words)],
        })


def _compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Jaccard similarity of the shingle sets of each row's two texts."""
    for batch in batches:
        unit = pd.concat([batch["a"], batch["b"]], ignore_index=True)
        text = pd.concat([batch["text_a"], batch["text_b"]], ignore_index=True)
        code, unique = pd.factorize(unit)
        first = np.zeros(len(unique), np.int64)
        first[code[::-1]] = np.arange(len(code))[::-1]
        h, owner, _ = shingles(word_lists(text.iloc[first].tolist()))
        order = np.lexsort((h, owner))
        sets = np.split(h[order], np.searchsorted(owner[order], np.arange(1, len(unique))))
        n = len(batch)
        shared = np.fromiter(
            (len(np.intersect1d(sets[x], sets[y], assume_unique=True)) for x, y in zip(code[:n], code[n:])), float, n
        )
        sizes = np.fromiter(map(len, sets), float, len(sets))
        union = sizes[code[:n]] + sizes[code[n:]] - shared
        yield pd.DataFrame({"a": batch["a"], "b": batch["b"], "similarity": shared / np.maximum(union, 1)})


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """(a, b, similarity) of some pairs, a < b."""
    own = lambda side: texts.select(F.col("unit").alias(side), F.col("text").alias(f"text_{side}"))
    with_texts = pairs.join(own("a"), "a").join(own("b"), "b")
    return store(bounded(with_texts).mapInPandas(_compare, "a long, b long, similarity double"), "verified")


def _ordered(x: str, y: str) -> list[Column]:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def _order() -> Column:
    """Which row of a class stays: the least doc_id, a null one last, then the first row."""
    return F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row")


def _units(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All rows with their row number and word sequence; one unit per distinct word sequence that has words."""
    one = narrow(docs, doc_id="long", text="string").withColumn("text_md5", text_md5(F.col("text")))
    signed = bounded(one).mapInPandas(_sign, "doc_id long, text_md5 string, words binary, bands array<long>")
    rows = store(signed.withColumn("row", F.monotonically_increasing_id()), "signed")
    first = F.min(F.struct("row", "doc_id", "text_md5", "bands"))
    units = rows.where(F.size("bands") > 0).groupBy("words").agg(
        first.alias("of"), F.count(F.lit(1)).alias("n"), F.min(_order()).alias("best")
    )
    unit = F.col("of.row").alias("unit")
    return rows, store(units.select("words", unit, "of.doc_id", "of.text_md5", "of.bands", "n", "best"), "units")


def _linked(docs: DataFrame, units: DataFrame) -> DataFrame:
    """(unit, component) of all units that are linked with another."""
    members = units.select("unit", F.explode("bands").alias("bucket"))
    sizes = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    shared = store(join_sized(members, store(sizes, "sizes"), "bucket", "size"), "buckets")

    wanted = shared.select("unit").distinct().join(units.select("unit", "doc_id", "text_md5"), "unit")
    wanted = if_small(store(wanted, "candidates"), BROADCAST_ROWS)
    one = narrow(docs, doc_id="long", text="string").withColumn("text_md5", text_md5(F.col("text")))
    same = one["doc_id"].eqNullSafe(wanted["doc_id"]) & (one["text_md5"] == wanted["text_md5"])
    texts = store(one.join(wanted, same).select("unit", F.coalesce("text", F.lit("")).alias("text")), "texts")
    if texts.count() > wanted.count():  # rows that repeat id and text
        texts = store(texts.dropDuplicates(["unit"]), "texts")

    # Small buckets pair by pair, large ones against their most central member.
    small = shared.where(F.col("size") <= SMALL_BUCKET).select("bucket", "unit")
    pairs = small.join(small.withColumnRenamed("unit", "other"), "bucket").where("unit < other")
    pairs = pairs.select(F.col("unit").alias("a"), F.col("other").alias("b"))
    central = shared.groupBy("unit").agg(F.sum("size").alias("weight"))
    large = store(shared.where(F.col("size") > SMALL_BUCKET).join(central, "unit"), "large-buckets")
    rank = F.struct("weight", (-F.col("unit")).alias("less"))
    leaders = large.groupBy("bucket").agg((-F.max(rank)["less"]).alias("leader"), F.first("size").alias("members"))
    led = join_sized(large, store(leaders, "leaders"), "bucket", "members")
    led = store(led.select("bucket", "unit", "leader", *_ordered("unit", "leader")), "led")
    done = _verified(pairs.unionByName(led.where("a <> b").select("a", "b")).distinct(), texts)
    found = store(components(done.where(F.col("similarity") >= SIMILARITY).select("a", "b")), "components")
    if large.isEmpty():
        return found
    alike = F.when(F.col("a") == F.col("b"), 1.0).otherwise(F.col("similarity")).alias("alike")
    members = led.join(done, ["a", "b"], "left").select("bucket", "unit", "leader", alike)
    rest = _undecided(members, if_small(found, BROADCAST_ROWS), units, texts)
    more = _verified(rest.join(done.select("a", "b"), ["a", "b"], "left_anti"), texts)
    return store(more_components(found, more.where(F.col("similarity") >= SIMILARITY).select("a", "b")), "components")


def _shingle_sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        h, owner, _ = shingles(word_lists(batch["text"].tolist()))
        order = np.argsort(owner, kind="stable")
        sets = np.split(h[order].view(np.int64), np.searchsorted(owner[order], np.arange(1, len(batch))))
        yield pd.DataFrame({"unit": batch["unit"], "shingles": sets})


def _undecided(members: DataFrame, found: DataFrame, units: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs (a, b) of large buckets that are in two components and may still be linked.

    `members` are (bucket, unit, leader, alike): the similarity to the bucket's central member.
    Two texts can share at most what both share with that member, and of what else they
    have, only shingles that some other text holds as well.
    """
    placed = members.join(found, "unit", "left").withColumn("component", F.coalesce("component", "unit"))
    sizes = placed.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("n"))
    largest = sizes.groupBy("bucket").agg(
        F.max(F.struct("n", "component"))["component"].alias("largest"), F.count(F.lit(1)).alias("components"), F.sum("n").alias("members")
    )
    largest = store(largest.where("components > 1").drop("components"), "largest")
    placed = store(join_sized(placed, largest, "bucket", "members").drop("members"), "undecided")

    # Shingles of each member, and how many of them another member has as well.
    universe = placed.select("unit").distinct()
    sets = bounded(texts.join(universe, "unit")).mapInPandas(_shingle_sets, "unit long, shingles array<long>")
    each = sets.select("unit", F.explode("shingles").alias("shingle"))
    alone = each.groupBy("shingle").agg(F.count(F.lit(1)).alias("n"), F.min("unit").alias("unit")).where("n = 1")
    alone = alone.groupBy("unit").agg(F.count(F.lit(1)).alias("alone"))
    total = sets.select("unit", F.size("shingles").alias("total"))
    counts = total.join(alone, "unit", "left").select("unit", "total", (F.col("total") - F.coalesce("alone", F.lit(0))).alias("held"))
    counts = store(counts, "held")
    leaders = counts.select(F.col("unit").alias("leader"), F.col("total").alias("leader_total"))
    # Fewer than SIMILARITY of a text's own shingles elsewhere: no link at all.
    counts = counts.where(F.col("held") >= (SIMILARITY - 1e-9) * F.col("total"))
    placed = placed.join(counts, "unit").join(leaders, "leader").join(units.select("unit", "bands"), "unit")
    common = F.round(F.col("alike") * (F.col("total") + F.col("leader_total")) / (1 + F.col("alike")))
    placed = placed.withColumn("common", common).withColumn("extra", F.col("held") - F.col("common"))
    columns = ["unit", "component", "largest", "total", "common", "extra", "bands"]
    placed = store(placed.select("bucket", *columns), "may-be-linked")

    outside = placed.where("component <> largest").select("bucket", *(F.col(c).alias(f"_{c}") for c in columns))
    overlap = F.least("common", "_common") + F.least("extra", "_extra")
    possible = (
        (F.col("component") != F.col("_component"))
        & ((F.col("component") == F.col("largest")) | (F.col("unit") < F.col("_unit")))
        & (overlap >= (SIMILARITY - 1e-9) * (F.col("total") + F.col("_total") - overlap))
        # a pair that shares several buckets is taken in one of them
        & (F.array_min(F.array_intersect("bands", "_bands")) == F.col("bucket"))
    )
    pairs = placed.withColumnRenamed("bucket", "own").join(outside, (F.col("own") == F.col("bucket")) & possible)
    return pairs.select(*_ordered("unit", "_unit"))


def near_dedup(docs: DataFrame) -> DataFrame:
    """One row per row of `docs`: doc_id, class_id, class_size, kept, text_md5.

    `class_id` is the least doc_id of the class; that row stays (of rows that repeat it,
    exactly one; a null id is last).  Texts with equal word sequences are one class, but
    null, empty and wordless texts are alone.  Texts of one to four words count as one
    shingle.  Other columns are not read; an empty table gives an empty result.
    """
    rows, units = _units(docs)
    found = if_small(_linked(docs, units), BROADCAST_ROWS)
    linked = store(units.select("words", "unit", "n", "best").join(found, "unit", "left"), "linked")
    members = linked.where("component is not null")
    sums = [F.sum("n").alias("class_size"), F.min("best").alias("of")]
    classes = store(members.groupBy("component").agg(*sums, F.count(F.lit(1)).alias("units")), "classes")
    joined = join_sized(members, classes, "component", "units").select("words", "n", "class_size", "of")
    single = linked.where("component is null").select("words", "n", F.col("n").alias("class_size"), F.col("best").alias("of"))
    of_words = store(joined.unionByName(single), "of-words")

    each = rows.select("doc_id", "text_md5", "row", "words", (F.size("bands") == 0).alias("wordless"))
    named = join_sized(each.where("not wordless"), of_words, "words", "n")
    alone = each.where("wordless").withColumns({"class_size": F.lit(1).cast("long"), "of": _order()})
    columns = ["doc_id", "text_md5", "row", "class_size", "of"]
    return named.select(*columns).unionByName(alone.select(*columns)).select(
        "doc_id", F.col("of.doc_id").alias("class_id"), "class_size", (F.col("row") == F.col("of.row")).alias("kept"), "text_md5"
    )


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """`docs`, all its columns, one document of each class."""
    return drop_unkept(docs, near_dedup(docs))
