"""Benchmark decontamination with one Aho-Corasick automaton over the test items.

Every item is cut into windows of ten words (an item of fewer is one window).  All windows
make one automaton.  A document is normalised to the same words and passes the automaton
once, whatever the number of windows; each match is a run of words, and runs are mapped
back to code points of the original text.

The automaton works on words, not letters: a word of the benchmark is two symbols of two
disjoint alphabets, so that a node has few children and a match can only begin and end at a
word's edge.  All other words are one pair of symbols that no window holds.

A task holds one automaton at a time.  A benchmark of more windows than one may hold is
dealt by hash into several, each a scan of its own; their matches are merged by document.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomstar.llm.common import bounded, narrow, store

WIDTH = 10
#: What one automaton may hold: windows (about 1 kB each) and bytes of their words.
MAX_WINDOWS, MAX_BYTES = 60_000, 32 << 20

_KEPT = b"0123456789abcdefghijklmnopqrstuvwxyz"
_TABLE = bytes(c if c >= 0x80 or c in _KEPT else c + 32 if 65 <= c <= 90 else 32 for c in range(256))
_PLACE = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_OTHER = "\0\0"

#: Runs of words that some window covers: from code point `start` to before `end`.
SPANS = "array<struct<start:int,end:int>>"
_FOUND = f"row long, doc_id long, n_words long, n_hit long, items array<string>, runs array<array<int>>, spans {SPANS}"


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased runs of ASCII letters and digits and of all other characters, as UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_TABLE).split()


def windows_of(words: list[bytes]) -> list[list[bytes]]:
    return [words[k : k + WIDTH] for k in range(max(1, len(words) - WIDTH + 1))] if words else []


def _windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for item, text in zip(batch["item_id"], batch["text"]):
            found = list({b" ".join(w) for w in windows_of(words_of(text))})
            for k in range(0, len(found), 10_000):
                yield pd.DataFrame({"item": item, "window": found[k : k + 10_000]})


class _Codes(dict):
    def __missing__(self, word: bytes) -> str:
        return _OTHER


class Scanner:
    """The automaton of some windows: `windows` maps a window to the items that hold it."""

    def __init__(self, windows: dict[bytes, list[str]]):
        import ahocorasick

        known = sorted({w for window in windows for w in window.split()})
        base = max(127, int(len(known) ** 0.5) + 1)
        second = 1 + len(known) // base + 1
        self.codes = _Codes((w, chr(1 + k // base) + chr(second + k % base)) for k, w in enumerate(known))
        self.automaton = ahocorasick.Automaton()
        for window, items in windows.items():
            words = window.split()
            self.automaton.add_word("".join(map(self.codes.__getitem__, words)), (len(words), items))
        self.empty = not windows
        if windows:
            self.automaton.make_automaton()

    def __call__(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Runs of hit words, from one word to before another, and the items found."""
        runs: list[tuple[int, int]] = []
        items: set[str] = set()
        if self.empty:
            return runs, items
        for at, (n, own) in self.automaton.iter("".join(map(self.codes.__getitem__, words))):
            end = at // 2 + 1
            begin = end - n
            while runs and runs[-1][1] >= begin:
                begin = min(begin, runs.pop()[0])
            runs.append((begin, end))
            items.update(own)
        return runs, items


def spans_of(text: str, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Code points of the original text that runs of words stand on."""
    if not runs:
        return []
    places = [m.span() for m in _PLACE.finditer(text)]
    return [(places[a][0], places[b - 1][1]) for a, b in runs]


_last: list = [None, None]


def _scanner(windows: dict[bytes, list[str]]) -> Scanner:
    """One for each Python worker and broadcast; a worker keeps the last one only."""
    if _last[0] is not windows:
        _last[:] = windows, Scanner(windows)
    return _last[1]


def _scan(share, hits_only: bool):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scan = _scanner(share.value)
        for batch in batches:
            rows = []
            for row, doc_id, text in zip(batch["row"], batch["doc_id"].array, batch["text"]):
                words = words_of(text)
                runs, items = scan(words)
                if runs or not hits_only:
                    hit = sum(b - a for a, b in runs)
                    rows.append((row, doc_id, len(words), hit, sorted(items), runs, spans_of(text, runs)))
            if rows:
                yield _frame(rows)

    return run


def _frame(rows: list[tuple]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=["row", "doc_id", "n_words", "n_hit", "items", "runs", "spans"])
    out["doc_id"] = out["doc_id"].astype("Int64")
    out["spans"] = pd.Series([[{"start": a, "end": b} for a, b in s] for s in out["spans"]], dtype=object)
    return out


def _merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One document's matches of several automata as one."""
    for batch in batches:
        rows = []
        for b in batch.itertuples():
            runs: list[tuple[int, int]] = []
            for begin, end in sorted((int(a), int(z)) for part in b.runs for a, z in part):
                if runs and runs[-1][1] >= begin:
                    begin, end = runs[-1][0], max(end, runs.pop()[1])
                runs.append((begin, end))
            items = sorted({x for part in b.items for x in part})
            rows.append((b.row, None, 0, sum(z - a for a, z in runs), items, runs, spans_of(b.text, runs)))
        yield _frame(rows)


def _dealt(benchmark: DataFrame) -> tuple[DataFrame, int]:
    """(item, window) of all items, and into how many automata the bounds ask to deal them."""
    name = F.coalesce(F.col("item_id"), F.lit("")).alias("item_id")
    items = narrow(benchmark, item_id="string", text="string").select(name, "text")
    pairs = store(bounded(items).mapInPandas(_windows, "item string, window binary").distinct(), "windows")
    size = pairs.agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("window") + F.length("item")).alias("bytes")).first()
    return pairs, max(1, -(-size.n // MAX_WINDOWS), -(-(size.bytes or 0) // MAX_BYTES))


def _block(pairs: DataFrame, n: int, k: int) -> dict[bytes, list[str]]:
    """The k-th of n parts of the windows, within the bounds of one automaton."""
    block: dict[bytes, list[str]] = {}
    for r in pairs.where(F.pmod(F.xxhash64("item", "window"), F.lit(n)) == k).collect():
        block.setdefault(bytes(r.window), []).append(r.item)
    return block


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per row of `docs`: doc_id, n_words, n_hit, n_items, items, spans, contaminated.

    `items` are the ids, as sorted strings, of the items with a window in the text; `spans`
    the code points from the first to the last character of each run of hit words.  Null,
    empty and wordless texts have no words and are clean; such items have no window.  Rows
    that repeat an item id are one item, a null id is an empty string.  Repeated documents
    are judged alike; other columns are not read; an empty table gives an empty result.
    """
    context = docs.sparkSession.sparkContext
    one = narrow(docs, doc_id="long", text="string")
    pairs, n = _dealt(benchmark)

    def scanned(rows: DataFrame, windows: dict[bytes, list[str]], hits_only: bool) -> DataFrame:
        return bounded(rows).mapInPandas(_scan(context.broadcast(windows), hits_only), _FOUND)

    if n == 1:
        found = scanned(one.withColumn("row", F.lit(0).cast("long")), _block(pairs, 1, 0), False)
    else:
        one = store(one.withColumn("row", F.monotonically_increasing_id()), "documents")
        parts = [store(scanned(one, _block(pairs, n, k), True).select("row", "items", "runs"), "matches") for k in range(n)]
        each = reduce(DataFrame.unionByName, parts).groupBy("row")
        each = each.agg(F.collect_list("items").alias("items"), F.collect_list("runs").alias("runs"))
        hits = bounded(one.join(each, "row")).mapInPandas(_merge, _FOUND).select("row", F.col("n_hit").alias("hit"), "items", "spans")
        words = scanned(one, {}, False).select("row", "doc_id", "n_words")
        none = lambda c, kind: F.coalesce(c, F.array().cast(kind)).alias(c)
        found = words.join(hits, "row", "left").select(
            "doc_id", "n_words", F.coalesce("hit", F.lit(0).cast("long")).alias("n_hit"),
            none("items", "array<string>"), none("spans", SPANS),
        )
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), "items", "spans",
        (F.col("n_hit") > 0).alias("contaminated"),
    )
