"""Licence scan with a positional rare-token index.

Licence templates are indexed by word and position.  A first pass over all documents
counts in how many each licence word occurs.  A document then looks up its licence words
of the highest IDF only: for every template, the rarest words of its mandatory phrases.
Their postings, shifted by position, must meet at one place of the document; there the
mandatory phrases are verified word by word and the rest of the template is weighed by IDF.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomstar.llm.common import bounded, narrow

# Notices of public licences, each with phrases without which it is not that licence.
TEMPLATES: list[tuple[str, str, list[str]]] = [
    ("mit", "released under the mit license", ["the mit license"]),
    ("mit",
     "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
     "documentation files the software to deal in the software without restriction including without limitation the "
     "rights to use copy modify merge publish distribute sublicense and or sell copies of the software",
     ["permission is hereby granted free of charge", "to deal in the software without restriction"]),
    ("mit",
     "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
     "documentation files the software to deal in the software without restriction including without limitation the "
     "rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit "
     "persons to whom the software is furnished to do so subject to the following conditions the above copyright notice "
     "and this permission notice shall be included in all copies or substantial portions of the software the software is "
     "provided as is without warranty of any kind express or implied including but not limited to the warranties of "
     "merchantability fitness for a particular purpose and noninfringement in no event shall the authors or copyright "
     "holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise "
     "arising from out of or in connection with the software or the use or other dealings in the software",
     ["permission is hereby granted free of charge", "this permission notice shall be included in all copies",
      "the authors or copyright holders be liable for any claim"]),
    ("apache-2", "licensed under the apache license version 2 0", ["apache license version 2"]),
    ("apache-2",
     "licensed under the apache license version 2 0 the license you may not use this file except in compliance with "
     "the license", ["apache license version 2", "except in compliance with the license"]),
    ("apache-2",
     "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the "
     "license you may obtain a copy of the license at http www apache org licenses license 2 0 unless required by "
     "applicable law or agreed to in writing software distributed under the license is distributed on an as is basis "
     "without warranties or conditions of any kind either express or implied see the license for the specific language "
     "governing permissions and limitations under the license",
     ["apache license version 2", "distributed on an as is basis", "governing permissions and limitations under the license"]),
    ("bsd",
     "redistribution and use in source and binary forms with or without modification are permitted provided that the "
     "following conditions are met", ["redistribution and use in source and binary forms"]),
    ("bsd",
     "redistribution and use in source and binary forms with or without modification are permitted provided that the "
     "following conditions are met redistributions of source code must retain the above copyright notice this list of "
     "conditions and the following disclaimer redistributions in binary form must reproduce the above copyright notice "
     "this list of conditions and the following disclaimer in the documentation and or other materials provided with the "
     "distribution",
     ["redistribution and use in source and binary forms", "redistributions of source code must retain",
      "redistributions in binary form must reproduce"]),
    ("isc",
     "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
     "granted", ["distribute this software for any purpose", "with or without fee"]),
    ("isc",
     "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted "
     "provided that the above copyright notice and this permission notice appear in all copies the software is provided as "
     "is and the author disclaims all warranties with regard to this software including all implied warranties of "
     "merchantability and fitness",
     ["distribute this software for any purpose", "this permission notice appear in all copies", "the author disclaims all warranties"]),
    ("gpl-3", "licensed under the gnu general public license version 3", ["gnu general public license", "version 3"]),
    ("gpl-2", "licensed under the gnu general public license version 2", ["gnu general public license", "version 2"]),
    ("gpl-3",
     "this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
     "license as published by the free software foundation either version 3 of the license or at your option any later "
     "version", ["gnu general public license", "published by the free software foundation", "version 3"]),
    ("gpl-2",
     "this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
     "license as published by the free software foundation either version 2 of the license or at your option any later "
     "version", ["gnu general public license", "published by the free software foundation", "version 2"]),
    ("lgpl", "licensed under the gnu lesser general public license", ["gnu lesser general public license"]),
    ("lgpl",
     "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general "
     "public license as published by the free software foundation either version 2 1 of the license or at your option any "
     "later version", ["gnu lesser general public license", "published by the free software foundation"]),
    ("agpl", "licensed under the gnu affero general public license", ["gnu affero general public license"]),
    ("agpl",
     "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general "
     "public license as published by the free software foundation either version 3 of the license or at your option any "
     "later version", ["gnu affero general public license", "published by the free software foundation"]),
    ("mpl-2",
     "this source code form is subject to the terms of the mozilla public license v 2 0", ["mozilla public license v 2"]),
    ("mpl-2",
     "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not "
     "distributed with this file you can obtain one at http mozilla org mpl 2 0",
     ["mozilla public license v 2", "if a copy of the mpl was not distributed with this file"]),
    ("epl-2", "made available under the terms of the eclipse public license 2 0", ["eclipse public license"]),
    ("epl-2",
     "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0 "
     "which is available at https www eclipse org legal epl 2 0",
     ["the accompanying materials are made available", "eclipse public license"]),
    ("cc-by-nc", "licensed under cc by nc 4 0", ["cc by nc"]),
    ("cc-by-sa", "licensed under cc by sa 4 0", ["cc by sa"]),
    ("cc-by", "licensed under cc by 4 0", ["cc by 4"]),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license",
     ["creative commons attribution 4"]),
    ("cc-by-sa", "licensed under a creative commons attribution sharealike 4 0 international license",
     ["creative commons attribution sharealike 4"]),
    ("cc0", "cc0 1 0 universal public domain dedication", ["cc0 1 0"]),
    ("unlicense", "this is free and unencumbered software released into the public domain",
     ["free and unencumbered software"]),
]
#: What follows "SPDX-License-Identifier:", and its label.
SPDX = [
    ("mit", "mit"), ("apache 2 0", "apache-2"), ("bsd 2 clause", "bsd"), ("bsd 3 clause", "bsd"), ("isc", "isc"),
    ("gpl 3 0", "gpl-3"), ("gpl 2 0", "gpl-2"), ("lgpl 2 1", "lgpl"), ("lgpl 3 0", "lgpl"), ("agpl 3 0", "agpl"),
    ("mpl 2 0", "mpl-2"), ("epl 2 0", "epl-2"), ("cc by nc 4 0", "cc-by-nc"), ("cc by sa 4 0", "cc-by-sa"),
    ("cc by 4 0", "cc-by"), ("cc0 1 0", "cc0"), ("unlicense", "unlicense"),
]
#: Phrases that name a licence wherever they stand.
BASE = [("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc")]
#: Words that may be missing or added around and inside a notice: so many at least, or this share of its words.
SLACK, SLACK_SHARE = 3, 0.2
#: Share of a template's IDF weight that must be there.
COVERAGE = 0.6
#: Rarest words of each mandatory phrase that are looked up.
ANCHORS = 2

_KEPT = b"0123456789abcdefghijklmnopqrstuvwxyz"
_TABLE = bytes(c if c >= 0x80 or c in _KEPT else c + 32 if 65 <= c <= 90 else 32 for c in range(256))

Template = tuple[str, list[bytes], list[list[bytes]]]


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased runs of ASCII letters and digits and of all other characters, as UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_TABLE).split()


def _parsed() -> list[Template]:
    lines = [(label, f"spdx license identifier {name}") for name, label in SPDX]
    notices = TEMPLATES + [(label, line, [line]) for label, line in lines]
    return [(label, words_of(text), [words_of(p) for p in phrases]) for label, text, phrases in notices]


def vocabulary() -> frozenset[bytes]:
    return frozenset(w for _, words, phrases in _parsed() for w in [*words, *(x for p in phrases for x in p)])


def _frequencies(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """In how many documents of this task each licence word occurs; row `documents` counts all."""
    known, found, n = vocabulary(), defaultdict(int), 0
    for batch in batches:
        n += len(batch)
        for text in batch["text"]:
            for w in known.intersection(words_of(text)):
                found[w] += 1
    rows = [(w.decode(), k) for w, k in found.items()] + [("", n)]
    yield pd.DataFrame(rows, columns=["word", "documents"])


def idf_of(docs: DataFrame) -> dict[bytes, float]:
    """IDF of every licence word over all documents: as many numbers as the templates have words."""
    one = bounded(narrow(docs, text="string"))
    rows = one.mapInPandas(_frequencies, "word string, documents long").groupBy("word").agg(F.sum("documents").alias("n")).collect()
    found = {r.word.encode(): r.n for r in rows}
    total = found.pop(b"", 0)
    return {w: math.log1p((total + 1) / (found.get(w, 0) + 0.5)) for w in vocabulary()}


class Index:
    """Templates by the rarest words of their phrases."""

    def __init__(self, idf: dict[bytes, float]):
        self.idf, self.templates = idf, _parsed()
        #: word -> (template, phrase, place in the phrase); each phrase under its ANCHORS rarest words
        self.postings: dict[bytes, list[tuple[int, int, int]]] = defaultdict(list)
        for t, (_, _, phrases) in enumerate(self.templates):
            for p, phrase in enumerate(phrases):
                rare = sorted(set(range(len(phrase))), key=lambda k: (-idf[phrase[k]], k))[:ANCHORS]
                for k in rare:
                    self.postings[phrase[k]].append((t, p, k))
        self.rare = frozenset(self.postings)
        self.need = [frozenset(w for p in phrases for w in p) for _, _, phrases in self.templates]

    def matches(self, words: list[bytes]) -> list[tuple[str, int, int, float]]:
        """(label, first word, words, coverage) of every place that a template holds."""
        if self.rare.isdisjoint(words):
            return []
        present = set(words)
        possible = {t for t, need in enumerate(self.need) if need <= present}
        if not possible:
            return []
        # Positions of the document's licence words, by falling IDF of what is looked up.
        places: dict[bytes, list[int]] = {w: [] for w in self.rare & present}
        for at, w in enumerate(words):
            if w in places:
                places[w].append(at)
        # Postings shifted by position: a phrase begins where all its anchors agree.
        votes: dict[tuple[int, int], dict[int, int]] = defaultdict(lambda: defaultdict(int))
        for w in sorted(places, key=lambda w: (-self.idf[w], w)):
            for t, p, k in self.postings[w]:
                if t in possible:
                    for at in places[w]:
                        votes[t, p][at - k] += 1
        out = []
        for t in sorted(possible):
            label, whole, phrases = self.templates[t]
            starts = []
            for p, phrase in enumerate(phrases):
                least = min(ANCHORS, len(phrase))
                starts.append([
                    s for s, n in sorted(votes[t, p].items()) if n >= least and s >= 0 and words[s : s + len(phrase)] == phrase
                ])
            for first in starts[0]:
                found = self._place(words, whole, phrases, starts, first)
                if found:
                    out.append((label, *found))
        return out

    def _place(self, words, whole, phrases, starts, first) -> tuple[int, int, float] | None:
        """The template around its first phrase at `first`, if all the other phrases are in reach."""
        offset = _find(whole, phrases[0])
        slack = max(SLACK, int(SLACK_SHARE * len(whole)))
        lo, hi = max(0, first - offset - slack), first - offset + len(whole) + slack
        for others in starts[1:]:  # in rising order
            next_ = bisect_left(others, lo)
            if next_ == len(others) or others[next_] >= hi:
                return None
        left: dict[bytes, int] = defaultdict(int)
        for w in words[lo:hi]:
            left[w] += 1
        have = total = 0.0
        for w in whole:
            total += self.idf[w]
            if left[w]:
                left[w] -= 1
                have += self.idf[w]
        coverage = have / total
        return (first, len(phrases[0]), coverage) if coverage >= COVERAGE else None


def _find(words: list[bytes], phrase: list[bytes]) -> int:
    return next((k for k in range(len(words)) if words[k : k + len(phrase)] == phrase), 0)


def base_places(words: list[bytes]) -> list[tuple[int, str]]:
    """(first word, label) of every place where a base phrase stands."""
    joined, out = b" " + b" ".join(words) + b" ", []
    for phrase, label in BASE:
        wanted = b" " + phrase.encode() + b" "
        at, counted, n = joined.find(wanted), 0, 0
        while at >= 0:
            n, counted = n + joined.count(b" ", counted, at), at
            out.append((n, label))
            at = joined.find(wanted, at + 1)
    return out


SCHEMA = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
    "score double, matches array<struct<label:string,first_word:long,words:long,coverage:double>>"
)


def license_scan(docs: DataFrame) -> DataFrame:
    """One row per row of `docs`: SCHEMA, where `matches` are the places that templates hold.

    `score` is the best template's coverage, 1 where a base phrase stands, 0 without any
    licence.  Null and empty texts have no words and no labels, and null for first and last
    word.  Repeated rows are scanned alike; other columns are not read; an empty table
    gives an empty result.
    """
    share = docs.sparkSession.sparkContext.broadcast(idf_of(docs))
    names = [x.split()[0] for x in SCHEMA.split(", ")]

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index = Index(share.value)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"].array, batch["text"]):
                words = words_of(text)
                base, found = base_places(words), index.matches(words)
                labels = {label for _, label in base}
                more = labels | {m[0] for m in found}
                rows.append((
                    doc_id, len(words), len(base), min(base)[0] if base else None, max(base)[0] if base else None,
                    ",".join(sorted(labels)), ",".join(sorted(more)),
                    1.0 if base else max((m[3] for m in found), default=0.0),
                    [dict(zip(("label", "first_word", "words", "coverage"), m)) for m in found],
                ))
            out = pd.DataFrame(rows, columns=names)
            for c in ("doc_id", "first_word", "last_word"):
                out[c] = out[c].astype("Int64")
            yield out

    return bounded(narrow(docs, doc_id="long", text="string")).mapInPandas(scan, SCHEMA)
