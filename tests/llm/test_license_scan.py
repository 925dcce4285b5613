import re
import time

from loomstar.llm import license_scan
from tests.llm.cases import documents, text

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(t):
    """Base columns by walking over all words."""
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    found = []
    for phrase, label in license_scan.BASE:
        wanted = phrase.split()
        found += [(k, label) for k in range(len(words)) if words[k : k + len(wanted)] == wanted]
    starts = [k for k, _ in found]
    return len(words), len(found), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in found}))


LICENSED = [
    (1, "Released under the MIT License. " + text(40) + " Under the MIT-License, under the mit license", "aa"),
    (2, text(500) + "\nLicensed under the Apache License, Version 2.0.", "aa"),
    (3, "CC BY-NC CC BY NC cc by nc", "aa"),
    (4, "This work is licensed under the GNU General Public License, version 3.", "aa"),
    (5, "the gnu and a general public version 3 license", "aa"),
    (6, "Permission is hereby granted, free of charge, to any person", "aa"),
    (7, None, "aa"), (8, "", "aa"), (9, "ÜNDER the MIT Licénse under the mitt license", "aa"),
    (10, text(300) + " " + license_scan.TEMPLATES[1][1].title() + " " + text(300), "aa"),
]


def test_base_columns_equal_brute_force(spark):
    rows = {r.doc_id: r for r in license_scan.license_scan(documents(spark, LICENSED)).collect()}
    for doc_id, t, _ in LICENSED:
        r = rows[doc_id]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute(t)


def test_templates_need_their_phrases_in_place(spark):
    rows = {r.doc_id: r for r in license_scan.license_scan(documents(spark, LICENSED)).collect()}
    assert rows[4].labels == "gpl-3" and rows[4].base_labels == "" and rows[4].score > 0.9
    assert rows[10].labels == "mit" and rows[10].matches[0].coverage > 0.9
    assert [rows[k].labels for k in (5, 6, 7, 8, 9)] == [""] * 5
    assert rows[7].score == 0.0 and rows[7].first_word is None
    assert rows[2].labels == "apache-2" and rows[2].score == 1.0


def test_idf_counts_documents(spark):
    idf = license_scan.idf_of(documents(spark, LICENSED))
    assert idf[b"the"] < idf[b"gnu"] < idf[b"mozilla"]
    assert set(idf) == license_scan.vocabulary()


GPL = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {kind}General "
    "Public License as published by the Free Software Foundation, either version {version} of the License, or (at your "
    "option) any later version."
)
HEADERS = [
    (1, f"# x\n{GPL.format(kind='', version=3)}\n", "gpl-3"), (2, GPL.format(kind="", version=2), "gpl-2"),
    (3, GPL.format(kind="Affero ", version=3), "agpl"), (4, GPL.format(kind="Lesser ", version=3), "lgpl"),
    (5, "// SPDX-License-Identifier: GPL-3.0-or-later", "gpl-3"), (6, "/* SPDX-License-Identifier: BSD-3-Clause */", "bsd"),
    (7, "SPDX-License-Identifier", ""), (8, "published by the Free Software Foundation, version 3", ""),
]


def test_standard_headers_and_spdx_lines(spark):
    rows = {r.doc_id: r for r in license_scan.license_scan(documents(spark, [(k, t, "aa") for k, t, _ in HEADERS])).collect()}
    assert [rows[k].labels for k, _, _ in HEADERS] == [label for _, _, label in HEADERS]


def test_every_notice_is_found_whole(spark):
    rows = [(k, f"{text(50, k)}. {notice.upper()}; {text(50, k + 1)}", "aa") for k, (_, notice, _) in enumerate(license_scan.TEMPLATES)]
    found = {r.doc_id: r for r in license_scan.license_scan(documents(spark, rows)).collect()}
    for k, (label, notice, _) in enumerate(license_scan.TEMPLATES):
        assert label in found[k].labels.split(",") and found[k].score > 0.9, notice


def test_many_places_take_time_in_proportion():
    def seconds(n):
        words = license_scan.words_of("under the mit license " * n + GPL.format(kind="", version=3) * (n // 20))
        index = license_scan.Index({w: 1.0 for w in license_scan.vocabulary()})
        began = time.process_time()
        assert len(license_scan.base_places(words)) == n and len(index.matches(words)) >= n // 20
        return time.process_time() - began

    seconds(1_000)
    assert seconds(40_000) < 24 * max(seconds(5_000), 0.02)
