"""The keyword gate opens on every form that a rule knows."""

import re

import pytest

from waferlens.llm import licenses, signatures

FORMS = [(label, form) for label, (_, names) in licenses.FAMILIES.items() for form in names.split("|")]


@pytest.fixture(scope="module")
def found(spark):
    texts = [(i, f"Licensed under the {form} license") for i, (_, form) in enumerate(FORMS)]
    texts += [(1000, "Licensed under the AGPLv3"), (1001, "GFDL license"), (1002, "Beer Ware license")]
    return {r.doc_id: r.labels.split(",") for r in licenses.scan(spark.createDataFrame(texts, "doc_id long, text string")).collect()}


def test_every_form_is_detected(found):
    assert [f for i, f in enumerate(FORMS) if f[0] not in found[i]] == []


def test_forms_without_the_family_keyword(found):
    assert found[1000] == ["agpl-short"] and found[1001] == ["fdl"] and found[1002] == ["beerware"]


BODIES = {
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
    "bsd": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions",
    "bsd-3": "Neither the name of the Example Project nor the names of its contributors may be used to endorse or promote products",
    "apache": "Unless required by applicable law or agreed to in writing, software distributed under the License is",
    "gpl": "distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; see",
    "gpl-3-later": "either version 3 of the License, or (at your option) any later version.",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    "zlib": "Altered source versions must be plainly marked as such, and must not be",
    "mpl": "If a copy of the MPL was not distributed with this file, You can obtain one at",
    "cc-by-sa": "see https://creativecommons.org/licenses/by-sa/4.0/ for details",
    "ofl": "This Font Software is licensed under the SIL Open Font License, Version 1.1.",
    "proprietary": "Unauthorized copying of this file, via any medium is strictly prohibited",
}


def test_license_bodies_are_found(spark):
    rows = list(enumerate(BODIES.values()))
    clean = [(100, "a hopeful reader received a copy of the book at no cost"), (101, "the law requires notice and a fee for any person")]
    got = {r.doc_id: r.labels.split(",") for r in licenses.scan(spark.createDataFrame([*rows, *clean], "doc_id long, text string")).collect()}
    assert [label for i, label in enumerate(BODIES) if label not in got[i]] == []
    assert got[100] == got[101] == [""]


def test_signatures_equal_plain_regular_expressions(spark):
    """Every signature's own words, with a word at each gap, are detected under its label or a containing one."""
    lines = [re.fullmatch(r"(\S+) \S+: (.+)", x).groups() for x in signatures.TEXT.strip().splitlines()]
    texts = [(i, " ".join("xyz" if w == ".." else w.rstrip("?").split("|")[0] for w in words.split())) for i, (_, words) in enumerate(lines)]
    got = {r.id: {(h.start, h.end, h.label) for h in r.hits} for r in licenses.find(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    for i, (label, _) in enumerate(lines):
        n = len(texts[i][1].split())
        assert any(s == 0 and e == n for s, e, _ in got[i]), texts[i]
        assert len(lines) > 150


def test_every_form_contains_its_keyword():
    for keyword, pattern, *_ in licenses.rules():
        assert f" {keyword} " in pattern
    assert all(k in f.split() for _, k, forms in licenses._families() for f in forms)
