import textwrap
from pathlib import Path

import pytest

from llm_fixtures import documents, edges  # noqa: F401
from wardlight.llm import licenses as L
from wardlight.llm.license_texts import DIGESTS, TEXTS


def answer(frame):
    return {r.doc_id: (r.licenses, r.n_notices, r.whole_text) for r in frame.collect()}


def test_whole_texts_and_notices(spark, documents):
    mit = TEXTS["MIT"]
    wrapped = "Copyright (c) 2020 Somebody\nAll rights reserved.\n\n" + mit.replace(", ", ",\n   ")
    frame = documents(
        (1, wrapped), (2, mit.upper().replace("RESTRICTION", "LIMITATION")),
        (3, "MIT Licence\n\n(c) Me\n" + mit.replace("\"", "'")),
        (4, "Some prose.\nLicensed under the Apache Licence, version 2.0!\nMore prose."),
        (5, "Released under the MIT License.\nThis work is licensed under CC BY-NC 4.0."),
        (6, mit + " And then something else."), (7, "Licensed under the Nobody License."),
        (8, "# SPDX-License-Identifier: BSD-3-Clause"),
        (9, "We talk of software licensed under the MIT License, sometimes."),
        (10, TEXTS["BSD-3-Clause"]), (11, TEXTS["BSD-2-Clause"]))
    assert answer(L.license_table(frame)) == {
        1: ("MIT", 0, True), 2: ("", 0, False), 3: ("MIT", 0, True), 4: ("Apache-2.0", 1, False),
        5: ("CC-BY-NC-4.0,MIT", 2, False), 6: ("", 0, False), 7: ("", 0, False),
        8: ("BSD-3-Clause", 1, True), 9: ("", 0, False), 10: ("BSD-3-Clause", 0, True),
        11: ("BSD-2-Clause", 0, True)}


def test_spellings_and_copyright_lines(spark):
    rows = spark.createDataFrame(
        [("  The LICENCE,  whilst Organisation--favours", "the license while organization favours"),
         ("© 2020 Somebody", ""), ("// Copyright (C) Me", ""), ("licence licence", "license license"),
         ("a copyright holder", "a copyright holder"), ("", ""), ("!!", "")], "line string, want string")
    for r in rows.select("want", L.canonical_line(rows.line).alias("got")).collect():
        assert " ".join(r.got.split()) == r.want


def test_known_texts_have_one_licence_each(spark):
    known = L.known_digests(spark)
    assert known.count() == known.select("digest").distinct().count() > 1000


def test_edges(spark, documents, edges):
    frame = documents(*edges, (1, "Released under the MIT License."), (1, "nothing"),
                      (None, "Licensed under the ISC License"))
    got = L.license_table(frame)
    assert got.count() == len(edges) + 3
    assert {r.licenses for r in got.where("doc_id = 1").collect()} == {"MIT"}
    assert {r.licenses for r in got.where("doc_id is null").collect()} == {"ISC"}
    assert {r.licenses for r in got.where("doc_id >= 900").collect()} == {""}
    assert L.license_table(documents()).count() == 0


FILES = {"Artistic-1.0-Perl": "Artistic", "GPL-1.0": "GPL-1", "GPL-2.0": "GPL-2", "GPL-3.0": "GPL-3",
         "LGPL-2.0": "LGPL-2", "LGPL-3.0": "LGPL-3"}


def test_whole_texts_known_by_digest(spark, documents):
    """Public licence texts as a system holds them, also rewrapped, in capitals, and with an owner's line."""
    folder = Path("/usr/share/common-licenses")
    if not folder.is_dir():
        pytest.skip("no licence texts on this system")
    texts = {spdx: (folder / FILES.get(spdx, spdx)).read_text(errors="replace") for spdx in DIGESTS
             if (folder / FILES.get(spdx, spdx)).is_file()}
    assert len(texts) >= 10
    rows, want = [], {}
    for i, (spdx, text) in enumerate(sorted(texts.items())):
        rows += [(10 * i, text), (10 * i + 1, "Copyright 2021 Someone\n" + text.upper()), (10 * i + 2, text + "\nAnd more.")]
        want |= {10 * i: spdx, 10 * i + 1: spdx, 10 * i + 2: None}
    got = {r.doc_id: r for r in L.license_table(documents(*rows)).collect()}
    for doc, spdx in want.items():
        assert got[doc].whole_text == (spdx is not None), doc
        assert spdx is None or spdx in got[doc].licenses.split(","), doc


@pytest.mark.parametrize("width", [30, 41, 60, 77, 200])
def test_known_texts_in_any_wrapping(spark, documents, width):
    """A clause that a line break leaves behind "copyright" stays part of the text."""
    rows, want = [], {}
    for i, (spdx, text) in enumerate(sorted(TEXTS.items())):
        rows.append((i, "\n".join(line for part in text.split("\n") for line in textwrap.wrap(part, width))))
        want[i] = spdx
    got = {r.doc_id: r for r in L.license_table(documents(*rows)).collect()}
    assert {d: r.licenses for d, r in got.items() if r.whole_text} == want
