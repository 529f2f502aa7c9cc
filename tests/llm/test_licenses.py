"""The licence scan against all pairs of passages and templates in Python."""

import re

from daybook.llm import licenses
from daybook.llm.queries import QUERIES

SCHEMA = "doc_id long, text string"


def plain(rows, templates=licenses.EVERY):
    sets = {name: set(licenses.bigrams_of(text)) for name, text in templates.items()}
    named = {}
    for doc, text in rows:
        text = (text or "").lower()
        lines = text.split("\n")
        cuts = [s for line in lines for s in re.split(r"(?<=[.!?])[\x20\x09-\x0D]+", line)] + lines
        cuts += re.split(r"(?<=[.!?])[\x20\x09-\x0D]+", text) + re.split(r"\n[\x20\x09\x0B-\x0D]*\n", text) + [text]
        for passage in set(cuts):
            own = set(licenses.bigrams_of(passage))
            order, name = min((-2 * len(own & pairs) / max(1, len(own) + len(pairs)), name) for name, pairs in sets.items())
            if order <= -0.8:
                best, n = named.setdefault(doc, {}).get(licenses.license_of(name), ((0, ""), 0))
                named[doc][licenses.license_of(name)] = min(best, (order, name)), n + 1
    return {(doc, license): (best[1], -best[0], n) for doc, found in named.items() for license, (best, n) in found.items()
            if not any(other.startswith(start) for start in licenses.SHARED.get(license, ()) for other in found)}


def got(frame):
    return {(row.doc_id, row.license): (row.template, row.dice, row.passages) for row in frame.collect()}


def test_against_all_pairs(frame):
    t = licenses.TEMPLATES
    rows = [(1, "Prose here.\nReleased under the MIT License.\nMore prose."), (2, t["MIT"].replace(",", "\n")), (3, None), (4, ""),
            (5, t["GPL-3.0"].upper() + " And one more sentence follows it here."), (6, "Licensed under CC BY-NC 4.0. " * 40),
            (7, "released under mit license"), (8, "Licensed under CC BY-NC-SA 4.0!\n\nLicensed under CC BY 4.0"), (None, t["ISC"]),
            (9, "under the of License version"), (10, "x " * 100_000), (11, t["BSD"][:-30]), (1, "Released under the MIT License."),
            (12, "This work is licensed under the GNU General Public License, version 3. Or version 2.")]
    assert got(licenses.scan(frame(rows, SCHEMA))) == plain(rows)
    assert licenses.scan(frame([], SCHEMA)).count() == 0
    assert licenses.scan(frame([(1, t["BSD"], "x")], SCHEMA + ", TEXT string")).first().license == "BSD"


LATER = "(at your option) any later version."
OWN = {
    "LGPL-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public "
                "License as published by the Free Software Foundation, either version 3 of the License, or " + LATER,
    "LGPL-2.1": "This library is free software; you can redistribute it and/or\nmodify it under the terms of the GNU Lesser General Public\n"
                "License as published by the Free Software Foundation; either\nversion 2.1 of the License, or " + LATER,
    "AGPL-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public "
                "License as published by the Free Software Foundation, either version 3 of the License, or " + LATER,
    "GPL-2.0": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License "
               "as published by the Free Software Foundation; either version 2 of the License, or " + LATER,
    "GPL-2.0-only": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public "
                    "License version 2 as published by the Free Software Foundation.",
    "LGPL-3.0 notice": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "CC-BY-4.0": "This work is licensed under the Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0": "Licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC-BY-NC-ND-3.0": "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivs 3.0 Unported License.",
    "CC0-1.0": "To the extent possible under law, Jo Doe has waived all copyright and related or neighboring rights to this work.",
    "MPL-2.0 header": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
                      "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "EPL-2.0": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is "
               "available at http://www.eclipse.org/legal/epl-2.0",
    "BSD-3-Clause names": "Neither the name of Acme nor the names of its contributors may be used to endorse or promote products derived from "
                          "this software without specific prior written permission.",
}


def test_families_keep_their_names(frame):
    rows = [*enumerate(OWN.values()), (100, licenses.TEMPLATES["GPL-3.0"])]
    found = got(licenses.scan(frame(rows, SCHEMA)))
    assert {name for doc, name in found if doc == 100} == {"GPL-3.0"}
    for i, name in enumerate(OWN):
        assert {(own, row[0]) for (doc, own), row in found.items() if doc == i} == {(name.split(" ")[0], name)}
    rows += [(1000 + i, f"Prose before it.\n{text}\n\nAnd after.") for i, text in enumerate(licenses.EVERY.values())]
    found = got(licenses.scan(frame(rows, SCHEMA)))
    assert found == plain(rows)
    assert all(found[1000 + i, licenses.license_of(name)][1] == 1 for i, name in enumerate(licenses.EVERY))


def test_one_licence_for_a_header(frame):
    """The usual notice at the head of a file, in its paragraphs: one licence, whatever its sentences share with others."""
    for own in ("GPL-3.0", "LGPL-3.0", "AGPL-3.0"):
        header = licenses.EVERY[f"{own} header"].replace("This program is distributed", "\n\nThis program is distributed").replace(
            "You should", "\n\nYou should")
        found = licenses.scan(frame([(1, header)], SCHEMA)).collect()
        assert [row.license for row in found] == [own] and found[0].passages > 1
    assert [row.license for row in licenses.scan(frame([(1, licenses.EVERY["GPL copy"])], SCHEMA)).collect()] == ["GPL"]


def test_bigrams_of_a_passage_are_made_once(frame):
    plan = licenses.scan(frame([(1, "x")], SCHEMA))._jdf.queryExecution().optimizedPlan().toString()
    assert 0 < plan.count("concat_ws") <= 3  # of the text; of a passage, in the filter and in what it lets pass


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    want = plain([(d.doc_id, d.text) for d in docs])
    assert want and got(QUERIES["op1_license_scans"](spark, folder)) == want
