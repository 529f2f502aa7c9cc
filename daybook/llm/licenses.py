"""Licence scan: passages against licence templates by the Dice coefficient of their word bigrams.

Passages are the sentences, lines, blocks between blank lines and the whole of a text. Dice of two sets A and B is at least
t only if the smaller is at least t / (2 - t) of the larger, so a passage meets only templates within these bounds. It
then has at least o bigrams in common with B, hence one at least of any |B| - o + 1 of B's; the longest ones, which prose
seldom holds, serve as anchors. Both prune without loss.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import pick, text_of

LEAST = 0.8
SENTENCE = r"(?<=[.!?])[\x20\x09-\x0D]+"
BLANK_LINE = r"\n[\x20\x09\x0B-\x0D]*+\n"

#: The wording of public licence notices, as published.
TEMPLATES = {
    "MIT notice": "Released under the MIT License.",
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
           "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
           "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
           "to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                  "compliance with the License. You may obtain a copy of the License at "
                  "http://www.apache.org/licenses/LICENSE-2.0",
    "GPL-2.0 notice": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0 notice": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
               "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
               "option) any later version.",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
           "the following conditions are met:",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
           "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "CC-BY-4.0 notice": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0 notice": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0 notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-NC-SA-4.0 notice": "Licensed under CC BY-NC-SA 4.0.",
}

_GNU = {"GPL-2.0": ("General", "2"), "GPL-3.0": ("General", "3"), "LGPL-2.0": ("Library General", "2"),
        "LGPL-2.1": ("Lesser General", "2.1"), "LGPL-3.0": ("Lesser General", "3"), "AGPL-3.0": ("Affero General", "3")}
_CC = {"BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-NC": "Attribution-NonCommercial",
       "BY-NC-SA": "Attribution-NonCommercial-ShareAlike", "BY-ND": "Attribution-NoDerivatives",
       "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives"}
#: Versions and their names.
_CC_VERSIONS = {"4.0": "International", "3.0": "Unported", "2.5": "Generic", "2.0": "Generic"}


def _gnu() -> dict[str, str]:
    """The headers, notices and marked sentences of the GNU licences, which differ by a word or two. The wording is fixed."""
    warranty = ("This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied "
                "warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.")
    found = {"GNU warranty": warranty}
    for name, (kind, version) in _GNU.items():
        thing = "library" if version != "3" and "LGPL" in name else "program"
        own, family = f"GNU {kind} Public License", name.rsplit("-", 1)[0]
        start = f"This {thing} is free software: you can redistribute it and/or modify it under the terms of the {own}"
        later = f"{start} as published by the Free Software Foundation, either version {version} of the License, or (at your option) any later version."
        more = f"See the {own} for more details."
        copy = f"You should have received a copy of the {own} along with this {thing}."
        found |= {
            name: later, f"{name}-only": f"{start} version {version} as published by the Free Software Foundation.",
            f"{name} header": f"{later} {warranty.replace('program', thing)} {more} {copy} If not, see https://www.gnu.org/licenses/.",
            f"{name} notice": f"This work is licensed under the {own}, version {version}.",
            f"{name} short notice": f"Licensed under the {own} v{version if '.' in version else version + '.0'}."}
        if kind != "Library General":
            found |= {f"{family} warranty": f"{warranty} {more}", f"{family} details": more, f"{family} copy": copy.replace("library", "program")}
    return found


def _creative_commons() -> dict[str, str]:
    """Creative Commons' own wording and short notices, by licence and version. The wording is fixed."""
    found = {}
    for code, title in _CC.items():
        for version, place in _CC_VERSIONS.items():
            if version != "4.0":
                title = title.replace("NoDerivatives", "NoDerivs")
            found[f"CC-{code}-{version}"] = f"This work is licensed under a Creative Commons {title} {version} {place} License."
            found[f"CC-{code}-{version} notice"] = f"Licensed under CC {code} {version}."
            found[f"CC-{code}-{version} short"] = f"This work is licensed under CC {code} {version}."
            found[f"CC-{code}-{version} title"] = f"Creative Commons {title} {version} {place} (CC {code} {version})"
            found[f"CC-{code}-{version} site"] = (
                f"Except where otherwise noted, content on this site is licensed under a Creative Commons {title} {version} {place} License.")
    return found


#: Sentences that several licences share.
_BSD_SOURCE = "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."
_BSD_BINARY = ("Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
               "disclaimer in the documentation and/or other materials provided with the distribution.")
_BSD_NAMES = ("Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
              "derived from this software without specific prior written permission.")
_APACHE_WARRANTY = ("Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on "
                    "an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.")
_MIT_CONDITION = ("The above copyright notice and this permission notice shall be included in all copies or substantial portions of "
                  "the Software.")

#: The common licence families. The nearest template names a text, so near relatives keep their names.
FAMILIES = {name: text for name, text in (_gnu() | _creative_commons() | {
    "GPL-2.0 title": "GNU GENERAL PUBLIC LICENSE Version 2, June 1991",
    "GPL-2.0 preamble": "The licenses for most software are designed to take away your freedom to share and change it.",
    "GPL-3.0 title": "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
    "GPL-3.0 preamble": "The GNU General Public License is a free, copyleft license for software and other kinds of works.",
    "LGPL-2.1 title": "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999",
    "LGPL-3.0 title": "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
    "LGPL-3.0 preamble": "This version of the GNU Lesser General Public License incorporates the terms and conditions of version 3 of the "
                         "GNU General Public License, supplemented by the additional permissions listed below.",
    "AGPL-3.0 title": "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007",
    "AGPL-3.0 preamble": "The GNU Affero General Public License is a free, copyleft license for software and other kinds of works, "
                         "specifically designed to ensure cooperation with the community in the case of network server software.",
    "MIT conditions": _MIT_CONDITION,
    "MIT grant": f"{TEMPLATES['MIT']} {_MIT_CONDITION}",
    "Apache-2.0 warranty": _APACHE_WARRANTY,
    "Apache-2.0 header": f"{TEMPLATES['Apache-2.0']} {_APACHE_WARRANTY} See the License for the specific language governing permissions and "
                         "limitations under the License.",
    "Apache-2.0 title": "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/",
    "Apache-2.0 OR MIT": "Licensed under either of Apache License, Version 2.0 or MIT license at your option.",
    "BSD source clause": _BSD_SOURCE,
    "BSD binary clause": _BSD_BINARY,
    "BSD-2-Clause": f"{TEMPLATES['BSD']} 1. {_BSD_SOURCE} 2. {_BSD_BINARY}",
    "BSD-3-Clause": f"{TEMPLATES['BSD']} 1. {_BSD_SOURCE} 2. {_BSD_BINARY} 3. {_BSD_NAMES}",
    "BSD-3-Clause names": _BSD_NAMES,
    "BSD-4-Clause advertising": "All advertising materials mentioning features or use of this software must display the following acknowledgement:",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "MPL-2.0 header": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
                      "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "MPL-1.1": "The contents of this file are subject to the Mozilla Public License Version 1.1 (the \"License\"); you may not use this "
               "file except in compliance with the License. You may obtain a copy of the License at http://www.mozilla.org/MPL/",
    "EPL-1.0": "This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 which "
               "accompanies this distribution, and is available at http://www.eclipse.org/legal/epl-v10.html",
    "EPL-2.0": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which "
               "is available at https://www.eclipse.org/legal/epl-2.0/",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "CC0-1.0 dedication": "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights "
                          "to this software to the public domain worldwide.",
    "CC0-1.0 title": "CC0 1.0 Universal (CC0 1.0) Public Domain Dedication",
    "CC-BY article": "This is an open access article distributed under the terms of the Creative Commons Attribution License, which permits "
                     "unrestricted use, distribution, and reproduction in any medium, provided the original work is properly cited.",
    "Zlib": "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and "
            "redistribute it freely, subject to the following restrictions:",
    "BSL-1.0": "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and "
               "accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and "
               "transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software "
               "is furnished to do so, all subject to the following:",
    "BSL-1.0 notice": "Distributed under the Boost Software License, Version 1.0.",
    "WTFPL": "Everyone is permitted to copy and distribute verbatim or modified copies of this license document, and changing it is "
             "allowed as long as the name is changed.",
}).items() if name not in TEMPLATES}

EVERY = TEMPLATES | FAMILIES
#: Wording that a family shares tells no version. It is reported only of a document that names no licence with such a start.
SHARED = {"GNU": ("GPL", "LGPL", "AGPL"), "GPL": ("GPL-",), "LGPL": ("LGPL-",), "AGPL": ("AGPL-",), "BSD": ("BSD-",), "CC-BY": ("CC-BY-",)}


def license_of(template: str) -> str:
    """The licence that a template is wording of: its name up to what the template is."""
    return template if " OR " in template else template.split(" ")[0]


def bigrams_of(template: str) -> list[str]:
    words = re.findall(r"[^\W_]+", template.lower())
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(words, words[1:])))


def bounds(size: int, least: float = LEAST) -> tuple[int, int]:
    """The sizes that a set may have beside one of ``size`` members."""
    return math.ceil(size * least / (2 - least) - 1e-9), math.floor(size * (2 - least) / least + 1e-9)


def anchors(bigrams: list[str], least: float = LEAST) -> list[str]:
    """Bigrams of which any passage within the limits has one at least."""
    low, _ = bounds(len(bigrams), least)
    common = math.ceil(least * (low + len(bigrams)) / 2 - 1e-9)
    return sorted(bigrams, key=lambda bigram: (-len(bigram), bigram))[:len(bigrams) - common + 1]


def passages(text: Column) -> Column:
    """Sentences, lines, blocks and the whole text, each once."""
    lines = F.split(text, r"\n")
    sentences = F.flatten(F.transform(lines, lambda line: F.split(line, SENTENCE)))
    return F.array_distinct(F.concat(sentences, lines, F.split(text, SENTENCE), F.split(text, BLANK_LINE), F.array(text)))


def bigrams(text: Column) -> Column:
    """The different word bigrams of a lower-cased text; words are runs of letters and digits."""
    words = F.filter(F.split(text, r"[^\p{L}\p{N}]+"), lambda word: word != "")
    pairs = F.transform(F.array(words), lambda w: F.when(F.size(w) > 1, F.array_distinct(F.transform(
        F.sequence(F.lit(1), F.size(w) - 1), lambda i: F.concat_ws(" ", F.get(w, i - 1), F.get(w, i))))))
    return F.coalesce(F.get(pairs, F.lit(0)), F.array().cast("array<string>"))


def scan(docs: DataFrame, templates: dict[str, str] = EVERY, least: float = LEAST) -> DataFrame:
    """``doc_id, license, template, dice, passages``: the licences that a document names, with the nearest template, its score
    and how many passages name the licence.

    A passage counts for its most similar template (of equal ones the first by name), once for each different wording. Wording
    that tells only the family (``SHARED``) has a row only where the document names no licence of it. Null text counts as
    empty; rows with a null id are reported under null; rows with the same id are reported together; a document without a
    licence has no row, an empty table gives an empty one. Very long texts are read whole: each passage is compared by its
    own bigrams. Templates are a parameter and sit in the plan as literals. A text without any anchor is done with after its
    own bigrams; only others are cut into passages.
    """
    sets = {name: bigrams_of(text) for name, text in sorted(templates.items())}
    every = F.array(*[F.lit(x) for x in sorted({x for own in sets.values() for x in anchors(own, least)})])
    texts = pick(docs, {"doc_id": "long", "text": "string"}).select("doc_id", F.lower(text_of()).alias("text"))
    near = texts.where(F.arrays_overlap(bigrams(F.col("text")), every))
    cut = near.select("doc_id", F.explode(passages(F.col("text"))).alias("passage"))

    rows = [(name, own, *bounds(len(own), least)) for name, own in sets.items()]
    table = F.array(*[F.struct(F.lit(name).alias("template"), F.split(F.lit("|".join(own)), r"\|").alias("pairs"), F.lit(low).alias("low"),
                               F.lit(high).alias("high")) for name, own, low, high in rows])
    # one expression for all templates, as one each would be beyond what Spark compiles; a passage meets those whose anchors it has
    hooks: dict[str, list[str]] = {}
    for place, (_, own, _, _) in enumerate(rows, 1):
        for anchor in anchors(own, least):
            hooks.setdefault(anchor, []).append(str(place))
    listed = F.array(*[F.lit(",".join(hooks[x])) for x in sorted(hooks)])

    def nearest(own: Column) -> Column:
        hooked = F.array_distinct(F.split(F.array_join(F.transform(F.array_intersect(own, every), lambda anchor: F.element_at(
            listed, F.array_position(every, anchor).cast("int"))), ","), ","))
        fitting = F.filter(F.transform(hooked, lambda place: F.element_at(table, place.cast("int"))),
                           lambda t: F.size(own).between(t["low"], t["high"]))
        scores = F.transform(fitting, lambda t: F.struct((-2.0 * F.size(F.array_intersect(own, t["pairs"])) / (
            F.size(own) + F.size(t["pairs"]))).alias("order"), t["template"].alias("template")))
        return F.when(F.arrays_overlap(own, every), F.array_min(scores))

    # as a lambda's variable a passage's bigrams are made once; as a column, Spark would write them out at each use
    best = cut.select("doc_id", F.get(F.transform(F.array(bigrams(F.col("passage"))), nearest), F.lit(0)).alias("best"))
    names = F.create_map(*[F.lit(x) for name in sets for x in (name, license_of(name))])
    found = best.where(F.col("best.order") <= -least).groupBy("doc_id", names[F.col("best.template")].alias("license")).agg(
        F.min("best").alias("best"), F.count(F.lit(1)).alias("passages"))
    entry = F.struct("license", F.col("best.template").alias("template"), (-F.col("best.order")).alias("dice"), "passages")
    whole = found.groupBy("doc_id").agg(F.collect_list(entry).alias("all"))  # as many as licences
    return whole.select("doc_id", F.inline(F.filter("all", lambda own: ~_outdone(own["license"], F.col("all")))))


def _outdone(license: Column, every: Column) -> Column:
    """Whether the licence is shared wording, and a licence of the family is among all."""
    more = F.lit(False)
    for family, starts in SHARED.items():
        more = more | ((license == family) & F.exists(every, lambda other: _starts(other["license"], starts)))
    return more


def _starts(name: Column, starts: tuple[str, ...]) -> Column:
    found = F.lit(False)
    for start in starts:
        found = found | name.startswith(start)
    return found
