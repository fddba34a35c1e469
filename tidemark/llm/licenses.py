"""Licence scans by sentence rules.

A text is cut into sentences, each is normalised, and known licence sentences get an identifier: whole sentences, some with
slots for names; statements that something is under a named licence, wherever they stand in a sentence; and SPDX tags. The
identifiers of a document, in order, are matched against ordered rules, longer ones first; an unknown sentence that speaks
of licences breaks a sequence. Identifiers that no rule uses are reported as they are.

The catalogue has the notices and short texts in common use that are listed below; of long licences (Apache, GPL, MPL,
EPL) it knows the notices that files carry, not the sentences of the full texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, record_batch

#: Stands for one to SLOT_WORDS words in a sentence.
SLOT = "[*]"
SLOT_WORDS = 12
#: Identifier -> licence sentences as published. Alternatives follow each other.
SENTENCES = {
    "mit-grant": ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",),
    "mit-notice": ("The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",),
    "mit-warranty": ("THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",),
    "mit-liability": ("IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",),
    "isc-grant": ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.", "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    "isc-warranty": ("THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.",),
    "bsd-grant": ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",),
    "bsd-source": ("Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",),
    "bsd-binary": ("Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",),
    "bsd-advertise": ("All advertising materials mentioning features or use of this software must display the following acknowledgement:",),
    "bsd-endorse": ("Neither the name of [*] nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.", "Neither the name of [*] nor the names of [*] may be used to endorse or promote products derived from this software without specific prior written permission.", "The name of [*] may not be used to endorse or promote products derived from this software without specific prior written permission."),
    "bsd-warranty": ("THIS SOFTWARE IS PROVIDED BY [*] \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.",),
    "apache-2-header": ("Licensed under the Apache License, Version 2.0 (the \"License\");",),
    "apache-2-file": ("you may not use this file except in compliance with the License.", "you may not use these files except in compliance with the License."),
    "apache-2-copy": ("You may obtain a copy of the License at", "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    "apache-2-warranty": ("Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",),
    "gpl-2-later": ("[*] is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",),
    "gpl-3-later": ("[*] is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",),
    "lgpl-2.1-later": ("[*] is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",),
    "agpl-3-later": ("[*] is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",),
    "gpl-hope": ("[*] is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;",),
    "gpl-implied": ("without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",),
    "mpl-2-header": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",),
    "cc0-dedicated": ("This work is dedicated to the public domain under CC0 1.0.",),
    "epl-2-header": ("This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at",),
    "boost-header": ("Distributed under the Boost Software License, Version 1.0.",),
    "zlib-as-is": ("This software is provided 'as-is', without any express or implied warranty.",),
    "zlib-damages": ("In no event will the authors be held liable for any damages arising from the use of this software.",),
    "zlib-grant": ("Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:",),
    "unlicense-free": ("This is free and unencumbered software released into the public domain.",),
    "all-rights": ("All rights reserved.",),
}
#: SPDX identifier -> names of a licence in statements, in normal form. Longer names go before shorter ones.
NAMES = {
    "MIT": ("mit license", "mit licence", "mit"),
    "ISC": ("isc license", "isc"),
    "BSD-2-Clause": ("bsd 2 clause license", "2 clause bsd license", "simplified bsd license", "bsd 2 clause"),
    "BSD-3-Clause": ("bsd 3 clause license", "3 clause bsd license", "new bsd license", "modified bsd license", "revised bsd license", "bsd 3 clause"),
    "BSD": ("bsd license", "bsd"),
    "Apache-2.0": ("apache license version 2.0", "apache license v2.0", "apache license 2.0", "apache software license 2.0", "apache 2.0 license", "apache 2.0", "apache license 2"),
    "GPL-2.0-only": ("gnu general public license version 2.0", "gnu general public license version 2", "gnu general public license v2", "gnu gpl version 2", "gnu gpl v2", "gpl version 2", "gpl v2", "gplv2", "gpl 2.0"),
    "GPL-3.0-only": ("gnu general public license version 3.0", "gnu general public license version 3", "gnu general public license v3", "gnu gpl version 3", "gnu gpl v3", "gpl version 3", "gpl v3", "gplv3", "gpl 3.0"),
    "LGPL-2.1-only": ("gnu lesser general public license version 2.1", "gnu lgpl v2.1", "lgpl v2.1", "lgplv2.1", "lgpl 2.1"),
    "LGPL-3.0-only": ("gnu lesser general public license version 3.0", "gnu lesser general public license version 3", "gnu lgpl v3", "lgpl v3", "lgplv3", "lgpl 3.0"),
    "AGPL-3.0-only": ("gnu affero general public license version 3.0", "gnu affero general public license version 3", "gnu agpl v3", "agpl v3", "agplv3", "agpl 3.0"),
    "MPL-2.0": ("mozilla public license version 2.0", "mozilla public license v. 2.0", "mozilla public license 2.0", "mpl 2.0"),
    "EPL-2.0": ("eclipse public license version 2.0", "eclipse public license 2.0", "epl 2.0"),
    "BSL-1.0": ("boost software license version 1.0", "boost software license 1.0", "boost software license"),
    "Zlib": ("zlib license",),
    "CC0-1.0": ("cc0 1.0 universal", "cc0 1.0", "cc0"),
    "CC-BY-SA-4.0": ("creative commons attribution sharealike 4.0 international license", "creative commons attribution sharealike 4.0", "cc by sa 4.0"),
    "CC-BY-NC-4.0": ("creative commons attribution noncommercial 4.0 international license", "creative commons attribution noncommercial 4.0", "cc by nc 4.0"),
    "CC-BY-ND-4.0": ("creative commons attribution noderivatives 4.0 international license", "creative commons attribution noderivatives 4.0", "cc by nd 4.0"),
    "CC-BY-4.0": ("creative commons attribution 4.0 international license", "creative commons attribution 4.0", "cc by 4.0"),
    "Unlicense": ("unlicense",),
}
#: What a statement says is done under a licence, and words that may stand before the licence's name.
STATED = ("licensed", "released", "distributed", "published", "available", "provided", "covered", "shared")
ARTICLES = ("", "a ", "an ", "the ", "terms of ", "the terms of ", "terms of the ", "the terms of the ", "conditions of the ", "the conditions of the ")
#: Rules in order; a rule's identifiers must follow each other among a document's identifiers. A statement's
#: identifier is "name:" and the SPDX identifier, a tag's "spdx:" and the same; each is a rule of its own.
RULES = (
    ("BSD-4-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-advertise", "bsd-endorse", "bsd-warranty")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse", "bsd-warranty")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-warranty")),
    ("MIT", ("mit-grant", "mit-notice", "mit-warranty", "mit-liability")),
    ("MIT", ("mit-grant", "mit-notice", "mit-warranty")),
    ("Apache-2.0", ("apache-2-header", "apache-2-file", "apache-2-copy", "apache-2-warranty")),
    ("GPL-3.0-or-later", ("gpl-3-later", "gpl-hope", "gpl-implied")),
    ("GPL-2.0-or-later", ("gpl-2-later", "gpl-hope", "gpl-implied")),
    ("LGPL-2.1-or-later", ("lgpl-2.1-later", "gpl-hope", "gpl-implied")),
    ("AGPL-3.0-or-later", ("agpl-3-later", "gpl-hope", "gpl-implied")),
    ("Zlib", ("zlib-as-is", "zlib-damages", "zlib-grant")),
    ("ISC", ("isc-grant", "isc-warranty")),
    ("Apache-2.0", ("apache-2-header",)),
    ("GPL-3.0-or-later", ("gpl-3-later",)),
    ("GPL-2.0-or-later", ("gpl-2-later",)),
    ("LGPL-2.1-or-later", ("lgpl-2.1-later",)),
    ("AGPL-3.0-or-later", ("agpl-3-later",)),
    ("MPL-2.0", ("mpl-2-header",)),
    ("EPL-2.0", ("epl-2-header",)),
    ("BSL-1.0", ("boost-header",)),
    ("CC0-1.0", ("cc0-dedicated",)),
    ("Unlicense", ("unlicense-free",)),
    ("all-rights-reserved", ("all-rights",)),
)

#: A sentence ends after . ; : ! or ? before white space, and at a line's end if a blank line follows or the line
#: ends in one of them; other line ends join, so that wrapped sentences stay whole.
_ENDS = regex.compile(r"(?<=[.;:!?])\s+|\n\s*\n")
_NOISE = regex.compile(r"[^a-z0-9.]+")


def normalise(sentence: str) -> str:
    """Lower case, 'licence' spelt 'license', runs of other characters one blank, no dot at the end."""
    return _NOISE.sub(" ", sentence.lower().replace("licence", "license")).strip(" .")


#: What a sentence must have in it to be looked at; unknown sentences of BREAK_WORDS words or more with one of the second
#: kind break a sequence.
_HINT = regex.compile(r"licen[sc]|copyright|permission|redistribut|software|warrant|rights reserved|public domain|liable|as is|spdx|gpl|mpl|cc by|cc0|cc-by|creative commons|apache|boost|zlib|\b(?:mit|isc|bsd|epl)\b|neither the name|the name of|acknowledgement", regex.IGNORECASE)
_SPEAKS = regex.compile(r"\blicense|\bpermission|\bredistribut|\bwarrant|\bliable|\bpermitted\b|\bendorse")
BREAK_WORDS = 5
UNKNOWN = "?"
_TAG = regex.compile(r"spdx-licen[sc]e-identifier\s*:[ \t]*([A-Za-z0-9.+() \t-]+)", regex.IGNORECASE)


@cache
def _known() -> tuple[dict[str, str], regex.Pattern, dict[str, str], regex.Pattern, dict[str, str]]:
    """Normalised sentence -> identifier; a pattern of those with slots, and its groups' identifiers; a pattern of
    statements, and the SPDX identifiers of the names in it."""
    names: dict[str, set[str]] = {}
    for name, sentences in SENTENCES.items():
        for sentence in sentences:
            # A published sentence may itself be cut, as text is; parts that two of them share, or of a word or two, tell
            # nothing.
            for part in filter(None, _ENDS.split(sentence)):
                own = SLOT.join(normalise(x) for x in part.split(SLOT))
                if len(own.split()) > 2:
                    names.setdefault(own, set()).add(name)
    table = {part: next(iter(own)) for part, own in names.items() if part and SLOT not in part and len(own) == 1}
    slots, groups = [], {}
    inner = rf"[^ ]+(?: [^ ]+){{0,{SLOT_WORDS - 1}}}?"
    for part, own in names.items():
        if SLOT in part and len(own) == 1:
            group = f"s{len(slots)}"
            groups[group] = next(iter(own))
            pieces = [p for x in part.split(SLOT) for p in (SLOT, x) if p][1:]
            slots.append(f"(?P<{group}>" + " ".join(inner if p == SLOT else regex.escape(p) for p in pieces) + ")")
    spelt = {n: spdx for spdx, own in NAMES.items() for n in own}
    ordered = sorted(spelt, key=lambda n: (-len(n), n))
    stated = rf"\b(?:{'|'.join(STATED)})\b(?: [^ ]+){{0,6}}? under (?:{'|'.join(sorted(ARTICLES, key=len, reverse=True))})({'|'.join(map(regex.escape, ordered))})(?= |$)"
    return table, regex.compile("|".join(slots)), groups, regex.compile(stated), spelt


def sentence_ids(text: str | None) -> tuple[int, list[tuple[str, int]]]:
    """(number of sentences, [(identifier, sentence number)]) of a text, in order; a sentence that directly repeats the
    last identifier counts once, as parts of one published sentence do. UNKNOWN marks a break."""
    if not text:
        return 0, []
    parts = _ENDS.split(text) if "." in text or "\n" in text or ";" in text or ":" in text else [text]
    found: list[tuple[str, int]] = []
    # Only sentences around a hint can be known; elsewhere sentences are counted, not normalised.
    if _HINT.search(text):
        tags = [x for m in _TAG.finditer(text) for x in _expression(m[1])]
        for i, part in enumerate(parts):
            for own in _identify(part):
                if own == "spdx":  # the tag's value may be in the next sentence, as a colon ends one
                    while tags:
                        found.append((f"spdx:{tags.pop(0)}", i))
                elif not (found and found[-1][0] == own and found[-1][1] >= i - 1):
                    found.append((own, i))
    return sum(1 for p in parts if p.strip()), found


def _expression(text: str) -> list[str]:
    """The identifiers of an SPDX expression."""
    words = regex.sub(r"[()]", " ", text).split()
    return [w for w in words if w.upper() not in ("AND", "OR", "WITH")]


def _named(sentence: str) -> str | None:
    """The identifier of a whole normalised sentence."""
    table, slots, groups, _, _ = _known()
    own = table.get(sentence)
    if own:
        return own
    whole = slots.fullmatch(sentence)
    return groups[whole.lastgroup] if whole else None


def _identify(part: str) -> list[str]:
    """Identifiers of a sentence: of the whole, or else of the lines in it that are known on their own; and of statements."""
    if not _HINT.search(part):
        return []
    sentence = normalise(part)
    if sentence.startswith("spdx license identifier") or sentence.endswith("spdx license identifier"):
        return ["spdx"]
    own = _named(sentence)
    if own:
        return [own]
    _, _, _, stated, spelt = _known()
    lines = [(line, _named(normalise(line))) for line in part.split("\n")] if "\n" in part else [(part, None)]
    names = [name for _, name in lines if name]
    others = normalise("\n".join(line for line, name in lines if not name)) if names else sentence
    names += [f"name:{spelt[m[1]]}" for m in stated.finditer(others)]
    if names:
        return names
    speaks = _SPEAKS.search(sentence) and not sentence.startswith("http") and len(sentence.split()) >= BREAK_WORDS
    return [UNKNOWN] if speaks else []


def match_rules(identifiers: list[str]) -> tuple[list[str], list[str]]:
    """(licences in order of place, identifiers that no rule used)."""
    used = [x == UNKNOWN for x in identifiers]
    found: list[tuple[int, str]] = []
    for name, rule in RULES:
        at = 0
        while at + len(rule) <= len(identifiers):
            if tuple(identifiers[at : at + len(rule)]) == rule and not any(used[at : at + len(rule)]):
                used[at : at + len(rule)] = [True] * len(rule)
                found.append((at, name))
                at += len(rule)
            else:
                at += 1
    for at, own in enumerate(identifiers):
        if own.startswith(("name:", "spdx:")):
            used[at] = True
            found.append((at, own.split(":", 1)[1]))
    names = list(dict.fromkeys(n for _, n in sorted(found)))
    return names, [x for x, u in zip(identifiers, used, strict=True) if not u]


def license_table(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_sentences, n_license_sentences, licenses, sentence_ids and leftovers (comma-joined).

    Null and empty texts have no sentences and no licences (empty strings); repeated rows give repeated rows; an empty
    table gives an empty one; other columns are not read.
    """
    bounded_batches(docs.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), ("n_sentences", pa.int64()), ("n_license_sentences", pa.int64()), ("licenses", pa.string()), ("sentence_ids", pa.string()), ("leftovers", pa.string())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                n, found = sentence_ids(t)
                licenses, rest = match_rules([x for x, _ in found])
                names = [x for x, _ in found if x != UNKNOWN]
                rows.append((doc, n, len(names), ",".join(licenses), ",".join(names), ",".join(rest)))
            yield record_batch(schema, list(zip(*rows, strict=True)) if rows else [[]] * 6)

    narrow = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("t"))
    return narrow.mapInArrow(scan, "doc_id long, n_sentences long, n_license_sentences long, licenses string, sentence_ids string, leftovers string")
