"""Licence recognition: sentences to identifiers, identifier sequences to rules.

A text is cut into pieces at ends of sentences and lines, and at ";" and ":". From each piece on, words in lower case, with numbers
as "#", are followed through a tree of known licence sentences, over line ends, ";" and ":" inside a paragraph for as long as any of them can match. What is found is a sequence of identifiers in text
order; ordered rules, the longest and most special first, name the licence of each run of identifiers.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import product

import pyarrow as pa
from pyspark.sql import DataFrame

from lexmill.llm.base import slices, text_or_empty

_WORD = re.compile(r"\d+(?:\.\d+)*|[^\W\d_]+")
_END = re.compile(r"(?<!\b[vV])[.!?;](?=\s|$)|(?<!dentifier):(?=\s|$)|\n")
_PARAGRAPH = re.compile(r"\n[ \t]*\n")
#: What a notice adds to a licence's name; not part of the sentence.
_TERM = re.compile(r"""\(\s*the\W+licen[sc]e\W*?\)""", re.IGNORECASE)
_SPELLING = {"licence": "license", "licenced": "licensed", "licences": "licenses", "v": "version"}

# What licences are called, and their identifiers; {} is the version.
NAMES = {
    "mit license": "MIT",
    "mit": "MIT",
    "x # license": "X11",
    "apache license version #": "Apache-{}",
    "apache license #": "Apache-{}",
    "apache #": "Apache-{}",
    "apache software license version #": "Apache-{}",
    "gnu general public license": "GPL",
    "gnu general public license version #": "GPL-{}-only",
    "gnu general public license version # or later": "GPL-{}-or-later",
    "gnu gpl version #": "GPL-{}-only",
    "gpl version #": "GPL-{}-only",
    "gplv #": "GPL-{}-only",
    "gnu lesser general public license version #": "LGPL-{}-only",
    "gnu lesser general public license version # or later": "LGPL-{}-or-later",
    "lgpl version #": "LGPL-{}-only",
    "gnu affero general public license version #": "AGPL-{}-only",
    "gnu affero general public license version # or later": "AGPL-{}-or-later",
    "agpl version #": "AGPL-{}-only",
    "mozilla public license version #": "MPL-{}",
    "mozilla public license #": "MPL-{}",
    "eclipse public license version #": "EPL-{}",
    "eclipse public license #": "EPL-{}",
    "boost software license version #": "BSL-{}",
    "bsd # clause license": "BSD-{}-Clause",
    "bsd license": "BSD",
    "isc license": "ISC",
    "zlib license": "Zlib",
    "unlicense": "Unlicense",
    "cc # #": "CC0-{}",
    "cc by #": "CC-BY-{}",
    "cc by sa #": "CC-BY-SA-{}",
    "cc by nc #": "CC-BY-NC-{}",
    "cc by nd #": "CC-BY-ND-{}",
    "cc by nc sa #": "CC-BY-NC-SA-{}",
    "cc by nc nd #": "CC-BY-NC-ND-{}",
    "creative commons attribution # international license": "CC-BY-{}",
    "creative commons attribution sharealike # international license": "CC-BY-SA-{}",
    "creative commons attribution noncommercial # international license": "CC-BY-NC-{}",
    "creative commons attribution noncommercial sharealike # international license": "CC-BY-NC-SA-{}",
}
_SUBJECTS = ("", "this work is", "this file is", "this software is", "this project is", "this program is", "this code is", "this document is", "this text is", "this library is", "all content is", "the code is", "the text is")
_VERBS = ("licensed under", "released under", "distributed under", "available under", "made available under", "published under", "covered by", "licensed under the terms of")

# Sentences of licence texts and notices, normalised, and their identifiers.
SENTENCES = {
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions": "mit-grant",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "mit-notice",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement": "mit-warranty",
    "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software": "mit-liability",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "isc-grant",
    "the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness": "isc-warranty",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsd-grant",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "bsd-source",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution": "bsd-binary",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "bsd-names",
    "you may not use this file except in compliance with the license": "apache-compliance",
    "you may obtain a copy of the license at": "apache-copy",
    "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied": "apache-basis",
    "see the license for the specific language governing permissions and limitations under the license": "apache-see",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version # of the license or at your option any later version": "gpl-later",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license version # as published by the free software foundation": "gpl-only",
    "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version # of the license or at your option any later version": "lgpl-later",
    "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose": "gpl-hope",
    "see the gnu general public license for more details": "gpl-details",
    "this source code form is subject to the terms of the mozilla public license version #": "mpl-subject",
    "if a copy of the mpl was not distributed with this file you can obtain one at": "mpl-copy",
    "this is free and unencumbered software released into the public domain": "unlicense-domain",
    "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work": "cc0-waiver",
    "all rights reserved": "reserved",
    "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license version # as published by the free software foundation": "lgpl-only",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version # of the license or at your option any later version": "agpl-later",
    "gnu general public license version # # june #": "gpl-title",
    "gnu lesser general public license version # # june #": "lgpl-title",
    "gnu lesser general public license version # # february #": "lgpl-title",
    "gnu affero general public license version # # november #": "agpl-title",
    "everyone is permitted to copy and distribute verbatim copies of this license document but changing it is not allowed": "gnu-verbatim",
    "apache license version # january #": "apache-title",
    "terms and conditions for use reproduction and distribution": "apache-terms",
    "mozilla public license version #": "mpl-title",
    "boost software license version # august # th #": "boost-title",
    "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license the software to use reproduce display distribute execute and transmit the software and to prepare derivative works of the software and to permit third parties to whom the software is furnished to do so all subject to the following": "boost-grant",
    "this software is provided as is without any express or implied warranty": "zlib-warranty",
    "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions": "zlib-grant",
    "anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means": "unlicense-anyone",
    "creative commons attribution # international public license": "cc-by-title",
    "creative commons attribution sharealike # international public license": "cc-by-sa-title",
    "creative commons attribution noncommercial # international public license": "cc-by-nc-title",
    "by exercising the licensed rights defined below you accept and agree to be bound by the terms and conditions of this creative commons attribution # international public license public license": "cc-by-accept",
}

# Rules in order; identifiers that follow each other, with at most GAP other sentences between two of them.
GAP = 3
RULES = (
    (("mit-grant", "mit-notice", "mit-warranty", "mit-liability"), "MIT"),
    (("mit-grant", "mit-notice", "mit-warranty"), "MIT"),
    (("mit-grant", "mit-notice"), "MIT"),
    (("isc-grant", "isc-warranty"), "ISC"),
    (("bsd-grant", "bsd-source", "bsd-binary", "bsd-names"), "BSD-3-Clause"),
    (("bsd-grant", "bsd-source", "bsd-binary"), "BSD-2-Clause"),
    (("name", "apache-compliance", "apache-copy", "apache-basis", "apache-see"), None),
    (("name", "apache-compliance", "apache-copy"), None),
    (("name", "apache-compliance"), None),
    (("gpl-later", "gpl-hope", "gpl-details"), "GPL-{}-or-later"),
    (("gpl-later", "gpl-hope"), "GPL-{}-or-later"),
    (("gpl-later",), "GPL-{}-or-later"),
    (("gpl-only",), "GPL-{}-only"),
    (("lgpl-later",), "LGPL-{}-or-later"),
    (("mpl-subject", "mpl-copy"), "MPL-{}"),
    (("mpl-subject",), "MPL-{}"),
    (("lgpl-only",), "LGPL-{}-only"),
    (("agpl-later",), "AGPL-{}-or-later"),
    (("gpl-title", "gnu-verbatim"), "GPL-{}"),
    (("lgpl-title", "gnu-verbatim"), "LGPL-{}"),
    (("agpl-title", "gnu-verbatim"), "AGPL-{}"),
    (("apache-title", "apache-terms"), "Apache-{}"),
    (("gpl-title",), "GPL-{}"),
    (("lgpl-title",), "LGPL-{}"),
    (("agpl-title",), "AGPL-{}"),
    (("apache-title",), "Apache-{}"),
    (("mpl-title",), "MPL-{}"),
    (("cc-by-title", "cc-by-accept"), "CC-BY-{}"),
    (("cc-by-title",), "CC-BY-{}"),
    (("cc-by-sa-title",), "CC-BY-SA-{}"),
    (("cc-by-nc-title",), "CC-BY-NC-{}"),
    (("boost-title", "boost-grant"), "BSL-{}"),
    (("boost-title",), "BSL-{}"),
    (("boost-grant",), "BSL-1.0"),
    (("zlib-warranty", "zlib-grant"), "Zlib"),
    (("zlib-grant",), "Zlib"),
    (("unlicense-domain", "unlicense-anyone"), "Unlicense"),
    (("unlicense-domain",), "Unlicense"),
    (("cc0-waiver",), "CC0-1.0"),
    (("spdx",), None),
    (("name",), None),
    (("mit-grant",), "MIT"),
    (("isc-grant",), "ISC"),
    (("bsd-grant",), "BSD"),
)


@lru_cache(1)
def known() -> dict[str, tuple[str, str | None]]:
    """Normalised sentences with (identifier, licence or None)."""
    out = {s: (i, None) for s, i in SENTENCES.items()}
    for subject, verb, the, (name, spdx) in product(_SUBJECTS, _VERBS, ("", "the", "a"), NAMES.items()):
        out[" ".join(x for x in (subject, verb, the, name) if x)] = "name", spdx
    for name, spdx in NAMES.items():
        out[f"license {name}"] = "name", spdx
    return out


@lru_cache(1)
def tree() -> dict:
    """The known sentences word by word: a word leads to the words that may follow; "" leads to what a sentence that ends there is."""
    top: dict = {}
    for sentence, what in known().items():
        node = top
        for w in sentence.split():
            node = node.setdefault(w, {})
        node[""] = what
    return top


#: Words of which every known sentence has one; texts without them need no look-up.
ANCHORS = re.compile("licen[sc]|permission|warranty|copyright|distribut|under|covered|liab|mpl|reserved|unencumbered|spdx", re.IGNORECASE)
_SPDX = re.compile(r"spdx-license-identifier:\s*([A-Za-z0-9.+-]+)", re.IGNORECASE)


def sentences(text: str) -> Iterator[tuple[int, int]]:
    """(start, stop) of sentences inside lines."""
    start = 0
    for m in _END.finditer(text):
        if text[start : m.start()].strip():
            yield start, m.start()
        start = m.end()
    if text[start:].strip():
        yield start, len(text)


def identified(text: str) -> list[tuple[int, int, int, str, str | None, str, int]]:
    """(sentence number, start, stop, identifier, licence template, version, number of its last line) of the known sentences of a text, in order."""
    if not ANCHORS.search(text):
        return []
    top, out, spdx = tree(), [], _SPDX.search(text)
    text = _TERM.sub(lambda m: " " * len(m[0]), text)
    spans = list(sentences(text))
    line = -1
    for k, (a, b) in enumerate(spans):
        if k <= line:
            continue
        if hit := _longest(text, spans, k, top):
            (name, template), line, version = hit
            out.append((k, a, spans[line][1], name, template, version, line))
        elif spdx and (m := _SPDX.search(text[a:b])):
            out.append((k, a, b, "spdx", m[1], "", k))
    return out


def _longest(text: str, spans: list[tuple[int, int]], k: int, node: dict) -> tuple[tuple[str, str | None], int, str] | None:
    """(what it is, number of its last piece, last number) of the longest known sentence that begins with piece k and ends with a piece."""
    found, version, line, stop, before = None, "", k, spans[k][1], ""
    stated = False
    if not _WORD.search(text, spans[k][0], stop):
        return None
    for m in _WORD.finditer(text, spans[k][0]):
        while m.start() >= stop:
            # a piece has ended; the sentence may have too, or go on in the next one
            if "" in node:
                found = node[""], line, version
            if text[stop] in ".!?" or _PARAGRAPH.search(text, stop, m.start()):
                return found
            line += 1
            stop = spans[line][1]
        w = m[0].lower()
        number = version
        if w[0].isdigit():
            # the number after "version", else the last one; a date that follows a version is no version
            if before != "version" and stated:
                w = "#"
            else:
                w, number, stated = "#", w, before == "version"
        if w in ("http", "https") and "" in node:
            # an address ends what leads to it
            found = node[""], line, version
        before = _SPELLING.get(w, w)
        node = node.get(before)
        if node is None:
            return found
        version = number
    return (node[""], line, version) if "" in node else found


def recognised(text: str) -> list[dict]:
    """Licences of a text: {license_id, sentences, start, stop}, by the first rule that fits at each identifier that no match before it has used."""
    found = identified(text)
    out, i = [], 0
    while i < len(found):
        for ids, spdx in RULES:
            j, last = i, i
            for k, want in enumerate(ids):
                if k:
                    j = next((x for x in range(last + 1, len(found)) if found[x][3] == want and found[x][0] - found[last][6] <= GAP + 1), -1)
                if j < 0 or found[j][3] != want:
                    break
                last = j
            else:
                template = spdx or found[i][4]
                version = found[i][5]
                out.append({"license_id": template.format(version if "." in version or "Clause" in template else f"{version}.0"), "sentences": list(ids), "start": found[i][1], "stop": found[last][2]})
                i = last
                break
        i += 1
    return out


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, licenses) of every row; licenses: an array of (license_id, sentences, start, stop), in text order, offsets in code points.

    Null and empty texts, and texts without a known sentence, have an empty array. A licence named several times comes as often. Repeated
    rows come out as often as they went in; other columns are ignored; an empty table gives no rows.
    """
    source = df.select(df[id_col].alias("__id"), df[text_col].alias("text"))
    kind = source.schema["__id"].dataType.simpleString()
    shape = pa.list_(pa.struct([("license_id", pa.string()), ("sentences", pa.list_(pa.string())), ("start", pa.int32()), ("stop", pa.int32())]))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in parts:
            for b in slices(whole):
                yield pa.RecordBatch.from_arrays([b.column("__id"), pa.array([recognised(t) for t in text_or_empty(b.column("text"))], shape)], ["__id", "licenses"])

    return source.mapInArrow(run, f"__id {kind}, licenses array<struct<license_id: string, sentences: array<string>, start: int, stop: int>>").withColumnRenamed("__id", id_col)
