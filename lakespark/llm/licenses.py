"""License scan by sentence rules: sentences become identifiers, and sequences of identifiers match rules."""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame

from lakespark.llm.common import map_arrow

#: Sentences of public licence texts and notices, in lower-case letters and digits, everything between them one blank.
SENTENCES = {
    "mit-notice": "released under the mit license",
    "mit-notice-2": "licensed under the mit license",
    "mit-notice-3": "this project is licensed under the mit license",
    "mit-title": "mit license",
    "mit-title-2": "the mit license mit",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "mit-notice-kept": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "as-is": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "apache-2-notice": "licensed under the apache license version 2 0",
    "apache-2-notice-long": "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license",
    "apache-copy": "you may obtain a copy of the license at http www apache org licenses license 2 0",
    "apache-limits": "see the license for the specific language governing permissions and limitations under the license",
    "gpl-3-notice": "this work is licensed under the gnu general public license version 3",
    "gpl-free": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl-2-free": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    "gpl-hope": "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "bsd-grant": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsd-source": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "bsd-binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "bsd-name": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "isc-grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "mpl-2-notice": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "cc-by-4": "this work is licensed under a creative commons attribution 4 0 international license",
    "unlicense": "this is free and unencumbered software released into the public domain",
}
#: License and the identifiers that make it, in this order, longest rules first.
RULES = (
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-name")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("MIT", ("mit-grant", "mit-notice-kept", "as-is")),
    ("Apache-2.0", ("apache-2-notice-long", "apache-copy", "apache-limits")),
    ("Apache-2.0", ("apache-2-notice-long", "apache-copy")),
    ("GPL-3.0-or-later", ("gpl-free", "gpl-hope")),
    ("GPL-2.0-or-later", ("gpl-2-free", "gpl-hope")),
    ("MIT", ("mit-grant", "mit-notice-kept")),
    ("MIT", ("mit-notice",)),
    ("MIT", ("mit-notice-2",)),
    ("MIT", ("mit-notice-3",)),
    ("MIT", ("mit-grant",)),
    ("Apache-2.0", ("apache-2-notice",)),
    ("Apache-2.0", ("apache-2-notice-long",)),
    ("GPL-3.0-only", ("gpl-3-notice",)),
    ("GPL-3.0-or-later", ("gpl-free",)),
    ("GPL-2.0-or-later", ("gpl-2-free",)),
    ("ISC", ("isc-grant",)),
    ("MPL-2.0", ("mpl-2-notice",)),
    ("CC-BY-4.0", ("cc-by-4",)),
    ("Unlicense", ("unlicense",)),
)
_LONGEST = max(map(len, SENTENCES.values()))
#: Known sentences by their first word, longest first; between two words anything but letters and digits.
_STARTING: dict[str, list[tuple[str, re.Pattern]]] = {}
for _name, _text in sorted(SENTENCES.items(), key=lambda x: -len(x[1])):
    _STARTING.setdefault(_text.split()[0], []).append((_name, re.compile("[^a-z0-9]+".join(_text.split()) + "(?![a-z0-9])", re.I | re.A)))
#: A sentence ends with a mark that a blank follows, or with its line.
_CUT = re.compile(r"[.!?;:](?=\s)|\n")
#: What follows the start of the text or a cut: no letters or digits, and perhaps the first word of a known sentence.
_START = re.compile(rf"(?:\A|[.!?;:](?=\s)|\n)([^a-z0-9]*+)(?:({'|'.join(_STARTING)})(?![a-z0-9]))?", re.I | re.A)
_END = re.compile(r"[^a-z0-9\n]*?(?:[.!?;:](?=\s|\Z)|(?=\n)|\Z)", re.I | re.A)
_SPDX = re.compile(r"SPDX-License-Identifier:[ \t]*([A-Za-z0-9.+-]+)")


def recognised(text: str) -> list[tuple[int, int, str]]:
    """(start, end, identifier) of the known sentences of a text, in order and without overlap.

    A known sentence starts and ends at a mark or a line break, and may run over others: headers are wrapped,
    have comment signs before their lines, and hold ``;`` and ``:``. Of several at one place the longest counts.
    """
    found, at = [], 0
    for m in _START.finditer(text):
        if m[2] and m.start(2) >= at:
            for name, pattern in _STARTING[m[2].lower()]:
                words = pattern.match(text, m.start(2))
                end = words and words.end() - words.start() <= 3 * _LONGEST and _END.match(text, words.end())
                if end:
                    lead = _CUT.split(m[1])[-1].lstrip()
                    at = end.end()
                    found.append((m.start(2) - len(lead), words.end() + len(end[0].rstrip()), name))
                    break
    return found


def licences(text: str, ids: list[tuple[int, int, str]]) -> list[tuple[str, int, int]]:
    """(license, start, end) of the rules that match: the first rule that fits at each place, without overlap."""
    out, at = [], 0
    while at < len(ids):
        names = tuple(name for _, _, name in ids[at : at + 4])
        rule = next(((lic, seq) for lic, seq in RULES if names[: len(seq)] == seq), None)
        if rule:
            out.append((rule[0], ids[at][0], ids[at + len(rule[1]) - 1][1]))
            at += len(rule[1])
        else:
            at += 1
    out += [(m[1], m.start(), m.end()) for m in _SPDX.finditer(text)]
    return sorted(out, key=lambda x: (x[1], x[2], x[0]))


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_sentences (recognised), licenses (distinct, by name, comma-joined) and spans of every row of ``docs``.

    ``spans`` is an array of (license, start, end) in code points of the whole text, by place. Null and
    empty texts have none; repeated rows give repeated results; other columns are ignored.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts, names, spans = [], [], []
        for text in batch.column("text").to_pylist():
            ids = recognised(text or "")
            found = licences(text or "", ids)
            counts.append(len(ids))
            names.append(",".join(sorted({f[0] for f in found})))
            spans.append([{"license": a, "start": b, "end": c} for a, b, c in found])
        kind = pa.list_(pa.struct([("license", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(names, pa.string()), pa.array(spans, kind)],
            ["doc_id", "n_sentences", "licenses", "spans"],
        )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_arrow(
        docs.select("doc_id", "text"), run, f"doc_id {kind}, n_sentences long, licenses string, spans array<struct<license: string, start: bigint, end: bigint>>"
    )
