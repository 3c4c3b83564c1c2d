"""Licence scans by sentence rules (operator 2).

A text is cut into sentences, each of them normalised and looked up among
known licence sentences, which gives a sequence of sentence identifiers. A
licence is found where the identifiers of one of its rules stand in the
rule's order, with no other known sentence between them. A sentence may run
over the wrapped lines of a paragraph and may also begin or end at a line's end.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_SUBJECT = r"(?:(?:this|the) )?(?:work|program|software|file|library|package|project|code|source code|document|documentation|content|text)"
_VERSION = r"(?:(?: version| v)? ?(?P<v>\d+(?: \d+)*)(?: only| or later| or any later version)?)?"
_FSF = r"you can redistribute it and or modify it under the terms of the gnu {} public license(?: version (?P<v>\d+(?: \d+)*)(?: only)?)? as published by the free software foundation(?: either version (?P<later>\d+(?: \d+)*) of the license or at your option any later version)?"
_CC = r"cc by(?: nc)?(?: sa| nd)?"
_CC_LONG = r"creative commons attribution(?: noncommercial| non commercial)?(?: sharealike| share alike| noderivatives| noderivs| no derivatives)?"
#: Known sentences, normalised, as patterns of whole sentences: identifier and text; a group named v is the version.
SENTENCES = (
    ("gpl-grant", _SUBJECT + r" is (?:licensed|released|distributed|available|made available) under the (?:terms of the )?(?:gnu general public license|gnu gpl|gpl)" + _VERSION),
    ("lgpl-grant", _SUBJECT + r" is (?:licensed|released|distributed|available|made available) under the (?:terms of the )?(?:gnu (?:lesser|library) general public license|gnu lgpl|lgpl)" + _VERSION),
    ("agpl-grant", _SUBJECT + r" is (?:licensed|released|distributed|available|made available) under the (?:terms of the )?(?:gnu affero general public license|gnu agpl|agpl)" + _VERSION),
    ("cc-grant", r"(?:" + _SUBJECT + r" is )?(?:licensed|released|distributed|available|made available) under (?:the terms of )?(?:a |the )?(?P<name>" + _CC + "|" + _CC_LONG + r") (?P<v>\d+(?: \d+)*)(?: international| unported| generic)?(?: license)?"),
    ("mit-grant", r"(?:" + _SUBJECT + r" is )?(?:released|licensed|distributed|available|made available) under the (?:terms of the )?mit license"),
    ("bsd-grant", r"(?:" + _SUBJECT + r" is )?(?:released|licensed|distributed|available|made available) under the (?:terms of the )?(?:(?:new|modified|simplified|[234] clause) )?bsd(?: [234] clause)? license"),
    ("mpl-grant", r"(?:" + _SUBJECT + r" is )?(?:released|licensed|distributed|available|made available) under the (?:terms of the )?mozilla public license" + _VERSION),
    ("apache-grant", r"(?:" + _SUBJECT + r" is )?(?:(?:released |distributed )?licensed|released|distributed|available|made available) under the (?:terms of the )?apache license" + _VERSION + r"(?: the license)?"),
    ("asf-contributors", r"licensed to the apache software foundation asf under one or more contributor license agreements"),
    ("asf-grant", r"the asf licenses this file to you under the apache license version (?P<v>\d+(?: \d+)*) the license"),
    ("apache-except", r"you may not use this (?:file|work|software) except in compliance with the license"),
    ("apache-copy", r"you may obtain a copy of the license at(?: https? www apache org licenses license 2 0(?: txt| html)?)?"),
    ("apache-disclaimer", r"unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied"),
    ("apache-limits", r"see the license for the specific language governing permissions and limitations under the license"),
    ("fsf-free", r"(?:this|[a-z0-9]+) (?:program |library |software |file )?is free software"),
    ("gpl-terms", _FSF.format("general")),
    ("lgpl-terms", _FSF.format("(?:lesser|library) general")),
    ("agpl-terms", _FSF.format("affero general")),
    ("fsf-later", r"either version (?P<v>\d+(?: \d+)*) of the license or at your option any later version"),
    ("fsf-warranty", r"(?:this|[a-z0-9]+) (?:program |library |software |file )?is distributed in the hope that it will be useful but without any warranty"),
    ("fsf-implied", r"without even the implied warranty of merchantability or fitness for a particular purpose"),
    ("fsf-details", r"see the gnu (?:(?:lesser|library|affero) )?general public license for more details"),
    ("fsf-copy", r"you should have received a copy of the gnu (?:(?:lesser|library|affero) )?general public license along with this (?:program|library|software|file)"),
    ("mit-permission", r"permission is hereby granted free of charge to any person obtaining a copy of this software .*"),
    ("mit-notice", r"the above copyright notice and this permission notice(?: including the next paragraph)? shall be included in all copies or substantial portions of the software"),
    ("isc-permission", r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("isc-disclaimer", r"the software is provided as is and .* disclaims all warranties .*"),
    ("bsd-permission", r"redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met.*"),
    ("bsd-source", r"(?:1 |a )?redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    ("bsd-binary", r"(?:2 |b )?redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution"),
    ("bsd-name", r"(?:3 |c )?neither the names? of .* may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("bsd-advertising", r"(?:3 |c )?all advertising materials mentioning features or use of this software must display the following acknowledgement.*"),
    ("bsd-disclaimer", r"this software is provided by .* as is and any express or implied warranties .*"),
    ("bsd-liability", r"in no event shall .* be liable for any direct indirect incidental special exemplary or consequential damages .*"),
    ("mit-liability", r"in no event shall .* be liable for any claim damages or other liability .*"),
    ("isc-liability", r"in no event shall .* be liable for any special direct indirect or consequential damages .*"),
    ("as-is", r"(?:the|this) software is provided as is .*"),
    ("mpl-terms", r"this source code form is subject to the terms of the mozilla public license v(?:ersion)?(?: |\.)(?P<v>\d+(?: \d+)*)"),
    ("mpl-copy", r"if a copy of the mpl was not distributed with this file you can obtain one at(?: https? (?:www )?mozilla org mpl 2 0)?"),
    ("unlicense-grant", r"this is free and unencumbered software released into the public domain"),
    ("unlicense-terms", r"anyone is free to copy modify publish use compile sell or distribute this software .*"),
)
_FSF_END = (("fsf-warranty", "fsf-implied", "fsf-details", "fsf-copy"), ("fsf-warranty", "fsf-implied", "fsf-details"), ())
_BSD_END = ("bsd-disclaimer", "bsd-liability")
#: Rules by licence and identifiers in order; where several fit at the same sentence, the longest counts, and the first of those.
RULES = tuple(
    sorted(
        (
            ("MIT", ("mit-permission", "mit-notice", "as-is", "mit-liability")),
            ("MIT", ("mit-permission", "mit-notice", "as-is")),
            ("MIT", ("mit-permission", "mit-notice")),
            ("MIT", ("mit-permission",)),
            ("MIT", ("mit-grant",)),
            ("ISC", ("isc-permission", "isc-disclaimer", "isc-liability")),
            ("ISC", ("isc-permission",)),
            ("BSD", ("bsd-permission", "bsd-source", "bsd-binary", "bsd-name", *_BSD_END)),
            ("BSD", ("bsd-permission", "bsd-source", "bsd-binary", "bsd-advertising", "bsd-name", *_BSD_END)),
            ("BSD", ("bsd-permission", "bsd-source", "bsd-binary", *_BSD_END)),
            ("BSD", ("bsd-permission", "bsd-source", "bsd-binary")),
            ("BSD", ("bsd-permission", "as-is")),
            ("BSD", ("bsd-permission",)),
            ("BSD", ("bsd-grant",)),
            ("Apache", ("apache-grant", "apache-except", "apache-copy", "apache-disclaimer", "apache-limits")),
            ("Apache", ("asf-contributors", "asf-grant", "apache-except", "apache-copy", "apache-disclaimer", "apache-limits")),
            ("Apache", ("asf-contributors", "asf-grant")),
            ("Apache", ("asf-grant",)),
            ("Apache", ("apache-grant", "apache-except")),
            ("Apache", ("apache-grant",)),
            *((name, (*start, *end)) for name, terms in (("GPL", "gpl-terms"), ("LGPL", "lgpl-terms"), ("AGPL", "agpl-terms")) for start in (("fsf-free", terms, "fsf-later"), ("fsf-free", terms), (terms, "fsf-later"), (terms,)) for end in _FSF_END),
            ("GPL", ("gpl-grant",)),
            ("LGPL", ("lgpl-grant",)),
            ("AGPL", ("agpl-grant",)),
            ("CC", ("cc-grant",)),
            ("MPL", ("mpl-terms", "mpl-copy")),
            ("MPL", ("mpl-terms",)),
            ("MPL", ("mpl-grant",)),
            ("Unlicense", ("unlicense-grant", "unlicense-terms")),
            ("Unlicense", ("unlicense-grant",)),
        ),
        key=lambda rule: -len(rule[1]),
    )
)
#: Words that every known sentence has one of; paragraphs without them aren't normalised.
HINT = re.compile(r"licen[cs]e|permi|software|redistribution|warrant|liab|advertising|\bmpl\b|\bcc\W{1,3}by\b|creative\W{1,3}commons", re.IGNORECASE)
#: In a normalised paragraph "." stands after a sentence, "/" after a line or a colon, and " " after any other word.
_KNOWN = [(name, re.compile(r"(?:^|(?<=[./]))" + pattern.replace(" ", "[ /]").replace(".*", "[^.]*") + r"(?=[./])")) for name, pattern in SENTENCES]
#: A line without letters or digits ends a paragraph.
_PARAGRAPH_END = re.compile(r"\n[^A-Za-z0-9\n]*(?=\n)")
_SHORT = (("creative commons attribution", "cc by"), ("non ?commercial", "nc"), ("share ?alike", "sa"), ("no ?derivatives|noderivs", "nd"))
_WORD = re.compile(r"[a-z0-9]+")
_COLON = re.compile(r":\s")
_MARK = re.compile(r"[.!?;](?=\W*\s|\W*\Z)", re.ASCII)


@dataclass(frozen=True)
class Sentence:
    name: str
    begin: int
    end: int
    version: str | None
    form: str | None


def _in_paragraph(text: str, begin: int, end: int) -> list[Sentence]:
    """The known sentences of text[begin:end], in order; of those that overlap, the one that begins first, or the longest."""
    own = text[begin:end]
    lower = "".join(c.lower() if c.isascii() else "\0" for c in own) if not own.isascii() else own.lower()
    words = [m.span() for m in _WORD.finditer(lower)]
    parts, starts, at = [], [], 0
    for (a, b), after in zip(words, [*(w[0] for w in words[1:]), len(own)], strict=True):
        gap = own[b:after]
        parts += (lower[a:b], "." if after == len(own) or _MARK.search(gap + own[after : after + 1]) else "/" if "\n" in gap or _COLON.search(gap) else " ")
        starts.append(at)
        at += b - a + 1
    normal = "".join(parts)
    found = []
    for name, pattern in _KNOWN:
        for known in pattern.finditer(normal):
            groups = known.groupdict()
            version, form = (x and x.replace("/", " ") for x in (groups.get("v") or groups.get("later"), groups.get("name")))
            first, last = bisect_left(starts, known.start()), bisect_left(starts, known.end()) - 1
            stop = words[last][1]
            if mark := re.match(r"[^\w\s]*[.!?;]", own[stop:]):
                stop += mark.end()
            found.append(Sentence(name, begin + words[first][0], begin + stop, version, form))
    out = []
    for sentence in sorted(found, key=lambda s: (s.begin, -s.end)):  # among equal ones the first in the table
        if not out or sentence.begin >= out[-1].end:
            out.append(sentence)
    return out


def sentences(text: str) -> list[Sentence]:
    """The known sentences of a text, in order."""
    out = []
    at = 0
    while hint := HINT.search(text, at):
        # the paragraph around the hint; those without hints have no known sentence
        begin = at
        for gap in _PARAGRAPH_END.finditer(text, at, hint.start()):
            begin = gap.end()
        gap = _PARAGRAPH_END.search(text, hint.end())
        end = gap.start() if gap else len(text)
        out += _in_paragraph(text, begin, end)
        at = end
    return out


def _form(name: str) -> str:
    """CC-BY-NC and the like, of the short or the long name."""
    for long, short in _SHORT:
        name = re.sub(long, short, name)
    return name.upper().replace(" ", "-")


def licences(text: str | None) -> list[tuple[str, int, int]]:
    """Licence names with the places of their texts, by the longest rule that fits at each sentence."""
    known, out, at = sentences(text or ""), [], 0
    names = [s.name for s in known]
    while at < len(known):
        for licence, rule in RULES:
            if tuple(names[at : at + len(rule)]) == rule:
                own = known[at : at + len(rule)]
                form = next((_form(x.form) for x in own if x.form), licence)
                version = next((x.version.replace(" ", ".") for x in own if x.version), "")
                name = f"{form}-{version}" if version else form
                out.append((name, own[0].begin, own[-1].end))
                at += len(rule)
                break
        else:
            at += 1
    return out


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` with `licences`: name, `begin` and `end` (code points) of every licence found, in order; none for null and empty texts.

    A column of that name is replaced.
    """
    rest = [c for c in docs.columns if c != "licences"]
    spare = next(name for name in ("_text", *(f"_text_{i}" for i in range(len(docs.columns) + 1))) if name not in docs.columns)
    found = T.ArrayType(T.StructType([T.StructField("name", T.StringType()), T.StructField("begin", T.LongType()), T.StructField("end", T.LongType())]))
    kind = pa.list_(pa.struct([("name", pa.string()), ("begin", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [[{"name": n, "begin": a, "end": b} for n, a, b in licences(x)] for x in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(out, kind)], names=[*rest, "licences"])

    ready = docs.select(*(F.col(f"`{c}`") for c in rest), F.col(text).alias(spare))
    return ready.mapInArrow(run, T.StructType([*(docs.schema[c] for c in rest), T.StructField("licences", found)]))
