"""Licence scans by sentence rules.

A text is cut into statements, those with a word of ``CUES`` are normalised (ASCII lower case, comment
marks and punctuation out, names of holders and years folded) and looked up among known licence
sentences. Each known sentence has an identifier; another sentence with a cue has ``unknown``. The
identifiers of a document, in order, are then matched with ordered rules: at every place the first
rule whose identifiers follow there names a licence and takes them; an identifier that no rule takes
is left over. Rules stand with longer ones first, so a full licence is not read as its first lines.

A statement ends at a full stop or mark before white space ("v. 2.0" is none), or at a blank line. Its
pieces are its lines, cut after semicolons; at every piece the longest known sentence that the pieces
from there on spell is taken, over any number of them. What is left between is ``unknown`` once for
every stretch up to a semicolon that has a cue. An SPDX line that is no known sentence is read as an
expression (``AND``, ``OR``, ``WITH``, brackets), each licence of which is an identifier and a licence of
its own. A null or empty text, or one
without a cue, has no sentences and no licence. Every row is answered by itself; an empty table gives
no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.tables import documents

# Words without which no statement is looked at, in lower case.
CUES = [
    "licen",
    "copyright",
    "redistribut",
    "permission",
    "permitted",
    "warrant",
    "public domain",
    "liable",
    "general public",
    "all rights reserved",
    "endorse",
    "origin of this software",
    "altered source",
    "copy of the mpl",
]

# Known sentences, normalised as :func:`normal` does, by identifier.
SENTENCES = {
    "copyright": ["copyright holder"],
    "rights-reserved": ["all rights reserved"],
    "spdx-mit": ["spdx license identifier mit"],
    "spdx-apache-2.0": ["spdx license identifier apache 2.0"],
    "spdx-bsd-2": ["spdx license identifier bsd 2 clause"],
    "spdx-bsd-3": ["spdx license identifier bsd 3 clause"],
    "spdx-gpl-2": ["spdx license identifier gpl 2.0 only", "spdx license identifier gpl 2.0"],
    "spdx-gpl-2-later": ["spdx license identifier gpl 2.0 or later"],
    "spdx-gpl-3": ["spdx license identifier gpl 3.0 only", "spdx license identifier gpl 3.0"],
    "spdx-gpl-3-later": ["spdx license identifier gpl 3.0 or later"],
    "mit-named": [
        "released under the mit license",
        "licensed under the mit license",
        "the mit license",
        "mit license",
        "this project is licensed under the mit license",
        "distributed under the mit license",
    ],
    "mit-grant": [
        "permission is hereby granted free of charge to any person obtaining a copy of this software and"
        " associated documentation files the software to deal in the software without restriction"
        " including without limitation the rights to use copy modify merge publish distribute sublicense"
        " and or sell copies of the software and to permit persons to whom the software is furnished to"
        " do so subject to the following conditions"
    ],
    "mit-notice": [
        "the above copyright notice and this permission notice shall be included in all copies or"
        " substantial portions of the software"
    ],
    "mit-warranty": [
        "the software is provided as is without warranty of any kind express or implied including but not"
        " limited to the warranties of merchantability fitness for a particular purpose and noninfringement"
    ],
    "mit-liability": [
        "in no event shall the authors or copyright holders be liable for any claim damages or other"
        " liability whether in an action of contract tort or otherwise arising from out of or in connection"
        " with the software or the use or other dealings in the software"
    ],
    "isc-grant": [
        "permission to use copy modify and or distribute this software for any purpose with or without fee"
        " is hereby granted provided that the above copyright notice and this permission notice appear in"
        " all copies"
    ],
    "isc-warranty": [
        "the software is provided as is and the author disclaims all warranties with regard to this software"
        " including all implied warranties of merchantability and fitness"
    ],
    "isc-liability": [
        "in no event shall the author be liable for any special direct indirect or consequential damages or"
        " any damages whatsoever resulting from loss of use data or profits whether in an action of contract"
        " negligence or other tortious action arising out of or in connection with the use or performance of"
        " this software"
    ],
    "apache-named": [
        "licensed under the apache license version 2.0",
        "licensed under the apache license version 2.0 the license",
        "released under the apache license version 2.0",
        "this project is licensed under the apache license version 2.0",
    ],
    "apache-comply": ["you may not use this file except in compliance with the license"],
    "apache-obtain": ["you may obtain a copy of the license at"],
    "apache-url": ["http www.apache.org licenses license 2.0", "https www.apache.org licenses license 2.0"],
    "apache-as-is": [
        "unless required by applicable law or agreed to in writing software distributed under the license"
        " is distributed on an as is basis without warranties or conditions of any kind either express or"
        " implied"
    ],
    "apache-see": [
        "see the license for the specific language governing permissions and limitations under the license"
    ],
    "bsd-grant": [
        "redistribution and use in source and binary forms with or without modification are permitted"
        " provided that the following conditions are met"
    ],
    "bsd-source": [
        "redistributions of source code must retain the above copyright notice this list of conditions and"
        " the following disclaimer"
    ],
    "bsd-binary": [
        "redistributions in binary form must reproduce the above copyright notice this list of conditions"
        " and the following disclaimer in the documentation and or other materials provided with the"
        " distribution"
    ],
    "bsd-endorse": [
        "neither the name of the copyright holder nor the names of its contributors may be used to endorse"
        " or promote products derived from this software without specific prior written permission"
    ],
    "bsd-warranty": [
        "this software is provided by the copyright holders and contributors as is and any express or"
        " implied warranties including but not limited to the implied warranties of merchantability and"
        " fitness for a particular purpose are disclaimed"
    ],
    "bsd-liability": [
        f"in no event shall the {who} be liable for any direct indirect incidental special exemplary or"
        " consequential damages including but not limited to procurement of substitute goods or services"
        " loss of use data or profits or business interruption however caused and on any theory of liability"
        " whether in contract strict liability or tort including negligence or otherwise arising in any way"
        " out of the use of this software even if advised of the possibility of such damage"
        for who in (
            "copyright holder or contributors",
            "copyright holders or contributors",
            "copyright owner or contributors",
            "regents or contributors",
            "author or contributors",
        )
    ],
    "bsd-named": ["licensed under the bsd license", "released under the bsd license"],
    "bsd-3-named": ["licensed under the bsd 3 clause license", "released under the bsd 3 clause license"],
    "gpl-named-3": [
        "this work is licensed under the gnu general public license version 3",
        "licensed under the gnu general public license version 3",
        "released under the gnu general public license version 3",
    ],
    "gpl-named-2": [
        "this work is licensed under the gnu general public license version 2",
        "licensed under the gnu general public license version 2",
        "released under the gnu general public license version 2",
    ],
    "gpl-later-3": [
        "this program is free software you can redistribute it and or modify it under the terms of the gnu"
        " general public license as published by the free software foundation either version 3 of the"
        " license or at your option any later version"
    ],
    "gpl-later-2": [
        "this program is free software you can redistribute it and or modify it under the terms of the gnu"
        " general public license as published by the free software foundation either version 2 of the"
        " license or at your option any later version"
    ],
    "gpl-no-warranty": [
        "this program is distributed in the hope that it will be useful but without any warranty without"
        " even the implied warranty of merchantability or fitness for a particular purpose",
        "this library is distributed in the hope that it will be useful but without any warranty without"
        " even the implied warranty of merchantability or fitness for a particular purpose",
    ],
    "gpl-details": ["see the gnu general public license for more details"],
    "gpl-received": ["you should have received a copy of the gnu general public license along with this program"],
    "gpl-url": ["if not see http www.gnu.org licenses", "if not see https www.gnu.org licenses"],
    "boost-named": ["distributed under the boost software license version 1.0"],
    "boost-file": [
        "see accompanying file license 1 0.txt or copy at http www.boost.org license 1 0.txt",
        "see accompanying file license 1 0.txt or copy at https www.boost.org license 1 0.txt",
    ],
    "boost-title": ["boost software license version 1.0 august 17th 2003"],
    "boost-grant": [
        "permission is hereby granted free of charge to any person or organization obtaining a copy of the"
        " software and accompanying documentation covered by this license the software to use reproduce"
        " display distribute execute and transmit the software and to prepare derivative works of the"
        " software and to permit third parties to whom the software is furnished to do so all subject to the"
        " following"
    ],
    "boost-notice": [
        "the copyright notices in the software and this entire statement including the above license grant"
        " this restriction and the following disclaimer must be included in all copies of the software in"
        " whole or in part and all derivative works of the software unless such copies or derivative works"
        " are solely in the form of machine executable object code generated by a source language processor"
    ],
    "boost-warranty": [
        "the software is provided as is without warranty of any kind express or implied including but not"
        " limited to the warranties of merchantability fitness for a particular purpose title and non"
        " infringement"
    ],
    "boost-liability": [
        "in no event shall the copyright holders or anyone distributing the software be liable for any"
        " damages or other liability whether in contract tort or otherwise arising from out of or in"
        " connection with the software or the use or other dealings in the software"
    ],
    "lgpl-named": ["licensed under the gnu lesser general public license version 3"],
    "agpl-named": ["licensed under the gnu affero general public license version 3"],
    "mpl-named": [
        "this source code form is subject to the terms of the mozilla public license v 2.0",
        "licensed under the mozilla public license version 2.0",
    ],
    "mpl-copy": [
        "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla.org mpl"
        " 2.0 because the license asks for it",
        "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla.org mpl 2.0",
        "if a copy of the mpl was not distributed with this file you can obtain one at http mozilla.org mpl 2.0",
    ],
    "cc-by": ["licensed under cc by 4.0", "this work is licensed under cc by 4.0"],
    "cc-by-sa": ["licensed under cc by sa 4.0", "this work is licensed under cc by sa 4.0"],
    "cc-by-nc": ["licensed under cc by nc 4.0", "this work is licensed under cc by nc 4.0"],
    "cc-by-nc-sa": ["licensed under cc by nc sa 4.0"],
    "cc-by-nd": ["licensed under cc by nd 4.0"],
    "cc0": ["to the public domain under cc0 1.0", "licensed under cc0 1.0"],
    "unlicense": ["this is free and unencumbered software released into the public domain"],
    "zlib-as-is": ["this software is provided as is without any express or implied warranty"],
    "zlib-liability": [
        "in no event will the authors be held liable for any damages arising from the use of this software"
    ],
    "zlib-grant": [
        "permission is granted to anyone to use this software for any purpose including commercial"
        " applications and to alter it and redistribute it freely subject to the following restrictions"
    ],
    "zlib-origin": [
        "the origin of this software must not be misrepresented",
        "the origin of this software must not be misrepresented you must not claim that you wrote the original"
        " software",
    ],
    "zlib-altered": [
        "altered source versions must be plainly marked as such",
        "altered source versions must be plainly marked as such and must not be misrepresented as being the"
        " original software",
    ],
}

# The published headers of the licences that are worded like the GPL: name, versions, what they cover.
KIN = {
    "lgpl": ("gnu lesser general public license", ("2.1", "3"), ("library", "program")),
    "agpl": ("gnu affero general public license", ("3",), ("program",)),
}
for _kin, (_name, _versions, _things) in KIN.items():
    for _version in _versions:
        SENTENCES[f"{_kin}-later-{_version}"] = [
            f"this {thing} is free software you can redistribute it and or modify it under the terms of the {_name}"
            f" as published by the free software foundation either version {_version} of the license or at your"
            " option any later version"
            for thing in _things
        ]
    SENTENCES[f"{_kin}-details"] = [f"see the {_name} for more details"]
    SENTENCES[f"{_kin}-received"] = [
        f"you should have received a copy of the {_name} along with this {thing}" for thing in _things
    ]


def header_rules() -> list[tuple[list[str], str]]:
    """The headers of :data:`KIN`, longer ones first."""
    rules = []
    for kin, (_, versions, _) in KIN.items():
        for version in versions:
            licence = f"{kin.upper()}-{version if '.' in version else version + '.0'}-or-later"
            whole = [f"{kin}-later-{version}", "gpl-no-warranty", f"{kin}-details", f"{kin}-received", "gpl-url"]
            rules += [(whole[:n], licence) for n in (5, 4, 1)]
    return rules


def bsd_rules() -> list[tuple[list[str], str]]:
    """The two BSD notices, with what stands before and without what is often cut off, longer ones first."""
    rules = []
    for before in (["copyright", "rights-reserved"], ["rights-reserved"], []):
        for ends in (["bsd-warranty", "bsd-liability"], ["bsd-warranty"], []):
            conditions = [*before, "bsd-grant", "bsd-source", "bsd-binary"]
            rules.append(([*conditions, "bsd-endorse", *ends], "BSD-3-Clause"))
            rules.append(([*conditions, *ends], "BSD-2-Clause"))
    return sorted(rules, key=lambda rule: -len(rule[0]))


# Identifiers that follow each other, and the licence that they are, first match first.
RULES = [
    (["mit-grant", "mit-notice", "mit-warranty", "mit-liability"], "MIT"),
    *bsd_rules(),
    *header_rules(),
    (["boost-title", "boost-grant", "boost-notice", "boost-warranty", "boost-liability"], "BSL-1.0"),
    (["boost-grant", "boost-notice", "boost-warranty", "boost-liability"], "BSL-1.0"),
    (["boost-named", "boost-file"], "BSL-1.0"),
    (["boost-named"], "BSL-1.0"),
    (["boost-title"], "BSL-1.0"),
    (["apache-named", "apache-comply", "apache-obtain", "apache-url", "apache-as-is", "apache-see"], "Apache-2.0"),
    (["apache-named", "apache-comply", "apache-obtain", "apache-as-is", "apache-see"], "Apache-2.0"),
    (["apache-named", "apache-comply"], "Apache-2.0"),
    (["apache-named"], "Apache-2.0"),
    (["gpl-later-3", "gpl-no-warranty", "gpl-details", "gpl-received", "gpl-url"], "GPL-3.0-or-later"),
    (["gpl-later-3", "gpl-no-warranty", "gpl-details", "gpl-received"], "GPL-3.0-or-later"),
    (["gpl-later-2", "gpl-no-warranty", "gpl-details", "gpl-received", "gpl-url"], "GPL-2.0-or-later"),
    (["gpl-later-2", "gpl-no-warranty", "gpl-details", "gpl-received"], "GPL-2.0-or-later"),
    (["gpl-later-3"], "GPL-3.0-or-later"),
    (["gpl-later-2"], "GPL-2.0-or-later"),
    (["gpl-named-3"], "GPL-3.0"),
    (["gpl-named-2"], "GPL-2.0"),
    (["lgpl-named"], "LGPL-3.0"),
    (["agpl-named"], "AGPL-3.0"),
    (["mpl-named", "mpl-copy"], "MPL-2.0"),
    (["mpl-named"], "MPL-2.0"),
    (["mit-named", "mit-grant", "mit-notice", "mit-warranty", "mit-liability"], "MIT"),
    (["mit-grant", "mit-notice"], "MIT"),
    (["mit-named"], "MIT"),
    (["isc-grant", "isc-warranty", "isc-liability"], "ISC"),
    (["isc-grant", "mit-warranty"], "ISC"),
    (["isc-grant"], "ISC"),
    (["bsd-3-named"], "BSD-3-Clause"),
    (["bsd-named"], "BSD"),
    (["zlib-as-is", "zlib-liability", "zlib-grant", "zlib-origin", "zlib-altered"], "Zlib"),
    (["zlib-as-is", "zlib-origin", "zlib-altered"], "Zlib"),
    (["unlicense"], "Unlicense"),
    (["cc-by"], "CC-BY-4.0"),
    (["cc-by-sa"], "CC-BY-SA-4.0"),
    (["cc-by-nc"], "CC-BY-NC-4.0"),
    (["cc-by-nc-sa"], "CC-BY-NC-SA-4.0"),
    (["cc-by-nd"], "CC-BY-ND-4.0"),
    (["cc0"], "CC0-1.0"),
    (["spdx-mit"], "MIT"),
    (["spdx-apache-2.0"], "Apache-2.0"),
    (["spdx-bsd-2"], "BSD-2-Clause"),
    (["spdx-bsd-3"], "BSD-3-Clause"),
    (["spdx-gpl-2"], "GPL-2.0"),
    (["spdx-gpl-2-later"], "GPL-2.0-or-later"),
    (["spdx-gpl-3"], "GPL-3.0"),
    (["spdx-gpl-3-later"], "GPL-3.0-or-later"),
    (["rights-reserved"], "proprietary"),
]

UNKNOWN = "unknown"
#: What the identifier of a licence in an SPDX expression starts with; the licence follows.
SPDX = "spdx "
KNOWN = {text: name for name, texts in SENTENCES.items() for text in texts}

#: All beginnings of known sentences, in whole words.
STARTS = {" ".join(words[:n]) for words in map(str.split, KNOWN) for n in range(len(words) + 1)}

_GAP = r"\s[\s/*#;%>|-]*"
_END = re.compile(rf"(?<=[.!?])(?!(?<=\b[vV]\.){_GAP}\d)\s+|\n\s*\n")
_CUT = re.compile(r"(?<=;)\s+")
#: Cues of several words may have a line break and comment marks between them.
_CUE_WORDS = [c for c in CUES if " " not in c]
_CUE_PHRASES = [(max(c.split(), key=len), re.compile(_GAP.join(c.split()))) for c in CUES if " " in c]
_MARKS = re.compile(r"^[\s/*#;%>|-]+|[\s*/]+$")
_BULLET = re.compile(r"^\s*(?:(?!v\.\s+\d)\(?[0-9a-z]{1,2}[.)]\s+|[*-]\s+)")
_SPDX = re.compile(r"spdx-license-identifier:", re.IGNORECASE)
_SPDX_TEXT = re.compile(r"[\w\s.+()-]+")
_SPDX_TOKEN = re.compile(r"[()]|[\w.+-]+")
_PUNCT = re.compile(r"[^\w.]+|\.(?!\w)|(?<!\w)\.|_")
_HOLDER = re.compile(r"^(?:copyright|c)(?: c)?(?: [12]\d{3}\b).*|^copyright (?:c )?by .*")


def plain(piece: str) -> str:
    """A line or part of one in lower case: words and dotted numbers only."""
    return " ".join(_PUNCT.sub(" ", _BULLET.sub("", _MARKS.sub("", piece.lower()))).split())


def normal(statement: str) -> str:
    """Lower case, words and dotted numbers only; a copyright line without its names."""
    flat = " ".join(filter(None, map(plain, statement.split("\n"))))
    return "copyright holder" if "\n" not in statement and _HOLDER.match(flat) else flat


def cued(text: str) -> bool:
    low = text.lower()
    return any(c in low for c in _CUE_WORDS) or any(w in low and p.search(low) for w, p in _CUE_PHRASES)


def unknown_ids(pieces: list[str]) -> list[str]:
    """``unknown`` for every stretch of pieces, up to one that ends in a semicolon, that has a cue."""
    stretches = [[]]
    for piece in pieces:
        stretches[-1].append(piece)
        if piece.endswith(";"):
            stretches.append([])
    return [UNKNOWN for s in stretches if cued(" ".join(s))]


def spdx_licences(line: str) -> list[str]:
    """The licences of an SPDX line, in order, exceptions with them; none if it is no whole expression."""
    met = _SPDX.search(line)
    text = line[met.end() :].strip(" \t.*/>-") if met else ""
    if not _SPDX_TEXT.fullmatch(text):
        return []
    found, depth, wanted, beside = [], 0, True, False
    for token in _SPDX_TOKEN.findall(text):
        word = token.upper()
        if wanted and token == "(" and not beside:
            depth += 1
        elif not wanted and token == ")" and depth:
            depth -= 1
        elif wanted and token not in "()" and word not in ("AND", "OR", "WITH"):
            if beside:
                found[-1] += f" WITH {token}"
            else:
                found.append(token)
            wanted = beside = False
        elif not wanted and word in ("AND", "OR"):
            wanted = True
        elif not wanted and word == "WITH":
            wanted = beside = True
        else:
            return []
    return [] if wanted or depth else found


def statement_ids(statement: str) -> list[str]:
    """Identifiers of a statement: of the runs of its pieces that are known, and of what is between."""
    pieces = [p.rstrip() for line in statement.split("\n") for p in _CUT.split(_MARKS.sub("", line))]
    words = [plain(p) for p in pieces]
    found, at, left = [], 0, []
    while at < len(pieces):
        known, end, run = None, at, ""
        if _HOLDER.match(words[at]):
            known, end = "copyright", at + 1
        elif words[at]:
            for k in range(at, len(pieces)):
                run = f"{run} {words[k]}".strip()
                if run not in STARTS:
                    break
                if run in KNOWN:
                    known, end = KNOWN[run], k + 1
        named = [] if known else spdx_licences(pieces[at])
        if known or named:
            found += [*unknown_ids(left), *([known] if known else [SPDX + n for n in named])]
            at, left = end if known else at + 1, []
        else:
            left.append(pieces[at])
            at += 1
    return found + unknown_ids(left)


def sentence_ids(text: str | None) -> list[str]:
    if not text or not cued(text):
        return []
    return [i for s in _END.split(text) if cued(s) for i in statement_ids(s)]


def match_rules(ids: list[str]) -> tuple[list[str], list[str]]:
    """Licences in order, each once, and the identifiers that no rule took."""
    licences, left, at = [], [], 0
    while at < len(ids):
        if ids[at].startswith(SPDX):
            licences.append(ids[at].removeprefix(SPDX))
            at += 1
            continue
        for wanted, name in RULES:
            if ids[at : at + len(wanted)] == wanted:
                licences.append(name)
                at += len(wanted)
                break
        else:
            left.append(ids[at])
            at += 1
    return list(dict.fromkeys(licences)), left


def scan(docs: DataFrame) -> DataFrame:
    """``doc_id, sentence_ids, licences, n_left`` of every row of ``doc_id, text``."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for text in b["text"]:
                ids = sentence_ids(text)
                licences, left = match_rules(ids)
                rows.append((ids, licences, len(left)))
            out = pd.DataFrame(rows, columns=["sentence_ids", "licences", "n_left"])
            yield out.assign(doc_id=b["doc_id"].astype("Int64").array)

    return docs.select("doc_id", "text").mapInPandas(
        read, "sentence_ids array<string>, licences array<string>, n_left long, doc_id long"
    )


def op10_licence_scan(spark: SparkSession, folder: str) -> DataFrame:
    return scan(documents(spark, folder)).select(
        "doc_id",
        F.size("sentence_ids").cast("long").alias("n_sentences"),
        F.array_join("sentence_ids", " ").alias("sentence_ids"),
        F.array_join("licences", " ").alias("licences"),
        "n_left",
    )
