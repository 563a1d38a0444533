"""Licence scans by sentence rules.

A text is cut into sentences, each sentence is normalised, and known licence
sentences are mapped to identifiers (a table keyed by the normalised sentence,
with ``#`` standing for a version number).  The document's sequence of
identifiers is then matched against ordered rules: each rule is a sequence of
identifiers that must follow one another (other, unknown sentences may stand
between); the first rule that fits at a position wins and consumes its
identifiers, so longer notices stand before their parts.

A text is cut into pieces at each full stop, semicolon, colon, question or
exclamation mark before white space, and at each end of a line.  A known
sentence may hold such marks and be wrapped anywhere, so every run of adjacent
pieces is looked up, the longest first; a run goes on only while it begins a
known sentence, and never over a blank line.  A sentence must begin and end
with a piece, whatever stands on the lines around it.

Digits in a known sentence stand for themselves (``bsd 3-clause``, ``cc0``),
and only ``#`` stands for the version.

Only texts that hold one of ``SIGNS`` are cut; every known sentence holds one
(a test checks it), so no text is missed.  The signs are single words, which
no line end can break.  The test runs inside the scan and what follows is done
per row: there is no shuffle and nothing grows with the number of copies.

Defined results: null and empty texts have no row; each match is a row;
repeated rows are scanned row by row; of runs that begin at one piece the
longest counts; an empty table gives no row; texts of any length are scanned
whole; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sylvan.session import ship_package

# fixed values: sentences of public licence notices, by identifier
SENTENCES = {
    "MITname": ["the mit license", "mit license", "the mit license (mit)", "released under the mit license", "licensed under the mit license",
                "this project is licensed under the mit license", "this software is released under the mit license",
                "distributed under the mit license", "license: mit", "spdx-license-identifier: mit"],
    "MITgrant": ["permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
                 "documentation files (the \"software\"), to deal in the software without restriction, including without limitation "
                 "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the software, and to "
                 "permit persons to whom the software is furnished to do so, subject to the following conditions"],
    "MITnotice": ["the above copyright notice and this permission notice shall be included in all copies or substantial portions of "
                  "the software"],
    "AsIsMIT": ["the software is provided \"as is\", without warranty of any kind, express or implied, including but not limited to "
                "the warranties of merchantability, fitness for a particular purpose and noninfringement"],
    "LiabMIT": ["in no event shall the authors or copyright holders be liable for any claim, damages or other liability, whether in "
                "an action of contract, tort or otherwise, arising from, out of or in connection with the software or the use or "
                "other dealings in the software"],
    "ApacheName": ["licensed under the apache license, version #", "released under the apache license, version #",
                   "this work is licensed under the apache license, version #", "apache license, version #", "license: apache-#",
                   "licensed under the apache license, version # (the \"license\")", "spdx-license-identifier: apache-#"],
    "ApacheUse": ["you may not use this file except in compliance with the license"],
    "ApacheObtain": ["you may obtain a copy of the license at http://www.apache.org/licenses/license-#",
                     "you may obtain a copy of the license at"],
    "ApacheAsIs": ["unless required by applicable law or agreed to in writing, software distributed under the license is distributed "
                   "on an \"as is\" basis, without warranties or conditions of any kind, either express or implied"],
    "ApacheSee": ["see the license for the specific language governing permissions and limitations under the license"],
    "GPLname": ["this work is licensed under the gnu general public license, version #", "gnu general public license, version #",
                "licensed under the gnu general public license, version #", "released under the gnu general public license, version #",
                "licensed under the gpl, version #", "spdx-license-identifier: gpl-#-only", "license: gpl-#",
                "spdx-license-identifier: gpl-#"],
    "GPLlaterName": ["spdx-license-identifier: gpl-#-or-later", "spdx-license-identifier: gpl-#+", "license: gpl-#+"],
    "GPLfree": ["this program is free software: you can redistribute it and/or modify it under the terms of the gnu general public "
                "license as published by the free software foundation, either version # of the license, or (at your option) any "
                "later version"],
    "GPLonly": ["this program is free software; you can redistribute it and/or modify it under the terms of the gnu general public "
                "license as published by the free software foundation; version # of the license"],
    "GPLwarranty": ["this program is distributed in the hope that it will be useful, but without any warranty; without even the "
                    "implied warranty of merchantability or fitness for a particular purpose"],
    "GPLsee": ["see the gnu general public license for more details"],
    "GPLreceived": ["you should have received a copy of the gnu general public license along with this program"],
    "LGPLname": ["licensed under the gnu lesser general public license, version #", "spdx-license-identifier: lgpl-#-only",
                 "spdx-license-identifier: lgpl-#"],
    "LGPLlaterName": ["spdx-license-identifier: lgpl-#-or-later", "spdx-license-identifier: lgpl-#+"],
    "AGPLname": ["licensed under the gnu affero general public license, version #", "spdx-license-identifier: agpl-#-only",
                 "spdx-license-identifier: agpl-#"],
    "AGPLlaterName": ["spdx-license-identifier: agpl-#-or-later", "spdx-license-identifier: agpl-#+"],
    "MITorApache": ["spdx-license-identifier: mit or apache-#", "licensed under the mit license or the apache license, version #",
                    "licensed under either of apache license, version # or mit license"],
    "ApacheOrMIT": ["spdx-license-identifier: apache-# or mit"],
    "ISCname": ["licensed under the isc license", "isc license", "released under the isc license", "spdx-license-identifier: isc"],
    "ISCgrant": ["permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
                 "granted, provided that the above copyright notice and this permission notice appear in all copies",
                 "permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby "
                 "granted, provided that the above copyright notice and this permission notice appear in all copies"],
    "BSLname": ["distributed under the boost software license, version #", "licensed under the boost software license, version #",
                "boost software license - version #", "spdx-license-identifier: bsl-#"],
    "UnlicenseFree": ["this is free and unencumbered software released into the public domain", "spdx-license-identifier: unlicense"],
    "BSDredist": ["redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
                  "following conditions are met"],
    "BSDsource": ["redistributions of source code must retain the above copyright notice, this list of conditions and the following "
                  "disclaimer"],
    "BSDbinary": ["redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
                  "following disclaimer in the documentation and/or other materials provided with the distribution"],
    "BSDendorse": ["neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
                   "products derived from this software without specific prior written permission"],
    "BSD3name": ["licensed under the bsd 3-clause license", "spdx-license-identifier: bsd-3-clause"],
    "BSD2name": ["licensed under the bsd 2-clause license", "spdx-license-identifier: bsd-2-clause"],
    "MPLname": ["this source code form is subject to the terms of the mozilla public license, v. #", "spdx-license-identifier: mpl-#",
                "licensed under the mozilla public license, version #"],
    "CCBYNC": ["spdx-license-identifier: cc-by-nc-#", "licensed under cc by-nc #", "this work is licensed under cc by-nc #",
               "this work is licensed under a creative commons attribution-noncommercial # international license"],
    "CCBYND": ["licensed under cc by-nd #", "this work is licensed under cc by-nd #", "spdx-license-identifier: cc-by-nd-#",
               "this work is licensed under a creative commons attribution-noderivatives # international license"],
    "CCBYSA": ["spdx-license-identifier: cc-by-sa-#", "licensed under cc by-sa #", "this work is licensed under cc by-sa #",
               "this work is licensed under a creative commons attribution-sharealike # international license"],
    "CCBY": ["spdx-license-identifier: cc-by-#", "licensed under cc by #", "this work is licensed under cc by #",
             "this work is licensed under a creative commons attribution # international license"],
    "CC0": ["spdx-license-identifier: cc0-#", "this work is dedicated to the public domain under cc0 #"],
}

#: Ordered rules: licence, and the identifiers that must follow one another.  ``#`` in a name is the version found.
RULES = [
    ("MIT", ["MITname", "MITgrant", "MITnotice", "AsIsMIT", "LiabMIT"]),
    ("MIT", ["MITgrant", "MITnotice", "AsIsMIT", "LiabMIT"]),
    ("MIT", ["MITgrant", "MITnotice"]),
    ("MIT", ["MITname"]),
    ("Apache-#", ["ApacheName", "ApacheUse", "ApacheObtain", "ApacheAsIs", "ApacheSee"]),
    ("Apache-#", ["ApacheName", "ApacheUse"]),
    ("Apache-#", ["ApacheName"]),
    ("GPL-#-or-later", ["GPLfree", "GPLwarranty", "GPLsee", "GPLreceived"]),
    ("GPL-#-or-later", ["GPLfree", "GPLwarranty"]),
    ("GPL-#-or-later", ["GPLfree"]),
    ("GPL-#-or-later", ["GPLlaterName"]),
    ("GPL-#", ["GPLonly", "GPLwarranty"]),
    ("GPL-#", ["GPLonly"]),
    ("GPL-#", ["GPLname"]),
    ("LGPL-#", ["LGPLname"]),
    ("LGPL-#-or-later", ["LGPLlaterName"]),
    ("AGPL-#", ["AGPLname"]),
    ("AGPL-#-or-later", ["AGPLlaterName"]),
    ("MIT OR Apache-#", ["MITorApache"]),
    ("Apache-# OR MIT", ["ApacheOrMIT"]),
    ("ISC", ["ISCname", "ISCgrant"]),
    ("ISC", ["ISCgrant"]),
    ("ISC", ["ISCname"]),
    ("BSL-#", ["BSLname"]),
    ("Unlicense", ["UnlicenseFree"]),
    ("BSD-3-Clause", ["BSDredist", "BSDsource", "BSDbinary", "BSDendorse"]),
    ("BSD-2-Clause", ["BSDredist", "BSDsource", "BSDbinary"]),
    ("BSD-3-Clause", ["BSD3name"]),
    ("BSD-2-Clause", ["BSD2name"]),
    ("MPL-#", ["MPLname"]),
    ("CC-BY-NC-#", ["CCBYNC"]),
    ("CC-BY-ND-#", ["CCBYND"]),
    ("CC-BY-SA-#", ["CCBYSA"]),
    ("CC-BY-#", ["CCBY"]),
    ("CC0-#", ["CC0"]),
]

#: Every known sentence holds one of these, each within a word.
SIGNS = ("licens", "permission", "warrant", "copyright", "redistribut", "unencumbered", "cc0")

PLACED = re.compile(r"\d+(?:\.\d+)*|#")
COMMENT = re.compile(r"^[ \t]*(?:/\*+|\*+/?|//+|#+|--+|;+|%+|<!--)?[ \t]*|[ \t]*(?:\*+/|-->)?[ \t]*$", re.M)
END = re.compile(r"[.;:!?](?=\s)|\n(?P<blank>[ \t]*\n)?")
WORDS = re.compile(r"[a-z0-9#]+\+?")


def normalise(sentence: str) -> tuple[str, list[str]]:
    """(words of the sentence with ``#`` for its numbers, those numbers)."""
    low = sentence.lower()
    return " ".join(WORDS.findall(PLACED.sub("#", low))), PLACED.findall(low)


def _table() -> tuple[dict[str, list[tuple[str, list[str]]]], set[str]]:
    """Known sentences by their words, as (identifier, numbers) where ``#`` is any number; and what they begin with."""
    known: dict[str, list[tuple[str, list[str]]]] = {}
    begins: set[str] = set()
    for key, group in SENTENCES.items():
        for s in group:
            words, numbers = normalise(s)
            known.setdefault(words, []).append((key, numbers))
            split = words.split()
            begins.update(" ".join(split[:i]) for i in range(1, len(split) + 1))
    return known, begins


KNOWN, BEGINS = _table()


def sentences(text: str) -> list[tuple[str, list[str], bool]]:
    """(words, numbers, whether a blank line stands before it) of every piece that has words."""
    out, start, fresh, clean = [], 0, True, COMMENT.sub("", text)
    for m in END.finditer(clean):
        words, numbers = normalise(clean[start:m.end()])
        if words:
            out.append((words, numbers, fresh))
            fresh = False
        fresh, start = fresh or m["blank"] is not None, m.end()
    words, numbers = normalise(clean[start:])
    return [*out, (words, numbers, fresh)] if words else out


def lookup(words: str, numbers: list[str]) -> tuple[str, str] | None:
    """(identifier, version) of a known sentence."""
    for key, known in KNOWN.get(words, ()):
        if all(k in ("#", n) for k, n in zip(known, numbers)):
            return key, next((n for k, n in zip(known, numbers) if k == "#" != n), "")
    return None


def identify(text: str) -> list[tuple[str, str]]:
    """The known sentences' (identifier, version) in their order."""
    found, pieces, i = [], sentences(text), 0
    while i < len(pieces):
        run, numbers, best, after = "", [], None, i + 1
        for j in range(i, len(pieces)):
            words, more, fresh = pieces[j]
            run = f"{run} {words}" if run else words
            if run not in BEGINS or (fresh and j > i):
                break
            numbers = numbers + more
            hit = lookup(run, numbers)
            if hit:
                best, after = hit, j + 1
        if best:
            found.append(best)
        i = after
    return found


def match(ids: list[tuple[str, str]]) -> list[tuple[str, int, int]]:
    """(licence, first identifier's position, identifiers used) by the ordered rules."""
    out, i, names = [], 0, [k for k, _ in ids]
    while i < len(ids):
        for licence, seq in RULES:
            if names[i:i + len(seq)] == seq:
                version = next((v for _, v in ids[i:i + len(seq)] if v), "")
                out.append((licence.replace("#", version), i, len(seq)))
                i += len(seq)
                break
        else:
            i += 1
    return out


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, licence, position, n_sentences, sentence_ids`` of every licence notice found."""
    ship_package(docs.sparkSession)
    id_type = docs.schema[id_col].dataType.simpleString()
    low = F.lower(F.col(text_col))
    signed = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), low.alias("low"))
    hits = None
    for sign in SIGNS:
        hit = F.contains("low", F.lit(sign))
        hits = hit if hits is None else hits | hit

    def rows(batches):
        for batch in batches:
            out = [[] for _ in range(5)]
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = identify(text.as_py())
                for licence, at, n in match(ids):
                    for col, v in zip(out, (doc, licence, at, n, ",".join(k for k, _ in ids[at:at + n]))):
                        col.append(v)
            kinds = [batch.schema.field(0).type, pa.string(), pa.int32(), pa.int32(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds)],
                                             names=["doc_id", "licence", "position", "n_sentences", "sentence_ids"])

    return signed.where(hits).select("doc_id", "text").mapInArrow(
        rows, f"doc_id {id_type}, licence string, position int, n_sentences int, sentence_ids string")
