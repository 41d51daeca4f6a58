"""Licence recognition by sentences and ordered rules.

A text is cut into sentences at line ends and after ``. ! ? ; :`` before white space; each sentence
is reduced to lower-case letters and digits with single spaces and looked up among the known licence
sentences. A known sentence may also be wrapped: any run of lines that follow each other without an
empty line or the end of a sentence between them counts as one sentence if together it is a known one,
the longest first; marks of comments go with the other marks, ``rem`` and ``dnl`` as well. What a document
has is then a sequence of sentence identifiers, with ``-`` for any other sentence (its lines in a row
count once between two identifiers), and a licence is found where the identifiers of one of its rules
follow each other in order with at most ``gap`` other sentences between two of them.

Defined results: NULL and empty texts have no sentence and no licence; a sentence that repeats is
listed once in ``sentence_ids`` in the order of first occurrence; rules of several licences may
hold at once and are listed in the order of names; an empty table gives an empty result.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sentences of public licence texts and notices, as their publishers print them.
SENTENCES = {
    "mit-notice": "Released under the MIT License.",
    "mit-licensed": "Licensed under the MIT License.",
    "mit-name": "The MIT License (MIT)",
    "mit-short": "MIT License",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    "mit-keep": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "mit-as-is": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "isc-as-is": "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.",
    "bsd-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "bsd-names": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "apache-notice": "Licensed under the Apache License, Version 2.0.",
    "apache-grant": "Licensed under the Apache License, Version 2.0 (the \"License\");",
    "apache-comply": "you may not use this file except in compliance with the License.",
    "apache-copy": "You may obtain a copy of the License at",
    "apache-as-is": "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    "gpl2-notice": "This work is licensed under the GNU General Public License, version 2.",
    "gpl3-notice": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-free": "This program is free software:",
    "gpl2-terms": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation;",
    "gpl2-version": "either version 2 of the License, or (at your option) any later version.",
    "gpl3-terms": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "gpl-hope": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;",
    "lgpl3-notice": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "agpl3-notice": "This work is licensed under the GNU Affero General Public License, version 3.",
    "mpl-start": "This Source Code Form is subject to the terms of the Mozilla Public License, v.",
    "mpl-notice": "Licensed under the Mozilla Public License, Version 2.0.",
    "cc0-notice": "Released under CC0 1.0.",
    "cc-by-notice": "Licensed under CC BY 4.0.",
    "cc-by-sa-notice": "Licensed under CC BY-SA 4.0.",
    "cc-by-nc-notice": "Licensed under CC BY-NC 4.0.",
    "cc-by-nd-notice": "Licensed under CC BY-ND 4.0.",
    "cc-by-nc-sa-notice": "Licensed under CC BY-NC-SA 4.0.",
    "unlicense-free": "This is free and unencumbered software released into the public domain.",
    "public-domain": "This work is released into the public domain.",
    "all-rights": "All rights reserved.",
}
# Licence, category and the ordered sentences that show it.
RULES = [
    ("Apache-2.0", "permissive", ["apache-notice"]),
    ("Apache-2.0", "permissive", ["apache-grant", "apache-comply", "apache-copy", "apache-as-is"]),
    ("BSD-2-Clause", "permissive", ["bsd-grant", "bsd-source", "bsd-binary"]),
    ("BSD-3-Clause", "permissive", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-names"]),
    ("CC-BY-4.0", "permissive", ["cc-by-notice"]),
    ("CC-BY-NC-4.0", "non-commercial", ["cc-by-nc-notice"]),
    ("CC-BY-NC-SA-4.0", "non-commercial", ["cc-by-nc-sa-notice"]),
    ("CC-BY-ND-4.0", "no-derivatives", ["cc-by-nd-notice"]),
    ("CC-BY-SA-4.0", "copyleft", ["cc-by-sa-notice"]),
    ("CC0-1.0", "permissive", ["cc0-notice"]),
    ("AGPL-3.0", "copyleft", ["agpl3-notice"]),
    ("GPL-2.0", "copyleft", ["gpl2-notice"]),
    ("GPL-2.0", "copyleft", ["gpl-free", "gpl2-terms", "gpl2-version"]),
    ("GPL-3.0", "copyleft", ["gpl3-notice"]),
    ("GPL-3.0", "copyleft", ["gpl-free", "gpl3-terms"]),
    ("ISC", "permissive", ["isc-grant", "isc-as-is"]),
    ("LGPL-3.0", "copyleft", ["lgpl3-notice"]),
    ("MIT", "permissive", ["mit-notice"]),
    ("MIT", "permissive", ["mit-licensed"]),
    ("MIT", "permissive", ["mit-grant", "mit-keep", "mit-as-is"]),
    ("MPL-2.0", "copyleft", ["mpl-notice"]),
    ("MPL-2.0", "copyleft", ["mpl-start"]),
    ("Proprietary", "restricted", ["all-rights"]),
    ("Unlicense", "permissive", ["unlicense-free"]),
    ("Public-Domain", "permissive", ["public-domain"]),
]
#: The worst of a document's categories counts.
SEVERITY = ["restricted", "non-commercial", "no-derivatives", "copyleft", "permissive"]
#: Every known sentence has one of these words, so a text without any of them has no known sentence, wrapped or not.
ANCHORS = ["licen", "permission", "software", "redistribut", "warrant", "copyright", "cc0", "domain", "reserved"]
GAP = 3
END = r"(?<=[.!?;:])\s+"
OTHER = r"[^a-z0-9]+"


def normal(sentence: str) -> str:
    return re.sub(OTHER, " ", sentence.lower()).strip()


#: By normalised sentence; where two are spelled alike after that, the first name counts.
KNOWN: dict[str, str] = {}
for _name, _sentence in SENTENCES.items():
    KNOWN.setdefault(normal(_sentence), _name)


def rule_pattern(identifiers: list[str], gap: int = GAP) -> str:
    """Regular expression for identifiers in order, on a sequence whose members end with a blank."""
    between = rf"(?:\S+ ){{0,{gap}}}"
    return r"(?:^| )" + between.join(rf"{KNOWN.get(normal(SENTENCES[x]), x)} " for x in identifiers)


#: On lines of normalised text: a known sentence over one line or more, any other line, or an empty line.
SENTENCE = "(?m)^(?:" + "|".join(
    k.replace(" ", "[ \\n]") for k in sorted(KNOWN, key=len, reverse=True)) + r")$|^[^\n]+$|^$"


def sentence_sequence(text: Column) -> Column:
    """One entry per sentence of ``text``: its identifier if it is a known one, ``-`` for another line, ``/`` where
    an empty line or the end of a sentence keeps lines apart."""
    lines = F.regexp_replace(F.regexp_replace(F.lower(text), END, "\n\n"), r"\r\n?", "\n")
    lines = F.regexp_replace(F.regexp_replace(lines, r"[^a-z0-9\n]+", " "), r" ?\n ?", "\n")
    lines = F.regexp_replace(F.trim(lines), r"(?m)^(?:rem|dnl) ", "")
    table = F.create_map(*[F.lit(x) for pair in KNOWN.items() for x in pair])

    def name(s: Column) -> Column:
        return F.when(s == "", "/").when(s.isin(list(KNOWN)), F.element_at(table, s)).otherwise("-")

    return F.transform(F.regexp_extract_all(lines, F.lit(SENTENCE), 0), lambda s: name(F.replace(s, F.lit("\n"), F.lit(" "))))


def scan_licences(documents: DataFrame, key: str = "doc_id", text: str = "text", gap: int = GAP) -> DataFrame:
    """(key, n_known, sentence_ids, licences, category): one row per document, in one pass without a shuffle."""
    low = F.lower(F.col(text))
    may = F.coalesce(F.lit(False) | _any([F.contains(low, F.lit(a)) for a in ANCHORS]), F.lit(False))
    seq = F.when(may, sentence_sequence(F.col(text))).otherwise(F.array().cast("array<string>"))
    found = documents.select(F.col(key), seq.alias("_seq"))
    known = F.filter("_seq", lambda s: ~s.isin("-", "/"))
    joined = F.concat(F.array_join("_seq", " "), F.lit(" "))
    # The lines of one other sentence count once.
    joined = F.replace(F.regexp_replace(joined, "(?<=- )- ", ""), F.lit("/ "), F.lit(""))
    names = F.array_compact(F.array(*[
        F.when(F.rlike(joined, F.lit(rule_pattern(ids, gap))), F.lit(name)) for name, _, ids in RULES]))
    found = found.select(key, F.size(known).cast("long").alias("n_known"),
                         F.array_join(F.array_distinct(known), ",").alias("sentence_ids"),
                         F.when(F.size(known) > 0, F.array_sort(F.array_distinct(names))).otherwise(
                             F.array().cast("array<string>")).alias("_names"))
    of = F.create_map(*[F.lit(x) for name, kind, _ in {r[0]: r for r in RULES}.values() for x in (name, kind)])
    kinds = F.transform("_names", lambda n: F.element_at(of, n))
    worst = F.coalesce(*[F.when(F.array_contains(kinds, s), F.lit(s)) for s in SEVERITY], F.lit("none"))
    return found.select(key, "n_known", "sentence_ids", F.array_join("_names", ",").alias("licences"),
                        worst.alias("category"))


def _any(tests: list[Column]) -> Column:
    out = tests[0]
    for t in tests[1:]:
        out = out | t
    return out
