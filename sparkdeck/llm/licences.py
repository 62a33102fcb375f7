"""Licences by sentence rules.

A text is split into sentences (at . ; : ! ? before white space or the end, and at empty lines, but not between
the "v." of a version and its digit: "v. 2.0" and "v.2.0" are read as "v 2.0"). A sentence
is normalised: everything but ASCII letters, digits, "." and "+" becomes one space, lower case, and a "." that does
not stand between two letters or digits goes too, whatever sign, tag or blank is beside it. A known
sentence is a phrase that stands in it, on word borders, and gives its identifier; a sentence may give
several, in the order in which they begin. Phrases are normalised like texts. The identifiers of a document, in order, are then matched with
`RULES`, first rule first: where a rule's sequence of identifiers stands, they are taken out and the
licence is noted. Identifiers that no rule takes stay behind.

Odd cases: a null or empty text has no identifiers; a sentence that stands in a text twice counts twice. Whole
texts are read. It is a column expression: no row moves and other columns are not touched.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: phrases of published licence texts and notices, normalised as above
SENTENCES = {
    "agpl_notice": "gnu affero general public license",
    "apache_as_is": "distributed on an as is basis without warranties or conditions of any kind",
    "apache_notice": "licensed under the apache license version 2.0",
    "apache_obtain": "you may obtain a copy of the license at",
    "apache_use": "you may not use this file except in compliance with the license",
    "artistic_notice": "the artistic license 2.0",
    "boost_grant": "obtaining a copy of the software and accompanying documentation covered by this license",
    "boost_notice": "distributed under the boost software license version 1.0",
    "bsd2_notice": "released under the bsd 2 clause license",
    "bsd3_notice": "released under the bsd 3 clause license",
    "bsd_binary": "redistributions in binary form must reproduce the above copyright notice",
    "bsd_disclaimer": "provided by the copyright holders and contributors as is",
    "bsd_endorse": "may be used to endorse or promote products derived from this software",
    "bsd_redistribute": "redistribution and use in source and binary forms",
    "bsd_source": "redistributions of source code must retain the above copyright notice",
    "cc0_notice": "cc0 1.0 universal",
    "ccby_notice": "licensed under cc by 4.0",
    "ccbync_notice": "licensed under cc by nc 4.0",
    "ccbysa_notice": "licensed under cc by sa 4.0",
    "ccbynd_notice": "licensed under cc by nd 4.0",
    "epl_notice": "eclipse public license",
    "gpl_copy": "you should have received a copy of the gnu general public license",
    "gpl_free": "you can redistribute it and or modify it under the terms of the gnu general public license",
    "gpl_hope": "in the hope that it will be useful but without any warranty",
    "gpl2_notice": "licensed under the gnu general public license version 2",
    "gpl3_notice": "licensed under the gnu general public license version 3",
    "gpl2_version": "either version 2 of the license or",
    "gpl3_version": "either version 3 of the license or",
    "isc_grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
    "isc_disclaimer": "the author disclaims all warranties with regard to this software",
    "isc_notice": "provided that the above copyright notice and this permission notice appear in all copies",
    "lgpl_notice": "gnu lesser general public license",
    "mit_grant": "permission is hereby granted free of charge to any person obtaining a copy of this software",
    "mit_notice": "this permission notice shall be included in all copies or substantial portions of the software",
    "mit_disclaimer": "the software is provided as is without warranty of any kind",
    "mit_release": "released under the mit license",
    "mpl_notice": "subject to the terms of the mozilla public license v. 2.0",
    "reserved": "all rights reserved",
    "unlicense_domain": "this is free and unencumbered software released into the public domain",
    "wtfpl_notice": "do what the fuck you want to public license",
    "zlib_alter": "altered source versions must be plainly marked as such",
    "zlib_origin": "the origin of this software must not be misrepresented",
}

#: licence and the sequence of identifiers that shows it; longer sequences of a family stand first
RULES = [
    ("BSD-3-Clause", "bsd_redistribute bsd_source bsd_binary bsd_endorse bsd_disclaimer"),
    ("BSD-2-Clause", "bsd_redistribute bsd_source bsd_binary bsd_disclaimer"),
    ("BSD-3-Clause", "bsd_redistribute bsd_source bsd_binary bsd_endorse"),
    ("BSD-2-Clause", "bsd_redistribute bsd_source bsd_binary"),
    ("BSD-3-Clause", "bsd3_notice"),
    ("BSD-2-Clause", "bsd2_notice"),
    ("Apache-2.0", "apache_notice apache_use apache_obtain apache_as_is"),
    ("Apache-2.0", "apache_notice apache_use apache_obtain"),
    ("Apache-2.0", "apache_notice"),
    ("BSL-1.0", "boost_grant mit_disclaimer"),
    ("BSL-1.0", "boost_notice"),
    ("MIT", "mit_grant mit_notice mit_disclaimer"),
    ("MIT", "mit_grant mit_notice"),
    ("MIT", "mit_release"),
    ("GPL-3.0-or-later", "gpl_free gpl3_version gpl_hope gpl_copy"),
    ("GPL-2.0-or-later", "gpl_free gpl2_version gpl_hope gpl_copy"),
    ("GPL-3.0-or-later", "gpl_free gpl3_version"),
    ("GPL-2.0-or-later", "gpl_free gpl2_version"),
    ("GPL-3.0", "gpl3_notice"),
    ("GPL-2.0", "gpl2_notice"),
    ("AGPL", "agpl_notice"),
    ("LGPL", "lgpl_notice"),
    ("ISC", "isc_grant isc_notice isc_disclaimer"),
    ("ISC", "isc_grant isc_notice"),
    ("MPL-2.0", "mpl_notice"),
    ("EPL", "epl_notice"),
    ("Artistic-2.0", "artistic_notice"),
    ("Zlib", "zlib_origin zlib_alter"),
    ("CC-BY-NC-4.0", "ccbync_notice"),
    ("CC-BY-SA-4.0", "ccbysa_notice"),
    ("CC-BY-ND-4.0", "ccbynd_notice"),
    ("CC-BY-4.0", "ccby_notice"),
    ("CC0-1.0", "cc0_notice"),
    ("Unlicense", "unlicense_domain"),
    ("WTFPL", "wtfpl_notice"),
    ("All-rights-reserved", "reserved"),
]

BLANK = "[ \\t\\n\\x0b\\f\\r]"
BREAK = f"[.;:!?]+(?:{BLANK}+|$)|\\n{BLANK}*\\n"
OTHER = "[^A-Za-z0-9.+]+"
#: blanks with one line break at most; possessive, so a long run is read once
VERSION = "(?<![A-Za-z0-9.+])([vV])\\.[ \\t\\x0b\\f\\r]*+\\n?+[ \\t\\x0b\\f\\r]*+(?=[0-9])"
LOOSE = "(?<![a-z0-9])\\.+|\\.+(?![a-z0-9])"


def sequence(rule: str) -> str:
    return "".join(f"<{name}>" for name in rule.split())


class Scanner:
    """Finds identifiers and licences of one text at a time."""

    def __init__(self, sentences: dict[str, str], rules: list[tuple[str, str]]):
        self.cut, self.other, self.loose, self.version = map(re.compile, (BREAK, OTHER, LOOSE, VERSION))
        phrases = {name: self.normal(self.version.sub(r"\1 ", phrase)) for name, phrase in sentences.items()}
        self.phrases = sorted((name, f" {phrase} ") for name, phrase in phrases.items())
        self.rules = [(f"[{licence}]", sequence(rule)) for licence, rule in rules]
        # a word out of each phrase; a text with none of these words has no known sentence
        self.words = re.compile("|".join(sorted({re.escape(max(p.split(), key=len)) for p in phrases.values()})))

    def normal(self, sentence: str) -> str:
        return " ".join(self.loose.sub(" ", self.other.sub(" ", sentence).lower()).split())

    def identifiers(self, text: str | None) -> list[str]:
        if not text or not self.words.search(text.lower()):
            return []
        out = []
        for sentence in self.cut.split(self.version.sub(r"\1 ", text)):
            plain = f" {self.normal(sentence)} "
            found = [(plain.find(p), name) for name, p in self.phrases if p in plain]
            out += [name for _, name in sorted(found)]
        return out

    def licences(self, names: list[str]) -> tuple[list[str], list[str]]:
        """Licences in the order in which they stand, and identifiers left over."""
        text = "".join(f"<{name}>" for name in names)
        for mark, rule in self.rules:
            text = text.replace(rule, mark)
        return re.findall(r"\[([^\]]+)\]", text), re.findall(r"<([^>]+)>", text)


def scan(text: Column, sentences: dict[str, str] = SENTENCES, rules: list[tuple[str, str]] = RULES) -> Column:
    """Column struct(sentences, licences, rest) of arrays for a text column."""

    @F.pandas_udf("sentences array<string>, licences array<string>, rest array<string>")
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scanner = Scanner(sentences, rules)
        for batch in texts:
            names = [scanner.identifiers(t) for t in batch]
            found = [scanner.licences(n) for n in names]
            yield pd.DataFrame({"sentences": names, "licences": [a for a, _ in found], "rest": [b for _, b in found]})

    return run(text)


def scanned(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, sentences, licences, rest) for every row."""
    return docs.select(F.col(id_col), scan(F.col(text_col).cast("string")).alias("found")).select(id_col, "found.*")


def check_sql(table: str = "documents") -> str:
    """SQL with the same result as the registered query: the same steps, without looking around."""
    known = ", ".join(f"('{name}', '{phrase}')" for name, phrase in Scanner(SENTENCES, RULES).phrases)
    marked = "names"
    for licence, rule in RULES:
        marked = f"replace({marked}, '{sequence(rule)}', '[{licence}]')"
    blank = BLANK.replace("\\f", "\\x0c")
    cut = BREAK.replace(BLANK, blank)
    space = "[ \\t\\x0b\\x0c\\r]*"
    version = f"(^|[^A-Za-z0-9.+])([vV])\\.{space}\\n?{space}([0-9])"
    inner = "([a-z0-9])[.]([a-z0-9])"
    return f"""
        WITH known(name, phrase) AS (VALUES {known}),
        texts AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '{version}', '\\1\\2 \\3', 'g') AS text FROM {table}),
        parts AS (SELECT doc_id, regexp_split_to_array(text, '{cut}') AS parts FROM texts),
        one AS (SELECT doc_id, unnest(parts) AS part, generate_subscripts(parts, 1) AS place FROM parts),
        words AS (SELECT doc_id, place, lower(regexp_replace(part, '{OTHER}', ' ', 'g')) AS part FROM one),
        -- a full stop between two letters or digits is kept as a comma until the others are gone; twice, as it may share a letter
        kept AS (
            SELECT doc_id, place, regexp_replace(regexp_replace(part, '{inner}', '\\1,\\2', 'g'), '{inner}', '\\1,\\2', 'g') AS part FROM words),
        plain AS (
            SELECT doc_id, place, ' ' || trim(regexp_replace(replace(replace(part, '.', ' '), ',', '.'), ' +', ' ', 'g')) || ' ' AS part FROM kept),
        hits AS (
            SELECT doc_id, place, name, instr(part, phrase) AS begins FROM plain JOIN known ON contains(part, phrase)),
        named AS (
            SELECT doc_id, count(*) AS n, string_agg('<' || name || '>', '' ORDER BY place, begins, name) AS names FROM hits GROUP BY doc_id),
        marked AS (SELECT doc_id, n, names, {marked} AS marked FROM named)
        SELECT d.doc_id, coalesce(n, 0) AS n_sentences, coalesce(names, '') AS sentences,
               coalesce(array_to_string(regexp_extract_all(marked, '\\[([^\\]]+)\\]', 1), ','), '') AS licences,
               coalesce(array_to_string(regexp_extract_all(marked, '<([^>]+)>', 1), ','), '') AS rest
        FROM {table} d LEFT JOIN marked m ON d.doc_id = m.doc_id"""
