"""Licence recognition by known sentences and rules over their order.

A text is cut into sentences at full stops, exclamation and question marks before a blank, and at blank
lines; a single line break is a blank, so wrapped and commented licences read as unwrapped ones. A
sentence is normalised to lower-case letters and digits with one blank between words. The known licence
sentences that stand in it give their identifiers, from left to right; where several begin at one word, the
first of the table counts. The identifiers of a text, in order, are then matched against licence rules from
left to right: a rule is a row of identifiers that follow each other, some of which may be absent or repeated,
and where several rules fit, the first of the table uses its identifiers up. Others are reported as left.

A mere mention of terms counts only in sentences that name nothing else, and "or later" only where something is named.
Only texts with a cue word are cut at all. Everything is DataFrame or SQL functions on one row, so
there is no shuffle.

Defined results: a null or empty text, and one without known sentences, has empty results;
a sentence that stands in a text several times is identified each time, a licence is named once, where
it occurs first; repeated rows are scanned each; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.llm.storage import spare

#: Stems without which no known sentence can stand in a text; each lies inside one word, or spans any blanks.
CUE = (
    r"licen[cs]|copyright|reserved|warrant|permission|redistribut|liable|domain|endorse|spdx|gpl|bsd|apache"
    r"|creative|attribution|cc0|cc[^a-z0-9]+by"
)
SENTENCE_END = r"[.!?]+[ \t\r\n]+|[.!?]+$|\n[ \t\r]*\n[ \t\r\n]*"
TAG = "spdx license identifier"
#: Licences whose short names are common words: they count behind the tag only, also as later parts of its expression.
SHORT = "mit|isc|unlicense"


def gnu(kind: str, short: str, number: str) -> str:
    """Ways to name one version of a licence of the GNU family."""
    name = rf"gnu {kind}general public license"
    published = r"( as published by the free software foundation)?( either)?"
    return rf"{name}( {short})?{published} (version |v)?{number}|(gnu )?{short} ?(version |v)?{number}|version {number} of the {name}"


#: What known licence sentences say, as patterns over whole words of normalised sentences.
SENTENCES: list[tuple[str, str]] = [
    ("GPLREST", r"distributed in the hope that it will be useful"),
    ("GPLREST", r"see the gnu (affero |lesser |library )?general public license for more details"),
    ("GPLREST", r"received? a copy of the gnu (affero |lesser |library )?general public license"),
    ("AGPL3", gnu("affero ", "agpl", "3( 0)?")),
    ("LGPL21", gnu("(lesser |library )", "lgpl", "2( [01])?")),
    ("LGPL3", gnu("lesser ", "lgpl", "3( 0)?")),
    ("GPL2", gnu("", "gpl", "2( 0)?")),
    ("GPL3", gnu("", "gpl", "3( 0)?")),
    ("AGPLANY", r"gnu affero general public license|gnu agpl"),
    ("LGPLANY", r"gnu (lesser|library) general public license|gnu lgpl"),
    ("GPLANY", r"gnu general public license|gnu gpl"),
    ("LATER", r"or (at your option )?any later version|or later( versions?)?"),
    ("APACHE2", r"apache (software )?(license )?(version |v)?2 0"),
    ("APACHEDIST", r"unless required by applicable law or agreed to in writing software distributed under the license"),
    ("APACHECOND", r"you may not use this file except in compliance with the license"),
    ("MPL2", r"mozilla public license (version |v )?2 0|mpl 2 0"),
    ("EPL2", r"eclipse public license (version |v )?2 0|epl 2 0"),
    ("MITNAME", rf"mit licen[cs]ed?( mit)?|{TAG} mit"),
    ("MITPERM", r"permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("MITNOTICE", r"the above copyright notice and this permission notice( including the next paragraph)? shall be included"),
    ("ISCNAME", rf"isc license|{TAG} isc"),
    ("ISCPERM", r"permission to use copy modify and (or )?distribute this software for any purpose with or without fee"),
    ("BSDNAME3", r"(3|three) clause bsd( license)?|(new|revised|modified) bsd license|bsd (3|three) clause( new or revised)?( license)?"),
    ("BSDNAME2", r"(2|two) clause bsd( license)?|simplified bsd license|bsd (2|two) clause( simplified)?( license)?"),
    ("BSDPERM", r"redistribution and use in source and binary forms with or without modification are permitted"),
    ("BSDSOURCE", r"redistributions? of source code must retain the (above )?copyright notice"),
    ("BSDBINARY", r"redistributions? in binary form must reproduce the (above )?copyright notice"),
    ("BSDENDORSE", r"be used to endorse or promote products"),
    ("ASIS", r"(software|work|program|library|code) is provided (by .{0,200}?)?as is"),
    ("NOLIABLE", r"in no event (shall|will) .{0,300}?be liable"),
    ("CC0", r"cc0( 1 0)?( universal)?|creative commons zero"),
    ("CCBYNCND", r"cc by nc nd|(creative commons )?attribution non ?commercial no ?deriv(ative)?s?"),
    ("CCBYNCSA", r"cc by nc sa|(creative commons )?attribution non ?commercial share ?alike"),
    ("CCBYNC", r"cc by nc|(creative commons )?attribution non ?commercial"),
    ("CCBYSA", r"cc by sa|(creative commons )?attribution share ?alike"),
    ("CCBYND", r"cc by nd|(creative commons )?attribution no ?deriv(ative)?s?"),
    ("CCBY", r"cc by|creative commons attribution"),
    ("UNLICENSE", rf"free and unencumbered software released into the public domain|the unlicense|{TAG} unlicense"),
    ("PUBLIC", r"(released|placed|dedicated) (in|into|to) the public domain"),
    ("RIGHTS", r"all rights reserved"),
    ("COPYRIGHT", r"copyright (c )?[0-9]{4}"),
    ("NOTICE", r"licen[cs]ed under|under the terms of|see the ([a-z]+ ){0,4}license"),
]

#: Licences by the identifiers that follow each other in them; ``?`` and ``*`` as in patterns.
RULES: list[tuple[str, list[str]]] = [
    ("BSD-3-Clause", ["BSDNAME3?", "COPYRIGHT*", "RIGHTS?", "BSDPERM", "BSDSOURCE", "BSDBINARY", "BSDENDORSE", "ASIS?", "NOLIABLE?"]),
    ("BSD-2-Clause", ["BSDNAME2?", "COPYRIGHT*", "RIGHTS?", "BSDPERM", "BSDSOURCE", "BSDBINARY", "ASIS?", "NOLIABLE?"]),
    ("MIT", ["MITNAME*", "COPYRIGHT*", "RIGHTS?", "MITPERM", "MITNOTICE", "ASIS?", "NOLIABLE?"]),
    ("ISC", ["ISCNAME?", "COPYRIGHT*", "RIGHTS?", "ISCPERM", "ASIS?", "NOLIABLE?"]),
    ("Apache-2.0", ["APACHE2", "APACHECOND", "APACHE2?", "APACHEDIST", "NOTICE?"]),
    ("Apache-2.0", ["APACHE2", "APACHEDIST", "NOTICE?"]),
    ("AGPL-3.0-or-later", ["AGPL3", "LATER", "GPLREST*"]),
    ("LGPL-3.0-or-later", ["LGPL3", "LATER", "GPLREST*"]),
    ("LGPL-2.1-or-later", ["LGPL21", "LATER", "GPLREST*"]),
    ("GPL-3.0-or-later", ["GPL3", "LATER", "GPLREST*"]),
    ("GPL-2.0-or-later", ["GPL2", "LATER", "GPLREST*"]),
    ("AGPL-3.0", ["AGPL3", "GPLREST*"]),
    ("LGPL-3.0", ["LGPL3", "GPLREST*"]),
    ("LGPL-2.1", ["LGPL21", "GPLREST*"]),
    ("GPL-3.0", ["GPL3", "GPLREST*"]),
    ("GPL-2.0", ["GPL2", "GPLREST*"]),
    ("AGPL", ["AGPLANY", "GPLREST*"]),
    ("LGPL", ["LGPLANY", "GPLREST*"]),
    ("GPL", ["GPLANY", "GPLREST*"]),
    ("Apache-2.0", ["APACHE2", "APACHECOND?"]),
    ("MPL-2.0", ["MPL2"]),
    ("EPL-2.0", ["EPL2"]),
    ("MIT", ["MITNAME"]),
    ("ISC", ["ISCNAME"]),
    ("BSD-3-Clause", ["BSDNAME3"]),
    ("BSD-2-Clause", ["BSDNAME2"]),
    ("CC0-1.0", ["CC0"]),
    ("CC-BY-NC-ND", ["CCBYNCND"]),
    ("CC-BY-NC-SA", ["CCBYNCSA"]),
    ("CC-BY-NC", ["CCBYNC"]),
    ("CC-BY-SA", ["CCBYSA"]),
    ("CC-BY-ND", ["CCBYND"]),
    ("CC-BY", ["CCBY"]),
    ("Unlicense", ["UNLICENSE"]),
    ("Public-Domain", ["PUBLIC"]),
    ("All-Rights-Reserved", ["COPYRIGHT*", "RIGHTS"]),
]


def sequence(parts: list[str]) -> str:
    """The pattern of a rule over identifiers in angle brackets."""
    return "".join(f"(<{p.rstrip('?*')}>){p[len(p.rstrip('?*')) :]}" for p in parts)


SEQUENCES = [(name, sequence(parts)) for name, parts in RULES]


def anywhere(known: list[tuple[str, str]], edge: str = "") -> str:
    """One pattern for the whole table; its alternatives are tried in order."""
    return f"{edge}({'|'.join(p for _, p in known)}){edge}"


def names_of(text: Column, known: list[tuple[str, str]], edge: str = "") -> Column:
    """Names of what the table finds in a text, from left to right, nothing twice in one place."""

    def name_of(match: Column) -> Column:
        found = F.lit(None).cast("string")
        for name, pattern in reversed(known):
            found = F.when(match.rlike(f"^({pattern})$"), name).otherwise(found)
        return found

    return F.transform(F.regexp_extract_all(text, F.lit(anywhere(known, edge)), F.lit(0)), name_of)


def normalised(sentence: Column) -> Column:
    """Words of a sentence; ``2.0+`` is an "or later", and every part of a tag's expression gets the tag."""
    later = F.regexp_replace(F.lower(sentence), r"([0-9])\+", "$1 or later")
    words = F.trim(F.regexp_replace(later, r"[^a-z0-9]+", " "))
    spread = F.regexp_replace(words, rf" (or|and) ({SHORT})\b", f" {TAG} $2")
    return F.when(words.contains(TAG), spread).otherwise(words)


def identified(sentence: Column) -> Column:
    """The identifiers of a normalised sentence, as far as they count."""
    ids = names_of(sentence, SENTENCES, r"\b")
    strong = F.exists(ids, lambda i: ~i.isin("NOTICE", "LATER"))
    return F.filter(ids, lambda i: F.when(strong, i != "NOTICE").otherwise(i == "NOTICE"))


def scan_licences(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """The columns ``keep`` with ``sentence_ids, licences, left_ids`` for every row, parted by blanks in order.

    Columns of these names are replaced.
    """
    keep = [c for c in keep if c.lower() not in ("sentence_ids", "licences", "left_ids")]
    scan_ids, scan_row = spare("scan_ids", keep), spare("scan_row", keep)
    raw = F.coalesce(F.col(text), F.lit(""))
    sentences = F.filter(F.transform(F.split(raw, SENTENCE_END), normalised), lambda s: s.rlike(CUE))
    none = F.array().cast("array<string>")
    told = docs.select(
        *keep, F.when(F.lower(raw).rlike(CUE), F.flatten(F.transform(sentences, identified))).otherwise(none).alias(scan_ids)
    )
    told = told.withColumn(scan_row, F.concat_ws("", F.transform(scan_ids, lambda i: F.concat(F.lit("<"), i, F.lit(">")))))
    # most texts have no known sentence: their row stays empty and no rule looks at it
    row = F.col(scan_row)
    left = F.trim(F.regexp_replace(F.regexp_replace(row, anywhere(SEQUENCES), ""), "[<>]+", " "))
    return told.select(
        *keep,
        F.concat_ws(" ", scan_ids).alias("sentence_ids"),
        F.when(row != "", F.concat_ws(" ", F.array_distinct(names_of(row, SEQUENCES)))).otherwise("").alias("licences"),
        F.when(row != "", left).otherwise("").alias("left_ids"),
    )


def oracle() -> str:
    """The same scan of ``documents`` in DuckDB's SQL."""

    def quoted(value: str) -> str:
        return "'" + value.replace("'", "''") + "'"

    def named(text: str, known: list[tuple[str, str]], edge: str = "") -> str:
        case = " ".join(f"WHEN regexp_matches(m, {quoted(f'^({p})$')}) THEN {quoted(n)}" for n, p in known)
        return f"list_transform(regexp_extract_all({text}, {quoted(anywhere(known, edge))}, 0), lambda m: CASE {case} END)"

    spread = quoted(rf" (or|and) ({SHORT})\b")
    return (
        "WITH parts AS (SELECT doc_id, generate_subscripts(p, 1) AS pos, unnest(p) AS raw FROM"
        f" (SELECT doc_id, regexp_split_to_array(text, {quoted(SENTENCE_END)}) AS p FROM documents"
        f" WHERE regexp_matches(lower(text), {quoted(CUE)}))),"
        r" words AS (SELECT doc_id, pos, trim(regexp_replace(regexp_replace(lower(raw), '([0-9])\+', '\1 or later', 'g'),"
        " '[^a-z0-9]+', ' ', 'g')) AS w FROM parts),"
        f" plain AS (SELECT doc_id, pos, CASE WHEN contains(w, '{TAG}') THEN regexp_replace(w, {spread}, ' {TAG} \\2', 'g')"
        " ELSE w END AS s FROM words),"
        rf" found AS (SELECT doc_id, pos, {named('s', SENTENCES, chr(92) + 'b')} AS l FROM plain WHERE regexp_matches(s, {quoted(CUE)})),"
        " counted AS (SELECT doc_id, pos, CASE WHEN len(list_filter(l, lambda i: i NOT IN ('NOTICE', 'LATER'))) > 0"
        " THEN list_filter(l, lambda i: i <> 'NOTICE') ELSE list_filter(l, lambda i: i = 'NOTICE') END AS l FROM found),"
        " lists AS (SELECT doc_id, flatten(list(l ORDER BY pos)) AS l FROM counted GROUP BY doc_id HAVING sum(len(l)) > 0),"
        " ids AS (SELECT d.doc_id, coalesce(array_to_string(l, ' '), '') AS sentence_ids,"
        " coalesce('<' || array_to_string(l, '><') || '>', '') AS line FROM documents d LEFT JOIN lists USING (doc_id)),"
        f" ruled AS (SELECT *, {named('line', SEQUENCES)} AS hits FROM ids)"
        " SELECT doc_id, sentence_ids,"
        " coalesce(array_to_string(list_filter(hits, lambda x, i: list_position(hits, x) = i), ' '), '') AS licences,"
        f" trim(regexp_replace(regexp_replace(line, {quoted(anywhere(SEQUENCES))}, '', 'g'), '[<>]+', ' ', 'g')) AS left_ids FROM ruled"
    )
