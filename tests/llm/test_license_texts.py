"""Licence texts as they are published, wrapped and commented, and the scan against one that walks word by word."""

import random
import re

import duckdb
import pyarrow as pa

from tidegrid.llm import license_scan
from tidegrid.llm.license_scan import RULES, SENTENCES, TAG, oracle, scan_licences

MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY
CLAIM, DAMAGES OR OTHER LIABILITY."""
BSD2 = """Copyright (c) 2019, Somebody
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer.
"""
DISCLAIMER = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND
ANY WARRANTIES ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS
BE LIABLE FOR ANY DAMAGES."""
BSD3 = BSD2 + """
3. Neither the name of Google Inc. nor the names of its
   contributors may be used to endorse or promote products derived from it.
"""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions."""
GNU = """This program is free software; you can redistribute it and/or modify
it under the terms of the GNU {0}General Public License as published by
the Free Software Foundation; either version {1} of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of FITNESS.  See the
GNU {0}General Public License for more details.
"""
ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted."""

TEXTS = [
    (MIT, "MIT"),
    ("The MIT License (MIT)\n\nCopyright (c) 2020 A. Person\n\n" + MIT, "MIT"),
    (re.sub("(?m)^", " * ", MIT), "MIT"),
    (BSD2 + DISCLAIMER, "BSD-2-Clause"),
    (BSD3 + DISCLAIMER, "BSD-3-Clause"),
    (re.sub("(?m)^", "# ", APACHE), "Apache-2.0"),
    (APACHE, "Apache-2.0"),
    (GNU.format("", 2), "GPL-2.0-or-later"),
    (GNU.format("", 3), "GPL-3.0-or-later"),
    (GNU.format("Lesser ", "2.1"), "LGPL-2.1-or-later"),
    (GNU.format("Affero ", 3), "AGPL-3.0-or-later"),
    (ISC, "ISC"),
    ("CC BY-SA 4.0", "CC-BY-SA"),
    ("Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License", "CC-BY-NC-ND"),
    ("// SPDX-License-Identifier: Apache-2.0\nint main", "Apache-2.0"),
    ("SPDX-License-Identifier: GPL-2.0+", "GPL-2.0-or-later"),
    ("SPDX-License-Identifier: GPL-3.0-or-later", "GPL-3.0-or-later"),
    ("SPDX-License-Identifier: Apache-2.0 OR MIT", "Apache-2.0 MIT"),
    ("This work is licensed under the GNU General Public License, version 3.", "GPL-3.0"),
    ("under the terms of version 2 of the GNU General\nPublic License", "GPL-2.0"),
    ("Some words\nLicensed under CC BY-NC 4.0.\nReleased under the MIT License.", "CC-BY-NC MIT"),
    ("Copyright (c) 2020 A. All rights\nreserved.", "All-Rights-Reserved"),
    ("Ein Brief mit Lizenz, or mit copyright, sooner or later.", ""),
    ("We hope to see later versions of the domain.", ""),
]


def scanned(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r["doc_id"]: tuple(r)[1:] for r in scan_licences(docs, ["doc_id"]).collect()}
    return [rows[i] for i in range(len(texts))]


def in_duckdb(texts):
    con = duckdb.connect()
    con.register("documents", pa.table({"doc_id": list(range(len(texts))), "text": pa.array(texts, pa.string())}))
    rows = {r[0]: tuple(r[1:]) for r in con.execute(oracle()).fetchall()}
    return [rows[i] for i in range(len(texts))]


def test_published_texts_are_recognised(spark):
    got = scanned(spark, [t for t, _ in TEXTS])
    assert [g[1] for g in got] == [licences for _, licences in TEXTS]
    assert [g[2] for g in got] == [""] * len(TEXTS)
    assert in_duckdb([t for t, _ in TEXTS]) == got


def by_words(text):
    """Sentences word by word, rules identifier by identifier, without a joint pattern."""
    line = []
    for raw in re.split(r"\n[ \t\r]*\n|(?<=[.!?])[ \t\r\n]", text):
        words = re.sub(r"([0-9])\+", r"\1 or later", raw.lower())
        words = re.findall("[a-z0-9]+", words)
        s = " ".join(words)
        if TAG in s:
            s = re.sub(r" (or|and) (mit|isc|unlicense)\b", rf" {TAG} \2", s)
        if not re.search(license_scan.CUE, s):
            continue
        at, ids = 0, []
        while at < len(s):
            hits = []
            if at == 0 or s[at - 1] == " ":
                hits = [(name, m.end()) for name, p in SENTENCES if (m := re.match(f"({p})\\b", s[at:]))]
            if hits:
                ids.append(hits[0][0])
            at += hits[0][1] if hits else 1
        strong = [i for i in ids if i not in ("NOTICE", "LATER")]
        line += [i for i in ids if i != "NOTICE"] if strong else [i for i in ids if i == "NOTICE"]

    def taken(parts, at):
        if not parts:
            return at
        name, many = parts[0].rstrip("?*"), parts[0][-1]
        fits = at < len(line) and line[at] == name
        if fits and (end := taken(parts if many == "*" else parts[1:], at + 1)) is not None:
            return end
        return taken(parts[1:], at) if many in "?*" else None

    licences, left, at = [], [], 0
    while at < len(line):
        for name, parts in RULES:
            end = taken(parts, at)
            if end is not None and end > at:
                licences += [name] * (name not in licences)
                at = end
                break
        else:
            left.append(line[at])
            at += 1
    return " ".join(line), " ".join(licences), " ".join(left)


def test_scan_equals_one_that_walks_word_by_word(spark):
    random.seed(10)
    pieces = [p for t, _ in TEXTS for p in re.split(r"(?<=[.;:,])\s", t)] + ["word", "other words here", "\n\n", "!", "or later"]
    texts = [random.choice([" ", "\n", ". ", "\n\n"]).join(random.choices(pieces, k=random.randint(1, 12))) for _ in range(400)]
    got = scanned(spark, texts)
    assert got == [by_words(t) for t in texts]
    assert in_duckdb(texts) == got
    assert len({g[1] for g in got}) > 30
