"""Operator 2: licence scan by sentence rules (DataFrame functions only).

A text is cut into pieces at line ends and at signs that blanks follow, and
the pieces are normalised (lower case, runs of anything but a-z and 0-9 become
one blank).  A known licence sentence is a run of whole pieces that together
read like it, so it may hold a ``: `` or be wrapped over lines (also behind
comment signs, and over one blank line); the longest counts.  List marks at
the head of a line are pieces of their own.  The identifiers found, in order, form a sequence; ordered
rules are matched against it, longer rules first, and a matched run of
identifiers is used up.  The identifiers of SPDX lines (expressions of AND, OR
and WITH) come after these.  "All rights reserved." never breaks a run, and
names a licence only where nothing else does.

Scale: one scan, no shuffle, nothing broadcast but the rule table below.
Texts without any of the rule table's key words skip the sentence work; every
known sentence holds one (asserted by a test), so nothing is lost.

Defined results: null and empty texts have no sentences and no licences;
repeated rows get a row each; other columns are ignored; a licence that
matches more than once is listed once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

# Sentences of well-known public licences, as they are quoted.
SENTENCES = {
    "apache-ref": "Licensed under the Apache License, Version 2.0.",
    "apache-hdr-1": 'Licensed under the Apache License, Version 2.0 (the "License");',
    "apache-hdr-2": "you may not use this file except in compliance with the License.",
    "apache-hdr-3": "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "mit-ref": "Released under the MIT License.",
    "mit-ref-2": "Licensed under the MIT License.",
    "mit-ref-3": "This project is licensed under the MIT License.",
    "mit-title": "The MIT License (MIT)",
    "mit-notice": "The above copyright notice and this permission notice shall be included in all copies or "
                  "substantial portions of the Software.",
    "as-is": 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT '
             "NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND "
             "NONINFRINGEMENT.",
    "bsd-ref": "Use of this source code is governed by a BSD-style license.",
    "bsd-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted "
                 "provided that the following conditions are met:",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions "
                  "and the following disclaimer.",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of "
                  "conditions and the following disclaimer in the documentation and/or other materials provided "
                  "with the distribution.",
    "gpl3-ref": "This work is licensed under the GNU General Public License, version 3.",
    "gpl2-ref": "This work is licensed under the GNU General Public License, version 2.",
    "gpl-free": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                "General Public License as published by the Free Software Foundation, either version 3 of the "
                "License, or (at your option) any later version.",
    "gpl-hope": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;",
    "gpl-fit": "without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    "cc-by": "Licensed under CC BY 4.0.",
    "cc-by-sa": "Licensed under CC BY-SA 4.0.",
    "cc-by-nc": "Licensed under CC BY-NC 4.0.",
    "cc0": "To the extent possible under law, the author has waived all copyright and related rights to this work.",
    "spdx-mit": "SPDX-License-Identifier: MIT",
    "spdx-apache": "SPDX-License-Identifier: Apache-2.0",
    "spdx-gpl3": "SPDX-License-Identifier: GPL-3.0-or-later",
    "all-rights": "All rights reserved.",
}
# A licence is an ordered run of those sentences.
RULES = [
    ("Apache-2.0", ("apache-hdr-1", "apache-hdr-2", "apache-hdr-3")),
    ("GPL-3.0-or-later", ("gpl-free", "gpl-hope", "gpl-fit")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("MIT", ("mit-title", "mit-notice", "as-is")),
    ("MIT", ("mit-notice", "as-is")),
    ("Apache-2.0", ("apache-hdr-1", "apache-hdr-2")),
    ("Apache-2.0", ("apache-ref",)),
    ("MIT", ("mit-ref",)), ("MIT", ("mit-ref-2",)), ("MIT", ("mit-ref-3",)), ("MIT", ("spdx-mit",)),
    ("MIT", ("mit-title",)),
    ("BSD", ("bsd-ref",)),
    ("GPL-3.0-only", ("gpl3-ref",)), ("GPL-2.0-only", ("gpl2-ref",)),
    ("GPL-3.0-or-later", ("gpl-free",)), ("GPL-3.0-or-later", ("spdx-gpl3",)),
    ("CC-BY-4.0", ("cc-by",)), ("CC-BY-SA-4.0", ("cc-by-sa",)), ("CC-BY-NC-4.0", ("cc-by-nc",)),
    ("CC0-1.0", ("cc0",)),
    ("Apache-2.0", ("spdx-apache",)),
]
# Sentences and rules that OP2_SQL does not have, as they hold
# signs that end a piece or are wrapped as a rule.  ``*`` stands for 1 to 12
# words.
MORE_SENTENCES = {
    "gpl2-free": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
                 "General Public License as published by the Free Software Foundation; either version 2 of the "
                 "License, or (at your option) any later version.",
    "lgpl-free": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU "
                 "Lesser General Public License as published by the Free Software Foundation; either version 2.1 of "
                 "the License, or (at your option) any later version.",
    "agpl-free": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                 "Affero General Public License as published by the Free Software Foundation, either version 3 of the "
                 "License, or (at your option) any later version.",
    "mpl-form": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without "
                 "fee is hereby granted, provided that the above copyright notice and this permission notice appear "
                 "in all copies.",
    "unlicense": "This is free and unencumbered software released into the public domain.",
    "bsl-grant": "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the "
                 'software and accompanying documentation covered by this license (the "Software") to use, reproduce, '
                 "display, distribute, execute, and transmit the Software, and to prepare derivative works of the "
                 "Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the "
                 "following:",
    "epl-terms": "This program and the accompanying materials are made available under the terms of the Eclipse "
                 "Public License 2.0",
    "bsd-endorse": "Neither the name of * nor the names of its contributors may be used to endorse or promote products "
                   "derived from this software without specific prior written permission.",
}
MORE_RULES = [
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse")),
    ("GPL-2.0-or-later", ("gpl2-free",)), ("LGPL-2.1-or-later", ("lgpl-free",)),
    ("AGPL-3.0-or-later", ("agpl-free",)), ("MPL-2.0", ("mpl-form",)), ("ISC", ("isc-grant",)),
    ("Unlicense", ("unlicense",)), ("BSL-1.0", ("bsl-grant",)), ("EPL-2.0", ("epl-terms",)),
]
#: A licence of its own only where nothing else is found; it stands in the head
#: of many other licences and never breaks a rule.
RESERVED, RESERVED_NAME = "all-rights", "Proprietary"
#: The expression of an SPDX line: identifiers joined by AND, OR and WITH.
SPDX = (r"(?i)SPDX-License-Identifier:[ \t]*\(*([A-Z0-9.+-]+(?:\)*[ \t]+(?:AND|OR|WITH)[ \t]+\(*[A-Z0-9.+-]+)*)")
#: Every known sentence holds one of these inside a word, which the signs and
#: blanks around it do not change.
KEY_WORDS = ("licen[sc]e", "warranty", "copyright", "redistribut", "reserved", "endorse", "unencumbered")
#: Pieces end at a line end, or at a sign that blanks follow.
PIECE_END = r"\r\n?|(?<=[.!?;:])[ \t]+(?=[^ \t\r\n])"
#: A list mark such as ``a)`` or ``(1)`` at the head of a line, in lower case.
LIST_MARK = r"(?m)^([^a-z0-9\r\n]*(?:[0-9]{1,2}|[a-z]|[ivx]{2,4})\))[ \t]+"
#: What may stand between two words of a known sentence.
BETWEEN = r"(?: |\n{1,2})"


def normal(text: str) -> str:
    """The normalised form of a sentence (the rule table's side)."""
    return " ".join("".join(c if c.isascii() and c.isalnum() else " " for c in text.lower()).split())


def known_runs() -> str:
    """A pattern of the known sentences as runs of whole pieces, in a text of
    normalised pieces with a line end before and after each; longer first."""
    words = [normal(s).split() for s in SENTENCES.values()]
    runs = [(len(w), BETWEEN.join(w)) for w in words]
    for s in MORE_SENTENCES.values():
        if "*" not in s:
            words = normal(s).split()
            runs.append((len(words), BETWEEN.join(words)))
            continue
        left, right = (normal(x).split() for x in s.split("*"))
        any_words = f"(?:{BETWEEN}[a-z0-9]+){{1,12}}?"
        runs.append((len(left + right), BETWEEN.join(left) + any_words + BETWEEN + BETWEEN.join(right)))
    return r"(?<=\n)(?:" + "|".join(r for _, r in sorted(runs, key=lambda x: -x[0])) + r")(?=\n)"


def scan_licenses(docs: DataFrame, text_col: str = "text", ids_col: str = "sentence_ids",
                  licenses_col: str = "licenses") -> DataFrame:
    """``docs`` with the identifiers of known sentences in order (array) and
    the licences found (array; own columns of those names are replaced)."""
    whole = SENTENCES | {i: s for i, s in MORE_SENTENCES.items() if "*" not in s}
    known = F.create_map(*(F.lit(x) for i, s in whole.items() for x in (normal(s), i)))
    open_ends = [(i, *map(normal, s.split("*"))) for i, s in MORE_SENTENCES.items() if "*" in s]

    def to_id(run):
        s = F.regexp_replace(run, r"\n+", " ")
        return F.coalesce(F.try_element_at(known, s),
                          *(F.when(s.startswith(x) & s.endswith(y), F.lit(i)) for i, x, y in open_ends))

    text = F.coalesce(F.col(text_col), F.lit(""))
    none = F.array().cast("array<string>")
    pieces = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.lower(text), LIST_MARK, "$1\n"), PIECE_END, "\n"), r"[^a-z0-9\n]+", " ")
    pieces = F.concat(F.lit("\n"), F.regexp_replace(pieces, r" ?\n ?| $|^ ", "\n"), F.lit("\n"))
    ids = F.when(text.rlike("(?i)" + "|".join(KEY_WORDS)),
                 F.transform(F.regexp_extract_all(pieces, F.lit(known_runs()), F.lit(0)), to_id)).otherwise(none)
    rules = F.array(*(F.struct(F.lit(n).alias("name"), F.lit("," + ",,".join(r) + ",").alias("run"))
                      for n, r in sorted(RULES + MORE_RULES, key=lambda x: -len(x[1]))))

    def use(acc, rule):
        hit = acc["left"].contains(rule["run"])
        return F.struct(F.replace(acc["left"], rule["run"], F.lit("#")).alias("left"),
                        F.when(hit, F.array_append(acc["names"], rule["name"])).otherwise(acc["names"]).alias("names"))

    # every identifier stands between commas of its own: neighbours share none
    sequence = F.concat(F.lit(","), F.array_join(F.array_remove("_ids", RESERVED), ",,"), F.lit(","))
    folded = F.aggregate(rules, F.struct(sequence.alias("left"), none.alias("names")), use,
                         lambda acc: F.array_distinct(acc["names"]))
    # a licence of an SPDX expression keeps its exception
    lines = F.when(F.instr(F.lower(text), "spdx-license-identifier") > 0, F.regexp_extract_all(text, F.lit(SPDX), F.lit(1)))
    parts = F.flatten(F.transform(F.coalesce(lines, none), lambda x: F.split(F.regexp_replace(x, r"[()]", " "), r"(?i)[ \t]+(?:AND|OR)[ \t]+")))
    spdx = F.transform(parts, lambda x: F.regexp_replace(F.regexp_replace(F.trim(x), r"(?i)[ \t]+WITH[ \t]+", " WITH "), r"\.+$", ""))
    out = docs.withColumn("_ids", ids).withColumn("_spdx", spdx)
    named = F.array_distinct(F.concat(F.when(F.size("_ids") > 0, folded).otherwise(none), F.col("_spdx")))
    reserved = F.when(F.array_contains("_ids", RESERVED), F.array(F.lit(RESERVED_NAME))).otherwise(none)
    return (out.withColumn("_names", named)
            .select(*(c for c in docs.columns if c not in (ids_col, licenses_col)), F.col("_ids").alias(ids_col),
                    F.when(F.size("_names") > 0, F.col("_names")).otherwise(reserved).alias(licenses_col)))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences of all ``documents``."""
    found = scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.size("sentence_ids").cast("long").alias("n_sentences"),
                        F.array_join("sentence_ids", ",").alias("sentence_ids"),
                        F.array_join("licenses", ",").alias("licenses"))


def _sql() -> str:
    q = lambda s: "'" + s.replace("'", "''") + "'"
    known = ", ".join(f"({q(normal(s))}, {q(i)})" for i, s in SENTENCES.items())
    steps, prev = [], "joined"
    order = sorted(RULES, key=lambda x: -len(x[1]))
    for k, (_, run) in enumerate(order):
        r = q("," + ",,".join(run) + ",")
        steps.append(f"r{k} AS (SELECT *, contains(left_{k}, {r}) AS hit_{k}, "
                     f"replace(left_{k}, {r}, '#') AS left_{k + 1} FROM {prev})")
        prev = f"r{k}"
    names = list(dict.fromkeys(n for n, _ in order))
    first = ", ".join("CASE WHEN " + " OR ".join(f"hit_{k}" for k, (m, _) in enumerate(order) if m == n)
                      + f" THEN {q(n)} END" for n in names)
    # a licence stands where its first rule that hit stands
    rank = ", ".join("coalesce(" + ", ".join(f"CASE WHEN hit_{k} THEN {k} END" for k, (m, _) in enumerate(order)
                                              if m == n) + ", 99)" for n in names)
    return f"""
WITH known(s, i) AS (VALUES {known}),
cut AS (
  SELECT doc_id, unnest(regexp_split_to_array(regexp_replace(coalesce(text, ''), '([.!?;:])[ \\t]+', '\\1' || chr(10),
         'g'), '[\\n\\r]+')) AS s, generate_subscripts(regexp_split_to_array(regexp_replace(coalesce(text, ''),
         '([.!?;:])[ \\t]+', '\\1' || chr(10), 'g'), '[\\n\\r]+'), 1) AS k FROM documents),
ids AS (
  SELECT doc_id, count(*) AS n, string_agg(i, ',' ORDER BY k) AS ids
  FROM cut JOIN known ON trim(regexp_replace(lower(cut.s), '[^a-z0-9]+', ' ', 'g')) = known.s GROUP BY doc_id),
joined AS (
  SELECT doc_id, coalesce(n, 0) AS n, coalesce(ids, '') AS ids,
         CASE WHEN n > 0 THEN ',' || array_to_string(list_filter(string_split(ids, ','), lambda x: x <> '{RESERVED}'), ',,') || ','
              ELSE '' END AS left_0,
         list_transform(flatten(list_transform(regexp_extract_all(coalesce(text, ''), {q(SPDX)}, 1),
           lambda x: string_split_regex(regexp_replace(x, '[()]', ' ', 'g'), '(?i)[ \\t]+(?:AND|OR)[ \\t]+'))),
           lambda x: regexp_replace(regexp_replace(trim(x), '(?i)[ \\t]+WITH[ \\t]+', ' WITH ', 'g'), '\\.+$', '')) AS spdx
  FROM documents LEFT JOIN ids USING (doc_id)),
{', '.join(steps)},
named AS (
  SELECT doc_id, n, ids, spdx,
         list_transform(list_sort(list_filter(list_zip([{rank}], [{first}]), lambda x: x[2] IS NOT NULL)), lambda x: x[2]) AS names
  FROM {prev}),
every AS (
  SELECT doc_id, n, ids, list_concat(names, list_filter(spdx, lambda x, i: list_position(spdx, x) = i AND NOT list_contains(names, x))) AS names
  FROM named)
SELECT doc_id, n AS n_sentences, ids AS sentence_ids,
       CASE WHEN len(names) > 0 THEN array_to_string(names, ',')
            WHEN list_contains(string_split(ids, ','), '{RESERVED}') THEN '{RESERVED_NAME}' ELSE '' END AS licenses
FROM every
"""


OP2_SQL = _sql()
