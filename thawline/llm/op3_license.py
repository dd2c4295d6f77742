"""License scans by sentence rules, in DataFrame operations only.

A text is cut into units (lines, and sentences within lines) and normalised: lower case,
everything but a-z and 0-9 one space.  A known licence sentence is a run of units, as many as it
has words at most, so sentences wrapped at any width are found too; runs are formed only where a
unit is a known sentence or the beginning of one.  In sentences that name the copyright holder any
name of up to ``MOST_HOLDER_WORDS`` words stands for the one in the table.  The units are mapped to the identifiers of known
sentences by an equi-join with the sentence table; a document's identifiers in text order are
then matched against the ordered rules: a rule is found where its identifiers follow each other.
Other sentences in between carry no identifier and do not disturb a rule.

Only documents with one of ``KEYWORDS`` are cut up; the words are chosen so that every known
sentence holds at least one, so none is lost.  The sentence and rule tables are constants of this
module (their size is that of this file), hence broadcast.  Nothing but the found identifiers is
shuffled.

Defined cases: null or empty text: no row; rows that repeat both doc_id and text count once, rows
of one doc_id with other texts each give their own rows; a null doc_id is reported as null.  At
one place the longest sentence counts.  Empty table: empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Sentences of public licence texts and notices, in normalised form.
SENTENCES = {
    "apache2-notice": "licensed under the apache license version 2 0",
    "apache2-comply": "you may not use this file except in compliance with the license",
    "apache2-copy": "you may obtain a copy of the license at",
    "apache2-unless": (
        "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an"
        " as is basis without warranties or conditions of any kind either express or implied"
    ),
    "apache2-see": "see the license for the specific language governing permissions and limitations under the license",
    "mit-notice": "released under the mit license",
    "mit-grant": (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation"
        " files the software to deal in the software without restriction including without limitation the rights to use copy modify"
        " merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is"
        " furnished to do so subject to the following conditions"
    ),
    "mit-include": (
        "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"
    ),
    "mit-warranty": (
        "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties"
        " of merchantability fitness for a particular purpose and noninfringement"
    ),
    "gpl3-notice": "this work is licensed under the gnu general public license version 3",
    "gpl-free": "this program is free software",
    "gpl3-redistribute": (
        "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software"
        " foundation either version 3 of the license or at your option any later version"
    ),
    "gpl2-redistribute": (
        "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software"
        " foundation either version 2 of the license or at your option any later version"
    ),
    "gpl2-only": (
        "you can redistribute it and or modify it under the terms of the gnu general public license version 2 as published by the"
        " free software foundation"
    ),
    "lgpl-free": "this library is free software",
    "lgpl21-redistribute": (
        "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free"
        " software foundation either version 2 1 of the license or at your option any later version"
    ),
    "lgpl3-redistribute": (
        "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free"
        " software foundation either version 3 of the license or at your option any later version"
    ),
    "lgpl-hope": "this library is distributed in the hope that it will be useful but without any warranty",
    "agpl3-redistribute": (
        "you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free"
        " software foundation either version 3 of the license or at your option any later version"
    ),
    "mpl2-subject": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "isc-grant": (
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided"
        " that the above copyright notice and this permission notice appear in all copies"
    ),
    "0bsd-grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
    "isc-disclaims": (
        "the software is provided as is and the author disclaims all warranties with regard to this software including all implied"
        " warranties of merchantability and fitness"
    ),
    "zlib-as-is": "this software is provided as is without any express or implied warranty",
    "zlib-liable": "in no event will the authors be held liable for any damages arising from the use of this software",
    "zlib-grant": (
        "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and"
        " redistribute it freely subject to the following restrictions"
    ),
    "unlicense-free": "this is free and unencumbered software released into the public domain",
    "unlicense-anyone": (
        "anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled"
        " binary for any purpose commercial or non commercial and by any means"
    ),
    "boost-notice": "distributed under the boost software license version 1 0",
    "gpl-hope": "this program is distributed in the hope that it will be useful but without any warranty",
    "cc-by-nc-4-notice": "licensed under cc by nc 4 0",
    "cc-by-4-notice": "licensed under cc by 4 0",
    "bsd-permitted": (
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following"
        " conditions are met"
    ),
    "bsd-endorse": (
        "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived"
        " from this software without specific prior written permission"
    ),
    "bsd-warranty": (
        "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but"
        " not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed"
    ),
}

# Rule, licence, ordered sentences.
RULES = [
    ("apache-2.0-notice", "Apache-2.0", ["apache2-notice"]),
    ("apache-2.0-header", "Apache-2.0", ["apache2-comply", "apache2-copy", "apache2-unless", "apache2-see"]),
    ("mit-notice", "MIT", ["mit-notice"]),
    ("mit-text", "MIT", ["mit-grant", "mit-include", "mit-warranty"]),
    ("gpl-3.0-notice", "GPL-3.0", ["gpl3-notice"]),
    ("gpl-3.0-or-later-header", "GPL-3.0-or-later", ["gpl-free", "gpl3-redistribute", "gpl-hope"]),
    ("gpl-2.0-or-later-header", "GPL-2.0-or-later", ["gpl-free", "gpl2-redistribute", "gpl-hope"]),
    ("gpl-2.0-only-header", "GPL-2.0-only", ["gpl-free", "gpl2-only"]),
    ("lgpl-2.1-or-later-header", "LGPL-2.1-or-later", ["lgpl-free", "lgpl21-redistribute", "lgpl-hope"]),
    ("lgpl-3.0-or-later-header", "LGPL-3.0-or-later", ["lgpl-free", "lgpl3-redistribute", "lgpl-hope"]),
    ("lgpl-3.0-or-later-program", "LGPL-3.0-or-later", ["gpl-free", "lgpl3-redistribute", "gpl-hope"]),
    ("agpl-3.0-or-later-header", "AGPL-3.0-or-later", ["gpl-free", "agpl3-redistribute", "gpl-hope"]),
    ("mpl-2.0-notice", "MPL-2.0", ["mpl2-subject"]),
    ("isc-text", "ISC", ["isc-grant", "isc-disclaims"]),
    ("0bsd-text", "0BSD", ["0bsd-grant", "isc-disclaims"]),
    ("zlib-text", "Zlib", ["zlib-as-is", "zlib-liable", "zlib-grant"]),
    ("unlicense-text", "Unlicense", ["unlicense-free", "unlicense-anyone"]),
    ("bsl-1.0-notice", "BSL-1.0", ["boost-notice"]),
    ("cc-by-nc-4.0-notice", "CC-BY-NC-4.0", ["cc-by-nc-4-notice"]),
    ("cc-by-4.0-notice", "CC-BY-4.0", ["cc-by-4-notice"]),
    ("bsd-2-clause-text", "BSD-2-Clause", ["bsd-permitted", "bsd-warranty"]),
    ("bsd-3-clause-text", "BSD-3-Clause", ["bsd-permitted", "bsd-endorse", "bsd-warranty"]),
]

# One-line identifiers: a sentence and a rule for each licence named above that has one.
for _name in sorted({name for _, name, _ in RULES} - {"GPL-3.0"}):
    SENTENCES[f"spdx-{_name.lower()}"] = "spdx license identifier " + _name.lower().replace("-", " ").replace(".", " ")
    RULES.append((f"spdx-{_name.lower()}", _name, [f"spdx-{_name.lower()}"]))

# Sentences that name the holder: opening, words after the name (either of two), and the name that the table has.
_HOLDERS = [
    ("neither the name of ", " nor the names of (?:its|their) contributors may be used ", "the copyright holder", " nor the names of its contributors may be used "),
    ("this software is provided by ", " as is and any express ", "the copyright holders and contributors", " as is and any express "),
]
MOST_HOLDER_WORDS = 16


def _cover(sentences: list[str]) -> list[str]:
    """Few long words such that every sentence holds at least one (greedy cover)."""
    left, out = [set(s.split()) for s in sentences], []
    while left:
        words = sorted({w for s in left for w in s if len(w) >= 6})
        best = max(words, key=lambda w: (sum(w in s for s in left), len(w), w))
        out.append(best)
        left = [s for s in left if best not in s]
    return sorted(out)


KEYWORDS = _cover(list(SENTENCES.values()))
# a unit has a word at least, so no sentence spans more units than it has words
_MOST_UNITS = max(len(s.split()) for s in SENTENCES.values()) + MOST_HOLDER_WORDS
_OPENINGS = sorted({" ".join(s.split()[: n + 1]) for s in SENTENCES.values() for n in range(len(s.split()))})
# (pattern, text in its place): any holder's name of up to MOST_HOLDER_WORDS words becomes the one in the table
_NAMED = [(f"^{o}[a-z0-9]+(?: [a-z0-9]+){{0,{MOST_HOLDER_WORDS - 1}}}?{after}", o + name + plain) for o, after, name, plain in _HOLDERS]


def _units(text):
    """Normalised non-empty units of a text, in order."""
    cut = F.split(F.regexp_replace(F.lower(text), r"([.!?:;])[ \t\r\n]+", "$1\n"), "\n")
    return F.filter(F.transform(cut, lambda u: F.trim(F.regexp_replace(u, "[^a-z0-9]+", " "))), lambda u: u != "")


def sentence_ids(docs: DataFrame) -> DataFrame:
    """(doc_id, tie, ids, units): identifiers of known sentences and their first units, in text order."""
    spark = docs.sparkSession
    known = spark.sql("SELECT * FROM VALUES " + ", ".join(f"('{k}', '{v}')" for k, v in SENTENCES.items()) + " AS known(sentence_id, body)")
    text = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text"))
    text = text.where(F.lower("text").rlike("|".join(KEYWORDS)))
    units = text.select("doc_id", F.xxhash64("text").alias("tie"), _units(F.col("text")).alias("units"))
    starts = F.filter(F.sequence(F.lit(1), F.size("units")), lambda i: F.element_at("units", i).isin(_OPENINGS) | F.element_at("units", i).rlike(f"^(?:{'|'.join(h[0] for h in _HOLDERS)})"))
    places = units.where(F.size("units") > 0).select("doc_id", "tie", "units", F.explode(starts).alias("unit"))
    runs = places.select(
        "doc_id", "tie", "unit",
        F.explode(F.transform(
            F.sequence(F.lit(1), F.least(F.lit(_MOST_UNITS), F.size("units") - F.col("unit") + 1)),
            lambda n: F.struct(n.alias("n"), F.array_join(F.slice("units", F.col("unit"), n), " ").alias("body")),
        )).alias("run"),
    )
    body = F.col("run.body")
    for pattern, named in _NAMED:
        body = F.regexp_replace(body, pattern, named)
    found = runs.select("doc_id", "tie", "unit", "run.n", body.alias("body")).join(F.broadcast(known), "body")
    longest = found.groupBy("doc_id", "tie", "unit").agg(F.max_by("sentence_id", "n").alias("sentence_id"))
    ordered = longest.groupBy("doc_id", "tie").agg(F.sort_array(F.collect_list(F.struct("unit", "sentence_id"))).alias("found"))
    return ordered.select("doc_id", "tie", F.col("found.sentence_id").alias("ids"), F.col("found.unit").alias("units"))


def license_scan(docs: DataFrame) -> DataFrame:
    """(doc_id, rule_id, license, n_matches, first_unit): licence rules found in each document."""
    rules = F.array(*(F.struct(F.lit(r).alias("rule_id"), F.lit(name).alias("license"), F.array(*map(F.lit, seq)).alias("seq")) for r, name, seq in RULES))
    tried = sentence_ids(docs).select("doc_id", "ids", "units", F.explode(rules).alias("rule"))
    size = F.size("rule.seq")
    tried = tried.where(F.size("ids") >= size)
    at = F.filter(F.sequence(F.lit(1), F.size("ids") - size + 1), lambda p: F.slice("ids", p, size) == F.col("rule.seq"))
    hits = tried.select("doc_id", "rule.rule_id", "rule.license", "units", at.alias("at")).where(F.size("at") > 0)
    return hits.select(
        "doc_id", "rule_id", "license", F.size("at").cast("bigint").alias("n_matches"), F.element_at("units", F.element_at("at", 1)).cast("bigint").alias("first_unit")
    )


def license_sql() -> str:
    """DuckDB twin of ``license_scan`` over ``documents``."""
    sentences = ", ".join(f"('{k}', '{v}')" for k, v in SENTENCES.items())
    rules = ", ".join(f"('{r}', '{n}', [{', '.join(repr(s) for s in seq)}])" for r, n, seq in RULES)
    body = "array_to_string(units[unit:unit + n - 1], ' ')"
    for pattern, named in _NAMED:
        body = f"regexp_replace({body}, '{pattern}', '{named}')"
    return f"""
WITH known(sentence_id, body) AS (VALUES {sentences}),
rules(rule_id, license, seq) AS (VALUES {rules}),
cut AS (
  SELECT DISTINCT doc_id, text,
    list_filter(list_transform(string_split(regexp_replace(lower(text), '([.!?:;])[ \\t\\r\\n]+', '\\1' || chr(10), 'g'), chr(10)),
      lambda u: trim(regexp_replace(u, '[^a-z0-9]+', ' ', 'g'))), lambda u: u <> '') AS units
  FROM documents WHERE text IS NOT NULL),
places AS (SELECT doc_id, text, units, unnest(range(1, len(units) + 1)) AS unit FROM cut),
opened AS (SELECT * FROM places WHERE split_part(units[unit], ' ', 1) IN (SELECT split_part(body, ' ', 1) FROM known)),
runs AS (SELECT doc_id, text, unit, n, {body} AS body
  FROM opened, (SELECT unnest(range(1, {_MOST_UNITS + 1})) AS n) WHERE unit + n - 1 <= len(units)),
longest AS (SELECT doc_id, text, unit, arg_max(sentence_id, n) AS sentence_id FROM runs JOIN known USING (body) GROUP BY ALL),
ordered AS (SELECT doc_id, text, list(sentence_id ORDER BY unit) AS ids, list(unit ORDER BY unit) AS units FROM longest GROUP BY ALL),
hits AS (SELECT doc_id, rule_id, license, units,
    list_filter(range(1, len(ids) - len(seq) + 2), lambda p: ids[p:p + len(seq) - 1] = seq) AS hit_at
  FROM ordered, rules WHERE len(ids) >= len(seq))
SELECT doc_id, rule_id, license, CAST(len(hit_at) AS BIGINT) AS n_matches, CAST(units[hit_at[1]] AS BIGINT) AS first_unit
FROM hits WHERE len(hit_at) > 0
"""
