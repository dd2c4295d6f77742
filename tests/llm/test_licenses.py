"""Licence rules: notices, wrapped texts, order, and the DuckDB twin on awkward rows."""

import textwrap

import duckdb

from tests.llm.cases import docs, empty
from thawline.llm import op3_license as M

MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License. You may obtain a copy of the License at
    http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""


def wrapped(text, width=60):
    return "\n".join("\n".join(textwrap.wrap(p, width)) for p in text.split("\n"))


ROWS = [
    (1, MIT), (2, wrapped(MIT)), (3, "Some words. " + wrapped(APACHE, 72) + " And more."), (4, "Released under the MIT License."),
    (5, "x y z\nLicensed under CC BY-NC 4.0.\nq\nLicensed under CC BY-NC 4.0."), (6, "\n".join(reversed(MIT.split("\n")))),
    (7, "This work is licensed under the GNU General Public License, version 3. Licensed under CC BY 4.0!"),
    (8, MIT.replace("\n", "\nA sentence in between.\n")), (9, "licensed without software"), (10, None), (11, ""), (12, "software " * 4000),
    (13, "Released under the MIT License."), (13, "Released under the MIT License."), (13, "Released under the MIT License. Twice."),
    (None, "Released under the MIT License."),
]


def test_rules(spark):
    df, _ = docs(spark, ROWS)
    got = sorted(((r.doc_id, r.rule_id, r.n_matches) for r in M.license_scan(df).collect()), key=str)
    want = [(1, "mit-text", 1), (2, "mit-text", 1), (3, "apache-2.0-header", 1), (4, "mit-notice", 1), (5, "cc-by-nc-4.0-notice", 2),
            (7, "gpl-3.0-notice", 1), (7, "cc-by-4.0-notice", 1), (8, "mit-text", 1), (13, "mit-notice", 1), (13, "mit-notice", 1), (None, "mit-notice", 1)]
    assert got == sorted(want, key=str)


def test_equals_twin(spark):
    df, _ = docs(spark, ROWS)
    documents = df.select("doc_id", "text").toPandas()
    con = duckdb.connect()
    con.register("rows", documents)
    con.execute("CREATE VIEW documents AS SELECT CAST(doc_id AS BIGINT) AS doc_id, text FROM rows")
    cols = ["doc_id", "rule_id", "license", "n_matches", "first_unit"]
    want = con.execute(f"SELECT {', '.join(cols)} FROM ({M.license_sql()})").fetchall()
    assert sorted(map(tuple, M.license_scan(df).select(*cols).collect()), key=str) == sorted(want, key=str)


def test_every_wrap_width_equals_twin(spark):
    """First lines of one word, and sentences of many lines."""
    rows = [(w, wrapped(APACHE, w)) for w in range(20, 101)] + [(1000 + w, wrapped(MIT, w)) for w in range(20, 101)]
    df, _ = docs(spark, rows)
    got = [tuple(r) for r in M.license_scan(df).select("doc_id", "rule_id", "n_matches", "first_unit").collect()]
    assert {d for d, r, n, _ in got if r == "apache-2.0-header" and n == 1} == set(range(20, 101))
    assert {d - 1000 for d, r, n, _ in got if r == "mit-text" and n == 1} == set(range(20, 101))
    con = duckdb.connect()
    con.register("documents", df.select("doc_id", "text").toPandas())
    want = con.execute(f"SELECT doc_id, rule_id, n_matches, first_unit FROM ({M.license_sql()})").fetchall()
    assert sorted(got) == sorted(want)


GNU = """This {w} is free software{c} you can redistribute it and/or modify it under the terms of the GNU {k}General Public License as published by the Free Software Foundation, either version {v} of the License, or (at your option) any later version.
This {w} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY."""
BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
* Neither the name of {h} nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.
THIS SOFTWARE IS PROVIDED BY {by} "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED."""
ISC = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted{p}.\nTHE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS."
TEXTS = [
    ("gpl-2.0-or-later-header", GNU.format(w="program", c=";", k="", v="2")), ("gpl-3.0-or-later-header", GNU.format(w="program", c=":", k="", v="3")),
    ("lgpl-2.1-or-later-header", GNU.format(w="library", c=";", k="Lesser ", v="2.1")), ("lgpl-3.0-or-later-program", GNU.format(w="program", c=":", k="Lesser ", v="3")),
    ("agpl-3.0-or-later-header", GNU.format(w="program", c=":", k="Affero ", v="3")),
    ("gpl-2.0-only-header", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation."),
    ("mpl-2.0-notice", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("isc-text", ISC.format(p=", provided that the above copyright notice and this permission notice appear in all copies")), ("0bsd-text", ISC.format(p="")),
    ("zlib-text", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.\nPermission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:"),
    ("unlicense-text", "This is free and unencumbered software released into the public domain.\nAnyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    ("bsl-1.0-notice", "Distributed under the Boost Software License, Version 1.0."), ("spdx-lgpl-2.1-or-later", "// SPDX-License-Identifier: LGPL-2.1-or-later\nint x;"),
    ("bsd-3-clause-text", BSD.format(h="the copyright holder", by="THE COPYRIGHT HOLDERS AND CONTRIBUTORS")),
    ("bsd-3-clause-text", BSD.format(h="Example Institute of Soil, Water and Air", by="THE REGENTS AND CONTRIBUTORS")), ("bsd-3-clause-text", BSD.format(h="Acme", by="ACME")),
]


def test_licences_and_holders_at_every_width_equal_twin(spark):
    """Each text gives its own rule alone, whatever the wrapping; a holder's name may have up to 16 words."""
    rows = [(1000 * w + i, wrapped(t, w)) for w in (20, 33, 47, 60, 72, 80, 100) for i, (_, t) in enumerate(TEXTS)]
    rows.append((7, BSD.format(h=" ".join("abcdefghijklmnopq"), by="ACME")))
    df, _ = docs(spark, rows)
    cols = ["doc_id", "rule_id", "license", "n_matches", "first_unit"]
    got = [tuple(r) for r in M.license_scan(df).select(*cols).collect()]
    assert {(d, r) for d, r, *_ in got} == {(d, TEXTS[d % 1000][0]) for d, _ in rows if d != 7} | {(7, "bsd-2-clause-text")}
    con = duckdb.connect()
    con.register("documents", df.select("doc_id", "text").toPandas())
    assert sorted(got) == sorted(con.execute(f"SELECT {', '.join(cols)} FROM ({M.license_sql()})").fetchall())


def test_every_sentence_has_a_keyword_and_no_python_runs(spark):
    assert all(any(k in s for k in M.KEYWORDS) for s in M.SENTENCES.values())
    assert all(s in M.SENTENCES for _, _, seq in M.RULES for s in seq)
    plan = M.license_scan(docs(spark, ROWS)[0])._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_empty_table(spark):
    assert M.license_scan(empty(spark)).count() == 0
