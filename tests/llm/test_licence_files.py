"""Licence files as they are published, short notes and SPDX lines."""

from pathlib import Path

import duckdb
import pytest

from tessella.llm import licences

public_tokenizers = pytest.importorskip("public_tokenizers")
THIRD = (Path(public_tokenizers.path("byte_bpe_50k.json")).parent / "LICENSES.txt").read_text()
MIT = THIRD[THIRD.index("MIT License") : THIRD.index("word_bpe_49k.json:")]
BSD = """Copyright (c) 2001, A. Person

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice,
   this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
ADVERT = """3. All advertising materials mentioning features or use of this software
   must display the following acknowledgement: This product includes software
   developed by the organization.
"""
ENDORSE = """3. Neither the name of the copyright holder nor the names of its contributors
   may be used to endorse or promote products derived from this software
   without specific prior written permission.
"""
ZLIB = """This software is provided 'as-is', without any express or implied warranty.

Permission is granted to anyone to use this software for any purpose,
including commercial applications, and to alter it and redistribute it
freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not
   claim that you wrote the original software."""
GPL2 = """This program is free software; you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation; either version 2 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."""
NOTES = {
    "This project is licensed under the MIT License - see the LICENSE file for details.": "MIT",
    "// SPDX-License-Identifier: MIT OR Apache-2.0": "Apache-2.0,MIT",
    "# SPDX-License-Identifier: GPL-2.0-only": "GPL-2.0",
    "# SPDX-License-Identifier: LGPL-2.1-or-later": "LGPL-2.1",
    "/* SPDX-License-Identifier: BSD-3-Clause */": "BSD-3-Clause",
    "The code is released under the GNU Affero General Public License v3.0.": "AGPL-3.0",
    "Our tool is distributed under the terms of the GNU Lesser General Public License version 3.": "LGPL-3.0",
    "Released under GPLv3.": "GPL-3.0",
    "It is available under the GNU General Public License.": "GPL",
    "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.": "CC-BY-NC-SA-4.0",
    "Dual-licensed under MIT License or Apache License, Version 2.0.": "Apache-2.0,MIT",
    "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.": "MPL-2.0",
    "This is free and unencumbered software released into the public domain.": "Unlicense",
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.": "ISC",
    "This project is not licensed under the MIT License.": "",
    "She is licensed to teach under the Apache.": "",
    "Released under the BSD license.": "BSD",
    "Released under the 2-clause BSD licence.": "BSD-2-Clause",
    "It is distributed under the terms of the GNU Lesser General Public License v2.1.": "LGPL-2.1",
    "It is distributed under the GNU Library General Public License version 2.": "LGPL-2.0",
    "Photo published under CC BY-SA 3.0.": "CC-BY-SA-3.0",
    "# SPDX-License-Identifier: MIT-0": "MIT-0",
    "Fonts are licensed under the SIL Open Font License, Version 1.1.": "OFL-1.1",
    "Made available under the terms of the Eclipse Public License 2.0.": "EPL-2.0",
    "Licenses of the MIT licensed kind are common.": "",
    "GNU AFFERO GENERAL PUBLIC LICENSE\n   Version 3, 19 November 2007\n\n Copyright (C) 2007": "AGPL-3.0",
    GPL2: "GPL-2.0",
    BSD: "BSD-2-Clause",
    BSD + ENDORSE: "BSD-3-Clause",
    BSD + ADVERT + ENDORSE.replace("3.", "4."): "BSD-4-Clause",
    "".join(f"# {line}\n" for line in (BSD + ENDORSE).split("\n")): "BSD-3-Clause",
    (BSD + ENDORSE).replace("\n", "\r\n"): "BSD-3-Clause",
    ZLIB: "Zlib",
}


def found(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    return [r.licence for r in licences.scan(rows).orderBy("i").collect()]


def test_whole_files(spark):
    mit = MIT
    commented = "".join(f" * {line}".rstrip() + "\n" for line in mit.split("\n"))
    got = found(spark, [mit, mit.replace("\n", "\r\n"), "/*\n" + commented + " */\n", THIRD])
    assert [x.licences for x in got[:3]] == ["MIT"] * 3 and {x.verdict for x in got} == {"permissive"}
    assert got[0].sentences == "mit_title mit_permission mit_notice as_is"
    assert "MIT" in got[3].licences.split(",") and "Apache-2.0" in got[3].licences.split(",")


def test_notes(spark):
    assert dict(zip(NOTES, [x.licences for x in found(spark, NOTES)], strict=True)) == NOTES


def test_sql_says_the_same(spark):
    """Spark's and the SQL's regular expressions differ; whole licences, notes, marks and line ends of both kinds don't tell them apart."""
    texts = [None, "", "\n", "licensed", THIRD, MIT, *NOTES, *(x.upper() for x in NOTES), *(x.replace("\n", "\r\n") for x in NOTES), *(f" * {x}" for x in NOTES), " ".join(NOTES), "\n\n".join(NOTES)]
    texts += [f"- {x}\n(a) {y}\n\n" for x, y in zip(NOTES, reversed(NOTES), strict=True)]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", list(enumerate(texts)))
    want = con.execute(f"SELECT sentences, licences, verdict, n_sentences FROM ({licences.scan_sql()}) ORDER BY doc_id").fetchall()
    assert [tuple(x) for x in found(spark, texts)] == want
    assert sum(1 for x in want if x[3]) > len(texts) // 2


# --- headers as they stand in source files, expectations written by hand ---

_CLAUSES = [
    "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
]
_GRANT = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
_RIGHTS = "Copyright (c) 2015, Jane Doe. All rights reserved."
_WRAPS = {"plain": ("", "", ""), "c": ("/*\n", " * ", "\n */"), "hash": ("", "# ", ""), "slash": ("", "// ", ""), "dash": ("", "-- ", "")}


def _header(clauses, bullet, wrap):
    marks = {"number": "1234", "letter": "abcd"}.get(bullet)
    lines = [_RIGHTS, "", *_fold(_GRANT)]
    for i, clause in enumerate(clauses):
        mark = {"number": f"{i + 1}. ", "letter": f"{'abcd'[i]}) ", "none": ""}.get(bullet, f"{bullet} ") if marks or bullet != "none" else ""
        lines += ["", *_fold(mark + clause)] if bullet == "none" else _fold(mark + clause)
    head, each, tail = _WRAPS[wrap]
    return head + "\n".join((each + line).rstrip() for line in lines) + tail


def _fold(text, width=70):
    out = [""]
    for word in text.split(" "):
        if len(out[-1]) + len(word) > width:
            out.append("  " + word)
        else:
            out[-1] += (" " if out[-1].strip() else "") + word
    return out


@pytest.mark.parametrize("wrap", list(_WRAPS))
def test_bsd_headers_with_reserved_rights(spark, wrap):
    rows = [(n, bullet, _header(_CLAUSES[:n], bullet, wrap)) for n in (2, 3) for bullet in ("number", "letter", "none", "*", "-", "+", "o", "•")]
    found = {(r.n, r.bullet): (r.licence.licences, r.licence.verdict) for r in licences.scan(spark.createDataFrame(rows, "n int, bullet string, text string")).collect()}
    assert found == {(n, b): (f"BSD-{n}-Clause", "permissive") for n, b, _ in rows}


LINES = {
    "This file is MIT licensed.": ("MIT", "permissive"),
    "This file is not MIT licensed.": ("", "none"),
    "The parser is Apache-2.0 licensed, see NOTICE.": ("Apache-2.0", "permissive"),
    "Licensed under the MIT License (see LICENSE). All rights reserved.": ("MIT", "permissive"),
    "Copyright 2019 Somebody. All rights reserved.": ("proprietary", "restricted"),
    "SPDX-License-Identifier: ISC\n// All rights reserved.": ("ISC", "permissive"),
}


def test_notes_by_hand(spark):
    rows = list(enumerate(LINES))
    got = {r.text: (r.licence.licences, r.licence.verdict) for r in licences.scan(spark.createDataFrame(rows, "i int, text string")).collect()}
    assert got == LINES


def test_headers_against_sql(spark):
    texts = [_header(_CLAUSES[:n], b, w) for n in (2, 3) for b in ("number", "none", "*", "o") for w in _WRAPS] + list(LINES)
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", list(enumerate(texts)))
    want = sorted(con.execute(licences.scan_sql()).fetchall())
    got = licences.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).select("doc_id", "licence.*")
    assert sorted(tuple(r) for r in got.collect()) == want
