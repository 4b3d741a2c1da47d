from textsift.llm import licenses as L


def test_ordered_rules(spark):
    grant, kept, warranty = [k for k, v in L.SENTENCES.items() if v in ("mit_grant", "mit_notice_kept", "mit_warranty")]
    rows = {1: "Foo.\nReleased under the MIT License.\nbar", 2: f"MIT License\n{grant.upper()}.\nxx\n{kept}; {warranty}!", 3: f"{warranty}.\n{kept}.\n{grant}.",
            4: None, 5: "", 6: "Licensed under CC BY-NC 4.0.", 7: "licensed  under the Apache License, Version 2.0.\nLicensed under CC BY-NC 4.0.\n" * 2,
            8: "This is not licensed under the MIT License.", 9: "word " * 50000 + "\nReleased under the MIT License."}
    df = spark.createDataFrame([(i, t, "clash") for i, t in rows.items()], "doc_id long, text string, sequence string")
    got = {r.doc_id: r for r in L.scan_licenses(df).collect()}
    assert {i: r.licenses for i, r in got.items()} == {1: "MIT", 2: "MIT", 3: "", 4: "", 5: "", 6: "CC-BY-NC-4.0", 7: "Apache-2.0,CC-BY-NC-4.0", 8: "", 9: "MIT"}
    assert got[2].rules == "mit_text" and got[2].sequence == "mit_title mit_grant mit_notice_kept mit_warranty" and got[3].n_sentences == 3
    assert got[7].sequence == "apache2_notice ccbync4_notice apache2_notice ccbync4_notice"
    assert L.scan_licenses(df.limit(0)).count() == 0


MIT = """MIT License

Copyright (c) 2020 Foo

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM."""
BSD = """Copyright (c) 2020, Foo
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
BSD3 = BSD + """
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
GPL = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details."""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."""


def test_wrapped_texts(spark):
    gpl2 = GPL.replace("version 3", "version 2").replace("software:", "software;")
    whole = {"mit_text": MIT, "bsd2_text": BSD, "bsd2_text,bsd3_text": BSD3, "gpl3_header": GPL, "gpl2_header": gpl2, "apache2_header,apache2_notice": APACHE}
    marks = ["", "    ", " * ", "# ", "// ", ";; ", "! ", "-- ", "dnl ", "REM "]
    rows, want = [], {}
    for rules, text in whole.items():
        for mark in marks:
            for end in ("\n", "\r\n"):
                want[len(rows)] = rules
                rows.append((len(rows), "x = 1" + end + end + end.join((mark + x).rstrip() if not x else mark + x for x in text.split("\n"))))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in L.scan_licenses(df).collect()}
    assert {i: r.rules for i, r in got.items()} == want
    assert got[0].sequence == "mit_title mit_grant mit_notice_kept mit_warranty"
    parts = {0: "Released under\nthe MIT\nLicense.", 1: "Released under\n\nthe MIT License.", 2: "Released under.\nthe MIT License.",
             3: "Released under the MIT License\nReleased under the MIT License", 4: "not released under\nthe MIT License today", 5: "x\nMIT License\ny",
             6: "Released  under\t\n \t the MIT\nLicense"}
    got = {r.doc_id: r.sequence for r in L.scan_licenses(spark.createDataFrame(list(parts.items()), "doc_id long, text string")).collect()}
    assert got == {0: "mit_notice", 1: "mit_title", 2: "mit_title", 3: "mit_notice mit_notice", 4: "", 5: "mit_title", 6: "mit_notice"}


ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY
AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE."""
ZLIB = """This software is provided 'as-is', without any express or implied
warranty. In no event will the authors be held liable.

Permission is granted to anyone to use this software for any purpose,
including commercial applications, and to alter it and redistribute it
freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented.
2. Altered source versions must be plainly marked as such, and must not be
   misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution."""
MPL = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/."""


def test_notices_tags_and_other_texts(spark):
    lgpl = GPL.replace("GNU General Public License as", "GNU Lesser General Public License as").replace("version 3", "version 2.1").replace("program is free", "library is free")
    agpl = GPL.replace("GNU General Public License as", "GNU Affero General Public License as")
    zero = ISC.replace(", provided that the above\ncopyright notice and this permission notice appear in all copies", "")
    texts = {
        "This project is licensed under the MIT License.": "MIT", "This file is released under the MIT license, see LICENSE.": "MIT",
        "This project is not licensed under the MIT License.": "", "We think that this project is licensed under the MIT License.": "", "Licensed under the MIT License of another kind.": "",
        "Licensed under the BSD 3-Clause License": "BSD-3-Clause", "This library is distributed under the terms of the GNU Lesser General\nPublic License, version 3.": "LGPL-3.0",
        "Distributed under the Boost Software License, Version 1.0.": "BSL-1.0", "the code is available under the GPLv3 or later; see x": "GPL-3.0-or-later",
        "SPDX-License-Identifier: Apache-2.0": "Apache-2.0", "<!-- SPDX-License-Identifier: GPL-2.0-or-later -->": "GPL-2.0-or-later", "# spdx-license-identifier:MIT\nx": "MIT",
        "SPDX-License-Identifier: MIT OR Apache-2.0": "", "SPDX-License-Identifier: Made-Up-1.0\nMIT": "", "mit\nApache 2.0\nunlicense": "",
        lgpl: "LGPL-2.1-or-later", agpl: "AGPL-3.0-or-later", ISC: "ISC", zero: "0BSD", ZLIB: "Zlib", MPL: "MPL-2.0", ISC.split("\n\n")[0]: "", ZLIB.replace("1. The", "3. The").split("2. Alt")[0]: "",
    }
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.licenses for r in L.scan_licenses(df).collect()}
    assert {t: got[i] for i, t in enumerate(texts)} == texts


def test_sql_on_planted_lines(spark):
    import duckdb
    texts = [f"{a}{n.title()}{b}\nnext" for n in L.NAMES for a, b in (("This work is licensed under the ", "."), ("Released under ", ", see the LICENSE file for details"), ("", "."), ("Never published under ", ""))]
    texts += [f"// SPDX-License-Identifier: {x}" for x in L.SPDX] + [k.capitalize() + "." for k in L.SENTENCES] + [None, "", "word " * 9]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    documents = df.toPandas()  # noqa: F841 - read by the SQL
    columns = ["doc_id", "n_sentences", "sequence", "rules", "licenses"]
    want = duckdb.sql(L.oracle()).df()[columns].sort_values("doc_id").values.tolist()
    assert L.scan_licenses(df).toPandas()[columns].sort_values("doc_id").values.tolist() == want
    assert {r for w in want for r in w[3].split(",")} >= {n for n, _, ids in L.RULES if len(ids) == 1}
