"""License scan by sentence rules (operator 2).

A text is cut into sentences (at ``. ; : ! ?`` before white space or a line end, and at blank lines), and each sentence is
normalised (lower case, every run of characters other than letters and digits to one space). A single line feed within
a sentence may be a wrap or an end: known sentences are looked for in every run of consecutive whole lines of a
sentence, from the first line on, the longest first; lines that were read are not read again. Comment marks at the
start of a line (``*``, ``#``, ``//``, ``;;``, ``dnl``, ``rem``) don't count. The identifiers found, in text order, form the
document's sequence; a rule is an ordered list of identifiers, and matches when they occur in the sequence in that
order, other known sentences allowed between. Identifiers in no rule (titles, reserved rights) are in the sequence only.

Besides whole sentences of licence texts (``SENTENCES``) there are two families. A notice names a licence in one of the
``NAMES``: "[This project is] licensed under [the terms of] [the] <name>[, see LICENSE]" (``NOTICE``; anything else before it,
such as "not", makes it another sentence). A tag line is ``SPDX-License-Identifier:`` with one of the identifiers of ``SPDX``;
expressions of several identifiers are not known.

Everything is one narrow projection of column expressions over whole texts: no shuffle, no join, and the known
sentences are literal maps and a pattern of fixed size.

The SQL cuts at every line feed and so agrees where no known sentence is wrapped; wrapped ones are held by the tests.

Defined cases: a null or empty text has no sentences and no licence. A repeated sentence appears in the sequence as
often as in the text. A rule that matches in several places is reported once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sentences of public licence texts and notices, normalised as above, with their identifiers.
SENTENCES: dict[str, str] = {
    "the mit license": "mit_title",
    "mit license": "mit_title",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions": "mit_grant",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "mit_notice_kept",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement": "mit_warranty",
    "licensed under the apache license version 2 0 the license": "apache2_notice",
    "you may not use this file except in compliance with the license": "apache2_compliance",
    "you may obtain a copy of the license at": "apache2_copy",
    "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied": "apache2_warranty",
    "this program is free software": "gpl_free",
    "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version": "gpl3_terms",
    "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version": "gpl2_terms",
    "this program is distributed in the hope that it will be useful but without any warranty": "gpl_warranty",
    "without even the implied warranty of merchantability or fitness for a particular purpose": "gpl_merchantability",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsd_grant",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "bsd_source",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution": "bsd_binary",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "bsd_endorse",
    "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version": "lgpl21_terms",
    "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version": "lgpl3_terms",
    "you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version": "agpl3_terms",
    "this library is free software": "gpl_free",
    "this library is distributed in the hope that it will be useful but without any warranty": "gpl_warranty",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "isc_grant",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted": "bsd0_grant",
    "the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness": "isc_warranty",
    "this software is provided as is without any express or implied warranty": "zlib_warranty",
    "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions": "zlib_grant",
    "altered source versions must be plainly marked as such and must not be misrepresented as being the original software": "zlib_altered",
    "this notice may not be removed or altered from any source distribution": "zlib_notice_kept",
    "this is free and unencumbered software released into the public domain": "unlicense_domain",
    "anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means": "unlicense_free",
    "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license the software to use reproduce display distribute execute and transmit the software and to prepare derivative works of the software and to permit third parties to whom the software is furnished to do so all subject to the following": "boost_grant",
    "this source code form is subject to the terms of the mozilla public license v": "mpl_form",
    "if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0": "mpl2_copy",
    "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla org mpl 2 0": "mpl2_copy",
    "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0 which is available at https www eclipse org legal epl 2 0": "epl2_terms",
    "all rights reserved": "rights_reserved",
}

# Names of licences in notices, normalised, with the identifier of the notice.
NAMES: dict[str, str] = {
    "mit license": "mit_notice", "mit": "mit_notice", "mit licence": "mit_notice",
    "apache license version 2 0": "apache2_notice", "apache license 2 0": "apache2_notice", "apache license v2 0": "apache2_notice", "apache 2 0 license": "apache2_notice", "apache 2 0": "apache2_notice",
    "gnu general public license version 3": "gpl3_notice", "gnu general public license v3 0": "gpl3_notice", "gnu gpl v3": "gpl3_notice", "gpl v3": "gpl3_notice", "gplv3": "gpl3_notice", "gpl 3 0": "gpl3_notice",
    "gnu general public license version 3 or later": "gpl3_later_notice", "gplv3 or later": "gpl3_later_notice",
    "gnu general public license version 2": "gpl2_notice", "gnu general public license v2 0": "gpl2_notice", "gnu gpl v2": "gpl2_notice", "gpl v2": "gpl2_notice", "gplv2": "gpl2_notice", "gpl 2 0": "gpl2_notice",
    "gnu general public license version 2 or later": "gpl2_later_notice", "gplv2 or later": "gpl2_later_notice",
    "gnu lesser general public license version 2 1": "lgpl21_notice", "lgpl v2 1": "lgpl21_notice", "lgplv2 1": "lgpl21_notice", "lgpl 2 1": "lgpl21_notice",
    "gnu lesser general public license version 3": "lgpl3_notice", "lgpl v3": "lgpl3_notice", "lgplv3": "lgpl3_notice", "lgpl 3 0": "lgpl3_notice",
    "gnu affero general public license version 3": "agpl3_notice", "gnu agpl v3": "agpl3_notice", "agpl v3": "agpl3_notice", "agplv3": "agpl3_notice", "agpl 3 0": "agpl3_notice",
    "mozilla public license version 2 0": "mpl2_notice", "mozilla public license 2 0": "mpl2_notice", "mozilla public license v2 0": "mpl2_notice", "mpl 2 0": "mpl2_notice",
    "bsd 3 clause license": "bsd3_notice", "bsd 3 clause": "bsd3_notice", "3 clause bsd license": "bsd3_notice", "new bsd license": "bsd3_notice", "modified bsd license": "bsd3_notice",
    "bsd 2 clause license": "bsd2_notice", "bsd 2 clause": "bsd2_notice", "2 clause bsd license": "bsd2_notice", "simplified bsd license": "bsd2_notice",
    "isc license": "isc_notice", "zlib license": "zlib_notice", "unlicense": "unlicense_notice",
    "boost software license version 1 0": "boost_notice", "boost software license 1 0": "boost_notice",
    "eclipse public license version 2 0": "epl2_notice", "eclipse public license 2 0": "epl2_notice", "eclipse public license v2 0": "epl2_notice", "epl 2 0": "epl2_notice",
    "cc0 1 0": "cc0_notice", "cc0 1 0 universal": "cc0_notice", "creative commons zero v1 0 universal": "cc0_notice",
    "cc by 4 0": "ccby4_notice", "creative commons attribution 4 0 international license": "ccby4_notice",
    "cc by nc 4 0": "ccbync4_notice", "creative commons attribution noncommercial 4 0 international license": "ccbync4_notice",
    "cc by sa 4 0": "ccbysa4_notice", "creative commons attribution sharealike 4 0 international license": "ccbysa4_notice",
    "cc by nd 4 0": "ccbynd4_notice", "cc by nc sa 4 0": "ccbyncsa4_notice", "cc by nc nd 4 0": "ccbyncnd4_notice",
}

# SPDX identifiers known in tag lines.
SPDX: list[str] = [
    "0BSD", "AGPL-3.0-only", "AGPL-3.0-or-later", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "BSL-1.0", "CC-BY-4.0", "CC-BY-NC-4.0", "CC-BY-NC-ND-4.0", "CC-BY-NC-SA-4.0",
    "CC-BY-ND-4.0", "CC-BY-SA-4.0", "CC0-1.0", "EPL-2.0", "GPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0", "GPL-3.0-only", "GPL-3.0-or-later", "ISC", "LGPL-2.1-only",
    "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later", "MIT", "MPL-2.0", "Unlicense", "Zlib",
]

# The words around a licence's name in a notice, normalised.
NOTICE = ("(?:(?:this|the) (?:project|software|work|file|code|source code|library|program|package|repository|document|module) is )?"
          "(?:licensed|released|distributed|available|made available|published) under (?:the terms of )?(?:the |an? )?")
SEE = "(?: see (?:the )?(?:file )?license(?: file)?(?: txt| md)?(?: for (?:more )?(?:details|information))?)?"

# Rule name, SPDX identifier of the licence, ordered sentence identifiers.
RULES: list[tuple[str, str, tuple[str, ...]]] = [
    ("mit_notice", "MIT", ("mit_notice",)),
    ("mit_text", "MIT", ("mit_grant", "mit_notice_kept", "mit_warranty")),
    ("apache2_notice", "Apache-2.0", ("apache2_notice",)),
    ("apache2_header", "Apache-2.0", ("apache2_notice", "apache2_compliance", "apache2_copy", "apache2_warranty")),
    ("gpl3_notice", "GPL-3.0", ("gpl3_notice",)),
    ("gpl3_header", "GPL-3.0-or-later", ("gpl_free", "gpl3_terms", "gpl_warranty")),
    ("gpl2_header", "GPL-2.0-or-later", ("gpl_free", "gpl2_terms", "gpl_warranty")),
    ("ccbync4_notice", "CC-BY-NC-4.0", ("ccbync4_notice",)),
    ("ccby4_notice", "CC-BY-4.0", ("ccby4_notice",)),
    ("ccbysa4_notice", "CC-BY-SA-4.0", ("ccbysa4_notice",)),
    ("bsd2_text", "BSD-2-Clause", ("bsd_grant", "bsd_source", "bsd_binary")),
    ("bsd3_text", "BSD-3-Clause", ("bsd_grant", "bsd_source", "bsd_binary", "bsd_endorse")),
    ("gpl3_later_notice", "GPL-3.0-or-later", ("gpl3_later_notice",)),
    ("gpl2_notice", "GPL-2.0", ("gpl2_notice",)),
    ("gpl2_later_notice", "GPL-2.0-or-later", ("gpl2_later_notice",)),
    ("lgpl21_notice", "LGPL-2.1", ("lgpl21_notice",)),
    ("lgpl21_header", "LGPL-2.1-or-later", ("gpl_free", "lgpl21_terms", "gpl_warranty")),
    ("lgpl3_notice", "LGPL-3.0", ("lgpl3_notice",)),
    ("lgpl3_header", "LGPL-3.0-or-later", ("gpl_free", "lgpl3_terms", "gpl_warranty")),
    ("agpl3_notice", "AGPL-3.0", ("agpl3_notice",)),
    ("agpl3_header", "AGPL-3.0-or-later", ("gpl_free", "agpl3_terms", "gpl_warranty")),
    ("mpl2_notice", "MPL-2.0", ("mpl2_notice",)),
    ("mpl2_header", "MPL-2.0", ("mpl_form", "mpl2_copy")),
    ("bsd2_notice", "BSD-2-Clause", ("bsd2_notice",)),
    ("bsd3_notice", "BSD-3-Clause", ("bsd3_notice",)),
    ("isc_notice", "ISC", ("isc_notice",)),
    ("isc_text", "ISC", ("isc_grant", "isc_warranty")),
    ("bsd0_text", "0BSD", ("bsd0_grant", "isc_warranty")),
    ("zlib_notice", "Zlib", ("zlib_notice",)),
    ("zlib_text", "Zlib", ("zlib_warranty", "zlib_grant", "zlib_altered", "zlib_notice_kept")),
    ("unlicense_notice", "Unlicense", ("unlicense_notice",)),
    ("unlicense_text", "Unlicense", ("unlicense_domain", "unlicense_free")),
    ("boost_notice", "BSL-1.0", ("boost_notice",)),
    ("boost_text", "BSL-1.0", ("boost_grant",)),
    ("epl2_notice", "EPL-2.0", ("epl2_notice",)),
    ("epl2_header", "EPL-2.0", ("epl2_terms",)),
    ("cc0_notice", "CC0-1.0", ("cc0_notice",)),
    ("ccbynd4_notice", "CC-BY-ND-4.0", ("ccbynd4_notice",)),
    ("ccbyncsa4_notice", "CC-BY-NC-SA-4.0", ("ccbyncsa4_notice",)),
    ("ccbyncnd4_notice", "CC-BY-NC-ND-4.0", ("ccbyncnd4_notice",)),
]


def tag_id(spdx: str) -> str:
    return "spdx_" + spdx.lower().replace("-", "_").replace(".", "_")


TAG = "spdx license identifier "
TAG_RE = "(?i)SPDX-License-Identifier[ \t]*:[ \t]*"
#: Tag lines are sentences of one rule each.
TAGS: dict[str, str] = {TAG + x.lower().replace("-", " ").replace(".", " "): tag_id(x) for x in SPDX}
RULES += [(tag_id(x), x, (tag_id(x),)) for x in SPDX]

#: Start of a line up to its first word, comment marks included; an empty line keeps its line feed.
LINE_START = r"\n[^\p{L}\p{N}\n]*+(?:(?:dnl|rem)[ \t]++[^\p{L}\p{N}\n]*+)?"
SENTENCE_END = r"[.;:!?](?:[ \t\r\x0B\f]|(?=\n))"


def lines(text: Column) -> Column:
    """Normalised lines, each between line feeds; an empty line stands between sentences."""
    t = F.regexp_replace(F.concat(F.lit("\n"), F.lower(F.regexp_replace(text, TAG_RE, TAG)), F.lit("\n")), LINE_START, "\n")
    t = F.regexp_replace(F.regexp_replace(t, SENTENCE_END, "\n\n"), r"[^\p{L}\p{N}\n]+", " ")
    return F.regexp_replace(t, " ?\n ?", "\n")


def either(texts) -> str:
    """One of the texts, the longest that fits."""
    return "|".join(sorted(texts, key=len, reverse=True))


def sentence_ids(text: Column, sentences: dict[str, str] = SENTENCES, names: dict[str, str] = NAMES) -> Column:
    """Known sentence identifiers of a text, in order."""
    sentences = sentences | TAGS
    table = lambda kv: F.create_map(*[F.lit(x) for pair in kv.items() for x in pair])
    notice = f"{NOTICE}(?:{either(names)}){SEE}"
    pattern = "\n(" + f"{either(sentences)}|{notice}".replace(" ", "[ \n]") + ")(?=\n)"
    found = F.regexp_extract_all(lines(F.coalesce(text, F.lit(""))), F.lit(pattern), F.lit(1))
    name = lambda s: F.regexp_extract(s, f"^{NOTICE}({either(names)}){SEE}$", 1)
    return F.transform(F.transform(found, lambda s: F.translate(s, "\n", " ")), lambda s: F.coalesce(F.try_element_at(table(sentences), s), F.try_element_at(table(names), name(s))))


def rule_pattern(ids: tuple[str, ...]) -> str:
    """Ordered identifiers within the joined sequence `` a b c ``, others allowed between."""
    return " " + "(?:[^ ]+ )*".join(f"{x} " for x in ids)


def scan_licenses(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                  sentences: dict[str, str] = SENTENCES, rules=RULES) -> DataFrame:
    """One row per document: id, sequence (identifiers, space-joined), rules and licenses (sorted, comma-joined), n_sentences."""
    base = docs.select(F.col(id_col).alias("doc_id"), sentence_ids(F.col(text_col), sentences).alias("ids"))
    base = base.select("doc_id", F.size("ids").cast("bigint").alias("n_sentences"), F.array_join("ids", " ").alias("sequence"))
    padded = F.concat(F.lit(" "), F.col("sequence"), F.lit(" "))
    hit = lambda value: F.array_join(F.array_sort(F.array_distinct(F.array_compact(F.array(
        *[F.when(padded.rlike(rule_pattern(ids)), F.lit(value(name, spdx))) for name, spdx, ids in rules])))), ",")
    return base.select("doc_id", "n_sentences", "sequence", hit(lambda n, s: n).alias("rules"), hit(lambda n, s: s).alias("licenses"))


def oracle(sentences: dict[str, str] = SENTENCES, rules=RULES, names: dict[str, str] = NAMES) -> str:
    """DuckDB form: a relational lookup of exploded sentences and a regular expression for each rule."""
    q = lambda s: "'" + s.replace("'", "''") + "'"
    known = ", ".join(f"({q(k)}, {q(v)})" for k, v in (sentences | TAGS | {"#" + k: v for k, v in names.items()}).items())
    marks = [(n, s, f"regexp_matches(' ' || sequence || ' ', {q(rule_pattern(i))})") for n, s, i in rules]
    listed = lambda k: ", ".join(f"CASE WHEN {m[2]} THEN {q(m[k])} END" for m in marks)
    joined = lambda k: f"coalesce(array_to_string(list_sort(list_distinct(list_filter([{listed(k)}], lambda x: x IS NOT NULL))), ','), '')"
    return f"""
WITH known(s, id) AS (VALUES {known}),
cut AS (SELECT doc_id, regexp_split_to_array(regexp_replace(coalesce(text, ''), {q(TAG_RE)}, {q(TAG)}, 'g'), '\\n|[.;:!?][ \\t\\r\\x0B\\f]') AS parts FROM documents),
each AS (SELECT doc_id, unnest(parts) AS s, generate_subscripts(parts, 1) AS i FROM cut),
plain AS (SELECT doc_id, i, trim(regexp_replace(lower(s), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')) AS s FROM each),
named AS (SELECT doc_id, i, coalesce('#' || nullif(regexp_extract(s, {q(f"^{NOTICE}({either(names)}){SEE}$")}, 1), ''), s) AS s FROM plain),
found AS (SELECT doc_id, i, id FROM named JOIN known USING (s)),
seq AS (SELECT d.doc_id, coalesce(string_agg(f.id, ' ' ORDER BY f.i), '') AS sequence, count(f.id) AS n_sentences
        FROM documents d LEFT JOIN found f USING (doc_id) GROUP BY d.doc_id)
SELECT doc_id, CAST(n_sentences AS BIGINT) AS n_sentences, sequence, {joined(0)} AS rules, {joined(1)} AS licenses FROM seq"""
