"""Licence recognition by sentence rules, in DataFrame functions only.

A text becomes words (lower case, every run of characters other than
a-z 0-9 . + - one blank) with marks between sentences and lines: a hard mark
behind ``. ! ?`` before white space and for blank lines, a soft one behind
``; :`` before blanks and for other line ends; full stops and blanks at a mark
are dropped. A known licence sentence, in any of its wordings, is found where
its words follow one another from one mark to another, with any soft marks
between them (wrapped lines) and hard ones only where the wording has them. Of
sentences that overlap the one that begins first counts, of those the longest.
The found sentences become identifiers. A rule is an ordered sequence of
identifiers; it matches where they follow one another in the document's
sequence of identifiers, other text between them not counted. A rule that is
part of a longer matching rule of the same licence is not listed, and where the
next identifier makes it the beginning of another licence's rule (the third BSD
clause), it does not match there at all.

Before that, dashes that stand alone or begin a line (comment marks, bullets) go,
a subject before "is licensed under" goes (but "this work", which some wordings
have), and the holder named in the third BSD clause becomes "the holder".
``SPDX-License-Identifier`` lines are sentences of their own.

Only texts with one of ``HINT_WORDS`` are cut at all; each known sentence holds
one of them inside a word, whatever stands between its words, so nothing is
lost.

``ORACLE_SQL`` knows the sentences of ``SENTENCES`` and their rules only, each within one piece
between two cuts, in texts with one of ``HINTS``; it agrees for texts without
wrapped or other wordings or unusual white space in a hint.

Defined results: one row out per row in. Null, empty and licence-free texts have
empty lists. Repeated rows get equal results. Other columns are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Known licence sentences, normalised, by identifier.
SENTENCES = {
    "apache-under": "licensed under the apache license version 2.0",
    "apache-comply": "you may not use this file except in compliance with the license",
    "apache-copy": "you may obtain a copy of the license at http www.apache.org licenses license-2.0",
    "apache-warranty": "unless required by applicable law or agreed to in writing software distributed under the license is distributed "
                       "on an as is basis without warranties or conditions of any kind either express or implied",
    "apache-see": "see the license for the specific language governing permissions and limitations under the license",
    "mit-released": "released under the mit license",
    "mit-under": "licensed under the mit license",
    "mit-title": "the mit license",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
                 "documentation files the software to deal in the software without restriction including without limitation the "
                 "rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit "
                 "persons to whom the software is furnished to do so subject to the following conditions",
    "mit-notice": "the above copyright notice and this permission notice shall be included in all copies or substantial portions "
                  "of the software",
    "gpl3-under": "this work is licensed under the gnu general public license version 3",
    "gpl-free": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
                "license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl-hope": "this program is distributed in the hope that it will be useful but without any warranty without even the implied "
                "warranty of merchantability or fitness for a particular purpose",
    "gpl-received": "you should have received a copy of the gnu general public license along with this program",
    "bsd-source": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "bsd-binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following "
                  "disclaimer in the documentation and or other materials provided with the distribution",
    "mpl-subject": "this source code form is subject to the terms of the mozilla public license v. 2.0",
    "cc-by": "licensed under cc by 4.0",
    "cc-by-sa": "licensed under cc by-sa 4.0",
    "cc-by-nc": "licensed under cc by-nc 4.0",
    "cc-by-long": "this work is licensed under a creative commons attribution 4.0 international license",
    "unlicense": "this is free and unencumbered software released into the public domain",
    "public-domain": "this work is in the public domain",
    "reserved": "all rights reserved",
}

# Further standard wordings, (identifier, wording). A | stands where
# the standard text has a sentence end or a blank line inside.
WORDINGS = [
    ("apache-under", "licensed under the apache license version 2.0 the license"),
    ("apache-copy", "you may obtain a copy of the license at | http www.apache.org licenses license-2.0"),
    ("apache-copy", "you may obtain a copy of the license at | https www.apache.org licenses license-2.0"),
    ("mit-title", "mit license"),
    ("mit-title", "the mit license mit"),
    ("mit-notice", "the above copyright notice and this permission notice including the next paragraph shall be included in all copies or "
                   "substantial portions of the software"),
    ("mpl-subject", "this source code form is subject to the terms of the mozilla public license v | 2.0"),
    ("cc-by", "this work is licensed under cc by 4.0"),
    ("cc-by-sa", "this work is licensed under cc by-sa 4.0"),
    ("cc-by-nc", "this work is licensed under cc by-nc 4.0"),
    ("cc-by-long", "this work is licensed under the creative commons attribution 4.0 international license"),
    ("cc-by-sa", "this work is licensed under a creative commons attribution-sharealike 4.0 international license"),
    ("cc-by-sa", "this work is licensed under the creative commons attribution-sharealike 4.0 international license"),
    ("cc-by-nc", "this work is licensed under a creative commons attribution-noncommercial 4.0 international license"),
    ("cc-by-nc", "this work is licensed under the creative commons attribution-noncommercial 4.0 international license"),
]

# Sentences that the SQL does not know, (identifier, wording) as above.
MORE_SENTENCES = [
    ("bsd-neither", "neither the name of the holder nor the names of its contributors may be used to endorse or promote products derived "
                    "from this software without specific prior written permission"),
    ("bsd-neither", "the name of the author may not be used to endorse or promote products derived from this software without specific "
                    "prior written permission"),
    ("gpl2-free", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
                  "license as published by the free software foundation either version 2 of the license or at your option any later version"),
    ("gpl2-only", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
                  "license version 2 as published by the free software foundation"),
    ("lgpl21-free", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public "
                    "license as published by the free software foundation either version 2.1 of the license or at your option any later version"),
    ("lgpl3-free", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public "
                   "license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("lgpl3-free", "this program is free software you can redistribute it and or modify it under the terms of the gnu lesser general public "
                   "license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("agpl3-free", "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public "
                   "license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("gpl2-title", "gnu general public license version 2 june 1991"),
    ("gpl3-title", "gnu general public license version 3 29 june 2007"),
    ("lgpl21-title", "gnu lesser general public license version 2.1 february 1999"),
    ("lgpl3-title", "gnu lesser general public license version 3 29 june 2007"),
    ("agpl3-title", "gnu affero general public license version 3 19 november 2007"),
    ("apache-title", "apache license version 2.0 january 2004"),
    ("gpl3-under", "licensed under the gnu general public license version 3"),
    ("isc-grant", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted "
                  "provided that the above copyright notice and this permission notice appear in all copies"),
    ("isc-grant", "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted "
                  "provided that the above copyright notice and this permission notice appear in all copies"),
    ("zlib-warranty", "this software is provided as-is without any express or implied warranty"),
    ("zlib-grant", "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it "
                   "and redistribute it freely subject to the following restrictions"),
    ("epl-available", "this program and the accompanying materials are made available under the terms of the eclipse public license 2.0 "
                      "which is available at https www.eclipse.org legal epl-2.0"),
    ("epl-available", "this program and the accompanying materials are made available under the terms of the eclipse public license v2.0 "
                      "which accompanies this distribution"),
]

# Licences of identifier lines.
SPDX = ("Apache-2.0", "MIT", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later", "LGPL-2.1-only", "LGPL-2.1-or-later",
        "LGPL-3.0-only", "LGPL-3.0-or-later", "AGPL-3.0-only", "AGPL-3.0-or-later", "BSD-2-Clause", "BSD-3-Clause", "ISC", "Zlib", "MPL-2.0",
        "EPL-2.0", "CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0", "Unlicense")
WORDINGS += MORE_SENTENCES + [(f"spdx-{x.lower()}", f"spdx-license-identifier {x.lower()}") for x in SPDX]

# the same said of something else than "this work"
WORDINGS += [(i, w.removeprefix("this work is ")) for i, w in [*SENTENCES.items(), *WORDINGS] if w.startswith("this work is licensed")
             and w.removeprefix("this work is ") not in {*SENTENCES.values(), *(x for _, x in WORDINGS)}]

# Rules in order, (rule, licence, sequence of identifiers).
RULES = [
    ("apache-2.0-header", "Apache-2.0", ("apache-under", "apache-comply", "apache-copy", "apache-warranty", "apache-see")),
    ("apache-2.0-short", "Apache-2.0", ("apache-under",)),
    ("mit-text", "MIT", ("mit-grant", "mit-notice")),
    ("mit-title-text", "MIT", ("mit-title", "mit-grant", "mit-notice")),
    ("mit-released", "MIT", ("mit-released",)),
    ("mit-short", "MIT", ("mit-under",)),
    ("gpl-3.0-short", "GPL-3.0-only", ("gpl3-under",)),
    ("gpl-3.0-header", "GPL-3.0-or-later", ("gpl-free", "gpl-hope", "gpl-received")),
    ("gpl-3.0-grant", "GPL-3.0-or-later", ("gpl-free",)),
    ("bsd-2-clause", "BSD-2-Clause", ("bsd-source", "bsd-binary")),
    ("mpl-2.0-header", "MPL-2.0", ("mpl-subject",)),
    ("cc-by-4.0", "CC-BY-4.0", ("cc-by",)),
    ("cc-by-4.0-long", "CC-BY-4.0", ("cc-by-long",)),
    ("cc-by-sa-4.0", "CC-BY-SA-4.0", ("cc-by-sa",)),
    ("cc-by-nc-4.0", "CC-BY-NC-4.0", ("cc-by-nc",)),
    ("unlicense", "Unlicense", ("unlicense",)),
    ("public-domain", "LicenseRef-public-domain", ("public-domain",)),
    ("all-rights-reserved", "LicenseRef-all-rights-reserved", ("reserved",)),
]
SQL_RULES = list(RULES)

# Rules of sentences that the SQL does not know.
RULES += [
    ("bsd-3-clause", "BSD-3-Clause", ("bsd-source", "bsd-binary", "bsd-neither")),
    ("gpl-2.0-header", "GPL-2.0-or-later", ("gpl2-free", "gpl-hope", "gpl-received")),
    ("gpl-2.0-grant", "GPL-2.0-or-later", ("gpl2-free",)),
    ("gpl-2.0-only", "GPL-2.0-only", ("gpl2-only",)),
    ("gpl-2.0-text", "GPL-2.0-only", ("gpl2-title",)),
    ("gpl-3.0-text", "GPL-3.0-only", ("gpl3-title",)),
    ("lgpl-2.1-grant", "LGPL-2.1-or-later", ("lgpl21-free",)),
    ("lgpl-2.1-text", "LGPL-2.1-only", ("lgpl21-title",)),
    ("lgpl-3.0-grant", "LGPL-3.0-or-later", ("lgpl3-free",)),
    ("lgpl-3.0-text", "LGPL-3.0-only", ("lgpl3-title",)),
    ("agpl-3.0-grant", "AGPL-3.0-or-later", ("agpl3-free",)),
    ("agpl-3.0-text", "AGPL-3.0-only", ("agpl3-title",)),
    ("apache-2.0-text", "Apache-2.0", ("apache-title",)),
    ("isc", "ISC", ("isc-grant",)),
    ("zlib", "Zlib", ("zlib-warranty", "zlib-grant")),
    ("epl-2.0", "EPL-2.0", ("epl-available",)),
] + [(f"spdx-{x.lower()}", x, (f"spdx-{x.lower()}",)) for x in SPDX]

HINTS = ("licen", "copyright", "rights reserved", "permission", "warranty", "public domain")
assert all(any(h in s for h in HINTS) for s in SENTENCES.values())

CUT = r"[.!?;:]+\s+|[.!?;:]*\n+"
OTHER = r"[^a-z0-9.+-]+"


# Hints of one word, which no spacing splits.
HINT_WORDS = ("licen", "copyright", "reserved", "permission", "warranty", "domain")
assert all(any(h in word for h in HINT_WORDS for word in w.split()) for w in [*SENTENCES.values(), *(w for _, w in WORDINGS)])

# Wordings as they are looked up, with their identifiers.
KNOWN = {w.replace(" | ", " "): i for i, w in [*SENTENCES.items(), *WORDINGS]}


def _marked(text):
    """The words of a lower-case text with | for a hard mark, a line feed for a soft one."""
    x = F.regexp_replace(F.translate(text, "|", "/"), r"(?<=[.!?])\s+", "|")
    x = F.regexp_replace(x, r"(?<=[;:])[^\S\n]+", "\n")
    x = F.regexp_replace(x, r"[^a-z0-9.+|\n-]+", " ")
    x = F.regexp_replace(x, r"(?<![a-z0-9.+-])-+(?![a-z0-9.+-])", " ")
    x = F.regexp_replace(F.concat(F.lit("|"), x, F.lit("|")), r"\n[ \n]*\n", "|")
    x = F.regexp_replace(x, r"(?<![. ])[. ]++(?=[|\n])|(?<=[|\n]) ", "")
    x = F.regexp_replace(x, r"[|\n]{2,}", "|")
    x = F.regexp_replace(x, r"(?<=[|\n])[ -]+", "")
    x = F.regexp_replace(x, r"(?<=[|\n])(?!this[ \n]work[ \n])(?:[a-z0-9.+-]+ ){1,8}?(?:is|are)[ \n](?=(?:licensed|released|distributed)[ \n]under[ \n])", "")
    return F.regexp_replace(x, r"(?<=[|\n])neither[ \n]the[ \n]names?[ \n]of[ \n][a-z0-9.+ |\n-]{1,200}?[ |\n]nor[ \n]the[ \n]names[ \n]of[ \n](?:its|their|any)[ \n](?=contributors[ \n])",
                            "neither the name of the holder nor the names of its ")


def _sentence() -> str:
    """The regular expression of a known sentence in a marked text, longest first."""
    def words(w):
        return r"[ |\n]".join(r"[ \n]".join(map(re.escape, part.split())) for part in w.split(" | "))
    wordings = sorted([*SENTENCES.values(), *(w for _, w in WORDINGS)], key=len, reverse=True)
    return r"(?<=[|\n])(?:" + "|".join(map(words, wordings)) + r")(?=[|\n])"


def _pattern(ids) -> str:
    return "," + ",".join(ids) + ","


def _continued(rule: str) -> list[str]:
    """Identifiers that make a rule the beginning of another licence's rule."""
    own = {r: (licence, ids) for r, licence, ids in RULES}
    mine, seq = own[rule]
    return sorted({ids[len(seq)] for _, licence, ids in RULES if licence != mine and len(ids) > len(seq) and ids[:len(seq)] == seq})


def _weaker(rules) -> dict[str, list[str]]:
    """For each rule the longer rules of its licence that contain it."""
    return {r: [q for q, other, long in rules if other == licence and len(long) > len(ids) and _pattern(ids) in _pattern(long)]
            for r, licence, ids in rules}


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_sentences (recognised), and comma-joined sentence_ids (in their
    order in the text), rules and licences (in the order of the rules)."""
    known = F.create_map(*[F.lit(x) for w, i in KNOWN.items() for x in (w, i)])
    low = F.lower("text")
    hinted = low.rlike("|".join(HINT_WORDS))
    ids = F.transform(F.regexp_extract_all(_marked(low), F.lit(_sentence()), F.lit(0)),
                      lambda s: F.element_at(known, F.translate(s, "|\n", "  ")))
    found = docs.select("doc_id", F.when(hinted, F.concat_ws(",", ids)).otherwise("").alias("sentence_ids")).select(
        "doc_id", F.coalesce("sentence_ids", F.lit("")).alias("sentence_ids"))
    run = F.concat(F.lit(","), F.col("sentence_ids"), F.lit(","))
    hit = {}
    for r, _, p in RULES:
        after = _continued(r)
        hit[r] = (run.rlike(re.escape(_pattern(p)) + "(?!(?:" + "|".join(map(re.escape, after)) + "),)") if after
                  else F.contains(run, F.lit(_pattern(p))))
    listed = {}
    for r, longer in _weaker(RULES).items():
        cond = hit[r]
        for q in longer:
            cond = cond & ~hit[q]
        listed[r] = cond
    licences = list(dict.fromkeys(licence for _, licence, _ in RULES))
    by_licence = {x: [r for r, licence, _ in RULES if licence == x] for x in licences}

    def either(conds):
        out = conds[0]
        for c in conds[1:]:
            out = out | c
        return out
    return found.select(
        "doc_id", F.when(F.col("sentence_ids") == "", 0).otherwise(F.size(F.split("sentence_ids", ","))).cast("bigint").alias("n_sentences"),
        "sentence_ids", F.concat_ws(",", *[F.when(listed[r], F.lit(r)) for r, _, _ in RULES]).alias("rules"),
        F.concat_ws(",", *[F.when(either([hit[r] for r in by_licence[x]]), F.lit(x)) for x in licences]).alias("licences"))


def _oracle() -> str:
    values = ",\n  ".join(f"('{i}', '{s}')" for i, s in SENTENCES.items())
    hit = {r: f"contains(run, '{_pattern(p)}')" for r, _, p in SQL_RULES}
    listed = {r: " AND ".join([hit[r], *[f"NOT {hit[q]}" for q in longer]]) for r, longer in _weaker(SQL_RULES).items()}
    licences = list(dict.fromkeys(licence for _, licence, _ in SQL_RULES))
    rules = ", ".join(f"CASE WHEN {listed[r]} THEN '{r}' END" for r, _, _ in SQL_RULES)
    names = ", ".join("CASE WHEN " + " OR ".join(hit[r] for r, other, _ in SQL_RULES if other == x) + f" THEN '{x}' END" for x in licences)
    return f"""
WITH known(id, sentence) AS (VALUES
  {values}),
cut AS (
  SELECT doc_id, regexp_split_to_array(lower(text), '{CUT}') AS a FROM documents
  WHERE regexp_matches(lower(text), '{"|".join(HINTS)}')),
one AS (SELECT doc_id, unnest(a) AS s, generate_subscripts(a, 1) AS pos FROM cut),
ids AS (
  SELECT doc_id, count(*) AS n, string_agg(id, ',' ORDER BY pos) AS sentence_ids
  FROM one JOIN known ON rtrim(trim(regexp_replace(s, '{OTHER}', ' ', 'g')), '. ') = sentence GROUP BY doc_id),
per AS (
  SELECT d.doc_id, coalesce(n, 0) AS n, coalesce(sentence_ids, '') AS sentence_ids,
    ',' || coalesce(sentence_ids, '') || ',' AS run
  FROM documents d LEFT JOIN ids ON d.doc_id = ids.doc_id)
SELECT doc_id, CAST(n AS BIGINT) AS n_sentences, sentence_ids,
  concat_ws(',', {rules}) AS rules,
  concat_ws(',', {names}) AS licences
FROM per"""


ORACLE_SQL = _oracle()
